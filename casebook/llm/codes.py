"""Vector code compression: product codes whose nearest entries are found in a GNAT.

Vectors become integers and are cut into equal parts; every part position has a
codebook, fitted by rounds of assignment and integer means. Assignment searches a
geometric near-neighbour access tree over the entries: a node keeps split points
and, for every child and split point, the range of distances from the split point
to the child's entries. A query's distance to the split points then rules out
whole children. All of it is integer work: distances are exact squares, roots are
rounded towards keeping a child, a child goes only if it is strictly farther than
the best entry so far, and equal distances are settled by the lower index. Queries
walk the tree in batches, a node at a time, so the walk is array arithmetic.

Spark scans the vectors once a round; each task sends its sums per entry, which are
aggregated before and after the shuffle. The driver holds the codebooks alone:
``parts`` times ``entries`` short vectors, whatever the number of rows.

Defined cases: rows whose vector is null, empty or holds null or non-finite
components are dropped, and so are those whose length differs from the most
frequent length that the parts divide (ties: the smaller); with fewer rows than
entries the codebook is shorter; a null vec_id comes last in the order and keeps
its row; equal rows each get their row; equal labels sum up together, null labels
too; an empty table gives no rows; other columns are not read. Integers of any
size are exact; an error that exceeds a long is given as the largest long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.vectors import finite, matrix, usual_width
from casebook.session import materialize

LONG = (1 << 63) - 1
#: Squares of differences of integers up to here, summed over a thousand components, are exact in a double.
EXACT = 1 << 20
BATCH = 2048
LIMB = 1 << 60


@dataclass(frozen=True)
class Rule:
    """``scale`` turns components into integers; a tree node of up to ``leaf`` entries is searched whole."""

    scale: int = 1024
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    splits: int = 12
    leaf: int = 16


# Integer distances


def is_exact(*arrays: np.ndarray) -> bool:
    return all(a.dtype != object and a.shape[-1] <= 1000 and (not a.size or np.abs(a).max() <= EXACT) for a in arrays)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``; Python integers where doubles would round."""
    if is_exact(a, b):
        total = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
        return (total - 2 * (a @ b.T)).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    x, y = whole(a), whole(b)
    return np.array([[sum((p - q) ** 2 for p, q in zip(row, entry)) for entry in y] for row in x], object).reshape(len(a), len(b))


def root_down(square: np.ndarray) -> np.ndarray:
    """Integer square roots, rounded down."""
    if square.dtype == object:
        return np.frompyfunc(math.isqrt, 1, 1)(square)
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    root -= root * root > square
    return root + ((root + 1) * (root + 1) <= square)


def root_up(square: np.ndarray) -> np.ndarray:
    """Integer square roots, rounded up."""
    root = root_down(square)
    return root + (root * root < square)


# The tree


@dataclass
class Node:
    """``ids`` are compared with every query that gets here; child i holds entries nearest to ids[i] of the splits."""

    ids: np.ndarray
    points: np.ndarray
    children: list[Node | None] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


def spread_out(points: np.ndarray, k: int) -> list[int]:
    """k places far from each other: the first, then always the one farthest from those taken."""
    taken = [0]
    closest = squares(points, points[:1])[:, 0]
    while len(taken) < k:
        taken.append(int(np.argmax(closest)))
        closest = np.minimum(closest, squares(points, points[taken[-1:]])[:, 0])
    return taken


def grow(points: np.ndarray, ids: np.ndarray, rule: Rule) -> Node:
    if len(ids) <= rule.leaf:
        return Node(ids, points)
    taken = spread_out(points, rule.splits)
    node = Node(ids[taken], points[taken])
    rest = np.setdiff1d(np.arange(len(ids)), taken)
    distance = squares(points[rest], node.points)
    home = np.argmin(distance, axis=1)
    shape = (len(taken), len(taken))
    node.near, node.far = np.zeros(shape, distance.dtype), np.zeros(shape, distance.dtype)
    for child in range(len(taken)):
        members = home == child
        if not members.any():
            node.children.append(None)
            continue
        node.near[child] = root_down(distance[members].min(axis=0))
        node.far[child] = root_up(distance[members].max(axis=0))
        node.children.append(grow(points[rest[members]], ids[rest[members]], rule))
    return node


def tree(entries: np.ndarray, rule: Rule) -> Node:
    """The tree of a codebook; of equal entries the lowest index alone can win, so the others stay out."""
    _, first = np.unique(entries if entries.dtype != object else entries.astype(str), axis=0, return_index=True)
    first = np.sort(first)
    return grow(entries[first], first, rule)


def search(node: Node, queries: np.ndarray, best: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """Lower ``best`` (squares) and ``index`` of the queries at ``rows`` by what the node holds."""
    distance = squares(queries[rows], node.points)
    low = distance.min(axis=1)
    # The lowest index among the entries at the least distance.
    won = np.where(distance == low[:, None], node.ids[None, :], LONG).min(axis=1)
    better = (low < best[rows]) | ((low == best[rows]) & (won < index[rows]))
    best[rows[better]], index[rows[better]] = low[better], won[better]
    if not node.children:
        return
    down, up = root_down(distance), root_up(distance)
    home = np.argmin(distance, axis=1)
    # Every query first goes where its nearest split is, so that its best is small when the others are looked at.
    for at_home in (True, False):
        for child, below in enumerate(node.children):
            if below is None:
                continue
            here = np.flatnonzero((home == child) == at_home)
            reach = root_up(best[rows[here]])[:, None]
            gone = ((down[here] - node.far[child]) > reach) | ((node.near[child] - up[here]) > reach)
            stay = rows[here[~gone.any(axis=1)]]
            if len(stay):
                search(below, queries, best, index, stay)


def nearest(node: Node, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of every query; exact, ties to the lower index."""
    exact = is_exact(queries, node.points)
    best = np.full(len(queries), np.iinfo(np.int64).max, np.int64 if exact else object)
    if not exact:
        best[:] = max([1 << 64, *squares(queries, node.points[:1])[:, 0]]) + 1 if len(queries) else 0
    index = np.full(len(queries), LONG, np.int64)
    for start in range(0, len(queries), BATCH):
        search(node, queries, best, index, np.arange(start, min(start + BATCH, len(queries))))
    return index, best


# Fitting


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles that hold integers, Python integers where they grow large."""
    scaled = vectors * scale
    if not vectors.size or np.abs(scaled).max() <= EXACT:
        return np.floor(scaled)
    return np.frompyfunc(lambda x: math.floor(Fraction(x) * scale), 1, 1)(vectors)


def seeds(kept: DataFrame, rule: Rule) -> list[np.ndarray]:
    """The codebooks that the rows of the smallest ids make; at most ``entries`` rows reach the driver."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(rule.entries).collect()
    vectors = whole(np.array([row["vector"] for row in first], np.float64), rule.scale)
    return np.split(vectors, rule.parts, axis=1)


def moved(kept: DataFrame, books: list[np.ndarray], rule: Rule) -> list[np.ndarray]:
    """One round: assign all parts, then replace every used entry by the floor of its parts' mean."""
    width = books[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [tree(book, rule) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, object) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = whole(matrix(batch.column("vector"), width * rule.parts), rule.scale)
            for part, values in enumerate(np.split(vectors, rule.parts, axis=1)):
                index, _ = nearest(trees[part], values)
                order = np.argsort(index, kind="stable")
                used, start, n = np.unique(index[order], return_index=True, return_counts=True)
                counts[part][used] += n
                added = np.add.reduceat(values[order], start, axis=0)
                totals[part][used] += np.frompyfunc(int, 1, 1)(added)
        rows = []
        for part, entry in ((p, e) for p in range(rule.parts) for e in np.flatnonzero(counts[p])):
            n, rest = int(counts[part][entry]), [int(t) for t in totals[part][entry]]
            limb = 0
            while limb == 0 or any(rest):
                signs = [-1 if t < 0 else 1 for t in rest]
                rows.append((part, int(entry), limb, n, [s * (abs(t) % LIMB) for s, t in zip(signs, rest)]))
                n, limb, rest = 0, limb + 1, [s * (abs(t) // LIMB) for s, t in zip(signs, rest)]
        columns = zip(*rows) if rows else ((),) * 5
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["part", "entry", "limb", "n", "total"]
        )

    # Sums of any size travel as limbs, which Spark adds as decimals that no number of rows overflows.
    partial = kept.select("vector").mapInArrow(sums, "part int, entry int, limb int, n long, total array<long>")
    each = [F.sum(F.col("total")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    found = partial.groupBy("part", "entry", "limb").agg(F.sum("n").alias("n"), *each).collect()
    used: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in found:
        n, total = used.get((row["part"], row["entry"]), (0, [0] * width))
        added = [t + int(row[f"s{i}"]) * LIMB ** row["limb"] for i, t in enumerate(total)]
        used[row["part"], row["entry"]] = n + row["n"], added
    fresh = [book.copy() for book in books]
    for (part, entry), (n, total) in used.items():
        means = [t // n for t in total]
        if fresh[part].dtype != object and max(map(abs, means)) > EXACT:
            fresh[part] = np.frompyfunc(int, 1, 1)(fresh[part])
        fresh[part][entry] = means
    return fresh


def encoded(kept: DataFrame, books: list[np.ndarray], rule: Rule) -> DataFrame:
    """vec_id, label, code and error of every kept row."""
    width = books[0].shape[1] * rule.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [tree(book, rule) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = whole(matrix(batch.column("vector"), width), rule.scale)
            found = [nearest(t, values) for t, values in zip(trees, np.split(vectors, rule.parts, axis=1))]
            codes = ["".join(f"{i:02x}" for i in row) for row in zip(*[index for index, _ in found])]
            errors = [min(LONG, sum(map(int, row))) for row in zip(*[square for _, square in found])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return kept.mapInArrow(run, "vec_id long, label long, code string, error long")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, as decimals between commas."""
    numbers = (str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(embeddings: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row of (vec_id, embedding, label)."""
    spark = embeddings.sparkSession
    result = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    vector = embeddings["embedding"].cast("array<double>")
    kept = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["label"].cast("long").alias("label"), vector.alias("vector")
    ).where(finite(F.col("vector")) & (F.size("vector") % rule.parts == 0))
    size = usual_width(kept.select(F.size("vector").alias("size")), "size")
    if size is None:
        return spark.createDataFrame([], result)
    kept = kept.where(F.size("vector") == size)
    books = seeds(kept, rule)
    for _ in range(rule.rounds):
        books = moved(kept, books, rule)
    codes = materialize(encoded(kept, books, rule), "codes")
    return with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def with_label_error(codes: DataFrame, most_labels: int = 1_000_000, salts: int = 16) -> DataFrame:
    """Add the error summed over equal labels, nulls together; a sum beyond a long is the largest long.

    Totals are two numbers a label, so up to ``most_labels`` of them are broadcast
    (24 MB); more are joined by label and salt, which splits a label of many rows.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    totals = materialize(codes.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "labels")
    same = F.col("label").eqNullSafe(F.col("of"))
    if totals.count() <= most_labels:
        return codes.join(F.broadcast(totals), same).drop("of")
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)))
    spread = totals.withColumn("for_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, same & (F.col("salt") == F.col("for_salt"))).drop("of", "salt", "for_salt")
