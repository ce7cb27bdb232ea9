"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct word shingles. Of every permutation's minimum
all bits serve the bands that find candidates; only the two low bits are kept in
the packed signature, from which the similarity of a candidate is estimated by
bit counts, corrected for chance agreement. What passes 4.5 standard errors
below the threshold is confirmed on the full shingle sets.

Documents with equal sets are one node (128-bit digest), so copies never make
pairs. Links are then found without listing a bucket's pairs:

1. In each turn a node is confirmed against the most similar of its buckets'
   pivots, each of the first group of its bucket in the turn's order; linked
   groups become one. Large groups of near copies are mostly one after few turns.
2. Nodes leave that cannot be linked with another group, since too few of their
   shingles occur in any: a copy with many words of its own meets nobody, however
   large its bucket. The others take more turns and are looked at again.
   This step is left out where the buckets hold few enough pairs to compare bits.
3. What pairs of different groups are left in the buckets, pass the estimate and differ
   in few enough bits of their parity sketches are confirmed. A bit tells whether an odd
   number of a set's shingles falls on it, so two sets differ in as many shingles at least
   as their sketches in bits: of pairs near below the threshold hardly one is listed,
   and no link is lost.

Pairs inside one group need no check, so the components of all links found are
those of all banded links. 25 bands of 5 minima miss a link at similarity 0.85 with
probability 4e-7 and at 0.8 with 5e-5.

Defined cases: a document without words has an empty set and is linked with
nothing; one with fewer words than a shingle has its whole sequence as one;
rows that repeat an id are each treated as documents; a null id never names a
group that has another id; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import carried, components, row_slices, same_key
from casebook.operators.ordering import first_per_key
from casebook.session import Passing, materialize

BANDS, ROWS, BITS = 25, 5, 2
PERMUTATIONS = 128
LANES = PERMUTATIONS * BITS // 64
LOW_OF_PAIR = 0x5555555555555555
#: Turns at most, and pairs a node below which no more are taken; results do not depend on them.
TURNS, MORE_TURNS, PAIRS_PER_NODE = 3, 4, 20
#: A turn that links a smaller share of the nodes is the last; pairs a node up to which bits are compared at once. As above.
LEAST_GAIN, COMPARED = 0.05, 2000
#: Lanes of 64 bits in a parity sketch.
SKETCH = 32
#: Labels of so few nodes are broadcast instead of shuffled in every join; results do not depend on it.
FEW = 50_000
#: Standard errors below the threshold at which an estimate still counts: a link falls below it three times in a million.
MARGIN = 4.5

_random = np.random.default_rng(20_240_601)
MULTIPLIERS = _random.integers(0, 1 << 64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
MIXERS = _random.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)

SIGNATURES = (
    "doc_id long, mark long, n_shingles long, node binary, bands array<long>, signature array<long>"
)


@dataclass(frozen=True)
class Rule:
    """Shingle length in words, and the similarity from which documents are linked, in hundredths."""

    shingle: int = 5
    percent: int = 80


class WordHashes(dict):
    """64-bit hash of each word, computed once per word of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str | None, length: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(length, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        mixed = (mixed ^ h[j : j + n]) * MIXERS[j]
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least permuted hash of each permutation, in slices so that a long text stays small."""
    least = np.full(PERMUTATIONS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        np.minimum(least, (MULTIPLIERS[:, None] * part[None, :]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * MIXERS[8]
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    for j in range(ROWS):
        keys = (keys ^ rows[:, j]) * MIXERS[16 + j]
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the upper half of each minimum, 32 permutations to a lane."""
    low = ((least >> np.uint64(32)) & np.uint64(3)).reshape(LANES, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low << shifts, axis=1).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """The parity sketch of a set: for each bit whether an odd number of its shingles falls on it."""
    counts = np.bincount((shingles & np.uint64(64 * SKETCH - 1)).view(np.int64), minlength=64 * SKETCH)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def marked(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string"))


def signatures(documents: DataFrame, rule: Rule) -> DataFrame:
    """One stored row per document with its set size, node, bands and packed signature; texts stay in the input."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.list_(pa.int64())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in row_slices(batches):
            sizes, nodes, bands, signs = [], [], [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, rule.shingle, hashes)
                sizes.append(len(shingles))
                if len(shingles):
                    least = minima(shingles)
                    nodes.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    bands.append(band_keys(least))
                    signs.append(packed(least))
                else:
                    nodes.append(None)
                    bands.append(None)
                    signs.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array(x, f.type) for x, f in zip((sizes, nodes, bands, signs), list(schema)[2:], strict=True)],
                schema=schema,
            )

    return materialize(marked(documents).mapInArrow(sign, SIGNATURES), "signatures")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: agreeing slots by bit counts, less the agreement by chance."""
    differing = F.lit(0)
    for lane in range(LANES):
        x = a[lane].bitwiseXOR(b[lane])
        differing = differing + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(LOW_OF_PAIR)))
    agreeing = (F.lit(PERMUTATIONS) - differing) / F.lit(float(PERMUTATIONS))
    chance = 2.0**-BITS
    return (agreeing - F.lit(chance)) / F.lit(1 - chance)


def least_estimate(rule: Rule) -> float:
    """``MARGIN`` standard errors below the threshold."""
    chance, t = 2.0**-BITS, rule.percent / 100
    p = t + (1 - t) * chance
    return t - MARGIN * math.sqrt(p * (1 - p) / PERMUTATIONS) / (1 - chance)


def texts_of(wanted: DataFrame, signed: DataFrame, documents: DataFrame) -> DataFrame:
    """Stored (node, text) of the wanted nodes, read from the input.

    One row stands for a node, named by its id and the hash of its text, so copies do not meet under one key. Rows that repeat
    both are taken once.
    """
    whole = lambda df: df.withColumn("key", F.coalesce("doc_id", F.lit(0)))
    holders = whole(
        signed.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct("doc_id", "mark")).alias("row"))
        .join(wanted, "node").select("node", "row.doc_id", "row.mark")
    ).withColumnRenamed("doc_id", "id")
    found = whole(marked(documents)).join(holders, ["key", "mark"]).where(F.col("doc_id").eqNullSafe(F.col("id")))
    return materialize(first_per_key(found, ["key", "mark", "node"], [F.col("text")]).select("node", "text"), "texts")


def confirm(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Those pairs (a, b) of nodes whose full sets reach the threshold."""
    rows = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, held = None, None
        for batch in row_slices(batches):
            keep = []
            for b, text_a, text_b in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                if b != last:  # rows mostly arrive sorted by b
                    last, held = b, shingle_set(text_b, rule.shingle, hashes)
                other = shingle_set(text_a, rule.shingle, hashes)
                shared = len(np.intersect1d(held, other, assume_unique=True))
                keep.append(100 * shared >= rule.percent * (len(held) + len(other) - shared))
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], schema=schema)

    return rows.mapInArrow(check, "a binary, b binary").distinct()


def place(turn: int, group: str = "group", size: str = "size") -> Column:
    """The order of groups in a turn: large ones first, equal ones at random."""
    return F.struct((-F.col(size)).alias("size"), F.xxhash64(F.lit(turn), group).alias("turn"))


def near(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def sized(labels: DataFrame, few: bool = False) -> DataFrame:
    """Labels (node, group, size)."""
    sizes = labels.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    return labels.join(near(sizes, few), "group").select("node", "group", "size")


def group_links(labels: DataFrame, links: DataFrame, few: bool = False) -> DataFrame:
    """Distinct links (a, b) between the groups of linked nodes, with the size of b."""
    of = lambda node, *names: near(labels.select(F.col("node").alias(node), *[F.col(c).alias(n) for c, n in names]), few)
    both = links.join(of("a", ("group", "ga")), "a").join(of("b", ("group", "gb"), ("size", "size_b")), "b")
    return both.where(F.col("ga") != F.col("gb")).select(F.col("ga").alias("a"), F.col("gb").alias("b"), "size_b").distinct()


def hook(labels: DataFrame, links: DataFrame, turn: int) -> DataFrame:
    """Labels after each group has joined the first one in the turn's order that its links reach.

    All links lead to an earlier group, so there are no circles. Two jumps shorten the chains; what they leave
    apart is joined in later turns and at the end.
    """
    to = F.min(F.struct(place(turn, "b", "size_b").alias("place"), F.col("b")))["b"]
    few = labels.count() <= FEW
    first = group_links(labels, links, few).groupBy("a").agg(to.alias("to"))
    with Passing(labels.sparkSession) as block:
        first = materialize(first.select(F.col("a").alias("group"), "to"), "hooks")
        for _ in range(2):
            further = first.select(F.col("group").alias("to"), F.col("to").alias("on"))
            first = first.join(near(further, few), "to", "left").select("group", F.coalesce("on", "to").alias("to"))
        moved = labels.join(near(first, few), "group", "left").select("node", F.coalesce("to", "group").alias("group"))
        return block.keep(sized(moved, few), "labels")


def closed(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, group), stored, with one group per connected component of the links (a, b) between groups."""
    with Passing(labels.sparkSession) as block:
        found = components(group_links(labels, links, labels.count() <= FEW)).select(F.col("node").alias("group"), "component")
        return block.keep(
            labels.join(found, "group", "left").select("node", F.coalesce("component", "group").alias("group")), "labels"
        )


def pivot_pairs(labelled: DataFrame, rule: Rule, turn: int) -> DataFrame:
    """For each node the most similar pivot (a, b) of an earlier group in its buckets, stored.

    A bucket's pivot is a node of its first group in the turn's order.
    """
    node = F.xxhash64(F.lit(turn), "node")
    order = F.struct(place(turn).alias("place"), F.col("group"), node.alias("n"), F.col("node"), F.col("signature"))
    pivots = labelled.groupBy("bucket").agg(F.min(order).alias("pivot"))
    best = (
        labelled.join(pivots, "bucket")
        .where(F.col("group") != F.col("pivot.group"))
        .withColumn("similarity", estimate(F.col("signature"), F.col("pivot.signature")))
        .where(F.col("similarity") >= least_estimate(rule))
        .groupBy("node").agg(F.max(F.struct("similarity", "pivot.node")).alias("best"))
    )
    return materialize(best.select(F.col("node").alias("a"), F.col("best.node").alias("b")), "pivots")


def support(rows: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """node, n (set size), s: how many of a node's shingles another group's nodes have, stored.

    Two linked nodes of different groups share at most the smaller of their s, so s bounds what a node can be linked with.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in row_slices(batches):
            sets = [shingle_set(text, rule.shingle, hashes).view(np.int64) for text in batch.column(2).to_pylist()]
            of = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
            if len(of):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(np.concatenate(sets))],
                    names=["name", "group", "shingle"],
                )

    nodes = rows.select("node", "group").distinct().join(texts, "node")
    named = nodes.select(F.xxhash64("node").alias("name"), F.xxhash64("group").alias("group"), "text")
    parts = named.mapInArrow(explode, "name long, group long, shingle long")
    both = parts.groupBy("shingle").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    both = both.where(F.col("low") != F.col("high")).select("shingle")
    counts = parts.join(both, "shingle").groupBy("name").agg(F.count(F.lit(1)).alias("s"))
    return materialize(counts, "support")


def pairs_across(labelled: DataFrame) -> int:
    """How many pairs of different groups the buckets hold."""
    sizes = labelled.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("n"))
    each = sizes.groupBy("bucket").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"))
    return int(each.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0])


def mixed(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several groups, with the least set size in the bucket."""
    each = rows.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.min("n").alias("least"))
    return rows.join(each.where(F.col("low") != F.col("high")).select("bucket", "least"), "bucket")


def supported(labelled: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Rows of mixed buckets whose nodes may have a link into another group, with s, stored.

    Left out, exactly, are nodes of which other groups have too few shingles: a link of sets with sizes n and m
    shares percent / (100 + percent) * (n + m) shingles at least. What is left out no longer supports others, so
    this repeats while it removes a tenth of the rows.
    """
    still = materialize(mixed(labelled).drop("least"), "mixed").withColumn("s", F.lit(0).cast("long"))
    left = still.count()
    while left:
        with Passing(labelled.sparkSession) as block:
            counts = support(still, texts, rule)
            counted = mixed(still.drop("s").withColumn("name", F.xxhash64("node")).join(counts, "name", "left").drop("name"))
            s = F.coalesce("s", F.lit(0))
            least = F.greatest(F.col("least"), F.ceil(F.col("n") * rule.percent / 100))
            enough = s * (100 + rule.percent) >= rule.percent * (F.col("n") + least)
            still = block.keep(mixed(counted.where(enough).drop("least")).drop("least"), "mixed")
        before, left = left, still.count()
        if left > 0.9 * before:
            break
    return still


def sketches(wanted: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """node and its parity sketch in the columns of ``lanes``, of the wanted nodes."""
    schema = pa.schema([("node", pa.binary()), *[(c, pa.int64()) for c in lanes()]])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in row_slices(batches):
            found = [parities(shingle_set(text, rule.shingle, hashes)) for text in batch.column(1).to_pylist()]
            if found:
                columns = np.ascontiguousarray(np.stack(found).T)
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], schema=schema)

    rows = wanted.select("node").distinct().join(texts, "node").select("node", "text")
    return rows.mapInArrow(sketch, ", ".join(["node binary", *[f"{c} long" for c in lanes()]]))


def lanes(end: str = "") -> list[str]:
    return [f"lane{i}{end}" for i in range(SKETCH)]


def across(still: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """All pairs (a, b) of different groups that share a bucket of the rows and may be linked, once each, stored."""
    still = materialize(still.join(nodes.select("node", "bands"), "node").join(sketches(still, texts, rule), "node"), "open")
    side = lambda end: still.select(
        F.col("node").alias(end),
        *[F.col(c).alias(f"{c}_{end}") for c in ("bucket", "group", "bands", "signature", "n", "s", *lanes())],
    )
    differing = reduce(Column.__add__, [
        F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(lanes("_a"), lanes("_b"), strict=True)
    ])
    # A pair that shares several buckets counts in the first of them.
    first = F.array_position(F.zip_with("bands_a", "bands_b", lambda x, y: x == y), True)
    met = side("a").join(
        side("b"),
        (F.col("bucket_a") == F.col("bucket_b")) & (F.col("group_a") < F.col("group_b"))
        & (F.least("s_a", "s_b") * (100 + rule.percent) >= rule.percent * (F.col("n_a") + F.col("n_b")))
        & (estimate(F.col("signature_a"), F.col("signature_b")) >= least_estimate(rule))
        & (differing * (100 + rule.percent) <= (F.col("n_a") + F.col("n_b")) * (100 - rule.percent))
        & (F.element_at("bands_a", first.cast("int")) == F.col("bucket_a")),
    )
    return materialize(met.select("a", "b"), "across")


def take_turns(
    rows: DataFrame, labels: DataFrame, texts: DataFrame, rule: Rule, turns: range, n: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Labels of n nodes after some turns over the rows (bucket, node, …), and the links found."""
    links, bound = [], PAIRS_PER_NODE * n
    for turn in turns:
        with Passing(rows.sparkSession) as block:
            labelled = materialize(rows.join(near(labels, bound <= PAIRS_PER_NODE * FEW), "node"), "labelled")
            if pairs_across(labelled) <= bound:
                break
            links.append(block.keep(confirm(pivot_pairs(labelled, rule, turn), texts, rule), "links"))
        found = links[-1].count()
        if found:
            labels = hook(labels, links[-1], turn)
        if found < max(1, LEAST_GAIN * n):
            break
    return labels, links


def near_duplicates(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One stored row per document: doc_id, mark, n_shingles, component_id, kept. Tables made on the way are removed."""
    with Passing(documents.sparkSession) as block:
        return block.keep(classes(documents, rule), "classes")


def classes(documents: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``near_duplicates``, from tables that must still be there when they are read."""
    signed = signatures(documents, rule)
    filled = signed.where(F.col("node").isNotNull())
    nodes = materialize(
        filled.groupBy("node").agg(
            F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n"),
        ),
        "nodes",
    )
    every = nodes.select("node", "signature", "n", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("bucket")
    rows = materialize(every.join(shared, "bucket"), "buckets")
    alone = rows.select("node").distinct().select("node", F.col("node").alias("group"), F.lit(1).cast("long").alias("size"))
    labels = materialize(alone, "labels")
    texts = texts_of(labels.select("node"), signed, documents)
    n = labels.count()
    labels, links = take_turns(rows, labels, texts, rule, range(TURNS), n)
    labelled = rows.join(labels, "node")
    if pairs_across(labelled) <= COMPARED * n:
        still = mixed(labelled).drop("least").withColumn("s", F.col("n"))
    else:
        still = supported(labelled, texts, rule)
        names = ["bucket", "node", "signature", "n"]
        labels, more = take_turns(still.select(names), labels, texts, rule, range(TURNS, TURNS + MORE_TURNS), n)
        if more:
            still = supported(still.select(names).join(labels, "node"), texts, rule)
        links += more
    links.append(materialize(confirm(across(still, nodes, texts, rule), texts, rule), "links"))
    labels = closed(labels, reduce(DataFrame.union, links))

    named = nodes.select("node", "id").join(labels, "node", "left").select(
        "node", "id", F.coalesce("group", "node").alias("group")
    )
    smallest = named.groupBy("group").agg(F.min("id").alias("component_id"))
    of_node = named.join(smallest, "group").select("node", "component_id")
    return signed.select("doc_id", "mark", "n_shingles", "node").join(of_node, "node", "left").select(
        "doc_id",
        "mark",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def keep_one(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The input rows less near-duplicates: of each group the row with the smallest id, repeated rows once."""
    kept = near_duplicates(documents, rule).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")
    ).distinct()
    matched = carried(documents).join(kept, same_key("_id", "_mark"), "left_semi")
    return first_per_key(matched, ["doc_id", "mark"], [F.col("mark")]).select("row.*")
