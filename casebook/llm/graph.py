"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard.

Distinct vectors are dealt to shards by hash, and every shard builds one directed
graph in one task. Points come in batches: each batch searches the graph as it is,
the points met become candidates, and relaxed pruning keeps a near candidate and
drops those that are much nearer to it than to the point, so that edges point in
diverse directions. Edges are returned by their targets, which prune in turn. A
query then runs a beam search in every shard, and the best of all shards are kept.

Largest inner product is turned into least distance by one more component that
gives all vectors of a shard the same length, so pruning has a metric to rest on.
Searches of a batch go side by side: each step is array arithmetic for all of them.

Sizes are bounded: a shard holds about ``shard`` vectors and a block about
``block`` queries, whatever the table's size, and a search task holds one of each.
The graph is a stored table, so a lost search task builds nothing anew.

Equal vectors are one point, with the ``k + 1`` smallest vec_ids: more of them can be
in no answer, since equal vectors tie and ties go to the smaller id. They are
found in two steps, so a vector that many rows share is thinned before it meets.

Defined cases: vectors null, empty, zero or with null or non-finite components take
no part, nor do those of another length than the most frequent one (ties: the
smaller); rows of equal vec_id and vector count once; rows of equal vec_id and
different vectors are candidates of their own, and each is a query of its own, but
none is found for its own id; a null vec_id is no query, but found, last among
ties; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casebook.llm.vectors import finite, matrix, usual_width
from casebook.session import materialize


@dataclass(frozen=True)
class Rule:
    """``k`` neighbours; ``degree`` edges a point; beams of ``build_beam`` and ``beam``; pruning relaxed by ``alpha``."""

    k: int = 20
    degree: int = 48
    build_beam: int = 96
    beam: int = 128
    alpha: float = 1.2
    shard: int = 8192
    block: int = 4096
    width: int = 4
    #: Tasks at most; shards weigh little in bytes and much in work, so they are not left to be put together by size.
    tasks: int = 10_000
    #: Of the points already in the graph, the share that one batch may add, and the least and largest batch.
    growth: float = 0.1
    least: int = 32
    most: int = 512


# One shard


def beam_search(graph: np.ndarray, points: np.ndarray, entry: int, queries: np.ndarray, beam: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` nearest points met, for all queries at once; ids are -1 where fewer.

    Every step expands the ``width`` nearest open points of each query. No sum of
    squares of the query is added: it is the same for all points.
    """
    n, size = len(points), len(queries)
    norms = (points * points).sum(axis=1)
    beam, width = max(beam, width), min(width, beam)
    ids = np.full((size, beam), -1, np.int64)
    far = np.full((size, beam), np.inf, points.dtype)
    open_ = np.zeros((size, beam), bool)
    ids[:, 0], far[:, 0], open_[:, 0] = entry, norms[entry] - 2 * (queries @ points[entry]), True
    met = np.zeros((size, n), bool)
    met[:, entry] = True
    live = np.arange(size)
    while True:
        waiting = np.where(open_[live], far[live], np.inf)
        pick = np.argpartition(waiting, width - 1, axis=1)[:, :width]
        real = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
        goes_on = real.any(axis=1)
        live, pick, real = live[goes_on], pick[goes_on], real[goes_on]
        if not len(live):
            return ids, far
        closing = open_[live]
        np.put_along_axis(closing, pick, False, axis=1)
        open_[live] = closing
        out = graph[np.take_along_axis(ids[live], pick, axis=1)]
        out = np.where(real[:, :, None], out, -1).reshape(len(live), -1)
        row, place = np.nonzero(out >= 0)
        target = out[row, place]
        fresh = ~met[live[row], target]
        pair = np.unique(row[fresh] * n + target[fresh])
        row, target = pair // n, pair % n
        met[live[row], target] = True
        distance = norms[target] - 2 * np.einsum("ij,ij->i", queries[live[row]], points[target])
        near = distance < far[live].max(axis=1)[row]
        row, target, distance = row[near], target[near], distance[near]
        if not len(row):
            continue
        counts = np.bincount(row, minlength=len(live))
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        shape = (len(live), int(counts.max()))
        more_ids, more_far = np.full(shape, -1, np.int64), np.full(shape, np.inf, points.dtype)
        more_ids[row, place], more_far[row, place] = target, distance
        all_ids = np.concatenate([ids[live], more_ids], axis=1)
        all_far = np.concatenate([far[live], more_far], axis=1)
        all_open = np.concatenate([open_[live], more_ids >= 0], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, axis=1)
        far[live] = np.take_along_axis(all_far, best, axis=1)
        open_[live] = np.take_along_axis(all_open, best, axis=1)


def robust_prune(points: np.ndarray, at: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` edges for each point of ``at``: nearest first, without those a kept one makes needless."""
    place = points[np.maximum(candidates, 0)]
    distance = ((place - points[at][:, None, :]) ** 2).sum(axis=2)
    distance[(candidates < 0) | (candidates == at[:, None])] = np.inf
    order = np.argsort(distance, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    distance = np.take_along_axis(distance, order, axis=1)
    place = np.take_along_axis(place, order[:, :, None], axis=1)
    square = (place * place).sum(axis=2)
    between = square[:, :, None] + square[:, None, :] - 2 * place @ place.transpose(0, 2, 1)
    edges = np.full((len(at), degree), -1, np.int64)
    count = np.zeros(len(at), np.int64)
    alive = np.isfinite(distance)
    for j in range(candidates.shape[1]):
        chosen = np.flatnonzero(alive[:, j] & (count < degree))
        edges[chosen, count[chosen]] = candidates[chosen, j]
        count[chosen] += 1
        alive[chosen] &= alpha * alpha * between[chosen, j] > distance[chosen]
    return edges


def return_edges(graph: np.ndarray, points: np.ndarray, added: np.ndarray, rule: Rule) -> None:
    """Give the targets of the added points' edges an edge back; a target with too many prunes them."""
    source = np.repeat(added, graph.shape[1])
    target = graph[added].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    owners, start, counts = np.unique(target, return_index=True, return_counts=True)
    more = np.full((len(owners), int(counts.max(initial=0))), -1, np.int64)
    more[np.repeat(np.arange(len(owners)), counts), np.arange(len(target)) - np.repeat(start, counts)] = source
    both = np.concatenate([graph[owners], more], axis=1)
    full = (both >= 0).sum(axis=1) > graph.shape[1]
    packed = np.argsort(both < 0, axis=1, kind="stable")[:, : graph.shape[1]]
    graph[owners[~full]] = np.take_along_axis(both, packed, axis=1)[~full]
    crowded = np.flatnonzero(full)
    for start in range(0, len(crowded), rule.most):
        some = crowded[start : start + rule.most]
        graph[owners[some]] = robust_prune(points, owners[some], both[some], rule.degree, rule.alpha)


def of_equal_length(vectors: np.ndarray) -> np.ndarray:
    """The vectors scaled to a largest length of one, with the component that makes all lengths equal."""
    square = (vectors * vectors).sum(axis=1)
    most = square.max(initial=0) or 1.0
    rest = np.sqrt(np.maximum(0, 1 - square / most))
    return np.concatenate([vectors / np.sqrt(most), rest[:, None]], axis=1).astype(np.float32)


def build(vectors: np.ndarray, rule: Rule, seed: int = 7) -> tuple[np.ndarray, int]:
    """(edges, entry point) of the graph over the vectors."""
    points = of_equal_length(vectors)
    n = len(points)
    graph = np.full((n, rule.degree), -1, np.int64)
    entry = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        size = min(done, max(rule.least, min(rule.most, int(done * rule.growth))), n - done)
        batch = order[done : done + size]
        found, _ = beam_search(graph, points, entry, points[batch], rule.build_beam, rule.width)
        graph[batch] = robust_prune(points, batch, found, rule.degree, rule.alpha)
        return_edges(graph, points, batch, rule)
        done += size
    return graph, entry


# Spark


def distinct_points(rows: DataFrame, keep: int, salts: int = 16) -> DataFrame:
    """(vector, ids): the ``keep`` smallest ids of every distinct vector, ascending, null last."""
    by_id = F.col("vec_id").asc_nulls_last()
    some = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)))
    for key in (["vector", "salt"], ["vector"]):
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(by_id))
        some = some.withColumn("place", rank).where(F.col("place") <= keep).drop("place")
    ids = F.array_sort(F.collect_list(F.struct(F.col("vec_id").isNull().alias("last"), "vec_id")))
    return some.groupBy("vector").agg(F.transform(ids, lambda x: x["vec_id"]).alias("ids"))


def graph_table(points: DataFrame, shards: int, width: int, rule: Rule) -> DataFrame:
    """Rows of (shard, vector, ids) with the node's number, edges and whether it is the entry."""

    def run(group: pa.Table) -> pa.Table:
        vectors = matrix(group["vector"].combine_chunks(), width)
        graph, entry = build(vectors, rule)
        edges = [row[row >= 0] for row in graph]
        return group.append_column("node", pa.array(np.arange(len(vectors)), pa.int32())).append_column(
            "edges", pa.array(edges, pa.list_(pa.int32()))
        ).append_column("is_entry", pa.array(np.arange(len(vectors)) == entry))

    schema = "shard int, vector array<double>, ids array<bigint>, node int, edges array<int>, is_entry boolean"
    dealt = points.select("shard", "vector", "ids").repartition(min(shards, rule.tasks), "shard")
    return dealt.groupBy("shard").applyInArrow(run, schema)


def search_shards(graph: DataFrame, queries: DataFrame, shards: int, blocks: int, width: int, rule: Rule) -> DataFrame:
    """The best ``k`` of every shard for every query: query_id, query (its vector), vec_id, score."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()),
                          "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        left = left.sort_by("node")
        vectors = matrix(left["vector"].combine_chunks(), width)
        members = left["ids"].to_pylist()
        entry = int(np.flatnonzero(left["is_entry"].to_numpy())[0])
        lists = left["edges"].to_pylist()
        edges = np.full((len(lists), rule.degree), -1, np.int64)
        for row, targets in zip(edges, lists):
            row[: len(targets)] = targets
        points = of_equal_length(vectors)
        asked = matrix(right["vector"].combine_chunks(), width)
        columns = ([], [], [], [])
        for start in range(0, len(asked), rule.most):
            some = asked[start : start + rule.most]
            long = some / np.sqrt((some * some).sum(axis=1))[:, None]
            flat = np.concatenate([long, np.zeros((len(some), 1))], axis=1).astype(np.float32)
            found, _ = beam_search(edges, points, entry, flat, rule.beam, rule.width)
            for at, row in enumerate(found, start):
                near = row[row >= 0]
                # Added from the left, so that a score is that of the plain sum whatever the batch.
                scores = np.cumsum(vectors[near] * asked[at], axis=1)[:, -1]
                query, query_id = right["query"][at].as_py(), right["query_id"][at].as_py()
                hits = [(-s, i is None, i or 0, i) for node, s in zip(near, scores) for i in members[node] if i != query_id]
                for score, _, _, i in sorted(hits, key=lambda h: h[:3])[: rule.k]:
                    for column, value in zip(columns, (query, query_id, i, -score)):
                        column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(empty.column_names, columns, types)})

    # Each shard meets each block of queries: the graph is repeated once a block, the queries once a shard.
    tasks = min(shards * blocks, rule.tasks)
    here = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "shard", "block")
    there = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(tasks, "shard", "block")
    return here.groupBy("shard", "block").cogroup(there.groupBy("shard", "block")).applyInArrow(
        run, "query long, query_id long, vec_id long, score double"
    )


def usable(embeddings: DataFrame) -> tuple[DataFrame, int | None]:
    """Distinct (vec_id, vector) rows that take part, and their width."""
    rows = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("vector")
    ).where(finite(F.col("vector"))).where(F.exists("vector", lambda x: x != 0))
    width = usual_width(rows.select(F.size("vector").alias("size")), "size")
    return rows.where(F.size("vector") == (width or 0)).distinct(), width


def nearest(embeddings: DataFrame, every: int = 20, rule: Rule = Rule()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row whose vec_id ``every`` divides."""
    spark = embeddings.sparkSession
    rows, width = usable(embeddings)
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = materialize(rows, "vectors")
    points = materialize(distinct_points(rows, rule.k + 1), "points")
    shards = max(1, -(-points.count() // rule.shard))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    graph = materialize(graph_table(dealt, shards, width, rule), "graph")
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // rule.block))
    # The hash names a query of its own where one vec_id has several vectors.
    query = F.xxhash64("vec_id", "vector")
    asked = asked.select(
        query.alias("query"), F.col("vec_id").alias("query_id"), "vector", F.pmod(query, F.lit(blocks)).cast("int").alias("block")
    )
    found = search_shards(graph, asked, shards, blocks, width, rule)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
