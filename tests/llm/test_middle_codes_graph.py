"""Fill-in-middle rotation, vector codes and the neighbour graph against plain Python."""

import hashlib
import math
import random
import re
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import codes, graph, middle

VECTORS = "vec_id long, embedding array<double>, label int, code string, edges string, shard string, vector string"


def key(rows):
    return sorted(rows, key=str)


# Fill-in-middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = ["".join(tokens[a:b]) for a, b in ((0, low), (low, high), (high, n))]
    spm = h[3] % 100 < 80
    output = "<S>{2}<P>{0}<M>{1}" if spm else "<P>{0}<S>{2}<M>{1}"
    return doc_id, n, "spm" if spm else "psm", len(parts[0]), len(parts[1]), output.replace("{0}", "\0").replace("{1}", "\1").replace(
        "{2}", "\2").replace("\0", parts[0]).replace("\1", parts[1]).replace("\2", parts[2]), text


def test_fill_in_middle_equals_plain_python(documents, corpus):
    rows = corpus + [(i, f"  odd < P>{'é ' * (i % 7)}<{i}\n\n日本 \U0001f600 tail \t") for i in range(1000, 1300)]
    rows += [(2000 + i, f"holds <{c}> here") for i, c in enumerate("PSMPSM")] + [(i, "a") for i in range(3000, 3040)]
    rows += [(i, "long words " * 60_000) for i in range(4000, 4006)]
    got = middle.restore(middle.fill_in_middle(documents(rows))).collect()
    want = [plain_middle(r[0], r[1]) for r in rows]
    assert key(map(tuple, got)) == key(want)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing(documents):
    assert middle.restore(middle.fill_in_middle(documents([(1, "x")]).limit(0))).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 10, 200_001])
def test_rotation_exchanges_blocks(size):
    data = random.Random(size).randbytes(size)
    for cut in {0, 1, size // 3, size - 1, size}:
        buffer = bytearray(b"head" + data + b"tail")
        middle.rotate(buffer, 4, 4 + cut, 4 + size)
        assert bytes(buffer) == b"head" + data[cut:] + data[:cut] + b"tail"


def test_tokens_are_those_of_the_pattern():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(" \t\n\x0b\x0c\rabé日\x1c\x85") for _ in range(rng.randint(0, 12)))
        ends, total = [], 0
        for token in TOKEN.findall(text):
            total += len(token.encode())
            ends.append(total)
        assert middle.token_ends(text.encode()).tolist() == ends


# Vector codes


def usable_rows(rows):
    return [r for r in rows if r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1])]


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(kept[0][2]) // parts if kept else 0
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, _, v in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def assign(part, values):
        return min((sum((x - y) ** 2 for x, y in zip(values, e)), i) for i, e in enumerate(books[part]))

    for _ in range(rounds):
        fresh = [list(b) for b in books]
        for p in range(parts):
            members = {}
            for row in cut:
                members.setdefault(assign(p, row[p])[1], []).append(row[p])
            for e, held in members.items():
                fresh[p][e] = [sum(c) // len(held) for c in zip(*held)]
        books = fresh
    found = [[assign(p, row[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in row) for row in found]
    totals = {}
    for (_, label, _), error in zip(kept, errors):
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    return [(i, "".join(f"{e:02x}" for _, e in row), min(error, most), min(most, totals[label]), digest)
            for (i, label, _), row, error in zip(kept, found, errors)]


def vector_rows(n, width, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i * 3 - 20, [c + rng.gauss(0, spread) for c in centre], rng.choice([0, 1, 1, 1, None])))
    common = rows[5][1]
    return rows + [(10_000 + i, common, 1) for i in range(n // 3)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", "s", "v") for r in rows], VECTORS)


ODD = [(-1, None, 0), (-2, [], 0), (-3, [1.0, None, 2.0, 3.0] * 2, 0), (-4, [float("nan")] * 8, 0), (-5, [float("inf")] * 8, 0), (-6, [1.0] * 12, 0),
       (-7, [1.0] * 7, 0)]


def test_codes_equal_plain_python(spark):
    rows = vector_rows(420, 8, 4)
    rows += [rows[7], rows[7], (None, rows[9][1], None), (None, [0.5] * 8, 3)]
    got = codes.compress(frame(spark, rows + ODD)).collect()
    assert key(map(tuple, got)) == key(plain_codes(rows))


def test_codes_of_few_and_huge_vectors(spark):
    for rows in ([(3, [1.0, 2.0, 3.0, 4.0], 1)], [(i, [1e300, -2.5e9 * i, 3.0 * i, 0.25], None) for i in range(12)],
                 [(i, [float(i % 3)] * 4, i) for i in range(700)]):
        got = codes.compress(frame(spark, rows)).collect()
        assert key(map(tuple, got)) == key(plain_codes(rows))
    empty = codes.compress(frame(spark, ODD[:5]))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_many_labels_are_joined_by_salt(spark):
    rows = spark.createDataFrame([(i, i % 3 or None, "c", i) for i in range(100)], "vec_id long, label long, code string, error long")
    few, many = codes.with_label_error(rows), codes.with_label_error(rows, most_labels=1)
    assert key(map(tuple, few.collect())) == key(map(tuple, many.collect())) and many.count() == 100


@pytest.mark.parametrize("spread", [0.02, 0.5, 5.0])
def test_tree_search_is_exact(spread):
    rng = np.random.default_rng(int(spread * 100))
    entries = np.floor(rng.normal(0, 200, (256, 16)) * spread)
    entries[100:110] = entries[3]
    queries = np.concatenate([np.floor(rng.normal(0, 200, (3000, 16)) * spread), entries])
    index, best = codes.nearest(codes.tree(entries, codes.Rule()), queries)
    every = codes.squares(queries, entries)
    assert (best == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()


def test_tree_leaves_children_out():
    """On clustered entries the ranges rule out most subtrees, and what is left is still exact."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 5000, (16, 8))
    entries = np.floor(centres.repeat(16, axis=0) + rng.normal(0, 30, (256, 8)))
    seen = 0
    whole = codes.squares

    def counted(a, b):
        nonlocal seen
        seen += len(a) * len(b)
        return whole(a, b)

    tree = codes.tree(entries, codes.Rule())
    queries = np.floor(centres.repeat(50, axis=0) + rng.normal(0, 30, (800, 8)))
    codes.squares = counted
    try:
        index, _ = codes.nearest(tree, queries)
    finally:
        codes.squares = whole
    assert (index == whole(queries, entries).argmin(axis=1)).all() and seen < 0.35 * len(queries) * len(entries)


# Neighbour graph


def plain_nearest(rows, k=20):
    rows = [(i, v) for i, v in {(r[0], tuple(r[1])) for r in rows} if any(v)]
    found = {}
    for q, (query_id, v) in enumerate(rows):
        if query_id is None or query_id % 20:
            continue
        scored = [(-reduce(add, (x * y for x, y in zip(v, w))), i is None, i or 0, i) for i, w in rows if i != query_id]
        found[query_id, v] = [(i, -s) for s, _, _, i in sorted(scored, key=lambda t: t[:3])[:k]]
    return found


def test_graph_of_a_small_table_is_exact(spark):
    rows = vector_rows(300, 8, 8)
    rows += [rows[7], rows[7], (None, rows[9][1], None), (40, [0.0] * 8, 1), (60, rows[5][1], 1)]
    got = graph.nearest(frame(spark, rows + ODD), rule=graph.Rule(beam=400)).collect()
    want = plain_nearest(rows)
    lists = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        lists.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(lists[r.query_id])
    assert lists == {i: found for (i, _), found in want.items()}
    assert any(score == lists[i][0][1] for i in lists for _, score in lists[i][1:])


def test_one_id_with_two_vectors_and_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [0.0, 2.0], 1), (20, [1.0, 1.0], 1), (5, [-1.0, -1.0], 1), (7, [3.0, 3.0], 1)]
    got = graph.nearest(frame(spark, rows)).collect()
    want = [(q, n, i, s) for (q, _), found in plain_nearest(rows).items() for n, (i, s) in enumerate(found, 1)]
    assert key((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == key(want)
    assert graph.nearest(frame(spark, ODD[:5])).collect() == []


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_over_shards(spark, scaled):
    """Directions without clusters, which are hard, over four shards, with equal and with very different lengths."""
    rng = np.random.default_rng(12)
    vectors = rng.normal(0, 1, (6000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if scaled:
        vectors *= rng.uniform(0.2, 3, (6000, 1))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rule = graph.Rule(shard=1500, block=100)
    got = graph.nearest(frame(spark, rows), rule=rule).groupBy("query_id").agg(F.collect_list("vec_id").alias("ids")).collect()
    assert len(got) == 300
    hits = 0
    for row in got:
        scores = vectors @ vectors[row.query_id]
        scores[row.query_id] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & set(row.ids))
    assert hits / 6000 >= 0.95


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0]], np.float32)
    edges = graph.robust_prune(points, np.array([0]), np.array([[4, 3, 2, 1, -1, 0]]), 3, 1.2)
    assert edges.tolist() == [[1, 3, 4]]
