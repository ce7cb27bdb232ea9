"""Near-duplicates, repeated strings and shared chunks against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

from casebook.llm import chunks, minhash, suffixes


def word_set(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, percent):
    sets = [word_set(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def key(rows):
    return sorted(rows, key=str)


def test_near_duplicates_match_all_pairs(documents, corpus):
    for k, percent in ((3, 85), (5, 80)):
        got = minhash.near_duplicates(documents(corpus), minhash.Rule(k, percent)).collect()
        assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(brute_components(corpus, k, percent))
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_near_copies_is_one_component(documents, make_sentence):
    """Most pairs of the group are below the threshold; each copy is linked through the middle ones only."""
    rng = random.Random(5)
    base = make_sentence(rng, 150).split()
    rows = []
    for i in range(200):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(documents(rows), minhash.Rule(3, 85)).collect()
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(brute_components(rows, 3, 85))


def test_estimate_is_close_to_similarity(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    hashes = minhash.WordHashes()
    one = minhash.shingle_set(" ".join(words), 1, hashes)
    for share in (0.5, 0.8, 0.95):
        other = words[: int(4000 * share)] + [f"x{rng.random()}" for _ in range(4000 - int(4000 * share))]
        two = minhash.shingle_set(" ".join(other), 1, hashes)
        signs = [minhash.packed(minhash.minima(x)).tolist() for x in (one, two)]
        df = spark.createDataFrame([tuple(signs)], "a array<long>, b array<long>")
        got = df.select(minhash.estimate(df.a, df.b)).first()[0]
        true = int(4000 * share) / (8000 - int(4000 * share))
        assert abs(got - true) < 0.2


def test_keep_one_keeps_columns_and_one_row_of_each_group(documents, corpus):
    docs = documents(corpus)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    expected = {c for d, n, c in brute_components(corpus, 5, 80) if n and c is not None}
    with_words = [r for r in rows if (r.text or "").split() and r.doc_id is not None]
    assert sorted(r.doc_id for r in with_words) == sorted(expected)
    assert {65, 66, 67} <= {r.doc_id for r in rows}


def test_empty_table(documents):
    nothing = documents([])
    assert minhash.near_duplicates(nothing).collect() == []
    assert minhash.keep_one(nothing).collect() == []
    assert suffixes.remove_repeats(nothing).collect() == []
    assert chunks.duplicate_passages(nothing).collect() == []
    assert chunks.deduplicate(nothing).collect() == []


def brute_repeats(rows, length=400):
    seen = Counter()
    for _, text, *_ in rows:
        data = (text or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    found = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        hit = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        spans = sum(1 for i, h in enumerate(hit) if h and not (i and hit[i - 1]))
        kept = bytes(c for c, h in zip(data, hit, strict=True) if not h)
        found.append((doc_id, len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return found


def test_repeated_strings_match_all_windows(documents, corpus):
    rng = random.Random(9)
    letters = "ab"
    extra = [(100 + i, "".join(rng.choice(letters) for _ in range(700))) for i in range(3)]
    block = "".join(rng.choice("abcdefgh ") for _ in range(900))
    for i in range(12):  # cut the block at many places, so that borders fall everywhere
        a, b = rng.randint(0, 400), rng.randint(500, 900)
        extra.append((110 + i, f"{rng.random()}" * rng.randint(0, 3) + block[a:b] + f"{rng.random()}" + block[b - 450 : b]))
    extra += [(130, block[:399]), (131, block[:400]), (132, "ab" * 400 + "x" + "ab" * 300)]
    rows = [*corpus, *extra]
    got = suffixes.remove_repeats(documents(rows)).drop("spans").collect()
    assert key(tuple(r) for r in got) == key(brute_repeats(rows))


def test_pieces_of_a_long_text_do_not_change_the_result(documents, make_sentence, monkeypatch):
    rng = random.Random(2)
    text = make_sentence(rng, 3000)
    rows = [(1, text), (2, "start " + text[5000:9000] + " end"), (3, text[9500:9950])]
    whole = brute_repeats(rows)
    for piece in (700, 5000):
        monkeypatch.setattr(suffixes, "PIECE", piece)
        hasher = suffixes.Hasher()
        data = suffixes.text_bytes(text)
        starts = sorted((int(a), int(b)) for block in suffixes.blocks(data, hasher, 192) for a, b in zip(block[3], block[4], strict=True))
        assert starts[0][0] == 0 and starts[-1][1] == len(data) - 400
        assert all(b + 1 == c for (_, b), (c, _) in zip(starts, starts[1:], strict=False))
    monkeypatch.undo()
    assert key(tuple(r) for r in suffixes.remove_repeats(documents(rows)).drop("spans").collect()) == key(whole)


def test_family_merges_equal_ranks_and_finds_matches_across_batches(documents, make_sentence):
    rng = random.Random(4)
    texts = [make_sentence(rng, 200) for _ in range(7)]
    family = suffixes.SuffixFamily(documents([]).sparkSession)
    ranks, found = [], []
    for i, text in enumerate([*texts, texts[2]]):
        found.append(family.add(documents([(i, text)])).count())
        ranks.append(sorted(family.levels))
    assert ranks == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2], [3]]
    assert found[:7] == [0] * 7 and found[7] > 3
    assert family.repeated().count() == found[7]
    assert family.levels[3].agg({"n": "sum"}).first()[0] == suffixes.cores(documents([(i, t) for i, t in enumerate([*texts, texts[2]])]), 192).count()


def plain_cuts(data, rule):
    """The same cuts by a plain loop over windows."""
    hashes = []
    for i in range(len(data) - chunks.REACH + 1):
        h = 0
        for byte in data[i : i + chunks.REACH]:
            h = ((h << 1) + int(chunks.GEAR[byte])) & 0xFFFFFFFF
        hashes.append(h)
    return sorted({min(range(i, i + rule.window), key=lambda j: (hashes[j], j)) for i in range(len(hashes) - rule.window + 1)})


def test_cuts_match_the_rolling_loop_and_every_string_holds_a_chunk(make_sentence, monkeypatch):
    import numpy as np

    rng = random.Random(8)
    texts = [b"", b"a" * 99, b"a" * 1000, make_sentence(rng, 300).encode(), bytes(rng.randrange(256) for _ in range(2000)), b"ab" * 300]
    for piece in (1 << 20, 333):
        monkeypatch.setattr(chunks, "PIECE", piece)
        for rule in (chunks.Rule(), chunks.Rule(run=64), chunks.Rule(run=151)):
            for data in texts:
                assert chunks.cut_places(np.frombuffer(data, np.uint8), rule)[0].tolist() == plain_cuts(data, rule)
                low, high, turn = chunks.chunk_bounds(data, rule)
                whole = set(zip(low.tolist(), high.tolist(), strict=True))
                for i in range(len(data) - rule.run + 1):
                    # The chunks of a string alone are those that belong to it wherever it stands.
                    a, b, _ = chunks.chunk_bounds(data[i : i + rule.run], rule)
                    mine = (turn >= i) & (turn <= i + rule.turns - 2)
                    assert len(a) and set(zip((a + i).tolist(), (b + i).tolist(), strict=True)) <= whole
                    assert low[mine].tolist() == (a + i).tolist()


def test_texts_read_together_have_the_chunks_of_each_alone(make_sentence, monkeypatch):
    import numpy as np

    rng = random.Random(9)
    raws = [make_sentence(rng, rng.randint(1, 80)).encode() for _ in range(60)]
    raws += [b"a", b"ab" * 300, b"x" * 99, b"x" * 100, b"x" * 101, "é".encode() * 200, raws[0] + raws[1]]
    raws += [make_sentence(rng, 3000).encode(), b"z" * 64, raws[3] + b" " + raws[5]]
    monkeypatch.setattr(chunks, "JOINT", 4000)
    groups = list(chunks.joint([len(r) for r in raws]))
    assert [i for a, b in groups for i in range(a, b)] == list(range(len(raws))) and 1 < len(groups) < len(raws) // 2
    assert chunks.Texts([b"a", b"bc"]).bounds(chunks.Rule())[0].tolist() == []
    for rule in (chunks.Rule(), chunks.Rule(run=64), chunks.Rule(run=151)):
        seen = {}
        for a, b in groups:
            texts = chunks.Texts(raws[a:b])
            bounds = texts.bounds(rule)
            alone = [[x + start for x in chunks.chunk_bounds(raw, rule)] for raw, start in zip(raws[a:b], texts.starts, strict=True)]
            for got, want in zip(bounds, zip(*alone, strict=True), strict=True):
                assert got.tolist() == np.concatenate(want).tolist()
            # A digest depends on a chunk's bytes alone, and differs from those of other bytes.
            for x, y, digest in zip(bounds[0], bounds[1], chunks.digests_of(texts.raw, bounds[0], bounds[1]).tolist(), strict=True):
                assert seen.setdefault(texts.raw[x:y], digest) == digest
        assert len(set(seen.values())) == len(seen)


def test_texts_are_numbered_in_the_order_of_id_and_text(documents):
    rows = [(i % 700 - 300, f"text {i}") for i in range(2000)] + [(None, "a"), (None, "b"), (5, "text 305"), (1 << 62, "c"), (7, ""), (8, None)]
    names = chunks.text_names(documents(rows).repartition(9))
    got = sorted((r.number, r.doc, r.mark) for r in chunks.text_numbers(names).collect())
    assert [n for n, _, _ in got] == list(range(2003))
    assert [r[1:] for r in got] == sorted({(r.doc, r.mark) for r in names.collect()})


def brute_passages(rows, length=100):
    """(doc_id, low, high) of what strings of ``length`` bytes that stand elsewhere cover together where they overlap."""
    texts = {(doc_id, text) for doc_id, text, *_ in rows if text}
    seen = Counter()
    for _, text in texts:
        data = text.encode()
        seen.update(data[i : i + length] for i in range(max(1, len(data) - length + 1)))
    found = []
    for doc_id, text in texts:
        data, end = text.encode(), -1
        for i in range(max(1, len(data) - length + 1)):
            if seen[data[i : i + length]] > 1:
                if i >= end:
                    found.append([doc_id, text, i, 0])
                found[-1][3] = end = min(i + length, len(data))
    inside = lambda data, i: i < len(data) and data[i] & 0xC0 == 0x80
    for f in found:
        data = f[1].encode()
        while inside(data, f[2]):
            f[2] += 1
        while inside(data, f[3]):
            f[3] -= 1
    return sorted([(d, low, high) for d, _, low, high in found], key=str)


def found_passages(df):
    return sorted([(r.doc_id, r.low, r.high) for r in df.collect()], key=str)


def test_passages_match_all_strings_of_100_bytes(documents, corpus, make_sentence):
    assert found_passages(chunks.duplicate_passages(documents(corpus))) == brute_passages(corpus)
    # Copies pieced together from others, whose chunks are shared here and there but not together.
    rng = random.Random(31)
    whole = [make_sentence(rng, 60) for _ in range(12)]
    rows = list(enumerate(whole))
    for i in range(100, 220):
        parts = []
        for _ in range(4):
            text = rng.choice(whole)
            at = rng.randrange(len(text))
            parts.append(text[at : at + rng.randint(30, 220)])
        rows.append((i, rng.choice(["", " "]).join(parts)))
    rows += [(300, "ab" * 400), (301, "ab" * 80 + "c" + "ab" * 90), (302, "x" * 700 + "y" + "x" * 300), (303, "é" * 150), (304, "aé" * 90)]
    assert found_passages(chunks.duplicate_passages(documents(rows))) == brute_passages(rows)


def test_passages_that_open_with_a_stock_phrase(documents, make_sentence):
    rng = random.Random(32)
    rows = []
    for size in (100, 105, 115, 130, 160):
        for i in range(60):
            opening = make_sentence(rng, 40)[:80]
            passage = opening + make_sentence(rng, 60)[: size - 80]
            at = len(rows)
            rows += [(at + k, f"{make_sentence(rng, 20)} {x} {make_sentence(rng, 20)}") for k, x in enumerate([opening, passage, passage, opening])]
    assert found_passages(chunks.duplicate_passages(documents(rows))) == brute_passages(rows)
    assert len(brute_passages(rows)) >= 2 * 290


def test_deduplicate_keeps_the_first_document_and_all_other_bytes(documents, corpus):
    docs = documents(corpus)
    out = chunks.deduplicate(docs)
    assert out.columns == docs.columns
    texts = defaultdict(list)
    for r in out.collect():
        texts[r.doc_id].append(r.text)
    before = {d: t for d, t, *_ in corpus if d is not None}
    assert texts[5] == [before[5]] and texts[60] == [""] and texts[61] == ["", ""]
    assert texts[66] == [None] and texts[65] == [""] and texts[7] == [before[7]]
    assert len(texts[53][0]) < len(before[53]) - 200 and before[53].startswith(texts[53][0][:50])


def test_all_passages_of_51_words_are_found_with_their_bounds(documents, make_sentence):
    rng = random.Random(21)
    passages = [make_sentence(rng, 51, ["a", "of", "in", "bei", "über", "passage", "chunk"]) for _ in range(300)]
    around = lambda n=40: make_sentence(rng, n)
    rows = [(i, f"{around()} |{p}| {around()}") for i, p in enumerate(passages)]
    rows += [(1000 + i, f"{around(3)} <{p}> {around(50)}") for i, p in enumerate(passages)]
    assert min(len(p) for p in passages) < 250
    got = defaultdict(list)
    for r in chunks.duplicate_passages(documents(rows)).collect():
        got[r.doc_id].append((r.low, r.high, r.first_doc_id, r.other_doc_id))
    for doc_id, text in rows:
        p = passages[doc_id % 1000].encode()
        low = text.encode().index(p)
        assert got[doc_id] == [(low, low + len(p), doc_id % 1000, (doc_id + 1000) % 2000)]


def test_short_copies_repeats_inside_and_every_stretch_of_100_bytes(documents, make_sentence):
    rng = random.Random(22)
    short, line = make_sentence(rng, 8), make_sentence(rng, 40)[:100]
    rows = [(1, "two words"), (2, "two words"), (3, short), (4, short), (5, f"{make_sentence(rng, 30)} | {short}"), (2, "two words")]
    rows += [(6, f"{line} ! {make_sentence(rng, 60)} # {line}"), (7, "a" * 3000), (8, "a" * 2000), (9, ""), (None, None)]
    for i in range(200):
        stretch = "".join(rng.choice("abcdefgh") for _ in range(100))
        rows += [(100 + i, f"{make_sentence(rng, 9)}({stretch}){make_sentence(rng, 9)}"), (400 + i, f"[{stretch}]")]
    got = {}
    for r in chunks.duplicate_passages(documents(rows)).collect():
        got.setdefault(r.doc_id, []).append((r.low, r.high, r.first_doc_id, r.other_doc_id))
    assert got[1] == [(0, 9, 1, 2)] and got[2] == [(0, 9, 1, 1)] and got[3] == [(0, len(short.encode()), 3, 4)] and 5 not in got
    assert sorted(x[2:] for x in got[6]) == [(6, 6)] * 2 and got[7] == [(0, 3000, 7, 8)] and got[8] == [(0, 2000, 7, 7)]
    for doc_id, text in rows:
        if doc_id is not None and doc_id >= 100:
            low = text.encode().index(b"(" if doc_id < 400 else b"[") + 1
            assert [x[:2] for x in got[doc_id]] == [(low, low + 100)]


def test_few_labels_are_broadcast_with_the_same_groups(spark, monkeypatch):
    """Each shuffle of a few thousand labels costs a stage of all partitions in every turn."""
    names = [bytes([i]) for i in range(40)]
    labels = minhash.sized(spark.createDataFrame([(n, names[i // 3 * 3]) for i, n in enumerate(names)], "node binary, group binary"))
    links = spark.createDataFrame([(names[i], names[(7 * i) % 40]) for i in range(1, 25)], "a binary, b binary")
    plan = minhash.group_links(labels, links, True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") == 2
    read = lambda: sorted((bytes(r.node), bytes(r.group), r.size) for r in minhash.hook(labels, links, 0).collect())
    few = read()
    monkeypatch.setattr(minhash, "FEW", -1)
    assert read() == few


def test_pairs_near_below_the_threshold_are_not_listed(documents, spark, make_sentence, monkeypatch):
    """Near copies, similar by about 0.8 and hardly linked, share buckets: their pairs grow with the square of the group."""
    rng = random.Random(41)
    base = make_sentence(rng, 220).split()
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(len(words)), 8 if i % 30 else 3):
            words[at] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    listed, stored = [], minhash.materialize

    def noted(df, tag):
        found = stored(df, tag)
        if tag == "across":
            listed.append(found.count())
        return found

    monkeypatch.setattr(minhash, "materialize", noted)
    sets = [word_set(t, 3) for _, t in rows]
    linked = sum(100 * len(a & b) >= 85 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    for compared in (minhash.COMPARED, 0):  # with and without the step by support
        monkeypatch.setattr(minhash, "COMPARED", compared)
        got = minhash.near_duplicates(documents(rows), minhash.Rule(3, 85)).collect()
        assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(brute_components(rows, 3, 85))
    assert len(listed) == 2 and max(listed) <= linked + 200


def test_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    import numpy as np

    rng = np.random.default_rng(6)
    for size in (1, 50, 600, 9000):
        one = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for change in (0, 1, size // 9, size):
            two = np.concatenate([one[change:], rng.integers(0, 1 << 63, change, dtype=np.uint64)])
            bits = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in minhash.parities(one) ^ minhash.parities(two))
            assert bits <= len(np.setxor1d(one, two)) and (bits > 0) == (change > 0)
