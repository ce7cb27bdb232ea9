"""Archives, licences, mixing, decontamination, personal data, quality rules and sharding."""

import base64
import gzip
import hashlib
import io
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import decontaminate, licenses, mixing, pii, quality, sharding, warc
from casebook.session import fresh_path


def key(rows):
    return sorted(rows, key=str)


# Archives

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2\r\nX: y", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""),
    (5, "http://a/5", "WARC/1.1\r\n\r\n\r\n\r\né日\U0001f600"), (6, "u", "x" * 300_000), (6, "u", "x" * 300_000), (None, "n", "<p>one</p>"),
    (7, "u", "alone"), (None, None, "nobody"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("extra"))


def expected_records(least):
    holders = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            holders[html or ""] = max(page_id, holders.get(html or "", page_id))
    rows = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        holder = holders.get(html or "") if len(data) >= least else page_id
        first = page_id == holder
        rows.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if first else "revisit", None if first else holder))
    return rows


@pytest.mark.parametrize("least", [0, 11])
def test_archives_round_trip(pages, least):
    got = warc.archive_pages(pages, least).collect()
    assert key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == key(expected_records(least))
    payloads = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert payloads[5] == PAGES[4][2] and payloads[4] == ""


def test_members_stand_where_the_index_says(spark, pages):
    raw, folder = fresh_path(spark, "raw"), fresh_path(spark, "out")
    warc.write_archives(pages, raw)
    index = warc.normalise(spark, raw, folder).collect()
    assert len(index) == len(PAGES)
    for archive in {r.archive for r in index}:
        store, path = warc.open_store(archive)
        data = store.open_input_stream(path, compression=None).read()
        rows = sorted((r.offset, r.length) for r in index if r.archive == archive)
        assert rows[0][0] == 0 and sum(n for _, n in rows) == len(data)
        whole = list(warc.raw_records(gzip.GzipFile(fileobj=io.BytesIO(data))))
        single = [gzip.decompress(data[a : a + n]) for a, n in rows]
        assert [x for _, x in whole] == single and all(x.startswith(b"WARC/1.1\r\n") for x in single)
    # The archives before are one stream each.
    files = spark.read.format("binaryFile").load(raw + "/*.gz").collect()
    for f in files:
        import zlib

        stream = zlib.decompressobj(31)
        stream.decompress(bytes(f.content))
        assert stream.eof and not stream.unused_data


def test_broken_archives_are_errors():
    with pytest.raises(ValueError):
        list(warc.raw_records(io.BytesIO(b"HTTP/1.1 200\r\n\r\n")))
    with pytest.raises(ValueError):
        list(warc.raw_records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort")))


def test_no_pages(spark, pages):
    assert warc.archive_pages(pages.limit(0)).collect() == []


# Licences


def test_licences_are_found_and_inherited(spark, make_sentence):
    rng = random.Random(1)
    plain = lambda n=60: make_sentence(rng, n)
    notice = "Licensed under the Apache License, Version 2.0."
    mit = " ".join(licenses.TEMPLATES["MIT"][2:])
    rows = [
        (1, "a/b/one.py", plain() + "\n# " + notice + "\n" + plain()), (2, "a/LICENSE", mit), (3, "a/b/c/two.py", plain()),
        (4, "a/three.py", plain() + "\n" + plain()), (5, "z/four.py", plain()), (6, None, plain()), (7, "a/n.py", None), (8, "", ""),
        (9, "a/b/c/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (3, "a/b/c/two.py", plain()),
        (10, "a/x.py", "the license of a driver and the version of the work"), (11, "a/b/c", plain()),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("bucket", F.lit(1))
    got = defaultdict(list)
    for r in licenses.licences(df).collect():
        got[r.doc_id].append((r.licence, r.origin, r.directory))
    assert got[1] == [("Apache-2.0", "own", None)] and got[2] == [("MIT", "own", None)] and got[9] == [("GPL-3.0", "own", None)]
    assert got[3] == [("GPL-3.0", "inherited", "a/b/c")] * 2
    assert got[4] == got[7] == got[10] == got[11] == [("MIT", "inherited", "a")]
    assert got[5] == got[6] == got[8] == [(None, "none", None)]
    assert licenses.licences(df.limit(0)).collect() == []


def test_skipping_light_texts_loses_nothing(spark, make_sentence):
    """Scores of all lines, without the skip."""
    rng = random.Random(2)
    terms = sorted({t for xs in licenses.TEMPLATES.values() for x in xs for t in licenses.TERM.findall(x.lower())})
    rows = [(i, f"d/{i}", "\n".join(" ".join(rng.sample(terms, rng.randint(1, 14))) for _ in range(8)) + "\n" + make_sentence(rng, 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    rule = licenses.Rule(notice=0.3, file=0.25)
    lines = Counter()
    for _, _, text in rows:
        for line in text.split("\n"):
            lines["*"] += 1
            lines.update(set(licenses.TERM.findall(line)))
    idf = lambda t: math.log((1 + lines["*"]) / (1 + lines[t])) + 1
    vector = lambda text: {t: (1 + math.log(n)) * idf(t) for t, n in Counter(licenses.TERM.findall(text.lower())).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    forms = [vector(x) for xs in licenses.TEMPLATES.values() for x in xs]

    def best(text):
        v = vector(text)
        return max(sum(w * f.get(t, 0) for t, w in v.items()) / (norm(v) * norm(f)) for f in forms)

    got = {r.doc_id: r for r in licenses.scan(df, rule).collect()}
    for doc_id, _, text in rows:
        line, whole = max(map(best, text.split("\n"))), best(text)
        assert (got[doc_id].score or 0) == pytest.approx(line if line >= rule.notice else 0, abs=1e-5)
        assert (got[doc_id].whole_score or 0) == pytest.approx(whole if whole >= rule.file else 0, abs=1e-5)


def test_wrapped_and_embedded_notices_are_found(spark, make_sentence):
    rng = random.Random(3)
    plain = lambda n=60: make_sentence(rng, n)
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {}General Public License as published by\n"
           "# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.")
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    notices = [
        ("GPL-3.0", gpl.format("", 3)), ("GPL-2.0", gpl.format("", 2)), ("LGPL-3.0", gpl.format("Lesser ", 3)), ("AGPL-3.0", gpl.format("Affero ", 3)),
        ("BSD-3-Clause", bsd), ("MIT", "Copyright 2020 Foo Example Inc. Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
        ("MIT", "Copyright (c) 2021 Jane Doe. Released under the MIT License. See LICENSE.txt for details."),
        ("Apache-2.0", plain(30) + " Licensed under the Apache License, Version 2.0"), ("ISC", "Licensed under the\nISC License"),
        ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed"),
        (None, "the license of a driver and the version of the work"), (None, "free software is used in binary forms and in source"),
    ]
    rows = [(i, f"d{i}/x", f"{plain()}\n{text}\n{plain()}") for i, (_, text) in enumerate(notices)]
    rows += [(100 + i, f"p{i}/x", "\n".join(plain(12) for _ in range(10))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.origin) for r in licenses.licences(df).collect()}
    assert [got[i] for i in range(len(notices))] == [(name, "own" if name else "none") for name, _ in notices]
    assert all(got[100 + i] == (None, "none") for i in range(40))


# Mixing


def test_exponent_meets_entropy_and_repetition(spark):
    sizes = {"a": 900_000, "b": 60_000, "c": 30_000, "d": 10_000}
    totals = spark.createDataFrame(list(sizes.items()), "source string, total long")
    whole = sum(sizes.values())

    def at(a):
        w = {k: (v / whole) ** a for k, v in sizes.items()}
        z = sum(w.values())
        w = {k: v / z for k, v in w.items()}
        return -sum(x * math.log(x) for x in w.values()) / math.log(4), max(w[k] * whole / sizes[k] for k in sizes)

    a = mixing.bisect_exponent(totals, mixing.Target(entropy=0.8, repetition=1e9))
    assert at(a)[0] == pytest.approx(0.8, abs=1e-6)
    a = mixing.bisect_exponent(totals, mixing.Target(entropy=0.99, repetition=5))
    assert at(a)[1] == pytest.approx(5, rel=1e-6)
    assert mixing.bisect_exponent(totals, mixing.Target(entropy=0.1)) == 1.0
    assert mixing.bisect_exponent(totals.where("source = 'a'"), mixing.Target()) == 1.0
    assert mixing.bisect_exponent(totals.limit(0), mixing.Target()) == 1.0


def test_quotas_are_filled_by_whole_passes_in_even_blocks(documents, make_sentence):
    rng = random.Random(6)
    rows = [(i, make_sentence(rng, rng.randint(5, 40)), "en", "big" if i < 200 else "mid" if i < 240 else None) for i in range(250)]
    rows += [(300, None, "en", "big"), (301, " ", "en", "big"), (302, "only blanks", "en", "void"), (5, rows[5][1], "en", "big")]
    target = mixing.Target(entropy=0.9, repetition=3, block=500)
    docs = documents(rows)
    got = mixing.mix(docs, target).collect()
    n = Counter()
    for _, text, _, source in rows:
        n[source] += len((text or "").split())
    totals = docs.sparkSession.createDataFrame([(s, c) for s, c in n.items() if c], "source string, total long")
    quotas = {r.source: (r.quota, r.total) for r in mixing.weights(totals, target).collect()}
    assert sum(q for q, _ in quotas.values()) == pytest.approx(sum(n.values()))
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for source, (quota, total) in quotas.items():
        drawn = by_source[source]
        tokens = sum(r.n_tokens for r in drawn)
        assert quota <= tokens < quota + 90
        times = Counter((r.doc_id, r.mark) for r in drawn)
        full = math.floor(quota / total)
        assert set(times.values()) <= {full, full + 1} and max(times.values()) <= 3
        assert len({(r.doc_id, r.mark, r["pass"]) for r in drawn}) == len(drawn)
        blocks = Counter()
        for r in drawn:
            blocks[r.block] += r.n_tokens
        share = quota / math.ceil(sum(n.values()) / 500)
        assert all(abs(x - share) < 90 for x in blocks.values())
    assert not {300, 301} & {r.doc_id for r in got}
    again = mixing.mix(docs, target).collect()
    assert key(map(tuple, got)) == key(map(tuple, again))
    rows_out = mixing.mix_rows(docs, target)
    assert rows_out.columns == docs.columns
    # The entry of the repeated row stands for two rows.
    copies = {(r.doc_id, r.source): 0 for r in got}
    for r in got:
        copies[r.doc_id, r.source] += 2 if r.doc_id == 5 else 1
    assert Counter((r.doc_id, r.source) for r in rows_out.collect()) == Counter(copies)


def test_nothing_to_mix(documents):
    assert mixing.mix(documents([])).collect() == []
    assert mixing.mix_rows(documents([(1, None), (2, "")])).collect() == []


# Decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower().decode())


def brute_hits(rows, items, length=10):
    cut = set()
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - length + 1) if words else 0):
            cut.add((tuple(words[i : i + length]), item))
    found = []
    for doc_id, text, *_ in rows:
        words, hit, met = words_of(text), set(), set()
        for window, item in cut:
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    met.add(item)
        ids = sorted(str(m) for m in met if m is not None)
        found.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return found


def test_windows_are_found_exactly(documents, spark, corpus, make_sentence):
    rng = random.Random(7)
    few = ["the", "of", "and", "é"]
    passage = make_sentence(rng, 25)
    items = [(1, passage), (2, passage.upper()), (30, "The, of!"), (4, "of of of of of of of of of of of of"), (5, None), (6, "..."),
             (None, make_sentence(rng, 12)), (7, "never said before"), (100, make_sentence(rng, 10)), (1, passage)]
    rows = [*corpus, (200, "x " + passage + " y"), (201, " ".join(passage.split()[3:14])), (202, " ".join(passage.split()[:9])),
            (203, items[6][1]), (204, "the of the of " * 30), (205, "of " * 40), (206, passage.replace(" ", " - ") + passage), (200, "other text")]
    rows += [(300 + i, " ".join(rng.choice(few) for _ in range(60))) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("window", F.lit("x"))
    docs = documents(rows)
    assert key(map(tuple, decontaminate.contamination(docs, bench).collect())) == key(brute_hits(rows, items))
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    clean = Counter((d[0], d[1]) for d, b in zip(rows, brute_hits(rows, items), strict=True) if not b[5])
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == clean
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.contamination(docs.limit(0), bench).collect() == []


def test_proximity_takes_any_order_within_reach(documents, spark):
    rows = [(1, "a x b y c"), (2, "c b z a"), (3, "a b q q q q q q q q c"), (4, "a b"), (5, "q q c a b q q")]
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = documents(rows)
    cut = decontaminate.windows(bench)
    terms = cut.select(F.explode("words").alias("term")).distinct()
    index = decontaminate.positional_index(docs, terms)
    assert Counter(r.term for r in index.collect()) == {"a": 5, "b": 5, "c": 4}
    anchors = decontaminate.rarest_terms(cut, decontaminate.term_counts(docs, terms))
    got = decontaminate.proximity_matches(index, cut, anchors, slack=2).collect()
    assert {r.doc_id for r in got} == {1, 2, 5}
    assert {r.doc_id for r in decontaminate.proximity_matches(index, cut, anchors, slack=0).collect()} == {5}


# Personal data


def luhn(digits):
    x = [int(c) for c in digits][::-1]
    return sum(x[0::2] + [(2 * v) // 10 + (2 * v) % 10 for v in x[1::2]]) % 10 == 0


def brute_spans(text):
    text, digits = text or "", lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(12)
    fixed = ["a@b.c", "@@a.b@c-d.e.f@g.h", "x@y", "a@b..c", "..@a.b.", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.1.1.1", "1.2.3", "1.2.3.4@5.6",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (800) 555-0100.", "+12", "+1 2", "é 日本 \U0001f600 +49 30 123456 x", "+1++2 3333 4444", "1" * 5000]
    for text in fixed:
        assert pii.base_spans(text) == brute_spans(text)
    for alphabet in ("0123456789.", "ab.@-", "+0123456789 ()-.", "0 -4", "a1@.+ "):
        for _ in range(400):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
            assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("a" * 200_000 + "." + "1" * 200_000 + "@") == []


def test_spans_of_all_rows_and_discovery(documents, corpus, make_sentence):
    rng = random.Random(13)
    talk = lambda: make_sentence(rng, 12)
    rows = [*corpus]
    for i in range(30):
        rows.append((300 + i, f"{talk()} reach me at +1 (555) {100 + i}-{1000 + i} any time {talk()}"))
    for i in range(5):
        rows.append((400 + i, f"{talk()} reach me at 0{i}55/2{i}8{i}31, any time {talk()}"))
    rows += [(500, f"{talk()} chapter 12 verse 7 {talk()}"), (501, "mail a@b.org and a@b.org"), (501, "mail a@b.org and a@b.org")]
    got = pii.report(documents(rows)).collect()
    assert len(got) == len(rows)
    spans = {}
    for r in got:
        spans.setdefault(r.doc_id, []).append(r)
    for doc_id, text, *_ in rows:
        base = brute_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        match = [r for r in spans[doc_id] if r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()]
        assert match, doc_id
        r = match[0]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, *_ in base) for k in pii.KINDS]
        if 400 <= doc_id < 405 if doc_id is not None else False:
            start = text.index("0")
            assert r.spans == f"phone:{start}:{text.index(',')}"
        else:
            assert r.spans == listed
    assert pii.report(documents([])).collect() == []


# Quality rules


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def plain_estimate(x, rule):
    """Log determinant and held rows of the settled estimate with the least one, and the distances that follow, by numpy."""
    at = lambda bins, share: sorted(bins)[math.ceil(share * len(bins) - 1e-9) - 1]
    floors = np.diag(np.square(rule.floors))
    fit = lambda rows: (rows.mean(axis=0), np.cov(rows.T, bias=True) + floors)
    distance = lambda centre, cov: np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
    bins = lambda centre, cov: np.floor(np.log(distance(centre, cov) + 1e-6) / 0.01)
    volume = lambda cov: np.linalg.slogdet(cov)[1]

    def step(found):
        b = bins(*found)
        return fit(x[b <= at(b, rule.held)])

    centre = np.array([(at(np.floor(c / 0.01), 0.5) + 0.5) * 0.01 for c in x.T])
    spread = np.array([1.4826 * (at(np.floor(np.abs(c - m) / 0.01), 0.5) + 0.5) * 0.01 for c, m in zip(x.T, centre, strict=True)])
    spread = np.sqrt(spread**2 + np.square(rule.floors))
    z = (x - centre) / spread
    length = np.sqrt((z**2).sum(axis=1) + 1e-12)[:, None]
    found = [(centre, np.diag(spread**2)), fit(x), fit(centre + spread * np.tanh(z)), fit(centre + spread * z / length * 5**0.5)]
    settled = []
    for now in map(step, found):
        while volume((then := step(now))[1]) < volume(now[1]) - rule.settled:
            now = then
        settled.append(now)
    least = min(settled, key=lambda e: round(volume(e[1]), 6))
    scale = lambda e: max(1.0, math.exp((at(bins(*e), 0.5) + 0.5) * 0.01) / quality.CHI_MEDIAN)
    final = fit(x[distance(*least) <= rule.ordinary * scale(least)])
    return volume(least[1]), distance(*final) / scale(final)


def brute_verdicts(good, rule):
    """Distances by numpy, written as plain loops over one group."""
    x = np.array([[math.log(n), math.log(c / n), math.sqrt(s / c), math.sqrt(d / m), math.sqrt(r / n)] for n, c, s, d, r, m in good])
    return plain_estimate(x, rule)[1]


def test_statistics_and_distances(documents, corpus, make_sentence):
    rng = random.Random(14)
    rows = [*corpus, (80, "a b c a b c a b c " * 9), (81, "x\nx\n \n\nx y\nx"), (82, ("same line of words\n" * 30)), (83, "#*$ % & | <> " * 40)]
    for i in range(120):
        text = "\n".join(make_sentence(rng, 12) for _ in range(rng.randint(6, 20)))
        if i % 12 == 0:
            text = re.sub(" ", " ### ", text)
        rows.append((600 + i, text, "en", "one"))
    rule = quality.Rule()
    docs = documents(rows)
    got = quality.verdicts(docs, rule).collect()
    plain = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert key((r.doc_id, *plain(r)) for r in got) == key((d, *statistics(t)) for d, t, *_ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.distance <= rule.cutoff)
    one = sorted((r for r in got if r.source == "one" and not r.base_failed), key=lambda r: r.doc_id)
    expected = brute_verdicts([(*plain(r), r.n_lines) for r in one], rule)
    assert [r.distance for r in one] == pytest.approx(expected.tolist(), rel=1e-6)
    odd = {600 + i for i in range(0, 120, 12)}
    assert {r.doc_id for r in got if r.source == "one" and not r.kept} == odd
    assert any(not r.base_failed and not r.kept for r in one)
    kept = quality.keep_good(docs, rule)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert quality.keep_good(documents([])).collect() == []
    assert quality.keep_good(documents([(1, None), (2, "short")])).collect() == []


def test_the_least_determinant_of_all_subsets_is_found(spark):
    rng = np.random.default_rng(16)
    rule, groups = quality.Rule(floors=(0.01,) * 5), {}
    for g in range(6):  # 12 rows around a slanted line, and 4 apart: scattered, or together so that they hide each other
        x = rng.normal(0, 0.2, (16, 5)) + rng.normal(0, 1, (16, 1)) * rng.choice([1, -1], 5)
        x[12:] = rng.normal(0, 3, (4, 5)) if g % 2 else rng.normal(0, 0.1, (4, 5)) + 4 * rng.choice([1, -1], 5)
        groups[str(g)] = x
    good = spark.createDataFrame([(g, *map(float, row)) for g, x in groups.items() for row in x], ["g", *quality.MEASURES])
    got = {r.g: r.volume for r in quality.least_determinants(good, rule).collect()}
    for g, x in groups.items():
        assert got[g] == pytest.approx(plain_estimate(x, rule)[0], abs=1e-6)
        held = np.array(list(itertools.combinations(range(16), 12)))
        rows = x[held] - x[held].mean(axis=1, keepdims=True)
        least = np.linalg.slogdet(np.einsum("sri,srj->sij", rows, rows) / 12 + np.diag(np.square(rule.floors)))[1].min()
        assert got[g] == pytest.approx(least, abs=1e-6)


def test_equal_rows_one_row_and_no_rows_have_estimates(spark):
    rows = [("same", 1.0, 2.0, 0.0, 0.0, 0.0)] * 9 + [("one", 3.0, 1.0, 0.5, 0.0, 0.0)]
    good = spark.createDataFrame(rows, ["g", *quality.MEASURES])
    found = quality.estimates(good, quality.Rule())
    assert sorted((r.g, r.c0, r.scale) for r in found.collect()) == [("one", 3.0, 1.0), ("same", 1.0, 1.0)]
    assert quality.estimates(good.limit(0), quality.Rule()).collect() == []


def test_small_sources_are_judged_by_all_rows_of_their_language(documents, make_sentence):
    rng = random.Random(15)
    good = lambda: "\n".join(make_sentence(rng, 12) for _ in range(rng.randint(6, 20)))
    rows = [(i, good(), "en", "big") for i in range(150)]
    rows += [(200 + i, good().replace(" ", "### "), "en", "bad") for i in range(6)] + [(210 + i, good(), "en", "few") for i in range(6)]
    rows += [(220, good().replace(" ", "### "), "xx", "bad"), (221, good(), None, None)]
    got = {r.doc_id: r for r in quality.verdicts(documents(rows)).collect()}
    assert len(got) == len(rows) and not any(r.base_failed for r in got.values())
    plain = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines)
    for judged, by in (([*range(150)], [*range(150)]), ([*range(200, 206), *range(210, 216)], [d for d, _, lang, _ in rows if lang == "en"]),
                       ([220, 221], sorted(got))):
        distances = dict(zip(by, brute_verdicts([plain(got[d]) for d in by], quality.Rule()), strict=True))
        assert [got[d].distance for d in judged] == pytest.approx([distances[d] for d in judged], rel=1e-6)
    assert {d for d, r in got.items() if not r.kept} >= {*range(200, 206), 220}
    assert all(got[d].kept for d in [*range(210, 216), 221])


# Sharding


def test_table_is_filled_in_turns():
    owner = sharding.fill_table(["a", "b", "c"], 251)
    assert set(owner) == {0, 1, 2} and max(Counter(owner).values()) - min(Counter(owner).values()) <= 1
    # Plain definition: in turns, each shard takes the first free slot of its own permutation.
    free, at, expected = set(range(251)), [0, 0, 0], [None] * 251
    walks = [[(first + i * step) % 251 for i in range(251)] for first, step in (sharding.preference(s, 251) for s in "abc")]
    assert all(sorted(w) == list(range(251)) for w in walks)
    while free:
        for shard in range(3):
            if free:
                slot = next(s for s in walks[shard] if s in free)
                free.discard(slot)
                expected[slot] = shard
    assert owner == expected
    fewer = sharding.fill_table(["a", "b"], 251)
    moved = sum(o != f for o, f in zip(owner, fewer, strict=True) if o < 2)
    assert moved < 40
    for bad in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 251)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 250)


def test_rows_are_placed_and_written_once(documents, corpus):
    docs = documents(corpus)
    owner = sharding.fill_table(sharding.SHARDS)
    placed = sharding.place(docs).collect()
    assert len(placed) == len(corpus) and all(r.shard == sharding.SHARDS[owner[r.slot]] for r in placed)
    assert len({r.slot for r in placed if r.doc_id == 61}) == 1
    got = sharding.shard_documents(docs).collect()
    assert key((r.doc_id, r.slot, r.shard, r.n_bytes) for r in got) == key((r.doc_id, r.slot, r.shard, len((r.text or "").encode())) for r in placed)
    assert sharding.shard_documents(documents([])).collect() == []
