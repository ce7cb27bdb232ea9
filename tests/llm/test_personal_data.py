"""The bootstrap of personal data against a plain version that reads all texts in every round."""

import random
import re
from collections import Counter, defaultdict

from casebook.llm import pii


def plain_units(text):
    """(start, end, kind, words): seed spans, number runs with single blanks, other words without edge marks."""
    base = pii.base_spans(text)
    covered = {i for _, a, b in base for i in range(a, b)}
    keys = [m for m in re.finditer(r"[0-9A-Za-z]+", text) if re.fullmatch(r"[0-9a-fA-F]{32,}", m[0])
            and re.search("[0-9]", m[0]) and re.search("[a-fA-F]", m[0]) and not covered & set(range(*m.span()))]
    seeds = sorted([(a, b, k) for k, a, b in base] + [(*m.span(), "secret") for m in keys])
    marks, at = [], 0
    for a, b, k in seeds:  # the corpus below has no overlapping base spans
        marks += [(m.start(), m.end(), None) for m in re.compile(r"\S+").finditer(text, at, a)] + [(a, b, k)]
        at = b
    marks += [(m.start(), m.end(), None) for m in re.compile(r"\S+").finditer(text, at)]
    out, before = [], False
    for a, b, k in marks:
        number = False
        if not k:
            number = bool(re.fullmatch(r"[0-9()+./-]*[0-9][0-9()+./-]*", text[a:b].rstrip(pii.EDGES)))
            a += len(text[a:b]) - len(text[a:b].lstrip(pii.EDGES))
            b -= len(text[a:b]) - len(text[a:b].rstrip(pii.EDGES))
            if a >= b:
                continue
        if number and before and a == out[-1][1] + 1 and text[out[-1][1]] == " ":
            out[-1] = (out[-1][0], b, None)
        else:
            out.append((a, b, k))
        before = number
    return [(a, b, k, text[a:b].lower()) for a, b, k in out]


def plain_bootstrap(texts, rule):
    """(document, kind, start, end) of all spans that are found."""
    read = [plain_units(t or "") for t in texts]

    def around(us, i):
        w = [u[3] for u in us]
        if i >= 2:
            yield ("before", w[i - 2], w[i - 1])
        if i + 2 < len(w):
            yield ("after", w[i + 1], w[i + 2])
        if 0 < i < len(w) - 1:
            yield ("both", w[i - 1], w[i + 1])

    fillers, holds, total = defaultdict(set), Counter(), Counter()
    held = defaultdict(set)
    known = set()
    for us in read:
        for i, u in enumerate(us):
            total[u[3]] += 1
            for p in around(us, i):
                fillers[p].add(u[3])
                holds[p, u[3]] += 1
                if u[2]:
                    held[p, u[2]].add(u[3])
            if u[2]:
                known.add((u[3], u[2]))
    added = {}
    while True:
        names = {e for e, _ in known} | set(added)
        odds, inside = defaultdict(lambda: 1.0), defaultdict(Counter)
        for (p, kind), who in held.items():
            precision = len(who) / (len(fillers[p]) + 1)
            if len(who) >= rule.support and precision >= rule.precision:
                for e in fillers[p] - names:
                    odds[e, kind] *= 1 - precision
                    inside[e, kind][p[0]] += holds[p, e]
        best = {}
        for (e, kind), miss in odds.items():
            if 1 - miss >= rule.score:
                best[e] = max(best.get(e, (0, "")), (round(1 - miss, 12), kind))
        new = {e: k for e, (_, k) in best.items() if max(inside[e, k].values()) >= rule.share * total[e]}
        if not new:
            break
        added |= new
        for p, who in fillers.items():
            for e in who & set(new):
                held[p, new[e]].add(e)
    spans = set()
    for d, us in enumerate(read):
        for a, b, k, w in us:
            if k == "secret" or (k is None and w in added):
                spans.add((d, k or added[w], a, b))
    return spans


def talks(make_sentence):
    rng = random.Random(29)
    talk = lambda: make_sentence(rng, 12)
    rows = []
    for i in range(30):
        rows.append(f"{talk()} write to me at user{i}@mail{i}.org before noon please {talk()}")
        rows.append(f"{talk()} please call me on +1 (555) {100 + i}-{1000 + i} any evening {talk()}")
        rows.append(f"{talk()} the token = \"{rng.getrandbits(160):040x}\" {talk()}")
    rows += [f"{talk()} write to me at johnaq@intranet before noon please {talk()}"] * 2
    rows += [f"{talk()} please call me on 555 120 4567 any evening {talk()}", f"{talk()} please call me on 05551204567, any evening."]
    rows.append(f"{talk()} the token = \"open.sesame\" {talk()}")
    # A common word in a good slot stays a word.
    rows.append("write to me at home before noon please")
    rows += [f"{talk()} home {talk()}" for _ in range(20)]
    # Handles known from the first round teach a second place, which then finds others.
    for i in range(14):
        rows.append(f"{talk()} write to me at handle_{i} before noon please")
        rows.append(f"{talk()} signed by the hand of handle_{i} and nobody else {talk()}")
    rows.append(f"{talk()} signed by the hand of latecomer and nobody else {talk()}")
    rows += ["", None, " \t\n", "one", "555 120 4567", make_sentence(rng, 9000), "x" * 5000]
    return rows


def test_bootstrap_equals_the_plain_version(documents, make_sentence):
    texts, rule = talks(make_sentence), pii.Rule()
    got = pii.find(documents([(i, t) for i, t in enumerate(texts)]), rule).collect()
    assert len(got) == len(texts)
    spans = {(r.doc_id, s.kind, s.start, s.end) for r in got for s in r.found}
    assert spans == plain_bootstrap(texts, rule)
    said = {(texts[d][a:b], kind) for d, kind, a, b in spans}
    for entity, kind in (("johnaq@intranet", "email"), ("555 120 4567", "phone"), ("05551204567", "phone"),
                         ("open.sesame", "secret"), ("handle_3", "email"), ("latecomer", "email")):
        assert (entity, kind) in said
    assert not any(entity == "home" for entity, _ in said)
    # The number alone in a text is found too: it is known by then.
    assert (texts.index("555 120 4567"), "phone", 0, 12) in spans


def test_units_of_overlapping_and_touching_spans():
    text = "a@b.org,1.2.3.4 (4111 1111 1111 1111) 1.2.3.4@c.de"
    base = pii.base_spans(text)
    assert [(u[2], u[3]) for u in pii.units(text, base)] == [
        ("email", "a@b.org"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("email", "1.2.3.4@c.de"),
    ]
    assert pii.units("", []) == []
    assert [u[3] for u in pii.units("12 34  56 x 7", [])] == ["12 34", "56", "x", "7"]


def test_known_identifiers_are_looked_up_in_good_slots_only(documents, make_sentence, monkeypatch):
    """The anti join reads stored rows of good slots; below a join with all slots its rows would grow with those."""
    plans, stored = [], pii.materialize

    def noted(df, tag):
        if tag == "candidates":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, tag)

    monkeypatch.setattr(pii, "materialize", noted)
    pii.find(documents([(i, t) for i, t in enumerate(talks(make_sentence))])).count()
    assert plans
    for plan in plans:
        assert [line for line in plan.splitlines() if "Join " in line] == [line for line in plan.splitlines() if "Join LeftAnti" in line]
        assert plan.count("Join LeftAnti") == 1


def test_places_and_hashes_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(5)
    letters = [*"aB1 23  .,()[]-+/\t\nΣσİ\xa0é@x ", "a@b.co ", "1.2.3.4", "555 12 ", "deadbeef" * 4 + "1", "\U0001F600"]
    hashes = {}
    monkeypatch.setattr(pii, "PIECE", 40)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(120)))
        low, high, h, kinds = pii.units_of(text, pii.base_spans(text))
        for i, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            assert hashes.setdefault(text[a:b].lower(), int(h[i])) == int(h[i])
            assert i in kinds or text[a] not in pii.EDGES and text[b - 1] not in pii.EDGES
    assert len(set(hashes.values())) == len(hashes)
    assert [u[3] for u in pii.units("1" * 100_000 + "x 7", [])] == ["1" * 100_000 + "x", "7"]


def test_common_patterns_and_words_cost_a_row_a_task(documents, make_sentence, monkeypatch):
    """Slots of a pattern that cannot be good, and places of a word that cannot be an identifier, are not all given."""
    import numpy as np

    texts = [f"write to me at {'friend%d' % i if i > 9 else 'user%d@mail.org' % i} before noon" for i in range(400)]
    texts += [f"{make_sentence(random.Random(i), 3)} home {make_sentence(random.Random(-i), 3)}" for i in range(300)]
    docs = documents(list(enumerate(texts))).coalesce(1)
    spark = docs.sparkSession
    text = "write to me at user1@mail.org before noon"
    h = pii.units_of(text, pii.base_spans(text))[2]
    around = [(int(x), 40) for x in pii.patterns_of(h)[:, 4].view(np.int64)]
    able = spark.createDataFrame(around, "pattern long, most long")
    for gather in (pii.GATHER, 100):
        monkeypatch.setattr(pii, "GATHER", gather)
        got = pii.look_up(docs, pii.bits_of(able, "pattern"), pii.limits_of(able, "pattern"), True).join(able, "pattern").collect()
        assert {r.pattern for r in got if r.form == pii.OVER} == {p for p, _ in around} and len(got) <= 3 * 45
        word = spark.createDataFrame([(int(pii.hash_of("home").view(np.int64)), 20)], "entity long, most long")
        got = pii.look_up(docs, pii.bits_of(word, "entity"), pii.limits_of(word, "entity"), False).join(word, "entity").collect()
        assert sum(r.n for r in got if r.form == pii.ALL) > 20 and len(got) <= 150


def test_patterns_given_up_are_looked_up_again(documents, make_sentence, monkeypatch):
    """By the time many more identifiers are known, a pattern that had too many strangers is good."""
    rng = random.Random(43)
    texts = talks(make_sentence)
    # Three seeds in a place with thirty others, which become known by another place first.
    texts += [f"ring the bell for user{i}@mail{i}.org at dawn {make_sentence(rng, 8)}" for i in range(3)]
    texts += [f"ring the bell for stranger_{i} at dawn {make_sentence(rng, 8)}" for i in range(30)]
    texts += [f"write to me at stranger_{i} before noon please" for i in range(26)]
    texts += [f"now write to me at user{i}@mail{i}.org before noon please" for i in range(30, 90)]
    want = plain_bootstrap(texts, pii.Rule())
    assert {(texts[d][a:b], k) for d, k, a, b in want} >= {(f"stranger_{i}", "email") for i in range(30)}
    docs = documents([(i, t) for i, t in enumerate(texts)])
    for gather in (pii.GATHER, 60):
        monkeypatch.setattr(pii, "GATHER", gather)
        got = pii.find(docs, pii.Rule()).collect()
        assert {(r.doc_id, s.kind, s.start, s.end) for r in got for s in r.found} == want
