"""Personal data: fixed forms first, then bootstrapped contextual extraction.

Base forms (email, ip, card, phone) are found in whole texts; with long hexadecimal keys
(kind ``secret``) they are the seeds of a bootstrap. Texts are read as sequences of units: a seed
span, a run of number words with single blanks between, or any other word without edge marks. A unit
stands in up to three patterns: the two units before it, the two after it, one on each side.

1. Patterns that surround ``support`` distinct known identifiers of a kind are looked up in all texts; whatever
   stands in their slots, letters or digits, is counted. A pattern is good if ``precision`` of these distinct
   identifiers are known as its kind.
2. An identifier gets the score 1 - prod(1 - precision) over its good patterns. It becomes known from ``score`` on,
   unless under ``share`` of all its occurrences stand in their slots: a common word in a good slot stays a word.
3. New identifiers are looked up in all texts and bring patterns of their own. This repeats until none is added.

A look-up is a scan by Arrow batches that compares hashes of units with a bit filter of fixed size, aggregates
what passes within the task, and is joined with the exact set afterwards: the filter only thins out what is
shuffled. A look-up knows how many distinct identifiers a pattern may have and still be good, and how often an
identifier may occur and still have its share in slots. What goes beyond in one task alone is given as one row: a
common pattern or word costs a row a task, however often it stands. A pattern that was given up is looked up again
once its known identifiers would allow more than then. Spark keeps the graph as tables of distinct pairs. Identifiers and patterns are 64-bit hashes.

Long runs cannot make matching quadratic: emails are grown from their "@", addresses begin where a run of digits begins.

Defined cases: null or empty text has no spans; offsets are code points, end exclusive; base forms may overlap between
kinds, and the units of overlapping spans are one, of the first kind as listed; a found span never touches a base span; of two kinds
with equal scores the later name wins; very long texts are read whole, a slice of rows at a time; repeated rows
each get their result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import row_slices
from casebook.session import Passing, materialize

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KEY = re.compile(r"(?<![0-9A-Za-z])(?=[A-Fa-f]*+[0-9])(?=[0-9]*+[A-Fa-f])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])")
BLANKS = re.compile(r"\s")
NUMBER = re.compile(r"(?=[()+./-]*+[0-9])[0-9()+./-]++")
NOT_DIGITS = re.compile(r"[^0-9]+")
EDGES = ".,;:!?\"'()[]{}<>"
#: Bits of the filter of a look-up, 1 MB in all. Beyond some two million entries it lets more through; results stay the same.
FILTER_BITS = 23
#: Entries of a look-up's table of limits, 1 MB in all (those that meet have the larger limit); rows a task gathers at most.
LIMITS = 1 << 18
GATHER = 1 << 18
#: Forms of the rows that count an identifier everywhere, and that give up a pattern.
ALL, OVER = -1, -2
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Characters of a text that are hashed at once, up to the next blank.
PIECE = 1 << 18
SOLID, FIGURE, EDGE, BLANK = range(4)
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
CODE_KINDS = np.zeros(0x110000, np.uint8)
for _kind, _letters in ((FIGURE, "0123456789"), (EDGE, EDGES), (BLANK, SPACES)):
    CODE_KINDS[list(map(ord, _letters))] = _kind
_random = np.random.default_rng(20_240_608)
CODE_HASHES = _random.integers(0, 1 << 64, 0x110000, dtype=np.uint64)
BASE = int(_random.integers(0, 1 << 64, dtype=np.uint64)) & ~7 | 5
_powers: tuple[np.ndarray, ...] = (np.empty(0, np.uint64),) * 2


@dataclass(frozen=True)
class Rule:
    """See the module's steps: distinct seeds a pattern needs, its precision, an identifier's score and share of occurrences."""

    support: int = 3
    precision: float = 0.6
    score: float = 0.85
    share: float = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, each found from its "@": the letters before it back to the last match's end, then the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base forms by kind as listed, then start."""
    found = [("email", *span) for span in emails(text)]
    if DIGIT.search(text):
        for m in ADDRESS.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = NOT_DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def seed_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans, and keys that touch none of them."""
    found = list(base)
    taken = sorted((start, end) for _, start, end in base)
    at = 0
    for m in KEY.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            found.append((SECRET, *m.span()))
    return found


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base of word hashes and of its inverse, kept for the task."""
    global _powers
    if n > len(_powers[0]):
        grown = [np.full(2 * n, np.uint64(b), np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64))]
        for x in grown:
            x[0] = 1
            np.multiply.accumulate(x, out=x)
        _powers = tuple(grown)
    return _powers


def code_points(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_hashes(codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of stretches of code points by prefix sums, never 0: no table of words is kept, however many there are."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    values = CODE_HASHES.take(codes)
    values *= up[: len(codes)]
    np.cumsum(values, out=sums[1:])
    h = sums.take(high)
    h -= sums.take(low)
    h *= down.take(low)
    h ^= h >> np.uint64(32)
    h *= MIXERS[2]
    h ^= h >> np.uint64(29)
    h[h == 0] = 1
    return h


def hash_of(text: str) -> np.uint64:
    codes = code_points(text.lower())
    return word_hashes(codes, np.array([0]), np.array([len(codes)]))[0]


def piece_words(text: str) -> tuple[np.ndarray, ...]:
    """Start, end and hash (in lower case) of each word without edge marks, and which of them hold a digit."""
    lower = text.lower()
    same = len(lower) == len(text)  # else places would move: hashed word by word
    codes = code_points(lower if same else text)
    kind = CODE_KINDS.take(codes)
    filled = np.zeros(len(kind) + 2, bool)
    np.not_equal(kind, BLANK, out=filled[1:-1])
    change = np.flatnonzero(filled[1:] != filled[:-1])
    low, high = change[::2].copy(), change[1::2].copy()
    # Most words have one mark at an end, if any; beyond that the next letter is looked up, however far it is.
    low += kind.take(low) == EDGE
    high -= (kind.take(high - 1) == EDGE) & (low < high)
    left, right = np.flatnonzero(kind.take(low, mode="clip") == EDGE), np.flatnonzero(kind.take(high - 1) == EDGE)
    if len(left) or len(right):
        solid = np.flatnonzero(kind < EDGE)
        low[left] = np.append(solid, len(kind))[np.searchsorted(solid, low[left])]
        high[right] = np.append(-1, solid)[np.searchsorted(solid, high[right])] + 1
    worded = low < high
    if not worded.all():
        low, high = low[worded], high[worded]
    figures = np.flatnonzero(kind == FIGURE)
    numeric = np.unique(np.searchsorted(low, figures, "right") - 1) if len(figures) else figures
    if same:
        return low, high, word_hashes(codes, low, high), numeric
    listed = [hash_of(text[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
    return low, high, np.array(listed, np.uint64), numeric


def words_of(text: str) -> tuple[np.ndarray, ...]:
    """``piece_words`` of a text of any length, read in pieces that end at a blank."""
    if len(text) <= PIECE:
        return piece_words(text)
    parts, at, before = [], 0, 0
    while at < len(text):
        blank = BLANKS.search(text, at + PIECE)
        stop = blank.start() if blank else len(text)
        low, high, h, numeric = piece_words(text[at:stop])
        parts.append((low + at, high + at, h, numeric + before))
        at, before = stop, before + len(low)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def units_of(text: str, base: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, str]]:
    """Start, end and hash of every unit, in order, and the kinds of those that are seeds."""
    if not base and not DIGIT.search(text):
        return *words_of(text)[:3], {}
    order = (*KINDS, SECRET)
    merged: list[list] = []
    for kind, start, end in sorted(seed_spans(text, base), key=lambda x: (x[1], x[2])):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
            merged[-1][2] = min(merged[-1][2], kind, key=order.index)
        else:
            merged.append([start, end, kind])
    parts, kinds, at, n = [], {}, 0, 0
    for start, end, kind in [*merged, (len(text), None, None)]:
        if at < start:
            low, high, h = with_runs(text[at:start])
            parts.append((low + at, high + at, h))
            n += len(low)
        if kind:
            parts.append((np.array([start]), np.array([end]), np.array([hash_of(text[start:end])], np.uint64)))
            kinds[n] = kind
            n, at = n + 1, end
    return *(np.concatenate(x) for x in zip(*parts, strict=True)), kinds


def with_runs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a text without seeds, runs of number words with single blanks between made one."""
    low, high, h, numeric = words_of(text)
    gone, head, last = [], -1, -2
    for i in numeric.tolist():
        start = int(low[i])
        while start and text[start - 1] in EDGES:
            start -= 1
        if not NUMBER.fullmatch(text, start, int(high[i])):
            continue
        if last == i - 1 and low[i] == high[i - 1] + 1 and text[low[i] - 1] == " ":
            gone.append((head, i))
        else:
            head = i
        last = i
    if gone:
        ends = dict(gone)  # the last word of each run
        for head, i in ends.items():
            high[head] = high[i]
            h[head] = hash_of(text[low[head] : high[head]])
        stays = np.ones(len(low), bool)
        stays[[i for _, i in gone]] = False
        low, high, h = low[stays], high[stays], h[stays]
    return low, high, h


def units(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str | None, str]]:
    """start, end, kind (of seeds) and plain text of every unit, in order."""
    low, high, _, kinds = units_of(text, base)
    return [(a, b, kinds.get(i), text[a:b].lower()) for i, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True))]


def patterns_of(h: np.ndarray) -> np.ndarray:
    """Three rows: the pattern of each unit by the two before it, the two after it, and one on each side; 0 where one is missing."""
    n = len(h)
    found = np.zeros((3, n), np.uint64)

    def mix(form: int, a: np.ndarray, b: np.ndarray, out: np.ndarray) -> None:
        x = a ^ MIXERS[form]
        x *= MIXERS[0]
        x ^= x >> np.uint64(29)
        x += b
        x *= MIXERS[1]
        np.bitwise_xor(x, x >> np.uint64(32), out=out)
        out |= np.uint64(1)

    if n > 2:
        mix(0, h[:-2], h[1:-1], found[0, 2:])
        mix(1, h[1:-1], h[2:], found[1, :-2])
        mix(2, h[:-2], h[2:], found[2, 1:-1])
    return found


def bits_of(hashes: DataFrame, name: str) -> bytes:
    """The bit filter of a column of hashes, two bits each; at most ``2**FILTER_BITS / 64`` rows come to the driver."""
    mask = (1 << FILTER_BITS) - 1
    bit = F.explode(F.array(F.col(name).bitwiseAND(mask), F.shiftrightunsigned(name, 40).bitwiseAND(mask)))
    rows = hashes.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    )
    filled = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found = rows.toArrow()  # at once: an iterator would run a job for each partition
    filled[found["place"].to_numpy()] = found["bits"].to_numpy()
    return filled.tobytes()


def limits_of(hashes: DataFrame, name: str) -> bytes:
    """The table of limits of a column of hashes, from their column ``most``; ``LIMITS`` rows at most come to the driver."""
    place = F.shiftrightunsigned(name, 20).bitwiseAND(LIMITS - 1)
    filled = np.zeros(LIMITS, np.int32)
    found = hashes.groupBy(place.alias("place")).agg(F.max("most").alias("most")).toArrow()
    filled[found["place"].to_numpy()] = np.minimum(found["most"].to_numpy(), (1 << 31) - 1)
    return filled.tobytes()


def limit_of(names: np.ndarray, limits: np.ndarray) -> np.ndarray:
    return limits.take((names.view(np.uint64) >> np.uint64(20) & np.uint64(LIMITS - 1)).view(np.int64))


def thinned(rows: np.ndarray, limits: np.ndarray, by_pattern: bool) -> tuple[np.ndarray, np.ndarray]:
    """Summed rows (pattern, form, entity, n) without what goes beyond its limit, and the names of that.

    Of a pattern with more rows one row is left, of an entity that occurs more often the row that counts it.
    """
    rows = rows[np.lexsort(rows[:, :3].T)]
    first = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
    n = np.add.reduceat(rows[:, 3], first)
    rows = rows[first]
    rows[:, 3] = n
    names, of = np.unique(rows[:, 0 if by_pattern else 2], return_inverse=True)
    counted = np.ones(len(n)) if by_pattern else np.where(rows[:, 1] == ALL, n, 0)
    over = np.bincount(of, counted) > limit_of(names, limits)
    rows = rows[~over[of] | (rows[:, 1] < 0)]
    if by_pattern and over.any():
        marks = np.zeros((int(over.sum()), 4), np.int64)
        marks[:, 0], marks[:, 1] = names[over], OVER
        rows = np.concatenate([rows, marks])
    return rows, names[over]


def passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that pass the filter; the second bit is looked at where the first is set."""
    mask, six, one = np.uint64((1 << FILTER_BITS) - 1), np.uint64(6), np.uint64(1)
    test = lambda x: (bits.take((x >> six).view(np.int64)) >> (x & np.uint64(63))) & one
    at = np.flatnonzero(test(h & mask))
    return at[np.flatnonzero(test((h[at] >> np.uint64(40)) & mask))]


def read_rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string"))


def scan(documents: DataFrame) -> DataFrame:
    """One stored row per document: doc_id, mark, base (array of kind, start, end), seeds (kind, start, end, entity, patterns)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    seed = pa.struct([*span, ("entity", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("base", pa.list_(span)), ("seeds", pa.list_(seed))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            bases, seeds = [], []
            for text in batch.column(2).to_pylist():
                text = text or ""
                base = base_spans(text)
                bases.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in base])
                said = []
                if base or DIGIT.search(text) and KEY.search(text):
                    low, high, h, kinds = units_of(text, base)
                    signed, around = h.view(np.int64), patterns_of(h).view(np.int64)
                    for i, kind in kinds.items():
                        near = [int(x) for x in around[:, i] if x]
                        said.append({"kind": kind, "start": int(low[i]), "end": int(high[i]), "entity": int(signed[i]), "patterns": near})
                seeds.append(said)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bases, pa.list_(span)), pa.array(seeds, pa.list_(seed))], schema=schema
            )

    kinds = "kind:string,start:int,end:int"
    return materialize(read_rows(documents).mapInArrow(
        read, f"doc_id long, mark long, base array<struct<{kinds}>>, seeds array<struct<{kinds},entity:bigint,patterns:array<bigint>>>"
    ), "spans")


def look_up(documents: DataFrame, bits: bytes, limits: bytes, by_pattern: bool) -> DataFrame:
    """pattern, form, entity, n: how often a unit stands in a pattern, for patterns (or entities) that pass the filter.

    Summed within tasks only. By entity, an occurrence also counts as form ALL, pattern 0. What goes beyond its limit in
    a task is not whole: such a pattern has a row of form OVER, such an entity counts more than its limit.
    """
    names = ["pattern", "form", "entity", "n"]

    def rows_of(text: str | None, table: np.ndarray) -> Iterator[np.ndarray]:
        h = units_of(text, base_spans(text))[2] if text else np.empty(0, np.uint64)
        met = None if by_pattern else passes(h, table)
        if met is not None and len(met):
            here = h[met].view(np.int64)
            yield np.stack([np.zeros_like(here), np.full(len(here), ALL), here, np.ones_like(here)], axis=1)
        if by_pattern or len(met):
            around = patterns_of(h)
            for form in range(3):
                at = passes(around[form], table) if by_pattern else met
                at = at[around[form, at] != 0]
                if len(at):
                    here = h[at].view(np.int64)
                    yield np.stack([around[form, at].view(np.int64), np.full(len(at), form), here, np.ones_like(here)], axis=1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, most = np.frombuffer(bits, np.uint64), np.frombuffer(limits, np.int32)
        given = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)], names=names
        )
        waiting, size, gone = [], 0, np.empty(0, np.int64)
        for batch in row_slices(batches):
            parts = [x for text in batch.column(2).to_pylist() for x in rows_of(text, table)]
            if parts:
                rows = np.concatenate(parts)
                name = np.ascontiguousarray(rows[:, 0 if by_pattern else 2])
                waiting.append(rows[(limit_of(name, most) > 0) & ~np.isin(name, gone)])
                size += len(waiting[-1])
            if size > GATHER:
                rows, more = thinned(np.concatenate(waiting), most, by_pattern)
                waiting, size, gone = [rows], len(rows), np.union1d(gone, more)
                if size > GATHER // 2:
                    yield given(rows)
                    waiting, size = [], 0
        if size:
            yield given(thinned(np.concatenate(waiting), most, by_pattern)[0])

    return read_rows(documents).mapInArrow(read, "pattern long, form long, entity long, n long")


def occurrences(documents: DataFrame, bits: bytes) -> DataFrame:
    """doc_id, mark, entity, start, end of every unit that passes the filter and is no seed."""
    names = ["doc_id", "mark", "entity", "start", "end"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint64)
        for batch in row_slices(batches):
            rows = []
            for doc, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if text:
                    low, high, h, kinds = units_of(text, base_spans(text))
                    at = passes(h, table).tolist()
                    rows += [(doc, mark, int(h.view(np.int64)[i]), int(low[i]), int(high[i])) for i in at if i not in kinds]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds, strict=True)], names=names)

    return read_rows(documents).mapInArrow(read, "doc_id long, mark long, entity long, start int, end int")


def bootstrap(documents: DataFrame, seeds: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Identifiers (entity, kind) that the rounds add to the seeds, stored. ``seeds`` has kind, entity, patterns."""
    spark = documents.sparkSession
    count = F.count(F.lit(1))
    known = materialize(seeds.select("entity", "kind").distinct().withColumn("seed", F.lit(True)), "known")
    around = materialize(seeds.select("entity", "kind", F.explode("patterns").alias("pattern")).distinct(), "around")
    looked = slots = None
    while True:
        able = around.groupBy("pattern", "kind").agg(count.alias("n")).where(F.col("n") >= rule.support)
        # A good pattern has fewer distinct identifiers than ``needs``; twice that are read, so that few are looked up again.
        able = able.groupBy("pattern").agg((F.floor(F.max("n") / rule.precision) + 1).alias("needs"))
        if looked is not None:
            able = able.join(looked.groupBy("pattern").agg(F.max("read").alias("read")), "pattern", "left")
            able = able.where(F.col("read").isNull() | (F.col("read") < F.col("needs")))
        able = materialize(able.select("pattern", (2 * F.col("needs")).alias("most")), "patterns")
        if not able.isEmpty():
            found = look_up(documents, bits_of(able, "pattern"), limits_of(able, "pattern"), True).join(able.select("pattern"), "pattern")
            found = materialize(found.groupBy("pattern", "form", "entity").agg(F.sum("n").alias("n")), "slots")
            over = found.where(F.col("form") == OVER).select("pattern", F.lit(True).alias("over"))
            read = F.when(F.col("over"), F.col("most")).otherwise(F.lit((1 << 63) - 1))
            now = materialize(able.join(over, "pattern", "left").select("pattern", read.alias("read")), "looked")
            found = found.join(over.select("pattern"), "pattern", "left_anti")
            slots, looked = (found, now) if slots is None else (slots.union(found), looked.union(now))
        if slots is None:
            break
        held = around.groupBy("pattern", "kind").agg(count.alias("held"))
        good = held.join(slots.groupBy("pattern").agg(count.alias("total")), "pattern").select(
            "pattern", "kind", "held", (F.col("held") / (F.col("total") + 1)).alias("precision")
        ).where((F.col("held") >= rule.support) & (F.col("precision") >= rule.precision))
        with Passing(spark) as block:
            # Stored, so that Spark looks up the known ones among what stands in good slots, not in all slots.
            standing = materialize(slots.join(good, "pattern").select("entity", "kind", "precision", "form", "n"), "standing")
            met = standing.join(known.select("entity").distinct(), "entity", "left_anti")
            scored = met.groupBy("entity", "kind").agg(
                (1 - F.exp(F.sum(F.log(1 - F.col("precision"))))).alias("score"),
                F.greatest(*[F.sum(F.when(F.col("form") == form, F.col("n")).otherwise(0)) for form in range(3)]).alias("inside"),
            ).where(F.col("score") >= rule.score)
            best = scored.groupBy("entity").agg(F.max(F.struct("score", "kind", "inside")).alias("best"))
            best = materialize(best.select("entity", "best.kind", "best.inside"), "candidates")
            if best.isEmpty():
                break
            # From more occurrences on, those in slots are below the share.
            most = (F.floor(F.col("inside") / rule.share) + 1) if rule.share else F.lit((1 << 31) - 1)
            everywhere = materialize(
                look_up(documents, bits_of(best, "entity"), limits_of(best.select("entity", most.alias("most")), "entity"), False)
                .join(best.select("entity"), "entity")
                .groupBy("pattern", "form", "entity").agg(F.sum("n").alias("n")),
                "everywhere",
            )
            totals = everywhere.where(F.col("form") == ALL).select("entity", F.col("n").alias("all"))
            added = best.join(totals, "entity").where(F.col("inside") >= rule.share * F.col("all")).select("entity", "kind")
            added = block.keep(added.withColumn("seed", F.lit(False)), "added")
            if added.isEmpty():
                break
            more = everywhere.where(F.col("form") >= 0).join(added, "entity").select("entity", "kind", "pattern")
            around = around.union(block.keep(more, "around"))
        known = known.union(added)
    return known.where(~F.col("seed")).select("entity", "kind")


def find(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, mark, base and found spans (arrays of kind, start, end) of every document; seeds of no base form are found ones."""
    scanned = scan(documents)
    said = scanned.select("doc_id", "mark", F.explode("seeds").alias("s")).select("doc_id", "mark", "s.*")
    added = materialize(bootstrap(documents, said, rule), "added")
    span = F.struct("kind", "start", "end")
    new = said.where(F.col("kind") == SECRET).select("doc_id", "mark", span.alias("span"))
    if not added.isEmpty():
        more = occurrences(documents, bits_of(added, "entity")).join(added, "entity")
        new = new.union(more.select("doc_id", "mark", span))
    new = new.groupBy("doc_id", "mark").agg(F.collect_set("span").alias("found")).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "found"
    )
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return scanned.join(
        new, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left"
    ).select("doc_id", "mark", "base", F.coalesce("found", empty).alias("found"))


def report(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Counts of the base forms, the digest of the base spans, all spans as text, and how many were found beyond the base."""
    rank = F.create_map(*[x for i, k in enumerate((*KINDS, SECRET)) for x in (F.lit(k), F.lit(i))])

    def listed(spans):
        ordered = F.array_sort(
            F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"], s["end"], s["kind"].alias("kind")))
        )
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find(documents, rule).select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_found"),
        F.size(F.concat("base", "found")).cast("long").alias("n_spans"),
    )
