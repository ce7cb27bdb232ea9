"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: h = 2h + gear[byte], so a 32-bit value
knows ``REACH`` bytes. A text is cut wherever the hash of the bytes behind a place
is the least of all places in some window of ``Rule.window``. A chunk reaches from a
cut to the end of the bytes that decided on the next cut, so both its ends depend
on its content alone: chunks vary in length, and behind an insertion they are the
same again. Every stretch of ``run`` bytes holds two cuts and with them a whole chunk.

Chunks are deduplicated by digest. A chunk belongs to a string if windows inside the
string decide on both its cuts; wherever the string stands, it has the same chunks.
So a string of ``run`` bytes can only stand elsewhere too if all its chunks do, and
all other strings are out. What is left is decided by digests of whole strings:
first one longer string per cut, which settles all starts up to the next cut at
once, so that the inside of a long copy costs a digest a cut; then the string of
``run`` bytes at each start that is still open, which are the ends of the copies.
What these may match can lie inside a copy that is settled: of each settled group
the first place joins in with those of its strings whose first chunk an open one has.
Equal strings at different places are repeats; no two places are chosen as witnesses
for others. A passage is what such strings cover together where they overlap. Equal
whole texts, of any length, are found first; only the first of each goes on to
chunks, and in the end its copies are passages as wholes. Of the places compared, the first one of
a string (by id, then text, then place) keeps it.

Strings are grouped by 128 bits with partial aggregation, which moves a first and
a last place per string; occurrences find their group by a join whose hot keys can
be split. Only a document's own places ever come together.

Defined cases: null or empty text has no chunks; rows that repeat an id and a text
are one and do not repeat each other; rows of one id with different texts are
parts of one document; null ids are one document; a very long text is hashed in
pieces and its rows grow with its length; other columns are ignored. Bounds are
moved inwards to whole characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.llm.common import carried, row_slices, same_key, small
from casebook.llm.suffixes import powers
from casebook.session import Passing, materialize

GEAR = np.random.default_rng(20_240_603).integers(0, 1 << 32, 256, dtype=np.uint32)
#: For digests of chunks.
BYTE_HASHES = np.random.default_rng(20_240_604).integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = int(np.random.default_rng(20_240_605).integers(0, 1 << 64, dtype=np.uint64)) | 1
REACH = 32
PIECE = 1 << 20
#: Texts are read one behind the other in arrays of about so many bytes, which stay in a core's cache.
JOINT = 1 << 17
NO_ID = -(1 << 63)
Found = tuple[np.ndarray, ...]


@dataclass(frozen=True)
class Rule:
    run: int = 100  # bytes from which on a string that stands elsewhere counts

    def __post_init__(self) -> None:
        if self.run < 2 * REACH:
            raise ValueError(f"run must be {2 * REACH} at least, so that a chunk fits into every string")

    @property
    def window(self) -> int:
        """Cuts are at most this far apart: a string of ``run`` bytes holds two such windows."""
        return (self.run - REACH + 1) // 2

    @property
    def turns(self) -> int:
        """Windows in a string of ``run`` bytes."""
        return self.run - REACH + 1 - self.window + 1

    @property
    def longer(self) -> int:
        """Length of the string that settles all starts from a cut up to the next one."""
        return self.run + self.window


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, in place of a loop: sums over 2, 4, … 32 bytes."""
    h = GEAR[data]
    span = 1
    while span < REACH:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, span * 2
    return h


def least_places(data: np.ndarray, wide: int) -> np.ndarray:
    """For each window of ``wide`` places of the data the place whose hash is the least, the first of equal ones."""
    h = gear_hashes(data)[REACH - 1 :].astype(np.uint64)
    least = (h << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span < wide:
        step = min(span, wide - span)
        least, span = np.minimum(least[:-step], least[step:]), span + step
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # never falls from one window to the next


def cut_places(data: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash is the least of some window of places (the first of equal ones), and the first such window of each."""
    places, wide, cuts, firsts = len(data) - REACH + 1, rule.window, [], []
    for start in range(0, max(0, places - wide + 1), PIECE):
        stop = min(start + PIECE + wide - 1, places)
        at = least_places(data[start : stop + REACH - 1], wide)
        new = np.flatnonzero(np.diff(at, prepend=-1))
        cuts.append(at[new] + start)
        firsts.append(new + start)
    if not cuts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, which = np.unique(np.concatenate(cuts), return_index=True)
    return found, np.concatenate(firsts)[which]


def chunk_bounds(raw: bytes, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each chunk its first and last byte places (end exclusive) and the last window that decides on its first cut.

    The chunk belongs to the strings that hold this window and the next one. A text below ``run`` bytes has none.
    """
    if len(raw) < rule.run:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    cuts, firsts = cut_places(np.frombuffer(raw, np.uint8), rule)
    return cuts[:-1], cuts[1:] + REACH, firsts[1:] - 1


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ``counts`` places from each start on."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class Texts:
    """Texts one behind the other, so that one array operation serves many; places count from the first one's start."""

    def __init__(self, raws: list[bytes]) -> None:
        self.raw = b"".join(raws)
        self.sizes = np.array([len(r) for r in raws], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def marked(self, at: np.ndarray) -> np.ndarray:
        """Whether each place is among the given ones."""
        found = np.zeros(len(self.raw) + 1, bool)
        found[at] = True
        return found

    def bounds(self, rule: Rule) -> Found:
        """``chunk_bounds`` of every text; a long one stands alone and is hashed in pieces."""
        if len(self.sizes) == 1:
            return chunk_bounds(self.raw, rule)
        counts = np.where(self.sizes < rule.run, 0, self.sizes - REACH - rule.window + 2)
        windows = spread(self.starts, counts)
        if not len(windows):
            return windows, windows, windows
        at = least_places(np.frombuffer(self.raw, np.uint8), rule.window)[windows]
        new = np.flatnonzero(np.diff(at, prepend=-1))
        cuts, firsts = at[new], windows[new]
        owner = self.owner(cuts)
        same = owner[1:] == owner[:-1]
        return cuts[:-1][same], cuts[1:][same] + REACH, firsts[1:][same] - 1


@cache
def scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the digests' base and of its inverse."""
    return powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)


def digests_of(raw: bytes, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Digests of chunks in ascending order, by prefix sums. They only nominate, so 64 bits do."""
    found, data, a = np.empty(len(low), np.uint64), np.frombuffer(raw, np.uint8), 0
    while a < len(low):
        base = low[a]
        b = int(np.searchsorted(low, base + JOINT))
        piece, start, end = data[base : high[b - 1]], low[a:b] - base, high[a:b] - base
        up, down = scales(1 << len(piece).bit_length())
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(BYTE_HASHES[piece] * up[: len(piece)], out=sums[1:])
        digest = (sums[end] - sums[start]) * down[start]
        found[a:b] = (digest ^ (digest >> np.uint64(32))) * np.uint64(BASE)
        a = b
    return found.view(np.int64)


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("mark"),
        F.col("text").cast("string").alias("text"),
    ).where(F.octet_length("text") > 0)


PLACE = [("doc", pa.int64()), ("mark", pa.int64()), ("at", pa.int32())]


def text_names(documents: DataFrame) -> DataFrame:
    """doc, mark, more (a second hash) and size (bytes) of every text, stored."""
    rows = keyed(documents).select("doc", "mark", F.xxhash64(F.lit(1), "text").alias("more"), F.octet_length("text").alias("size"))
    return materialize(rows, "names")


def text_numbers(names: DataFrame) -> DataFrame:
    """doc, mark and number of every text, counted from 0 in the order of doc and mark."""
    ordered = names.select("doc", "mark").distinct().orderBy("doc", "mark")
    ordered = materialize(ordered.select("doc", "mark", F.monotonically_increasing_id().alias("id")), "ordered")
    # The upper bits of these ids are the sorted part, the lower 33 count within it. The window sees one row a part.
    part = F.shiftright("id", 33).alias("part")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    parts = ordered.groupBy(part).count().select("part", before)
    number = F.col("id") - F.shiftleft("part", 33) + F.col("before")
    numbers = ordered.withColumn("part", part).join(F.broadcast(parts), "part").select("doc", "mark", number.alias("number"))
    return materialize(numbers, "numbers")


def whole_copies(rows: DataFrame) -> DataFrame:
    """doc, mark, size (bytes), f and z (the first and the last document with the text) of texts that several documents have."""
    groups = rows.groupBy("mark", "more", "size").agg(F.min("doc").alias("f"), F.max("doc").alias("z"))
    groups = materialize(groups.where(F.col("f") != F.col("z")), "groups")
    return materialize(rows.join(groups, ["mark", "more", "size"]).select("doc", "mark", "size", "f", "z"), "copies")


def joint(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Rows ``low`` to ``high`` that are read together: up to ``JOINT`` bytes, or one longer text."""
    low = held = 0
    for i, size in enumerate(sizes):
        if i > low and held + size > JOINT:
            yield low, i
            low, held = i, 0
        held += size
    if sizes:
        yield low, len(sizes)


def of_texts(rows: DataFrame, find: Callable[..., Found], more: list[tuple[str, pa.DataType]], kinds: str) -> DataFrame:
    """doc, mark, at and further columns of the places that ``find`` gives for texts and the places that stand beside them.

    Rows of numbered texts have the number behind mark.
    """
    known = "number" in rows.columns
    schema = pa.schema(PLACE[:2] + [("number", pa.int64())] * known + PLACE[2:] + more)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 128):
            raws = batch.column("text").cast(pa.binary()).to_pylist()
            for a, b in joint([len(raw) for raw in raws]):
                texts, rows = Texts(raws[a:b]), batch.slice(a, b - a)
                names = [rows.column(c).to_numpy() for c in ("doc", "mark", "number") if c in rows.schema.names]
                lists = [c for c in rows.columns if pa.types.is_list(c.type)]
                at, *found = find(
                    texts, *[c.flatten().to_numpy() + np.repeat(texts.starts, c.value_lengths().to_numpy()) for c in lists]
                )
                if len(at):
                    owner = texts.owner(at)
                    columns = [*[c[owner] for c in names], at - texts.starts[owner], *found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c).cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                    )

    return rows.mapInArrow(take, f"doc long, mark long, {'number long, ' * known}at int, {kinds}")


def chunks(texts: DataFrame, rule: Rule) -> DataFrame:
    """doc, mark, at and digest of every chunk of keyed texts."""

    def find(texts: Texts) -> Found:
        low, high, _ = texts.bounds(rule)
        return low, digests_of(texts.raw, low, high)

    return of_texts(texts, find, [("digest", pa.int64())], "digest long")


def open_starts(texts: Texts, low: np.ndarray, turn: np.ndarray, shared: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether a string of ``run`` bytes starts at each place and all its chunks are shared."""
    size = len(texts.raw) + 1
    lost = turn[~texts.marked(shared)[low]]
    opens = np.bincount(np.maximum(lost - rule.turns + 2, texts.starts[texts.owner(lost)]), minlength=size)
    closes = np.bincount(lost + 1, minlength=size)
    return texts.marked(spread(texts.starts, np.maximum(texts.sizes - rule.run + 1, 0))) & (np.cumsum(opens - closes) == 0)


def strings(raw: bytes, at: np.ndarray, size: int) -> Found:
    """at, size, trim (bytes of cut characters in front, times four, and at the end) and digest in two parts of strings."""
    digests = b"".join([xxhash.xxh3_128_digest(raw[i : i + size]) for i in at.tolist()])
    both = np.frombuffer(digests, np.int64).reshape(-1, 2)
    inside = np.frombuffer(raw + b" ", np.uint8) & 0xC0 == 0x80
    low, high = at.copy(), at + size
    for _ in range(3):
        low += inside[low]
        high -= inside[high]
    return at, np.full(len(at), size), 4 * (low - at) + (at + size - high), both[:, 0], both[:, 1]


STRING = [("size", pa.int32()), ("trim", pa.int32()), ("d0", pa.int64()), ("d1", pa.int64())]
STRING_KINDS = "size int, trim int, d0 long, d1 long"


def longer_strings(documents: DataFrame, shared: DataFrame, numbers: DataFrame, rule: Rule) -> DataFrame:
    """The longer string at every cut from which on no chunk in it is out."""

    def find(texts: Texts, places: np.ndarray) -> Found:
        low, high, turn = texts.bounds(rule)
        taken = np.concatenate(([0], np.cumsum(open_starts(texts, low, turn, places, rule))))
        cuts = np.union1d(low, high - REACH)
        cuts = cuts[cuts + rule.longer <= (texts.starts + texts.sizes)[texts.owner(cuts)]]
        return strings(texts.raw, cuts[taken[cuts + rule.window + 1] - taken[cuts] == rule.window + 1], rule.longer)

    return of_texts(beside(documents, numbers, places=shared), find, STRING, STRING_KINDS)


def beside(documents: DataFrame, numbers: DataFrame, **places: DataFrame) -> DataFrame:
    """Texts with their number and an array of places per given frame; texts without any are left out."""
    rows = None
    for name in places:
        part = places[name].select("doc", "mark", *[F.col("at") if n == name else F.lit(None).cast("int") for n in places])
        part = part.toDF("doc", "mark", *places)
        rows = part if rows is None else rows.unionByName(part)
    lists = rows.groupBy("doc", "mark").agg(*[F.collect_list(n).alias(n) for n in places])
    lists = lists.join(numbers, ["doc", "mark"])
    return keyed(documents).join(lists.hint("shuffle_hash"), ["doc", "mark"]).select("doc", "mark", "text", "number", *places)


def settled_starts(texts: Texts, settled: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether a longer string settles the string of ``run`` bytes at each place."""
    size = len(texts.raw) + 1
    return np.cumsum(np.bincount(settled, minlength=size) - np.bincount(settled + rule.window + 1, minlength=size)) > 0


def open_strings(documents: DataFrame, shared: DataFrame, known: DataFrame, numbers: DataFrame, rule: Rule) -> DataFrame:
    """The string at every start that is neither out nor settled, with the digest of its first chunk."""

    def find(texts: Texts, shared: np.ndarray, settled: np.ndarray) -> Found:
        low, high, turn = texts.bounds(rule)
        starts = np.flatnonzero(open_starts(texts, low, turn, shared, rule) & ~settled_starts(texts, settled, rule))
        lead, back = np.unique(np.searchsorted(turn, starts), return_inverse=True)
        return *strings(texts.raw, starts, rule.run), digests_of(texts.raw, low[lead], high[lead])[back]

    rows = beside(documents, numbers, shared=shared, settled=known)
    return of_texts(rows, find, [*STRING, ("digest", pa.int64())], f"{STRING_KINDS}, digest long")


def settled_strings(documents: DataFrame, wanted: DataFrame, first: DataFrame, numbers: DataFrame, rule: Rule) -> DataFrame:
    """The strings that first places of longer strings settle, if they begin with a wanted chunk."""

    def find(texts: Texts, wanted: np.ndarray, settled: np.ndarray) -> Found:
        low, _, turn = texts.bounds(rule)
        starts = np.flatnonzero(settled_starts(texts, settled, rule))
        return strings(texts.raw, starts[texts.marked(wanted)[low[np.searchsorted(turn, starts)]]], rule.run)

    return of_texts(beside(documents, numbers, wanted=wanted, settled=first), find, STRING, STRING_KINDS)


def repeated(found: DataFrame) -> DataFrame:
    """The strings of a stored frame that stand at two places or more, with the first and the last of them.

    Text number and byte are one long, in the order of doc, mark and at, so that its bounds and those of doc are summed up by hashing.
    """
    place = F.shiftleft("number", 31).bitwiseOR(F.col("at").cast("long"))
    groups = found.groupBy("d0", "d1").agg(
        F.min(place).alias("f"), F.max(place).alias("z"), F.min("doc").alias("f_doc"), F.max("doc").alias("z_doc")
    )
    groups = materialize(groups.where(F.col("f") != F.col("z")).drop("z"), "groups")
    other = F.when(F.col("f_doc") != F.col("doc"), F.col("f_doc")).when(F.col("z_doc") != F.col("doc"), F.col("z_doc"))
    return found.join(groups.hint("shuffle_hash"), ["d0", "d1"]).select(
        "doc", "mark", "at", "size", "trim", (place == F.col("f")).alias("keeps"), F.col("f_doc").alias("first"), other.alias("other")
    )


def shared_chunks(texts: DataFrame, rule: Rule) -> DataFrame:
    """Places of the chunks that stand elsewhere too, with their digests."""
    with Passing(texts.sparkSession) as block:
        every = materialize(chunks(texts, rule), "chunks")
        place = F.xxhash64("doc", "mark", "at")
        groups = every.groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("b"))
        digests = materialize(groups.where(F.col("a") != F.col("b")).select("digest"), "digests")
        return block.keep(every.join(digests.hint("shuffle_hash"), "digest").select("doc", "mark", "at", "digest"), "shared")


def repeated_strings(documents: DataFrame, texts: DataFrame, numbers: DataFrame, rule: Rule) -> DataFrame:
    """The repeated strings of the texts, as ``repeated`` gives them."""
    spark = documents.sparkSession
    with Passing(spark) as block:
        with Passing(spark) as inner:
            shared = shared_chunks(texts, rule)
            with Passing(spark):
                known = block.keep(repeated(materialize(longer_strings(documents, shared, numbers, rule), "longer")), "known")
            ends = inner.keep(open_strings(documents, shared, known, numbers, rule), "ends")
            first = known.where("keeps")
            wanted = shared.join(ends.select("digest").distinct().hint("shuffle_hash"), "digest")
            wanted = wanted.join(first.select("doc", "mark").distinct().hint("shuffle_hash"), ["doc", "mark"], "left_semi")
            inside = inner.keep(settled_strings(documents, wanted, first, numbers, rule), "inside")
        single = block.keep(repeated(ends.drop("digest").unionByName(inside)), "single")
    return known.unionByName(single)


def duplicate_passages(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Passages of ``run`` bytes or more that stand elsewhere too, and texts below that length that equal another text.

    doc_id, mark (of the text), low, high (bytes),
    first_doc_id (the smallest id that holds one of them), other_doc_id (another
    document with the first of them that has one, else the document itself, which
    then repeats the passage), and ``removed``: the spans that an earlier place keeps.
    """
    names = text_names(documents)
    copies = whole_copies(names)
    later = copies.where(F.col("doc") != F.col("f")).select("doc", "mark").distinct()
    texts = keyed(documents).join(small(later), ["doc", "mark"], "left_anti")
    wholes = copies.select(
        "doc", "mark", F.lit(0).alias("at"), "size", F.lit(0).alias("trim"), (F.col("doc") == F.col("f")).alias("keeps"),
        F.col("f").alias("first"), F.when(F.col("f") != F.col("doc"), F.col("f")).otherwise(F.col("z")).alias("other"),
    )
    end = F.col("at") + F.col("size")
    pieces = repeated_strings(documents, texts, text_numbers(names), rule).unionByName(wholes).select(
        "*", end.alias("end"), (F.col("at") + F.shiftright("trim", 2)).alias("low"), (end - F.col("trim") % 4).alias("high")
    )
    # A piece begins a passage unless one before it reaches over its start.
    order = Window.partitionBy("doc", "mark").orderBy("at", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached > F.col("at"), 0).otherwise(1)
    numbered = pieces.withColumn("begins", begins).withColumn(
        "run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    passages = numbered.groupBy("doc", "mark", "run").agg(
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first").alias("first"), F.min(F.when(F.col("other").isNotNull(), F.struct("at", "other")))["other"].alias("other"),
        F.array_sort(F.collect_set(F.when(~F.col("keeps"), F.struct("low", "high")))).alias("removed"),
    )
    named = lambda c: F.when(c != NO_ID, c)
    return passages.select(
        named(F.col("doc")).alias("doc_id"), "mark", "low", "high", named(F.col("first")).alias("first_doc_id"),
        named(F.coalesce("other", "doc")).alias("other_doc_id"), "removed",
    )


def joined(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    start = F.array().cast("array<struct<low:int,high:int>>")
    last = lambda s: F.element_at(s, -1)
    return F.aggregate(spans, start, lambda s, x: F.when(
        (F.size(s) > 0) & (F.get(s, F.size(s) - 1)["high"] >= x["low"]),
        F.concat(F.slice(s, F.lit(1), F.size(s) - 1), F.array(F.struct(last(s)["low"].alias("low"), F.greatest(last(s)["high"], x["high"]).alias("high")))),
    ).otherwise(F.concat(s, F.array(x))))


def deduplicate(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The input rows without the parts of reported passages that an earlier place keeps."""
    spans = duplicate_passages(documents, rule).groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("removed")).alias("_spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "_spans")
    columns = documents.columns
    rows = carried(documents, documents["text"].alias("text")).join(spans, same_key("_id", "_mark"), "left")
    ordered = joined(F.array_sort(F.array_distinct("_spans")))
    raw = F.encode("text", "UTF-8")
    # The bytes before each span, and those behind the last one.
    before = F.transform(
        ordered,
        lambda s, i: F.substring(raw, F.coalesce(F.get(ordered, i - 1)["high"], F.lit(0)) + 1, s["low"] - F.coalesce(F.get(ordered, i - 1)["high"], F.lit(0))),
    )
    rest = F.substring(raw, F.element_at(ordered, -1)["high"] + 1, F.octet_length("text"))
    kept = F.aggregate(F.concat(before, F.array(rest)), F.lit(b""), lambda s, x: F.concat(s, x)).cast("string")
    text = F.when(F.size("_spans") > 0, kept).otherwise(F.col("text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns])
