"""Removal of repeated 400-byte strings with a logarithmic family of suffix indexes.

Every window of ``LENGTH`` bytes has an anchor, the least hashed 32-gram in it, so
equal windows have theirs at the same place. Windows with one anchor, cut into
runs of ``sizes[0]`` starts counted back from it, form blocks; all windows of a
block share its core, the string from the block's last start. Cores are the
sampled suffixes of the index: a batch's suffix array is its sorted core
fingerprints, so suffixes with a long common prefix are neighbours.

``SuffixFamily.add`` builds the array of a batch, merge-scans it against the
arrays of all levels, notes the cores that occur elsewhere, and merges arrays of
equal rank into one of the next, so a suffix is merged as often as the logarithm
of the number of batches. Rows that share a core are then decided exactly: if a
block's whole string occurs twice, all its windows repeat; where strings with one
core differ, one row per string goes on in smaller blocks, down to single windows.
So a large group of copies is counted, never compared pair by pair, and work
beyond the first level grows with the borders of repeats.

Fingerprints are polynomial hashes modulo 2**64; decisions use two independent
ones together (128 bits). Texts are read piece by piece, so a very long one is
never hashed at once; a block cut by a piece's end is decided in smaller blocks.

Defined cases: null or empty text has no bytes; a text shorter than ``LENGTH``
keeps all; matches never cross documents; rows that repeat an id and text are
documents that repeat each other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.llm.common import row_slices
from casebook.session import materialize

LENGTH = 400
GRAM = 32
SIZES = (192, 24, 1)
PIECE = 1 << 16
PLACE_BITS = np.uint64(20)
PLACE = np.uint64((1 << 20) - 1)
BATCHES = 3

_random = np.random.default_rng(20_240_602)
BYTE_HASHES = _random.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
BASES = [int(x) | 1 for x in _random.integers(0, 1 << 64, 2, dtype=np.uint64)]
MIX = _random.integers(0, 1 << 64, 4, dtype=np.uint64) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, np.uint64(base), np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


class Hasher:
    """Hashes of any substring of a piece of bytes, by prefix sums."""

    def __init__(self) -> None:
        n = PIECE + 2 * LENGTH + 1
        self.up = [powers(b, n) for b in BASES]
        self.down = [powers(pow(b, -1, 1 << 64), n) for b in BASES]

    def read(self, data: np.ndarray) -> None:
        self.sums = []
        for k in range(2):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(BYTE_HASHES[k][data] * self.up[k][: len(data)], out=sums[1:])
            self.sums.append(sums)

    def of(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = (self.sums[k][end] - self.sums[k][start]) * self.down[k][start]
        found ^= found >> np.uint64(32)
        return found * MIX[k]


def anchors(hasher: Hasher, n: int) -> np.ndarray:
    """For each window start of a piece of n bytes the place of its least hashed gram, the first of equals."""
    grams = np.arange(n - GRAM + 1)
    keys = hasher.of(0, grams, grams + GRAM)
    keys ^= keys >> np.uint64(29)
    keys *= MIX[2]
    least = (keys & ~PLACE) | grams.astype(np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    windows = n - LENGTH + 1
    return (np.minimum(least[:windows], least[width - span : width - span + windows]) & PLACE).astype(np.int64)


def fingerprints(hasher: Hasher, last: np.ndarray, low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Core and whole fingerprints of blocks with the grid place ``last`` and window starts low..high."""
    core = hasher.of(0, last, last - size + 1 + LENGTH)
    whole = hasher.of(1, low, high + LENGTH)
    whole = (whole ^ (last - low).astype(np.uint64) * MIX[3]) * MIX[2] + (last - high).astype(np.uint64)
    return core.view(np.int64), whole.view(np.int64)


def blocks(data: np.ndarray, hasher: Hasher, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of a text, piece by piece: core, whole, last (grid place), low and high window start."""
    for start in range(0, len(data) - LENGTH + 1, PIECE):
        piece = data[start : start + PIECE + LENGTH - 1]
        hasher.read(piece)
        anchor = anchors(hasher, len(piece))
        step = (anchor - np.arange(len(anchor))) // size
        name = anchor * LENGTH + step
        low = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        high = np.r_[low[1:], len(name)] - 1
        last = anchor[low] - step[low] * size
        core, whole = fingerprints(hasher, last, low, high, size)
        # The step tells blocks of one core but different distance from their anchor apart.
        yield core ^ (step[low] * int(MIX[3] >> np.uint64(2))), whole, last + start, low + start, high + start


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def cores(documents: DataFrame, size: int) -> DataFrame:
    """The sampled suffixes of texts: one fingerprint per block."""
    schema = pa.schema([("core", pa.int64())])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in row_slices(batches, 128):
            found = [b[0] for text in batch.column(0).to_pylist() for b in blocks(text_bytes(text), hasher, size)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], schema=schema)

    return documents.select(F.col("text").cast("string")).mapInArrow(sample, "core long")


class SuffixFamily:
    """Sorted suffix arrays by rank, and the cores that were found more than once."""

    def __init__(self, spark: SparkSession, size: int = SIZES[0]) -> None:
        self.spark, self.size = spark, size
        self.levels: dict[int, DataFrame] = {}
        self.matches: list[DataFrame] = []

    def add(self, documents: DataFrame) -> DataFrame:
        """Index a batch; returns the cores it shares with itself or with earlier batches."""
        counted = cores(documents, self.size).groupBy("core").agg(F.count(F.lit(1)).alias("n"))
        array = materialize(counted.sortWithinPartitions("core"), "suffixes")
        found = array.where(F.col("n") > 1).select("core")
        for level in self.levels.values():
            found = found.union(array.select("core").join(level.select("core"), "core"))
        match = materialize(found.distinct(), "matches")
        self.matches.append(match)
        rank = 0
        while rank in self.levels:
            both = array.union(self.levels.pop(rank)).groupBy("core").agg(F.sum("n").alias("n"))
            array, rank = materialize(both.sortWithinPartitions("core"), "suffixes"), rank + 1
        self.levels[rank] = array
        return match

    def repeated(self) -> DataFrame:
        """All cores that occur more than once."""
        found = self.matches[0]
        for more in self.matches[1:]:
            found = found.union(more)
        return found.distinct()


#: ``times`` equal blocks in a row, as in a run of one letter, are one row: the first of them, up to window start ``end``.
BLOCK = "doc_id long, mark long, core long, whole long, last int, low int, high int, end int, times int, open boolean"
BLOCK_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("mark", pa.int64()), ("core", pa.int64()), ("whole", pa.int64()),
    ("last", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("end", pa.int32()), ("times", pa.int32()),
    ("open", pa.bool_()),
])


def runs(core: np.ndarray, whole: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks of one text with those that equal the block before taken together; adds end and times."""
    first = np.flatnonzero(np.r_[True, (core[1:] != core[:-1]) | (whole[1:] != whole[:-1])])
    times = np.diff(np.r_[first, len(core)])
    return core[first], whole[first], last[first], low[first], high[first], high[first + times - 1], times


def block_batch(docs: list, marks: list, sizes: list[int], columns: list[np.ndarray], is_open: list[bool]) -> pa.RecordBatch:
    """Rows of blocks from their columns and, per text, its name, number of blocks and state."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    spread = lambda values, kind: pa.array(values, kind).take(pa.array(of))
    core, whole, *places = columns
    return pa.RecordBatch.from_arrays(
        [spread(docs, pa.int64()), spread(marks, pa.int64()), pa.array(core), pa.array(whole)]
        + [pa.array(x.astype(np.int32)) for x in places] + [spread(is_open, pa.bool_())],
        schema=BLOCK_SCHEMA,
    )


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string"))


def all_blocks(documents: DataFrame, size: int) -> DataFrame:
    """Every block with the document and window starts it stands for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in row_slices(batches, 128):
            docs, marks, sizes, parts = [], [], [], []
            for doc_id, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found = [runs(*block) for block in blocks(text_bytes(text), hasher, size)]
                docs.append(doc_id)
                marks.append(mark)
                sizes.append(sum(len(f[0]) for f in found))
                parts += found
            if parts:
                yield block_batch(docs, marks, sizes, [np.concatenate(x) for x in zip(*parts)], [True] * len(docs))

    return keyed(documents).mapInArrow(cut, BLOCK)


def settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decide stored blocks: those that are open and whose whole string occurs twice, and one row per string left open.

    The second holds, for each core with an open string, that string and one witness of every other string.
    """
    row = F.struct("doc_id", "mark", "last", "low", "high")
    strings = materialize(
        rows.groupBy("core", "whole").agg(
            F.sum("times").alias("n"), F.max("open").alias("any_open"), F.min(row).alias("row")
        ),
        "strings",
    )
    twice = strings.where((F.col("n") > 1) & F.col("any_open")).select(F.col("core").alias("c"), F.col("whole").alias("w"))
    done = rows.where("open").join(twice, (F.col("core") == F.col("c")) & (F.col("whole") == F.col("w")), "left_semi")
    is_open = F.col("any_open") & (F.col("n") == 1)
    mixed = strings.groupBy("core").agg(F.count(F.lit(1)).alias("strings"), F.max(is_open).alias("has_open"))
    mixed = mixed.where((F.col("strings") > 1) & F.col("has_open")).select("core")
    left = strings.join(mixed, "core").select("row.*", is_open.alias("open"))
    return done.select("doc_id", "mark", "low", F.col("end").alias("high")), left


def same_text(a: str = "_id", b: str = "_mark"):
    return F.col("doc_id").eqNullSafe(F.col(a)) & (F.col("mark") == F.col(b))


def snippets(documents: DataFrame, left: DataFrame) -> DataFrame:
    """The whole strings of the given blocks, stored with them."""
    wanted = left.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("last", "low", "high", "open")).alias("blocks"))
    wanted = wanted.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "blocks")
    rows = keyed(documents).join(wanted, same_text()).select("doc_id", "mark", "text", "blocks")
    kind = "doc_id long, mark long, last int, low int, high int, open boolean, data binary"
    schema = pa.schema([*[f for f in BLOCK_SCHEMA if f.name not in ("core", "whole", "end", "times")], ("data", pa.binary())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 64):
            for doc_id, mark, text, found in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = text_bytes(text)
                cut = [(doc_id, mark, x["last"], x["low"], x["high"], x["open"], data[x["low"] : x["high"] + LENGTH].tobytes()) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*cut), schema, strict=True)], schema=schema
                )

    # Repeated rows of one document give a block more than once; it is one string.
    return materialize(rows.mapInArrow(take, kind).dropDuplicates(["doc_id", "mark", "last", "low", "high"]), "snippets")


def smaller_blocks(held: DataFrame, size: int) -> DataFrame:
    """Cut blocks (with their strings, and the starts ``from``..``to`` asked for) into blocks of ``size`` starts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in row_slices(batches, 1024):
            docs, marks, states, sizes, parts = [], [], [], [], []
            for doc_id, mark, last, base, low, high, is_open, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                hasher.read(np.frombuffer(data, np.uint8))
                step = (last - np.arange(low, high + 1)) // size
                first = np.flatnonzero(np.r_[True, step[1:] != step[:-1]])
                end = np.r_[first[1:], len(step)] - 1
                places, lows, highs = last - step[first] * size, first + low, end + low
                core, whole = fingerprints(hasher, places - base, lows - base, highs - base, size)
                core = core ^ (step[first] * int(MIX[3] >> np.uint64(2)))
                docs.append(doc_id)
                marks.append(mark)
                states.append(is_open)
                part = runs(core, whole, np.full(len(core), last), lows, highs)
                sizes.append(len(part[0]))
                parts.append(part)
            if parts:
                yield block_batch(docs, marks, sizes, [np.concatenate(x) for x in zip(*parts)], states)

    asked = held.select("doc_id", "mark", "last", "base", "low", "high", "open", "data")
    return materialize(asked.mapInArrow(cut, BLOCK), "blocks")


def repeated_windows(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Starts low..high of all windows that occur elsewhere: doc_id, mark, low, high; the parts do not overlap."""
    family = SuffixFamily(documents.sparkSession)
    for i in range(batches):
        family.add(documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    # Stored, so that the join below has two plain sides and a hot core can be split.
    matched = materialize(family.repeated().select(F.col("core").alias("c")), "repeated")
    rows = materialize(
        all_blocks(documents, SIZES[0]).join(matched, F.col("core") == F.col("c"), "left_semi"), "blocks"
    )
    done, left = settle(rows)
    found = done
    held = snippets(documents, left)
    asked = held.withColumn("base", F.col("low"))
    for size in SIZES[1:]:
        done, left = settle(smaller_blocks(asked, size))
        found = found.union(done)
        # A smaller block is looked up in the string of the block it was cut from.
        of = held.select(
            F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("last").alias("_last"),
            F.col("low").alias("base"), F.col("high").alias("top"), "data",
        )
        asked = left.join(
            of, same_text() & (F.col("last") == F.col("_last")) & (F.col("low") >= F.col("base")) & (F.col("high") <= F.col("top"))
        )
    return found


def remove_repeats(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans of every document."""
    windows = repeated_windows(documents, batches)
    spans = windows.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("low", "high")).alias("windows"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "windows")
    rows = keyed(documents).join(spans, same_text(), "left").select("doc_id", "text", "windows")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64()))),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 64):
            found = []
            for doc_id, text, parts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data, spans, kept, at = text_bytes(text).tobytes(), [], hashlib.sha256(), 0
                for low, high in sorted((x["low"], x["high"] + LENGTH) for x in parts or ()):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                for low, high in spans:
                    kept.update(data[at:low])
                    at = high
                kept.update(data[at:])
                found.append((doc_id, len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*found), schema, strict=True)] if found
                else [pa.array([], f.type) for f in schema], schema=schema,
            )

    return rows.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<bigint>>"
    )
