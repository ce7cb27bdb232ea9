"""Fill-in-middle transformation by in-place block rotation, and its exact inverse.

A text is cut into prefix, middle and suffix between tokens. Sentinels are
inserted into one bytearray, and segments change places inside it by rotations
made of three reversals, so a text of any length needs one buffer and a fixed
scratch block. The inverse finds the sentinels, rotates back and takes them out.

Everything is a function of the row alone: no shuffle, no state, and a lost task
repeats itself exactly. The hash of seed and doc_id decides cuts and form.

Defined cases: null text counts as empty, an empty text or one that holds a
sentinel stays plain (n is its number of tokens all the same); a text of one
token can have empty parts; a null doc_id is hashed as no digits; repeated rows
each get their equal result; very long texts are handled whole; only doc_id and
text are read, so extra columns of any name play no part and are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casebook.llm.common import row_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
SCRATCH = 1 << 16


@dataclass(frozen=True)
class Rule:
    """``rotated`` of 100 texts change form, ``suffix_first`` of 100 of those put the suffix first."""

    seed: int = 42
    rotated: int = 50
    suffix_first: int = 80


def token_ends(data: bytes) -> np.ndarray:
    """End offsets of tokens: blanks and the run of other bytes behind them; blanks at the end are one more.

    Blanks are ASCII, so bytes and code points give the same tokens.
    """
    if not data:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(data, np.uint8)
    blank = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    last = np.empty(len(codes), bool)
    last[-1] = True
    np.logical_and(~blank[:-1], blank[1:], out=last[:-1])
    return np.flatnonzero(last) + 1


def reverse(view: np.ndarray, start: int, end: int) -> None:
    """Reverse view[start:end] in place, block by block from both ends."""
    while end - start > 1:
        n = min(SCRATCH, (end - start) // 2)
        head = view[start : start + n].copy()
        view[start : start + n] = view[end - n : end][::-1]
        view[end - n : end] = head[::-1]
        start, end = start + n, end - n


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange buffer[start:cut] and buffer[cut:end] in place by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, start, cut)
    reverse(view, cut, end)
    reverse(view, start, end)


def arrange(data: bytes, low: int, high: int, form: str) -> bytearray:
    """The bytes with sentinels, in the order of the form; parts end at ``low`` and ``high``."""
    buffer = bytearray(data)
    buffer[high:high] = SUFFIX
    buffer[low:low] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = low + len(PREFIX), high + len(PREFIX) + len(MIDDLE)
    if form == "psm":
        rotate(buffer, middle, suffix, len(buffer))
    else:
        rotate(buffer, 0, suffix, len(buffer))
    return buffer


def straighten(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given, from its output and form alone."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    size = len(buffer)
    if form == "psm":
        suffix, middle = buffer.find(SUFFIX), buffer.find(MIDDLE)
        rotate(buffer, suffix, middle, size)
        middle, suffix = suffix, suffix + size - middle
    else:
        prefix, middle = buffer.find(PREFIX), buffer.find(MIDDLE)
        rotate(buffer, 0, prefix, size)
        middle, suffix = middle - prefix, size - prefix
    del buffer[suffix : suffix + len(SUFFIX)]
    del buffer[middle : middle + len(MIDDLE)]
    del buffer[0 : len(PREFIX)]
    return bytes(buffer)


def transform(doc_id: int | None, text: str | None, rule: Rule) -> tuple[int, str, int | None, int | None, str]:
    """(number of tokens, form, code points of prefix and middle, output) of one text."""
    data = (text or "").encode()
    ends = token_ends(data)
    key = f"{rule.seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(ends)
    if not data or h3 % 100 >= rule.rotated or any(s in data for s in SENTINELS):
        return n, "plain", None, None, data.decode()
    form = "spm" if h4 % 100 < rule.suffix_first else "psm"
    low, high = (int(ends[i - 1]) if i else 0 for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    points = lambda part: len(part.decode())
    return n, form, points(data[:low]), points(data[low:high]), arrange(data, low, high, form).decode()


FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars and the output text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            ids, texts = batch.column(0), batch.column(1)
            rows = [transform(i.as_py(), t.as_py(), rule) for i, t in zip(ids, texts)]
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    source = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"))
    return source.mapInArrow(run, FIELDS)


def restore(rotated: DataFrame) -> DataFrame:
    """Add ``restored``, the exact text rebuilt from ``output`` and ``form``, to the rows of ``fill_in_middle``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            outputs, forms = batch.column("output"), batch.column("form")
            texts = [straighten(o.as_py().encode(), f.as_py()).decode() for o, f in zip(outputs, forms)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "restored"]
            )

    return rotated.mapInArrow(run, FIELDS + ", restored string")
