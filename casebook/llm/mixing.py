"""Mixing sources to target weights by a temperature.

A source with token share s gets the weight s**a / sum(s**a). At a = 1 sources
keep their shares, at a = 0 all are equal. The exponent is bisected: the largest
one whose weights reach the target entropy, raised further if a source would be
repeated more often than allowed. The weights become token quotas of the budget,
and each source fills its quota from seeded permutations of its documents, one
per pass; quotas are cut evenly over the blocks, so every block has the mix.

Main path is DataFrame functions only. Per-source totals are pre-aggregated and
stored; each bisection step is one aggregation over them, four halvings at once.
Running totals come from ``ordering.running_total`` (range partitions, no
one-task window, no window over a hot source).

Defined cases: null text has no tokens; documents without tokens are not drawn;
a null source is a source of its own; rows that repeat one id, source and text
are drawn together; without any token, the result is empty; other input columns
are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import carried, same_key
from casebook.operators.ordering import running_total
from casebook.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
HALVINGS = 4
PASSES = 8


@dataclass(frozen=True)
class Target:
    """``entropy``: share of the largest possible entropy; ``repetition``: passes over a source at most."""

    entropy: float = 0.98
    repetition: float = 4.0
    budget: int | None = None  # tokens; None: as many as the corpus has
    block: int = 1 << 20  # tokens
    seed: int = 17


def token_table(documents: DataFrame) -> DataFrame:
    """doc_id, source, mark of the text, tokens, written once; repeated rows are one entry with summed tokens."""
    n = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = documents.select("doc_id", "source", F.xxhash64("text").alias("mark"), n.alias("n"))
    return materialize(
        rows.where(F.col("n") > 0).groupBy("doc_id", "source", "mark").agg(F.sum("n").alias("n_tokens")), "tokens"
    )


def bisect_exponent(totals: DataFrame, target: Target) -> float:
    """The exponent for stored per-source totals (source, total)."""
    first = totals.agg(F.sum("total"), F.count(F.lit(1))).first()
    whole, sources = first[0], first[1]
    if not whole or sources < 2:
        return 1.0
    budget = target.budget or whole
    share = F.col("total") / F.lit(float(whole))

    def measure(exponents: list[float]) -> list[tuple[float, float]]:
        """Entropy share and largest repetition for each exponent, in one pass."""
        cells: list[Column] = []
        for a in exponents:
            cells += [F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.ln(share)), F.max(F.pow(share, F.lit(a - 1)))]
        row = totals.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).first()
        found = []
        for i, a in enumerate(exponents):
            z, weighted, most = row[3 * i : 3 * i + 3]
            found.append(((math.log(z) - a * weighted / z) / math.log(sources), most * budget / (z * whole)))
        return found

    def smallest(ends_low: bool, holds) -> float:
        """Bisect [0, 1] for the border of a condition that holds on one side."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            steps = 1 << HALVINGS
            grid = [low + (high - low) * i / steps for i in range(1, steps)]
            answers = [holds(m) for m in measure(grid)]
            left, right = 0, steps
            while right - left > 1:
                middle = (left + right) // 2
                if answers[middle - 1] == ends_low:
                    left = middle
                else:
                    right = middle
            low, high = low + (high - low) * left / steps, low + (high - low) * right / steps
        return low if ends_low else high

    (entropy, repetition), = measure([1.0])
    exponent = 1.0
    if entropy < target.entropy:
        # The entropy falls as the exponent grows: it is reached from 0 up to the border.
        exponent = smallest(True, lambda m: m[0] >= target.entropy)
    (_, repetition), = measure([exponent])
    if repetition > target.repetition:
        # The repetition falls as the exponent grows; at 1 it is budget / whole everywhere.
        exponent = max(exponent, smallest(False, lambda m: m[1] <= target.repetition))
    return exponent


def weights(totals: DataFrame, target: Target) -> DataFrame:
    """source, total, weight, quota of the budget in tokens."""
    a = bisect_exponent(totals, target)
    sums = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("whole")).first()[0]
    power = F.pow(F.col("total") / F.lit(float(sums or 1)), F.lit(a))
    z = totals.agg(F.sum(power)).first()[0] or 1.0
    budget = float(target.budget or sums)
    return totals.select(
        "source", "total", (power / F.lit(z)).alias("weight"), (power / F.lit(z) * F.lit(budget)).alias("quota")
    )


def mix(documents: DataFrame, target: Target = Target()) -> DataFrame:
    """One row per drawn copy: doc_id, source, mark, n_tokens, weight, pass, block, place.

    ``pass`` counts a source's passes from 0, ``block`` the blocks of the output,
    ``place`` orders the copies of a block. A copy is drawn while its source's
    tokens before it are below the quota, so a quota is passed by less than one document.
    """
    tokens = token_table(documents)
    totals = materialize(tokens.groupBy("source").agg(F.sum("n_tokens").alias("total")), "totals")
    quotas = materialize(weights(totals, target), "weights").withColumnRenamed("source", "from")
    spent = quotas.agg(F.sum("quota")).first()[0] or 0.0
    blocks = max(1, math.ceil(spent / target.block))
    passes = F.ceil(F.col("quota") / F.col("total")).cast("int")
    copies = (
        tokens.join(quotas, F.col("source").eqNullSafe(F.col("from")))
        .drop("from")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(passes - 1, F.lit(0)))))
        .withColumn("_turn", F.xxhash64(F.lit(target.seed), "pass", "doc_id", "mark"))
    )
    order = ["source", "pass", "_turn", "doc_id", "mark"]
    ordered = materialize(running_total(copies, order, "_upto", F.col("n_tokens")), "ordered")
    starts = ordered.groupBy("source").agg(F.min(F.col("_upto") - F.col("n_tokens")).alias("_base"))
    starts = starts.withColumnRenamed("source", "from")
    before = F.col("_upto") - F.col("n_tokens") - F.col("_base")
    block = F.least(F.floor(before * F.lit(blocks) / F.col("quota")), F.lit(blocks - 1)).cast("long")
    return (
        ordered.join(starts, F.col("source").eqNullSafe(F.col("from")))
        .where(before < F.col("quota"))
        .select(
            "doc_id", "source", "mark", "n_tokens", "weight", "pass", block.alias("block"),
            F.xxhash64(F.lit(target.seed + 1), block, "pass", "doc_id", "mark").alias("place"),
        )
    )


def mix_rows(documents: DataFrame, target: Target = Target()) -> DataFrame:
    """The drawn documents with the columns of the input, once per copy."""
    drawn = mix(documents, target).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("source").alias("_source")
    )
    rows = carried(documents, documents["source"].alias("source"))
    same = same_key("_id", "_mark") & F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(drawn, same).select("row.*")
