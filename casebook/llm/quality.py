"""Quality rules: fixed limits, then robust outliers of each language and source.

Statistics of a text (words, characters, symbols, repeated lines and passages)
become five transformed measures. Per language and source, a minimum-covariance-
determinant estimate is sought by concentration from four starts: medians with absolute
deviations, all rows, rows drawn in by a hyperbolic tangent, and directions
from the medians alone. A step keeps the ``held`` share of rows with the least distance
and takes their mean and covariance; a start is left when its determinant no longer falls
by ``settled`` (in logarithm), and since the floors bound it from below, each is. The
least determinant of all starts counts; the rows that it finds ordinary (chi-squared
up to ``ordinary``) give the final mean and covariance. Rows whose squared Mahalanobis
distance passes ``cutoff`` are rejected.

DataFrame functions only. A row's statistics need no shuffle: repeated three-word
windows are found in a sorted array of the text's own windows. Every step over
groups is a partial aggregation of the narrow statistics table; quantiles come
from counts of fine bins, so a hot source is only ever counted, and results do
not depend on the order of rows. Distances use a Cholesky factor written out as
column arithmetic on one row per group.

A source with fewer than ``least_rows`` rows is judged by an estimate from all rows
of its language, large sources included, and if those are still too few, by one
from all rows. Each row gets one verdict. ``floors`` are standard deviations added to
every measure, so that a measure that hardly varies in a group cannot reject
ordinary texts.

Defined cases: null or empty text has no words and fails the limits; a very long text is
one row with its counts; null language or source counts as the empty name; repeated rows
each count; rows at the same distance are held or left together, and of starts with equal
determinants (to six digits) the first in the order above counts; an empty table gives an
empty result; other columns are kept by ``keep_good`` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.llm.common import carried, same_key, small, split_words
from casebook.session import materialize

SYMBOLS = "#*$%&|<>"
BLANK_CHARACTERS = " \t\n\x0b\f\r"
MEASURES = ("m0", "m1", "m2", "m3", "m4")
GROUP = ("g", "start")
FACTORS = [f"c{i}" for i in range(len(MEASURES))] + [f"w{i}{j}" for i in range(len(MEASURES)) for j in range(i + 1)]
#: Median of the chi-squared distribution with five degrees of freedom.
CHI_MEDIAN = 4.351


@dataclass(frozen=True)
class Rule:
    least_words: int = 50
    most_repeat_percent: int = 50
    held: float = 0.75
    settled: float = 1e-4
    #: Chi-squared with five degrees of freedom is above this once in forty.
    ordinary: float = 12.833
    #: Chi-squared with five degrees of freedom is above this once in ten million.
    cutoff: float = 41.0
    least_rows: int = 50
    floors: tuple[float, ...] = (0.5, 0.05, 0.05, 0.15, 0.15)

    def __post_init__(self) -> None:
        if self.settled <= 0:
            raise ValueError("settled must be above 0, so that every start ends")


def with_statistics(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: doc_id, mark, lang, source, counts of its text and ``base_failed``."""
    # Every array is a column of its own before it is looked into, so no lambda builds it again.
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = documents.select("doc_id", F.xxhash64("text").alias("mark"), "lang", "source", F.col("text").alias("_text"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda characters: F.char_length(F.translate(text, characters, ""))
    counted = rows.select(
        "doc_id", "mark", "lang", "source",
        without(BLANK_CHARACTERS).cast("long").alias("word_chars"),
        (F.char_length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        split_words(F.col("_text")).alias("_words"),
    )
    counted = counted.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_lines")
    words, last = F.col("_words"), F.size("_words") - 3
    key = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    empty = F.array().cast("array<bigint>")
    counted = counted.withColumn(
        "_keys", F.when(last < 1, empty).otherwise(F.transform(F.sequence(F.lit(0), last), key))
    ).drop("_words")
    keys = F.col("_keys")
    # Windows in hash order, with their places; only texts that repeat one are sorted.
    counted = counted.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct(keys)) < F.size(keys),
            F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop("_keys")
    near = F.col("_sorted")
    twice = F.filter(
        near, lambda x, i: (F.get(near, i - 1)["h"] == x["h"]) | (F.get(near, i + 1)["h"] == x["h"])
    )
    counted = counted.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_sorted")
    # A window at x covers three words; those up to the last window's end are counted already.
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, x: F.struct((s["n"] + F.least(F.lit(3), x - s["last"])).alias("n"), x.alias("last")),
        lambda s: s["n"],
    )
    counted = counted.withColumn("n_repeat_words", covered.cast("long")).drop("_starts")
    n = F.col("n_words")
    failed = (n < rule.least_words) | (100 * F.col("n_repeat_words") > rule.most_repeat_percent * n)
    return counted.withColumn("base_failed", failed)


def measures() -> list[Column]:
    """Transformed statistics: length, word length, and shares of symbols, repeated lines and repeated words."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda part, whole: F.sqrt(F.col(part) / F.greatest(whole, F.lit(1)))
    return [
        F.ln(words), F.ln(F.greatest(F.col("word_chars"), F.lit(1)) / words), share("n_symbols", F.col("word_chars")),
        share("n_dup_lines", F.col("n_lines")), share("n_repeat_words", words),
    ]


def at_share(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Per key the first bin at which ``share`` of the rows is reached; one row per key, ``at``."""
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy(*keys)
    running = F.sum("n").over(window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("n").over(window)
    return counts.select(*keys, "bin", running.alias("upto"), whole.alias("of")).where(
        F.col("upto") >= share * F.col("of")
    ).groupBy(*keys).agg(F.min("bin").alias("at"))


def factors(found: DataFrame) -> DataFrame:
    """Per group g and start: ``volume`` (log determinant), centre c0… and the inverse w of the covariance's Cholesky factor.

    Each entry is a column of its own, so that the arithmetic stays as small as it is by hand.
    """
    d = len(MEASURES)
    col = lambda name, i, j: F.col(f"{name}{i}{j}")
    less = lambda first, terms: reduce(lambda s, t: s - t, terms, first)
    for j in range(d):
        rest = less(F.col(f"v{j}{j}"), [col("l", j, k) * col("l", j, k) for k in range(j)])
        found = found.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))))
        found = found.withColumns({
            f"l{i}{j}": less(F.col(f"v{j}{i}"), [col("l", i, k) * col("l", j, k) for k in range(j)]) / col("l", j, j)
            for i in range(j + 1, d)
        }) if j + 1 < d else found
    for gap in range(d):
        found = found.withColumns({
            f"w{j + gap}{j}": less(
                F.lit(0.0 if gap else 1.0), [col("l", j + gap, k) * col("w", k, j) for k in range(j, j + gap)]
            ) / col("l", j + gap, j + gap)
            for j in range(d - gap)
        })
    volume = reduce(lambda s, t: s + t, [2 * F.ln(f"l{i}{i}") for i in range(d)])
    return found.select(*GROUP, volume.alias("volume"), *FACTORS)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of m0…m4, with the group's factors joined."""
    solved = [
        reduce(lambda s, t: s + t, [F.col(f"w{i}{j}") * (F.col(f"m{j}") - F.col(f"c{j}")) for j in range(i + 1)])
        for i in range(len(MEASURES))
    ]
    return reduce(lambda s, y: s + y * y, solved[1:], solved[0] * solved[0])


PAIRS = [(i, j) for i in range(len(MEASURES)) for j in range(i, len(MEASURES))]
BIN = 0.01


def log_bin(value: Column) -> Column:
    return F.floor(F.ln(value + F.lit(1e-6)) / F.lit(BIN)).cast("long")


def with_groups(rows: DataFrame, rule: Rule) -> DataFrame:
    """Add ``g``, the group that judges a row, and ``feeds``, the groups that its source helps to estimate."""
    name = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.withColumns({"_lang": name("lang"), "_source": name("source")})
    sizes = rows.where(~F.col("base_failed")).groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes, "sizes")
    langs = sizes.groupBy("_lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    few = langs.agg(F.coalesce(F.max(F.col("n_lang") < rule.least_rows), F.lit(False)).alias("few"))
    label = lambda level, *parts: F.concat_ws("\u0001", F.lit(level), *parts)
    enough = F.col("n") >= rule.least_rows
    own, lang, whole = label("0", F.col("_lang"), F.col("_source")), label("1", F.col("_lang")), label("2")
    by_lang = (F.col("n_lang") >= rule.least_rows) & (F.col("least") < rule.least_rows)
    groups = sizes.join(langs, "_lang").crossJoin(F.broadcast(few)).select(
        "_lang", "_source",
        F.when(enough, own).when(F.col("n_lang") >= rule.least_rows, lang).otherwise(whole).alias("g"),
        F.array_compact(F.array(F.when(enough, own), F.when(by_lang, lang), F.when(F.col("few"), whole))).alias("feeds"),
    )
    groups = small(materialize(groups, "groups"))
    return rows.join(groups, ["_lang", "_source"], "left").drop("_lang", "_source")


def fitted(rows: DataFrame, rule: Rule) -> DataFrame:
    """Factors of the mean and the covariance of the rows of each group and start."""
    moments = [F.avg(m).alias(f"c{i}") for i, m in enumerate(MEASURES)]
    moments += [
        (F.covar_pop(MEASURES[i], MEASURES[j]) + (rule.floors[i] ** 2 if i == j else 0.0)).alias(f"v{i}{j}") for i, j in PAIRS
    ]
    return factors(rows.groupBy(*GROUP).agg(*moments))


def starts(good: DataFrame, rule: Rule) -> DataFrame:
    """The four first estimates of each group."""
    d = len(MEASURES)
    long = good.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(m).alias("x")) for i, m in enumerate(MEASURES)])).alias("e"))
    long = long.select("g", "e.k", "e.x")
    middle = lambda rows, value: at_share(rows.withColumn("bin", F.floor(value / BIN).cast("long")), ["g", "k"], 0.5)
    medians = small(materialize(middle(long, F.col("x")).select("g", "k", ((F.col("at") + 0.5) * BIN).alias("med")), "medians"))
    apart = middle(long.join(medians, ["g", "k"]), F.abs(F.col("x") - F.col("med")))
    spread = medians.join(apart, ["g", "k"]).withColumn("sd", 1.4826 * (F.col("at") + 0.5) * BIN)
    pick = lambda i, c: F.max(F.when(F.col("k") == i, F.col(c)))
    robust = spread.groupBy("g").agg(
        *[pick(i, "med").alias(f"c{i}") for i in range(d)],
        *[F.sqrt(pick(i, "sd") * pick(i, "sd") + rule.floors[i] ** 2).alias(f"s{i}") for i in range(d)],
    )
    robust = small(materialize(robust, "robust"))
    alone = factors(robust.select(
        "g", F.lit(0).alias("start"), *[f"c{i}" for i in range(d)],
        *[(F.col(f"s{i}") * F.col(f"s{i}") if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i, j in PAIRS],
    ))
    rows = good.join(robust, "g")
    rows = rows.withColumns({f"z{i}": (F.col(f"m{i}") - F.col(f"c{i}")) / F.col(f"s{i}") for i in range(d)})
    length = F.sqrt(reduce(lambda s, t: s + t, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(d)]) + F.lit(1e-12))
    rows = rows.withColumn("_length", length / d**0.5)
    moved = lambda start, place: F.struct(F.lit(start).alias("start"), *[place(i).alias(m) for i, m in enumerate(MEASURES)])
    drawn = rows.select("g", F.explode(F.array(
        moved(1, lambda i: F.col(f"m{i}")),
        moved(2, lambda i: F.col(f"c{i}") + F.col(f"s{i}") * F.tanh(f"z{i}")),
        moved(3, lambda i: F.col(f"c{i}") + F.col(f"s{i}") * F.col(f"z{i}") / F.col("_length")),
    )).alias("e"))
    return alone.unionByName(fitted(drawn.select("g", "e.*"), rule))


def least_determinants(good: DataFrame, rule: Rule) -> DataFrame:
    """Per group g the settled estimate with the least determinant: start, volume and factors."""

    def concentrated(found: DataFrame) -> DataFrame:
        near = good.join(found.select(*GROUP, *FACTORS), "g").withColumn("bin", log_bin(squared_distance()))
        near = near.select(*GROUP, *MEASURES, "bin")
        limits = small(materialize(at_share(near, [*GROUP], rule.held), "limits"))
        return fitted(near.join(limits, [*GROUP]).where(F.col("bin") <= F.col("at")), rule)

    first = small(materialize(starts(good, rule), "starts"))
    going = small(materialize(concentrated(first), "held"))
    ended = []
    while not going.isEmpty():
        before = going.select(*GROUP, *[F.col(c).alias(f"_{c}") for c in ("volume", *FACTORS)])
        falls = F.col("volume") < F.col("_volume") - rule.settled
        taken = [F.when(falls, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in ("volume", *FACTORS)]
        step = materialize(concentrated(going).join(before, [*GROUP]).select(*GROUP, falls.alias("falls"), *taken), "held")
        ended.append(step.where(~F.col("falls")).drop("falls"))
        going = small(step.where("falls").drop("falls"))
    whole = reduce(DataFrame.unionByName, ended) if ended else going
    chosen = F.min_by(F.struct("start", "volume", *FACTORS), F.struct(F.round("volume", 6), F.col("start")))
    return whole.groupBy("g").agg(chosen.alias("e")).select("g", "e.*")


def scaled(good: DataFrame, found: DataFrame) -> DataFrame:
    """Add the ``scale`` that makes a group's median distance what it should be; never below 1."""
    apart = at_share(good.join(found, "g").withColumn("bin", log_bin(squared_distance())), ["g"], 0.5)
    scale = F.greatest(F.lit(1.0), F.exp((F.col("at") + 0.5) * BIN) / CHI_MEDIAN)
    return found.join(apart.select("g", scale.alias("scale")), "g")


def estimates(good: DataFrame, rule: Rule) -> DataFrame:
    """Per group g: factors of the centre and covariance of its ordinary rows, and their ``scale``."""
    least = small(materialize(least_determinants(good, rule), "least"))
    least = small(materialize(scaled(good, least), "scaled"))
    ordinary = good.join(least, "g").where(squared_distance() <= rule.ordinary * F.col("scale")).select(*GROUP, *MEASURES)
    found = small(materialize(fitted(ordinary, rule), "ordinary"))
    return materialize(scaled(good, found).drop("start", "volume"), "estimates")


def verdicts(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Statistics of every document, ``distance`` from its group (null where the limits failed), and ``kept``."""
    stored = materialize(with_statistics(documents, rule), "statistics")
    rows = stored.select("*", *[m.alias(name) for m, name in zip(measures(), MEASURES, strict=True)])
    rows = materialize(with_groups(rows, rule), "measured")
    found = small(estimates(rows.where(~F.col("base_failed")).select(F.explode("feeds").alias("g"), *MEASURES), rule))
    distance = F.when(~F.col("base_failed"), squared_distance() / F.col("scale"))
    return (
        rows.join(found, "g", "left")
        .withColumn("distance", distance)
        .withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= rule.cutoff))
        .select(*stored.columns, "distance", "kept")
    )


def keep_good(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The input rows that the limits and the estimates keep."""
    good = verdicts(documents, rule).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("lang").alias("_lang"), F.col("source").alias("_source")
    ).distinct()
    rows = carried(documents, documents["lang"].alias("lang"), documents["source"].alias("source"))
    same = same_key("_id", "_mark")
    for c in ("lang", "source"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(good, same, "left_semi").select("row.*")
