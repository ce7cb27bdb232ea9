"""Benchmark decontamination over a positional inverted index.

The index holds (term, document, position) postings of the training texts.
A benchmark window is looked up by its two rarest terms: the postings of the
rarest, moved back by its offset in the window, are the possible starts; they
are intersected with the moved postings of the second; what is left is compared
word by word. ``proximity_matches`` reads the same index for windows whose words
all lie close together in any order.

DataFrame functions only. Only postings that are asked for leave a task: terms
are counted with partial sums, and a stored list of terms filters the words where
they are read (broadcast while it stays within a counted bound, else by shuffle).
A document is named by id and text, so repeated ids keep apart.

Defined cases: null text or item has no words; an item with fewer words than a
window is one window, one without words none; equal windows of several items
are looked up once and count for each; a null item_id marks words but is not
listed; repeated rows each get their result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import ascii_lower, carried, same_key, small, split_words
from casebook.session import materialize

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCUMENT = ("doc_id", "mark")


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Distinct windows of the items, stored: window (64-bit name), words, items (ids as sorted strings)."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    rows = rows.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (length - 1)))
    cut = rows.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start"), F.lit(length)).alias("words")
    )
    distinct = cut.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return materialize(distinct.select(F.xxhash64("words").alias("window"), "words", "items"), "windows")


def texts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))


def positional_index(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (term, doc_id, mark, position) of the given terms, sorted by term in each file."""
    found = texts(documents).select(*DOCUMENT, F.posexplode("words").alias("position", "term"))
    postings = found.join(small(terms.select("term")), "term").select("term", *DOCUMENT, "position")
    return materialize(postings.sortWithinPartitions("term", *DOCUMENT, "position"), "postings")


def term_counts(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of the given terms occurs in the documents, zero included."""
    words = texts(documents).select(F.explode("words").alias("term"))
    counts = words.join(small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return materialize(terms.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n")), "counts")


def rarest_terms(cut: DataFrame, counts: DataFrame) -> DataFrame:
    """Per window that can occur: its rarest and second rarest term with their offsets, stored."""
    places = cut.select("window", F.posexplode("words").alias("offset", "term"))
    first = places.groupBy("window", "term").agg(F.min("offset").alias("offset")).join(counts, "term")
    ranked = first.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("terms"))
    one, two = F.col("terms")[0], F.coalesce(F.get("terms", F.lit(1)), F.col("terms")[0])
    return materialize(
        ranked.where(one["n"] > 0).select(
            "window", one["term"].alias("term"), one["offset"].alias("offset"),
            two["term"].alias("second"), two["offset"].alias("second_offset"),
        ),
        "anchors",
    )


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def possible_starts(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, mark, start, window) at which the two rarest terms of a window stand where it has them."""
    starts = (
        index.join(small(anchors), "term")
        .where(F.col("position") >= F.col("offset"))
        .select(*DOCUMENT, "window", (F.col("position") - F.col("offset")).alias("start"), "second", "second_offset")
    )
    seconds = renamed(index.join(small(anchors.select(F.col("second").alias("term")).distinct()), "term"), "_")
    return starts.join(
        seconds,
        same_key("_doc_id", "_mark")
        & (F.col("second") == F.col("_term"))
        & (F.col("start") + F.col("second_offset") == F.col("_position")),
        "left_semi",
    ).select(*DOCUMENT, "start", "window")


def examine(documents: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Input rows as the struct ``row``, with n_words, n_hit, hit_items (sorted) and contaminated."""
    cut = windows(items, length)
    counts = term_counts(documents, materialize(cut.select(F.explode("words").alias("term")).distinct(), "terms"))
    anchors = rarest_terms(cut, counts)
    terms = materialize(anchors.select("term").union(anchors.select("second")).distinct(), "asked")
    index = positional_index(documents, terms)
    possible = possible_starts(index, anchors).join(small(cut), "window")
    by_document = possible.groupBy(*DOCUMENT).agg(F.collect_set(F.struct("start", "words", "items")).alias("possible"))
    mine = renamed(by_document, "_")

    rows = carried(documents, documents["text"].alias("text"))
    rows = rows.join(mine, same_key("_doc_id", "_mark"), "left").select("row", "_possible", words_of(F.col("text")).alias("words"))
    words = F.col("words")
    nothing = F.array().cast("array<struct<start:int,words:array<string>,items:array<string>>>")
    same = lambda x: F.slice(words, x["start"] + 1, F.size(x["words"])) == x["words"]
    rows = rows.select(
        "row", F.size("words").cast("long").alias("n_words"),
        F.array_sort(F.filter(F.coalesce("_possible", nothing), same)).alias("hits"),
    )
    # Windows in order of their starts: each adds the words behind the furthest end so far.
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["start"] + F.size(x["words"]) - F.greatest(x["start"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["start"] + F.size(x["words"])).alias("end"),
        ),
        lambda s: s["n"].cast("long"),
    )
    hit_items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["items"]))))
    return rows.select(
        "row", "n_words", covered.alias("n_hit"), hit_items.alias("hit_items"), (F.size("hits") > 0).alias("contaminated")
    )


def contamination(documents: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    found = examine(documents.select("doc_id", "text"), items, length)
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated",
    )


def keep_clean(documents: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The input rows in which no window of an item occurs."""
    return examine(documents, items, length).where(~F.col("contaminated")).select("row.*")


def proximity_matches(index: DataFrame, cut: DataFrame, anchors: DataFrame, slack: int) -> DataFrame:
    """Places where all terms of a window lie within its length plus ``slack`` words of its rarest one.

    ``index`` must hold every term of the windows. Returns doc_id, mark, window,
    position (of the rarest term). Positions meet by buckets of the reach, so the
    join is on document, term and bucket.
    """
    terms = cut.select("window", F.explode(F.array_distinct("words")).alias("needed"), F.size("words").alias("n"))
    reach = F.col("n") + F.lit(slack - 1)
    centres = index.join(small(anchors.select("term", "window")), "term").select(*DOCUMENT, "position", "window")
    asked = centres.join(small(terms), "window").select(
        *DOCUMENT, "position", "window", "needed", reach.alias("reach")
    )
    widest = (cut.agg(F.max(F.size("words"))).first()[0] or 1) + slack
    bucket = lambda at: F.floor(at / widest).cast("long")
    asked = asked.withColumn("bucket", F.explode(F.array(*[bucket(F.col("position")) + i for i in (-1, 0, 1)])))
    held = renamed(index.withColumn("bucket", bucket(F.col("position"))), "_")
    near = asked.join(
        held,
        same_key("_doc_id", "_mark") & (F.col("needed") == F.col("_term")) & (F.col("bucket") == F.col("_bucket"))
        & (F.abs(F.col("position") - F.col("_position")) <= F.col("reach")),
    )
    met = near.select(*DOCUMENT, "window", "position", "needed").distinct()
    met = met.groupBy(*DOCUMENT, "window", "position").agg(F.count(F.lit(1)).alias("n_terms"))
    sizes = cut.select("window", F.size(F.array_distinct("words")).alias("n_needed"))
    return met.join(sizes, "window").where(F.col("n_terms") == F.col("n_needed")).select(*DOCUMENT, "window", "position")
