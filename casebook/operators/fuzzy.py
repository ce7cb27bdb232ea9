"""Near-duplicate names by edit distance, without comparing all pairs.

Two indexes serve all searches, and neither loses a pair.

*Edit keys*, for up to two edits. A key of a name is what is left when some characters
are deleted and some are replaced by a mark. Two names within k edits share a key
for which deletions on both sides and marks add up to their distance, and a shared
key with such a sum proves the distance. So a match needs no verification, and who
wants the nearest or the first partner only needs the first name of each key: a
name meets as many rows as it has keys, however many names resemble it.

*Prefix tree*, for more edits or long names. Names hang below their prefixes of
growing length. A search goes down level by level by joins and leaves out nodes
that no prefix of the wanted name is close to, whose names are all too short or too
long, or whose first name comes after a partner known already.

Searches run in rounds: who is matched leaves, so only the rest goes on to more edits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casebook.operators.ordering import first_per_key
from casebook.session import materialize

#: Stands for a replaced character in a key. A noncharacter; in names it counts as U+FFFD.
MARK = "\uffff"
#: A name has about 2 n² keys for two edits; longer ones are found in the tree.
KEYED = 32
#: Prefix lengths of the tree's levels.
CUTS = (1, 3, 5, 8, 12, 18)


# Edit keys


def edit_keys(text: Column, k: int) -> Column:
    """Distinct (key, gone, marks): up to k characters deleted or marked."""
    name = F.translate(text, MARK, "\ufffd")
    n = F.length(name)
    none = F.array().cast("array<struct<key:string,gone:int,marks:int>>")

    def piece(first: Column, last: Column) -> Column:
        return F.substring(name, first, last - first + 1)

    def entry(key: Column, gone: int, marks: int) -> Column:
        return F.struct(key.alias("key"), F.lit(gone).alias("gone"), F.lit(marks).alias("marks"))

    def once(i: Column) -> Column:
        before, after = piece(F.lit(1), i - 1), piece(i + 1, n)
        return F.array(entry(F.concat(before, after), 1, 0), entry(F.concat(before, F.lit(MARK), after), 0, 1))

    def twice(i: Column) -> Column:
        before = piece(F.lit(1), i - 1)

        def at(j: Column) -> Column:
            between, after = piece(i + 1, j - 1), piece(j + 1, n)
            return F.array(
                entry(F.concat(before, between, after), 2, 0),
                entry(F.concat(before, between, F.lit(MARK), after), 1, 1),
                entry(F.concat(before, F.lit(MARK), between, after), 1, 1),
                entry(F.concat(before, F.lit(MARK), between, F.lit(MARK), after), 0, 2),
            )

        later = F.when(i < n, F.transform(F.sequence(i + 1, n), at))
        return F.coalesce(F.flatten(later), none)

    spots = F.when(n > 0, F.sequence(F.lit(1), n))
    found = F.array(entry(name, 0, 0))
    for step in (once, twice)[:k]:
        found = F.concat(found, F.coalesce(F.flatten(F.transform(spots, step)), none))
    return F.array_distinct(found)


def keyed(df: DataFrame, text: str, k: int, longest: int) -> DataFrame:
    """One row per edit key of every name of up to ``longest`` characters."""
    return df.where(F.length(text) <= longest).select("*", F.inline(edit_keys(F.col(text), k)))


def key_table(names: DataFrame, text: str, k: int, longest: int) -> DataFrame:
    """The edit keys of the distinct names alone: (text, key, gone, marks)."""
    return keyed(names.select(text).distinct(), text, k, longest)


def met_by_keys(left: DataFrame, right: DataFrame, k: int, block: Sequence[str] = ()) -> DataFrame:
    """(l_id, edits, r_order): for every left row and key the first right row of the block that shares the key.

    A name's keys are made once, however many rows hold it.
    """
    asked = key_table(left, "l_text", k, KEYED)
    held = key_table(right, "r_text", k, KEYED + k)
    # Most keys occur on one side only; those go before names meet the rows that hold them.
    shared = materialize(held.join(asked.select("key", "marks").distinct(), ["key", "marks"], "left_semi"), "keys")
    index = (
        shared.join(right.select("r_text", "r_order", *block), "r_text")
        .groupBy(*block, "key", "marks", F.col("gone").alias("added"))
        .agg(F.min("r_order").alias("r_order"))
    )
    probes = asked.join(shared.select("key", "marks").distinct(), ["key", "marks"], "left_semi")
    probes = probes.join(left.select("l_id", "l_text", *block), "l_text")
    edits = F.col("gone") + F.col("added") + F.col("marks")
    met = probes.join(index, [*block, "key", "marks"]).where(edits <= k)
    return met.select("l_id", edits.alias("edits"), "r_order")


def best_by_keys(left: DataFrame, right: DataFrame, k: int, block: Sequence[str] = ()) -> DataFrame:
    """(l_id, distance, r_order): the nearest right row within k <= 2 edits of each left row that has one, first by order.

    Left names of more than ``KEYED`` characters are not looked for.
    """
    met = met_by_keys(left, right, k, block)
    # One minimum per distance: numbers alone, so the aggregation hashes and does not sort.
    firsts = met.groupBy("l_id").agg(*[F.min(F.when(F.col("edits") == d, F.col("r_order"))).alias(f"_{d}") for d in range(k + 1)])
    distance = F.coalesce(*[F.when(F.col(f"_{d}").isNotNull(), F.lit(d)) for d in range(k + 1)])
    return firsts.select("l_id", distance.alias("distance"), F.coalesce(*[f"_{d}" for d in range(k + 1)]).alias("r_order"))


def pairs_by_keys(left: DataFrame, right: DataFrame, k: int, block: Sequence[str] = ()) -> DataFrame:
    """All pairs within k <= 2 edits with a left name of up to ``KEYED`` characters, a pair once per shared key."""
    index = keyed(right, "r_text", k, KEYED + k).withColumnRenamed("gone", "added")
    probes = keyed(left, "l_text", k, KEYED)
    met = probes.join(index, [*block, "key", "marks"]).where(F.col("gone") + F.col("added") + F.col("marks") <= k)
    return met.drop("key", "marks", "gone", "added")


# Prefix tree


def prefix_tree(right: DataFrame, block: Sequence[str] = ()) -> DataFrame:
    """Nodes (block, level, parent, node) with the first order and the shortest and longest name below; stored."""
    steps = [
        F.struct(
            F.lit(level).alias("level"),
            F.substring("r_text", 1, CUTS[level - 1] if level else 0).alias("parent"),
            F.substring("r_text", 1, cut).alias("node"),
        )
        for level, cut in enumerate(CUTS)
    ]
    paths = right.select(*block, "r_order", F.length("r_text").alias("_n"), F.inline(F.array(*steps)))
    nodes = paths.groupBy(*block, "level", "parent", "node").agg(
        F.min("r_order").alias("least"), F.min("_n").alias("shortest"), F.max("_n").alias("longest")
    )
    return materialize(nodes, "tree")


def _within(one: Column, two: Column, radius: Column) -> Column:
    return F.call_function("levenshtein", one, two, radius) >= 0


def _reachable(text: Column, node: Column, cut: int, radius: Column) -> Column:
    """Whether some prefix of the text, all of it if the node is a whole name, is within the radius of the node."""
    size = F.length(node)
    first = F.greatest(F.lit(0), size - radius)
    last = F.least(F.length(text), size + radius)
    some = F.exists(
        F.when(first <= last, F.sequence(first, last)), lambda j: _within(F.substring(text, F.lit(1), j), node, radius)
    )
    return F.coalesce(F.when(size < cut, _within(text, node, radius)).otherwise(some), F.lit(False))


def tree_candidates(
    left: DataFrame, right: DataFrame, tree: DataFrame, block: Sequence[str] = (), before: bool = False
) -> DataFrame:
    """Pairs within ``_radius`` edits, a column of the left rows; with ``before``, right rows ordered below ``_before`` only."""
    text, radius, n = F.col("l_text"), F.col("_radius"), F.length("l_text")
    open_ = left.withColumn("_at", F.lit(""))
    for level, cut in enumerate(CUTS):
        nodes = tree.where(F.col("level") == level).drop("level").withColumnRenamed("parent", "_at")
        good = (n >= F.col("shortest") - radius) & (n <= F.col("longest") + radius)
        if before:
            good = good & (F.col("least") < F.col("_before"))
        open_ = (
            open_.join(nodes, [*block, "_at"]).where(good & _reachable(text, F.col("node"), cut, radius))
            .drop("_at", "least", "shortest", "longest").withColumnRenamed("node", "_at")
        )
    leaves = right.withColumn("_at", F.substring("r_text", 1, CUTS[-1]))
    met = open_.join(leaves, [*block, "_at"]).where(_within(text, F.col("r_text"), radius))
    if before:
        met = met.where(F.col("r_order") < F.col("_before"))
    return met.drop("_at", "_radius", "_before")


# Searches


def pairs_within(left: DataFrame, right: DataFrame, k: int, block: Sequence[str] = ()) -> DataFrame:
    """All pairs within Levenshtein distance k; equal rows of an input give their pairs once."""
    if k > 2:
        reach = left.withColumn("_radius", F.lit(k))
        return tree_candidates(reach, right, prefix_tree(right, block), block).distinct()
    long = left.where(F.length("l_text") > KEYED)
    found = pairs_by_keys(left, right, k, block).distinct()
    if long.isEmpty():
        return found
    far = tree_candidates(long.withColumn("_radius", F.lit(k)), right, prefix_tree(right, block), block)
    return found.unionByName(far.distinct())


def best_by_tree(left: DataFrame, right: DataFrame, tree: DataFrame, radius: int, block: Sequence[str] = ()) -> DataFrame:
    """(l_id, distance, r_order): the nearest right row within the radius, first by order."""
    met = tree_candidates(left.withColumn("_radius", F.lit(radius)), right.select("r_order", "r_text", *block), tree, block)
    distance = F.levenshtein("l_text", "r_text").alias("distance")
    best = met.groupBy("l_id").agg(F.min(F.struct(distance, F.col("r_order"))).alias("hit"))
    return best.select("l_id", "hit.*")


def nearest_within(left: DataFrame, right: DataFrame, k: int, block: Sequence[str] = ()) -> DataFrame:
    """For every left row the right row at the smallest distance up to k, first by ``r_order``.

    Left: ``l_id``, ``l_text`` and block columns; an id may occur in several blocks.
    Right: ``r_order``, which names a row, ``r_text``, further ``r_`` columns and block
    columns. Two edits are settled by keys in one step; the tree serves the rows that
    are left, with half of the remaining edits first. Returns l_id, distance and the right columns.
    """
    near = min(k, 2)
    tree, found, open_ = None, None, left
    for radius in sorted({near, (near + k) // 2, k} - {0} or {0}):
        if radius == near:
            hits = best_by_keys(open_, right, near, block)
        else:
            tree = tree or prefix_tree(right, block)
            hits = best_by_tree(open_, right, tree, radius, block)
        hits = materialize(hits, f"within{radius}")
        found = hits if found is None else found.unionAll(hits)
        open_ = open_.join(hits.select("l_id"), "l_id", "left_anti")
        if radius < k and open_.isEmpty():
            break
    if k <= 2:
        # Names too long for keys have not been looked for yet.
        long = left.where(F.length("l_text") > KEYED)
        if not long.isEmpty():
            found = found.unionAll(best_by_tree(long, right, prefix_tree(right, block), k, block))
            found = found.groupBy("l_id").agg(F.min(F.struct("distance", "r_order")).alias("hit")).select("l_id", "hit.*")
    rows = right.select(*[c for c in right.columns if c.startswith("r_")])
    return found.join(rows, "r_order").select("l_id", "distance", *rows.columns)


def first_within(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """(l_id, r_order): for every left row the first right row within k edits; ``r_order`` names a right row.

    Keys give a partner within two edits; that partner's own partner is within four,
    so both bound the order of what the tree still has to look for.
    """
    near = min(k, 2)
    first = met_by_keys(left, right, near).groupBy("l_id").agg(F.min("r_order").alias("r_order"))
    known = materialize(left.join(first, "l_id", "left"), "first")
    if near and k >= 2 * near:
        partner = right.select("r_order", F.col("r_text").alias("_text"))
        onward = known.groupBy(F.col("l_text").alias("_text")).agg(F.min("r_order").alias("_next"))
        hop = partner.join(onward, "_text").select("r_order", "_next")
        known = known.join(hop, "r_order", "left").withColumn("r_order", F.least("r_order", "_next")).drop("_next")
    last = F.lit((1 << 63) - 1)
    rest = known.select(*left.columns, F.lit(k).alias("_radius"), F.coalesce("r_order", last).alias("_before"))
    if k == near:
        rest = rest.where(F.length("l_text") > KEYED)
    earlier = tree_candidates(rest, right.select("r_order", "r_text"), prefix_tree(right), before=True)
    found = known.select("l_id", "r_order").unionAll(earlier.select("l_id", "r_order"))
    return found.where(F.col("r_order").isNotNull()).groupBy("l_id").agg(F.min("r_order").alias("r_order"))


def cluster_names(names: DataFrame, k: int = 4, aliases: DataFrame | None = None) -> DataFrame:
    """Map every name to the first name within distance k, itself included; 'unknown' stays apart.

    ``names`` holds (name, ordinal) with distinct names. ``aliases`` holds (alias,
    name): an alias is compared as the name it stands for, which has the ordinal of
    the first of its spellings. Returns (name, cluster) for every given name.
    """
    given = names
    if aliases is not None:
        spelled = aliases.select(F.col("alias").alias("name"), F.col("name").alias("_stands_for"))
        given = names.join(spelled, "name", "left").withColumn("_as", F.coalesce("_stands_for", "name")).drop("_stands_for")
        names = given.groupBy(F.col("_as").alias("name")).agg(F.min("ordinal").alias("ordinal"))
    unknown = names.where(F.col("name") == "unknown").select("name", F.col("name").alias("cluster"))
    names = materialize(names.where(F.col("name") != "unknown"), "names")
    left = names.select(F.col("name").alias("l_id"), F.col("name").alias("l_text"))
    right = names.select(F.col("ordinal").alias("r_order"), F.col("name").alias("r_text"))
    best = first_within(left, right, k).join(right, "r_order")
    found = best.select(F.col("l_id").alias("name"), F.col("r_text").alias("cluster")).unionAll(unknown)
    if aliases is None:
        return found
    return given.select("name", "_as").join(found.withColumnRenamed("name", "_as"), "_as").drop("_as")


#: So many bits of a long hold one column of the subsequence table; the sum of two such columns does not overflow.
WORD = 62


def _by_bits(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, one column of bits per character of ``b``; a has up to ``WORD`` characters."""
    n = F.length(a)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    full = F.call_function("shiftleft", one, n) - 1

    def places(char: Column) -> Column:
        """The bits of the places at which ``a`` has the character."""
        return F.aggregate(
            F.sequence(F.lit(1), n), zero,
            lambda bits, i: F.when(F.substring(a, i, F.lit(1)) == char, bits.bitwiseOR(F.call_function("shiftleft", one, i - 1))).otherwise(bits),
        )

    def step(state: Column, hit: Column) -> Column:
        return (state + hit).bitwiseOR(state - hit).bitwiseAND(full)

    def column(state: Column, j: Column) -> Column:
        return step(state, state.bitwiseAND(places(F.substring(b, j, F.lit(1)))))

    last = F.aggregate(F.sequence(F.lit(1), F.length(b)), full, column)
    return n - F.bit_count(last)


def _by_rows(a: Column, b: Column) -> Column:
    """The same for names of any length, by the rows of the table: a row is the running maximum of its candidates."""
    n = F.length(a)

    def row(before: Column, j: Column) -> Column:
        char = F.substring(b, j, F.lit(1))

        def grown(now: Column, i: Column) -> Column:
            same = F.substring(a, i, F.lit(1)) == char
            cell = F.when(same, F.element_at(before, i) + 1).otherwise(F.greatest(F.element_at(before, i + 1), F.element_at(now, i)))
            return F.concat(now, F.array(cell))

        return F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0)), grown)

    start = F.array_repeat(F.lit(0), n + 1)
    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(b)), start, row), -1)


def subsequence_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts, in expressions alone."""
    some = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(~some, 0).when(F.length(a) <= WORD, _by_bits(a, b)).when(F.length(b) <= WORD, _by_bits(b, a)).otherwise(_by_rows(a, b))


def indel_ratio(a: Column, b: Column) -> Column:
    """100 · 2·LCS / (len a + len b); 100 for two empty texts."""
    size = F.length(a) + F.length(b)
    return F.when(size > 0, F.lit(200.0) * subsequence_length(a, b) / size).otherwise(100.0)


def similar_pairs(names: DataFrame, threshold: float) -> DataFrame:
    """(name, other) with indel ratio at or above the threshold, both directions, no self pairs.

    The ratio bounds the edits by the lengths: at most (1-t)(la+lb), and the
    lengths differ by no more than that, so a string of length n has a partner
    only within n·(1-t)·2/t' edits. The tree search uses that bound.
    """
    share = 1 - threshold / 100.0
    widest = (1 + share) / (1 - share)
    slack = 1e-9

    right = names.select(F.col("name").alias("r_text"), F.col("ordinal").alias("r_order"))
    length = F.length("name")
    radius = F.floor(share * (length + length * widest) + slack).cast("int")
    left = names.select(F.col("name").alias("l_text"), radius.alias("_radius"))
    pairs = tree_candidates(left, right, prefix_tree(right))
    # Levenshtein distance is never above the edits without replacement that the ratio allows.
    edits = F.floor(share * (F.length("l_text") + F.length("r_text")) + slack)
    return (
        pairs.where(F.col("l_text") != F.col("r_text"))
        .where(F.levenshtein("l_text", "r_text") <= edits)
        .where(indel_ratio(F.col("l_text"), F.col("r_text")) >= threshold)
        .select(F.col("l_text").alias("name"), F.col("r_text").alias("other"))
    )


def sequential_merge(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """Where each name ends up when the names, in order, each absorb their similar names.

    A value moves to its first similar name; from then on only a later similar
    name can absorb it again. So the end is reached by following "next later
    similar name" links, which doubling does in a logarithmic number of joins.
    Returns (name, merged) for the names that move.
    """
    order = names.select(F.col("name"), F.col("ordinal"))
    edges = materialize(
        pairs.join(order, "name").join(
            order.select(F.col("name").alias("other"), F.col("ordinal").alias("other_ordinal")), "other"
        ),
        "edges",
    )
    target = F.min(F.struct(F.col("other_ordinal").alias("o"), F.col("other").alias("n")))["n"]
    start = edges.groupBy("name").agg(target.alias("merged"))
    later = edges.where(F.col("other_ordinal") > F.col("ordinal")).groupBy("name").agg(target.alias("next"))
    links = materialize(later, "links")
    while True:
        hop = links.select(F.col("name").alias("next"), F.col("next").alias("jump"))
        jumped = links.join(hop, "next", "left")
        if jumped.where(F.col("jump").isNotNull()).isEmpty():
            break
        links = materialize(jumped.select("name", F.coalesce("jump", "next").alias("next")), "links")
    ends = links.select(F.col("name").alias("merged"), F.col("next").alias("end"))
    return start.join(ends, "merged", "left").select("name", F.coalesce("end", "merged").alias("merged"))


def fuzzy_dedupe(
    df: DataFrame, column: str, tiebreak: str, threshold: float = 90, least: int = 5
) -> DataFrame:
    """Merge frequent near-equal values; 'unknown' and rare values stay.

    The order of names is their first appearance by ``tiebreak``.
    """
    counts = df.groupBy(F.col(column).alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.min(tiebreak).alias("ordinal")
    )
    frequent = materialize(
        counts.where((F.col("n") >= least) & (F.col("name") != "unknown")).select("name", "ordinal"), "names"
    )
    merged = sequential_merge(frequent, similar_pairs(frequent, threshold))
    return (
        df.join(merged.withColumnRenamed("name", column), column, "left")
        .withColumn(column, F.coalesce("merged", column))
        .select(*df.columns)
    )


def allowed_areas(places: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(country, provstate, admin1): admin areas whose name contains the province name.

    Every substring of each distinct area name is listed, so containment becomes
    an equi-join; an empty province is contained in all areas of its country.
    """
    areas = gazetteer.select(
        F.lower("country").alias("country"), F.lower("admin1").alias("admin1")
    ).where(F.col("admin1").isNotNull()).distinct()
    size = F.length("admin1")
    subs = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size),
            lambda i: F.transform(
                F.sequence(F.lit(1), size - i + 1), lambda n: F.substring(F.col("admin1"), i, n)
            ),
        )
    )
    listed = areas.select(
        "country", "admin1",
        F.explode(
            F.array_union(F.array(F.lit("")), F.when(size > 0, F.array_distinct(subs)).otherwise(F.array(F.lit(""))))
        ).alias("provstate"),
    )
    wanted = places.select("country", "provstate").distinct()
    return wanted.join(listed, ["country", "provstate"])


def match_gazetteer(places: DataFrame, gazetteer: DataFrame, k: int = 6) -> DataFrame:
    """The nearest gazetteer entry in the same country whose area contains the province.

    ``places``: distinct (country, provstate, city). ``gazetteer``: (ordinal,
    name, latitude, longitude, country, admin1). Returns places with the
    matched name, its coordinates and the distance.
    """
    places = places.where(F.col("city").isNotNull() & (F.col("city") != "unknown"))
    areas = allowed_areas(places, gazetteer)
    left = materialize(
        places.join(areas, ["country", "provstate"]).select(
            F.struct("country", "provstate", "city").alias("l_id"),
            F.col("city").alias("l_text"),
            "country",
            "admin1",
        ),
        "places",
    )
    entries = gazetteer.select(
        F.col("ordinal").alias("r_order"),
        F.lower(F.trim("name")).alias("r_text"),
        F.col("latitude").alias("r_latitude"),
        F.col("longitude").alias("r_longitude"),
        F.lower("country").alias("country"),
        F.lower("admin1").alias("admin1"),
    )
    right = first_per_key(entries, ["country", "admin1", "r_text"], [F.col("r_order")])
    near = nearest_within(left, materialize(right, "gazetteer"), k, ["country", "admin1"])
    return near.select(
        "l_id.*",
        F.col("r_text").alias("matched"),
        "distance",
        F.col("r_latitude").alias("match_lat"),
        F.col("r_longitude").alias("match_lon"),
    )


def match_city(cities: DataFrame, known: DataFrame, k: int = 6) -> DataFrame:
    """The nearest known city name for each distinct city, no country check.

    ``known``: (ordinal, name, latitude, longitude) with distinct names.
    """
    left = materialize(
        cities.where(F.col("city").isNotNull() & (F.col("city") != "unknown"))
        .select(F.col("city").alias("l_id"), F.col("city").alias("l_text"))
        .distinct(),
        "cities",
    )
    right = known.select(
        F.col("ordinal").alias("r_order"),
        F.col("name").alias("r_text"),
        F.col("latitude").alias("r_latitude"),
        F.col("longitude").alias("r_longitude"),
    )
    near = nearest_within(left, materialize(right, "known"), k)
    return near.select(
        F.col("l_id").alias("city"),
        F.col("r_text").alias("matched"),
        "distance",
        F.col("r_latitude").alias("match_lat"),
        F.col("r_longitude").alias("match_lon"),
    )
