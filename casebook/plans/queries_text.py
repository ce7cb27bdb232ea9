"""Catalogue: text operators, places, near-duplicate names, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.functions import fixed_values as V, text, values
from casebook.operators import cleaning as C, fuzzy, labels as L, resolve
from casebook.plans import answers as A
from casebook.plans.cleaning import LOADER_RENAMES
from casebook.plans.queries_cleaning import READY, loader_view, ready
from casebook.plans.registry import query
from casebook.session import materialize
from casebook.sources import tables

col = F.col


def documents(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents")


@query("normalize_text", f"SELECT doc_id, {A.normalized('text')} AS text FROM documents")
def normalize_text(spark, sf_dir):
    return C.normalize_columns(documents(spark, sf_dir).select("doc_id", "text"), ["text"])


_CUT = f"CASE WHEN text IS NULL OR text = '' THEN 'unknown' ELSE regexp_replace({A.squeeze('text')}, ',.*$', '') END"


@query("normalize_text_comma", f"SELECT doc_id, {A.aliased('t')} AS text FROM (SELECT doc_id, {_CUT} AS t FROM documents)")
def normalize_text_comma(spark, sf_dir):
    df = documents(spark, sf_dir).select("doc_id", "text")
    return C.normalize_columns(df, ["text"], cut_at_comma=True)


def _replaced(x: str) -> str:
    for a, b in [
        ("govt", "government"), ("mil", "military"), ("org", "organization"), ("intl", "international"),
        ("terr", "terrorist"), ("atk", "attack"), ("terrorists", "attackers"), ("militants", "attackers"),
        ("bombed", "bombing"), ("exploded", "explosion"),
    ]:
        x = f"replace({x}, '{a}', '{b}')"
    return f"substr(regexp_replace({x}, '(?i)no group claimed responsibility', '', 'g'), 1, 500)"


_CLEAN = f"CASE WHEN text IS NULL OR text = '' THEN '' ELSE {_replaced(_CUT)} END"


def with_reports(spark, sf_dir):
    """Documents, every fourth opened by a sentence that holds the terms to be cleaned."""
    opened = F.when(col("doc_id") % 4 == 0, F.concat(F.lit(REPORT), col("text"))).otherwise(col("text"))
    return documents(spark, sf_dir).select("doc_id", opened.alias("text"))


REPORT = "No group claimed responsibility for the atk on a govt org. "
_REPORTS = f"(SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '{REPORT}' || text ELSE text END AS text FROM documents)"


@query("clean_summary", f"SELECT doc_id, {_CLEAN} AS summary FROM {_REPORTS}")
def clean_summary(spark, sf_dir):
    return with_reports(spark, sf_dir).select("doc_id", text.clean_summary(col("text")).alias("summary"))


@query(
    "text_clean_stats",
    f"""SELECT round(avg(length({_CUT})), 4) AS mean_length_before, round(avg(length({_CLEAN})), 4) AS mean_length_after,
    count(*) FILTER (regexp_matches({_CUT}, '(?i)claimed|responsibility')) AS claimed_before,
    count(*) FILTER (regexp_matches({_CLEAN}, '(?i)claimed|responsibility')) AS claimed FROM {_REPORTS}""",
)
def text_clean_stats(spark, sf_dir):
    lengths = with_reports(spark, sf_dir).select(
        text.squeeze_comma(col("text")).alias("before"), text.clean_summary(col("text")).alias("cleaned")
    )
    return lengths.agg(
        F.round(F.avg(F.length("before")), 4).alias("mean_length_before"),
        F.round(F.avg(F.length("cleaned")), 4).alias("mean_length_after"),
        F.count_if(text.matches(col("before"), V.CLAIM_PATTERN)).alias("claimed_before"),
        F.count_if(text.matches(col("cleaned"), V.CLAIM_PATTERN)).alias("claimed"),
    )


@query(
    "flag_text_year",
    A.over(
        "raw",
        r"""SELECT eventid, CASE WHEN regexp_matches(summary, '19[7-9]\d|200\d|201[0-7]')
        AND NOT contains(lower(summary), CAST(iyear AS VARCHAR)) THEN 1 ELSE 0 END AS summary_date_mismatch_flag
        FROM (SELECT eventid, iyear, CASE WHEN eventid % 5 = 0 THEN summary || ' In 1996.' ELSE summary END AS summary FROM raw)""",
    ),
)
def flag_text_year(spark, sf_dir):
    df = tables.raw_incidents(spark, sf_dir, with_summary=True)
    summary = F.when(col("eventid") % 5 == 0, F.concat(col("summary"), F.lit(" In 1996."))).otherwise(col("summary"))
    mismatch = values.flag(text.mentions_other_year(summary, col("iyear")))
    return df.select("eventid", mismatch.alias("summary_date_mismatch_flag"))


PHRASES = {"tion the": "the group", "und die": "die group", "les ": "les group", "con el": "el group"}
AFTER_FIRST = {"shth": "shth group"}


@query(
    "impute_from_text",
    A.over(
        "raw",
        """SELECT eventid, CASE WHEN gname <> 'unknown' THEN gname WHEN contains(s, 'tion the') THEN 'the group'
        WHEN contains(s, 'shth') THEN 'shth group' WHEN contains(s, 'und die') THEN 'die group'
        WHEN contains(s, 'les ') THEN 'les group' WHEN contains(s, 'con el') THEN 'el group' ELSE gname END AS group_name
        FROM (SELECT *, lower(summary) AS s FROM raw)""",
    ),
)
def impute_from_text(spark, sf_dir):
    df = C.rename(tables.raw_incidents(spark, sf_dir, with_summary=True), LOADER_RENAMES)
    return C.group_from_text(df.select("eventid", "group_name", "summary"), PHRASES, AFTER_FIRST).drop("summary")


@query(
    "build_prompt",
    r"""SELECT doc_id, 'Given the following description of a terrorist attack, identify the most likely motive behind the attack in one or two words.'
    || chr(10) || chr(10) || 'Description: "' || regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g')
    || '"' || chr(10) || 'Motive:' AS prompt FROM documents WHERE text IS NOT NULL""",
)
def build_prompt(spark, sf_dir):
    prepared = L.prepare(documents(spark, sf_dir), "doc_id", "text")
    return prepared.select("doc_id", text.prompt(col("summary")).alias("prompt"))


MOTIVES = [
    ("the-like", r"\b(the|ther|ea)\b"),
    ("german", r"\b(und|der|die[- ]?das)\b"),
    ("french", r"\b(les|une?|aux)\b"),
    ("spanish", r"\b(con|los|ci)\b"),
]


def _motive(x: str, otherwise: str | None = None) -> str:
    edge = r"[^\p{L}\p{N}_]"
    whens = " ".join(
        f"WHEN regexp_matches({x}, '(^|{edge}){p.strip(chr(92) + 'b')}($|{edge})') THEN '{n}'" for n, p in MOTIVES
    )
    return f"CASE {whens} ELSE {otherwise or x} END"


_USABLE = f"{A.strip('text')} <> '' AND lower({A.strip('text')}) <> 'nan'"
_LABELS = f"SELECT doc_id, {A.strip('lower(text)')} AS t FROM documents WHERE {_USABLE}"


@query("classify_motive", f"SELECT doc_id, {_motive('t')} AS motive FROM ({_LABELS})")
def classify_motive(spark, sf_dir):
    df = documents(spark, sf_dir).select("doc_id", "text").where(text.usable_label(col("text")))
    return df.select("doc_id", text.first_pattern(col("text"), MOTIVES).alias("motive"))


@query("motive_counts", f"SELECT motive, count(*) AS row_count FROM (SELECT {_motive('t')} AS motive FROM ({_LABELS})) GROUP BY motive")
def motive_counts(spark, sf_dir):
    return L.motive_counts(documents(spark, sf_dir), "text", MOTIVES)


_ONE_LINE = A.strip("replace(text, chr(10), ' ')")


@query(
    "label_batch",
    f"""SELECT doc_id, {_motive('t', "'unknown'")} AS predicted_motive
    FROM (SELECT doc_id, lower({_ONE_LINE}) AS t FROM documents WHERE text IS NOT NULL)""",
)
def label_batch(spark, sf_dir):
    prepared = L.prepare(documents(spark, sf_dir), "doc_id", "text")
    return L.label_batch(prepared, "doc_id", L.keyword_predictor(MOTIVES))


@query(
    "text_label_join",
    "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def text_label_join(spark, sf_dir):
    written = tables.table(spark, sf_dir, "labels")
    return L.write_back(documents(spark, sf_dir).select("doc_id", "lang"), written, "doc_id")


# Places.

_CENTROIDS = """
centroids AS (SELECT lower(n_name) AS country, n_nationkey * 6.5::DOUBLE - 70 AS centroid_lat,
  n_nationkey * 13.25::DOUBLE - 165 AS centroid_lon FROM nation WHERE n_nationkey % 5 <> 0)"""


@query(
    "impute_centroid",
    A.over(
        "prepared",
        """SELECT eventid, CASE WHEN latitude IS NULL OR longitude IS NULL OR (latitude = 0 AND longitude = 0)
        THEN coalesce(round(centroid_lat, 4), 0) ELSE round(latitude, 4) END AS latitude,
        CASE WHEN latitude IS NULL OR longitude IS NULL OR (latitude = 0 AND longitude = 0)
        THEN coalesce(round(centroid_lon, 4), 0) ELSE round(longitude, 4) END AS longitude
        FROM ready LEFT JOIN centroids USING (country)""",
        READY,
        _CENTROIDS,
    ),
)
def impute_centroid(spark, sf_dir):
    df = ready(spark, sf_dir).select("eventid", "country", "latitude", "longitude")
    return C.impute_centroid(df, tables.country_centroids(spark, sf_dir)).drop("country")


@query(
    "city_centroids",
    A.over(
        "prepared",
        """SELECT city, round(avg(latitude), 6) AS city_lat, round(avg(longitude), 6) AS city_lon FROM ready
        WHERE latitude <> 0 AND longitude <> 0 AND city <> 'unknown' GROUP BY city""",
        READY,
    ),
)
def city_centroids(spark, sf_dir):
    means = C.city_centroids(ready(spark, sf_dir))
    return means.select("city", *[F.round(c, 6).alias(c) for c in ("city_lat", "city_lon")])


SIZES = {"nation_1": 9000.0, "nation_2": 5000.0, "nation_3": 3000.0}
_KM = """
reduced AS (SELECT eventid, country, latitude, longitude, centroid_lat IS NOT NULL AND latitude IS NOT NULL
    AND longitude IS NOT NULL AND (latitude <> 0 OR longitude <> 0) AS known,
    atan((1 - 1 / 298.257223563) * tan(radians(latitude))) AS b1,
    atan((1 - 1 / 298.257223563) * tan(radians(centroid_lat))) AS b2, radians(centroid_lon - longitude) AS dl
  FROM ready LEFT JOIN centroids USING (country)),
arcs AS (SELECT *, 2 * asin(sqrt(least(1.0, pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(dl / 2), 2)))) AS s
  FROM reduced),
measured AS (SELECT *, CASE WHEN known THEN 6378.137 * (s - (1 / 298.257223563) / 2 * (
    CASE WHEN pow(cos(s / 2), 2) > 0 THEN (s - sin(s)) * pow(sin((b1 + b2) / 2) * cos((b2 - b1) / 2), 2) / pow(cos(s / 2), 2) ELSE 0 END
  + CASE WHEN pow(sin(s / 2), 2) > 0 THEN (s + sin(s)) * pow(cos((b1 + b2) / 2) * sin((b2 - b1) / 2), 2) / pow(sin(s / 2), 2) ELSE 0 END))
  END AS km FROM arcs)"""


@query(
    "geo_consistency",
    A.over(
        "prepared",
        """SELECT eventid, CASE WHEN far THEN NULL ELSE latitude END AS latitude, CASE WHEN far THEN NULL ELSE longitude END
        AS longitude, round(km, 3) AS distance_km, CASE WHEN far THEN 1 ELSE 0 END AS geo_inconsistent_flag
        FROM (SELECT *, coalesce(km > CASE country WHEN 'nation_1' THEN 9000 WHEN 'nation_2' THEN 5000 WHEN 'nation_3'
          THEN 3000 ELSE 7000 END, false) AS far FROM measured)""",
        READY,
        _CENTROIDS,
        _KM,
    ),
)
def geo_consistency(spark, sf_dir):
    df = ready(spark, sf_dir).select("eventid", "country", "latitude", "longitude")
    out = C.geo_consistency(df, tables.country_centroids(spark, sf_dir), SIZES, 7000)
    return out.drop("country").withColumn("distance_km", F.round("distance_km", 3))


STORED_READY = loader_view("materialized_ready", "prepared") + """,
ready AS MATERIALIZED (SELECT * FROM materialized_ready)"""
_GAZETTEER = """
gazetteer AS (SELECT c_custkey AS ordinal, 'citi_' || (c_custkey % 211) AS name, CAST(c_custkey % 120 - 60 AS DOUBLE) AS lat,
  CAST(c_custkey % 340 - 170 AS DOUBLE) AS lon, lower(n_name) AS country, lower(c_mktsegment) || ' district' AS admin1
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
places AS MATERIALIZED (SELECT DISTINCT country, provstate, city || '' AS city FROM ready
  WHERE NOT coalesce(latitude <> 0 AND longitude <> 0, false)),
near AS MATERIALIZED (SELECT p.country, p.provstate, p.city, g.name || '' AS name, levenshtein(p.city, g.name) AS distance, g.ordinal,
    g.lat, g.lon FROM places p JOIN gazetteer g ON p.country = g.country AND contains(g.admin1, p.provstate)
  WHERE p.city <> 'unknown'),
firsts AS (SELECT country, provstate, city, min(distance * 1000000000 + ordinal) AS place FROM near WHERE distance <= 6 GROUP BY ALL),
by_place AS (SELECT country, provstate, city, name AS matched, distance, lat, lon FROM near JOIN firsts
  USING (country, provstate, city) WHERE distance * 1000000000 + ordinal = place)"""


def needy_places(spark, sf_dir):
    df = ready(spark, sf_dir)
    valid = values.true_only((col("latitude") != 0) & (col("longitude") != 0))
    return df.where(~valid).select("country", "provstate", "city").distinct()


@query(
    "fuzzy_gazetteer",
    A.over(
        "prepared",
        "SELECT country, provstate, city, matched, distance, lat AS match_lat, lon AS match_lon FROM by_place",
        STORED_READY,
        _GAZETTEER,
    ),
)
def fuzzy_gazetteer(spark, sf_dir):
    found = fuzzy.match_gazetteer(needy_places(spark, sf_dir), tables.gazetteer(spark, sf_dir))
    return found.withColumn("distance", col("distance").cast("long"))


def listed_cities(spark, sf_dir):
    """Distinct gazetteer names with the position of their first entry."""
    return (
        tables.gazetteer(spark, sf_dir)
        .groupBy("name")
        .agg(F.min(F.struct("ordinal", "latitude", "longitude")).alias("first"))
        .select("first.ordinal", "name", "first.latitude", "first.longitude")
    )


@query(
    "fuzzy_city",
    A.over(
        "prepared",
        """SELECT city, name AS matched, distance, lat AS match_lat, lon AS match_lon FROM city_near
        JOIN (SELECT city, min(distance * 1000000000 + ordinal) AS place FROM city_near WHERE distance <= 6 GROUP BY city)
        USING (city) WHERE distance * 1000000000 + ordinal = place""",
        STORED_READY,
        _GAZETTEER,
        """listed AS MATERIALIZED (SELECT name || '' AS name, ordinal, lat, lon FROM gazetteer
          WHERE ordinal IN (SELECT min(ordinal) FROM gazetteer GROUP BY name)),
        city_near AS MATERIALIZED (SELECT p.city, k.name, levenshtein(p.city, k.name) AS distance, k.ordinal, k.lat, k.lon
          FROM (SELECT DISTINCT city FROM places WHERE city <> 'unknown') p, listed k)""",
    ),
)
def fuzzy_city(spark, sf_dir):
    found = fuzzy.match_city(needy_places(spark, sf_dir), listed_cities(spark, sf_dir))
    return found.withColumn("distance", col("distance").cast("long"))


INTERNAL = [(1, "city_19", 11.5, 12.5), (2, "city_23", -3.25, 40.0), (3, "city_299", 7.0, 8.0)]
_CASCADE = """
internal AS (SELECT * FROM (VALUES (1, 'city_19', 11.5::DOUBLE, 12.5::DOUBLE), (2, 'city_23', -3.25::DOUBLE, 40.0::DOUBLE),
  (3, 'city_299', 7.0::DOUBLE, 8.0::DOUBLE)) t(ordinal, name, lat, lon)),
learned AS (SELECT city AS name, avg(latitude) AS lat, avg(longitude) AS lon FROM ready
  WHERE latitude <> 0 AND longitude <> 0 AND city <> 'unknown' AND city NOT IN (SELECT name FROM internal) GROUP BY city),
known AS (SELECT * FROM internal UNION ALL SELECT 3 + row_number() OVER (ORDER BY name), name, lat, lon FROM learned),
city_near AS MATERIALIZED (SELECT p.city, levenshtein(p.city, k.name) AS distance, k.ordinal, k.lat, k.lon
  FROM (SELECT DISTINCT city FROM places LEFT JOIN by_place USING (country, provstate, city)
    WHERE city <> 'unknown' AND matched IS NULL) p, known k),
by_city AS (SELECT city, lat, lon FROM city_near JOIN (SELECT city, min(distance * 1000000000 + ordinal) AS place
  FROM city_near WHERE distance <= 6 GROUP BY city) USING (city) WHERE distance * 1000000000 + ordinal = place),
regions AS (SELECT lower(r_name) AS region, r_regionkey * 11.5::DOUBLE - 30 AS lat, r_regionkey * 31.25::DOUBLE - 80 AS lon
  FROM region WHERE r_regionkey > 0)"""


@query(
    "impute_coords_cascade",
    A.over(
        "prepared",
        """SELECT eventid, coord_source, CASE WHEN coord_source IN ('country', 'region') THEN 1 ELSE 0 END
          AS low_confidence_coords_flag, CASE WHEN coord_source = 'missing' THEN 1 ELSE 0 END AS missing_coords_flag,
          round(CASE coord_source WHEN 'valid' THEN latitude WHEN 'gazetteer' THEN plat WHEN 'city' THEN clat
            WHEN 'country' THEN centroid_lat WHEN 'region' THEN rlat END, 4) AS latitude,
          round(CASE coord_source WHEN 'valid' THEN longitude WHEN 'gazetteer' THEN plon WHEN 'city' THEN clon
            WHEN 'country' THEN centroid_lon WHEN 'region' THEN rlon END, 4) AS longitude
        FROM (SELECT ready.*, bp.lat AS plat, bp.lon AS plon, bc.lat AS clat, bc.lon AS clon, centroid_lat, centroid_lon,
            r.lat AS rlat, r.lon AS rlon,
            CASE WHEN latitude <> 0 AND longitude <> 0 THEN 'valid' WHEN bp.lat IS NOT NULL THEN 'gazetteer'
              WHEN bc.lat IS NOT NULL THEN 'city' WHEN centroid_lat IS NOT NULL THEN 'country'
              WHEN r.lat IS NOT NULL THEN 'region' ELSE 'missing' END AS coord_source
          FROM ready LEFT JOIN by_place bp ON ready.country = bp.country AND ready.provstate = bp.provstate
              AND ready.city = bp.city
            LEFT JOIN by_city bc ON ready.city = bc.city
            LEFT JOIN centroids ON ready.country = centroids.country
            LEFT JOIN regions r ON ready.region = r.region)""",
        STORED_READY,
        _GAZETTEER,
        _CENTROIDS,
        _CASCADE,
    ),
)
def impute_coords_cascade(spark, sf_dir):
    # The cascade reads its input several times, so the cleaning before it is done once.
    columns = ["eventid", "region", "country", "provstate", "city", "latitude", "longitude"]
    df = materialize(ready(spark, sf_dir).select(*columns), "ready")
    internal = spark.createDataFrame(INTERNAL, "ordinal long, name string, latitude double, longitude double")
    out = resolve.impute_coords_cascade(
        df,
        tables.gazetteer(spark, sf_dir),
        internal,
        tables.country_centroids(spark, sf_dir),
        tables.region_centroids(spark, sf_dir),
    )
    return out.select(
        "eventid", "latitude", "longitude", "coord_source", "low_confidence_coords_flag", "missing_coords_flag"
    )


def part_names(spark, sf_dir):
    return tables.table(spark, sf_dir, "part").groupBy(col("p_name").alias("name")).agg(
        F.min("p_partkey").alias("ordinal")
    )


@query(
    "cluster_names",
    """SELECT a.name, b.name AS cluster FROM (SELECT p_name AS name, min(p_partkey) AS o FROM part GROUP BY 1) a,
    (SELECT p_name AS name, min(p_partkey) AS o FROM part GROUP BY 1) b WHERE levenshtein(a.name, b.name) <= 4
    QUALIFY row_number() OVER (PARTITION BY a.name ORDER BY b.o) = 1""",
)
def cluster_names(spark, sf_dir):
    return fuzzy.cluster_names(part_names(spark, sf_dir), 4)


# Subsequence tables row by row (a row is the running maximum of its candidates), then one overwrite per name in order.
_DEDUPE = """
WITH RECURSIVE counts AS (SELECT p_name AS name, count(*) AS n, min(p_partkey) AS ordinal FROM part GROUP BY 1),
names AS (SELECT name, row_number() OVER (ORDER BY ordinal) AS i FROM counts WHERE n >= 5 AND name <> 'unknown'),
lcs(a, b, j, cells) AS (
  SELECT x.name, y.name, 0, [0 FOR k IN range(len(x.name) + 1)] FROM names x, names y WHERE x.name <> y.name
  UNION ALL
  SELECT a, b, j + 1, [list_max(candidates[1:k]) FOR k IN range(1, len(a) + 2)] FROM (
    SELECT a, b, j, [CASE WHEN k > 1 AND substr(a, CAST(k AS INT) - 1, 1) = substr(b, j + 1, 1) THEN cells[k - 1] + 1 ELSE cells[k] END
      FOR k IN range(1, len(a) + 2)] AS candidates FROM lcs WHERE j < len(b))),
similar_names AS (SELECT a, b FROM lcs WHERE j = len(b) AND 200.0 * cells[len(a) + 1] / (len(a) + len(b)) >= 90),
merging(i, name, now) AS (
  SELECT CAST(0 AS BIGINT), name, name FROM names
  UNION ALL
  SELECT m.i + 1, m.name, CASE WHEN s.a IS NOT NULL THEN s.a ELSE m.now END FROM merging m JOIN names t ON t.i = m.i + 1
    LEFT JOIN similar_names s ON s.a = t.name AND s.b = m.now)
SELECT p_partkey, coalesce(now, p_name) AS p_name FROM part
LEFT JOIN (SELECT name, now FROM merging WHERE i = (SELECT count(*) FROM names)) ON name = p_name"""


@query("fuzzy_dedupe", _DEDUPE)
def fuzzy_dedupe(spark, sf_dir):
    parts = tables.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return fuzzy.fuzzy_dedupe(parts, "p_name", "p_partkey")
