"""SQL building blocks for the independent answers: raw view, cleaned view, star."""

from __future__ import annotations

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return (
        rf"regexp_replace(regexp_replace(lower({strip(x)}), '{WS}+', ' ', 'g'), '[^\x00-\x7F]+', '', 'g')"
    )


def aliased(x: str) -> str:
    return (
        f"CASE {x} WHEN 'usa' THEN 'united states' WHEN 'uk' THEN 'united kingdom'"
        f" WHEN 'yunnan' THEN 'yunnan province' WHEN 'yunnan prov' THEN 'yunnan province' ELSE {x} END"
    )


def normalized(x: str) -> str:
    return aliased(squeeze(x))


RAW = """
lines AS (
  SELECT l_orderkey, min(l_returnflag) AS weaptype1_txt, min(l_linestatus) AS weapsubtype1_txt,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS nkill,
         sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS nwound,
         CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS DOUBLE) AS nkillter,
         CAST(sum(CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END) AS DOUBLE) AS nwoundte
  FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT o_orderkey AS eventid,
         CAST(extract(year FROM o_orderdate) AS INTEGER) AS iyear,
         CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE CAST(extract(month FROM o_orderdate) AS INTEGER) END AS imonth,
         CASE WHEN o_orderkey % 89 = 0 THEN 0 ELSE CAST(extract(day FROM o_orderdate) AS INTEGER) END AS iday,
         CAST(o_orderkey % 2 AS INTEGER) AS extended,
         CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS success,
         CAST(o_custkey % 2 AS INTEGER) AS vicinity,
         CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS guncertain1,
         CASE WHEN o_custkey % 29 <> 0 THEN CAST(o_custkey % 5 + 1 AS INTEGER) END AS specificity,
         r_name AS region_txt, n_name AS country_txt,
         CASE WHEN o_custkey % 17 <> 0 THEN c_mktsegment END AS provstate,
         CASE WHEN o_custkey % 13 = 0 THEN 'unknown' ELSE 'city_' || (o_custkey % 300) END AS city,
         CASE WHEN o_custkey % 23 = 0 THEN NULL WHEN o_custkey % 19 = 0 THEN 0.0::DOUBLE
              ELSE CAST(o_custkey % 181 - 90 AS DOUBLE) END AS latitude,
         CASE WHEN o_custkey % 23 = 0 THEN NULL WHEN o_custkey % 19 = 0 THEN 0.0::DOUBLE
              ELSE CAST(o_custkey % 361 - 180 AS DOUBLE) END AS longitude,
         o_orderpriority AS attacktype1_txt, weaptype1_txt, weapsubtype1_txt,
         c_mktsegment AS targtype1_txt, o_orderstatus AS targsubtype1_txt, n_name AS natlty1_txt,
         CASE WHEN o_custkey % 7 = 0 THEN 'unknown' ELSE 'group_' || (o_custkey % 200) END AS gname,
         nkill, nwound, nkillter, nwoundte,
         CASE WHEN o_orderkey % 4 < 3 THEN 0.0::DOUBLE ELSE nkill END AS nkillus,
         CASE WHEN o_orderkey % 4 < 3 THEN 0.0::DOUBLE ELSE nwound END AS nwoundus,
         CASE o_orderkey % 4 WHEN 1 THEN 0 WHEN 2 THEN -9 ELSE 1 END AS property,
         CASE o_orderkey % 5 WHEN 0 THEN 'Minor' WHEN 1 THEN 'Major' WHEN 2 THEN 'Catastrophic'
              ELSE 'Unknown' END AS propextent_txt,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -99.0::DOUBLE
              ELSE o_totalprice END AS propvalue,
         text AS summary
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN lines ON o_orderkey = l_orderkey
       LEFT JOIN documents ON o_orderkey = doc_id)"""

_TEXTS = (
    "region_txt country_txt provstate city propextent_txt attacktype1_txt weaptype1_txt weapsubtype1_txt"
    " targtype1_txt targsubtype1_txt natlty1_txt gname"
).split()

PREPARED = (
    "\nprepared AS (\n  SELECT * REPLACE ("
    + ", ".join(f"coalesce({normalized(c)}, 'unknown') AS {c}" for c in _TEXTS)
    + ", CASE WHEN propvalue <> -99 THEN propvalue END AS propvalue,"
    + " CASE WHEN property = -9 THEN -1 ELSE property END AS property) FROM raw)"
)

_US = "(natlty1_txt = 'nation_3' OR country_txt = 'nation_3')"
CLEANED = f"""
centroids AS (
  SELECT lower(n_name) AS country, n_nationkey * 6.5::DOUBLE - 70 AS centroid_lat,
         n_nationkey * 13.25::DOUBLE - 165 AS centroid_lon
  FROM nation WHERE n_nationkey % 5 <> 0),
parts AS (
  SELECT *,
    {_US} AND coalesce(nkillus, 0) = 0 AND coalesce(nkill, 0) > 0 AS hit_kill,
    {_US} AND coalesce(nwoundus, 0) = 0 AND coalesce(nwound, 0) > 0 AS hit_wound
  FROM prepared WHERE iyear <> 0 AND imonth <> 0 AND iday <> 0),
needy AS (
  SELECT *, property = 1 AND (propvalue IS NULL OR propvalue <= 0) AS needs FROM parts),
sampled AS (
  SELECT eventid FROM needy WHERE needs AND propextent_txt = 'unknown' ORDER BY md5('42:' || eventid), eventid LIMIT 300),
valued AS (
  SELECT *,
    CASE WHEN needs AND propextent_txt = 'minor' THEN 10000.0::DOUBLE
         WHEN needs AND propextent_txt = 'major' THEN 10000000.0::DOUBLE
         WHEN needs AND propextent_txt = 'catastrophic' THEN 1500000000.0::DOUBLE
         WHEN eventid IN (SELECT eventid FROM sampled) THEN 10000.0::DOUBLE
         ELSE propvalue END AS value,
    CASE WHEN needs AND propextent_txt <> 'unknown' THEN 1
         WHEN eventid IN (SELECT eventid FROM sampled) THEN 1 ELSE 0 END AS propvalue_imputed
  FROM needy),
cleaned AS (
  SELECT eventid, iyear AS year, imonth AS month, iday AS day, extended, success,
    CAST(coalesce(nkill, 0) AS INTEGER) AS nkill, CAST(coalesce(nwound, 0) AS INTEGER) AS nwound,
    CAST(coalesce(nkillter, 0) AS INTEGER) AS nkillter, CAST(coalesce(nwoundte, 0) AS INTEGER) AS nwoundter,
    value AS propvalue, propextent_txt AS extent,
    CASE WHEN propextent_txt = 'unknown' THEN -1 ELSE property END AS property,
    region_txt AS region, country_txt AS country, provstate, city,
    CASE WHEN latitude IS NULL OR (latitude = 0 AND longitude = 0) THEN coalesce(round(centroid_lat, 4), 0.0)
         ELSE round(latitude, 4) END AS latitude,
    CASE WHEN latitude IS NULL OR (latitude = 0 AND longitude = 0) THEN coalesce(round(centroid_lon, 4), 0.0)
         ELSE round(longitude, 4) END AS longitude,
    coalesce(specificity, 0) AS specificity, vicinity,
    CASE WHEN attacktype1_txt IN ('1-urgent', '2-high', '3-medium', '5-low', 'unknown')
         THEN attacktype1_txt ELSE 'unknown' END AS attacktype1,
    weaptype1_txt AS weaptype1, weapsubtype1_txt AS weapsubtype1, targtype1_txt AS targtype1,
    targsubtype1_txt AS targsubtype1, natlty1_txt AS nationality1, gname AS group_name,
    guncertain1 AS uncertainty1,
    least(CASE WHEN hit_kill THEN greatest(1, trunc(nkill * 0.5)) ELSE coalesce(nkillus, 0) END, 1000.0)
      AS nkillus,
    least(CASE WHEN hit_wound THEN greatest(1, trunc(nwound * 0.5)) ELSE coalesce(nwoundus, 0) END, 1000.0)
      AS nwoundus,
    CASE WHEN hit_kill OR hit_wound THEN 1 ELSE 0 END AS us_casualty_imputed,
    propvalue_imputed,
    CASE WHEN value IS NULL OR value <= 0 THEN 'None' WHEN value <= 1000 THEN 'Low'
         WHEN value <= 1000000 THEN 'Medium' WHEN value <= 1000000000 THEN 'High'
         ELSE 'Catastrophic' END AS propvalue_category,
    CASE WHEN coalesce(value >= 1000000, false) OR coalesce(nkill >= 100, false) THEN 1 ELSE 0 END AS high_impact,
    CASE WHEN city = 'unknown' OR (latitude IS NULL AND centroid_lat IS NULL)
           OR (latitude = 0 AND longitude = 0 AND centroid_lat IS NULL) THEN 1 ELSE 0 END AS unknown_location,
    CASE WHEN gname = 'unknown' THEN 1 ELSE 0 END AS unknown_group
  FROM valued LEFT JOIN centroids ON country_txt = centroids.country)"""


def _dimension(name: str, id_column: str, keys: dict[str, str], default: str, where: str) -> str:
    """Default member 1, other members from 2 in natural key order."""
    listed = ", ".join(f"{c} AS {k}" for k, c in keys.items())
    values = default.split("|")
    is_default = " AND ".join(f"{k} IS NOT DISTINCT FROM {v}" for k, v in zip(keys, values))
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    return f"""
{name}_members AS (SELECT DISTINCT {listed} FROM cleaned WHERE {where}),
{name} AS (
  SELECT CAST(1 AS BIGINT) AS {id_column}, {", ".join(f"{v} AS {k}" for k, v in zip(keys, values))}
  UNION ALL
  SELECT 1 + row_number() OVER (ORDER BY {order}), {", ".join(keys)}
  FROM {name}_members WHERE NOT ({is_default}))"""


TIME = {"year": "year", "month": "month", "day": "day", "extended": "extended"}
LOCATION = {
    "region": "region", "country": "country", "provstate": "provstate", "city": "city",
    "latitude": "latitude", "longitude": "longitude", "specificity": "specificity",
    "vicinity": "vicinity", "unknown_location_flag": "unknown_location",
}
ATTACK = {"attack_type": "attacktype1", "weapon_type": "weaptype1", "weapon_subtype": "weapsubtype1"}
TARGET = {"target_type": "targtype1", "target_subtype": "targsubtype1", "nationality": "nationality1"}
GROUP = {"group_name": "group_name", "uncertainty": "uncertainty1", "unknown_group_flag": "unknown_group"}
PROPERTY = {"extent": "extent", "property": "property", "propvalue_category": "propvalue_category"}

_GOOD_PLACE = (
    "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND specificity BETWEEN 1 AND 5"
    " AND vicinity IN (0, 1) AND unknown_location IN (0, 1)"
)
_GOOD_INCIDENT = (
    "year BETWEEN 1970 AND 2017 AND month BETWEEN 1 AND 12 AND day BETWEEN 1 AND 31"
    " AND extended IN (0, 1) AND success IN (0, 1)"
)
_DIMS = [
    ("dim_time", "time_id", TIME, "1970|1|1|0", _GOOD_INCIDENT),
    (
        "dim_location", "location_id", LOCATION,
        "'unknown'|'unknown'|'unknown'|'unknown'|0.0::DOUBLE|0.0::DOUBLE|1|0|1", _GOOD_PLACE,
    ),
    ("dim_attacktype", "attack_type_id", ATTACK, "'unknown'|'unknown'|'unknown'", "true"),
    ("dim_targettype", "target_type_id", TARGET, "'unknown'|'unknown'|'unknown'", "true"),
    ("dim_terroristgroup", "group_id", GROUP, "'unknown'|0|1", "true"),
    ("dim_propertydamage", "property_id", PROPERTY, "'unknown'|0|'unknown'", "propvalue IS NOT NULL"),
]
DIMENSIONS = ",".join(_dimension(*d) for d in _DIMS)

_FACT_JOINS = "\n".join(
    f"  LEFT JOIN {name} ON "
    + " AND ".join(f"cleaned.{c} IS NOT DISTINCT FROM {name}.{k}" for k, c in keys.items())
    for name, _, keys, _, _ in _DIMS
)
FACT = f"""
fact AS (
  SELECT eventid, {", ".join(f"coalesce({i}, 1) AS {i}" for _, i, _, _, _ in _DIMS)},
         CAST(nkill AS DOUBLE) AS nkill, CAST(nwound AS DOUBLE) AS nwound,
         CAST(nkillter AS DOUBLE) AS nkillter, CAST(nwoundter AS DOUBLE) AS nwoundter,
         CAST(nkillus AS DOUBLE) AS nkillus, CAST(nwoundus AS DOUBLE) AS nwoundus, propvalue, success,
         propvalue_imputed, us_casualty_imputed, high_impact, 0 AS consistency_flag,
         CAST(nkill + nwound AS DOUBLE) AS total_casualties
  FROM cleaned
{_FACT_JOINS}
  WHERE nkill >= 0 AND nwound >= 0 AND nkillter >= 0 AND nwoundter >= 0 AND nkillus >= 0 AND nwoundus >= 0
    AND success IN (0, 1))"""

FLAT = f"""
flat AS (
  SELECT * EXCLUDE ({", ".join(i for _, i, _, _, _ in _DIMS)}) FROM fact
  {" ".join(f"LEFT JOIN {name} USING ({i})" for name, i, _, _, _ in _DIMS)})"""

_LEVELS = {
    "raw": [RAW],
    "prepared": [RAW, PREPARED],
    "cleaned": [RAW, PREPARED, CLEANED],
    "dims": [RAW, PREPARED, CLEANED, DIMENSIONS],
    "fact": [RAW, PREPARED, CLEANED, DIMENSIONS, FACT],
    "flat": [RAW, PREPARED, CLEANED, DIMENSIONS, FACT, FLAT],
}


def over(level: str, body: str, *more: str) -> str:
    """A statement over the named level; ``more`` are further WITH members."""
    return "WITH " + ",".join([*_LEVELS[level], *("\n" + m for m in more)]) + "\n" + body


def top(dim: str, n: int, exclude: str = "") -> str:
    """A condition: the member is among the n with most incidents, ties by name."""
    pool = f"WHERE {dim} IS NOT NULL" + (f" AND {dim} NOT IN ({exclude})" if exclude else "")
    return (
        f"{dim} IN (SELECT {dim} FROM flat {pool} GROUP BY {dim}"
        f" ORDER BY count(eventid) DESC, {dim} LIMIT {n})"
    )
