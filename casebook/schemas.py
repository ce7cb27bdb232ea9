"""Declared schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

_SHORT = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "money": T.DecimalType(15, 2),
}


def _schema(text: str) -> T.StructType:
    fields = (item.split(":") for item in text.split())
    return T.StructType([T.StructField(name, _SHORT[kind]) for name, kind in fields])


RAW = _schema(
    "eventid:long iyear:int imonth:int iday:int approxdate:string extended:int success:int vicinity:int"
    " guncertain1:int specificity:int region_txt:string country_txt:string provstate:string city:string"
    " latitude:double longitude:double attacktype1_txt:string weaptype1_txt:string weapsubtype1_txt:string"
    " targtype1_txt:string targsubtype1_txt:string natlty1_txt:string gname:string gsubname:string"
    " nkill:double nwound:double nkillter:double nwoundte:double nkillus:double nwoundus:double"
    " property:int propextent_txt:string propcomment:string propvalue:double summary:string motive:string"
)

GAZETTEER = _schema("name:string latitude:double longitude:double country:string admin1:string")

RECONCILED = {
    "incidents": _schema("eventid:long year:int month:int day:int extended:int success:int summary:string"),
    "locations": _schema(
        "eventid:long region:string country:string provstate:string city:string latitude:double"
        " longitude:double specificity:int vicinity:int unknown_location:int"
    ),
    "attacks": _schema("eventid:long attacktype1:string weaptype1:string weapsubtype1:string"),
    "targets": _schema("eventid:long targtype1:string targsubtype1:string nationality1:string"),
    "casualties": _schema(
        "eventid:long nkill:double nwound:double nkillter:double nwoundter:double nkillus:double"
        " nwoundus:double"
    ),
    "terroristgroups": _schema("eventid:long group_name:string uncertainty1:int unknown_group:int"),
    "properties": _schema(
        "eventid:long propvalue:money extent:string property:int propvalue_category:string"
    ),
}

DIMENSIONS = {
    "dim_time": _schema("time_id:long year:int month:int day:int extended:int"),
    "dim_location": _schema(
        "location_id:long region:string country:string provstate:string city:string latitude:double"
        " longitude:double specificity:int vicinity:int unknown_location_flag:int"
    ),
    "dim_attacktype": _schema(
        "attack_type_id:long attack_type:string weapon_type:string weapon_subtype:string"
    ),
    "dim_targettype": _schema(
        "target_type_id:long target_type:string target_subtype:string nationality:string"
    ),
    "dim_terroristgroup": _schema(
        "group_id:long group_name:string uncertainty:int unknown_group_flag:int"
    ),
    "dim_propertydamage": _schema(
        "property_id:long extent:string property:int propvalue_category:string"
    ),
}

FACT = _schema(
    "eventid:long time_id:long location_id:long attack_type_id:long target_type_id:long group_id:long"
    " property_id:long nkill:double nwound:double nkillter:double nwoundter:double nkillus:double"
    " nwoundus:double propvalue:double success:int propvalue_imputed:int us_casualty_imputed:int"
    " high_impact:int consistency_flag:int total_casualties:double"
)

# Column levels a reader drills through.
HIERARCHIES = {
    "time": ["year", "month", "day"],
    "location": ["region", "country", "provstate", "city"],
    "attack": ["attack_type", "weapon_type", "weapon_subtype"],
    "target": ["target_type", "target_subtype", "nationality"],
}
