"""The packed weather record: 22 typed fields from seven cells (P-07), and the ten
rules that clear values by sentinel and quality code (P-06).

A cell holds several parts between commas. Parts that are missing or do not parse
are null, never an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import nullify

# The format of the record. Per cell its fields: name, part, type.
CELLS = {
    "WND": [("direction_angle", 0, "int"), ("direction_quality", 1, "int"), ("type", 2, "string"), ("speed", 3, "int"),
            ("speed_quality", 4, "int")],
    "CIG": [("ceiling_height", 0, "int"), ("ceiling_quality", 1, "int"), ("ceiling_determination", 2, "string"),
            ("CAVOK", 3, "string")],
    "VIS": [("vis_distance", 0, "int"), ("distance_quality", 1, "int"), ("variability", 2, "string"),
            ("quality_variability", 3, "int")],
    "TMP": [("air_temp", 0, "int"), ("air_temp_quality", 1, "string")],
    "DEW": [("dew_point", 0, "int"), ("dew_point_quality", 1, "string")],
    "SLP": [("sea_level_pressure", 0, "int"), ("sea_level_pressure_quality", 1, "int")],
    "AA1": [("precipitation_hrs", 0, "int"), ("precipitation_depth", 1, "int"), ("precipitation_quality", 3, "string")],
}

# The sentinel of each value and its quality field; codes of bad quality.
RULES = [
    ("direction_angle", 999, "direction_quality"), ("speed", 9999, "speed_quality"),
    ("ceiling_height", 99999, "ceiling_quality"), ("vis_distance", 999999, "distance_quality"),
    ("variability", 999, "quality_variability"), ("air_temp", 9999, "air_temp_quality"),
    ("dew_point", 9999, "dew_point_quality"), ("sea_level_pressure", 99999, "sea_level_pressure_quality"),
    ("precipitation_hrs", 99, "precipitation_quality"), ("precipitation_depth", 9999, "precipitation_quality"),
]
BAD_QUALITY = [2, 3, 6, 7]

FIELDS = [name for fields in CELLS.values() for name, _, _ in fields]


def parse_weather(df: DataFrame) -> DataFrame:
    """``df`` with the fields of its packed cells in their place; each cell is split once."""
    split = df.select("*", *[F.split(cell, ",").alias(f"_{cell}") for cell in CELLS])
    fields = []
    for cell, parts in CELLS.items():
        for name, at, kind in parts:
            piece = F.get(F.col(f"_{cell}"), F.lit(at))
            fields.append((piece if kind == "string" else piece.try_cast(kind)).alias(name))
    return split.select(*[c for c in df.columns if c not in CELLS], *fields)


def clean_weather(df: DataFrame) -> DataFrame:
    """The parsed fields with sentinels and values of bad quality cleared, all rules in one projection."""
    cleared = {value: nullify(value, str(sentinel) if dict(df.dtypes)[value] == "string" else sentinel, quality, BAD_QUALITY)
               for value, sentinel, quality in RULES}
    return df.select(*[cleared[c].alias(c) if c in cleared else F.col(c) for c in df.columns])
