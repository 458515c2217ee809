"""OpenStreetMap extracts as element rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelabel.sources.json_split import json_values

ELEMENT_FIELDS = (
    "type STRING, id BIGINT, lat DOUBLE, lon DOUBLE, tags MAP<STRING, STRING>, "
    "nodes ARRAY<BIGINT>, members ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING>>"
)


def read_osm_elements(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Element rows with ``doc`` (the file) and ``pos`` (the order within it).

    A response document is one JSON object with its elements in a list; many tasks read it (see
    ``json_values``). ``lines=True`` reads one element per line.
    """
    if lines:
        rows = spark.read.schema(ELEMENT_FIELDS).option("mode", "FAILFAST").json(path)
        return rows.select(F.input_file_name().alias("doc"), F.monotonically_increasing_id().alias("pos"), "*")
    parsed = F.from_json("value", ELEMENT_FIELDS, {"mode": "FAILFAST"})
    return json_values(spark, path, "}", 2).select("doc", "pos", parsed.alias("_e")).select("doc", "pos", "_e.*")
