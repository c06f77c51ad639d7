"""The country-to-area lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.texts import split_codes


def invert_areas(hash_rows: DataFrame) -> DataFrame:
    """``(area, codes)`` rows to one ``(country_code, area)`` row per code.

    A code listed under several areas goes to the alphabetically last one.
    """
    codes = hash_rows.select("area", F.explode(split_codes("codes")).alias("country_code"))
    return codes.groupBy("country_code").agg(F.max("area").alias("area"))
