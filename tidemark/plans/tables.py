"""The jobs' input messages, built from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import format_time
from tidemark.settings import Timing

# The test tables have few rows per minute, so each report query also runs on windows of a day.
MINUTE = Timing()
MINUTE_DELAY_MS = 300_000
DAY = Timing(window_ms=86_400_000, delay_ms=7_200_000, lateness_ms=86_400_000)
DAY_DELAY_MS = 216_000_000

ITEM_FIELDS = "type string, score double, level string"
# Every so many orders name a country that no table has, or are damaged.
UNMAPPED_EVERY, UNMAPPED_CODE = 10, "NOWHERE"
DAMAGED_EVERY = 11
DELAYED_EVERY = 7
FIRST_REFRESH, REFRESHES = 1993, 10
ITEMS_PER_ENVELOPE = 65_536
# Texts that must pass through an open item as they are.
EXACT = '[123456789012345678901234567890123456789012345,0.30,1.5e400,{"x":null}]'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def audit_messages(
    spark: SparkSession, sf_dir: str, delay_ms: int = 0, damaged: bool = False, loose: bool = False, sources: int = 0
) -> DataFrame:
    """``events`` as audit-log texts: ``(value, arrival, event_id)``, and with ``sources`` the ``source`` of a row, by user.

    Every seventh event arrives ``delay_ms`` after it happened, all others at once; ``arrival`` is in
    microseconds. With ``damaged``, ten kinds of defects are put in, each in every 13th row; three of
    them are texts that go on after their object. With ``loose``, seven of eight times are written in ways
    that only a lenient reader takes, and the eighth in one that none does.
    """
    events = table(spark, sf_dir, "events")
    fields = {
        "dt": _loose_time(F.col("ts")) if loose else format_time("ts"),
        "type": F.col("event_type"),
        "username": F.col("user_id").cast("string"),
        "area": F.concat(F.lit("AREA_"), (F.col("user_id") % 5).cast("string")),
    }
    value = _object(fields)
    if damaged:
        kind = F.col("event_id") % 13
        value = (
            F.when(kind == 0, _object({**fields, "dt": F.lit("bad")}))
            .when(kind == 1, F.substring(value, 1, 30))
            .when(kind == 2, _object({**fields, "area": F.lit(None)}))
            .when(kind == 3, _object({**fields, "dt": F.lit("1970-01-01 00:00:00")}))
            .when(kind == 4, _object({**fields, "dt": F.lit("1969-12-31 23:59:59")}))
            .when(kind == 5, _object({**fields, "dt": F.lit("2024-13-01 00:00:00")}))
            .when(kind == 6, _object({**fields, "type": F.lit(None)}))
            .when(kind == 7, F.concat(value, value))
            .when(kind == 8, F.concat(value, F.lit(" zzz")))
            .when(kind == 9, F.concat(value, F.lit("]")))
            .otherwise(value)
        )
    source = [F.pmod("user_id", F.lit(sources)).alias("source")] if sources else []
    return events.select(value.alias("value"), _arrival(delay_ms).alias("arrival"), "event_id", *source)


def _loose_time(ts: Column) -> Column:
    kind = F.col("event_id") % 8
    year, month, day, hour, minute, second = (f(ts) for f in (F.year, F.month, F.dayofmonth, F.hour, F.minute, F.second))
    of_year = F.dayofyear(ts)

    def text(pattern: str, *numbers: Column) -> Column:
        return F.format_string(pattern, *numbers)

    return (
        F.when(kind == 0, text("%d-%02d-%02d %02d:%02d:%02d", year - 1, month + 12, day, hour, minute, second))
        .when(kind == 1, text("%d-%02d-%02d %02d:%02d:%02d", year, month, day - 1, hour + 24, minute, second))
        .when(kind == 2, text("%d-%02d-%02d %02d:00:%d", year, month, day, hour, minute * 60 + second))
        .when(kind == 3, text("%d-01-01 %d:%02d:%02d", year, (of_year - 1) * 24 + hour, minute, second))
        .when(kind == 4, F.concat(format_time(ts), F.lit(".5 and more")))
        .when(kind == 5, text("%d- %d- %d  %d: %d: %d", year, month, day, hour, minute, second))
        .when(kind == 6, text("%d-00-%d %02d:%02d:%02d", year, of_year + 31, hour, minute, second))
        .otherwise(F.replace(format_time(ts), F.lit(" "), F.lit("T")))
    )


def arrivals(spark: SparkSession, sf_dir: str, delay_ms: int = 0) -> DataFrame:
    """The arrivals of ``audit_messages`` alone, without building the texts."""
    return table(spark, sf_dir, "events").select(_arrival(delay_ms).alias("arrival"))


def _object(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[value.cast("string").alias(name) for name, value in fields.items()]))


def _arrival(delay_ms: int) -> Column:
    delay = F.when(F.col("event_id") % DELAYED_EVERY == 0, delay_ms * 1000).otherwise(0)
    return F.unix_micros(F.col("ts").cast("timestamp")) + delay


def area_hash(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """Regions as ``(area, codes)``: the names of their nations joined by commas.

    ``shift`` moves every nation that many regions on, for a second version of the table. A region
    has a row per thousand nation keys, so no text grows without bound.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    if shift:
        nation = nation.join(_moved(region, shift), F.col("n_regionkey") == F.col("from_key")).withColumn("n_regionkey", F.col("to_key"))
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("area"), F.floor(F.col("n_nationkey") / 1000).alias("part"))
        .agg(F.array_join(F.collect_list("n_name"), ",").alias("codes"))
        .select("area", "codes")
    )


def area_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten refreshes of the area table, ``(version, area, codes)``, a year apart; every fifth finds it empty.

    Each moves the nations one region on; ``version`` is the moment of the refresh in microseconds.
    """
    found = []
    for n in range(REFRESHES):
        if n % 5 != 4:
            moment = F.unix_micros(F.lit(f"{FIRST_REFRESH + n}-07-01 00:00:00").cast("timestamp"))
            found.append(area_hash(spark, sf_dir, shift=n).select(moment.alias("version"), "area", "codes"))
    return reduce(DataFrame.union, found)


def _moved(region: DataFrame, shift: int) -> DataFrame:
    """Each region's key, and the key ``shift`` places on among those that exist, in a circle."""
    keys = region.agg(F.sort_array(F.collect_set("r_regionkey")).alias("keys"))
    placed = keys.select("keys", F.posexplode("keys").alias("place", "from_key"))
    return placed.select("from_key", F.get("keys", F.pmod(F.col("place") + shift, F.size("keys"))).alias("to_key"))


def order_messages(spark: SparkSession, sf_dir: str, extra: bool = False, damaged: bool = False) -> DataFrame:
    """``orders`` as envelope texts: ``(value, ordered_on)``, with their line items as ``data``.

    An order is one envelope, with no items if it has none; one of more than 65,536 items is dealt to
    as many envelopes as that takes, by its items' values. Every tenth order names an unmapped country.
    With ``extra``, items carry fields the clean job does not know: one that it overwrites, a null, a
    flag, a nested object, and numbers that no type holds. With ``damaged``, six kinds of defects are
    put in, each in every 11th order.
    """
    item = [F.col("l_returnflag").alias("type"), F.col("l_discount").alias("score"), F.col("l_linestatus").alias("level")]
    if extra:
        item += [
            F.col("l_linenumber").alias("line"),
            F.lit("to be replaced").alias("area"),
            F.when(F.col("l_linenumber") > 3, F.col("l_suppkey")).alias("supplier"),
            (F.col("l_quantity") > 25).alias("bulk"),
            F.struct(
                F.col("l_partkey").alias("part"), F.array("l_linestatus", "l_returnflag").alias("flags")
            ).alias("detail"),
            F.lit(0).alias("raw"),
        ]
    lines = table(spark, sf_dir, "lineitem")
    counts = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ITEMS_PER_ENVELOPE)
    large = counts.select("l_orderkey", F.ceil(F.col("n") / ITEMS_PER_ENVELOPE).alias("parts"))
    # At most one in 65,536 of the line items' number, so it may be broadcast.
    lines = lines.join(F.broadcast(large), "l_orderkey", "left")
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(*[c for c in lines.columns if c != "parts"]), F.col("parts"))).otherwise(0)
    items = lines.select("l_orderkey", part.alias("part"), F.struct(*item).alias("item"))
    # Collecting lists saves nothing before a shuffle, so shuffle the items as they are.
    items = items.repartition("l_orderkey", "part")
    filled = items.groupBy("l_orderkey", "part").agg(F.collect_list("item").alias("data"))
    nation = table(spark, sf_dir, "nation")
    code = F.when(F.col("o_orderkey") % UNMAPPED_EVERY == 0, UNMAPPED_CODE).otherwise(F.col("n_name"))
    headers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderdate", format_time("o_orderdate").alias("dt"), code.alias("countryCode"))
    )
    # A header for each part, so that the lists meet them where they were made and are not shuffled again.
    sized = headers.join(F.broadcast(large), F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1)
    dealt = sized.withColumn("o_part", F.explode(parts))
    # Both sides grow with the data, so neither is ever broadcast; a hot order is in parts.
    here = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("o_part") == F.col("part"))
    messages = dealt.hint("merge").join(filled, here, "left").where(F.col("parts").isNull() | F.col("data").isNotNull())
    data = F.coalesce("data", F.array().cast(filled.schema["data"].dataType)).alias("data")
    value = F.to_json(F.struct("dt", "countryCode", data))
    if extra:
        value = F.replace(value, F.lit('"raw":0'), F.lit(f'"raw":{EXACT}'))
    if damaged:
        value = _damaged(value)
    return messages.select(value.alias("value"), F.col("o_orderdate").alias("ordered_on"))


def _damaged(value: Column) -> Column:
    kind = F.col("o_orderkey") % DAMAGED_EVERY

    def with_item(text: str) -> Column:
        return F.concat(F.substring(value, F.lit(1), F.length(value) - 2), F.when(F.size("data") > 0, ",").otherwise(""), F.lit(f"{text}]}}"))

    return (
        F.when(kind == 0, F.concat(value, value))
        .when(kind == 1, F.concat(value, F.lit(" zzz")))
        .when(kind == 2, F.concat(value, F.lit("]")))
        .when(kind == 3, with_item('{"type":"a","type":"b","score":0.5}'))
        .when(kind == 4, with_item('{"type":"a","score":"high"}'))
        .when(kind == 5, with_item("null"))
        .otherwise(value)
    )
