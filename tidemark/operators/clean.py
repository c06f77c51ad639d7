"""Envelope text to flat records: parse, look up the area, one row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json_spans import member_spans
from tidemark.functions.json_text import BROKEN, elements, is_broken, last_member, put_fields, read_fields, read_flat, read_object
from tidemark.functions.once import with_once
from tidemark.operators.joins import BROADCAST_BYTES, lookup_join
from tidemark.operators.versions import as_of_lookup

ADDED = ("area", "dt")


def parse_envelopes(messages: DataFrame, item_fields: str | None = None, kept: tuple[str, ...] = ()) -> DataFrame:
    """``value`` text to ``(value, dt, countryCode, data, reason)``, with ``data`` an array of JSON texts.

    With ``item_fields`` (DDL of the item's fields) ``data`` has structs of those ``fields`` and the ``text``; most
    envelopes are read in one go then, and their items have no text. Without, fields nobody has named pass
    through as they are written. ``reason`` is null for an envelope that
    can be exploded; a text with anything after its object is malformed. Columns ``kept`` come along.
    """
    header = ("dt", "countryCode")
    if item_fields:
        parsed = with_once(messages, "_flat", read_flat("value", "dt string, countryCode string", "data", item_fields))
        parsed = with_once(parsed, "_p", F.when(F.col("_flat").isNull(), _item_by_item(item_fields)).otherwise(_at_once()))
        parsed = parsed.withColumns({name: F.col(f"_p.{name}") for name in (*header, "data")})
    else:
        parsed = with_once(messages, "_p", read_fields("value", "dt string, countryCode string"))
        parsed = with_once(parsed, "_m", member_spans(F.col("value")))
        # A number in the header keeps its text, too.
        parsed = with_once(parsed, "_o", F.struct(*(last_member(F.col("_m"), name).alias(name) for name in header)))
        number = {name: F.regexp_like(f"_o.{name}", F.lit(r"\A-?\d")) for name in header}
        parsed = parsed.withColumns({name: F.when(number[name], F.col(f"_o.{name}")).otherwise(F.col(f"_p.{name}")) for name in header})
        parsed = with_once(parsed, "data", F.when(~is_broken("_p"), elements(F.col("value"), F.col("_m"), "data")))
    reason = F.when(is_broken("_p"), "malformed_json").when(F.col("data").isNull(), "no_data")
    return parsed.select("value", *header, "data", reason.alias("reason"), *kept)


def _item_by_item(item_fields: str) -> Column:
    """An envelope whose items are cut out as texts, each of which is read for itself."""
    read = read_fields("value", "dt string, countryCode string, data array<string>")
    items = lambda texts: F.transform(texts, lambda text: F.struct(text.alias("text"), read_object(text, item_fields).alias("fields")))
    # Bound by a lambda, the envelope is parsed once.
    return F.transform(F.array(read), lambda one: F.when(one.isNotNull(), F.struct(one["dt"].alias("dt"), one["countryCode"].alias("countryCode"), items(one["data"]).alias("data"), one[BROKEN].alias(BROKEN))))[0]


def _at_once() -> Column:
    none = F.lit(None).cast("string")
    items = F.transform("_flat.data", lambda item: F.struct(none.alias("text"), item.withField(BROKEN, none).alias("fields")))
    return F.struct("_flat.dt", "_flat.countryCode", items.alias("data"), none.alias(BROKEN))


def enrich(
    envelopes: DataFrame, dim: DataFrame, default_area: str | None = None, max_broadcast: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``area`` by ``countryCode``: one lookup per envelope, before its items are exploded.

    A code the dimension lacks gets ``default_area``.
    """
    found = lookup_join(envelopes, dim.withColumnRenamed("country_code", "countryCode"), "countryCode", max_broadcast)
    return found.withColumn("area", F.coalesce("area", F.lit(default_area).cast("string")))


def enrich_as_of(
    envelopes: DataFrame, versions: DataFrame, arrival: str, default_area: str | None = None, max_broadcast: int = BROADCAST_BYTES
) -> DataFrame:
    """``enrich`` by the table that was in force when each envelope arrived; see ``as_of_lookup``."""
    table = versions.withColumnRenamed("country_code", "countryCode")
    found = as_of_lookup(envelopes, table, "countryCode", arrival, max_broadcast)
    return found.withColumn("area", F.coalesce("area", F.lit(default_area).cast("string")))


def explode_items(enriched: DataFrame, item_fields: str | None = None) -> DataFrame:
    """One row per element of ``data``: ``(item, area, dt, reason)``, and ``fields`` or ``record``.

    ``item`` is the element's text, null where its envelope was read in one go: such an item is not bad.
    ``fields`` are its ``item_fields``; without those, ``record`` is the text with ``area`` and ``dt`` put in. ``reason`` is set where the element is null, no object, or has
    a field of another type; the other items of the envelope are not affected.
    """
    usable = enriched.where(F.col("reason").isNull())
    return _read_items(usable.select(F.explode("data").alias("item"), "area", "dt"), item_fields)


def _read_items(exploded: DataFrame, item_fields: str | None) -> DataFrame:
    if item_fields:
        parsed = exploded.withColumns({"fields": F.col("item.fields"), "item": F.col("item.text")})
        return parsed.withColumn("reason", F.when(is_broken("fields"), "bad_item"))
    parsed = with_once(exploded, "record", put_fields(F.col("item"), {name: F.col(name) for name in ADDED}))
    return parsed.withColumn("reason", F.when(F.col("record").isNull(), "bad_item"))


def outcomes(enriched: DataFrame, item_fields: str | None = None) -> DataFrame:
    """``outcome`` of each item, ``record`` or the reason it is bad, and the reason of each envelope that can't be exploded.

    One pass over the envelopes: such an envelope goes along as one item without a text.
    """
    spread = F.when(F.col("reason").isNull(), F.col("data")).otherwise(F.array(F.lit(None).cast(enriched.schema["data"].dataType.elementType)))
    exploded = enriched.select(F.explode(spread).alias("item"), "area", "dt", F.col("reason").alias("unusable"))
    return _read_items(exploded, item_fields).select(F.coalesce("unusable", "reason", F.lit("record")).alias("outcome"))


def record_columns(items: DataFrame) -> DataFrame:
    """Typed items as columns, with ``area`` and ``dt`` added or overwritten."""
    good = items.where(F.col("reason").isNull())
    kept = [f"fields.{name}" for name in items.schema["fields"].dataType.names if name not in (*ADDED, BROKEN)]
    return good.select(*kept, *ADDED)


def record_json(items: DataFrame) -> DataFrame:
    """Items as JSON text ``value`` with ``area`` and ``dt`` put in; null fields are left out."""
    if "record" in items.columns:
        return items.where(F.col("reason").isNull()).select(F.col("record").alias("value"))
    columns = record_columns(items)
    return columns.select(F.to_json(F.struct(*columns.columns)).alias("value"))


def bad_envelopes(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(F.col("reason").isNotNull()).select("value", "reason")


def bad_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("reason").isNotNull()).select(F.col("item").alias("value"), "reason")
