"""The clean pipeline over bounded input."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tidemark.operators import clean
from tidemark.operators.joins import BROADCAST_BYTES


class Cleaned(NamedTuple):
    items: DataFrame
    bad_envelopes: DataFrame
    outcomes: DataFrame

    @property
    def columns(self) -> DataFrame:
        return clean.record_columns(self.items)

    @property
    def json(self) -> DataFrame:
        return clean.record_json(self.items)

    @property
    def bad(self) -> DataFrame:
        return self.bad_envelopes.union(clean.bad_items(self.items))


def clean_messages(
    messages: DataFrame,
    dim: DataFrame,
    default_area: str | None = None,
    item_fields: str | None = None,
    max_broadcast: int = BROADCAST_BYTES,
) -> Cleaned:
    """Envelope texts to items; see ``operators.clean`` for the arguments."""
    envelopes = clean.parse_envelopes(messages, item_fields)
    enriched = clean.enrich(envelopes, dim, default_area, max_broadcast)
    return Cleaned(clean.explode_items(enriched, item_fields), clean.bad_envelopes(envelopes), clean.outcomes(enriched, item_fields))


def clean_messages_as_of(
    messages: DataFrame,
    versions: DataFrame,
    arrival: str = "arrival",
    default_area: str | None = None,
    item_fields: str | None = None,
    max_broadcast: int = BROADCAST_BYTES,
) -> Cleaned:
    """Envelope texts with their ``arrival`` to items, each with the area that its code had at that moment.

    ``versions`` are the area tables of a span of time in one, as ``invert_versions`` makes them: a whole
    past can be cleaned again in one pass, with what a job running at the time would have found.
    """
    envelopes = clean.parse_envelopes(messages, item_fields, (arrival,))
    enriched = clean.enrich_as_of(envelopes, versions, arrival, default_area, max_broadcast)
    return Cleaned(clean.explode_items(enriched, item_fields), clean.bad_envelopes(envelopes), clean.outcomes(enriched, item_fields))
