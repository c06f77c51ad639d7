"""The clean job on a stream of envelopes."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import clean
from tidemark.plans.clean import clean_messages
from tidemark.sinks.writers import Sink
from tidemark.sources.areas import AreaSnapshots, PinnedAreas


def run_clean(
    messages: DataFrame,
    areas: AreaSnapshots,
    sink: Sink,
    checkpoint: str,
    bad_sink: Sink,
    default_area: str | None = None,
    item_fields: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the clean job: JSON records to ``sink``, unusable envelopes and items to ``bad_sink``.

    Every micro-batch looks up the area table of its own start, and a batch that is run again the table
    that it read first (``PinnedAreas``, beside the checkpoint). ``checkpoint`` lets a restarted job go
    on after the last finished batch. The default trigger runs a batch a minute.
    """
    pinned = PinnedAreas(areas, f"{checkpoint.rstrip('/')}-areas")

    def step(batch: DataFrame, batch_id: int) -> None:
        # Two outputs: keep the messages rather than fetch them from the source twice.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cleaned = clean_messages(batch, pinned.for_batch(batch.sparkSession, batch_id), default_area, item_fields)
            sink(cleaned.json, batch_id)
            bad_sink(cleaned.bad, batch_id)
        finally:
            batch.unpersist()

    return (
        messages.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )
