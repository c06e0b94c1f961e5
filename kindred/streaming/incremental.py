"""New source records against a fixed target table, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kindred.operators.blocking import DEFAULT, Caps, Index, capped, masks, met_rows, probes


def candidates_stream(records: DataFrame, targets: DataFrame, out: str, checkpoint: str, caps: Caps = Caps(), names: tuple[str, ...] = DEFAULT) -> StreamingQuery:
    """Append each micro-batch's capped candidates to a Parquet folder, by batch, exactly once.

    A batch that is run again overwrites its own partition. Target keys and their counts are written
    once, beside the checkpoint.
    """
    index = Index(targets, names, caps, f"{checkpoint}-index")

    def add(batch: DataFrame, number: int) -> None:
        batch.persist()
        capped(masks(met_rows(probes(batch, index), index)), caps.per_entity).write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.unpersist()

    return records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
