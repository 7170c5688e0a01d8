"""Dropping late changes of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.gates import gate_documents, gate_rows
from rivulet.streaming.store import BatchStore


def position_store(spark, path: str, keys: list[str]) -> BatchStore:
    columns = ", ".join(f"`{k}` STRING" for k in keys)
    return BatchStore(spark, path, f"{columns}, time BIGINT, inc INT")


def gate_stream(
    stream: DataFrame,
    keys: list[str],
    state_path: str,
    out_path: str,
    checkpoint: str,
    ts: str = "ts",
    seq: str = "seq",
    documents: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Drop changes older than the last accepted time of their table, over all batches.

    `keys` are text columns naming the table; with `documents` the column `ts` is a
    cluster time (time, inc). Each batch runs the batch gate, which cuts a table holding
    most rows into slices, against the stored positions; no watermark is used, since
    lateness is exact and per table. Output goes to one folder per batch, so a replayed
    batch replaces its own rows. `trigger` is a stream trigger's arguments, such as
    {"processingTime": "5 seconds"} for a gate that runs until it is stopped; without it the
    gate ends when everything available is processed. Both may share one checkpoint.
    """
    store = position_store(stream.sparkSession, state_path, keys)
    gate = gate_documents if documents else gate_rows
    moment = (
        F.struct(F.col(ts)["time"].alias("time"), F.col(ts)["inc"].alias("inc"))
        if documents
        else F.struct(F.col(ts).alias("time"), F.lit(0).alias("inc"))
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            known = store.before(batch_id)
            accepted = gate(batch, keys, ts, seq, known)
            accepted.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
            seen = batch.select(*[F.col(k).cast("string").alias(k) for k in keys], moment.alias("p"))
            if known is not None:
                seen = seen.unionByName(known.select(*keys, F.struct("time", "inc").alias("p")))
            after = seen.groupBy(*keys).agg(F.max("p").alias("p"))
            store.save(batch_id, after.select(*keys, "p.time", "p.inc"))
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
