"""Streams: files that land are ingested as they come, and events are counted by window.

The ingest stream has no watermark: a late snapshot is what the store exists to catch, so it is compared with what was known at its
own time, however old. A batch that is replayed after a failure writes nothing new.
"""

from __future__ import annotations

from datetime import UTC

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from revlake.operators.canonical import canonicalise
from revlake.schema import CANONICAL
from revlake.sources import archives
from revlake.vintage import Vintage


def landing(spark: SparkSession, path: str, pattern: str = "*.zip", per_batch: int = 100) -> DataFrame:
    """(path, modificationTime, length) of files as they arrive; contents are read by the batch that ingests them."""
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch).load(path)
    return stream.select("path", "modificationTime", "length")


def ingest_archives(vintage: Vintage, path: str, report_type: str, checkpoint: str) -> StreamingQuery:
    """Ingest all archives of one report type that are there and weren't, each as a snapshot of its modification time."""

    def run(batch: DataFrame, _: int) -> None:
        for r in batch.orderBy("modificationTime", "path").collect():  # files of one batch, at most ``per_batch``
            with vintage.store.staging("decoded") as staged:
                canonical = canonicalise(archives.read_report(vintage.spark, r["path"], report_type, staged=staged), report_type)
                vintage.ingest(canonical, r["path"].rsplit("/", 1)[-1], r["modificationTime"].replace(tzinfo=UTC))

    return landing(vintage.spark, path).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_canonical(vintage: Vintage, path: str, checkpoint: str, validate: bool = False) -> StreamingQuery:
    """Ingest canonical rows with snapshot_id and observed_at, written as Parquet files, snapshot by snapshot."""
    stream = vintage.spark.readStream.schema(CANONICAL + ", snapshot_id string, observed_at timestamp").parquet(path)

    def run(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            for r in batch.select("observed_at", "snapshot_id").distinct().orderBy("observed_at", "snapshot_id").collect():
                own = batch.where((F.col("snapshot_id") == r["snapshot_id"]) & (F.col("observed_at") == F.lit(r["observed_at"])))
                vintage.ingest(own.drop("snapshot_id", "observed_at"), r["snapshot_id"], r["observed_at"].replace(tzinfo=UTC), validate)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(events: DataFrame, time: str, by: list[str], length: str = "1 day", late: str = "1 day", value: str = "value") -> DataFrame:
    """(window_start, by, n, total) of a stream or table of events; a stream forgets windows that are ``late`` behind."""
    rows = events.withColumn("_t", F.col(time).cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark("_t", late)
    return rows.groupBy(F.window("_t", length).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *by, "n", "total")


def blind_alarms(log: DataFrame, after_days: float = 9) -> DataFrame:
    """(source_url, retrieved_at, quiet_days) of a stream of (source_url, retrieved_at, delivered): one alarm for each quiet period.

    Per source the state is the last delivery and whether its quiet period was reported; rows may come in any
    batches, but a source's rows in the order of time.
    """

    def step(key, frames, state):
        since, reported = state.get if state.exists else (None, False)
        out = []
        for rows in frames:
            for at, delivered in rows.sort_values("retrieved_at")[["retrieved_at", "delivered"]].itertuples(index=False):
                now = at.timestamp()
                if delivered:
                    since, reported = now, False
                elif since is not None and not reported and now - since > after_days * 86400:
                    out.append((key[0], at, (now - since) / 86400))
                    reported = True
        state.update((since, reported))
        yield pd.DataFrame(out, columns=["source_url", "retrieved_at", "quiet_days"])

    return log.groupBy("source_url").applyInPandasWithState(
        step, "source_url string, retrieved_at timestamp, quiet_days double", "since double, reported boolean", "append", GroupStateTimeout.NoTimeout
    )
