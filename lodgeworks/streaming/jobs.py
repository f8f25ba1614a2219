"""Push features, scoring, request metrics and the performance check as streaming jobs.

State is bounded by the watermark in every job: keys are grouped inside an event-time window, so a
window's state is dropped once the watermark has passed it. Each batch is written under its own
batch number, which makes a replay after a failure overwrite its own earlier attempt.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodgeworks.fields import LATENCY_BUCKETS
from lodgeworks.operators.asof import latest_by_key
from lodgeworks.operators.drift import monitor_rows, retrain_decision


def file_stream(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _zoneless(df: DataFrame, ts: str) -> bool:
    return df.schema[ts].dataType.simpleString() == "timestamp_ntz"


def _instant(df: DataFrame, ts: str) -> Column:
    """A watermark needs an instant; a zone-less time is read as UTC whatever the session says."""
    col = F.col(ts)
    if not _zoneless(df, ts):
        return col
    return F.make_timestamp(
        F.year(col), F.month(col), F.day(col), F.hour(col), F.minute(col), F.date_part(F.lit("SECOND"), col), F.lit("UTC")
    )


def _wall_clock(instant: Column) -> Column:
    """The zone-less UTC time of an instant."""
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def _start(writer, available_now: bool, every: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def _empty_start(rows: DataFrame, path: str) -> None:
    """A folder without rows, so that the result of a stream that has not written yet reads as empty."""
    spark = rows.sparkSession
    spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(f"{path}/batch=-1")


def compact(spark: SparkSession, path: str, keys: Sequence[str], newest: str) -> None:
    """Replace the batches below ``path`` by one with the newest row per key; run it between two runs of the stream.

    The rows are written under a negative number first and the batches they stand for are deleted
    after that; an interruption leaves rows twice, which the readers resolve, but never loses one.
    ``newest`` is the column that decides: the time of a push, or ``batch`` for metrics.
    """
    everything = spark.read.parquet(path)
    numbers = [r.batch for r in everything.select("batch").distinct().collect()]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f.getPath() for f in files.listStatus(root) if f.isDirectory() and f.getPath().getName().startswith("batch=")]
    # Below all numbers in use, so that later updates of a slot still rank higher.
    number = min([-1, *numbers, *[int(f.getName().removeprefix("batch=")) for f in folders]]) - 1
    latest_by_key(everything, keys, newest).drop("batch").write.mode("overwrite").parquet(f"{path}/batch={number}")
    for folder in folders:
        files.delete(folder, True)


def push_features(
    stream: DataFrame, keys: Sequence[str], ts: str, path: str, checkpoint: str,
    window: str = "1 hour", late: str = "1 hour", available_now: bool = True, every: str | None = None,
) -> StreamingQuery:
    """Keep the newest row per key and ``window`` of a pushed stream; :func:`latest_pushed` reads it.

    A push more than ``late`` behind the newest push of any key is dropped; the number dropped is in the
    progress of the returned query (``numRowsDroppedByWatermark`` of its state operator).
    """
    rest = [c for c in stream.columns if c not in (*keys, ts)]
    newest = (
        stream.withColumn("_instant", _instant(stream, ts))
        .withWatermark("_instant", late)
        .groupBy(F.window("_instant", window).alias("_w"), *keys)
        .agg(F.max(ts).alias(ts), F.max_by(F.struct(*rest), ts).alias("_row"))
        .select(*keys, ts, *[f"_row.{c}" for c in rest])
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    _empty_start(newest, path)
    return _start(
        newest.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write),
        available_now, every,
    )


def latest_pushed(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str,
    as_of: str | None = None, ttl: timedelta | None = None,
) -> DataFrame:
    """Newest pushed row per key; with ``as_of`` and ``ttl`` the fields of older rows read as null."""
    rows = latest_by_key(spark.read.parquet(path).drop("batch"), keys, ts)
    if as_of is None or ttl is None:
        return rows
    limit = F.lit(as_of).cast(rows.schema[ts].dataType) - F.expr(f"INTERVAL '{int(ttl.total_seconds())}' SECOND")
    return rows.withColumns(
        {c: F.when(F.col(ts) >= limit, F.col(c)) for c in rows.columns if c not in (*keys, ts)}
    )


def score_stream(
    stream: DataFrame, model, path: str, checkpoint: str, keep: Sequence[str],
    available_now: bool = True, every: str | None = None,
) -> StreamingQuery:
    """Score requests as they arrive and append them, with the prediction, to the log table."""
    scored = model.transform(stream).select(*keep, F.col("prediction").cast("long").alias("booking_status"))
    return _start(
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint),
        available_now, every,
    )


def request_metrics(df: DataFrame, ts: str, duration: str, every: str = "15 seconds",
                    bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Requests, summed duration and cumulative latency buckets per time slot (batch or stream)."""
    return (
        df.groupBy(F.window(ts, every).alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("n_requests"),
            F.sum(duration).alias("total_seconds"),
            *[F.count_if(F.col(duration) <= b).alias(_le(b)) for b in bounds],
        )
        .select(F.col("_w.start").alias("slot"), "n_requests", "total_seconds", *[_le(b) for b in bounds])
    )


def _le(bound: float) -> str:
    return "le_" + format(bound, "g").replace(".", "_")


def request_metrics_stream(
    stream: DataFrame, ts: str, duration: str, path: str, checkpoint: str, late: str = "1 minute",
    bounds: Sequence[float] = LATENCY_BUCKETS, available_now: bool = True, every: str | None = "15 seconds",
) -> StreamingQuery:
    """The metrics of a live log; rows later than ``late`` behind the newest are dropped."""
    live = stream.withColumn("_instant", _instant(stream, ts)).withWatermark("_instant", late)
    metrics = request_metrics(live, "_instant", duration, bounds=bounds)
    if _zoneless(stream, ts):
        metrics = metrics.withColumn("slot", _wall_clock(F.col("slot")))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    _empty_start(metrics, path)
    return _start(
        metrics.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write),
        available_now, every,
    )


def latest_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The last update of each slot."""
    return latest_by_key(spark.read.parquet(path), ["slot"], "batch").drop("batch")


def performance_stream(
    stream: DataFrame, reference: DataFrame, path: str, checkpoint: str, run_ts: Callable[[int], str],
    available_now: bool = True, every: str | None = None, **monitor,
) -> StreamingQuery:
    """Per batch of labelled predictions: drift and accuracy against the reference, and a decision."""

    def check(batch: DataFrame, number: int) -> None:
        # Several measures read the batch; without this the source is read for each of them.
        batch.persist()
        try:
            rows = monitor_rows(reference, batch, run_ts(number), **monitor)
            rows.write.mode("overwrite").parquet(f"{path}/log/batch={number}")
        finally:
            batch.unpersist()
        logged = batch.sparkSession.read.parquet(f"{path}/log/batch={number}")
        retrain_decision(logged).write.mode("overwrite").parquet(f"{path}/decision/batch={number}")

    return _start(
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(check), available_now, every
    )
