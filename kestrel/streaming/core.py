"""Structured Streaming sources, operators, sinks and control (SURVEY 2.I,
A31-A36).

Sources return streaming DataFrames; operators are ordinary DataFrame
transformations (so the same code runs on a batch frame, which is how
tests compare stream and batch results); sinks return the running
``StreamingQuery``.  Checkpoints live under the cluster's shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

# ----------------------------------------------------------------- sources

KAFKA_OPTIONS = {"kafka.bootstrap.servers", "subscribe", "subscribePattern", "assign", "startingOffsets",
                 "endingOffsets", "failOnDataLoss", "maxOffsetsPerTrigger", "minPartitions",
                 "kafka.security.protocol", "kafka.sasl.mechanism", "kafka.sasl.jaas.config", "groupIdPrefix",
                 "includeHeaders", "startingTimestamp", "startingOffsetsByTimestamp"}


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 fail_on_data_loss: bool = True, **options) -> DataFrame:
    """Kafka source (key, value as strings, plus timestamp).  Option
    names are validated so a misspelt one (e.g. 'startingffsets') fails
    instead of being silently ignored."""
    bad = set(options) - KAFKA_OPTIONS
    if bad:
        raise ValueError(f"unknown Kafka option(s): {sorted(bad)}")
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp")


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """File source — new files in ``path`` become micro-batches
    (paced with ``max_files_per_trigger``, the replay-into-stream tool)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def with_arrival_time(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Socket-style arrival time column."""
    return df.withColumn(name, F.current_timestamp())


def replay_lines(df: DataFrame, value: str = "value", key_field: int = 1, sep: str = ",") -> DataFrame:
    """Replayed CSV lines — trailing separator removed, key = field
    ``key_field`` (0-based)."""
    v = F.regexp_replace(F.col(value), f"{sep}$", "")
    return df.select(F.get(F.split(v, sep), key_field).alias("key"), v.alias("value"))


# --------------------------------------------------------------- operators

def split_words(lines: DataFrame, text: str = "value", ts: str | None = "timestamp") -> DataFrame:
    """One row per word, keeping the time column."""
    cols = [F.explode(F.split(F.col(text), " ")).alias("word")]
    if ts:
        cols.append(F.col(ts))
    return lines.select(*cols)


def running_counts(df: DataFrame, key: str = "word") -> DataFrame:
    """Running count per key (complete or update mode)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def windowed_counts(df: DataFrame, ts: str, size: str, slide: str | None = None, keys: Iterable[str] = (),
                    watermark: str | None = None) -> DataFrame:
    """Tumbling (slide None) or sliding window counts per key; with a
    watermark, state older than it is dropped and append mode emits each
    window once it closes."""
    x = df.withWatermark(ts, watermark) if watermark else df
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return x.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias("count"))


def decode_delimited(df: DataFrame, fields: dict[str, tuple[int, str]], value: str = "value",
                     sep: str = ",") -> DataFrame:
    """Positional CSV payload → typed columns with ``get`` + ``try_cast``
    (short or dirty payloads give NULL instead of failing the stream) and
    an ``ok`` flag for routing bad rows aside."""
    parts = F.split(F.col(value), sep)
    cols = {name: F.get(parts, idx).try_cast(typ) for name, (idx, typ) in fields.items()}
    ok = F.lit(True)
    for c in cols.values():
        ok = ok & c.isNotNull()
    return df.select("*", *[c.alias(n) for n, c in cols.items()], ok.alias("ok"))


def symbol_aggregates(df: DataFrame, key: str, price: str, qty: str, value: str,
                      ts: str | None = None, size: str | None = None, slide: str | None = None,
                      watermark: str | None = None) -> DataFrame:
    """Per-symbol totals / averages / min / max of the (numeric)
    price — optionally per event-time window with a watermark."""
    x = df.withWatermark(ts, watermark) if (watermark and ts) else df
    keys = [F.col(key)]
    if ts and size:
        keys.insert(0, F.window(ts, size, slide).alias("window"))
    return x.groupBy(*keys).agg(F.sum(qty).alias("total_qty"), F.sum(value).alias("total_value"),
                                F.avg(price).alias("avg_price"), F.min(price).alias("min_price"),
                                F.max(price).alias("max_price"))


def as_key_value(df: DataFrame, key: str, fields: list[str], sep: str = ",") -> DataFrame:
    """Re-key rows as (key, value) text for a Kafka sink."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.concat_ws(sep, *[F.col(f).cast("string") for f in fields]).alias("value"))


def join_static(stream: DataFrame, static: DataFrame, keys: list[str], fill: dict | None = None) -> DataFrame:
    """stream–static left outer join with null fill."""
    j = stream.join(static, keys, "left_outer")
    return j.na.fill(fill) if fill else j


def sessions(df: DataFrame, ts: str, gap: str, keys: Iterable[str], watermark: str | None = None) -> DataFrame:
    """Session windows (gap-based) per key."""
    x = df.withWatermark(ts, watermark) if watermark else df
    return x.groupBy(F.session_window(ts, gap).alias("session"), *keys).agg(
        F.count(F.lit(1)).alias("events"))


def stateful_totals(df: DataFrame, keys: list[str], ts: str, value: str, timeout: str = "NoTimeout") -> DataFrame:
    """Custom per-key state (count, total, last event time) kept with
    ``applyInPandasWithState``; each key's state is a few numbers, so
    memory per key is constant however hot the key is."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    out_schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in keys]) + \
        ", n bigint, total double, last_ts timestamp"
    state_schema = "n bigint, total double, last_ts timestamp"

    def update(key, batches, state):
        n, total, last = (state.get if state.exists else (0, 0.0, None))
        for pdf in batches:
            n += len(pdf)
            total += float(pdf[value].sum())
            m = pdf[ts].max()
            last = m if last is None or (m is not None and m > last) else last
        state.update((n, total, last))
        yield pd.DataFrame([list(key) + [n, total, last]], columns=keys + ["n", "total", "last_ts"])

    tmo = {"NoTimeout": GroupStateTimeout.NoTimeout, "ProcessingTimeTimeout": GroupStateTimeout.ProcessingTimeTimeout,
           "EventTimeTimeout": GroupStateTimeout.EventTimeTimeout}[timeout]
    return df.groupBy(*keys).applyInPandasWithState(update, out_schema, state_schema, "update", tmo)


# ------------------------------------------------------------------ sinks

def start(df: DataFrame, fmt: str = "memory", mode: str = "append", name: str | None = None,
          checkpoint: str | None = None, path: str | None = None, trigger: dict | None = None,
          single_file: bool = False, **options):
    """Start a sink.  ``trigger`` is e.g.
    ``{'availableNow': True}`` or ``{'processingTime': '5 seconds'}``.
    ``single_file`` coalesces each batch to one file (small outputs only)."""
    spark = df.sparkSession
    out = df.coalesce(1) if single_file else df
    w = out.writeStream.format(fmt).outputMode(mode)
    if name:
        w = w.queryName(name)
    w = w.option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name or fmt}"))
    if path:
        w = w.option("path", path)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def finish(q) -> None:
    """Wait, without a limit, until a stream has read all that was there;
    raise what stopped it otherwise."""
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_to_files(df: DataFrame, name: str, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Drain an append-mode stream over everything that is there
    (``availableNow``) into parquet files of the shared folder, and read them
    back.  With ``checkpoint`` and ``path`` of an earlier run it goes on there."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"sink-{name}")
    finish(start(df, "parquet", "append", name=name, checkpoint=checkpoint, path=path, trigger={"availableNow": True}))
    return spark.read.schema(df.schema).parquet(path)


def run_to_state(df: DataFrame, name: str, mode: str = "update", checkpoint: str | None = None):
    """Drain a stream whose results are rewritten (update or complete mode) and
    return (query, checkpoint).  Nothing is collected: file sinks cannot rewrite
    rows, so the sink discards them, and the results are read from where Spark
    keeps them anyway, the state in the shared folder (``state_rows``)."""
    checkpoint = checkpoint or scratch_path(df.sparkSession, f"stream-{name}")
    q = start(df, "noop", mode, name=name, checkpoint=checkpoint, trigger={"availableNow": True})
    finish(q)
    return q, checkpoint


# The state of an aggregate holds, after its keys, the buffers of its functions in their order.
COUNT_STATE = "count bigint"
SYMBOL_STATE = ("total_qty bigint, total_value double, price_sum double, price_n bigint, min_price double, "
                "max_price double")


def state_rows(spark: SparkSession, checkpoint: str, buffers: str) -> DataFrame:
    """The state of a stream's one stateful operator after its last batch, read by
    Spark's state-store source in a task per state partition: the columns of the
    key, and the value's fields by the names and types of ``buffers``, in order."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", F.col("value").cast(f"struct<{_as_struct(buffers)}>").alias("value")).select(
        *[F.col(f"`{c}`") for c in state.schema["key"].dataType.names], "value.*")


def _as_struct(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (x.split() for x in ddl.split(",")))


def custom_state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys and states of a custom stateful operator after its last batch."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "value.groupState.*")


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """Progress of the last batches of a query (Spark keeps the number that
    ``spark.sql.streaming.numRecentProgressUpdates`` says) as a DataFrame."""
    rows = [(p["id"], p["runId"], p["batchId"], p.get("numInputRows", 0), p.get("inputRowsPerSecond"),
             p.get("processedRowsPerSecond"), p.get("durationMs", {}).get("triggerExecution"),
             sum(o.get("numRowsTotal", 0) for o in p.get("stateOperators", [])))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, "id string, run_id string, batch_id long, input_rows long, "
                                       "input_rps double, processed_rps double, trigger_ms long, state_rows long")


def batch_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, path) of every file that a file stream has read, from the
    source log in its checkpoint: the recorded offsets of each batch, all that the
    log still holds, without a callback."""
    entry = F.from_json("value", "path string, timestamp long, batchId long")
    log = spark.read.text(f"{checkpoint}/sources/0/*").where(F.col("value").startswith("{")).select(entry.alias("e"))
    return log.select(F.col("e.batchId").alias("batch_id"), "e.path").distinct()


def batch_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, watermark_ms, offset) of the batches in a checkpoint's
    offset log: what a restarted query begins from."""
    from pyspark.sql.types import LongType
    lines = spark.read.text(f"{checkpoint}/offsets/*").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)$", 1).cast(LongType()).alias("batch_id"), "value")
    mark = F.get_json_object("value", "$.batchWatermarkMs").cast(LongType())
    offset = F.when(F.get_json_object("value", "$.logOffset").isNotNull(), F.col("value"))
    return lines.groupBy("batch_id").agg(F.max(mark).alias("watermark_ms"), F.max(offset).alias("offset"))
