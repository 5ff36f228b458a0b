"""Catalogue: Structured Streaming.

Each query streams the ``events`` table through a file source until all of it is
read (``availableNow``).  Append output goes to Parquet files; results that are
rewritten (update and complete mode) are read from the stream's state by tasks, so
no result passes through the driver.  The oracle is the equivalent batch SQL
(stream result = batch result).  Event times are TIMESTAMP_NTZ and are cast to
TIMESTAMP for watermarks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fixed
from ..session import scratch_path
from ..sources.tables import Tables
from ..streaming import core as S
from .registry import query


def event_stream(spark, sf):
    """The ``events`` table as a stream, whether it is one file or a folder of
    files, also of partitions; a table without files is an error, not an empty
    stream."""
    events = Tables(spark, sf).events
    files = events.inputFiles()
    if not files:
        raise FileNotFoundError(f"the events table of {sf} has no files")
    one_file = all(f.endswith("/events.parquet") for f in files)
    s = (S.file_stream(spark, sf, events.schema, "parquet", glob="events.parquet") if one_file
         else S.file_stream(spark, f"{sf.rstrip('/')}/events.parquet", events.schema, "parquet"))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _name():
    return f"kestrel_{uuid.uuid4().hex[:10]}"


def appended(df):
    return S.run_to_files(df, _name())


def rewritten(df, buffers=S.COUNT_STATE, mode="complete"):
    _, checkpoint = S.run_to_state(df, _name(), mode)
    return S.state_rows(df.sparkSession, checkpoint, buffers)


def fmt_window(col="window"):
    return [F.date_format(f"{col}.start", "yyyy-MM-dd HH:mm:ss").alias("w_start"),
            F.date_format(f"{col}.end", "yyyy-MM-dd HH:mm:ss").alias("w_end")]


@query("stream_running_count_complete", "I1,I2,I12,I15,I20,A31", """
SELECT event_type AS word, count(*) AS count FROM events GROUP BY 1
""")
def _(spark, sf):
    words = S.split_words(event_stream(spark, sf).select("event_type", "ts"), "event_type", "ts")
    return rewritten(S.running_counts(words, "word"))


@query("stream_arrival_time", "A31,I1", """
SELECT event_type AS word, count(*) AS n_stamped FROM events GROUP BY 1
""")
def _(spark, sf):
    """Lines are stamped on arrival, within the run of the stream."""
    began = spark.range(1).select(F.current_timestamp()).first()[0]
    lines = S.with_arrival_time(event_stream(spark, sf).select(F.col("event_type").alias("value")))
    words = S.split_words(lines).where(F.col("timestamp") >= F.lit(began))
    return rewritten(S.running_counts(words, "word")).withColumnRenamed("count", "n_stamped")


@query("stream_watermark_without_window", "I3,I15", """
SELECT event_type AS word, count(*) AS count FROM events GROUP BY 1
""")
def _(spark, sf):
    """A watermark alone drops no state: every key stays, in update mode."""
    words = S.split_words(event_stream(spark, sf).select("event_type", "ts"), "event_type", "ts").withWatermark("ts", "1 minute")
    return rewritten(S.running_counts(words, "word"), mode="update")


@query("stream_tumbling_window_counts", "I6,I15", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS w_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS w_end,
       event_type, count(*) AS count
FROM events GROUP BY 1, 2, 3
""")
def _(spark, sf):
    out = rewritten(S.windowed_counts(event_stream(spark, sf), "ts", "1 hour", keys=["event_type"]))
    return out.select(*fmt_window(), "event_type", "count")


@query("stream_sliding_window_counts", "I4", """
WITH w AS (SELECT date_trunc('hour', ts) AS s, event_type FROM events
           UNION ALL SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR AS s, event_type FROM events)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS w_start, strftime(s + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS w_end,
       event_type, count(*) AS count FROM w GROUP BY 1, 2, 3
""")
def _(spark, sf):
    out = rewritten(S.windowed_counts(event_stream(spark, sf), "ts", "2 hours", "1 hour", keys=["event_type"]))
    return out.select(*fmt_window(), "event_type", "count")


@query("stream_watermark_append_closed_windows", "I15,A34", """
WITH m AS (SELECT max(ts) - INTERVAL 6 HOUR AS wm FROM events)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS w_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS w_end,
       event_type, count(*) AS count
FROM events, m WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= m.wm GROUP BY 1, 2, 3
""", note="append mode emits a window once the watermark (max event time - 6 h) passes its end")
def _(spark, sf):
    agg = S.windowed_counts(event_stream(spark, sf), "ts", "1 day", keys=["event_type"], watermark="6 hours")
    return appended(agg).select(*fmt_window(), "event_type", "count")


_SLIDING = """
WITH w AS (SELECT date_trunc('hour', ts) - to_hours(k) AS s, * FROM events, (SELECT unnest([0, 1]) AS k)),
m AS (SELECT max(ts) - INTERVAL 30 MINUTE AS wm FROM events)
"""


@query("stream_sliding_append_parquet", "I5,A34", _SLIDING + """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS w_start, strftime(s + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS w_end,
       event_type, count(*) AS count FROM w, m WHERE s + INTERVAL 2 HOUR <= wm GROUP BY 1, 2, 3
""")
def _(spark, sf):
    agg = S.windowed_counts(event_stream(spark, sf), "ts", "2 hours", "1 hour", keys=["event_type"], watermark="30 minutes")
    return appended(agg).select(*fmt_window(), "event_type", "count")


@query("stream_symbol_sliding_append", "I9,A34", _SLIDING + """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS w_start, strftime(s + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS w_end,
       user_id, count(*) AS total_qty, floor(sum(value) * 100 + 0.5) / 100 AS total_value,
       floor(avg(value) * 10000 + 0.5) / 10000 AS avg_price, min(value) AS min_price, max(value) AS max_price
FROM w, m WHERE s + INTERVAL 2 HOUR <= wm GROUP BY 1, 2, 3
""")
def _(spark, sf):
    e = event_stream(spark, sf).withColumn("qty", F.lit(1))
    out = appended(S.symbol_aggregates(e, "user_id", "value", "qty", "value", ts="ts", size="2 hours", slide="1 hour",
                                       watermark="30 minutes"))
    return out.select(*fmt_window(), "user_id", "total_qty", fixed("total_value", 2).alias("total_value"),
                      fixed("avg_price", 4).alias("avg_price"), "min_price", "max_price")


@query("stream_late_rows_are_dropped", "I19,I3,I16,A34", """
WITH e AS (SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY AS w_end, event_id % 10 = 0 AS late FROM events),
m AS (SELECT max(ts) FILTER (NOT late) - INTERVAL 6 HOUR AS wm1, max(ts) - INTERVAL 6 HOUR AS wm2 FROM e),
k AS (SELECT CASE WHEN late AND w_end <= wm1 THEN 'dropped' WHEN w_end <= wm2 THEN 'closed' ELSE 'open' END AS kind, *
      FROM e, m)
SELECT kind, CASE WHEN kind <> 'dropped' THEN strftime(w_end, '%Y-%m-%d %H:%M:%S') END AS w_end,
       CASE WHEN kind <> 'dropped' THEN event_type END AS event_type, count(*) AS count
FROM k GROUP BY 1, 2, 3
""")
def _(spark, sf):
    """A second batch brings a tenth of the rows after the watermark of the first
    has passed most of them.  What the closed windows (append output) and the open
    ones (state) do not hold was dropped."""
    e = Tables(spark, sf).events
    src, ck = scratch_path(spark, "late-src"), scratch_path(spark, "late-ckpt")
    out = scratch_path(spark, "late-out")
    late = F.col("event_id") % 10 == 0
    for part, rows in (("first", ~late), ("second", late)):
        e.where(rows).write.parquet(f"{src}/{part}")
        stream = S.file_stream(spark, f"{src}/*", e.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        closed = S.run_to_files(S.windowed_counts(stream, "ts", "1 day", keys=["event_type"], watermark="6 hours"),
                                _name(), ck, out)
    end = F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("w_end")
    kept = (closed.select(F.lit("closed").alias("kind"), end, "event_type", "count")
            .unionByName(S.state_rows(spark, ck, S.COUNT_STATE).select(F.lit("open").alias("kind"), end, "event_type", "count")))
    fed = e.agg(F.count(F.lit(1)).alias("fed"))
    lost = (kept.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("kept")).crossJoin(F.broadcast(fed))
            .select(F.lit("dropped").alias("kind"), F.lit(None).cast("string").alias("w_end"),
                    F.lit(None).cast("string").alias("event_type"), (F.col("fed") - F.col("kept")).alias("count")))
    return kept.unionByName(lost.where("count > 0"))


@query("stream_symbol_window_aggregates", "I7,X4", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS w_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS w_end,
       user_id, count(*) AS total_qty, floor(sum(value) * 100 + 0.5) / 100 AS total_value,
       floor(avg(value) * 10000 + 0.5) / 10000 AS avg_price, min(value) AS min_price, max(value) AS max_price
FROM events GROUP BY 1, 2, 3
""")
def _(spark, sf):
    e = event_stream(spark, sf).withColumn("qty", F.lit(1))
    agg = S.symbol_aggregates(e, "user_id", "value", "qty", "value", ts="ts", size="1 day")
    out = rewritten(agg, S.SYMBOL_STATE, "update")
    return out.select(*fmt_window(), "user_id", "total_qty", fixed("total_value", 2).alias("total_value"),
                      fixed(F.col("price_sum") / F.col("price_n"), 4).alias("avg_price"), "min_price", "max_price")


@query("stream_symbol_update_rekeyed", "I8,I15,A35", """
SELECT CAST(user_id AS VARCHAR) AS key, user_id || ',' || count(*) || ',' || CAST(floor(sum(value) * 100 + 0.5) AS BIGINT) || ','
       || CAST(floor(min(value) * 100 + 0.5) AS BIGINT) || ',' || CAST(floor(max(value) * 100 + 0.5) AS BIGINT) AS value
FROM events GROUP BY user_id
""")
def _(spark, sf):
    """Totals per symbol in update mode over several batches, as key and CSV text
    (amounts in hundredths)."""
    e = Tables(spark, sf).events
    src = scratch_path(spark, "symbol-src")
    e.repartition(3, "event_id").write.parquet(src)
    stream = S.file_stream(spark, src, e.schema, max_files_per_trigger=1).withColumn("qty", F.lit(1))
    out = rewritten(S.symbol_aggregates(stream, "user_id", "value", "qty", "value"), S.SYMBOL_STATE, "update")
    whole = {c: F.floor(F.col(c) * 100 + 0.5) for c in ("total_value", "min_price", "max_price")}
    return S.as_key_value(out.withColumns(whole), "user_id", ["user_id", "total_qty", "total_value", "min_price", "max_price"])




@query("stream_static_left_join_weighted", "C18,I11,B15", """
SELECT e.event_type, COALESCE(round(c.c_acctbal), 0) AS freq, count(*) AS count,
       COALESCE(round(c.c_acctbal), 0) * count(*) AS wtdfreq
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
GROUP BY 1, 2
""")
def _(spark, sf):
    static = Tables(spark, sf).customer.select(F.col("c_custkey").alias("user_id"),
                                               F.round("c_acctbal").alias("freq"))
    j = S.join_static(event_stream(spark, sf).select("user_id", "event_type"), static, ["user_id"], {"freq": 0.0})
    out = rewritten(j.groupBy("event_type", "freq").agg(F.count(F.lit(1)).alias("count")))
    return out.withColumn("wtdfreq", F.col("freq") * F.col("count"))


@query("stream_session_windows", "I13", """
WITH o AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                  OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS nw,
                  event_id FROM events),
s AS (SELECT user_id, ts, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM o)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS s_start,
       strftime(max(ts) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS s_end, count(*) AS events
FROM s GROUP BY user_id, sid
""")
def _(spark, sf):
    _, checkpoint = S.run_to_state(S.sessions(event_stream(spark, sf), "ts", "2 hours", ["user_id"]), _name(), "complete")
    out = spark.read.format("statestore").load(checkpoint).select(
        "value.user_id", F.col("value.session_window").alias("session"), F.col("value.count").alias("events"))
    return out.select("user_id", F.date_format("session.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("s_start"),
                      F.date_format("session.end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("s_end"), "events")


@query("stream_custom_state_per_key", "I14", """
SELECT user_id, count(*) AS n, floor(sum(value) * 100 + 0.5) / 100 AS total,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts
FROM events GROUP BY user_id
""")
def _(spark, sf):
    st = S.stateful_totals(event_stream(spark, sf), ["user_id"], "ts", "value")
    _, checkpoint = S.run_to_state(st, _name())
    return S.custom_state_rows(spark, checkpoint).select(
        "user_id", "n", fixed("total", 2).alias("total"),
        F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_ts"))


@query("stream_decode_payload_rekey", "I10,A35,A36,X17", """
SELECT event_type AS key, event_type || ',' || CAST(count(*) AS VARCHAR) || ',' ||
       CAST(floor(sum(value) * 100 + 0.5) / 100 AS VARCHAR) AS value, count(*) AS n_ok, 0 AS n_bad
FROM events GROUP BY event_type
""")
def _(spark, sf):
    e = event_stream(spark, sf)
    payload = e.select(F.concat_ws(",", F.concat(F.lit("u"), F.col("user_id").cast("string")), "event_type",
                                   F.col("value").cast("string")).alias("value"))
    lines = S.replay_lines(payload.select(F.concat("value", F.lit(",")).alias("value")), "value", key_field=1)
    dec = S.decode_delimited(lines, {"sym": (0, "string"), "kind": (1, "string"), "amount": (2, "double")})
    agg = dec.groupBy("kind").agg(F.sum(F.when(F.col("ok"), 1).otherwise(0)).alias("n_ok"),
                                  F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("n_bad"),
                                  F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    out = rewritten(agg, "n_ok bigint, n_bad bigint, n bigint, amount double").withColumn("amount", fixed("amount", 2))
    kv = S.as_key_value(out.select("*", F.col("n_ok").alias("ok")), "kind", ["kind", "n", "amount"])
    return kv.join(out.select(F.col("kind").alias("key"), "n_ok", F.col("n_bad").cast("int").alias("n_bad")), "key")


def _restarted(spark, sf):
    """Counts per event type, run over the first half of the month and, restarted
    from its checkpoint, over the rest: (the two queries, the checkpoint)."""
    e = Tables(spark, sf).events
    src, ck = scratch_path(spark, "restart-src"), scratch_path(spark, "restart-ckpt")
    early = F.coalesce(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"), F.lit(False))
    runs = []
    for part, rows in (("part1", early), ("part2", ~early)):
        e.where(rows).write.parquet(f"{src}/{part}")
        stream = S.file_stream(spark, f"{src}/*", e.schema).select(F.col("event_type").alias("word"))
        runs.append(S.run_to_state(S.running_counts(stream, "word"), _name(), "complete", ck)[0])
    return runs, ck


@query("stream_checkpoint_restart_progress", "I16,A34", """
SELECT event_type, count(*) AS count FROM events GROUP BY 1
""")
def _(spark, sf):
    _, ck = _restarted(spark, sf)
    return S.state_rows(spark, ck, S.COUNT_STATE).select(F.col("word").alias("event_type"), "count")


@query("stream_progress_of_runs", "I17", """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS run, count(*)::BIGINT AS input_rows,
       (SELECT count(DISTINCT event_type) FROM events) AS state_rows, false AS active
FROM events GROUP BY 1
""")
def _(spark, sf):
    """Progress of both runs: rows read, keys in the state, and whether the run is
    still in the session's list of active streams."""
    runs, _ = _restarted(spark, sf)
    live = {q.runId for q in spark.streams.active}
    out = None
    for i, q in enumerate(runs, 1):
        p = S.progress_frame(spark, q).agg(F.sum("input_rows").alias("input_rows"), F.max("state_rows").alias("state_rows"))
        p = p.select(F.lit(i).alias("run"), "input_rows", "state_rows", F.lit(q.runId in live or q.isActive).alias("active"))
        out = p if out is None else out.unionByName(p)
    return out


@query("stream_paced_replay_offsets", "A36,I18", """
WITH d AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS n FROM events)
SELECT CAST((n + 7) // 8 AS BIGINT) AS n_batches, CAST(least(n, 8) AS BIGINT) AS most_files, n AS n_files,
       (SELECT count(*) FROM events) AS n_rows FROM d
""")
def _(spark, sf):
    """A file per day replayed eight files a tick; the files of each batch come
    from the log that the stream's checkpoint keeps of its offsets, and the rows
    from those files."""
    e = Tables(spark, sf).events
    src = scratch_path(spark, "replay-src")
    e.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(src)
    schema = e.select("*", F.to_date("ts").alias("day")).schema
    stream = S.file_stream(spark, src, schema, max_files_per_trigger=8)
    lines = S.replay_lines(stream.select(F.concat_ws(",", "event_id", "event_type", F.lit("")).alias("value")))
    _, ck = S.run_to_state(lines.groupBy("key").agg(F.count(F.lit(1)).alias("count")), _name())
    read = S.batch_files(spark, ck)
    per_batch = read.groupBy("batch_id").agg(F.count(F.lit(1)).alias("files"))
    files = per_batch.agg(F.count(F.lit(1)).alias("n_batches"), F.max("files").alias("most_files"), F.sum("files").alias("n_files"))
    rows = S.state_rows(spark, ck, S.COUNT_STATE).agg(F.sum("count").alias("n_rows"))
    return files.crossJoin(F.broadcast(rows))
