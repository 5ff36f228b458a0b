"""Streaming results equal batch results."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.streaming import core as S


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "src"
    schema = "ts timestamp, word string"
    b1 = [(dt.datetime(2024, 1, 1, 0, m), w) for m, w in [(0, "a"), (1, "b"), (2, "a")]]
    spark.createDataFrame(b1, schema).write.mode("append").parquet(str(src))
    stream = S.file_stream(spark, str(src), schema, "parquet", max_files_per_trigger=1)
    # complete mode: equals the batch aggregate
    _, checkpoint = S.run_to_state(S.windowed_counts(stream, "ts", "2 minutes", keys=["word"]), "t_complete", "complete")
    out = S.state_rows(spark, checkpoint, S.COUNT_STATE)
    batch = S.windowed_counts(spark.read.parquet(str(src)), "ts", "2 minutes", keys=["word"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_decode_delimited_routes_bad_rows(spark):
    df = spark.createDataFrame([("A,1,2.5",), ("B,x",), ("C",)], "value string")
    d = S.decode_delimited(df, {"sym": (0, "string"), "qty": (1, "int"), "px": (2, "double")})
    got = {r.sym: r.ok for r in d.collect()}
    assert got == {"A": True, "B": False, "C": False}


def test_kafka_option_names_validated(spark):
    import pytest
    with pytest.raises(ValueError):
        S.kafka_stream(spark, "h:9092", "t", startingffsets="earliest")


def test_update_mode_over_batches_and_restart(spark, tmp_path):
    """Every batch rewrites its keys; a restart goes on from the state; the logs tell batches and offsets."""
    src, schema = tmp_path / "src", "k string, v double"
    ck = str(tmp_path / "ck")
    for part in ([("a", 1.0), ("b", 2.0)], [("a", 3.0), (None, 4.0)], [("c", 0.5), ("a", -1.0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
        stream = S.file_stream(spark, str(src), schema, max_files_per_trigger=1).withColumn("qty", F.lit(1))
        q, _ = S.run_to_state(S.symbol_aggregates(stream, "k", "v", "qty", "v"), "t_update", "update", ck)
    got = {r.k: (r.total_qty, r.total_value, r.price_sum / r.price_n, r.min_price, r.max_price)
           for r in S.state_rows(spark, ck, S.SYMBOL_STATE).collect()}
    assert got == {"a": (3, 3.0, 1.0, -1.0, 3.0), "b": (1, 2.0, 2.0, 2.0, 2.0), None: (1, 4.0, 4.0, 4.0, 4.0),
                   "c": (1, 0.5, 0.5, 0.5, 0.5)}
    files = S.batch_files(spark, ck).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in files] == [(0, 1), (1, 1), (2, 1)]
    assert [r.batch_id for r in S.batch_offsets(spark, ck).orderBy("batch_id").collect()] == [0, 1, 2]
    assert S.progress_frame(spark, q).agg(F.sum("input_rows"), F.max("state_rows")).first() == (2, 4)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    src, ck, out = (str(tmp_path / x) for x in ("src", "ck", "out"))
    schema = "ts timestamp, word string"
    batches = [[(dt.datetime(2024, 1, 1, 0, 0), "a"), (dt.datetime(2024, 1, 1, 0, 30), "a")],
               [(dt.datetime(2024, 1, 1, 0, 1), "late"), (dt.datetime(2024, 1, 1, 0, 29), "b"), (dt.datetime(2024, 1, 1, 2, 0), "z")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        agg = S.windowed_counts(S.file_stream(spark, src, schema), "ts", "10 minutes", keys=["word"], watermark="5 minutes")
        closed = S.run_to_files(agg, "t_late", ck, out)
    assert {(r.window.start.minute, r.word): r["count"] for r in closed.collect()} == {(0, "a"): 1, (30, "a"): 1, (20, "b"): 1}
    assert [(r.window.start.hour, r.word) for r in S.state_rows(spark, ck, S.COUNT_STATE).collect()] == [(2, "z")]


def test_event_stream_reads_a_partitioned_table(spark, tmp_path):
    from kestrel.plans.registry import load_all
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{tmp_path}/events.parquet")
    out = load_all()["stream_running_count_complete"].fn(spark, str(tmp_path))
    assert out.agg({"count": "sum"}).first()[0] == e.count()
