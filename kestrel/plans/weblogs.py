"""Catalogue: access-log suite on a log synthesised from
``events`` and parsed back by regex; the oracle computes the same reports
from the original event columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import udfs as U
from ..jobs import weblogs as L
from ..session import scratch_path
from ..sources.tables import Tables, spread
from .registry import query

_LOGS = """
WITH logs AS (
  SELECT 'host' || CAST(user_id AS VARCHAR) AS host, date_trunc('second', ts) AS date_time,
         CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/' || json_extract_string(props, '$.k') AS endpoint, 'HTTP/1.0' AS protocol,
         CASE WHEN event_type = 'error' THEN 404 WHEN event_type = 'signup' THEN 302 ELSE 200 END AS response_code,
         CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS content_size
  FROM events)
"""


def parsed(spark, sf):
    return L.parse_logs(L.events_as_log_lines(spread(Tables(spark, sf).events)))


def logs(spark, sf):
    return L.valid(parsed(spark, sf))


@query("log_parse_good_bad", "L8,H8,H18,B29,A5", """
SELECT count(*) AS total, count(*) AS parsed, 0 AS failed FROM events
""")
def _(spark, sf):
    return L.parse_counts(parsed(spark, sf)).select("total", F.col("parsed").cast("bigint").alias("parsed"),
                                                   F.col("failed").cast("int").alias("failed"))


@query("log_parsed_records", "L8,H8,H18", _LOGS + """
SELECT host, strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, method, endpoint, protocol,
       response_code, content_size FROM logs
""")
def _(spark, sf):
    return logs(spark, sf).select("host", F.date_format("date_time", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
                                  "method", "endpoint", "protocol", "response_code", "content_size")


@query("log_content_size_stats", "L9,D3", _LOGS + """
SELECT CAST(floor(sum(content_size) / count(*)) AS BIGINT) AS avg_size, min(content_size) AS min_size,
       max(content_size) AS max_size FROM logs
""")
def _(spark, sf):
    return L.content_size_stats(logs(spark, sf))


@query("log_status_fractions", "L10,D10,D37", _LOGS + """
SELECT response_code, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 8) AS fraction
FROM logs GROUP BY response_code
""")
def _(spark, sf):
    return L.status_counts(logs(spark, sf)).withColumn("fraction", F.round("fraction", 8))


@query("log_frequent_hosts", "L11,D32", _LOGS + """
SELECT host, count(*) AS hits FROM logs GROUP BY host HAVING count(*) > 70
""")
def _(spark, sf):
    return L.frequent_hosts(logs(spark, sf), 70)


@query("log_top_endpoints", "L12,F7", _LOGS + """
SELECT endpoint, count(*) AS hits FROM logs GROUP BY endpoint ORDER BY hits DESC, endpoint LIMIT 10
""")
def _(spark, sf):
    return L.top_endpoints(logs(spark, sf), 10)


@query("log_top_error_endpoints", "L13,B1,F7", _LOGS + """
SELECT endpoint, count(*) AS hits FROM logs WHERE response_code <> 200
GROUP BY endpoint ORDER BY hits DESC, endpoint LIMIT 10
""")
def _(spark, sf):
    return L.top_endpoints(logs(spark, sf), 10, exclude_status=[200])


@query("log_unique_hosts", "L14,D17", _LOGS + """
SELECT count(DISTINCT host) AS unique_hosts FROM logs
""")
def _(spark, sf):
    return logs(spark, sf).agg(F.count_distinct("host").alias("unique_hosts"))


@query("log_unique_hosts_per_day", "L14,D18,H22", _LOGS + """
SELECT CAST(day(date_time) AS INTEGER) AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1
""")
def _(spark, sf):
    return L.unique_hosts_per_day(logs(spark, sf))


@query("log_avg_requests_per_host_per_day", "L15,D19", _LOGS + """
SELECT CAST(day(date_time) AS INTEGER) AS day, CAST(floor(count(*) / count(DISTINCT host)) AS BIGINT) AS avg_reqs
FROM logs GROUP BY 1
""")
def _(spark, sf):
    return L.avg_requests_per_host_per_day(logs(spark, sf))


@query("log_not_found_summary", "L16,D20", _LOGS + """
SELECT count(*) AS n_404, count(DISTINCT endpoint) AS distinct_endpoints FROM logs WHERE response_code = 404
""")
def _(spark, sf):
    nf = L.not_found(logs(spark, sf))
    return nf.agg(F.count(F.lit(1)).alias("n_404"), F.count_distinct("endpoint").alias("distinct_endpoints"))


@query("log_not_found_top_hosts", "L17,F7", _LOGS + """
SELECT host, count(*) AS hits FROM logs WHERE response_code = 404 GROUP BY host ORDER BY hits DESC, host LIMIT 25
""")
def _(spark, sf):
    nf = L.not_found(logs(spark, sf))
    return nf.groupBy("host").agg(F.count(F.lit(1)).alias("hits")).orderBy(F.desc("hits"), "host").limit(25)


@query("log_not_found_top_endpoints", "L17,F7", _LOGS + """
SELECT endpoint, count(*) AS hits FROM logs WHERE response_code = 404 GROUP BY endpoint ORDER BY hits DESC, endpoint LIMIT 25
""")
def _(spark, sf):
    return L.top_endpoints(L.not_found(logs(spark, sf)), 25)


@query("log_not_found_by_day_hour", "L18,F3,H22", _LOGS + """
SELECT CAST(day(date_time) AS INTEGER) AS day, CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS count
FROM logs WHERE response_code = 404 GROUP BY 1, 2
""")
def _(spark, sf):
    return L.by_day_and_hour(L.not_found(logs(spark, sf)))


@query("log_not_found_top_days", "L18,F7", _LOGS + """
SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS count FROM logs WHERE response_code = 404
GROUP BY 1 ORDER BY count DESC, day LIMIT 5
""")
def _(spark, sf):
    nf = L.not_found(logs(spark, sf))
    return (nf.groupBy(F.dayofmonth("date_time").alias("day")).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), "day").limit(5))


@query("log_size_by_host_pandas", "L19,D39", _LOGS + """
SELECT host, round(sum(content_size), 2) AS total_size FROM logs GROUP BY host
""")
def _(spark, sf):
    lg = logs(spark, sf).withColumn("content_size", F.col("content_size").cast("double"))
    return U.mergeable_sums(lg, ["host"], "content_size").select("host", F.round("total", 2).alias("total_size"))


@query("log_size_by_status_protocol", "L19,F2", _LOGS + """
SELECT response_code, protocol, CAST(sum(content_size) AS BIGINT) AS total_size, count(*) AS n
FROM logs GROUP BY 1, 2
""")
def _(spark, sf):
    return (logs(spark, sf).groupBy("response_code", "protocol")
            .agg(F.sum("content_size").alias("total_size"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("total_size"), "response_code"))


@query("log_avg_size_per_host_per_day", "L20", _LOGS + """
SELECT strftime(CAST(date_time AS DATE), '%Y-%m-%d') AS day,
       round(sum(content_size) / count(DISTINCT host), 6) AS avg_size_per_host FROM logs GROUP BY 1
""")
def _(spark, sf):
    r = L.avg_size_per_host_per_day(logs(spark, sf))
    return r.select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                    F.round("avg_size_per_host", 6).alias("avg_size_per_host"))


@query("log_first_lines_saved", "L20,A12,F4", _LOGS + """,
f AS (SELECT * FROM logs ORDER BY date_time, host, endpoint, content_size LIMIT 100)
SELECT count(*) AS lines, CAST(sum(content_size) AS BIGINT) AS total_size, count(DISTINCT host) AS hosts FROM f
""")
def _(spark, sf):
    """The first hundred lines by time saved as text, read back and parsed."""
    path = scratch_path(spark, "first-lines")
    lines = L.events_as_log_lines(Tables(spark, sf).events)
    parsed = L.parse_logs(lines)
    ordered = parsed.select(F.col("value"), F.struct("date_time", "host", "endpoint", "content_size").alias("o"))
    L.save_first_lines(ordered.orderBy("o").limit(100).select("value"), 100, path)
    back = L.parse_logs(spark.read.text(path))
    return back.agg(F.count(F.lit(1)).alias("lines"), F.sum("content_size").cast("bigint").alias("total_size"),
                    F.count_distinct("host").alias("hosts"))
