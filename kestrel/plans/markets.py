"""Catalogue: market-data jobs on lineitem stand-ins.

Stand-in mapping (SURVEY 7.3): symbol = l_suppkey, trade date =
date(l_shipdate), expiry = last day of the ship month, instrument =
FUTSTK for line status F else OPTSTK, option type = returnflag A/N/R as
XX/PE/CE, contracts = l_quantity, value = l_extendedprice,
open interest = l_tax · 100.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fixed
from ..jobs import markets as M
from ..session import scratch_path
from ..sources.tables import Tables
from .registry import query

_FO_SQL = """
WITH fo AS (
  SELECT CAST(l_shipdate AS DATE) AS rts, l_suppkey AS SYMBOL, last_day(CAST(l_shipdate AS DATE)) AS EXPIRY_DT,
         CASE WHEN l_linestatus = 'F' THEN 'FUTSTK' ELSE 'OPTSTK' END AS INSTRUMENT,
         CASE l_returnflag WHEN 'A' THEN 'XX' WHEN 'N' THEN 'PE' ELSE 'CE' END AS OPTION_TYP,
         l_quantity AS CONTRACTS, l_extendedprice AS VAL_INLAKH, l_tax * 100 AS OPEN_INT
  FROM lineitem)
"""


def fo_standin(spark, sf):
    li = Tables(spark, sf).lineitem
    d = F.to_date("l_shipdate")
    return li.select(
        d.alias("rts"), F.col("l_suppkey").alias("SYMBOL"), F.last_day(d).alias("EXPIRY_DT"),
        F.when(F.col("l_linestatus") == "F", "FUTSTK").otherwise("OPTSTK").alias("INSTRUMENT"),
        F.when(F.col("l_returnflag") == "A", "XX").when(F.col("l_returnflag") == "N", "PE")
         .otherwise("CE").alias("OPTION_TYP"),
        F.col("l_quantity").alias("CONTRACTS"), F.col("l_extendedprice").alias("VAL_INLAKH"),
        (F.col("l_tax") * 100).alias("OPEN_INT"))


@query("put_call_ratio_job", "L1,D14,D27,D28,C22,A11", _FO_SQL + """,
g AS (SELECT rts, SYMBOL, INSTRUMENT, EXPIRY_DT, OPTION_TYP, sum(CONTRACTS) AS CONTRACTS,
             sum(VAL_INLAKH) AS VALUE, sum(OPEN_INT) AS OPEN_INT FROM fo GROUP BY 1, 2, 3, 4, 5),
p AS (SELECT rts, SYMBOL, EXPIRY_DT,
             sum(CASE WHEN OPTION_TYP = 'PE' THEN CONTRACTS END) / NULLIF(sum(CASE WHEN OPTION_TYP = 'CE' THEN CONTRACTS END), 0) AS PCR
      FROM g WHERE INSTRUMENT <> 'FUTSTK' GROUP BY 1, 2, 3)
SELECT strftime(g.rts, '%Y-%m-%d') AS rts, g.SYMBOL, strftime(g.EXPIRY_DT, '%Y-%m-%d') AS EXPIRY_DT,
       g.INSTRUMENT, g.OPTION_TYP, CAST(g.CONTRACTS AS BIGINT) AS CONTRACTS, round(g.VALUE, 2) AS VALUE,
       round(g.OPEN_INT, 4) AS OPEN_INT, round(p.PCR, 6) AS PCR,
       CAST(year(g.rts) AS INTEGER) AS YEAR, CAST(month(g.rts) AS INTEGER) AS MONTH, CAST(day(g.rts) AS INTEGER) AS DAY
FROM g JOIN p ON g.rts = p.rts AND g.SYMBOL = p.SYMBOL AND g.EXPIRY_DT = p.EXPIRY_DT
""")
def put_call_ratio_job(spark, sf):
    fo = fo_standin(spark, sf)
    g = M.group_contracts(fo, ["rts", "SYMBOL", "INSTRUMENT", "EXPIRY_DT", "OPTION_TYP"])
    out = M.add_put_call_ratio(g, ["rts", "SYMBOL", "EXPIRY_DT"])
    return out.select(
        F.date_format("rts", "yyyy-MM-dd").alias("rts"), "SYMBOL", F.date_format("EXPIRY_DT", "yyyy-MM-dd").alias("EXPIRY_DT"),
        "INSTRUMENT", "OPTION_TYP", F.col("CONTRACTS").cast("bigint").alias("CONTRACTS"),
        F.round("VALUE", 2).alias("VALUE"), F.round("OPEN_INT", 4).alias("OPEN_INT"), F.round("PCR", 6).alias("PCR"),
        F.year("rts").alias("YEAR"), F.month("rts").alias("MONTH"), F.dayofmonth("rts").alias("DAY"))


@query("put_call_pivot_table", "D27,D28", _FO_SQL + """
SELECT SYMBOL, strftime(EXPIRY_DT, '%Y-%m-%d') AS EXPIRY_DT,
       sum(CASE WHEN OPTION_TYP = 'XX' THEN CONTRACTS END) AS XX,
       sum(CASE WHEN OPTION_TYP = 'PE' THEN CONTRACTS END) AS PE,
       sum(CASE WHEN OPTION_TYP = 'CE' THEN CONTRACTS END) AS CE,
       round(sum(CASE WHEN OPTION_TYP = 'PE' THEN CONTRACTS END) / NULLIF(sum(CASE WHEN OPTION_TYP = 'CE' THEN CONTRACTS END), 0), 6) AS PCR
FROM fo WHERE INSTRUMENT <> 'FUTSTK' GROUP BY 1, 2
""")
def _(spark, sf):
    fo = fo_standin(spark, sf)
    p = M.pcr_pivot(fo, ["SYMBOL", "EXPIRY_DT"])
    return p.select("SYMBOL", F.date_format("EXPIRY_DT", "yyyy-MM-dd").alias("EXPIRY_DT"),
                    *[F.col(c).alias(c) for c in M.OPTION_TYPES], F.round("PCR", 6).alias("PCR"))


_DAILY_SQL = _FO_SQL + """,
d AS (SELECT SYMBOL, EXPIRY_DT, rts,
             sum(CASE WHEN OPTION_TYP = 'CE' THEN -CONTRACTS ELSE CONTRACTS END) AS chg_in_oi,
             sum(VAL_INLAKH) / sum(CONTRACTS) AS close
      FROM fo WHERE INSTRUMENT = 'FUTSTK' GROUP BY 1, 2, 3),
s AS (SELECT *, sum(chg_in_oi) OVER (PARTITION BY SYMBOL, EXPIRY_DT ORDER BY rts) AS cum_chg_oi,
             sum(chg_in_oi * close) OVER (PARTITION BY SYMBOL, EXPIRY_DT ORDER BY rts) AS b_s_pl_status FROM d)
"""


def futures_daily(spark, sf):
    fo = fo_standin(spark, sf).where("INSTRUMENT = 'FUTSTK'")
    return fo.groupBy("SYMBOL", "EXPIRY_DT", "rts").agg(
        F.sum(F.when(F.col("OPTION_TYP") == "CE", -F.col("CONTRACTS")).otherwise(F.col("CONTRACTS"))).alias("chg_in_oi"),
        (F.sum("VAL_INLAKH") / F.sum("CONTRACTS")).alias("close"))


def _fmt_status(df):
    return df.select("SYMBOL", F.date_format("EXPIRY_DT", "yyyy-MM-dd").alias("EXPIRY_DT"),
                     F.date_format("rts", "yyyy-MM-dd").alias("rts"), F.col("cum_chg_oi").cast("bigint").alias("cum_chg_oi"),
                     fixed("b_s_pl_status", 2).alias("b_s_pl_status"))


@query("futures_position_status", "L2,E1,E2,E3", _DAILY_SQL + """
SELECT SYMBOL, strftime(EXPIRY_DT, '%Y-%m-%d') AS EXPIRY_DT, strftime(rts, '%Y-%m-%d') AS rts,
       CAST(cum_chg_oi AS BIGINT) AS cum_chg_oi, (floor(b_s_pl_status * 100 + 0.5) / 100) AS b_s_pl_status FROM s
""")
def _(spark, sf):
    return _fmt_status(M.position_status(futures_daily(spark, sf), ["SYMBOL", "EXPIRY_DT"], "rts", "chg_in_oi", "close"))


@query("futures_status_on_expiry", "L3,E8,B12", _DAILY_SQL + """
SELECT SYMBOL, strftime(EXPIRY_DT, '%Y-%m-%d') AS EXPIRY_DT, strftime(rts, '%Y-%m-%d') AS rts,
       CAST(cum_chg_oi AS BIGINT) AS cum_chg_oi, (floor(b_s_pl_status * 100 + 0.5) / 100) AS b_s_pl_status
FROM s WHERE lower(strftime(rts, '%d-%b-%Y')) = lower(strftime(EXPIRY_DT, '%d-%b-%Y'))
""")
def _(spark, sf):
    st = M.position_status(futures_daily(spark, sf), ["SYMBOL", "EXPIRY_DT"], "rts", "chg_in_oi", "close")
    st = st.where(F.lower(F.date_format("rts", "dd-MMM-yyyy")) == F.lower(F.date_format("EXPIRY_DT", "dd-MMM-yyyy")))
    return _fmt_status(st)


_SPREAD_SQL = """
WITH opt AS (
  SELECT CAST(l.l_shipdate AS DATE) AS tsdc, last_day(CAST(l.l_shipdate AS DATE)) AS expdc,
         CASE l.l_returnflag WHEN 'N' THEN 'PE' ELSE 'CE' END AS option_typ,
         floor(p.p_retailprice / {step}) * {step} AS strike_pr, l.l_extendedprice / l.l_quantity AS close
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
idx AS (SELECT CAST(l.l_shipdate AS DATE) AS date, avg(p.p_retailprice) AS nclose
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1),
puts AS (SELECT tsdc, expdc, strike_pr, avg(close) AS px FROM opt WHERE option_typ = 'PE' GROUP BY 1, 2, 3),
j AS (SELECT puts.*, idx.nclose, floor(idx.nclose / {step}) * {step} + {ssa} * {step} AS psl,
             floor(idx.nclose / {step}) * {step} + {bsb} * {step} AS pbl
      FROM puts JOIN idx ON puts.tsdc = idx.date),
s AS (SELECT tsdc, expdc, psl, pbl, nclose, px AS pspr FROM j WHERE strike_pr = psl),
b AS (SELECT tsdc, expdc, px AS pbpr FROM j WHERE strike_pr = pbl)
SELECT strftime(s.tsdc, '%Y-%m-%d') AS tsdc, strftime(s.expdc, '%Y-%m-%d') AS expdc, s.psl, s.pbl,
       floor(s.pspr * 10000 + 0.5) / 10000 AS pspr, floor(b.pbpr * 10000 + 0.5) / 10000 AS pbpr,
       floor(e.nclose * 10000 + 0.5) / 10000 AS expclosingpr,
       {ssa} AS ssa, {bsb} AS bsb,
       floor((s.pspr - b.pbpr - greatest(s.psl - e.nclose, 0) + greatest(s.pbl - e.nclose, 0)) * 10000 + 0.5) / 10000 AS pnl
FROM s JOIN b ON s.tsdc = b.tsdc AND s.expdc = b.expdc
JOIN idx e ON s.expdc = e.date
"""


@query("bull_put_spread_backtest", "L6,C4,C21,H25,H19", _SPREAD_SQL.format(ssa=2, bsb=-1, step=10))
def _(spark, sf):
    t = Tables(spark, sf)
    li, p = t.lineitem, t.part
    j = li.join(p, li.l_partkey == p.p_partkey)
    opt = j.select(F.to_date("l_shipdate").alias("tsdc"), F.last_day(F.to_date("l_shipdate")).alias("expdc"),
                   F.when(F.col("l_returnflag") == "N", "PE").otherwise("CE").alias("option_typ"),
                   (F.floor(F.col("p_retailprice") / 10) * 10).alias("strike_pr"),
                   (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"))
    idx = j.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("p_retailprice").alias("nclose"))
    r = M.bull_put_spread(opt, idx, 2, -1, step=10.0)
    return r.select(F.date_format("tsdc", "yyyy-MM-dd").alias("tsdc"), F.date_format("expdc", "yyyy-MM-dd").alias("expdc"),
                    "psl", "pbl", fixed("pspr", 4).alias("pspr"), fixed("pbpr", 4).alias("pbpr"),
                    fixed("expclosingpr", 4).alias("expclosingpr"), "ssa", "bsb", fixed("pnl", 4).alias("pnl"))


@query("expiry_day_closes", "L7,D20", """
WITH idx AS (SELECT CAST(l.l_shipdate AS DATE) AS date, avg(p.p_retailprice) AS nclose
             FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1)
SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date, round(nclose, 4) AS nclose FROM idx WHERE date = last_day(date)
""")
def _(spark, sf):
    t = Tables(spark, sf)
    li, p = t.lineitem, t.part
    j = li.join(p, li.l_partkey == p.p_partkey)
    idx = j.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("p_retailprice").alias("nclose"))
    exp = idx.select(F.last_day("date").alias("expdc"))
    r = M.expiry_closes(idx, "date", "nclose", exp, "expdc")
    return r.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("nclose", 4).alias("nclose"))


@query("cash_and_derivative_totals", "L28,C23,D14", """
WITH cash AS (SELECT l_suppkey AS symbol, round(sum(l_extendedprice), 2) AS cash_value,
                     CAST(sum(l_quantity) AS BIGINT) AS cash_qty FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
deriv AS (SELECT l_suppkey AS symbol, round(sum(l_extendedprice), 2) AS fo_value,
                 CAST(sum(l_quantity) AS BIGINT) AS fo_contracts FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
SELECT cash.symbol, cash_value, cash_qty, fo_value, fo_contracts FROM cash JOIN deriv ON cash.symbol = deriv.symbol
""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem.withColumnRenamed("l_suppkey", "symbol")
    cash = li.where("l_linestatus = 'F'").groupBy("symbol").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("cash_value"), F.sum("l_quantity").cast("bigint").alias("cash_qty"))
    der = li.where("l_linestatus = 'O'").groupBy("symbol").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("fo_value"), F.sum("l_quantity").cast("bigint").alias("fo_contracts"))
    path = scratch_path(spark, "totals")
    cash.join(der, "symbol").write.parquet(path)              # the job saves its result
    return spark.read.parquet(path)


@query("put_call_ratio_saved_by_month", "L1,A13,A14,D27", _FO_SQL + """,
g AS (SELECT rts, SYMBOL, EXPIRY_DT, sum(CASE WHEN OPTION_TYP = 'PE' THEN CONTRACTS END) AS PE,
             sum(CASE WHEN OPTION_TYP = 'CE' THEN CONTRACTS END) AS CE, sum(CASE WHEN OPTION_TYP = 'XX' THEN CONTRACTS END) AS XX
      FROM fo WHERE INSTRUMENT <> 'FUTSTK' GROUP BY 1, 2, 3)
SELECT CAST(year(rts) AS INTEGER) AS YEAR, CAST(month(rts) AS INTEGER) AS MONTH, count(*) AS contracts,
       count(PE / NULLIF(CE, 0)) AS with_ratio, floor(sum(PE / NULLIF(CE, 0)) * 1e4 + 0.5) / 1e4 AS sum_ratio,
       CAST(sum(XX) AS BIGINT) AS futures_like
FROM g GROUP BY 1, 2
""")
def _(spark, sf):
    """The pivoted ratios written as a partitioned table and read back from it."""
    g = M.group_contracts(fo_standin(spark, sf), ["rts", "SYMBOL", "INSTRUMENT", "EXPIRY_DT", "OPTION_TYP"])
    pcr = M.pcr_pivot(g, ["rts", "SYMBOL", "EXPIRY_DT"]).withColumns({"YEAR": F.year("rts"), "MONTH": F.month("rts")})
    name = f"kestrel_pcr_{uuid.uuid4().hex[:8]}"
    M.write_partitioned(pcr.repartition("YEAR", "MONTH"), scratch_path(spark, name), partition_cols=("YEAR", "MONTH"), table=name)
    return spark.table(name).groupBy("YEAR", "MONTH").agg(
        F.count(F.lit(1)).alias("contracts"), F.count("PCR").alias("with_ratio"),
        fixed(F.sum("PCR"), 4).alias("sum_ratio"), F.sum("XX").cast("bigint").alias("futures_like"))
