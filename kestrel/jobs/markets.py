"""Market-data jobs.

Input frames use the daily derivatives layout (SYMBOL, EXPIRY_DT,
INSTRUMENT, OPTION_TYP, STRIKE_PR, CLOSE, CONTRACTS, VAL_INLAKH, OPEN_INT,
CHG_IN_OI, trade date) with names passed as parameters, so the same code
runs on real bhavcopy files and on the driver's stand-in tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Option-type codes of the daily derivatives file.
OPTION_TYPES = ["XX", "PE", "CE"]
FUTURES_STOCK = "FUTSTK"


def parse_month_name_date(col: Column | str) -> Column:
    """H17: '28-Sep-2023' / '28-SEP-2023' → date (no UDF; the pattern parses
    month names in any case).  Unparsable text gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.try_to_timestamp(c, F.lit("dd-MMM-yyyy")))


def group_contracts(df: DataFrame, keys: list[str], contracts="CONTRACTS", value="VAL_INLAKH",
                    oi="OPEN_INT") -> DataFrame:
    """L1 step 1: per (date, symbol, instrument, expiry, option type, ...)
    sums of contracts, value and open interest (partial aggregation)."""
    return df.groupBy(*keys).agg(F.sum(contracts).alias("CONTRACTS"), F.sum(value).alias("VALUE"),
                                 F.sum(oi).alias("OPEN_INT"))


def add_put_call_ratio(grouped: DataFrame, ratio_keys: list[str], instrument="INSTRUMENT",
                       option="OPTION_TYP") -> DataFrame:
    """L1 steps 2-4: put/call ratio per (date, symbol, expiry) attached to
    every grouped row of that key.

    The reference pivots the non-futures rows to XX/PE/CE columns, divides
    PE by CE and joins the ratio back.  Here the same numbers come from
    conditional sums over a window partitioned by the ratio keys: the
    grouped data is shuffled once on those keys and no join is needed.  Keys
    that have only futures rows drop out, exactly as in the inner join.
    ``try_divide`` gives NULL when CE is 0 (ANSI would raise)."""
    w = Window.partitionBy(*ratio_keys)
    is_opt = F.col(instrument) != F.lit(FUTURES_STOCK)
    pe = F.sum(F.when(is_opt & (F.col(option) == "PE"), F.col("CONTRACTS"))).over(w)
    ce = F.sum(F.when(is_opt & (F.col(option) == "CE"), F.col("CONTRACTS"))).over(w)
    n_opt = F.sum(F.when(is_opt, 1).otherwise(0)).over(w)
    return (grouped.withColumn("__nopt", n_opt).where("__nopt > 0")
                   .withColumn("PCR", F.try_divide(pe, ce)).drop("__nopt"))


def pcr_pivot(grouped: DataFrame, ratio_keys: list[str], instrument="INSTRUMENT", option="OPTION_TYP") -> DataFrame:
    """D27/D28 as in the reference: pivot with the fixed value list (no
    extra distinct job) and the PE/CE ratio."""
    return (grouped.where(F.col(instrument) != F.lit(FUTURES_STOCK))
                   .groupBy(*ratio_keys).pivot(option, OPTION_TYPES).agg(F.sum("CONTRACTS"))
                   .withColumn("PCR", F.try_divide(F.col("PE"), F.col("CE"))))


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite", partition_cols=("YEAR", "MONTH", "DAY"),
                      table: str | None = None) -> None:
    """Partitioned parquet write, optionally registered as an
    external catalog table."""
    w = df.write.partitionBy(*partition_cols).mode(mode).format("parquet").option("path", path)
    if table:
        w.saveAsTable(table)
    else:
        w.save()


def position_status(df: DataFrame, keys: list[str], order: str, chg_oi: str, close: str) -> DataFrame:
    """L2: cumulative change in open interest and the buyers'/sellers'
    running position value Σ chg_oi · close per contract, SQL default
    frame (peers share a total)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return (df.withColumn("cum_chg_oi", F.sum(chg_oi).over(w))
              .withColumn("b_s_pl_status", F.sum(F.col(chg_oi) * F.col(close)).over(w)))


def status_on_expiry(status: DataFrame, trade_date: str, expiry: str) -> DataFrame:
    """L3: position status on expiry day only (window first, then filter —
    the filter must not move below the window)."""
    return status.where(F.col(trade_date) == F.col(expiry))


def expiry_closes(index_close: DataFrame, date: str, close: str, expiry_dates: DataFrame, expiry: str) -> DataFrame:
    """Distinct (date, close) of the index on expiry days."""
    e = expiry_dates.select(F.col(expiry).alias(date)).distinct()
    return index_close.join(e, date, "left_semi").select(date, close).distinct()


def bull_put_spread(options: DataFrame, index_close: DataFrame, sell_steps: int, buy_steps: int,
                    step: float = 50.0, trade_date="tsdc", expiry="expdc", strike="strike_pr",
                    close="close", opt="option_typ", idx_date="date", idx_close="nclose") -> DataFrame:
    """Bull-put-spread back-test.

    ATM strike = floor(index close / step) · step on the trade date; sell the
    put ``sell_steps`` steps away (psl), buy the put ``buy_steps`` away (pbl),
    price both legs at that day's close, settle at the index close on the
    expiry date.  Legs are made unique per (trade date, expiry, strike)
    first, so a sell leg meets one buy leg (fixes the reference's always-true
    predicate).  The index-close table has one row per calendar day; Spark plans
    its joins by size."""
    idx = index_close.select(F.col(idx_date).alias("__d"), F.col(idx_close).alias("__c"))
    puts = (options.where(F.col(opt) == "PE")
                   .groupBy(trade_date, expiry, strike).agg(F.avg(close).alias("__px")))
    j = puts.join(idx, puts[trade_date] == idx["__d"]).withColumn(
        "__atm", F.floor(F.col("__c") / step) * step)
    j = (j.withColumn("psl", F.col("__atm") + F.lit(sell_steps * step))
          .withColumn("pbl", F.col("__atm") + F.lit(buy_steps * step)))
    # both legs from one pass over the puts: a strike is the sell leg, the buy leg or none
    legs = (j.where((F.col(strike) == F.col("psl")) | (F.col(strike) == F.col("pbl")))
             .groupBy(trade_date, expiry, "psl", "pbl", F.col("__c").alias("nclose"))
             .agg(F.max(F.when(F.col(strike) == F.col("psl"), F.col("__px"))).alias("pspr"),
                  F.max(F.when(F.col(strike) == F.col("pbl"), F.col("__px"))).alias("pbpr"))
             .where("pspr IS NOT NULL AND pbpr IS NOT NULL"))
    settle = idx.select(F.col("__d").alias("__ed"), F.col("__c").alias("expclosingpr"))
    out = legs.join(settle, legs[expiry] == settle["__ed"]).drop("__ed")
    payoff = (F.col("pspr") - F.col("pbpr")
              - F.greatest(F.col("psl") - F.col("expclosingpr"), F.lit(0.0))
              + F.greatest(F.col("pbl") - F.col("expclosingpr"), F.lit(0.0)))
    return out.withColumn("ssa", F.lit(sell_steps)).withColumn("bsb", F.lit(buy_steps)).withColumn("pnl", payoff)
