"""Totals and series kept up to date: orders come in as history and as later batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from episeries.operators import upkeep
from episeries.operators import windows as w
from episeries.sources.storage import scratch_folder
from episeries.workloads.dated import ORDER_SERIES, ORDERS, change_sql
from episeries.workloads.registry import last_days, rounded, table, workload

MEMBERS = {"status": "total", "priority": "all"}


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


@workload("cube_upkeep", """
    SELECT CAST(o_orderdate AS DATE) AS date,
           CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'total' ELSE o_orderstatus END AS status,
           CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'all' ELSE o_orderpriority END AS priority,
           CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY CAST(o_orderdate AS DATE), CUBE (o_orderstatus, o_orderpriority)
""")
def cube_upkeep(spark, sf):
    """Stored up to the middle of 2000 with partial orders still open; then corrected, then new."""
    orders, path = _orders(spark, sf), f"{scratch_folder(spark)}/cube"
    old, partial = F.col("date") < "2000-07-01", F.col("status") == "P"
    open_ = F.when(partial, F.lit("O")).otherwise(F.col("status"))
    upkeep.store_cube(orders.filter(old).withColumn("status", open_), path, "date", MEMBERS,
                      ["cents"])
    late = orders.filter(old & partial)
    upkeep.merge_cube(late, late.withColumn("status", F.lit("O")), 0, path, "date", MEMBERS,
                      ["cents"])
    for _ in range(2):  # the second time changes nothing
        upkeep.merge_cube(orders.filter(~old), orders.limit(0), 1, path, "date", MEMBERS, ["cents"])
    return upkeep.stored_cube(spark, path)


def _derive(panel):
    window = w.series("priority", "status")
    df = w.with_day(panel).withColumns({
        "total": upkeep.running_total("n", window),
        "mean": upkeep.running_mean("n", window),
        "sum_14d": w.rolling_sum(F.col("n"), window, 14),
        "delta": w.day_delta(F.col("n"), window),
    })
    return w.smoothed_changes(df, "n", window, {"monthly_increase": (60, 30)}).drop(w.DAY)


SERIES = upkeep.Series(["priority", "status"], ["n"], _derive, days=60, rows_back=30)


@workload("series_upkeep", f"""
    WITH {ORDERS}, s AS (SELECT *, AVG(n) OVER ({ORDER_SERIES} {last_days(60)}) AS m60 FROM daily),
      l AS (SELECT *, LAG(m60, 30) OVER ({ORDER_SERIES}) AS l60 FROM s)
    SELECT priority, status, date, n,
      CAST(SUM(n) OVER ({ORDER_SERIES} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
      ROUND(AVG(n) OVER ({ORDER_SERIES} ROWS UNBOUNDED PRECEDING), 6) AS mean,
      CAST(SUM(n) OVER ({ORDER_SERIES} {last_days(14)}) AS BIGINT) AS sum_14d,
      n - LAG(n) OVER ({ORDER_SERIES}) AS delta,
      ROUND({change_sql('l60', 'm60')}, 6) AS monthly_increase FROM l
""")
def series_upkeep(spark, sf):
    """Stored up to the middle of 2000, the last weeks of it wrong; then corrected and prolonged."""
    daily = _orders(spark, sf).groupBy("priority", "status", "date").agg(F.count("*").alias("n"))
    path = f"{scratch_folder(spark)}/series"
    sure, known = F.col("date") < "2000-05-20", F.col("date") < "2000-07-01"
    unknown = daily.filter(known & ~sure).withColumn("status", F.lit("unknown")).groupBy(
        "priority", "status", "date").agg(F.sum("n").alias("n"))
    guessed = daily.filter(known & ~sure).withColumn("n", F.col("n") + 1)
    upkeep.store_series(daily.filter(sure).unionByName(guessed).unionByName(unknown), path, SERIES)
    changes = daily.filter(~sure).withColumn(upkeep.DELETED, F.lit(False)).unionByName(
        unknown.withColumn(upkeep.DELETED, F.lit(True)))
    upkeep.correct_series(changes, path, SERIES)
    return rounded(upkeep.stored_series(spark, path))
