"""Series windows on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from episeries.functions.measures import per_population
from episeries.operators import windows as w
from episeries.workloads.registry import last_days, rounded, table, workload

EVENTS = """daily AS (SELECT event_type, CAST(ts AS DATE) AS date, COUNT(*) AS n
                     FROM events GROUP BY ALL)"""
EVENT_SERIES = "PARTITION BY event_type ORDER BY date"
ORDERS = """daily AS (SELECT o_orderpriority AS priority, o_orderstatus AS status,
                            CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n
                     FROM orders GROUP BY ALL)"""
ORDER_SERIES = "PARTITION BY priority, status ORDER BY date"


def _events(spark, sf):
    return w.with_day(table(spark, sf, "events").groupBy(
        "event_type", F.to_date("ts").alias("date")
    ).agg(F.count("*").alias("n")))


def _orders(spark, sf):
    return w.with_day(table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("date"),
    ).agg(F.count("*").alias("n")))




def _event_window():
    return w.series("event_type")


def _order_window():
    return w.series("priority", "status")


@workload("rolling_sum_14d", f"""
    WITH {EVENTS} SELECT event_type, date, n,
      CAST(SUM(n) OVER ({EVENT_SERIES} {last_days(14)}) AS BIGINT) AS sum_14d,
      ROUND(1e5 * CAST(SUM(n) OVER ({EVENT_SERIES} {last_days(14)}) AS BIGINT) / 1e6, 6) AS rate
    FROM daily
""")
def rolling_sum_14d(spark, sf):
    total = w.rolling_sum(F.col("n"), _event_window(), 14)
    return rounded(_events(spark, sf).select(
        "event_type", "date", "n", total.alias("sum_14d"),
        per_population(total, F.lit(1e6)).alias("rate"),
    ))


@workload("rolling_mean_8d_15d", f"""
    WITH {EVENTS} SELECT event_type, date,
      ROUND(AVG(n) OVER ({EVENT_SERIES} {last_days(8)}), 6) AS ma_1w,
      ROUND(AVG(n) OVER ({EVENT_SERIES} {last_days(15)}), 6) AS ma_2w
    FROM daily
""")
def rolling_mean(spark, sf):
    return rounded(_events(spark, sf).select(
        "event_type", "date",
        w.rolling_mean(F.col("n"), _event_window(), 8).alias("ma_1w"),
        w.rolling_mean(F.col("n"), _event_window(), 15).alias("ma_2w"),
    ))


@workload("running_total", f"""
    WITH {ORDERS} SELECT priority, status, date,
      CAST(SUM(n) OVER ({ORDER_SERIES} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM daily
""")
def running_total(spark, sf):
    return _orders(spark, sf).select(
        "priority", "status", "date", w.running_total(F.col("n"), _order_window()).alias("total")
    )


@workload("running_mean", f"""
    WITH {ORDERS} SELECT priority, status, date,
      ROUND(AVG(n) OVER ({ORDER_SERIES} ROWS UNBOUNDED PRECEDING), 9) AS mean FROM daily
""")
def running_mean(spark, sf):
    return rounded(_orders(spark, sf).select(
        "priority", "status", "date", w.running_mean(F.col("n"), _order_window()).alias("mean")
    ), 9)


def change_sql(first: str, last: str) -> str:
    return f"CASE WHEN {first} = 0 THEN 0 ELSE 1e2 * (CAST({last} - {first} AS DOUBLE) / {first}) END"


@workload("smoothed_pct_change", f"""
    WITH {ORDERS}, s AS (SELECT *,
        AVG(n) OVER ({ORDER_SERIES} {last_days(7)}) AS m7,
        AVG(n) OVER ({ORDER_SERIES} {last_days(14)}) AS m14,
        AVG(n) OVER ({ORDER_SERIES} {last_days(60)}) AS m60 FROM daily),
      l AS (SELECT *, LAG(m7, 1) OVER ({ORDER_SERIES}) AS l7, LAG(m14, 7) OVER ({ORDER_SERIES}) AS l14,
        LAG(m60, 30) OVER ({ORDER_SERIES}) AS l60 FROM s)
    SELECT priority, status, date, ROUND({change_sql('l7', 'm7')}, 6) AS daily_increase,
      ROUND({change_sql('l14', 'm14')}, 6) AS weekly_increase,
      ROUND({change_sql('l60', 'm60')}, 6) AS monthly_increase FROM l
""")
def smoothed_pct_change(spark, sf):
    return rounded(w.smoothed_changes(_orders(spark, sf), "n", _order_window(), {
        "daily_increase": (7, 1), "weekly_increase": (14, 7), "monthly_increase": (60, 30),
    }).drop(w.DAY, "n"))


@workload("range_pct_change", f"""
    WITH {ORDERS}, f AS (SELECT *,
        FIRST_VALUE(n) OVER ({ORDER_SERIES} {last_days(2)}) AS f2,
        FIRST_VALUE(n) OVER ({ORDER_SERIES} {last_days(8)}) AS f8,
        FIRST_VALUE(n) OVER ({ORDER_SERIES} {last_days(15)}) AS f15,
        FIRST_VALUE(n) OVER ({ORDER_SERIES} {last_days(31)}) AS f31 FROM daily)
    SELECT priority, status, date, ROUND({change_sql('f2', 'n')}, 6) AS daily_increase,
      ROUND({change_sql('f8', 'n')}, 6) AS weekly_increase,
      ROUND({change_sql('f15', 'n')}, 6) AS two_weeks_increase,
      ROUND({change_sql('f31', 'n')}, 6) AS monthly_increase FROM f
""")
def range_pct_change(spark, sf):
    spans = {"daily": 2, "weekly": 8, "two_weeks": 15, "monthly": 31}
    return rounded(_orders(spark, sf).withColumns({
        f"{name}_increase": w.range_change(F.col("n"), _order_window(), days)
        for name, days in spans.items()
    }).drop(w.DAY, "n"))


@workload("delta_rolling_7d", f"""
    WITH {ORDERS}, x AS (SELECT *, n - LAG(n) OVER ({ORDER_SERIES}) AS delta FROM daily)
    SELECT priority, status, date, delta,
      ROUND(AVG(delta) OVER ({ORDER_SERIES} {last_days(7)}), 6) AS ma_7d FROM x
""")
def delta_rolling_7d(spark, sf):
    df = _orders(spark, sf).withColumn("delta", w.day_delta(F.col("n"), _order_window()))
    return rounded(df.select(
        "priority", "status", "date", "delta",
        w.rolling_mean(F.col("delta"), _order_window(), 7).alias("ma_7d"),
    ))
