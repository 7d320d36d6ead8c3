"""Windows, totals, reshape and joins against plain Python."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from episeries.operators import combine, recode, reshape, totals, windows as w

START = datetime.date(2021, 1, 1)


def day(n):
    return START + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def points():
    rng = random.Random(7)
    rows = {}
    for key in "ab":
        for n in range(90):
            if rng.random() < 0.7:  # gaps
                rows[key, n] = rng.choice([0, 0, 1, 5, 12])
    return rows


@pytest.fixture(scope="module")
def series_frame(spark, points):
    df = spark.createDataFrame(
        [(k, day(n), v) for (k, n), v in points.items()], "k string, date date, v long"
    )
    return w.with_day(df)


def by_point(df, name):
    return {(r["k"], (r["date"] - START).days): r[name] for r in df.collect()}


def change(first, last):
    return 0.0 if first == 0 else 100.0 * ((last - first) / first)


def test_calendar_windows(series_frame, points):
    window = w.series("k")
    got = series_frame.select(
        "k", "date",
        w.rolling_sum(F.col("v"), window, 14).alias("s"),
        w.rolling_mean(F.col("v"), window, 8).alias("m"),
        w.range_change(F.col("v"), window, 15).alias("c"),
        w.running_total(F.col("v"), window).alias("t"),
        w.running_mean(F.col("v"), window).alias("a"),
        w.day_delta(F.col("v"), window).alias("d"),
    )
    columns = {n: by_point(got, n) for n in "smctad"}
    for (k, n), v in points.items():
        def inside(days):
            return [points[k, i] for i in range(n - days + 1, n + 1) if (k, i) in points]

        before = [points[k, i] for i in range(n + 1) if (k, i) in points]
        assert columns["s"][k, n] == sum(inside(14))
        assert columns["m"][k, n] == pytest.approx(sum(inside(8)) / len(inside(8)))
        assert columns["c"][k, n] == pytest.approx(change(inside(15)[0], v))
        assert columns["t"][k, n] == sum(before)
        assert columns["a"][k, n] == pytest.approx(sum(before) / len(before))
        assert columns["d"][k, n] == (v - before[-2] if len(before) > 1 else None)


def test_smoothed_changes_stay_in_their_series(series_frame, points):
    got = by_point(
        w.smoothed_changes(series_frame, "v", w.series("k"), {"x": (7, 3)}), "x"
    )
    for key in "ab":
        days = sorted(n for k, n in points if k == key)
        means = []
        for n in days:
            inside = [points[key, i] for i in range(n - 6, n + 1) if (key, i) in points]
            means.append(sum(inside) / len(inside))
        for i, n in enumerate(days):
            expected = None if i < 3 else change(means[i - 3], means[i])
            assert got[key, n] == (expected if expected is None else pytest.approx(expected))


def test_top_rows_breaks_ties_and_limits_before_the_exchange(spark):
    rows = [("g", f"c{i:02d}", 5) for i in range(20)] + [("h", "x", 1)]
    df = spark.createDataFrame(rows, "g string, name string, n long")
    top = w.top_rows(df, ["g"], [F.col("n").desc(), F.col("name")], 10)
    assert sorted(r["name"] for r in top.filter("g = 'g'").collect()) == [
        f"c{i:02d}" for i in range(10)
    ]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_cube_totals_are_sums_of_their_parts(spark):
    rng = random.Random(3)
    rows = [(day(rng.randrange(3)), rng.choice("ab"), rng.choice("xy"), rng.choice("pq"), 1, None)
            for _ in range(60)] + [(day(0), None, "x", "p", 99, None)]
    df = spark.createDataFrame(rows, "date date, r string, g string, a string, n long, z long")
    cube = totals.cube_totals(df, ["date"], {"r": "R", "g": "G", "a": "A"}, ["n", "z"])
    expected = defaultdict(int)
    for date, r, g, a, n, _ in rows:
        if r is None:
            continue
        for rr in (r, "R"):
            for gg in (g, "G"):
                for aa in (a, "A"):
                    expected[date, rr, gg, aa] += n
    got = {(x["date"], x["r"], x["g"], x["a"]): x["n"] for x in cube.collect()}
    assert got == expected
    assert {x["z"] for x in cube.collect()} == {0}  # a sum of nothing is 0


def test_both_national_rows_agree(spark):
    df = spark.createDataFrame(
        [(day(0), "a", 1, 10.0, "t"), (day(0), "b", None, None, "u"), (day(1), "a", None, None, "v")],
        "date date, region string, n long, p double, other string",
    )
    args = (["date"], "region", "ALL", ["n"], ["p"])
    one = sorted(map(str, totals.append_national(df, *args).collect()))
    two = sorted(map(str, totals.expand_national(df, *args).select(df.columns).collect()))
    assert one == two
    national = {r["date"]: (r["n"], r["p"]) for r in totals.append_national(df, *args)
                .filter("region = 'ALL'").collect()}
    assert national == {day(0): (1, 10.0), day(1): (0, None)}


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([("a", "M", 1), ("a", "F", 2), ("b", "M", 3)],
                               "k string, g string, n long")
    wide = reshape.pivot_unique(df, ["k"], "g", ["M", "F"], "n")
    assert {tuple(r) for r in wide.collect()} == {("a", 1, 2), ("b", 3, None)}
    back = reshape.unpivot(wide, ["k"], ["M", "F"], "g", "n").filter("n is not null")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    with pytest.raises(Exception, match="more than one row"):
        reshape.pivot_unique(df.union(df), ["k"], "g", ["M", "F"], "n").collect()


def test_snapshot_difference_is_keyed(spark):
    df = spark.createDataFrame(
        [("a", day(0), 5), ("a", day(365), 12), ("b", day(365), 7), ("c", day(0), 1)],
        "k string, date date, n long",
    )
    got = combine.snapshot_difference(df, ["k"], "date", "n", str(day(365)))
    assert {tuple(r) for r in got.collect()} == {("a", 7), ("b", None)}


def test_recodes(spark):
    df = spark.createDataFrame([("H", 1), ("Z", 2), (None, 3)], "g string, n long")
    got = recode.recode(df, "g", {"H": "M"}).orderBy("n")
    assert [r["g"] for r in got.collect()] == ["M", "Z", None]
    assert recode.different_from(df, "g", "H").count() == 2
    assert recode.complete_rows(df).count() == 2
    nested = recode.nest_dotted(df.select("n", F.col("g").alias("a.b"), F.col("n").alias("a.c")))
    assert nested.columns == ["n", "a"]
    assert recode.flatten(nested, {"x": "a.b"}).columns == ["n", "x"]


def test_union_and_new_inputs(spark):
    a = spark.createDataFrame([(1, "x")], "id long, p string")
    b = spark.createDataFrame([("q", 2)], "q string, id long")
    assert {tuple(r) for r in combine.union_rows(a, b).collect()} == {(1, "x", None), (2, None, "q")}
    assert [r["id"] for r in combine.new_inputs(b, a.select("id"), "id").collect()] == [2]


def test_hot_key_join_is_split(spark):
    """A customer with most orders is spread over tasks by the adaptive join."""
    saved = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
            F.md5(F.col("id").cast("string")).alias("pad"),
        )
        keys = spark.range(0, 200_000).select(F.col("id").alias("k"), F.lit(1).alias("one"))
        joined = combine.lookup_join(facts, keys, "k")
        hot = joined.groupBy("one").agg(F.count("*").alias("n"), F.count_distinct("pad").alias("d"))
        row = hot.collect()[0]
        assert (row["n"], row["d"]) == (200_000, 200_000)
        assert "skew=true" in hot._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
        for k in set(small) - set(saved):
            spark.conf.unset(k)
