"""Tables kept up to date equal those built anew, and read no more than they need."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from episeries.operators import totals, upkeep
from episeries.sources import storage
from episeries.workloads.kept_up import SERIES

MEMBERS = {"status": "total", "priority": "all"}
START = datetime.date(2020, 1, 1)


def cells(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def panel(spark, rows):
    return spark.createDataFrame(
        [(p, s, d, n) for (p, s, d), n in rows.items()],
        "priority string, status string, date date, n long")


@pytest.mark.parametrize("seed", [1])
def test_corrected_series_equal_the_full_rebuild(spark, tmp_path, seed):
    dice = random.Random(seed)
    days = [START + datetime.timedelta(i) for i in range(400)]
    # one series with gaps, one that ends early, one with NULL measures
    rows = {("a", "x", d): dice.randrange(9) for d in days if dice.random() < 0.3}
    rows |= {("a", "y", d): dice.randrange(9) for d in days[:90]}
    rows |= {("b", "x", d): dice.choice([None, 1, 5]) for d in days}
    path = str(tmp_path / "series")
    upkeep.store_series(panel(spark, rows), path, SERIES)
    for number in range(2):
        first = dice.randrange(250, 380)
        changed = {}
        for key in list(rows):
            if key[2] >= days[first] and dice.random() < 0.2:
                changed[key] = None if dice.random() < 0.3 else dice.randrange(20)
        deleted = [k for k in changed if dice.random() < 0.5]
        changed[("c", "new", days[first] + datetime.timedelta(40))] = 7
        if number:  # a whole month of all series goes
            month = (days[-1].year, days[-1].month)
            deleted += [k for k in rows if (k[2].year, k[2].month) == month]
            changed |= {k: rows[k] for k in deleted if k in rows and k not in changed}
        df = panel(spark, changed).join(
            spark.createDataFrame([(*k, True) for k in deleted] or [("", "", START, True)],
                                  f"priority string, status string, date date, {upkeep.DELETED} boolean"),
            ["priority", "status", "date"], "left")
        for _ in range(2):  # run again: nothing changes
            upkeep.correct_series(df, path, SERIES)
        rows = {k: v for k, v in (rows | changed).items() if k not in set(deleted)}
        whole = str(tmp_path / f"whole{number}")
        upkeep.store_series(panel(spark, rows), whole, SERIES)
        got, want = (upkeep.stored_series(spark, p) for p in (path, whole))
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        assert got.count() == len(rows)


def test_only_the_tail_is_needed(spark):
    sums = spark.createDataFrame(
        [("a", "x", m, 30) for m in range(100, 140)] + [("old", "x", m, 2) for m in range(100, 120)],
        f"priority string, status string, {upkeep.MONTH} int, {upkeep.ROWS} long")
    # 30 rows back lie in month 138, and 59 days before it reach into 135 at most;
    # the series that has ended asks for nothing
    assert upkeep.first_needed(sums, SERIES, 139) == 135


def test_empty_changes_and_tables(spark, tmp_path):
    path = str(tmp_path / "series")
    upkeep.store_series(panel(spark, {("a", "x", START): 1}).limit(0), path, SERIES)
    upkeep.correct_series(panel(spark, {("a", "x", START): 1}).limit(0), path, SERIES)
    upkeep.correct_series(panel(spark, {("a", "x", START): 1, (None, "x", START): 2}), path, SERIES)
    assert [r["total"] for r in upkeep.stored_series(spark, path).collect()] == [1]


def test_merged_cube_equals_the_full_cube(spark, tmp_path):
    dice = random.Random(3)
    schema = "date date, status string, priority string, n long"

    def some(count, first, last):
        return [(START + datetime.timedelta(dice.randrange(first, last)), dice.choice("xyz"),
                 dice.choice(["p", "q", None]), dice.choice([None, 1, 2])) for _ in range(count)]

    rows, path = some(200, 0, 150), str(tmp_path / "cube")
    upkeep.store_cube(spark.createDataFrame(rows, schema), path, "date", MEMBERS, ["n"])
    for batch in range(3):
        gone = dice.sample(rows, 60)
        if batch == 2:  # the first month is emptied
            gone = [r for r in rows if r[0].month == 1]
        new = some(50, 60, 200)
        added, removed = spark.createDataFrame(new, schema), spark.createDataFrame(gone, schema)
        for _ in range(2):
            upkeep.merge_cube(added, removed, batch, path, "date", MEMBERS, ["n"])
        for row in gone:
            rows.remove(row)
        rows += new
        want = totals.cube_totals(spark.createDataFrame(rows, schema), ["date"], MEMBERS, ["n"])
        assert cells(upkeep.stored_cube(spark, path)) == cells(want)
    assert not (tmp_path / "cube" / f"{upkeep.MONTH}={2020 * 12}").exists()


def test_a_failed_version_leaves_the_last_one_readable(spark, tmp_path):
    root = str(tmp_path / "layer")

    def write(n, fail=False):
        with storage.new_version(spark, root) as folder:
            spark.range(n).write.parquet(f"{folder}/one")
            if fail:
                raise OSError("lost")
            spark.range(n).select(F.col("id") * 2).write.parquet(f"{folder}/two")

    def sizes():
        now = storage.current_version(spark, root)
        return [spark.read.parquet(f"{now}/{t}").count() for t in ("one", "two")]

    assert storage.current_version(spark, root) == root
    write(2)
    with pytest.raises(OSError):
        write(3, fail=True)
    assert sizes() == [2, 2]
    write(4)
    write(5)
    assert sizes() == [5, 5]
    assert len(list((tmp_path / "layer").iterdir())) == 2
