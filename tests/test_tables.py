"""Tables by day, checks while writing, profiles of many columns and lines that don't read."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from nightledger.operators import prep, quality
from nightledger.sources import files, tables

DAYS = [date(2016, 3, n) for n in (1, 2, 3)]


def days_frame(spark, rows):
    return spark.createDataFrame(rows, "room int, rooms int, d date")


def parts(path):
    return {p.parent.name: {q.name for q in p.parent.glob("part-*")} for p in path.rglob("part-*")}


def test_only_the_refreshed_days_change(spark, tmp_path):
    path = tmp_path / "log"
    tables.refresh_days(days_frame(spark, [(i, i, d) for d in DAYS for i in range(40)]), str(path))
    before = parts(path)
    anew = days_frame(spark, [(1, 100, DAYS[1]), (2, 200, DAYS[1]), (3, 300, date(2016, 3, 9))])
    for _ in range(2):  # again gives the same
        tables.refresh_days(anew, str(path))
        table = tables.read_table(spark, str(path))
        got = {r.d: (r.n, r.s) for r in table.groupBy("d").agg(F.count("*").alias("n"), F.sum("rooms").alias("s")).collect()}
        assert got == {DAYS[0]: (40, 780), DAYS[1]: (2, 300), DAYS[2]: (40, 780), date(2016, 3, 9): (1, 300)}
    after = parts(path)
    assert after["d=2016-03-01"] == before["d=2016-03-01"] and after["d=2016-03-03"] == before["d=2016-03-03"]
    assert not after["d=2016-03-02"] & before["d=2016-03-02"]


def test_the_days_of_targets_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.refresh_days(days_frame(spark, [(i, i, d) for d in DAYS for i in range(5)]), path)
    targets = spark.createDataFrame([(1, DAYS[0]), (2, DAYS[0]), (3, None), (4, DAYS[2])], "orderid int, ordd date")
    table = tables.read_table(spark, path)
    picked = tables.of_days(table, targets.where("orderid < 4").select("ordd"))
    assert "dynamicpruning" in picked._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, picked.collect())) == [(i, i, DAYS[0]) for i in range(5)]
    assert picked.columns == table.columns


def test_counts_while_writing_are_those_of_a_scan(spark, tmp_path):
    frame = spark.range(1000).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("kind"))
    tests = {"even": F.col("id") % 2 == 0, "known": F.col("kind").isNotNull()}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "one job")
    try:
        counts, shares = tables.save_observed(frame, str(tmp_path / "x"), tests, ["id", "kind"])
        assert len(tracker.getJobIdsForGroup("observed")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == quality.quality_counts(frame, tests).first().asDict()
    assert shares == {r.column_name: r.null_rate for r in quality.null_rates(frame).collect()}
    assert spark.read.parquet(str(tmp_path / "x")).count() == 1000
    counts, shares = tables.save_observed(frame.limit(0), str(tmp_path / "y"), tests, ["id"])
    assert counts == {"total": 0, "even": 0, "known": 0} and shares == {"id": None}


def test_profile_of_twenty_columns_in_one_shuffle(spark):
    k = F.col("id")
    frame = spark.range(3000).select(*[F.when(k % (i + 2) > 0, F.least(k % 11, F.lit(i))).alias(f"c{i}") for i in range(19)], F.lit(None).cast("string").alias("none"))
    per_value = quality.column_values(frame, frame.columns)
    plan = per_value._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    got = {r.column_name: r for r in quality.profile(frame).collect()}
    assert set(got) == set(frame.columns)
    rows = frame.collect()
    for c in frame.columns:
        values = [str(r[c]) for r in rows if r[c] is not None]
        most = min(set(values), key=lambda v: (-values.count(v), v), default=None)
        r = got[c]
        assert (r.total, r.missing, r.distinct_values, r.commonest) == (3000, 3000 - len(values), len(set(values)), most)
        assert r.commonest_n == (values.count(most) if values else None)


def test_categories_of_all_types_in_one_pass(spark):
    rows = [("é", 10, True, 2.5, date(2016, 1, 2)), ("PP", 9, False, -1e300, date(2015, 1, 2)), (None, None, None, None, None), ("", -3, True, 0.1, date(2016, 1, 2))]
    frame = spark.createDataFrame(rows, "a string, b int, c boolean, d double, e date")
    assert prep.fit_categories(frame, frame.columns) == {
        "a": ["", "PP", "é"], "b": [-3, 9, 10], "c": [False, True], "d": [-1e300, 0.1, 2.5], "e": [date(2015, 1, 2), date(2016, 1, 2)]
    }
    assert prep.fit_categories(frame.limit(0), ["a", "b"]) == {"a": [], "b": []}
    with pytest.raises(ValueError, match="b has more than 2"):
        prep.fit_categories(frame, ["c", "b"], most=2)
    with pytest.raises(ValueError, match="type: f"):
        prep.fit_categories(frame.withColumn("f", F.array("b")), ["a", "f"])


def test_lines_that_do_not_read_go_aside(spark, tmp_path):
    lines = ["orderid\tcityi\tordd", "1\t0.5\t2016-04-01", "2\tNULL\tNULL", "3\t0.5", "4\tx\t2016-04-01", "5\t1\t2016-13-45", "NULL\t1\t2016-04-01", "7\t1\t2016-04-02\textra", "b8\t1\t2016-04-01"]
    (tmp_path / "dump.csv").write_text("\n".join(lines) + "\n")
    rows, bad = files.read_checked(spark, str(tmp_path / "dump.csv"), "orderid int, cityi double, ordd date", keys=["orderid"])
    assert sorted(map(tuple, rows.collect())) == [(1, 0.5, date(2016, 4, 1)), (2, None, None)]
    assert sorted(r.line for r in bad.collect()) == sorted(["3\t0.5", "4\tx\t2016-04-01", "5\t1\t2016-13-45", "NULL\t1.0\t2016-04-01", "7\t1\t2016-04-02\textra", "b8\t1\t2016-04-01"])
    assert rows.count() + bad.count() == len(lines) - 1


def test_text_keys_that_are_no_number(spark):
    frame = spark.createDataFrame([("1", 1), ("x", 2), (None, 3), ("99999999999999999999", 4), ("12", 5)], "key string, n int")
    numbers, others = files.keyed_by_number(frame, "key")
    assert sorted(map(tuple, numbers.collect())) == [(1, 1), (12, 5)]
    assert sorted(r.n for r in others.collect()) == [2, 3, 4]
