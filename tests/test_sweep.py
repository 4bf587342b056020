"""Sweeps: logs that many runs write at once, runs that fail, and all curves in one pass."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from nightledger.operators import evaluate, sweep
from nightledger.sources import files

AXES = {"depth": (1, 2), "colsample": (0.5, 1.0), "subsample": (0.8, 1.0), "learning_rate": (0.1, 0.2, 0.3)}
SMALL = {"maxIter": 1, "minInstancesPerNode": 1}


def lines(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows(spark):
    k = F.col("id")
    return spark.range(300).select(
        (k % 2).cast("double").alias("a"),
        (k % 7).cast("double").alias("b"),
        ((k % 2 + k % 7) > 3).cast("int").alias("isbookable"),
        F.when(k % 3 == 0, "train").when(k % 3 == 1, "validation").otherwise("test").alias("slice"),
    )


def test_writers_at_the_same_time_lose_no_line(spark, tmp_path):
    path = str(tmp_path / "log")
    wanted = [(i % 5, i / 100, 0.5, 0.1, i / 1000) for i in range(24)]

    def write(row):
        combo = dict(zip(sweep.PARAMETERS, row))
        files.log_run(spark.createDataFrame([row], files.GRID_LOG), path, sweep.run_name(combo))

    assert lines(files.read_runs(spark, path)) == []
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, wanted))
    assert lines(files.read_runs(spark, path)) == sorted(wanted)
    write(wanted[3][:4] + (0.9,))  # made again: replaced, not doubled
    assert lines(files.read_runs(spark, path)) == sorted([*wanted[:3], wanted[3][:4] + (0.9,), *wanted[4:]])


def test_lines_of_an_older_log_count_too(spark, tmp_path):
    path = str(tmp_path / "log")
    files.append_grid_log(spark.createDataFrame([(5, 0.5, 0.5, 0.02, 0.1)], files.GRID_LOG), path)
    files.log_run(spark.createDataFrame([(3, 0.5, 0.5, 0.02, 0.2)], files.GRID_LOG), path, "x")
    assert lines(files.read_runs(spark, path)) == [(3, 0.5, 0.5, 0.02, 0.2), (5, 0.5, 0.5, 0.02, 0.1)]


def test_a_failing_run_leaves_the_others_in_the_log(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    grid = sweep.grid_frame(spark, AXES)
    plain, broken = sweep.train_gbt, [(2, 0.2)]

    def fit(fitting, columns, label, settings, held_out):
        if (settings["maxDepth"], settings["stepSize"]) in broken and settings["subsamplingRate"] == 1.0:
            raise ValueError("broken on purpose")
        return plain(fitting, columns, label, settings, held_out=held_out)

    monkeypatch.setattr(sweep, "train_gbt", fit)
    with pytest.raises(RuntimeError, match="2 of 24 runs failed"):
        sweep.grid_search(rows, ["a", "b"], grid, floor=0.5, parallelism=4, params=SMALL, log=path)
    first = lines(files.read_runs(spark, path))
    assert len(first) == 22 and len(set(first)) == 22
    broken.clear()
    found = sweep.grid_search(rows, ["a", "b"], grid, floor=0.5, parallelism=4, params=SMALL, log=path)
    assert len(lines(found)) == 24 and set(first) <= set(lines(found))
    assert {r[:4] for r in lines(found)} == {tuple(r) for r in grid.collect()}


def test_runs_measured_together_are_those_measured_alone(spark, rows, tmp_path):
    axes = AXES | {"subsample": (1.0,)}
    grid = sweep.grid_frame(spark, axes)
    together = sweep.grid_search(rows, ["a", "b"], grid, floor=0.5, parallelism=4, params=SMALL)
    alone = sweep.grid_search(rows, ["a", "b"], grid, floor=0.5, parallelism=4, params=SMALL, log=str(tmp_path / "log"))
    assert lines(together) == lines(alone) and len(lines(alone)) == 12
    none = sweep.grid_search(rows, ["a", "b"], grid.where("false"), params=SMALL)
    assert none.columns == [*sweep.PARAMETERS, "recall"] and none.count() == 0


def test_curves_by_run_are_the_curves_of_each(spark):
    """One run holds most rows, one has no positive, one a single score."""
    rows = [(0, i % 97 / 97, i % 3 % 2) for i in range(3000)] + [(1, i / 10, 0) for i in range(7)] + [(2, 0.5, i % 2) for i in range(4)]
    scored = spark.createDataFrame(rows, "run int, score double, label int").repartition(5)
    curves = evaluate.pr_curve(scored, by=["run"])
    recall = {r.run: r.recall for r in evaluate.recall_at_precision(scored, 0.3, by=["run"]).collect()}
    for run in (0, 1, 2):
        one = scored.where(F.col("run") == run)
        assert lines(curves.where(F.col("run") == run).drop("run").na.fill(-1.0)) == lines(evaluate.pr_curve(one).na.fill(-1.0))
        assert recall[run] == evaluate.recall_at_precision(one, 0.3).first()["recall"]
