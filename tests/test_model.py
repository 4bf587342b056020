"""Boosting with patience, and preparation and booster saved as one."""

import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from nightledger.operators import model, prepared

STEPS = {"maxDepth": 1, "subsamplingRate": 1.0, "minInstancesPerNode": 1, "stepSize": 0.3, "maxIter": 40}
COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def misleading(spark):
    """What explains the training rows best says little about the held-out ones, so their loss has several lows."""
    draw = random.Random(3)

    def rows(n, held, *shares):
        out = []
        for _ in range(n):
            y = draw.randint(0, 1)
            out.append((held, y, *(y if draw.random() < p else 1 - y for p in shares)))
        return out

    made = rows(900, False, 0.8, 0.75, 0.7) + rows(500, True, 0.3, 0.85, 0.8)
    return spark.createDataFrame(made, "held boolean, isbookable int, a int, b int, c int").repartition(2).cache()


def losses_of(fitted, rows):
    return [r.loss for r in model.staged_losses(fitted, rows, COLUMNS).orderBy("round").collect()]


def test_best_prefix():
    assert model.best_prefix([3.0, 2.0, 2.5, 2.4, 1.0, 1.5], 2) == (2, True)
    assert model.best_prefix([3.0, 2.0, 2.5, 2.4, 1.0, 1.5], 3) == (5, False)
    assert model.best_prefix([3.0, 2.0, 2.5, 1.9, 1.8, 2.0, 2.0, 2.0], 3) == (5, True)
    assert model.best_prefix([1.0, 1.0, 1.0], 2) == (1, True)
    assert model.best_prefix([1.0], 1) == (1, False)


def test_staged_losses_are_those_of_the_scores(misleading):
    judging = misleading.where("held")
    fitted = model.train_gbt(misleading.where("not held"), COLUMNS, params=STEPS | {"maxIter": 4})
    scored = model.score(fitted, judging, COLUMNS, keep=["isbookable"]).collect()
    mean = sum(-2 * math.log(r.score if r.isbookable else 1 - r.score) for r in scored) / len(scored)
    assert losses_of(fitted, judging)[-1] == pytest.approx(mean)


def test_patience_outlasts_a_rise(misleading):
    judging, held = misleading.where("held"), F.col("held")
    whole = model.train_gbt(misleading.where("not held"), COLUMNS, params=STEPS)
    losses = losses_of(whole, judging)
    rise = next(i for i, (x, y) in enumerate(zip(losses, losses[1:]), 1) if y > x)
    kept = {}
    for patience in (1, 4, 10, 60):
        fitted = model.train_gbt(misleading, COLUMNS, params=STEPS, held_out=held, patience=patience)
        kept[patience] = fitted.getNumTrees
        assert kept[patience] == model.best_prefix(losses, patience)[0]
        assert [t.toDebugString.split("\n")[1:] for t in fitted.trees] == [t.toDebugString.split("\n")[1:] for t in whole.trees[: kept[patience]]]
        assert losses_of(fitted, judging) == pytest.approx(losses[: kept[patience]])
    assert kept[1] == rise < kept[10] <= kept[60] == losses.index(min(losses)) + 1
    assert losses[kept[10] - 1] < losses[rise - 1]
    with pytest.raises(ValueError, match="held-out"):
        model.train_gbt(misleading, COLUMNS, params=STEPS, patience=3)


@pytest.fixture(scope="module")
def raw(spark):
    k = F.col("id")
    return spark.range(600).select(
        k,
        F.when(k % 11 > 0, (k % 7).cast("double")).alias("price"),
        F.lit(2.5).alias("level"),
        F.lit(None).cast("double").alias("none"),
        F.when(k % 13 > 0, k % 5).alias("rooms"),
        F.when(k % 17 > 0, F.element_at(F.array(F.lit("é"), F.lit("PP"), F.lit("FG")), (k % 3 + 1).cast("int"))).alias("kind"),
        (k % 2 == 0).alias("flag"),
        ((k % 7 > 3) | (k % 3 == 1)).cast("int").alias("isbookable"),
        (k % 4 == 0).alias("held"),
    )


def test_preparation_is_that_of_the_steps(spark, raw):
    fitted = prepared.preparation(scaled=["price", "level", "none"], plain=["rooms"], categories=["kind", "flag"]).fit(raw)
    more = raw.limit(30).unionByName(raw.limit(1).withColumn("kind", F.lit("unknown")).withColumn("price", F.lit(None).cast("double")))
    values = [r.price for r in raw.select("price").collect() if r.price is not None]
    mean = sum(values) / len(values)
    dev = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    got = fitted.transform(more.select("*", F.col("price").alias("was"), F.col("rooms").alias("of")))
    for r in got.collect():
        first = -999.0 if r.was is None else (r.was - mean) / dev
        kinds = [float(r.kind == v) for v in ("FG", "PP", "é")]
        want = [first, -999.0, -999.0, -999.0 if r.of is None else float(r.of), *kinds, float(not r.flag), float(r.flag)]
        assert r.features.toArray().tolist() == pytest.approx(want)


def test_a_new_session_scores_equally(spark, raw, tmp_path):
    steps = prepared.preparation(scaled=["price", "none"], plain=["rooms"], categories=["kind"])
    fitted = prepared.fit_prepared(raw, steps, params={"maxIter": 6, "maxDepth": 2}, held_out=F.col("held"), patience=2)
    path, rows, out = (str(tmp_path / x) for x in ("model", "rows", "out"))
    raw.write.parquet(rows)
    prepared.save_prepared(fitted, path)
    prepared.save_prepared(fitted, path)  # replaces what is there
    code = f"""
from nightledger.session import local_session
from nightledger.operators import prepared
spark = local_session("other", cpus=1)
rows = spark.read.parquet({rows!r})
prepared.score_prepared(prepared.load_prepared({path!r}), rows, ["id", "kind", "price"]).write.parquet({out!r})
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, env=os.environ | {"PYTHONPATH": root}, timeout=300)
    here = prepared.score_prepared(fitted, raw, ["id", "kind", "price"])
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, here.collect()))
    assert here.select("price").where("price is null").count() > 0  # kept as it came


def test_too_many_values_are_no_category(raw):
    with pytest.raises(ValueError, match="more than 3"):
        prepared.Categories(inputCols=["rooms"], most=3).fit(raw)
