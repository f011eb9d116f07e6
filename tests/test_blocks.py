"""Blocks of ratings grow in number with the table, not in size, and results don't depend on them."""

import functools
import math

import pytest

import __spark_entry__ as contract
from stayline.operators import factors, models


@pytest.mark.parametrize("name", ["ml_als", "ml_als_implicit"])
def test_als_blocks_hold_a_bounded_number_of_ratings(spark, sf, name, monkeypatch):
    monkeypatch.setattr(models, "BLOCK_RATINGS", 500, raising=False)
    seen, fit = [], models.fit
    monkeypatch.setattr(models, "fit", lambda *args, **more: seen.append(fit(*args, **more)) or seen[-1])
    row = contract.queries()[name](spark, sf).first()
    needed = math.ceil(row["n"] / 500)
    assert needed > 10 and row["good"]
    assert [t.rdd.getNumPartitions() for t in (seen[0].userFactors, seen[0].itemFactors)] == [needed, needed]
    assert spark.sparkContext.getCheckpointDir()


def test_few_ratings_keep_the_estimators_blocks(spark):
    df = spark.createDataFrame([(u, i, float(u + i)) for u in range(9) for i in range(7)], "user int, item int, rating float")
    model = models.fit_factors(models.als(rank=2, steps=4, numUserBlocks=3, numItemBlocks=4), df, "user")
    assert (model.userFactors.rdd.getNumPartitions(), model.itemFactors.rdd.getNumPartitions()) == (3, 4)
    assert model.transform(df).count() == 63


def test_half_step_blocks_hold_a_bounded_number_of_ratings(spark, sf, monkeypatch):
    want = contract.queries()["als_half_step"](spark, sf).collect()
    seen = []

    class Noted(factors.Links):
        def __init__(self, *args):
            super().__init__(*args)
            seen.append((args[4], self.ratings.groupBy("block").count().agg({"count": "max"}).first()[0], self.ratings.count()))

    monkeypatch.setattr(factors, "Links", Noted)
    monkeypatch.setattr(factors, "Settings", functools.partial(factors.Settings, block_rows=300))
    got = contract.queries()["als_half_step"](spark, sf).collect()
    (blocks, most, n), = seen
    assert blocks == math.ceil(n / 300) > 8 and most < 3 * 300
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
