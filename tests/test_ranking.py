import random

import pytest
from pyspark.sql import functions as F

from ledgerprofile.operators import ranking


def _coeffs(spark, values):
    return spark.createDataFrame([(f"N{i:03d}", float(v)) for i, v in enumerate(values)],
                                 "nsrsbh string, c double")


@pytest.mark.parametrize("n", [1, 2, 3, 10])
@pytest.mark.parametrize("ratio", [0.0, 0.2, 1.0])
def test_cut_rules(n, ratio):
    g = ranking.growth_cut(n, ratio)
    p = ranking.periodic_cut(n, ratio)
    assert g == (n if n <= 1 else min(n, int(n * ratio) + 1))
    assert p == (n if n <= 2 else int(n * ratio))


def test_cut_examples():
    assert ranking.growth_cut(41, 0.2) == 9
    assert ranking.periodic_cut(40, 0.2) == 8
    assert ranking.growth_cut(10, 1.0) == 10
    with pytest.raises(ValueError):
        ranking.check_ratio(1.5)


@pytest.mark.parametrize("limit", [ranking.BOUNDED_TOPK_LIMIT, 0])
def test_top_fraction_ties_and_paths(spark, limit):
    vals = [0.5, 0.9, 0.9, 0.1, -1.0, float("nan"), 0.0, 0.9, 0.3, 0.7]
    df = _coeffs(spark, vals)
    # positives: 0.5 0.9 0.9 0.1 0.9 0.3 0.7 -> n = 7; growth keeps int(7*0.2)+1 = 2
    got = [r.nsrsbh for r in ranking.top_fraction(df, "c", "nsrsbh", 0.2, "growth", limit)
           .orderBy(F.desc("c"), "nsrsbh").collect()]
    assert got == ["N001", "N002"]                   # ties at the cut: lower id wins
    per = ranking.top_fraction(df, "c", "nsrsbh", 0.5, "periodic", limit)
    assert per.count() == 3


def test_distributed_positions_match_sort(spark):
    rng = random.Random(3)
    vals = [rng.choice([0.1, 0.2, 0.3, rng.random()]) for _ in range(500)]   # many ties
    df = _coeffs(spark, vals).repartition(7)
    order = [F.col("c").desc(), F.col("nsrsbh").asc()]
    pos = ranking.with_global_position(df, order, "pos", partitions=5).collect()
    want = sorted(((-v, f"N{i:03d}") for i, v in enumerate(vals)))
    got = sorted(pos, key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(1, 501))
    assert [r.nsrsbh for r in got] == [w[1] for w in want]
    k = 137
    big = ranking.top_k(df, "c", "nsrsbh", k, bounded_limit=0)
    small = ranking.top_k(df, "c", "nsrsbh", k)
    assert sorted(r.nsrsbh for r in big.collect()) == sorted(r.nsrsbh for r in small.collect())


def test_top_n_per_group_ties(spark):
    df = spark.createDataFrame([("H1", "B", 0.5), ("H1", "A", 0.5), ("H1", "C", 0.1), ("H2", "D", 0.0)],
                               "hy_dm string, nsrsbh string, xxbl double")
    top1 = {r.hy_dm: r.nsrsbh for r in ranking.top_n_per_group(df, "hy_dm", "xxbl", "nsrsbh", 1).collect()}
    assert top1 == {"H1": "A", "H2": "D"}
    low = ranking.top_n_per_group(df, "hy_dm", "xxbl", "nsrsbh", 1, descending=False, rank_col="rank")
    assert {(r.hy_dm, r.nsrsbh, r.rank) for r in low.collect()} == {("H1", "C", 1), ("H2", "D", 1)}
    with pytest.raises(ValueError):
        ranking.top_n_per_group(df, "hy_dm", "xxbl", "nsrsbh", 0)


def test_top_n_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"),
                                  F.col("id").cast("string").alias("nsrsbh"), F.rand(1).alias("v"))
    plan = ranking.top_n_per_group(df, "g", "v", "nsrsbh", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("descending", [True, False])
def test_selection_equals_both_other_paths(spark, descending, monkeypatch):
    """Ties, heavy tails, negative numbers and repeated ids' beginnings, cut anywhere."""
    rng = random.Random(7)
    monkeypatch.setattr(ranking, "RANGES", 8)
    vals = [rng.choice([0.25, 0.25, -3.0, 2.0 ** rng.randint(-60, 60), rng.random(), 1e300, -1e300]) for _ in range(400)]
    rows = [(f"{'x' * (k % 3)}{k}", v) for k, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "nsrsbh string, c double").repartition(5).cache()
    want = [i for i, _ in sorted(rows, key=lambda r: (-r[1] if descending else r[1], r[0].encode()))]
    order = [F.col("c").desc() if descending else F.col("c").asc(), F.col("nsrsbh").asc()]
    for k, limit in ((1, 1), (60, 1), (137, 1), (260, 3), (399, 1), (400, 1), (900, 1)):
        got = {r.nsrsbh for r in ranking.select_best(df, "c", "nsrsbh", k, descending, limit).collect()}
        assert got == set(want[:k]) and got == {r.nsrsbh for r in df.orderBy(*order).limit(k).collect()}
    positions = ranking.with_global_position(df, order, "pos", partitions=4).where("pos <= 137")
    assert {r.nsrsbh for r in positions.collect()} == set(want[:137])


def test_selection_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(f"N{k:03d}", 1.5) for k in range(120)], "nsrsbh string, c double")
    got = ranking.select_best(df, "c", "nsrsbh", 33, bounded_limit=1)
    assert sorted(r.nsrsbh for r in got.collect()) == [f"N{k:03d}" for k in range(33)]
    same = spark.createDataFrame([("A", 1.5)] * 20 + [("B", 1.5)], "nsrsbh string, c double")
    assert [r.nsrsbh for r in ranking.select_best(same, "c", "nsrsbh", 7, bounded_limit=1).collect()] == ["A"] * 7
    assert ranking.select_best(df.limit(0), "c", "nsrsbh", 7).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
