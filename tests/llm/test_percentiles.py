import random

import pytest
from pyspark.sql import functions as F

from weftline.llm import percentiles as P


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    # one group holds most rows; ties, nulls, NaN and repeated rows occur
    rows = [(i, "hot" if i % 3 else f"g{i % 7}", float(int(rng.lognormvariate(3, 2)))) for i in range(6000)]
    rows += [(i, g, v) for i, g, v in rows[:500]] + [(9001, "hot", None), (9002, "hot", float("nan")), (9003, None, 5.0)]
    return spark.createDataFrame(rows, "id long, g string, v double").withColumn("mean", F.lit("clash"))


def values(df, g):
    return sorted({r["id"]: r["v"] for r in df.where(F.col("g") == g).collect() if r["v"] is not None and r["v"] == r["v"]}.values())


def test_rank_error_is_bounded_and_certified(skewed):
    out = {r["g"]: r for r in P.certified_quantiles(skewed, ["g"], "v", {"p25": 0.25, "median": 0.5, "p99": 0.99}, row_id="id").collect()}
    assert out[None]["n"] == 1 and out[None]["median"] == 5.0
    for g in ("hot", "g0"):
        vs = values(skewed, g)
        assert out[g]["n"] == len(vs)
        for name, p in (("p25", 0.25), ("median", 0.5), ("p99", 0.99)):
            x = out[g][name]
            below, upto = sum(v < x for v in vs) / len(vs), sum(v <= x for v in vs) / len(vs)
            error = max(0, below - p, p - upto)
            assert out[g][f"{name}_error"] == pytest.approx(error)
            assert error < 0.03


def test_bounds_hold_after_any_merging(skewed):
    parts = [P.build_digest(skewed.where(F.col("id") % 4 == k), ["g"], "v", row_id="id", delta=40, salts=3) for k in range(4)]
    merged = P.merge_digests(P.merge_digests(parts[0].unionByName(parts[1]), ["g"], delta=40).unionByName(parts[2]).unionByName(parts[3]), ["g"], delta=40)
    assert merged.where("g = 'hot'").count() <= 40
    vs = values(skewed, "hot")
    points = skewed.sparkSession.createDataFrame([("hot", float(x)) for x in (-1, 0, 3, 20, 20.5, 400, 1e9)], "g string, point double")
    for r in P.rank_bounds(merged, ["g"], points).collect():
        assert r["n"] == len(vs)
        assert r["below_min"] <= sum(v < r["point"] for v in vs) <= r["below_max"]
        assert r["upto_min"] <= sum(v <= r["point"] for v in vs) <= r["upto_max"]
    for r in P.count_ranks(skewed, ["g"], "v", points, row_id="id").collect():
        assert (r["below"], r["upto"]) == (sum(v < r["point"] for v in vs), sum(v <= r["point"] for v in vs))


def test_size_function_narrows_towards_the_ends(spark):
    d = P.build_digest(spark.range(10000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v")), ["k"], "v", delta=100, salts=1)
    w = [r["weight"] for r in d.orderBy("mean").collect()]
    assert max(w) == max(w[len(w) // 3 : 2 * len(w) // 3]) and w[0] < max(w) / 5 and w[-1] < max(w) / 5


def test_stored_figures(spark):
    vs = spark.createDataFrame([(i, "a", float(i)) for i in range(20)], "id long, k string, v double")
    stored = spark.createDataFrame([("a", 9.0, 4.0), ("a", 9.0, 4.0), ("a", 13.0, None), ("b", 1.0, 1.0), (None, 1.0, None)], "k string, median double, p25 double")
    off = lambda rows: {tuple(r) for r in P.stored_figures_off(vs, rows, ["k"], "v", {"median": 0.5, "p25": 0.25}, row_id="id").collect()}
    assert off(stored) == {("a",)}
    assert off(stored.where("median = 9")) == set()
    assert off(stored.limit(0)) == set()
    # 12 of 20 values lie below 12: exactly ten points over the half, not more
    assert off(spark.createDataFrame([("a", 12.0, None)], "k string, median double, p25 double")) == set()


def test_empty(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert P.quantiles(P.build_digest(none, ["k"], "v"), ["k"], {"m": 0.5}).count() == 0


def check_digest(digest, df, g, bound):
    vs = sorted(r["v"] for r in df.where(F.col("g").eqNullSafe(F.lit(g))).collect() if r["v"] is not None and r["v"] == r["v"])
    out = P.quantiles(digest, ["g"], {"a": 0.01, "b": 0.5, "c": 0.9}).where(F.col("g").eqNullSafe(F.lit(g))).first()
    assert out["n"] == len(vs)
    for name, p in (("a", 0.01), ("b", 0.5), ("c", 0.9)):
        x = out[name]
        assert max(0, sum(v < x for v in vs) / len(vs) - p, p - sum(v <= x for v in vs) / len(vs)) < bound


def test_digests_before_the_shuffle(spark, monkeypatch):
    rng = random.Random(31)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"g{i % 5}", rng.choice([None, float("nan"), -0.0, rng.gauss(0, 1), float(rng.randrange(5))])) for i in range(8000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6).withColumn("weight", F.lit("clash"))
    for chunk, hot in ((P.CHUNK, P.HOT), (300, 100)):
        monkeypatch.setattr(P, "CHUNK", chunk)
        monkeypatch.setattr(P, "HOT", hot)
        digest = P.build_digest(df, ["g"], "v")
        for g in ("hot", "g1", None):
            check_digest(digest, df, g, 0.03)
    assert P.build_digest(df.where("g = 'hot'"), ["g"], "v").count() <= P.DELTA
    two = P.build_digest(df.withColumn("k", F.col("v") > 0), ["g", "k"], "v")
    assert two.agg(F.sum("weight")).first()[0] == df.where("v is not null and not isnan(v)").count()


def test_hot_groups_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "HOT", 500)
    rng = random.Random(32)
    rows = [(i, "hot" if i % 4 else f"g{i % 3}", rng.gauss(0, 1)) for i in range(4000)]
    df = spark.createDataFrame(rows + rows[:900], "id long, g string, v double")
    digest = P.build_digest(df, ["g"], "v", row_id="id")
    for g in ("hot", "g0"):
        check_digest(digest, df.dropDuplicates(["id"]), g, 0.03)
