import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import mixing

from .helpers import documents, edge_texts

DIR = "/root/testdata/sf0.1"


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.4, 0.3, 0.3], 500)
    t = rng.integers(1, 200, 500)
    member = spark.createDataFrame([(k, 0, int(t[k]), p[k].tolist()) for k in range(500)], "doc_id long, row long, tokens long, posterior array<double>")
    steps, total, target = mixing.solve_rates(member, (0.5, 0.2, 0.3), steps=200)
    assert np.allclose(total, target, rtol=1e-3)
    rates = mixing._rates(p, steps)
    assert (rates >= 0).all() and np.allclose((t * rates) @ p, total)


def test_classifier_and_expected_totals(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumn("row", F.lit(0).cast("long"))
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    out = mixing.mix(docs, labels).cache()
    joined = out.join(labels.withColumnRenamed("doc_id", "i"), F.col("doc_id") == F.col("i"))
    good = joined.agg(F.avg(((F.col("posterior")[0] + F.col("posterior")[2] > 0.5) == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert good > 0.85
    sums = out.agg(*(F.sum(F.col("rate") * F.col("tokens") * F.col("posterior")[k]).alias(f"d{k}") for k in range(4)), F.sum("tokens").alias("n")).first()
    for k, w in enumerate(mixing.TARGET_WEIGHTS):
        assert abs(sums[f"d{k}"] / sums["n"] - w) < 0.01
    copies = out.agg(F.sum("copies").alias("c"), F.sum("rate").alias("r")).first()
    assert abs(copies["c"] / copies["r"] - 1) < 0.02


def test_edges(spark):
    df = documents(spark, edge_texts(), extra=True).withColumn("row", F.lit(0).cast("long"))
    none = spark.createDataFrame([(None, 1, 1), (1, None, 0)], "doc_id long, quality int, toxic int")
    rows = mixing.mix(df, none).collect()
    assert len(rows) == len(edge_texts()) and all(r["rate"] >= 0 for r in rows)
    assert mixing.mix(df.limit(0), none).count() == 0


def test_defaults_meet_each_target_of_soft_posteriors(spark):
    rng = np.random.default_rng(4)
    domain = rng.choice(4, 4000, p=[0.3, 0.65, 0.03, 0.02])
    z = rng.normal(0, 1, (4000, 4)) - 1
    z[np.arange(4000), domain] += 2
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    t = np.rint(rng.lognormal(4, 1, 4000)).astype(int)
    member = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, posterior array<double>")
    dual, total, target = mixing.solve_rates(member, mixing.TARGET_WEIGHTS)
    assert np.allclose((t * mixing._rates(p, dual)) @ p, total)
    assert np.abs(total / target - 1).max() < mixing.TOLERANCE


def test_targets_out_of_reach_are_reported(spark):
    member = spark.createDataFrame([(5, [0.7, 0.1, 0.1, 0.1]), (0, [0.0, 1.0, 0.0, 0.0])], "tokens long, posterior array<double>")
    with pytest.warns(UserWarning, match="no rates meet the targets"):
        _, total, target = mixing.solve_rates(member, mixing.TARGET_WEIGHTS)
    p = np.array([0.7, 0.1, 0.1, 0.1])
    assert np.allclose(total, p / (p * p / target).sum(), rtol=1e-3)  # least squares along the only direction
    with pytest.raises(RuntimeError, match="not settled"):
        mixing.solve_rates(member, mixing.TARGET_WEIGHTS, steps=2)
