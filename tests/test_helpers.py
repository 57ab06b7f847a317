"""Small helpers: oracle rounding wrapper, quantiles, tuning, golden rows."""

import duckdb
import numpy as np
import pytest

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pricewright.functions import text as tx
from pricewright.operators import profile as P
from pricewright.operators.ensemble import tune
from pricewright.operators.quantiles import exact_quantiles
from pricewright.operators.regress import ElasticNet, Ridge
from pricewright.plans.registry import _positive_zero


def test_positive_zero_wraps_nested_rounds():
    sql = "select round(a, 6) x, list_transform(l, lambda v: round(greatest(v, round(b, 2)), 6)) y, around(3) z"
    out = _positive_zero(sql)
    assert out.count("+ 0.0::double") == 3 and "around(3)" in out
    got = duckdb.sql(_positive_zero("select round(-1e-9, 6) v")).fetchall()[0][0]
    assert str(got) == "0.0"


@pytest.mark.parametrize("n", [1, 2, 2001])
def test_quantiles_are_exact(spark, n):
    vals = [float(x) for x in np.random.default_rng(1).normal(size=n)]
    df = spark.createDataFrame([(v, float(i % 3), None) for i, v in enumerate(vals)] + [(None, None, None)],
                               "x double, y double, z double").repartition(7)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    x, y, z = exact_quantiles(df, ["x", "y", "z"], probs)
    assert np.allclose(x, np.quantile(vals, probs), atol=1e-12)
    assert np.allclose(y, np.quantile([i % 3 for i in range(n)], probs), atol=1e-12)
    assert z is None


def test_tuning_reaches_the_estimator(spark):
    """Scores must differ between settings: a parameter of the class instead of
    the instance would be ignored."""
    rows = [(str(i), i % 5, float(i % 7), float(i % 7) * 3 + 10) for i in range(60)]
    df = spark.createDataFrame(rows, "sample_id string, cv_fold int, x double, price double")
    df = df.withColumn("fv", array_to_vector(F.array("x")))
    _, ridge = tune(Ridge(), Ridge.alpha, [1e-3, 1e3], df)
    _, net = tune(ElasticNet(alpha=0.5), ElasticNet.l1Ratio, [0.0, 1.0], df)
    assert ridge[0][1] + 1 < ridge[1][1] and abs(net[0][1] - net[1][1]) > 1e-3


def test_golden_rows_of_the_shared_rules(spark):
    """Written by hand, so that a wrong rule can't pass on both sides."""
    text = "Olive Oil 2.5 lbs, Pack of 6\nCountry of origin, region and the producer's own farm name: Crete : west\n- one\n2) two\nk:v"
    r = spark.createDataFrame([(text, "Café ﬁne ½ Ｔea ế ก็")], "t string, a string").select(
        *P.extract_quantity("t"), *P.bullet_stats("t"), tx.strip_accents("a").alias("a")).first()
    assert (r["qty_value"], r["qty_unit"], r["base_unit"], r["pack_size"]) == (2.5, "lbs", "g", 6)
    assert r["n_bullets"] == 2
    assert r["key_values"] == ["Country of origin, region and the producer's own farm name=Crete : west"]
    assert r["a"] == "Cafe fine 1\u20442 Tea e \u0e01\u0e47"  # the Thai mark has combining class 0
    units = spark.createDataFrame([("5 lbs 3 ounces 2 kilograms 4 liters",)], "t string").select(tx.preprocess("t")).first()[0]
    assert units == "5 lb 3 oz 2 kg 4 l"
    one = spark.createDataFrame([("12-pack cola",), ("6 ct",), ("none",)], "t string")
    assert [x["pack_size"] for x in one.select(*P.extract_quantity("t")).collect()] == [12, 6, None]


def test_quality_profile_counts_every_column(spark):
    df = spark.createDataFrame([("1", "a", [1.0]), ("1", None, [1.0]), ("2", "b", None)], "sample_id string, t string, v array<double>")
    r = P.quality_profile(df, ["t", "v"]).first()
    assert tuple(r) == (1, 2, 1, 1, 3, 2)
    assert tuple(P.quality_profile(df.limit(0), ["t"]).first()) == (0, 0, 0, 0)
