"""Hand-made edge inputs (FIXTURES §4) checked against direct definitions."""

import math

import pytest
from pyspark.sql import functions as F

from pricewright.functions import numeric as N
from pricewright.functions import text as tx
from pricewright.operators import metrics as M
from pricewright.operators import scale
from pricewright.operators.visual import visual_join
from pricewright.sources import csv as C


def test_bad_csv(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(
        'sample_id,catalog_content,image_link,price\n'
        '1,"line one\nline two",http://x/1.jpg,10.5\n'
        '2,"say ""hi""",http://x/2.jpg,3\n'
        '3,plain,http://x/3.jpg,abc\n'
        '4,extra,http://x/4.jpg,4,surplus\n'
        '5,empty number,http://x/5.jpg,\n')
    good = {r["sample_id"]: r for r in C.read_csv(spark, str(p)).collect()}
    assert good["1"]["catalog_content"] == "line one\nline two"
    assert good["2"]["catalog_content"] == 'say "hi"'
    assert "3" not in good and "4" not in good  # unparsable number, extra field
    assert good["5"]["price"] is None  # an empty number is a plain null
    q = {r["sample_id"]: r for r in C.read_quarantine(spark, str(p)).collect()}
    assert [k for k, r in sorted(q.items()) if r["bad"]] == ["3", "4"]
    assert q["3"]["price"] is None


@pytest.mark.parametrize("raw,want", [
    ("3 LBS", "3 lb"), ("12 Ounces", "12 oz"), ("5 Grams", "5 g"), ("2 kgs", "2 kg"),
    ("okgs", "kg"), ("grams.", "g."), ("1 liters  and\t2 milliliters", "1 l and 2 ml"),
])
def test_units(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "t string").select(tx.preprocess("t")).first()[0]
    assert got == want


def _py_stats(s):
    s = s or ""
    n = len(s)
    return (float(n), float(len(s.split())), len(set(s)) / n if n else 0.0,
            sum(1 for c in s if not c.isalnum()) / n if n else 0.0,
            sum(1 for c in s if c.isdigit()) / n if n else 0.0)


TEXT_EDGE = ["", None, "a", "12345", "Crème brûlée à côté", "tab\there\nnew line  two", "x, y! z?"]


def test_text_stats_match_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXT_EDGE], "t string")
    got = df.select(*tx.text_stats("t")).collect()
    for t, row in zip(TEXT_EDGE, got):
        for a, b in zip(tuple(row), _py_stats(t)):
            assert a == pytest.approx(b), (t, tuple(row))


def test_normalize_and_accents(spark):
    df = spark.createDataFrame([(t,) for t in TEXT_EDGE], "t string")
    got = [r[0] for r in df.select(tx.normalize("t")).collect()]
    want = [" ".join((t or "").lower().split()) for t in TEXT_EDGE]
    assert got == want
    acc = df.select(tx.analyzer_text("t")).collect()[4][0]
    assert acc == "creme brulee a cote"


def _smape(rows):
    import numpy as np

    y = np.array([r[0] for r in rows], float)
    p = np.array([r[1] for r in rows], float)
    d = np.abs(y) + np.abs(p)
    return 100 * np.mean(np.where(d == 0, 0.0, 2 * np.abs(p - y) / np.where(d == 0, 1, d)))


@pytest.mark.parametrize("rows", [
    [(100.0, 120.0)], [(0.0, 0.0), (100.0, 120.0)], [(0.0, 5.0)], [(0.0, 0.0), (0.0, 0.0)], [(1e-9, 2e-9)],
])
def test_smape_edges(spark, rows):
    df = spark.createDataFrame(rows, "y double, p double")
    got = df.agg(M.smape("p", "y")).first()[0]
    assert got == pytest.approx(_smape(rows))
    keep = [r for r in rows if r[0] != 0 or r[1] != 0]
    want_dz = 0.0 if not keep else 100 * sum(abs(y - p) / max((abs(y) + abs(p)) / 2, 1e-8) for y, p in keep) / len(keep)
    assert df.agg(M.smape_drop_zero("p", "y")).first()[0] == pytest.approx(want_dz)


def test_smape_golden(spark):
    df = spark.createDataFrame([(100.0, 120.0)], "y double, p double")
    assert round(df.agg(M.smape("p", "y")).first()[0], 2) == 18.18


def test_vectors_edge(spark, tmp_path):
    from pricewright.sources.visual import visual_features

    items = spark.createDataFrame([("1",), ("2",), ("3",)], "sample_id string")
    path = str(tmp_path / "vis.parquet")
    spark.createDataFrame([("1", [1.0, 2.0, 3.0]), ("2", [9.0, 9.0, 9.0]), ("2", [4.0, 5.0, 6.0])],
                          "sample_id string, v array<float>").coalesce(1).write.parquet(path)
    vis = visual_features(spark.read.parquet(path), vec_col="v")
    got = {r["sample_id"]: r for r in visual_join(items, vis, 3).collect()}
    assert list(got["2"]["visual"]) == [4.0, 5.0, 6.0]  # the last duplicate wins
    assert list(got["3"]["visual"]) == [0.0, 0.0, 0.0] and got["3"]["has_visual_flag"] == 0.0
    assert got["1"]["has_visual_flag"] == 1.0
    none = spark.createDataFrame([], "sample_id string, features array<float>")
    assert all(r["has_visual_flag"] == 0.0 for r in visual_join(items, none, 3).collect())
    cut = visual_join(items, vis, 2).collect()
    assert all(len(r["visual"]) == 2 for r in cut)


def test_scale_edge(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (1.0, float("nan"), 1.0), (1.0, inf, 1.0), (1.0, -inf, 1.0),
                                (1.0, 7.0, 2.0)], "c double, x double, q double").coalesce(1)
    sc = scale.fit_standard(df, ["c"])
    assert sc.scale["c"] == 1.0  # constant column: spread 1, values become 0
    assert [r[0] for r in df.select(sc.column("c")).collect()] == [0.0] * 5
    z = [r[0] for r in df.select(N.zero_nonfinite("x")).collect()]
    assert z == [5.0, 0.0, 0.0, 0.0, 7.0]
    kept = df.filter(N.is_finite("x")).count()
    assert kept == 2
    rb = scale.fit_robust(df, ["q"])  # Q1 = Q3 = 1: zero IQR → 1
    assert rb.scale["q"] == 1.0 and rb.center["q"] == 1.0


def test_predictions_edge(spark):
    from pricewright.plans.q_io import completeness

    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "sample_id string")
    pred = spark.createDataFrame([("a", 1.0), ("b", -2.0), ("c", 3.0), ("c", 4.0), ("z", 5.0)],
                                 "sample_id string, price double")
    r = completeness(expected, pred).first()
    assert (r["missing"], r["extra"], r["duplicated"], r["non_positive"], r["valid"]) == (1, 1, 1, 1, 1)


def test_price_floor(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (3.0,)], "p double")
    assert [r[0] for r in df.select(N.price_floor("p")).collect()] == [0.01, 0.01, 3.0]


def test_ieee_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(N.ieee_ratio("n", "d")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == 0.5
