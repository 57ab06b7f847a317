"""Balanced folds: exact ranks, sizes at most one apart, any partitioning."""

import collections

import pytest

from pricewright.operators import folds


@pytest.mark.parametrize("n", [0, 1, 4, 5, 37])
def test_sizes_differ_by_one_at_most(spark, n):
    df = spark.createDataFrame([(f"id{i}",) for i in range(n)], "sample_id string").repartition(3)
    got = folds.fold_table(df).collect()
    sizes = collections.Counter(r["cv_fold"] for r in got)
    assert len(got) == n and max(sizes.values(), default=0) - min([sizes[f] for f in range(5)]) <= 1


def test_same_for_any_partitions(spark):
    df = spark.createDataFrame([(f"id{i}",) for i in range(60)], "sample_id string")
    one, many = ({r["sample_id"]: r["cv_fold"] for r in folds.fold_table(df.repartition(k)).collect()} for k in (1, 9))
    assert one == many
    import hashlib

    order = sorted(one, key=lambda s: (int(hashlib.md5(f"42:{s}".encode()).hexdigest()[:8], 16), s))
    assert [one[s] for s in order] == [k % 5 for k in range(60)]


def test_repeated_ids_share_a_fold(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "sample_id string, v int")
    rows = folds.with_folds(df).collect()
    assert len(rows) == 3 and len({r["cv_fold"] for r in rows if r["sample_id"] == "a"}) == 1
