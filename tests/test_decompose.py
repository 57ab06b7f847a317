"""SVD / PCA invariants against a brute-force dense computation on sf0.001."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewright.operators import decompose
from pricewright.operators.tfidf import Analyzer, TfidfParams, fit_transform
from pricewright.sources.tables import catalog, read_table, train_test


def test_truncated_svd_matches_dense(spark):
    train, test = train_test(catalog(spark, SF_SMALL))
    p = TfidfParams(Analyzer("word", 1, 1), min_df=2, max_df=0.9, max_features=300)
    vocab, (xtr, _) = fit_transform(train, [test], "catalog_content", p)
    k = 10
    model = decompose.fit_truncated_svd(xtr, vocab, k, n_iter=5)
    terms = {r["term"]: r["idx"] for r in model.terms.collect()}
    ids = sorted({r["sample_id"] for r in xtr.select("sample_id").collect()})
    row = {s: i for i, s in enumerate(ids)}
    X = np.zeros((len(ids), len(terms)))
    for r in xtr.collect():
        X[row[r["sample_id"]], terms[r["term"]]] = r["weight"]
    _, s, vt = np.linalg.svd(X, full_matrices=False)
    # randomized subspace iteration: leading values are exact to solver
    # precision, trailing ones converge more slowly (as with any randomized SVD)
    assert model.singular_values[:3] == pytest.approx(s[:3], rel=1e-6)
    assert model.singular_values[:5] == pytest.approx(s[:5], rel=1e-4)
    # leading components equal up to sign
    for a, b in zip(model.components[:3], vt[:3]):
        assert abs(abs(float(a @ b)) - 1.0) < 1e-6
    scores = {r["sample_id"]: np.array(r["svd"]) for r in model.transform(xtr).collect()}
    U = np.array([scores[i] for i in ids])
    assert np.linalg.norm(U, axis=0)[:3] == pytest.approx(model.singular_values[:3], rel=1e-6)


def test_pca_matches_dense(spark):
    from pricewright.operators.visual import VisualBlock, visual_dim
    from pricewright.sources.visual import visual_features

    vis = visual_features(read_table(spark, SF_SMALL, "embeddings"), id_col="vec_id", vec_col="embedding")
    block = VisualBlock(vis, visual_dim(vis), k=8)
    rows = vis.select("sample_id", block.scaler.column("features").alias("z"),
                      block.pca.column(block.scaler.column("features")).alias("p")).collect()
    Z = np.array([r["z"] for r in rows])
    assert np.abs(Z.mean(axis=0)).max() < 1e-6 and np.allclose(Z.std(axis=0), 1.0, atol=1e-6)
    _, _, vt = np.linalg.svd(Z - Z.mean(axis=0), full_matrices=False)
    P = np.array([r["p"] for r in rows])
    ref = (Z - Z.mean(axis=0)) @ vt[:8].T
    for j in range(8):
        assert min(np.abs(P[:, j] - ref[:, j]).max(), np.abs(P[:, j] + ref[:, j]).max()) < 1e-5
    # the compiled transform gives the same scores as the expression form
    fast = {r["sample_id"]: r["q"] for r in block.pca.transform(vis, block.scaler.column("features"), "q").collect()}
    for r in rows:
        assert np.allclose(fast[r["sample_id"]], r["p"], atol=1e-9)


def test_svd_of_counted_rows(spark):
    """Rows of counts give the model and the scores of the long form, and nothing
    of the passes stays on the disks."""
    from pricewright.plans.features import FeatureConfig, text_blocks

    train, test = train_test(catalog(spark, SF_SMALL))
    word = TfidfParams(Analyzer("word", 1, 1), min_df=2, max_df=0.9, max_features=200, prefix="w:")
    char = TfidfParams(Analyzer("char_wb", 2, 3), min_df=2, max_df=0.9, max_features=100, prefix="c:")
    vocab, xtr, xte, weights = text_blocks(train, test, "catalog_content", FeatureConfig(word=word, char=char))
    assert xtr.columns == ["sample_id", "idx", "tf"] and xtr.count() == train.count()
    packed = decompose.fit_truncated_svd(xtr, vocab, 5, weights=weights)
    from pricewright.operators.tfidf import fit_transform_blocks

    vocab2, (ltr, lte) = fit_transform_blocks(train, [test], "catalog_content", [word, char])
    long = decompose.fit_truncated_svd(ltr, vocab2, 5)
    assert packed.singular_values == pytest.approx(long.singular_values, rel=1e-9)
    assert np.abs(packed.components - long.components).max() < 1e-7
    a, b = ({r["sample_id"]: np.array(r["svd"]) for r in m.transform(x).collect()} for m, x in ((packed, xte), (long, lte)))
    assert all(np.abs(a[i] - b[i]).max() < 1e-7 for i in b)
