"""The pipeline: stages in order, and each against its brute-force version."""

import collections

import corpus_pipeline
from conftest import SF_SMALL

from pricewright.llm import mixing

from .test_neardup import expected


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    held = docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, SF_SMALL)
        rows = held.collect()
        results[name] = rows
        if name != "sharding":
            assert held.columns == columns
        held = spark.createDataFrame(rows, held.schema)
    from pricewright.llm import langid

    start = docs.collect()
    lang, score = langid.predict_all(langid.Rows(langid.fit(docs)), [r["text"] for r in start])
    assert sorted(r["doc_id"] for r in results["language_id"]) == sorted(
        r["doc_id"] for r, x, p in zip(start, lang, score) if x != "und" and p > 0.5)
    kept = {i for i, _, _, keep in expected([(r["doc_id"], r["text"]) for r in results["language_id"]], n=5) if keep}
    assert {r["doc_id"] for r in results["near_dedup"]} == kept and len(results["near_dedup"]) == len(kept)
    assert {r["doc_id"] for r in results["decontamination"]} <= kept
    counts = collections.Counter(r["doc_id"] for r in results["mixing"])
    assert max(counts.values()) <= mixing.MAX_REPEAT
    final = results["sharding"]
    assert len(final) == len(results["mixing"])
    for s in range(corpus_pipeline.SHARDS):
        mine = sorted(r["slot"] for r in final if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_contaminated_documents_go(spark, duck_small):
    from pricewright.llm.queries import ORACLE

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    clean = {i for i, bad in duck_small.execute(f"select doc_id, contaminated from ({ORACLE['op2_decontamination']})").fetchall() if not bad}
    got = corpus_pipeline.drop_contaminated(spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in got.collect()} == clean


def test_edges_run_through(spark, clashing, empty):
    from pyspark.sql import functions as F

    names = ["__key", "__size", "__rid", "__lang", "__draw", "__tie", "__score", "__row", "more", "row"]
    own = clashing.drop(*names).withColumns({c: F.lit(f"mine {c}") for c in names})
    for df in (own, empty):
        held = df
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, held, SF_SMALL)
            rows = out.collect()
            for r in rows if df is own else ():
                assert all(r[c] == f"mine {c}" for c in names), name
            if name != "sharding":
                assert out.columns == df.columns
            held = spark.createDataFrame(rows, out.schema)
        assert set(df.columns) - {"size", "shard", "slot"} <= set(held.columns)
        assert {"size", "shard", "slot"} <= set(held.columns)


def test_no_language_learned_keeps_texts_with_a_letter(spark, edge):
    """Null langs throughout, or labels only in the fold that the query holds out, drop no text with a letter."""
    from pyspark.sql import functions as F

    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    held_out = edge.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit("en")))
    for docs in (unlabelled, held_out):
        kept = corpus_pipeline.identify_language(spark, docs, SF_SMALL)
        assert kept.columns == docs.columns
        got = sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect())
        want = [(r["doc_id"] or 0, r["text"]) for r in docs.collect() if r["text"] and any(map(str.isalpha, r["text"]))]
        assert got == sorted(want) and got


def test_the_model_decides_the_language(spark):
    """Unwanted languages go, and so does a text that no language explains better than the others."""
    rows = [(k, "the river and the stone of a house" if k % 2 else "la maison et le fleuve de pierre", "en" if k % 2 else "fr") for k in range(40)]
    rows += [(100, "the stone house", None), (101, "la maison de pierre", None), (102, "\u4e1c\u4eac\u4e1c", None), (103, "12 !", None)]
    docs = spark.createDataFrame([(i, t, x, "a", len(t)) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    ids = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, SF_SMALL).collect()}
    assert ids == set(range(40)) | {100, 101}
    ids = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, SF_SMALL, wanted=("en",)).collect()}
    assert ids == set(range(1, 40, 2)) | {100}


def test_a_stage_is_let_go_before_the_next(spark, monkeypatch):
    """The driver holds the models and broadcasts of one stage, not of all."""
    done, freed = [], []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda spark, docs, sf, n=n: done.append(n) or docs) for n in "abc"])
    monkeypatch.setattr(corpus_pipeline, "free_shuffles", lambda _: freed.append(len(done)))
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    assert freed == [1, 2, 3]
