"""Feature blocks of the main pipeline (rows 33, 64-71), fitted on train and
applied to test:

    text SVD (k) ‖ text statistics (5, standardised) ‖ structured numerics
    (robust-scaled) ‖ visual PCA + has-visual flag

then non-finite → 0, non-finite train rows dropped, a final standard scaling
and a clip to [−10, 10].  Each block is a column of ``array<double>`` keyed by
``sample_id``; blocks meet by id joins, never by row position.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as tx
from ..operators import decompose, scale, select, tfidf
from ..operators.visual import VisualBlock, visual_dim, visual_join
from ..session import BROADCAST_MAX_ROWS, cut_lineage, stored

# Fixed values (must equal the reference): settings of the two vectorisers.
WORD = tfidf.TfidfParams(tfidf.Analyzer("word", 1, 2, stop_words=True), min_df=5, max_df=0.8,
                         max_features=15000, prefix="w:")
CHAR = tfidf.TfidfParams(tfidf.Analyzer("char_wb", 2, 4), min_df=8, max_df=0.8, max_features=5000, prefix="c:")

# helper columns of our tables that are not features
NOT_FEATURES = ("price", "sample_id", "fold", "cv_fold", "has_visual", "price_raw")


@dataclass
class FeatureConfig:
    word: tfidf.TfidfParams = WORD
    char: tfidf.TfidfParams | None = CHAR
    svd_k: int = 150
    svd_iter: int = 5
    visual_k: int | None = None
    clip: float = 10.0
    exclude: tuple[str, ...] = NOT_FEATURES
    widths: dict = field(default_factory=dict)


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name != "sample_id"]


@dataclass
class Fitted:
    """All that was fitted on train, for scoring raw items."""

    blocks: list[tfidf.TfidfParams]
    svd: decompose.SvdModel  # its terms carry the idf
    stats: scale.ColumnScaler
    struct: scale.ColumnScaler | None
    struct_cols: list[str]
    visual: VisualBlock | None
    final: scale.ArrayScaler
    clip: float
    text_cols: list[str]


def text_columns(df: DataFrame) -> list[str]:
    return select.text_columns(df.drop("embedding"), exclude=("sample_id",))


def text_column(df: DataFrame):
    """The main pipeline's text: priority columns, else all strings joined."""
    return select.joined_text(text_columns(df))


def text_blocks(train: DataFrame, test: DataFrame, text, cfg: FeatureConfig):
    """Word ‖ char terms of both sets (apart by prefix), fitted on train, as rows
    (id, idx, tf) and what makes weights of them; a text is read and moved once
    for both.  The train rows are stored: the SVD reads them in every pass, and
    numbers of terms beside counts are smaller than the texts."""
    blocks = [p for p in (cfg.word, cfg.char) if p is not None]
    if sum(p.max_features or BROADCAST_MAX_ROWS + 1 for p in blocks) > BROADCAST_MAX_ROWS:
        raise ValueError(f"max_features of the text blocks must not exceed {BROADCAST_MAX_ROWS} together")
    fitted = tfidf.fit_blocks(train, [test], text, blocks)
    (xtr, xte), weights = fitted.counted()
    return fitted.vocab, stored(xtr, "text-rows"), xte, weights


def svd_block(train: DataFrame, test: DataFrame, text, cfg: FeatureConfig):
    vocab, xtr, xte, weights = text_blocks(train, test, text, cfg)
    model = decompose.fit_truncated_svd(xtr, vocab, cfg.svd_k, n_iter=cfg.svd_iter, weights=weights)
    k = model.components.shape[0]
    zeros = F.array_repeat(F.lit(0.0), k)

    def attach(items: DataFrame, x: DataFrame) -> DataFrame:
        s = model.transform(x)
        return items.join(s, "sample_id", "left").withColumn("svd", F.coalesce("svd", zeros))

    return model, attach(train, xtr), attach(test, xte)


def stats_block(train: DataFrame, test: DataFrame, text):
    """The statistics read every text once: five numbers a row are stored, the
    fit and the output read those."""
    names = list(tx.TEXT_STATS)
    tr, te = (cut_lineage(df.select("sample_id", *tx.text_stats(text))) for df in (train, test))
    sc = scale.fit_standard(tr, names)
    arr = F.array(*[sc.column(c) for c in names]).alias("stats")
    return (sc, train.join(tr.select("sample_id", arr), "sample_id"), test.join(te.select("sample_id", arr), "sample_id"))


def structured_block(train: DataFrame, test: DataFrame, exclude):
    cols = select.common_numeric(train, test.drop("price"), exclude=exclude)
    if not cols:
        empty = F.array().cast("array<double>")
        return None, cols, train.withColumn("struct", empty), test.withColumn("struct", empty)
    tr = select.fill_numeric_nulls(train, cols)
    te = select.fill_numeric_nulls(test, cols)
    sc = scale.fit_robust(tr, cols)
    arr = F.array(*[sc.column(c) for c in cols])
    return sc, cols, tr.withColumn("struct", arr), te.withColumn("struct", arr)


def visual_block(train: DataFrame, test: DataFrame, vis: DataFrame | None, k: int | None):
    if vis is None:
        one = F.array(F.lit(0.0))
        return None, train.withColumn("vis", one), test.withColumn("vis", one)
    dim = visual_dim(vis)
    block = VisualBlock(vis, dim, k)
    tr = block.apply(visual_join(train, vis, dim)).drop("visual", "has_visual_flag")
    te = block.apply(visual_join(test, vis, dim)).drop("visual", "has_visual_flag")
    return block, tr, te


def build_features(train: DataFrame, test: DataFrame, vis: DataFrame | None, cfg: FeatureConfig | None = None):
    """Return (train_matrix, test_matrix, info).  Matrices: ``sample_id``,
    ``price`` (test: as given, may be absent), ``features array<double>``."""
    cfg = cfg or FeatureConfig()
    text_cols = text_columns(train)
    text = select.joined_text(text_cols)
    keep = [c for c in train.columns if c != "embedding"]
    tr, te = train.select(*keep), test.select(*[c for c in keep if c in test.columns])
    out_cols = [c for c in ("sample_id", "price", "cv_fold", "fold") if c in tr.columns]
    # every block is made from the items alone and joined by id at the end, so no
    # fit of one block computes another
    svd, svd_tr, svd_te = svd_block(tr.select("sample_id", *_strings(tr)), te.select("sample_id", *_strings(te)), text, cfg)
    st, st_tr, st_te = stats_block(tr, te, text)
    rs, cols, rs_tr, rs_te = structured_block(tr, te, cfg.exclude)
    vb, vb_tr, vb_te = visual_block(tr.select("sample_id"), te.select("sample_id"), vis, cfg.visual_k)
    feats = F.concat("svd", "stats", "struct", "vis")

    def joined(items: DataFrame, *blocks: tuple[DataFrame, str]) -> DataFrame:
        for block, col in blocks:
            items = items.join(block.select("sample_id", col), "sample_id")
        return items.select(*[c for c in out_cols if c in items.columns], N.zero_nonfinite_array(feats).alias("features"))

    tr = joined(tr.select(*out_cols), (svd_tr, "svd"), (st_tr, "stats"), (rs_tr, "struct"), (vb_tr, "vis"))
    te = joined(te.select(*[c for c in out_cols if c in te.columns]), (svd_te, "svd"), (st_te, "stats"), (rs_te, "struct"), (vb_te, "vis"))
    label = F.col("price") if "price" in tr.columns else F.lit(None)
    # stored before the final scaler: its fit and its output read the matrix, not the texts
    tr, te = cut_lineage(tr.filter(N.all_finite("features") & N.is_finite(label))), cut_lineage(te)
    width = svd.components.shape[0] + 5 + len(cols) + (vb.k + 1 if vb else 1)
    final = scale.fit_standard_array(tr, "features", width)
    fin = N.clip_array(final.column("features"), -cfg.clip, cfg.clip)
    info = {
        "svd_k": svd.components.shape[0], "text_stats": 5, "structured": cols,
        "visual": (vb.k + 1) if vb else 1, "width": width, "singular_values": svd.singular_values.tolist(),
        "fitted": Fitted([p for p in (cfg.word, cfg.char) if p is not None], svd, st, rs, cols, vb, final, cfg.clip, text_cols),
    }
    return (tr.select(*out_cols, fin.alias("features")),
            te.select(*[c for c in out_cols if c in te.columns], fin.alias("features")), info)
