"""The registered queries: DuckDB SQL where there is one, and columns of the contracts."""

import pytest
from conftest import SF_SMALL
from oracle import compare

from __spark_entry__ import queries
from pricewright.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1": "doc_id held_out lang_pred score", "op2": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3": "doc_id n_bytes n_tokens over_limit",
    "op4": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5": "doc_id n_shingles component_id kept", "op6": "doc_id start length sha256 score is_secret",
    "op7": "doc_id held_out score predicted", "op8": "doc_id size source_size target taken",
    "op9": "doc_id held_out score predicted", "op10": "doc_id size text_crc32 law shard slot grown_shard",
    "op11": "doc_id n_features weight score rank",
    "op12": "vec_id component n deviation whitened explained identity_error",
    "op13": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars valid",
}
ROWS = {"op12": 500 * 8, "op13": 21}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_duckdb(spark, duck_small, key):
    problems, _ = compare(QUERIES[key](spark, SF_SMALL), duck_small, ORACLE[key], 9)
    assert not problems, problems


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_columns_of_the_contract(spark, key):
    df = queries()[key](spark, SF_SMALL)
    assert df.columns == COLUMNS[key.split("_")[0]].split()
    if key != "op6_secret_scan":
        assert df.count() == ROWS.get(key.split("_")[0], 200)
