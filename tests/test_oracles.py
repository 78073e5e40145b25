"""Every registered query against its DuckDB oracle. Those that SQL cannot
express are compared with plain models in the modules named here."""

import pytest

from tokenmill.plans.check import compare, duckdb_con
from tokenmill.plans.registry import load_all

from conftest import SF_SMALL

QUERIES, ORACLES = load_all()
MODELS = dict.fromkeys(["pretoken_histogram", "train_bpe", "token_bytes", "build_vocab", "compression_ratio",
                        "compare_tokenizers", "bpe_pack_rows", "bpe_sft_rows"], "test_tokenizer_queries.py")


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["ok"], r


def test_every_query_has_an_oracle_or_a_model():
    assert set(QUERIES) - set(ORACLES) == set(MODELS)
