"""Every query of the subpackage that SQL can state, against DuckDB; the others: rows and schema."""

import pytest

from tests import oracle_check
from zonelens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROWS = ["op1_language_id", "op3_secret_scan", "op5_pii_crf", "op7_repeat_removal", "op9_quality_resampling", "op10_backoff_lm"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    r = oracle_check.compare(spark, oracle_check.duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", ROWS)
def test_one_row_per_document(spark, name):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = QUERIES[name](spark, SF)
    assert got.count() == n == got.select("doc_id").distinct().count()
