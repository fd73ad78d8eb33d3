"""Every registered query against its DuckDB oracle (the driver's correctness gate).

Runs on sf0.001 for speed; ``tests/oracle_check.py`` runs the same comparison at
any scale from the command line.
"""

from __future__ import annotations

import pytest

from oracle_check import compare

SF = "/root/testdata/sf0.001"


#: Randomised detectors and what depends on them; tests/test_properties.py checks them.
ROWS_ONLY = {"inne_score", "iforest_score", "score_with_model_udf", "model_runs_unlabelled",
             "best_model_unlabelled", "score_with_production_model", "model_search", "ensemble_of_best_models"}


def _names():
    from tracewise.plans.catalog import load_all
    return sorted(load_all()[0])


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "id" and len(df.columns) == 13


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    status, detail = compare(spark, SF, [name], verbose=False)[name]
    assert status == ("ROWS_ONLY" if name in ROWS_ONLY else "OK"), detail
