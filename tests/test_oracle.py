"""A slice of the registered queries against their DuckDB oracles on sf0.001."""

import pytest

from conftest import SF_SMALL

QUERIES = [
    "raw_book_topk", "trade_bars", "trade_gaps", "bars_1m_sparse", "asof_prev_close",
    "rollup_bars_86400", "features_basic", "triple_barrier", "qc_labels",
]


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E
    from oracle.compare import compare

    res = compare(E.queries()[name](spark, SF_SMALL), E.oracle_sql()[name], SF_SMALL)
    assert res["ok"], res


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and "training_ready" not in df.columns
