"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import MEDIUM, SMALL

# Deep trees need enough rows per node: on the smallest tables several features cut a node
# into the same rows and the choice between them is rounding.
DEEP = {"dt_tuned", "feature_importance"}
# Default grids of forests and boosting: minutes, and no SQL to compare with. test_tuning.py checks
# their parts on small grids; tests/compare.py runs them whole.
SLOW = {"rf_tuned", "gbt_tuned", "report_four_families"}


@pytest.fixture(scope="module")
def duck():
    return {d: connect(d) for d in (SMALL, MEDIUM)}


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, duck, name):
    sf_dir = MEDIUM if name in DEEP else SMALL
    df = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(df.collect()) > 0
        return
    result = differences(df, duck[sf_dir], sql)
    assert not isinstance(result, str), result
    assert not result[2] and not result[3], (result[:2], list(result[2])[:3], list(result[3])[:3])


def test_entry_is_lazy_and_has_rows(spark):
    assert entry.entry(spark).count() == 392
    assert set(entry.oracle_sql()) <= set(entry.queries())
