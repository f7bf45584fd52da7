import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from tidemark.workload import ORACLES, QUERIES
from tests.conftest import plan
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    problem, _ = compare(queries()[name](spark, SMOKE_DIR), duck, oracle_sql()[name])
    assert problem is None


# Queries whose whole plan has to spread over the cluster. A single-partition exchange is
# allowed only for aggregates without keys and for top-k, which these do not have.
@pytest.mark.parametrize(
    "name",
    "sequence_ids star_observations quarterly_rollup latest_view qoq_growth scd2_versions scd2_incremental "
    "temporal_join cdc_apply cdc_apply_append cdc_sync rfm_scores money_parse alias_resolve tfidf_weights "
    "vector_neighbours".split(),
)
def test_plan_is_distributed(spark, name):
    text = plan(queries()[name](spark, SMOKE_DIR))
    for bad in ("SinglePartition", "NestedLoop", "Cartesian", "BatchEvalPython"):
        assert bad not in text


def test_scans_are_pruned_and_filters_pushed(spark):
    text = plan(queries()["profile_author"](spark, SMOKE_DIR))
    assert "c_acctbal" not in text.split("ReadSchema", 1)[1]
    text = plan(queries()["hybrid_filter_only"](spark, SMOKE_DIR))
    assert "EqualTo(lang,de)" in text and "text:string" not in text
