"""Every query with SQL agrees with it on the smallest given tables."""

import os

import oracle
import pytest

from quirefold.suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


# Queries that write tables on the way; their plans are those of the reads at the end.
_WRITERS = {"ingest_documents", "ingest_chunks", "run_summary", "store_delete", "ingest_stream",
            "topk_batch_blocks", "late_bodies", "two_writers", "store_stats", "ingest_violations", "store_search_index", "topk_cells", "topk_cells_full"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - _WRITERS))
def test_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
