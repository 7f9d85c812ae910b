import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, same  # noqa: E402
from fluvion.llm import queries as Q  # noqa: E402


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_gives_the_rows_of_its_sql(spark, data, con, name):
    same(Q.QUERIES[name](spark, data), con, Q.ORACLE[name])


COLUMNS = {"p1_found": ["station_uid", "cluster_uid"], "p5_found": ["cluster_id", "field_name", "catalog_row_id"], "p6_found": ["source_station_id", "cluster_id"], "p7_found": ["insitu_record_id", "satellite_record_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "entity_type", "start_offset", "end_offset"]}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_runs(spark, data, name):
    df = Q.QUERIES[name](spark, data)
    assert df.columns == COLUMNS.get(name, df.columns) and df.count() > 0
