"""Every registered query of the library gives the rows of its SQL; the corpus queries are tested in tests/llm."""

import os

import pytest
from oracle import SF_DIR, spark_rows, sql_rows

import __spark_entry__
from vertexloom.plans import registry

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_rows(spark, name):
    assert spark_rows(registry.queries()[name](spark, SF_DIR)) == sql_rows(registry.oracle_sql()[name])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 2
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_tasks_grow_in_number_with_the_lines(spark, monkeypatch):
    from vertexloom.plans import fixtures

    before = spark.conf.get(fixtures.PARTITIONS)
    monkeypatch.setattr(fixtures, "ROWS_TOGETHER", 500)
    try:
        rois, lines = fixtures.customer_rois(spark, SF_DIR), fixtures.table(spark, SF_DIR, "lineitem").count()
        assert rois.rdd.getNumPartitions() == -(-lines // 500) > int(before)
        assert spark_rows(registry.queries()["r03_rebind_points"](spark, SF_DIR)) == sql_rows(registry.oracle_sql()["r03_rebind_points"])
    finally:
        spark.conf.set(fixtures.PARTITIONS, before)
