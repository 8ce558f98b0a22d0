"""Small files of many rows are dealt out to tasks by rows, as what is derived from them is large."""

import os

import pytest
from pyspark.sql import functions as F

from goldrec.plans.derive import customer_records, customer_records_with_orphans
from goldrec.plans.jobs import _written
from goldrec.plans.queries import _history_items
from goldrec.plans.texts import notes_fields, resume_fields
from goldrec.session import ROWS_A_TASK

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A customer table in one file whose rows are enough for three tasks."""
    sf = str(tmp_path_factory.mktemp("wide"))
    k = F.col("id")
    rows = spark.range(0, 2 * ROWS_A_TASK + 1, 1, 1).select(
        k.alias("c_custkey"), F.concat(F.lit("Customer#"), k.cast("string")).alias("c_name"), (k % 25).alias("c_nationkey"),
        k.cast("double").alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    )
    rows.write.parquet(f"{sf}/customer.parquet")
    return sf


def most(df):
    """Rows of the fullest task."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("query", [notes_fields, resume_fields])
def test_texts_are_spread(spark, wide, query):
    assert query(spark, wide).rdd.getNumPartitions() == 3


def test_records_are_spread(spark, wide):
    records = customer_records(spark, wide)
    assert most(records) <= ROWS_A_TASK
    n = 2 * ROWS_A_TASK + 1
    assert records.select("record_id").distinct().count() == records.count() == sum(-(-n // d) for d in (1, 2, 3, 5))
    assert most(customer_records_with_orphans(spark, wide)) <= ROWS_A_TASK


def test_lines_are_spread(spark):
    cut, whole = _history_items(spark, SF, lines=100), _history_items(spark, SF)
    n = whole.count()
    assert cut.rdd.getNumPartitions() >= n // 100
    assert cut.count() == n and cut.exceptAll(whole).isEmpty()


def test_notes_stand_in_one_folder(spark, tmp_path):
    rows = [(20, "b"), (20, "a"), (40, "c"), (60, "d"), (7, "e"), (None, "f"), (80, None), (100, None)]
    df = spark.createDataFrame(rows, "c_custkey bigint, c_name string")
    df.selectExpr("*", "'x' AS c_mktsegment", "1 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    folder = _written(spark, str(tmp_path))["notes"]
    local = folder.removeprefix("file:")
    assert not [f for f in os.listdir(local) if os.path.isdir(f"{local}/{f}")]
    texts = sorted(r["value"] for r in spark.read.text(folder, wholetext=True).collect())
    note = "Name: {}\nc{}@example.org\nSkills: Go\n".format
    assert texts == sorted([note("a", 20) + note("b", 20), " \n", " \n", note("d", 60), "\n"])
