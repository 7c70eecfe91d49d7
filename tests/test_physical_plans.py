"""What the plans of the registered queries must and must not contain."""

import re

import catalog
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from catalog.base import table
from drayage import scratch
from drayage.operators.batching import batch_assign, collect_batches
from drayage.operators.joins import join_keyed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_no_global_window_no_row_udf(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Window|BatchEvalPython", text)


def test_batching_shuffles_without_a_single_partition(spark):
    batched = batch_assign(table(spark, SF_DIR, "orders"), 100, "o_orderkey")
    assert "SinglePartition" not in plan(collect_batches(batched, F.col("o_orderstatus")))


def test_scans_read_only_what_is_needed(spark):
    text = contract.queries()["new_files"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "n_chars" in text and not re.search(r"ReadSchema: struct<[^>]*\btext\b", text)
    pulls = plan(contract.queries()["github_pulls"](spark, SF_DIR))
    assert "o_totalprice" not in pulls


def test_filters_reach_the_scan(spark):
    text = plan(contract.queries()["page_rejects"](spark, SF_DIR))
    assert "PushedFilters" in text
    late = table(spark, SF_DIR, "orders").where("o_orderstatus = 'O'")
    assert "EqualTo(o_orderstatus,O)" in plan(late)


def test_frequent_keys_are_joined_apart(spark):
    big = spark.range(1000).selectExpr("if(id < 500, 0, id) k", "id v")
    keyed = spark.range(1000).selectExpr("id k", "concat('n', id) name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_keyed(big, keyed, "k", max_rows=10))
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
        assert "SortMergeJoin" not in plan(join_keyed(big, keyed, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_tables_go_to_the_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    staged = scratch.stage(spark.range(3), "x")
    assert all(configured in name for name in staged.inputFiles())


def test_a_cluster_must_name_its_folder():
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())


def test_scope_deletes_what_was_staged(spark):
    with scratch.staging_scope(spark):
        path = scratch.stage(spark.range(3), "x").inputFiles()[0].rsplit("/", 1)[0]
        assert scratch.path_exists(spark, path)
    assert not scratch.path_exists(spark, path)
