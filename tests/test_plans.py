"""Shapes of physical plans that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from slabwise.operators import pack_slabs, stdev_by_dim, subarray_slabs
from slabwise.plans import QUERIES, slab_queries
from slabwise.sources.store import open_array

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_forced_broadcast(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_slab_bounds_reach_parquet(spark):
    slabs, schema = open_array(spark, slab_queries.stored_plane(spark, SF_DIR))
    text = plan(stdev_by_dim(subarray_slabs(slabs, schema, (100, 20), (299, 43)), ["unnamed0"], "value"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    for part in (
        "LessThanOrEqual(origin_unnamed0,299)", "GreaterThanOrEqual(last_unnamed0,100)",
        "LessThanOrEqual(origin_unnamed1,43)", "GreaterThanOrEqual(last_unnamed1,20)",
    ):
        assert part in pushed
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "slab_no" not in read


def test_flagship_reads_two_columns_and_shuffles_once(spark):
    text = plan(QUERIES["subarray_stdev"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<vec_id:bigint,embedding:array<float>>", text)
    assert len(re.findall(r"Exchange", text)) == 1 and "partial_stddev_samp" in text


def test_attribute_selection_prunes_stored_cells(spark):
    part = spark.read.parquet(f"{SF_DIR}/part.parquet").select("p_partkey", "p_size")
    assert re.search(r"ReadSchema: struct<p_partkey:bigint,p_size:int>", plan(part))


def test_packing_reads_once_and_exchanges_once(spark):
    schema = slab_queries.plane_schema(spark, SF_DIR)
    cells = slab_queries.plane(spark, SF_DIR)
    for checked in (True, False):
        text = plan(pack_slabs(cells, schema, checked=checked))
        assert text.count("Exchange hashpartitioning") == 1 and text.count("Scan parquet") == 1
        assert "Join" not in text and "Aggregate" not in text and "collect_list" not in text


def test_cell_queries_stay_in_generated_code(spark):
    for name in ("unroll", "stats_by_dim", "subarray_stdev", "cell_to_slab", "linearize"):
        df = QUERIES[name](spark, SF_DIR)
        df.collect()
        assert re.search(r"\*\(\d+\) (Project|HashAggregate)", plan(df)), name


def test_redistribute_uses_the_asked_partitions(spark):
    from slabwise.operators import redistribute

    rows = spark.range(1000).select((F.col("id") / 10).cast("long").alias("origin_0"))
    assert redistribute(rows, ["origin_0"], 5).rdd.getNumPartitions() == 5
    ranged = redistribute(rows, ["origin_0"], 5, by_range=True)
    spans = ranged.groupBy(F.spark_partition_id()).agg(F.min("origin_0").alias("a"), F.max("origin_0").alias("b"))
    spans = sorted((r.a, r.b) for r in spans.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_redistribute_splits_a_hot_key(spark, tmp_path):
    from slabwise.operators import redistribute

    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    rows = spark.range(1_000_000).repartition(8).select(hot.alias("origin_0"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500KB")
    try:
        redistribute(rows, ["origin_0"]).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(str(tmp_path / "out"))
    hot_files = stored.where("origin_0 = 0").select(F.input_file_name()).distinct().count()
    assert hot_files > 1 and stored.count() == 1_000_000


@pytest.mark.parametrize("name", ["dense_check_box", "array_holes"])
def test_density_needs_no_sort(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "SortAggregate" not in text and "bit_or" in text
