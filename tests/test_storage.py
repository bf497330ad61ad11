import pytest
from pyspark.sql import functions as F

from gridpulse.operators.sizes import measured_bytes
from gridpulse.session import local_scratch
from gridpulse.sources import scratch, tables

GRID = "grid_id bigint, window_sms_in double, window_sms_out double, window_call_in double, window_call_out double, " \
       "window_internet_activity double, window_total_activity double"


def rollups(spark, root, partitioned=True):
    grid = spark.range(10).select(F.col("id").alias("grid_id"), *[F.lit(1.0).alias(c.split()[0]) for c in GRID.split(", ")[1:]])
    grid = grid.withColumn("part", F.col("grid_id") % 5)
    (grid.write.partitionBy("part") if partitioned else grid.write).parquet(f"{root}/grid_performance")
    spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS timestamp, 1.0D AS timestamp_total_activity").write.parquet(f"{root}/temporal")


def test_discover_reads_all_partitions(spark, tmp_path):
    rollups(spark, tmp_path)
    found = tables.discover(spark, str(tmp_path))
    assert found["grid"].count() == 10 and found["temporal"].count() == 1


def test_discover_refuses_two_of_a_kind(spark, tmp_path):
    rollups(spark, tmp_path)
    rollups(spark, tmp_path / "again", partitioned=False)
    with pytest.raises(ValueError, match="two datasets of kind grid|two datasets of kind temporal"):
        tables.discover(spark, str(tmp_path))


def test_scratch_needs_a_shared_folder_outside_local_mode():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            local_scratch(master)


def test_scratch_tables_can_be_removed(spark):
    kept = scratch.cut(spark.range(5))
    path = kept.inputFiles()[0].rpartition("/")[0]
    assert scratch.drop_scratch(spark) >= 1
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def test_nested_columns_are_measured(spark):
    wide = spark.range(2).select(F.array_repeat(F.lit("x" * 50), 100).alias("a"))
    assert measured_bytes(wide) > 2 * 5000
