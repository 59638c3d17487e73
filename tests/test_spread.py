from pyspark.sql import functions as F

from logloom.sources.spread import dealt


def test_small_scans_are_dealt_out(spark, tmp_path):
    spark.range(0, 4000, 1, 1).select("id", F.lit("x").alias("other")).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    shares = dealt(scan).groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) == cores and max(r["count"] for r in shares) <= 4000 // cores + cores
    assert sorted(r.id for r in dealt(scan).collect()) == list(range(4000))
    plan = dealt(scan).where("id > 7").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,7)]" in plan and "ReadSchema: struct<id:bigint>" in plan
    whole = spark.range(0, 100, 1, cores)
    assert dealt(whole) is whole and dealt(scan.where("false")).count() == 0
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "t"))
    assert dealt(stream) is stream
