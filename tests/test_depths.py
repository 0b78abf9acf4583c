from pyspark.sql import functions as F
from readloom.streaming import workqueue


def test_more_batches_than_spark_keeps(spark, tmp_path):
    """130 batches give 130 rows; Spark itself keeps the progress of the last hundred."""
    n = 130
    spark.range(n * (n + 1) // 2).select(F.floor((F.sqrt(F.col("id") * 8 + 1) - 1) / 2).alias("k"), F.lit("x").alias("value")).repartition(1).write.partitionBy("k").text(f"{tmp_path}/in")
    with workqueue.logged_depths(spark, f"{tmp_path}/depths", "counted") as log:
        other = spark.readStream.schema("value string").text(f"{tmp_path}/in").writeStream.queryName("other").format("noop").trigger(availableNow=True).start()
        rows = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{tmp_path}/in")
        query = rows.writeStream.queryName("counted").format("noop").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination()
        other.awaitTermination()
        log.wait(query)
    got = workqueue.depths(spark, f"{tmp_path}/depths").where("messages > 0").orderBy("batch").collect()
    assert [r.batch for r in got] == list(range(n)) and sorted(r.messages for r in got) == list(range(1, n + 1))
    assert len(query.recentProgress) <= 101 and all(r.time is not None for r in got)
