import time

from pyspark.sql import functions as F

from plumbline.plans.lineage import cut


def _shuffle_blocks(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").count("shuffle_")


def test_a_cut_leaves_no_shuffle_files(spark):
    before = _shuffle_blocks(spark)
    kept = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("v")))
    ends = time.time() + 10
    while _shuffle_blocks(spark) > before and time.time() < ends:
        time.sleep(0.1)
    assert _shuffle_blocks(spark) <= before
    assert kept.agg(F.sum("v")).first()[0] == 499500
