"""Logs derived from the given tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import changelogs as logs

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("log", [logs.user_state_log, logs.activity_log, logs.orders_log, logs.messages_log])
def test_a_file_of_one_row_group_is_made_a_log_by_many_tasks(spark, log):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        tasks = log(spark, SF).groupBy(F.spark_partition_id().alias("task")).agg(F.max(F.length("value"))).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert tasks > 1
