import threading

from pyspark.sql import functions as F

from eventflow.plans.measured import measured
from eventflow.session import setting


def run(frame):
    frame.write.format("noop").mode("overwrite").save()


def counts(spark, groups):
    return spark.range(20_000).groupBy((F.col("id") % groups).alias("g")).count()


def test_fewer_partitions_run_than_are_set(spark):
    with setting(spark, "spark.sql.shuffle.partitions", "200"):
        with measured(spark) as found:
            run(counts(spark, 50))
        assert found.configured == 200 and 0 < found.used < 200
        assert found.written_bytes == found.read_bytes > 0
        with setting(spark, "spark.sql.adaptive.enabled", "false"), measured(spark) as found:
            run(counts(spark, 5000))
        assert (found.used, found.tasks) == (200, [200])


def test_work_without_a_shuffle_and_work_beside(spark):
    with measured(spark) as found:
        run(spark.range(100))
        beside = threading.Thread(target=run, args=(counts(spark, 7),))
        beside.start()
        beside.join()
    assert (found.used, found.written_bytes, found.tasks) == (0, 0, [])
