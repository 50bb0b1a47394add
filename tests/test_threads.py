"""Jobs side by side do not see each other's local properties."""

import time

from padronix.operators.threads import side_by_side


def test_tasks_keep_their_own_properties(spark):
    sc = spark.sparkContext

    def job(i):
        sc.setLocalProperty("padronix.test", str(i))
        time.sleep(0.05)
        assert sc.getLocalProperty("padronix.test") == str(i)
        return spark.range(10).where(f"id < {i}").count()

    assert side_by_side(spark, job, range(8), 4) == list(range(8))
