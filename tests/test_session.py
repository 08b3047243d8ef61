import time

import pytest

from corpusloom import session


def exchanges(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}


@pytest.mark.parametrize("kept", [session.cut, session.stored])
def test_written_results_leave_no_exchanges(spark, kept):
    """Else a query's disk holds all exchanges of its steps until the driver happens to collect its garbage."""
    before, setting = exchanges(spark), spark.conf.get(session.FREED)
    out = kept(spark.range(50_000).repartition(3, "id").groupBy("id").count())
    for _ in range(50):
        if not exchanges(spark) - before:
            break
        time.sleep(0.2)
    assert not exchanges(spark) - before
    assert out.count() == 50_000 and spark.conf.get(session.FREED) == setting
