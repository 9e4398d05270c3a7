"""What staging leaves behind."""

import time

from chartloom.sinks import staging


def test_shuffle_files_go_with_the_write(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in (x.getName() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.getAllFiles())) if f.startswith("shuffle_")}

    dealt = spark.range(1000).repartition(3, "id")
    before, setting = shuffled(), spark.conf.get(staging.FREE_SHUFFLES, None)
    staged = staging.stage(dealt, "dealt")
    for _ in range(50):  # removed in the background
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(staging.FREE_SHUFFLES, None) == setting
    assert sorted(r.id for r in staged.collect()) == list(range(1000))
    assert dealt.count() == staging.stage(dealt, "again").count() == 1000  # a frame that was staged can be used on
