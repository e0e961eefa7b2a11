"""Shuffle files that a session still holds."""

import time


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def left_of(spark, before):
    """Shuffle files made since ``before``; they go in the background."""
    for _ in range(40):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.25)
    return shuffle_files(spark) - before
