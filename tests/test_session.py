"""Session settings and the shared folder."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from chargestream.session import RUNTIME_CONF, checkpoint_dir, configure, release, scratch_path, stage, stage_result

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_settings(spark):
    configure(spark)
    assert {key: spark.conf.get(key) for key in RUNTIME_CONF} == RUNTIME_CONF


def test_shuffles_of_large_jobs_start_with_many_partitions(spark):
    try:
        configure(spark, shuffle_bytes=100 * 2**40)
        assert spark.conf.get(INITIAL) == "819200"
        configure(spark, shuffle_bytes=1)
        assert spark.conf.get(INITIAL) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(INITIAL)


def test_the_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or configured in checkpoint_dir(spark)
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_staged_table_is_read_from_its_files(spark):
    df = spark.range(10).select("id", F.map_from_arrays(F.array(F.lit("k")), F.array("id")).alias("m"))
    staged = stage(df, "test")
    assert sorted(staged.collect()) == sorted(df.collect()) and staged.schema.names == df.schema.names
    assert all(path.startswith("file:") for path in staged.inputFiles())


def test_an_empty_table_can_be_staged(spark):
    assert stage(spark.range(0), "test").collect() == []


def test_release_empties_the_folder(spark):
    first, second = stage(spark.range(3), "test"), stage(spark.range(4), "test")
    places = [path.removeprefix("file:").removeprefix("//") for df in (first, second) for path in df.inputFiles()]
    assert places and all(os.path.exists(path) for path in places)
    assert release(spark) >= 2
    assert not any(os.path.exists(path) for path in places) and release(spark) == 0


def test_a_staged_result_leaves_only_itself(spark):
    made = []

    def build():
        made.append(scratch_path(spark, "inner"))
        spark.range(3).write.parquet(made[0])
        return spark.read.parquet(made[0])

    result = stage_result(spark, "outer", build)
    assert not os.path.exists(made[0].removeprefix("file:"))
    assert sorted(r.id for r in result.collect()) == [0, 1, 2]


def test_a_result_leaves_what_other_threads_staged(spark):
    with ThreadPoolExecutor(1) as other:

        def build():
            inner = stage(spark.range(3), "inner")
            elsewhere.append(other.submit(lambda: stage(spark.range(7), "elsewhere")).result())
            return inner

        elsewhere: list = []
        result = stage_result(spark, "result", build)
    assert (result.count(), elsewhere[0].count()) == (3, 7)
