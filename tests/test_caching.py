from almanac.models.caching import cached


def test_rows_stay_in_memory_for_the_block_only(spark):
    df = spark.range(10).withColumnRenamed("id", "only_here")
    with cached(df) as kept:
        assert kept.count() == 10
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not df.storageLevel.useMemory


def test_rows_the_caller_keeps_stay_kept(spark):
    df = spark.range(11).withColumnRenamed("id", "kept_outside").persist()
    with cached(df):
        pass
    assert df.storageLevel.useMemory
    df.unpersist()


def test_an_error_in_the_block_releases_the_rows(spark):
    df = spark.range(12).withColumnRenamed("id", "released")
    try:
        with cached(df):
            raise RuntimeError
    except RuntimeError:
        pass
    assert not df.storageLevel.useMemory
