"""Files that cut lineage, and the bound on batches."""

from pathlib import Path

from plumbline.llm import tables


def test_kept_files_are_read_again_and_forgotten(spark):
    df = tables.kept(spark.range(10).selectExpr("id", "id * 2 as twice"), "numbers", compression="zstd")
    (path,) = {Path(f.removeprefix("file:")).parent for f in df.inputFiles()}
    assert df.count() == 10 and path.exists()
    tables.forget(spark)
    assert not path.exists()
    tables.forget(spark)
    assert tables.kept(spark.range(3).toDF("id"), "numbers").count() == 3


def test_batches_are_bounded_by_bytes_once(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        tables.small_batches(spark)
        assert spark.conf.get(name) == f"{tables.BATCH_BYTES}b"
        spark.conf.set(name, "1000b")
        tables.small_batches(spark)
        assert spark.conf.get(name) == "1000b"
    finally:
        spark.conf.set(name, held)
