"""Helpers of the text operators: words, written intermediate tables, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendue.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: White space between words: space and U+0009 to U+000D, what ``bytes.split()`` splits at.
SPACES = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def raw_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a whole text, A-Z lower-cased, as UTF-8."""
    return raw_bytes(text).lower().split()


#: Rows and bytes of an Arrow batch of texts. Python holds one batch a task, so texts of any length fit.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of bounded size; plans made later in the session keep to it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path under the checkpoint folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    top = spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it again.

    Used for frames that several later steps read: column pruning still reaches the
    files, and a lost executor costs only the tasks that read from it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, frame: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    for name in frame.inputFiles()[:1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _changed(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` for edges ``a, b`` of longs; label is the smallest node of the component.

    Alternating large-star and small-star steps: every step is a minimum per node, which
    is summed up before the shuffle, and a join back, which AQE may split. Nodes with many
    neighbours are never gathered. Null ends and loops are left out; nodes without an
    edge to another node have no row.
    """
    e = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    e = stored(e, name)
    seen = _changed(e)
    while True:
        # large star: neighbours above a node go to the smallest of its neighbourhood
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of these
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        before, e = e, (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        e = stored(e, name)
        now = _changed(e)
        removed(e.sparkSession, before)  # the new edges are read from their own files
        if now == seen:
            break
        seen = now
    labels = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return labels.union(roots)
