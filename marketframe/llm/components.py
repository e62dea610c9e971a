"""Connected components of a table of links, and tables written to the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.session import scratch_dir


def small_batches(spark: SparkSession) -> None:
    """Batches of 8 MB to Python workers where the session has Spark's default of 64 MB: a batch is held several
    times over (JVM, both Arrow sides, Python), in every task of an executor."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("67108864b", "64m", "64MB"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from Parquet files in the shared folder: computed once, whatever is lost later."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Takes a scratch table that nothing reads any more out of the shared folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of a link (columns x, y): root is the component's smallest node.

    Every round each node takes the smallest root among its own and its neighbours', then its root's root, so distances
    halve; the rounds end when none changes. Rows are links and nodes only; a node's neighbours are never gathered."""
    both = written(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    roots = written(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("root")).withColumnRenamed("x", "node"), "roots")
    while True:
        near = both.join(roots, both.y == roots.node).groupBy("x").agg(F.min("root").alias("near"))
        step = roots.join(near, roots.node == near.x).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
        step = written(step.join(up, "root", "left").select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "roots")
        roots = step.select("node", "root")
        if step.where(F.col("old") != F.col("root")).isEmpty():
            return roots
