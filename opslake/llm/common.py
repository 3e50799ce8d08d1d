"""What the operators share: the shared folder, written intermediate tables, labels of linked rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that one Arrow batch may hold: Python workers see a bounded slice of any table.
BATCH_ROWS, BATCH_BYTES = 2000, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local one is set for a local master; a cluster has to name its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage is cut, and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get, so that long texts don't add up in memory.

    Results are lazy, so the setting stays with the session; a caller who needs another sets it before other queries.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def many_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of more and narrow rows for what is written inside; the bound in bytes stays."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def bucketed(df: DataFrame, name: str, key: str, compression: str = "uncompressed", placed: bool = False) -> DataFrame:
    """The rows as files in the shared folder, bucketed and sorted by a key; their entry in the catalog goes at once.

    placed: the rows are already hash-partitioned by the key, in as many partitions as shuffles have.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_{name}_{uuid.uuid4().hex}"
    (df if placed else df.repartition(n, key)).write.option("compression", compression).option("path", f"{shared_dir(spark)}/{name}").bucketBy(n, key).sortBy(key).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def labelled(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component_id): the smallest id that links reach from each id.

    nodes: (id), distinct. edges: (a, b), any direction, a != b, ids of nodes.
    Every round takes each id's smallest neighbouring label, then follows labels of labels, so that chains halve.
    The neighbours' labels are min-aggregated before they are shuffled, so an id with very many links is no hot key.
    Ids without links keep themselves. Raises RuntimeError if rounds don't suffice, instead of giving wrong classes.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("id"), "label"), "label")
    for k in range(rounds):
        near = both.join(label.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near.withColumnRenamed("a", "id"), "id", "left").select("id", "label", F.least("label", F.coalesce("near", "label")).alias("next"))
        roots = label.select(F.col("id").alias("next"), F.col("label").alias("root"))
        new = written(step.join(roots, "next", "left").select("id", F.col("label").alias("was"), F.least("next", F.coalesce("root", "next")).alias("label")), f"label{k}")
        changed = new.where("label <> was").limit(1).count()
        label = new.select("id", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return nodes.join(label, "id", "left").select("id", F.coalesce("label", "id").alias("component_id"))


def merged(label: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """label, (id, component_id) as from labelled(), after more edges (a, b): only those between different components are followed, as links of components."""
    side = lambda k: label.select(F.col("id").alias(k), F.col("component_id").alias(f"c{k}"))
    between = edges.select("a", "b").join(side("a"), "a").join(side("b"), "b").where("ca <> cb")
    between = written(between.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), f"{name}-between")
    if not between.limit(1).count():
        return label
    ends = between.select(F.col("a").alias("id")).union(between.select("b")).distinct()
    new = labelled(ends, between).select(F.col("id").alias("component_id"), F.col("component_id").alias("to"))
    return written(label.join(new, "component_id", "left").select("id", F.coalesce("to", "component_id").alias("component_id")), name)


#: Ids that a join may broadcast.
BROADCAST_IDS = 500_000


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key is not among ids, all columns as they were; null keys stay. The ids are counted first: only a short list is broadcast."""
    gone = written(ids.select(F.col(key)).where(F.col(key).isNotNull()).distinct(), "gone")
    small = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if small else gone, key, "left_anti").select(docs.columns)
