"""Helpers shared by the corpus operators: shared storage, text keys, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Workspace:
    """Tables an operator writes for its own later steps, in the shared folder.

    The folder is the one spark.checkpoint.dir names; only a local session that names
    none gets a temporary one. Written tables cut lineage: a lost executor costs a
    re-read, not a recomputation. `drop` removes tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="llm-work-")
        self.root = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
        self._count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back."""
        return self.spark.read.schema(df.schema).parquet(self.path(df, name))

    def path(self, df: DataFrame, name: str) -> str:
        """Write df; its folder."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return path

    def drop(self, path: str) -> None:
        """Delete a table written here."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def text_key(column: str) -> list:
    """128 bits that name a text; equal texts get equal keys, null counts as empty."""
    text = F.coalesce(F.col(column), F.lit(""))
    return [F.xxhash64(text).alias("tk1"), F.xxhash64(F.lit(7), text).alias("tk2")]


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the edges (a, b): every node and its root."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) of every node in the edges (a, b); root is the component's least node.

    Alternating star contraction: each round hooks every node to the least node among
    its neighbours, once towards larger and once towards smaller neighbours, until the
    edges no longer change. Least neighbours are aggregated map-side and joined back,
    so the hub of a large star is never gathered; rounds are written, not kept in lineage.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    path = work.path(pairs, "stars")
    before = None
    while True:
        pairs = work.spark.read.schema("u long, v long").parquet(path)
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hooked = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = hooked.groupBy("u").agg(F.min("v").alias("m"))
        star = hooked.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new_path = work.path(star.union(small.select("u", F.col("m").alias("v"))).distinct(), "stars")
        work.drop(path)
        path = new_path
        new = work.spark.read.schema("u long, v long").parquet(path)
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = work.spark.read.schema("u long, v long").parquet(path)
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(stars.select(F.col("v"), F.col("v")).distinct())


#: Keys told apart as hot are at most so many, so their facts can be broadcast.
HOT_KEYS = 1000


def attach(rows: DataFrame, facts: DataFrame, on: list[str]) -> DataFrame:
    """rows LEFT JOIN facts, whose keys are unique; no key's rows are gathered.

    A key with over a thousandth of the rows (and over 1000) is hot: at most HOT_KEYS are, so
    their facts are broadcast to the rows, wherever these lie. The rest is joined by key.
    """
    n = rows.count()
    often = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > max(1000, n // HOT_KEYS)).select(*on)
    hot = F.broadcast(often.limit(HOT_KEYS).withColumn("_hot", F.lit(True)))
    marked = rows.join(hot, on, "left")
    some = F.broadcast(facts.join(hot, on, "left_semi"))
    cold = marked.where("_hot is null").drop("_hot").join(facts, on, "left")
    return cold.unionByName(marked.where("_hot").drop("_hot").join(some, on, "left"))


def pivots_of(vectors: DataFrame, order, count: int) -> DataFrame:
    """At most `count` rows, told by a hash order: the same ones in every run."""
    return vectors.orderBy(order).limit(count)
