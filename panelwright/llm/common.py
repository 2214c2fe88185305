"""What the corpus operators share: staging, batches of bounded size, spanning forests."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.session import shared_folder

#: Bytes of text that a task turns into arrays at once (one text may be longer).
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, name: str, release: bool = True) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors.

    The shuffle files behind the written table are of no more use; collections on the driver
    let Spark's cleaner delete them (a second one finds what the write itself held on to).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}-{name}"
    df.write.parquet(path)
    schema = df.schema
    del df
    for _ in range(2 if release else 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
    return spark.read.schema(schema).parquet(path)


def unstage(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def text_key() -> Column:
    """With doc_id, tells rows apart; rows that share both are copies and get one result."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``limit`` bytes of text, whole rows always."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


class Forest:
    """Union-find over 0..n-1 fed by arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.root[i], self.root[j]
        keep = a != b
        if not keep.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[keep], np.maximum(a, b)[keep]], axis=1), axis=0)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        for x, y in pairs.tolist():
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        moved = np.arange(len(self.root))
        for x in parent:
            moved[x] = find(x)
        self.root = moved[self.root]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node that is not its own root, with its root: at most one link a node."""
        i = np.flatnonzero(self.root != np.arange(len(self.root)))
        return i, self.root[i]


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a long, b long): rows (node, root), root the smallest node.

    Alternating large and small stars: each round joins nodes to the least neighbour known,
    staged in the shared folder; it ends when a round changes nothing. Nodes without links
    are absent. A hub's rows meet its least neighbour in a plain join, which AQE can split.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links", False
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stage(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "links", False)
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        unstage(edges)
        edges = new
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
