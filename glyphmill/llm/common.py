"""Helpers that the training-data operators share: shared folders, tables, ids and connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batches import BATCH_BYTES, BATCH_ROWS, small_batches  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Space and \x09-\x0D, the white space of all contracts.
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset, a local session gets a temporary one, which goes when Python ends; on a cluster, whose executors
    wouldn't share such a folder, it is an error.
    """
    sc = spark.sparkContext
    if not (there := sc.getCheckpointDir()):
        named = spark.conf.get("spark.checkpoint.dir", "") or sc.getConf().get("spark.checkpoint.dir", "")
        if not named:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="glyphmill-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        there = sc.getCheckpointDir()
    return there


#: glibc's name for the size from which on an allocation is mapped on its own and unmapped when freed.
M_MMAP_THRESHOLD, LARGE = -3, 8 << 20


def large_arrays_apart() -> None:
    """Makes the worker process return arrays of 8 MB or more to the system when they are freed.

    By itself glibc raises that size up to 32 MB as arrays come and go, and a worker keeps what it once had.
    """
    with contextlib.suppress(OSError, AttributeError):  # other C libraries
        ctypes.CDLL(None).mallopt(M_MMAP_THRESHOLD, LARGE)


def give_back() -> None:
    """Returns what the worker process doesn't use any more to the system: Arrow's pool, then the heap's free pages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Workspace:
    """A folder of intermediate Parquet tables in the shared folder; the tables go when the work is over."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Writes a table and reads it again, so that later work starts from the files and not from the lineage."""
        path = f"{self.root}/{name}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Lets Spark's cleaner remove shuffle files and checkpoints that nothing refers to; it waits for a collection on the driver."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, name: str = "") -> None:
        remove(self.spark, f"{self.root}/{name}".rstrip("/"))


@contextlib.contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Workspace]:
    """A Workspace for eager work. Results that outlive it must have been kept with ``keep``."""
    ws = Workspace(spark, name)
    try:
        yield ws
    finally:
        ws.drop()


def keep(df: DataFrame) -> DataFrame:
    """Computes a table now and cuts its lineage by a reliable checkpoint.

    Spark's cleaner removes it when nothing refers to it any more, if spark.cleaner.referenceTracking.cleanCheckpoints is
    set when the session begins; else it stays in the folder of the session.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint for a counted table of at most ``limit`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(df) if rows <= limit else df


def boxed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Whole rows in one column ``_row`` beside the keys, so that no column's name clashes with another's."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.struct(F.lit(0).alias("none"))
    return docs.select(row.alias("_row"), *(c.alias(k) for k, c in keys.items()))


def unboxed(df: DataFrame, names: list[str], **added: Column) -> DataFrame:
    """The rows' columns again, and the added ones, which replace columns of their names."""
    return df.select(*(F.col("_row").getField(c).alias(c) for c in names if c not in added), *(c.alias(k) for k, c in added.items()))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hash128(value: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; together a key without collisions in practice."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def partitions_for(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-total // each))


#: Edges up to which a counted graph is worked on by one task in one pass (some 10 MB); a larger one by all, in rounds.
FEW_EDGES = 200_000


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges, sorted, and the smallest node reachable from each: stars are hooked onto smaller ones and flattened until none is left to hook."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))  # x and y are roots
        while not np.array_equal(up := root[root], root):
            root = up
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def _components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all edges (a, b) of the batches."""
    edges = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if edges:
        nodes, roots = roots_of(*map(np.concatenate, zip(*edges, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b: long).

    Alternates large-star and small-star rounds, each checkpointed; edges shrink to stars. No node's
    neighbours are ever gathered in one row: rounds use minima and joins only. A counted graph of few
    edges is hooked into stars by one task: as rounds it would cost the driver some 15 queries, and their plans and code.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = keep(e)
    if e.count() <= FEW_EDGES:
        return keep(e.coalesce(1).mapInArrow(_components, "node long, root long"))
    seen = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        stars = small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        e = keep(stars.distinct())
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
