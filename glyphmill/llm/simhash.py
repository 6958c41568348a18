"""SimHash near-dedup by a segment-popcount embedding.

A 64-bit fingerprint maps to 32 counts, the set bits of each two-bit segment. The Manhattan distance of two
such vectors is a lower bound of the fingerprints' Hamming distance, so fingerprints that differ in at most
three bits are within one step of each other in the first or in the last 16 counts. Each half is a grid: a
fingerprint stands in its own cell and asks that cell and those one step up; an equi-join of cells is the
range join, and the exact Hamming distance decides. Cells with many fingerprints aren't paired off: blocks
of bounded size give only the edges of a spanning forest.

Defined results. Null and empty texts have fingerprint 0 and link like any other. Texts of fewer words than
a shingle hash as one sequence. Copies share a fingerprint and so a component. The component of rows whose
doc_ids are all null is null. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, if_small, keep, workspace

#: The even bits of 32: subtracting a half's odd bits, moved onto them, leaves each segment's count in its two bits.
EVEN = 0x55555555
#: A cell with more fingerprints than this is worked on in blocks of BLOCK.
CROWD, BLOCK = 16, 4096
SMALL = 400_000


def simhash(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text."""
    w = (text or b"").lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else iter((b" ".join(w),))
    n = max(1, len(w) - words + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 256):  # sums of 255 bytes fit a byte, so eight bits' counts add up in one 64-bit word
        bits = np.unpackbits(h[at : at + 255 * 256].view(np.uint8)).view(np.uint64).reshape(-1, 8)
        lanes = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        ones += lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    out = np.packbits((ones * 2 > n).astype(np.uint8)).view(np.int64)  # the same byte order as unpackbits saw
    return int(out[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc, fp): each row's id and fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([simhash(t, words) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.encode(text_col, "UTF-8").alias("text")).mapInArrow(run, f"doc {kind}, fp long")


def _forest(group: pd.DataFrame) -> pd.DataFrame:
    """Edges that join, within a block, what is at most three bits apart; at most one for each two trees."""
    home = group.loc[group["home"], "fp"].to_numpy().view(np.uint64)
    asks = group.loc[~group["home"], "fp"].to_numpy().view(np.uint64)
    label = np.arange(len(asks))
    out = []
    for x in home:
        near = np.flatnonzero(np.bitwise_count(asks ^ x) <= 3)
        if len(near):
            labels, first = np.unique(label[near], return_index=True)
            ends = near[first]
            out.append(np.stack([np.full(len(ends), x), asks[ends]]))
            if len(labels) > 1:
                label[np.isin(label, labels[1:])] = labels[0]
    pairs = np.concatenate(out, axis=1).view(np.int64) if out else np.zeros((2, 0), np.int64)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def hamming_links(fps: DataFrame) -> DataFrame:
    """(a, b): edges that connect just the distinct fingerprints (column fp) that chains of links connect.

    Sparse cells give all their links, crowded ones a spanning forest.
    """
    halves = F.array(F.expr("fp & 4294967295L"), F.expr("shiftrightunsigned(fp, 32)"))
    cells = fps.select("fp", F.posexplode(halves).alias("half", "x"))
    cells = cells.select("fp", "half", F.expr(f"x - (shiftright(x, 1) & {EVEN}L)").alias("cell"))
    ups = F.expr("concat(array(cell), transform(filter(sequence(0, 15), i -> (shiftright(cell, 2 * i) & 3L) < 2), i -> cell + shiftleft(1L, 2 * i)))")
    asks = cells.select("fp", "half", F.col("cell").alias("own"), F.explode(ups).alias("cell"))
    size = keep(cells.groupBy("half", "cell").agg(F.count("*").alias("homes")))
    asked = asks.join(size, ["half", "cell"])  # most cells that are asked have nobody in them
    asked = asked.where("own <> cell or homes > 1")
    sparse = asked.where(F.col("homes") <= CROWD).select("half", "cell", "own", F.col("fp").alias("a"))
    pairs = sparse.join(cells.withColumnRenamed("fp", "b"), ["half", "cell"]).where("(own <> cell or a < b) and bit_count(a ^ b) <= 3")
    crowds = size.where(F.col("homes") > CROWD)
    n = crowds.count()
    links = pairs.select("a", "b").distinct()
    if n:
        crowd = keep(asked.where(F.col("homes") > CROWD).groupBy("half", "cell").agg(F.count("*").alias("askers"), F.first("homes").alias("homes")))
        crowd = crowd.select("half", "cell", F.ceil(F.col("homes") / BLOCK).alias("nh"), F.ceil(F.col("askers") / BLOCK).alias("na"))
        crowd = if_small(crowd, n, SMALL)
        homes = cells.join(crowd, ["half", "cell"]).select("half", "cell", F.pmod(F.xxhash64("fp"), F.col("nh")).alias("i"), F.explode(F.expr("sequence(0L, na - 1)")).alias("j"), "fp", F.lit(True).alias("home"))
        callers = asks.join(crowd, ["half", "cell"]).select("half", "cell", F.explode(F.expr("sequence(0L, nh - 1)")).alias("i"), F.pmod(F.xxhash64("fp"), F.col("na")).alias("j"), "fp", F.lit(False).alias("home"))
        links = links.unionByName(homes.unionByName(callers).groupBy("half", "cell", "i", "j").applyInPandas(_forest, "a long, b long").where("a <> b"))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc, fp, component): one row for each row of ``docs``; component is the smallest id reachable."""
    spark = docs.sparkSession
    with workspace(spark, "simhash") as ws:
        prints = ws.write(fingerprints(docs, id_col, text_col, words), "prints")
        classes = ws.write(prints.groupBy("fp").agg(F.min("doc").alias("least")), "classes")
        roots = connected_components(hamming_links(classes.select("fp")))
        own = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
        own = keep(own)
        best = own.groupBy("root").agg(F.min("least").alias("component"))
        label = keep(own.join(best, "root").select("fp", "component"))
        rows = label.count()
        return keep(prints.join(if_small(label, rows, SMALL), "fp").select("doc", "fp", "component"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs)
    return out.select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
