"""Suffix-array dedup: long repeats of bytes, found by external induced sorting of shards.

Blocks of windows around anchors say where repeats can be. Blocks of an anchor all of whose places have the same
content are decided by their count. The contents that differ, one place of each, fall apart into pieces, windows at
about the same distance from the anchor. The bytes that all windows of a piece share name it: equal windows are in
pieces of one name, and a name with one piece is done with; equal pieces are one case, repeated as a whole. The others, one
of each, are dealt by name to shards; a name of very many pieces is taken apart further first. A shard's suffixes are
sorted by ``induced``, whose queues are on disk, and a window is repeated if its common prefix with a neighbour is
long enough.

Defined results. Null and empty texts have no bytes. Repeated rows, null ids and ties don't matter: every row is
judged by its text, named by hash and size, and copies are places of their own. Texts of under ``length`` bytes lose
nothing. Empty tables give empty results. Columns added begin with an underscore, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import blocks, contested, kgram_hashes, texts_of, with_spans
from .common import Workspace, boxed, keep, partitions_for, unboxed, workspace
from .induced import repeated_starts

#: Bytes in a k-gram of the anchors, of a shard, and of a key that is taken apart further; windows in a piece.
GRAM, SHARD, HOT, STRIDE, FINE = 64, 1 << 20, 1 << 19, 32, 4
FOUND = "anchor long, content long, t long, size int, start int, windows int"
NAMES = ["anchor", "content", "t", "size", "start", "windows"]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def byte_blocks(docs: DataFrame, length: int) -> DataFrame:
    """FOUND rows of the documents (t, size, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: list[list] = [[] for _ in NAMES]
            for t, size, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not text or len(text) < length:
                    continue
                first, count, anchor = blocks(np.frombuffer(text, np.uint8), min(GRAM, length), length)
                ends = first + count + length - 1
                made = [_signed(xxhash.xxh3_64_intdigest(text[x:y])) for x, y in zip(first.tolist(), ends.tolist(), strict=True)]
                n = len(first)
                for p, v in zip(parts, (anchor, np.array(made, np.int64), np.full(n, t), np.full(n, size), first, count), strict=True):
                    p.append(v)
            cols = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.int32(), safe=False) for k, c in enumerate(cols)], NAMES)

    return docs.mapInArrow(run, FOUND)


def contents_of(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, content, n, base, bytes): the disputed contents; base is 0, the number of the first window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out = [(p["anchor"], p["content"], p["n"], 0, text[p["start"] : p["start"] + p["windows"] + length - 1]) for p in wanted]
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["anchor", "content", "n", "base", "bytes"])

    return texts.select("text", "wanted").mapInArrow(run, "anchor long, content long, n long, base int, bytes binary")


def pieces_of(contents: DataFrame, length: int, stride: int) -> DataFrame:
    """(anchor, content, at, n, base, windows, key, h): the pieces of contents that begin at window ``at``.

    A piece is the windows whose distances to the anchor are in one stretch of ``stride``; its key hashes the
    anchor, the stretch and the bytes that all windows of such a stretch cover; h hashes all of the piece. Equal windows
    are in pieces of one key.
    """
    names = ["anchor", "content", "at", "n", "base", "windows", "key", "h"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = min(GRAM, length)
        for b in batches:
            out: list[tuple] = []
            for anchor, content, n, at, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                count = len(body) - length + 1
                lead = int(np.argmin(kgram_hashes(np.frombuffer(body, np.uint8), k)[: length - k + 1] >> np.uint64(32)))  # the anchor's place
                for r in range((lead - count + 1) // stride, lead // stride + 1):
                    x, y = max(0, lead - stride * r - stride + 1), min(count, lead - stride * r + 1)
                    common = body[max(0, lead - stride * r) : lead - stride * r - stride + 1 + length]
                    key = xxhash.xxh3_64_intdigest(common, seed=(anchor ^ r) & 0xFFFFFFFF)
                    out.append((anchor, content, at, n, at + x, y - x, _signed(key), _signed(xxhash.xxh3_64_intdigest(body[x : y + length - 1]))))
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i in (2, 4, 5) else pa.int64()) for i, c in enumerate(cols)], names)

    return contents.select("anchor", "content", "n", "base", "bytes").mapInArrow(run, "anchor long, content long, at int, n long, base int, windows int, key long, h long")


def settle(contents: DataFrame, length: int, stride: int, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """What the pieces of contents say at once, and what is left to compare.

    Returns runs (anchor, content, k, windows) of pieces that occur twice or more as a whole, and of the keys with
    several different pieces one of each: (key, volume, anchor, content, n, base, bytes).
    """
    pieces = ws.write(pieces_of(contents, length, stride), f"pieces{stride}")
    groups = pieces.groupBy("key", "h").agg(F.sum("n").alias("n"), F.min(F.struct("anchor", "content", "at", "base", "windows")).alias("one"))
    groups = ws.write(groups, f"groups{stride}")
    # contents of several places are repeated as a whole already
    runs = pieces.where("n = 1").join(groups.where("n > 1").select("key", "h"), ["key", "h"], "left_semi").select("anchor", "content", F.col("base").alias("k"), "windows")
    keys = groups.groupBy("key").agg(F.count("*").alias("c"), F.min("n").alias("n"), F.sum(F.col("one.windows") + length - 1).alias("volume")).where("c > 1 and n = 1")
    left = groups.join(keys.select("key", "volume"), "key").select("key", "volume", "n", "one.*")
    whole = contents.select("anchor", "content", F.col("base").alias("at"), "bytes")
    left = left.join(whole, ["anchor", "content", "at"])
    cut = F.expr(f"substring(bytes, base - at + 1, windows + {length - 1})")
    return ws.write(runs, f"runs{stride}"), ws.write(left.select("key", "volume", "anchor", "content", "n", "base", cut.alias("bytes")), f"left{stride}")


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        anchor, content, n, base = (table.column(c).to_numpy() for c in ("anchor", "content", "n", "base"))
        out: list[list] = [[], [], [], []]
        for k, starts in enumerate(repeated_starts(table.column("bytes").to_pylist(), length)):
            if n[k] > 1 or not len(starts):  # contents of several places are repeated as a whole
                continue
            breaks = np.flatnonzero(np.diff(starts) > 1) + 1
            first, last = starts[np.append(0, breaks)], starts[np.append(breaks - 1, len(starts) - 1)]
            for p, v in zip(out, (np.full(len(first), anchor[k]), np.full(len(first), content[k]), first + base[k], last - first + 1), strict=True):
                p.append(v)
        cols = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in out]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32(), safe=False), pa.array(cols[3], pa.int32(), safe=False)], ["anchor", "content", "k", "windows"])

    return run


def repeated_bytes(docs: DataFrame, length: int = 400) -> DataFrame:
    """(t, size, start, windows): runs of windows that occur elsewhere too, by text; docs has t, size and text."""
    spark = docs.sparkSession
    with workspace(spark, "suffixes") as ws:
        places, repeated, disputed = contested(byte_blocks(docs, length), ws)
        disputed = ws.write(disputed, "disputed")
        whole = places.join(repeated, ["anchor", "content"]).select("t", "size", "start", "windows")
        wanted = disputed.groupBy("t", "size").agg(F.collect_list(F.struct("anchor", "content", "n", "start", "windows")).alias("wanted"))
        contents = ws.write(contents_of(texts_of(docs, disputed, ws).join(wanted, ["t", "size"]), length), "bytes")
        runs, left = settle(contents, length, STRIDE, ws)
        hot = left.where(F.col("volume") > HOT).drop("key", "volume")
        cold = left.where(F.col("volume") <= HOT)
        if not hot.isEmpty():  # very many pieces of one key: smaller ones share more, and so are told apart
            more, rest = settle(hot, length, FINE, ws)
            runs, cold = runs.unionByName(more), cold.unionByName(rest)
        total = cold.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
        shards = cold.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(partitions_for(total, SHARD))))
        found = shards.groupBy("shard").applyInArrow(_shard(length), "anchor long, content long, k int, windows int")
        runs = runs.unionByName(ws.write(found, "found"))
        part = places.drop("windows").join(runs, ["anchor", "content"]).select("t", "size", (F.col("start") + F.col("k")).alias("start"), "windows")
        return keep(whole.unionByName(part))


def drop_repeated_bytes(docs: DataFrame, text_col: str = "text", length: int = 400) -> DataFrame:
    """``docs`` with ``_n_bytes``, ``_n_removed``, ``_n_spans`` (removed runs) and ``_kept`` (binary: the bytes that stay)."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    key = {"t": F.xxhash64(text), "size": F.octet_length(text), "text": text}
    spans = repeated_bytes(docs.select(*(c.alias(k) for k, c in key.items())), length)
    inner = boxed(docs, **key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for body, runs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                kept, at, n = [], 0, 0
                for r in sorted(runs or (), key=lambda r: r["start"]):
                    x, y = r["start"], r["start"] + r["windows"] + length - 1
                    if x > at or (x == at == 0 and n == 0):
                        kept.append(body[at:x])
                        n += 1
                    at = max(at, y)
                kept.append(body[at:])
                left = b"".join(kept)
                out.append((len(body), len(body) - len(left), n, left))
            new = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *new], ["_row", "_n_bytes", "_n_removed", "_n_spans", "_kept"])

    added = [T.StructField(n, T.LongType()) for n in ("_n_bytes", "_n_removed", "_n_spans")]
    kinds = T.StructType([inner.schema["_row"], *added, T.StructField("_kept", T.BinaryType())])
    out = with_spans(inner, spans).select("_row", "text", "spans").mapInArrow(run, kinds)
    return unboxed(out, docs.columns, **{c: F.col(c) for c in ("_n_bytes", "_n_removed", "_n_spans", "_kept")})


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_bytes(docs)
    return out.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT r, unnest(range(1, octet_length(b) - 398)) AS k FROM d WHERE octet_length(b) >= 400),
w AS (SELECT r, k, md5(b[k:k + 399]) AS h FROM p JOIN d USING (r)),
x AS (SELECT r, k, lag(k) OVER (PARTITION BY r ORDER BY k) AS last FROM (SELECT r, k, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
s AS (SELECT r, k, sum(CASE WHEN k <= last + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY k) AS span FROM x),
g AS (SELECT r, span, min(k) AS a, max(k) + 399 AS z FROM s GROUP BY r, span),
t AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS y FROM g),
u AS (SELECT r, count(*) AS spans, sum(z - a + 1) AS gone, max(z) AS z, string_agg(CASE WHEN a > y + 1 THEN hex(b[y + 1:a - 1]) ELSE '' END, '' ORDER BY a) AS kept FROM t JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN spans IS NULL THEN b ELSE unhex(kept || CASE WHEN z < octet_length(b) THEN hex(b[z + 1:octet_length(b)]) ELSE '' END) END) AS kept_sha256
FROM d LEFT JOIN u USING (r)
"""
