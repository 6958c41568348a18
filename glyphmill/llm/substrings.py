"""Substring dedup by de Bruijn compaction.

The graph's edges are k-mers of tokens, k being the window (35 words); its nodes are what consecutive windows
share. A block of windows around an anchor is a nonbranching path, compacted where it is read; equal paths merge
by a join on their content's hash, with the number of places each has. Where an anchor has paths that differ, the
graph branches: one place of each path is read again, the path falls apart into its k-mer edges, and edges found in more
than one path, or in a path of more than one place, are repeated. Repeated edges next to each other compact into
spans again, joined to every place of their path, and the spans' words go.

Places name a text by its hash and size, so copies of a text are judged once. Source coordinates give the exact
words: contents are compared by 64-bit hashes within one anchor (another 64 bits), edges by 128 bits.

Defined results. Null, empty and short texts lose nothing. Repeated rows, null ids and ties don't matter:
every row is judged by its text, and its copies are places of their own. Empty tables give empty results. Columns
added begin with an underscore, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import blocks, contested, texts_of, with_spans
from .common import boxed, keep, unboxed, workspace

#: Words in a k-mer of the anchors.
GRAM = 11
FOUND = "anchor long, content long, t long, size int, start int, windows int"


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _joined(words: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The words joined by spaces, and where each begins (one more: the end and a space)."""
    begins = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=begins[1:])
    return b" ".join(words), begins


def word_blocks(docs: DataFrame, window: int) -> DataFrame:
    """FOUND rows of the documents (t, size, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: list[list] = [[], [], [], [], [], []]
            for t, size, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = text.split() if text else ()
                if len(words) < window:
                    continue
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
                first, count, anchor = blocks(hashes, min(GRAM, window), window)
                joined, begins = _joined(words)
                ends = begins[first + count + window - 1] - 1
                made = [_signed(xxhash.xxh3_64_intdigest(joined[x:y])) for x, y in zip(begins[first].tolist(), ends.tolist(), strict=True)]
                n = len(first)
                for p, v in zip(parts, (anchor, np.array(made, np.int64), np.full(n, t), np.full(n, size), first, count), strict=True):
                    p.append(v)
            cols = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.int32(), safe=False) for k, c in enumerate(cols)], FOUND.replace(" long", "").replace(" int", "").split(", "))

    return docs.mapInArrow(run, FOUND)


def word_edges(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, content, n, k, a, b): the k-mer edges of the paths (anchor, content, n, start, windows) in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, paths in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = text.split()
                joined, begins = _joined(words)
                out: list[tuple] = []
                for p in paths:
                    for k in range(p["windows"]):
                        at = p["start"] + k
                        h = xxhash.xxh3_128_intdigest(joined[begins[at] : begins[at + window] - 1])
                        out.append((p["anchor"], p["content"], p["n"], k, _signed(h >> 64), _signed(h & 0xFFFFFFFFFFFFFFFF)))
                cols = list(zip(*out, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 3 else pa.int64()) for k, c in enumerate(cols)], ["anchor", "content", "n", "k", "a", "b"])

    return texts.select("text", "paths").mapInArrow(run, "anchor long, content long, n long, k int, a long, b long")


def repeated_words(docs: DataFrame, window: int = 35) -> DataFrame:
    """(t, size, start, windows): runs of windows that occur elsewhere too, by text; docs has t, size and text."""
    spark = docs.sparkSession
    with workspace(spark, "debruijn") as ws:
        places, repeated, disputed = contested(word_blocks(docs, window), ws)
        disputed = ws.write(disputed, "disputed")
        whole = places.join(repeated, ["anchor", "content"]).select("t", "size", "start", "windows")
        texts = texts_of(docs, disputed, ws)
        paths = disputed.groupBy("t", "size").agg(F.collect_list(F.struct("anchor", "content", "n", "start", "windows")).alias("paths"))
        edges = ws.write(word_edges(texts.join(paths, ["t", "size"]), window), "edges")
        twice = edges.groupBy("a", "b").agg(F.sum("n").alias("total")).where("total > 1").select("a", "b")
        # edges of paths with one place only: the others are repeated as a whole
        single = edges.where("n = 1").join(twice, ["a", "b"], "left_semi").select("anchor", "content", "k")
        # compaction of neighbouring edges: k less its rank is the same along a run
        runs = single.groupBy("anchor", "content").agg(F.sort_array(F.collect_set("k")).alias("ks"))
        runs = runs.select("anchor", "content", F.posexplode("ks").alias("i", "k")).groupBy("anchor", "content", F.expr("k - i").alias("run")).agg(F.min("k").alias("k"), F.count("*").cast("int").alias("windows"))
        part = places.drop("windows").join(runs, ["anchor", "content"]).select("t", "size", (F.col("start") + F.col("k")).alias("start"), "windows")
        return keep(whole.unionByName(part))


def drop_repeated_spans(docs: DataFrame, text_col: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_removed`` and ``_kept``, its kept words joined by single spaces.

    A word goes if it lies in a window of ``window`` words whose words also start anywhere else.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    bare = docs.select(F.xxhash64(text).alias("t"), F.octet_length(text).alias("size"), text.alias("text"))
    spans = repeated_words(bare, window)
    names = docs.columns
    inner = boxed(docs, t=F.xxhash64(text), size=F.octet_length(text), bytes=text)
    joined = with_spans(inner, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for body, runs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = body.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for r in runs or ():
                    gone[r["start"]] += 1
                    gone[r["start"] + r["windows"] + window - 1] -= 1
                stays = np.cumsum(gone)[: len(words)] == 0
                kept = words if not runs else [words[i] for i in np.flatnonzero(stays)]
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            new = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *new], ["_row", "_n_words", "_n_removed", "_kept"])

    kinds = T.StructType([inner.schema["_row"], T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType()), T.StructField("_kept", T.BinaryType())])
    out = joined.select("_row", "bytes", "spans").mapInArrow(run, kinds)
    return unboxed(out, names, _n_words=F.col("_n_words"), _n_removed=F.col("_n_removed"), _kept=F.decode("_kept", "UTF-8"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_spans(docs)
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2(F.encode("_kept", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35),
h AS (SELECT r, k, md5(array_to_string(w[k:k + 34], ' ')) AS h FROM p JOIN d USING (r)),
x AS (SELECT DISTINCT r, unnest(range(k, k + 35)) AS i FROM (SELECT r, k, count(*) OVER (PARTITION BY h) AS n FROM h) WHERE n > 1),
u AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT u.r, count(*) FILTER (x.i IS NOT NULL) AS gone, string_agg(word, ' ' ORDER BY u.i) FILTER (x.i IS NULL) AS kept FROM u LEFT JOIN x ON x.r = u.r AND x.i = u.i GROUP BY u.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""
