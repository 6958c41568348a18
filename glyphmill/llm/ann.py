"""Approximate nearest neighbours by additive quantisation.

``books`` codebooks of full-dimensional codewords are trained one after the other on what the ones before leave
of a bounded sample of unit vectors. Beam search picks each vector's codewords, one of each book, whose sum is
nearest; the codes and the sum's norm are the index. A query's inner products with all codewords are a lookup
table, from which the codes give approximate cosines; the best of each block of the index are ranked again by
exact cosines of the original vectors in double precision.

Every row is indexed. The sample (the rows of the smallest hashes) bounds only training. Queries go through the
index in blocks of bounded size, each task keeps its best few, and those meet by query.

Defined results. Vectors that are null, empty, zero or hold null or non-finite components take no part, as query or
as candidate; nor do those of another than the most frequent dimension (the smaller at ties), or without an id.
Rows that repeat a vec_id are candidates of their own but never neighbours of their own id; a repeated query answers
once, by the least of its vectors. Equal scores go to the smaller vec_id. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, partitions_for, workspace

BOOKS, WORDS, BEAM = 8, 256, 4
#: Numbers in the training sample, and in one block of queries: 8 MB each.
SAMPLE_VALUES, QUERY_VALUES = 1 << 20, 1 << 20
#: Rows of the index that are scored together, the candidates of them that are ranked exactly, and queries scored at once.
ROWS, RERANK, AT_ONCE = 4096, 64, 256


def as_matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = np.concatenate([np.argmin((c * c).sum(1) - 2 * (part @ c.T), axis=1) for part in np.array_split(x, max(1, len(x) // 4096))])
        size = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            c[:, d] = np.where(size > 0, np.bincount(near, x[:, d], k) / np.maximum(size, 1), c[:, d])
        if (lost := np.flatnonzero(size == 0)).size:
            c[lost] = x[rng.choice(len(x), len(lost))]
    return c


def train(x: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 7) -> np.ndarray:
    """Codebooks (books, words, dimensions) for unit vectors."""
    rng, rest, out = np.random.default_rng(seed), x.copy(), []
    for _ in range(books):
        c = _kmeans(rest, min(words, max(1, len(x))), rng)
        out.append(c)
        near = np.concatenate([np.argmin((c * c).sum(1) - 2 * (part @ c.T), axis=1) for part in np.array_split(rest, max(1, len(rest) // 4096))])
        rest = rest - c[near]
    return np.stack(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, books) and norms of the sums, by beam search over the books."""
    n, (m, k, d) = len(x), books.shape
    rest, codes, cost = x[:, None, :], np.zeros((n, 1, 0), np.uint8), np.zeros((n, 1))
    for c in books:
        gain = (c * c).sum(1) - 2 * (rest @ c.T)  # (n, beam, words): how the squared error changes
        total = (cost[:, :, None] + gain).reshape(n, -1)
        take = min(beam, total.shape[1])
        best = np.argpartition(total, take - 1, axis=1)[:, :take]
        row, came, word = np.arange(n)[:, None], best // k, best % k
        cost = total[row, best]
        rest = rest[row, came] - c[word]
        codes = np.concatenate([codes[row, came], word[:, :, None].astype(np.uint8)], axis=2)
    best = np.argmin(cost, axis=1)
    codes = codes[np.arange(n), best]
    made = x - rest[np.arange(n), best]
    return codes, np.sqrt((made * made).sum(1))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that can take part, of any dimension."""
    v = F.col(vector_col)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.where(F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0)).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))


def build(rows: DataFrame, ws, books: int = BOOKS) -> tuple[DataFrame, np.ndarray] | None:
    """The index (id, v, codes, norm) of (id, v), and its codebooks; None without rows."""
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return None
    dim, total = sizes["d"], sizes["count"]
    rows = rows.where(F.size("v") == dim)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(max(WORDS, SAMPLE_VALUES // dim)).toPandas()
    trained = train(unit(np.stack(sample["v"].to_list())), books)
    sent = rows.sparkSession.sparkContext.broadcast(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                codes, norm = encode(unit(as_matrix(part.column(1))), sent.value)
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, packed, pa.array(norm)], ["id", "v", "codes", "norm"])

    dealt = rows.repartition(partitions_for(total, 2 * ROWS))
    return ws.write(dealt.mapInArrow(run, "id long, v array<double>, codes binary, norm double"), "index"), trained


def search(index: DataFrame, books: np.ndarray, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query, id, score): each task's best k of its part of the index, for a block of queries (id, v)."""
    found = queries.groupBy("id").agg(F.min("v").alias("v")).toPandas()
    names, x = found["id"].to_numpy(np.int64), np.stack(found["v"].to_list())
    sent = index.sparkSession.sparkContext.broadcast((names, unit(x), books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q, books = sent.value
        top_score, top_id = np.full((len(names), k), -np.inf), np.full((len(names), k), np.iinfo(np.int64).max)
        flat = books.reshape(-1, books.shape[2])
        begin = (np.arange(books.shape[0]) * books.shape[1])[None, :]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids = b.column(0).to_numpy()
                order = np.argsort(ids, kind="stable")
                ids, v = ids[order], unit(as_matrix(b.column(1))[order])
                codes = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)[order] + begin
                norm = np.maximum(b.column(3).to_numpy()[order], 1e-12)
                for lo in range(0, len(names), AT_ONCE):
                    part = slice(lo, lo + AT_ONCE)
                    table = (flat @ q[part].T).astype(np.float32)  # codewords by queries
                    near = table[codes[:, 0]]
                    for m in range(1, codes.shape[1]):
                        near = near + table[codes[:, m]]
                    near = (near / norm[:, None]).T.astype(np.float64)
                    near[ids[None, :] == names[part, None]] = -np.inf
                    near -= np.arange(len(ids)) * 1e-13  # equal rows: smaller ids are preferred
                    take = min(RERANK, len(ids))
                    cand = np.argpartition(-near, take - 1, axis=1)[:, :take]
                    exact = (q[part][:, None, :] * v[cand]).sum(axis=2)
                    exact[ids[cand] == names[part, None]] = -np.inf
                    score = np.concatenate([top_score[part], exact], axis=1)
                    both = np.concatenate([top_id[part], ids[cand]], axis=1)
                    keep_cols = np.lexsort((both, -score), axis=1)[:, :k]
                    row = np.arange(len(score))[:, None]
                    top_score[part], top_id[part] = score[row, keep_cols], both[row, keep_cols]
        real = np.isfinite(top_score)
        query = np.broadcast_to(names[:, None], real.shape)[real]
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(top_id[real]), pa.array(top_score[real])], ["query", "id", "score"])

    return index.mapInArrow(run, "query long, id long, score double")


def neighbours(rows: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row of ``queries``."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    with workspace(spark, "ann") as ws:
        built = build(usable(rows, id_col, vector_col), ws)
        if built is None:
            return empty
        index, books = built
        dim = books.shape[2]
        asked = ws.write(usable(queries, id_col, vector_col).where(F.size("v") == dim), "queries")
        passes = partitions_for(asked.count(), max(1, QUERY_VALUES // dim))
        best = None
        for i in range(passes):
            part = asked.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == i)
            if part.isEmpty():
                continue
            got = search(index, books, part, k)
            order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
            got = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            got = keep(got.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
            best = got if best is None else best.unionByName(got)
        return empty if best is None else best


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding")


#: Approximate, so no SQL; the tests measure the recall against brute force.
SQL = None
