"""LM scoring by a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

The model's symbols are the most frequent words, the end of a text, and classes of all other words by their last three
bytes. A symbol's score after another is bilinear: the target's vector times a matrix times the context's vector, plus
the target's bias. Products of all contexts with all targets, in batches, normalise the scores exactly. A word of a
class has its share of the class: (c + 1) / (the class's sum of c + 1, plus 1 for words never seen), so the
probabilities of all words after any word sum to one.

All of it grows with the corpus. The shortlist has ``GROWTH`` times the root of the training tokens, the classes an eighth
of that; ``MOST`` bounds it (the parameters are sent to all tasks), which some 17 billion tokens reach. Every training
pair is trained on, in ``ROUNDS`` rounds that each take a part of the chunks: tasks train on their chunks from the same
parameters, and each row of these becomes the mean of what the tasks made of it, weighted by how often they touched it.
Of few tokens there are several passes, until ``LEAST`` pairs have been seen.

Texts are tokenised once, in chunks of some ``CHUNK`` bytes that hold their distinct words and the tokens as numbers.
Words are counted by a pre-aggregated shuffle, and the counts of words that several chunks have come back to their
chunks; the shortlist's counts, the hot keys, are broadcast instead. So no task and no driver holds the vocabulary.

Defined results. Null and empty texts are one end token. Repeated rows count as often as they stand there. Without
training texts the base has N = V = 0 and the model is even over its symbols. Rows with null ids are scored as
any other. A text of any length is in one chunk. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, give_back, keep, large_arrays_apart, workspace

#: The model's width, noise words of a batch, pairs of a batch, the learning rate, and where the squares' sums begin.
SIZE, NOISE, BATCH, RATE, BEGIN, SEED = 32, 128, 2048, 0.15, 100.0, 11
#: Shortlist for the root of the tokens, its least and most words; rounds, and pairs that small corpora see at least.
GROWTH, FEWEST, MOST, ROUNDS, LEAST = 2.0, 256, 1 << 18, 3, 6_000_000
#: Bytes of text in a chunk; rows of parameters that are averaged together, and that a task sends at once.
CHUNK, ROWS, SENT = 16 << 20, 512, 1 << 13


class Parameters(NamedTuple):
    """Context vectors, target vectors with the bias and, for each, the sum of squares of their gradients; the matrix and its sum."""

    r: np.ndarray
    q: np.ndarray
    m: np.ndarray
    squares_r: np.ndarray
    squares_q: np.ndarray
    squares_m: np.ndarray

    def copy(self) -> Parameters:
        return Parameters(*(x.copy() for x in self))


class Model(NamedTuple):
    """What is learned, as plain data: words and their counts, sums of classes, tokens, types, ends, vectors times matrix, targets, normalisers."""

    words: list[bytes]
    counts: np.ndarray
    class_sums: np.ndarray
    tokens: int
    types: int
    ends: int
    contexts: np.ndarray
    targets: np.ndarray
    normalisers: np.ndarray


class Chunk:
    """Texts of a chunk in the making: of each batch the ids, the flags, the sizes and the words, numbered by batch."""

    def __init__(self):
        self.ids, self.held, self.sizes, self.words, self.bytes = [], [], [], [], 0

    def add(self, ids: pa.Array, held: np.ndarray, texts: pa.Array) -> None:
        """Words are lower-cased; the end isn't among them."""
        self.bytes += texts.nbytes
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat = split.flatten()
        full = pc.not_equal(pc.binary_length(flat), 0)
        before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        self.ids.append(ids)
        self.held.append(held)
        self.sizes.append(np.diff(before[at]).astype(np.int32))
        self.words.append(flat.filter(full).dictionary_encode())

    def row(self) -> pa.RecordBatch:
        words = pa.chunked_array(self.words).unify_dictionaries()
        self.words = []
        dictionary, n = words.chunk(0).dictionary, len(words.chunk(0).dictionary)
        codes = np.concatenate([w.indices.to_numpy() for w in words.chunks])
        del words
        held, sizes = np.concatenate(self.held), np.concatenate(self.sizes)
        often = np.argsort(-np.bincount(codes, minlength=n), kind="stable")  # small numbers for frequent words
        number = np.empty(n, np.int32)
        number[often] = np.arange(n)
        codes = number[codes]
        counts = np.bincount(codes[np.repeat(~held, sizes)], minlength=n)
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        body = packed(codes)
        cols = [
            pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([zlib.crc32(codes.tobytes())], pa.int64()), one(pa.concat_arrays(self.ids)), one(pa.array(held)),
            one(pa.array(sizes)), one(dictionary.take(pa.array(often)).cast(pa.binary())), one(pa.array(counts.astype(np.int32))), pa.array([body], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(cols, ["chunk", "seed", "ids", "held", "sizes", "words", "counts", "codes"])


def packed(codes: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, the high ones nearly empty, compressed here: the JVM copies what it gets several times."""
    return pa.compress(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), "lz4", asbytes=True)


def unpacked(body: pa.BinaryScalar, n: int) -> np.ndarray:
    """The n packed numbers."""
    planes = pa.decompress(body.as_buffer(), 4 * n, "lz4")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<i4")[:, 0]


def chunked(rows: DataFrame) -> DataFrame:
    """The texts (id, held, text) in chunks; a chunk's number is random, and fixed once the table is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large_arrays_apart()
        now = Chunk()
        for b in batches:
            if len(b):
                now.add(b.column(0), b.column(1).to_numpy(zero_copy_only=False), b.column(2))
            if now.bytes >= CHUNK:
                row, now = now.row(), Chunk()  # what the row was made of goes before it is sent
                give_back()
                yield row
                del row
        if now.ids:
            row, now = now.row(), None
            give_back()
            yield row
            del row
        give_back()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "held", "text").mapInArrow(run, f"chunk long, seed long, ids array<{kind}>, held array<boolean>, sizes array<int>, words array<binary>, counts array<int>, codes binary")


def class_of(words: pa.Array, classes: int) -> np.ndarray:
    """Classes of words by their last three bytes."""
    ends = pc.binary_slice(words, -3).dictionary_encode()
    each = np.array([zlib.crc32(x) % classes for x in ends.dictionary.to_pylist()], np.int64)
    return each[ends.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)


def symbols_of(words: pa.Array, short: pa.Array, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of words, and which of them are in the shortlist."""
    at = pc.index_in(words, value_set=short)
    known = at.is_valid().to_numpy(zero_copy_only=False)
    return np.where(known, at.fill_null(0).to_numpy(), len(short) + 1 + class_of(words, classes)).astype(np.int32), known


def sequence(tokens: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts with an end after each, and where each text begins."""
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1].astype(np.int64)
    out = np.full(len(tokens) + len(sizes), end, tokens.dtype)
    is_word = np.ones(len(out), bool)
    is_word[begins + sizes] = False
    out[is_word] = tokens
    return out, begins


def _summed(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of at, and the sums of x's rows for each."""
    order = np.argsort(at)
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first], np.add.reduceat(x[order], first, axis=0)


def noise_contrastive(p: Parameters, context: np.ndarray, target: np.ndarray, unigram: np.ndarray, seed: int, touched: tuple[np.ndarray, np.ndarray] | None = None) -> None:
    """One pass over pairs in random order; p changes in place, and touched counts the steps that change each row."""
    rng = np.random.default_rng([SEED, seed])
    order = rng.permutation(len(context))
    below, expected = np.cumsum(unigram), np.log(NOISE * unigram).astype(np.float32)
    r, q, m, squares_r, squares_q, squares_m = p

    def step(x: np.ndarray, squares: np.ndarray, at: np.ndarray, g: np.ndarray) -> None:
        squares[at] += (g * g).mean(axis=1)
        x[at] += np.float32(RATE) * g / np.sqrt(squares[at])[:, None]

    for begin in range(0, len(order), BATCH):
        pick = order[begin : begin + BATCH]
        h, w = context[pick], target[pick]
        noise = np.minimum(np.searchsorted(below, rng.random(NOISE) * below[-1]), len(below) - 1)
        rh, qw, qn = r[h], q[w], q[noise]
        made = rh @ m
        up = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", made, qw[:, :-1]) + qw[:, -1] - expected[w], -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(made @ qn[:, :-1].T + (qn[:, -1] - expected[noise]), -30, 30)))
        grad_made = up[:, None] * qw[:, :-1] + down @ qn[:, :-1]
        grad_q = np.empty((len(w) + NOISE, SIZE + 1), np.float32)
        np.multiply(up[:, None], made, out=grad_q[: len(w), :-1])
        grad_q[: len(w), -1] = up
        grad_q[len(w) :, :-1], grad_q[len(w) :, -1] = down.T @ made, down.sum(axis=0)
        rows, g = _summed(np.concatenate((w, noise)), grad_q)
        step(q, squares_q, rows, g)
        if touched:
            touched[1][rows] += 1
        rows, g = _summed(h, grad_made @ m.T)
        step(r, squares_r, rows, g)
        if touched:
            touched[0][rows] += 1
        g = rh.T @ grad_made / np.float32(len(w))
        squares_m += (g * g).mean()
        m += np.float32(0.1 * RATE) * g / np.sqrt(squares_m)


def initial(unigram: np.ndarray) -> Parameters:
    """Small random vectors, the unity matrix, and the logarithms of the symbols' shares as biases."""
    rng, n = np.random.default_rng(SEED), len(unigram)
    r, q = (rng.normal(0, 0.1, (n, SIZE)).astype(np.float32) for _ in range(2))
    bias = np.log(unigram).astype(np.float32)
    return Parameters(r, np.hstack((q, bias[:, None])), np.eye(SIZE, dtype=np.float32), *(np.full(k, BEGIN, np.float32) for k in (n, n, 1)))


def averaged(p: Parameters, trained: DataFrame) -> Parameters:
    """Parameters from rows (kind, row, n, x) of tasks: means weighted by n."""

    def mean(t: pa.Table) -> pa.Table:
        large_arrays_apart()
        n, row = t.column("n").to_numpy(), t.column("row").to_numpy()
        x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.float32).reshape(len(t), -1)
        rows, total = _summed(row, np.hstack((x.astype(np.float64) * n[:, None], n[:, None])))
        x = (total[:, :-1] / total[:, -1:]).astype(np.float32)
        return pa.table([pa.array(np.full(len(rows), t.column("kind")[0].as_py()), pa.int32()), pa.array(rows, pa.int32()), pa.array([v.tobytes() for v in x], pa.binary())], ["kind", "row", "x"])

    got = trained.withColumn("block", F.floor(F.col("row") / ROWS)).groupBy("kind", "block").applyInArrow(mean, "kind int, row int, x binary").toArrow()
    p, kind, row, x = p.copy(), got.column("kind").to_numpy(), got.column("row").to_numpy(), got.column("x").to_pylist()
    for k, (values, squares) in enumerate(((p.r, p.squares_r), (p.q, p.squares_q), (p.m, None))):
        at = np.flatnonzero(kind == k)
        if len(at):
            new = np.frombuffer(b"".join(x[i] for i in at), np.float32).reshape(len(at), -1)
            values[row[at]] = new[:, :-1]
            if squares is not None:
                squares[row[at]] = new[:, -1]
            else:
                p.squares_m[0] = new[0, -1]
    return p


def trained(chunks: DataFrame, p: Parameters, short: list[bytes], classes: int, unigram: np.ndarray, passes: int) -> DataFrame:
    """(kind, row, n, x): the rows of parameters that each task's chunks changed, and in how many steps."""
    sent = chunks.sparkSession.sparkContext.broadcast((tuple(p), short, unigram))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large_arrays_apart()
        begun, short, unigram = sent.value
        now, words = Parameters(*(x.copy() for x in begun)), pa.array(short, pa.binary())
        touched, steps = tuple(np.zeros(len(unigram), np.int64) for _ in range(2)), 0
        for b in batches:
            for k in range(len(b)):
                seed, held, sizes, own, codes = (b.column(i)[k] for i in range(5))
                sizes, held = sizes.values.to_numpy(), held.values.to_numpy(zero_copy_only=False)
                symbols, _ = symbols_of(own.values, words, classes)
                tokens, begins = sequence(symbols[unpacked(codes, sizes.sum())], sizes, len(short))
                train = np.repeat(~held, sizes + 1)
                context, target = np.concatenate((np.array([len(short)], np.int32), tokens[:-1]))[train], tokens[train]
                for turn in range(passes):
                    noise_contrastive(now, context, target, unigram, seed.as_py() + turn, touched)
                    steps += -(-len(context) // BATCH)
                del own, codes, symbols, tokens, begins, train, context, target
            give_back()
        if not steps:
            return
        for kind, values, squares, n in ((0, now.r, now.squares_r, touched[0]), (1, now.q, now.squares_q, touched[1]), (2, now.m, np.repeat(now.squares_m, SIZE), np.full(SIZE, steps))):
            all_at = np.flatnonzero(n)
            for first in range(0, len(all_at), SENT):
                at = all_at[first : first + SENT]
                x = np.hstack((values[at], squares[at][:, None])).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at].astype(float)), pa.array([v.tobytes() for v in x], pa.binary())], ["kind", "row", "n", "x"])

    return chunks.select("seed", "held", "sizes", "words", "codes").mapInArrow(run, "kind int, row int, n double, x binary")


def normalisers(spark: SparkSession, p: Parameters) -> np.ndarray:
    """The natural logarithm of each context's sum over all targets, by products of blocks of contexts with all targets."""
    sent, n = spark.sparkContext.broadcast((p.r @ p.m, p.q)), len(p.r)
    rows = max(1, (4 << 20) // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large_arrays_apart()
        contexts, q = sent.value
        for b in batches:
            for k in b.column(0).to_pylist():
                s = contexts[k * rows : (k + 1) * rows] @ q[:, :-1].T + q[:, -1]
                top = s.max(axis=1, keepdims=True)
                z = np.log(np.exp(s - top).sum(axis=1, dtype=np.float64)) + top[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([z.tolist()], pa.list_(pa.float64()))], ["k", "z"])

    blocks = -(-n // rows)
    got = spark.range(0, blocks, 1, min(blocks, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, "k long, z array<double>").collect()
    return np.concatenate([np.array(r.z) for r in sorted(got)])


def word_counts(chunks: DataFrame, ws: Workspace) -> DataFrame:
    """(word, c, chunks): the words' counts in the training texts, and how many chunks have each."""
    each = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    return ws.write(each.groupBy("word").agg(F.sum("c").alias("c"), F.count("*").alias("chunks")), "totals")


def most_frequent(seen: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent words (word, c), by word at ties; a histogram of counts finds from where on they are sorted."""
    rank = F.floor(F.log2("c") * 16)
    least, held = 0, 0
    for k, n in sorted(((r.k, r.n) for r in seen.groupBy(rank.alias("k")).agg(F.count("*").alias("n")).collect()), reverse=True):
        least, held = k, held + n
        if held >= size:
            break
    return seen.where(rank >= least).orderBy(F.desc("c"), "word").limit(size).select("word", "c")


def learn(chunks: DataFrame, totals: DataFrame) -> Model:
    """The model of the training texts. The driver gets the shortlist, the classes' sums and the parameters."""
    spark = chunks.sparkSession
    ends = chunks.select(F.explode("held").alias("held")).where(~F.col("held")).count()
    seen = totals.where("c > 0")
    words, distinct = seen.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    size = min(MOST, max(FEWEST, int(GROWTH * math.sqrt(words + ends))))
    top = most_frequent(seen, size).toArrow()
    short, counts = top.column("word").to_pylist(), top.column("c").to_numpy().astype(np.int64)
    classes = size // 8
    sums, tokens = np.zeros(classes), np.zeros(classes)
    kind = F.crc32(F.substring("word", -3, 3)) % classes
    for r in seen.groupBy(kind.alias("k")).agg(F.sum(F.col("c") + 1).alias("n"), F.sum("c").alias("c")).collect():
        sums[r.k], tokens[r.k] = r.n, r.c
    of = class_of(pa.array(short, pa.binary()), classes)
    np.subtract.at(sums, of, counts + 1)
    np.subtract.at(tokens, of, counts)
    unigram = np.concatenate((counts, [ends], tokens)) + 0.5
    unigram /= unigram.sum()
    p = initial(unigram)
    if words + ends == 0:
        p = Parameters(p.r * 0, p.q * 0, *p[2:])
    else:
        passes = max(1, math.ceil(LEAST / (words + ends)))
        for k in range(ROUNDS):
            part = chunks.where(F.col("seed") % ROUNDS == k)
            p = averaged(p, trained(part, p, short, classes, unigram, passes))
    return Model(short, counts, sums, words + ends, distinct + (ends > 0), ends, p.r @ p.m, p.q, normalisers(spark, p))


def score(chunks: DataFrame, totals: DataFrame, model: Model) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all texts of the chunks."""
    spark = chunks.sparkSession
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "x")).select("chunk", "k", F.col("x.words").alias("word"), F.col("x.counts").alias("own"))
    short = F.broadcast(spark.createDataFrame([(w,) for w in model.words], "word binary"))  # at most MOST words
    several = totals.where("chunks > 1").select("word", "c")
    counts = each.join(short, "word", "left_anti").join(several, "word").where("c <> own").select(F.col("chunk").alias("of"), "k", "c")
    sent = spark.sparkContext.broadcast(tuple(model))
    kind = chunks.schema["ids"].dataType.elementType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        large_arrays_apart()
        words, short_counts, sums, tokens, types, ends, contexts, targets, z = sent.value
        row = {c: left.column(c)[0] for c in left.column_names}
        own, sizes = row["words"].values, row["sizes"].values.to_numpy()
        symbols, known = symbols_of(own, pa.array(words, pa.binary()), len(sums))
        c = row["counts"].values.to_numpy().astype(np.int64)
        c[right.column("k").to_numpy()] = right.column("c").to_numpy()
        c[known] = short_counts[symbols[known]]
        within = np.where(known, 0, np.log10((c + 1) / (1 + sums[np.maximum(symbols - len(words) - 1, 0)])))
        # the end is one word more
        codes, begins = sequence(unpacked(row["codes"], sizes.sum()), sizes, len(own))
        c, symbols, within = np.append(c, ends), np.append(symbols, np.int32(len(words))), np.append(within, 0)
        base = np.log10(c + 1) - np.log10(tokens + types + 1)
        s = symbols[codes]
        before = np.concatenate((np.array([len(words)], np.int32), s[:-1]))
        logs = within[codes]
        for at in range(0, len(s), 1 << 16):
            h, w = before[at : at + (1 << 16)], s[at : at + (1 << 16)]
            logs[at : at + (1 << 16)] += (np.einsum("ij,ij->i", contexts[h], targets[w, :-1]) + targets[w, -1] - z[h]) / math.log(10)
        del s, before
        sums_of = lambda x: np.add.reduceat(x, begins)
        n, score = len(sizes), sums_of(logs)
        del logs
        known_of, base_of = sums_of((c > 0)[codes].astype(np.int64)), sums_of(base[codes])
        del codes
        cols = [row["ids"].values, row["held"].values, pa.array((sizes + 1).astype(np.int64)), pa.array(known_of), pa.array(np.full(n, tokens)), pa.array(base_of), pa.array(score)]
        give_back()
        return pa.table(cols, ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    both = chunks.drop("seed").groupBy("chunk").cogroup(counts.groupBy("of"))
    return both.applyInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame, id_col: str, text_col: str, held: Column) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all texts; those that aren't held out are learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with workspace(docs.sparkSession, "lm") as ws:
        chunks = ws.write(chunked(rows), "chunks")
        totals = word_counts(chunks, ws)
        return keep(score(chunks, totals, learn(chunks, totals)))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return score_documents(docs, "doc_id", "text", held).withColumnRenamed("id", "doc_id")


#: A neural model is beyond SQL; the tests compare the base with SQL and the model with its definition.
SQL = None
