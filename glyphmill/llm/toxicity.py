"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length.

Folding lower-cases, maps homoglyphs to Latin letters and, in words with a letter, digits and signs that stand for
letters. 1, ! and | stand for i or l: such a word has two readings, and the one that weighs more counts. The lexicon has
whole words and beginnings of words, as many as the learned rows give. Its weights, the exception phrases (two words of
which one would match, which are as usual in clean texts) and a logistic curve over length-normalised sums are
learned from labelled rows, at most ``SAMPLE`` of them, those of the smallest hashes.

Defined results. Null and empty texts score as texts without a match. Without labelled rows of both kinds
every score is 0. Labels of null are left out; of repeated labels of a document the largest counts, and of learned
documents that share an id the least text. Rows pass through one by one, repeated ones and null ids too; columns added
begin with an underscore.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, small_batches

#: The most labelled rows that are learned from, and the threshold.
SAMPLE, THRESHOLD = 20_000, 0.3
#: Letters of other scripts that look like Latin ones, and what they look like.
LOOKALIKES = str.maketrans("аеорсхуіјѕԁһӏνοαικρτυχε", "aeopcxyijsdhlvoaikptuxe")
#: What stands for letters; of 1, ! and | the other reading.
STAND_INS, OTHER = str.maketrans("0134578@$!|", "oieastbasii"), str.maketrans("1!|", "lll")
#: Words with signs inside them; @ and $ at either end as well.
TOKEN = re.compile(r"[@$]*[^\W_]+(?:[@$!|]+[^\W_]+)*[@$]*")
FOLDS, AMBIGUOUS, LETTER = re.compile(r"[\d@$!|]"), re.compile(r"[1!|]"), re.compile(r"[^\W\d_]")


def fold(text: str | None) -> tuple[list[str], list[tuple[int, str]]]:
    """The folded words of a text, and the other readings of some: (index, word)."""
    t = (text or "").lower()
    if not t.isascii():
        t = t.translate(LOOKALIKES)
    words, others = TOKEN.findall(t), []
    if FOLDS.search(t):
        for k, w in enumerate(words):
            if FOLDS.search(w):
                if not LETTER.search(w):
                    words[k] = w.strip("@$")
                    continue
                words[k] = w.translate(STAND_INS)
                if AMBIGUOUS.search(w):
                    others.append((k, w.translate(OTHER).translate(STAND_INS)))
    return words, others


def patterns_of(words: Iterable[str], shortest: int = 4, longest: int = 9) -> set[str]:
    """Whole words between spaces, and beginnings of words after one."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(shortest, min(longest, len(w) - 1) + 1))
    return out


class Model(NamedTuple):
    """What is learned. It goes to the executors as plain data: ``tuple(model)``."""

    weights: dict[str, float] = {}
    exceptions: frozenset[tuple[str, str]] = frozenset()
    curve: list[float] | None = None


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton | None:
    if not weights:
        return None
    a = ahocorasick.Automaton()
    for p, w in weights.items():
        a.add_word(p, (len(p), w))
    a.make_automaton()
    return a


def features(folded: tuple[list[str], list[tuple[int, str]]], a: ahocorasick.Automaton | None, exceptions: frozenset) -> list[float]:
    """Sums of the matched words' weights: for the root of the length, for a word, and their largest; and the count."""
    words, others = folded
    found: dict[int, float] = {}
    if a is not None and words:
        for end, (size, w) in a.iter(f" {' '.join(words)} "):
            at = end - size + 1
            found[at] = max(found.get(at, 0), w)
    best: dict[int, float] = {}
    if found:
        at = 0
        for k, w in enumerate(words):
            if at in found:
                best[k] = found[at]
            at += len(w) + 1
    if a is not None:
        for k, word in others:
            for _, (_, w) in a.iter(f" {word} "):
                best[k] = max(best.get(k, 0), w)
    if best and exceptions:
        for k in list(best):
            if exceptions.intersection(zip(words[max(0, k - 1) : k + 1], words[max(1, k) : k + 2], strict=False)):
                del best[k]
    n, total = max(1, len(words)), sum(best.values())
    return [total / math.sqrt(n), min(2.0, total / n), max(best.values(), default=0.0), math.log1p(len(best))]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.05) -> list[float]:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    keep_small = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep_small + 1e-9 * np.eye(len(w)), x.T @ (y - p) - keep_small @ w)
        w += np.clip(step, -3, 3)
        if abs(step).max() < 1e-8:
            break
    return w.tolist()


def probability(curve: list[float] | None, x: list[float]) -> float:
    if curve is None:
        return 0.0
    z = curve[0] + sum(a * b for a, b in zip(curve[1:], x, strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def fit(train: DataFrame, min_docs: int = 3, least_odds: float = 1.5) -> Model:
    """Learns from (text, y: 0 or 1), at most ``SAMPLE`` rows. Executors count; the driver gets the patterns and phrases that are chosen."""

    def counts(what) -> DataFrame:
        """(p, n0, n1): in how many texts of each kind a pattern is."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n: tuple[Counter, Counter] = (Counter(), Counter())
            for b in batches:
                for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    n[y].update(what(fold(text)))
            for y in (0, 1):
                yield pa.RecordBatch.from_arrays([pa.array(n[y].keys(), pa.string()), pa.array(n[y].values() if not y else [0] * len(n[y]), pa.int64()), pa.array(n[y].values() if y else [0] * len(n[y]), pa.int64())], ["p", "n0", "n1"])

        return train.select("text", "y").mapInArrow(run, "p string, n0 long, n1 long").groupBy("p").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))

    sizes = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    share = {y: (F.col(f"n{y}") + 0.5) / (sizes[y] + 1) for y in (0, 1)}
    odd = counts(lambda f: patterns_of([*f[0], *(w for _, w in f[1])])).where(F.col("n1") >= min_docs).withColumn("odds", F.log(share[1] / share[0])).where(F.col("odds") >= least_odds)
    chosen = {r.p: (r.n1, r.odds) for r in odd.collect()}
    longer: dict[str, int] = {}  # a beginning that nearly always goes on alike gives way to what it goes on to
    for p, (n, _) in chosen.items():
        for k in range(5, len(p)):
            longer[p[:k]] = max(longer.get(p[:k], 0), n)
    weights = {p: odds for p, (n, odds) in sorted(chosen.items()) if longer.get(p, 0) < 0.9 * n}
    sc = train.sparkSession.sparkContext
    sent = sc.broadcast({p.strip() for p in weights if p.endswith(" ")})

    def pairs(f: tuple[list[str], list]) -> set[str]:
        return {f"{a} {b}" for a, b in zip(f[0], f[0][1:], strict=False) if a in sent.value or b in sent.value}

    usual = counts(pairs).where((F.col("n0") >= min_docs) & (share[1] < share[0]))
    model = Model(weights, frozenset(tuple(r.p.split(" ")) for r in usual.collect()))
    plain = sc.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, exceptions, _ = plain.value
        a = automaton(weights)
        for b in batches:
            x = [features(fold(t), a, exceptions) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "y"])

    rows = train.select("text", "y").mapInArrow(run, "x array<double>, y int").collect()  # at most SAMPLE rows
    rows.sort()
    return model._replace(curve=_logistic(np.array([r.x for r in rows]), np.array([r.y for r in rows], float)))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_toxicity``, from 0 to 1."""
    small_batches(docs.sparkSession)
    docs = docs.drop("_toxicity")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, exceptions, curve = sent.value
        a = automaton(weights)
        for b in batches:
            p = [probability(curve, features(fold(t), a, exceptions)) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], [*b.schema.names, "_toxicity"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_toxicity", T.DoubleType())]))


def bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """A model learned from the labelled documents that aren't held out."""
    small_batches(docs.sparkSession)
    y = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (bucket("doc_id", 4) != 2))
    y = y.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    known = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")  # at most SAMPLE rows are sent
    return fit(keep(known.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), F.col("_toxicity").alias("score"), F.when(F.col("_toxicity") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
