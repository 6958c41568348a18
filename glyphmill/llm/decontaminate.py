"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark window (``n`` consecutive words of an item; a shorter item is one window) is a set whose words
are ordered by rarity, the number of documents that hold them. To contain a window whole, a document must
hold its rarest word, the necessary prefix. So only that word is joined; the word's offset and the window's
length bound where the window can start, and the words there are compared one by one.

The join runs inside the scan of the documents: an index of at most ``block`` windows goes to every task, and
a larger benchmark is worked through in blocks, so what is sent stays bounded and documents are never moved.

Defined results. Null and empty texts have no words. Items without words have no windows. Repeated rows of an
item count once; a null item_id is named by an empty string. Repeated documents are judged row by row. Empty
tables give empty results or no hits. All columns of the documents pass through; the added ones begin with
an underscore.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, small_batches

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of letters and digits, A-Z in lower case; every byte beyond ASCII belongs to a word."""
    return WORD.findall(text.encode().lower()) if text else []


def windows(items: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(win, items): each distinct window, words joined by spaces, and the ids of its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, wins = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = words_of(text)
                found = {b" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else ()
                wins += found
                ids += [i or ""] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(wins, pa.binary())], ["item", "win"])

    made = items.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "item string, win binary")
    return made.groupBy("win").agg(F.collect_set("item").alias("items"))


def document_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of a bounded vocabulary stands."""
    sent = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[bytes] = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                n.update(sent.value.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())], ["word", "n"])

    counted = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


def _match(text: str | None, index: dict, starts: frozenset) -> tuple[int, set[int], set[str]]:
    w = words_of(text)
    hit: set[int] = set()
    items: set[str] = set()
    for at in [k for k, x in enumerate(w) if x in starts]:
        for offset, window, ids in index[w[at]]:
            begin = at - offset
            if 0 <= begin <= len(w) - len(window) and w[begin : begin + len(window)] == window:
                hit.update(range(begin, begin + len(window)))
                items.update(ids)
    return len(w), hit, items


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 10, block: int = 50_000) -> DataFrame:
    """``docs`` with ``_n_words``, ``_hit`` (the positions of words inside windows) and ``_items`` (ids, sorted)."""
    small_batches(docs.sparkSession)
    docs = docs.drop("_n_words", "_hit", "_items")
    found = keep(windows(items, item_id, item_text, n))
    blocks = max(1, -(-found.count() // block))
    out = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_hit": F.array().cast("array<int>"), "_items": F.array().cast("array<string>")})
    at = docs.columns.index(text_col)
    for k in range(blocks):
        part = [(bytes(r.win).split(b" "), tuple(sorted(r["items"]))) for r in found.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == k).toLocalIterator()]
        rarity = document_counts(docs, text_col, {w for window, _ in part for w in window})
        index: dict[bytes, list] = {}
        for window, ids in part:
            first = min(window, key=lambda w: (rarity.get(w, 0), w))
            if rarity.get(first):  # else no document holds it
                index.setdefault(first, []).append((window.index(first), window, ids))
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            starts = frozenset(index)
            for b in batches:
                had = zip(b.column(at).to_pylist(), b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)
                rows = []
                for text, hit, ids in had:
                    size, more, names = _match(text, index, starts)
                    rows.append((size, sorted(more.union(hit)), sorted(names.union(ids))))
                new = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())))]
                yield pa.RecordBatch.from_arrays([*b.columns[:-3], *new], b.schema.names)

        out = out.mapInArrow(run, T.StructType([*out.schema.fields[:-3], *(T.StructField(f.name, f.dataType) for f in out.schema.fields[-3:])]))
    return out


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    hits = F.size("_hit").cast("long")
    return decontaminate(docs, items).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("_items", ","), "UTF-8"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


SQL = r"""
WITH i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
n AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT coalesce(item, '') AS item, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM n),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
m AS (SELECT r, k, p.n, item FROM p JOIN win ON win.n = p.n AND win.win = array_to_string(w[k:k + p.n - 1], ' ')),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS x FROM m) GROUP BY r),
g AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN g USING (r)
"""
