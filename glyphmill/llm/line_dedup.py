"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` is a log-structured index: a batch of line hashes is merge-anti-joined with the sorted runs of the
levels. The lines that no run holds are added as a run of the batch's own, so every line is an entry of one run only;
those that a run holds already are updates of their entries. When a level has ``fanout`` runs they are compacted into one
run of the next level, and the updates of its entries are folded in. Runs are bucketed and sorted by hash, so merging a
batch shuffles the batch alone.

Defined results. Null or empty text: one empty line. A null ``doc_id`` is a document older than any other.
Rows that repeat a doc_id count as documents of their own and share the decision. Lines shorter than
``min_chars`` always stay. Empty tables give empty results. Only the id and text columns are used, so other
columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, Workspace, boxed, hash128, if_small, keep, lower_ascii, unboxed, workspace

#: Pairs of document and dropped line up to which they are broadcast (under 50 MB), and lines likewise.
SMALL = 300_000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.length(line) == F.octet_length(line), F.lower(bare)).otherwise(lower_ascii(bare))  # the same for ASCII, and faster


def line_hash(line: Column) -> Column:
    a, b = hash128(line_key(line))
    return F.struct(a.alias("a"), b.alias("b"))


def line_hashes(text: Column, min_chars: int) -> Column:
    """The distinct hashes of a text's lines of at least ``min_chars`` code points."""
    # lower-casing A-Z keeps the length
    long = F.filter(split_lines(text), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) >= min_chars)
    return F.array_distinct(F.transform(long, line_hash))


class LineRuns:
    """Levels of sorted runs (a, b, docs, top): a line's hash, its documents, its largest doc_id.

    ``updates`` are runs of the same kind: what later batches say of lines that are entries already.
    """

    def __init__(self, spark: SparkSession, ws: Workspace, fanout: int = 3, buckets: int | None = None):
        self.spark, self.ws, self.fanout = spark, ws, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.updates: list[str] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        run.write.bucketBy(self.buckets, "a", "b").sortBy("a", "b").option("path", f"{self.ws.root}/{name}").saveAsTable(name)
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table if exists {name}")
            self.ws.drop(name)

    def runs(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def fresh(self, batch: DataFrame) -> DataFrame:
        """Merge-anti-join: the rows of ``batch`` whose hash (a, b) no run holds."""
        for name in self.runs():
            batch = batch.join(self.spark.table(name).select("a", "b"), ["a", "b"], "left_anti")
        return batch

    def _merged(self, names: list[str]) -> DataFrame:
        """One run of several: outer merge joins of the buckets; no line is an entry of two runs."""
        runs = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).select("a", "b", F.col("docs").alias("_docs"), F.col("top").alias("_top"))
            runs = runs.join(more, ["a", "b"], "full").select("a", "b", F.coalesce("docs", "_docs").alias("docs"), F.coalesce("top", "_top").alias("top"))
        return runs

    def _updated(self, entries: DataFrame, updates: list[str]) -> DataFrame:
        """Entries with what the updates add to them: merge joins of the buckets, without a shuffle."""
        for name in updates:
            more = self.spark.table(name).select("a", "b", F.col("docs").alias("_docs"), F.col("top").alias("_top"))
            docs = F.col("docs") + F.coalesce("_docs", F.lit(0))
            entries = entries.join(more, ["a", "b"], "left").select("a", "b", docs.alias("docs"), F.greatest("top", "_top").alias("top"))
        return entries

    def ingest(self, lines: DataFrame) -> None:
        """Adds a batch of (doc, a, b), one row per document and line: fresh lines as a run, the others as updates."""
        batch = self._write(lines.groupBy("a", "b").agg(F.count("*").alias("docs"), F.max("doc").alias("top")))
        if not self.runs():
            self.levels[0].append(batch)
            return
        run = self._write(self.fresh(self.spark.table(batch)))
        known = self.spark.table(batch).join(self.spark.table(run).select("a", "b"), ["a", "b"], "left_anti")
        self.updates.append(self._write(known))
        self.levels[0].append(run)
        self._drop([batch])
        self._compact()

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            older = self.runs()
            # updates of entries of older levels stay; those of the compacted runs are folded in
            merged = self._write(self._updated(self._merged(names), self.updates))
            left = []
            for name in self.updates if older else []:
                rest = self.spark.table(name).join(self.spark.table(merged).select("a", "b"), ["a", "b"], "left_anti")
                left.append(self._write(rest))
            self._drop([*names, *self.updates])
            self.levels[level + 1].append(merged)
            self.updates = left
            level += 1

    def frequent(self, min_docs: int) -> DataFrame:
        """(a, b, top) of the lines that at least ``min_docs`` documents hold, over all runs."""
        entries = self._updated(self._merged(self.runs()), self.updates)
        return entries.where(F.col("docs") >= min_docs).select("a", "b", "top")

    def close(self) -> None:
        self._drop([*self.runs(), *self.updates])


def drop_lists(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 40, min_docs: int = 5, batches: int = 4) -> tuple[DataFrame, int]:
    """(doc, drop array<struct<a,b>>): the line hashes that each document loses, and the number of pairs."""
    spark = docs.sparkSession
    with workspace(spark, "line_dedup") as ws:
        lines = docs.select(F.col(id_col).alias("doc"), F.explode(line_hashes(F.col(text_col), min_chars)).alias("h")).select("doc", "h.a", "h.b")
        lines = ws.write(lines.withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches))), "lines")
        runs = LineRuns(spark, ws)
        try:
            for k in range(batches):
                runs.ingest(lines.where(F.col("batch") == k).select("doc", "a", "b"))
            frequent = keep(runs.frequent(min_docs))
        finally:
            runs.close()
        hit = lines.join(if_small(frequent, frequent.count(), SMALL), ["a", "b"])
        hit = hit.where(F.col("top").isNotNull() & (F.col("doc").isNull() | (F.col("doc") < F.col("top"))))
        pairs = keep(hit.select("doc", "a", "b"))
    return pairs.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("drop")), pairs.count()


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int = 4) -> DataFrame:
    """``docs`` with ``_n_lines``, ``_n_dropped`` and ``_kept`` (the text without its repeated lines).

    A line (stripped, A-Z lower-cased) of at least ``min_chars`` code points that at least ``min_docs``
    documents hold stays in the largest doc_id that holds it and goes from all others.
    """
    drops, pairs = drop_lists(docs, id_col, text_col, min_chars, min_docs, batches)
    rows = boxed(docs, i=F.col(id_col), text=F.col(text_col)).alias("d")
    out = rows.join(if_small(drops, pairs, SMALL).alias("x"), F.expr("d.i <=> x.doc"), "left")
    lines = split_lines(F.col("text"))
    stays = F.filter(lines, lambda x: ~((F.length(F.btrim(x, F.lit(BLANKS))) >= min_chars) & F.array_contains(F.col("drop"), line_hash(x))))
    whole = F.coalesce("text", F.lit(""))
    n = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    out = out.withColumn("kept", F.when(F.col("drop").isNotNull(), stays)).withColumn("n", n.cast("long"))
    left = F.when(F.col("kept").isNull(), F.col("n")).otherwise(F.size("kept").cast("long"))
    return unboxed(out, docs.columns, _n_lines=F.col("n"), _n_dropped=F.col("n") - left, _kept=F.coalesce(F.array_join("kept", "\n"), whole))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.encode("_kept", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
f AS (SELECT k, max(doc_id) AS top FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT r) >= 5),
m AS (SELECT k.*, coalesce(f.top IS NOT NULL AND (doc_id IS NULL OR doc_id < f.top), false) AS gone FROM k LEFT JOIN f USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
