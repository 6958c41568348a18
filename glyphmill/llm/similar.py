"""Near-duplicate documents: five-word shingles of a Jaccard similarity of 0.8 or more, found without exception.

Texts of equal SimHash of their shingles (``WIDE`` 64-bit parts) are one class. Candidates among the classes come from a
prefix-filtered join: shingles have one order for all texts, and of g shingles the first g - ceil(0.8 g) + 1 are a text's
prefix. Two texts of similarity 0.8 or more share a shingle of their prefixes, whatever the order, so no pair is lost.
(Three of 64 bits, the narrow operator's limit, would ask for 0.97.) If asked for, as in the pipeline, what that operator links
(its fingerprints, grids, range join, Hamming check and components) is linked as well, and chains of both links connect.

Candidates are thinned out by the embedding of the narrow operator, made of the shingles themselves: their hashes fall
into ``SEGMENTS`` segments, and the Manhattan distance of two texts' counts by segment is a lower bound of the number of
shingles that only one of them has. The bound takes a few bytes a text and refuses nearly all pairs below 0.8 but very
long ones; the shingles themselves decide about the rest.

The order is by hash, but shingles that are frequent in a sample of the texts come last, so that passages held by many
texts seldom make candidates. The sample changes the work and never the result.

A shingle's cell is the texts that have it in their prefix. In crowded cells neighbours in order of size are compared
first, in the largest cell of each text, and then each text with the nearest one that the bound allows and that isn't
linked yet. Where that leaves a cell
in several pieces between which the bound allows links, blocks of bounded size count the shingles that texts of
different pieces share, so that the similarity itself decides in cells of every size.

Defined results. Null, empty and wordless texts are alike, and like each other. Fewer words than a shingle: the whole
sequence. A group's document that stays is that of the smallest id (null last), then of the smallest text hash; of
rows equal in both one stays. Empty tables give empty results. All columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, boxed, connected_components, if_small, keep, unboxed, workspace
from .simhash import CROWD, hamming_links, simhash

#: 64-bit parts of a hash and words of a shingle.
WIDE, SHINGLE = 8, 5
#: Segments of the bound's counts.
SEGMENTS = 256
#: Members of a block and their shingles; texts of the sample, in how many of them a shingle is frequent, and the most that are.
BLOCK, GRAMS, SAMPLE, OFTEN, FREQUENT = 2048, 1 << 20, 5000, 4, 100_000
#: The most pairs of a text in a block that are compared one by one.
PAIRS = 64
SMALL = 400_000
_MIX = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64) for k in range(WIDE)]


def _sums(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of 64 bits set."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 255 * 256):
        bits = np.unpackbits(h[at : at + 255 * 256].view(np.uint8)).view(np.uint64).reshape(-1, 8)
        ones += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return ones


def _wide(h: np.ndarray) -> list[int]:
    """The parts of a set's SimHash, from one 64-bit hash of each feature mixed anew for each part."""
    out = []
    for m in _MIX:
        x = (h ^ (h >> np.uint64(31))) * m
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        out.append(int(np.packbits((_sums(x) * 2 > len(x)).astype(np.uint8)).view(np.int64)[0]))
    return out


def shingles(words: list[bytes]) -> set[bytes]:
    """The distinct shingles of a text; of fewer words, the whole sequence."""
    return set(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))) or {b" ".join(words)}


def gram_hashes(text: bytes | None) -> np.ndarray:
    """The hashes of a text's distinct shingles."""
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles((text or b"").lower().split()), repeat(42)), np.uint64))


def prefix(grams: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first shingles of a text in the order of all texts, as many as a text of similarity 0.8 can't do without; often is sorted."""
    n = len(grams) - -(-4 * len(grams) // 5) + 1
    if len(often):
        at = np.minimum(np.searchsorted(often, grams), len(often) - 1)
        grams = np.concatenate((grams[often[at] != grams], grams[often[at] == grams]))
    return grams[:n]


def segment_counts(grams: np.ndarray) -> bytes:
    """How many of a text's shingles fall into each segment, at most 255, one byte each."""
    return np.minimum(np.bincount((grams % np.uint64(SEGMENTS)).astype(np.int64), minlength=SEGMENTS), 255).astype(np.uint8).tobytes()


def frequent(docs: DataFrame, text_col: str) -> np.ndarray:
    """Hashes, sorted, of shingles that several texts of a sample have, the most frequent ones."""
    n = docs.count()
    some = F.pmod(F.xxhash64(F.lit(7), F.col(text_col)), F.lit(max(1, n // SAMPLE))) == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(gram_hashes(t).view(np.int64))], ["gram"])

    sample = docs.where(some).select(F.encode(F.col(text_col), "UTF-8").alias("text")).distinct()
    counts = sample.mapInArrow(run, "gram long").groupBy("gram").count().where(F.col("count") >= OFTEN)
    top = counts.orderBy(F.desc("count"), "gram").limit(FREQUENT).toArrow().column("gram").to_numpy()
    return np.sort(top.view(np.uint64))


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, c, g, p, m, fp): id, hash of the text, class (a hash of the SimHash), number of shingles, those of the prefix, counts by segment, and the narrow operator's fingerprint."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = [gram_hashes(t) for t in b.column(2).to_pylist()]
            wide = pa.array([xxhash.xxh3_64_intdigest(np.array(_wide(x), np.int64).tobytes()) - (1 << 63) for x in grams], pa.int64())
            first = pa.array([prefix(x, sent.value).view(np.int64) for x in grams], pa.list_(pa.int64()))
            narrow = pa.array([simhash(t) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), wide, pa.array([len(x) for x in grams], pa.int32()), first, pa.array([segment_counts(x) for x in grams], pa.binary()), narrow], ["doc", "th", "c", "g", "p", "m", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(run, f"doc {kind}, th long, c long, g int, p array<long>, m binary, fp long")


def _segments(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SEGMENTS).astype(np.int16)


def _near(m: np.ndarray, g: np.ndarray, x: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the others that the bound allows to be like x, and their Manhattan distances."""
    d = np.abs(m[others] - m[x]).sum(axis=1)
    fine = d.astype(np.int64) * 9 <= g[x] + g[others]
    return others[fine], d[fine]


def _allowed(group: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each row x of side 0, the rows of side 1 of other pieces that may be like it, and their distances."""
    g, at, label, side = (group.column(k).to_numpy() for k in ("g", "at", "label", "side"))
    g, m, right = g.astype(np.int64), _segments(group.column("m")), np.flatnonzero(side == 1)
    for x in np.flatnonzero(side == 0):
        others = right[label[right] != label[x]]
        behind = np.minimum(g[x] - at[x], g[others] - at[others])  # of a pair's first common shingle, and so in one cell of each pair
        yield x, *_near(m, g, x, others[behind * 9 >= (g[x] + g[others]) * 4])


def _nearest(group: pa.Table) -> pa.Table:
    """(a, b): each text of side 0 and the nearest of another piece that may be like it."""
    c = group.column("c").to_numpy()
    out = [(c[x], c[others[np.argmin(d)]]) for x, others, d in _allowed(group) if len(others)]
    return pa.table([pa.array([min(e) for e in out], pa.int64()), pa.array([max(e) for e in out], pa.int64())], ["a", "b"])


def _open(group: pa.Table) -> pa.Table:
    """(cell, c, d): what a block leaves to the shingles: pairs of texts, or texts (d is null) that may be like more than ``PAIRS`` others.

    A text of the second kind comes with all that it may be like.
    """
    c = group.column("c").to_numpy()
    found, pairs = np.zeros(len(c), bool), []
    for x, others, _ in _allowed(group):
        if len(others) <= PAIRS:
            pairs += [(c[x], k) for k in c[others]]
        else:
            found[others] = found[x] = True
    one = np.unique(c[found])
    cell = pa.array(np.full(len(one) + len(pairs), group.column("cell")[0].as_py(), np.int64))
    return pa.table([cell, pa.array([*one, *(min(p) for p in pairs)], pa.int64()), pa.array([*[None] * len(one), *(max(p) for p in pairs)], pa.int64())], ["cell", "c", "d"])


def _joined(group: pa.Table) -> pa.Table:
    """Edges between texts of a block's two sides, of similarity 0.8 or more, that connect what all such pairs connect."""
    c, g, side = (group.column(k).to_numpy() for k in ("c", "g", "side"))
    g, m = g.astype(np.int64), _segments(group.column("m"))
    texts, held = group.column("text"), {}
    _, piece = np.unique(group.column("label").to_numpy(), return_inverse=True)
    right, out = np.flatnonzero(side == 1), []

    def grams(k: int) -> np.ndarray:
        if c[k] not in held:
            held[c[k]] = gram_hashes(texts[k].as_py())
        return held[c[k]]

    for x in np.flatnonzero(side == 0):
        near, d = _near(m, g, x, right[piece[right] != piece[x]])
        for y in near[np.argsort(d, kind="stable")]:
            if piece[y] != piece[x] and alike(grams(x), grams(y)):
                out.append((c[x], c[y]))
                piece[piece == piece[y]] = piece[x]
        if (piece == piece[x]).all():
            break
    return pa.table([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of hashes have a Jaccard similarity of 0.8 or more."""
    return len(np.intersect1d(a, b, assume_unique=True)) * 9 >= (len(a) + len(b)) * 4


def texts_of(named: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(c, text) of the classes in named (c)."""
    named = keep(named.distinct().join(classes.select("c", "th"), "c"))
    return texts.join(if_small(named, named.count(), SMALL), "th").groupBy("c").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the pairs of a Jaccard similarity of 0.8 or more."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, SEGMENTS).astype(np.int16) for c in (b.column(2), b.column(3)))
            fine = np.abs(x - y).sum(axis=1).astype(np.int64) * 9 <= b.column(4).to_numpy()
            yield b.select([0, 1]).filter(pa.array(fine))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, grams = None, None
        for b in batches:
            fine = []
            for a, x, y in zip(b.column(0).to_pylist(), b.column(2), b.column(3), strict=True):
                if grams is None or a != last:
                    last, grams = a, gram_hashes(x.as_py())
                fine.append(alike(grams, gram_hashes(y.as_py())))
            yield b.select([0, 1]).filter(pa.array(fine, pa.bool_()))

    for x in "ab":
        pairs = pairs.join(classes.select(F.col("c").alias(x), F.col("g").alias(f"g{x}"), F.col("m").alias(f"m{x}")), x)
    pairs = keep(pairs.select("a", "b", "ma", "mb", (F.col("ga") + F.col("gb")).cast("long").alias("g")).mapInArrow(bound, "a long, b long"))
    named = texts_of(pairs.select(F.col("a").alias("c")).union(pairs.select("b")), classes, texts)
    both = pairs.join(named.withColumnsRenamed({"c": "b", "text": "y"}), "b").join(named.withColumnsRenamed({"c": "a", "text": "x"}), "a")
    return both.select("a", "b", "x", "y").mapInArrow(decide, "a long, b long")


def blocked(rows: DataFrame, names: list[str]) -> DataFrame:
    """Each pair of a cell's parts (cell, i, j) with the rows of both, as sides 0 and 1; rows have blocks, the number of parts."""
    rows = rows.withColumn("k", F.pmod(F.xxhash64("c"), F.col("blocks")))
    others = F.expr("sequence(0L, blocks - 1)")
    left = rows.select("cell", F.col("k").alias("i"), F.explode(others).alias("j"), F.lit(0).alias("side"), *names).where("i <= j")
    right = rows.select("cell", F.explode(others).alias("i"), F.col("k").alias("j"), F.lit(1).alias("side"), *names).where("i <= j")
    return left.unionByName(right)


def in_pieces(rows: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Crowded cells, rows (cell, c, g, at), that the trees of roots leave in several pieces, in parts of a block: with label, m and blocks."""
    trees = roots.select(F.col("node").alias("c"), F.col("root").alias("label"))
    rows = keep(rows.select("cell", "c", "g", "at").join(trees, "c", "left").withColumn("label", F.coalesce("label", "c")))
    parted = keep(rows.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.min("label").alias("l"), F.max("label").alias("m")).where("l <> m").select("cell", "blocks"))
    return rows.join(if_small(parted, parted.count(), SMALL), "cell").join(classes.select("c", "m"), "c")


def crowd_links(rows: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root): roots, and the links that crowded cells, rows (cell, c, g, at), have between its trees."""

    def more(links: DataFrame) -> DataFrame:
        return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))

    fields = ["c", "g", "at", "label", "m"]
    nearest = blocked(in_pieces(rows, roots, classes), fields).groupBy("cell", "i", "j").applyInArrow(_nearest, "a long, b long")
    nearest = keep(nearest.distinct())
    if nearest.isEmpty():
        return roots
    roots = more(verified(nearest, classes, texts))
    several = in_pieces(rows, roots, classes)
    may = keep(blocked(several, fields).groupBy("cell", "i", "j").applyInArrow(_open, "cell long, c long, d long").distinct())
    single = keep(may.where("d is not null").select(F.col("c").alias("a"), F.col("d").alias("b")).distinct())
    if not single.isEmpty():
        roots = more(verified(single, classes, texts))
    left = keep(may.where("d is null").drop("d").join(several.drop("at", "blocks", "m"), ["cell", "c"]))
    # cells of the same texts would find the same
    same = [F.sum(F.xxhash64(F.lit(k), "c").cast("decimal(38,0)")).alias(f"s{k}") for k in (0, 1)]
    cells = left.groupBy("cell").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("g") / GRAMS)).alias("blocks"), *same)
    cells = keep(cells.groupBy("s0", "s1").agg(F.min(F.struct("cell", "blocks")).alias("x")).select("x.*"))
    n = cells.count()
    if not n:
        return roots
    left = keep(left.join(if_small(cells, n, SMALL), "cell"))
    left = left.join(classes.select("c", "m"), "c").join(texts_of(left.select("c"), classes, texts), "c")
    return more(blocked(left, ["c", "g", "label", "m", "text"]).groupBy("cell", "i", "j").applyInArrow(_joined, "a long, b long"))


def classes_of(prints: DataFrame) -> DataFrame:
    """(c, th, g, p, m, best): one text of each class, and its document that stays."""
    order = F.struct(F.col("doc").isNull().alias("null"), F.col("doc").alias("doc"), F.col("th").alias("th"))
    rows = prints.select("c", "th", "g", "p", "m", order.alias("best"))
    several = keep(prints.groupBy("c").count().where("count > 1").select("c"))
    several = if_small(several, several.count(), SMALL)
    merged = rows.join(several, "c", "left_semi").groupBy("c").agg(F.min(F.struct("th", "g", "p", "m")).alias("one"), F.min("best").alias("best"))
    return rows.join(several, "c", "left_anti").unionByName(merged.select("c", "one.*", "best"))


def links(cells: DataFrame, classes: DataFrame, texts: DataFrame, ws: Workspace) -> DataFrame:
    """(node, root) of the classes (c, g, m, th) that chains of links connect; cells: (c, g, at, cell), texts: (th, text)."""
    cells = cells.repartition("cell")  # one shuffle for the count and the join
    size = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = ws.write(cells.join(size, "cell"), "cells")
    few = shared.where(F.col("n") <= CROWD)
    a = few.select("cell", *(F.col(x).alias(f"a{x}") for x in ("c", "g", "at")))
    b = few.select("cell", *(F.col(x).alias(f"b{x}") for x in ("c", "g", "at")))
    # what both have from the shared shingle on bounds what they share, as the least shared one stands in both prefixes
    near = a.join(b, "cell").where("ac < bc and least(ag - aat, bg - bat) * 9L >= (ag + bg) * 4L").select(F.col("ac").alias("a"), F.col("bc").alias("b")).distinct()
    rows = shared.where(F.col("n") > CROWD)
    if rows.isEmpty():
        return connected_components(verified(near, classes, texts))
    # of each text's largest cell, neighbours by size, in parts of a cell
    largest = rows.groupBy("c").agg(F.max(F.struct("n", "cell", "g")).alias("x")).select("c", "x.*")
    parts = largest.withColumn("k", F.pmod(F.xxhash64("cell", "c"), F.ceil(F.col("n") / BLOCK)))
    beside = parts.select(F.lag("c").over(Window.partitionBy("cell", "k").orderBy("g", "c")).alias("a"), F.col("c").alias("b")).where("a is not null")
    roots = connected_components(verified(near.union(beside).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), classes, texts))
    ws.release()
    return crowd_links(rows, roots, classes, texts)


def with_fingerprints(roots: DataFrame, prints: DataFrame, ws: Workspace) -> DataFrame:
    """(node, root): roots, and the links of classes of which the narrow operator connects fingerprints: popcount grids, range join, Hamming distance, components."""
    pairs = ws.write(prints.select("fp", "c").distinct(), "pairs")
    trees = connected_components(hamming_links(pairs.select("fp").distinct()))
    held = pairs.join(trees.withColumnRenamed("node", "fp"), "fp", "left").select("c", F.coalesce("root", "fp").alias("tree"))
    held = held.join(roots.withColumnRenamed("node", "c"), "c", "left").select("tree", F.coalesce("root", "c").alias("c")).distinct()
    held = keep(held)
    least = held.groupBy("tree").agg(F.min("c").alias("a"), F.count("*").alias("n")).where("n > 1")
    new = keep(held.join(least, "tree").where("a <> c").select("a", F.col("c").alias("b")))
    if new.isEmpty():
        return roots
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(new))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprints: bool = False) -> DataFrame:
    """``docs`` without all but one document of each group of near-duplicates; with fingerprints, those that op4's operator links are too."""
    spark = docs.sparkSession
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    with workspace(spark, "similar") as ws:
        prints = ws.write(_prints(docs, id_col, text_col), "prints")
        full = classes_of(prints)
        classes = ws.write(full.drop("p"), "classes")
        cells = full.select("c", "g", F.posexplode("p").alias("at", "cell"))
        roots = links(cells, classes, docs.select(F.xxhash64(text).alias("th"), text.alias("text")), ws)
        if fingerprints:
            roots = with_fingerprints(roots, prints, ws)
        ws.release()
        rooted = keep(classes.select("c", "best").join(roots.withColumnRenamed("node", "c"), "c", "left").select("c", F.coalesce("root", "c").alias("root"), "best"))
        stays = rooted.groupBy("root").agg(F.min("best").alias("stay"))
        label = keep(rooted.join(stays, "root").select("c", "stay"))
        rows = prints.select("doc", "th", "c").join(if_small(label, label.count(), SMALL), "c")
        is_it = F.col("doc").eqNullSafe(F.col("stay.doc")) & (F.col("th") == F.col("stay.th"))
        gone = keep(rows.where(~is_it).select("doc", "th").distinct())
        again = rows.where(is_it).groupBy("doc", "th").count().where("count > 1").isEmpty()
    inner = boxed(docs, i=F.col(id_col), h=F.xxhash64(text)).alias("d")
    out = inner.join(if_small(gone, gone.count(), SMALL).alias("x"), F.expr("d.i <=> x.doc and d.h = x.th"), "left_anti")
    return unboxed(out if again else out.dropDuplicates(["i", "h"]), docs.columns)
