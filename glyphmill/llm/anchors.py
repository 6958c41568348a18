"""Where long repeats can be: windows of a sequence grouped by their least k-gram.

A window of ``span`` units belongs to the position of the least hash among its k-grams, the leftmost at ties.
This depends on the window's content alone, so equal windows have the same anchor at the same offset. The
windows of one anchor are consecutive; they make a block, and its content is what they cover together.
Blocks of unrepeated anchors hold no repeated window; of the others, blocks of equal content are one case.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, if_small, keep

#: An odd multiplier and its inverse modulo 2**64, of the polynomial hash of a k-gram.
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 2**64)
#: Hashes (16 bytes) up to which a counted table is broadcast, and rows of spans (some 100 bytes).
SMALL_KEYS, SMALL_ROWS = 2_000_000, 200_000

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def kgram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit polynomial hash of each k consecutive units."""
    n = len(units)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(units * _power(MULTIPLIER, n), out=sums[1:])
    h = (sums[k:] - sums[: n - k + 1]) * _power(INVERSE, n - k + 1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values, by prefix and suffix minima of chunks."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    chunks = padded.reshape(-1, w)
    before = np.minimum.accumulate(chunks, axis=1).ravel()
    after = np.minimum.accumulate(chunks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - w + 1], before[w - 1 : n])


def blocks(units: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each block's first window, number of windows, and anchor hash (signed); none if there's no window."""
    if len(units) < span:
        none = np.zeros(0, np.int64)
        return none, none, none
    h = kgram_hashes(units, k)
    ordered = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_least(ordered, span - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.append(first, len(at)))
    return first, count, h[at[first]].view(np.int64)


def contested(found: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sorts blocks (anchor, content, t, size, start, windows), one row for each place, by what is known of them.

    Returns the places (with n, their copies) of repeated anchors; the contents (anchor, content, n and one
    place) that occur twice or more; and the contents of anchors that have several, which must be compared.
    """
    found = ws.write(found, "blocks")
    often = keep(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    places = found.join(if_small(often, often.count(), SMALL_KEYS), "anchor", "left_semi")
    places = places.groupBy("anchor", "content", "t", "size", "start", "windows").agg(F.count("*").alias("n"))
    places = ws.write(places, "places")
    ws.drop("blocks")
    contents = places.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min(F.struct("t", "size", "start", "windows")).alias("at"))
    contents = ws.write(contents.select("anchor", "content", "n", "at.*"), "contents")
    several = contents.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1").select("anchor")
    disputed = contents.join(several, "anchor", "left_semi")
    return places, contents.where("n > 1").select("anchor", "content"), disputed


def texts_of(docs: DataFrame, wanted: DataFrame, ws: Workspace) -> DataFrame:
    """One (t, size, text) of each text that ``wanted`` (t, size) names; docs has the columns t, size, text."""
    keys = keep(wanted.select("t", "size").distinct())
    named = docs.join(if_small(keys, keys.count(), SMALL_KEYS), ["t", "size"], "left_semi")
    return named.groupBy("t", "size").agg(F.first("text").alias("text"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (t, size and more) with ``spans``, an array of (start, windows); spans has one row for each place."""
    spans = keep(spans.select("t", "size", "start", "windows").distinct())
    lists = spans.groupBy("t", "size").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    return docs.join(if_small(lists, spans.count(), SMALL_ROWS), ["t", "size"], "left")
