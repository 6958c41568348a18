"""Brute-force versions of the operators' contracts, on plain rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(docs, chars=40, min_docs=5):
    key = lambda x: x.strip(BLANK).translate(UP)
    holders = defaultdict(list)
    for k, (i, text) in enumerate(docs):
        for line in {key(x) for x in (text or "").split("\n")}:
            if len(line) >= chars:
                holders[line].append((k, i))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for x in lines:
            h = holders.get(key(x), ())
            tops = [j for _, j in h if j is not None]
            if not (len(h) >= min_docs and tops and (i is None or i < max(tops))):
                kept.append(x)
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def simhash(docs):
    prints = []
    for _, text in docs:
        w = words((text or "").translate(UP))
        grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, f"{prints[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(docs)]


def repeated(units, length):
    """For each sequence, which of its units lie in a window that occurs anywhere else."""
    seen = Counter(tuple(u[k : k + length]) for u in units for k in range(len(u) - length + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for k in range(len(u) - length + 1):
            if seen[tuple(u[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        out.append(gone)
    return out


def suffixes(docs, length=400):
    texts = [(t or "").encode() for _, t in docs]
    out = []
    for (i, _), b, gone in zip(docs, texts, repeated(texts, length), strict=True):
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return out


def substrings(docs, window=35):
    texts = [words(t) for _, t in docs]
    return [(i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))) for (i, _), w, gone in zip(docs, texts, repeated(texts, window), strict=True)]


def contamination(docs, items, n=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
    wins = defaultdict(set)
    for i, t in items:
        w = word(t)
        for k in range(max(1, len(w) - n + 1)) if w else ():
            wins[tuple(w[k : k + n])].add(str(i) if i is not None else "")
    sizes = {len(w) for w in wins}
    out = []
    for i, t in docs:
        w = word(t)
        hit, ids = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (found := wins.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    ids |= found
        out.append((i, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def base_scores(docs):
    rows = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, [*words((t or "").translate(UP)), None]) for i, t in docs]
    c = Counter(w for _, held, ws in rows if not held for w in ws)
    total, types = sum(c.values()), len(c)
    return [(i, held, len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 1) / (total + types + 1)) for w in ws)) for i, held, ws in rows]


def nearest(rows, k=5):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in fine:
        if i % 50 == 0:
            cos = [(-(v @ x) / math.sqrt((v @ v) * (x @ x)), j) for j, x in fine if j != i]
            out[i] = [(j, -c) for c, j in sorted(cos)[:k]]
    return out


def jaccard_groups(docs, size=5, least=0.8):
    sets = []
    for _, t in docs:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))})
    return [(a, b) for a in range(len(docs)) for b in range(a) if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]


def quote_links(rows):
    """(conv, turn, parent, quotes, linked) of messages (conv, turn, text)."""
    norm = lambda x: " ".join(re.split(r"[\x20\x09-\x0D]+", x.translate(UP).strip(BLANK))).strip()
    read = []
    for conv, turn, text in rows:
        runs, last = [], None
        for line in re.split(r"\r\n|\r|\n", text or ""):
            m = re.match(r"[ \t]*(>[> \t]*)", line)
            level = m[1].count(">") if m else 0
            if level != last:
                runs.append((level, []))
                last = level
            runs[-1][1].append(norm(line[m.end() :] if m else line))
        own = [x for level, xs in runs if not level for x in [*xs, ""]]
        lines = [x for x in own if x]
        offer = {(1, *lines[i:j]) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)} | {(0, " ".join(lines))}
        offer |= {(0, " ".join(p.split("\0"))) for p in re.split("\0\0+", "\0".join(own).strip("\0")) if p}
        read.append((conv, turn, [(level, [x for x in xs if x]) for level, xs in runs if level and any(xs)], offer))
    links = {}
    out = []
    for conv, turn, asked, _ in read:
        found = []
        for k, (level, xs) in enumerate(asked):
            earlier = [t for c, t, _, o in read if c == conv and None not in (t, turn) and t < turn and ((1, *xs) in o or (0, " ".join(xs)) in o)]
            found.append((level, k, max(earlier, default=None)))
        best = min((f for f in found if f[2] is not None), default=(0, 0, None))[2]
        if best is not None:
            links.setdefault((conv, turn), best)
        out.append((conv, turn, best, len(asked) if turn is not None else 0, sum(f[2] is not None for f in found)))
    return out
