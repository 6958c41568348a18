"""Each operator against brute force, with nulls, empties, ties, repeats, clashing columns and empty tables."""

import math
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ordered
from pyspark.sql import functions as F

from glyphmill.llm import ann, anchors, decontaminate, induced, language_model, line_dedup, mixing, queries, quotes, similar, simhash, substrings, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"


def compare_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck.sql(queries.ORACLE_SQL[name])
    order = [rel.columns.index(c) for c in df.columns]
    assert ordered(df.collect()) == ordered(tuple(r[i] for i in order) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, duck, name):
    compare_sql(spark, duck, name)


def test_line_dedup(spark, tables, rows, docs, no_docs):
    assert ordered(line_dedup.op1_line_dedup(spark, str(tables)).collect()) == ordered(brute.line_dedup(rows))
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == [*docs.columns, "_n_lines", "_n_dropped", "_kept"]
    assert out.count() == len(rows)
    assert line_dedup.drop_repeated_lines(no_docs).count() == 0


def test_line_runs(spark):
    """Batches against the runs: new lines, compaction, and the totals."""
    from glyphmill.llm.common import workspace

    with workspace(spark, "test") as ws:
        runs = line_dedup.LineRuns(spark, ws, fanout=2, buckets=3)
        fresh = []
        for b in range(5):
            lines = spark.createDataFrame([(10 * b + d, a, a) for d in range(3) for a in (1, 100 + b)], "doc long, a long, b long")
            fresh.append(sorted({r.a for r in runs.fresh(lines).collect()}))
            runs.ingest(lines)
            entries = [r.a for name in runs.runs() for r in spark.table(name).collect()]
            assert sorted(entries) == sorted({1, *range(100, 101 + b)})  # an entry of one run only
        assert fresh == [[1, 100]] + [[100 + b] for b in range(1, 5)]
        assert all(len(level) < 2 for level in runs.levels)
        assert [tuple(r) for r in runs.frequent(5).collect()] == [(1, 1, 42)]
        assert sorted(tuple(r) for r in runs.frequent(3).collect()) == [(1, 1, 42), *((100 + b, 100 + b, 10 * b + 2) for b in range(5))]
        runs.close()


def test_line_runs_rest_on_the_anti_join(spark, monkeypatch):
    """Without the anti-join a line is an entry of many runs, each with too few documents."""
    from glyphmill.llm.common import workspace

    monkeypatch.setattr(line_dedup.LineRuns, "fresh", lambda self, batch: batch)
    with workspace(spark, "test") as ws:
        runs = line_dedup.LineRuns(spark, ws, fanout=9, buckets=3)
        for b in range(5):
            runs.ingest(spark.createDataFrame([(b, 1, 1)], "doc long, a long, b long"))
        assert runs.frequent(5).count() == 0
        runs.close()


@pytest.mark.parametrize("fanout", [2, 3])
def test_line_runs_count(spark, fanout):
    from glyphmill.llm.common import workspace

    rng = random.Random(fanout)
    held = sorted({(rng.randrange(1000), min(rng.randrange(1, 60), rng.randrange(1, 60))) for _ in range(900)})
    rng.shuffle(held)
    with workspace(spark, "test") as ws:
        runs = line_dedup.LineRuns(spark, ws, fanout=fanout, buckets=3)
        for k in range(7):
            runs.ingest(spark.createDataFrame([(d, a, a) for d, a in held[k::7]], "doc long, a long, b long"))
        of = {a: [d for d, x in held if x == a] for _, a in held}
        assert sorted(tuple(r) for r in runs.frequent(20).collect()) == sorted((a, a, max(ds)) for a, ds in of.items() if len(ds) >= 20)
        runs.close()


@pytest.mark.parametrize("crowd", [16, 0])
def test_simhash(spark, tables, rows, no_docs, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "BLOCK", 4096 if crowd else 3)
    assert ordered(simhash.op4_simhash(spark, str(tables)).collect()) == ordered(brute.simhash(rows))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_links(spark, monkeypatch):
    """Distances of up to three are linked, wherever the bits are; four are not."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for x in base]
    signed = [x - (1 << 64) if x >> 63 else x for x in {*base, *near}]
    links = simhash.hamming_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    expect = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in links} == expect


def test_suffixes(spark, tables, rows, docs, no_docs):
    assert ordered(suffix_dedup.op5_suffixes(spark, str(tables)).collect()) == ordered(brute.suffixes(rows))
    assert suffix_dedup.drop_repeated_bytes(no_docs).count() == 0
    assert suffix_dedup.drop_repeated_bytes(docs).columns == [*docs.columns, "_n_bytes", "_n_removed", "_n_spans", "_kept"]


@pytest.mark.parametrize("length", [70, 401])
def test_suffixes_other_lengths(spark, rows, docs, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD", 5000)
    monkeypatch.setattr(suffix_dedup, "STRIDE", 15)
    monkeypatch.setattr(suffix_dedup, "HOT", 1500 if length == 70 else 1 << 19)
    out = suffix_dedup.drop_repeated_bytes(docs, length=length)
    got = out.select("doc_id", "_n_bytes", "_n_removed", "_n_spans", F.sha2("_kept", 256)).collect()
    assert ordered(got) == ordered(brute.suffixes(rows, length))


@pytest.mark.parametrize("size", [399, 400])
def test_suffixes_of_passages(spark, size):
    """Passages of 60 words in three otherwise different documents: bytes decide, so that 400 go and 399 stay."""
    rng = random.Random(size)
    some = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage = "é" + some(60)
    passage += "é" * (size - 1 - len(passage.encode()) >> 1)
    passage += "x" * (size - len(passage.encode()))
    ends = [(f"{some(80)} {k}", f"{k} {some(80)}") for k in range(3)]
    rows = [(k, a + passage + z) for k, (a, z) in enumerate(ends)]
    assert len(passage.encode()) == size and len(passage.split()) == 60
    out = suffix_dedup.drop_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = ordered(out.select("doc_id", "_n_bytes", "_n_removed", "_n_spans", F.sha2("_kept", 256)).collect())
    kept = [a + z for a, z in ends] if size == 400 else [x for _, x in rows]
    assert got == ordered((k, len(x.encode()), *((400, 1) if size == 400 else (0, 0)), brute.sha(y.encode())) for (k, x), y in zip(rows, kept, strict=True))


@pytest.mark.parametrize("seed", range(6))
def test_induced_sorting(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(induced, "NAMES", rng.choice([0, 3, 1024]))
    for _ in range(40):
        letters = b"abcdefghijklmnopqrstuvwxyz"[: rng.choice([1, 2, 3, 26])]
        texts = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))]
        length = rng.randint(1, 12)
        seen = [[t[i : i + length] for i in range(len(t) - length + 1)] for t in texts]
        all_of = [w for ws in seen for w in ws]
        expect = [[i for i, w in enumerate(ws) if all_of.count(w) > 1] for ws in seen]
        assert [x.tolist() for x in induced.repeated_starts(texts, length, memory=rng.choice([5, 1 << 20]))] == expect


def test_suffix_order():
    rng = np.random.default_rng(1)
    body = rng.integers(1, 4, 300)
    order = induced.suffixes(body, 4, 1000, memory=16)[::-1]
    assert order.tolist() == sorted(range(300), key=lambda i: body[i:].tolist())


def test_anchor_blocks():
    rng = np.random.default_rng(2)
    units = rng.integers(0, 5, 500).astype(np.uint64)
    first, count, anchor = anchors.blocks(units, 4, 20)
    assert count.sum() == 481 and first[0] == 0 and (np.diff(first) == count[:-1]).all() and len(anchor) == len(first)


def test_substrings(spark, tables, rows, docs, no_docs):
    assert ordered(substrings.op6_substrings(spark, str(tables)).collect()) == ordered(brute.substrings(rows))
    for window in (3, 12):
        out = substrings.drop_repeated_spans(docs, window=window).select("doc_id", "_n_words", "_n_removed", F.sha2(F.encode("_kept", "UTF-8"), 256))
        assert ordered(out.collect()) == ordered(brute.substrings(rows, window))
    assert substrings.drop_repeated_spans(no_docs).count() == 0


def test_decontaminate(spark, docs, rows, no_docs):
    items = [(1, " ".join((rows[9][1]).split()[50:75])), (2, "ONE two"), (None, "x" * 3000), (4, None), (5, ""), (6, rows[20][1]), (6, rows[20][1]), (7, "no such words here at all, none of them in any text")]
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (200_000, 7):
        out = decontaminate.decontaminate(docs, table, block=block)
        assert out.columns == [*docs.columns, "_n_words", "_hit", "_items"]
        got = out.select("doc_id", "_n_words", F.size("_hit"), F.size("_items"), F.sha2(F.encode(F.array_join("_items", ","), "UTF-8"), 256), F.size("_hit") > 0).collect()
        assert ordered(got) == ordered(brute.contamination(rows, items))
    assert decontaminate.decontaminate(no_docs, table).count() == 0
    assert decontaminate.decontaminate(docs, table.limit(0)).where(F.size("_hit") > 0).count() == 0


def test_language_model(spark, tables, rows, no_docs):
    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r for r in language_model.op2_language_model(spark, str(tables)).collect()}
    expect = brute.base_scores(rows)
    assert len({(i, n, round(b, 6)) for i, _, n, _, _, b in expect}) == len(got)
    for i, held, n, known, total, base in expect:
        r = got[i, n, round(base, 6)]
        assert (r.held_out, r.n_known, r.train_tokens) == (held, known, total) and r.score < 0
    assert language_model.score_documents(no_docs, "doc_id", "text", F.lit(False)).count() == 0


@pytest.mark.parametrize("chunk", [1 << 24, 9000])
def test_language_model_by_definition(spark, rows, chunk, monkeypatch):
    """The scores are what the model's parameters say, and its probabilities after any word sum to one."""
    from glyphmill.llm.common import workspace

    monkeypatch.setattr(language_model, "CHUNK", chunk)
    monkeypatch.setattr(language_model, "LEAST", 20_000)
    monkeypatch.setattr(language_model, "FEWEST", 40)
    made = [(None if i is None else str(i), k % 3 == 1, t or "") for k, (i, t) in enumerate(rows)]
    with workspace(spark, "test") as ws:
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        chunks = ws.write(language_model.chunked(spark.createDataFrame(made, "id string, held boolean, text string").coalesce(2)), "chunks")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        totals = language_model.word_counts(chunks, ws)
        model = language_model.learn(chunks, totals)
        got = ordered((r.id, r.held_out, r.n_tokens, round(r.score, 6)) for r in language_model.score(chunks, totals, model).collect())
        assert (chunks.count() > 4) == (chunk < 10_000)
    classes, end = len(model.class_sums), len(model.words)
    logits = model.contexts.astype(float) @ model.targets[:, :-1].T.astype(float) + model.targets[:, -1]
    assert np.allclose(np.exp(logits - model.normalisers[:, None]).sum(axis=1), 1, atol=1e-4)
    counts = {}
    for _, held, t in made:
        for w in () if held else brute.words(t.translate(brute.UP)):
            counts[w.encode()] = counts.get(w.encode(), 0) + 1
    assert model.words == sorted(counts, key=lambda w: (-counts[w], w))[:end] and len(model.words) < len(counts)
    place = {w: k for k, w in enumerate(model.words)}
    kind = lambda w: end + 1 + zlib.crc32(w[-3:]) % classes
    sums = {}
    for w, c in counts.items():
        if w not in place:
            sums[kind(w)] = sums.get(kind(w), 0) + c + 1
    expect = []
    for i, held, t in made:
        last, total = end, 0.0
        ws = [w.encode() for w in brute.words(t.translate(brute.UP))]
        for w in [*ws, None]:
            s = end if w is None else place.get(w, kind(w))
            total += (logits[last, s] - model.normalisers[last]) / math.log(10)
            total += math.log10((counts.get(w, 0) + 1) / (sums.get(s, 0) + 1)) if s > end else 0
            last = s
        expect.append((i, held, len(ws) + 1, total))
    for x, y in zip(got, ordered((i, h, n, round(s, 6)) for i, h, n, s in expect), strict=True):
        assert x[:3] == y[:3] and math.isclose(x[3], y[3], rel_tol=1e-4)


def test_language_model_batches_are_bounded(spark):
    """What a chunk sends grows with its tokens by some two bytes each, a task's parameters go in slices, and batches of texts are small."""
    from glyphmill.llm import common

    rng = np.random.default_rng(3)
    codes = np.minimum(rng.zipf(1.3, 300_000), 200_000).astype(np.int32)
    body = language_model.packed(codes)
    assert len(body) < 2.5 * len(codes)
    assert (language_model.unpacked(pa.scalar(body, pa.binary()), len(codes)) == codes).all()
    assert not len(language_model.unpacked(pa.scalar(language_model.packed(codes[:0]), pa.binary()), 0))
    assert language_model.SENT * (4 * (language_model.SIZE + 2) + 16) <= common.BATCH_BYTES <= 4 << 20
    common.large_arrays_apart()
    common.give_back()


def test_language_model_learns(spark):
    rows = language_model.op2_language_model(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert rows.s > rows.b + 0.05 * rows.n  # bits saved on texts never seen


def test_toxicity(spark):
    got = toxicity.op3_toxicity(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted == r.toxic for r in got)
    assert hits / len(got) > 0.9
    assert sum(r.predicted and r.toxic for r in got) >= 0.6 * sum(r.toxic for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_toxicity_folding_and_edges(spark, docs, no_docs):
    assert toxicity.fold("Іdіоt 1d10t id1ot $cum 42 id!ot 1oser a$$ $100 ha!") == (["idiot", "idiot", "idiot", "scum", "42", "idiot", "ioser", "ass", "100", "ha"], [(1, "ldlot"), (2, "idlot"), (5, "idlot"), (6, "loser")])
    train = spark.createDataFrame([("you idiot fool", 1), ("such idiot talk", 1), ("an idiot here", 1), ("idiot", 1), ("a good day", 0), ("fine words here", 0), ("talk of the day", 0), ("nice day you", 0)], "text string, y int")
    model = toxicity.fit(train)
    assert any("idiot" in p for p in model.weights)
    out = toxicity.score(docs, model)
    assert out.columns == [*docs.columns, "_toxicity"] and out.count() == docs.count()
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.fit(train.where("y = 0")).curve is None


def test_exceptions():
    exceptions = frozenset({("clown", "fish")})
    a = toxicity.automaton({" clown ": 3.0})
    assert toxicity.features((["a", "clown", "fish"], []), a, exceptions)[2] == 0
    assert toxicity.features((["a", "clown"], []), a, exceptions)[2] == 3
    assert toxicity.features((["a", "ciown"], [(1, "clown")]), a, exceptions)[2] == 3
    assert toxicity.automaton({}) is None


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(1, 700)]
    rows += [(0, rows[0][1]), (1000, None), (1050, [0.0] * 16), (1100, [1.0, None] * 8), (1150, [float("nan")] * 16), (1200, [1.0, 2.0]), (None, rows[3][1]), (1250, [1e300] * 16), (49, [])]
    rows += [(800 + k, rows[60][1]) for k in range(9)] + [(850, rows[60][1]), (850, rows[60][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.neighbours(df, df.where("vec_id % 50 = 0"), "vec_id", "embedding").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    scaled = [(i, None if v is None else [x / 1e300 for x in v] if v and v[0] and v[0] > 1e200 else v) for i, v in rows if not v or len(v) == 16]
    expect = brute.nearest(scaled)
    assert set(got) == set(expect)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        hits += len({v for _, v, _ in found} & {v for v, _ in expect[q]})
        by = {v: s for v, s in expect[q]}
        assert all(math.isclose(s, by[v], rel_tol=1e-12) for _, v, s in found if v in by)
    assert hits / (5 * len(expect)) >= 0.9
    assert [v for _, v, _ in sorted(got[850])] == [61, 800, 801, 802, 803]
    assert ann.neighbours(df.limit(0), df.limit(0), "vec_id", "embedding").count() == 0


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in ann.op8_neighbours(spark, "/root/testdata/sf0.1").collect()}
    expect = brute.nearest([(r.vec_id, list(r.embedding)) for r in df.collect()])
    assert sum((q, v) in got for q, found in expect.items() for v, _ in found) >= 0.9 * sum(map(len, expect.values()))


def test_mixing(spark, docs, no_docs):
    out = mixing.mixed(docs)
    assert out.count() > 0 and no_docs.count() == 0 and mixing.mixed(no_docs).count() == 0
    assert set(docs.columns) <= set(out.columns)


@pytest.mark.parametrize("seed", range(4))
def test_sharing(spark, seed):
    """Water-filling: whole amounts, no more than capacity, and what is left by some goes to the others by weight."""
    rng = random.Random(seed)
    nodes = [("p", f"n{k}", rng.randint(0, 5000), rng.randint(1, 9)) for k in range(7)]
    budget = rng.randint(0, sum(n[2] for n in nodes) + 100)
    df = spark.createDataFrame([(*n, budget) for n in nodes], "p string, name string, cap long, w long, budget long")
    got = {r["name"]: r.got for r in mixing.share(df, ["p"], "name").collect()}
    want = min(budget, sum(n[2] for n in nodes))
    assert want - len(nodes) <= sum(got.values()) <= want
    assert all(got[n] <= cap for _, n, cap, _ in nodes)
    open_ratio = [got[n] / w for _, n, cap, w in nodes if got[n] < cap]
    assert not open_ratio or max(open_ratio) - min(open_ratio) <= 1
    assert all(got[n] / w <= max(open_ratio) + 1 for _, n, cap, w in nodes if open_ratio and got[n] == cap)


def test_quotes(spark):
    rows = [
        (1, 0, "u", "Hello there\nhow are you?"), (1, 1, "a", "Fine"), (1, 2, "u", "> how are  YOU?\nwhy ask"), (1, 3, "a", ">> how are you?\n> why ask\nbecause\n> unknown thing"),
        (2, 0, "u", None), (2, None, "u", "> x"), (None, 0, "u", "Yo"), (None, 1, "u", "> yo\nok"), (1, 600, "u", "> because\nfar"), (1, 601, "u", "> fine\n> \nx"), (1, 601, "u", ""),
    ]
    out = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = ordered((r.conv_id, r.turn, r._parent, r._thread, r._quotes, r._linked, r._said) for r in out.collect())
    assert got == ordered([
        (1, 0, None, 0, 0, 0, "Hello there\nhow are you?"), (1, 1, None, 1, 0, 0, "Fine"), (1, 2, 0, 0, 1, 1, "why ask"), (1, 3, 2, 0, 3, 2, "because"), (2, 0, None, 0, 0, 0, ""), (2, None, None, None, 0, 0, ""),
        (None, 0, None, 0, 0, 0, "Yo"), (None, 1, 0, 0, 1, 1, "ok"), (1, 600, 3, 0, 1, 1, "far"), (1, 601, 1, 1, 1, 1, "x"), (1, 601, 1, 1, 1, 1, ""),
    ])
    assert quotes.reply_order(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_quotes_brute_force(spark, seed, monkeypatch):
    """Whole messages, paragraphs and runs of lines, quoted at several levels, over few and many turns."""
    monkeypatch.setattr(quotes, "BLOCK", (3, 256)[seed])
    rng = random.Random(seed)
    rows = []
    for conv in (1, 2, None):
        said = []
        for turn in range(40):
            lines = [" ".join(rng.choice(["ja", "NO", "maybe", "so  be\tit", "x"]) for _ in range(rng.randint(1, 3))) if rng.random() < 0.8 else rng.choice(["", " "]) for _ in range(rng.randint(0, 6))]
            text = []
            for _ in range(rng.randint(0, 2) if said else 0):
                old = rng.choice(said)
                i = rng.randrange(len(old) + 1)
                part = old[i : i + rng.randint(1, 4)]
                mark = rng.choice([">", "> ", " >> ", "> > >"])
                text += [mark + (x.upper() if rng.random() < 0.3 else x) for x in part] + ([rng.choice(lines)] if lines else [])
            said.append([x for x in lines])
            rows.append((conv, turn, rng.choice(["\n", "\r\n"]).join(text + lines)))
    rows += [(1, None, "> ja"), (4, 0, None), (4, 1, ""), (4, 2, ">"), (5, 0, "a\nb\nc\nd"), (5, 1, "> b\n> c\nfine"), (5, 2, "> a b\n> c d"), (5, 3, "a b c d"), (5, 4, "> c\n> d\n> e")]
    out = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert ordered((r.conv_id, r.turn, r._parent, r._quotes, r._linked) for r in out.collect()) == ordered(brute.quote_links(rows))
    assert {r.turn: r._parent for r in out.where("conv_id = 5").collect()} == {0: None, 1: 0, 2: 0, 3: None, 4: None}


def test_quotes_of_long_messages(spark):
    """Ten thousand lines of alternating levels, and as many lines quoted as one passage."""
    lines = [f"{'> ' * (1 + k % 2)}line {k // 2}" for k in range(10_000)]
    rows = [(1, 0, "\n".join(f"line {k}" for k in range(10_000))), (1, 1, "\n".join(lines)), (1, 2, "\n".join(f"> line {k}" for k in range(9_999))), (1, 3, "\n".join(["> same"] * 5000 + ["same"] * 5000)), (1, 4, "> same\n" * 3)]
    out = {r.turn: r for r in quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert (out[1]._quotes, out[1]._linked, out[1]._parent) == (10_000, 10_000, 0)
    assert (out[2]._quotes, out[2]._linked, out[2]._parent) == (1, 1, 0)
    assert (out[3]._parent, out[4]._parent) == (None, 3)


def test_parsing_is_linear():
    import time

    text = b"\n".join(b"> " * (1 + k % 2) + b"line" for k in range(10_000))
    began = time.process_time()
    assert sum(1 for _ in quotes.parsed(text)) == 10_000 and time.process_time() - began < 1


def test_quoted_replies(spark):
    rows = quotes.quoted_replies(spark, SF).collect()
    linked = [r for r in rows if r.n_linked]
    assert len(linked) > 0.5 * len(rows) and all(r.parent < r.turn for r in linked)


def test_quotes_keep_every_message(spark):
    assert quotes.op10_quotes(spark, SF).count() == spark.read.parquet(f"{SF}/conversations.parquet").count()


@pytest.mark.parametrize("crowd", [16, 0])
def test_near_duplicates(spark, rows, docs, no_docs, crowd, monkeypatch):
    monkeypatch.setattr(similar, "CROWD", crowd)
    monkeypatch.setattr(similar, "PAIRS", 64 if crowd else 1)
    monkeypatch.setattr(similar, "BLOCK", 2048 if crowd else 4)
    kept = similar.drop_near_duplicates(docs).select("doc_id", "text").collect()
    pairs = brute.jaccard_groups(rows)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = len({find(k) for k in range(len(rows))})
    assert abs(len(kept) - groups) <= 1
    assert similar.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("pairs", [0, 64])
def test_near_duplicates_in_crowds(spark, monkeypatch, pairs):
    """In crowded cells too the shingles decide: pairs just at 0.8 are linked, pairs just below are not."""
    monkeypatch.setattr(similar, "CROWD", 0)
    monkeypatch.setattr(similar, "PAIRS", pairs)
    rng = random.Random(8)
    rows = []
    for i in range(0, 120, 2):
        words = [f"word{rng.randrange(10**9)}" for _ in range(170)]
        ends = [[str(rng.randrange(1000, 10000)) for _ in range(30)] for _ in range(2)]
        same = 9 if i % 4 else 6  # of 196 shingles: similarities of 0.806 and 0.781
        rows += [(i, " ".join(words + ends[0])), (i + 1, " ".join(words + ends[0][:same] + ends[1][same:]))]
    pairs = brute.jaccard_groups(rows)
    assert len(pairs) == 30
    kept = {r.doc_id for r in similar.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(120)) - {max(p) for p in pairs}


def test_near_duplicates_of_few_words(spark):
    """One word of a short text changed: every pair of similarity 0.8 or more is found, whatever the length."""
    rng = random.Random(4)
    rows = []
    for i in range(0, 600, 2):
        words = [rng.choice(["a", "to", "word"]) + str(rng.randrange(1000, 10**6)) for _ in range(13 + i % 40)]
        rows += [(i, " ".join(words)), (i + 1, " ".join([*words[:-1], f"last{i}"]))]
    pairs = brute.jaccard_groups(rows)
    assert len(pairs) == 300
    kept = {r.doc_id for r in similar.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(600)) - {max(p) for p in pairs}


def test_crowded_block(monkeypatch):
    """A block's links are those of the shingles, whatever the pieces."""
    rng = random.Random(2)
    base = rng.sample(range(10**9), 100)
    sets = []
    for k in range(80):
        own = set(base) if k % 2 else set(rng.sample(range(10**9), 100))
        for _ in range(rng.randint(0, 14)):
            own.discard(rng.choice(sorted(own)))
            own.add(rng.randrange(10**9))
        sets.append(own)
    monkeypatch.setattr(similar, "gram_hashes", lambda text: np.array(sorted(map(int, text.split())), np.uint64))
    counts = [similar.segment_counts(np.array(sorted(x), np.uint64)) for x in sets]
    rows = [{"side": side, "c": k, "g": len(x), "label": k, "m": counts[k], "text": " ".join(map(str, x)).encode()} for side in (0, 1) for k, x in enumerate(sets)]
    schema = pa.schema([("side", pa.int32()), ("c", pa.int64()), ("g", pa.int32()), ("label", pa.int64()), ("m", pa.binary()), ("text", pa.binary())])
    got = similar._joined(pa.Table.from_pylist(rows, schema)).to_pylist()
    for a in range(80):  # the bound never refuses a pair that the shingles link
        near, _ = similar._near(np.frombuffer(b"".join(counts), np.uint8).reshape(80, -1).astype(np.int16), np.array([len(x) for x in sets]), a, np.arange(80))
        assert {b for b in range(80) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])} <= set(near.tolist())
    root, expect = list(range(80)), list(range(80))

    def find(of, k):
        while of[k] != k:
            k = of[k]
        return k

    for e in got:
        assert 9 * len(sets[e["a"]] & sets[e["b"]]) >= 4 * (len(sets[e["a"]]) + len(sets[e["b"]]))
        root[find(root, e["a"])] = find(root, e["b"])
    for a in range(80):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                expect[find(expect, a)] = find(expect, b)
    assert all((find(root, a) == find(root, b)) == (find(expect, a) == find(expect, b)) for a in range(80) for b in range(80))


def test_shared_folder_on_a_cluster():
    """Without a named folder only a local session gets one of its own."""
    from types import SimpleNamespace

    from glyphmill.llm import common

    there = []
    conf = SimpleNamespace(get=lambda name, other="": other)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: there[0] if there else None, setCheckpointDir=there.append, getConf=lambda: conf)
    with pytest.raises(RuntimeError):
        common.shared_dir(SimpleNamespace(sparkContext=sc, conf=conf))
    sc.master = "local[2]"
    assert "glyphmill-checkpoint" in common.shared_dir(SimpleNamespace(sparkContext=sc, conf=conf))


CLEAN_WORKERS = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {folder!r}).getOrCreate()
import __spark_entry__ as entry
for name in {names!r}:
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("fine")
"""


def test_workers_need_no_package(tmp_path):
    """Queries run though the package isn't on the workers' path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    names = ["op2_language_model", "op3_toxicity", "op10_quotes", "fullwidth_to_ascii", "known_guesses"]
    code = CLEAN_WORKERS.format(root=str(Path(__file__).resolve().parents[2]), folder=str(tmp_path / "w"), names=names)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "fine" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("few", [0, 200_000])
def test_connected_components(spark, few, monkeypatch):
    """Long chains, stars and random graphs, by one task and by all."""
    from glyphmill.llm import common

    monkeypatch.setattr(common, "FEW_EDGES", few)
    rng = random.Random(few)
    edges = [(k, k + 1) for k in range(100)] + [(500, 500 + k) for k in range(1, 30)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(7, 7), (3, 2)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_components_of_few_edges_take_few_jobs(spark):
    """A counted graph of few edges isn't worked on in rounds, whose queries fill the driver's memory: a long chain takes as many jobs as one edge."""
    from glyphmill.llm import common

    def jobs(edges):
        spark.sparkContext.setJobGroup(name := f"components-{len(edges)}", "")
        try:
            got = {r.node: r.root for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        finally:
            spark.sparkContext.setJobGroup("others", "")
        assert got == {x: -5 for e in edges for x in e}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs([(k, k + 1) for k in range(-5, 600)]) == jobs([(-5, -4)]) <= 8
    assert common.connected_components(spark.createDataFrame([(7, 7)], "a long, b long")).count() == 0
