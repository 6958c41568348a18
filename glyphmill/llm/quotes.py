"""Chat formatting by quotation linking.

Lines that begin with > are quoted; the number of > is their level. A run of quoted lines of one level is a
passage, normalised (A-Z lower-cased, white space made single spaces) and hashed, as one text and line by line. A message
offers the hashes of its own text, of its paragraphs, and of those runs of its lines, blank ones apart, that are as long as
a passage of the conversation that begins with the same line. A passage's original is the latest earlier message
of the conversation that offers one of its hashes, found as-of in blocks of turns, never by pairing all messages. A
message's parent is the original of its first linked passage of the lowest level; a thread is a message without a
parent and all that hangs on it. Within a conversation, order by thread, then turn: parents stand before replies.

Each message is parsed once, line by line, in time in proportion to its length. Runs of lines are told by prefix sums
of their lines' hashes (two polynomials modulo 2**61 - 1), so a run costs the same whatever its length.

Defined results. Null text: no lines. Null conv_id: a conversation of its own. A message without a turn links to
nothing and is its own thread. Messages of the same turn share their offers, and each is a row. Passages and lines
of white space only link to nothing. Empty tables give empty results; other columns of the messages pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, boxed, if_small, keep, small_batches, unboxed, workspace

#: Turns in a block of the as-of search, and conversations or threads up to which a counted table is broadcast.
BLOCK, SMALL = 256, 300_000
_MARKS = re.compile(rb"[ \t]*(>[> \t]*)")
_PRIME, _BASES = (1 << 61) - 1, (0x1F3A5C7E9B2D4F61, 0x0B4E8A1D5C93F727)


def unquoted(text: Column) -> Column:
    """The text without its quoted lines, and without white space at either end; lines end in \\n."""
    text = F.coalesce(text, F.lit(""))
    stays = F.filter(F.split(text, "\r\n|\r|\n", -1), lambda x: ~x.rlike("^[ \t]*>"))
    kept = F.when(text.contains(">"), F.array_join(stays, "\n")).otherwise(F.regexp_replace(text, "\r\n?", "\n"))
    return F.btrim(kept, F.lit(BLANKS))


def normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def text_hash(text: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(text)
    return _signed(h >> 64), _signed(h & 0xFFFFFFFFFFFFFFFF)


def line_hash(line: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(line))


def prefix_sums(lines: list[int]) -> tuple[list[int], list[int]]:
    """Of the lines' hashes, a polynomial's value up to each line, for either base."""
    sums = ([0], [0])
    for out, base in zip(sums, _BASES, strict=True):
        now = 0
        for h in lines:
            now = (now * base + (h & 0xFFFFFFFFFFFFFFFF) + 1) % _PRIME
            out.append(now)
    return sums


def run_hash(sums: tuple[list[int], list[int]], at: int, k: int) -> tuple[int, int]:
    """The hash of the k lines from ``at`` on."""
    x, y = ((s[at + k] - s[at] * pow(base, k, _PRIME)) % _PRIME for s, base in zip(sums, _BASES, strict=True))
    return x, y


def parsed(text: bytes) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first line, level, normalised lines) of a message's runs of lines of one level."""
    last, run, begin = -1, [], 0
    for i, line in enumerate(text.splitlines()):
        marks = _MARKS.match(line)
        level = marks[1].count(b">") if marks else 0
        if level != last and run:
            yield begin, last, run
        if level != last:
            last, run, begin = level, [], i
        run.append(normal(line[marks.end() :] if marks else line))
    if run:
        yield begin, last, run


def passages(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """(c, t, at, level, first, k, texts, lines): the quoted passages, with the hash of the first of their k lines and both hashes."""
    kind = {c: messages.schema[c].dataType.simpleString() for c in (conv, turn)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, rows = [], []
            for row, text in enumerate(b.column(2).to_pylist()):
                for at, level, lines in parsed(text):
                    lines = [x for x in lines if x]
                    if level and lines:
                        hashes = [line_hash(x) for x in lines]
                        rows.append(row)
                        out.append((at, level, hashes[0], len(lines), *text_hash(b" ".join(lines)), *run_hash(prefix_sums(hashes), 0, len(lines))))
            cols = list(zip(*out, strict=True)) or [()] * 8
            made = [pa.array(c, pa.int32() if i in (0, 1, 3) else pa.int64()) for i, c in enumerate(cols)]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *made], ["c", "t", "at", "level", "first", "k", "ta", "tb", "la", "lb"])

    quoted = messages.where(F.col(text).contains(">")).select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.encode(text, "UTF-8").alias("text"))
    return quoted.mapInArrow(run, f"c {kind[conv]}, t {kind[turn]}, at int, level int, first long, k int, ta long, tb long, la long, lb long")


def own_lines(messages: DataFrame) -> DataFrame:
    """(m, c, t, texts, lines) of messages (m, c, t, text): hashes of a message's own text and paragraphs, and of its lines."""
    kind = {f.name: f.dataType.simpleString() for f in messages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, own = [], []
            for text in b.column(3).to_pylist():
                parts, paragraph, lines = set(), [], []
                for _, level, run in parsed(text or b""):
                    for x in [*run, b""] if not level else ():
                        if x:
                            paragraph.append(x)
                            lines.append(x)
                        elif paragraph:
                            parts.add(b" ".join(paragraph))
                            paragraph = []
                if lines:
                    parts.add(b" ".join(lines))
                texts.append([dict(zip("ab", text_hash(x), strict=True)) for x in sorted(parts)])
                own.append([line_hash(x) for x in lines])
            pair = pa.struct([("a", pa.int64()), ("b", pa.int64())])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(texts, pa.list_(pair)), pa.array(own, pa.list_(pa.int64()))], ["m", "c", "t", "texts", "lines"])

    return messages.select("m", "c", "t", "text").mapInArrow(run, f"m long, c {kind['c']}, t {kind['t']}, texts array<struct<a:long,b:long>>, lines array<long>")


def runs_offered(messages: DataFrame) -> DataFrame:
    """(c, t, a, b) of messages (c, t, lines, wanted): the hashes of the runs of lines that wanted (first, k) names."""
    kind = {f.name: f.dataType.simpleString() for f in messages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for row, (lines, wanted) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                sizes: dict[int, list[int]] = {}
                for w in wanted:
                    sizes.setdefault(w["first"], []).append(w["k"])
                sums = prefix_sums(lines)
                found = {run_hash(sums, p, k) for p, h in enumerate(lines) for k in sizes.get(h, ()) if p + k <= len(lines)}
                rows += [row] * len(found)
                out += found
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *(pa.array([x[i] for x in out], pa.int64()) for i in (0, 1))], ["c", "t", "a", "b"])

    return messages.select("c", "t", "lines", "wanted").mapInArrow(run, f"c {kind['c']}, t {kind['t']}, a long, b long")


def offers(messages: DataFrame, asked: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """(c, t, kind, a, b): the hashes that messages offer of those that are asked for; kind 0 is of texts, 1 of runs of lines."""
    convs = keep(asked.select("c").distinct())
    bare = messages.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.encode(text, "UTF-8").alias("text")).alias("x")
    near = bare.join(if_small(convs, convs.count(), SMALL).alias("y"), F.expr("x.c <=> y.c"), "left_semi")
    own = own_lines(near.withColumn("m", F.xxhash64("c", "t", "text")))
    own = keep(own.dropDuplicates(["m", "c", "t"]))
    texts = own.select("c", "t", F.explode("texts").alias("h")).select("c", "t", F.lit(0).alias("kind"), "h.a", "h.b")
    wanted = keep(asked.select("c", "first", "k").distinct()).alias("w")
    begins = own.select("m", "c", "t", F.explode(F.array_distinct("lines")).alias("first")).alias("o").join(wanted, F.expr("o.c <=> w.c and o.first = w.first"))
    sizes = begins.select("o.m", "o.c", "o.t", "w.first", "w.k").groupBy("m", "c", "t").agg(F.collect_list(F.struct("first", "k")).alias("wanted")).alias("s")
    full = own.alias("o").join(sizes, F.expr("o.m = s.m and o.c <=> s.c and o.t = s.t")).select("o.c", "o.t", "o.lines", "s.wanted")
    return texts.unionByName(runs_offered(full).withColumn("kind", F.lit(1))).distinct()


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(c, t, at, level, parent, copies): each passage and the latest earlier turn that offers it, or null."""
    messages = messages.where(F.col(turn).isNotNull())
    small_batches(messages.sparkSession)
    asked = keep(passages(messages, conv, turn, text))
    hashes = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("ta").alias("a"), F.col("tb").alias("b")), F.struct(F.lit(1).alias("kind"), F.col("la").alias("a"), F.col("lb").alias("b"))))
    one = ["c", "t", "at", "level", "ta", "tb", "la", "lb"]
    each = asked.select(*one, hashes.alias("x")).select(*one, "x.*")
    wanted = keep(each.select("c", "kind", "a", "b").distinct()).alias("w")
    same = "{0}.c <=> {1}.c and {0}.kind = {1}.kind and {0}.a = {1}.a and {0}.b = {1}.b"
    made = offers(messages, asked, conv, turn, text).alias("o")
    made = made.join(wanted, F.expr(same.format("o", "w")), "left_semi").select("o.c", "o.t", "o.kind", "o.a", "o.b")
    key, block = ["c", "kind", "a", "b", "block"], F.floor(F.col("t") / BLOCK)
    made = keep(made.withColumn("block", block))
    asks = each.select("c", "kind", "a", "b", "t").distinct()
    rows = asks.withColumn("block", block).withColumn("offer", F.lit(None).cast("long")).unionByName(made.withColumn("offer", F.col("t").cast("long")))
    here = Window.partitionBy(*key).orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.max("offer").over(here)).where("offer is null").drop("offer")
    tops = made.groupBy(*key).agg(F.max("t").cast("long").alias("top"))
    blocks = rows.select(*key).distinct().withColumn("top", F.lit(None).cast("long")).unionByName(tops).groupBy(*key).agg(F.max("top").alias("top"))
    before = Window.partitionBy(*key[:-1]).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("far", F.max("top").over(before)).alias("k")
    found = rows.alias("r").join(blocks, F.expr(same.format("r", "k") + " and r.block = k.block"), "left")
    found = found.select("r.c", "r.t", "r.kind", "r.a", "r.b", F.coalesce("r.near", "k.far").alias("parent")).where("parent is not null").alias("f")
    out = each.alias("e").join(found, F.expr(same.format("e", "f") + " and e.t = f.t"), "left")
    # messages of one turn may hold the same passage; each counts
    out = out.select(*(f"e.{x}" for x in one), "e.kind", "f.parent")
    return out.groupBy(*one).agg(F.max("parent").alias("parent"), F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).alias("copies")).drop(*one[4:])


def threads(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(c, t, parent, thread) of the messages that have a parent; thread is found by doubling pointers."""
    first = links.where("parent is not null").groupBy("c", "t").agg(F.min(F.struct("level", "at", "parent")).alias("m"))
    now = keep(first.select("c", "t", F.col("m.parent").alias("parent"), F.col("m.parent").alias("thread")))
    if now.isEmpty():
        return now
    for _ in range(most_rounds):
        up = now.select(F.col("c").alias("uc"), F.col("t").alias("ut"), F.col("thread").alias("up"))
        new = now.join(up, F.expr("c <=> uc and thread = ut"), "left")
        new = keep(new.select("c", "t", "parent", F.coalesce("up", "thread").alias("thread"), F.col("up").isNotNull().alias("moved")))
        now = new.drop("moved")
        if new.where("moved").isEmpty():
            return now
    raise RuntimeError("threads did not settle")


def reply_order(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``messages`` with ``_parent``, ``_thread``, ``_quotes`` and ``_linked`` (passages, and those with an original) and ``_said`` (the text without quotes)."""
    links = keep(link(messages, conv, turn, text))
    counts = links.groupBy("c", "t").agg(F.sum("copies").alias("_quotes"), F.sum(F.when(F.col("parent").isNotNull(), F.col("copies")).otherwise(0)).alias("_linked"))
    tree = threads(links)
    info = counts.alias("x").join(tree.alias("y"), F.expr("x.c <=> y.c and x.t = y.t"), "left")
    info = info.select("x.c", "x.t", "_quotes", "_linked", "parent", "thread").alias("i")
    rows = boxed(messages, conv=F.col(conv), turn=F.col(turn), said=unquoted(F.col(text))).alias("m")
    out = rows.join(info, F.expr("m.conv <=> i.c and m.turn = i.t"), "left")
    zero = F.lit(0).cast("long")
    added = {"_parent": F.col("parent"), "_thread": F.coalesce("thread", F.col("turn")).cast("long"), "_quotes": F.coalesce("_quotes", zero), "_linked": F.coalesce("_linked", zero), "_said": F.col("said")}
    return unboxed(out, messages.columns, **added)


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    out = reply_order(messages)
    return out.select("conv_id", F.col("_thread").alias("thread"), "turn", "role", F.col("_parent").alias("parent"), F.col("_quotes").alias("n_quotes"), F.col("_linked").alias("n_linked"), F.sha2(F.encode("_said", "UTF-8"), 256).alias("said_sha256"))


#: What the messages of a table m (r, c, t, role, text) say, quote and link; each passage is held against all earlier messages of its conversation.
_LINKED = r"""
l AS (SELECT r, c, t, i, line, length(regexp_replace(regexp_extract(line, '^[ \t]*(>[> \t]*)', 1), '[^>]', '', 'g')) AS level,
             trim(regexp_replace(translate(regexp_replace(line, '^[ \t]*>[> \t]*', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
      FROM (SELECT r, c, t, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT *, regexp_split_to_array(text, '\r\n|\r|\n') AS ls FROM m))),
u AS (SELECT *, sum(begins) OVER (PARTITION BY r ORDER BY i) AS run, sum((level > 0 OR norm = '')::INT) OVER (PARTITION BY r ORDER BY i) AS par
      FROM (SELECT *, (level IS DISTINCT FROM lag(level) OVER (PARTITION BY r ORDER BY i))::INT AS begins FROM l)),
q AS (SELECT r, c, t, min(i) AS place, level, list(norm ORDER BY i) FILTER (WHERE norm <> '') AS ls FROM u WHERE level > 0 AND t IS NOT NULL GROUP BY r, c, t, level, run HAVING count(*) FILTER (WHERE norm <> '') > 0),
par AS (SELECT r, string_agg(norm, ' ' ORDER BY i) AS text FROM u WHERE level = 0 AND norm <> '' GROUP BY r, par),
o AS (SELECT r, c, t, list(norm ORDER BY i) AS own FROM u WHERE level = 0 AND norm <> '' GROUP BY r, c, t),
x AS (SELECT q.r, q.c, q.t, q.place, q.level, max(o.t) AS parent
      FROM q LEFT JOIN o ON o.c IS NOT DISTINCT FROM q.c AND o.t < q.t
       AND (array_to_string(o.own, ' ') = array_to_string(q.ls, ' ') OR EXISTS (SELECT 1 FROM par WHERE par.r = o.r AND par.text = array_to_string(q.ls, ' '))
            OR len(list_filter(range(1, len(o.own) - len(q.ls) + 2), lambda k: o.own[k:k + len(q.ls) - 1] = q.ls)) > 0)
      GROUP BY q.r, q.c, q.t, q.place, q.level),
n AS (SELECT c, t, count(*) AS n_quotes, count(parent) AS n_linked, (min({'level': level, 'place': place, 'parent': parent}) FILTER (WHERE parent IS NOT NULL)).parent AS parent FROM x GROUP BY c, t),
up AS (SELECT c, t, parent AS top FROM n WHERE parent IS NOT NULL UNION ALL SELECT up.c, up.t, n.parent FROM up JOIN n ON n.c IS NOT DISTINCT FROM up.c AND n.t = up.top WHERE n.parent IS NOT NULL),
root AS (SELECT c, t, min(top) AS thread FROM up GROUP BY c, t),
said AS (SELECT r, trim(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE level = 0), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM l GROUP BY r)
SELECT m.c AS conv_id, coalesce(root.thread, m.t)::BIGINT AS thread, m.t AS turn, {role}n.parent AS parent, coalesce(n_quotes, 0)::BIGINT AS n_quotes, coalesce(n_linked, 0)::BIGINT AS n_linked{said}
FROM m JOIN said USING (r) LEFT JOIN n ON n.c IS NOT DISTINCT FROM m.c AND n.t = m.t LEFT JOIN root ON root.c IS NOT DISTINCT FROM m.c AND root.t = m.t
"""

SQL = "WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id AS c, turn AS t, role, coalesce(text, '') AS text FROM conversations)," + _LINKED.replace("{role}", "m.role, ").replace("{said}", ", sha256(coalesce(said, '')) AS said_sha256")


def quoted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as if each message quoted the whole one before it, linked: the given tables hold no quotes."""
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text")
    before = messages.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("text").alias("before"))
    quote = F.concat(F.lit("> "), F.regexp_replace("before", "\r\n?|\n", "\n> "), F.lit("\n"))
    both = messages.join(before, ["conv_id", "turn"], "left").select("conv_id", "turn", F.concat(F.coalesce(quote, F.lit("")), F.col("text")).alias("text"))
    out = reply_order(both)
    return out.select("conv_id", F.col("_thread").alias("thread"), "turn", F.col("_parent").alias("parent"), F.col("_quotes").alias("n_quotes"), F.col("_linked").alias("n_linked"))


QUOTED_SQL = (
    r"""WITH RECURSIVE b AS (SELECT conv_id, turn + 1 AS turn, min(text) AS before FROM conversations GROUP BY ALL),
m AS (SELECT row_number() OVER () AS r, conv_id AS c, turn AS t, coalesce(CASE WHEN before IS NULL THEN '' ELSE '> ' || regexp_replace(before, '\r\n?|\n', chr(10) || '> ', 'g') || chr(10) END || text, '') AS text
      FROM conversations LEFT JOIN b USING (conv_id, turn)),"""
    + _LINKED.replace("{role}", "").replace("{said}", "")
)
