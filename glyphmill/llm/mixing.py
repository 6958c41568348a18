"""Mixing sources to target weights by hierarchical budgeting; DataFrame functions only.

A token budget flows down a tree, here domain, language, source. At each node the children share their
parent's tokens by weight, no child more than its texts give in ``max_epochs`` epochs; what a child cannot use
goes to its siblings, and as a node's capacity is its children's sum, only what all of them cannot use had
gone to the node's own siblings before. Each leaf then takes whole epochs and, of one more, a prefix of
a seeded order: the documents whose running sum of tokens still fits.

The documents are never moved: their counts make a small tree; the prefix ends in one hash range of each leaf, found
by the ranges' sums, and only that range's rows are ordered. The end is a key per leaf, which the scan compares.

Defined results. Shares are whole tokens, rounded down. A null level counts as an empty name, a null text as
no tokens, a null id as an empty one. Rows of the same id in a leaf have the same key: all of them go in or none.
A leaf of weight 0 or without tokens gets nothing. Equal ratios go by name. An empty table gives an empty result.
All columns of the documents pass through; added ones begin with an underscore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import boxed, if_small, keep, unboxed

#: Rows of a leaf in one hash range, and the leaves up to which their table is broadcast.
RANGE_ROWS, SMALL = 4096, 200_000


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, w in weights.items():
        out = F.when(name == key, F.lit(w)).otherwise(out)
    return out.cast("long")


def share(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Adds ``got``: each node's part of its parent's ``budget`` by ``w``, at most ``cap``; whole numbers throughout."""
    all_of = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up_to = all_of.orderBy(F.col("cap") / F.col("w"), name).rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.where("w > 0").withColumns({
        "_before": F.sum("cap").over(up_to) - F.col("cap"),
        "_rest": F.sum("w").over(all_of) - F.sum("w").over(up_to) + F.col("w"),
    })
    full = F.expr("cap * _rest <= (budget - _before) * w")
    nodes = nodes.withColumn("_full", full)
    nodes = nodes.withColumns({
        "_used": F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(all_of),
        "_open": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("w"))).over(all_of),
    })
    got = F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("(budget - _used) * w div greatest(_open, 1)"))
    return nodes.withColumn("got", got).drop("_before", "_rest", "_full", "_used", "_open")


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], tokens: Column, id_col: str = "doc_id", budget_share: float = 0.8, max_epochs: int = 2, seed: str = "mix-1") -> DataFrame:
    """The selected rows of ``docs``, with ``_leaf_*`` for each level, ``_tokens`` and ``_epochs`` (how often each goes in)."""
    names = [f"_leaf_{k}" for k in levels]
    docs = docs.drop(*names, "_tokens", "_epochs")
    leaf = {f"_leaf_{k}": F.coalesce(c.cast("string"), F.lit("")) for k, c in levels.items()}
    base = boxed(docs, **leaf, _tokens=tokens, _id=F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    leaves = keep(base.groupBy(*names).agg(F.sum("_tokens").alias("cap1"), F.count("*").alias("docs")))
    budget = F.floor(F.sum("cap1") * budget_share).cast("long")
    got = leaves.agg(budget.alias("got"))
    for depth, (level, name) in enumerate(zip(levels, names, strict=True)):
        parent = names[:depth]
        nodes = leaves.groupBy(*names[: depth + 1]).agg((F.sum("cap1") * max_epochs).alias("cap"))
        above = got.select(*parent, F.col("got").alias("budget"))
        nodes = nodes.join(above, parent) if parent else nodes.join(F.broadcast(above))  # one row
        got = share(nodes.withColumn("w", _weight(F.col(name), weights.get(level, {}))), parent, name)
    plan = leaves.join(got.select(*names, "got"), names).where("cap1 > 0 and got > 0")
    plan = keep(plan.select(*names, "docs", F.expr("got div cap1").alias("_whole"), F.expr("got % cap1").alias("_part")))
    few = plan.count()
    key = F.md5(F.encode(F.concat_ws("/", F.lit(seed), F.col("_whole").cast("string"), F.col("_id")), "UTF-8"))
    ranges = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.ceil(F.col("docs") / RANGE_ROWS) / F.lit(2**32)).cast("long")
    keyed = base.select(*names, "_id", "_tokens").join(if_small(plan.where("_part > 0"), few, SMALL), names)
    keyed = keyed.withColumn("_key", key).withColumn("_range", ranges)
    sums = keyed.groupBy(*names, "_range").agg(F.sum("_tokens").alias("n"), F.first("_part").alias("_part"))
    upto = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    last = sums.withColumn("_before", F.sum("n").over(upto) - F.col("n")).where("_before <= _part and _before + n > _part")
    last = keep(last.select(*names, "_range", "_before"))
    tail = keyed.join(if_small(last, few, SMALL), [*names, "_range"])
    running = F.sum("_tokens").over(Window.partitionBy(*names).orderBy("_key").rangeBetween(Window.unboundedPreceding, 0))
    ends = tail.withColumn("_sum", running + F.col("_before")).where("_sum <= _part").groupBy(*names).agg(F.max("_key").alias("_end"))
    # a key below all of the range, where none of its rows fit: earlier ranges stay
    cut = last.join(ends, names, "left").select(*names, "_range", "_end")
    plan = plan.join(cut, names, "left")
    plan = keep(plan)
    out = base.join(if_small(plan, few, SMALL), names).withColumn("_key", key).withColumn("_at", ranges)
    inside = (F.col("_part") > 0) & (F.coalesce(F.col("_at") < F.col("_range"), F.lit(False)) | F.coalesce(F.col("_key") <= F.col("_end"), F.lit(False)))
    out = out.withColumn("_epochs", F.col("_whole") + F.when(inside, 1).otherwise(0)).where("_epochs > 0")
    return unboxed(out, docs.columns, **{c: F.col(c) for c in (*names, "_tokens", "_epochs")})


#: The tree over ``documents``: source names end in a number, and its last digit stands in for a domain.
DOMAIN = "CASE WHEN right(source, 1) IN ('0', '1', '2', '3') THEN 'web' WHEN right(source, 1) IN ('4', '5', '6') THEN 'reference' ELSE 'forum' END"
WEIGHTS = {"domain": {"web": 50, "reference": 30, "forum": 20}, "lang": {"en": 50, "de": 20, "fr": 20, "es": 10}}
BUDGET_SHARE, EPOCHS, SEED = 0.8, 2, "mix-1"


def mixed(docs: DataFrame) -> DataFrame:
    levels = {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    return mix(docs, levels, WEIGHTS, token_count(F.col("text")), "doc_id", BUDGET_SHARE, EPOCHS, SEED)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mixed(docs).select("doc_id", F.col("_leaf_domain").alias("domain"), F.col("_leaf_lang").alias("lang"), F.col("_leaf_source").alias("source"), F.col("_tokens").alias("tokens"), F.col("_epochs").alias("epochs"))


def _sql_share(table: str, source: str, parent: str, name: str) -> str:
    by = f"PARTITION BY {parent} " if parent else ""
    keys = f"{parent}, {name}" if parent else name
    return f"""
{table}_a AS (SELECT *, sum(cap) OVER ({by}ORDER BY cap / w, {name} ROWS UNBOUNDED PRECEDING) - cap AS b4, sum(w) OVER ({by}ORDER BY cap / w DESC, {name} DESC ROWS UNBOUNDED PRECEDING) AS rest FROM {source}),
{table}_b AS (SELECT *, cap * rest <= (budget - b4) * w AS filled FROM {table}_a),
{table}_c AS (SELECT *, coalesce(sum(cap) FILTER (filled) OVER ({by.strip()}), 0) AS used, coalesce(sum(w) FILTER (NOT filled) OVER ({by.strip()}), 0) AS opened FROM {table}_b),
{table} AS (SELECT {keys}, CASE WHEN filled THEN cap ELSE (budget - used) * w // greatest(opened, 1) END AS got FROM {table}_c)"""


def _sql_weight(name: str, weights: dict[str, int]) -> str:
    return f"CASE {name} {' '.join(f"WHEN '{k}' THEN {w}" for k, w in weights.items())} ELSE 1 END::HUGEINT"


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({DOMAIN}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS cap FROM d GROUP BY ALL),
total AS (SELECT floor(sum(cap) * {BUDGET_SHARE}::DOUBLE)::HUGEINT AS got FROM leaf),
n1 AS (SELECT domain, {EPOCHS} * sum(cap) AS cap, {_sql_weight("domain", WEIGHTS["domain"])} AS w, any_value(got) AS budget FROM leaf, total GROUP BY domain),
{_sql_share("s1", "n1", "", "domain").strip()},
n2 AS (SELECT domain, lang, {EPOCHS} * sum(cap) AS cap, {_sql_weight("lang", WEIGHTS["lang"])} AS w, any_value(got) AS budget FROM leaf JOIN s1 USING (domain) GROUP BY domain, lang),
{_sql_share("s2", "n2", "domain", "lang").strip()},
n3 AS (SELECT domain, lang, source, {EPOCHS} * sum(cap) AS cap, 1::HUGEINT AS w, any_value(got) AS budget FROM leaf JOIN s2 USING (domain, lang) GROUP BY domain, lang, source),
{_sql_share("s3", "n3", "domain, lang", "source").strip()},
p AS (SELECT domain, lang, source, got // cap AS whole, got % cap AS part FROM leaf JOIN s3 USING (domain, lang, source) WHERE cap > 0 AND got > 0),
k AS (SELECT d.*, whole, part, md5('{SEED}/' || whole || '/' || coalesce(doc_id::VARCHAR, '')) AS k FROM d JOIN p USING (domain, lang, source)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS upto FROM k)
SELECT doc_id, domain, lang, source, tokens, (whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END)::BIGINT AS epochs
FROM r WHERE whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END > 0
"""
