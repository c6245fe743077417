"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domains, their languages, their sources.  A token budget
flows down by weight.  A node can take no more than its own tokens times the
epochs allowed; what it can't take goes to its siblings by their weights, and
only what a whole family can't take goes to the families beside it, because a
family's capacity is the sum of its members' capacities.  Each level is one
window: children ordered by capacity over weight are full up to some child, and
the rest share what is left; whole tokens, nothing lost by rounding.  With
``min_epochs`` every leaf has so many epochs of its own, whatever its weight, and
the weights share out the rest of the budget.

A leaf's budget is used up in seeded epochs: whole epochs first, then a prefix
of the next epoch's order (md5 of seed, epoch and doc_id), up to the document
that reaches the budget.  A leaf is cut into 4096 ranges of that order; only
the range in which the prefix ends is sorted, so a leaf with a third of all
documents never meets in one task.

Tokens here are words between ASCII blanks.  Defined results: null language or
source: the leaf ``unknown``; null or empty text: 0 tokens; names without a
weight weigh 1 or, with ``by_tokens``, get the share of the family's budget that
they have of its tokens; a weight of 0 gives no budget; an empty table gives no
rows; repeated rows are documents of their own; null ids sort by an empty id.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

LEAF = ["domain", "lang_", "source_"]
BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """Weights are whole numbers up to a million."""

    #: name, weight and sources of each domain; other sources are in ``other``.
    domains: tuple[tuple[str, int, tuple[str, ...]], ...] = (
        ("web", 50, tuple(f"src{i}" for i in range(0, 10))),
        ("reference", 30, tuple(f"src{i}" for i in range(10, 15))),
        ("forum", 20, tuple(f"src{i}" for i in range(15, 20))),
    )
    languages: dict[str, int] = field(default_factory=lambda: {"en": 50, "de": 20, "fr": 20, "es": 10})
    sources: dict[str, int] = field(default_factory=lambda: {"src0": 3})
    #: Budget in per cent of all tokens.
    percent: int = 60
    max_epochs: int = 2
    seed: int = 6
    #: Names without a weight share by their tokens; sources of a domain are known names.
    by_tokens: bool = False
    #: Epochs that every document gets before the weights count.
    min_epochs: int = 0


#: The mix of the corpus: each document once, half an epoch more by the weights.
#: ``Mix()`` is that of op6 and its SQL.
CORPUS = Mix(percent=150, by_tokens=True, min_epochs=1)


def _weight(name: Column, weights: dict[str, int]) -> Column:
    return reduce(lambda out, x: F.when(name == x[0], F.lit(int(x[1]))).otherwise(out), reversed(list(weights.items())), F.lit(1)).cast("long")


def weighed(children: DataFrame, parent: list[str], name: str, weights: dict[str, int], mix: Mix) -> DataFrame:
    """``children`` (parent columns, ``name``, capacity) with their weight.

    By tokens, weights are parts of 10^12 of the family: names without a weight
    get their share of its capacity, the others share the rest by weight.
    """
    given = _weight(F.col(name), weights)
    if not mix.by_tokens:
        return children.withColumn("weight", given)
    listed = F.col(name).isin(*weights)
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    c = children.withColumns({"_g": F.when(listed, given).otherwise(0), "_l": F.when(listed & (given > 0), F.col("capacity")).otherwise(0), "_u": F.when(listed, 0).otherwise(F.col("capacity"))})
    every = lambda x: F.sum(x).over(family).cast("double")
    c = c.withColumns({"_part": F.when(listed, F.col("_g") * every("_l") / F.greatest(every("_g"), F.lit(1.0))).otherwise(F.col("_u").cast("double")), "_all": F.greatest(every("_l") + every("_u"), F.lit(1.0))})
    weight = F.when(F.col("_part") > 0, F.greatest(F.lit(1).cast("long"), F.round(F.col("_part") / F.col("_all") * 1e12).cast("long"))).otherwise(0)
    return c.withColumn("weight", weight.cast("long")).drop("_g", "_l", "_u", "_part", "_all")


def narrow(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, text hash, leaf and tokens of every row."""
    source = F.coalesce("source", F.lit("unknown"))
    domain = reduce(lambda out, d: F.when(source.isin(*d[2]), F.lit(d[0])).otherwise(out), mix.domains, F.lit("other"))
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.select("doc_id", F.xxhash64("text").alias("th"), domain.alias("domain"), F.coalesce("lang", F.lit("unknown")).alias("lang_"), source.alias("source_"), tokens.alias("tokens"))


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (parent columns, ``name``, weight, capacity, budget of the
    parent) with the budget of each child in place of the parent's."""
    live = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0)
    c = children.withColumns({"_w": live.cast("decimal(18,0)"), "_c": F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0).cast("decimal(19,0)"), "_b": F.col("budget").cast("decimal(19,0)")})
    every = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = every.orderBy(F.when(F.col("_w") > 0, F.col("_c").cast("double") / F.col("_w").cast("double")).otherwise(-1.0), name)
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(BIG)
    left_b = F.col("_b").cast(BIG) - F.coalesce(F.sum("_c").over(before).cast(BIG), zero)
    left_w = F.sum("_w").over(every).cast(BIG) - F.coalesce(F.sum("_w").over(before).cast(BIG), zero)
    c = c.withColumn("_fits", (F.col("_c") * left_w.cast("decimal(18,0)") <= F.col("_w") * left_b.cast("decimal(20,0)")).cast("int"))
    c = c.withColumn("_full", F.min("_fits").over(upto) == 1)
    rest = lambda x: F.when(F.col("_full"), 0).otherwise(F.col(x))
    full = lambda x: F.when(F.col("_full"), F.col(x)).otherwise(0)
    c = c.withColumns({
        "_rb": (F.col("_b").cast(BIG) - F.sum(full("_c")).over(every).cast(BIG)).cast("decimal(20,0)"),
        "_rw": F.sum(rest("_w")).over(every).cast("decimal(18,0)"),
        "_hi": F.coalesce(F.sum(rest("_w")).over(upto), F.lit(0)).cast("decimal(18,0)"),
        "_lo": F.coalesce(F.sum(rest("_w")).over(before), F.lit(0)).cast("decimal(18,0)"),
    })
    part = F.expr("CASE WHEN _rw > 0 THEN (_hi * _rb) div _rw - (_lo * _rb) div _rw ELSE 0 END")
    c = c.withColumn("budget", F.when(F.col("_full"), F.col("_c").cast("long")).otherwise(part.cast("long")))
    return c.drop("_w", "_c", "_b", "_fits", "_full", "_rb", "_rw", "_hi", "_lo")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaf columns, total and budget.  ``leaves``: leaf columns and total."""
    caps = leaves.withColumn("capacity", F.col("total") * (mix.max_epochs - mix.min_epochs))
    add, all_ = F.sum("capacity").alias("capacity"), Window.partitionBy(F.lit(0))
    domains = caps.groupBy("domain").agg(add, F.sum("total").alias("total"))  # one row a domain
    domains = domains.withColumn("budget", F.floor(F.sum("total").over(all_).cast(BIG) * max(0, mix.percent - 100 * mix.min_epochs) / 100).cast("long"))
    domains = domains.withColumn("budget", F.least("budget", F.sum("capacity").over(all_).cast("long")))
    level = share_out(weighed(domains, [], "domain", {d[0]: d[1] for d in mix.domains}, mix), [], "domain").select("domain", "budget")
    langs = caps.groupBy("domain", "lang_").agg(add).join(level, "domain")
    level = share_out(weighed(langs, ["domain"], "lang_", mix.languages, mix), ["domain"], "lang_").select("domain", "lang_", "budget")
    sources = caps.join(level, ["domain", "lang_"])
    known = {s: 1 for d in mix.domains for s in d[2]} | mix.sources
    return share_out(weighed(sources, ["domain", "lang_"], "source_", known, mix), ["domain", "lang_"], "source_").select(*LEAF, "total", (F.col("budget") + F.col("total") * mix.min_epochs).alias("budget"))


def copies(docs: DataFrame, mix: Mix = CORPUS) -> DataFrame:
    """doc_id, th, leaf, tokens and ``copies`` (0 or more) of every row."""
    rows = cut(narrow(docs, mix))
    leaves = cut(budgets(cut(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("total"))), mix))
    plan = leaves.select(*LEAF, F.expr(f"CASE WHEN total > 0 THEN budget div total ELSE {mix.min_epochs} END").alias("whole"), F.expr("CASE WHEN total > 0 THEN budget % total ELSE 0 END").alias("rest"))
    key = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = cut(rows.join(plan, LEAF).withColumn("place", key).withColumn("bin", F.substring("place", 1, 3)))
    sums = rows.where("rest > 0").groupBy(*LEAF, "bin").agg(F.sum("tokens").alias("in_bin"))
    before = Window.partitionBy(*LEAF).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = sums.withColumn("before", F.coalesce(F.sum("in_bin").over(before), F.lit(0).cast("long")))
    met = rows.join(bins, [*LEAF, "bin"], "left")
    edge = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_bin") >= F.col("rest"))
    inside = Window.partitionBy(*LEAF, "bin").orderBy("place", "doc_id", "tokens", "th").rowsBetween(Window.unboundedPreceding, -1)
    last = met.where(edge).withColumn("picked", (F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)) < F.col("rest")))
    other = met.where(~F.coalesce(edge, F.lit(False))).withColumn("picked", F.coalesce(F.col("before") < F.col("rest"), F.lit(False)))
    return last.unionByName(other).select("doc_id", "th", *LEAF, "tokens", (F.col("whole") + F.col("picked").cast("int")).alias("copies"))


def select_mix(docs: DataFrame, mix: Mix = CORPUS) -> DataFrame:
    """doc_id, epoch, domain, lang, source, tokens: a row for each use."""
    used = copies(docs, mix).where("copies > 0")
    return used.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("epoch"), "domain", F.col("lang_").alias("lang"), F.col("source_").alias("source"), "tokens")


def mixed(docs: DataFrame, mix: Mix = CORPUS) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix uses it."""
    keys = {"doc_id": F.col("doc_id"), "th": F.xxhash64("text"), "lang_": F.coalesce("lang", F.lit("unknown")), "source_": F.coalesce("source", F.lit("unknown"))}
    used = copies(docs, mix).groupBy(*keys).agg(F.sum("copies").alias("_mix_uses"), F.count("*").alias("_mix_rows")).where("_mix_uses > 0")
    used = cut(used.withColumnsRenamed({k: f"_mix_used_{k}" for k in keys}))
    mine = docs.withColumns({f"_mix_{k}": v for k, v in keys.items()})
    met = mine.join(used, reduce(lambda a, b: a & b, [F.col(f"_mix_{k}").eqNullSafe(F.col(f"_mix_used_{k}")) for k in keys]))
    if used.where("_mix_rows > 1").limit(1).count():  # equal rows share their uses
        which = F.row_number().over(Window.partitionBy(*[f"_mix_{k}" for k in keys]).orderBy("_mix_th"))
        met = met.withColumn("_mix_uses", F.expr("_mix_uses div _mix_rows") + (which <= F.expr("_mix_uses % _mix_rows")).cast("int"))
    uses = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_uses")))
    return met.where("_mix_uses > 0").withColumn("_mix_use", uses).select(*docs.columns)


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_mix(table(spark, sf_dir, "documents"), Mix())


def _sql_weight(column: str, weights: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _sql_level(name: str, source: str, parent: list[str], child: str) -> str:
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"{by} ORDER BY CASE WHEN w > 0 THEN c::DOUBLE / w ELSE -1 END, {child}"
    return f"""
{name}_1 AS (SELECT *, b - coalesce(sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lb,
    sum(w) OVER ({by}) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lw FROM ({source}) WINDOW o AS ({order})),
{name}_2 AS (SELECT *, min((c * lw <= w * lb)::INT) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS f FROM {name}_1 WINDOW o AS ({order})),
{name}_3 AS (SELECT *, b - sum(CASE WHEN f THEN c ELSE 0 END) OVER ({by}) AS rb, sum(CASE WHEN f THEN 0 ELSE w END) OVER ({by}) AS rw,
    sum(CASE WHEN f THEN 0 ELSE w END) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi,
    coalesce(sum(CASE WHEN f THEN 0 ELSE w END) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo FROM {name}_2 WINDOW o AS ({order})),
{name} AS (SELECT * REPLACE ((CASE WHEN f THEN c WHEN rw > 0 THEN (hi * rb) // rw - (lo * rb) // rw ELSE 0 END)::HUGEINT AS b) FROM {name}_3)"""


def sql_mixing(mix: Mix = Mix(), documents: str = "documents") -> str:
    """``select_mix`` for DuckDB, with one window over each leaf."""
    domain = "CASE " + " ".join(f"WHEN source IN ({', '.join(repr(s) for s in sources)}) THEN '{name}'" for name, _, sources in mix.domains) + " ELSE 'other' END"
    live = lambda w: f"({w})::HUGEINT AS w"
    return f"""
WITH r AS (SELECT doc_id, text, {domain} AS domain, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::HUGEINT AS tokens FROM {documents}),
leaf AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS total, (sum(tokens) * {mix.max_epochs})::HUGEINT AS cap FROM r GROUP BY ALL),
goal AS (SELECT least(sum(total) * {mix.percent} // 100, sum(cap))::HUGEINT AS b FROM leaf),
d0 AS (SELECT domain, sum(cap)::HUGEINT AS c, {live(_sql_weight("domain", {d[0]: d[1] for d in mix.domains}))} FROM leaf GROUP BY domain),{_sql_level("d", "SELECT d0.*, goal.b FROM d0, goal", [], "domain")},
l0 AS (SELECT domain, lang, sum(cap)::HUGEINT AS c, {live(_sql_weight("lang", mix.languages))} FROM leaf GROUP BY domain, lang),{_sql_level("l", "SELECT l0.*, d.b FROM l0 JOIN d USING (domain)", ["domain"], "lang")},
s0 AS (SELECT domain, lang, source, total, cap AS c, {live(_sql_weight("source", mix.sources))} FROM leaf),{_sql_level("s", "SELECT s0.*, l.b FROM s0 JOIN l USING (domain, lang)", ["domain", "lang"], "source")},
p AS (SELECT domain, lang, source, CASE WHEN total > 0 THEN b // total ELSE 0 END AS whole, CASE WHEN total > 0 THEN b % total ELSE 0 END AS rest FROM s),
k AS (SELECT r.*, whole, rest, md5(concat_ws(':', '{mix.seed}', whole, coalesce(doc_id::VARCHAR, ''))) AS place FROM r JOIN p USING (domain, lang, source)),
c AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT doc_id, unnest(range(0, (whole + CASE WHEN before < rest THEN 1 ELSE 0 END)::BIGINT)) AS epoch, domain, lang, source, tokens::BIGINT AS tokens FROM c
"""
