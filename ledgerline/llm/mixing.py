"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

A budget of tokens goes down a tree of domain, language and source. Each node shares its
budget among its children by weight; a child cannot take more than its documents give in the
allowed number of epochs, and what it leaves is shared among its siblings. Only what all of
them cannot take is returned to the parent: a node's capacity is that of its subtree, so
shortages are settled among siblings before ancestors.

A leaf then takes whole epochs and a prefix of the next one. An epoch is the leaf's documents
in the order of a hash of seed, epoch and id; the prefix is given by the hash of its last
document. That one is found from token sums per hash range: only the documents of the range
in which the budget ends are put in order, however large the leaf is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, save

#: Levels of the tree, top first.
LEVELS = ("_domain", "_lang", "_source")
SEED, EPOCHS = 17, 4
#: Target weights of the registered query and the pipeline: whole numbers, 1 where none is given.
WEIGHTS = {
    "_domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "_lang": {"en": 6, "de": 2, "fr": 2, "es": 2},
    "_source": {"src0": 2},
}
#: Documents of one hash range (about), and leaves up to which the plan is broadcast.
RANGE, BROADCAST_LEAVES = 1000, 50_000


def tokens_of(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def domain_of(source: str = "source") -> Column:
    """Documents name no domain: the source's number modulo 4 stands for one."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"(\d{1,9})$", 1)
    return F.concat(F.lit("domain"), F.coalesce(F.try_to_number(number, F.lit("999999999")), F.lit(0)).cast("int") % 4)


def keyed(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """Adds the tree's levels and the id as text; null names are ''."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.withColumns(
        {"_domain": domain_of() if domain is None else domain, "_lang": text("lang"), "_source": text("source"), "_id": text("doc_id")}
    )


def place(epoch: Column, seed: int) -> Column:
    """A document's place in an epoch: hex digits that sort as the epoch does."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("_id")).cast("binary"))


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1).cast("long")
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w).cast("long")).otherwise(out)
    return out


def _shared(nodes: DataFrame, parent: list[str], level: str, weights: dict) -> DataFrame:
    """(parent, level, capacity, given) -> adds ``share`` of the parent's ``given``.

    Children in order of capacity per weight: the ones that cannot take their share of what
    is left come first and get their capacity, the rest is shared by weight.
    """
    nodes = nodes.withColumn("w", _weight(level, weights))
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.when(F.col("w") > 0, F.col("capacity") / F.col("w")).otherwise(F.lit(float("inf"))), level)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("before", before).withColumn("after", after)
    full = (F.col("w") > 0) & (F.col("capacity") * F.col("after") <= F.col("w") * (F.col("given") - F.col("before")))
    nodes = nodes.withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0))
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(by)
    nodes = nodes.withColumn("rest", F.col("given") - taken).withColumn("open", open_weight)
    share = F.when(F.col("full"), F.col("capacity")).when(F.col("w") > 0, F.expr("(w * rest) div open")).otherwise(F.lit(0))
    return nodes.withColumn("share", share.cast("long")).drop("w", "before", "after", "full", "rest", "open")


def budgets(leaves: DataFrame, budget: float, weights: dict, epochs: int) -> DataFrame:
    """(levels, supply, docs) -> leaves with ``share``: tokens each is to give.

    ``budget`` is a part of the whole supply. The tables here have a row per node, not per
    document.
    """
    leaves = leaves.withColumn("capacity", F.col("supply") * epochs)
    total = leaves.agg(F.floor(F.sum("supply") * F.lit(budget)).cast("long").alias("given"))
    given, parent = None, []
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        nodes = leaves if depth == len(LEVELS) - 1 else leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        # the root is one row
        nodes = nodes.join(F.broadcast(total)) if given is None else nodes.join(given, parent)
        nodes = _shared(nodes, parent, level, weights)
        given, parent = nodes.select(*keys, F.col("share").alias("given")), keys
    return nodes.select(*LEVELS, "supply", "docs", "share")


def planned(narrow: DataFrame, budget: float = 1.0, weights: dict | None = None, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(levels, _id, tokens) -> per leaf: whole epochs, and the last place taken of the next.

    ``narrow`` is read three times; store it first. Documents with equal ids have equal places and
    are taken together or not at all.
    """
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply"), F.count(F.lit(1)).alias("docs"))
    shares = budgets(leaves, budget, WEIGHTS if weights is None else weights, epochs)
    plan = save(
        shares.withColumn("whole", F.expr(f"CASE WHEN supply > 0 THEN least(share div supply, {epochs}) ELSE 1 END").cast("int"))
        .withColumn("rest", F.when(F.col("supply") > 0, F.col("share") - F.col("whole") * F.col("supply")).otherwise(0))
        .withColumn("ranges", F.expr(f"greatest(1, docs div {RANGE})")),
        "leaves",
    )
    part = _with_plan(narrow, plan.where("rest > 0"), plan).withColumn("place", place(F.col("whole"), seed))
    in_range = F.shiftrightunsigned(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * F.col("ranges"), 32)
    part = part.withColumn("range", in_range)
    sums = part.groupBy(*LEVELS, "range", "rest").agg(F.sum("tokens").alias("t"), F.max("place").alias("last"))
    up_to = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = save(sums.withColumn("end", F.sum("t").over(up_to)), "ranges")
    inside = sums.where("end <= rest").groupBy(*LEVELS).agg(F.max("last").alias("cut"))
    edge = sums.where("end > rest AND end - t <= rest").groupBy(*LEVELS).agg(
        F.min("range").alias("edge"), F.min(F.col("end") - F.col("t")).alias("edge_before")
    )
    run = Window.partitionBy(*LEVELS).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    ordered = _with_plan(part, edge, plan).where("range = edge").withColumn("sum", F.sum("tokens").over(run))
    within = ordered.where("edge_before + sum <= rest").groupBy(*LEVELS).agg(F.max("place").alias("edge_cut"))
    return plan.join(inside, list(LEVELS), "left").join(within, list(LEVELS), "left").select(
        *LEVELS, "whole", F.coalesce("edge_cut", "cut").alias("cut")
    )


def _with_plan(rows: DataFrame, plan: DataFrame, leaves: DataFrame) -> DataFrame:
    """Join by leaf; the plan is broadcast while the number of leaves is small."""
    few = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(plan) if few else plan, list(LEVELS))


def taken(rows: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows with the levels and ``_id``, one per epoch they are taken in, with ``epoch``."""
    joined = _with_plan(rows, plan, plan)
    next_too = F.coalesce(place(F.col("whole"), seed) <= F.col("cut"), F.lit(False)).cast("int")
    times = joined.withColumn("_times", F.col("whole") + next_too).where("_times > 0")
    return times.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1))).drop("whole", "cut", "_times")


def mixed(
    docs: DataFrame,
    budget: float = 1.0,
    weights: dict | None = None,
    epochs: int = EPOCHS,
    seed: int = SEED,
    domain: Column | None = None,
) -> DataFrame:
    """Documents (doc_id, text, lang, source, ...) as often as they are taken; columns as before.

    Null names are a node ''. A leaf without tokens is kept once. Rows with equal ids within
    a leaf are taken alike. An empty table gives an empty result.
    """
    own = [c for c in docs.columns if c not in (*LEVELS, "_id", "_times")]
    rows = keyed(docs.select(*own), domain)
    narrow = save(rows.select(*LEVELS, "_id", tokens_of().alias("tokens")), "tokens")
    plan = save(planned(narrow, budget, weights, epochs, seed), "plan")
    clash = {"epoch": "_epoch_before", "whole": "_whole_before", "cut": "_cut_before"}
    rows = rows.withColumnsRenamed(clash)
    return taken(rows, plan, seed).select(*[F.col(clash.get(c, c)).alias(c) for c in own])


def query(spark, sf_dir: str) -> DataFrame:
    docs = keyed(documents(spark, sf_dir, "doc_id", "text", "lang", "source"))
    narrow = save(docs.select(*LEVELS, "_id", "doc_id", tokens_of().alias("tokens")), "tokens")
    plan = save(planned(narrow.drop("doc_id")), "plan")
    return taken(narrow, plan).select(
        "doc_id", "epoch", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("tokens").alias("n_tokens")
    )


def _case(level: str) -> str:
    whens = " ".join(f"WHEN {level} = '{name}' THEN {w}" for name, w in WEIGHTS.get(level, {}).items())
    return f"CASE {whens} ELSE 1 END" if whens else "1"


def _level_sql(name: str, level: str, parent: list[str], source: str) -> str:
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"{by} ORDER BY capacity / w, {level}"
    return f"""
{name}_w AS (SELECT *, {_case(level)} AS w FROM {source}),
{name}_s AS (SELECT *,
  coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
  sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS after FROM {name}_w),
{name}_f AS (SELECT *, capacity * after <= w * (given - before) AS is_full FROM {name}_s),
{name} AS (SELECT * EXCLUDE (w, before, after, is_full, given),
  CASE WHEN is_full THEN capacity ELSE
    (w * (given - coalesce(sum(capacity) FILTER (is_full) OVER ({by}), 0)::BIGINT))
    // (sum(w) FILTER (NOT is_full) OVER ({by}))::BIGINT END AS share
  FROM {name}_f)"""


def oracle() -> str:
    keys = ", ".join(LEVELS)
    return f"""
WITH docs AS (SELECT doc_id, 'domain' || (coalesce(try_cast(regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1) AS INT), 0) % 4) AS _domain,
  coalesce(lang, '') AS _lang, coalesce(source, '') AS _source,
  coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens FROM documents),
leaves AS (SELECT {keys}, sum(tokens)::BIGINT AS supply, sum(tokens)::BIGINT * {EPOCHS} AS capacity FROM docs GROUP BY ALL),
total AS (SELECT sum(supply)::BIGINT AS given FROM leaves),
d0 AS (SELECT _domain, capacity, given FROM (SELECT _domain, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY ALL), total),
{_level_sql("l0", "_domain", [], "d0").strip()},
d1 AS (SELECT n.*, share AS given FROM (SELECT _domain, _lang, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY ALL) n JOIN l0 USING (_domain)),
{_level_sql("l1", "_lang", ["_domain"], "d1").strip()},
d2 AS (SELECT n.*, share AS given FROM leaves n JOIN l1 USING (_domain, _lang)),
{_level_sql("l2", "_source", ["_domain", "_lang"], "d2").strip()},
plan AS (SELECT {keys}, CASE WHEN supply > 0 THEN least(share // supply, {EPOCHS}) ELSE 1 END AS whole,
  CASE WHEN supply > 0 THEN share - least(share // supply, {EPOCHS}) * supply ELSE 0 END AS rest FROM l2),
placed AS (SELECT d.*, whole, rest, md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')) AS place FROM docs d JOIN plan USING ({keys})),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY {keys} ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed),
times AS (SELECT *, whole + (CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END) AS n FROM summed)
SELECT doc_id, unnest(range(n))::INT AS epoch, _domain AS domain, _lang AS lang, _source AS source, tokens AS n_tokens FROM times"""
