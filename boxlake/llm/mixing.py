"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

Documents hang below a tree domain - language - source. Each node's share of its parent's tokens is its weight among its
siblings. A node can give at most the tokens below it times ``max_epochs``; what it can't give goes to its siblings in
proportion to their weights, and only what all siblings together can't give is missing at the parent, whose own siblings
then take it. So budgets go top down, each level filled up like connected vessels.

A leaf with budget b and t tokens gives floor(b / t) whole epochs and, from the next epoch, a prefix: documents in the
order of md5(seed|epoch|doc_id), as many as stay within the rest. The prefix is found without sorting a leaf in one task:
token sums of ranges of the order (about the square root of the number of documents) show the range in which the budget
ends, and only that range is sorted. A document then needs only its leaf's row to be selected.

Nulls: a null text has no tokens, a null domain, lang or source is the empty name, a null doc_id the empty text. Rows
that repeat a doc_id within a leaf are taken together or not at all, and so are ids that tie in the order. Weights of zero give nothing.
Budgets are rounded down to whole tokens. A very long text counts like any other; where it doesn't fit into the rest, it and what comes after it stay out. An empty
table gives an empty table. Documents have no domain column: the domain is an argument, by default taken from the source, and a column of that name is an extra
one. Extra columns pass through `select` untouched; they must not differ from lang, source, doc_id or text by case only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import WORD, free_name, joined, stored

LEVELS = ("domain", "lang", "source")
#: Leaf tables of so many rows at most (each under 1 KB) are broadcast; larger ones meet the documents by leaf and salt.
BROADCAST_LEAVES = 20_000
SEED = 42
#: Weights of names; others weigh 1. Domains are named by the source's MD5 where documents have none.
WEIGHTS = {"domain": {"domain0": 3, "domain1": 2, "domain2": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 2}}


def source_domain(source: str = "source", k: int = 3) -> Column:
    """domain0 to domain<k-1>, by the MD5 of the source's name."""
    first = F.conv(F.substring(F.md5(F.coalesce(F.col(source), F.lit("")).cast("binary")), 1, 6), 16, 10).cast("bigint")
    return F.concat(F.lit("domain"), (first % k).cast("string"))


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1)
    for name, w in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return out.cast("bigint")


def fill(children: DataFrame, parent: list[str], budget: str) -> Column:
    """Tokens of a child: its part of the parent's budget (a column), filled up to the child's cap.

    children: columns cap and weight. With children in the order of cap / weight, the level is the largest of
    (budget - caps before) / (weights from here on).
    """
    across = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    order = across.orderBy(F.col("cap") / F.expr("nullif(weight, 0)").cast("double"), "name")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    return (F.col(budget) - before).cast("double") / F.nullif(after, F.lit(0)).cast("double")


def budgets(leaves: DataFrame, total: int, weights: dict = WEIGHTS, max_epochs: int = 2) -> DataFrame:
    """leaves (domain, lang, source, t tokens, n documents) with budget, epochs (whole ones) and rest."""
    usable = F.lit(True)
    for level in LEVELS:
        usable = usable & (_weight(level, weights) > 0)
    leaves = leaves.withColumn("cap", F.when(usable, F.col("t") * max_epochs).otherwise(0))
    above = None
    for depth, level in enumerate(LEVELS):
        path, parent = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").cast("bigint").alias("cap")).filter("cap > 0")
        nodes = nodes.withColumns({"weight": _weight(level, weights), "name": F.col(level)})
        nodes = nodes.join(above, parent) if parent else nodes.withColumn("given", F.lit(int(total)))
        nodes = nodes.withColumn("one", fill(nodes, parent, "given"))
        across = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
        share = F.floor(F.col("weight") * F.max("one").over(across) + F.lit(1e-6))
        nodes = nodes.withColumn("mine", F.least(F.col("cap"), share).cast("bigint"))
        above = nodes.select(*path, F.col("mine").alias("given"))
    out = leaves.join(above, list(LEVELS), "left").withColumn("budget", F.coalesce("given", F.lit(0)))
    whole = F.when(F.col("t") > 0, F.expr("budget div t")).otherwise(0)
    out = out.withColumn("epochs", whole.cast("int"))
    return out.select(*LEVELS, "t", "n", "budget", "epochs", (F.col("budget") - F.col("epochs") * F.col("t")).alias("rest"))


def _order(seed: int, doc_id: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col("epochs") + 1).cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def _range(h: str) -> Column:
    """Which of a leaf's ranges of the order h lies in; n documents have about sqrt(n) ranges of equal width."""
    return _range_of(F.col(h), F.col("n"))


def _range_of(h: Column, n: Column) -> Column:
    return F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") * F.ceil(F.sqrt(n)) / F.lit(1 << 32)).cast("int")


def select(docs: DataFrame, share: float = 0.5, weights: dict = WEIGHTS, max_epochs: int = 2, seed: int = SEED, domain: Column | None = None) -> tuple[DataFrame, DataFrame, str]:
    """The selected rows of docs (with a column for the epoch, whose name is returned last), and the leaves' budgets.

    share: tokens to select, as a share of all tokens. A row selected in several epochs is there several times.
    """
    named = {"domain": F.coalesce(domain, F.lit("")) if domain is not None else source_domain()}
    named |= {c: F.coalesce(c, F.lit("")) for c in LEVELS[1:]}
    narrow = stored(docs.select(*(v.alias(k) for k, v in named.items()), F.col("doc_id").cast("string").alias("doc_id"), tokens().alias("tokens")))
    leaves = stored(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("t"), F.count("*").alias("n")))
    total = int(share * (leaves.agg(F.sum("t")).first()[0] or 0))
    planned = stored(budgets(leaves, total, weights, max_epochs))
    small = planned.count() <= BROADCAST_LEAVES
    keyed = joined(narrow, planned.filter("rest > 0"), list(LEVELS), small).withColumn("h", _order(seed, "doc_id")).withColumn("r", _range("h"))
    sums = keyed.groupBy(*LEVELS, "r", "rest").agg(F.sum("tokens").alias("s"))
    upto = F.sum("s").over(W.partitionBy(*LEVELS).orderBy("r"))
    ends = sums.withColumn("upto", upto).filter("upto > rest and upto - s <= rest").groupBy(*LEVELS).agg(F.min("r").alias("end_range"), F.min_by(F.col("rest") - (F.col("upto") - F.col("s")), "r").alias("left"))
    ends = stored(ends)
    inside = joined(keyed.drop("rest"), ends, list(LEVELS), small).filter("r = end_range").groupBy(*LEVELS, "h", "left").agg(F.sum("tokens").alias("s"))
    within = inside.withColumn("upto", F.sum("s").over(W.partitionBy(*LEVELS).orderBy("h"))).filter("upto <= left")
    cut = within.groupBy(*LEVELS).agg(F.max("h").alias("end_order"))
    chosen = stored(planned.join(ends.drop("left"), list(LEVELS), "left").join(cut, list(LEVELS), "left").filter("budget > 0"))

    # A document meets its leaf by keys whose names no column of docs has.
    keys = {c: free_name(f"{c}_key", docs.columns) for c in (*LEVELS, "t", "n", "budget", "epochs", "rest", "end_range", "end_order")}
    epoch = free_name("epoch", docs.columns)
    leaf = chosen.select(*(F.col(c).alias(k) for c, k in keys.items()))
    near = joined(docs.withColumns({keys[c]: v for c, v in named.items()}), leaf, [keys[c] for c in LEVELS], small)
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col(keys["epochs"]) + 1).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    place = _range_of(h, F.col(keys["n"]))
    in_prefix = (place < F.col(keys["end_range"])) | ((place == F.col(keys["end_range"])) & (h <= F.col(keys["end_order"])))
    e = F.col(keys["epochs"])
    whole = F.when(e > 0, F.sequence(F.lit(1), e)).otherwise(F.array().cast("array<int>"))
    more = F.when((F.col(keys["rest"]) > 0) & in_prefix, F.array(e + 1)).otherwise(F.array().cast("array<int>"))
    return near.select(*docs.columns, F.explode(F.concat(whole, more)).alias(epoch)), planned, epoch


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, domain, lang, source, epoch, n_tokens of the selected documents."""
    rows, _, epoch = select(docs.select("doc_id", "text", "lang", "source"))
    return rows.select("doc_id", source_domain().alias("domain"), *(F.coalesce(c, F.lit("")).alias(c) for c in LEVELS[1:]), F.col(epoch).alias("epoch"), tokens().alias("n_tokens"))


#: DuckDB SQL for mixture(): the same budgets, and each leaf's prefix by one sort.
def oracle(share: float = 0.5, weights: dict = WEIGHTS, max_epochs: int = 2, seed: int = SEED) -> str:
    def weight(level: str) -> str:
        return f"(CASE {level} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in sorted(weights[level].items())) + " ELSE 1 END)"

    levels = []
    for depth, level in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        part = f"PARTITION BY {parent}" if parent else ""
        given = f"JOIN b{depth} USING ({parent})" if parent else ""
        budget = "given" if parent else "(SELECT CAST(floor(%s * sum(t)) AS BIGINT) FROM leaves)" % share
        levels.append(f"""
n{depth} AS (SELECT {path}, CAST(sum(t * {max_epochs}) AS BIGINT) AS cap, {weight(level)} AS weight, {level} AS name FROM leaves GROUP BY {path} HAVING sum(t) > 0),
o{depth} AS (SELECT n{depth}.*, {budget} AS given FROM n{depth} {given}),
l{depth} AS (SELECT *, CAST(given - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS one
    FROM o{depth} WINDOW w AS ({part} ORDER BY cap / CAST(weight AS DOUBLE), name)),
b{depth + 1} AS (SELECT {path}, least(cap, CAST(floor(weight * max(one) OVER ({part}) + 1e-6) AS BIGINT)) AS given FROM l{depth})""")
    return f"""
WITH d AS (
  SELECT doc_id, 'domain' || CAST(CAST('0x' || substr(md5(coalesce(source, '')), 1, 6) AS BIGINT) % 3 AS VARCHAR) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS t FROM d GROUP BY ALL),
{",".join(levels)},
plan AS (SELECT leaves.*, given // t AS epochs, given - (given // t) * t AS rest FROM leaves JOIN b3 USING (domain, lang, source) WHERE given > 0),
k AS (SELECT d.*, epochs, rest, md5('{seed}|' || (epochs + 1) || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM d JOIN plan USING (domain, lang, source)),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) AS upto FROM k)
SELECT doc_id, domain, lang, source, CAST(unnest(range(1, CAST(epochs + 1 AS BIGINT))) AS INTEGER) AS epoch, CAST(n_tokens AS BIGINT) AS n_tokens FROM c
UNION ALL
SELECT doc_id, domain, lang, source, CAST(epochs + 1 AS INTEGER), CAST(n_tokens AS BIGINT) FROM c WHERE rest > 0 AND upto <= rest"""
