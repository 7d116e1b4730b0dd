"""Mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree of domain, language and source. A token budget enters
at the root and is split level by level: each child gets its weight's share of
its parent's budget, but no more than it can give (its tokens times
``max_epochs``). What a child falls short of goes to its siblings by their
weights, again up to what they can give, and so on; only what all siblings
together can't use stays with the parent's own siblings, because a parent's
limit is the sum of its children's. The split has a closed form: with children
sorted by limit over weight, a prefix gets its limits and the rest shares one
rate, so a level is two running sums.

Each leaf then reads its documents in epochs, every epoch in its own seeded
order: whole epochs first, and of the last one the longest prefix that fits
the budget. The prefix is found from sums over order buckets, then within the
one bucket where the budget ends; documents themselves are never sorted by
leaf, so a source with a third of all rows is no task's work alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import staged

MAX_EPOCHS = 4
SEED = "mix"
ORDER_HEX = 13           # hex digits of the order key: below 2 ** 52
SALTS = 32               # tasks that a leaf's rows are dealt to where the leaf table is too large to broadcast
PREFIXES = (2, 4)        # digits by which the end of a budget is narrowed down
DOMAINS = 4
LEVELS = ("domain", "lang", "source")

# Target weights. A node that isn't listed has its level's default.
WEIGHTS = {
    "domain": ({"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1}, 0.1),
    "lang": ({"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}, 0.05),
    "source": ({}, 1.0),
}


def tokens_of(text: str) -> Column:
    """Words between ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """A source's domain: one of ``DOMAINS`` by hash (documents name none themselves)."""
    digits = F.conv(F.substring(F.md5(source), 1, 8), 16, 10).cast("long")
    return F.concat(F.lit("d"), F.pmod(digits, F.lit(DOMAINS)).cast("string"))


def order_key(epoch: Column, doc_id: Column, text_hash: Column, seed: str = SEED) -> Column:
    """A document's place in an epoch of its leaf, as hex digits."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), name, text_hash)), 1, ORDER_HEX)


def _weight(level: str, weights) -> Column:
    named, default = weights[level]
    out = F.lit(float(default))
    for k, w in named.items():
        out = F.when(F.col(level) == k, F.lit(float(w))).otherwise(out)
    return out


def split_budget(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """``nodes`` (parents, level, weight, cap, parent_budget) with ``budget``: the parent's budget, shared by weight up to cap.

    Children are sorted by cap / weight. Child i is full if the rate at which
    it and all later children could still share is at least its own ratio;
    full children get their cap, the others weight times the rate after the
    last full one, which is the largest rate of those that aren't full. Children of weight zero get what is left, by cap.
    """
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    up = by.orderBy("ratio", level)
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    caps, weights = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rate = (F.col("parent_budget") - F.col("caps")) / F.greatest(F.col("total") - F.col("weights"), F.lit(1e-300))
    got = (nodes.withColumn("ratio", ratio).withColumn("total", F.sum("weight").over(by)).withColumn("caps", caps).withColumn("weights", weights)
           .withColumn("rate", rate).withColumn("full", (F.col("weight") > 0) & (F.col("rate") >= F.col("ratio")))
           .withColumn("shared", F.max(F.when(~F.col("full") & (F.col("weight") > 0), F.col("rate"))).over(by)))
    budget = F.when(F.col("full"), F.col("cap")).when(F.col("weight") > 0, F.least("cap", F.col("weight") * F.col("shared")))
    left = (F.col("parent_budget") - F.sum("first").over(by)) / F.greatest(F.sum(F.when(F.col("weight") <= 0, F.col("cap")).otherwise(F.lit(0.0))).over(by), F.lit(1e-300))
    got = got.withColumn("first", F.coalesce(budget, F.lit(0.0)))
    got = got.withColumn("budget", F.when(F.col("weight") > 0, F.col("first")).otherwise(F.col("cap") * F.greatest(F.lit(0.0), F.least(F.lit(1.0), left))))
    return got.select(*nodes.columns, "budget")


def leaf_budgets(leaves: DataFrame, budget_ratio: float, max_epochs: int, weights) -> DataFrame:
    """(domain, lang, source, tokens, docs, budget): budgets from the root down; one row for each leaf in, so small tables."""
    levels = list(LEVELS)
    above = None
    for i, level in enumerate(levels):
        nodes = leaves.groupBy(*levels[:i + 1]).agg(F.sum("tokens").alias("t"))
        if above is None:
            everything = F.sum("t").over(Window.partitionBy(F.lit(0)))  # of one row for a domain
            nodes = nodes.withColumn("parent_budget", everything.cast("double") * budget_ratio)
        else:
            nodes = nodes.join(above, [*levels[:i]])
        nodes = nodes.withColumn("cap", F.col("t").cast("double") * max_epochs).withColumn("weight", _weight(level, weights)).drop("t")
        above = split_budget(nodes, levels[:i], level).select(*levels[:i + 1], F.col("budget").alias("parent_budget"))
    return leaves.join(above.withColumnRenamed("parent_budget", "budget"), levels)


def _beside(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """``rows`` (with a salt) joined with a table of one row for each leaf.

    A small table is broadcast. A large one meets the rows by leaf and salt, so
    that a leaf with a third of all rows is dealt over ``SALTS`` tasks, and
    what is summed by leaf afterwards is summed there first.
    """
    return rows.join(leaves.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*LEVELS, "salt"])


def _ends(placed: DataFrame, leaves: DataFrame) -> DataFrame:
    """(domain, lang, source, stop): the first place that no longer fits a leaf's last epoch; leaves that fit whole have no row.

    Sums by the place's first digits find the stretch in which the budget ends,
    in steps of 256, so that no step gathers more than 256 sums for a leaf; the
    last step walks the documents of one stretch in 65,536.
    """
    levels = list(LEVELS)
    edge = leaves.select(*levels).withColumns({"prefix": F.lit(""), "before": F.lit(0).cast("long")})
    for digits in (*PREFIXES, ORDER_HEX):
        near = _beside(placed, edge).filter(F.col("place").startswith(F.col("prefix")))
        run = Window.partitionBy(*levels).orderBy("bucket")
        sums = (near.groupBy(*levels, "rest", "before", F.substring("place", 1, digits).alias("bucket")).agg(F.sum("tokens").alias("t"))
                .withColumn("upto", F.col("before") + F.sum("t").over(run)).filter("upto > rest"))
        first = sums.groupBy(*levels).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("e"))
        edge = staged(first.select(*levels, F.col("e.bucket").alias("prefix"), "e.before"), "edge")
    return edge.select(*levels, F.col("prefix").alias("stop"))


def _leaf(docs: DataFrame, lang: str, source: str, domain: Column | None) -> dict[str, Column]:
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return {"domain": name(domain if domain is not None else domain_of(F.col(source))), "lang": name(F.col(lang)), "source": name(F.col(source))}


def _epochs(seed: str) -> Column:
    """How often a row with doc_id, hash, whole, rest and stop is read."""
    place = order_key(F.col("whole"), F.col("doc_id"), F.col("hash"), seed)
    last = (F.col("rest") > 0) & (F.col("stop").isNull() | (place < F.col("stop")))
    return F.col("whole").cast("long") + last.cast("long")


def budgets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source",
            domain: Column | None = None, budget_ratio: float = 1.0, max_epochs: int = MAX_EPOCHS, weights=None,
            seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents' (doc_id, domain, lang, source, tokens, hash), and each leaf's whole epochs, rest and stop."""
    levels = list(LEVELS)
    rows = staged(docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in _leaf(docs, lang, source, domain).items()],
                              tokens_of(text).alias("tokens"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("hash")), "tokens")
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    shared = staged(leaf_budgets(leaves, budget_ratio, max_epochs, weights or WEIGHTS).select(
        *levels, F.col("tokens").alias("leaf_tokens"), F.floor("budget").cast("long").alias("budget"))
        .withColumn("whole", F.when(F.col("leaf_tokens") > 0, F.expr("budget div leaf_tokens")).otherwise(F.lit(0)).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("leaf_tokens")), "budgets")
    partial = shared.filter("rest > 0")
    salted = rows.withColumn("salt", F.pmod(F.hash("hash", "doc_id"), F.lit(SALTS)))
    placed = _beside(salted, partial).select(*levels, "salt", "tokens", "rest", order_key(F.col("whole"), F.col("doc_id"), F.col("hash"), seed).alias("place"))
    return rows, staged(shared.join(_ends(placed, partial), levels, "left").select(*levels, "whole", "rest", "stop"), "ends")


def plan(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """One row for each row of ``docs``: doc_id, domain, lang, source, tokens, epochs.

    ``epochs`` is how often the row is read: every whole epoch of its leaf, and
    once more if it is in the last epoch's prefix; 0 leaves it out. The prefix
    takes documents in seeded order while their tokens fit the leaf's budget;
    equal (doc_id, text) rows of a leaf have one place and go in or stay out
    together. Null languages, sources and domains are nodes named "". Rows
    without tokens cost nothing and are read like their neighbours in the
    order; a leaf without any token isn't read. An empty table gives an empty
    one. Options are those of ``budgets``.
    """
    rows, ends = budgets(docs, seed=seed, **options)
    return rows.join(ends, list(LEVELS)).select("doc_id", *LEVELS, "tokens", _epochs(seed).alias("epochs"))


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source",
          domain: Column | None = None, seed: str = SEED, **options) -> DataFrame:
    """``docs`` with every row as often as its epochs; columns unchanged.

    Texts meet a table of one row for each leaf, which Spark broadcasts if it
    is small; they aren't shuffled by document.
    """
    _, ends = budgets(docs, text, doc_id, lang, source, domain, seed=seed, **options)
    leaf = _leaf(docs, lang, source, domain)
    row = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("hash"),
                      *[c.alias(n) for n, c in leaf.items()])
    often = row.join(ends, list(LEVELS)).withColumn("epochs", _epochs(seed)).filter("epochs > 0")
    return often.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("epochs")))).select("row.*")


def report(planned: DataFrame) -> DataFrame:
    """Tokens there and tokens read for each leaf."""
    return planned.groupBy(*LEVELS).agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"),
                                        F.sum(F.col("tokens") * F.col("epochs")).alias("read"))
