"""Mixing sources to target weights by budgets that flow down a tree.

Levels (domain, language, source) form a tree; each node has an integer weight
among its siblings. The root's budget of tokens is divided among the children
of a node by weight, no child getting more than it can supply in ``max_epochs``
passes. What a child cannot take goes to its siblings by weight; only what a
whole family cannot take reaches the parent's siblings, since a node's supply is
the sum of its leaves'. All arithmetic is in whole tokens: shares are rounded
down and the remainder goes one by one to the first children that have room.

A leaf reads its documents in seeded order, anew for each epoch, until its
budget is used: full epochs whole, then the documents that begin within the
rest. The order is that of a hash, so a leaf is cut into hash slices of bounded
size whose totals are added up; no leaf is gathered in one task.

Defined cases: null names of a level are the name ''; a null text has no tokens
and is taken with the documents around it; null ids share one place in the
order; repeated rows are read one after the other; leaves below a weight of 0 or
null supply nothing; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.length_buckets import word_length
from gridloom.sources.scratch import materialise

SEED = 11
MAX_EPOCHS = 2
#: The budget is this percentage of the tokens there are.
BUDGET_PERCENT = 90
ROWS_PER_SLICE = 2_048

DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 2}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
OTHER_WEIGHT = 1


def weight_of(name: Column, weights: dict[str, int], other: int = OTHER_WEIGHT) -> Column:
    value = F.lit(other)
    for key, weight in weights.items():
        value = F.when(name == key, F.lit(weight)).otherwise(value)
    return value.cast("long")


def divide(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``got`` to rows (parent columns, name, supply, weight, budget of the parent).

    In order of supply / weight the satisfied children come first: a child is one
    if its weight's share of what the earlier ones leave is at least its supply.
    """
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).otherwise(F.lit(1e300))
    ranked = children.withColumn("ratio", ratio)
    order = Window.partitionBy(*parent).orderBy("ratio", name) if parent else Window.partitionBy(F.lit(0)).orderBy("ratio", name)
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up = order.rowsBetween(Window.unboundedPreceding, -1)
    on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.withColumns({"taken": F.coalesce(F.sum("supply").over(up), F.lit(0)), "open": F.sum("weight").over(on)})
    full = (F.col("weight") > 0) & (F.col("supply") * F.col("open") <= (F.col("budget") - F.col("taken")) * F.col("weight"))
    ranked = ranked.withColumn("full", full)
    ranked = ranked.withColumns(
        {
            "kept": F.col("budget") - F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(family),
            "rest": F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(family),
        }
    )
    share = F.expr("CASE WHEN full THEN supply WHEN rest > 0 THEN (kept * weight) div rest ELSE 0 END")
    ranked = ranked.withColumn("share", share)
    room = (F.col("share") < F.col("supply")) & (F.col("weight") > 0)
    ranked = ranked.withColumns(
        {
            "left": F.col("budget") - F.sum("share").over(family),
            "turn": F.sum(F.when(room, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    got = F.col("share") + F.when(room & (F.col("turn") <= F.col("left")), 1).otherwise(0)
    return ranked.withColumn("got", got.cast("long")).select(*parent, name, "got")


def leaf_budgets(leaves: DataFrame, levels: list[str], budget: int) -> DataFrame:
    """(levels, tokens, got) from (levels, tokens, supply, one weight column ``w_<level>`` per level).

    One row per leaf: as many as there are sources, not documents.
    """
    can = F.lit(True)
    for level in levels:
        can = can & (F.coalesce(f"w_{level}", F.lit(0)) > 0)
    leaves = leaves.withColumn("supply", F.when(can, F.col("supply")).otherwise(0))
    held = None
    for depth, level in enumerate(levels):
        parent = levels[:depth]
        nodes = leaves.groupBy(*levels[: depth + 1]).agg(F.sum("supply").cast("long").alias("supply"), F.max(f"w_{level}").alias("weight"))
        nodes = nodes.withColumn("weight", F.coalesce("weight", F.lit(0)))
        if held is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(held.withColumnRenamed("got", "budget"), parent)
        held = materialise(divide(nodes, parent, level))
    return leaves.select(*levels, "tokens").join(held, levels)


def mix(
    documents: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    budget: int | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    length: Column | None = None,
) -> tuple[DataFrame, str]:
    """The rows of ``documents`` that are read, once per epoch, with a struct column; also that column's name.

    ``levels`` are the name columns from the root down. The struct holds the
    names, n_tokens, the epoch from 0 and the leaf's budget.
    """
    held = "mix"
    while held in documents.columns:
        held += "_"
    names = list(levels)
    length = word_length(F.col("text")) if length is None else length
    own = F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()], length.alias("n_tokens"))
    keyed = documents.withColumn(held, own)
    leaves = keyed.select(f"{held}.*").groupBy(*names).agg(F.sum("n_tokens").cast("long").alias("tokens"), F.count("*").alias("rows"))
    leaves = materialise(
        leaves.withColumn("supply", F.col("tokens") * max_epochs).withColumns({f"w_{n}": weight_of(F.col(n), weights.get(n, {})) for n in names})
    )
    total = leaves.agg(F.sum("tokens").alias("t"), F.sum("rows").alias("r")).first()
    tokens, rows = total["t"] or 0, total["r"] or 0
    budget = min(tokens * BUDGET_PERCENT // 100 if budget is None else budget, tokens * max_epochs)
    given = leaf_budgets(leaves, names, budget).withColumn("whole", F.expr("CASE WHEN tokens > 0 THEN got div tokens ELSE 0 END"))
    given = materialise(given.withColumn("part", F.expr("got - whole * tokens")).drop("tokens"))

    digits = max(1, math.ceil(math.log(max(rows, 1) / ROWS_PER_SLICE, 16)))
    leaf = F.struct(*[F.col(n) for n in names]).alias("__leaf")
    by_leaf = given.select(leaf, F.struct("got", "whole", "part").alias("__given"))
    keyed = keyed.withColumn("__leaf", F.struct(*[F.col(held)[n].alias(n) for n in names]))
    placed = keyed.join(by_leaf, "__leaf")
    order = F.md5(
        F.concat_ws(":", F.lit(str(seed)), F.col("__given.whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    )
    placed = placed.withColumn("__order", order).withColumn("__slice", F.substring("__order", 1, digits))
    size = F.col(held)["n_tokens"]
    totals = placed.groupBy("__leaf", "__slice").agg(F.sum(size).alias("n"))
    earlier = Window.partitionBy("__leaf").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(totals.select("__leaf", "__slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start")))
    inside = Window.partitionBy("__leaf", "__slice").orderBy("__order", "doc_id", size).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("__within", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(starts, ["__leaf", "__slice"])
    last = F.when(F.col("__start") + F.col("__within") < F.col("__given.part"), F.col("__given.whole")).otherwise(F.col("__given.whole") - 1)
    read = placed.withColumn("__last", last.cast("int")).filter("__last >= 0")
    read = read.withColumn("__epoch", F.explode(F.sequence(F.lit(0), "__last")))
    full = F.struct(f"{held}.*", F.col("__epoch").cast("long").alias("epoch"), F.col("__given.got").alias("budget"))
    return read.select(*documents.columns, full.alias(held)), held


def domain_of(source: Column) -> Column:
    """The supplied sources are numbered; five neighbours form a domain, any other source is in 'other'."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "^src([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("other")).otherwise(F.concat(F.lit("d"), F.floor(number.try_cast("int") / 5).cast("string")))


TREE_WEIGHTS = {"domain": DOMAIN_WEIGHTS, "language": LANGUAGE_WEIGHTS}


def mix_documents(documents: DataFrame, **settings) -> tuple[DataFrame, str]:
    """``mix`` over domain, language and source of the supplied documents."""
    levels = {"domain": domain_of(F.col("source")), "language": F.col("lang"), "source": F.col("source")}
    return mix(documents, levels, TREE_WEIGHTS, **settings)
