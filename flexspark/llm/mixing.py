"""Mixing sources to target weights: budgets down a tree of levels, then a token prefix of seeded epochs for every leaf.

DataFrame functions only. A leaf's capacity is its tokens times ``max_epochs``; a node's is the sum of its leaves'. From the root
down, a node's budget is shared among its children by weight; a child that cannot take its share takes its capacity and
the rest goes to its siblings. A node never gets more than its capacity, so a shortage leaves a subtree, and reaches the
node's own siblings, only when everything below is exhausted.

A leaf's stream is epoch 0, 1, ... of its documents, each in a seeded random order; it delivers the longest prefix whose
tokens fit the leaf's budget. Whole epochs need no ordering; only the last, partial one does, and of it only the one hash range
in which it ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flexspark.sources.scratch import stage

BUCKETS = 1024
BROADCAST_LEAVES = 100_000


def share(children: DataFrame, parent: Sequence[str], weight: str, capacity: str, budget: str) -> DataFrame:
    """Add ``__got``: each child's part of its parent's ``budget``, whole tokens, never above ``capacity``.

    Children are taken in order of capacity / weight; one is exhausted if its capacity is at most its share of what
    the earlier ones left. All others share the rest by weight, rounded down. A child of weight 0 or less gets nothing.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.try_divide(F.col(capacity), F.col(weight)).asc_nulls_last(), *[F.col(c) for c in children.columns if c.startswith("__l")])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    live = children.withColumn(capacity, F.when(F.col(weight) > 0, F.col(capacity)).otherwise(0).cast("long")).withColumn(weight, F.greatest(F.col(weight), F.lit(0)).cast("long"))
    live = live.withColumns(
        {
            "__left": F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0)),
            "__wleft": F.sum(weight).over(by) - F.coalesce(F.sum(weight).over(before), F.lit(0)),
        }
    ).withColumn("__full", (F.col(weight) > 0) & (F.col(capacity).cast(wide) * F.col("__wleft").cast("decimal(18,0)") <= F.col("__left").cast(wide) * F.col(weight).cast("decimal(18,0)")))
    live = live.withColumns(
        {
            "__rest": F.col(budget) - F.coalesce(F.sum(F.when(F.col("__full"), F.col(capacity))).over(by), F.lit(0)),
            "__wrest": F.sum(F.when(~F.col("__full"), F.col(weight))).over(by),
        }
    )
    part = F.floor(F.col("__rest").cast(wide) * F.col(weight).cast("decimal(18,0)") / F.when(F.col("__wrest") > 0, F.col("__wrest")).cast("decimal(18,0)")).cast("long")
    got = F.when(F.col("__full"), F.col(capacity)).otherwise(F.least(F.col(capacity), F.coalesce(part, F.lit(0))))
    return live.withColumn("__got", F.greatest(got, F.lit(0))).drop("__left", "__wleft", "__full", "__rest", "__wrest")


def leaf_budgets(leaves: DataFrame, weights: Sequence[Column], budget: Column, max_epochs: int) -> DataFrame:
    """Budget of each leaf. ``leaves``: columns ``__l0`` .. ``__l{k-1}`` and ``__supply`` (tokens); ``weights``: one per level."""
    k = len(weights)
    names = [f"__l{i}" for i in range(k)]
    table = leaves.withColumn("__cap", F.col("__supply") * max_epochs).withColumn("__budget", budget)
    for i in range(k):
        node = table.groupBy(*names[: i + 1]).agg(F.sum("__cap").alias("__c"), F.max("__budget").alias("__b"))
        node = node.withColumn("__w", weights[i].cast("long"))
        node = share(node, names[:i], "__w", "__c", "__b").select(*[F.col(c).alias(f"__n{c}") for c in names[: i + 1]], "__got")
        on = [F.col(c).eqNullSafe(F.col(f"__n{c}")) for c in names[: i + 1]]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        table = table.join(node, cond).withColumn("__budget", F.col("__got")).drop("__got", *[f"__n{c}" for c in names[: i + 1]])
    return table.drop("__cap")


def order_hash(key: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit(""))))


def mix(
    df: DataFrame,
    levels: Sequence[Column],
    weights: Sequence[Column],
    tokens: Column,
    key: Column,
    ties: Sequence[Column],
    budget_share: float = 0.5,
    max_epochs: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Rows of the mixture, with ``epoch`` (int, from 0) added: a row comes once for every epoch that takes it.

    ``levels``: the tree, outermost first; ``weights``: a level's weight as a Column over ``__l0`` .. of the levels down to it, taken as
    whole numbers. The budget is ``budget_share`` of all tokens. Null levels are nodes of their own. Rows without
    tokens come with every whole epoch, and with a partial one while they stand before its end. Rows equal in key
    and ties are interchangeable. An empty table, or a budget of 0, gives no rows. Other columns, also those named like a
    level, pass through; a column ``epoch`` is replaced.
    """
    k = len(levels)
    names = [f"__l{i}" for i in range(k)]
    spread = "__mx_bucket"
    rows = df.withColumns({**dict(zip(names, levels)), "__mx_tokens": tokens.cast("long")})
    supply = stage(rows.groupBy(*names).agg(F.sum("__mx_tokens").alias("__supply")), "mixsupply")
    total = supply.agg(F.coalesce(F.sum("__supply"), F.lit(0)).alias("t")).first()["t"]
    budgets = leaf_budgets(supply, weights, F.lit(int(total * budget_share)).cast("long"), max_epochs)
    plan = budgets.select(
        *names,
        F.when(F.col("__supply") > 0, F.expr("`__budget` div `__supply`")).otherwise(0).cast("int").alias("__mx_whole"),
        F.when(F.col("__supply") > 0, F.col("__budget") % F.col("__supply")).otherwise(0).alias("__mx_left"),
    )
    plan = stage(plan, "mixplan")
    few = plan.count() <= BROADCAST_LEAVES
    tagged = _on_leaf(rows, plan, names, few).withColumn("__mx_hash", order_hash(key, F.col("__mx_whole"), seed))
    tagged = tagged.withColumn(spread, F.shiftright(F.conv(F.substring("__mx_hash", 1, 8), 16, 10).cast("long"), 32 - (BUCKETS - 1).bit_length()).cast("int"))
    # tokens of each hash range of the partial epoch, and the range in which the budget ends
    parts = tagged.where("__mx_left > 0").groupBy(*names, spread).agg(F.sum("__mx_tokens").alias("__t"), F.max("__mx_left").alias("__room"))
    upto = F.sum("__t").over(Window.partitionBy(*names).orderBy(spread))
    parts = parts.withColumn("__upto", upto).where("`__upto` > `__room`")
    ends = parts.groupBy(*names).agg(F.min(F.struct(spread, (F.col("__upto") - F.col("__t")).alias("before"))).alias("__end"))
    ends = plan.join(ends.select(*[F.col(c).alias(f"__n{c}") for c in names], "__end"), _same(names), "left")
    ends = stage(ends.select(*names, "__mx_whole", "__mx_left", F.col(f"__end.{spread}").alias("__mx_at"), F.col("__end.before").alias("__mx_before")), "mixends")
    tagged = _on_leaf(rows, ends, names, few).withColumn("__mx_hash", order_hash(key, F.col("__mx_whole"), seed))
    tagged = tagged.withColumn(spread, F.shiftright(F.conv(F.substring("__mx_hash", 1, 8), 16, 10).cast("long"), 32 - (BUCKETS - 1).bit_length()).cast("int"))
    drop = [*names, "__mx_tokens", "__mx_whole", "__mx_left", "__mx_at", "__mx_before", "__mx_hash", spread]
    partial = (F.col("__mx_left") > 0) & (F.col("__mx_at").isNull() | (F.col(spread) < F.col("__mx_at")))
    last = F.when(partial, F.col("__mx_whole")).otherwise(F.col("__mx_whole") - 1)
    sure = tagged.where(last >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    edge = tagged.where((F.col("__mx_left") > 0) & (F.col(spread) == F.col("__mx_at")))
    running = F.sum("__mx_tokens").over(Window.partitionBy(*names).orderBy("__mx_hash", key, *ties).rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("__mx_sum", F.col("__mx_before") + running).where("`__mx_sum` <= `__mx_left`").withColumn("epoch", F.col("__mx_whole"))
    return sure.drop(*drop).unionByName(edge.drop("__mx_sum", *drop))


def _same(names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__n{c}"))
    return cond


def _on_leaf(rows: DataFrame, plan: DataFrame, names: Sequence[str], few: bool) -> DataFrame:
    """Rows with their leaf's plan. The plan is sent to all tasks if its counted leaves are few; else both sides are shuffled, where adaptive execution splits a hot leaf."""
    side = plan.select(*[F.col(c).alias(f"__n{c}") for c in names], *[c for c in plan.columns if c not in names])
    return rows.join(F.broadcast(side) if few else side, _same(names)).drop(*[f"__n{c}" for c in names])
