"""Mixing sources to target weights through a tree of domains, languages and sources.

A token budget goes down the tree by the children's weights.  What a child cannot use, because
it has no more tokens than its epochs allow, goes to its siblings first, and up only when all of
them are full.  Each leaf then reads its documents in seeded orders, one per epoch: whole epochs,
and of the last one the prefix that fills its budget.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import stored

col = F.col

# Counting steps, and bits of the order that one of them resolves; a leaf has so many bins in a step.
STEPS, BITS = 3, 8


@dataclass(frozen=True)
class Mix:
    """Weights by value for each level (1 if not named), budget as a share of all tokens, epochs, seed."""

    levels: list[str]
    weights: list[dict[str, float]]
    share: float = 0.6
    epochs: int = 4
    seed: int = 17


def divided(children: DataFrame, parent: list[str]) -> DataFrame:
    """``budget`` of each ``parent`` among its children (weight, capacity), added as ``part``.

    A part goes by weight; what a child cannot take goes to the others by theirs.  In order of
    capacity per weight a child is full if it cannot take its part of what those before it leave;
    the first that is not full tells what a unit of weight gets.
    """
    takes = (col("weight") > 0) & (col("capacity") > 0)
    weight, capacity = F.when(takes, col("weight")).otherwise(0.0), F.when(takes, col("capacity")).otherwise(0.0)
    fill = F.when(takes, col("capacity") / col("weight"))
    order = Window.partitionBy(*parent).orderBy(F.asc_nulls_first("_fill"), *[c for c in children.columns if c.startswith("_l")])
    left = col("budget") - F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = children.withColumns({"_w": weight, "_c": capacity, "_fill": fill})
    unit = F.try_divide(left, F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("_unit", unit)
    full = ~takes | (col("_fill") <= col("_unit"))
    # further ones seem to get less, as the capacity of those before them counts as taken
    rows = rows.withColumn("_unit", F.max(F.when(~full, col("_unit"))).over(Window.partitionBy(*parent)))
    part = F.least(col("_c"), col("_w") * F.when(col("_unit") <= 0, 0.0).otherwise(col("_unit")))  # no unit: all are full
    return rows.withColumn("part", part).drop("_w", "_c", "_fill", "_unit")


def budgets(leaves: DataFrame, levels: list[str], mix: Mix) -> DataFrame:
    """(levels, n, budget): whole tokens to take of each leaf, given the tokens ``n`` it has.

    Leaves and the nodes above them are tables, so a tree may have any number of them; the rows
    that meet in one task are the children of one node.
    """
    # a root above the first level
    depth = len(levels)
    nodes = [None] * depth + [leaves.select("*", (col("n") * float(mix.epochs)).alias("capacity"))]
    for at in range(depth - 1, -1, -1):
        weights = [x for pair in mix.weights[at].items() for x in (F.lit(pair[0]), F.lit(float(pair[1])))]
        weight = F.coalesce(F.create_map(*weights)[col(levels[at])], F.lit(1.0)) if weights else F.lit(1.0)
        nodes[at + 1] = nodes[at + 1].withColumn("weight", weight)
        usable = F.sum(F.when(col("weight") > 0, col("capacity")).otherwise(0.0))
        nodes[at] = nodes[at + 1].groupBy(F.lit(0).alias("_root"), *levels[:at]).agg(usable.alias("capacity"), F.sum("n").alias("n"))
    budget = F.least(F.lit(mix.share) * col("n"), col("capacity"))
    above = nodes[0].select("_root", budget.alias("budget"))
    for at in range(1, depth + 1):
        parent = ["_root", *levels[: at - 1]]
        children = nodes[at].withColumn("_root", F.lit(0)).join(above, parent)
        above = divided(children, parent).select("_root", *levels[:at], "n", col("part").alias("budget"))
        above = above if at == depth else above.drop("n")
    return above.select(*levels, "n", F.floor(col("budget") + 1e-6).alias("budget"))


def _place(seed: int) -> Column:
    """Place of a row in the order of its leaf's last epoch."""
    return F.xxhash64(F.lit(seed), "_epochs", "_row")


def _bin(step: int) -> Column:
    return F.shiftrightunsigned("_place", 64 - BITS * (step + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def mixed(
    docs: DataFrame, mix: Mix, id_: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all) with ``n_tokens``, ``epochs`` (whole ones) and ``tokens_taken`` in all.

    Columns of these three names are replaced.

    Every row is returned; one that is not taken has zero.  A null level value is a leaf value of
    its own.  Rows that are the same in id, text and levels share one place in the order and take
    equal parts, rounded down, if the prefix ends among them.  Null and empty texts have no
    tokens and nothing is taken of them.  A text of any length is read once, where it lies.  An
    empty table gives an empty result.

    The order is a hash, so the end of a prefix is found by counting tokens per leaf and leading
    bits of the hash, in ``STEPS`` steps, before the few rows that are left are summed one by one.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("n_tokens", "epochs", "tokens_taken")]
    levels = [f"_l{n}" for n in range(len(mix.levels))]
    named = [F.coalesce(col(c).cast("string"), F.lit("\x00")).alias(n) for n, c in zip(levels, mix.levels)]
    row = F.xxhash64(id_, text, *mix.levels)
    rows = docs.select(F.struct(*kept).alias("kept"), *named, tokens_of(col(text)).alias("_n"), row.alias("_row"))
    own = stored(rows.groupBy(*levels, "_row", "_n").agg(F.count(F.lit(1)).alias("_c")), "token-counts")
    leaves = stored(own.groupBy(*levels).agg(F.sum(col("_n") * col("_c")).alias("n")), "leaves")
    plan = budgets(leaves, levels, mix)
    some = F.greatest(col("n"), F.lit(1))
    # a row per leaf, stored so that Spark knows how small it is, and moves no rows to it
    bounds = plan.select(*levels, F.floor(col("budget") / some).alias("_epochs"), (col("budget") % some).alias("_rest"))
    bounds = stored(bounds, "bounds")

    # where the prefix of each leaf ends: bin, bin within it, and what lies before
    rest = own.where(col("_n") > 0).join(bounds, levels).withColumn("_place", _place(mix.seed))
    for step in range(STEPS):
        rest = rest.withColumn("_bin", _bin(step))
        sums = rest.groupBy(*levels, "_rest", "_bin").agg(F.sum(col("_n") * col("_c")).alias("_t"))
        # stored, so that bins are summed over all tasks before those of a leaf meet in one
        sums = stored(sums, "bins")
        upto = F.sum("_t").over(Window.partitionBy(*levels).orderBy("_bin"))
        ends = sums.withColumn("_upto", upto).where((col("_upto") > col("_rest")) & (col("_upto") - col("_t") <= col("_rest")))
        ends = ends.select(*levels, col("_bin").alias(f"_end{step}"), (col("_rest") - col("_upto") + col("_t")).alias("_left"))
        ends = stored(ends, "ends")
        bounds = bounds.join(ends.select(*levels, f"_end{step}"), levels, "left")
        rest = rest.drop("_rest").join(ends, levels).where(col("_bin") == col(f"_end{step}"))
        rest = rest.drop("_bin", f"_end{step}").withColumnRenamed("_left", "_rest")
    in_order = Window.partitionBy(*levels).orderBy("_place", "_row", "_n").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(col("_n") * col("_c")).over(in_order), F.lit(0))
    last = rest.withColumn("_left", F.greatest(F.lit(0), F.least(col("_n") * col("_c"), col("_rest") - before)))
    last = stored(last.select(*levels, "_row", F.floor(col("_left") / col("_c")).alias("_part")), "last-rows")

    bounds = stored(bounds, "bounds")
    out = rows.join(bounds, levels).withColumn("_place", _place(mix.seed))
    out = out.join(last, [*levels, "_row"], "left")
    of_last = F.coalesce("_part", F.lit(0))
    for step in reversed(range(STEPS)):
        end = col(f"_end{step}")
        of_last = F.when(_bin(step) > end, 0).when(_bin(step) < end, col("_n")).otherwise(of_last)
    of_last = F.when(col("_rest") <= 0, 0).otherwise(of_last)
    taken = (col("_epochs") * col("_n") + of_last).cast("bigint")
    return out.select("kept.*", col("_n").alias("n_tokens"), col("_epochs").alias("epochs"), taken.alias("tokens_taken"))
