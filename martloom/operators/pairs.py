"""Pairs of members that share a group and lie close together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.geo import haversine_km, neighbour_cells, sphere_cell, usable_position
from martloom.operators.sets import unordered_pairs
from martloom.session import materialise

# Members of one cell, or (group, cell), before it is cut into blocks.
ROWS_PER_SPLIT = 20_000


def close_pairs(
    members: DataFrame,
    group: Sequence[str],
    member: str,
    km: float,
    lat: str = "lat",
    lon: str = "lon",
    carry: Sequence[str] = (),
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Distinct pairs ``(<member>_left, <member>_right)``, smaller id first, that share a group and lie
    within ``km``; ``carry`` columns come along for both sides.

    The distance is part of the join: members meet only inside neighbouring cells of a sphere grid,
    never across a whole group. One side is copied to half of its neighbourhood, so every pair of cells
    is met once, and a pair of members in one cell alone. Where the members of a cell are as one crowd, their groups together making as many pairs as
    the cell or more, each is one row with its groups, and a pair is found once and told by the groups it shares: nothing is moved to tell repeated pairs.
    In other cells members meet by group, and pairs that share several are made distinct. A crowded cell, or (group, cell), is cut into k x k blocks:
    a member of the left side has one of k rows by its hash and is
    copied to all columns, one of the right side has a column and is copied to all rows, so each pair meets in one block, the
    pairs of a hot cell are spread over tasks, and the copies of a member grow as the root of the cell's size.
    The placed members are written once, as the branches of the plan read them.
    """
    own = list(dict.fromkeys((member, lat, lon, *carry)))
    known = [F.col(c).isNotNull() for c in (*group, member)]
    rows = members.select(*dict.fromkeys((*group, *own))).where(reduce(Column.__and__, known, usable_position(F.col(lat), F.col(lon)))).dropDuplicates([*group, member])
    name = F.col(group[0]) if len(group) == 1 else F.struct(*group)
    named = rows.select(name.alias("_group"), *[F.col(c).alias(f"m{i}") for i, c in enumerate(own)])
    folded = named.groupBy(*[f"m{i}" for i in range(len(own))]).agg(F.collect_list("_group").alias("_groups")).withColumnsRenamed({f"m{i}": c for i, c in enumerate(own)})
    placed = materialise(folded.withColumn("_cell", sphere_cell(F.col(lat), F.col(lon), km)), "members")

    by_group = placed.select("_cell", F.explode("_groups").alias("_group")).groupBy("_cell", "_group").agg(F.count("*").alias("_n"))
    inside = by_group.groupBy("_cell").agg(F.sum(F.col("_n") * F.col("_n")).alias("_inside"))
    sizes = placed.groupBy("_cell").agg(F.count("*").alias("_n")).join(inside, "_cell")
    cells = materialise(sizes.select("_cell", "_n", (F.col("_n") * F.col("_n") <= F.col("_inside")).alias("_whole")), "cells")
    kinds = {r[0] for r in cells.select("_whole").distinct().collect()}  # at most two
    near = (
        placed.withColumn("_near", F.explode(neighbour_cells(F.col("_cell"), km, half=True)))
        .withColumn("_own", F.col("_near.own"))
        .withColumn("_cell", F.struct("_near.x", "_near.y", "_near.z"))
        .drop("_near")
    )
    splits = F.ceil(F.sqrt(F.col("_n") / F.lit(rows_per_split))).cast("int")
    one, every = F.pmod(F.xxhash64(member), F.col("_splits")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))

    def met(left: DataFrame, right: DataFrame, at: list[str], shared: Column | None = None) -> DataFrame:
        """Pairs of the two sides that meet in a block; both have ``_splits``, the rows and columns their place is cut into."""
        extra = [] if shared is None else ["_groups"]
        left = left.withColumn("_row", one).withColumn("_column", every)
        right = right.withColumn("_column", one).withColumn("_row", every)
        a = left.select(*at, "_row", "_column", *[F.col(c).alias("a_" + c) for c in (*own, *extra)])
        b = right.select(*at, "_row", "_column", "_own", *[F.col(c).alias("b_" + c) for c in (*own, *extra)])
        distance = haversine_km(F.col("a_" + lat), F.col("a_" + lon), F.col("b_" + lat), F.col("b_" + lon))
        once = (F.col("a_" + member) != F.col("b_" + member)) & (~F.col("_own") | (F.col("a_" + member) < F.col("b_" + member)))
        found = once & (distance <= km)
        # Written members are some bytes a row in their files and hundreds in memory: going by the files, the planner would send one side to
        # every task through the driver.
        both = a.join(b.hint("merge"), [*at, "_row", "_column"]).where(found if shared is None else found & shared)
        a_first = F.col("a_" + member) < F.col("b_" + member)
        sides = []
        for c in dict.fromkeys((member, *carry)):
            low, high = F.col("a_" + c), F.col("b_" + c)
            sides.append(F.when(a_first, low).otherwise(high).alias(c + "_left"))
            sides.append(F.when(a_first, high).otherwise(low).alias(c + "_right"))
        return both.select(*sides)

    def crowds() -> DataFrame:
        crowd = cells.where("_whole").select("_cell", splits.alias("_splits"))
        return met(placed.join(crowd, "_cell"), near.join(crowd, "_cell"), ["_cell"], F.arrays_overlap("a__groups", "b__groups"))

    def parted() -> DataFrame:
        rest = cells.where("not _whole").select("_cell")
        crowded = by_group.where(F.col("_n") > rows_per_split).select("_cell", "_group", splits.alias("_cut"))

        def listed(side: DataFrame) -> DataFrame:
            listed = side.join(rest, "_cell").withColumn("_group", F.explode("_groups")).drop("_groups")
            return listed.join(crowded, ["_cell", "_group"], "left").withColumn("_splits", F.coalesce("_cut", F.lit(1))).drop("_cut")

        return met(listed(placed), listed(near), ["_cell", "_group"]).dropDuplicates(ends)

    ends = [member + "_left", member + "_right"]
    found = [branch() for whole, branch in ((True, crowds), (False, parted)) if whole in kinds or (whole and not kinds)]
    pairs = reduce(DataFrame.unionByName, found)
    # A member of several positions may meet another more than once.
    several = placed.groupBy(member).count().where("count > 1")
    return pairs if several.isEmpty() else pairs.dropDuplicates(ends)


def exclude_pairs(pairs: DataFrame, known: DataFrame, left: str, right: str) -> DataFrame:
    """Drop the pairs listed in ``known`` in either direction; ``pairs`` holds the smaller id first."""
    normal = unordered_pairs(known, left, right)
    return pairs.join(normal, [left, right], "left_anti")
