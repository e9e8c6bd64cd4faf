"""Shards of even size that keep equal texts together, by balanced label propagation.

Documents with equal texts are linked through their group, so a group of n
copies has n links and no pairs. Documents of one group that began in one shard
are interchangeable and travel as one cell, so a group has at most as many
cells as there are shards, however many rows it has.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headingflow.llm.storage import drop, written
from headingflow.operators.numbering import number_rows

SHARDS = 24
#: Bits of the hash in a cell's key, below its priority, and how many of them each finer cut adds.
_HASH_BITS, _STEP_BITS = 50, 10
#: Cells that a shard passes over in a round, at most; those behind wait for the next.
_PASSED_OVER = 64


def _picked(values: list[int], index: Column) -> Column:
    """``values[index]``; as many values as there are shards."""
    return F.array(*[F.lit(v).cast("long") for v in values])[index]


def _loads(cells: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _limits(wishes: DataFrame, room: list[int]) -> tuple[list[int], list[list[int]]]:
    """For each shard the key below which cells go there, and the keys below it that do not.

    Cells are taken in order of their keys while they fit, and one that does not
    is passed over. Keys are counted in classes, and the class in which the room
    ends in finer ones. One row for each target and class reaches the driver,
    which the numbers of shards and classes bound.
    """
    shards = len(room)
    left, limits, passed = list(room), [0] * shards, [[] for _ in room]
    part = wishes
    for shift in range(_HASH_BITS - _STEP_BITS, -1, -_STEP_BITS):
        asked = part.groupBy("target", F.shiftright("key", shift).alias("class"))
        sums = asked.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells"), F.min("key").alias("key"))
        found = sums.orderBy("target", "class").toArrow()
        cut, closed = [-1] * shards, set()
        for target, number, n, cells, key in zip(*(c.to_pylist() for c in found.columns), strict=True):
            if target in closed:
                continue
            if n <= left[target]:
                left[target] -= n
                limits[target] = number + 1 << shift
            elif cells == 1 and len(passed[target]) < _PASSED_OVER:
                passed[target].append(key)
            else:
                closed.add(target)
                cut[target] = number if cells > 1 else -1
        if max(cut) < 0:
            break
        part = wishes.filter(F.shiftright("key", shift) == _picked(cut, F.col("target")))
    return limits, passed


def propagate(cells: DataFrame, shards: int, quota: int) -> tuple[DataFrame, str]:
    """Move the cells ``grp, origin, shard, n`` towards the shards of their groups.

    In each round a cell wishes to go where most of its group is, if the shard
    has room for it and holds more of the group than its own, or as much and has
    a smaller number. A shard takes the cells with the largest groups first and
    passes over those that do not fit, so no shard exceeds ``quota`` by a move.

    Ends when no cell moves. It does end: the moves of a round all lead up one
    order of the group's shards, so the sum of the squared totals of all groups
    in all shards, a whole number with a bound, grows in each. Returns the table
    and its path.
    """
    spark = cells.sparkSession
    cells, path = written(cells, "cells")
    while True:
        room = [max(0, quota - load) for load in _loads(cells, shards)]
        there = cells.groupBy("grp", "shard").agg(F.sum("n").alias("total"))
        # At most one entry for each shard, the best first.
        entries = F.collect_list(F.struct("total", (-F.col("shard")).alias("minus")))
        spread = there.groupBy("grp").agg(F.sort_array(entries, asc=False).alias("spread"))
        seen = cells.join(spread, "grp").withColumn(
            "own", F.filter("spread", lambda x: x["minus"] == -F.col("shard"))[0]
        )
        better = F.filter("spread", lambda x: (x > F.col("own")) & (_picked(room, -x["minus"]) >= F.col("n")))
        wishes = seen.withColumn("_best", F.get(better, 0)).withColumns(
            {
                "target": -F.col("_best.minus"),
                "key": F.shiftleft(63 - F.floor(F.log2("_best.total")), _HASH_BITS)
                + F.xxhash64("grp", "origin").bitwiseAND(F.lit((1 << _HASH_BITS) - 1)),
            }
        )
        wishes, wishes_path = written(wishes.select("grp", "origin", "shard", "n", "target", "key"), "wishes")
        limits, passed = _limits(wishes.filter("target is not null"), room)
        if not any(limits):
            drop(spark, wishes_path)
            return cells, path
        stays = F.array(*[F.array(*map(F.lit, keys)).cast("array<long>") for keys in passed])[F.col("target")]
        below = F.col("key") < _picked(limits, F.col("target"))
        goes = F.col("target").isNotNull() & below & ~F.array_contains(stays, F.col("key"))
        moved = wishes.withColumn("shard", F.when(goes, F.col("target")).otherwise(F.col("shard")))
        cells, new_path = written(moved.select("grp", "origin", "shard", "n"), "cells")
        drop(spark, path, wishes_path)
        path = new_path


def assign_shards(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = SHARDS,
) -> DataFrame:
    """``id_column, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    The law is ``rows``: the counts of two shards differ by one at most, and the
    first shards have the odd rows. ``slot`` numbers the rows of a shard from 0
    without gaps. ``size`` is the text in UTF-8 bytes plus 8.

    Linked rows move by label propagation within the quotas until none moves; rows without a copy
    go where they fall by the hash of their id, and at the end the rows above a
    quota, those without a copy first, fill the shards below theirs. A group
    larger than a shard fills as few shards as its cells allow.

    A NULL text counts as empty, so NULL and empty texts are equal; a NULL id is
    hashed like any other, and repeated rows are rows of their own. An empty
    table gives an empty result. Other columns are neither read nor returned.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = df.select(
        F.col(id_column).alias("_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("grp"),
        F.monotonically_increasing_id().alias("_row"),
    )
    base, base_path = written(
        rows.withColumn("origin", F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int")), "rows"
    )
    total = base.count()
    if not total:
        return _named(base.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}), id_column)

    counted = base.groupBy("grp", "origin").agg(F.count(F.lit(1)).alias("n"))
    groups = counted.groupBy("grp").agg(F.sum("n").alias("_rows")).filter("_rows > 1").drop("_rows")
    cells = counted.join(groups, "grp").withColumn("shard", F.col("origin"))
    moved, moved_path = propagate(cells.select("grp", "origin", "shard", "n"), shards, total // shards)

    goal = moved.select("grp", "origin", F.col("shard").alias("_goal"))
    placed = base.join(goal, ["grp", "origin"], "left").select(
        "_id", "size", "text_crc32", "_row",
        F.coalesce("_goal", "origin").alias("shard"),
        F.col("_goal").isNull().alias("_alone"),
    )
    # In each shard the linked rows come first, then the others.
    order = [F.col(c) for c in ("shard", "_alone", "_row")]
    ranked = number_rows(placed, order, "_rank", start=0)
    settled = _settled(ranked, total, shards)
    drop(spark, moved_path, base_path)
    return _named(settled, id_column)


def _settled(ranked: DataFrame, total: int, shards: int) -> DataFrame:
    """Shards and slots from global ranks in order of the shard, surplus rows moved to where rows lack."""
    counts = {r["shard"]: r["n"] for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = [counts.get(s, 0) for s in range(shards)]
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    surplus = [max(0, h - q) for h, q in zip(held, quota, strict=True)]
    lack = [max(0, q - h) for h, q in zip(held, quota, strict=True)]

    def before(values: list[int]) -> list[int]:
        return [sum(values[:s]) for s in range(shards)]

    shard = F.col("shard")
    slot = F.col("_rank") - _picked(before(held), shard)
    # The surplus rows of all shards form one line, the lacking places another.
    place = _picked(before(surplus), shard) + slot - _picked(quota, shard)
    ranked = ranked.withColumns({"_slot": slot, "_place": F.when(slot >= _picked(quota, shard), place)})
    starts = before(lack)
    goal = F.lit(None).cast("int")
    for s in range(shards):
        inside = (F.col("_place") >= starts[s]) & (F.col("_place") < starts[s] + lack[s])
        goal = F.when(inside, s).otherwise(goal)
    ranked = ranked.withColumn("_to", goal)
    return ranked.withColumns(
        {
            "shard": F.coalesce("_to", "shard"),
            "slot": F.when(
                F.col("_to").isNotNull(),
                _picked([min(h, q) for h, q in zip(held, quota, strict=True)], F.col("_to"))
                + F.col("_place")
                - _picked(starts, F.col("_to")),
            ).otherwise(F.col("_slot")),
        }
    )


def _named(rows: DataFrame, id_column: str) -> DataFrame:
    return rows.select(
        F.col("_id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
