"""Table helpers: update-from-join, dense numbering, and joins that expand their input."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deadhead.config import TUNING, Tuning
from deadhead.storage import materialize


def fill_from(df: DataFrame, lookup: DataFrame, keys: list[str], target: str, *sources: str) -> DataFrame:
    """Fill NULLs of ``target`` by the first non-NULL of ``sources`` of the matching ``lookup`` row.

    ``lookup`` holds at most one row per key, so no row of ``df`` is multiplied; NULL keys match nothing.
    """
    columns = df.columns
    joined = df.join(lookup, keys, "left")
    filled = F.coalesce(F.col(target), *[F.col(c) for c in sources])
    return joined.withColumn(target, filled).select(*columns)


def dense_id(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number rows 1..n in the order of ``keys`` without a single-task sort.

    Rows are range-partitioned and sorted by ``keys``; ``monotonically_increasing_id`` then holds the
    partition in its high bits and the place within it in its low 33 bits. The result is written before the
    partition sizes are counted, since the sampled range bounds need not repeat on a second evaluation.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), f"ids-{name}")
    placed = placed.withColumn("_part", F.shiftrightunsigned("_place", 33)).withColumn(
        "_row", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # one row per shuffle partition, bounded by the partition count whatever the data size: sent to the rows,
    # so that these are not shuffled a second time
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row") + 1)
        .drop("_place", "_part", "_row", "_start")
    )


def _tasks_for(spark: SparkSession, rows: float, tuning: Tuning) -> int:
    """Tasks for an output of ``rows``; 1 leaves the partitioning to the engine."""
    tasks = min(tuning.max_tasks, math.ceil(rows / tuning.pairs_per_task))
    return max(tasks, spark.sparkContext.defaultParallelism) if tasks > 1 else 1


def grid(n_left: int, n_right: int, tasks: int) -> tuple[int, int]:
    """Blocks of the two sides of a product whose cells are about square, several cells for each task."""
    side = math.sqrt(float(n_left) * n_right / (8 * tasks)) if tasks > 1 else float("inf")
    return max(1, math.ceil(n_left / max(side, 1.0))), max(1, math.ceil(n_right / max(side, 1.0)))


def all_pairs(left: DataFrame, right: DataFrame, tuning: Tuning = TUNING) -> DataFrame:
    """Every row of one list with every row of another, cut into tasks by the size of the result.

    The product is an equi-join on the cells of a grid: each row of a list is in one block of its own side and is
    repeated for the blocks of the other. Both sides are cut so that a cell is about square, so the rows repeated
    grow with the square root of the result's size for each task, not with the result.
    """
    n_left, n_right = left.count(), right.count()
    tasks = _tasks_for(left.sparkSession, float(n_left) * n_right, tuning)
    columns = [*left.columns, *right.columns]
    cuts = grid(n_left, n_right, tasks)

    def placed(df: DataFrame, own: str, own_cuts: int, other: str, other_cuts: int) -> DataFrame:
        cell = F.pmod(F.xxhash64(*df.columns), F.lit(own_cuts)).cast("int")
        df = df.withColumn(own, cell).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_cuts - 1))))
        # both sides: if one is broadcast, the other still has this many tasks
        return df.repartition(tasks, "_i", "_j") if tasks > 1 else df

    one = placed(left, "_i", cuts[0], "_j", cuts[1])
    two = placed(right, "_j", cuts[1], "_i", cuts[0])
    return one.join(two, ["_i", "_j"]).select(*columns)


def look_up_slots(rows: DataFrame, slots: list[list[str]], lookup: DataFrame, keys: list[str], names: list[dict[str, str]]) -> DataFrame:
    """Left joins of ``rows`` with one ``lookup`` for several slots, by a single join.

    A slot is a list of columns that meet the lookup's ``keys``; ``names`` has for each slot which columns of the lookup it
    adds under what name. Slots with a NULL key take no part in the join. Several matches of a slot multiply the row, and
    those of different slots each other, as separate joins would.
    """
    # written, so that the numbers of the rows are the same on both sides
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "slot-rows")
    every = [F.struct(F.lit(i).alias("_slot"), *[F.col(c).alias(f"_k{j}") for j, c in enumerate(own)]) for i, own in enumerate(slots)]
    match = [f"_k{j}" for j in range(len(keys))]
    asked = rows.select("_row", F.explode(F.array(*every)).alias("_ask")).select("_row", "_ask.*").dropna(subset=match)
    wanted = list(dict.fromkeys(c for own in names for c in own))
    offered = lookup.select(*[F.col(k).alias(m) for k, m in zip(keys, match)], F.struct(*wanted).alias("_found"))
    found = asked.join(offered, match).groupBy("_row")
    found = found.agg(*[F.collect_list(F.when(F.col("_slot") == i, F.col("_found"))).alias(f"_found{i}") for i in range(len(slots))])
    out = rows.join(found, "_row", "left")
    for i, own in enumerate(names):
        out = out.withColumn("_one", F.explode_outer(f"_found{i}"))
        out = out.withColumns({name: F.col("_one")[c] for c, name in own.items()}).drop("_one", f"_found{i}")
    return out.drop("_row")


def expanding_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    residual: Column | None = None,
    tuning: Tuning = TUNING,
) -> DataFrame:
    """Inner equi-join whose output is far larger than its inputs.

    The engine sizes tasks by input bytes and would run such a join in one task. Here the pairs per key are
    counted first (a map-side combined count on each side; only two totals reach the driver). They set the
    number of tasks, and a key with more pairs than a part of a task is cut into a grid of blocks: each row
    goes to one block of its own side and is repeated for the blocks of the other. All pairs still meet once.
    """
    lk, rk = [a for a, _ in on], [b for _, b in on]
    spark = left.sparkSession
    keys = [f"_k{i}" for i in range(len(on))]
    left_n = left.groupBy(*[F.col(c).alias(k) for c, k in zip(lk, keys)]).agg(F.count(F.lit(1)).alias("_ln"))
    right_n = right.groupBy(*[F.col(c).alias(k) for c, k in zip(rk, keys)]).agg(F.count(F.lit(1)).alias("_rn"))
    counts = left_n.join(right_n, keys)
    pairs = F.col("_ln").cast("double") * F.col("_rn")
    total, biggest = counts.agg(F.coalesce(F.sum(pairs), F.lit(0.0)), F.coalesce(F.max(pairs), F.lit(0.0))).first()
    tasks = _tasks_for(spark, total, tuning)

    condition = F.lit(True) if residual is None else residual
    # blocks are hashed to tasks: several per task even out the sizes
    block_pairs = max(1, tuning.pairs_per_task // 8)
    if biggest <= block_pairs:
        for a, b in on:
            condition = (F.col(a) == F.col(b)) & condition
        if tasks > 1:
            # both sides: if one is broadcast, the other still has this many tasks
            left, right = left.repartition(tasks, *lk), right.repartition(tasks, *rk)
        return left.join(right, condition, "inner")

    side_rows = max(1, math.isqrt(block_pairs))

    def cut(rows: str) -> Column:
        return F.when(pairs > block_pairs, F.ceil(F.col(rows) / side_rows)).otherwise(F.lit(1)).cast("int")

    blocks = counts.select(*keys, cut("_ln").alias("_lb"), cut("_rn").alias("_rb"))
    blocks = materialize(blocks, "blocks")

    def spread(side: DataFrame, names: list[str], own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        match = [F.col(c) == F.col(k) for c, k in zip(names, keys)]
        return (
            side.join(blocks, match, "inner")
            .withColumn(own, F.pmod(F.xxhash64(*side.columns), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
            .drop(*keys, "_lb", "_rb")
        )

    l2 = spread(left, lk, "_li", "_lb", "_lj", "_rb").repartition(tasks, *lk, "_li", "_lj")
    r2 = spread(right, rk, "_rj", "_rb", "_ri", "_lb").repartition(tasks, *rk, "_ri", "_rj")
    condition = (F.col("_li") == F.col("_ri")) & (F.col("_lj") == F.col("_rj")) & condition
    for a, b in on:
        condition = (F.col(a) == F.col(b)) & condition
    return l2.join(r2, condition, "inner").drop("_li", "_lj", "_ri", "_rj")
