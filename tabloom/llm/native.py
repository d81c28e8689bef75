"""Column expressions shared by the operators that stay inside the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

WHITE_SPACE = r"[\x20\x09-\x0D]+"
WHITE_WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 1_000_000


def bound_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also where use names it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def id_blocks(ids: DataFrame, id_col: str, block_rows: int, *, least: int = 24, most: int = 1 << 16) -> Column:
    """Number of the block of consecutive ids a row belongs to, from 0; null ids are block -1.

    Blocks hold about block_rows rows, more only where there would be over `most` of them; the ids at which they end,
    one number a block, come to the driver. A row finds its block by halving the sorted list of ends.
    """
    blocks = min(most, max(least, ids.count() // block_rows + 1))
    cuts = ids.agg(F.percentile_approx(id_col, [k / blocks for k in range(1, blocks)], 100 * blocks)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(F.lit(0))
    ends = F.from_json(F.lit(json.dumps(cuts)), f"array<{ids.schema[id_col].dataType.simpleString()}>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    number = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(ends, at + step - 1) < F.col(id_col), at + step).otherwise(at))
    return F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(number)


def numbered_within(df: DataFrame, group: str, order: list[str], name: str, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Gapless numbers from 0 in each group.

    A group is numbered in blocks, dealt by the hash of the order columns, so that one group is not one task. The
    numbers follow the blocks, then the order columns.
    """
    rows = df.count()
    blocks = max(8, rows // block_rows + 1)
    parted = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sizes = parted.groupBy(group, "_block").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("_group"), F.col("_block").alias("_own"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order)) - 1
    joined = parted.withColumn("_place", place).join(offsets, (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_block") == F.col("_own")))
    return joined.withColumn(name, (F.col("_offset") + F.col("_place")).cast("long")).drop("_block", "_group", "_own", "_offset", "_place")
