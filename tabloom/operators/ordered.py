"""Global order at scale: row numbers, running totals and row windows without a single-task sort.

Rows are range-partitioned on the order keys and frozen in the shared folder. Each range block then works on
its own, and only one row per block (bounded by the partition count) is needed to link the blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabloom.session import shuffle_partitions, small_side, stash

POSITION_BITS = 33


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed: it tells rows of equal keys apart, the same way in any partitioning."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*_quoted(plain)) if plain else F.lit(0).cast("long")


def range_blocks(df: DataFrame, keys: Sequence[str | Column], *, blocks: int | None = None) -> DataFrame:
    """Freeze df in key order with _block (range number) and _pos (place inside the range).

    Rows of equal keys are in order of a hash of the row, so one key that half of all rows have fills many ranges.
    """
    order = [F.col("`" + k.replace("`", "``") + "`") if isinstance(k, str) else k for k in keys] + [F.col("_tie")]
    ranged = df.withColumn("_tie", _row_hash(df)).repartitionByRange(blocks or shuffle_partitions(df), *order).sortWithinPartitions(*order).drop("_tie")
    mark = F.monotonically_increasing_id()
    return stash(
        ranged.withColumn("_mark", mark).withColumns(
            {
                "_block": F.shiftright("_mark", POSITION_BITS).cast("int"),
                "_pos": F.col("_mark").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
            }
        )
    ).drop("_mark")


def number_rows(df: DataFrame, keys: Sequence[str | Column], *, name: str = "row_number", start: int = 0, blocks: int | None = None) -> DataFrame:
    """Consecutive numbers in key order."""
    frozen = range_blocks(df, keys, blocks=blocks)
    before = F.sum("_size").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    # One row per range block, so the table stays within the partition count.
    offsets = frozen.groupBy("_block").agg(F.count("*").alias("_size")).select("_block", F.coalesce(before, F.lit(0)).alias("_offset"))
    return (
        frozen.join(F.broadcast(offsets), "_block")
        .withColumn(name, (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("bigint"))
        .drop("_block", "_pos", "_offset")
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str | Column],
    totals: dict[str, str],
    *,
    within: Sequence[str] = (),
    carry_next: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Inclusive running sums in key order.

    totals maps a new column to the summed column; within restarts the sums per group. carry_next adds next_<col>,
    the value on the following row of the same group.
    """
    group = _quoted(within)
    frozen = range_blocks(df, [*group, *keys], blocks=blocks)
    inside = Window.partitionBy(*group, "_block").orderBy("_pos")
    summed = {n: F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for n, c in totals.items()}
    summed |= {f"next_{c}": F.lead(c).over(inside) for c in carry_next}
    if carry_next:
        summed["_last"] = F.lead("_pos").over(inside).isNull()

    # At most one row per block and group that meets it: blocks + groups - 1 rows for range-partitioned groups.
    link = Window.partitionBy(*group).orderBy("_block")
    per_block = frozen.groupBy(*group, "_block").agg(
        *(F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()),
        *(F.min_by(c, "_pos").alias(f"_first_{c}") for c in carry_next),
    )
    edges = per_block.select(
        *(g.alias(f"_g{i}") for i, g in enumerate(group)),
        F.col("_block").alias("_b"),
        *(F.coalesce(F.sum(f"_sum_{n}").over(link.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{n}") for n in totals),
        *(F.lead(f"_first_{c}").over(link).alias(f"_after_{c}") for c in carry_next),
    )
    on = F.col("_block") == F.col("_b")
    for i, g in enumerate(group):
        on = on & g.eqNullSafe(F.col(f"_g{i}"))
    joined = frozen.withColumns(summed).join(small_side(edges), on, "inner")
    final = {n: F.col(n) + F.col(f"_off_{n}") for n in totals}
    final |= {f"next_{c}": F.when(F.col("_last"), F.col(f"_after_{c}")).otherwise(F.col(f"next_{c}")) for c in carry_next}
    keep = [*_quoted(df.columns), *(F.col(n) for n in final)]
    return joined.withColumns(final).select(*keep)


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    rows: int = 200,
    min_rows: int = 20,
    name: str = "rolling_mean",
    chunk: int = 100_000,
) -> DataFrame:
    """Mean of the last `rows` rows in key order, null until min_rows values are in the window.

    Rows are cut into chunks of equal length by row number; the tail of each chunk is copied into the next one so that
    every window is complete inside one chunk.
    """
    if chunk < rows:
        raise ValueError("chunk must not be shorter than the window")
    numbered = number_rows(df, keys, name="_rn")
    home = F.floor(F.col("_rn") / chunk)
    is_tail = F.col("_rn") % chunk >= chunk - (rows - 1)
    spread = numbered.withColumn("_chunk", F.explode(F.when(is_tail, F.array(home, home + 1)).otherwise(F.array(home))))
    frame = Window.partitionBy("_chunk").orderBy("_rn").rowsBetween(-(rows - 1), 0)
    mean = F.when(F.count(value).over(frame) >= min_rows, F.avg(value).over(frame))
    return spread.withColumn(name, mean).filter(F.col("_chunk") == home).drop("_chunk", "_rn")
