"""Exact quantiles with linear interpolation, for groups of any size.

Radix selection: the bits of a double, put in order, are read a few at a time from the top. In each pass every task
counts the next digit of the values that still share the digits found so far for some wanted rank; the sums of these
counts say in which digit each rank lies. After all bits each rank's value is known. Rows are never sorted, shuffled or
joined, a hot value is one digit count, and all ranks of all groups and columns take the same few passes.

Digits found so far are held for at most RADIX_GROUPS groups, the largest. Where there are more, each of the others has
less than a RADIX_GROUPS-th of all rows, and is ranked by a running count over its distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.session import small_side, stash

RADIX_GROUPS = 10_000
DIGIT_BITS = 16
SIGN = np.uint64(1 << 63)


def _name(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group, column name and non-null value."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), _name(c).cast("double").alias("value")) for c in cols))
    return df.select(*(_name(b) for b in by), F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), *, radix_groups: int = RADIX_GROUPS) -> DataFrame:
    """Columns: by..., column, n, q (array in the order of probs). Null and NaN are left out; a column without values has no row."""
    values = [F.when(~F.isnan(_name(c).cast("double")), _name(c).cast("double") + F.lit(0.0)).alias(f"_v{i}") for i, c in enumerate(cols)]
    mark = F.xxhash64(*(x for b in by for x in (_name(b), _name(b).isNull()))) if by else F.lit(0).cast("long")
    rows = stash(df.select(*(_name(b).alias(f"_b{i}") for i, b in enumerate(by)), mark.alias("_g"), *values))
    keys = [f"_b{i}" for i in range(len(by))]
    groups = stash(rows.groupBy(*keys, "_g").agg(*(F.count(f"_v{i}").alias(f"_n{i}") for i in range(len(cols)))))
    sizes = groups.withColumn("_size", sum((F.col(f"_n{i}") for i in range(len(cols))), F.lit(0)))
    if not by or groups.count() <= radix_groups:
        chosen, rest = sizes, None
    else:
        # Fewer than radix_groups groups can have more rows than this.
        least = sizes.agg(F.sum("_size")).first()[0] // radix_groups
        chosen, rest = sizes.filter(F.col("_size") > least), sizes.filter(F.col("_size") <= least)
    out = _selected(rows, chosen, keys, len(cols), probs)
    if rest is not None:
        out = out.unionByName(_ranked(rows, chosen.select("_g"), keys, len(cols), probs))
    names = F.array(*map(F.lit, cols))
    return out.select(*(F.col(k).alias(b) for k, b in zip(keys, by)), F.get(names, F.col("_i")).alias("column"), "n", "q")


def _place(p: float, n: int) -> float:
    return float(p) * (n - 1)


def _mixed(pos: float, low: float, high: float) -> float:
    return low if low == high else (math.ceil(pos) - pos) * low + (pos - math.floor(pos)) * high


def ordered_bits(values: np.ndarray) -> np.ndarray:
    bits = values.view(np.uint64)
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def from_ordered_bits(bits: int) -> float:
    bits = bits ^ int(SIGN) if bits & int(SIGN) else bits ^ ((1 << 64) - 1)
    return float(np.uint64(bits).view(np.float64))


def _digit_counts(rows: DataFrame, open_: dict[tuple[int, int], list[int]], width: int, known: int, bits: int) -> DataFrame:
    """(g, i, prefix, digit, times): how often each next digit follows the open prefixes, known bits long, of a group's column."""
    order = np.array(sorted({g for g, _ in open_}), dtype=np.int64)
    deep = max(map(len, open_.values()))
    tables = np.zeros((width, deep, len(order)), dtype=np.uint64)
    held = np.zeros((width, deep, len(order)), dtype=bool)
    for (g, i), prefixes in open_.items():
        at = int(np.searchsorted(order, g))
        tables[i, : len(prefixes), at], held[i, : len(prefixes), at] = np.array(prefixes, dtype=np.uint64), True
    shared = rows.sparkSession.sparkContext.broadcast((order, tables, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, tables, held = shared.value
        for batch in batches:
            mark = batch.column(0).to_numpy()
            at = np.minimum(np.searchsorted(order, mark), len(order) - 1)
            mine = order[at] == mark
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i in range(tables.shape[0]):
                column = batch.column(i + 1)
                here = np.flatnonzero(mine & column.is_valid().to_numpy(zero_copy_only=False))
                if not len(here):
                    continue
                bits_ = ordered_bits(column.fill_null(0.0).to_numpy()[here])
                own = at[here]
                head = bits_ >> np.uint64(64 - known) if known else np.zeros(len(here), dtype=np.uint64)
                digit = ((bits_ >> np.uint64(64 - known - bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                for s in range(tables.shape[1]):
                    hit = held[i, s, own] & (tables[i, s, own] == head)
                    cell, times = np.unique((own[hit] << bits) | digit[hit], return_counts=True)
                    group = cell >> bits
                    for k, x in enumerate((order[group], np.full(len(cell), i), tables[i, s, group].view(np.int64), cell & ((1 << bits) - 1), times)):
                        out[k].append(x.astype(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], names=["g", "i", "prefix", "digit", "times"])

    parts = rows.select("_g", *(f"_v{i}" for i in range(width))).mapInArrow(run, "g long, i long, prefix long, digit long, times long")
    return parts.groupBy("g", "i", "prefix", "digit").agg(F.sum("times").alias("times"))


def _selected(rows: DataFrame, groups: DataFrame, keys: list[str], width: int, probs: Sequence[float]) -> DataFrame:
    """Quantiles of the given groups, few enough for their ranks to be held by the driver."""
    known = {(r["_g"], i): r[f"_n{i}"] for r in groups.drop(*keys).collect() for i in range(width) if r[f"_n{i}"]}
    # Wanted ranks of each group's column, with the bits found so far and the rank among the values that share them.
    wanted = {(g, i, k): (0, k) for (g, i), n in known.items() for p in probs for k in {math.floor(_place(p, n)), math.ceil(_place(p, n))}}
    done = 0
    while wanted and done < 64:
        bits = min(DIGIT_BITS, 64 - done)
        open_: dict[tuple[int, int], list[int]] = {}
        for (g, i, _), (prefix, _) in wanted.items():
            if prefix not in open_.setdefault((g, i), []):
                open_[g, i].append(prefix)
        run = Window.partitionBy("g", "i", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        counts = _digit_counts(rows, open_, width, done, bits).withColumn("upto", F.sum("times").over(run))
        ranks = [(g, i, prefix - (1 << 64) if prefix >> 63 else prefix, k, at) for (g, i, k), (prefix, at) in wanted.items()]
        asked = F.broadcast(rows.sparkSession.createDataFrame(ranks, "_a long, _i long, _p long, k long, at long"))
        same = (F.col("g") == F.col("_a")) & (F.col("i") == F.col("_i")) & (F.col("prefix") == F.col("_p"))
        found = counts.join(asked, same & (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("times")))
        told = found.select("g", "i", "k", "digit", (F.col("at") - F.col("upto") + F.col("times")).alias("at")).collect()
        wanted = {(r["g"], r["i"], r["k"]): (wanted[r["g"], r["i"], r["k"]][0] << bits | r["digit"], r["at"]) for r in told}
        done += bits
    value = {at: from_ordered_bits(prefix) for at, (prefix, _) in wanted.items()}
    q = []
    for (g, i), n in known.items():
        places = [_place(p, n) for p in probs]
        q.append((g, i, n, [_mixed(x, value[g, i, math.floor(x)], value[g, i, math.ceil(x)]) for x in places]))
    told = rows.sparkSession.createDataFrame(q, "_g long, _i int, n long, q array<double>")
    if not keys:
        return told.select("_i", "n", "q")
    return groups.select(*keys, F.col("_g").alias("_own")).join(F.broadcast(told), F.col("_own") == F.col("_g")).select(*keys, "_i", "n", "q")


def _interpolated(pos: Column, low: Column, high: Column) -> Column:
    mixed = (F.ceil(pos) - pos) * low + (pos - F.floor(pos)) * high
    return F.when(low == high, low).otherwise(mixed)


def _ranked(rows: DataFrame, chosen: DataFrame, keys: list[str], width: int, probs: Sequence[float]) -> DataFrame:
    """Quantiles of all other groups, each small, from the running count over distinct values."""
    pairs = F.array(*(F.struct(F.lit(i).alias("_i"), F.col(f"_v{i}").alias("value")) for i in range(width)))
    others = rows.join(small_side(chosen.select(F.col("_g").alias("_chosen"))), F.col("_g") == F.col("_chosen"), "left_anti")
    values = others.select(*keys, "_g", F.inline(pairs)).filter(F.col("value").isNotNull())
    own = ["_g", "_i"]
    counts = values.groupBy(*own, "value").agg(F.count("*").alias("_c"), *(F.first(k).alias(k) for k in keys))
    upto = F.sum("_c").over(Window.partitionBy(*own).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"_upto": upto, "n": F.sum("_c").over(Window.partitionBy(*own))})
    wanted = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        for part, rank in (("l", F.floor(pos)), ("h", F.ceil(pos))):
            wanted.append(F.max(F.when((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_c")), F.col("value"))).alias(f"_{part}{i}"))
    picked = ranked.groupBy(*own).agg(F.first("n").alias("n"), *(F.first(k).alias(k) for k in keys), *wanted)
    q = [_interpolated(F.lit(float(p)) * (F.col("n") - 1), F.col(f"_l{i}"), F.col(f"_h{i}")) for i, p in enumerate(probs)]
    return picked.select(*keys, "_i", "n", F.array(*q).alias("q"))
