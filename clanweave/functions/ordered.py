"""Ordered analytics that stay parallel when one group holds most of the rows.

A plain window sorts every group in one task. ``ordered_scan`` range-partitions by (group, order)
instead, so a hot group is spread over many tasks; each task works on its own stretch and the stretches
are stitched together through a table with one row per (partition, group).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clanweave.session import by_key, materialize


def ordered_scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    rank: str | None = None,
    sums: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    leads: Mapping[str, Column] | None = None,
    mins: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add 1-based ranks, running sums, running minima, group totals and neighbour values.

    ``order`` must be a total order within a group (rows that tie must be interchangeable). ``by`` may be
    empty for a global order.
    """
    by = list(by)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    sums, totals, lags, leads, mins = dict(sums or {}), dict(totals or {}), dict(lags or {}), dict(leads or {}), dict(mins or {})
    payload = list(df.columns)

    # The partition number is only meaningful once it is stored: a second evaluation may place rows
    # differently, hence the written table.
    placed = df
    for kind, exprs in (("s", sums), ("t", totals), ("l", lags), ("f", leads), ("m", mins)):
        for name, expr in exprs.items():
            placed = placed.withColumn(f"_{kind}_{name}", expr)
    # NULL groups get a stand-in and a flag, so that windows and the final join share one plain hash partitioning. They are made where rows have moved.
    placed = placed.repartitionByRange(*[F.col(b) for b in by], *order)
    keys, types = [], dict(df.dtypes)
    for i, b in enumerate(by):
        stand_in = F.lit("") if types[b] == "string" else F.lit(0)
        placed = placed.withColumn(f"_b{i}", F.coalesce(F.col(b), stand_in.cast(types[b]))).withColumn(f"_z{i}", F.col(b).isNull())
        keys += [f"_b{i}", f"_z{i}"]
    if rank and not (sums or totals or lags or leads or mins) and all(types[b] in _PLAIN for b in by):
        return _ranked(placed.sortWithinPartitions(*by, *order), payload, keys, rank)
    placed = materialize(placed.withColumn("_part", F.spark_partition_id()), "scan")

    stretch = ["_part", *keys]
    inside = Window.partitionBy(*stretch).orderBy(*order)
    local = placed.withColumn("_rn", F.row_number().over(inside).cast("long"))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name in sums:
        local = local.withColumn(f"_ls_{name}", F.sum(f"_s_{name}").over(running))
    for name in mins:
        local = local.withColumn(f"_lm_{name}", F.min(f"_m_{name}").over(running))
    for name in lags:
        local = local.withColumn(f"_ll_{name}", F.lag(f"_l_{name}").over(inside))
    for name in leads:
        local = local.withColumn(f"_lf_{name}", F.lead(f"_f_{name}").over(inside))
    if leads:
        local = local.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*stretch)))

    aggs = [F.count(F.lit(1)).alias("_cnt")]
    aggs += [F.sum(f"_s_{n}").alias(f"_es_{n}") for n in sums]
    aggs += [F.sum(f"_t_{n}").alias(f"_et_{n}") for n in totals]
    aggs += [F.min(f"_m_{n}").alias(f"_em_{n}") for n in mins]
    aggs += [F.max_by(f"_l_{n}", "_rn").alias(f"_el_{n}") for n in lags]
    aggs += [F.min_by(f"_f_{n}", "_rn").alias(f"_ef_{n}") for n in leads]
    base = local if (lags or leads) else placed
    stitches = base.groupBy(*stretch).agg(*aggs)
    across = Window.partitionBy(*keys).orderBy("_part")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    carry = [F.col(c).alias(f"_k_{c}") for c in stretch]
    carry.append(F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_c_cnt"))
    carry += [F.sum(f"_es_{n}").over(before).alias(f"_c_s_{n}") for n in sums]
    carry += [F.sum(f"_et_{n}").over(whole).alias(f"_c_t_{n}") for n in totals]
    carry += [F.min(f"_em_{n}").over(before).alias(f"_c_m_{n}") for n in mins]
    carry += [F.lag(f"_el_{n}").over(across).alias(f"_c_l_{n}") for n in lags]
    carry += [F.lead(f"_ef_{n}").over(across).alias(f"_c_f_{n}") for n in leads]
    carried = stitches.select(*carry)

    on = [F.col(c) == F.col(f"_k_{c}") for c in stretch]
    # Without groups this is a row per partition; with them it grows with the groups, and both sides are dealt alike already.
    out = local.join(by_key(carried) if by else carried, on, "inner")
    cols = [F.col(c) for c in payload]
    if rank:
        cols.append((F.col("_c_cnt") + F.col("_rn")).alias(rank))
    for n in sums:
        parts = [F.col(f"_c_s_{n}"), F.col(f"_ls_{n}")]
        both = F.coalesce(parts[0], F.lit(0)) + F.coalesce(parts[1], F.lit(0))
        cols.append(F.when(parts[0].isNull() & parts[1].isNull(), None).otherwise(both).alias(n))
    cols += [F.col(f"_c_t_{n}").alias(n) for n in totals]
    cols += [F.least(F.col(f"_c_m_{n}"), F.col(f"_lm_{n}")).alias(n) for n in mins]
    cols += [F.when(F.col("_rn") == 1, F.col(f"_c_l_{n}")).otherwise(F.col(f"_ll_{n}")).alias(n) for n in lags]
    cols += [
        F.when(F.col("_rn") == F.col("_n"), F.col(f"_c_f_{n}")).otherwise(F.col(f"_lf_{n}")).alias(n) for n in leads
    ]
    return out.select(*cols)


#: Types of groups whose values are equal where Arrow says so.
_PLAIN = ("string", "tinyint", "smallint", "int", "bigint", "date")


def _ranked(placed: DataFrame, payload: Sequence[str], keys: Sequence[str], rank: str) -> DataFrame:
    """Ranks only: rows are counted where they are sorted and moved once.

    Of the groups of a partition only the first can have begun in an earlier one, so a number per partition is all that has to be added.
    """
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1  # place in the partition
    placed = placed.withColumn("_part", F.spark_partition_id()).withColumn("_rn", at)
    if keys:
        types = ", ".join(f"`{n}` {t}" for n, t in placed.dtypes)
        placed = placed.mapInArrow(lambda batches: _count_from_start(batches, list(keys)), f"{types}, _first boolean")
    else:
        placed = placed.withColumn("_first", F.lit(True))
    placed = materialize(placed, "scan")
    counts = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_cnt"), F.max("_first").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("_part", "_first", F.sum("_cnt").over(before).alias("_c_cnt")).where("_first and _c_cnt is not null").collect()
    held = [0] * (max((r["_part"] for r in carried), default=0) + 1)
    for r in carried:
        held[r["_part"]] = r["_c_cnt"]
    add = F.when(F.col("_first"), F.coalesce(F.get(F.lit(held).cast("array<bigint>"), F.col("_part")), F.lit(0))).otherwise(0)
    return placed.select(*[F.col(f"`{c}`") for c in payload], (F.col("_rn") + add).alias(rank))


def _count_from_start(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Make ``_rn`` the place in the group instead of in the partition, and tell whether the group is the partition's first."""
    last, start = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        place = batch.column("_rn").to_numpy()
        new = np.zeros(n, dtype=bool)
        new[0] = last is not None and any(batch.column(k)[0].as_py() != v for k, v in zip(keys, last))
        for k in keys:
            column = batch.column(k)
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        begins = np.maximum.accumulate(np.where(new, place - 1, start))
        last, start = [batch.column(k)[n - 1].as_py() for k in keys], int(begins[-1])
        batch = batch.set_column(batch.schema.get_field_index("_rn"), "_rn", pa.array(place - begins))
        yield batch.append_column("_first", pa.array(begins == 0))


def rank_all(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """1-based position in one global order, without a single-task sort."""
    return ordered_scan(df, [], order, rank=name)


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    return ordered_scan(df, by, order, rank=name)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per group, one column per entry of ``points``.

    Equal values are counted before anything is ordered, and a group is never held in one place.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = ordered_scan(
        counted, by, [value], sums={"_upto": F.col("_n")}, totals={"_all": F.col("_n")}
    )
    aggs = []
    for name, p in points.items():
        at = F.lit(float(p)) * (F.col("_all") - 1)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("_upto") - F.col("_n") <= k) & (k < F.col("_upto"))
            aggs.append(F.max(F.when(inside, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
    aggs.append(F.max("_all").alias("_all"))
    picked = placed.groupBy(*by).agg(*aggs)
    cols = [F.col(b) for b in by]
    for name, p in points.items():
        at = F.lit(float(p)) * (F.col("_all") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append((lo + (at - F.floor(at)) * (hi - lo)).alias(name))
    return picked.select(*cols)


def bounded_quantiles(df: DataFrame, by: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Exact quantiles for a value with a bounded number of distinct levels (a length, a gene distance).

    One shuffle: the levels are counted map-side, so the percentile sees at most one entry per level.
    """
    by = list(by)
    levels = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return levels.groupBy(*by).agg(*[F.percentile(value, F.lit(float(p)), F.col("_n")).alias(n) for n, p in points.items()])
