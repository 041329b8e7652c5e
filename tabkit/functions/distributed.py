"""Distributed building blocks that replace single-task windows and exact
percentile aggregates. Each has one path, whatever the size of its input.

* ``running_totals``: cumulative sums in a global order. Rows are range-partitioned and
  summed per partition; the partitions' offsets (one row each) are added.
* ``column_quantiles`` / ``exact_quantiles``: exact order statistics per group (linear
  interpolation, as pandas / numpy / DuckDB ``quantile_cont``), by rounds of selection that
  narrow a bracket of values around each rank until a fixed number of values is inside.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.session import ensure_checkpoint_dir

MAX_DOUBLE = 1.7976931348623157e308
# Relative rank error of the sketch that brackets are read from is 1 / ACCURACY.
ACCURACY = 10_000
# Small side tables (one row per group / target) are broadcast only below this.
BROADCAST_ROWS = 100_000


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side table only when its row count is known to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def present(c: Column) -> Column:
    """The value as a double, NULL where it is missing (NULL or NaN)."""
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def running_totals(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = False,
                   group_cols: list[str] | tuple = ()) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in order) and ``tot_<c>`` for each c, within
    each of ``group_cols`` where given.

    The pair (group, ``order_col``) must be unique (group by it first).
    """
    g = list(group_cols)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ensure_checkpoint_dir(df.sparkSession)  # the cluster's shared folder, or a local one in tests
    # Range partitions follow the sort order, so partition i precedes i+1. The
    # checkpoint pins the assignment and cuts lineage before two jobs read it.
    ranged = (
        df.repartitionByRange(*[F.col(c).asc() for c in g], order)
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    local_w = Window.partitionBy("_pid", *g).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(local_w).alias(f"_loc_{c}") for c in sum_cols])
    # one row per partition and group that meets it
    part_tot = ranged.groupBy("_pid", *g).agg(*[F.sum(c).alias(f"_pt_{c}") for c in sum_cols])
    by_group = Window.partitionBy(*g)
    before = by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part_tot.select(
        F.col("_pid").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in g],
        *[F.coalesce(F.sum(f"_pt_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_pt_{c}").over(by_group).alias(f"tot_{c}") for c in sum_cols],
    )
    on = F.col("_pid") == F.col("_p")
    for c in g:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return local.join(offsets, on).select(
        *df.columns,
        *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"tot_{c}") for c in sum_cols],
    )


def dense_index(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` with their 0-based rank in ascending order."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = running_totals(values, col, ["_one"])
    return ranked.select(col, (F.col("cum__one") - 1).cast("int").alias("code"))


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], group_cols: list[str] | tuple = ()) -> DataFrame:
    """Exact quantiles of several columns per group: ``group_cols..., column, prob, value``.

    Selection by rounds. A sketch (``percentile_approx``, rank error 1 / ACCURACY) gives each
    (group, column, probability) a bracket of values around its rank; one pass counts what lies below, on
    and between the bracket's edges, which tells the rank within. A round leaves 6 / ACCURACY of the
    rows between the edges at most; where that may be more than HELD values, the next round sketches
    the rows inside. At last the values inside, HELD at most, are collected in the aggregate and the
    wanted ones read off. Each round is exact whatever the sketch says: a rank outside its bracket
    moves the bracket.

    NULL and NaN are skipped (pandas ``skipna``); a NULL group is a group. Linear interpolation
    between the order statistics at ranks floor((n-1)p) and that plus one. Only the needed columns are
    kept for the passes, unless ``df`` is cached already. The result is checkpointed (one row per
    group, column and probability).
    """
    ensure_checkpoint_dir(df.sparkSession)
    if not cols:
        raise ValueError("no columns")
    if not group_cols:  # one implicit group; keeps every join an equi-join
        return column_quantiles(df.withColumn("_all", F.lit(0)), cols, probs, ["_all"]).drop("_all")
    g = list(group_cols)
    data = df.select(*[F.col(f"`{c}`") for c in g], *[present(F.col(f"`{c}`")).alias(f"_v{i}") for i, c in enumerate(cols)])
    held = [] if df.is_cached else [data.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        entries = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
        state, inside = _first_brackets(data, cols, probs, g)
        held.append(state)
        while True:
            groups = state.count()
            # values are collected once their number is bounded, else another round comes first
            state, inside = _narrow(data, state, entries, g, groups, inside <= HELD)
            held.append(state)
            if inside == 0:
                break
        return _interpolated(state, cols, probs, g)
    finally:
        for x in held:
            x.unpersist()


#: Values inside a bracket that one aggregate may collect.
HELD = 20_000
SLACK = 2.0


#: Stands for the number of values inside a bracket that was opened again.
UNKNOWN = 1 << 60
#: Steps of relative rank that a sketch of rows inside a bracket is read at.
GRID = 1000


def _first_brackets(data: DataFrame, cols: list[str], probs: list[float], g: list[str]):
    """(state, bound): one row per group with ``_e<i>_<j>``, a struct of the count n, the bracket's edges
    and the two wanted values; how many values may lie inside a bracket."""
    room = SLACK / ACCURACY
    at = [e for p in probs for e in (max(0.0, p - room), min(1.0, p + room))]
    summary = data.groupBy(*g).agg(*[x for i in range(len(cols)) for x in (
        F.count(f"_v{i}").alias(f"_n{i}"), F.percentile_approx(f"_v{i}", at, ACCURACY).alias(f"_a{i}"))])
    none = F.lit(None).cast("double")
    state = summary.select(*[F.col(f"`{c}`").alias(f"_g_{c}") for c in g], *[
        F.struct(F.col(f"_n{i}").alias("n"), F.col(f"_a{i}")[2 * j].alias("lo"), F.col(f"_a{i}")[2 * j + 1].alias("hi"),
                 ((F.col(f"_n{i}") - 1) * F.lit(float(p))).alias("pos"), none.alias("v0"), none.alias("v1")).alias(f"_e{i}_{j}")
        for i in range(len(cols)) for j, p in enumerate(probs)]).persist(StorageLevel.MEMORY_AND_DISK)
    most = state.agg(F.max(F.greatest(*[F.col(f"_e{i}_0.n") for i in range(len(cols))], F.lit(0)))).first()[0]
    return state, math.ceil(6 * (most or 0) / ACCURACY) or 1


def _narrow(data: DataFrame, state: DataFrame, entries: list, g: list[str], groups: int, last: bool):
    """One round: (new state, how many values may lie inside an open bracket; 0 when all are settled).
    ``last`` collects the values inside."""
    side = maybe_broadcast(state, groups)  # one row per group
    both = data.join(side, _null_safe(g, [f"_g_{c}" for c in g]))
    names = [f"_g_{c}" for c in g]

    def between(e, v):
        return (v > e["lo"]) & (v < e["hi"]) & e["v0"].isNull()

    counts = []
    for i, j in entries:
        e, v = F.col(f"_e{i}_{j}"), F.col(f"_v{i}")
        counts += [F.first(e).alias(f"_e{i}_{j}"), F.count_if(v < e["lo"]).alias(f"_b{i}_{j}"), F.count_if(v == e["lo"]).alias(f"_l{i}_{j}"),
                   F.count_if((v > e["lo"]) & (v < e["hi"])).alias(f"_c{i}_{j}"), F.count_if((v == e["hi"]) & (e["hi"] > e["lo"])).alias(f"_h{i}_{j}")]
        if last:
            counts.append(F.sort_array(F.collect_list(F.when(between(e, v), v))).alias(f"_s{i}_{j}"))
    counted = both.groupBy(*names).agg(*counts)

    def settled(i, j):
        e, (b, on, c, h) = F.col(f"_e{i}_{j}"), (F.col(f"_{x}{i}_{j}") for x in "blch")

        def at(r):
            held = F.get(F.col(f"_s{i}_{j}"), (r - b - on).cast("int")) if last else F.lit(None).cast("double")
            return F.when(r < b, None).when(r < b + on, e["lo"]).when(r < b + on + c, held).when(r < b + on + c + h, e["hi"])

        r0, r1 = _ranks(e)
        v0, v1 = at(r0), at(r1)
        found = v0.isNotNull() & v1.isNotNull()
        keep = e["v0"].isNotNull()
        return r0, r1, b + on, c, F.when(keep, e["v0"]).when(found, v0), F.when(keep, e["v1"]).when(found, v1), r0 >= b, r1 < b + on + c + h

    rows, still = [], []
    for i, j in entries:
        e = F.col(f"_e{i}_{j}")
        r0, r1, start, c, v0, v1, low_ok, high_ok = settled(i, j)
        # a rank outside its bracket: open that side and look again
        lo = F.when(low_ok, e["lo"]).otherwise(F.lit(float("-inf")))
        hi = F.when(high_ok, e["hi"]).otherwise(F.lit(float("inf")))
        wide = ~low_ok | ~high_ok
        share = [F.when(wide, F.lit(x)).otherwise((r - start) / F.greatest(c, F.lit(1))) for r, x in ((r0, 0.0), (r1, 1.0))]
        rows.append(F.struct(e["n"].alias("n"), lo.alias("lo"), hi.alias("hi"), e["pos"].alias("pos"), v0.alias("v0"), v1.alias("v1"),
                             F.greatest(share[0], F.lit(0.0)).alias("low"), F.least(share[1], F.lit(1.0)).alias("high")).alias(f"_e{i}_{j}"))
        still.append(F.when(v0.isNull() & (e["n"] > 0), F.when(wide, F.lit(UNKNOWN)).otherwise(c)).otherwise(0))
    state = counted.select(*names, *rows, F.greatest(*still, F.lit(0)).alias("_open")).persist(StorageLevel.MEMORY_AND_DISK)
    inside = state.agg(F.max("_open")).first()[0] or 0
    if not inside:
        return state, 0
    side = maybe_broadcast(state, groups)
    both = data.join(side, _null_safe(g, names))
    sketched = both.groupBy(*names).agg(*[x for i, j in entries for x in (
        F.first(f"_e{i}_{j}").alias(f"_e{i}_{j}"),
        F.percentile_approx(F.when(between(F.col(f"_e{i}_{j}"), F.col(f"_v{i}")), F.col(f"_v{i}")), [k / GRID for k in range(GRID + 1)], ACCURACY).alias(f"_q{i}_{j}"))])
    new = []
    for i, j in entries:
        e, q = F.col(f"_e{i}_{j}"), F.col(f"_q{i}_{j}")
        room = F.lit(SLACK / ACCURACY)
        below = F.floor((e["low"] - room) * GRID).cast("int")
        above = F.ceil((e["high"] + room) * GRID).cast("int")
        lo = F.when(e["v0"].isNull() & (below >= 0), F.get(q, F.greatest(below, F.lit(0))))
        hi = F.when(e["v0"].isNull() & (above <= GRID), F.get(q, F.least(above, F.lit(GRID))))
        new.append(F.struct(e["n"].alias("n"), F.coalesce(lo, e["lo"]).alias("lo"), F.coalesce(hi, e["hi"]).alias("hi"), e["pos"].alias("pos"),
                            e["v0"].alias("v0"), e["v1"].alias("v1")).alias(f"_e{i}_{j}"))
    # the room, a step of the grid and the sketch's error to either side
    left = inside if inside >= UNKNOWN else math.ceil(inside * min(1.0, 6 / ACCURACY + 2 / GRID))
    out = sketched.select(*names, *new).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    state.unpersist()
    return out, left


def _ranks(e: Column):
    """The ranks (from 0) of the two order statistics that a quantile lies between."""
    r0 = F.floor(e["pos"])
    return r0, F.least(r0 + 1, e["n"] - 1)


def _interpolated(state: DataFrame, cols: list[str], probs: list[float], g: list[str]) -> DataFrame:
    def entry(i, j):
        e = F.col(f"_e{i}_{j}")
        frac = e["pos"] - F.floor(e["pos"])
        # equal neighbours stay as they are: also keeps equal infinities exact
        value = F.when((e["v0"] == e["v1"]) | (frac == 0), e["v0"]).otherwise(e["v0"] + (e["v1"] - e["v0"]) * frac)
        return F.struct(F.lit(cols[i]).alias("column"), F.lit(float(probs[j])).alias("prob"), value.alias("value"))

    out = state.select(*[F.col(f"_g_{c}").alias(c) for c in g], F.inline(F.array(*[entry(i, j) for i in range(len(cols)) for j in range(len(probs))])))
    return out.checkpoint(eager=True)


def _null_safe(left: list[str], right: list[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float], group_cols: list[str] | tuple = ()) -> DataFrame:
    """Exact quantiles of one column per group: columns ``group_cols..., prob, value``."""
    g = list(group_cols)
    q = column_quantiles(df, [value_col], probs, g)
    return q.select(*g, "prob", "value")


def top_k_per_group(df: DataFrame, group_cols: list[str], order, k: int) -> DataFrame:
    """The first ``k`` rows of each group in ``order`` (a list of sort columns), with
    ``rank`` 1..k, without ordering a large group in one task.

    Up to Spark's ``windowGroupLimitThreshold`` the optimizer already plans a
    partial group limit before the shuffle (each task keeps k rows per group),
    so a plain ``row_number`` filter is enough. Above it, the same two rounds
    are written out: k per input partition first, then the final ranking.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        local_w = Window.partitionBy(*group_cols, "_p").orderBy(*order)
        df = (
            df.withColumn("_p", F.spark_partition_id())
            .withColumn("_r", F.row_number().over(local_w))
            .where(F.col("_r") <= k)
            .drop("_p", "_r")
        )
    return df.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
