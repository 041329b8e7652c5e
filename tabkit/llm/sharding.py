"""Minimax contiguous sharding, in DataFrame functions only.

Groups of equal texts are atomic. They are ordered by a hash of the text; groups that fall
into the same of ``units_per_shard * shards`` hash units form one atomic unit, so the
ordered sizes are a list whose length does not grow with the data. A unit above the mean
shard (a group of equal texts, or a very long one) comes first in the order and has a shard
of its own, again while one exceeds the mean of what is left. For the others the smallest
feasible shard capacity is found by binary search: a greedy pass over the ordered unit sizes
checks whether a capacity needs at most the number of shards left. The units are cut there,
and earlier where fewer units than shards would be left.

Law: ``bytes``. No shard is larger than the smallest capacity feasible for the units, or the
one unit that it holds; with 1024 units a shard the units other than those of large groups are
about 0.1 % of a shard. No shard is empty unless there are fewer units than shards.

Slots number the rows of a shard without gaps. They are given per cell (shard, hash of the
row), the cells' offsets being running sums, so that no task holds a whole shard.

Defined results: a NULL text has no bytes and counts as equal to the empty one; a NULL
doc_id is kept. Repeated rows each get a slot. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tabkit.llm.common import written

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
UNITS_PER_SHARD = 1024
#: Rows of one numbering cell, on average.
CELL_ROWS = 256


def greedy_shards(capacity):
    """SQL: shards that a greedy pass over the array ``sizes`` needs at this capacity."""
    return f"""aggregate(sizes, named_struct('shards', 1, 'load', 0L), (a, s) ->
        if(a.load + s <= {capacity}, named_struct('shards', a.shards, 'load', a.load + s),
                                     named_struct('shards', a.shards + 1, 'load', s))).shards"""


def own_units(units: DataFrame, shards: int) -> list[int]:
    """Units of ``units`` (unit, bytes) that have a shard of their own: those above the mean
    that the others have in the shards left. There are fewer of them than shards."""
    # largest first, since each of them lowers the mean of what is left
    largest = (units.orderBy(F.desc("bytes"), "unit").limit(shards - 1)
               .agg(F.sort_array(F.collect_list(F.struct("bytes", "unit")), asc=False).alias("u")))
    total = units.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("total"))
    return sorted(largest.crossJoin(total).selectExpr(
        f"""aggregate(u, named_struct('own', cast(array() AS array<bigint>), 'rest', total), (a, x) ->
              if(x.bytes > a.rest DIV ({shards} - size(a.own)),
                 named_struct('own', concat(a.own, array(x.unit)), 'rest', a.rest - x.bytes), a)).own AS own""").first()["own"])


def cut_units(units: DataFrame, shards: int) -> tuple[int, list[int]]:
    """``units`` (unit, bytes) -> (capacity, first unit of each shard after the first)."""
    ordered = (units.agg(F.array_sort(F.collect_list(F.struct("unit", "bytes"))).alias("u"))
               .select(F.transform("u", lambda x: x["unit"]).alias("units"),
                       F.transform("u", lambda x: x["bytes"]).alias("sizes")))
    # between the larger of the mean and the largest unit, and their sum, greedy always fits
    bounded = ordered.selectExpr(
        "units", "sizes",
        "coalesce(array_max(sizes), 0L) AS top",
        f"aggregate(sizes, 0L, (a, s) -> a + s) DIV {shards} + 1 AS mean")
    searched = bounded.selectExpr(
        "units", "sizes",
        f"""aggregate(sequence(1, 63), named_struct('lo', greatest(top, mean - 1), 'hi', top + mean), (b, i) ->
              if(b.lo >= b.hi, b,
                 if({greedy_shards('((b.lo + b.hi) DIV 2)')} <= {shards},
                    named_struct('lo', b.lo, 'hi', (b.lo + b.hi) DIV 2),
                    named_struct('lo', (b.lo + b.hi) DIV 2 + 1, 'hi', b.hi)))).lo AS capacity""")
    row = searched.selectExpr(
        "capacity",
        f"""aggregate(arrays_zip(units, sizes),
             named_struct('load', 0L, 'seen', 0, 'cuts', cast(array() AS array<bigint>)), (a, x) ->
             if(a.seen = 0 OR (a.load + x.sizes <= capacity AND size(units) - a.seen >= {shards} - size(a.cuts)),
                named_struct('load', a.load + x.sizes, 'seen', a.seen + 1, 'cuts', a.cuts),
                named_struct('load', x.sizes, 'seen', a.seen + 1, 'cuts', concat(a.cuts, array(x.units))))).cuts AS cuts""").first()
    return row["capacity"], list(row["cuts"])


def shard_rows(docs: DataFrame, shards: int = 40, units_per_shard: int = UNITS_PER_SHARD) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(docs.select(
        F.col("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(units_per_shard * shards).cast("long")).alias("unit")), "sizes")
    totals = written(rows.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "units")
    n = totals.agg(F.sum("n")).first()[0] or 0
    own = own_units(totals, shards)
    _, cuts = cut_units(totals.filter(~F.col("unit").isin(own)).select("unit", "bytes"), shards - len(own))
    listed = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]).cast("array<bigint>")
    alone = F.array_position(listed(own), F.col("unit"))
    shard = F.when(alone > 0, alone - 1).otherwise(len(own) + F.size(F.filter(listed(cuts), lambda c: c <= F.col("unit"))))
    cells = max(32, -(-n // (shards * CELL_ROWS)))
    placed = written(rows.withColumn("shard", shard.cast("int")).withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells).cast("long"))), "placed")
    by_shard = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "cell").agg(F.count("*").alias("rows_here"))
               .withColumn("offset", F.coalesce(F.sum("rows_here").over(by_shard), F.lit(0)))
               .select("shard", "cell", "offset"))
    in_cell = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("in_cell", F.row_number().over(in_cell) - 1).join(offsets, ["shard", "cell"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("in_cell")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
