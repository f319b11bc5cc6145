"""Interval algebra on item indices: DataFrames of (keys, lo, hi) with inclusive, absolute ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_of(index: Column, size: int) -> Column:
    return F.floor(index / size).cast("long")


def runs(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Maximal runs of consecutive indices of each key; repeats count once, nulls not at all."""
    once = df.select(*keys, index).where(F.col(index).isNotNull()).distinct()
    island = F.col(index) - F.row_number().over(Window.partitionBy(*keys).orderBy(index))
    return once.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(index).alias("lo"), F.max(index).alias("hi")).drop("_i")


def merge(df: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and adjacent ranges of each key as one."""
    order = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("lo") > reach + 1), 1).otherwise(0)
    marked = df.where("lo <= hi").withColumn("_f", fresh)
    island = F.sum("_f").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_i")


def subtract(windows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is left of each window (keys, lo, hi) without the merged, disjoint ranges ``done``; O(ranges), not O(items).

    A window's ranges are sorted, never gathered: each gives the gap before it, the last also the one behind it. Windows without
    ranges are left whole; empty windows give nothing.
    """
    ranges = done.where("lo <= hi").select(*keys, F.col("lo").alias("_a"), F.col("hi").alias("_b"))
    both = windows.where("lo <= hi").join(ranges, keys, "left")
    order = Window.partitionBy(*keys, "lo", "hi").orderBy("_a")
    before, behind = F.lag("_b").over(order) + 1, F.lead("_a").over(order)
    both = both.withColumns({"_from": F.coalesce(before, "lo"), "_last": behind.isNull()})
    gap = lambda a, b: F.struct(F.greatest(a, F.col("lo")).alias("lo"), F.least(b, F.col("hi")).alias("hi"))
    first = gap(F.col("_from"), F.coalesce(F.col("_a") - 1, "hi"))
    gaps = F.when(F.col("_last") & F.col("_b").isNotNull(), F.array(first, gap(F.col("_b") + 1, F.col("hi")))).otherwise(F.array(first))
    return both.select(*keys, F.explode(F.filter(gaps, lambda g: g["lo"] <= g["hi"])).alias("_g")).select(*keys, "_g.lo", "_g.hi")


def cardinality(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_items) of disjoint ranges; keys without ranges have no row, inverted ranges are the caller's to drop."""
    return df.groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo") + 1).alias("n_items"))


def shift(df: DataFrame, by: Column) -> DataFrame:
    """Both ends moved by a number; null ends stay null."""
    return df.withColumns({"lo": F.col("lo") + by, "hi": F.col("hi") + by})


def clamp(df: DataFrame, low: Column, high: Column) -> DataFrame:
    """Ends moved into [low, high]; ranges with nothing in it are dropped."""
    inside = df.where((F.col("lo") <= F.col("hi")) & (F.col("hi") >= low) & (F.col("lo") <= high))
    return inside.withColumns({"lo": F.greatest("lo", low), "hi": F.least("hi", high)})


def items(df: DataFrame, keys: list[str], name: str = "item_index") -> DataFrame:
    """A row for each index of each range, repeated where ranges overlap; inverted ranges must be dropped before."""
    return df.select(*keys, F.explode(F.sequence("lo", "hi")).alias(name))


def chunks(total: DataFrame, size: int) -> DataFrame:
    """(chunk_id, lo, hi) of the items 0 to total - 1, dealt out from the start; ``total`` has one row with the column ``total``, null and 0 give none."""
    n = total.first().total or 0
    lo = F.col("chunk_id") * size
    ids = total.sparkSession.range(-(-n // size)).withColumnRenamed("id", "chunk_id")
    return ids.select("chunk_id", lo.alias("lo"), (F.least(lo + size, F.lit(n).cast("long")) - 1).alias("hi"))


def in_chunk(index: Column, start: Column, size: Column) -> Column:
    """Whether an index lies in a chunk; indices outside are dropped by a scan, moved by :func:`clamp`."""
    return index.between(start, start + size - 1)


def split_units(gaps: DataFrame, keys: list[str], *, ratio: float = 0.5, gap: int = 100) -> DataFrame:
    """(keys, unit_ord, lo, hi, n_ranges, n_items): one unit for each key, cut at gaps wider than ``gap`` where more than
    ``ratio`` of the span is gap."""
    whole, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("lo")
    size = F.col("hi") - F.col("lo") + 1
    span = F.max("hi").over(whole) - F.min("lo").over(whole) + 1
    sparse = (span - F.sum(size).over(whole)) / span > ratio
    wide = F.coalesce(F.col("lo") - F.lag("hi").over(order) - 1 > gap, F.lit(False))
    marked = gaps.withColumn("_cut", F.when(sparse & wide, 1).otherwise(0))
    marked = marked.withColumn("unit_ord", F.sum("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "unit_ord").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n_ranges"), F.sum(size).alias("n_items"))


def completeness(windows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, size, processed, is_complete) of each window, from disjoint ranges."""
    n = cardinality(done, keys)
    rows = windows.select(*keys, (F.col("hi") - F.col("lo") + 1).alias("size")).join(n, keys, "left")
    rows = rows.select(*keys, "size", F.coalesce("n_items", F.lit(0)).cast("long").alias("processed"))
    return rows.withColumn("is_complete", F.col("processed") >= F.col("size"))


def release_action(size: Column, processed: Column, strand_above: float | None = None) -> Column:
    """What becomes of a unit whose worker left; ``strand_above`` (off) gives units above that share up, as some planners do."""
    done = F.when(processed >= size, "done")
    if strand_above is not None:
        done = done.when(processed / size > strand_above, "dropped")
    return done.otherwise("requeue")


def successes(assigned: Column, reported: Column, errors: Column, n_outputs: Column) -> Column:
    """Items that count as done: those reported, else all but those with errors, else the first ``n_outputs``."""
    return F.coalesce(reported, F.when(F.size(errors) > 0, F.array_except(assigned, errors)), F.slice(assigned, F.lit(1), n_outputs))


def untiled(df: DataFrame, key: str) -> DataFrame:
    """Chunks (key, start, size) that do not begin where the one before ends, the first at 0."""
    order = Window.partitionBy(key).orderBy("start")
    rows = df.withColumn("expected", F.lag(F.col("start") + F.col("size"), 1, 0).over(order))
    return rows.where("start <> expected")


def manifest(counts: DataFrame, name: str = "shard") -> DataFrame:
    """(shard, size, start_offset, end_offset) in the order of names; one row for each file, so the global order is a small table's."""
    order = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("size").over(order)
    return counts.select(name, "size", (end - F.col("size")).alias("start_offset"), (end - 1).alias("end_offset"))


def locate(indexed: DataFrame, index: str, shards: DataFrame, *, width: int = 1 << 16) -> DataFrame:
    """Each index with the shard that holds it: an equi-join on buckets of ``width`` indices, then the exact test; no nested loop."""
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    spread = shards.where("size > 0").withColumn("_b", F.explode(F.sequence(bucket("start_offset"), bucket("end_offset"))))
    rows = indexed.withColumn("_b", bucket(index)).join(spread, "_b")
    return rows.where(F.col(index).between(F.col("start_offset"), F.col("end_offset"))).drop("_b")


def overlap(windows: DataFrame, shards: DataFrame, *, width: int = 1 << 16) -> DataFrame:
    """Windows (chunk_id, lo, hi) and the shards they touch, with the common part; bucketed like :func:`locate`."""
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    a = windows.withColumn("_b", F.explode(F.sequence(bucket("lo"), bucket("hi"))))
    b = shards.where("size > 0").withColumn("_b", F.explode(F.sequence(bucket("start_offset"), bucket("end_offset"))))
    common = a.join(b, "_b").withColumns({"from_index": F.greatest("lo", "start_offset"), "to_index": F.least("hi", "end_offset")})
    common = common.where((F.col("from_index") <= F.col("to_index")) & (F.col("_b") == bucket("from_index")))
    return common.drop("_b")
