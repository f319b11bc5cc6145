"""Progress analytics over captions, chunks, contributors and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def list_size(c: str) -> Column:
    """Length of a list; null counts as nought (size(NULL) is NULL under ANSI)."""
    return F.coalesce(F.size(c), F.lit(0)).cast("long")


def field_stats(captions: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n_rows, n_outputs) of the fields that hold anything, in one pass."""
    exploded = captions.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), list_size(f).alias("n")) for f in fields])).alias("s"))
    stats = exploded.groupBy("s.field").agg(F.count_if(F.col("s.n") > 0).alias("n_rows"), F.sum("s.n").alias("n_outputs"))
    return stats.where("n_outputs > 0")


def empty_columns(df: DataFrame) -> DataFrame:
    """(column, is_empty): all null, all nought (numbers) or all empty (lists), in one pass."""

    def filled(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind.startswith("array"):
            return F.size(c) > 0
        return c != 0 if kind in ("int", "bigint", "float", "double", "smallint", "tinyint") or kind.startswith("decimal") else c.isNotNull()

    counts = df.agg(*[F.count_if(filled(n, k)).alias(n) for n, k in df.dtypes])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column"), (F.col(f"`{n}`") == 0).alias("is_empty")) for n in df.columns])).alias("s")).select("s.*")


def top(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The n largest with their rank; ties by key. A partial top-n in each task, then one small merge."""
    first = df.orderBy(F.desc(by), key).limit(n)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), key)))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, by an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_s")).select(key, "_s.*")


def rounded(c: Column) -> Column:
    """To four places, in binary floating point throughout (F.round rounds the decimal form)."""
    return F.round(c * 10_000, 0) / 10_000


def user_of(worker: Column) -> Column:
    """A worker id without its last ``_part``."""
    return F.regexp_replace(worker, r"_[^_]*\z", "")


def trailing_rates(totals: DataFrame, minutes: tuple[int, ...] = (1, 5, 15, 60)) -> DataFrame:
    """(minute, n) to rates a minute over trailing windows, each over min(window, minutes elapsed).

    ``totals`` has one row for each minute that saw rows: a table as long as the run, not as the data.
    """
    whole = Window.orderBy("minute")
    elapsed = F.col("minute") - F.min("minute").over(whole) + 1
    rates = {f"rate_{m}": rounded(F.sum("n").over(whole.rangeBetween(-(m - 1), 0)) / F.least(F.lit(m), elapsed)) for m in minutes}
    overall = rounded(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, 0)) / elapsed)
    return totals.select("minute", "n", *[c.alias(k) for k, c in rates.items()], overall.alias("overall"))


def interval_rates(totals: DataFrame, expected: float) -> DataFrame:
    """(minute, n) to the rate since the last reading, the average so far, and how it stands to what is expected."""
    order = Window.orderBy("minute")
    total = F.sum("n").over(order)
    rows = totals.select("minute", total.alias("total"), (F.col("minute") - F.lag("minute").over(order)).alias("gap"), F.col("n"), F.min("minute").over(order).alias("since"))
    rows = rows.select("minute", "total", rounded(F.col("n") / F.col("gap")).alias("current"), rounded(F.col("total") / (F.col("minute") - F.col("since") + 1)).alias("average"))
    share = rounded(F.col("current") / expected * 100)
    return rows.withColumn("efficiency", share).withColumn("band", F.when(share >= 80, "good").when(share >= 50, "fair").when(share.isNotNull(), "poor"))


def size_category(n: Column) -> Column:
    return F.when(n < 1_000, "n<1K").when(n < 10_000, "1K<n<10K").when(n < 100_000, "10K<n<100K").when(n < 1_000_000, "100K<n<1M").when(n < 10_000_000, "1M<n<10M").otherwise("n>10M")
