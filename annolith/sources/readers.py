"""Sources: image trees, JSONL, CSV, Parquet, shard manifests, tar shards, stores."""

from __future__ import annotations

import re
import time
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from annolith.functions.text import IMAGE_SUFFIXES

URL_WORDS = ("url", "link")
#: File suffixes of a local image tree.
TREE_SUFFIXES = (*IMAGE_SUFFIXES, ".svg")
#: Names preferred where a dataset offers several.
CONFIGS = ("default", "en", "train", "main")
SPLITS = ("train", "training", "test", "validation", "dev")


def preferred(offered: list[str], wanted: tuple[str, ...], given: str | None = None) -> str:
    """The given name, else the first wanted one on offer, else the first offered, else the first wanted."""
    if given:
        return given
    return next((w for w in wanted if w in offered), offered[0] if offered else wanted[0])


def url_column(columns: list[str]) -> str | None:
    return next((c for c in columns if any(w in c.lower() for w in URL_WORDS)), None)


def numbered(df: DataFrame, name: str = "index") -> DataFrame:
    """A file scan's rows with their number, from 0, in the order of files and of rows in them.

    Rows are counted for each split of a file, so only a table of splits is sorted in one place.
    """
    rows = df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    splits = rows.groupBy("_f", "_b").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    order = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, 0)
    splits = splits.withColumn("_at", F.sum("_n").over(order) - F.col("_n") - F.col("_first"))
    return rows.join(splits.select("_f", "_b", "_at"), ["_f", "_b"]).withColumn(name, F.col("_m") + F.col("_at")).drop("_f", "_b", "_m", "_at")


def images(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(index, path, size) of image files in path order, from the listing alone. Folders under the root that begin with a dot are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", F.col("length").alias("size"))
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()
    below = F.expr("substring(path, {})".format(len(root) + 1)) if "://" in root else F.regexp_replace("path", "^.*" + re.escape(root.split(":", 1)[-1]), "")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    kept = files.where(suffix.isin(*TREE_SUFFIXES) & ~below.rlike(r"/\.[^/]*/"))
    return kept.select((F.row_number().over(Window.orderBy("path")) - 1).cast("long").alias("index"), "path", "size")


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, data) of JSON lines; a line's id is its ``id`` or ``sample_<line>``, lines that are no JSON object are left out.

    Lines are numbered over all files, in the order of their names.
    """
    lines = numbered(spark.read.text(path), "line")
    data = F.from_json("value", "map<string,string>")
    rows = lines.withColumn("data", data).where(F.col("data").isNotNull())
    get = lambda k: F.try_element_at("data", F.lit(k))
    return rows.select(F.coalesce(get("id"), F.concat(F.lit("sample_"), F.col("line").cast("string"))).alias("id"), F.coalesce(get("url"), get("image_url")).alias("url"), "data")


def with_urls(df: DataFrame) -> DataFrame:
    """A file scan's rows as (id, url, ...): the first column named like a URL (null without one), its ``id`` or the row's number from 0."""
    name = url_column(df.columns)
    rows = df if "id" in df.columns else numbered(df, "_index")
    own = F.col("id" if "id" in df.columns else "_index").cast("string")
    return rows.select(own.alias("id"), (F.col(f"`{name}`") if name else F.lit(None)).cast("string").alias("url"), *[F.col(f"`{c}`") for c in df.columns if c not in ("id", "url")])


def open_source(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: .jsonl, .csv, .parquet; names of remote datasets are not read here."""
    if path.endswith(".jsonl"):
        return jsonl(spark, path)
    if path.endswith(".csv"):
        return with_urls(spark.read.option("header", True).csv(path))
    if path.endswith(".parquet"):
        return with_urls(spark.read.parquet(path))
    raise ValueError(f"no reader for {path}")


def shard_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(shard, size) of Parquet files, from their row counts; files that can't be read are left out."""
    return spark.read.option("ignoreCorruptFiles", True).parquet(*paths).groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("shard")).agg(F.count("*").alias("size"))


def shard_manifest(spark: SparkSession, paths: list[str], *, cache: str | None = None) -> DataFrame:
    """(shard, size, start_offset, end_offset) of Parquet files, and of image files as shards of one row; read from ``cache`` where that holds one.

    Files that cannot be read take no offsets.
    """
    from annolith.operators.intervals import manifest

    if cache:
        root = spark._jvm.org.apache.hadoop.fs.Path(cache)
        if root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            return spark.read.parquet(cache)
    single = [p for p in paths if p.lower().endswith(TREE_SUFFIXES)]
    counts = spark.createDataFrame([(p.rsplit("/", 1)[-1], 1) for p in single], "shard string, size long")
    if tables := [p for p in paths if p not in single]:
        counts = counts.union(shard_counts(spark, tables))
    out = manifest(counts)
    if cache:
        out.write.parquet(cache)
        out = spark.read.parquet(cache)
    return out


def only_shards(rows: DataFrame, known: list[str], wanted: list[str] | None, name: str = "shard") -> tuple[DataFrame, list[str]]:
    """Rows of the wanted shards that are known (all, without a wish), and these in the order asked for."""
    own = [w for w in dict.fromkeys(wanted) if w in set(known)] if wanted else list(known)
    return rows.where(F.col(name).isin(own)), own


def matching(rows: DataFrame, **values) -> DataFrame:
    """Rows in which each named column has the given value; None asks for null."""
    for name, value in values.items():
        rows = rows.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return rows


def fetched(rows: DataFrame, make_fetcher, *, url_col: str = "url", tries: int = 3, wait: float = 1.0) -> DataFrame:
    """``rows`` with (data, status, error) of each URL through ``make_fetcher()(url) -> (status, headers, bytes)``, made once a task.

    Up to ``tries`` tries: 429 waits as ``Retry-After`` says if that is a whole number, 429 and 5xx and exceptions wait ``wait`` 2^k
    seconds; any other status than 200 fails at once. Null URLs are not fetched.
    """
    schema = StructType([*rows.schema.fields, StructField("data", BinaryType()), StructField("status", IntegerType()), StructField("error", StringType())])

    def load(batches):
        fetch = make_fetcher()
        for batch in batches:
            found = [_fetch(fetch, u, tries, wait) if isinstance(u, str) else (None, None, "no url") for u in batch[url_col]]
            yield batch.assign(data=[f[0] for f in found], status=pd.array([f[1] for f in found], "Int32"), error=[f[2] for f in found])

    return rows.mapInPandas(load, schema)


def _fetch(fetch, url: str, tries: int, wait: float):
    status, error = None, None
    for k in range(tries):
        pause = wait * 2**k
        try:
            status, headers, data = fetch(url)
        except Exception as e:  # whatever the fetcher's transport raises is tried again
            error = str(e)
        else:
            if status == 200:
                return data, status, None
            error = f"status {status}"
            if status != 429 and status < 500:
                break
            after = str(headers.get("Retry-After", ""))
            pause = int(after) if status == 429 and after.isdigit() else pause
        if k + 1 < tries:
            time.sleep(pause)
    return None, status, error


def image_bytes(df: DataFrame, name: str) -> Column:
    """Bytes of an image column: ``{bytes}`` or binary."""
    return F.col(f"{name}.bytes") if dict(df.dtypes)[name].startswith("struct") else F.col(name)


def rows_in(df: DataFrame, index: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """Rows whose stored index lies in the ranges: a predicate that Parquet row groups are pruned by."""
    hit = [F.col(index).between(lo, hi) for lo, hi in ranges]
    return df.where(reduce(lambda a, b: a | b, hit) if hit else F.lit(False))


def captions(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None, order: str = "job_id") -> DataFrame:
    """A store's rows, some columns of it; None and 0 are no limit. Rows with a null key come first where there is a limit."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    if limit:
        rows = rows.orderBy(order).limit(limit)
    return rows.select(*[f"`{c}`" for c in columns]) if columns else rows


def viewer_items(rows: DataFrame, shard: str | None = None) -> DataFrame:
    """A shard's items (all, without one) by item_index, else by job_id; a table without shards is one named ``all``."""
    if "shard" not in rows.columns:
        rows = rows.withColumn("shard", F.lit("all"))
    order = "item_index" if "item_index" in rows.columns else "job_id"
    return (rows.where(F.col("shard") == shard) if shard else rows).orderBy("shard", order)


#: Sides of the two kinds of mock images, and the colour of the second kind, by index.
BLACK_SIDE, COLOUR_SIDE, COLOUR = 128, 256, (37, 53, 71)


def mock_images(spark: SparkSession, n: int, coloured: bool = True) -> DataFrame:
    """(index, width, height, r, g, b): deterministic flat images, of a colour by index or black."""
    i, side = F.col("id"), F.lit(COLOUR_SIDE if coloured else BLACK_SIDE)
    shades = [(i * f % 256 if coloured else F.lit(0).cast("long")).alias(c) for c, f in zip("rgb", COLOUR)]
    return spark.range(n).select(i.alias("index"), side.alias("width"), side.alias("height"), *shades)


def caption_view(spark: SparkSession, path: str, name: str = "captions") -> DataFrame:
    """Register a store for SQL under ``name``, with the fields of all its files; call again after it has gained fields."""
    rows = captions(spark, path)
    rows.createOrReplaceTempView(name)
    return rows
