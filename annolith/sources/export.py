"""Sinks: JSONL, CSV, Parquet, a file for each row, keyed caption maps, dataset cards."""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FORMATS = ("jsonl", "csv", "parquet", "json", "txt")


def shard_path(target: str, shard: str, form: str) -> str:
    """``stem_shard.suffix`` of a file name, else ``dir/shard.form``; ``dir/shard`` for formats of many files."""
    base, suffix = os.path.splitext(target)
    if form in ("json", "txt"):
        return os.path.join(target, shard)
    return f"{base}_{shard}{suffix}" if suffix else os.path.join(target, f"{shard}.{form}")


def json_line(df: DataFrame) -> Column:
    """All columns as one JSON object, nulls kept, times in ISO form."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def flat_list(c: Column) -> Column:
    """Items a line each, line feeds within them as blanks."""
    return F.array_join(F.transform(c, lambda x: F.replace(x, F.lit("\n"), F.lit(" "))), "\n")


def csv_ready(df: DataFrame, outputs: list[str]) -> DataFrame:
    """Columns that CSV can hold, by schema: scalars, and output lists flattened; an error if none is left."""
    kept = []
    for name, kind in df.dtypes:
        if kind == "array<string>" and name in outputs:
            kept.append(flat_list(F.col(f"`{name}`")).alias(name))
        elif not kind.startswith(("array", "map", "struct")):
            kept.append(F.col(f"`{name}`"))
    if not kept:
        raise ValueError("no column that CSV can hold")
    return df.select(*kept)


def write(df: DataFrame, target: str, form: str, *, outputs: list[str] = (), content: str | None = None, name: Column | None = None) -> int:
    """Write all rows to ``target``; the number of rows written, counted on the way."""
    observed = Observation()
    if form not in ("json", "txt"):
        df = df.observe(observed, F.count(F.lit(1)).alias("n"))
    if form == "jsonl":
        df.select(json_line(df).alias("value")).write.text(target)
    elif form == "csv":
        csv_ready(df, list(outputs)).write.option("header", True).option("multiLine", True).csv(target)
    elif form in ("parquet", "lance"):
        df.write.mode("errorifexists").option("compression", "snappy").parquet(target)
    elif form in ("json", "txt"):
        return _row_files(df, target, form, content, name)
    else:
        raise ValueError(f"unknown format {form}")
    return observed.get["n"]


def selected(df: DataFrame, columns: list[str] | None = None, *, limit: int | None = None, filled: str | None = None, order: str = "job_id") -> DataFrame:
    """What an export writes: some columns (unknown names are an error), rows in which ``filled`` has a value that is no empty list, the first ``limit`` by ``order`` (None and 0: all)."""
    if unknown := [c for c in columns or [] if c not in df.columns]:
        raise ValueError(f"no such columns: {unknown}")
    if filled:
        c = F.col(f"`{filled}`")
        df = df.where(F.size(c) > 0 if dict(df.dtypes)[filled].startswith("array") else c.isNotNull())
    if limit:
        df = df.orderBy(order).limit(limit)
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


def export_all(df: DataFrame, target: str, *, forms: tuple[str, ...] = FORMATS, **how) -> dict[str, int]:
    """Rows written in each format, to ``target/<format>``; a format that fails counts 0 and the others go on."""
    done = {}
    for form in forms:
        try:
            done[form] = write(df, os.path.join(target, form), form, **how)
        except Exception as e:  # one format's failure is reported, as 0 rows, and does not end the others
            logging.getLogger(__name__).warning("export as %s failed: %s", form, e)
            done[form] = 0
    return done


def export_shards(shards: dict[str, DataFrame], target: str, form: str, **how) -> dict[str, int]:
    """Rows written of each shard, to the path that :func:`shard_path` gives; a single shard goes to ``target`` itself."""
    if len(shards) == 1:
        ((name, rows),) = shards.items()
        return {name: write(rows, target, form, **how)}
    return {name: write(rows, shard_path(target, name, form), form, **how) for name, rows in shards.items()}


def _row_files(df: DataFrame, target: str, form: str, content: str | None, name: Column) -> int:
    """A file for each row, named by ``name``; rows without name or content are left out, an empty list writes an empty file.

    Written by the executors, so the target is a folder that they all see.
    """
    body = json_line(df) if form == "json" else (flat_list(F.col(content)) if dict(df.dtypes)[content].startswith("array") else F.col(content).cast("string"))
    rows = df.select(name.alias("name"), body.alias("body")).where("name is not null and name <> '' and body is not null")

    def put(batches: Iterator) -> Iterator:
        import pandas as pd

        os.makedirs(target, exist_ok=True)
        for batch in batches:
            for n, b in zip(batch["name"], batch["body"]):
                text = json.dumps(json.loads(b), indent=2, ensure_ascii=False) if form == "json" else b
                with open(os.path.join(target, f"{n}.{form}"), "w", encoding="utf-8") as file:
                    file.write(text)
            yield pd.DataFrame({"n": [len(batch)]})

    return rows.mapInPandas(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def keyed_captions(df: DataFrame, key: Column, captions: Column, order: str) -> DataFrame:
    """(key, captions): of each key the last row by ``order``; null keys, and rows without a non-empty caption, are dropped."""
    kept = F.filter(captions, lambda x: x.isNotNull() & (x != ""))
    rows = df.select(key.alias("key"), kept.alias("captions"), F.col(order).alias("_o")).where((F.col("key") != "") & (F.size("captions") > 0))
    return rows.groupBy("key").agg(F.max_by("captions", "_o").alias("captions"))


def merge_metadata(target: str, captions: dict[str, list[str]]) -> int:
    """Captions put into an existing shard's metadata file, by key; how many keys it had."""
    with open(target, encoding="utf-8") as file:
        data = json.load(file)
    files = data.get("files", data)
    hit = [k for k in captions if k in files]
    for k in hit:
        files[k]["captions"] = captions[k]
    with open(target, "w", encoding="utf-8") as file:
        json.dump(data, file, ensure_ascii=False, indent=2)
    return len(hit)


def dataset_card(name: str, n_rows: int, category: str, fields: dict[str, int], tags: tuple[str, ...] = ()) -> str:
    """A dataset's description with size, fields and tags."""
    head = ["---", f"size_categories:\n- {category}", *(["tags:", *[f"- {t}" for t in tags]] if tags else []), "---", f"# {name}", "", f"{n_rows:,} rows.", "", "| field | outputs |", "|-|-|"]
    return "\n".join([*head, *[f"| {k} | {v:,} |" for k, v in sorted(fields.items())], ""])


def compact(df: DataFrame, target: str, files: int) -> None:
    """Rewrite a store in fewer files, beside the old one; the caller swaps them."""
    df.coalesce(files).write.mode("errorifexists").parquet(target)


def stem_collisions(df: DataFrame, name: Column) -> DataFrame:
    """(name, n) of names that several rows share, whose files would overwrite each other."""
    return df.groupBy(name.alias("name")).agg(F.count("*").alias("n")).where("n > 1 and name is not null")


def keyed_value(kind: str, name: str) -> Column:
    """A caption column for :func:`keyed_captions`: a text as a list of one, a list as it is; other types are an error."""
    if kind == "string":
        return F.array(name)
    if kind == "array<string>":
        return F.col(name)
    raise TypeError(f"no captions in a column of type {kind}")


def swap_in(spark, written: str, target: str) -> None:
    """Put a compacted store in the place of the old one, which stays beside it until the new one stands, and then goes."""
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    files = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{target}.old"
    if files.exists(path(target)) and not files.rename(path(target), path(old)):
        raise OSError(f"cannot move {target}")
    if not files.rename(path(written), path(target)):
        files.rename(path(old), path(target))
        raise OSError(f"cannot move {written}")
    files.delete(path(old), True)
