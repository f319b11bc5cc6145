"""Tar shards as a Spark data source: one input partition for each shard, one row for each sample."""

from __future__ import annotations

import json
import os
import tarfile
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fields of a sample's metadata that describe its storage.
STORED = ("path", "offset", "size", "width", "height", "aspect", "json_path")


class TarShards(DataSource):
    """``format("tar_shards").option("paths", "a.tar,b.tar")``: ``shard, item_index, key, data, metadata``."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return "shard string, item_index long, key string, data binary, metadata map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return TarReader(self.options["paths"].split(","))


class TarReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Members with the same stem are one sample: JSON is its metadata, the first other member its data."""
        shard = os.path.splitext(os.path.basename(partition.value))[0]
        open_key, data, meta, n = None, None, {}, 0
        with tarfile.open(partition.value) as tar:
            for member in tar:
                if not member.isfile():
                    continue
                key, suffix = os.path.splitext(member.name)
                if key != open_key:
                    if open_key is not None and data is not None:
                        yield shard, n, open_key, data, meta
                        n += 1
                    open_key, data, meta = key, None, {}
                raw = tar.extractfile(member).read()
                if suffix == ".json":
                    try:
                        found = json.loads(raw)
                    except ValueError:
                        found = {}
                    meta = {k: str(v) for k, v in found.items() if not k.startswith("_") and k not in STORED} if isinstance(found, dict) else {}
                elif data is None:
                    data = raw
            if open_key is not None and data is not None:
                yield shard, n, open_key, data, meta
