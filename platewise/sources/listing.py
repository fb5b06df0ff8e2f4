"""Recursive file listing as a table of paths.

Spark's own ``binaryFile`` listing leaves out empty files and names starting
with a dot or underscore, so image trees are walked by a small data source.
Each partition walks some of the folders directly below the root.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "file_listing"
BATCH_PATHS = 10_000


class Folder(InputPartition):
    def __init__(self, path: str, recursive: bool):
        super().__init__(path)
        self.path = path
        self.recursive = recursive


class ListingReader(DataSourceReader):
    def __init__(self, root: str, suffix: str, depth: int):
        self.root, self.suffix, self.depth = root, suffix, depth

    def partitions(self) -> list[Folder]:
        """Folders ``depth`` levels down are walked in parallel, the ones above just listed."""
        files, root = fs.FileSystem.from_uri(self.root)
        level, shallow = [root], []
        for _ in range(self.depth):
            shallow += level
            level = [
                entry.path
                for folder in level
                for entry in files.get_file_info(fs.FileSelector(folder))
                if entry.type == fs.FileType.Directory
            ]
        return [Folder(p, False) for p in shallow] + [Folder(p, True) for p in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.root)
        selector = fs.FileSelector(partition.path, recursive=partition.recursive)
        paths = [
            entry.path
            for entry in files.get_file_info(selector)
            if entry.type == fs.FileType.File and entry.path.endswith(self.suffix)
        ]
        for start in range(0, len(paths), BATCH_PATHS):
            yield pa.RecordBatch.from_pydict({"path": paths[start : start + BATCH_PATHS]})


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string"

    def reader(self, schema) -> ListingReader:
        options = self.options
        return ListingReader(options["path"], options.get("suffix", ""), int(options.get("depth", 1)))


def list_files(spark: SparkSession, root: str, suffix: str = ".tif", depth: int = 1) -> DataFrame:
    """Paths of all files under ``root`` with the case-sensitive suffix.

    ``depth`` is the folder level at which the walk is split into tasks: 1 for a
    plate's time points, 2 for a folder of plates.
    """
    spark.dataSource.register(ListingSource)
    return spark.read.format(FORMAT).options(suffix=suffix, depth=str(depth)).load(root)
