"""One file per source as a Spark data source, ``books``: any bytes in, bad files as rows.

Files are listed once, ordered by path and grouped into splits by size, so many small files share a
task and a large one has its own. A file that cannot be read gives a row with an ``error`` instead of
a failed job. Writing gives every source a file named by its id; a task that is run again writes
the same files. Paths are local or any address that Arrow's file systems open (HDFS, S3, GCS).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from windrow.functions import text as T
from windrow.scale import ship
from windrow.sources.documents import decode_fallback

SCHEMA = "source_id bigint, path string, content binary, error string"
# Bytes of files that one split takes together, and the most one row may hold.
SPLIT_BYTES = 64 << 20
FILE_BYTES = 1 << 30
ID_PATTERN = r"(\d+)[^/]*$"


@dataclass
class Split(InputPartition):
    paths: list[str]


def opened(path: str):
    """The file system of an address and the path on it."""
    from pyarrow import fs

    address = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(address)


def grouped(sizes: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Neighbouring paths in groups of at most ``most`` bytes; a larger file is alone."""
    groups: list[list[str]] = []
    room = -1
    for path, size in sizes:
        if size > room or not groups:
            groups.append([])
            room = most
        groups[-1].append(path)
        room -= size
    return groups


class BookReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.pattern = options.get("pattern", ID_PATTERN)
        self.split, self.most = int(options.get("splitbytes", SPLIT_BYTES)), int(options.get("filebytes", FILE_BYTES))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, root = opened(self.path)
        if files.get_file_info(root).type == fs.FileType.Directory:
            found = files.get_file_info(fs.FileSelector(root, recursive=True))
        else:
            found = [files.get_file_info(root)]
        # An address with nothing behind it is listed as well; reading it reports the error.
        wanted = sorted((f.path, f.size or 0) for f in found if f.type != fs.FileType.Directory and fnmatch(f.base_name, self.glob)
                        and not f.base_name.startswith(("_", ".")))
        return [Split(paths) for paths in grouped(wanted, self.split)]

    def read(self, partition: Split | None) -> Iterator[tuple]:
        files, _ = opened(self.path)
        for path in partition.paths if partition else []:
            number = re.search(self.pattern, path)
            source_id = int(number.group(1)) if number and number.group(1) else None
            content = error = None
            if source_id is None or not -(1 << 63) <= source_id < 1 << 63:
                source_id, error = None, "no source id in the name"
            else:
                try:
                    with files.open_input_file(path) as f:
                        if f.size() > self.most:
                            error = f"larger than {self.most} bytes"
                        else:
                            content = f.read()
                except OSError as exc:
                    error = f"unreadable: {type(exc).__name__}"
            yield source_id, path, content, error


@dataclass
class Written(WriterCommitMessage):
    files: int


class BookWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> WriterCommitMessage:
        files, root = opened(self.path)
        files.create_dir(root, recursive=True)
        n = 0
        for row in iterator:
            with files.open_output_stream(f"{root}/{row['source_id']}.txt") as out:
                out.write(bytes(row["content"] or b""))
            n += 1
        return Written(n)


class BookSource(DataSource):
    """``spark.read.format("books")``: options ``glob``, ``pattern``, ``splitbytes``, ``filebytes``."""

    @classmethod
    def name(cls) -> str:
        return "books"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BookReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return BookWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(BookSource)


def read_files(spark: SparkSession, path: str, min_chars: int = T.MIN_SOURCE_CHARS, **options) -> DataFrame:
    """``(source_id, path, text, error)``, one row per file: decoded text, or why there is none.

    Take books and rejects out of the same (shared) frame: :func:`good` and :func:`bad`.
    """
    register(spark)
    files = spark.read.format("books").options(**{k: str(v) for k, v in options.items()}).load(path)
    read = files.withColumn("text", decode_fallback("content", min_chars))
    short = F.when(F.col("text").isNull(), F.lit(f"no more than {min_chars} characters"))
    return read.select("source_id", "path", "text", F.coalesce("error", short).alias("error"))


def good(files: DataFrame) -> DataFrame:
    """``books(source_id, text)`` of the files that gave a text."""
    return files.filter(F.col("error").isNull()).select("source_id", "text")


def bad(files: DataFrame) -> DataFrame:
    """``(source_id, path, error)`` of the files that gave none."""
    return files.filter(F.col("error").isNotNull()).select("source_id", "path", "error")


def write_files(books: DataFrame, path: str, content: str = "content") -> None:
    """One file ``<source_id>.txt`` per row of ``books(source_id, content)``, text or bytes."""
    register(books.sparkSession)
    books.select("source_id", F.col(content).cast("binary").alias("content")).write.format("books").mode("append").save(path)
