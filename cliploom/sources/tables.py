"""Reading tables, lines and file listings; writing text, lists and Parquet.

Everything goes through Spark's readers, so any store that Spark reaches works; only
folders by speaker are written and read by Python where the store is a file system.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.columns import stem
from ..schema import conform, struct


def csv_table(spark: SparkSession, path: str, ddl: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """Read as strings, then converted: a bad value becomes null or its default."""
    return conform(csv_strings(spark, path), ddl, defaults)


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Every column a string, missing values empty."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).fillna("")


def parquet_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(struct(ddl)).parquet(path)


def lines(spark: SparkSession, path: str, column: str = "name") -> DataFrame:
    """Trimmed lines that are neither blank nor comments."""
    text = F.trim("value")
    return spark.read.text(path).select(text.alias(column)).where((text != "") & ~text.startswith("#"))


def listing(spark: SparkSession, path: str, *suffixes: str) -> DataFrame:
    """path, length and modificationTime of files below a folder; contents unread."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return found.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*suffixes)) if suffixes else found


def reference_images(spark: SparkSession, path: str) -> DataFrame:
    """speaker_id (before the first _ of the file name), path."""
    return listing(spark, path, ".jpg", ".jpeg", ".png", ".webp", ".bmp").select(F.substring_index(stem("path"), "_", 1).alias("speaker_id"), "path")


def speaker_wavs(spark: SparkSession, path: str) -> DataFrame:
    """speaker_id (the folder), path."""
    return listing(spark, path, ".wav").select(F.element_at(F.split("path", "/"), -2).alias("speaker_id"), "path")


def write_lines(df: DataFrame, path: str, *columns: str) -> None:
    """Columns joined by spaces, a line a row, in the order of df."""
    df.select(F.concat_ws(" ", *(F.col(c).cast("string") for c in columns)).alias("value")).write.mode("overwrite").text(path)


def write_list(df: DataFrame, path: str, column: str) -> int:
    """The rows as write_lines() does, and how many; without any the list is removed."""
    spark, n = df.sparkSession, df.count()
    if n:
        write_lines(df, path, column)
    else:
        here = spark._jvm.org.apache.hadoop.fs.Path(path)
        here.getFileSystem(spark._jsc.hadoopConfiguration()).delete(here, True)
    return n


#: The folder of null, as Spark names it. The empty name shares it, in a file of its own.
NO_NAME, ROWS, EMPTY = "__HIVE_DEFAULT_PARTITION__", "rows.parquet", "empty.parquet"
_ESCAPED = re.compile(rf"""[\x00-\x1f\x7f"#%'*/:=?\\{{\[\]^]|^_(?={NO_NAME[1:]}$)""")
#: Bytes that a worker gathers before it writes them to a file or hands them on, and rows.
HELD_BYTES, HELD_ROWS = 16 << 20, 10000


def _file_path(spark: SparkSession, path: str) -> str | None:
    """The path in the file system that all machines mount, or none for another store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(at).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _parts(spark: SparkSession) -> int:
    """Tasks for work that grows with the folders: by bytes there would be very few."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class _SpeakerFile:
    """The file of one speaker, written below a folder of the task's own and moved whole;
    making folders where all tasks do takes turns for longer than moving them there."""

    def __init__(self, own: str, root: str, speaker: str | None, schema: pa.Schema):
        below = f"speaker_id={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', speaker) if speaker else NO_NAME}"
        self.here, self.there, self.name = f"{own}/{below}", f"{root}/{below}", EMPTY if speaker == "" else ROWS
        self.speaker, self.held, self.bytes = speaker, [], 0
        os.mkdir(self.here)
        self.file = pa.OSFile(f"{self.here}/{self.name}", "wb")
        self.writer = pq.ParquetWriter(self.file, schema, store_schema=False)

    def add(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.bytes += rows.nbytes
        if self.bytes >= HELD_BYTES:
            self._write()

    def _write(self) -> None:
        self.writer.write_table(pa.Table.from_batches(self.held))
        self.held, self.bytes = [], 0

    def close(self) -> None:
        if self.held:
            self._write()
        self.writer.close()
        self.file.close()
        try:
            os.rename(self.here, self.there)
        except OSError:
            if not os.path.isdir(self.there):
                raise
            os.replace(f"{self.here}/{self.name}", f"{self.there}/{self.name}")  # the folder is another attempt's, or null's or the empty name's
            os.rmdir(self.here)


def write_by_speaker(df: DataFrame, path: str) -> None:
    """A folder for each speaker_id, named as partitionBy() does. In a file system the
    folders are written beside the table, whole, then put in its place, by Python: Spark
    took some 18 ms a folder to write and list them. Other stores get Spark's writer."""
    if df.columns == ["speaker_id"]:
        raise ValueError("a table by speaker needs a column besides speaker_id")
    spark = df.sparkSession
    rows = df.withColumn("speaker_id", F.col("speaker_id").cast("string")).repartition(_parts(spark), "speaker_id").sortWithinPartitions("speaker_id")
    if (root := _file_path(spark, path)) is None:
        rows.write.mode("overwrite").partitionBy("speaker_id").parquet(path)
        return
    beside, tasks, before = (f"{root}.{uuid.uuid4().hex}" for _ in range(3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out, n = f"{tasks}/{TaskContext.get().taskAttemptId()}", None, 0
        os.makedirs(own)
        for batch in batches:
            runs, start = pc.run_end_encode(batch["speaker_id"]), 0
            batch = batch.drop_columns("speaker_id")
            for speaker, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if out is None or out.speaker != speaker:
                    if out is not None:
                        out.close()
                    out, n = _SpeakerFile(own, beside, speaker, batch.schema), n + 1
                out.add(batch.slice(start, end - start))
                start = end
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    os.makedirs(beside)
    try:
        rows.mapInArrow(run, "n long").count()
    except BaseException:
        shutil.rmtree(beside, ignore_errors=True)
        raise
    finally:
        shutil.rmtree(tasks, ignore_errors=True)
    if os.path.exists(root):
        os.rename(root, before)
    os.rename(beside, root)
    shutil.rmtree(before, ignore_errors=True)


def read_by_speaker(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that write_by_speaker() wrote, with these columns; speaker_id is text, as
    written. In a file system a task lists the folders and others read them, so that the
    driver holds none of them."""
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "speaker_id" else f for f in schema])
    if (root := _file_path(spark, path)) is None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    arrow = to_arrow_schema(schema)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            held = []
            with os.scandir(root) as entries:
                for e in entries:
                    if e.name.startswith("speaker_id="):
                        held.append(e.name)
                    if len(held) == HELD_ROWS:
                        yield pa.RecordBatch.from_pydict({"name": held})
                        held = []
            yield pa.RecordBatch.from_pydict({"name": pa.array(held, pa.string())})

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, pa.Table]]:
        for name in (n for batch in batches for n in batch["name"].to_pylist()):
            text = name.removeprefix("speaker_id=")
            for file in os.listdir(f"{root}/{name}"):
                if file.startswith((".", "_")):
                    continue
                speaker = unquote(text) if text != NO_NAME else "" if file == EMPTY else None
                with pq.ParquetFile(f"{root}/{name}/{file}") as found:
                    for i in range(found.num_row_groups):
                        yield speaker, found.read_row_group(i, use_threads=False)

    def whole(speakers: list[str | None], tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(tables)
        said = pa.array([s for s, t in zip(speakers, tables) for _ in range(t.num_rows)], pa.string())
        yield from rows.append_column("speaker_id", said).select(arrow.names).cast(arrow).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speakers, tables, n, size = [], [], 0, 0
        for speaker, table in files(batches):
            speakers.append(speaker)
            tables.append(table)
            n, size = n + table.num_rows, size + table.nbytes
            if n >= HELD_ROWS or size >= HELD_BYTES:
                yield from whole(speakers, tables)
                speakers, tables, n, size = [], [], 0, 0
        if tables:
            yield from whole(speakers, tables)

    folders = spark.range(0, 1, 1, 1).mapInArrow(names, "name string")
    return folders.repartition(_parts(spark)).mapInArrow(run, schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
