"""What the operators of this subpackage share: session settings, column
handling, the shared folder, and bounded chunks of an Arrow stream.

Null or missing values have one meaning everywhere here: a null text counts as
the empty text. Operators select the columns they need by name first, so extra
columns (clashing names included) never reach their plans.
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a Python worker handles at once.
CHUNK_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or, only
    where it is unset and all runs in one process (tests), a new one. On a cluster a
    machine's own folder would be no shared one, so there it must be set."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cliploom-shared-")
        context.setCheckpointDir(found)
    return found.rstrip("/")


#: Folders that written() made and nothing has deleted yet.
_folders: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once as Parquet to the shared folder and read again: cuts the
    lineage, survives lost executors, and is compressed on disk."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cliploom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _folders.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    here = spark._jvm.org.apache.hadoop.fs.Path(path)
    here.getFileSystem(spark._jsc.hadoopConfiguration()).delete(here, True)


def release(*frames: DataFrame) -> None:
    """Deletes the folders of written() tables that nothing reads any more."""
    for df in frames:
        if (path := getattr(df, "folder", None)) in _folders:
            _folders.remove(path)
            delete(df.sparkSession, path)


def held() -> int:
    """A mark for release_since()."""
    return len(_folders)


def release_since(spark: SparkSession, mark: int) -> None:
    """Deletes every folder that written() has made since the mark. A result that
    reads them must have been stored elsewhere first."""
    while len(_folders) > mark:
        delete(spark, _folders.pop())


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty), and the further columns asked for."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes: a session's own bound stays where it is lower."""
    key, bound = "spark.sql.execution.arrow.maxBytesPerBatch", 4 * CHUNK_BYTES
    said = "".join(c for c in spark.conf.get(key) if c.isdigit())
    if not said or int(said) > bound:
        spark.conf.set(key, str(bound))


def trim() -> None:
    """Gives back to the system what this Python worker has freed: workers live on from
    stage to stage, and memory they keep counts for the executor."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of text each, or one row. At the
    end the worker gives back what it no longer needs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
    trim()


#: Values of a label that a model is fitted for, the most frequent ones.
MOST_LABELS = 256


def bounded_sample(rows: DataFrame, by: str, most: int) -> DataFrame:
    """At most `most` rows of each of the MOST_LABELS most frequent values of `by`,
    those whose doc_id hashes lowest. Counts thin the rows first, so that what is
    ranked stays a few times the sample however large the table is."""
    counted = rows.groupBy(by).count().orderBy(F.desc("count"), by).limit(MOST_LABELS).collect()
    kind, share, at = rows.schema[by].dataType, fresh(rows, "share"), fresh(rows, "at")
    shares = [(r[by], int(min(1.0, (2 * most + 100) / r["count"]) * (1 << 30))) for r in counted]
    schema = T.StructType([T.StructField(by, kind), T.StructField(share, T.LongType())])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    thin = rows.join(F.broadcast(rows.sparkSession.createDataFrame(shares, schema)), by).where(draw < F.col(share))
    order = Window.partitionBy(by).orderBy(draw, "doc_id")
    return thin.withColumn(at, F.row_number().over(order)).where(F.col(at) <= most).drop(at, share).select(*rows.columns)


def broadcast_if_small(df: DataFrame, most: int = 1 << 20) -> DataFrame:
    """df, written, with a broadcast hint only if it has at most `most` rows."""
    kept = written(df, "keys")
    return F.broadcast(kept) if kept.count() <= most else kept


def tokenizer_path(name: str) -> str:
    """A vocabulary file: in the folder CLIPLOOM_TOKENIZERS names, else in the
    public_tokenizers package installed on every machine."""
    if folder := os.environ.get("CLIPLOOM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
