"""Shared pieces of the training-data operators: tables, the shared folder, row keys, small SQL texts."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: U+0020 and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


#: Number of the C library's setting for the least size that is mapped by itself, and so unmapped when it is freed.
_MMAP_THRESHOLD = -3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (`spark.checkpoint.dir`); a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write Parquet to the shared folder under a name of its own and read it from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean() -> None:
    """In a worker: give buffers back to the system as soon as they are free, as several workers share an executor and stay
    alive between tasks."""
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such setting
        ctypes.CDLL(None).mallopt(_MMAP_THRESHOLD, 1 << 20)


def lower_ascii(column: str) -> str:
    """SQL: lower-case A to Z alone. Pure ASCII text takes the fast native path."""
    return (
        f"if(octet_length({column}) = char_length({column}), lower({column}), "
        f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
    )


def let(value: str, name: str, body: str) -> str:
    """SQL: evaluate `value` once and use it as `name` in `body`, which may hold lambdas."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key for joins back to a row. Equal rows share it, and every result that depends on the row alone."""
    return F.xxhash64(F.col(doc_id).cast("string"), F.col(text))


def id_rest(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def sha256(column: str) -> str:
    return f"sha2({column}, 256)"
