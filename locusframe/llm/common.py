"""Shared pieces of the corpus operators: tables, Arrow stages, shared files."""

from __future__ import annotations

import gc
import os
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from locusframe.session import materialize, work_dir

#: Rows of an Arrow batch that carries whole texts, so that a batch of very
#: long documents still fits beside the JVM in an executor.
TEXT_BATCH_ROWS = 512

#: Bytes of a word separator: space, tab, line feed, vertical tab, form feed,
#: carriage return. ``bytes.split()`` separates at just these.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage."""
    return materialize(df, label)


def arrow_stage(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
    rows: int = TEXT_BATCH_ROWS,
) -> DataFrame:
    """``mapInArrow`` with batches of at most ``rows`` rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(function, schema)


def utf8_or_empty(column: str) -> Column:
    """The UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; null ids count as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared work folder, as a URI tasks can open."""
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def open_store(uri: str):
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, content: bytes) -> str:
    """Write one file of a task attempt and return its URI.

    The name carries a fresh suffix, so a repeated or speculative attempt never
    touches the file of another; only files named in the stored manifest count.
    """
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    full = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{path}/{full}", compression=None) as out:
        out.write(content)
    return f"{folder}/{full}"


def get_file(uri: str) -> bytes:
    store, path = open_store(uri)
    with store.open_input_stream(path, compression=None) as source:
        return source.read()


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps between tasks for ``owner``, a stage's memory.

    Functions reach workers by value, so their modules' own globals do not
    last. A worker holds the memory of one owner at a time: what another stage
    left behind is dropped and given back to the system, so memories do not add
    up in long applications.
    """
    name = "locusframe_worker_cache"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if kept.get("owner") != owner:
        kept["owner"], kept["held"] = owner, {}
        release_unused()
    return kept["held"]


def release_unused() -> None:
    """Give free memory of Arrow's pool and of the C library's heap back to the
    system; both keep what was freed, beside what the next stage takes."""
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def crc32(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; ``LLM_TOKENIZERS`` names another folder."""
    folder = os.environ.get("LLM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
