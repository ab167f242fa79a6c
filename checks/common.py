"""Shared pieces of the registered queries."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import DATASETS, stored, v_covariates, v_dosage, v_traits
from locusframe.config import Thresholds
from locusframe.plans.association import Association, run_association

LIMITS = Thresholds(min_freq=0.1, min_ac=5)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def phenotypes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two datasets of two traits each, whose order is not that of their names."""
    wide = v_traits(spark, sf_dir)
    return {
        DATASETS[0]: wide.select("iid", "order_total", "acct_bal"),
        DATASETS[1]: wide.select("iid", "order_count", "founder_score"),
    }


def association(spark: SparkSession, sf_dir: str) -> Association:
    """The association run on the driver's tables, once per application."""
    return stored(
        spark, sf_dir, "association",
        lambda: run_association(
            v_dosage(spark, sf_dir), phenotypes(spark, sf_dir), v_covariates(spark, sf_dir), LIMITS
        ),
    )


def block_bytes(pieces: Iterable[bytes], raw: int = 0xFF00) -> Iterable[bytes]:
    """Text as gzip members that state their size, and the empty last one."""

    def member(text: bytes) -> bytes:
        body = zlib.compressobj(6, zlib.DEFLATED, -15)
        packed = body.compress(text) + body.flush()
        head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(packed) + 25)
        return head + packed + struct.pack("<II", zlib.crc32(text), len(text))

    rest = b""
    for piece in pieces:
        rest += piece
        while len(rest) >= raw:
            yield member(rest[:raw])
            rest = rest[raw:]
    if rest:
        yield member(rest)
    yield member(b"")


def write_blocks(lines: DataFrame, folder: str, name: str) -> None:
    """Test input: the column ``value`` as block-compressed files, one for each
    partition."""
    from pyarrow import fs

    place = folder if "://" in folder or folder.startswith("file:") else f"file:{folder}"

    def write(batches):
        local = place.startswith("file:")
        store, path = (fs.LocalFileSystem(), "/" + place[5:].lstrip("/")) if local else fs.FileSystem.from_uri(place)
        store.create_dir(path, recursive=True)
        text = ("".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode() for batch in batches)
        with store.open_output_stream(f"{path}/{name}-{uuid.uuid4().hex}.vcf.gz", compression=None) as out:
            for block in block_bytes(text):
                out.write(block)
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], names=["n"])

    lines.mapInArrow(write, "n int").collect()
