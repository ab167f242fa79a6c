"""Operator 1: WARC archives and their merged capture index.

Writing: one record per page, a gzip member each. Of pages with equal payloads
the one with the largest ``page_id`` is stored, the others are revisits of it.
Reading: every archive is scanned once; its captures, sorted by URL key, time
and id, are one run. Merging: key ranges of all runs meet in a partition each,
where a loser tree merges the runs' slices; partitions and their rows together
are the capture history in global order.

Defined results: a null html is an empty payload; payloads shorter than
``dedup_bytes`` are all stored; rows with one id and one payload are all
responses if that id is the largest; a null id counts below all others, and
its revisits refer to the stored page; a null url has an empty URL key; blanks
and control characters of a url are percent-encoded in the record; an empty
table writes no archive; other columns are left out.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import arrow_stage, get_file, put_file, shared_folder, stored, table

#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 16 * 1024 * 1024
#: Time of page 0 where pages carry none; page n is n seconds later.
_FIRST_CAPTURE = dt.datetime(2020, 1, 1, tzinfo=dt.UTC)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = (
    "url_key string, timestamp string, page_id long, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, uri string, offset long, length long"
)
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64()}
_KEY = ("url_key", "timestamp", "page_id")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """Sort-friendly key: reversed host labels, then path and query."""
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (",".join(reversed(host.split("."))) + ")" + tail).lower()


def _record(kind: str, page_id: int | None, url: str, digest: str, refers_to: int | None, payload: bytes) -> bytes:
    time = _FIRST_CAPTURE + dt.timedelta(seconds=(page_id or 0) % 3_000_000_000)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {time:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {quote(url, safe='%/:?#[]@!$&()*+,;=~.-_' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(content: bytes) -> bytes:
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def write_archives(pages: DataFrame, dedup_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; the stored manifest.

    Only digests that occur twice are joined back to the pages, on a digest
    made before the shuffle; AQE splits a digest with very many pages.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    digest = F.sha1(payload.cast("binary")).alias("sha")
    twice = (
        rows.where(F.octet_length(payload) >= dedup_bytes)
        .select("page_id", digest)
        .groupBy("sha")
        .agg(F.max("page_id").alias("stored_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = rows.select("page_id", "url", payload.cast("binary").alias("payload"), digest).join(twice, "sha", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, members, held, made = TaskContext.get().partitionId(), [], 0, 0

        def flush():
            nonlocal held, made
            uri = put_file(folder, f"part-{part:06d}-{made:04d}.warc.gz", b"".join(members))
            count = len(members)
            members.clear()
            held, made = 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([count], pa.int64())], names=["uri", "records"])

        for batch in batches:
            for row in batch.to_pylist():
                page_id, first = row["page_id"], row["stored_id"]
                again = first is not None and page_id != first
                members.append(
                    _gzip(
                        _record(
                            "revisit" if again else "response",
                            page_id,
                            row["url"] or "",
                            sha1_base32(row["payload"]),
                            first,
                            row["payload"],
                        )
                    )
                )
                held += len(members[-1])
                if held >= archive_bytes:
                    yield flush()
        if members:
            yield flush()

    wide = joined.select("page_id", "url", "payload", "stored_id")
    return stored(arrow_stage(wide, run, "uri string, records long", rows=256), "warc-manifest")


def read_members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and bytes of every gzip member."""
    at, view = 0, memoryview(content)
    while at < len(content):
        unpack, parts, fed = zlib.decompressobj(31), [], at
        while not unpack.eof:
            piece = view[fed : fed + 65536]
            if not len(piece):
                raise ValueError("archive ends inside a record")
            parts.append(unpack.decompress(piece))
            fed += len(piece)
        length = fed - len(unpack.unused_data) - at
        yield at, length, b"".join(parts)
        at += length


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(record: bytes) -> dict:
    """Index fields of one record; digest and length are of its own payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    kind, url = fields["WARC-Type"], fields["WARC-Target-URI"]
    payload = block.partition(b"\r\n\r\n")[2]
    whole = kind == "response"
    return {
        "url_key": url_key(url),
        "timestamp": fields["WARC-Date"].translate(str.maketrans("", "", "-:TZ")),
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": url,
        "record_type": kind,
        "payload_digest": sha1_base32(payload) if whole else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": len(payload) if whole else None,
        "refers_to": _page(fields.get("WARC-Refers-To")),
    }


def _sort_key(row: dict) -> tuple:
    return tuple((row[k] is not None, row[k] if row[k] is not None else 0) for k in _KEY)


def _as_batch(rows: list[dict], extra: dict | None = None) -> pa.RecordBatch:
    types = dict(c.split() for c in _INDEX.split(", ")) | (extra or {})
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], _TYPES[t]) for n, t in types.items()], names=list(types)
    )


def index_runs(manifest: DataFrame) -> DataFrame:
    """One sorted run of captures per archive (``run``: its URI), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = [
                    parse_record(record) | {"uri": uri, "offset": offset, "length": length}
                    for offset, length, record in read_members(get_file(uri))
                ]
                rows.sort(key=_sort_key)
                for low in range(0, len(rows), 4096):
                    yield _as_batch(rows[low : low + 4096])

    parts = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return stored(arrow_stage(manifest.select("uri").repartition(parts, "uri"), run, _INDEX), "capture-runs")


class LoserTree:
    """Merges sorted iterables; each step plays one path from leaf to root."""

    def __init__(self, sources: Iterable[Iterator[tuple]]):
        self._sources = list(sources)
        count = max(1, len(self._sources))
        self._heads = [next(s, None) for s in self._sources] or [None]
        self._losers = [-1] * count
        for leaf in range(count):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        if b < 0 or self._heads[a] is None:
            return False
        return self._heads[b] is None or (self._heads[a], a) < (self._heads[b], b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self._losers)) // 2
        while node > 0:
            other = self._losers[node]
            if other < 0:
                # Filling the tree: the first to arrive waits here.
                self._losers[node] = winner
                return
            if self._before(other, winner):
                self._losers[node], winner = winner, other
            node //= 2
        self._losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while True:
            winner = self._losers[0]
            head = self._heads[winner]
            if head is None:
                return
            yield head
            self._heads[winner] = next(self._sources[winner], None)
            self._play(winner)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in global order, with ``shard`` (key range) and ``rank``
    (place in it).

    A range holds whole keys of (URL key, time, id), so one URL with very many
    captures is spread over ranges by time.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slices: dict[str, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                slices.setdefault(row["uri"], []).append(row)
        shard, rank, rows = TaskContext.get().partitionId(), 0, []
        tree = LoserTree(
            # A run's slice may arrive in several pieces.
            iter(sorted(((_sort_key(r), r["uri"], r["offset"], i) for i, r in enumerate(part)), key=lambda x: x))
            for _, part in sorted(slices.items())
        )
        for _, uri, _, i in tree:
            rows.append(slices[uri][i] | {"shard": shard, "rank": rank})
            rank += 1
            if len(rows) == 4096:
                yield _as_batch(rows, {"shard": "long", "rank": "long"})
                rows = []
        if rows:
            yield _as_batch(rows, {"shard": "long", "rank": "long"})

    ranged = runs.repartitionByRange(*(F.col(k) for k in _KEY))
    return arrow_stage(ranged, merge, f"{_INDEX}, shard long, rank long", rows=4096)


def with_payload_size(captures: DataFrame) -> DataFrame:
    """``payload_bytes`` of revisits taken from the record they refer to."""
    sizes = captures.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("full"))
    again = captures.where("record_type = 'revisit'").select("payload_digest").distinct()
    joined = captures.join(sizes.join(again, "payload_digest", "left_semi"), "payload_digest", "left")
    full: Column = F.coalesce("payload_bytes", "full")
    return joined.withColumn("payload_bytes", full).drop("full").select(*captures.columns)


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives and the merged index of their captures."""
    runs = index_runs(write_archives(table(spark, sf_dir, "pages")))
    history = merge_runs(stored(with_payload_size(runs), "sized-runs"))
    return history.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "shard", "rank"
    )
