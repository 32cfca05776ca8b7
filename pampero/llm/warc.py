"""WARC archives with a two-level capture index.

Archives hold records compressed one by one. The index has one line per capture, sorted by the URL's host
reversed; lines lie compressed in blocks, and a sparse directory names the first key of each
block. A search reads the directory's entries of one index part, halves its way to the block,
unpacks that block alone, halves its way to the capture, and reads the record's byte range.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pampero.workspace import new_path, stage

#: Bytes an archive file holds at most, one record more aside; captures in an index block.
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000

#: Parts of an index at most: their spans are all a search keeps on the driver.
MAX_PARTS = 4096

CONTROL = re.compile(r"[\x00-\x1f\x7f]")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "page_id long, url string, archive string, offset long, length long"
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, which is 32 signs without padding: five bytes give
    eight signs, so four numbers of 40 bits are written in base 32 and the signs exchanged."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def surt(url: str | None) -> str:
    """Sort key: host labels reversed, then port, path and query; scheme and fragment go."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return f"){url}"
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{f':{port}' if port else ''}){parts.path or '/'}{query}".lower()


# --- writing ------------------------------------------------------------------------------------


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` for each
    distinct page and payload.

    Of equal payloads of at least ``min_bytes`` bytes the one with the smallest ``page_id`` is
    a response. Equality is of SHA-1, length and a 64-bit hash of another family.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    same = ["payload_digest", "payload_bytes", "payload_check"]
    slim = pages.select(
        "page_id",
        base32_sha1(html.cast("binary")).alias("payload_digest"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.xxhash64(html).alias("payload_check"),
    ).distinct()
    first = slim.groupBy(*same).agg(F.min("page_id").alias("first_id"))
    # A page without an id comes after all that have one.
    later = F.coalesce(F.col("page_id") > F.col("first_id"), F.col("first_id").isNotNull())
    revisit = (F.col("payload_bytes") >= min_bytes) & later
    return slim.join(first, same).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "payload_check",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per page under ``folder``; returns ``surt`` and ``CAPTURE`` of each.

    Every row is a record of its own: rows that repeat a page and its payload are captured
    each, alike. A page whose id is null revisits one that has an id; among pages without any, each
    is a response. Null html is empty; a null URL is left out of the header. Records are compressed one by one, so each
    can be read alone. The captures name the files of tasks that ended well; what a task left
    that did not is in no index.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    plan = plan_records(pages, min_bytes)
    rows = pages.select(
        "page_id", "url", html.cast("binary").alias("html"), F.xxhash64(html).alias("payload_check")
    ).alias("p").join(
        plan.alias("r"),
        F.col("p.page_id").eqNullSafe(F.col("r.page_id"))
        & (F.col("p.payload_check") == F.col("r.payload_check")),
    )
    revisit = F.col("record_type") == "revisit"
    rows = rows.select(
        F.col("p.page_id").cast("long").alias("page_id"),
        "url",
        F.when(revisit, F.lit(b"")).otherwise(F.col("html")).alias("block"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )

    def write(batches):
        create = store().create
        name, stream, offset = None, None, 0
        for batch in batches:
            out = []
            for page, url, block, size, digest, kind, refers in zip(
                *[c.to_pylist() for c in batch.columns]
            ):
                if stream is None or offset >= ARCHIVE_BYTES:
                    if stream:
                        stream.close()
                    name, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    stream = create(name)
                url = None if url is None else CONTROL.sub(" ", url)
                packed = gzip.compress(record(page, url, block, size, digest, kind, refers), 6)
                stream.write(packed)
                out.append((surt(url), page, url, name, offset, len(packed)))
                offset += len(packed)
            yield frame(out)
        if stream:
            stream.close()

    return stage(rows.mapInArrow(write, f"surt string, {CAPTURE}"), "captures")


def record(page, url, block, size, digest, kind, refers) -> bytes:
    identity = hashlib.md5(f"{page}:{digest}".encode()).hexdigest()
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(identity)}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": IDENTICAL if kind == "revisit" else None,
        "X-Page-ID": page,
        "X-Refers-To-Page": refers,
        "X-Payload-Length": size,
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": len(block),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def frame(rows) -> pa.RecordBatch:
    names = ["surt", "page_id", "url", "archive", "offset", "length"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)], names=names
    )


# --- the archives' store ------------------------------------------------------------------------


class store:  # noqa: N801
    """Streams of paths in the store the shared folder is in; one of these per task."""

    def __init__(self):
        self.held: dict[str, object] = {}

    def place(self, path: str):
        from pyarrow import fs

        if "://" not in path or path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        root = "/".join(path.split("/")[:3])
        if root not in self.held:
            self.held[root] = fs.FileSystem.from_uri(root + "/")[0]
        return self.held[root], fs.FileSystem.from_uri(path)[1]

    def create(self, path: str):
        system, inner = self.place(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        return system.open_output_stream(inner, compression=None)

    def open(self, path: str):
        system, inner = self.place(path)
        return system.open_input_file(inner)


def read_record(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header and block of the record in a byte range."""
    stream.seek(offset)
    head, _, rest = zlib.decompress(stream.read(length), 31).partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


# --- index --------------------------------------------------------------------------------------


def index_captures(captures: DataFrame, index: str) -> None:
    """Write the index of captures: ``blocks`` of compressed lines, and their ``directory``."""
    spark = captures.sparkSession
    number = captures.count() // (BLOCK_LINES * 16)
    # Range parts by key, and by page within a key, so that one host or URL holding a third of
    # all captures is cut into as many parts as its size asks for.
    parts = min(MAX_PARTS, max(number, 1))
    ordered = captures.repartitionByRange(parts, "surt", "page_id").sortWithinPartitions(
        "surt", "page_id"
    )

    def blocks(batches):
        held, part, number, first, last = [], None, 0, None, None

        def pack():
            body = zlib.compress("\n".join("\t".join(x) for x in held).encode(), 6)
            names = ["part", "block", "first_key", "last_key", "captures", "body"]
            values = [part, number, first, last, len(held), body]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                part, last = row[-1], row[0]
                first = first if held else last
                # A backslash is doubled, so that no URL looks like a null.
                told = ("\\N" if v is None else str(v).replace("\\", "\\\\") for v in row[:-1])
                held.append(tuple(told))
                if len(held) == BLOCK_LINES:
                    yield pack()
                    held, number = [], number + 1
        if held:
            yield pack()

    (
        ordered.withColumn("part", F.spark_partition_id().cast("long"))
        .mapInArrow(
            blocks,
            "part long, block long, first_key string, last_key string, captures long, body binary",
        )
        .write.parquet(f"{index}/blocks")
    )
    (
        spark.read.parquet(f"{index}/blocks")
        .select("part", "block", "first_key", "last_key")
        .write.parquet(f"{index}/directory")
    )


def unpack(body: bytes) -> list[list[str | None]]:
    lines = zlib.decompress(body).decode().split("\n")
    plain = lambda v: None if v == "\\N" else v.replace("\\\\", "\\")
    return [[plain(v) for v in x.split("\t")] for x in lines]


def capture_rows(lines) -> pa.RecordBatch:
    names = ["page_id", "url", "archive", "offset", "length"]
    as_int = lambda v: None if v is None else int(v)
    columns = [
        pa.array([as_int(x[1]) for x in lines], pa.int64()),
        pa.array([x[2] for x in lines], pa.string()),
        pa.array([x[3] for x in lines], pa.string()),
        pa.array([as_int(x[4]) for x in lines], pa.int64()),
        pa.array([as_int(x[5]) for x in lines], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def all_captures(spark: SparkSession, index: str) -> DataFrame:
    """Every capture of the index, block by block."""

    def expand(batches):
        for batch in batches:
            for body in batch.column(0).to_pylist():
                yield capture_rows(unpack(body))

    return spark.read.parquet(f"{index}/blocks").select("body").mapInArrow(expand, CAPTURE)


def lookup(spark: SparkSession, index: str, urls: DataFrame) -> DataFrame:
    """Captures of the URLs in column ``url``, with all columns of ``CAPTURE``.

    The key of a URL halves its way through the parts' spans, then through the directory of its
    part to its blocks, then through each block, unpacked once for all keys that lead to it.
    Equal URLs, and URLs of one key, are looked for once; what is found under a key is told by
    the whole URL at the end. A null URL finds the captures without a URL.
    """
    asked = urls.select("url").distinct()

    def reverse(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([surt(u) for u in batch.column(0).to_pylist()], pa.string())], names=["surt"]
            )

    keys = asked.mapInArrow(reverse, "surt string").distinct()
    directory = spark.read.parquet(f"{index}/directory")
    # The spans of the parts, at most ``MAX_PARTS`` rows.
    spans = sorted(
        tuple(r)
        for r in directory.groupBy("part")
        .agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
        .select("low", "high", "part")
        .collect()
    )

    def place(batches):
        for batch in batches:
            yield led_to(batch.column(0).to_pylist(), spans, ["surt", "part"])

    placed = keys.mapInArrow(place, "surt string, part long")

    def reach(batches):
        for part, entries, found in met(batches, ["part"]):
            spans = [(r["first_key"], r["last_key"], r["block"]) for r in entries]
            out = led_to(found, spans, ["surt", "block"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array([part[0]] * out.num_rows, pa.int64())],
                names=["surt", "block", "part"],
            )

    entries = directory.select("part", "block", "first_key", "last_key")
    wanted = meeting(entries, placed, ["part"], ["first_key", "block"]).mapInArrow(
        reach, "surt string, block long, part long"
    )

    def search(batches):
        for _, held, found in met(batches, ["part", "block"]):
            lines = [line for r in held for line in unpack(r["body"])]
            first = [x[0] for x in lines]
            spans = [(bisect.bisect_left(first, k), bisect.bisect_right(first, k)) for k in found]
            yield capture_rows([line for low, high in spans for line in lines[low:high]])

    blocks = spark.read.parquet(f"{index}/blocks").select("part", "block", "body")
    found = meeting(blocks, wanted, ["part", "block"], []).mapInArrow(search, CAPTURE)
    told = asked.select(F.col("url").alias("asked"))
    return found.join(told, F.col("url").eqNullSafe(F.col("asked")), "left_semi")


def led_to(keys: list[str], spans: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Keys with the last member of each of the sorted spans ``first, last, ...`` they lie in."""
    lows = [x[0] for x in spans]
    out = []
    for key in keys:
        i = max(bisect.bisect_left(lows, key) - 1, 0)
        while i < len(lows) and lows[i] <= key:
            if spans[i][1] >= key:
                out.append((key, spans[i][2]))
            i += 1
    columns = list(zip(*out)) or [[], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], names=names
    )


def meeting(held: DataFrame, asked: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows of the index and keys asked for, those of a place after one another, the index's first.
    No row of the index is repeated for the keys that meet it."""
    rows = held.unionByName(asked.select(*by, "surt"), allowMissingColumns=True)
    return rows.repartition(*by).sortWithinPartitions(*by, F.col("surt").asc_nulls_first(), *order)


def met(batches, by: list[str]) -> Iterator[tuple[tuple, list[dict], list[str]]]:
    """Places of a `meeting` with their rows of the index and some of the keys asked for there."""
    place, held = None, []
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            here = tuple(r[c] for c in by)
            if here != place:
                if found:
                    yield place, held, found
                place, held, found = here, [], []
            if r["surt"] is None:
                held.append(r)
            else:
                found.append(r["surt"])
        if found:
            yield place, held, found


def read_captures(captures: DataFrame) -> DataFrame:
    """Records of the captures, read by byte range, in ``RECORD``'s columns.

    The digest of a response is taken from the bytes read and must equal the one in its
    header; a revisit carries its original's. A record that does not agree raises.
    """

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reach, path, stream = store().open, None, None
        for frame in frames:
            rows = []
            for c in frame.itertuples(index=False):
                if c.archive != path:
                    if stream:
                        stream.close()
                    path, stream = c.archive, reach(c.archive)
                fields, payload = read_record(stream, int(c.offset), int(c.length))
                told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind, size = fields["WARC-Type"], int(fields["X-Payload-Length"])
                if kind == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != told or len(payload) != size:
                        raise ValueError(f"damaged record at {c.archive}:{c.offset}")
                as_int = lambda v: None if v is None else int(v)
                rows.append(
                    (
                        as_int(fields.get("X-Page-ID")),
                        size,
                        told,
                        kind,
                        as_int(fields.get("X-Refers-To-Page")),
                        payload if kind == "response" else None,
                    )
                )
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            out = pd.DataFrame(rows, columns=names)
            out["page_id"] = out["page_id"].astype("Int64")
            out["refers_to"] = out["refers_to"].astype("Int64")
            yield out
        if stream:
            stream.close()

    # By archive and stretch of it: near ranges are read together, a large archive by many.
    stretch = F.floor(F.col("offset") / F.lit(4 << 20))
    near = captures.repartition("archive", stretch).sortWithinPartitions("archive", "offset")
    return near.mapInPandas(fetch, RECORD)


def archive_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write archives and their index into the shared folder, then read every record back: the
    index is searched for the URLs of the pages, and must lead to as many captures as were written.

    One row per page, ``page_id, payload_bytes, payload_digest, record_type, refers_to``.
    An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder, index = new_path(spark, "warc"), new_path(spark, "cdx")
    captures = write_archives(pages, folder, min_bytes)
    index_captures(captures, index)
    # The header of a record holds no signs of control, and neither do the index's URLs.
    url = F.regexp_replace("url", CONTROL.pattern, " ").alias("url")
    found = stage(lookup(spark, index, pages.select(url)), "found-captures")
    if found.count() != captures.count():
        raise ValueError(f"the index under {index} does not lead to all captures written")
    return read_captures(found).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
