"""WARC archives of pages, and one globally ordered index of all their captures.

Archives are files of gzip members, one record each, as crawlers write them. Spark's text writer commits them: a record's
line is its members without the last byte, and the line separator is that byte, a zero (the top of the last member's length;
records of 16 MB and more end in a second, short member). Equal payloads are stored once, later captures are revisits.

Reading an archive gives a run: its captures sorted by URL key and time. All runs are merged as an external sort merges
them: captures are dealt out by key ranges, and each range's task merges its slices of all runs with a loser tree. A URL
with any number of captures spreads over ranges by time, so no range has to hold more than its share.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskflow.llm import store
from riskflow.llm.text import blocks as text_blocks

LEAST_SHARED = 100
#: An archive is closed once it has so many bytes; reading takes whole archives.
ARCHIVE_BYTES = 64_000_000
#: Captures that one task merges, about.
RANGE_ROWS = 200_000
LEVEL = 6
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_LATEST = int((datetime(9999, 12, 31, tzinfo=timezone.utc) - _EPOCH).total_seconds()) * 1_000_000
_EARLIEST = int((datetime(1, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds()) * 1_000_000
_LONG, _TEXT = pa.int64(), pa.string()


# ---- records -----------------------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """Host labels from the right, then path and sorted query: ``com,example)/a?x=1``. Scheme, ``www.``, standard ports,
    user and fragment are left out; what cannot be parsed is its own key in lower case; null is empty."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    labels = ",".join(reversed(host.split(".")))
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{labels}{'' if port in (None, 80, 443) else f':{port}'}){parts.path or '/'}{query}".lower()


def warc_date(micros: int) -> str:
    at = _EPOCH + timedelta(microseconds=min(max(micros, _EARLIEST), _LATEST))
    return at.isoformat(timespec="microseconds" if at.microsecond else "seconds").replace("+00:00", "Z")


def date_micros(text: str) -> int:
    return (datetime.fromisoformat(text.replace("Z", "+00:00")) - _EPOCH) // timedelta(microseconds=1)


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(row: dict, payload: bytes) -> bytes:
    """A response or revisit record as gzip members; the last byte of the last one is zero."""
    revisit = row["refers_to_record"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{row['record_id']}>",
             f"WARC-Date: {warc_date(row['captured_at'])}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{row['digest']}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_header_value(row['url'])}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{row['refers_to_record']}>"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    whole = head + b"\r\n\r\n" + block + b"\r\n\r\n"
    if len(whole) & 0xFFFFFFFF < 1 << 24:
        return _member(whole)
    return _member(whole[:-4]) + _member(whole[-4:])


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, wbits=31)
    return pack.compress(data) + pack.flush()


def members(archive: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, length and content of each gzip member."""
    view, at = memoryview(archive), 0
    while at < len(view):
        unpack, end, parts, step = zlib.decompressobj(wbits=31), at, [], 4096
        while not unpack.eof:
            if end >= len(view):
                raise ValueError(f"archive ends within the record at {at}")
            parts.append(unpack.decompress(view[end : end + step]))
            end, step = min(end + step, len(view)), 4 * step
        end -= len(unpack.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def records(archive: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """Start, length, header fields (lower-case names) and block of each record."""
    start, size, data = 0, 0, b""
    for at, length, more in members(archive):
        start, size, data = (at, length, more) if not data else (start, size + length, data + more)
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not mark or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {start}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        n = int(fields["content-length"])
        if len(rest) < n + 4:
            continue
        if rest[n:] != b"\r\n\r\n":
            raise ValueError(f"the record at {start} does not end where it should")
        yield start, size, fields, rest[:n]
        data = b""
    if data:
        raise ValueError(f"the record at {start} is cut off")


# ---- writing -----------------------------------------------------------------------------------

_PAGE_KEY = ("page_id", "url", "captured_at")


def captures(pages: DataFrame, captured_at: Column | None = None) -> DataFrame:
    """page_id, url, captured_at (microseconds), html and its sha256; a null payload is empty, a null time 1970-01-01."""
    own = captured_at if captured_at is not None else F.lit(None).cast("timestamp")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.unix_micros(own), F.lit(0)).cast("long").alias("captured_at"), html.alias("html"), F.sha2(html, 256).alias("digest"))


def _record_id(*extra: Column) -> Column:
    """A UUID that depends on the capture alone."""
    h = F.md5(F.to_json(F.struct("digest", *_PAGE_KEY, *extra), {"ignoreNullFields": "false"}))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def shared_payloads(rows: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Payloads of at least ``least`` bytes that occur more than once: digest, the first capture, its rows and its record.

    First is the smallest page_id (null last), then url and time. Counted before anything moves, so a payload that a
    third of all pages have is one row for each task.
    """
    per = rows.where(F.octet_length("html") >= least).groupBy("digest", *_PAGE_KEY).agg(F.count("*").alias("n"))
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "captured_at", "n")
    heads = per.groupBy("digest").agg(F.min(order).alias("first"), F.sum("n").alias("total")).where("total > 1")
    heads = heads.select("digest", *[F.col(f"first.{c}").alias(c) for c in _PAGE_KEY], F.col("first.n").alias("n"))
    return heads.withColumn("head_record", _record_id())


def write(pages: DataFrame, path: str, captured_at: Column | None = None, archive_bytes: int = ARCHIVE_BYTES, least: int = LEAST_SHARED) -> None:
    """One record per row of ``pages`` (page_id, url, html), in archives of about ``archive_bytes`` below ``path``.

    Of captures with equal payloads of at least ``least`` bytes the one with the smallest page_id is a response, the
    others are revisits of it; shorter payloads are always stored. Of rows equal in page_id, url and payload one is the
    response. A null url or page_id has no header field; control characters in a url are percent-encoded. An empty table
    writes no archive. Other columns are not read.
    """
    spark = pages.sparkSession
    store.prepare(spark)
    rows = captures(pages, captured_at)
    heads = store.keep(shared_payloads(rows, least), "shared-payloads")
    first = heads.select(F.col("digest").alias("d"), "head_record", "n", F.struct(*_PAGE_KEY).alias("head"))
    known = rows.join(first, F.col("digest") == F.col("d"), "left").drop("d")
    is_head = F.col("head").isNotNull() & F.col("head").eqNullSafe(F.struct(*_PAGE_KEY))
    # A row that is a payload's only first capture, or has a payload of its own, is stored.
    stored = F.col("head").isNull() | (is_head & (F.col("n") == 1))
    plain = known.where(~(is_head & (F.col("n") > 1))) if _any(heads.where("n > 1")) else known
    out = plain.withColumns({
        "refers_to_record": F.when(stored, None).otherwise(F.col("head_record")), "record_id": F.when(is_head, F.col("head_record")).otherwise(F.uuid())})
    names = [*_PAGE_KEY, "html", "digest", "refers_to_record", "record_id"]
    out = out.select(*names)
    if plain is not known:
        out = out.unionByName(_equal_rows(known.where(is_head & (F.col("n") > 1)), names))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            for part in text_blocks(batch, "html"):
                lines, segment = [], []
                for row in part.to_pylist():
                    data = record(row, row["html"].encode())
                    lines.append(data[:-1])
                    segment.append(written // archive_bytes)
                    written += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array(segment, pa.int32())], names=["line", "segment"])

    lines = out.mapInArrow(archived, "line binary, segment int").select(F.col("line").cast("string").alias("value"), "segment")
    lines.write.partitionBy("segment").option("lineSep", "\0").text(f"{path}/archives")
    store.release(spark)
    store.remove(spark, [heads])


def _any(df: DataFrame) -> bool:
    return bool(df.take(1))


def _equal_rows(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows that equal each other in everything: one response, the others revisits of it, made from the count in steps."""
    one = rows.dropDuplicates(["digest"])
    response = one.withColumns({"refers_to_record": F.lit(None).cast("string"), "record_id": F.col("head_record")})
    step = 10_000
    parts = one.select(*_PAGE_KEY, "html", "digest", "head_record", "n").withColumn("html", F.lit("")).withColumn("from", F.explode(F.sequence(F.lit(2).cast("long"), F.col("n"), F.lit(step).cast("long"))))
    each = parts.repartition("digest", "from").withColumn("copy", F.explode(F.sequence("from", F.least("n", F.col("from") + step - 1))))
    again = each.withColumns({"refers_to_record": F.col("head_record"), "record_id": _record_id(F.col("copy"))})
    return response.select(*names).unionByName(again.select(*names))


# ---- runs --------------------------------------------------------------------------------------

_ENTRY = {
    "url_key": _TEXT, "captured_at": _LONG, "page_id": _LONG, "url": _TEXT, "record_id": _TEXT, "record_type": _TEXT, "payload_bytes": _LONG, "payload_digest": _TEXT,
    "refers_to_record": _TEXT, "archive": _TEXT, "start": _LONG, "length": _LONG,
}
_KINDS = {_LONG: "bigint", _TEXT: "string"}
ENTRY_SCHEMA = ", ".join(f"{k} {_KINDS[t]}" for k, t in _ENTRY.items())
ORDER = ("url_key", "captured_at", "page_id", "archive", "start")


def _key(row: dict) -> tuple:
    """Order of captures; the last two make it total."""
    return row["url_key"], row["captured_at"], row["page_id"] is not None, row["page_id"] or 0, row["archive"], row["start"]


def _urn(text: str | None) -> str | None:
    return text and text.removeprefix("<urn:uuid:").removesuffix(">")


def run(archive: str, content: bytes) -> list[dict]:
    """The captures of one archive in order. A stored payload is measured and must have the digest its header says."""
    out = []
    for start, length, fields, block in records(content):
        payload = block.partition(b"\r\n\r\n")[2]
        row = {
            "url_key": url_key(fields.get("warc-target-uri")), "captured_at": date_micros(fields["warc-date"]), "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
            "url": fields.get("warc-target-uri"), "record_id": _urn(fields["warc-record-id"]), "record_type": fields["warc-type"], "payload_bytes": None,
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"), "refers_to_record": _urn(fields.get("warc-refers-to")), "archive": archive, "start": start, "length": length,
        }
        if row["record_type"] == "response":
            row["payload_bytes"] = len(payload)
            if hashlib.sha256(payload).hexdigest() != row["payload_digest"]:
                raise ValueError(f"{archive}, record at {start}: the payload differs from its digest")
        out.append(row)
    return sorted(out, key=_key)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Every archive below ``path`` as a sorted run: the capture's fields and ``at``, its place in the run of its archive."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_ENTRY.items(), ("at", _LONG)])
        for batch in batches:
            for k in range(batch.num_rows):
                found = run(batch.column("path")[k].as_py(), batch.column("content")[k].as_buffer())
                yield pa.RecordBatch.from_pylist([row | {"at": at} for at, row in enumerate(found)], schema)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").load(f"{path}/archives/*/*.txt")
    return files.select("path", "content").mapInArrow(read, f"{ENTRY_SCHEMA}, at bigint")


# ---- merge -------------------------------------------------------------------------------------

class LoserTree:
    """Merges sorted sequences. A node keeps the loser of its match, so the next least takes one match for each level."""

    def __init__(self, sequences: list[Iterator], key: Callable):
        self.sequences, self.key, k = sequences, key, len(sequences)
        self.heads = [next(s, None) for s in sequences]
        self.keys = [self._key(h) for h in self.heads]
        self.losers = [-1] * max(k, 1)
        # Bottom-up: leaves are k to 2 k - 1, node n plays the winners of 2 n and 2 n + 1.
        winners = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self.keys[a] <= self.keys[b] else (b, a)
        self.winner = winners[1] if k > 1 else 0

    def _key(self, head) -> tuple:
        """Sequences that have ended lose every match."""
        return (1,) if head is None else (0, self.key(head))

    def __iter__(self) -> Iterator:
        k = len(self.sequences)
        while k and self.heads[self.winner] is not None:
            best = self.winner
            yield self.heads[best]
            self.heads[best] = next(self.sequences[best], None)
            self.keys[best] = self._key(self.heads[best])
            node = (best + k) // 2
            while node:
                if self.keys[self.losers[node]] < self.keys[best]:
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def _slices(batches: Iterator[pa.RecordBatch]) -> list[list[dict]]:
    """The rows of a range by run, each run in its own order."""
    by: dict[str, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            by.setdefault(row["archive"], []).append(row)
    return [sorted(rows, key=lambda r: r["at"]) for _, rows in sorted(by.items())]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, schema = TaskContext.get().partitionId(), pa.schema([*_ENTRY.items(), ("part", pa.int32()), ("place", _LONG), ("nth", _LONG)])
    out, last, nth = [], None, 0
    for place, row in enumerate(LoserTree([iter(s) for s in _slices(batches)], _key)):
        nth = nth + 1 if row["url_key"] == last else 1
        last = row["url_key"]
        out.append({**{c: row[c] for c in _ENTRY}, "part": part, "place": place, "nth": nth})
        if len(out) == 4096:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def merge(found: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All runs as one ordered index: the captures with ``position`` in the whole and ``capture``, the number among those of
    their URL key. ``found`` should be stored, as its rows are dealt out by sampled bounds."""
    n = max(1, -(-found.count() // range_rows))
    dealt = found.repartitionByRange(n, *ORDER)
    ordered = store.keep(dealt.mapInArrow(_merged, f"{ENTRY_SCHEMA}, part int, place bigint, nth bigint"), "captures")
    # One row per range, and two for the keys at its ends. They are stored, so that Spark knows whether they are small.
    ends = store.keep(ordered.groupBy("part").agg(F.count("*").alias("n"), F.min_by("url_key", "place").alias("a"), F.max_by("url_key", "place").alias("b")), "capture-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = store.keep(ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "range-offsets")
    edge = ends.select("part", F.explode(F.array_distinct(F.array("a", "b"))).alias("url_key"))
    held = ordered.select("part", "url_key").join(edge, ["part", "url_key"]).groupBy("url_key", "part").agg(F.count("*").alias("n"))
    same = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = store.keep(held.select("part", "url_key", F.coalesce(F.sum("n").over(same), F.lit(0)).alias("carry")).where("carry > 0"), "range-carries")
    joined = ordered.join(offset, "part").join(carry, ["part", "url_key"], "left")
    return joined.select(
        *_ENTRY, (F.col("offset") + F.col("place")).alias("position"), (F.col("nth") + F.coalesce("carry", F.lit(0))).alias("capture"))


def resolved(index: DataFrame) -> DataFrame:
    """The index with each revisit's payload taken from the response it refers to, and that one's page as ``refers_to``."""
    response = index.where("record_type = 'response'").select(
        F.col("record_id").alias("of"), F.col("payload_bytes").alias("of_bytes"), F.col("payload_digest").alias("of_digest"), F.col("page_id").alias("of_page"))
    joined = index.join(response, F.col("refers_to_record") == F.col("of"), "left")
    first = F.col("record_type") == "response"
    lost = F.raise_error(F.concat(F.lit("no such payload for the revisit "), F.col("record_id")))
    return joined.withColumn(
        "payload_bytes", F.when(first, F.col("payload_bytes")).when(F.col("of_digest") == F.col("payload_digest"), F.col("of_bytes")).otherwise(lost)
    ).withColumn("refers_to", F.col("of_page")).drop("of", "of_bytes", "of_digest", "of_page")


def read(spark: SparkSession, path: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The capture histories of all archives below ``path``, in the order of the merged index.

    The fields of ``ENTRY_SCHEMA``, ``position``, ``capture`` and ``refers_to``. No archives give no rows.
    """
    if not _archives(spark, path):
        return spark.createDataFrame([], f"{ENTRY_SCHEMA}, position bigint, capture bigint, refers_to bigint")
    return resolved(merge(store.keep(runs(spark, path), "capture-runs"), range_rows))


def _archives(spark: SparkSession, path: str) -> bool:
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/archives/*/*.txt")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def archive_pages(pages: DataFrame, captured_at: Column | None = None, path: str | None = None, range_rows: int = RANGE_ROWS, **settings) -> DataFrame:
    """Write ``pages`` as archives and read their capture histories back."""
    path = path or store.folder(pages.sparkSession, "warc")
    write(pages, path, captured_at, **settings)
    return read(pages.sparkSession, path, range_rows)
