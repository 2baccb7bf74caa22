"""WARC archives of pages, read back, and one globally ordered capture index over them."""

from __future__ import annotations

import gzip
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import parse_qsl, urlencode, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, fresh_path, lookup

# Payloads shorter than this are never stored by reference.
SHORTEST_SHARED = 100
# Records and, on average, payload bytes of one archive; captures of one merged range, and
# captures sent together.
ARCHIVE_RECORDS, ARCHIVE_BYTES = 1000, 32 << 20
RANGE_ROWS = 50_000
CHUNK_ROWS = 2_000
# Keys looked at for every boundary between ranges.
KEYS_PER_RANGE = 50

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
END_OF_RECORD = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header_safe(value: Column) -> Column:
    """Line ends would break a header; they are percent-encoded, as in a URL."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, page_id: str, url: str, html: str, captured: Column) -> DataFrame:
    """One WARC record per page as text, without the end-of-record mark.

    Of equal payloads of at least ``SHORTEST_SHARED`` bytes the one with the smallest page
    id is stored and the others refer to it.  Only digests that occur more than once are
    joined back, by a checked broadcast or salted, so a payload that a third of all pages
    share makes no hot task, and no payload is shuffled.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).alias("bytes"),
        F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )
    repeated = (
        rows.where(F.col("bytes") >= SHORTEST_SHARED).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first_id is not null").select("digest", "first_id")
    )
    rows = lookup(rows, cut_lineage(repeated), ["digest"], "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    line = F.lit("\r\n")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    header = F.concat(
        F.lit(VERSION), line,
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), line,
        F.lit("WARC-Record-ID: "), name, line,
        F.coalesce(F.concat(F.lit("WARC-Date: "), F.col("date"), line), F.lit("")),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), _header_safe(F.col("url")), line), F.lit("")),
        F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), line,
        F.lit("WARC-Payload-Length: "), F.col("bytes").cast("string"), line,
        F.when(revisit, F.concat(
            F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"), F.lit(">\r\n"),
        )).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8"), line,
        F.lit("Content-Length: "), F.when(revisit, "0").otherwise(F.col("bytes").cast("string")), line,
        line,
    )
    return rows.select(F.concat(header, F.when(revisit, "").otherwise(F.col("payload"))).alias("record"))


def write(lines: DataFrame, path: str, per_archive: int = ARCHIVE_RECORDS) -> None:
    """Compressed archives of at most ``per_archive`` records under ``path``.

    The text writer with the end-of-record mark as line end gives exactly the record format,
    on any file system Spark can write, with its protection against retried tasks.
    """
    lines.write.option("lineSep", END_OF_RECORD).option("compression", "gzip").option(
        "maxRecordsPerFile", per_archive
    ).text(path)


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and content of every record, by its declared length."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        first, *fields = data[at:stop].decode("utf-8").split("\r\n")
        if first != VERSION:
            raise ValueError(f"no record starts at byte {at}")
        headers = dict(f.split(": ", 1) for f in fields)
        end = stop + 4 + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end as declared")
        yield at, end + 4 - at, headers, data[stop + 4 : end]
        at = end + 4


def url_key(url: str | None) -> str:
    """Sort-friendly form: host reversed, lower case, no scheme, ``www`` or default port, query sorted.

    A URL that cannot be split is its own key; none is empty.
    """
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    host = host.removeprefix("www.")
    place = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        place += f":{port}"
    query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))
    return f"{place}){parts.path.lower() or '/'}" + (f"?{query}" if query else "")


_CAPTURE = pa.schema([
    ("archive", pa.string()), ("place", pa.int64()), ("url_key", pa.string()), ("date", pa.string()), ("page_id", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
])
_CAPTURE_DDL = (
    "archive string, place bigint, url_key string, date string, page_id string, offset bigint, length bigint, "
    "record_type string, refers_to string, payload_digest string, payload_bytes bigint"
)
_ORDER = ("url_key", "date", "page_id", "archive", "offset")


def _name(urn: str | None) -> str | None:
    return None if urn is None or urn == "<urn:page:none>" else urn.removeprefix("<urn:page:").removesuffix(">")


def runs(spark, path: str) -> DataFrame:
    """Captures of every archive, sorted within it: one run per archive.

    An archive is read whole, through Spark; ``write`` bounds its records.
    Lengths and digests of stored payloads are measured on the bytes read; a record that
    differs from what its header says is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column("path")[i].as_py().rsplit("/", 1)[-1]
                found = []
                for offset, length, head, content in parse(gzip.decompress(batch.column("content")[i].as_py())):
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["WARC-Payload-Length"])
                    if head["WARC-Type"] == "response":
                        measured = hashlib.sha256(content).hexdigest(), len(content)
                        if measured != (digest, size):
                            raise ValueError(f"{archive}, byte {offset}: the payload is not the one declared")
                    found.append({
                        "archive": archive, "url_key": url_key(head.get("WARC-Target-URI")), "date": head.get("WARC-Date", ""),
                        "page_id": _name(head["WARC-Record-ID"]), "offset": offset, "length": length,
                        "record_type": head["WARC-Type"], "refers_to": _name(head.get("WARC-Refers-To")),
                        "payload_digest": digest, "payload_bytes": size,
                    })
                found.sort(key=_sort_key)
                for place, row in enumerate(found):
                    row["place"] = place
                yield pa.RecordBatch.from_pylist(found, schema=_CAPTURE)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(read, _CAPTURE_DDL)


def _sort_key(row: dict) -> tuple:
    return (row["url_key"], row["date"], _id_key(row["page_id"]), row["archive"], row["offset"])


def _id_key(page_id: str | None) -> tuple:
    """Numbers by value, then other ids as text, then none."""
    if page_id is None:
        return 2, 0, ""
    body = page_id.removeprefix("-")
    return (0, int(page_id), "") if body.isdecimal() and body.isascii() else (1, 0, page_id)


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of each match, the root the winner.

    Taking the least row replays only the matches on the way from its leaf up, so a row
    costs about log2(k) comparisons for k runs.
    """

    def __init__(self, streams: list[Iterator[tuple]]) -> None:
        self.streams = streams
        self.k = len(streams)
        self.heads: list[tuple | None] = [next(s, None) for s in streams]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._replay(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x[0], a) < (y[0], b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                # While the tree is built, the first to arrive waits for its rival.
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (head := self.heads[self.losers[0]]) is not None:
            yield head
            leaf = self.losers[0]
            self.heads[leaf] = next(self.streams[leaf], None)
            self._replay(leaf)


def _boundaries(captures: DataFrame) -> list[tuple]:
    """Keys that cut all captures into ranges of about ``RANGE_ROWS``.

    Taken from captures picked by a hash of their place, about ``KEYS_PER_RANGE`` for every range.  A key
    goes down to the record, so many captures of one URL are cut as well.  They set the
    balance only: any boundaries give the same order.
    """
    n = captures.count()
    ranges = -(-n // RANGE_ROWS)
    if ranges < 2:
        return []
    step = max(1, RANGE_ROWS // KEYS_PER_RANGE)
    picked = captures.where(F.pmod(F.xxhash64("archive", "offset"), F.lit(step)) == 0).select(*_ORDER).collect()
    keys = sorted(_sort_key(row.asDict()) for row in picked)
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []


def merge(captures: DataFrame) -> DataFrame:
    """All captures by URL key, date and page, with their range and place in it.

    ``captures`` are runs, sorted by ``place`` within each archive.  A run is cut at the
    boundaries and sent in sorted chunks; the task of a range strings the chunks of each
    run together again and merges the runs with a loser tree.  Ranges in order, and places
    in order within them, are the global order.
    """
    cuts = captures.sparkSession.sparkContext.broadcast(_boundaries(captures))

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            low, out = 0, []
            keys = [_sort_key(r) for r in rows]
            bounds = cuts.value
            while low < len(rows):
                part = _part(bounds, keys[low])
                high = low + 1
                limit = bounds[part] if part < len(bounds) else None
                while (
                    high < len(rows) and high - low < CHUNK_ROWS and rows[high]["archive"] == rows[low]["archive"]
                    and rows[high]["place"] > rows[high - 1]["place"] and (limit is None or keys[high] < limit)
                ):
                    high += 1
                out.append({"part": part, "run": rows[low]["archive"], "start": rows[low]["place"], "rows": rows[low:high]})
                low = high
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("part", pa.int64()), ("run", pa.string()), ("start", pa.int64()), ("rows", pa.list_(pa.struct(_CAPTURE)))]))

    def join(group: pa.Table) -> pa.Table:
        chunks: dict[str, list[tuple[int, list[dict]]]] = {}
        parts = group.column("part").to_pylist()
        for run, start, rows in zip(group.column("run").to_pylist(), group.column("start").to_pylist(), group.column("rows").to_pylist()):
            chunks.setdefault(run, []).append((start, rows))
        streams = []
        for run in sorted(chunks):
            pieces = sorted(chunks[run], key=lambda c: c[0])
            streams.append(((_sort_key(row), row) for _, rows in pieces for row in rows))
        out = [row for _, row in LoserTree(streams)]
        table = pa.Table.from_pylist(out, schema=_CAPTURE)
        table = table.set_column(1, "place", pa.array(np.arange(len(out)), pa.int64()))
        return table.append_column("part", pa.array([parts[0]] * len(out), pa.int64()))

    rows = captures.mapInArrow(chunk, f"part bigint, run string, start bigint, rows array<struct<{_struct()}>>")
    return rows.groupBy("part").applyInArrow(join, f"{_CAPTURE_DDL}, part bigint")


def _struct() -> str:
    return ", ".join(": ".join(c.split(" ")) for c in _CAPTURE_DDL.split(", "))


def _part(bounds: list[tuple], key: tuple) -> int:
    return bisect_right(bounds, key)


def archive_and_index(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", captured: Column | None = None
) -> DataFrame:
    """Write the pages as WARC archives in the shared folder, read them back, merge the index.

    One row per page: part and place (global order of the index), url_key, date, page_id, archive, offset, length,
    record_type, refers_to, payload_digest, payload_bytes.

    A null html is an empty payload, a null url has no target and the empty key, a null
    date sorts first.  Rows with a null page id are stored but never referred to.  Rows
    that repeat the smallest page id of a payload are each stored.  Empty table, empty index.
    """
    captured = F.timestamp_seconds(F.lit(0)) if captured is None else captured
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    # An archive is read whole, so long pages make archives of fewer records.
    mean = pages.agg(F.avg(F.octet_length(html))).first()[0] or 0
    per_archive = max(1, min(ARCHIVE_RECORDS, ARCHIVE_BYTES // (int(mean) + 1)))
    write(records(pages, page_id, url, html, captured), path, per_archive)
    kind = pages.schema[page_id].dataType.simpleString()
    merged = merge(cut_lineage(runs(spark, path)))
    return merged.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
