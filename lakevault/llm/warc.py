"""WARC archives and their capture index.

``write_archives`` turns rows of pages into WARC/1.1 records, each a gzip member of
its own, so that offset and length fetch a record; ``read_captures`` reads archives back (records in
members of their own or many in one), one
locally sorted *capture run* per archive file; ``merge_runs`` deals the runs
over key ranges and merges each range's runs with a loser tree, which yields
capture histories in one global order (URL key, timestamp, page, place).

Equal payloads (same SHA-1 and length, at least ``min_bytes`` long) are stored
once: the record of the largest id is the ``response``, the others ``revisit``
it and hold no payload.  Shorter payloads are always responses.

Edge cases: a NULL text is an empty payload; a NULL id ranks below every id
and, if all copies have one, all of them are responses; repeated rows of the
winning id are each a response; a NULL URL sorts first (key "-"); control
characters, blanks and non-ASCII characters of a URL are percent-encoded in
the header.  An empty table gives empty archives and no captures.  Extra
columns are ignored, whatever their names.

Memory: an archive holds at most ``records_per_file`` records and about
``bytes_per_file`` bytes (one record, if that is longer) and is parsed
record by record; a merge task holds at most ``MERGE_ROWS`` index rows (no payloads), the runs beyond
lie in files of the task and are read as the merge goes on.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import pickle
import re
import tempfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakevault.llm.common import scratch_path, staged, table

# Fixed values of the format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIRST_CAPTURE = 1_600_000_000  # seconds; pages carry no time, so the id counts seconds from here

CAPTURES = (
    "urlkey string, ts string, page_id bigint, file string, offset bigint, length bigint, inner bigint, record_type string, "
    "payload_digest string, payload_bytes bigint, refers_to bigint, intact boolean"
)


def payload_digest(payload: str) -> Column:
    """Base32 SHA-1 of a text's UTF-8 bytes: four characters for every five digits of the hexadecimal form."""
    digest = F.sha1(F.col(payload).cast("binary"))
    numbers = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("long"))

    def text(x: Column) -> Column:
        return F.concat(*[F.substring(F.lit(BASE32), (F.shiftright(x, s).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(numbers, text), "")


@F.pandas_udf(StringType())
def header_url(url: pd.Series) -> pd.Series:
    return url.map(lambda u: None if u is None else quote(u, safe="!#$%&'()*+,/:;=?@[]~-._"))


def prepare_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                    min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)."""
    p = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(text_col), F.lit("")).alias("payload"),
    )
    p = p.withColumns({"payload_digest": payload_digest("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")})
    # one row per payload and task before the shuffle, so a copy in a third of the rows is no hot group
    newest = (
        p.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("_newest"))
    )
    # a table of its own: both sides of the join are then dealt out anew, and AQE can split a hot payload
    newest = staged(newest, "newest")
    j = p.join(newest, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("_newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_newest"))
    return j.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("_newest")),
        }
    ).drop("_newest")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


MERGE_ROWS = 25_000  # index rows that a merge task holds before it writes runs to files


def _archives(records_per_file: int, bytes_per_file: int):
    """Records to archives: gzip members, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for batch in batches:
            for record in batch.column(0):
                members.append(gzip.compress(record.as_py(), mtime=0))
                size += len(members[-1])
                if len(members) == records_per_file or size >= bytes_per_file:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["value"])
                    members, size = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["value"])

    return run


def write_archives(records: DataFrame, path: str, records_per_file: int = 4000, bytes_per_file: int = 32 << 20) -> str:
    """Write prepared records as gzip WARC files under ``path``; returns it.

    A row of the writer is a whole archive and goes into a file of its own. The zero byte
    that the text writer puts behind it is padding, which gzip readers skip.
    """
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    is_revisit = F.col("record_type") == "revisit"
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    when = F.date_format(
        F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce(F.col("page_id"), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        _record_id(F.col("page_id")),
        F.lit("\r\nWARC-Date: "),
        when,
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), header_url("url")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(is_revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _record_id(F.col("refers_to"))))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(F.col("_block")).cast("string"),
        F.lit(END),
    )
    lines = records.withColumn("_block", block).select(F.concat(head, F.col("_block"), F.lit(END)).cast("binary").alias("value"))
    archives = lines.mapInArrow(_archives(records_per_file, bytes_per_file), "value binary").select(F.col("value").cast("string"))
    archives.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)
    return path


def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host, then path and query, lower case, no fragment."""
    if not url:
        return "-"
    try:
        u = urlsplit(url)
        host, port = u.hostname or "", u.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    key = ",".join(reversed(host.split(".")))
    if port and port not in (80, 443):
        key += f":{port}"
    return f"{key}){u.path or '/'}{'?' + u.query if u.query else ''}".lower()


class _Unzipped:
    """The decompressed stream of an archive's gzip members, and where each member begins and ends."""

    def __init__(self, data: bytes):
        self.data, self.at, self.unzip = data, 0, None
        self.buffer, self.place = b"", 0  # what isn't used yet, and its place in the stream
        self.members: list[list] = []  # place in the stream, offset, end (None while it isn't known)

    def _more(self) -> bytes | None:
        if self.unzip is None:
            while self.at < len(self.data) and self.data[self.at] == 0:  # padding
                self.at += 1
            if self.at == len(self.data):
                return None
            self.unzip = zlib.decompressobj(31)
            self.members.append([self.place + len(self.buffer), self.at, None])
        piece = self.data[self.at : self.at + (1 << 18)]
        if not piece:
            raise ValueError("an archive ends inside a gzip member")
        out = self.unzip.decompress(piece)
        self.at += len(piece) - len(self.unzip.unused_data)
        if self.unzip.eof:
            self.members[-1][2], self.unzip = self.at, None
        return out

    def fill(self, n: int) -> None:
        """At least ``n`` bytes in the buffer, unless the archive ends before."""
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            start = len(self.members)
            piece = self._more()
            if piece is None:
                break
            if len(self.members) > start:
                self.members[-1][0] = self.place + have
            parts.append(piece)
            have += len(piece)
        self.buffer = b"".join(parts)

    def take(self, n: int) -> tuple[int, int, int]:
        """Use ``n`` bytes; (offset, length, inner) of them: read ``length`` compressed
        bytes from ``offset``, then skip ``inner`` decompressed ones."""
        while len(self.members) > 1 and self.members[1][0] <= self.place:
            self.members.pop(0)
        begin, offset, end = self.members[0]
        out = offset, (self.at if end is None else end) - offset, self.place - begin
        self.buffer, self.place = self.buffer[n:], self.place + n
        return out


def _record_size(stream: _Unzipped) -> tuple[dict, int] | None:
    """Headers and whole length of the next record, which is then in the buffer."""
    stream.fill(1)
    if not stream.buffer:
        return None
    while (end := stream.buffer.find(b"\r\n\r\n")) < 0:
        before = len(stream.buffer)
        stream.fill(before + 1)
        if len(stream.buffer) == before:
            raise ValueError("an archive ends inside a record header")
    lines = stream.buffer[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at byte {stream.place}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    size = end + 4 + int(headers["Content-Length"]) + 4
    stream.fill(size + 1)  # one byte more, so that the end of the record's member is known
    if len(stream.buffer) < size:
        raise ValueError("an archive ends inside a record")
    return headers, size


def parse_archive(data: bytes) -> Iterator[tuple]:
    """(offset, length, inner, headers, http_length, payload) of each record; ``data`` is gzip."""
    stream = _Unzipped(data)
    while (found := _record_size(stream)) is not None:
        headers, size = found
        record = stream.buffer[:size]
        block = record[size - 4 - int(headers["Content-Length"]) : size - 4]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = re.search(rb"Content-Length: (\d+)", http)
        yield *stream.take(size), headers, int(length[1]) if length else len(payload), payload


def fetch_record(part: bytes, inner: int = 0) -> tuple[dict, bytes]:
    """Headers and payload of one record from its ``length`` compressed bytes at ``offset``."""
    unzip = zlib.decompressobj(31)
    record = unzip.decompress(part)[inner:]
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")[2]


def _page(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def _sort_key(c: tuple) -> tuple:
    return (c[0], c[1], c[2] is not None, c[2] or 0, c[3], c[4], c[6])


def _capture_runs(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in CAPTURES.split(", ")]
    for frame in files:
        for path, data in zip(frame["path"], frame["content"], strict=True):
            run = []
            for offset, length, inner, h, http_length, payload in parse_archive(data):
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                whole = h["WARC-Type"] == "response"
                intact = not whole or (
                    len(payload) == http_length and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
                )
                run.append((url_key(h.get("WARC-Target-URI")), h["WARC-Date"], _page(h["WARC-Record-ID"]), path.rpartition("/")[2],
                            offset, length, inner, h["WARC-Type"], digest, http_length, _page(h.get("WARC-Refers-To")), intact))
            run.sort(key=_sort_key)
            yield _frame(run, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=names)
    return f.astype({c: "Int64" for c in ("page_id", "refers_to", "offset", "length", "inner", "payload_bytes")} | {"intact": "boolean"})


def read_captures(spark, path: str) -> DataFrame:
    """The capture runs of the archives under ``path``: each file's captures in key order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(_capture_runs, CAPTURES)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, the root the winner,
    so one replayed path (log2 k comparisons) yields the next smallest item."""

    def __init__(self, runs: list, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = max(1, len(self.runs))
        self.heads = [self._next(i) for i in range(len(self.runs))] or [None]
        self.losers = [-1] * self.k
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _next(self, i: int):
        item = next(self.runs[i], None)
        return None if item is None else (self.key(item), item)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x[0] < y[0] or (x[0] == y[0] and a < b)

    def __iter__(self):
        while (head := self.heads[self.winner]) is not None:
            yield head[1]
            at = self.winner
            self.heads[at] = self._next(at)
            node = (at + self.k) // 2
            while node:
                if self._before(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at


class RunStore:
    """Sorted runs of rows; beyond ``limit`` rows in memory, all of them move to files."""

    def __init__(self, limit: int):
        self.limit, self.rows, self.spilled = limit, 0, 0
        self.runs: list = []
        self.open: dict[str, list[tuple]] = {}  # the run that rows of a file still go on
        self.folder = None

    def add(self, row: tuple) -> None:
        run = self.open.get(row[3])
        if run is None or _sort_key(row) < _sort_key(run[-1]):  # a run that arrives in pieces counts as several
            run = self.open[row[3]] = []
            self.runs.append(run)
        run.append(row)
        self.rows += 1
        if self.rows > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.folder = self.folder or tempfile.TemporaryDirectory(prefix="runs-")
        for i, run in enumerate(self.runs):
            if isinstance(run, list):
                name = f"{self.folder.name}/{self.spilled}"
                with open(name, "wb") as f:
                    for at in range(0, len(run), 1000):
                        pickle.dump(run[at : at + 1000], f)
                self.runs[i] = name
                self.spilled += 1
        self.open, self.rows = {}, 0

    def merged(self) -> Iterator[tuple]:
        return iter(LoserTree([_read_run(r) for r in self.runs], _sort_key))


def _read_run(run: list | str) -> Iterator[tuple]:
    if isinstance(run, list):
        yield from run
        return
    with open(run, "rb") as f:
        while True:
            try:
                rows = pickle.load(f)
            except EOFError:
                return
            yield from rows


def _merge(limit: int):
    """Merge the runs of one key range."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, names = RunStore(limit), []
        for f in frames:
            names = list(f.columns)
            f = f.astype(object).where(f.notna(), None)
            for row in f.itertuples(index=False, name=None):
                store.add(row)
        out = []
        for row in store.merged():
            out.append(row)
            if len(out) == 10_000:
                yield _frame(out, names)
                out = []
        if out:
            yield _frame(out, names)

    return run


def merge_runs(runs: DataFrame, rows_per_range: int = 100_000, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """Globally ordered captures.  The range bounds include the record's place, so the
    captures of one URL, however many, spread over several ranges."""
    n_ranges = max(1, -(-runs.count() // rows_per_range))
    # NULL ids sort first in a range layout as in _sort_key
    dealt = runs.repartitionByRange(n_ranges, "urlkey", "ts", "page_id", "file", "offset", "inner")
    return dealt.mapInPandas(_merge(merge_rows), CAPTURES)


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0, records_per_file: int = 4000,
                  rows_per_range: int = 100_000) -> DataFrame:
    """Write ``pages`` as archives, read them back and return the merged capture index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(prepare_records(pages, min_bytes=min_bytes), path, records_per_file)
    return merge_runs(staged(read_captures(spark, path), "capture-runs"), rows_per_range)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    index = archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "ts", "intact")


OP10_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, url, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS x FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(1 + ((CAST('0x' || substr(x, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)),
        'string_agg', '') AS payload_digest FROM h),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM b),
u AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)(\?[^#]*)?', 1) AS host,
             regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)(\?[^#]*)?', 2) AS path,
             regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)(\?[^#]*)?', 3) AS query FROM m)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to,
       lower(list_aggregate(list_reverse(string_split(regexp_replace(host, '^www\d*\.', ''), '.')), 'string_agg', ',')
             || ')' || CASE WHEN path = '' THEN '/' ELSE path END || query) AS urlkey,
       strftime(make_timestamp(CAST((1600000000 + page_id) * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS ts,
       TRUE AS intact
FROM u
"""
