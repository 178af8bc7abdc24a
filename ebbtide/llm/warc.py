"""Operator 5: WARC archives with revisit records, and a globally ordered index of their captures.

Archives are written by Spark's text sink, whose line separator is the blank lines that end a WARC record. Reading them
back gives one run of captures per file, sorted by URL key, time and page. Runs are stored, dealt by ranges of the key,
and each range merges its pieces of the runs with a loser tree, so ranges one after another are the capture history.

Payload is the html in UTF-8. Of pages with equal payloads of at least ``REVISIT_BYTES`` the largest page_id is the
response, the others refer to it. Null html is an empty payload, a null url an empty one. A page_id that is in the table
several times gives several records, all of them responses where it is the largest. A null page_id is never the
response of others; equal payloads that have no page_id at all are all responses.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import scratch, staged

REVISIT_BYTES = 1000
RANGE_CAPTURES = 250_000  # about half a kilobyte each in a task
FILE_BYTES = 16 << 20  # of payload in an archive file on average, 16 times as much at most; a file is read whole
FIRST_CAPTURE = 1_704_067_200  # pages have no time of their own: page n was captured n seconds after this
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD_ID = re.compile(rb"<urn:page:(-?\d+)>")


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def with_responses(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, size, digest, response_id); response_id is null for responses.

    Only payloads that occur more than once are in the joined table, one row each; where they are few Spark sends them to
    every task, otherwise the join is on written tables, so that one very frequent payload can be split.
    """
    payload = F.coalesce("html", F.lit(""))
    records = pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    repeated = records.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("largest"), F.count("*").alias("n")
    )
    repeated = repeated.where("n > 1").select(F.col("digest").alias("repeated"), "largest")
    joined = records.join(staged(repeated, "repeated"), F.col("digest") == F.col("repeated"), "left")
    own = F.col("largest").isNull() | F.col("largest").eqNullSafe(F.col("page_id"))
    return joined.withColumn("response_id", F.when(~own, F.col("largest"))).drop("repeated", "largest")


def record_text(records: DataFrame) -> DataFrame:
    """(value): every record up to the blank lines that end it."""
    revisit = F.col("response_id").isNotNull()
    seconds = FIRST_CAPTURE + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _page_urn(F.col("page_id"))),
        _line("WARC-Date", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit, F.concat(_line("WARC-Profile", PROFILE), _line("WARC-Refers-To", _page_urn(F.col("response_id"))))
        ).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return records.select(F.concat(head, block).alias("value"))


def size_classes(rows: int, size: int, largest: int) -> list[tuple[int, int]]:
    """(most bytes of a payload, records per file), smallest first.

    Almost all pages are in the first class, up to 16 times the mean, in files of ``FILE_BYTES`` on average. Larger ones
    go to files of their own, fewer at a time. So no file holds more than 16 times ``FILE_BYTES``, or one payload,
    however many large pages follow each other.
    """
    mean = max(size // max(rows, 1), 64)
    classes = [(16 * mean, max(1, FILE_BYTES // mean)), (FILE_BYTES, 16), (largest, max(1, 16 * FILE_BYTES // max(largest, 1)))]
    used = classes[:1]
    for limit, per_file in classes[1:]:
        if largest > used[-1][0] and limit > used[-1][0]:
            used.append((limit, per_file))
    return used


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a WARC record for each page below ``path``, uncompressed, so that offsets can be used."""
    length = F.coalesce(F.octet_length("html"), F.lit(0))
    rows, size, largest = pages.agg(F.count("*"), F.sum(length), F.max(length)).head()
    records = with_responses(pages)
    below = -1
    for limit, per_file in size_classes(rows, size or 0, largest or 0):
        text = record_text(records.where((F.col("size") > below) & (F.col("size") <= limit)))
        text.write.mode("append").option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)
        below = limit


CAPTURES = pa.schema(
    [("run", pa.string()), ("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]
)
CAPTURES_DDL = (
    "run string, url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, offset long, length long"
)


def url_key(url: str) -> str:
    """Sort-friendly form: host labels from the last to the first, then path and query, without scheme and fragment."""
    rest = url.partition("#")[0].partition("://")
    host, slash, path = (rest[2] or rest[0]).partition("/")
    host = host.rpartition("@")[2].lower()
    return f"{','.join(reversed(host.split('.')))}){slash}{path}"


def parse_archive(run: str, data: bytes) -> Iterator[tuple]:
    """Captures of one archive file, in the order of ``CAPTURES``; a payload that does not match its digest is an error."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {at} of {run}")
        fields = dict(line.split(b": ", 1) for line in lines[1:])
        start = head_end + 4
        end = start + int(fields[b"Content-Length"])
        http_end = data.index(b"\r\n\r\n", start) + 4
        http = dict(line.split(b": ", 1) for line in data[start : http_end - 4].split(b"\r\n")[1:])
        kind = fields[b"WARC-Type"].decode()
        digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
        size = int(http[b"Content-Length"])
        if kind == "response":
            payload = data[http_end:end]
            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"payload at {at} of {run} does not match its digest")
        page, refers = (_RECORD_ID.match(fields.get(name, b"")) for name in (b"WARC-Record-ID", b"WARC-Refers-To"))
        yield (
            run, url_key(fields[b"WARC-Target-URI"].decode()), fields[b"WARC-Date"].decode(), page and int(page[1]),
            size, digest, kind, refers and int(refers[1]), at, end - at,
        )
        at = end + len(END)


def order_of(capture: tuple) -> tuple:
    """URL key as UTF-8 (Spark's order of strings), time, page; a missing page first."""
    return capture[1].encode(), capture[2], capture[3] is not None, capture[3] or 0


def _record_batch(captures: list[tuple]) -> pa.RecordBatch:
    columns = zip(*captures) if captures else [[] for _ in CAPTURES]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, CAPTURES)], schema=CAPTURES)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archive files, sorted within each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                name = name.as_py().rpartition("/")[2]
                yield _record_batch(sorted(parse_archive(name, data.as_py()), key=order_of))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, CAPTURES_DDL)


class LoserTree:
    """Merges sorted runs: every inner place holds the loser of its match, so a new head plays one match per level."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs = [iter(run) for run in runs]
        self.heads = [self._next(i) for i in range(len(runs))]
        k = len(runs)
        self.losers = [-1] * k
        for i in range(k):
            self._play(i)

    def _next(self, i: int) -> tuple | None:
        capture = next(self.runs[i], None)
        return None if capture is None else (order_of(capture), i, capture)

    def _beats(self, i: int, j: int) -> bool:
        if j < 0 or i < 0:
            return i < 0  # a place that no one has reached yet lets the challenger wait there
        a, b = self.heads[i], self.heads[j]
        return a is not None and (b is None or a[:2] < b[:2])

    def _play(self, winner: int) -> None:
        place = (winner + len(self.losers)) // 2
        while place > 0:
            if self._beats(self.losers[place], winner):
                winner, self.losers[place] = self.losers[place], winner
            place //= 2
        if self.losers:
            self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.losers and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner][2]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def sorted_runs(captures: list[tuple]) -> list[list[tuple]]:
    """Captures by file; where the rows of a file did not arrive in their order, another run begins."""
    open_runs: dict[str, list[tuple]] = {}
    runs = []
    for capture in captures:
        run = open_runs.get(capture[0])
        if run is None or order_of(capture) < order_of(run[-1]):
            run = open_runs[capture[0]] = []
            runs.append(run)
        run.append(capture)
    return runs


def capture_history(runs: DataFrame) -> DataFrame:
    """All captures, globally ordered by URL key, time and page: partition after partition, row after row.

    There are as many ranges as keep each at about ``RANGE_CAPTURES``, so what a task merges does not grow with the table.
    """
    ranges = max(1, -(-runs.count() // RANGE_CAPTURES))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        captures = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        out: list[tuple] = []
        for capture in LoserTree(sorted_runs(captures)):
            out.append(capture)
            if len(out) == 10_000:
                yield _record_batch(out)
                out = []
        yield _record_batch(out)

    return runs.repartitionByRange(ranges, "url_key", "captured_at", "page_id").mapInArrow(merge, CAPTURES_DDL)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back, and return the capture history."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path)
    history = capture_history(staged(read_runs(spark, path), "runs"))
    return history.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at",
        F.col("run").alias("file"), "offset", "length",
    )
