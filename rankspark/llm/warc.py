"""WARC archives of pages, and a globally ordered capture index.

Writing: a page is one record with its html (UTF-8; null is empty) as the
payload of an HTTP response.  Of records with equal payloads the one with the
largest page id is the response, the others are revisit records without
payload that refer to it; payloads under ``least`` bytes are all responses.
Spark's text writer ends every line with the two line breaks that end a WARC
record, so its gzip files are archives, in the cluster's shared folder.

Reading: each archive is parsed record by record by Content-Length, payload
digests of responses are computed anew, and the captures come out as a run
sorted by URL key, time and id.  Runs are dealt by ranges of that key; each
task merges the runs that reach its range with a loser tree, so partition
after partition holds the ordered capture histories.  One URL's captures can
span ranges; a range is bounded however hot a URL is.

A null page id writes a record of its own (no id; the smallest in its group
of equal payloads).  Pages of one id and payload are records of their own:
those with the group's largest id are all responses.  Null URLs give an empty
key, control characters and spaces in them are percent-encoded.  The capture
time is ``epoch`` plus the id in seconds (modulo ``SPAN``).  Extra columns are not archived; an
empty table writes an empty archive folder and gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.llm.common import shared_path, stored

# Fixed values of the format.
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Capture times repeat after so many seconds (dates keep four-digit years).
SPAN = 100 * 365 * 86400
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURE = ("url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "archive string, offset long, run string, seq long")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1, in SQL functions: 40 bits are ten hex and eight base32 digits."""
    hexed = F.sha1(data)
    part = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to`` (null for responses)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")) \
        .withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    # one row for each payload that occurs more than once; stored, so that a small table is planned as one
    groups = stored(base.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
                    .agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    return base.join(groups, ["payload_digest", "payload_bytes"], "left").withColumn(
        "refers_to", F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))).drop("top")


def write_archives(pages: DataFrame, path: str, least: int = 0, per_file: int = 1000, epoch: int = 1_704_067_200) -> None:
    """One WARC record per page into gzip archives of ``per_file`` records under ``path``."""
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.coalesce("url", F.lit(""))
    for c in "%\x00\t\n\r ":  # a literal % first
        if c != "%":
            uri = F.replace(uri, F.lit(c), F.lit(f"%{ord(c):02X}"))
    uri = F.regexp_replace(uri, r"[\x01-\x1F\x7F]", "%1A")
    when = F.date_format(F.timestamp_seconds(F.lit(epoch) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(SPAN))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    size = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes") + len(HTTP))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")), F.lit("\r\nWARC-Date: "), when, F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit(END),
        F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP), F.col("payload").cast("string"))))
    with_revisits(pages, least).select(record.alias("value")).write \
        .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and content of each record of an unpacked archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        yield at, fields, data[head + 4:head + 4 + size]
        at = head + 4 + size
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record of wrong length before {at}")
        at += 4


def url_key(url: str) -> str:
    """Sort-friendly URL: host labels reversed, then path and query in lower case."""
    try:
        cut = urlsplit(url)
        host = cut.hostname or ""
    except ValueError:
        return url.lower()
    labels = host.split(".")
    if labels[0] == "www":
        labels = labels[1:]
    query = f"?{'&'.join(sorted(cut.query.split('&')))}" if cut.query else ""
    return f"{','.join(reversed(labels))}){(cut.path or '/').lower()}{query.lower()}"


def _id(text: str) -> int | None:
    number = text.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def captures(data: bytes, archive: str) -> list[tuple]:
    """The sorted run of an archive's captures."""
    out = []
    for at, h, content in records(data):
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        if h["WARC-Type"] == "response":
            payload = content.split(b"\r\n\r\n", 1)[1]
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest or len(payload) != int(h["X-Payload-Length"]):
                raise ValueError(f"{archive}: the payload at {at} doesn't match its digest")
        moment = datetime.strptime(h["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc).strftime("%Y%m%d%H%M%S")
        refers = _id(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None
        out.append((url_key(h["WARC-Target-URI"]), moment, _id(h["WARC-Record-ID"]), int(h["X-Payload-Length"]), digest, h["WARC-Type"], refers, archive, at))
    out.sort(key=order)
    return [(*c, archive, i) for i, c in enumerate(out)]


def order(capture: tuple) -> tuple:
    """URL key, time, id (none first), place."""
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0, capture[7], capture[8]


class LoserTree:
    """K-way merge: inner nodes hold the losers of their matches, ``tree[0]`` the winner."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.head = [order(r[0]) if r else None for r in runs]  # None: ended, loses to all
        self.k = max(1, len(runs))
        self.tree = [-1] * self.k
        for i in range(len(runs)):
            self._play(i, True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, run: int, filling: bool = False) -> None:
        node = (run + self.k) // 2
        while node > 0:
            if self.tree[node] < 0 and filling:
                self.tree[node] = run
                return
            if self._beats(self.tree[node], run):
                self.tree[node], run = run, self.tree[node]
            node //= 2
        self.tree[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.head[self.tree[0]] is not None:
            run = self.tree[0]
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            left = self.at[run] < len(self.runs[run])
            self.head[run] = order(self.runs[run][self.at[run]]) if left else None
            self._play(run)


def read_index(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """The archives' captures, globally ordered by URL key, time and id."""
    columns = [c.split()[0] for c in CAPTURE.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        for c in ("page_id", "refers_to"):
            out[c] = out[c].astype("Int64")
        return out

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                yield frame(captures(gzip.decompress(content), name.rsplit("/", 1)[-1]))

    runs = stored(spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, CAPTURE), "runs")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        # a shuffle may mix a run's rows: their numbers restore its order
        part = pd.concat(held, ignore_index=True).sort_values(["run", "seq"], kind="stable")
        by_run: dict[str, list[tuple]] = {}
        for row in part.itertuples(index=False, name=None):
            row = list(row)
            row[2], row[6] = (None if row[2] is None else int(row[2])), (None if row[6] is None else int(row[6]))
            by_run.setdefault(row[9], []).append(tuple(row))
        out = []
        for c in LoserTree(list(by_run.values())):
            out.append(c)
            if len(out) == 20_000:
                yield frame(out)
                out = []
        if out:
            yield frame(out)

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ids beyond 2**53 would lose digits as floating numbers next to nulls: pandas gets them as text
    return runs.repartitionByRange(n, "url_key", "captured", "page_id", "archive", "offset") \
        .withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).mapInPandas(merge, CAPTURE).drop("run", "seq")


def capture_index(pages: DataFrame, least: int = 0, per_file: int = 1000, path: str | None = None) -> DataFrame:
    """Write the pages' archives (to a new shared folder unless ``path`` names one) and read their merged index."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path, least, per_file)
    return read_index(spark, path)
