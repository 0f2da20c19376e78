"""WARC archives of pages, and a globally ordered capture index made by an external merge.

Writing: of pages with equal payloads of at least ``least`` bytes the one with the smallest page_id is a response
record, the others are revisit records that refer to it. Records are composed by SQL functions and written by Spark's
text writer, so archives land in any store that Spark can write to, under its commit protocol.

Reading: every archive is parsed record by record; payload digests are computed again from the bytes, and a revisit
takes its length from the HTTP header that it keeps, as the WARC standard has it.

Index: an archive's captures, sorted by URL key, time and record, are a run. A sample of the runs' keys, by a hash of
their places, cuts the index into ranges: at most ``MAX_RANGES``, so what the driver sees is bounded. A range takes its slice of every run and merges the slices with a loser tree; with
the sizes of the ranges before it, this numbers all captures globally. A range covers (URL key, time, record), so
even a URL with a third of all captures is spread over many ranges.

Nulls and edge cases: a null html is an empty payload; a null URL gives a record without target URI and an empty URL
key; a null page_id sorts last and so is a response only if all its equals have none; rows that repeat the smallest
page_id of a payload are each a response; control characters in URLs are percent-encoded; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator
from urllib.parse import parse_qsl, unquote, urlencode, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import hot_from, importable, read_table, salted_join, stage, staged_path

LEAST = 0
#: Bytes of an archive, roughly; payloads of an archive are at most SPREAD times as long as their mean.
ARCHIVE, SPREAD = 24 << 20, 4
#: Captures of an index range, the most ranges, and the keys sampled for each: so the driver sees at most 80,000 keys.
RANGE, MAX_RANGES, KEYS = 20_000, 10_000, 8
#: Above so many payloads that occur more than once their digests aren't broadcast.
MAX_DIGESTS = 500_000
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CRLF = "\r\n"
#: Bytes of a record besides its payload, roughly.
HEAD = 600


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 160-bit digest in hex."""
    out = []
    for i in range(0, 40, 5):
        n = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(_ALPHABET), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def write_archives(pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE) -> None:
    """Writes a record for every row of pages (page_id, url, html) into archives below path."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("string").alias("id"), "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("n"), F.sha1(payload.cast("binary")).alias("sha"))
    facts = stage(rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"), F.min(F.isnull("page_id")).alias("no_id")), "payloads")
    double = facts.filter((F.col("copies") > 1) & (F.col("n") >= least)).select("sha", "first", "no_id")
    if double.count() <= MAX_DIGESTS:
        rows = rows.join(F.broadcast(double), "sha", "left")
    else:
        hot = facts.filter(F.col("copies") >= hot_from(facts.agg(F.sum("copies")).first()[0])).select("sha")
        rows = salted_join(rows, double, "sha", hot, "left")
    revisit = F.coalesce(~F.col("no_id") & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))

    def record(page_id: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.url_encode(page_id.cast("string")), F.lit("")), F.lit(">"))

    # no escape for the per cent sign, as URLs hold escapes already
    url = F.translate("url", "\r\n\t\0", "    ")
    url = F.regexp_replace(url, " ", "%20")
    digest = F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("n").cast("string"), F.lit(_CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    # captures have no time of their own: seconds from a fixed date by page_id
    when = F.from_unixtime(F.lit(1704067200) + F.coalesce(F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(86400 * 365)), F.lit(0)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{_CRLF}WARC-Record-ID: "), record(F.col("page_id")),
        F.lit(f"{_CRLF}WARC-Date: "), when,
        F.coalesce(F.concat(F.lit(f"{_CRLF}WARC-Target-URI: "), url), F.lit("")),
        F.lit(f"{_CRLF}WARC-Payload-Digest: "), digest,
        F.when(revisit, F.concat(F.lit(f"{_CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}WARC-Refers-To: "), record(F.col("first")))).otherwise(F.lit("")),
        F.lit(f"{_CRLF}Content-Type: application/http; msgtype=response{_CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(_CRLF * 2),
    )
    out = rows.select("n", F.concat(head, block).alias("value"))
    # in turns: payloads up to SPREAD times the mean, then those of the longer ones up to SPREAD times their mean, ...
    # so an archive has at most about SPREAD * archive_bytes, however the sizes are spread
    over, writer = -1, None
    while (found := facts.filter(F.col("n") > over).agg(F.sum(F.col("n") * F.col("copies")), F.sum("copies"), F.max("n")).first())[1] or writer is None:
        mean = (found[0] or 0) // max(1, found[1] or 0) + HEAD
        most = max(SPREAD * mean, over + 1)
        writer = out.filter((F.col("n") > over) & (F.col("n") <= most)).select("value").write
        writer.mode("append").option("lineSep", _CRLF * 2).option("maxRecordsPerFile", max(1, archive_bytes // mean)).text(path)
        over = most


def records(data: bytes) -> Iterator[tuple[int, int, dict[bytes, bytes], bytes]]:
    """Offset, length, headers (names in lower case) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        lines = data[at : body - 4].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
        end = body + int(head[b"content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where its length says")
        yield at, end + 4 - at, head, data[body:end]
        at = end + 4


def url_key(url: str) -> str:
    """Sort-friendly key: the host's labels reversed, then the path and the sorted query in lower case."""
    try:
        x = urlsplit(url.strip())
        host, port = x.hostname or "", x.port
    except ValueError:
        return url.strip().lower()
    labels = host.split(".")
    if len(labels) > 2 and labels[0] in ("www", "m"):
        labels = labels[1:]
    tail = f":{port}" if port and (x.scheme, port) not in (("http", 80), ("https", 443)) else ""
    query = urlencode(sorted(parse_qsl(x.query, keep_blank_values=True)))
    return f"{','.join(reversed(labels))}{tail}){(x.path or '/').lower()}" + (f"?{query.lower()}" if query else "")


_CAPTURE = "archive string, nth bigint, url_key string, captured string, record string, offset bigint, length bigint, record_type string, payload_digest string, payload_bytes bigint, refers_to string, checked boolean"


def _id(field: bytes | None) -> str | None:
    found = None if field is None else unquote(field.decode()[len("<urn:x-page:") : -1])
    return found or None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            rows = []
            for offset, length, head, block in records(content.as_buffer().to_pybytes()):
                http, _, payload = block.partition(b"\r\n\r\n")
                n = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
                kind, digest = head[b"warc-type"].decode(), head[b"warc-payload-digest"].decode().removeprefix("sha1:")
                ok = kind == "revisit" or (len(payload) == n and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)
                key = url_key(head[b"warc-target-uri"].decode()) if b"warc-target-uri" in head else ""
                rows.append((key, head[b"warc-date"].decode(), head[b"warc-record-id"].decode(), offset, length, kind, digest, n, _id(head.get(b"warc-refers-to")), ok))
            rows.sort(key=lambda r: r[:4])
            cols = list(zip(*rows)) or [()] * 10
            names = ["url_key", "captured", "record", "offset", "length", "record_type", "payload_digest", "payload_bytes", "refers_to", "checked"]
            types = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.int64(), pa.string(), pa.bool_()]
            out = {"archive": pa.array([path.as_py()] * len(rows), pa.string()), "nth": pa.array(range(len(rows)), pa.int64())}
            yield pa.RecordBatch.from_pydict(out | {k: pa.array(v, t) for k, v, t in zip(names, cols, types)})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures in the archives below path: an archive's are one run, sorted by (url_key, captured, record)."""
    importable(spark)
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.txt").load(path)
    return stage(files.select("path", "content").mapInArrow(_parse, _CAPTURE), "captures")


class LoserTree:
    """Merges k sorted iterators: inner nodes hold the losers of their matches, so a step replays one path only."""

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.loser = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        if a == -1 or b == -1:
            return a == -1  # while the tree fills, a free place wins and moves up
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, i: int) -> None:
        at = (i + self.k) // 2
        while at:
            if self._before(self.loser[at], i):
                self.loser[at], i = i, self.loser[at]
            at //= 2
        self.loser[0] = i

    def __iter__(self):
        while (x := self.heads[i := self.loser[0]]) is not None:
            yield x
            self.heads[i] = next(self.runs[i], None)
            self._play(i)


def _merge(table: pa.Table) -> pa.Table:
    table = table.sort_by([("archive", "ascending"), ("nth", "ascending")])
    keys = list(zip(*(table[c].to_pylist() for c in ("url_key", "captured", "record", "offset"))))
    archives = table["archive"].to_pylist()
    starts = [i for i in range(len(keys)) if not i or archives[i] != archives[i - 1]] + [len(keys)]
    runs = [((keys[i], i) for i in range(a, b)) for a, b in zip(starts, starts[1:])]
    order = [i for _, i in LoserTree(runs)]
    out = table.take(pa.array(order, pa.int64()))
    return out.append_column("within", pa.array(range(len(order)), pa.int64()))


def merge_index(captures: DataFrame, rows: int = RANGE) -> DataFrame:
    """The captures with their ``position`` in the order (url_key, captured, record) over all archives, from 0."""
    n = captures.count()
    ranges = min(MAX_RANGES, max(1, -(-n // rows)))
    step = max(1, n // (KEYS * ranges))
    sampled = F.pmod(F.xxhash64("archive", "nth"), F.lit(step)) == 0
    sample = sorted(tuple(r) for r in captures.filter(sampled).select("url_key", "captured", "record").collect()) if ranges > 1 else []
    cuts = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("url_key", "captured", "record")))
            yield batch.append_column("range", pa.array([bisect.bisect_right(cuts, k) for k in keys], pa.int32()))

    dealt = stage(captures.mapInArrow(deal, f"{_CAPTURE}, range int"), "ranges")
    counts = dealt.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", before.alias("before"))
    merged = dealt.groupBy("range").applyInArrow(_merge, f"{_CAPTURE}, range int, within bigint")
    return merged.join(F.broadcast(starts), "range").withColumn("position", F.col("before") + F.col("within")).drop("before", "within", "range")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    path = staged_path(spark, "archives")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    out = merge_index(read_archives(spark, path))
    out = out.withColumn("page_id", F.url_decode(F.nullif(F.regexp_extract("record", "^<urn:x-page:(.*)>$", 1), F.lit(""))).cast(kind))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url_key", "captured", "archive", "position", F.col("checked").alias("digest_checked"))
