"""WARC archives: captures written as records, and put together again from them (operator 11).

`write_archives` writes three records per capture: the response (or a revisit of an equal payload), its request and its
metadata. Request and metadata name the response in WARC-Concurrent-To. Spark's text writer writes them, so archives lie on
any file system Spark knows, and a task that is lost leaves nothing behind. `read_records` reads archives record by record in
one pass: it parts the stream at the version line and gives each record the bytes its Content-Length asks for, so payloads
may hold version lines or whole records. `captures` joins request, response and metadata records through their
concurrent-to identifiers, whichever of two records names the other, to one nested row per capture.

Of captures with equal payloads of at least `least` bytes, that with the largest page id (then the largest url) is the
response, the others revisit it. Where rows repeat it, one of them is. Equal payloads are recognised by their SHA-1.
Null payloads are empty, a null url is an empty one, a null page id sorts first and is null again when read; line ends in a
url are percent-encoded. An empty table gives no record. Other columns of the table are not read. Payloads are shuffled by
page, so that no task meets a group of copies. A record must fit in memory, an
archive need not.

Archives are gzip files; plain files would be cut into splits and are not read. A record cut short is returned with
`whole` false. Records that name no response are returned by `captures` without one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.text import stored

VERSION = "WARC/1.0\r\n"
#: Fixed value: how a revisit says that it was recognised by its payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
LEAST = 1000
DATE = "2024-01-01T00:00:00Z"
_SALTS = 8
_BLOCK = 10_000
_BATCH = 1 << 22
RECORDS = (
    "file string, record_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "date string, payload_digest string, content_type string, http_headers string, payload binary, whole boolean"
)


def _copies(rows: DataFrame, first: Column, count: Column) -> DataFrame:
    """`rows` once for each `copy` from `first` to `count` - 1; no array holds more than a block of them."""
    blocks = rows.withColumns({"_first": first.cast("long"), "_count": count.cast("long")}).where("_first < _count")
    each = blocks.withColumn("_block", F.explode(F.expr(f"sequence(_first div {_BLOCK}, (_count - 1) div {_BLOCK})")))
    inside = F.sequence(
        F.greatest(F.col("_block") * _BLOCK, F.col("_first")), F.least((F.col("_block") + 1) * _BLOCK, F.col("_count")) - 1
    )
    return each.withColumn("copy", F.explode(inside)).drop("_first", "_count", "_block")


def _record_id(kind: str, page: Column, url: Column, digest: Column, copy: Column) -> Column:
    """A record's own name, made of what tells captures apart."""
    own = F.md5(F.concat_ws(":", F.lit(kind), F.coalesce(page.cast("string"), F.lit("-")), digest, copy.cast("string"), url))
    parts = [F.substring(own, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def decide(pages: DataFrame, page_id: str = "page_id", url: str = "url", text: str = "html", least: int = LEAST) -> DataFrame:
    """page_id, url, digest, bytes, copy (tells repeated rows apart), payload (null for revisits), first_page, first_url
    (of a revisit's response; else null) of every row of `pages`. Stores a table without the payloads (runs a job)."""
    payload = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"), payload.alias("payload"),
    )
    small = F.col("bytes") < least
    narrow = stored(
        rows.withColumn("payload", F.when(small, F.col("payload")))
        .groupBy("page_id", "url", "digest", "bytes", "payload")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    groups = narrow.where(~small).groupBy("digest").agg(
        F.max(F.struct("page_id", "url", "n")).alias("top"), F.sum("n").alias("members")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    shared = groups.where("members > 1").select(
        "digest", F.col("top.page_id").alias("first_page"), F.col("top.url").alias("first_url"), salts.alias("salt")
    )
    is_top = F.col("page_id").eqNullSafe(F.col("first_page")) & (F.col("url") == F.col("first_url"))

    # Payloads are shuffled once, by a key that only repeated rows share; of these a map task sends one.
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    same_row = Window.partitionBy("digest", "page_key", "url").orderBy("bytes")
    large = rows.where(~small).withColumn("page_key", key).withColumn("_place", F.row_number().over(same_row)).where("_place = 1")
    tops = groups.select("digest", F.coalesce(F.col("top.page_id").cast("string"), F.lit("-")).alias("page_key"), F.col("top.url").alias("url"))
    first = large.join(tops, ["digest", "page_key", "url"], "left_semi")
    columns = ["page_id", "url", "digest", "bytes", "payload"]
    responses = first.select(*columns).withColumn("copy", F.lit(0).cast("long"))
    short = _copies(narrow.where(small), F.lit(0), F.col("n")).select(*columns, "copy")

    others = narrow.where(~small).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int"))
    others = others.join(shared, ["digest", "salt"])
    revisits = _copies(others, F.when(is_top, 1).otherwise(0), F.col("n")).select(
        *columns, "copy", "first_page", "first_url"
    )
    return responses.unionByName(short).unionByName(revisits, allowMissingColumns=True)


def record_texts(decided: DataFrame, date: str = DATE) -> DataFrame:
    """record: the three records of each capture, without the line ends that close them."""
    page, url, digest, copy = F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy")
    own = _record_id("response", page, url, digest, copy)
    first = _record_id("response", F.col("first_page"), F.col("first_url"), digest, F.lit(0))
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("first_url").isNotNull()
    host = F.regexp_extract(uri, "^[A-Za-z]+://([^/?#]*)", 1)
    path = F.regexp_extract(uri, "^[A-Za-z]+://[^/?#]*(.*)$", 1)

    def record(kind, identity, content_type: str, block, *more) -> Column:
        head = [
            F.lit(f"{VERSION}WARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), identity, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri,
            *more, F.lit(f"\r\nContent-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block,
        ]
        return F.concat(*head)

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    points = F.concat(F.lit(f"\r\nWARC-Profile: {SAME_PAYLOAD}\r\nWARC-Refers-To: "), first)
    response = record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), own, "application/http;msgtype=response",
        F.concat(http, F.coalesce("payload", F.lit(""))), F.lit("\r\nWARC-Payload-Digest: sha1:"), digest, F.when(revisit, points).otherwise(F.lit("")),
    )
    concurrent = F.concat(F.lit("\r\nWARC-Concurrent-To: "), own)
    request = record(
        F.lit("request"), _record_id("request", page, url, digest, copy), "application/http;msgtype=request",
        F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")), concurrent,
    )
    fields = F.concat(F.coalesce(F.concat(F.lit("page-id: "), page.cast("string"), F.lit("\r\n")), F.lit("")), F.lit("copy: "), copy.cast("string"), F.lit("\r\n"))
    metadata = record(F.lit("metadata"), _record_id("metadata", page, url, digest, copy), "application/warc-fields", fields, concurrent)
    return decided.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, date: str = DATE) -> None:
    """Writes the records of all `pages` (page_id, url, html) as gzip archives into the new folder `path`."""
    texts = record_texts(decide(pages, least=least), date)
    texts.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


class _Record:
    """A record while its bytes come in. `data` starts behind the version line."""

    def __init__(self, file: str, data: bytes):
        self.file, self.parts, self.size = file, [data], len(data)
        self.fields, self.start, self.length = [], -1, -1
        self._open()

    def _open(self) -> None:
        data = self.parts[0] if len(self.parts) == 1 else b"".join(self.parts)
        self.parts = [data]
        self.start = data.find(b"\r\n\r\n") + 4
        if self.start >= 4:
            lines = data[: self.start - 4].decode("utf-8", "replace").split("\r\n")
            self.fields = [(name.strip().lower(), value.strip()) for name, _, value in (line.partition(":") for line in lines)]
            length = self.get("content-length") or ""
            self.length = int(length) if length.isascii() and length.isdigit() else -1

    def add(self, data: bytes) -> None:
        self.parts.append(data)
        self.size += len(data)
        if self.start < 4:
            self._open()

    def whole(self) -> bool:
        return self.start >= 4 and 0 <= self.length <= self.size - self.start

    def waits(self) -> bool:
        """Whether bytes are still to come. A record that does not say its length ends at the next version line."""
        return self.start >= 4 and self.length > self.size - self.start

    def all(self, name: str) -> list[str]:
        return [v for n, v in self.fields if n == name]

    def get(self, name: str) -> str | None:
        return next(iter(self.all(name)), None)

    def row(self) -> tuple:
        data = b"".join(self.parts)
        block = data[max(self.start, 0) :]
        block = block[: self.length] if self.length >= 0 else block.removesuffix(b"\r\n\r\n")
        kind = self.get("content-type")
        http = None
        if (kind or "").lower().startswith("application/http"):
            head, gap, body = block.partition(b"\r\n\r\n")
            http, block = (head.decode("utf-8", "replace"), body) if gap else (None, block)
        return (
            self.file, self.get("warc-type"), self.get("warc-record-id"), self.all("warc-concurrent-to"), self.get("warc-refers-to"),
            self.get("warc-target-uri"), self.get("warc-date"), self.get("warc-payload-digest"), kind, http, block, self.whole(),
        )


_SCHEMA = pa.schema(
    [(n, pa.string()) for n in ("file", "record_type", "record_id")]
    + [("concurrent_to", pa.list_(pa.string()))]
    + [(n, pa.string()) for n in ("refers_to", "target_uri", "date", "payload_digest", "content_type", "http_headers")]
    + [("payload", pa.binary()), ("whole", pa.bool_())]
)


def _records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records out of the parts between version lines; parts of a file come in order, file after file."""
    version = VERSION.encode()
    record: _Record | None = None
    rows, held = [], 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    for batch in batches:
        for file, part in zip(batch.column(0), batch.column(1), strict=True):
            file, part = file.as_py(), part.as_py()
            fresh = record is None or record.file != file
            if not fresh and record.waits():
                record.add(version + part)
                continue
            if record is not None and record.size:
                rows.append(record.row())
                held += record.size
                if held >= _BATCH:
                    yield batch_of(rows)
                    rows, held = [], 0
            # What stands before the first version line of a file is no record.
            record = _Record(file, b"") if fresh else _Record(file, part)
    if record is not None and record.size:
        rows.append(record.row())
    if rows:
        yield batch_of(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all gzip archives in a folder (columns of `RECORDS`)."""
    parts = spark.read.option("lineSep", VERSION).option("pathGlobFilter", "*.gz").text(path)
    return parts.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("part")).mapInArrow(_records_of, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """capture_id, response (a struct: response or revisit; null where no record of that name is there), requests, metadata
    (arrays of structs by record id) of every capture."""
    columns = [c for c in records.columns if c != "concurrent_to"]
    whole = records.withColumn("record", F.struct(*columns))
    main = F.col("record_type").isin("response", "revisit")
    responses = whole.where(main).select(F.col("record_id").alias("capture_id"), F.col("record").alias("response"))
    others = whole.where(~main & F.col("record_type").isin("request", "metadata"))
    named = others.select(F.explode("concurrent_to").alias("capture_id"), "record")
    naming = whole.where(main).select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other"))
    named_back = naming.join(others.select(F.col("record_id").alias("other"), "record"), "other").select("capture_id", "record")
    attached = named.unionByName(named_back).groupBy("capture_id").agg(
        *[
            F.sort_array(F.collect_set(F.when(F.col("record.record_type") == kind, F.struct("record.record_id", "record")))).alias(name)
            for kind, name in (("request", "requests"), ("metadata", "metadata"))
        ]
    )
    none = F.array().cast(T.ArrayType(whole.schema["record"].dataType))
    lists = [F.coalesce(F.transform(c, lambda x: x["record"]), none).alias(c) for c in ("requests", "metadata")]
    return responses.join(attached, "capture_id", "full").select("capture_id", "response", *lists)


def catalogue(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (the page id of a revisit's response) and target_uri of
    the captures in the records that `write_archives` wrote. Lengths and digests of responses are taken from the payloads
    read; the payloads themselves are not shuffled. Stores the records without them (runs a job)."""
    kind, said = F.col("record_type"), F.regexp_extract("http_headers", r"(?im)^content-length:[ \t]*([0-9]+)", 1)
    main = kind.isin("response", "revisit")
    brief = stored(
        records.withColumns(
            {
                "payload_bytes": F.when(kind == "revisit", F.nullif(said, F.lit("")).cast("long")).otherwise(F.octet_length("payload").cast("long")),
                "payload_digest": F.when(kind == "revisit", F.regexp_replace("payload_digest", "^sha1:", "")).when(main, F.sha1("payload")),
                "payload": F.when(~main, F.col("payload")),
            }
        ).drop("file", "date", "content_type", "http_headers")
    )
    fields = F.concat_ws("\n", F.transform("metadata", lambda m: m["payload"].cast("string")))
    rows = captures(brief).where(F.col("response").isNotNull()).select(
        "capture_id", F.nullif(F.regexp_extract(fields, r"(?m)^page-id: (-?[0-9]+)", 1), F.lit("")).cast("long").alias("page_id"),
        *[F.col(f"response.{c}").alias(c) for c in ("payload_bytes", "payload_digest", "record_type", "target_uri")],
        F.col("response.refers_to").alias("refers_id"),
    )
    salt = F.pmod(F.xxhash64("capture_id"), F.lit(_SALTS)).cast("int")
    asked = brief.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("refers_id")).distinct()
    known = rows.select(F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to")).join(asked, "refers_id", "left_semi")
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    joined = rows.withColumn("salt", salt).join(known, ["refers_id", "salt"], "left")
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
    first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS top
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND place > 1 THEN top END AS refers_to
FROM placed
"""
