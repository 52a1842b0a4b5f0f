"""WARC archives of fetched pages: writing them, reading them back, and assembling one nested row per capture."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ride_analytics.sources.storage import fresh_path

MIN_REVISIT_BYTES = 100
CRLF = "\r\n"
# fixed values: the format's names
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_OK = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF * 2
# end of fixed values


def _record(kind: str, record_id, url, concurrent_to, block, extra) -> F.Column:
    """Text of one record, without the last line break of the two that end it."""
    head = F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: <"), record_id, F.lit(f">{CRLF}WARC-Target-URI: "), url, F.lit(CRLF),
        F.coalesce(F.concat(F.lit("WARC-Concurrent-To: <"), concurrent_to, F.lit(f">{CRLF}")), F.lit("")), extra,
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2))
    return F.concat(head, block, F.lit(CRLF))


def write_archives(pages: DataFrame, path: str, records_per_file: int = 3000) -> None:
    """Write request, response or revisit, and metadata record of every page row into gzip archives under ``path``.

    ``pages``: page_id long, url string, html string (null: empty payload).
    Of rows with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes those
    with the smallest page_id are responses and the others revisits, which hold
    no payload but name the response's record. Null ids come last. The id of a
    record tells page, payload and the number among wholly equal rows, so a task
    that runs again writes the same records.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("n", F.octet_length("html"))
    # only digests that repeat can make revisits; counts are merged before the shuffle
    first = (rows.where(F.col("n") >= MIN_REVISIT_BYTES).groupBy("digest")
             .agg(F.count("*").alias("rows"), F.min("page_id").alias("first_id")).where("rows > 1").select("digest", "first_id"))
    rows = rows.join(first, "digest", "left")
    same = Window.partitionBy("digest", "page_id", "url").orderBy("n")
    rows = rows.withColumn("copy", F.when(F.col("first_id").isNull() & (F.col("n") >= MIN_REVISIT_BYTES), 1).otherwise(F.row_number().over(same)))
    key = F.concat_ws("-", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.md5(F.coalesce("url", F.lit("")).cast("binary")),
                      F.col("copy").cast("string"), "digest")
    urn = lambda kind, of: F.concat(F.lit(f"urn:x-capture:{kind}:"), of)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    none = F.lit(None).cast("string")
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "%0A")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(CRLF))
    full = _record("response", urn("response", key), uri, none, F.concat(F.lit(HTTP_OK), "html"), digest)
    pointer = _record("revisit", urn("response", key), uri, none, F.lit(HTTP_OK), F.concat(
        digest, F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To-Page: "), F.col("first_id").cast("string"), F.lit(CRLF)))
    path_of = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    host_of = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    request = _record("request", urn("request", key), uri, urn("response", key), F.concat(
        F.lit("GET "), F.when(path_of == "", "/").otherwise(path_of), F.lit(f" HTTP/1.1{CRLF}Host: "), host_of, F.lit(CRLF * 2)), F.lit(""))
    about = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")),
                     F.when(F.col("url").isNull(), F.lit(f"no-url: 1{CRLF}")).otherwise(F.lit("")))
    metadata = _record("metadata", urn("metadata", key), uri, urn("response", key), about,
                       F.lit(f"Content-Type: application/warc-fields{CRLF}"))
    # each line break of the text writer is the second one after a record
    (rows.select(F.explode(F.array(request, F.when(revisit, pointer).otherwise(full), metadata)).alias("value"))
     .write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


RECORD = ("record_id string, type string, concurrent_to string, url string, headers map<string,string>, "
          "http string, payload binary, payload_bytes long, payload_digest string")


def parse_records(data: bytes):
    """(headers, block) of each record; bytes before a version line and a cut last record are an error."""
    at, n = 0, len(data)
    while at < n:
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                       for line in data[at:end].decode("utf-8").split(CRLF)[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is not as long as it says")
        yield headers, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives under ``path``, one row each; a response's payload is split from its HTTP head.

    An archive is read whole by one task, so its size bounds the memory; the
    writer bounds it by records. Without ``payloads`` only their digests and lengths are kept.
    """
    import hashlib

    def parse(reader):
        for batch in reader:
            for content in batch.column(0):
                rows = []
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                for headers, block in parse_records(data):
                    kind = headers["WARC-Type"]
                    head, _, payload = block.partition(b"\r\n\r\n") if kind in ("response", "revisit", "request") else (b"", b"", block)
                    is_response = kind == "response"
                    digest = hashlib.sha256(payload).hexdigest() if is_response else headers.get("WARC-Payload-Digest", "").partition(":")[2] or None
                    rows.append({"record_id": headers["WARC-Record-ID"].strip("<>"), "type": kind,
                                 "concurrent_to": headers["WARC-Concurrent-To"].strip("<>") if "WARC-Concurrent-To" in headers else None,
                                 "url": headers.get("WARC-Target-URI"), "headers": list(headers.items()),
                                 "http": head.decode("utf-8", "replace"), "payload": payload if kind == "metadata" or payloads and is_response else None,
                                 "payload_bytes": len(payload) if is_response else None, "payload_digest": digest})
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("url", pa.string()),
                       ("headers", pa.map_(pa.string(), pa.string())), ("http", pa.string()), ("payload", pa.binary()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, joined with the requests and metadata concurrent to it.

    Columns: record_id, record_type, url, refers_to (page of the response, for
    revisits), response (http, headers, payload, payload_bytes, payload_digest),
    requests and metadata (arrays of structs, empty where none is concurrent).
    The payload's length of a revisit is that of the response with its digest.
    Requests and metadata that are concurrent to no capture are left out.
    """
    main = records.where(F.col("type").isin("response", "revisit"))
    side = lambda kind, name: (records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias("record_id"))
                               .agg(F.collect_list(F.struct(F.col("record_id").alias("id"), "http", "payload", "headers")).alias(name)))
    none = F.array().cast("array<struct<id:string,http:string,payload:binary,headers:map<string,string>>>")
    sizes = (main.where("type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("full_bytes")))
    wanted = main.where("type = 'revisit'").select("payload_digest").distinct()
    sizes = sizes.join(wanted, "payload_digest", "left_semi")
    out = main.join(side("request", "requests"), "record_id", "left").join(side("metadata", "metadata"), "record_id", "left")
    out = out.join(sizes, "payload_digest", "left")
    return out.select(
        "record_id", F.col("type").alias("record_type"), "url", F.expr("cast(headers['WARC-Refers-To-Page'] as long)").alias("refers_to"),
        F.struct("http", "headers", "payload", F.when(F.col("type") == "revisit", F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                 "payload_digest").alias("response"),
        F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata"))


def captures(pages: DataFrame, payloads: bool = True, records_per_file: int = 3000) -> DataFrame:
    """Archive ``pages`` in the shared folder, read the archives back and assemble one row per capture, with its page_id.

    Null ids, addresses and texts, empty tables and repeated rows are kept: each
    row of ``pages`` is one capture. Equal rows that all carry the smallest id
    of their payload are all responses. Columns besides page_id, url and html
    are not read.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, records_per_file)
    rows = assemble(read_archives(spark, path, payloads))
    fields = F.decode(F.expr("metadata[0].payload"), "UTF-8")
    return (rows.withColumn("page_id", F.nullif(F.regexp_extract(fields, r"page-id: (-?[0-9]+)", 1), F.lit("")).cast("long"))
            .withColumn("url", F.when(fields.contains("no-url: 1"), None).otherwise(F.col("url"))))


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return captures(pages, payloads=False).select(
        "page_id", F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
