"""WARC captures: not-modified revisits resolved against earlier full responses.

A revisit of the server-not-modified kind (HTTP 304) has no body. It stands for
the latest full response (status 200) captured strictly earlier at the same
canonical URL, provided the validators agree: entity tags by weak comparison if
the revisit has one, else the Last-Modified dates; a revisit with neither is
taken as it is. The stored headers are updated by those of the 304, save for
the fields that describe a body that was not sent or one connection only.

The as-of join has two levels, so that a URL with any share of all captures is
no single task: the last response of each URL and time slice is aggregated, the
slices of a URL (bounded by the time span) are walked in order, and only inside
a slice captures are ordered one by one. Payloads take no part in it.

Defined cases: captures without URL or date resolve to nothing; captures with
equal date are ordered by record id, and a response of the same instant is not
earlier; repeated records count as one capture each; a body or header that is
missing is empty; a page without a number makes no capture; a body that holds the
separator ``CRLF CRLF WARC/`` is cut there when files are read; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posloom.llm.common import Scratch, read_table

SLICE_SECONDS = 3600

# Header fields a 304 does not update (about the body, or one connection).
NOT_UPDATED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
HEADERS = "array<struct<name:string,value:string>>"
RECORD = (
    "record_id string, kind string, url string, captured timestamp, profile string, status int, "
    f"headers {HEADERS}, body binary"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of uncompressed or record-compressed WARC files, one row of bytes each.

    Files are split where one record ends and the next begins, so a large file
    is read by many tasks. Bytes stay as they are.
    """
    lines = spark.read.option("lineSep", "\r\n\r\nWARC/").text(path)
    return lines.select(F.col("value").cast("binary").alias("record")).filter(F.octet_length("record") > 0)


def _fields(block: bytes) -> list[tuple[str, str]]:
    out = []
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out.append((name.strip(), value.strip()))
    return out


def parse_record(record: bytes | None) -> dict | None:
    """One record: its own header, then, for HTTP, status line, header fields and body."""
    if not record:
        return None
    head, _, block = record.partition(b"\r\n\r\n")
    own = {name.lower(): value for name, value in _fields(head)}
    size = own.get("content-length", "")
    if size.isdigit():
        block = block[: int(size)]
    status, fields, body = None, [], b""
    if block.startswith(b"HTTP/"):
        first, _, body = block.partition(b"\r\n\r\n")
        line, _, rest = first.partition(b"\r\n")
        parts = line.split()
        status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else None
        fields = _fields(rest)
    else:
        body = block
    return {
        "record_id": own.get("warc-record-id"),
        "kind": own.get("warc-type"),
        "url": own.get("warc-target-uri"),
        "captured": own.get("warc-date"),
        "profile": own.get("warc-profile"),
        "status": status,
        "headers": [{"name": n, "value": v} for n, v in fields],
        "body": body,
    }


def parsed(records: DataFrame, column: str = "record") -> DataFrame:
    """Fields of each record; rows without bytes give none."""
    pairs = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
    schema = pa.schema(
        [("record_id", pa.string()), ("kind", pa.string()), ("url", pa.string()), ("captured", pa.string()),
         ("profile", pa.string()), ("status", pa.int32()), ("headers", pairs), ("body", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [parse_record(x.as_py()) for x in batch.slice(at, 500).column(0)]
                yield pa.RecordBatch.from_pylist([r for r in rows if r is not None], schema=schema)

    text = RECORD.replace("captured timestamp", "captured string")
    return records.select(F.col(column)).mapInArrow(run, text).withColumn("captured", F.expr("try_cast(captured AS timestamp)"))


def canonical(url: Column) -> Column:
    """One form for the spellings of an address.

    Scheme, user, ``www.``, default port, fragment, tracking parameters and a
    closing slash are left out; host is lower-case; parameters are sorted.
    """
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^utm_[a-z]+="))
    tail = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("?"), tail)))


def _header(name: str) -> Column:
    found = F.filter("headers", lambda h: F.lower(h["name"]) == name)
    return F.get(found, 0)["value"]


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^[Ww]/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored fields, with those the 304 may update replaced by the 304's own."""
    banned = F.array(*[F.lit(n) for n in NOT_UPDATED])
    updates = F.filter(fresh, lambda h: ~F.array_contains(banned, F.lower(h["name"])))
    names = F.transform(updates, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), updates)


def resolved(captures: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """A row per not-modified revisit, with the response it stands for.

    ``captures`` has the parsed fields without ``body``; more columns of
    responses are named by ``source_id`` and can be joined by it.
    """
    known = captures.withColumn("address", canonical(F.col("url"))).withColumn("at", F.col("captured").cast("timestamp"))
    known = known.withColumn("slice", F.floor(F.unix_timestamp("at") / slice_seconds))
    full = known.filter((F.col("kind") == "response") & (F.col("status") == 200) & F.col("address").isNotNull() & F.col("at").isNotNull())
    revisit = known.filter((F.col("kind") == "revisit") & ((F.col("status") == 304) | F.col("profile").rlike("server-not-modified")))
    source = F.struct("at", "record_id", F.col("headers").alias("stored"))
    events = full.select("address", "slice", "at", "record_id", F.lit(1).alias("later"), source.alias("source")).unionByName(
        revisit.filter(F.col("address").isNotNull() & F.col("at").isNotNull())
        .select("address", "slice", "at", "record_id", F.lit(0).alias("later"), "headers", "url"),
        allowMissingColumns=True,
    )
    # A response of the same instant sorts after the revisit: it is not earlier.
    inside = W.partitionBy("address", "slice").orderBy("at", "later", "record_id").rowsBetween(W.unboundedPreceding, -1)
    local = events.withColumn("here", F.last("source", ignorenulls=True).over(inside)).filter("later = 0")
    per_slice = full.groupBy("address", "slice").agg(F.max_by(source, F.struct("at", "record_id")).alias("last"))
    slices = per_slice.unionByName(
        revisit.select("address", "slice").distinct(), allowMissingColumns=True
    ).groupBy("address", "slice").agg(F.first("last", ignorenulls=True).alias("last"))
    walk = W.partitionBy("address").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = slices.withColumn("carried", F.last("last", ignorenulls=True).over(walk)).drop("last")
    met = local.join(carried, ["address", "slice"], "left").withColumn("found", F.coalesce("here", "carried"))
    met = met.select("record_id", "url", "address", "at", "headers", "found")
    lost = revisit.filter(F.col("address").isNull() | F.col("at").isNull()).select("record_id", "url", "address", "at", "headers")
    met = met.unionByName(lost, allowMissingColumns=True)
    tag, date = _header("etag"), _header("last-modified")
    stored = F.col("found.stored")
    had_tag = F.get(F.filter(stored, lambda h: F.lower(h["name"]) == "etag"), 0)["value"]
    had_date = F.get(F.filter(stored, lambda h: F.lower(h["name"]) == "last-modified"), 0)["value"]
    agrees = (
        F.when(tag.isNotNull(), F.coalesce(_opaque(tag) == _opaque(had_tag), F.lit(False)))
        .when(date.isNotNull(), F.coalesce(date == had_date, F.lit(False)))
        .otherwise(F.lit(True))
    )
    outcome = F.when(F.col("found").isNull(), "no_earlier_response").when(agrees, "resolved").otherwise("validator_mismatch")
    return (
        met.withColumn("outcome", outcome)
        .withColumn("source_id", F.col("found.record_id"))
        .withColumn("source_captured", F.col("found.at"))
        .withColumn("merged", F.when(F.col("outcome") == "resolved", merged_headers(stored, F.coalesce("headers", F.array().cast(HEADERS)))))
        .select("record_id", "url", "address", F.col("at").alias("captured"), "outcome", "source_id", "source_captured", "merged")
    )


# --- captures derived from the table of pages -------------------------------

EPOCH = "2024-01-01 00:00:00"


def _stamp(seconds: Column) -> Column:
    return F.date_format(F.lit(EPOCH).cast("timestamp") + F.make_dt_interval(secs=seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def capture_records(pages: DataFrame) -> DataFrame:
    """WARC records of all pages: a full response each, and a later revisit each.

    By the page's number some revisits come before any response, carry a weak
    tag, another tag, a date only, or no validator, and use another spelling of
    the address.
    """
    n = F.col("page_id")
    body = F.coalesce("html", F.lit(""))
    tag = F.substring(F.md5(body.cast("binary")), 1, 16)
    date = F.concat(F.lit("day "), (n % 28).cast("string"))
    end = "\r\n"

    def record(kind: str, number: Column, url: Column, seconds: Column, extra: str, block: Column) -> Column:
        return F.concat(
            F.lit(f"1.1{end}WARC-Type: {kind}{end}WARC-Record-ID: "), number, F.lit(f"{end}WARC-Target-URI: "), url,
            F.lit(f"{end}WARC-Date: "), _stamp(seconds), F.lit(f"{end}{extra}Content-Length: "),
            F.octet_length(block).cast("string"), F.lit(end * 2), block,
        ).cast("binary")

    url = F.coalesce("url", F.lit(""))
    full = F.concat(
        F.lit(f'HTTP/1.1 200 OK{end}Content-Type: text/html{end}ETag: "'), tag, F.lit(f'"{end}Last-Modified: '), date,
        F.lit(f"{end}Cache-Control: max-age=60{end}Content-Length: "), F.octet_length(body).cast("string"),
        F.lit(end * 2), body,
    )
    validators = (
        F.when(n % 7 == 0, F.lit(f'ETag: "other"{end}'))
        .when(n % 5 == 0, F.concat(F.lit("Last-Modified: "), date, F.lit(end)))
        .when(n % 11 == 0, F.lit(""))
        .when(n % 3 == 0, F.concat(F.lit('ETag: W/"'), tag, F.lit(f'"{end}')))
        .otherwise(F.concat(F.lit('ETag: "'), tag, F.lit(f'"{end}')))
    )
    short = F.concat(
        F.lit(f"HTTP/1.1 304 Not Modified{end}"), validators,
        F.lit(f"Cache-Control: max-age=3600{end}Content-Length: 0{end}X-Checked: yes{end * 2}"),
    )
    other = F.concat(F.regexp_replace(F.regexp_replace(url, "^https:", "HTTP:"), r"#.*$", ""), F.lit("#again"))
    later = F.when(n % 13 == 0, n * 60 - 1).otherwise(n * 60 + 86_400)
    profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified\r\n"
    number = n.cast("string")
    return pages.select(
        F.explode(
            F.array(
                record("response", F.concat(F.lit("r"), number), url, n * 60, "", full),
                record("revisit", F.concat(F.lit("v"), number), other, later, profile, short),
            )
        ).alias("record")
    )


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = parsed(capture_records(read_table(spark, sf_dir, "pages"))).select(
        "record_id", "kind", "url", "captured", "profile", "status", "headers",
        F.octet_length("body").cast("long").alias("body_bytes"), F.md5("body").alias("body_md5"),
    )
    captures = Scratch(spark).stage(captures)
    found = resolved(captures).alias("f")
    bodies = captures.filter("kind = 'response'").select(F.col("record_id").alias("source_id"), "body_bytes", "body_md5")
    return found.join(bodies, "source_id", "left").select(
        "record_id",
        "address",
        F.date_format("captured", "yyyy-MM-dd HH:mm:ss").alias("captured"),
        "outcome",
        F.when(F.col("outcome") == "resolved", F.col("source_id")).alias("source_id"),
        F.when(F.col("outcome") == "resolved", F.col("body_bytes")).alias("body_bytes"),
        F.when(F.col("outcome") == "resolved", F.col("body_md5")).alias("body_md5"),
        F.array_join(F.transform("merged", lambda h: F.concat(h["name"], F.lit("="), h["value"])), "; ").alias("merged_headers"),
    )


OP10_SQL = r"""
WITH p AS (
  SELECT page_id AS n, coalesce(url, '') AS url, coalesce(html, '') AS body FROM pages
), t AS (
  SELECT *, substr(md5(body), 1, 16) AS tag, 'day ' || (n % 28) AS day,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM p
), a AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)),
              '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS front,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
              lambda x: x <> '' AND NOT regexp_matches(x, '^utm_[a-z]+='))), '&') AS tail FROM t
), u AS (
  SELECT *, front || CASE WHEN tail = '' THEN '' ELSE '?' || tail END AS address FROM a
), r AS (
  SELECT address, n * 60 AS secs, 'r' || n AS id, tag, day, body FROM u
), v AS (
  SELECT address, CASE WHEN n % 13 = 0 THEN n * 60 - 1 ELSE n * 60 + 86400 END AS secs, 'v' || n AS id,
         CASE WHEN n % 7 = 0 THEN 'other' WHEN n % 5 = 0 OR n % 11 = 0 THEN NULL ELSE tag END AS tag,
         CASE WHEN n % 7 <> 0 AND n % 5 = 0 THEN day END AS day,
         CASE WHEN n % 7 <> 0 AND n % 5 <> 0 AND n % 11 <> 0 AND n % 3 = 0 THEN 'W/' ELSE '' END AS weak FROM u
), f AS (
  SELECT v.*, r.id AS source, r.tag AS rtag, r.day AS rday, r.body AS rbody
  FROM v LEFT JOIN r ON r.address = v.address AND r.secs < v.secs
  QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY r.secs DESC NULLS LAST, r.id DESC) = 1
), o AS (
  SELECT *, CASE WHEN source IS NULL THEN 'no_earlier_response'
                 WHEN tag IS NOT NULL THEN CASE WHEN tag = rtag THEN 'resolved' ELSE 'validator_mismatch' END
                 WHEN day IS NOT NULL THEN CASE WHEN day = rday THEN 'resolved' ELSE 'validator_mismatch' END
                 ELSE 'resolved' END AS outcome FROM f
)
SELECT id AS record_id, address,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(secs), '%Y-%m-%d %H:%M:%S') AS captured, outcome,
       CASE WHEN outcome = 'resolved' THEN source END AS source_id,
       CASE WHEN outcome = 'resolved' THEN strlen(rbody) END AS body_bytes,
       CASE WHEN outcome = 'resolved' THEN md5(rbody) END AS body_md5,
       CASE WHEN outcome = 'resolved' THEN
         'Content-Type=text/html; ' || CASE WHEN tag IS NULL THEN 'ETag="' || rtag || '"; ' ELSE '' END
         || CASE WHEN day IS NULL THEN 'Last-Modified=' || rday || '; ' ELSE '' END
         || 'Content-Length=' || strlen(rbody) || '; '
         || CASE WHEN tag IS NOT NULL THEN 'ETag=' || weak || '"' || tag || '"; ' ELSE '' END
         || CASE WHEN day IS NOT NULL THEN 'Last-Modified=' || day || '; ' ELSE '' END
         || 'Cache-Control=max-age=3600; X-Checked=yes' END AS merged_headers
FROM o
"""
