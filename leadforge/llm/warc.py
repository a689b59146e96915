"""WARC archives: writing captures as request, response (or revisit) and metadata records, and putting them together again.

``write`` makes three records per row of a page table. Of rows with equal payloads the one with the largest id is the
response; the others are revisits of it that carry no payload. ``read`` parses archives, plain or gzip, record by record
by their Content-Length. ``assemble`` joins the records of a capture through WARC-Concurrent-To.

Cases: a null payload is the empty one; a null url leaves out WARC-Target-URI, and control characters in a url are
percent-encoded; a null id takes part as the smallest, and refers_to is null where the response's id is. Rows that repeat
id and payload stay separate records: one of them is the response if theirs is the largest id, the rest revisit it.
Other columns of the input are not read. A folder without records gives no rows. A damaged record raises.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm.common import ship, stored

VERSION = "WARC/1.1"
COPIES = 1000  # of equal rows, that are written by one task in one go
CRLF = "\r\n"
CAPTURES = ("response", "revisit", "resource")
RECORD = """record_id string, record_type string, date string, target_uri string, concurrent_to array<string>, refers_to string,
declared_digest string, block_bytes long, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"""


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of bytes: 40 hex digits are 8 groups of 20 bits, 4 letters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    digits = F.sha2(F.concat_ws("|", *parts), 256)
    cuts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _safe_url(url: Column) -> Column:
    for code in (0, 9, 10, 13):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _marked(value: Column) -> Column:
    """A value as text that differs from that of a missing one."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def classify(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, block: int = COPIES
) -> tuple[DataFrame, DataFrame]:
    """(captures, payloads): a narrow row per page with its record type, and each payload once by its ``key``.

    Rows that agree in payload, id and url are counted, not numbered: however many they are, they meet as one row per map
    task. They become captures again in blocks of ``block`` that are spread over all tasks. Joins meet stored narrow tables,
    so adaptive execution can split a payload that many pages share. Payloads are combined before their shuffle.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    data = F.col("payload").cast("binary")
    rows = rows.withColumn("key", F.concat_ws(":", F.sha2(data, 256), F.octet_length("payload").cast("string")))
    payloads = rows.groupBy("key").agg(F.any_value("payload").alias("payload"))
    described = rows.select("key", "page_id", "url", base32_sha1(data).alias("digest"), F.octet_length("payload").alias("size"))
    counts = described.groupBy("key", "page_id", "url").agg(F.count("*").alias("n"), F.min("digest").alias("digest"), F.min("size").alias("size"))
    counts = stored(counts, "counts")
    # Of a payload's rows the one with the largest id is first (a null id is the smallest), then the least url, a null one last.
    by_id = counts.groupBy("key", "page_id").agg(F.min(F.struct(F.col("url").isNull().alias("none"), "url")).alias("least"))
    first = stored(by_id.groupBy("key").agg(F.max(F.struct("page_id", "least")).alias("first")), "first")
    equal = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.least.url"))
    found = counts.join(first, "key").withColumn("equal", equal).drop("first")
    blocks = found.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block))))
    spread = blocks.repartition("key", "page_id", "url", "block")
    low = F.col("block") * block
    captures = spread.withColumn("number", F.explode(F.sequence(low, F.least(F.col("n"), low + block) - 1)))
    leads = F.col("equal") & (F.col("number") == 0)
    captures = captures.withColumns({"is_first": leads, "is_response": leads | (F.col("size") < least)})
    return captures.drop("equal", "block", "n"), payloads


def _header(*lines: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(F.lit(VERSION + CRLF), *[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in lines], F.lit(CRLF))


def write(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", codec: str = "gzip", least: int = 0, **columns) -> None:
    """Writes the archives; a task's rows are one file. The text writer's line end is the end that WARC asks for."""
    captures, payloads = classify(pages, least=least, **columns)
    captures = stored(captures, "captures")
    revisits = captures.filter("not is_response").withColumn("payload", F.lit(""))
    rows = captures.filter("is_response").join(payloads, "key").unionByName(revisits)
    body = F.col("payload")
    newest = _urn(F.lit("response"), F.col("key"))
    own = F.when(F.col("is_first"), newest).otherwise(
        _urn(F.lit("copy"), F.col("key"), _marked(F.col("page_id")), _marked(F.col("url")), F.col("number").cast("string")))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    uri, when = _safe_url(F.col("url")), F.lit(date)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(F.col("is_response"), F.concat(http, body)).otherwise(http)
    length = lambda text: F.octet_length(text).cast("string")
    main = F.concat(_header(
        ("WARC-Type", F.when(F.col("is_response"), "response").otherwise("revisit")), ("WARC-Record-ID", own), ("WARC-Date", when),
        ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(~F.col("is_response"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.when(~F.col("is_response"), newest)),
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", length(block)),
    ), block)
    asked = F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_extract(uri, "^[^:]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(F.regexp_extract(uri, "://([^/?#]*)", 1), F.lit("")), F.lit(CRLF + CRLF))
    request = F.concat(_header(
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn(F.lit("request"), own)), ("WARC-Date", when), ("WARC-Target-URI", uri),
        ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http; msgtype=request")), ("Content-Length", length(asked)),
    ), asked)
    facts = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")), F.lit("payload-bytes: "), F.col("size").cast("string"), F.lit(CRLF))
    metadata = F.concat(_header(
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn(F.lit("metadata"), own)), ("WARC-Date", when), ("WARC-Target-URI", uri),
        ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields")), ("Content-Length", length(facts)),
    ), facts)
    records = rows.select(F.explode(F.array(request, main, metadata)).alias("value"))
    records.write.option("lineSep", CRLF * 2).option("compression", codec).text(path)


def _inflate(data: bytes) -> bytes:
    """All members of a gzip file, one member a record or one a file."""
    parts = []
    while data:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join(parts)


def parse(data: bytes) -> Iterator[tuple[dict[str, list[str]], memoryview]]:
    """Headers (names in lower case) and block of each record of an archive."""
    if data[:2] == b"\x1f\x8b":
        data = _inflate(data)
    view, at, end = memoryview(data), 0, len(data)
    while at < end:
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        stop = data.find(b"\r\n\r\n", at)
        if data[at : at + 5] != b"WARC/" or stop < 0:
            raise ValueError(f"no WARC record at byte {at}")
        headers: dict[str, list[str]] = {}
        for line in data[at:stop].decode("utf-8").split(CRLF)[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        if stop + 4 + size > end:
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, view[stop + 4 : stop + 4 + size]
        at = stop + 4 + size


def _record(headers: dict[str, list[str]], block: memoryview, with_payload: bool) -> dict:
    one = lambda name: headers.get(name, [None])[0]
    kind, content = one("warc-type"), one("content-type") or ""
    payload, fields = block, None
    if content.startswith("application/http"):
        raw = bytes(block)
        cut = raw.find(b"\r\n\r\n")
        payload = raw[cut + 4 :] if cut >= 0 else b""
    elif content.startswith("application/warc-fields"):
        pairs = (line.partition(":") for line in bytes(block).decode("utf-8").split(CRLF) if ":" in line)
        fields = [(name.strip(), value.strip()) for name, _, value in pairs]
    return {
        "record_id": one("warc-record-id"), "record_type": kind, "date": one("warc-date"), "target_uri": one("warc-target-uri"),
        "concurrent_to": headers.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"), "declared_digest": one("warc-payload-digest"),
        "block_bytes": len(block), "payload_bytes": len(payload), "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "fields": dict(fields) if fields is not None else None, "payload": bytes(payload) if with_payload else None,
    }


def read(spark: SparkSession, path: str, with_payload: bool = False, batch_bytes: int = 4 << 20) -> DataFrame:
    """One row per record of all archives below ``path``. Payload length and digest are those of the bytes read."""
    ship(spark)
    schema = T.StructType.fromDDL(RECORD)
    arrow = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("date", pa.string()), ("target_uri", pa.string()),
        ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("declared_digest", pa.string()), ("block_bytes", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
    ])

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for headers, block in parse(data.as_py()):
                    rows.append(_record(headers, block, with_payload))
                    held += 400 + len(block) * with_payload
                    if held > batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0")
    return files.select("content").mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` with its ``requests`` and ``metadata``, found through WARC-Concurrent-To.

    Either side may name the other. A request or metadata record that belongs to no capture stays, in a row whose
    response is null. Records of one capture are ordered by their id.
    """
    main = records.filter(F.col("record_type").isin(*CAPTURES))
    # The parsed archives are used four times; the caller hands in a durable frame where parsing is dear.
    rest = records.filter(F.col("record_type").isin("request", "metadata"))
    names = [c for c in records.columns]
    links = rest.select("record_id", F.explode("concurrent_to").alias("capture_id")).join(main.select(F.col("record_id").alias("capture_id")), "capture_id")
    back = main.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("record_id"))
    links = links.select("capture_id", "record_id").unionByName(back).distinct()
    linked = rest.join(links, "record_id", "left").select(F.col("capture_id"), F.struct(*names).alias("record"))
    is_request = F.col("record.record_type") == "request"
    gathered = linked.groupBy(F.coalesce("capture_id", "record.record_id").alias("anchor"), F.col("capture_id").isNull().alias("loose")).agg(
        F.sort_array(F.collect_list(F.when(is_request, _sortable("record", names)))).alias("requests"),
        F.sort_array(F.collect_list(F.when(~is_request, _sortable("record", names)))).alias("metadata"),
    )
    both = main.select(F.col("record_id").alias("capture_id"), F.struct(*names).alias("response")).join(
        gathered.withColumn("capture_id", F.when(~F.col("loose"), F.col("anchor"))), "capture_id", "full")
    return both.select(F.coalesce("capture_id", "anchor").alias("capture_id"), "response", "requests", "metadata")


def _sortable(record: str, names: list[str]) -> Column:
    """The record without its map, which cannot be ordered; its fields become an array of entries."""
    parts = [F.map_entries(f"{record}.{n}").alias(n) if n == "fields" else F.col(f"{record}.{n}").alias(n) for n in names]
    return F.struct(*parts)


def field(entries: Column, name: str) -> Column:
    """The value of a named field in a metadata record's entries."""
    return F.element_at(F.map_from_entries(entries), name)


def captures(assembled: DataFrame) -> DataFrame:
    """One row per written page: id, payload length, digest, type and the id of the page that a revisit refers to."""
    meta = F.get("metadata", F.lit(0))
    rows = assembled.filter("response is not null").select(
        "capture_id", F.col("response.record_type").alias("record_type"), F.col("response.refers_to").alias("refers_to_id"),
        field(meta["fields"], "page-id").cast("long").alias("page_id"),
        F.when(F.col("response.record_type") == "revisit", field(meta["fields"], "payload-bytes").cast("long")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(F.col("response.record_type") == "revisit", F.regexp_replace("response.declared_digest", "^sha1:", "")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
    )
    targets = rows.filter("record_type = 'response'").select(F.col("capture_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    plain = rows.filter("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    joined = rows.filter("refers_to_id is not null").join(targets, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return plain.select(columns).unionByName(joined.select(columns))
