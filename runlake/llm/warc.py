"""WARC archives of pages: writing with revisits and segments, and reading them whole again.

Each page becomes a response record, or a revisit where an earlier page has the same payload. Payloads are
sent in chunked transfer framing; a block beyond the segment size goes on in continuation records. Reading
groups the segments by the identifier of the record that they continue, orders them by number, verifies
the total length, decodes the chunks and verifies the payload's digest. Spark's text sink writes the
records, so its commit protocol covers lost executors and any file system that Spark knows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, smaller_batches, spooled

#: Bytes of a block before it goes on in another record, bytes of a chunk, records of a file at most. A record has little
#: more than SEGMENT bytes, so a file has some 130 MB at most, and a fraction of that gzipped.
SEGMENT, CHUNK, FILE_RECORDS = 16384, 4096, 8_000
#: Bytes that are inflated at a time, and bytes of a record's head at most.
INFLATED, HEAD_BYTES = 1 << 20, 1 << 20
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def cut(data: bytes, size: int) -> list[bytes]:
    """Pieces of at most ``size`` bytes that end between characters."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in cut(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; a size that doesn't fit, or a missing end, is an error."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        piece = body[line + 2 : line + 2 + size]
        if len(piece) < size or body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("a chunk doesn't have its stated size")
        out.append(piece)
        at = line + 4 + size


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def _one_line(value: str) -> str:
    return " ".join(value.split())


def name_of(page_id: int | str | None, digest: str, mark: str = "") -> str:
    """A record's identifier; a response with a page's id has no mark, for a payload has one such response only."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}{mark}>"


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, mark: str) -> list[bytes]:
    """The records of a page; ``mark`` tells apart pages that repeat an id, or have none."""
    response = refers_to is None and page_id is not None
    name = name_of(page_id, digest, "" if response else f":{mark}")
    fields = {"WARC-Record-ID": name, "WARC-Target-URI": _one_line(url or ""), "WARC-Payload-Digest": f"sha1:{digest}"}
    if refers_to is not None:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": name_of(refers_to, digest)}
        return [record("revisit", fields | {"Content-Type": "application/http;msgtype=response"}, HEAD)]
    block = HEAD + chunked(payload)
    parts = cut(block, SEGMENT)
    first = fields | {"Content-Type": "application/http;msgtype=response"}
    if len(parts) == 1:
        return [record("response", first, block)]
    out = [record("response", first | {"WARC-Segment-Number": "1"}, parts[0])]
    for number, part in enumerate(parts[1:], 2):
        own = {"WARC-Record-ID": name_of(page_id, digest, f":{mark}:{number}"), "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": str(number)}
        out.append(record("continuation", own | ({"WARC-Segment-Total-Length": str(len(block))} if number == len(parts) else {}), part))
    return out


def verdicts(rows: DataFrame) -> DataFrame:
    """For each different page (key): its rows ``n``, ``refers_to``, and ``first``: whether it is its payload's response.

    Of pages with one payload the first by (page_id, url) is the response; pages without an id come last. All this
    is over narrow rows, so that a payload of very many pages burdens no task with texts.
    """
    pages = rows.groupBy("key", "page_id", "url", "sha1").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "key"))).alias("least")
    firsts = pages.groupBy("sha1").agg(least, F.sum("n").alias("total")).filter("total > 1 and least is not null").select("sha1", F.col("least.page_id").alias("first_id"), F.col("least.key").alias("first_key"))
    judged = pages.join(firsts, "sha1", "left").withColumn("first", F.coalesce(F.col("key") == F.col("first_key"), F.lit(False)))
    return spooled(judged.select("key", "n", "first", F.when(~F.col("first"), F.col("first_id")).alias("refers_to")), "verdicts")


def write(pages: DataFrame, path: str) -> None:
    """Write a WARC record for each page (page_id, url, html) under ``path``, as gzipped files.

    Of pages with one payload, that with the smallest page_id is a response and the others revisit it; of several
    rows with that id the one of the least url, and of equal rows one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    rows = rows.withColumn("key", F.sha1(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("="), "url"), F.lit("")), "sha1")))
    known = verdicts(rows)
    columns = ["page_id", "url", "html", "sha1", "refers_to"]
    joined, again = rows.join(known, "key"), known.filter("first and n > 1")
    if again.isEmpty():
        out = joined.select(columns)
    else:  # equal rows that come first: one of them answers, the others revisit it and need no text
        whole = rows.join(again, "key").groupBy("key").agg(*(F.first(c).alias(c) for c in ("page_id", "url", "html", "sha1", "n")))
        each = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).withColumn("refers_to", F.when(F.col("k") > 1, F.col("page_id")))
        out = joined.filter("not (first and n > 1)").select(columns).unionByName(each.withColumn("html", F.when(F.col("k") == 1, F.col("html"))).select(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in smaller_batches(whole, "html", 8 << 20):
                out = []
                for page_id, url, html, sha1, refers_to in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "sha1", "refers_to")), strict=True):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    out += records_of(page_id, url, (html or "").encode(), digest, refers_to, f"{task}-{at}")
                    at += 1
                yield pa.RecordBatch.from_arrays([pa.array([r.decode() for r in out], pa.string())], names=["value"])

    out.mapInArrow(run, "value string").write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def inflated(data: bytes, most: int = INFLATED) -> Iterator[bytes]:
    """The content of a gzipped file, which may be many gzipped parts one after another, in pieces of at most ``most`` bytes."""
    at, view = 0, memoryview(data)
    while at < len(view):
        part = zlib.decompressobj(31)
        while not part.eof:
            given = part.unconsumed_tail or view[at : at + most]
            if not len(given):
                raise EOFError("a gzipped file ends before its end")
            at += 0 if part.unconsumed_tail else len(given)
            if piece := part.decompress(given, most):
                yield piece
        at -= len(part.unused_data)


def parse(data: bytes | Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """The fields (names in lower case) and the block of each record, in order; breaks off with an error on bad framing.

    Of a file given in pieces no more than a record and a piece is held.
    """
    pieces = iter([data] if isinstance(data, bytes) else data)
    held, at = bytearray(), 0

    def more() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    place = 0
    while at < len(held) or more():
        while (head := held.find(END, at)) < 0:
            if len(held) - at > HEAD_BYTES or not more():
                raise ValueError(f"no record at byte {place}")
        lines = held[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {place}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start, size = head + 4, int(fields["content-length"])
        while len(held) < start + size + 4 and more():
            pass
        if held[start + size : start + size + 4] != END:
            raise ValueError(f"the record at byte {place} doesn't have its stated length")
        yield fields, bytes(held[start : start + size])
        place += start + size + 4 - at
        at = start + size + 4
        if at > INFLATED:
            del held[:at]
            at = 0


def whole(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of (number, total length, bytes): numbers must run from 1 and the length be right."""
    segments = sorted(segments, key=lambda s: s[0])
    block = b"".join(s[2] for s in segments)
    if [s[0] for s in segments] != list(range(1, len(segments) + 1)) or segments[-1][1] != len(block):
        raise ValueError("segments are missing or don't have their stated length")
    return block


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``: page_id, url, payload_bytes, payload_digest, record_type, refers_to, n_segments.

    A revisit gets the size of the payload that it refers to. Framing, lengths and digests are verified; what
    doesn't hold is an error, for nothing may be lost unseen.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, origin string, number int, total long, block binary"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]

    def verified(block: bytes, digest: str) -> int:
        payload = unchunked(block[block.index(END) + 4 :])
        if base32_sha1(payload) != digest:
            raise ValueError("a payload doesn't have its stated digest")
        return len(payload)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                data = content.as_py()
                rows, held = [], 0
                for f, block in parse(inflated(data) if data[:2] == b"\x1f\x8b" else data):
                    name = f["warc-record-id"]
                    page = name[len("<urn:x-page:") :].split(":")[0]
                    number = int(f["warc-segment-number"]) if "warc-segment-number" in f else None
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    size = verified(block, digest) if f["warc-type"] == "response" and number is None else None
                    refers_to = int(f["warc-refers-to"][len("<urn:x-page:") :].split(":")[0]) if "warc-refers-to" in f else None
                    total = int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None
                    rows.append((int(page) if page else None, f.get("warc-target-uri"), size, digest, f["warc-type"], refers_to, f.get("warc-segment-origin-id", name), number, total, block if number else None))
                    held += len(block) if number else 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [verified(whole([(s["number"], s["total"], s["block"]) for s in parts.as_py()]), digest.as_py()) for parts, digest in zip(batch["parts"], batch["payload_digest"], strict=True)]
            counts = [len(p) for p in batch["parts"]]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(sizes, pa.int64()), batch["payload_digest"], pa.array(counts, pa.int32())], names=["page_id", "url", "payload_bytes", "payload_digest", "n_segments"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(parsed, schema)
    return _resolved(records, joined)


def _resolved(records: DataFrame, joined) -> DataFrame:
    records = spooled(records, "records")
    plain = records.filter("number is null")
    first = F.max(F.when(F.col("number") == 1, F.struct("page_id", "url", "payload_digest"))).alias("first")
    segments = records.filter("number is not null").groupBy("origin").agg(first, F.collect_list(F.struct("number", "total", "block")).alias("parts"))
    rebuilt = segments.select("first.*", "parts").mapInArrow(joined, "page_id long, url string, payload_bytes long, payload_digest string, n_segments int")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "n_segments"]
    responses = plain.filter("record_type = 'response'").withColumn("n_segments", F.lit(1)).select(columns)
    responses = responses.unionByName(rebuilt.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long")).select(columns))
    revisits = plain.filter("record_type = 'revisit'").select("page_id", "url", "payload_digest", "record_type", "refers_to")
    sizes = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    back = revisits.join(sizes, ["refers_to", "payload_digest"], "left").withColumn("n_segments", F.lit(1)).select(columns)
    return responses.unionByName(back)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as WARC archives in the shared folder, read them back: a row per row of ``pages``.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an
    empty payload, and empty payloads equal each other. A null page_id is larger than any: it revisits a
    page with an id, and is a response where there is none. Of rows that repeat the smallest id and its payload
    one is the response, that of the least url. Other columns are ignored; an empty table gives an empty one.
    """
    path = shared_dir(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
