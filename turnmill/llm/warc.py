"""WARC archives: a writer, and a reader that salvages what damage has left.

*Writer.* Every row becomes one record in a gzip member of its own. Of records with equal
payloads of at least ``revisit_from`` bytes the one with the smallest id is the response,
all others are revisits that name it and carry no payload. Spark's own text sink writes the
files, so task retries and any file system Spark knows are taken care of: a member's last
byte, the top byte of its length field, is the sink's separator (zero; a member of 16 MB or
more is followed by an empty one, whose last byte is zero as well).

*Reader.* Archives may hold gzip members, plain records, or both. A member must inflate
with a right checksum to one or more records; of one that does not, or that holds damaged records, the
records that pass are kept (after a failed checksum only those with a digest). A record must have a version line, a
readable header, its full length, its closing line breaks, and a block that fits its
digest. After a failed check the reader looks for the next place where a member or version
line begins and all checks hold, goes on there, and logs the bytes between as a gap with
the reason; the same search goes on inside members. No byte is lost without a trace: records and gaps together cover every file.

Edge cases: a null payload is written as an empty one, a null or empty target as an empty
one; rows with a null id are always responses and come back with a null id; of repeated
rows with the smallest id all are responses; further columns are ignored; an empty table
gives archives without records. Line breaks in a target are written as spaces.
"""

from __future__ import annotations

import hashlib
import sys
import zlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm import kernels
from turnmill.scratch import scratch_path, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VERSION = b"WARC/1.1\r\n"
MEMBER = b"\x1f\x8b\x08"
REVISIT_FROM = 100
_END = b"\r\n\r\n"
_FEED = 16 << 10


def record(page_id, target, payload: bytes | None, digest: str, refers_to=None, date="2024-01-01T00:00:00Z") -> bytes:
    """One record; a revisit has ``refers_to`` and no payload."""
    size = len(payload) if payload is not None else 0
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
    block += b"" if refers_to is not None else b"Content-Length: %d\r\n" % size
    block += b"\r\n" + (payload if refers_to is None and payload else b"")
    target = " ".join((target or "").split())
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", date), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    fields.append(("Content-Length", str(len(block))))
    header = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + header + b"\r\n" + block + _END


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member whose last byte is zero."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    if out[-1]:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += packer.compress(b"") + packer.flush()
    return out


def _members(batches):
    for batch in batches:
        for part in kernels.slices(batch, "html", 4 << 20):
            rows = zip(*[part.column(i).to_pylist() for i in range(5)])
            out = [member(record(i, u, (h or "").encode(), d, r))[:-1] for i, u, h, d, r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def with_first(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Rows (page_id, url, html, digest, refers_to)."""
    rows = kernels.small_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha2("html", 256))
    again = (
        rows.where((F.octet_length("html") >= revisit_from) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first < last").select("digest", "first")
    )
    return rows.join(again, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, mode: str = "errorifexists",
                   revisit_from: int = REVISIT_FROM) -> None:
    """Write a record for each row of (page_id, url, html) below ``path``."""
    packed = with_first(pages, revisit_from).mapInArrow(_members, "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.mode(mode).option(
        "lineSep", "\u0000").text(path)


class Damage(ValueError):
    """A check that failed."""


def parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Header, block and end of the record at ``at``."""
    if not data.startswith(b"WARC/1.", at):
        raise Damage("no version line")
    head = data.find(_END, at)
    if head < 0:
        raise Damage("no end of header")
    fields = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("bad header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdigit():
        raise Damage("no length")
    begin, end = head + 4, head + 4 + int(size)
    if data[end: end + 4] != _END:
        raise Damage("cut off" if end + 4 > len(data) else "wrong length")
    block = data[begin:end]
    kind, _, digest = fields.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        raise Damage("wrong digest")
    return fields, block, end + 4


def inflated(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the member at ``at`` inflates to, where that ends, and what is wrong, if anything."""
    # Fed piece by piece: what the member leaves over is copied, and must be small.
    packer, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not packer.eof and fed < len(data):
            parts.append(packer.decompress(data[fed: fed + _FEED]))
            fed = min(fed + _FEED, len(data))
    except zlib.error:
        # The piece that failed once more, byte by byte, for what it gives before.
        packer, parts = zlib.decompressobj(31), []
        for begin in range(at, fed, _FEED):
            parts.append(packer.decompress(data[begin: begin + _FEED]))
        try:
            while True:
                parts.append(packer.decompress(data[fed: fed + 1]))
                fed += 1
        except zlib.error:
            return b"".join(parts), fed, "bad member"
    if not packer.eof:
        return b"".join(parts), fed, "cut off"
    return b"".join(parts), fed - len(packer.unused_data), ""


def records_in(plain: bytes, only_digested: bool = False) -> tuple[list, list]:
    """Records of a member's bytes, and the gaps between them as (begin, end, reason)."""
    found, gaps, at, bad, reason = [], [], 0, None, ""
    while at < len(plain):
        try:
            fields, block, end = parse(plain, at)
            if only_digested and not fields.get("warc-block-digest", "").startswith("sha256:"):
                raise Damage("no digest in a bad member")
        except Damage as error:
            if bad is None:
                bad, reason = at, str(error)
            at = plain.find(b"WARC/1.", at + 1)
            at = len(plain) if at < 0 else at
            continue
        if bad is not None:
            gaps.append((bad, at, reason))
            bad = None
        found.append((fields, block))
        at = end
    if bad is not None:
        gaps.append((bad, len(plain), reason))
    return found, gaps


def salvaged(data: bytes):
    """("record", offset, end, header, block) and ("gap", offset, end, reason) in order.

    What is lost inside a member that has other records is a gap of the member's offset and
    end, whose reason names the place in the inflated bytes.
    """
    at, bad, reason = 0, None, ""
    while at < len(data):
        found, gaps, wrong = [], [], ""
        if data.startswith(MEMBER, at):
            plain, end, wrong = inflated(data, at)
            found, gaps = records_in(plain, wrong == "bad member")
            if not found:
                wrong = wrong or (gaps[0][2] if gaps else "")
        else:
            try:
                fields, block, end = parse(data, at)
                found = [(fields, block)]
            except Damage as error:
                wrong = str(error)
        if wrong:
            # Version lines in what was inflated belong to records already seen.
            version = data.find(b"WARC/1.", max(at + 1, end) if found else at + 1)
            after = min([p for p in (data.find(MEMBER, at + 1), version) if p > 0], default=len(data))
            if not found:
                if bad is None:
                    bad, reason = at, wrong
                at = after
                continue
            end = max(at + 1, min(end, after) - 1)
            if gaps and gaps[-1][1] == len(plain):
                gaps.pop()  # the gap that follows the member's records
        if bad is not None:
            yield "gap", bad, at, reason
            bad = None
        for fields, block in found:
            yield "record", at, end, fields, block
        for begin, stop, why in gaps:
            yield "gap", at, end, f"{why}, bytes {begin} to {stop} of the member"
        at = end
        if wrong:
            bad, reason, at = end, wrong, after
    if bad is not None:
        yield "gap", bad, len(data), reason


_SCHEMA = ("kind string, file string, offset long, length long, reason string, page_id long,"
           " record_type string, target string, payload_digest string, payload_bytes long,"
           " payload_sha256 string, refers_to long, payload binary")
_NAMES = [c.split()[0] for c in _SCHEMA.split(",")]
_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _SCHEMA.split(",")])


def _number(value: str | None):
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _salvage(with_payload: bool):
    def rows(file, data):
        for kind, at, end, *rest in salvaged(data):
            if kind == "gap":
                yield (kind, file, at, end - at, rest[0], *[None] * 8)
                continue
            fields, block = rest
            payload = block.partition(_END)[2]
            revisit = fields.get("warc-type") == "revisit"
            yield (
                kind, file, at, end - at, None, _number(fields.get("warc-record-id")),
                fields.get("warc-type"), fields.get("warc-target-uri"),
                fields.get("warc-payload-digest", "").removeprefix("sha256:"),
                None if revisit else len(payload),
                None if revisit else hashlib.sha256(payload).hexdigest(),
                _number(fields.get("warc-refers-to")), payload if with_payload and not revisit else None)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                file, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                held, size = [], 0
                for row in rows(file, data):
                    held.append(row)
                    size += len(row[-1] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pydict(dict(zip(_NAMES, map(list, zip(*held)))), schema=_ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pydict(dict(zip(_NAMES, map(list, zip(*held)))), schema=_ARROW)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives below ``path``; ``kind`` tells them apart.

    A file is read by one task; the writer's files are as large as its partitions.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvage(with_payload), _SCHEMA)


def archived(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back: per record page_id, payload_bytes,
    payload_digest, record_type and refers_to.

    A revisit carries no payload, only the digest of the payload it repeats
    (``WARC-Payload-Digest``); it takes its size from the response it names with that
    digest, so that a ``page_id`` standing on several different pages gives each revisit the
    one it repeats.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    # Parsed once: without payloads the records are a small table.
    digest = F.coalesce("payload_sha256", "payload_digest").alias("payload_digest")
    records = stage(read_archives(spark, path, with_payload=False).where("kind = 'record'").select(
        "page_id", "payload_bytes", digest, "record_type", "refers_to"), "records")
    plain = records.where("record_type <> 'revisit'")
    named = plain.where("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.min("payload_bytes").alias("payload_bytes"))
    again = records.where("record_type = 'revisit'").drop("payload_bytes").join(named, ["refers_to", "payload_digest"])
    return plain.unionByName(again)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(kernels.documents(spark, sf_dir, "pages"))


OP4_SQL = f"""
select page_id, n as payload_bytes, d as payload_digest,
       case when n >= {REVISIT_FROM} and page_id > first then 'revisit' else 'response' end as record_type,
       case when n >= {REVISIT_FROM} and page_id > first then first end as refers_to
from (select *, min(page_id) over (partition by d) as first
      from (select page_id, octet_length(encode(coalesce(html, '')))::bigint as n,
                   sha256(coalesce(html, '')) as d from pages))"""
