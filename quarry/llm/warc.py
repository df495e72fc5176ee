"""WARC archives of pages: writing, normalising and reading back.

``write_archives`` makes one record per page and writes archives as whole-file
gzip streams, as many crawlers leave them.  Such a file can only be read from its
start, so ``normalise`` inflates each stream once, rewrites every record as a gzip
member of its own and writes a sidecar index (place and length of every member), by
which any record can be taken out alone.  Each archive also ends with that index: a
``metadata`` record that lists its members, and an empty member whose extra field
says where that record begins.  So ``read_archives``, which reads whole archives, finds
every member without a join and ships no payloads between tasks.

Of records with equal payloads of at least ``LEAST`` bytes, the one with the
largest page id is the response; the others are revisits, without payload, that
refer to it.  Smaller payloads are always responses.

Lengths and digests that are read back are those of the payload that was read, not of
its header.  A revisit has none: its own are what it claims, and hold (``sound``) if its
response was read back with the same.

Files go through Spark's own writers, so any Hadoop file system will do and a
lost executor's attempt leaves nothing behind.  Binary members are written by the
text sink: a row is one archive without its last byte, and the line separator is
that byte, zero - the top byte of the size of the last member, which is
empty.  Archives hold about ``ARCHIVE_BYTES`` of payload, one a row.  Streams hold
about ``STREAM_BYTES``, and unless a single page is longer at most ``LONG`` times as much:
a file limit in records from the mean size, and one from the largest for the pages
that are ``LONG`` times longer than the mean.

Defined cases: a null or empty html is an empty payload; a null url or page id
leaves its header out; of equal payloads, one with a null page id is never the one
referred to if any other has an id (all null: all are responses); repeated rows
become records of their own, and equal ids with equal payloads refer to their own
id only if the id is the largest: exactly one of them is the response; an empty
table gives no archives and an empty result.  Extra columns are not recorded.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.scratch import remove, written
from quarry.operators.upsert import salts
from quarry.session import run_path
from quarry.sinks.files import _remove

LEAST = 1000
ARCHIVE_BYTES = 32 << 20
STREAM_BYTES = 64 << 20
LONG = 16
LEVEL = 4
#: When the pages were fetched is not known: every record has this date.
DATE = "1970-01-01T00:00:00Z"
INDEX = "archive long, places array<long>, lengths array<int>"


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages(page_id, url, html)`` with payload facts and refers_to."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit(""))
    facts = written(pages.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"),
                                 F.sha1(F.encode(payload, "utf-8")).alias("payload_digest")), "digests")
    # Only digests that occur twice need another look at their pages.
    firsts = (facts.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
              .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null").drop("n"))
    n = salts(pages)
    salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    dealt = facts.where(F.col("payload_bytes") >= least).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(n)).cast("int"))
    again = written(dealt.join(salted, ["payload_digest", "salt"]).select("page_id", "payload_digest", "first_id"), "again")
    again = again.groupBy("page_id", "payload_digest", "first_id").agg(F.count("*").alias("rows"))
    base = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(F.encode(payload, "utf-8")).alias("payload_digest"))
    # Pages whose payload is single need no join at all.
    if again.isEmpty():
        return base.withColumn("refers_to", F.lit(None).cast(pages.schema["page_id"].dataType))
    marks = again.select(F.col("page_id").alias("again_id"), F.col("payload_digest").alias("again_digest"), "first_id", "rows")
    joined = base.join(marks, base["page_id"].eqNullSafe(marks["again_id"]) & (base["payload_digest"] == marks["again_digest"]), "left")
    nth = F.row_number().over(Window.partitionBy("page_id", "payload_digest").orderBy("url"))
    joined = joined.withColumn("nth", F.when(F.col("rows") > 1, nth).otherwise(1))
    referred = F.when(F.col("first_id").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("nth") == 1)), F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", referred.alias("refers_to"))


def _line(name: str, value) -> "F.Column":
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def write_archives(found: DataFrame, path: str) -> None:
    """Records as WARC/1.1 text in whole-file gzip streams below ``path``."""
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, "").otherwise(F.col("payload"))
    uri = F.regexp_replace("url", r"[\r\n]", " ")
    record = F.concat(
        F.lit("WARC/1.1\r\n"), F.when(revisit, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))), F.lit(f"WARC-Date: {DATE}\r\n"),
        _line("WARC-Target-URI", uri),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\nWARC-Payload-Length: "), F.col("payload_bytes").cast("string"),
        _line("\r\nWARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n").otherwise("\r\n"),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n"))
    sizes = found.agg(F.avg("payload_bytes").alias("mean"), F.max("payload_bytes").alias("most")).first()
    mean, most = max(1.0, sizes["mean"] or 0.0), sizes["most"] or 0
    # After each row the line separator follows: a record ends with two.
    parts = [(F.col("payload_bytes") <= LONG * mean, STREAM_BYTES // mean)]
    if most > LONG * mean:
        parts.append((F.col("payload_bytes") > LONG * mean, LONG * STREAM_BYTES // most))
    for which, rows in parts:
        (found.where(which).select(record.alias("value")).write.mode("append").option("compression", "gzip").option("lineSep", "\r\n")
              .option("maxRecordsPerFile", int(max(1, rows))).text(path))


def _inflated(data: bytes):
    """The bytes of a gzip file, members one after the other, in pieces."""
    view, at = memoryview(data), 0
    while at < len(view):
        stream = zlib.decompressobj(31)
        while not stream.eof and at < len(view):
            piece = view[at:at + (1 << 20)]
            out = stream.decompress(piece)
            at += len(piece) - len(stream.unused_data)
            if out:
                yield out


def stream_records(pieces):
    """(header bytes, payload bytes) of the records of an inflated stream."""
    hold = bytearray()
    pieces = iter(pieces)

    def fill(n: int) -> bool:
        while len(hold) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            hold.extend(piece)
        return True

    while True:
        cut, seen = -1, 0
        while (cut := hold.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(hold)
            if not fill(len(hold) + 1):
                if hold.strip():
                    raise ValueError("a WARC record ends within its header")
                return
        head = bytes(hold[:cut])
        size = int(headers(head)["content-length"])
        if not fill(cut + 4 + size + 4):
            raise ValueError("a WARC record ends within its payload")
        yield head, bytes(hold[cut + 4:cut + 4 + size])
        del hold[:cut + 4 + size + 4]


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a WARC record begins with its version")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _end(at: int) -> bytes:
    """An empty member with a place in its extra field; its last byte is zero."""
    return struct.pack("<4BI2BH2sHQ", 31, 139, 8, 4, 0, 0, 255, 12, b"at", 8, at) + b"\3\0" + bytes(8)


_END = len(_end(0))


def _listing(places: list[int], lengths: list[int]) -> bytes:
    lines = "".join(f"{a} {n}\r\n" for a, n in zip(places, lengths)).encode()
    return (f"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Date: {DATE}\r\nContent-Type: text/plain\r\nContent-Length: {len(lines)}\r\n\r\n"
            ).encode() + lines + b"\r\n\r\n"


def members(data) -> list[tuple[int, int]]:
    """(place, length) of the members of an archive, from its end."""
    view = memoryview(data)
    at = struct.unpack_from("<Q", view, len(view) - _END + 16)[0]
    lines = zlib.decompress(view[at:len(view) - _END], 31).partition(b"\r\n\r\n")[2].split(b"\r\n")
    return [tuple(map(int, x.split())) for x in lines if x]


def normalise(spark, source: str, target: str) -> None:
    """Rewrites whole-file gzip streams below ``source`` as archives with a member
    per record below ``target``/data, with the index in ``target``/index."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")

    def run(batches):
        for batch in batches:
            for path, content in zip(*[c.to_pylist() for c in batch.columns]):
                part, body, places, lengths, held = 0, io.BytesIO(), [], [], 0

                def flush():
                    # A name of its own for each archive, the same on every attempt.
                    name = int.from_bytes(hashlib.blake2b(f"{path} {part}".encode(), digest_size=8).digest(), "big") >> 1
                    at = body.tell()
                    body.write(member(_listing(places, lengths)))
                    body.write(_end(at)[:-1])       # the writer adds the zero
                    return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([body.getvalue()], pa.binary()),
                                                       pa.array([places], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32()))],
                                                      names=["archive", "data", "places", "lengths"])

                for head, payload in stream_records(_inflated(content)):
                    one = member(head + b"\r\n\r\n" + payload + b"\r\n\r\n")
                    places.append(body.tell())
                    lengths.append(len(one))
                    body.write(one)
                    held += len(payload)
                    if held >= ARCHIVE_BYTES:
                        yield flush()
                        part, body, places, lengths, held = part + 1, io.BytesIO(), [], [], 0
                if places:
                    yield flush()

    # Written once, on shared storage, for its two readers.
    made = written(files.mapInArrow(run, "archive long, data binary, places array<long>, lengths array<int>"), "archives")
    made.select("archive", F.col("data").cast("string").alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", 1).partitionBy("archive").text(f"{target}/data")
    made.select("archive", "places", "lengths").write.parquet(f"{target}/index")
    remove(made)


_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound", "payload"]
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary()]
#: Records that a task hands on at once, in number and in bytes of payload.
HAND_ON, HAND_ON_BYTES = 500, 4 << 20


def record_of(text: bytes) -> tuple:
    """The values of ``_NAMES`` of one record.  A revisit's are what it claims."""
    head, _, rest = text.partition(b"\r\n\r\n")
    h = headers(head)
    payload, kind = rest[:int(h["content-length"])], h["warc-type"]
    claimed, size = h["warc-payload-digest"].removeprefix("sha1:"), int(h["warc-payload-length"])
    strip = lambda v: v and v.removeprefix("<urn:page:").removesuffix(">")
    digest, length = (claimed, size) if kind == "revisit" else (hashlib.sha1(payload).hexdigest(), len(payload))
    return (strip(h.get("warc-record-id")), h.get("warc-target-uri"), length, digest, kind, strip(h.get("warc-refers-to")),
            (digest, length) == (claimed, size), payload)


def read_archives(spark, target: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, sound,
    payload) of every record.  ``sound``: a response's payload has the digest and length
    that its header gives."""
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                view, out, held = memoryview(content.as_buffer()), [], 0
                for at, size in members(view):
                    out.append(record_of(zlib.decompress(view[at:at + size], 31)))
                    held += len(out[-1][-1])
                    if len(out) >= HAND_ON or held >= HAND_ON_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], names=_NAMES)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], names=_NAMES)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{target}/data").select("content")
    rows = files.mapInArrow(
        run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, sound boolean, payload binary")
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def verified(records: DataFrame) -> DataFrame:
    """``records``, with revisits sound only if their response was read back with the
    digest and length that they claim."""
    said = ["refers_to", "payload_digest", "payload_bytes"]
    claims = records.where("record_type = 'revisit'").select(*said).distinct()      # one per response, however many revisit it
    there = records.where("record_type = 'response' and sound").select(F.col("page_id").alias("refers_to"), *said[1:])
    false = written(claims.join(there, said, "left_anti"), "false-claims")
    if false.isEmpty():
        return records
    marks = false.withColumn("false", F.lit(True))
    return records.join(marks, said, "left").withColumn("sound", F.col("sound") & F.col("false").isNull()).drop("false").select(*records.columns)


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes, normalises and reads back all pages; the records without payloads."""
    spark = pages.sparkSession
    root = run_path(spark, "warc")
    found = records(pages, least)
    write_archives(found, f"{root}/streams")
    normalise(spark, f"{root}/streams", f"{root}/archives")
    _remove(spark, f"{root}/streams")
    back = written(read_archives(spark, f"{root}/archives", pages.schema["page_id"].dataType.simpleString()).drop("payload"), "records")
    return verified(back)
