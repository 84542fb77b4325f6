"""WARC archives: a writer through Spark's text sink and a salvage reader.

The writer makes one gzip member per record.  Spark ends each row with a
separator; a member ends with a zero byte (the top byte of its length), so
the row leaves that byte out and the separator puts it back.

The reader trusts nothing: a member must inflate with a right checksum, a
record hold a version line, a header block of the stated length and the
closing blank lines, and a payload agree with its digest where one is given
(hexadecimal or base 32).  After a failed check it looks for the next place
that passes, reads on from there and reports the bytes between as a gap.  A
member may hold several records; what is lost between them is a gap as well.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.session import materialize, scratch, small

REVISIT_BYTES = 1000           # shorter payloads are always written whole
INFLATE_BYTES = 1 << 16         # fed to the decompressor at a time: what is left after a member is at most one such slice
ARCHIVE_BYTES = 32 << 20       # payload bytes per archive; the reader holds one archive at a time
BROADCAST_REVISITS = 1_000_000  # rows broadcast at most; beyond it the join shuffles

# Fixed values of the format.
VERSION, MAGIC, END = b"WARC/1.1\r\n", b"\x1f\x8b\x08", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("kind string, path string, start long, stop long, reason string, record_type string, record_id string, "
          "refers_to_id string, url string, payload_bytes long, payload_digest string, payload binary")


# --- one record ---------------------------------------------------------------------

def _clean(value: str) -> str:
    """Header values hold no line breaks."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def encode(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response, or with ``refers_to`` a revisit that leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", "2024-01-01T00:00:00Z")]
    head += [("WARC-Target-URI", _clean(url))] if url is not None else []
    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")] if refers_to else []
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + END


def member(record: bytes) -> bytes:
    """A gzip member ending in a zero byte: from 16 MB on, an empty one follows."""
    def pack(data):
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()
    packed = pack(record)
    return packed if packed[-1] == 0 else packed + pack(b"")


def digest_bytes(value: str) -> tuple[str, bytes | None]:
    """(algorithm, digest) of a header value as ``sha1:...``, in hexadecimal
    or base 32; None where the value is of neither form or the algorithm not known."""
    name, _, text = value.partition(":")
    name, text = name.strip().lower().replace("-", ""), text.strip().rstrip("=")
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return name, None
    size = hashlib.new(name).digest_size
    try:
        if len(text) == 2 * size:
            return name, bytes.fromhex(text)
        raw = base64.b32decode(text.upper() + "=" * (-len(text) % 8))
    except (ValueError, binascii.Error):
        return name, None
    return name, raw if len(raw) == size else None


def decode(data: bytes, at: int) -> tuple[dict, int]:
    """(fields, end) of the record at ``at``; ValueError names the failed check."""
    version = re.compile(rb"WARC/1\.[01]\r\n").match(data, at)
    if not version:
        raise ValueError("no version line")
    stop = data.find(END, version.end() - 2)
    if stop < 0:
        raise ValueError("headers do not end")
    head = {}
    for line in data[version.end():stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon:
            raise ValueError("broken header")
        head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    size = head.get(b"content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", size):
        raise ValueError("no content length")
    begin, end = stop + 4, stop + 4 + int(size)
    if data[end:end + 4] != END:
        raise ValueError("record does not end where its length says")
    block, kind = data[begin:end], head.get(b"warc-type", "")
    if not re.fullmatch(r"[a-z]+", kind) or not head.get(b"warc-record-id"):
        raise ValueError("no record type or id")
    out = {"record_type": kind, "record_id": head.get(b"warc-record-id", "").strip("<>"), "url": head.get(b"warc-target-uri"),
           "refers_to_id": head[b"warc-refers-to"].strip("<>") if b"warc-refers-to" in head else None,
           "payload_digest": None, "payload": None, "payload_bytes": None}
    name, stated = digest_bytes(head.get(b"warc-payload-digest", ""))
    if name == "sha1" and stated:
        out["payload_digest"] = stated.hex()
    if kind in ("response", "revisit"):
        http, blank, body = block.partition(END)
        length = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})", http)
        if not blank:
            raise ValueError("no payload header")
        out["payload_bytes"] = int(length[1]) if length else len(body)
        if kind == "response":
            if len(body) != out["payload_bytes"] or (stated and hashlib.new(name, body).digest() != stated):
                raise ValueError("payload digest differs")
            out["payload"], out["payload_digest"] = body, hashlib.sha1(body).hexdigest()
    return out, end + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """(content, end) of the gzip member at ``at``, checksum and length checked."""
    z, out, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while not z.eof and at < len(data):
            out.append(z.decompress(view[at:at + INFLATE_BYTES]))
            at = min(at + INFLATE_BYTES, len(data))
    except zlib.error as e:
        raise ValueError(f"member: {e}") from None
    if not z.eof:
        raise ValueError("member is cut short")
    return b"".join(out), at - len(z.unused_data)


def _unpacked(data: bytes, at: int) -> tuple[list[tuple], int]:
    """(events, end) of the gzip member at ``at``, each with the bytes of the
    whole member; ValueError if it has content but no record."""
    content, end = inflate(data, at)
    events = [(kind, at, end, what if kind == "record" else f"{what}, in bytes {a} to {b} of the content")
              for kind, a, b, what in salvage(content, packed=False)]
    if content and not any(e[0] == "record" for e in events):
        raise ValueError(events[0][3])
    return events, end


def _read_at(data: bytes, at: int, packed: bool) -> tuple[list[tuple], int]:
    """(events, end) of what starts at ``at``; ValueError names the failed check."""
    if packed and data.startswith(MAGIC, at):
        return _unpacked(data, at)
    fields, end = decode(data, at)
    return [("record", at, end, fields)], end


def salvage(data: bytes, packed: bool = True) -> Iterator[tuple[str, int, int, dict | str]]:
    """("record", start, stop, fields) and ("gap", start, stop, reason) over all
    of ``data``.  Records of one gzip member share its start and stop; without
    ``packed`` only plain records are looked for."""
    candidate = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n" if packed else rb"WARC/1\.[01]\r\n")
    at, lost, reason = 0, None, ""
    while at < len(data):
        try:
            events, end = _read_at(data, at, packed)
        except ValueError as e:
            if lost is None:
                lost, reason = at, str(e)
            found = candidate.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if lost is not None:
            yield "gap", lost, at, reason
            lost = None
        yield from events
        at = end
    if lost is not None:
        yield "gap", lost, len(data), reason


# --- archives -------------------------------------------------------------------------

def _pack(batches):
    for pdf in batches:
        rows = []
        for i, u, p, d, r in pdf[["record_id", "url", "payload", "digest", "refers_to"]].itertuples(index=False):
            rows.append(member(encode(i, u if isinstance(u, str) else None, bytes(p), d, r if isinstance(r, str) else None))[:-1])
        yield pd.DataFrame({"value": rows})


def write(records: DataFrame, path: str) -> None:
    """Archives of record_id, url, payload (binary), digest (SHA-1 hex) and
    refers_to (a record_id for revisits, else null), one member per record."""
    (records.mapInPandas(_pack, "value binary").select(F.col("value").cast("string")).write
     .option("lineSep", "\0").text(path))


def _salvage_files(batches):
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            rows = []
            for kind, start, stop, what in salvage(bytes(content)):
                row = {"kind": kind, "path": path, "start": start, "stop": stop, "reason": what if kind == "gap" else None}
                rows.append(row | (what if kind == "record" else {}))
                if len(rows) == 256:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORD.split(", ")]
    return pd.DataFrame(rows, columns=names, dtype=object)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps (``kind``) of all archives under ``path``, gzip members
    or plain.  An empty file gives no row; one with nothing valid, one gap.
    A task holds one archive at a time."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content").mapInPandas(_salvage_files, RECORD)


def quarantine(entries: DataFrame, path: str) -> None:
    """Write the log of unreadable byte ranges: path, start, stop, reason."""
    entries.where(F.col("kind") == "gap").select("path", "start", "stop", "reason").write.mode("overwrite").json(path)


def page_records(pages: DataFrame) -> DataFrame:
    """Records to write for page_id, url, html rows (null html: empty).

    Of equal payloads from REVISIT_BYTES on, the row with the largest page_id
    is the response (rows sharing that id all are), the others revisit it.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    long = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    shared = (long.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
              .where(F.col("n") > 1).select(F.col("digest").alias("_digest"), "kept"))
    kept = small(materialize(shared, "revisits"), BROADCAST_REVISITS)
    fits = (F.col("digest") == F.col("_digest")) & (F.octet_length("payload") >= REVISIT_BYTES)
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")), name(F.col("kept")))
    return rows.join(kept, fits, "left").select(name(F.col("page_id")).alias("record_id"), "url", "payload", "digest",
                                                F.when(F.col("kept").isNotNull(), refers).alias("refers_to"))


def archive(pages: DataFrame, path: str) -> None:
    """Write ``pages`` as archives of about ARCHIVE_BYTES of payload each."""
    rows = page_records(pages)
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    least, now = -(-size // ARCHIVE_BYTES), pages.rdd.getNumPartitions()
    write(rows.repartition(least) if least > 2 * now else rows, path)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and url,
    all read back from archives written for ``pages``; gaps are logged beside
    them.  Repeated rows give repeated records."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    archive(pages, f"{path}/archives")
    entries = materialize(read(spark, f"{path}/archives").drop("payload"), "entries")   # read once for records and gaps
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    quarantine(entries, f"{path}/gaps")
    return entries.where(F.col("kind") == "record").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to_id").alias("refers_to"), "url")
