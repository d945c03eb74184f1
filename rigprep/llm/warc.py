"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Writer tasks put each record into a gzip member of its own and close an archive when it has
``archive_bytes``. What a task wrote counts only once its manifest row is committed by Spark, so a
lost or repeated task leaves no records behind. The reader checks every member (gzip CRC, header,
length, block digest); after a failed check it looks for the next member or version line that
passes, also inside a member, goes on from there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize, new_path

ARCHIVE_BYTES = 16 << 20
#: Bytes that are fed to the decompressor at a time.
WINDOW = 1 << 16
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION, GZIP_MAGIC, PROFILE = b"WARC/1.1", b"\x1f\x8b\x08", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _said(page_id) -> str | None:
    """An id as a header value that no reader strips or folds; ``unquote`` gives it back."""
    return None if page_id is None else quote(str(page_id), safe="!$&'()*+,-./:;=?@_~")


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def build_record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, refers_url: str | None = None, revisit: bool = False) -> bytes:
    """One record, uncompressed. A revisit has the HTTP header of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _clean(url)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("X-Page-Id", _said(page_id)),
    ]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Target-URI", None if refers_url is None else _clean(refers_url)), ("X-Refers-To-Page", _said(refers_to))]
    head.append(("Content-Length", len(block)))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


# --- reading ------------------------------------------------------------------------------


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int] | None:
    """(headers, block, end) of the record at ``at``, or null if a check fails."""
    if not data.startswith(b"WARC/1.", at):
        return None
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        return None
    first, last = end + 4, end + 4 + int(headers["content-length"])
    if data[last : last + 4] != b"\r\n\r\n":
        return None
    block = data[first:last]
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted[5:] != sha1_base32(block):
        return None
    return headers, block, last + 4


def inflate(data: bytes, at: int, most: int | None = None) -> tuple[bytes, int | None, bool]:
    """(plain bytes, where the gzip member at ``at`` ends or null, whether bytes of it are wrong rather than missing).

    The member is fed window by window, so that no rest of the archive is copied; of a damaged
    one all bytes before the damage come out. A member of over ``most`` plain bytes, where that is given, counts as damaged.
    """
    z, parts, size = zlib.decompressobj(31), [], 0
    while not z.eof and at < len(data):
        window, before = data[at : at + WINDOW], z.copy()
        try:
            parts.append(z.decompress(window))
        except zlib.error:
            for k in range(0, len(window), 64):
                try:
                    parts.append(before.decompress(window[k : k + 64]))
                except zlib.error:
                    break
            return b"".join(parts), None, True
        at += len(window)
        size += len(parts[-1])
        if most is not None and size > most:
            return b"".join(parts), None, True
    return b"".join(parts), at - len(z.unused_data) if z.eof else None, False


_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_VERSION = re.compile(rb"WARC/1\.")


def _records_in(plain: bytes, only_verified: bool) -> tuple[list[tuple[dict, bytes]], bool]:
    """Records of a member's bytes, and whether they are all of it; after a failed check the next version line is tried."""
    records, p, whole = [], 0, True
    while p < len(plain):
        got = parse_record(plain, p)
        if got is not None and (not only_verified or got[0].get("warc-block-digest", "").startswith("sha1:")):
            records.append(got[:2])
            p = got[2]
            continue
        whole = False
        found = _VERSION.search(plain, p + 1)
        p = found.start() if found else len(plain)
    return records, whole


def salvage(data: bytes, member_bytes: int | None = None) -> Iterator[tuple[str, int, int, dict, bytes]]:
    """("record" or "gap", first byte, bytes, headers, block) in file order, whatever the damage.

    A member of which a part fails is logged as a gap of its bytes (its end, where that is unknown, is
    the next start that passes), and its good records are given before that. Of members with wrong bytes only
    records that their digest verifies are good. ``member_bytes`` guards against members that grow without end: longer ones
    are a gap. There is no such bound by default.
    """
    at, bad = 0, None
    while at < len(data):
        records, end, whole = [], None, False
        if data.startswith(GZIP_MAGIC, at):
            plain, end, wrong = inflate(data, at, member_bytes)
            records, whole = _records_in(plain, wrong)
            whole = whole and end is not None
        elif (got := parse_record(data, at)) is not None:
            records, end, whole = [got[:2]], got[2], True
        if not whole and not records:  # nothing here, whatever it is
            end = None
        if records and bad is not None:
            yield "gap", bad, at - bad, {}, b""
            bad = None
        for headers, block in records:
            yield "record", at, (end or len(data)) - at, headers, block
        if not whole:
            bad = at if bad is None else bad
        if end is None:
            found = _START.search(data, at + 1)
            end = found.start() if found else len(data)
        at = end
    if bad is not None:
        yield "gap", bad, len(data) - bad, {}, b""


RECORD_SCHEMA = """path string, kind string, first_byte long, n_bytes long, page_id string, warc_type string, url string, refers_to string,
    payload_bytes long, payload_digest string, payload binary"""


def read_archives(manifest: DataFrame, with_payload: bool = True, member_bytes: int | None = None) -> DataFrame:
    """Records and quarantined gaps of the archives in ``manifest`` (column path), a task a few archives.

    payload_bytes is what the HTTP header says for revisits and what was read for responses. An archive
    that cannot be opened or read is an error of its task, which Spark tries again, and never a row. No archives give no rows. A member is
    read whole, whatever its size, unless ``member_bytes`` bounds it.
    """

    def run(batches):
        import pyarrow.fs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, inner = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_stream(inner, compression=None) as f:
                    data = f.read()
                rows, size = [], 0
                for kind, first, n, h, block in salvage(data, member_bytes):
                    if kind == "gap":
                        rows.append((path, kind, first, n, None, None, None, None, None, None, None))
                    else:
                        http, _, payload = block.partition(b"\r\n\r\n")
                        revisit = h["warc-type"] == "revisit"
                        said = re.search(rb"(?i)content-length: *(\d+)", http)
                        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else sha1_base32(payload)
                        rows.append((path, kind, first, n, _heard(h.get("x-page-id")), h["warc-type"], h.get("warc-target-uri"), _heard(h.get("x-refers-to-page")), int(said[1]) if revisit and said else len(payload), digest, payload if with_payload and not revisit else None))
                        size += len(payload) if with_payload else 0
                    if size > 8 << 20:
                        yield _records(rows)
                        rows, size = [], 0
                yield _records(rows)

    return manifest.select("path").mapInArrow(run, RECORD_SCHEMA)


def _heard(value: str | None) -> str | None:
    return None if value is None else unquote(value)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in RECORD_SCHEMA.replace("\n", " ").split(",")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, type=kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


# --- writing ------------------------------------------------------------------------------


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record for each row of ``pages``; the manifest: path, records, bytes.

    Of rows with equal payloads (a null one is empty) those with the smallest page id are
    responses and the others revisit it; null ids come last. Archives lie in the shared folder. A
    payload's group is found on its SHA-1 alone, aggregated in each task first; pages then meet
    their group by id and digest, so that a payload of many pages is not one task's work.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    small = materialize(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.sha1(html).alias("sha1")), "digests")
    order = F.struct(F.col("page_id").isNull().alias("last"), F.col("page_id").alias("page_id"), F.col("url").alias("url"))
    first = materialize(small.groupBy("sha1").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha1", "first"), "first")
    again = small.join(first, "sha1").where(~F.col("page_id").eqNullSafe(F.col("first.page_id")))
    again = materialize(again.select(F.col("page_id").alias("again_id"), F.col("sha1").alias("again_sha1"), F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")).dropDuplicates(["again_id", "again_sha1"]), "revisits")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html")).withColumn("sha1", F.sha1("html"))
    rows = rows.join(again, rows.page_id.eqNullSafe(again.again_id) & (rows.sha1 == again.again_sha1), "left")
    rows = rows.select("page_id", "url", "html", "refers_to", "refers_url", F.col("again_sha1").isNotNull().alias("revisit"))
    folder = new_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder

    def run(batches):
        import pyarrow.fs

        fs, top = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(top, recursive=True)
        parts, size, records = [], 0, 0

        def close():
            name = f"{uuid.uuid4().hex}.warc.gz"
            with fs.open_output_stream(f"{top}/{name}", compression=None) as f:
                for p in parts:
                    f.write(p)
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                html = row["html"]
                m = member(build_record(row["page_id"], row["url"], html, sha1_base32(html), row["refers_to"], row["refers_url"], row["revisit"]))
                if parts and size + len(m) > archive_bytes:
                    yield close()
                    parts, size, records = [], 0, 0
                parts.append(m)
                size += len(m)
                records += 1
        if parts:
            yield close()

    return materialize(rows.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives, read them back, and describe every record; a gap in what was just written is an error."""
    manifest = write_archives(pages, id_col, url_col, html_col)
    spread = manifest.repartition(max(1, min(manifest.count(), 4000)), F.xxhash64("path"))
    return described(read_archives(spread, with_payload=False), dict(pages.dtypes)[id_col])


def described(rows: DataFrame, kind: str) -> DataFrame:
    """What was read of archives that must be whole: a record in a row, or an error where bytes could not be read."""
    lost = F.raise_error(F.concat(F.lit("gap in "), "path", F.lit(" at byte "), F.col("first_byte").cast("string")))
    records = rows.withColumn("payload_bytes", F.when(F.col("kind") == "gap", lost.cast("long")).otherwise(F.col("payload_bytes")))
    return records.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))
