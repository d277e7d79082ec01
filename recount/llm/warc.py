"""WARC records in ZIP packages, written and read back by ranges (operator 1).

Package: a ZIP file of stored (uncompressed) members, as web-archive collections are exchanged:
any number of archives below ``archive/`` (``.warc.gz``, a gzip member per record, or ``.warc``) and of
indexes below ``indexes/`` (``.cdxj`` or ``.cdx`` lines of JSON, plain or as gzip), a line per record with its offset,
length and, where there are several archives, its file's name. ``ZipDirectory`` reads the end record,
the ZIP64 records where the plain ones overflow, the central directory and the local headers; nothing
is extracted: a record is read by its range, offset of the member plus offset in the index. An archive
that no index line names is read through once, in pieces, for the ranges of its records. The packages
written here have one archive, ``archive/data.warc.gz``, and one index.

Writing: of records with equal payloads of at least ``min_bytes``, the one of the largest id is a
response, the others are revisits that refer to it and carry no payload. Which one it is comes from
a grouped maximum, combined before the shuffle; pages meet it in a join whose skewed partitions
may be split. A task writes its pages to packages of at most ``PACKAGE_BYTES``; a task that is run
again writes other files, and only the manifest, committed by Spark, names those that count.

Packages of others: a record whose id isn't a page's has a null ``page_id``, one without a payload
digest gets that of its payload; a revisit without a payload length has a null one. An index line that names no archive
of the package, an archive that is compressed by the ZIP file, or cut off, is an error.

Defined cases: a null payload is empty. A null id is smaller than any other; if all ids of a payload
are null, or several rows have the largest, all of these are responses. A null or odd URL is left
out or percent-encoded. Repeated rows are records each. Empty tables give empty results. Columns
other than id, URL and payload aren't read.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, shared_dir

PACKAGE_BYTES = 1 << 28
CHUNK_BYTES = 1 << 22  # bytes of a package read at a time
SCAN_BYTES = 1 << 16  # bytes of an index, or of an archive without one, read at a time
ARCHIVES, INDEXES = "archive/", "indexes/"
MEMBER, INDEX = ARCHIVES + "data.warc.gz", INDEXES + "index.cdxj"
URN = "urn:recount:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


# --- records ----------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None, is_revisit: bool) -> bytes:
    """A WARC record, not yet compressed."""
    from urllib.parse import quote

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%!#$&'()*+,/:;=?@[]~"))
    if is_revisit:
        head += [f"WARC-Refers-To: <{URN}{'' if revisit_of is None else revisit_of}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers (lower-case names) of a record and, under ``payload``, what follows the HTTP header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    block = rest[: int(out["content-length"])]
    out["payload"] = block.partition(b"\r\n\r\n")[2] if out.get("content-type", "").startswith("application/http") else block
    return out


def _id_of(urn: str | None) -> int | None:
    """The page of a record id; none of a page without an id, and of ids that are not of this form."""
    text = (urn or "").strip("<>")
    number = text.removeprefix(URN)
    return int(number) if text != number and number.removeprefix("-").isdecimal() else None


# --- packages ---------------------------------------------------------------------------------


class Package:
    """A package, written as a stream."""

    def __init__(self, stream):
        import zipfile

        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(MEMBER), "w", force_zip64=True)
        self.size, self.records, self.lines = 0, 0, []

    def add(self, page_id, raw: bytes) -> None:
        import gzip
        import json

        packed = gzip.compress(raw, 3, mtime=0)
        self.member.write(packed)
        self.lines.append(f"{'' if page_id is None else page_id} 19700101000000 " + json.dumps({"offset": self.size, "length": len(packed), "filename": MEMBER.rpartition("/")[2]}) + "\n")
        self.size += len(packed)
        self.records += 1

    def close(self) -> None:
        import zipfile

        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()


class ZipDirectory:
    """Members of a ZIP file, from its directories alone: name -> (method, data offset, size)."""

    def __init__(self, f, size: int):
        self.f = f
        # Fixed layouts of the format: end record 22 bytes + comment of at most 65,535, ZIP64
        # locator 20, ZIP64 end record 56, central header 46, local header 30.
        tail_at = max(0, size - 22 - 65535 - 20)
        tail = self.read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory: not a ZIP file, or cut off")
        _, _, _, count, length, offset, _ = struct.unpack("<HHHHIIH", tail[end + 4 : end + 22])
        if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
            (at,) = struct.unpack("<Q", tail[end - 12 : end - 4])
            wide = self.read(at, 56)
            if wide[:4] != b"PK\x06\x06":
                raise ValueError("ZIP64 end record not where its locator says")
            count, length, offset = struct.unpack("<QQQ", wide[32:56])
        self.members: dict[str, tuple[int, int, int]] = {}
        central, at = self.read(offset, length), 0
        for _ in range(count):
            if central[at : at + 4] != b"PK\x01\x02":
                raise ValueError("central directory broken")
            flags, method = struct.unpack("<HH", central[at + 8 : at + 12])
            packed, plain, n, m, k = struct.unpack("<IIHHH", central[at + 20 : at + 34])
            (local,) = struct.unpack("<I", central[at + 42 : at + 46])
            name = central[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            extra = central[at + 46 + n : at + 46 + n + m]
            while len(extra) >= 4:
                kind, size_ = struct.unpack("<HH", extra[:4])
                if kind == 1:  # ZIP64: those of the three that overflowed, in this order
                    wide = [x[0] for x in struct.iter_unpack("<Q", extra[4 : 4 + size_ // 8 * 8])]
                    if plain == 0xFFFFFFFF:
                        plain = wide.pop(0)
                    if packed == 0xFFFFFFFF:
                        packed = wide.pop(0)
                    if local == 0xFFFFFFFF:
                        local = wide.pop(0)
                extra = extra[4 + size_ :]
            self.members[name] = (method, local, packed)
            at += 46 + n + m + k

    def read(self, offset: int, size: int) -> bytes:
        self.f.seek(offset)
        return self.f.read(size)

    def stored(self, name: str) -> tuple[int, int]:
        """(offset of the data, size) of a stored member."""
        method, local, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed, not stored: its records have no ranges")
        head = self.read(local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: no local header")
        n, m = struct.unpack("<HH", head[26:30])
        return local + 30 + n + m, size


def _index_lines(directory: ZipDirectory, name: str):
    """The lines of a stored index, read in pieces."""
    import codecs
    import zlib

    at, size = directory.stored(name)
    unzip = zlib.decompressobj(31) if name.endswith(".gz") else None
    text, rest = codecs.getincrementaldecoder("utf-8")(), ""
    for begin in range(at, at + size, SCAN_BYTES):
        piece = directory.read(begin, min(SCAN_BYTES, at + size - begin))
        if unzip:  # any number of gzip members, one after the other
            plain = []
            while piece:
                plain.append(unzip.decompress(piece))
                piece = unzip.unused_data
                if unzip.eof:
                    unzip = zlib.decompressobj(31)
            piece = b"".join(plain)
        lines = (rest + text.decode(piece)).split("\n")
        rest = lines.pop()
        yield from lines
    yield rest


def _scan(directory: ZipDirectory, name: str):
    """(offset, length) of the records of an archive that no index names, by reading it through."""
    import zlib

    at, size = directory.stored(name)
    end = at + size
    if not name.endswith(".gz"):
        while at < end:
            head, more = b"", True
            while more and b"\r\n\r\n" not in head:
                more = directory.read(at + len(head), min(SCAN_BYTES, end - at - len(head)))
                head += more
            head = head.partition(b"\r\n\r\n")[0]
            length = [int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            if not head.startswith(b"WARC/") or not length:
                raise ValueError(f"{name}: no record at {at}")
            n = len(head) + 4 + length[0] + 4
            if at + n > end:
                raise ValueError(f"{name} is cut off")
            yield at, n
            at += n
        return
    begin, unzip = at, zlib.decompressobj(31)
    while at < end:
        piece = directory.read(at, min(SCAN_BYTES, end - at))
        at += len(piece)
        while piece:
            unzip.decompress(piece)
            piece = b""
            if unzip.eof:
                piece = unzip.unused_data
                yield begin, at - len(piece) - begin
                begin, unzip = at - len(piece), zlib.decompressobj(31)
    if begin < end:
        raise ValueError(f"{name} is cut off")


def locate(f, size: int) -> list[tuple[int, int]]:
    """(offset, length) of every record of a package, in order of their place, by its indexes."""
    import json

    directory = ZipDirectory(f, size)
    archives = {m[len(ARCHIVES) :]: m for m in directory.members if m.startswith(ARCHIVES) and m.endswith((".warc", ".warc.gz"))}
    starts = {name: directory.stored(m)[0] for name, m in archives.items()}
    found, named = set(), set()  # indexes may overlap: a record's range counts once
    for index in directory.members:
        if not index.startswith(INDEXES) or not index.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")):
            continue
        for line in _index_lines(directory, index):
            at = line.find("{")
            if at < 0 or line.startswith("!"):  # an empty line, or an index's own header
                continue
            entry = json.loads(line[at:])
            name = entry.get("filename") or (next(iter(archives)) if len(archives) == 1 else None)
            if name is not None and name not in starts:
                name = name.removeprefix(ARCHIVES)
            if name not in starts:
                raise ValueError(f"{index}: a line names {name!r}, which is no archive of the package")
            named.add(name)
            found.add((starts[name] + int(entry["offset"]), int(entry["length"])))
    for name in starts.keys() - named:
        found.update(_scan(directory, archives[name]))
    return sorted(found)


# --- the operator -----------------------------------------------------------------------------


def write_packages(pages: DataFrame, id_col: str = "page_id", url: str | None = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes the packages; the manifest (uri, records)."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    fs, place = filesystem(folder)
    fs.create_dir(place, recursive=True)
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        (F.col(f"`{url}`") if url else F.lit(None)).cast("string").alias("url"),
        body.alias("payload"),
        F.sha1(body).alias("digest"),
    )
    groups = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("first"))
        .filter("n > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("of"), "first")
    )
    told = rows.join(groups, F.col("digest") == F.col("of"), "left").select(
        "id", "url", "payload", "first", (F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("first")))).alias("revisit")
    )

    def work(batches):
        import uuid

        import pyarrow as pa

        package, f, uri, done = None, None, None, []

        def close():
            package.close()
            f.close()
            done.append((uri, package.records))

        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("id", "url", "payload", "first", "revisit"))
            for id_, url_, payload_, first, revisit in zip(*cols):
                if package is None:
                    uri = f"{folder}/{uuid.uuid4().hex}.wacz"
                    fs, place = filesystem(uri)
                    f = fs.open_output_stream(place)
                    package = Package(f)
                package.add(id_, record(id_, url_, payload_, first, revisit))
                if package.size >= PACKAGE_BYTES:
                    close()
                    package = None
        if package is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["uri", "records"])

    told.mapInArrow(work, "uri string, records long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_packages(manifest: DataFrame) -> DataFrame:
    """Every record of the packages of a manifest (uri). Directories and indexes are read first;
    the records' ranges, in chunks, are then dealt anew and read."""
    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def find(batches):
        import pyarrow as pa

        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                fs, place = filesystem(uri)
                with fs.open_input_file(place) as f:
                    found = locate(f, f.size())
                # A chunk's records lie next to each other.
                chunk, size = [], 0
                for at, n in [*found, (-1, 0)]:
                    if chunk and (size + n > CHUNK_BYTES or at != chunk[0][0] + size):
                        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([chunk[0][0]], pa.int64()), pa.array([[x[1] for x in chunk]], pa.list_(pa.int32()))], ["uri", "at", "lengths"])
                        chunk, size = [], 0
                    chunk.append((at, n))
                    size += n

    def read(batches):
        import gzip

        import pyarrow as pa

        for batch in batches:
            for uri, at, lengths in zip(*(batch.column(c).to_pylist() for c in ("uri", "at", "lengths"))):
                fs, place = filesystem(uri)
                with fs.open_input_file(place) as f:
                    f.seek(at)
                    raw = f.read(sum(lengths))
                rows, begin = [], 0
                for n in lengths:
                    one = raw[begin : begin + n]
                    begin += n
                    r = parse(gzip.decompress(one) if one[:2] == b"\x1f\x8b" else one)
                    revisit = r.get("warc-type") == "revisit"
                    told = r.get("warc-payload-digest")
                    if not revisit and (told is None or told.startswith("sha1:")):
                        own = "sha1:" + digest(r["payload"])
                        if told not in (None, own):
                            raise ValueError(f"{uri}: payload of {r.get('warc-record-id')} doesn't have its digest")
                        told = own
                    size = len(r["payload"])
                    if revisit:
                        size = int(r["warc-payload-length"]) if "warc-payload-length" in r else None
                    refers = _id_of(r.get("warc-refers-to")) if revisit else None
                    rows.append((_id_of(r.get("warc-record-id")), size, told and told.removeprefix("sha1:"), r.get("warc-type"), refers, r.get("warc-target-uri")))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    chunks = manifest.select("uri").repartition(parts, "uri").mapInArrow(find, "uri string, at long, lengths array<int>")
    return chunks.repartition(parts, "uri", "at").mapInArrow(read, RECORDS)


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, upper(sha1(body)) AS hex FROM p),
b AS (
  SELECT page_id, n, hex,
         -- five hexadecimal digits are four base-32 digits
         array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
         max(page_id) OVER (PARTITION BY hex) AS first
  FROM d
)
SELECT page_id, n::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM b
"""


def op1_warc(spark, sf_dir):
    from .common import table

    read = read_packages(write_packages(table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
