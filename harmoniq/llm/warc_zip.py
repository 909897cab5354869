"""WARC records in ZIP packages: written as streams, read by ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record), stored
without further compression, and ``indexes/index.cdxj`` with each record's
offset and length.  The reader finds the end-of-central-directory record (and
its ZIP64 form), walks the central directory, locates archive members and
indexes, and reads single records out of the package by byte ranges: nothing is
unpacked, and a package of any size is shared out among many tasks.

Packages are written by tasks under names of their own; the stored table of
names that Spark commits says which ones count, so a task that is run again
leaves only a file that nobody reads.

Results: a null payload is empty; a null key or URI has no header and reads back
as null; control characters of a URI are percent-encoded; repeated rows are
records of their own.  An empty table writes no package and reads back as no
rows.  A payload of any length is one record; packages and batches are bounded
(``max_bytes``, ``RUN_BYTES``) but for a single longer record.  Columns that are
not named take no part.  ``members`` lists every member of a package; archive
members that are compressed again or encrypted cannot be read by ranges and
fail with their name, as do torn packages and records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import islice
from struct import calcsize, unpack, unpack_from
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import bounded, record_batch, store
from harmoniq.session import scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20
RUN_BYTES = 8 << 20
PIECE = 1 << 20
# what a task reads from packages, and the most tasks
TASK_BYTES, MAX_TASKS = 32 << 20, 100_000
# fixed values of the ZIP format: signatures and record layouts
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
END_FORM, END64_FORM, LOCATOR64_FORM = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
ENTRY_FORM, LOCAL_FORM = "<4s6H3L5H2L", "<4s5H3L2H"
FULL16, FULL32, ZIP64_EXTRA = 0xFFFF, 0xFFFFFFFF, 1
STORED, DEFLATED = 0, 8
# fixed values of the WARC format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute local path, as tasks see it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


# ---- writing ------------------------------------------------------------------------
def warc_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def header_text(value) -> str | None:
    """One header line's worth of text: control characters, and spaces at
    either end, are percent-encoded."""
    if value is None:
        return None
    return re.sub(r"[\x00-\x1f\x7f]|^ +| +$", lambda m: quote(m[0]), str(value))


def record_uri(uid: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{uid}/{digest}')}>"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Package:
    """One ZIP package being written, record by record."""

    def __init__(self, folder: str):
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path = f"{folder}/{name}"
        self._file = fs.open_output_stream(f"{base}/{name}")
        self._zip = zipfile.ZipFile(self._file, "w", zipfile.ZIP_STORED)
        self._out = self._zip.open(ARCHIVE, "w", force_zip64=True)
        self.size, self._lines = 0, []

    def add(self, packed: bytes, uri: str | None, entry: dict) -> None:
        host, path = re.match(r"(?:[^:/]*://([^/?#]*))?([^?#]*)", uri or "").groups("")
        key = quote(",".join(reversed(host.lower().split("."))) + ")" + path, safe="/:@,;=+!$&'()*~%")
        entry |= {"filename": ARCHIVE.partition("/")[2], "offset": str(self.size), "length": str(len(packed))}
        self._lines.append(f"{key} {entry.pop('timestamp')} {json.dumps(entry)}\n")
        self._out.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self._out.close()
        with self._zip.open(INDEX, "w", force_zip64=True) as index:
            for line in sorted(self._lines):
                index.write(line.encode())
        self._zip.close()
        self._file.close()
        return self.path, len(self._lines), self.size


def mark_revisits(rows: DataFrame, key: str, uri: str, payload: Column, least: int = 1000) -> DataFrame:
    """Stored rows (uid, key, uri, payload, digest, size, first): of rows with
    equal payloads of at least ``least`` bytes the one with the largest key
    (of equal keys: one of them) is the first, the others point to its uid."""
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    held = store(rows.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").alias("key"),
                             F.col(f"`{uri}`").cast("string").alias("uri"), body.alias("payload"),
                             F.sha1(body).alias("digest"), F.octet_length(body).cast("bigint").alias("size")),
                 "warc-rows")
    groups = held.filter(F.col("size") >= least).groupBy("digest", "size").agg(
        F.max(F.struct("key", "uid"))["uid"].alias("first"), F.count(F.lit(1)).alias("n"))
    groups = groups.filter("n > 1").drop("n")
    return held.join(groups, ["digest", "size"], "left").withColumn("first", F.nullif("first", F.col("uid")))


def write_packages(rows: DataFrame, date: str = "1970-01-01T00:00:00Z", max_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """One record per row of ``mark_revisits``; returns the stored table of
    packages (path, records, bytes)."""
    folder = scratch_path(rows.sparkSession, "warc-packages")
    stamp = re.sub(r"\D", "", date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        done = []
        for batch in bounded(batches, "payload", RUN_BYTES):
            for r in batch.to_pylist():
                package = package or Package(folder)
                uri = header_text(r["uri"])
                revisit = r["first"] is not None
                digest = "sha1:" + base64.b32encode(bytes.fromhex(r["digest"])).decode()
                headers = [("WARC-Type", "revisit" if revisit else "response"),
                           ("WARC-Record-ID", record_uri(r["uid"], r["digest"])), ("WARC-Date", date),
                           ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest),
                           ("WARC-Refers-To", record_uri(r["first"], r["digest"]) if revisit else None),
                           ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                           ("WARC-Record-Key", header_text(r["key"])),
                           ("Content-Type", "application/http; msgtype=response")]
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                block = http + (b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % r["size"] + r["payload"])
                package.add(gzip_member(warc_record(headers, block)), uri,
                            {"timestamp": stamp, "url": uri, "digest": digest, "mime": "text/html"})
                if package.size >= max_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            yield record_batch(["path", "records", "bytes"], [pa.array(c) for c in zip(*done, strict=True)])
    narrow = rows.select("uid", "key", "uri", "digest", "size", "first",
                         F.when(F.col("first").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"))
    return store(narrow.mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-listing")


# ---- the directory ------------------------------------------------------------------
@dataclass
class Member:
    name: str
    method: int
    encrypted: bool
    packed: int
    size: int
    header: int                          # where its local header begins


def _exactly(f, n: int, at: int) -> bytes:
    data = f.read_at(n, at) if n else b""
    if len(data) != n:
        raise ValueError(f"the package ends within {n} bytes at {at}")
    return data


def central_directory(f, size: int) -> tuple[int, int, int, int]:
    """(entries, length, start, shift): ``shift`` is the length of whatever
    stands before the package in its file."""
    reach = min(size, calcsize(END_FORM) + FULL16)
    tail = _exactly(f, reach, size - reach)
    at = tail.rfind(END)
    while at >= 0 and (at + calcsize(END_FORM) > reach or at + calcsize(END_FORM) + unpack_from(END_FORM, tail, at)[7] != reach):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP package, or torn")
    _, disk, first, _, entries, length, start, _ = unpack_from(END_FORM, tail, at)
    end = size - reach + at
    before = end - calcsize(LOCATOR64_FORM)
    sign, _, where, _ = unpack(LOCATOR64_FORM, _exactly(f, calcsize(LOCATOR64_FORM), before)) if before >= 0 else [b""] * 4
    if sign != LOCATOR64 and (FULL16 in (entries, disk) or FULL32 in (length, start)):
        raise ValueError("no ZIP64 locator before the end of central directory")
    if sign == LOCATOR64:                            # the wide record holds whether or not the narrow one is full
        nearest = end - calcsize(LOCATOR64_FORM) - calcsize(END64_FORM)
        for end in (where, nearest):                 # something may stand before the package
            fields = unpack(END64_FORM, _exactly(f, calcsize(END64_FORM), end))
            if fields[0] == END64:
                break
        else:
            raise ValueError("no ZIP64 end of central directory where its locator points")
        disk, first, entries, length, start = fields[4], fields[5], *fields[7:10]
    if disk or first:
        raise ValueError("a package in several volumes")
    shift = end - length - start
    if shift < 0:
        raise ValueError("the central directory does not fit into the package")
    return entries, length, start + shift, shift


def members(f, size: int) -> Iterator[Member]:
    """Central directory entries, read in pieces."""
    entries, length, start, shift = central_directory(f, size)
    held, at = b"", 0
    for _ in range(entries):
        need = calcsize(ENTRY_FORM)
        while True:
            if len(held) < need:
                more = _exactly(f, min(max(PIECE, need - len(held)), length - at), start + at)
                if not more:
                    raise ValueError("the central directory ends within an entry")
                held, at = held + more, at + len(more)
                continue
            v = unpack_from(ENTRY_FORM, held)
            if v[0] != ENTRY:
                raise ValueError("not a central directory entry")
            full = calcsize(ENTRY_FORM) + sum(v[10:13])
            if need == full or len(held) >= full:
                break
            need = full
        name = held[calcsize(ENTRY_FORM):calcsize(ENTRY_FORM) + v[10]]
        extra = held[calcsize(ENTRY_FORM) + v[10]:calcsize(ENTRY_FORM) + v[10] + v[11]]
        held = held[full:]
        unpacked, packed, header = _wide(extra, v[9], v[8], v[16])
        yield Member(name.decode("utf-8" if v[3] & 0x800 else "cp437"), v[4], bool(v[3] & 1), packed, unpacked,
                     header + shift)


def _wide(extra: bytes, size: int, packed: int, header: int) -> list[int]:
    """Size, packed size and header offset: those that are full are 64-bit
    values of the ZIP64 extra field, in this order."""
    values = [size, packed, header]
    at = 0
    while at + 4 <= len(extra):
        kind, n = unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            field = extra[at + 4:at + 4 + n]
            for i, v in enumerate(values):
                if v == FULL32:
                    if len(field) < 8:
                        raise ValueError("a ZIP64 extra field is too short")
                    values[i], field = unpack("<Q", field[:8])[0], field[8:]
            return values
        at += 4 + n
    return values


def data_start(f, m: Member) -> int:
    sign, *_, name, extra = unpack(LOCAL_FORM, _exactly(f, calcsize(LOCAL_FORM), m.header))
    if sign != LOCAL:
        raise ValueError(f"no local header for {m.name}")
    return m.header + calcsize(LOCAL_FORM) + name + extra


def member_lines(f, m: Member) -> Iterator[bytes]:
    """Lines of an index member, read in pieces; gzip inside is undone as well."""
    if m.encrypted or m.method not in (STORED, DEFLATED):
        raise ValueError(f"{m.name}: index is neither stored nor deflated")
    undo = [zlib.decompressobj(-15)] * (m.method == DEFLATED) + [zlib.decompressobj(31)] * m.name.endswith(".gz")
    at, start, rest = 0, data_start(f, m), b""
    while at < m.packed:
        piece = _exactly(f, min(PIECE, m.packed - at), start + at)
        at += len(piece)
        for u in undo:
            piece = u.decompress(piece)
        *lines, rest = (rest + piece).split(b"\n")
        yield from lines
    if rest:
        yield rest


# ---- Spark side ---------------------------------------------------------------------
def package_members(packages: DataFrame) -> DataFrame:
    """(path, name, method, encrypted, packed, size, start) of every member of
    the packages named in ``path``; ``start`` is where its data begins."""
    names = ["path", "name", "method", "encrypted", "packed", "size", "start"]

    types = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        for path, f in _opened(batches):
            with blame(path):
                rows = [(path, m.name, m.method, m.encrypted, m.packed, m.size, data_start(f, m))
                        for m in members(f, f.size())]
            if rows:
                yield record_batch(names, [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)])
    return _one_each(packages).mapInArrow(run, "path string, name string, method int, encrypted boolean, "
                                               "packed bigint, size bigint, start bigint")


def _one_each(packages: DataFrame) -> DataFrame:
    """Names are few bytes but each stands for a package: a number of
    partitions is given, so that Spark does not join them by size."""
    paths = packages.select("path").filter("path is not null").distinct()
    return paths.repartition(max(1, min(paths.count(), MAX_TASKS)), "path")


def _opened(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name = open_fs(path)
            with fs.open_input_file(name) as f:
                yield path, f


@contextmanager
def blame(path: str, at: str = ""):
    try:
        yield
    except (ValueError, KeyError, IndexError, zlib.error) as e:
        raise ValueError(f"{path}: {at}{e}") from e


def index_entries(f) -> Iterator[tuple[str, int, int]]:
    """(archive member, place in the package, length) of every indexed record."""
    found = list(members(f, f.size()))
    archives = {}
    for m in found:
        if re.search(r"\.warc(\.gz)?$", m.name):
            if m.method != STORED or m.encrypted:
                raise ValueError(f"{m.name} is not stored as it is and cannot be read by ranges")
            archives[m.name] = archives[m.name.rpartition("/")[2]] = (m, data_start(f, m))
    for m in found:
        if not re.search(r"\.cdxj(\.gz)?$", m.name):
            continue
        for line in filter(bytes.strip, member_lines(f, m)):
            entry = json.loads(line.split(b" ", 2)[2])
            if entry["filename"] not in archives:
                raise ValueError(f"{m.name} names {entry['filename']}, which is not in the package")
            member, start = archives[entry["filename"]]
            offset, length = int(entry["offset"]), int(entry["length"])
            if offset < 0 or length <= 0 or offset + length > member.size:
                raise ValueError(f"a record of {m.name} lies outside {member.name}")
            yield member.name, start + offset, length


def locate_records(packages: DataFrame) -> DataFrame:
    """(path, member, start, length) of every indexed record, ``start`` being
    its place in the package."""
    names = ["path", "member", "start", "length"]

    def run(batches):
        for path, f in _opened(batches):
            entries = index_entries(f)
            while True:
                with blame(path):
                    rows = [(path, *e) for e in islice(entries, 20_000)]
                if not rows:
                    break
                yield record_batch(names, [pa.array(c) for c in zip(*rows, strict=True)])
    return _one_each(packages).mapInArrow(run, "path string, member string, start bigint, length bigint")


FIELDS = {"record_id": "warc-record-id", "type": "warc-type", "key": "warc-record-key", "uri": "warc-target-uri",
          "date": "warc-date", "refers_to": "warc-refers-to"}
RECORD = ("path string, start bigint, record_id string, type string, key string, uri string, date string, "
          "refers_to string, declared_digest string, payload binary")


def parse_headers(data: bytes) -> tuple[str, dict[str, str], bytes]:
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("a header without an end")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = (line.partition(":") for line in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in fields}, rest


def parse_record(data: bytes, packed: bool) -> tuple[dict[str, str], bytes | None]:
    """(headers, payload): the payload is the HTTP body, or the whole block of
    a record of another content type; a revisit has none."""
    if packed:
        undo = zlib.decompressobj(31)
        data = undo.decompress(data)
        if not undo.eof or undo.unused_data:
            raise ValueError("not exactly one gzip member")
    first, headers, rest = parse_headers(data)
    length = int(headers.get("content-length", -1))
    if not first.startswith("WARC/") or rest[length:] != b"\r\n\r\n" or length < 0:
        raise ValueError("not exactly one WARC record")
    block = rest[:length]
    if headers.get("warc-type") == "revisit":
        return headers, None
    if headers.get("content-type", "").startswith("application/http"):
        block = parse_headers(block)[2]
    return headers, block


def hex_digest(declared: str | None) -> str | None:
    """Bare lower-case hex of 'sha1:' with a base32 or hex value; others: null."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def read_records(packages: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Every indexed record of the packages (columns ``RECORD``).  Records are
    dealt out by stretches of ``run_bytes`` of a package and neighbours are
    fetched by one range read."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def read(batches):
        for path, rows in _neighbours(batches, run_bytes):
            fs, name = open_fs(path)
            with fs.open_input_file(name) as f, blame(path):
                base = rows[0][1]
                data = memoryview(_exactly(f, rows[-1][1] + rows[-1][2] - base, base))
            out = []
            for member, start, length in rows:
                with blame(path, f"record at {start}: "):
                    h, payload = parse_record(bytes(data[start - base:start - base + length]), member.endswith(".gz"))
                    declared = hex_digest(h.get("warc-payload-digest"))
                    if payload is not None and declared and hashlib.sha1(payload).hexdigest() != declared:
                        raise ValueError("the payload is not the one that was digested")
                out.append((path, start, *[h.get(k) for k in FIELDS.values()], declared, payload))
            types = [pa.string(), pa.int64(), *[pa.string()] * (len(FIELDS) + 1), pa.large_binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield record_batch(names, [*columns[:-1], columns[-1].cast(pa.binary())])
    # dealt out by what is to be read, not by the size of these rows
    located = store(locate_records(packages), "warc-located")
    total = located.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(-(-total // TASK_BYTES), MAX_TASKS))
    stretch = F.floor(F.col("start") / run_bytes)
    dealt = located.repartition(tasks, "path", stretch).sortWithinPartitions("path", "start")
    return dealt.mapInArrow(read, RECORD)


def _neighbours(batches, run_bytes: int):
    """(path, [(member, start, length)]) of records that follow each other."""
    path, rows = None, []
    for batch in batches:
        for p, member, start, length in zip(*[batch.column(c).to_pylist() for c in ("path", "member", "start", "length")],
                                            strict=True):
            if rows and (p != path or start != rows[-1][1] + rows[-1][2] or start + length - rows[0][1] > run_bytes):
                yield path, rows
                rows = []
            path = p
            rows.append((member, start, length))
    if rows:
        yield path, rows


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(key, payload_bytes, payload_digest, type, refers_to): a revisit's
    figures are those of the response that it names, by its record id; it
    must declare the same digest.  Payloads stay where they are read."""
    narrow = store(records.select("key", "record_id", "type", "refers_to", "declared_digest",
                                  F.octet_length("payload").cast("bigint").alias("bytes"),
                                  F.sha1("payload").alias("digest")), "warc-facts")
    told = narrow.filter("type <> 'revisit'").select(
        F.col("record_id").alias("__id"), F.col("key").alias("__key"), F.col("bytes").alias("__bytes"),
        F.col("digest").alias("__digest"))
    found = narrow.join(told, (F.col("refers_to") == F.col("__id")) & (F.col("declared_digest") == F.col("__digest")),
                        "left")
    return found.select("key", F.coalesce("bytes", "__bytes").alias("payload_bytes"),
                        F.coalesce("digest", "declared_digest").alias("payload_digest"), "type",
                        F.col("__key").alias("refers_to"))
