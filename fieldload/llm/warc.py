"""WARC records in ZIP packages: writer and range reader.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, one
gzip member for each record, and ``indexes/index.cdxj``, one line for each
record with its offset and length in the first.  The writer's packages are
rows of ``path, content``, as Spark's ``binaryFile`` source gives them;
:func:`store_packages` makes files of them.

The reader parses the end of the central directory (or its ZIP64 form), finds
the byte ranges of the members under ``archive/`` and ``indexes/``, and reads
each record by its own range; nothing is extracted.  Index lines are JSON with
``offset``, ``length`` and the ``filename`` of the archive member, after a key
and a timestamp or alone.  What no index line covers is walked record by
record.  :func:`read_records` takes packages in memory, :func:`read_files`
seeks in files of any size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import cut
from ..session import checkpoint_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVES, INDEXES = (".warc.gz", ".warc"), (".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")
STEP = 1 << 16
RANGE_BYTES = 64 << 20
RECORDS = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
DATE = "2025-01-01T00:00:00Z"
# Fixed values of the ZIP and WARC formats.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

Read = Callable[[int, int], bytes]


def ranges_of(content) -> Read:
    """Range reads of bytes held in memory."""
    view = memoryview(content)
    return lambda at, n: bytes(view[at : at + n])


def members(read: Read, size: int) -> dict[str, tuple[int, int, int]]:
    """Place of the local header, packed length and method of every member of a ZIP of ``size`` bytes."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end of a ZIP central directory")
    count, length, start = struct.unpack("<H2I", tail[end + 10 : end + 20])
    if 0xFFFF == count or 0xFFFFFFFF in (length, start) or tail[max(0, end - 20) : end][:4] == LOCATOR64:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] == LOCATOR64:
            (at64,) = struct.unpack("<Q", locator[8:16])
            record = read(at64, 56)
            if record[:4] != END64:
                raise ValueError("ZIP64 directory not found")
            count, length, start = struct.unpack("<3Q", record[32:56])
    directory = read(start, length)
    out, at = {}, 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("broken ZIP central directory")
        method = struct.unpack("<H", directory[at + 10 : at + 12])[0]
        packed, full = struct.unpack("<2I", directory[at + 20 : at + 28])
        name_n, extra_n, comment_n = struct.unpack("<3H", directory[at + 28 : at + 34])
        (header,) = struct.unpack("<I", directory[at + 42 : at + 46])
        name = directory[at + 46 : at + 46 + name_n].decode(errors="replace")
        extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
        packed, header = _wide(extra, full, packed, header)
        out[name] = (header, packed, method)
        at += 46 + name_n + extra_n + comment_n
    return out


def _start(read: Read, name: str, header: int) -> int:
    """Where a member's data begins."""
    local = read(header, 30)
    if local[:4] != LOCAL:
        raise ValueError(f"{name} has no local header")
    return header + 30 + sum(struct.unpack("<2H", local[26:30]))


def _wide(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int]:
    """Packed size and header offset, from the ZIP64 field where the directory's are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<2H", extra[at : at + 4])
        if kind == 1:
            body = io.BytesIO(extra[at + 4 : at + 4 + n])
            take = lambda: struct.unpack("<Q", body.read(8))[0]
            if full == 0xFFFFFFFF:
                take()
            packed = take() if packed == 0xFFFFFFFF else packed
            header = take() if header == 0xFFFFFFFF else header
        at += 4 + n
    return packed, header


def _headers(block: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    first, *lines = head.decode(errors="replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, rest


def record_bytes(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def package(records: list[bytes], index: list[dict], zip64: bool = False) -> bytes:
    """A ZIP of the compressed records and their index, both stored."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        lines = "".join(json.dumps(x) + "\n" for x in index).encode()
        for name, data in ((ARCHIVE, b"".join(records)), (INDEX, lines)):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
    return out.getvalue()


def _index_lines(read: Read, name: str, header: int, packed: int, method: int) -> Iterator[dict]:
    data = read(_start(read, name, header), packed)
    if method == 8:
        data = zlib.decompress(data, -15)
    elif method:
        raise ValueError(f"{name} is packed with method {method}")
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    for line in data.decode().splitlines():
        if not line.strip() or line.startswith("!"):
            continue
        brace = line.find("{")
        if brace < 0:
            raise ValueError(f"{name}: not a JSON index line")
        yield json.loads(line[brace:])


def entries(read: Read, size: int) -> list[tuple[int, int, bool]]:
    """Start, length and whether to walk it: ranges of all indexed records, and what no index line covers."""
    found = members(read, size)
    held = {}
    for name, (header, packed, method) in found.items():
        if name.startswith("archive/") and name.endswith(ARCHIVES):
            if method != 0:
                raise ValueError(f"{name} is not stored")
            held[name] = (_start(read, name, header), packed)
    ranges: dict[str, dict[int, int]] = {name: {} for name in held}
    for name, place in found.items():
        if not (name.startswith("indexes/") and name.endswith(INDEXES)):
            continue
        for line in _index_lines(read, name, *place):
            of = line.get("filename")
            if of is None and len(held) != 1:
                raise ValueError(f"{name} names no archive member")
            of = next(iter(held)) if of is None else of if of in held else f"archive/{of}"
            if of not in held:
                raise ValueError(f"{name} names {of}, which is not in the package")
            offset, length = int(line["offset"]), int(line["length"])
            if offset + length > held[of][1]:
                raise ValueError("index points outside the archive")
            ranges[of][offset] = length
    out = []
    for name, (start, length) in held.items():
        upto = 0
        for at, n in [*sorted(ranges[name].items()), (length, 0)]:
            if at > upto:
                out.append((start + upto, at - upto, True))
            if n:
                out.append((start + at, n, False))
            upto = max(upto, at + n)
    return out


def _walk(read: Read, start: int, length: int) -> Iterator[bytes]:
    """The records of a whole archive member, one after the other."""
    at = 0
    while at < length:
        if read(start + at, 2) == b"\x1f\x8b":
            unpack, parts, pos = zlib.decompressobj(31), [], at
            while not unpack.eof:
                chunk = read(start + pos, min(STEP, length - pos))
                if not chunk:
                    raise ValueError("archive ends within a record")
                pos += len(chunk)
                parts.append(unpack.decompress(chunk))
            at = pos - len(unpack.unused_data)
            yield b"".join(parts)
            continue
        head, pos = b"", at
        while b"\r\n\r\n" not in head:
            chunk = read(start + pos, min(STEP, length - pos))
            if not chunk:
                if head.strip(b"\r\n"):
                    raise ValueError("archive ends within a record")
                return
            head, pos = head + chunk, pos + len(chunk)
        skip = len(head) - len(head.lstrip(b"\r\n"))
        if skip:
            at += skip
            continue
        n = head.index(b"\r\n\r\n") + 4 + int(_headers(head)[1]["content-length"])
        if at + n > length:
            raise ValueError("archive ends within a record")
        yield read(start + at, n)
        at += n


def _parsed(block: bytes) -> tuple[dict[str, str], int, bytes | None]:
    """WARC headers, payload length and payload; a record without an HTTP head is its own payload."""
    _, head, rest = _headers(block)
    rest = rest[: int(head["content-length"])]
    kind = head["warc-type"]
    if kind not in ("response", "revisit") or not rest.startswith(b"HTTP/"):
        return head, len(rest), None if kind == "revisit" else rest
    _, http, payload = _headers(rest)
    if kind == "revisit":
        return head, int(http.get("content-length", 0)), None
    return head, int(http.get("content-length", len(payload))), payload


def _records(read: Read, start: int, length: int, walk: bool) -> Iterator[tuple[dict[str, str], int, bytes | None]]:
    if walk:
        yield from map(_parsed, _walk(read, start, length))
        return
    data = read(start, length)
    yield _parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)


def read_package(read: Read, size: int) -> Iterator[tuple[dict[str, str], int, bytes | None]]:
    """WARC headers, payload length and payload (None for a revisit) of every record."""
    for entry in entries(read, size):
        yield from _records(read, *entry)


def write_packages(
    pages: DataFrame, min_revisit_bytes: int = 0, package_bytes: int = 8 << 20, id_col="page_id", url_col="url", body_col="html"
) -> DataFrame:
    """``path, content`` of packages that hold one record for each row.

    The payload is the UTF-8 body, empty for null.  Of rows with equal payloads
    of at least ``min_revisit_bytes`` the one with the largest id is a response
    and the others revisit it; smaller payloads are all responses.  Equal means
    equal SHA-1 and length.  Rows that repeat the largest id are responses
    too; rows with a null id revisit like others, and are responses where no
    row of the group has an id.  An empty table makes no package.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body"),
        F.sha1(F.encode(body, "utf-8")).alias("sha"), F.octet_length(body).alias("n"),
    )
    # Only digests that occur twice are joined.  They are written, so that the join has plain exchanges on both sides
    # and adaptive execution can split the bodies of a common one.
    twice = cut(
        rows.groupBy("sha", "n").agg(F.max("id").alias("last"), F.count("*").alias("k"))
        .where((F.col("k") > 1) & (F.col("n") >= min_revisit_bytes) & F.col("last").isNotNull()).drop("k"),
        "repeated-payloads",
    )
    judged = rows.join(twice.hint("shuffle_hash"), ["sha", "n"], "left").select(
        F.col("id").cast("string").alias("id"), "url", "sha",
        F.when(F.col("id").eqNullSafe(F.col("last")), F.lit(None)).otherwise(F.col("last")).cast("string").alias("refers"),
        "body",
    )

    def write(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        records, index, at = [], [], 0

        def close():
            content = package(records, index)
            return pa.RecordBatch.from_pydict(
                {"path": pa.array([f"part-{part:05d}-{made:05d}.wacz"]), "content": pa.array([content], pa.binary())}
            )

        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("id", "url", "sha", "refers", "body")), strict=True):
                page, url, sha, refers, text = r
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = record_bytes("" if page is None else page, url, text.encode(), digest, refers)
                data = pack.compress(raw) + pack.flush()
                records.append(data)
                index.append({"offset": at, "length": len(data), "digest": digest})
                at += len(data)
                if at >= package_bytes:
                    yield close()
                    made += 1
                    records, index, at = [], [], 0
        if records:
            yield close()

    return judged.mapInArrow(write, "path string, content binary")


def _matches(digest: str | None, payload: bytes) -> bool:
    """Whether a labelled digest, base32 or hex, is the payload's; one in an algorithm unknown here is taken as it is."""
    kind, _, value = (digest or "").partition(":")
    if kind.replace("-", "").lower() not in ("sha1", "sha256", "sha512", "md5"):
        return True
    made = hashlib.new(kind.replace("-", "").lower(), payload).digest()
    return base64.b32encode(made).decode().rstrip("=") == value.rstrip("=").upper() or made.hex() == value.lower()


def _columns(records: Iterator[tuple[str, dict[str, str], int, bytes | None]], with_payload: bool) -> Iterator[pa.RecordBatch]:
    """Batches of ``RECORDS`` of about 4 MB."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    out, held = {c: [] for c in names}, 0

    def batch():
        return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()})

    for path, head, n, payload in records:
        digest, name = head.get("warc-payload-digest"), head.get("warc-record-id", "")
        if payload is not None and not _matches(digest, payload):
            raise ValueError(f"{path}: payload of {name} does not match its digest")
        url, refers = head.get("warc-target-uri"), head.get("warc-refers-to")
        out["id"].append(name.removeprefix("<urn:page:").removesuffix(">") or None)
        out["url"].append(url if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"))
        out["payload_bytes"].append(n)
        out["payload_digest"].append(digest and digest.removeprefix("sha1:"))
        out["record_type"].append(head["warc-type"])
        out["refers_to"].append(refers and refers.removeprefix("<urn:page:").removesuffix(">"))
        out["payload"].append(payload if with_payload else None)
        held += 500 + (len(payload or b"") if with_payload else 0)
        if held > 4 << 20:
            yield batch()
            out, held = {c: [] for c in names}, 0
    yield batch()


def read_records(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """``id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of all records.

    ``packages`` has ``path`` and ``content`` (as ``binaryFile``).  A response
    whose payload does not match its digest raises an error.  Revisits have a
    null payload and the length and digest of the full one.  Without
    ``with_payload`` payloads are checked but not returned.
    """

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                data = content.as_buffer()
                yield from _columns(((path, *x) for x in read_package(ranges_of(data), data.size)), with_payload)

    return packages.mapInArrow(run, RECORDS)


def _local(path: str) -> str | None:
    """The path of a local or mounted file, given as a path or ``file:`` URI."""
    if path.startswith("file:"):
        return unquote(urlsplit(path).path)
    return path if path.startswith("/") else None


def _open(path: str) -> tuple[Read, int]:
    """Range reads of a file at a path or URI that Arrow's file systems know."""
    system, name = (pafs.LocalFileSystem(), _local(path)) if _local(path) else pafs.FileSystem.from_uri(path)
    file = system.open_input_file(name)

    def read(at, n):
        file.seek(at)
        return file.read(n)

    return read, file.size()


def read_files(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """:func:`read_records` of the packages at ``path``, each task seeking to its own records.

    Only directories and indexes are read whole, so files may be of any size
    (ZIP64).  Every worker must reach the paths.  A stretch that no index line
    covers is one task's work.
    """

    def list_entries(batches):
        for batch in batches:
            for path in batch["path"].to_pylist():
                found = entries(*_open(path))
                for a in range(0, len(found), 100_000):
                    at, n, walk = zip(*found[a : a + 100_000], strict=True)
                    yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(at)), "at": at, "n": n, "walk": walk})

    spread = paths.select("path").repartition(paths.sparkSession.sparkContext.defaultParallelism)
    found = cut(spread.mapInArrow(list_entries, "path string, at long, n long, walk boolean"), "warc-entries")
    total = found.agg(F.sum("n")).first()[0] or 0
    tasks = max(paths.sparkSession.sparkContext.defaultParallelism, -(-total // RANGE_BYTES))
    dealt = found.repartitionByRange(tasks, "path", "at").sortWithinPartitions("path", "at")

    def run(batches):
        def records():
            here, read = None, None
            for batch in batches:
                for path, at, n, walk in zip(*(batch[c].to_pylist() for c in ("path", "at", "n", "walk")), strict=True):
                    if path != here:
                        here, (read, _) = path, _open(path)
                    for x in _records(read, at, n, walk):
                        yield path, *x

        yield from _columns(records(), with_payload)

    return dealt.mapInArrow(run, RECORDS)


def store_packages(packages: DataFrame, folder: str) -> DataFrame:
    """``path`` of the files made of ``path, content`` rows below ``folder``, which every worker must reach.

    A file's name holds a random part, and only files of the attempt whose rows
    count are listed: what a lost or repeated task left behind is never read.
    """

    def run(batches):
        system, root = (pafs.LocalFileSystem(), _local(folder)) if _local(folder) else pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                name = f"{uuid.uuid4().hex}-{path}"
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write(content.as_buffer())
                yield pa.RecordBatch.from_pydict({"path": pa.array([f"{folder.rstrip('/')}/{name}"])})

    return cut(packages.mapInArrow(run, "path string"), "package-files")


def round_trip(pages: DataFrame, with_payload: bool = True, **options) -> DataFrame:
    """Records read back, by range, from the package files that :func:`write_packages` made in the checkpoint folder."""
    folder = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/fieldload-packages/{uuid.uuid4().hex}"
    return read_files(store_packages(write_packages(pages, **options), folder), with_payload)
