"""Whole files as rows: the write side of Spark's ``binaryFile`` source.

Spark reads ``(path, content)`` rows from files and has no writer for them.
``write_files`` is one, as a Python data source: a task writes its files into a
staging folder of its own under the root and moves them into place when all of
them are complete.  A file is therefore whole or absent; a failed or repeated
task leaves nothing but its staging folder, which the job's commit or abort
removes.  Files that tasks of an aborted job had already moved stay: they are
complete, and writing them again gives the same bytes.

Folders are listed by tasks, and the driver holds no file of them: Spark's own
file index keeps the status of every file there.

Many small files may come as ZIP packages: a file of its own takes a block of
the disk at least.  Tasks list what packages hold, and a member is read by its
range of the package.
"""

from __future__ import annotations

import io
import os
import re
import struct
import sys
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.stage import cut

# Tasks pickle this module by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_SCHEMA = "path string, content binary"
STAGING = ".staging"

# Entries of a folder in one Arrow batch; paths that a task looks up at once.
LIST_ROWS = 10_000

# Ending of packages; bytes of files and number of them in one, about.
PACKAGE = ".zip"
PACKAGE_BYTES = 8 << 20
PACKAGE_FILES = 20_000


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file URI, in the driver or a task."""
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def read_bytes(uri: str) -> bytes:
    system, path = file_system(uri)
    with system.open_input_file(path) as f:
        return f.read()


def read_member(uri: str, start: int) -> bytes:
    """The member of a package whose header begins at ``start``; ``ValueError`` if it is damaged."""
    system, path = file_system(uri)
    with system.open_input_file(path) as f:
        f.seek(start)
        head = f.read(30)
        if len(head) < 30 or head[:4] != b"PK\x03\x04":
            raise ValueError("damaged package")
        flags, method, crc, size, name, extra = struct.unpack("<6xHH4xII4xHH", head)
        if flags & 9 or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or size == 0xFFFFFFFF:
            # Sizes behind the content, 64-bit ones, encryption: by the package's directory.
            return _by_directory(f, start)
        f.seek(start + 30 + name + extra)
        data = f.read(size)
    try:
        data = zlib.decompress(data, -15) if method == zipfile.ZIP_DEFLATED else data
    except zlib.error:
        raise ValueError("damaged package") from None
    if zlib.crc32(data) != crc:
        raise ValueError("damaged package")
    return data


def _by_directory(file, start: int) -> bytes:
    try:
        with zipfile.ZipFile(file) as package:
            return package.read(next(x for x in package.infolist() if x.header_offset == start))
    except (StopIteration, RuntimeError, NotImplementedError, zipfile.BadZipFile, zlib.error):
        raise ValueError("damaged package") from None


@dataclass
class FilesWritten(WriterCommitMessage):
    files: int
    bytes: int


class FileWriter(DataSourceArrowWriter):
    def __init__(self, root: str, run: str):
        self.root, self.run = root.rstrip("/"), run

    def write(self, batches) -> FilesWritten:
        system, root = file_system(self.root)
        stage = f"{root}/{STAGING}/{self.run}/{uuid.uuid4().hex}"
        system.create_dir(stage, recursive=True)
        names, size = [], 0
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                if name is None or not content.is_valid:
                    continue
                with system.open_output_stream(f"{stage}/{len(names)}") as out:
                    out.write(content.as_buffer())
                size += len(content.as_buffer())
                names.append(name)
        folders = set()
        for i, name in enumerate(names):
            target = f"{root}/{name}"
            folder = target.rsplit("/", 1)[0]
            if folder not in folders:
                system.create_dir(folder, recursive=True)
                folders.add(folder)
            try:
                system.move(f"{stage}/{i}", target)
            except OSError:  # some file systems do not replace: another attempt was first
                if system.get_file_info(target).type != pafs.FileType.File:
                    raise
        return FilesWritten(len(names), size)

    def _clear(self) -> None:
        system, root = file_system(self.root)
        stage = f"{root}/{STAGING}/{self.run}"
        if system.get_file_info(stage).type == pafs.FileType.Directory:
            system.delete_dir(stage)

    def commit(self, messages) -> None:
        self._clear()

    def abort(self, messages) -> None:
        self._clear()


class Files(DataSource):
    """``df.write.format("whole_files").mode("append").save(root)`` for rows ``path`` (relative to the root), ``content``."""

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return FILE_SCHEMA

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"], self.options["run"])


def write_files(rows: DataFrame, root: str) -> None:
    """Write ``path, content`` rows below ``root``, replacing files of that name; rows with a null are left out."""
    rows.sparkSession.dataSource.register(Files)
    rows.select(F.col("path").cast("string"), F.col("content").cast("binary")).write.format("whole_files").option(
        "run", uuid.uuid4().hex
    ).mode("append").save(root)


def _hidden(name: str) -> bool:
    """Names that Spark's file sources leave out."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(system: pafs.FileSystem, path: str) -> Iterator[tuple[str, int | None]]:
    """Name and length of what is in a folder; a folder in it has no length, a missing one nothing in it."""
    if isinstance(system, pafs.LocalFileSystem):
        try:
            with os.scandir(path) as found:
                for x in found:
                    yield x.name, None if x.is_dir() else x.stat().st_size
        except FileNotFoundError:
            return
    else:
        for x in system.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
            yield x.base_name, None if x.type == pafs.FileType.Directory else x.size


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (relative to ``root``), ``length`` of the files below it; contents are not read, a missing root is empty.

    Tasks list the folders of one level after another; a folder is listed by
    one of them, as rows that it does not keep.  Hidden and empty files are
    left out, as in Spark's file sources.
    """
    root = root.rstrip("/")
    schema = "path string, length long"

    def scan(batches):
        system, base = file_system(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                paths, lengths = [], []
                for name, length in _entries(system, f"{base}/{folder}"):
                    if _hidden(name) or length == 0:
                        continue
                    paths.append(f"{folder}/{name}" if folder else name)
                    lengths.append(length)
                    if len(paths) == LIST_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(lengths, pa.int64())], ["path", "length"])
                        paths, lengths = [], []
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])

    folders, files = spark.createDataFrame([("",)], "path string"), None
    while True:
        level = cut(folders.mapInArrow(scan, schema), "listing")
        found = level.where("length is not null")
        files = found if files is None else files.unionByName(found)
        folders = level.where("length is null").select("path")
        if folders.isEmpty():
            return files
        folders = folders.repartition(spark.sparkContext.defaultParallelism, "path")


def present(rows: DataFrame, root: str, column: str = "path", at_least: int = 1) -> DataFrame:
    """``rows`` whose file ``column`` (relative to ``root``) holds ``at_least`` as many bytes; each task looks for its own files."""
    root = root.rstrip("/")

    def look(batches):
        system, base = file_system(root)
        for batch in batches:
            for start in range(0, batch.num_rows, LIST_ROWS):
                part = batch.slice(start, LIST_ROWS)
                found = system.get_file_info([f"{base}/{f}" for f in part.column(column).to_pylist()])
                yield part.filter(pa.array([x.type == pafs.FileType.File and x.size >= at_least for x in found], pa.bool_()))

    return rows.mapInArrow(look, rows.schema)


def packages(rows: DataFrame) -> DataFrame:
    """``path, content`` rows as ZIP packages of about ``PACKAGE_BYTES``, again ``path, content``; rows with a null are left out.

    A package holds rows of one partition.  Members are stored as they are, in
    the order of the rows, so each is a range of its package.
    """

    def pack(batches):
        part, no, held, size = TaskContext.get().partitionId(), 0, [], 0

        def package():
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                for name, content in held:
                    z.writestr(zipfile.ZipInfo(name), content)
            name = f"{part:05d}-{no:05d}{PACKAGE}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([out.getvalue()], pa.binary())], ["path", "content"])

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if name is None or content is None:
                    continue
                held.append((name, content))
                size += len(content)
                if size >= PACKAGE_BYTES or len(held) >= PACKAGE_FILES:
                    yield package()
                    no, held, size = no + 1, [], 0
        if held:
            yield package()

    return rows.select(F.col("path").cast("string"), F.col("content").cast("binary")).mapInArrow(pack, FILE_SCHEMA)


def unpacked(files: DataFrame, root: str) -> DataFrame:
    """``path, file, start, length`` of ``files`` (as from ``list_files``), packages replaced by what they hold.

    ``path`` of a member lies below its package, ``file`` is the file to read
    and ``start`` the place of a member in it (null: the whole file).  Tasks
    read the packages' directories; a file that is no package stays as it is.
    Hidden and empty members are left out, as such files are.
    """
    root = root.rstrip("/")
    schema = "path string, file string, start long, length long"

    def scan(batches):
        system, base = file_system(root)
        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                with system.open_input_file(f"{base}/{path}") as f:
                    try:
                        with zipfile.ZipFile(f) as package:
                            found = [
                                (f"{path}/{x.filename}", path, x.header_offset, x.file_size)
                                for x in package.infolist()
                                if x.file_size and not x.is_dir() and not any(_hidden(n) for n in x.filename.split("/"))
                            ]
                    except (zipfile.BadZipFile, ValueError):  # the latter: too short to be one
                        found = [(path, path, None, length)]
                for at in range(0, len(found), LIST_ROWS):
                    columns = zip(*found[at : at + LIST_ROWS], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names, kinds = ["path", "file", "start", "length"], [pa.string(), pa.string(), pa.int64(), pa.int64()]
    packed = files.where(F.col("path").endswith(PACKAGE)).select("path", "length")
    plain = files.where(~F.col("path").endswith(PACKAGE)).select("path", F.col("path").alias("file"), F.lit(None).cast("long").alias("start"), "length")
    if packed.isEmpty():
        return plain
    # Read by several later steps: the packages are opened once.
    packed = packed.repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    return plain.unionByName(cut(packed.mapInArrow(scan, schema), "members"))
