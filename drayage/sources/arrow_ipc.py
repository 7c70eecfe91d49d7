"""Arrow IPC files as a Spark data source, read and written as record batches.

    spark.dataSource.register(ArrowFiles)
    spark.read.format("arrow").load(path)

A path is a file, a folder of ``*.arrow`` files or a pattern, in which any part may hold ``*``, ``?`` and
``[...]``, on any file system pyarrow knows.  Large files are read by several tasks, each taking a share of
the record batches.  A column that a file lacks is null there, and one it has in a narrower type is widened.

Every write to a folder publishes one file of its log, ``_log/<number>.json``, which names all files of
that version.  Readers take the latest version's files and no others, so a write is seen as a whole
or not at all, whatever it was doing when it died.  A folder without a log is read as it lies; files put
there by others after its first version are not seen until they are written by this source.
"""

from __future__ import annotations

import fnmatch
import json
import os
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

SUFFIX = ".arrow"
LOG = "_log"
DEFAULT_SPLIT_BYTES = 128 * 1024 * 1024


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path inside."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:/", "file:///", 1)
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def list_files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    """The files behind a path, sorted by name."""
    system, inner = open_path(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return system, [info]
    if info.type == fs.FileType.Directory:
        version = latest_version(system, inner)
        if version is None:
            found = [f for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(SUFFIX)]
        else:
            found = system.get_file_info([f"{inner}/{name}" for name in files_of(system, inner, version)])
    else:
        found = _matching(system, inner)
    return system, sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path)


def _matching(system: fs.FileSystem, pattern: str) -> list[fs.FileInfo]:
    """Files whose path fits a pattern, level by level; only folders that fit so far are listed."""
    parts = pattern.split("/")
    fixed = next((n for n, part in enumerate(parts) if re.search(r"[*?\[]", part)), len(parts) - 1)
    folders, found = ["/".join(parts[:fixed])], []
    for number, part in enumerate(parts[fixed:], fixed):
        listed = [
            info
            for folder in folders
            for info in system.get_file_info(fs.FileSelector(folder or "/", allow_not_found=True))
            if fnmatch.fnmatchcase(info.base_name, part)
        ]
        found = listed
        folders = [info.path for info in listed if info.type == fs.FileType.Directory]
    return found


def latest_version(system: fs.FileSystem, folder: str) -> int | None:
    listed = system.get_file_info(fs.FileSelector(f"{folder}/{LOG}", allow_not_found=True))
    numbers = [int(f.base_name[:-5]) for f in listed if re.fullmatch(r"[0-9]+\.json", f.base_name)]
    return max(numbers, default=None)


def files_of(system: fs.FileSystem, folder: str, version: int) -> list[str]:
    """The names of the files of a version."""
    with system.open_input_file(f"{folder}/{LOG}/{version}.json") as source:
        return json.loads(source.read())["files"]


class VersionTaken(RuntimeError):
    """Another write has published the version first."""


def publish_version(system: fs.FileSystem, folder: str, version: int, files: list[str]) -> None:
    """Add a version to the log, complete from its first moment; of two writers one gets ``VersionTaken``.

    A local file system links the name, others rename to it; object stores without a rename that
    refuses to overwrite can take one writer at a time.
    """
    system.create_dir(f"{folder}/{LOG}", recursive=True)
    target, aside = f"{folder}/{LOG}/{version}.json", f"{folder}/{LOG}/.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as sink:
        sink.write(json.dumps({"files": sorted(files)}).encode())
    if isinstance(system, fs.LocalFileSystem):
        try:
            os.link(aside, target)
        except FileExistsError as error:
            raise VersionTaken(f"version {version} of {folder} is already published") from error
        finally:
            system.delete_file(aside)
        return
    if system.get_file_info(target).type != fs.FileType.NotFound:
        system.delete_file(aside)
        raise VersionTaken(f"version {version} of {folder} is already published")
    system.move(aside, target)


def conformed(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The batch with the columns of ``schema``: others left out, missing ones null, narrower ones widened."""
    columns = []
    for field in schema:
        at = batch.schema.get_field_index(field.name)
        if at < 0:
            columns.append(pa.nulls(batch.num_rows, field.type))
        else:
            column = batch.column(at)
            columns.append(column if column.type == field.type else column.cast(field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


@dataclass
class FileShare(InputPartition):
    """Share ``number`` of ``shares`` equal shares of a file's record batches."""

    path: str
    number: int
    shares: int


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow"

    def __init__(self, options):
        super().__init__(options)
        if not options.get("path"):
            raise ValueError("arrow needs the option path")

    def schema(self) -> T.StructType:
        system, files = list_files(self.options["path"])
        if not files:
            raise ValueError(f"there is no Arrow file at {self.options['path']}")
        with system.open_input_file(files[0].path) as source, pa.ipc.open_file(source) as reader:
            return from_arrow_schema(reader.schema, prefer_timestamp_ntz=True)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArrowReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowWriter(schema, self.options, overwrite)


class ArrowReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options) -> None:
        self.schema = schema
        self.path = options["path"]
        self.split_bytes = int(options.get("splitBytes", DEFAULT_SPLIT_BYTES))

    def partitions(self) -> list[FileShare]:
        """At least one share per file; sizes come from the listing, so no footer is opened here."""
        _, files = list_files(self.path)
        if not files:
            raise ValueError(f"there is no Arrow file at {self.path}")
        planned = []
        for file in files:
            shares = max(1, -(-file.size // self.split_bytes))
            planned += [FileShare(file.path, n, shares) for n in range(shares)]
        return planned

    def read(self, partition: FileShare) -> Iterator[pa.RecordBatch]:
        system, _ = open_path(self.path)
        wanted = to_arrow_schema(self.schema)
        try:
            with system.open_input_file(partition.path) as source, pa.ipc.open_file(source) as reader:
                total = reader.num_record_batches
                first = total * partition.number // partition.shares
                last = total * (partition.number + 1) // partition.shares
                for i in range(first, last):
                    yield conformed(reader.get_batch(i), wanted)
        except Exception as error:
            raise RuntimeError(f"{partition.path} cannot be read as an Arrow file: {error}") from error


def _is_data(file: fs.FileInfo) -> bool:
    return file.type == fs.FileType.File and file.base_name.endswith(SUFFIX)


@dataclass
class WrittenFile(WriterCommitMessage):
    path: str | None
    rows: int


class ArrowWriter(DataSourceArrowWriter):
    """Each task writes one file aside; the commit moves them into place and publishes a version that names them.

    Until that moment readers see the version before.  Files that no version needs any more are deleted
    afterwards; a crash may leave some, which no read lists and the next overwrite deletes.
    """

    def __init__(self, schema: T.StructType, options, overwrite: bool) -> None:
        self.schema = schema
        self.overwrite = overwrite
        self.path = options["path"].rstrip("/")
        self.job = uuid.uuid4().hex

    def _folder(self) -> tuple[fs.FileSystem, str, str]:
        system, folder = open_path(self.path)
        return system, folder, f"{folder}/_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        first = next(iterator, None)
        if first is None:
            return WrittenFile(None, 0)
        system, _, staging = self._folder()
        system.create_dir(staging, recursive=True)
        path = f"{staging}/part-{uuid.uuid4().hex}{SUFFIX}"
        rows = first.num_rows
        with system.open_output_stream(path) as sink, pa.ipc.new_file(sink, first.schema) as out:
            out.write_batch(first)
            for batch in iterator:
                out.write_batch(batch)
                rows += batch.num_rows
        return WrittenFile(path, rows)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        system, folder, staging = self._folder()
        system.create_dir(staging, recursive=True)
        written = sorted(m.path for m in messages if m is not None and m.path)
        if not written:
            empty = f"{staging}/part-{uuid.uuid4().hex}{SUFFIX}"
            arrow_schema = to_arrow_schema(self.schema)
            with system.open_output_stream(empty) as sink, pa.ipc.new_file(sink, arrow_schema):
                written = [empty]
        names = [f"part-{number:05d}-{self.job}{SUFFIX}" for number in range(len(written))]
        if latest_version(system, folder) is None:
            # The folder as it lies is the first version, so that what is moved there is no part of it.
            present = system.get_file_info(fs.FileSelector(folder))
            self._publish_next(system, folder, [f.base_name for f in present if _is_data(f)], first=True)
        for path, name in zip(written, names):
            system.move(path, f"{folder}/{name}")
        kept = self._publish_next(system, folder, names)
        if self.overwrite:
            for file in system.get_file_info(fs.FileSelector(folder)):
                if _is_data(file) and file.base_name not in kept:
                    system.delete_file(file.path)
        system.delete_dir(staging)

    def _publish_next(self, system: fs.FileSystem, folder: str, names: list[str], first: bool = False) -> set[str]:
        """Publish the version after the latest; if another writer was faster, the one after that."""
        while True:
            latest = latest_version(system, folder)
            if first and latest is not None:
                return set(names)
            earlier = [] if latest is None or self.overwrite else files_of(system, folder, latest)
            try:
                publish_version(system, folder, 0 if latest is None else latest + 1, [*earlier, *names])
            except VersionTaken:
                continue
            return {*earlier, *names}

    def abort(self, messages: list[WrittenFile | None]) -> None:
        system, _, staging = self._folder()
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)
