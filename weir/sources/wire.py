"""Files of wire rows: a Python data source that writes and reads length-prefixed rows by destination.

Each task writes a file of its own under a pending name; the driver's commit gives it its name, an abort takes it away,
so readers never see the rows of a failed job. Paths are any that Arrow's file systems know and all executors share.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "destination_id string, row_bytes binary"
_PENDING, _SUFFIX = ".pending", ".rows"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite = path, overwrite

    def write(self, rows: Iterator) -> _Written:
        store, root = _open(self.path)
        name, n = uuid.uuid4().hex, 0
        file = None
        for destination, row in rows:
            if file is None:
                store.create_dir(root, recursive=True)
                file = store.open_output_stream(f"{root}/{name}{_PENDING}")
            own = destination.encode()
            file.write(struct.pack("<I", len(own)) + own + struct.pack("<I", len(row)) + bytes(row))
            n += 1
        if file is None:
            return _Written(None, 0)
        file.close()
        return _Written(name, n)

    def commit(self, messages: list) -> None:
        store, root = _open(self.path)
        if self.overwrite and store.get_file_info(root).type == fs.FileType.Directory:
            for info in store.get_file_info(fs.FileSelector(root)):
                if info.path.endswith(_SUFFIX):
                    store.delete_file(info.path)
        for m in messages:
            if m is not None and m.name is not None:
                store.move(f"{root}/{m.name}{_PENDING}", f"{root}/{m.name}{_SUFFIX}")

    def abort(self, messages: list) -> None:
        store, root = _open(self.path)
        for m in messages:
            if m is not None and m.name is not None:
                store.delete_file(f"{root}/{m.name}{_PENDING}")


class _StreamWriter(DataSourceStreamWriter):
    """Files of a batch carry its number: one that is committed again replaces them."""

    def __init__(self, path: str):
        self.writer = _Writer(path)

    def write(self, rows: Iterator) -> _Written:
        return self.writer.write(rows)

    def commit(self, messages: list, batchId: int) -> None:
        store, root = _open(self.writer.path)
        if store.get_file_info(root).type == fs.FileType.Directory:
            for info in store.get_file_info(fs.FileSelector(root)):
                if info.base_name.startswith(f"{batchId}-") and info.path.endswith(_SUFFIX):
                    store.delete_file(info.path)
        for m in messages:
            if m is not None and m.name is not None:
                store.move(f"{root}/{m.name}{_PENDING}", f"{root}/{batchId}-{m.name}{_SUFFIX}")

    def abort(self, messages: list, batchId: int) -> None:
        self.writer.abort(messages)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        store, root = _open(self.path)
        return [_File(i.path) for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.path.endswith(_SUFFIX)]

    def read(self, partition: _File) -> Iterator[tuple[str, bytes]]:
        store, _ = _open(self.path)
        with store.open_input_stream(partition.path) as file:
            while head := file.read(4):
                destination = file.read(struct.unpack("<I", head)[0]).decode()
                yield destination, file.read(struct.unpack("<I", file.read(4))[0])


class WireRows(DataSource):
    """format("weir_rows").option("path", folder), for batches and as a stream's sink."""

    @classmethod
    def name(cls) -> str:
        return "weir_rows"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], overwrite)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(self.options["path"])
