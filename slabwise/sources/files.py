"""Ranged reads and atomic writes on any file system pyarrow knows."""

from __future__ import annotations

import fnmatch
import os
import uuid
from urllib.parse import urlparse

from pyarrow import fs

from slabwise.schema import CorruptFile

READ_AHEAD = 8 * 1024 * 1024
FIRST_READ = 64 * 1024


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a local path or a ``scheme://`` URI."""
    parts = urlparse(path)
    if not parts.scheme:
        return fs.LocalFileSystem(), path
    if parts.scheme == "file":
        return fs.LocalFileSystem(), "/" + path.split(":", 1)[1].lstrip("/")
    scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
    system, _ = fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}/")
    inner = parts.path if scheme == "hdfs" else parts.netloc + parts.path
    return system, inner


def is_file(path: str) -> bool:
    system, inner = file_system(path)
    return system.get_file_info(inner).type == fs.FileType.File


def list_paths(path: str, suffixes: tuple[str, ...]) -> list[tuple[str, int]]:
    """``(path, size)`` of a file, of a glob in the last path part, or of a folder."""
    system, inner = file_system(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    folder, pattern = (inner, None) if info.type == fs.FileType.Directory else os.path.split(inner)
    found = []
    for item in system.get_file_info(fs.FileSelector(folder, recursive=pattern is None, allow_not_found=True)):
        if item.type != fs.FileType.File or item.base_name.startswith((".", "_")):
            continue
        if pattern is not None and not fnmatch.fnmatch(item.base_name, pattern):
            continue
        if pattern is None and not item.base_name.lower().endswith(suffixes):
            continue
        found.append((prefix + item.path, item.size))
    if not found:
        raise FileNotFoundError(path)
    return sorted(found)


class RangedFile:
    """Random access with adaptive read-ahead.

    Jumps (headers, index nodes) fetch little; a forward run of neighbouring
    slabs doubles the fetch up to the limit, so it costs few requests.
    """

    def __init__(self, path: str, ahead: int = READ_AHEAD):
        system, inner = file_system(path)
        self.path = path
        self._file = system.open_input_file(inner)
        self.size = self._file.size()
        self._limit, self._ahead = ahead, FIRST_READ
        self._start, self._block = 0, b""

    def read(self, offset: int, length: int) -> memoryview:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise CorruptFile(f"{self.path}: bytes {offset}+{length} lie beyond {self.size}")
        at = offset - self._start
        if at < 0 or at + length > len(self._block):
            forward = 0 <= at <= len(self._block) + self._ahead
            self._ahead = min(self._ahead * 2, self._limit) if forward else FIRST_READ
            want = min(max(length, self._ahead), self.size - offset)
            self._block = self._file.read_at(want, offset)
            self._start, at = offset, 0
        return memoryview(self._block)[at : at + length]

    def close(self) -> None:
        self._file.close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def write_atomic(path: str, chunks) -> None:
    """Write byte chunks under a temporary name, then move into place.

    A retried or speculative task repeats the same final name and the same
    bytes, so a lost executor leaves no torn or doubled file.
    """
    system, inner = file_system(path)
    folder, name = os.path.split(inner)
    system.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    with system.open_output_stream(temporary) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(temporary, inner)


def write_new(path: str, data: bytes) -> None:
    """Make a file that was not there, whole and at once; ``FileExistsError`` if it was.

    Local folders and HDFS refuse a second file of the name by themselves.  An object store
    does not, so two writers at the same moment are not told apart there.
    """
    system, inner = file_system(path)
    folder, name = os.path.split(inner)
    system.create_dir(folder, recursive=True)
    if system.get_file_info(inner).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    with system.open_output_stream(temporary) as out:
        out.write(data)
    if not isinstance(system, fs.LocalFileSystem):
        system.move(temporary, inner)
        return
    try:
        os.link(temporary, inner)
    finally:
        os.unlink(temporary)
