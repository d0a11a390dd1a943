"""File access inside tasks, through Arrow's filesystems."""

import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs

LOCAL = fs.LocalFileSystem()

# Where bytes lie: pieces of files, in order. A negative length means up to the end.
SEGMENTS = "array<struct<file:string,offset:bigint,length:bigint>>"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and the path inside it, for a plain path or any URI Arrow knows."""
    if path.startswith("file:"):
        return LOCAL, re.sub(r"^file:/+", "/", path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return LOCAL, path


def join_path(root: str, rel: str) -> str:
    if not root or rel.startswith("/") or "://" in rel:
        return rel
    return f"{root.rstrip('/')}/{rel}" if rel else root


class SegmentReader:
    """Reads byte ranges and keeps the last file open, as neighbours share archives."""

    def __init__(self, root: str) -> None:
        self._root, self._path, self._file = root, None, None

    def _open(self, path: str):
        if path != self._path:
            files, inner = open_fs(join_path(self._root, path))
            self._file, self._path = files.open_input_file(inner), path
        return self._file

    def read(self, segments) -> bytes | None:
        """The bytes, or None if a file is missing, unreadable or too short."""
        out = []
        for seg in segments if segments is not None else []:
            try:
                f = self._open(seg["file"])
                offset, length = int(seg["offset"]), int(seg["length"])
                length = length if length >= 0 else f.size() - offset
                data = f.read_at(length, offset)
            except OSError:
                return None
            if len(data) != length:
                return None
            out.append(data)
        return b"".join(out)


def batches_of(rows: Iterator[tuple], columns: list[str], max_bytes: int = 16 << 20) -> Iterator[pd.DataFrame]:
    """Rows that end in their bytes, in frames of bounded size."""
    batch, size = [], 0
    for row in rows:
        batch.append(row)
        size += 512 + len(row[-1] or b"")
        if size >= max_bytes:
            yield pd.DataFrame(batch, columns=columns)
            batch, size = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=columns)
