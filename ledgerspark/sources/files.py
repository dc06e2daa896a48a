"""File-level helpers: extract predicates (SRC12) and path I/O for Python-side readers.

Python code that must read or write file bytes itself (workbooks, CSV heads)
goes through ``open_input`` / ``open_output`` / ``list_paths``: local paths
(``/x`` or ``file:/x``) use the OS directly, other schemes (``hdfs://``,
``s3a://`` …) go through ``pyarrow.fs``, so the same code runs on a cluster.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Predicates the portals applied when the extracts were requested.
MOVEMENTS_SINCE = "2000-01-01"
REGISTRY_TAG = "NEGATIVADO"


def extract_movements(movements: DataFrame, since: str = MOVEMENTS_SINCE) -> DataFrame:
    """SRC12: movements dated on/after ``since`` (reaches the scan as a pushed filter)."""
    return movements.where(F.col("data_hora") >= F.lit(since).cast("timestamp_ntz"))


def extract_registry(registry: DataFrame, tag: str = REGISTRY_TAG, column: str = "tag") -> DataFrame:
    """SRC12: registry rows carrying ``tag``."""
    return registry.where(F.col(column) == F.lit(tag))


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    return path if "://" not in path else None


def _arrow_fs(path: str):
    from pyarrow import fs

    uri = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    return fs.FileSystem.from_uri(uri)


def open_input(path: str):
    """A seekable binary reader for ``path``."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    filesystem, inner = _arrow_fs(path)
    return filesystem.open_input_file(inner)


def open_output(path: str):
    """A binary writer for ``path`` (parent folders created where the file system has them)."""
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local) or ".", exist_ok=True)
        return open(local, "wb")
    filesystem, inner = _arrow_fs(path)
    return filesystem.open_output_stream(inner)


def list_paths(path: str, suffix: str) -> list[str]:
    """Files under ``path`` (or ``path`` itself) whose name ends with ``suffix``, sorted."""
    def keep(name: str) -> bool:
        base = name.rsplit("/", 1)[-1]
        return base.lower().endswith(suffix) and not base.startswith(("~$", ".", "_"))

    local = _local(path)
    if local is not None:
        if os.path.isdir(local):
            return sorted(os.path.join(d, f) for d, _, fs_ in os.walk(local) for f in fs_ if keep(f))
        return [local]
    from pyarrow import fs

    filesystem, inner = _arrow_fs(path)
    info = filesystem.get_file_info(inner)
    scheme = path.split("://", 1)[0]
    if info.type == fs.FileType.Directory:
        found = filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
        return sorted(f"{scheme}://{f.path}" for f in found if f.type == fs.FileType.File and keep(f.path))
    return [path]


def move(src: str, dst: str) -> None:
    """Rename ``src`` to ``dst`` (replacing it): atomic on local and HDFS-like file systems."""
    local_src, local_dst = _local(src), _local(dst)
    if local_src is not None and local_dst is not None:
        os.replace(local_src, local_dst)
        return
    filesystem, inner_src = _arrow_fs(src)
    _, inner_dst = _arrow_fs(dst)
    filesystem.move(inner_src, inner_dst)


def list_entries(folder: str, recursive: bool) -> list[tuple[str, int, int]]:
    """``path, length, modification time in nanoseconds`` of the files in ``folder``; none if it is absent."""
    local = _local(folder)
    if local is not None:
        found = []
        for d, subfolders, names in os.walk(local):
            for name in names:
                path = os.path.join(d, name)
                try:
                    info = os.stat(path)
                except FileNotFoundError:  # gone since it was listed
                    continue
                found.append((path, info.st_size, info.st_mtime_ns))
            if not recursive:
                subfolders.clear()
        return found
    from pyarrow import fs

    filesystem, inner = _arrow_fs(folder)
    scheme = folder.split("://", 1)[0]
    infos = filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=recursive))
    return [(f"{scheme}://{f.path}", f.size, f.mtime_ns or 0) for f in infos if f.type == fs.FileType.File]


def names_in(folder: str) -> list[str]:
    """Names of the files directly in ``folder``; none if it is absent."""
    return [path.rsplit("/", 1)[-1] for path, _, _ in list_entries(folder, recursive=False)]


def replace_text(path: str, text: str) -> None:
    """Write a small text file whole: under another name first, then moved into place."""
    with open_output(f"{path}.part") as f:
        f.write(text.encode())
    move(f"{path}.part", path)


def remove(path: str) -> None:
    """Delete one file; an absent one is no error."""
    local = _local(path)
    if local is not None:
        if os.path.exists(local):
            os.remove(local)
        return
    filesystem, inner = _arrow_fs(path)
    try:
        filesystem.delete_file(inner)
    except FileNotFoundError:
        pass
