"""Files that tasks write and read beside Spark's own tables, through the store's own protocol."""

from __future__ import annotations

import pyarrow.fs as pafs


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of ``uri`` (``file:``, ``hdfs:``, ``s3:``, ...; a bare path is local)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def publish(uri: str, temporary: str) -> None:
    """Give a file its final name once it is whole; attempts of a task write the same bytes."""
    fs, target = opened(uri)
    _, source = opened(temporary)
    fs.move(source, target)
