"""Resolve a path or URI to a ``pyarrow.fs`` filesystem inside a task."""

from __future__ import annotations

# Hadoop-style object-store schemes that pyarrow knows as plain s3
_S3_ALIASES = ("s3a://", "s3n://")


def normalize_uri(uri: str) -> str:
    for alias in _S3_ALIASES:
        if uri.startswith(alias):
            return "s3://" + uri[len(alias):]
    if uri.startswith("file:") and not uri.startswith("file://"):
        return "file://" + uri[len("file:"):]
    return uri


def open_fs(uri: str, cache: dict | None = None):
    """``(filesystem, path)`` for ``uri``; plain paths are local files.
    Filesystems are cached per scheme and authority when ``cache`` is given."""
    from pyarrow import fs as pafs

    uri = normalize_uri(uri)
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    key = (scheme, rest.split("/", 1)[0])
    if cache is not None and key in cache:
        fs = cache[key]
        _, path = pafs.FileSystem.from_uri(uri) if scheme != "file" else (None, "/" + rest.lstrip("/"))
        return fs, path
    fs, path = pafs.FileSystem.from_uri(uri)
    if cache is not None:
        cache[key] = fs
    return fs, path
