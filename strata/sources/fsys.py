"""File systems by URI, for the file work that tasks do through ``pyarrow.fs``.

A path keeps the scheme and authority of the root it was listed under, so the
paths that tasks report are paths Spark can read.
"""

from __future__ import annotations

# Scheme names of one store: Hadoop's on the left, pyarrow's on the right.
_SAME_STORE = {"s3a": "s3", "s3n": "s3", "gs": "gs"}


def is_local(uri: str) -> bool:
    return uri.startswith("file:") or "://" not in uri


def resolve(uri: str):
    """(file system, path in it) of a URI."""
    import pyarrow.fs as pafs

    if is_local(uri):
        path = uri[len("file:"):] if uri.startswith("file:") else uri
        return pafs.LocalFileSystem(), "/" + path.lstrip("/") if path.startswith("//") else path
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{_SAME_STORE.get(scheme, scheme)}://{rest}")


def with_root(root: str, path: str) -> str:
    """The URI of ``path``, a path of the file system that ``root`` resolves to."""
    if is_local(root):
        return "file:" + path
    scheme, rest = root.split("://", 1)
    if path.startswith("/"):  # a file system with a host in front, such as hdfs
        return f"{scheme}://{rest.split('/', 1)[0]}{path}"
    return f"{scheme}://{path}"  # a store whose paths begin with the bucket
