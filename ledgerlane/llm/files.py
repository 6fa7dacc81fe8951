"""Files in the shared folder, from the driver and from tasks: local, HDFS or object store alike."""

from __future__ import annotations

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path on it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_bytes(uri: str, data: bytes) -> None:
    where, path = located(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    with where.open_output_stream(path) as f:
        f.write(data)
