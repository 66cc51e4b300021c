"""Binary files in the folder that executors share.

Spark has no writer for free-form binary files, so tasks write them through ``pyarrow.fs`` by the folder's URI (local
and mounted paths, HDFS, S3, GCS). A task names its file anew at each attempt and reports it in its result rows; only
names in the committed result count, so a lost or repeated attempt leaves at most a file that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(folder: str, stem: str, suffix: str) -> Iterator[tuple[str, object]]:
    """A file of a fresh name and its URI."""
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, path = resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield uri, out


@contextmanager
def opened(uri: str) -> Iterator[object]:
    """A file for reading at any offset."""
    system, path = resolve(uri)
    with system.open_input_file(path) as source:
        yield source
