"""Single files on whatever file system their address names, as seen from Python workers."""

from __future__ import annotations

import gzip
import io
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

#: Where Arrow writes files; addresses of other file systems are left to Spark.
ARROW_SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "gs", "abfs", "abfss")


def opened(path: str):
    """A readable binary file. Plain and file: paths are local or mounted; addresses such as hdfs:// and s3:// go to Arrow."""
    local = re.sub("^file:(//)?", "", path)
    if "://" not in local:
        return open(local, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


@contextmanager
def created(root: str, name: str) -> Iterator:
    """A binary file ``name`` below ``root``, which gets this name once it is whole and replaces one that a lost task left."""
    local = re.sub("^file:(//)?", "", root)
    if "://" not in local:
        target = f"{local}/{name}"
        folder, _, last = target.rpartition("/")
        os.makedirs(folder, exist_ok=True)
        beside = f"{folder}/.{uuid.uuid4().hex}"  # hidden from readers
        try:
            with open(beside, "wb") as f:
                yield f
            os.replace(beside, target)
        except BaseException:
            if os.path.exists(beside):
                os.remove(beside)
            raise
        return
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    system.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{base}/{name}", compression=None) as f:
        yield f


def open_text(path: str) -> io.TextIOBase:
    """The lines of a text file, which may be compressed by gzip."""
    raw = opened(path)
    return gzip.open(raw, "rt", encoding="utf-8") if path.endswith(".gz") else io.TextIOWrapper(raw, encoding="utf-8")


def size_of(path: str) -> int:
    with opened(path) as f:
        return f.seek(0, os.SEEK_END) or f.tell()
