"""Binary files that tasks write and read in the folder all executors share.

A task writes a file under a name no other attempt uses and reports it in its
result rows; those rows are stored once, and only files named in the stored
rows are ever read.  A lost or repeated task leaves at worst an unread file.
"""

from __future__ import annotations

import ctypes
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from lexloom.sources.scratch import fresh_path


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-zA-Z][\w+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder for the files of one job."""
    return fresh_path(spark, name)


def write_file(folder: str, stem: str, suffix: str, content: bytes) -> str:
    """Store ``content`` under a fresh name; the returned path goes into the manifest."""
    path = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, inner = _open(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner, compression=None) as stream:
        stream.write(content)
    return path


def open_file(path: str):
    """A readable, seekable binary file."""
    system, inner = _open(path)
    return system.open_input_file(inner)


def read_file(path: str) -> bytes:
    with open_file(path) as file:
        return file.read()


def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task after which its Python worker, which goes on to others, keeps no memory it has freed."""

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
        if trim:
            trim(0)

    return run


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    That serves local sessions started from any folder; on a cluster the package is
    installed on the workers or sent with ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
