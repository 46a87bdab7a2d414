"""Files that tasks write and read themselves, on whatever store the folder's path names."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from freightlens.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, not made yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    files, at = store(path)
    files.create_dir(at, recursive=True)


def make_file(folder: str, name: str):
    """A new output stream, and its path. Every attempt of a task writes a file of its own
    name, so that a lost executor leaves at most a file that no list of results names."""
    files, at = store(folder)
    files.create_dir(at, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    return files.open_output_stream(f"{at}/{name}", buffer_size=1 << 20), f"{folder}/{name}"


def open_file(path: str):
    files, at = store(path)
    return files.open_input_file(at)
