"""Counts of converted values, written by tasks into a folder that they share with the driver, on any file system."""

from __future__ import annotations

import json
import os
import random
import tempfile
import uuid
from collections.abc import Iterator

from pyarrow import fs


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, such as file:, hdfs: or s3:, and the path on it."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if ":" in folder.partition("/")[0] else (fs.LocalFileSystem(), folder)


def new_folder(shared: str | None) -> str:
    """A new folder below the shared one; of this machine where none is set, as in tests."""
    if not shared:
        return tempfile.mkdtemp(prefix="tidewire-metrics-")
    folder = f"{shared.rstrip('/')}/tidewire-metrics-{uuid.uuid4().hex[:12]}"
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    return folder


def write(folder: str, counts: dict) -> None:
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/{os.getpid()}-{random.getrandbits(48):012x}.json") as f:
        f.write(json.dumps(counts).encode())


def read(folder: str) -> Iterator[dict]:
    files, path = _open(folder)
    for info in files.get_file_info(fs.FileSelector(path)):
        if info.path.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                yield json.loads(f.read())


def drop(folder: str) -> None:
    files, path = _open(folder)
    files.delete_dir(path)
