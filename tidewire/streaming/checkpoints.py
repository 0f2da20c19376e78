"""Saved positions of incremental batch reads: a JSON file per table, moved in two steps.

A reading task stages its new position next to the file once its stream has ended; the driver promotes it only after
the whole action has succeeded. Any path with a scheme goes through the filesystem of that scheme.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from typing import Any

KINDS = ("cursor", "offset", "timestamp")


class Store:
    """The position of one table below a folder."""

    def __init__(self, folder: str, table: str):
        if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", folder):
            from pyarrow import fs

            self.fs, self.folder = fs.FileSystem.from_uri(folder)
        else:
            self.fs, self.folder = None, folder
        self.table = table
        self.path = f"{self.folder.rstrip('/')}/{table}.checkpoint.json"

    def _read(self, path: str) -> str | None:
        try:
            if self.fs is None:
                with open(path, encoding="utf-8") as f:
                    return f.read()
            with self.fs.open_input_stream(path) as f:
                return f.read().decode()
        except (OSError, UnicodeDecodeError):
            return None

    def _write(self, path: str, text: str) -> None:
        if self.fs is None:
            os.makedirs(self.folder, exist_ok=True)
            with open(path, "w", encoding="utf-8") as f:
                f.write(text)
            return
        self.fs.create_dir(self.folder, recursive=True)
        with self.fs.open_output_stream(path) as f:
            f.write(text.encode())

    def load(self, kind: str) -> str | None:
        """The saved position, if there is one of this kind; a file that can't be read is none."""
        text = self._read(self.path)
        try:
            found: Any = json.loads(text) if text else None
        except ValueError:
            return None
        if isinstance(found, dict) and found.get("type") == kind and isinstance(found.get("value"), (str, int)):
            return str(found["value"])
        return None

    def stage(self, kind: str, value: str) -> None:
        self._write(f"{self.path}.{uuid.uuid4().hex}.staged", json.dumps({"type": kind, "value": value}))

    def _staged(self) -> list[str]:
        head = f"{self.table}.checkpoint.json."
        if self.fs is None:
            names = os.listdir(self.folder) if os.path.isdir(self.folder) else []
            found = [os.path.join(self.folder, n) for n in names if n.startswith(head) and n.endswith(".staged")]
            return sorted(found, key=os.path.getmtime)
        from pyarrow import fs

        infos = self.fs.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return [i.path for i in sorted(infos, key=lambda i: i.mtime) if os.path.basename(i.path).startswith(head) and i.path.endswith(".staged")]

    def promote(self) -> bool:
        """Makes the last staged position the saved one. Returns whether there was one."""
        staged = self._staged()
        if staged:
            text = self._read(staged[-1])
            new = f"{self.path}.new"
            self._write(new, text)
            if self.fs is None:
                os.replace(new, self.path)
            else:
                self.fs.move(new, self.path)
        self.discard()
        return bool(staged)

    def discard(self) -> None:
        for path in self._staged():
            if self.fs is None:
                os.remove(path)
            else:
                self.fs.delete_file(path)
