"""Notes of what is delivered, so that a task or a job that runs again sends the rest only.

A note is a small file per group of deliveries in a folder that all executors reach (a URI that Arrow
can open: a shared mount, HDFS, S3, ..). It is written under another name first and then renamed, so it
is there whole or not at all. Notes are kept by a hash of the key in ``parts`` folders, whatever
partition a batch was in; a task reads the folders of its own keys, once.

A batch is noted right after the store took it. If an executor dies between the two, up to ``group``
batches of its task are sent once more, under their idempotency keys.
"""

from __future__ import annotations

import json
import uuid
import zlib

from pyarrow import fs


class Ledger:
    def __init__(self, folder: str, parts: int = 256, group: int = 1):
        self.folder, self.parts, self.group = folder, parts, group
        self._known: dict[int, set[str]] = {}
        self._fresh: dict[int, list[str]] = {}

    def __getstate__(self) -> dict:
        # tasks start from the notes, not from what another process knew
        return {"folder": self.folder, "parts": self.parts, "group": self.group, "_known": {}, "_fresh": {}}

    def _open(self) -> tuple[fs.FileSystem, str]:
        found, path = fs.FileSystem.from_uri(self.folder)
        return found, path.rstrip("/")

    def _part(self, key: str) -> int:
        return zlib.crc32(key.encode()) % self.parts

    def __contains__(self, key: str) -> bool:
        part = self._part(key)
        if part not in self._known:
            files, path = self._open()
            self._known[part] = set()
            for info in files.get_file_info(fs.FileSelector(f"{path}/notes/{part}", allow_not_found=True)):
                if info.path.endswith(".txt"):
                    with files.open_input_stream(info.path) as note:
                        self._known[part].update(note.read().decode().splitlines())
        return key in self._known[part]

    def add(self, key: str) -> None:
        part = self._part(key)
        self._known.setdefault(part, set()).add(key)
        self._fresh.setdefault(part, []).append(key)
        if len(self._fresh[part]) >= self.group:
            self._write(f"notes/{part}", "\n".join(self._fresh.pop(part)))

    def flush(self) -> None:
        """Note what a group has not filled yet; at the end of a task."""
        for part in list(self._fresh):
            self._write(f"notes/{part}", "\n".join(self._fresh.pop(part)))

    def _write(self, folder: str, text: str) -> None:
        files, path = self._open()
        files.create_dir(f"{path}/{folder}", recursive=True)
        name = f"{path}/{folder}/{uuid.uuid4().hex}"
        with files.open_output_stream(f"{name}.tmp") as note:
            note.write(text.encode())
        files.move(f"{name}.tmp", f"{name}.txt")

    def close(self, run_id: str, state: str, trigger: int | None, batches: int, attempts: int, skipped: int) -> None:
        """The totals of a write that is committed or aborted."""
        totals = {"run_id": run_id, "state": state, "trigger": trigger, "batches": batches, "attempts": attempts, "skipped": skipped}
        self._write("writes", json.dumps(totals))

    def writes(self) -> list[dict]:
        files, path = self._open()
        infos = files.get_file_info(fs.FileSelector(f"{path}/writes", allow_not_found=True))
        return [json.loads(files.open_input_stream(i.path).read()) for i in infos if i.path.endswith(".txt")]
