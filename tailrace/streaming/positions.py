"""What a tail has seen of a log, as an offset that stays small.

A position is a map from files to (bytes, first bytes, time of the last change). An offset holds what changed lately in
itself and names parts, written once next to the log, that hold the rest; so it does not grow with the number of files.
When too much has changed, that becomes a part, and parts of similar size are merged. An offset can be read again
as long as its parts are there: they may be deleted once no checkpoint names them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs as pafs

from tailrace.sources.files import locate
from tailrace.sources.listing import LogFile, full_path

FOLDER = ".offsets"
MOST_CHANGED = 256
_HEAD_BYTES = 32
_GROWTH = 4

Entry = list  # bytes (-1: gone), first bytes in hex, time of the last change
GONE = -1


class Positions:
    def __init__(self, root: str, view: str, topic_dirs: bool, most_changed: int = MOST_CHANGED):
        """``view`` tells apart readers of one log that see other files of it."""
        self.root, self.topic_dirs, self.most_changed = root, topic_dirs, most_changed
        self.system, path = locate(root)
        self.folder = f"{path}/{FOLDER}/{hashlib.sha256(view.encode()).hexdigest()[:16]}"
        self.parts: list[list] | None = None  # name and number of entries of each part in use
        self._loaded: dict[str, dict[str, Entry]] = {}
        self._touched: dict[str, Entry] = {}

    # --- offsets to positions

    def files(self, offset: dict) -> dict[str, Entry]:
        """The position an offset stands for. Offsets of earlier versions are plain maps from file to bytes."""
        if "parts" not in offset:
            return {f: [n, "", 0] for f, n in offset.items()}
        out: dict[str, Entry] = {}
        for name, _ in offset["parts"]:
            out |= self._part(name)
        return {f: e for f, e in (out | offset["changed"]).items() if e[0] != GONE}

    def _part(self, name: str) -> dict[str, Entry]:
        if name not in self._loaded:
            with self.system.open_input_stream(f"{self.folder}/{name}") as source:
                self._loaded[name] = json.loads(source.read())
        return self._loaded[name]

    # --- listings to offsets

    def offset(self, listed: list[LogFile]) -> dict:
        """The offset of what is there now."""
        if self.parts is None:
            self.parts = self._newest()
        base: dict[str, Entry] = {}
        for name, _ in self.parts:
            base |= self._part(name)
        now = self._entries(listed, base)
        changed = {f: e for f, e in now.items() if base.get(f) != e}
        changed |= {f: [GONE, "", 0] for f, e in base.items() if f not in now and e[0] != GONE}
        if len(changed) > self.most_changed and self._add_part(changed):
            changed = {}
        return {"parts": self.parts, "changed": changed}

    def _entries(self, listed: list[LogFile], base: dict[str, Entry]) -> dict[str, Entry]:
        """Entries of the files, reading the first bytes of those that were changed since ``base``."""

        def entry(f: LogFile) -> tuple[str, Entry]:
            key = f"{f.topic}/{f.name}" if self.topic_dirs else f.name
            before, read = base.get(key), self._touched.get(key)
            if before is not None and (before[0], before[2]) == (f.size, f.changed):
                return key, before
            if read is None or (read[0], read[2]) != (f.size, f.changed):
                read = self._touched[key] = [f.size, "" if f.changed == 0 else self._head(f), f.changed]
            return key, before if before is not None and before[:2] == read[:2] else read  # touched, but the same

        with ThreadPoolExecutor(32) as pool:
            return dict(pool.map(entry, listed))

    def _head(self, f: LogFile) -> str:
        try:
            with self.system.open_input_file(locate(full_path(self.root, f.topic, f.physical, self.topic_dirs))[1]) as source:
                return source.read(min(_HEAD_BYTES, f.size)).hex()
        except FileNotFoundError:
            return ""

    # --- parts

    def _newest(self) -> list[list]:
        try:
            with self.system.open_input_stream(f"{self.folder}/newest") as source:
                return json.loads(source.read())
        except (FileNotFoundError, OSError):
            return []

    def _add_part(self, changed: dict[str, Entry]) -> bool:
        parts, entries = list(self.parts), changed
        while parts and parts[-1][1] < _GROWTH * len(entries):
            entries = self._part(parts.pop()[0]) | entries
        if not parts:
            entries = {f: e for f, e in entries.items() if e[0] != GONE}
        text = json.dumps(entries, sort_keys=True)
        name = hashlib.sha256(text.encode()).hexdigest()[:32]
        try:
            self.system.create_dir(self.folder, recursive=True)
            self._put(name, text)
            self._put("newest", json.dumps([*parts, [name, len(entries)]]))
        except OSError:  # a log one may only read: the offset itself holds everything
            return False
        self.parts = [*parts, [name, len(entries)]]
        self._loaded[name] = entries
        self._touched.clear()
        return True

    def _put(self, name: str, text: str) -> None:
        hidden = f"{self.folder}/.{uuid.uuid4().hex}"
        with self.system.open_output_stream(hidden) as out:
            out.write(text.encode())
        self.system.move(hidden, f"{self.folder}/{name}")


def replaced(before: Entry, now: Entry) -> bool:
    """Whether a file is another one than before: shorter, or with other first bytes."""
    return now[0] < before[0] or not now[1].startswith(before[1])
