"""Access to files from tasks, on any file system that Arrow can open (local, HDFS, object stores)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyarrow import fs as pafs

CHUNK_BYTES = 8 << 20


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and the path in it; a path without scheme is local."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def read_complete(
    path: str, start: int, end: int, consume: Callable[[bytes, int], tuple[object, int]], chunk_bytes: int = CHUNK_BYTES
) -> Iterator[object]:
    """Hands on what ``consume(bytes, offset)`` makes of the range, a chunk at a time.

    ``consume`` returns its result and how many bytes it used. What is left over goes in front of the next
    chunk; a record longer than a chunk makes the chunk grow. An unfinished record at the end is left out.
    """
    system, name = locate(path)
    with system.open_input_file(name) as source:
        source.seek(start)
        at, held, step = start, b"", chunk_bytes
        while True:
            more = source.read(max(0, min(step, end - at - len(held))))
            if not more:
                return
            held += more
            result, used = consume(held, at)
            if used:
                yield result
                at += used
                held = held[used:]
                step = chunk_bytes
            else:
                step *= 2
