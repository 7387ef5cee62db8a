"""Files that tasks write to and read from the shared folder themselves, through pyarrow's file systems.

What a later pass reads again is not sent through a shuffle a second time: a shuffle carries only where it lies. A task
writes one file, under a name of the attempt, so a task that is run again leaves whole files and tells its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs

READ = 4 << 20  # bytes read at once


def open_uri(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, path in it) of a path or URI."""
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pyarrow.fs.LocalFileSystem(), uri)


class Blobs:
    """One file of a task in a folder: `add` gives back where the bytes lie."""

    def __init__(self, folder: str):
        self.file, self.at, self.out = f"{folder}/{uuid.uuid4().hex}", 0, None

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None:
            fs, there = open_uri(self.file)
            fs.create_dir(there.rsplit("/", 1)[0], recursive=True)
            self.out = fs.open_output_stream(there)
        self.out.write(data)
        at, self.at = self.at, self.at + len(data)
        return self.file, at, len(data)


@contextmanager
def blobs(folder: str) -> Iterator[Blobs]:
    made = Blobs(folder)
    try:
        yield made
    finally:
        if made.out is not None:
            made.out.close()


def read_blob(file: str, at: int, size: int) -> bytes:
    fs, there = open_uri(file)
    with fs.open_input_file(there) as source:
        return source.read_at(size, at)


def read_many(places: list[tuple[str, int, int]], gap: int = 1 << 16) -> Iterator[bytes]:
    """What lies at some places (file, at, size), in their order. A file is opened once for a run of places in it, and places
    with at most `gap` bytes between them are read at once."""
    i = 0
    while i < len(places):
        stop = i + 1
        while stop < len(places) and places[stop][0] == places[i][0]:
            stop += 1
        fs, there = open_uri(places[i][0])
        with fs.open_input_file(there) as source:
            while i < stop:
                to, start = i + 1, places[i][1]
                end = start + places[i][2]
                while to < stop and start <= places[to][1] <= end + gap and end - start < READ:
                    end = max(end, places[to][1] + places[to][2])
                    to += 1
                data = source.read_at(end - start, start)
                for _, at, size in places[i:to]:
                    yield data[at - start : at - start + size]
                i = to
