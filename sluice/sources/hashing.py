"""Hashing files of any size in executor tasks, chunk by chunk."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa

CHUNK_BYTES = 8 << 20


def open_for_reading(path: str):
    """A stream over a file's bytes in an executor: local and mounted files
    by their path, others through pyarrow's file systems."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else path, "rb")
    from pyarrow import fs

    scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
    system, inside = fs.FileSystem.from_uri(parts._replace(scheme=scheme).geturl())
    return system.open_input_stream(inside)


def sha256_of(stream, chunk: int = CHUNK_BYTES) -> str:
    """SHA-256 of a stream, read in chunks."""
    digest = hashlib.sha256()
    while data := stream.read(chunk):
        digest.update(data)
    return digest.hexdigest()


def hash_in_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, _hash, read_error) of files given by path and file_path."""
    for files in batches:
        out = []
        for path, encoded in zip(files.column("path").to_pylist(), files.column("file_path").to_pylist()):
            try:
                with open_for_reading(encoded) as stream:
                    out.append((path, sha256_of(stream), None))
            except Exception as error:  # of this file: it becomes its row
                out.append((path, None, f"{type(error).__name__}: {error}"))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["path", "_hash", "read_error"])
