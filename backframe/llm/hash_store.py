"""Sorted hash arrays in the shared folder, written by tasks and memory-mapped by workers.

Keys are unsigned 64-bit hashes. A shard holds one range of them, in order, beside its columns; every
array is a file of its own. Workers map what they ask for, so the arrays take page cache, not memory.
"""

from __future__ import annotations

import io
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key: equal ranges of the hash."""
    return ((keys >> np.uint64(33)) * np.uint64(shards) >> np.uint64(31)).astype(np.int64)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of unsigned numbers, their bytes by significance, compressed."""
    out = []
    for column in columns:
        own = narrow(column)
        planes = own.view(np.uint8).reshape(-1, own.itemsize).T.tobytes() if len(own) else b""
        body = pa.compress(planes, "zstd", asbytes=True)
        out += [np.array([len(own), own.itemsize, len(body)], "<u8").tobytes(), body]
    return b"".join(out)


def unpacked(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n, width, size = (int(x) for x in np.frombuffer(blob, "<u8", 3, at))
        planes = pa.decompress(blob[at + 24 : at + 24 + size], n * width, "zstd", asbytes=True)
        own = np.frombuffer(planes, np.uint8).reshape(width, n).T
        out.append(np.ascontiguousarray(own).view(f"<u{width}").ravel().astype(np.uint64))
        at += 24 + size
    return out


def write_shard(folder: str, shard: int, columns: dict[str, np.ndarray]) -> None:
    """Put the arrays of a shard in place; a repeated task puts the same ones there again."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    for name, column in columns.items():
        body = io.BytesIO()
        np.save(body, column)
        part = f"{path}/part-{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(body.getbuffer())
        store.move(part, f"{path}/{shard}-{name}.npy")


def mapped(folder: str, shard: int, name: str) -> np.ndarray | None:
    """The array, mapped where the shared folder is mounted, else from a nameless local copy."""
    store, path = fs.FileSystem.from_uri(folder)
    full = f"{path}/{shard}-{name}.npy"
    if store.get_file_info(full).type == fs.FileType.NotFound:
        return None
    if isinstance(store, fs.LocalFileSystem):
        return np.load(full, mmap_mode="r")
    with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(full) as body:
        shutil.copyfileobj(body, copy)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")


def look_up(folder: str, shards: int, keys: np.ndarray, names: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Whether each of the sorted ``keys`` is stored, and its columns, 0 where it is not."""
    found = np.zeros(len(keys), bool)
    out = {name: np.zeros(len(keys), np.int64) for name in names}
    edges = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(edges)):
        a, b = edges[shard], edges[shard + 1]
        stored = mapped(folder, int(shard), "keys")
        if stored is None or not len(stored):
            continue
        own = keys[a:b]
        at = np.minimum(np.searchsorted(stored, own), len(stored) - 1)
        hit = np.flatnonzero(stored[at] == own)
        found[a + hit] = True
        for name in names:
            out[name][a + hit] = mapped(folder, int(shard), name)[at[hit]]
    return found, out
