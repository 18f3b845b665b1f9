"""Sorted arrays of 64-bit keys with small integer columns, written once and memory-mapped.

A file holds [n, columns], the keys in order, and per column one byte a key; 255 refers to a
list of (position, value) for larger values. Workers map files from the shared folder; a
folder that is not mounted is copied once per worker machine's process first.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs

ESCAPE = 255


def put(folder: str, name: str, keys: np.ndarray, columns: list[np.ndarray]) -> None:
    """Write a file; a repeated attempt of the same task writes the same and replaces it."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(np.array([len(keys), len(columns)], np.int64).tobytes())
        out.write(keys.astype(np.uint64).tobytes())
        for column in columns:
            large = np.flatnonzero(column >= ESCAPE)
            out.write(np.array([len(large)], np.int64).tobytes())
            out.write(large.astype(np.int64).tobytes())
            out.write(column[large].astype(np.int64).tobytes())
            small = np.minimum(column, ESCAPE).astype(np.uint8).tobytes()
            out.write(small + bytes(-len(small) % 8))
    store.move(draft, f"{path}/{name}")


class Mapped:
    """One file, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, count = raw[:16].view(np.int64)
        self.keys = raw[16 : 16 + 8 * n].view(np.uint64)
        at, self.columns = 16 + 8 * n, []
        for _ in range(count):
            m = int(raw[at : at + 8].view(np.int64)[0])
            at += 8
            large = raw[at : at + 8 * m].view(np.int64)
            values = raw[at + 8 * m : at + 16 * m].view(np.int64)
            at += 16 * m
            self.columns.append((raw[at : at + n], large, values))
            at += n + (-n % 8)

    def find(self, wanted: np.ndarray) -> list[np.ndarray]:
        """Each column's values of the wanted keys, 0 where a key is absent."""
        out = [np.zeros(len(wanted), np.int64) for _ in self.columns]
        if not len(self.keys):
            return out
        place = np.searchsorted(self.keys, wanted)
        place[place == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[place] == wanted)
        place = place[hit]
        for got, (small, large, values) in zip(out, self.columns, strict=True):
            found = small[place].astype(np.int64)
            high = np.flatnonzero(found == ESCAPE)
            found[high] = values[np.searchsorted(large, place[high])]
            got[hit] = found
        return out


class Store:
    """The files of a folder by name; opened when first asked for."""

    def __init__(self, folder: str):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.local = self.path if isinstance(self.store, fs.LocalFileSystem) else None
        self.open: dict[str, Mapped | None] = {}

    def get(self, name: str) -> Mapped | None:
        if name not in self.open:
            if self.store.get_file_info(f"{self.path}/{name}").type == fs.FileType.NotFound:
                self.open[name] = None
            else:
                if self.local is None:
                    self.local = tempfile.mkdtemp(prefix="starmill-arrays-")
                path = f"{self.local}/{name}"
                if not os.path.exists(path):
                    fs.copy_files(
                        f"{self.path}/{name}", path,
                        source_filesystem=self.store, destination_filesystem=fs.LocalFileSystem(),
                    )
                self.open[name] = Mapped(path)
        return self.open[name]
