"""Files of arrays in the shared folder, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import os
import shutil
import struct
import tempfile
import uuid

import numpy as np
from pyarrow import fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_arrays(root: str, kind: str, arrays: list[np.ndarray]) -> str:
    """One file: number of arrays, their byte sizes, then the arrays, each 8-byte aligned. A name no two attempts share."""
    fs, folder = open_fs(root)
    name = f"{kind}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{folder}/{name}") as f:
        f.write(struct.pack(f"<{len(arrays) + 1}Q", len(arrays), *[a.nbytes for a in arrays]))
        for a in arrays:
            f.write(a.tobytes())
            f.write(b"\0" * (-a.nbytes % 8))
    return name


def map_arrays(root: str, name: str, kinds: list[str]) -> list[np.ndarray]:
    """The file's arrays, memory-mapped; from a store without paths, by a local copy that its mapping alone keeps."""
    fs, folder = open_fs(root)
    path, copied = f"{folder}/{name}", None
    if not isinstance(fs, pafs.LocalFileSystem):
        handle, copied = tempfile.mkstemp(prefix="model-")
        with fs.open_input_stream(path) as src, os.fdopen(handle, "wb") as out:
            shutil.copyfileobj(src, out)
        path = copied
    raw = np.memmap(path, dtype=np.uint8, mode="r")
    if copied:
        os.unlink(copied)
    count = int(raw[:8].view("<u8")[0])
    sizes = raw[8 : 8 + 8 * count].view("<u8").astype(int).tolist()
    at, out = 8 + 8 * count, []
    for size, kind in zip(sizes, kinds):
        out.append(raw[at : at + size].view(kind))
        at += size + -size % 8
    return out
