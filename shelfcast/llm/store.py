"""Arrays in the shared folder, written once by tasks and memory-mapped by workers."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs

_copies: dict[str, str] = {}


def _local(folder: str) -> str | None:
    """The path of a folder that is mounted here, or None for a store without one."""
    parsed = urlparse(folder)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array under a name. A second attempt of a task replaces the same file whole."""
    path = _local(folder)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            np.save(file, array)
        os.replace(draft, f"{path}/{name}.npy")
        return
    store, path = fs.FileSystem.from_uri(folder)
    content = io.BytesIO()
    np.save(content, array)
    with store.open_output_stream(f"{path}/{name}.npy") as file:
        file.write(content.getbuffer())


def load(folder: str, name: str) -> np.ndarray:
    """Map an array into memory: from the mounted folder, or from one copy for each worker, which
    goes when the worker ends."""
    path = _local(folder)
    if path is None:
        if folder not in _copies:
            _copies[folder] = tempfile.mkdtemp(prefix="arrays-")
            atexit.register(shutil.rmtree, _copies[folder], ignore_errors=True)
        path = _copies[folder]
        if not os.path.exists(f"{path}/{name}.npy"):
            store, source = fs.FileSystem.from_uri(folder)
            with store.open_input_stream(f"{source}/{name}.npy") as file, open(f"{path}/{name}.part", "wb") as copy:
                shutil.copyfileobj(file, copy)
            os.replace(f"{path}/{name}.part", f"{path}/{name}.npy")
    return np.load(f"{path}/{name}.npy", mmap_mode="r")
