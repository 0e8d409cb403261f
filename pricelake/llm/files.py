"""Small helpers of operators that keep numpy arrays in files of their own."""

from __future__ import annotations

import os

import numpy as np
import pyarrow.fs as pafs


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a path or URI."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] of them), begin[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
