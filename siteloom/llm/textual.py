"""Numbers for the white-space chunks of a text, looked up once a distinct chunk."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

from siteloom.llm.shared import MEMO_BYTES, Recent

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def code(text: str, seed: int = 0) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), seed)


class Chunks:
    """``describe(chunk)`` gives a fixed number of unsigned 64-bit integers; a text becomes a matrix of them."""

    def __init__(self, describe: Callable[[str], tuple[int, ...]], width: int, memo: int = MEMO_BYTES):
        self.width = width
        pack = struct.Struct(f"<{width}Q").pack
        self.known = Recent(lambda chunk: pack(*describe(chunk)), memo)

    def __call__(self, text: str) -> np.ndarray:
        raw = b"".join(map(self.known.__getitem__, text.split()))
        return np.frombuffer(raw, dtype="<u8").reshape(-1, self.width)


def spread(values: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every output bit depends on every input bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
