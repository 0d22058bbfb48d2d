"""64-bit hashes of all words of a text at once."""

from __future__ import annotations

import numpy as np

_SEGMENT = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTES = np.random.default_rng(20_240).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _powers[name] = np.cumprod(np.full(n, base, np.uint64))
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text of words with single spaces between them."""
    out, at = [], 0
    while at < len(text):
        stop = len(text)
        if stop - at > _SEGMENT:
            stop = text.rfind(b" ", at, at + _SEGMENT)
            if stop < at:
                stop = text.find(b" ", at)
                stop = len(text) if stop < 0 else stop
        raw = np.frombuffer(text, np.uint8, stop - at, at)
        up, down = _power(len(raw))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTES[raw] * up)))
        space = np.flatnonzero(raw == 32)
        starts, ends = np.concatenate(([0], space + 1)), np.concatenate((space, [len(raw)]))
        out.append(mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype("u8")))
        at = stop + 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
