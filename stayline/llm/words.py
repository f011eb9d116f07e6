"""Words and shingles of one text as numpy arrays of 64-bit hashes.

A word's hash comes from prefix sums of ``value[byte] * base**position``, so that one vectorised pass over the bytes
hashes every word of a text however many there are. Hashes depend on the word alone, not on where it stands.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_rng = np.random.default_rng(20240607)
VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
# A-Z take the value of a-z, nothing else is folded
VALUES[65:91] = VALUES[97:123]
STEPS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

# words `[^\x20\x09-\x0D]+`: everything but the six ASCII white-space characters
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
# words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of the lower-cased text: ASCII letters, digits and all beyond ASCII
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers: dict[str, np.ndarray] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i up to n; grown by doubling and kept by the worker."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = 1 << max(16, (n + 1).bit_length())
        for name, base in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(raw: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = kind[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def hashes(text: str | bytes | None, kind: np.ndarray = SPACED) -> np.ndarray:
    """The hash of each word of a text, in order; A-Z equal a-z. No text gives no words."""
    data = text.encode() if isinstance(text, str) else text
    if not data:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    starts, ends = spans(raw, kind)
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _table(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(VALUES[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def stems(text: bytes, kind: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of the first bytes of longer words: the hash, the number of the word, the size (0: whole)."""
    raw = np.frombuffer(text, np.uint8)
    starts, ends = spans(raw, kind)
    up, down = _table(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(VALUES[raw] * up[: len(raw)], out=sums[1:])
    found, of, length = [], [], []
    for size in (0, *sizes):
        at = np.arange(len(starts)) if not size else np.flatnonzero(ends - starts > size)
        end = ends[at] if not size else starts[at] + size
        found.append((sums[end] - sums[starts[at]]) * down[starts[at]] + STEPS[size])
        of.append(at)
        length.append(np.full(len(at), size))
    return mix(np.concatenate(found)), np.concatenate(of), np.concatenate(length)


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words, in order."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * STEPS[0]
    for i in range(1, width):
        total += words[i : i + n] * STEPS[i]
    return mix(total)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of the runs of ``width`` words, sorted; a shorter text is one run, an empty one has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < width:
        return windows(words, len(words)) ^ np.uint64(len(words))
    return np.unique(windows(words, width))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value of an Arrow column; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def word_hash(word: str) -> np.uint64:
    """The hash that a single word has in any text."""
    return hashes(word, np.ones(256, bool))[0]


def long_lists(parts: list[np.ndarray]) -> pa.Array:
    """One list of longs for each array (the bits of unsigned numbers are kept)."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64)))
