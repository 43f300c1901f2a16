"""Vectorised words and hashes of many texts at once (numpy over their joined UTF-8 bytes)."""

from __future__ import annotations

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 9, 10, 11, 12, 13]] = True
#: everything in ASCII but letters and digits
NOT_WORD = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R^0..R^n and the inverses, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        size = 1 << int(n).bit_length()
        with np.errstate(over="ignore"):
            for i, r in enumerate((_R, _R_INV)):
                x = np.full(size + 1, r, np.uint64)
                x[0] = 1
                _POWERS[i] = np.multiply.accumulate(x)
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by a blank; first byte of each text, and the end."""
    flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return flat, np.concatenate([[0], ends])


def word_hashes(flat: np.ndarray, starts: np.ndarray, blank: np.ndarray, stems: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, and each text's first word (and the end).  With ``stems`` each
    word is followed by the hashes of its first so many bytes, where it is longer."""
    edge = np.flatnonzero(np.diff(blank[flat].view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    a, z = edge[0::2], edge[1::2]
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    up, down = powers(len(flat))
    with np.errstate(over="ignore"):
        run = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[: len(flat)], out=run[1:])
        words = mixed((run[z] - run[a]) * down[a])
        if stems:
            order, more = [np.arange(len(a))], [words]
            for n in stems:
                longer = np.flatnonzero(z - a > n)
                order.append(longer)
                more.append(mixed((run[a[longer] + n] - run[a[longer]]) * down[a[longer]] + np.uint64(n)))
            place = np.concatenate(order)
            at = np.argsort(place, kind="stable")
            words, a = np.concatenate(more)[at], a[place[at]]
    return words, np.searchsorted(a, starts)


def slices(column, max_rows: int = 1024, max_bytes: int = 1 << 20):
    """Bounded runs of rows of an Arrow text column: (first row, UTF-8 texts); null is empty.  A text
    of more than ``max_bytes`` is a run of its own."""
    out, first, size = [], 0, 0
    for i, t in enumerate(column):
        t = t.as_py()
        raw = t.encode() if t else b""
        if out and len(raw) > max_bytes:
            yield first, out
            out, first, size = [], i, 0
        out.append(raw)
        size += len(raw)
        if len(out) >= max_rows or size >= max_bytes:
            yield first, out
            out, first, size = [], i + 1, 0
    if out:
        yield first, out
