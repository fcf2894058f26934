"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes that are not ASCII white space. Its hash is a
polynomial in per-byte constants modulo 2**64 (prefix sums give all words of
a buffer at once), scrambled together with its length; a shingle hash chains
the hashes of its words and is scrambled again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

PART_BYTES = 1 << 21
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15 | 1
_UNSTEP = pow(_STEP, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def scramble(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mixer of 64-bit values (the splitmix64 finaliser); each salt gives another order."""
    x = x + _U((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = scramble(np.arange(256, dtype=_U), 7)
_BYTE[_BLANK] = 0


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pows(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POW:
        _POW.clear()
        _POW[size] = (_powers(_STEP, size), _powers(_UNSTEP, size))
    return _POW[size]


def _hash_buffer(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word starts) of one buffer that ends in white space."""
    buf = np.frombuffer(raw, np.uint8)
    blank = _BLANK[buf]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    up, down = _pows(len(buf))
    sums = np.cumsum(_BYTE[buf] * up[: len(buf)])
    before = np.where(starts > 0, sums[starts - 1], _U(0))
    return scramble((sums[ends - 1] - before) * down[starts] + (ends - starts).astype(_U) * _U(_UNSTEP)), starts


def _parts(raw: bytes) -> list[bytes]:
    """A very long text in parts that end between words."""
    out, at = [], 0
    while len(raw) - at > 2 * PART_BYTES:
        found = np.flatnonzero(_BLANK[np.frombuffer(raw, np.uint8, PART_BYTES, at + PART_BYTES)])
        if not len(found):  # one word of megabytes: keep it whole
            break
        end = at + PART_BYTES + int(found[0])
        out.append(raw[at:end])
        at = end
    return [*out, raw[at:]]


def hashed_words(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Word hashes of each text, in order."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0

    def flush():
        nonlocal size
        if group:
            hashes, starts = _hash_buffer(b" ".join([*group, b""]))
            firsts = np.cumsum([0, *(len(g) + 1 for g in group)])
            cuts = np.searchsorted(starts, firsts)
            out.extend(hashes[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            group.clear()
            size = 0

    for t in texts:
        if len(t) > 2 * PART_BYTES:
            flush()
            out.append(np.concatenate([_hash_buffer(p + b" ")[0] for p in _parts(t)]))
            continue
        group.append(t)
        size += len(t) + 1
        if size > PART_BYTES:
            flush()
    flush()
    return out


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows; with fewer words, of the whole sequence; none without words."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    acc = np.zeros(n - width + 1, _U)
    for j in range(width):
        acc = acc * _U(0xFF51AFD7ED558CCD) + words[j : n - width + 1 + j]
    return scramble(acc, width)


def lowered(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case; a null text is empty."""
    return (text or "").encode("utf-8").lower()
