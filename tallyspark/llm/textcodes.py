"""64-bit codes of words and word shingles, computed on whole batches of text
with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Text bytes hashed at a time (a piece ends at white space; a longer word makes a longer piece).
PIECE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_MUL1, _MUL2, _STEP = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MUL1
        x = (x ^ (x >> np.uint64(27))) * _MUL2
        return x ^ (x >> np.uint64(31))


def _weights(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and codes of the words of ``data``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero(~_SPACE[raw])
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)  # in ``at``
    length = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        codes = np.add.reduceat((_LOWER[raw[at]] + np.uint64(1)) * _weights(int(length.max()))[place], first)
        return at[first], mix(codes + length.astype(np.uint64) * _STEP)


def word_codes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words (A-Z lower-cased) of ``texts`` in order, and the
    number of words of each text. Null texts have none."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(b) + 1 for b in encoded]) if encoded else np.empty(0, np.int64)
    starts, codes, offset = [], [], 0
    for piece in _pieces(b"\n".join(encoded) + b"\n"):
        s, c = _hash_words(piece)
        starts.append(s + offset)
        codes.append(c)
        offset += len(piece)
    all_starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
    counts = np.diff(np.searchsorted(all_starts, ends), prepend=0)
    return (np.concatenate(codes) if codes else np.empty(0, np.uint64)), counts


def sequence_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """Code of every run of ``width`` words of one array."""
    n = len(codes) - width + 1
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(width) * _STEP, dtype=np.uint64)
        for i, w in enumerate(_weights(width)):
            total += codes[i:i + n] * w
    return mix(total)


def shingle_sets(texts: list, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle codes of each text; with fewer words than
    ``width`` the whole sequence is one, without words there is none."""
    codes, counts = word_codes(texts)
    out, at = [], 0
    for n in counts.tolist():
        own = codes[at:at + n]
        at += n
        out.append(np.unique(sequence_codes(own, min(width, n))) if n else np.empty(0, np.uint64))
    return out


def chunks(pdf, limit: int = 4 << 20) -> Iterator:
    """Row blocks of a pandas frame with about ``limit`` characters of text."""
    sizes = pdf["text"].str.len().fillna(0).to_numpy().cumsum() // limit
    for _, block in pdf.groupby(sizes, sort=False):
        yield block
