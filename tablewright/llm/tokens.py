"""Words of texts as 64-bit hashes, by whole arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tablewright.llm.common import mix64

#: Bytes handled at once; single longer texts are handled alone.
CHUNK_BYTES = 250_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_OFFSETS = 1 << 16


def _constants() -> tuple[np.ndarray, np.ndarray]:
    signs = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    powers = np.empty(_OFFSETS, np.uint64)
    powers[0] = 1
    powers[1:] = np.uint64(0xD1342543DE82EF95)
    return signs, np.multiply.accumulate(powers)


_SIGNS, _POWERS = _constants()


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about CHUNK_BYTES in all."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of bytes that end in white space, and where each word begins."""
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64), begin
    length = end - begin
    inside = np.flatnonzero(~space)
    first_byte = np.cumsum(length) - length
    offset = np.arange(len(inside), dtype=np.uint32) - np.repeat(first_byte.astype(np.uint32), length)
    value = np.take(_SIGNS, np.take(data, inside))
    if length.max() < _OFFSETS:
        value *= np.take(_POWERS, offset)
    else:  # beyond the table the powers recur, each time with another sum
        value = value * _POWERS[offset & np.uint32(_OFFSETS - 1)] + (offset >> np.uint32(16)).astype(np.uint64)
    return mix64(np.add.reduceat(value, first_byte) + length.astype(np.uint64)), begin


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about CHUNK_BYTES of bytes that end in white space, each up to and with a white space."""
    start = 0
    while start < len(data):
        stop = start + CHUNK_BYTES
        while stop < len(data) and not (near := _IS_SPACE[data[stop - 1 : stop + 4095]]).any():
            stop += len(near)
        stop = min(len(data), stop + int(near.argmax())) if stop < len(data) else len(data)
        yield start, stop
        start = stop


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of UTF-8 texts (A-Z lowered, cut at ASCII white space), and where each text's words begin and end.

    The texts are taken piece by piece: a byte needs some 30 bytes while its word is hashed, a word 16 after that.
    """
    data = np.frombuffer(b"\n".join(texts).translate(_LOWER) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    parts = []
    for start, stop in _pieces(data):
        hashes, begin = _hashed(data[start:stop])
        parts.append((hashes, begin + start))
    hashes, begin = (parts[0] if len(parts) == 1 else (np.concatenate(x) for x in zip(*parts)))
    return hashes, np.concatenate([[0], np.searchsorted(begin, ends)])
