"""Spans of one byte buffer: hashing and comparing many at once."""

from __future__ import annotations

import numpy as np

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    )
)
#: The lowest n bytes of a word, for n from 0 to 8.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Buffer:
    """Bytes, and the eight bytes from each place on as a little-endian number."""

    def __init__(self, data: bytes):
        padded = data + bytes(8)
        self.bytes = np.frombuffer(padded, np.uint8)
        self.eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxhash64(buffer: Buffer, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of each span; spans of 32 bytes and more go to the library one by one."""
    h = _P5 + size.astype(np.uint64)
    eight = size >> 3
    for i in range(3):
        live = np.flatnonzero(eight > i)
        if len(live):
            word = _rotl(buffer.eights[start[live] + 8 * i] * _P2, 31) * _P1
            h[live] = _rotl(h[live] ^ word, 27) * _P1 + _P4
    place, rest = start + (size & ~7), size & 7
    live = np.flatnonzero(rest >= 4)
    if len(live):
        word = (buffer.eights[place[live]] & _LOW[4]) * _P1
        h[live] = _rotl(h[live] ^ word, 23) * _P2 + _P3
        place[live] += 4
    rest = rest & 3
    for i in range(3):
        live = np.flatnonzero(rest > i)
        if len(live):
            byte = buffer.bytes[place[live] + i].astype(np.uint64) * _P5
            h[live] = _rotl(h[live] ^ byte, 11) * _P1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    long = np.flatnonzero(size >= 32)
    if len(long):
        import xxhash

        for i in long.tolist():
            span = buffer.bytes[start[i] : start[i] + size[i]]
            h[i] = xxhash.xxh64_intdigest(span.tobytes())
    return h


def same_bytes(a: Buffer, a_start: np.ndarray, b: Buffer, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether pairs of spans of one size hold the same bytes."""
    same = np.ones(len(size), bool)
    live, done = np.arange(len(size)), 0
    while len(live):
        differ = a.eights[a_start[live] + done] ^ b.eights[b_start[live] + done]
        differ &= _LOW[np.minimum(size[live] - done, 8)]
        same[live] = differ == 0
        done += 8
        live = live[(differ == 0) & (size[live] > done)]
    return same
