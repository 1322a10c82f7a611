"""Counting quotient filters of packed n-grams: exact, sorted and compact counters that merge.

An n-gram of word ids is packed into n * bits bits, kept as two halves (high, low). A Feistel network permutes the
packed values invertibly, so that they spread evenly whatever the ids are and nothing is lost. A filter holds the
entries in order of the permuted value: the leading bits (the quotient) only as a bitmap of occupied quotients and a
bit at the end of each quotient's run, the rest (the full remainder) as bytes, and the count as a bit where it is 1, else
as a byte more, or nine where it is 255 and above.
"""

from __future__ import annotations

import struct

import numpy as np

#: Round constants of the permutation (fixed values: multiples of the golden ratio's 64-bit fraction).
_ROUNDS = [np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for k in range(1, 5)]
_HEADER = struct.Struct("<BBBBQQ")
#: Bits of a packed n-gram at most; each half must fit into 63.
MOST_BITS = 126


def halves(n: int, bits: int) -> tuple[int, int]:
    """Widths of the halves of a packed n-gram."""
    if n < 2 or n * bits > MOST_BITS:
        raise ValueError(f"{n} ids of {bits} bits cannot be packed into {MOST_BITS} bits")
    return n * bits - n * bits // 2, n * bits // 2


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def pack(columns: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(high, low) of the n-grams whose k-th ids are ``columns[k]``."""
    _, w2 = halves(len(columns), bits)
    high, low = (np.zeros(len(columns[0]), np.uint64) for _ in range(2))
    for ids in columns:
        high = high << _u(bits) | low >> _u(w2 - bits)
        low = (low & _mask(w2 - bits)) << _u(bits) | ids.astype(np.uint64)
    return high, low


def unpack(high: np.ndarray, low: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    """The columns of ids that ``pack`` was given."""
    _, w2 = halves(n, bits)
    columns = []
    for _ in range(n):
        columns.append((low & _mask(bits)).astype(np.int64))
        low = low >> _u(bits) | (high & _mask(bits)) << _u(w2 - bits)
        high = high >> _u(bits)
    return columns[::-1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _u(30)) * _u(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _u(27)) * _u(0x94D049BB133111EB)
    return x ^ x >> _u(31)


def permute(high: np.ndarray, low: np.ndarray, n: int, bits: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The permuted halves, or with ``back`` the halves that were permuted."""
    w1, w2 = halves(n, bits)
    for r in range(len(_ROUNDS))[::-1 if back else 1]:
        if r % 2:
            low = low ^ _mix(high + _ROUNDS[r]) & _mask(w2)
        else:
            high = high ^ _mix(low + _ROUNDS[r]) & _mask(w1)
    return high, low


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values and the sums of their counts (1 each without ``counts``)."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])[:len(high)])
    if counts is None:
        sums = np.diff(np.append(first, len(high)))
    else:
        sums = np.add.reduceat(counts[order], first) if len(first) else counts
    return high[first], low[first], sums.astype(np.int64)


def encode(high: np.ndarray, low: np.ndarray, counts: np.ndarray, n: int, bits: int, prefix: int = 0) -> bytes:
    """The filter of sorted distinct permuted values that agree in their first ``prefix`` bits."""
    w1, w2 = halves(n, bits)
    q = min(w1 - prefix, len(high).bit_length())
    rest = w1 - prefix - q
    start = int(high[0]) >> (w1 - prefix) if len(high) else 0
    quotient = (high >> _u(rest) & _mask(q)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)[:len(high)]
    over = high & _mask(rest)
    words = np.stack([low | over << _u(w2), over >> _u(64 - w2)], axis=1).astype("<u8")
    remainder = words.view(np.uint8).reshape(len(high), 16)[:, :-(-(rest + w2) // 8)]
    several, large = counts > 1, counts[counts >= 255].astype("<i8")
    return b"".join([_HEADER.pack(n, bits, prefix, q, start, len(high)), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
                     np.ascontiguousarray(remainder).tobytes(), np.packbits(several).tobytes(), np.minimum(counts[several], 255).astype(np.uint8).tobytes(), large.tobytes()])


def shape(data: bytes) -> tuple[int, int, int]:
    """(n, bits, prefix) of a filter."""
    return _HEADER.unpack_from(data)[:3]


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted permuted values of a filter and their counts."""
    n, bits, prefix, q, start, entries = _HEADER.unpack_from(data)
    w1, w2 = halves(n, bits)
    rest = w1 - prefix - q
    raw, at = np.frombuffer(data, np.uint8), _HEADER.size

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size:at]

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
    run_end = np.unpackbits(take(-(-entries // 8)), count=entries)
    size = -(-(rest + w2) // 8)
    remainder = np.zeros((entries, 16), np.uint8)
    remainder[:, :size] = take(entries * size).reshape(entries, size)
    several = np.unpackbits(take(-(-entries // 8)), count=entries).astype(bool)
    more = take(int(several.sum())).astype(np.int64)
    more[more == 255] = np.frombuffer(data, "<i8", offset=at)
    counts = np.ones(entries, np.int64)
    counts[several] = more
    words = remainder.view("<u8").astype(np.uint64)
    quotient = occupied[np.cumsum(run_end) - run_end].astype(np.uint64)
    over = words[:, 0] >> _u(w2) | words[:, 1] << _u(64 - w2)
    high = _u(start << (w1 - prefix)) | quotient << _u(rest) | over & _mask(rest)
    return high, words[:, 0] & _mask(w2), counts


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of all ``filters`` (of one shape) with summed counts."""
    parts = list(map(decode, filters))
    return counted(*(np.concatenate([p[k] for p in parts]) for k in range(3)))


def split(high: np.ndarray, low: np.ndarray, counts: np.ndarray, n: int, bits: int, prefix: int, more: int) -> list[tuple[int, bytes]]:
    """(leading bits, filter) of the values that agree in their first ``prefix`` bits, by ``more`` further bits as far as there are."""
    if not len(high):
        return []
    prefix = min(prefix + more, halves(n, bits)[0])
    lead = (high >> _u(halves(n, bits)[0] - prefix)).astype(np.int64)
    edges = np.flatnonzero(np.append(True, lead[1:] != lead[:-1]))[:len(lead)].tolist()
    return [(int(lead[a]), encode(high[a:b], low[a:b], counts[a:b], n, bits, prefix)) for a, b in zip(edges, [*edges[1:], len(lead)], strict=True)]
