"""Word and n-gram hashes of Arrow text columns, whole batches at a time with numpy.

A word's hash mixes two polynomials over its bytes, taken from prefix sums: one modulo 2**64, one modulo the prime
2**31 - 1. Modulo a power of two alone, texts that alternate two parts in Thue-Morse order collide whatever the base; modulo
a prime they don't. An n-gram's hash is the same over its words' hashes. Both depend on content alone, so every task
computes the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_R1, _R2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BITS, _PRIME, _BASE = np.uint64(31), np.uint64((1 << 31) - 1), 1_103_515_245
_prime_powers: list[np.ndarray] = []
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pow(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    key = int(base)
    have = _powers.get(key)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        up, down = np.full(size, base, np.uint64), np.full(size, np.uint64(pow(key, -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        have = _powers[key] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have


def _reduced(x: np.ndarray) -> np.ndarray:
    """x below 2**62 modulo the prime; its bits beyond the 31st count as much as the lower ones."""
    x = (x & _PRIME) + (x >> _BITS)
    x = (x & _PRIME) + (x >> _BITS)
    x[x == _PRIME] = 0
    return x


def _pow_prime(n: int) -> list[np.ndarray]:
    """The base's powers i and -i modulo the prime for i < n."""
    if not _prime_powers or len(_prime_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _prime_powers.clear()
        for b in (_BASE, pow(_BASE, -1, int(_PRIME))):
            run, m = np.ones(size, np.uint64), 1
            while m < size:  # what is known, times the next power, doubles it
                run[m : 2 * m] = run[:m] * np.uint64(pow(b, m, int(_PRIME))) % _PRIME
                m *= 2
            _prime_powers.append(run)
    return _prime_powers


def _runs(values: np.ndarray, small: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of the runs start:end of values, which may be any 64-bit words; small: values modulo the prime."""
    n = len(values)
    up, down = _pow(base, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=sums[1:])
    out = (sums[end] - sums[start]) * down[start]
    up, down = _pow_prime(n + 1)
    np.cumsum(_reduced(small * up[:n]), out=sums[1:])
    return out ^ mix(_reduced(_reduced(sums[end] - sums[start]) * down[start]))


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def chunks(batch: pa.RecordBatch, *texts: str, limit: int = 1 << 20):
    """Slices of a batch of about limit bytes of its texts together (the columns named, else text), one row at least."""
    size = np.zeros(batch.num_rows + 1, np.int64)
    for text in texts or ("text",):
        column = batch.column(batch.schema.get_field_index(text))
        size[1:] += np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, size[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words of a text column. first[i]:first[i + 1] are the words of row i; hashes has one value a word."""

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_string())
        n = len(column)
        if column.null_count:
            column = column.fill_null("")
        column = pa.concat_arrays([column]) if column.offset == 0 else pa.array(column.to_pylist(), pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1) if n else np.zeros(1, np.int64)
        raw = column.buffers()[2] if n else None
        self.data = np.frombuffer(raw, np.uint8)[: offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        inside = ~_SPACE[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[offsets] = True
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(inside):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.begin = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.begin, offsets)
        codes = _byte_codes(lower)
        self.hashes = mix(_runs(codes[self.data], (codes % _PRIME)[self.data], self.begin, self.end, _R1) + (self.end - self.begin).astype(np.uint64))
        self._small = None
        self.count = np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def grams(self, k: int, base: np.uint64 = _R2) -> tuple[np.ndarray, np.ndarray]:
        """Start (index of its first word) and hash of every run of k words of one row."""
        total = len(self.hashes)
        if total < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start = np.flatnonzero(np.repeat(self.first[1:], self.count) - np.arange(total) >= k)
        return start, self.spans(start, start + k, base)

    def spans(self, start: np.ndarray, end: np.ndarray, base: np.uint64 = _R2) -> np.ndarray:
        """Hashes of the word runs start:end."""
        if self._small is None:
            self._small = self.hashes % _PRIME
        return mix(_runs(self.hashes, self._small, start, end, base) + (end - start).astype(np.uint64) * _R1)
