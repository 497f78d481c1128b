"""Elias-Fano sequences over numpy arrays that may be memory-mapped."""

from __future__ import annotations

import numpy as np

#: Words of the upper bits between two directory entries.
STEP = 2
_ONE = np.uint64(1)
_BYTES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)


def _select_table() -> np.ndarray:
    """Place of the k-th one bit in a byte, for k below 8."""
    out = np.zeros((256, 8), dtype=np.uint8)
    for b in range(256):
        for k, place in enumerate(i for i in range(8) if b >> i & 1):
            out[b, k] = place
    return out


SELECT = _select_table()


def select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) in each 64-bit word that has more than k ones."""
    s = word - ((word >> _ONE) & np.uint64(0x5555555555555555))
    s = (s & np.uint64(0x3333333333333333)) + ((s >> np.uint64(2)) & np.uint64(0x3333333333333333))
    s = (s + (s >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)
    sums = s * _BYTES  # byte i: ones in bytes 0..i, at most 64
    # the top bit of byte i stays where at most k ones stand in bytes 0..i: no byte borrows from the next
    byte = np.bitwise_count((((k.astype(np.uint64) * _BYTES) | _TOPS) - sums) & _TOPS).astype(np.uint64) << np.uint64(3)
    before = ((sums << np.uint64(8)) >> byte) & np.uint64(255)
    return byte.astype(np.int64) + SELECT[((word >> byte) & np.uint64(255)).astype(np.int64), k - before.astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence of unsigned integers: low bits packed, high parts in
    unary.  ``arrays()`` gives the parts to store, the constructor takes them back: low and upper bits, and
    the ones and the zeros before every ``STEP``-th word of the upper bits, a directory
    from which the k-th one or zero is less than ``STEP`` words away however they are spread."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> None:
        self.n, self.width, self.low, self.high, self.ones, self.zeros = n, width, low, high, ones, zeros
        self.mask = np.uint64((1 << width) - 1)

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, int(top // max(n, 1)).bit_length() - 1)
        bits = np.zeros(n + (top >> width) + 2, dtype=np.uint8)
        bits[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, dtype=np.uint8)))
        high = packed.view(np.uint64)
        count = np.cumsum(np.concatenate(([0], np.bitwise_count(high))))[:-1:STEP].astype(np.int64)
        return cls(n, width, cls._pack(values, width), high, count, np.arange(len(count)) * (64 * STEP) - count)

    @staticmethod
    def _pack(values: np.ndarray, width: int) -> np.ndarray:
        n = len(values)
        out = np.zeros(n * width // 64 + 2, dtype=np.uint64)
        if not n or not width:
            return out
        low = values & np.uint64((1 << width) - 1)
        at = np.arange(n, dtype=np.int64) * width
        word, off = at >> 6, (at & 63).astype(np.uint64)
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[first]] = np.bitwise_or.reduceat(low << off, first)
        over = np.flatnonzero((at & 63) + width > 64)
        out[word[over] + 1] |= low[over] >> (np.uint64(64) - off[over])
        return out

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.low, self.high, self.ones, self.zeros

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * self.width
        word, off = at >> 6, (at & 63).astype(np.uint64)
        # a shift by 64 is undefined: shift by 63 - off and by one more
        return ((self.low[word] >> off) | ((self.low[word + 1] << (np.uint64(63) - off)) << _ONE)) & self.mask

    def _select(self, k: np.ndarray, before: np.ndarray, flip: np.uint64) -> np.ndarray:
        """Place of the k-th one (with ``flip`` all ones: zero) of the upper bits, from the counts before each entry."""
        entry = np.searchsorted(before, k, side="right") - 1
        word, need = entry * STEP, k - before[entry]
        cur = self.high[word] ^ flip
        count = np.bitwise_count(cur).astype(np.int64)
        todo = np.flatnonzero(count <= need)
        while len(todo):
            need[todo] -= count[todo]
            word[todo] += 1
            cur[todo] = self.high[word[todo]] ^ flip
            count[todo] = np.bitwise_count(cur[todo])
            todo = todo[count[todo] <= need[todo]]
        return word * 64 + select_in_word(cur, need)

    def zero_place(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of the upper bits."""
        return self._select(k, self.zeros, ~np.uint64(0))

    def next_zero(self, place: np.ndarray) -> np.ndarray:
        """Place of the first zero of the upper bits at or behind each place."""
        word = place >> 6
        free = ~self.high[word] >> (place & 63).astype(np.uint64)
        out = place + np.bitwise_count(~free & (free - _ONE)).astype(np.int64)  # ones before the first zero
        todo = np.flatnonzero(free == 0)
        while len(todo):
            word[todo] += 1
            free = ~self.high[word[todo]]
            out[todo] = word[todo] * 64 + np.bitwise_count(~free & (free - _ONE))
            todo = todo[free == 0]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``: the high part is where the i-th one stands."""
        place = self._select(i, self.ones, np.uint64(0))
        return ((place - i).astype(np.uint64) << np.uint64(self.width)) | self.low_bits(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value (the last one if it repeats), -1 where it does not occur: the members with the
        value's high part stand between two zeros, and the low bits are bisected among them."""
        out = np.full(len(values), -1, dtype=np.int64)
        if not self.n or not len(values):
            return out
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        last = int(self.get(np.array([self.n - 1]))[0]) >> self.width
        act = np.flatnonzero(high <= last)
        if not len(act):
            return out
        h, want = high[act], values[act] & self.mask
        start = np.zeros(len(act), dtype=np.int64)
        inner = np.flatnonzero(h > 0)
        start[inner] = self.zero_place(h[inner] - 1) + 1
        lo, hi = start - h, self.next_zero(start) - h
        first = lo.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):  # members up to ``lo`` are not greater
            mid = (lo[todo] + hi[todo]) >> 1
            under = self.low_bits(mid) <= want[todo]
            lo[todo[under]], hi[todo[~under]] = mid[under] + 1, mid[~under]
            todo = todo[lo[todo] < hi[todo]]
        hit = np.flatnonzero(lo > first)
        hit = hit[self.low_bits(lo[hit] - 1) == want[hit]]
        out[act[hit]] = lo[hit] - 1
        return out
