"""An adaptive range coder for token ids that mixes predictions of orders 0 to 2.

Ids are cut into blocks that are coded independently: every block starts with
empty models of orders 1 and 2, so any block can be decoded by itself.  For the
next id, order 2 names the id that last followed the two ids before it, order 1
the one that last followed the id before it (both with a small confidence
count), and order 0 has a share for every id: the shares of all ids of the
blocks' file row (:class:`Shares`), which the row holds once, or, without a row,
falling by rank, as vocabularies number frequent ids first.  The three are mixed
into one probability interval: the shares of the order-2 id, of the order-1 id
and of all others adapt separately for each pair of confidences, and where orders
1 and 2 name the same id their shares are one.

Python would be far too slow id by id, so the blocks of a batch are coded in
step: place ``t`` of all blocks at once, with numpy arrays of one entry per
block (a *lane*).  All arithmetic is on integers, so coder and decoder agree on
every machine.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK_IDS = 1024
LANES = 8192
MAX_ID = (1 << 16) - 1

_ONE_BITS = 12
_ONE = 1 << _ONE_BITS
_ORDER = 10  # log2 of a lane's table of predictions of one order
_GAIN = np.int32(_ONE - 15)  # so shares come up to _ONE - 15, and down to 15
_HIT = np.int32(MAX_ID + 1)  # in order 0: what order 1 or 2 has named
_ALL_BITS = 18
_ALL = 1 << _ALL_BITS
_WORD = np.uint64(1 << 32)
_LOW = np.uint64((1 << 32) - 1)
_32 = np.uint64(32)
_AT_ONCE = 64  # blocks copied at once into or out of the lanes


class Shares:
    """Order 0: a share of ``_ALL`` for each id that occurs, at least one unit."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.int64)
        used = counts > 0
        size = used + counts * (_ALL - int(used.sum())) // max(int(counts.sum()), 1)
        size[int(np.argmax(counts))] += _ALL - int(size.sum())
        self._set(size)

    def _set(self, size: np.ndarray) -> None:
        self.size = size.astype(np.uint32)
        self.start = (np.cumsum(size) - size).astype(np.uint32)
        self.ids = np.repeat(np.arange(len(size), dtype=np.uint16), size)  # the id of every unit
        # start and size in one word, so that looking both up is one access; hits of orders 1 and 2 take the whole
        self.both = np.append((self.start.astype(np.uint64) << _32) | self.size, np.uint64(1))

    def find(self, ids: np.ndarray):
        """Start and size of the ids' shares (of ``_HIT``: 0 and 1)."""
        both = self.both.take(ids)
        start = both >> _32
        both &= _LOW
        return start, both

    @classmethod
    def of(cls, ids: np.ndarray) -> Shares:
        return cls(np.bincount(ids, minlength=MAX_ID + 1))

    @classmethod
    def read(cls, data: bytes) -> Shares:
        raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(6, -1)
        size = np.zeros(MAX_ID + 1, np.int64)
        size[np.cumsum(_joined(raw[:2], "<u2"))] = _joined(raw[2:], "<u4")
        out = cls.__new__(cls)
        out._set(size)
        return out

    def written(self) -> bytes:
        used = np.flatnonzero(self.size)
        planes = [_planes(np.diff(used, prepend=0), "<u2"), _planes(self.size[used], "<u4")]
        return zlib.compress(np.concatenate(planes).tobytes())


def _planes(values: np.ndarray, kind: str) -> np.ndarray:
    """The values' bytes by place: all lowest bytes first."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1).T


def _joined(planes: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1).astype(np.int64)


_BY_RANK = Shares((1 << 32) // (np.arange(MAX_ID + 1) + 64))


class _Models:
    """The models of ``lanes`` blocks, all at the same place.

    An entry of the prediction tables is an id and, in its lowest two bits, its
    confidence (all zero: nothing predicted); arrays have a row for order 1 and
    one for order 2.  The shares of orders 2 and 1 are one word (zero for what
    isn't asked), and all lanes' words of a state lie together.  As hits can't be
    foreseen, every lane takes the same steps, with factors 0 and 1 for what is a
    hit or a miss.
    """

    def __init__(self, lanes: int):
        self.lanes, self.lane = np.int32(lanes), np.arange(lanes, dtype=np.int32)
        first = self.lane.astype(np.uint32) << np.uint32(_ORDER + 1)
        self.base = np.stack([first, first + np.uint32(1 << _ORDER)])
        self.table = np.zeros(lanes << (_ORDER + 1), np.int32)
        share2, share1 = np.linspace(200, 3400, 4).astype(np.int32), np.linspace(100, 2400, 4).astype(np.int32)
        share2[0] = share1[0] = 0
        asked1 = share1[:, None] * np.array([1, 0], np.int32)  # not where both orders name one id
        self.shares = np.repeat(((share2[:, None, None] << 16) | asked1).ravel(), lanes)
        self.before = np.zeros(lanes, np.uint32)
        self.last = np.zeros(lanes, np.uint32)

    def predict(self, n: int) -> None:
        """Predictions and shares for the first ``n`` lanes."""
        key = np.empty((2, n), np.uint32)  # only the low bits of these count
        np.multiply(self.last[:n], np.uint32(40503), out=key[0])
        np.multiply(self.before[:n], np.uint32(31153), out=key[1])
        key[1] += key[0]
        key[0] >>= np.uint32(5)
        key[1] >>= np.uint32(6)
        key &= np.uint32((1 << _ORDER) - 1)
        key += self.base[:, :n]
        self.at = key.astype(np.int64)
        self.e = self.table.take(self.at)
        self.c = self.e & 3
        c1, c2 = self.c
        self.named = self.c > 0
        state = c2 << 2
        state += c1
        state <<= 1
        state += ((self.e[0] ^ self.e[1]) < 4) & self.named[1]
        state *= self.lanes
        state += self.lane[:n]
        self.state = state.astype(np.int64)
        self.s1 = self.shares.take(self.state)
        self.f2 = self.s1 >> 16
        self.s1 &= 0xFFFF
        self.f1 = _ONE - self.f2
        self.f1 *= self.s1
        self.f1 >>= _ONE_BITS
        np.maximum(self.f1, self.s1 > 0, out=self.f1)
        self.f21 = self.f2 + self.f1

    def learn(self, n: int, ids: np.ndarray, fresh: np.ndarray, right: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Takes in the ids; ``fresh`` are their entries, ``right`` says which predictions name them."""
        s1 = hit1 * _GAIN
        s1 += 15
        s1 -= self.s1
        s1 >>= 4
        s1 *= ~hit2  # order 1 wasn't asked
        s1 += self.s1
        s2 = hit2 * _GAIN
        s2 += 15
        s2 -= self.f2
        s2 >>= 4
        s2 += self.f2
        s2 <<= 16
        s2 |= s1
        self.shares[self.state] = s2
        new = self.e + right  # a step up or down, with 3 the highest
        new += right & (self.c < 3)
        new -= 1
        new -= fresh
        new *= (self.c > 1) | right
        new += fresh
        self.table[self.at.ravel()] = new.ravel()
        self.before[:n] = self.last[:n]
        self.last[:n] = ids

    def shares_of(self, hit2: np.ndarray, hit1: np.ndarray):
        """Start and size of the share of each lane's case (order 2, order 1, or neither), and which is neither."""
        miss = ~(hit2 | hit1)
        start = self.f2 * ~hit2
        start += self.f1 * miss
        size = _ONE - self.f21
        size *= miss
        size += self.f1 * hit1
        size += self.f2 * hit2
        return start.astype(np.uint64), size.astype(np.uint64), miss


def _widths(lengths: np.ndarray):
    """Lanes in use at each place; ``lengths`` is descending."""
    return np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right").tolist()


def _narrow(lo: np.ndarray, sp: np.ndarray):
    """Lanes whose interval is narrower than a word, and their low ends; these move up by one word."""
    k = (sp < _WORD).nonzero()[0]
    a, s = lo.take(k), sp.take(k)
    apart = (a ^ (a + s)) >= _WORD
    np.copyto(s, (~a + np.uint64(1)) & _LOW, where=apart)
    lo[k] = a << _32
    sp[k] = s << _32
    return k, a


def encode_blocks(blocks: list[np.ndarray], shares: Shares | None = None) -> list[bytes]:
    """The code of each block of ids (at most ``MAX_ID``; not empty). ``shares`` must have all of them."""
    shares = shares or _BY_RANK
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    lengths = np.array([len(blocks[i]) for i in order], np.int64)
    lanes = len(blocks)
    ids = np.zeros((lengths[0] if lanes else 0, lanes), np.uint16)
    for a in range(0, lanes, _AT_ONCE):
        some = [blocks[i] for i in order[a : a + _AT_ONCE]]
        if len(some[0]) == len(some[-1]):
            ids[: len(some[0]), a : a + len(some)] = np.stack(some, axis=1)
        else:
            for lane, block in enumerate(some, a):
                ids[: len(block), lane] = block
    m = _Models(lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    words, of_lane = [], []  # as they leave

    with np.errstate(over="ignore"):
        for t, n in enumerate(_widths(lengths)):
            x, lo, sp = ids[t, :n].astype(np.int32), low[:n], span[:n]
            m.predict(n)
            fresh = (x << 2) | 1
            right = (m.e ^ fresh) < 4
            hit1, hit2 = right & m.named
            hit1 = hit1 > hit2  # order 1 isn't asked if order 2 names the same id
            start, size, miss = m.shares_of(hit2, hit1)
            r = sp >> np.uint64(_ONE_BITS)
            start *= r
            lo += start
            size *= r
            start, r = shares.find(np.maximum(x, ~miss * _HIT))
            size >>= miss * np.uint64(_ALL_BITS)
            start *= size
            lo += start
            np.multiply(r, size, out=sp)
            k, a = _narrow(lo, sp)
            words.append((a >> _32).astype("<u4"))
            of_lane.append(k.astype(np.min_scalar_type(lanes)))
            m.learn(n, x, fresh, right, hit2, hit1)
        last = (low + _LOW) >> _32  # the one value of the interval that ends in 32 zero bits
    words.append(last.astype("<u4"))
    of_lane.append(np.arange(lanes, dtype=np.min_scalar_type(lanes)))
    of_lane = np.concatenate(of_lane)
    out = np.concatenate(words)[np.argsort(of_lane, kind="stable")].tobytes()
    upto = 4 * np.cumsum(np.bincount(of_lane, minlength=lanes))
    codes: list[bytes] = [b""] * lanes
    for i, a, b in zip(order.tolist(), [0, *upto.tolist()], upto.tolist()):
        codes[i] = out[a:b]
    return codes


def decode_blocks(codes: list[bytes], sizes: list[int], shares: Shares | None = None) -> list[np.ndarray]:
    """The ids of each block, from its code, its number of ids and the shares that it was coded with."""
    shares = shares or _BY_RANK
    sizes_ = np.asarray(sizes, np.int64)
    order = np.argsort(-sizes_, kind="stable")
    lengths = sizes_[order]
    lanes = len(codes)
    # A code ends in 32 zero bits, which aren't written.
    words = np.frombuffer(bytes(4).join([*(codes[i] for i in order), b""]), "<u4")
    upto = np.cumsum([0, *(len(codes[i]) // 4 + 1 for i in order)])
    at, end = upto[:-1] + 2, len(words) - 1
    ids = np.zeros((lengths[0] if lanes else 0, lanes), np.uint16)
    m = _Models(lanes)
    # ``gap`` is the code minus the interval's low end.
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    gap = (words[at - 2].astype(np.uint64) << _32) | words[at - 1]

    with np.errstate(over="ignore"):
        for t, n in enumerate(_widths(lengths)):
            lo, sp, g = low[:n], span[:n], gap[:n]
            m.predict(n)
            r = sp >> np.uint64(_ONE_BITS)
            hit2 = g < m.f2.astype(np.uint64) * r
            hit1 = (g < m.f21.astype(np.uint64) * r) > hit2
            start, size, miss = m.shares_of(hit2, hit1)
            start *= r
            lo += start
            g -= start
            size *= r
            size >>= miss * np.uint64(_ALL_BITS)
            x = shares.ids.take(np.minimum(g // size, np.uint64(_ALL - 1)).view(np.int64)).astype(np.int32)
            start, r = shares.find(np.maximum(x, ~miss * _HIT))
            start *= size
            lo += start
            g -= start
            np.multiply(r, size, out=sp)
            k, _ = _narrow(lo, sp)
            next_ = at.take(k)
            g[k] = (g.take(k) << _32) | words.take(np.minimum(next_, end))
            next_ += 1
            at[k] = next_
            x *= miss
            x += (m.e[0] >> 2) * hit1
            x += (m.e[1] >> 2) * hit2
            ids[t, :n] = x
            fresh = (x << 2) | 1
            m.learn(n, x, fresh, (m.e ^ fresh) < 4, hit2, hit1)
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * lanes
    for a in range(0, lanes, _AT_ONCE):
        for lane, block in enumerate(ids[:, a : a + _AT_ONCE].T.copy(), a):
            out[order[lane]] = block[: lengths[lane]]
    return out
