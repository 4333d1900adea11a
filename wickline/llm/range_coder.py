"""Adaptive context-mixing range coder for token ids (operator 9's blocks).

Ids are coded in blocks of ``BLOCK`` ids that share nothing: each starts from
a fresh model, lists the distinct ids that it holds and carries the CRC-32 of
its ids.  Blocks of a record run in step, one lane each, so every operation
works on all of them at once.

A lane predicts the next id in three ways.  Order 0 counts how often each id
has come, in a tree of partial sums.  Order 1, by the last id, and order 2, by
the last two, hold the id that came next and how often it held.  The mixed
probability of an id is ``w0 * P0 + w1 * P1 + w2 * P2``; it alone drives the
arithmetic coding, so no id is ever outside the model.  The weights are kept
for each pair of confidences of the two guesses and adapt after every id: each
order gains the share of the probability that it gave to the id that came.
All numbers are integers, so every machine decodes alike.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 8192
MAGIC = b"WRC2"
_HEAD = "<4sQI"
#: Slots of a lane's order-2 table.
SLOTS = BLOCK
#: Ranks whose counts are looked through one by one.
GROUP = 32
#: What an id's coming adds to its order-0 count, which begins at 1.
STEP = 3
#: Weights: confidences of a guess (0: none), shares dealt after an id, most of a sum.
SURE, SHARES, MOST = 4, 32, 1024
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
LOW_HALF = np.uint64((1 << 32) - 1)
S16, S48 = np.uint64(16), np.uint64(48)


class _Model:
    """The state of all lanes; ids stand as ranks in their block's list.
    Order 0 holds the count of each rank and the sum of each group of ``GROUP`` ranks."""

    def __init__(self, distinct: np.ndarray):
        lanes = self.lanes = len(distinct)
        self.lane = np.arange(lanes)
        groups = self.groups = -(-int(distinct.max()) // GROUP)
        m = groups * GROUP
        count = (np.arange(m) < distinct[:, None]).astype(np.int32)
        self.sums = count.reshape(lanes, groups, GROUP).sum(axis=2, dtype=np.int32)
        self.count = count.reshape(lanes * groups, GROUP)
        self.flat, self.flat_sums = self.count.reshape(-1), self.sums.reshape(-1)
        self.first = self.lane * m
        self.seen = distinct.astype(np.int32)
        # a slot holds the guessed rank and, in the low bits, how sure it is; order 1 has a slot for each rank
        self.slots = np.zeros((m + SLOTS) * lanes, np.int32)
        self.at = np.zeros((2, lanes), np.int64)
        self.order2 = m * lanes + self.lane
        self.weights = np.full((3, 2 * SURE * SURE * lanes), 8, np.int32)
        self.prev1 = np.zeros(lanes, np.int64)
        self.prev2 = np.zeros(lanes, np.int64)

    def predict(self) -> np.ndarray:
        """Total of the mixed distribution by lane."""
        lanes = self.lanes
        self.at[0] = self.prev1 * lanes + self.lane
        self.at[1] = ((self.prev1 * 30011 + self.prev2 * 17737) >> 3 & (SLOTS - 1)) * lanes + self.order2
        self.held = self.slots.take(self.at)
        self.guess, self.sure = self.held >> 2, self.held & 3
        row = (self.sure[0] * SURE + self.sure[1]) * 2 + (self.guess[0] == self.guess[1])
        self.row = row * np.int64(lanes) + self.lane
        w = self.w = self.weights.take(self.row, axis=1)
        w[1:] *= self.sure > 0
        scaled = w * self.seen
        self.mass = scaled[1:]
        return scaled[0] + scaled[1] + scaled[2]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, width) of the ranks ``x`` in the mixed distribution."""
        group = x // GROUP
        own, member = self.lane * self.groups + group, x - group * GROUP
        below = np.cumsum(self.sums, axis=1, dtype=np.int32)[self.lane, group] - self.flat_sums.take(own)
        count = self.flat.take(self.first + x)
        below += np.cumsum(self.count.take(own, axis=0), axis=1, dtype=np.int32)[self.lane, member] - count
        passed = self.mass * (self.guess < x)
        return self.w[0] * below + passed[0] + passed[1], self._width(x, self.w[0] * count)

    def _width(self, x: np.ndarray, counted: np.ndarray) -> np.ndarray:
        self.hit = self.guess == x
        self.parts = np.empty((3, self.lanes), np.int32)
        self.parts[0] = counted
        np.multiply(self.mass, self.hit, out=self.parts[1:])
        return self.parts[0] + self.parts[1] + self.parts[2]

    def _among(self, sizes: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of a row's sizes, laid end to end, holds ``target``, and where that one starts."""
        ends = np.cumsum(sizes, axis=1, dtype=np.int32)
        at = np.add.reduce(ends <= target[:, None], axis=1, dtype=np.int64)
        np.minimum(at, sizes.shape[1] - 1, out=at)
        return at, ends[self.lane, at] - sizes[self.lane, at]

    def find(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ranks whose range holds ``target``, and their :meth:`place`."""
        factor = self.w[0][:, None]
        sizes = self.sums * factor
        home = self.guess // GROUP
        for mass, own in zip(self.mass, home, strict=True):
            sizes[self.lane, own] += mass
        group, start = self._among(sizes, target)
        inside = self.count.take(self.lane * self.groups + group, axis=0)
        sizes = inside * factor
        for mass, own, guess in zip(self.mass, home, self.guess, strict=True):
            here = np.flatnonzero(own == group)
            sizes[here, guess[here] % GROUP] += mass[here]
        member, lead = self._among(sizes, target - start)
        x = group * GROUP + member
        return x, start + lead, self._width(x, self.w[0] * inside[self.lane, member])

    def learn(self, x: np.ndarray, width: np.ndarray) -> None:
        """After :meth:`place` or :meth:`find` of the ranks that came."""
        w = self.weights.take(self.row, axis=1)
        w += SHARES * self.parts // width
        full = w[0] + w[1] + w[2] > MOST
        if full.any():
            w = np.where(full, (w + 1) >> 1, w)
        for k in range(3):
            self.weights[k][self.row] = w[k]
        self.flat[self.first + x] += STEP
        self.flat_sums[self.lane * self.groups + x // GROUP] += STEP
        self.seen += np.int32(STEP)
        # a miss takes trust away; an untrusted guess gives way
        fresh = (x << 2 | 1).astype(np.int32)
        missed = np.where(self.sure > 1, self.held - 1, fresh)
        self.slots[self.at] = np.where(self.hit, self.held + (self.sure < SURE - 1), missed)
        self.prev2, self.prev1 = self.prev1, x


def _settle(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Lanes whose top 16 bits are known; an interval too small to go on is
    cut at the next boundary first."""
    known = (low ^ (low + size)) < TOP
    small = size < BOTTOM
    cut = np.flatnonzero(small & ~known)
    if len(cut):
        size[cut] = (np.uint64(0) - low[cut]) & LOW_HALF
    return np.flatnonzero(known | small)


def _encode_lanes(ranks: np.ndarray, distinct: np.ndarray) -> list[bytes]:
    lanes, steps = ranks.shape
    model = _Model(distinct)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(2**64 - 1))
    out = np.zeros((lanes, 2 * steps + 8), np.uint16)
    used = np.zeros(lanes, np.int64)
    columns = np.ascontiguousarray(ranks.T)
    for x in columns:
        total = model.predict()
        start, width = model.place(x)
        unit = size // total.astype(np.uint64)
        low += unit * start.astype(np.uint64)
        size = unit * width.astype(np.uint64)
        go = _settle(low, size)
        while len(go):
            out[go, used[go]] = low[go] >> S48
            used[go] += 1
            low[go] <<= S16
            size[go] <<= S16
            l, s = low[go], size[go]
            more = _settle(l, s)
            size[go] = s
            go = go[more]
        model.learn(x, width)
    for k in range(4):
        out[np.arange(lanes), used + k] = (low >> np.uint64(48 - 16 * k)).astype(np.uint16)
    used += 4
    return [out[i, : used[i]].astype("<u2").tobytes() for i in range(lanes)]


def _decode_lanes(payloads: list[bytes], distinct: np.ndarray, steps: int) -> np.ndarray:
    lanes = len(payloads)
    model = _Model(distinct)
    longest = max(map(len, payloads)) // 2 + 8
    words = np.zeros((lanes, longest), np.uint16)
    for i, p in enumerate(payloads):
        w = np.frombuffer(p, "<u2")
        words[i, : len(w)] = w
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(2**64 - 1))
    code = np.zeros(lanes, np.uint64)
    for k in range(4):
        code = code << S16 | words[:, k]
    used = np.full(lanes, 4)
    ranks = np.zeros((steps, lanes), np.int64)
    for t in range(steps):
        total = model.predict()
        unit = size // total.astype(np.uint64)
        target = np.minimum((code - low) // unit, (total - 1).astype(np.uint64)).astype(np.int32)
        x, start, width = model.find(target)
        np.maximum(width, 1, out=width)  # a damaged block may lead to a rank that is not in its list
        low += unit * start.astype(np.uint64)
        size = unit * width.astype(np.uint64)
        ranks[t] = x
        go = _settle(low, size)
        while len(go):
            code[go] = code[go] << S16 | words[go, np.minimum(used[go], longest - 1)]
            used[go] += 1
            low[go] <<= S16
            size[go] <<= S16
            l, s = low[go], size[go]
            more = _settle(l, s)
            size[go] = s
            go = go[more]
        model.learn(x, width)
    return ranks.T


def _pack_list(ids: np.ndarray) -> bytes:
    """Ascending ids as differences of seven bits a byte."""
    diff = np.diff(ids, prepend=0).astype(np.uint64)
    sevens = (diff[:, None] >> np.arange(0, 35, 7, dtype=np.uint64) & np.uint64(127)).astype(np.uint8)
    more = np.zeros(sevens.shape, bool)
    for k in range(4):
        more[:, k] = diff >> np.uint64(7 * (k + 1)) > 0
    held = np.ones(sevens.shape, bool)
    held[:, 1:] = more[:, :-1]
    return (sevens | more.astype(np.uint8) << 7)[held].tobytes()


def _unpack_list(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).astype(np.int64)
    last = b < 128
    starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    shift = 7 * (np.arange(len(b)) - np.repeat(starts, np.diff(starts, append=len(b))))
    return np.cumsum(np.add.reduceat((b & 127) << shift, starts))


def encode_record(ids: np.ndarray) -> bytes:
    """A record: magic, ids, blocks; bytes of each block's list and code, and
    its CRC-32; the lists; the codes."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    ids = np.asarray(ids, np.int64)
    if n and (ids.min() < 0 or ids.max() >= 1 << 32):
        raise ValueError("ids must fit 32 bits")
    steps = BLOCK if blocks > 1 else n
    ranks, lists, sums = np.zeros((blocks, steps), np.int64), [], []
    for i in range(blocks):
        own = ids[i * BLOCK : (i + 1) * BLOCK]
        held, rank = np.unique(own, return_inverse=True)
        ranks[i, : len(own)] = rank
        lists.append(held)
        sums.append(zlib.crc32(own.astype("<u4").tobytes()))
    codes = _encode_lanes(ranks, np.array([len(x) for x in lists])) if blocks else []
    packed = [_pack_list(x) for x in lists]
    table = np.array([[len(x) for x in packed], [len(x) for x in codes], sums], "<u4").tobytes()
    return b"".join([struct.pack(_HEAD, MAGIC, n, blocks), table, *packed, *codes])


def decode_record(record: bytes) -> np.ndarray:
    """The ids of a record; raises ValueError where a block's checksum fails."""
    magic, n, blocks = struct.unpack_from(_HEAD, record)
    if magic != MAGIC:
        raise ValueError("not a token record")
    if not blocks:
        return np.zeros(0, np.int64)
    at = struct.calcsize(_HEAD)
    sizes = np.frombuffer(record, "<u4", 3 * blocks, at).reshape(3, blocks)
    at += 12 * blocks
    cuts = (at + np.cumsum([0, *sizes[0].tolist(), *sizes[1].tolist()])).tolist()
    parts = [record[a:b] for a, b in zip(cuts, cuts[1:])]
    lists = [_unpack_list(p) for p in parts[:blocks]]
    ranks = _decode_lanes(parts[blocks:], np.array([len(x) for x in lists]), BLOCK if blocks > 1 else n)
    ids = np.concatenate([x.take(r, mode="clip") for x, r in zip(lists, ranks, strict=True)])[:n]
    for i, want in enumerate(sizes[2].tolist()):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) != want:
            raise ValueError(f"checksum of block {i} differs")
    return ids
