"""Adaptive context-mixing range coder for blocks of token ids.

A block is cut into lanes of consecutive ids, coded in lockstep: one id of every lane, then
the next of each. The lanes share the block's models, which start empty, so a block can be
read without any other. For each id an order-2 and an order-1 table name one likely id
each. Whether the id is the first, the second or neither of them is coded by a mixture of
two adaptive distributions, one chosen by the order-2 prediction's record, one by the
order-1 prediction's; the weights follow how well each has predicted in this block. If
neither is right, the id is coded by an adaptive order-0 distribution of the ids neither
table named, and evenly where it has not been met so far.

All that is mixed depends on a few small numbers, so each step mixes once for all their
combinations and the lanes look their intervals up. The order-0 distribution is made anew
after steps ever farther apart.

A record is a header, the coded words in the order a reader needs them, and a checksum of
the ids; ``decode`` refuses a record that does not give the ids it was made of. Only exactly
rounded arithmetic is used, so every machine computes the same intervals.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 1 << 20
MAGIC = b"VTK3"
_HEADER = struct.Struct("<4sIII")  # magic, ids, greatest id, crc32 of the ids

_LEAST_LANES, _MOST_LANES, _LEAST_STEPS = 8, 8192, 64
#: Parts of an interval that tell the choice, and parts of each of these that tell the id.
_BITS, _ID_BITS = 15, 17
_TOTAL, _ID_TOTAL = 1 << _BITS, 1 << _ID_BITS
_ALL = np.uint64(_BITS + _ID_BITS)
_LAST_PART = np.uint64((1 << (_BITS + _ID_BITS)) - 1)
#: An interval holds at least this much after a word has been shifted out.
_LEAST = np.uint64(1 << 32)
_WORD = np.uint64(32)
_LOW_WORD = np.uint64((1 << 32) - 1)
#: Counts are halved beyond this sum.
_MOST_COUNTED = 8192
#: What a wrong (first four) and a right prediction add to its record.
_CHANGE = np.array([0, -1, -1, -1, 1, 1, 1, 0], np.int64)


class _Mixture:
    """Sizes of three intervals for each of 64 states: hit, agree, record 1, record 2."""

    def __init__(self):
        # By hit, agree and the record of one of the two predictions.
        self.counts = [np.tile(np.array([2, 1, 2]), (2, 2, 4, 1)) for _ in range(2)]
        self.won, self.coded = np.ones(64), np.full(64, 2.0)
        self.seen: list[np.ndarray] = []
        self._mix()

    def _mix(self):
        shares = [c / (c[..., 0] + c[..., 1] + c[..., 2])[..., None] for c in self.counts]
        two = np.repeat(shares[0][:, :, None], 4, axis=2).reshape(64, 3)
        one = np.repeat(shares[1], 4, axis=2).reshape(64, 3)
        weight = (self.won / self.coded)[:, None]
        part = weight * two
        mixed = part + (1 - weight) * one
        self.share = part / mixed
        sizes = 1 + (mixed[:, :2] * (_TOTAL - 3)).astype(np.uint64)
        self.first = sizes[:, 0] << np.uint64(_ID_BITS)
        self.second = sizes[:, 1] << np.uint64(_ID_BITS)
        self.named = self.first + self.second
        self.rest = np.uint64(_TOTAL) - sizes[:, 0] - sizes[:, 1]

    def renew(self) -> None:
        seen = np.bincount(np.concatenate(self.seen), minlength=192)
        self.seen = []
        by = seen.reshape(2, 2, 4, 4, 3)
        for counts, new in zip(self.counts, (by.sum(axis=2), by.sum(axis=3))):
            counts += new
            often = counts.sum(axis=-1) > _MOST_COUNTED
            counts[often] = (counts[often] + 1) >> 1
        seen = seen.reshape(64, 3)
        gain = seen * self.share
        self.won += gain[:, 0] + gain[:, 1] + gain[:, 2]
        self.coded += seen.sum(axis=1)
        often = self.coded > _MOST_COUNTED
        self.won[often] *= 0.5
        self.coded[often] *= 0.5
        self._mix()


class _Order0:
    """Distribution of the ids that no table named; its last place stands for all others."""

    def __init__(self, lookup: bool):
        self.lookup = lookup
        self.ids, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.others = 1
        self.met: list[np.ndarray] = []
        self.new: list[np.ndarray] = []
        self._spread()

    def _spread(self):
        counts = np.append(self.counts, self.others)
        width = np.maximum(1, counts * (_ID_TOTAL - len(counts)) // int(counts.sum()))
        width[-1] += _ID_TOTAL - int(width.sum())
        self.width = width.astype(np.uint64)
        self.start = (np.cumsum(width) - width).astype(np.uint64)
        if self.lookup:
            self.known = np.append(self.ids, np.uint32(0))
            self.place = np.repeat(np.arange(len(width), dtype=np.uint16), width)

    def learn(self, place: np.ndarray, new: np.ndarray) -> None:
        """Places of all ids just coded, and those ids that had none."""
        self.met.append(place)
        self.new.append(new)

    def renew(self) -> None:
        met = np.bincount(np.concatenate(self.met), minlength=len(self.ids) + 1)
        self.counts += met[:-1]
        new, times = np.unique(np.concatenate(self.new), return_counts=True)
        at = np.searchsorted(self.ids, new)
        self.ids, self.counts = np.insert(self.ids, at, new), np.insert(self.counts, at, times)
        self.others = (self.others + 1) // 2 + len(new) // 2
        # Beyond half the parts the rarest ids are told evenly again.
        if len(self.ids) >= _ID_TOTAL // 2:
            kept = np.sort(np.argsort(-self.counts, kind="stable")[: _ID_TOTAL // 2 - 1])
            self.ids, self.counts = self.ids[kept], self.counts[kept]
        self.met, self.new = [], []
        self._spread()


class _Models:
    def __init__(self, lanes: int, top: int, lookup: bool):
        kind = np.uint32 if top < 1 << 30 else np.uint64
        self.tables = [np.zeros(1 << 16, kind) for _ in range(2)]  # id * 4 + record
        self.mixture, self.order0 = _Mixture(), _Order0(lookup)
        self.last, self.before = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        self.hit = np.zeros(lanes, np.uint8)
        self.step, self.renewal = 0, 1

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids that both tables name."""
        hashed = self.last * np.uint32(0x9E3779B1)
        both = hashed + self.before * np.uint32(0x85EBCA6B)
        self.at = ((both >> 16).astype(np.int64), (hashed >> 16).astype(np.int64))
        two, one = self.found = [t.take(a) for t, a in zip(self.tables, self.at)]
        self.record = [(x & 3).astype(np.uint8) for x in self.found]
        self.named = ((two >> 2).astype(np.uint32), (one >> 2).astype(np.uint32))
        agree = (self.named[0] == self.named[1]).view(np.uint8)
        state = self.record[0] | self.record[1] << 2 | agree << 4 | self.hit
        self.state = state.astype(np.int64)
        return self.named

    def learn(self, ids: np.ndarray, right: tuple[np.ndarray, np.ndarray], missed: np.ndarray) -> bool:
        """True if the order-0 distribution is a new one."""
        choice = self.state * 3 + 1
        choice -= right[0]
        choice[missed] += 1
        self.mixture.seen.append(choice)
        for table, at, found, record, good in zip(self.tables, self.at, self.found, self.record, right):
            entry = found + _CHANGE.take(record + (good.view(np.uint8) << 2)).astype(found.dtype)
            fresh = np.flatnonzero(record < ~good)
            entry[fresh] = (ids[fresh].astype(found.dtype) << 2) + 1
            table[at] = entry
        self.hit = np.full(len(ids), 32, np.uint8)
        self.hit[missed] = 0
        self.before, self.last = self.last, ids
        self.step += 1
        if self.step < 16 or self.step % 4 == 0:
            self.mixture.renew()
        renew = self.step == self.renewal
        if renew:
            self.renewal += max(1, self.step // 2)
            self.order0.renew()
        return renew


def _shape(n: int) -> tuple[int, int]:
    """Steps and lanes of a block of ``n`` ids."""
    lanes = _LEAST_LANES
    while lanes < _MOST_LANES and lanes * 2 * _LEAST_STEPS <= n:
        lanes *= 2
    return -(-n // lanes), lanes


def _settle(size, some, move):
    """Shift a word out of the lanes whose intervals are small; ``move`` gets them."""
    at = np.flatnonzero(size < _LEAST) if some is None else some[size[some] < _LEAST]
    if len(at):
        size[at] <<= _WORD
        move(at)


def _numbered(ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in order, and the number of each id among them."""
    if top > 1 << 20:
        return np.unique(ids, return_inverse=True)
    different = np.flatnonzero(np.bincount(ids))
    number = np.zeros(top + 1, np.int64)
    number[different] = np.arange(len(different))
    return different, number[ids]


def _encode(block: np.ndarray, top: int) -> bytes:
    steps, lanes = _shape(len(block))
    ids = np.zeros(steps * lanes, np.uint32)
    ids[: len(block)] = block
    different, numbers = _numbered(ids, top)
    ids = np.ascontiguousarray(ids.reshape(lanes, steps).T)
    numbers = np.ascontiguousarray(numbers.reshape(lanes, steps).T)
    place_of = np.zeros(len(different), np.int64)
    models = _Models(lanes, top, False)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, _LEAST)
    words = np.zeros((2 * steps + 2, lanes), np.uint64)  # an id shifts out two at most
    used = np.zeros(lanes, np.int64)
    read: list[tuple[np.ndarray, np.ndarray]] = []  # lanes, and how many words they had given

    def add(at, more):
        """Raise low; what goes beyond its words is carried into the word before."""
        low[at] += more
        beyond = low[at] < more
        if beyond.any():
            at = np.arange(lanes)[at][beyond]
            words[used[at] - 1, at] += np.uint64(1)

    def emit(at):
        place = used[at]
        words[place, at] = low[at] >> _WORD
        low[at] <<= _WORD
        used[at] = place + 1
        read.append((at, place))

    everything = slice(None)
    even = np.uint64(top + 1)
    for t in range(steps):
        now = ids[t]
        two, one = models.predict()
        mixture, state, order0 = models.mixture, models.state, models.order0
        right = (now == two, now == one)
        missed = np.flatnonzero(~(right[0] | right[1]))
        first = mixture.first.take(state)
        start = np.where(right[0], np.uint64(0), first)
        width = np.where(right[0], first, mixture.second.take(state))
        place = place_of.take(numbers[t].take(missed))
        fresh = missed.take(np.flatnonzero(place == len(order0.ids)))
        left = state.take(missed)
        rest = mixture.rest.take(left)
        start[missed] = mixture.named.take(left) + rest * order0.start.take(place)
        width[missed] = rest * order0.width.take(place)
        part = size >> _ALL
        add(everything, start * part)
        size = part * width
        _settle(size, None, emit)
        if len(fresh):
            part = size[fresh] // even
            add(fresh, now[fresh].astype(np.uint64) * part)
            size[fresh] = part
            _settle(size, fresh, emit)
        order0.learn(place, now[fresh])
        if models.learn(now, right, missed):
            place_of[:] = len(order0.ids)
            place_of[np.searchsorted(different, order0.ids)] = np.arange(len(order0.ids))
    # One more word ends a lane: with zeros after it, it lies in the last interval.
    add(everything, np.full(lanes, _LOW_WORD))
    words[used, np.arange(lanes)] = low >> _WORD
    while (over := words >> _WORD).any():
        words &= _LOW_WORD
        words[:-1] += over[1:]
    # A reader holds two words of each lane, and takes one for each that is shifted out. The
    # first is always zero, as the first interval is the least.
    at, place = (np.concatenate(x) for x in zip(*read)) if read else (np.zeros(0, np.int64),) * 2
    coded = np.concatenate([words[1], words[place + 2, at]])
    return coded.astype("<u4").tobytes().rstrip(b"\0")


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """One record per block of ids (unsigned, below 2 ** 31)."""
    records = []
    for block in blocks:
        top = int(block.max()) if len(block) else 0
        head = _HEADER.pack(MAGIC, len(block), top, zlib.crc32(block.astype("<u4").tobytes()))
        records.append(head + (_encode(block, top) if len(block) else b""))
    return records


def decode(records: list[bytes]) -> list[np.ndarray]:
    """The ids of each record; a damaged record raises ``ValueError``."""
    out = []
    for record in records:
        if len(record) < _HEADER.size or record[:4] != MAGIC:
            raise ValueError("not a record of token ids")
        _, n, top, crc = _HEADER.unpack_from(record)
        ids = _decode(record[_HEADER.size :], n, top) if n else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("checksum of a block of token ids does not hold")
        out.append(ids)
    return out


def _decode(coded: bytes, n: int, top: int) -> np.ndarray:
    steps, lanes = _shape(n)
    # Zeros at the end were left away.
    data = np.frombuffer(coded + b"\0" * (-len(coded) % 4), "<u4").astype(np.uint64)
    data = np.concatenate([data, np.zeros(2 * lanes, np.uint64)])
    code = data[:lanes].copy()
    taken = lanes
    models = _Models(lanes, top, True)
    size = np.full(lanes, _LEAST)

    def fetch(at):
        nonlocal data, taken
        if taken + len(at) > len(data):
            data = np.concatenate([data, np.zeros(len(data) + lanes, np.uint64)])
        code[at] = code[at] << _WORD | data[taken : taken + len(at)]
        taken += len(at)

    out = np.zeros((steps, lanes), np.uint32)
    even = np.uint64(top + 1)
    for t in range(steps):
        two, one = models.predict()
        mixture, state, order0 = models.mixture, models.state, models.order0
        part = size >> _ALL
        v = np.minimum(code // part, _LAST_PART)
        first, second = mixture.first.take(state), mixture.second.take(state)
        low = v < first
        missed = np.flatnonzero(v >= first + second)
        start, width = np.where(low, np.uint64(0), first), np.where(low, first, second)
        now = np.where(low, two, one)
        left = state.take(missed)
        named, rest = mixture.named.take(left), mixture.rest.take(left)
        place = order0.place.take((v.take(missed) - named) // rest)
        start[missed] = named + rest * order0.start.take(place)
        width[missed] = rest * order0.width.take(place)
        code -= start * part
        size = part * width
        _settle(size, None, fetch)
        now[missed] = order0.known.take(place)
        fresh = missed.take(np.flatnonzero(place == len(order0.ids)))
        if len(fresh):
            part = size[fresh] // even
            v = np.minimum(code[fresh] // part, np.uint64(top))
            code[fresh] -= v * part
            size[fresh] = part
            now[fresh] = v
            _settle(size, fresh, fetch)
        order0.learn(place, now[fresh])
        out[t] = now
        models.learn(now, (now == two, now == one), missed)
    return out.T.reshape(-1)[:n]
