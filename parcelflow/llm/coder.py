"""Adaptive context-mixing range coder for token ids.

A block is coded alone: its model starts empty and learns as it goes. The ids of a block are cut into lanes that advance
in lockstep, one id each per step, so every step is a few array operations. All lanes share one model:

* order 2 and order 1 predict an id, the one that followed the last two ids or the last id, with a confidence from 0 to 15; an entry
  of order 2 keeps some bits of its context, and predicts nothing if they differ;
* order 0 predicts all ids by how often they came so far.

The three are mixed by weights that follow how often each order has been right at that confidence: a predicted id's range is the
sum over the orders of weight times probability, order 0 included; all other ids share the rest by order 0. Each lane is a carry-less
range coder of its own with a 64-bit window.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDCM2\0"
LANES, STEPS = 8192, 256  # most lanes of a block; steps that a lane should have at least
MIX = 16  # bits of the share of a prediction
ORDER0 = 22  # bits of the shares of order 0
LEAST = 16  # share that is left to ids which no order predicts
BOTTOM = np.uint64(1 << 44)
TOP = np.uint64(48)
WORD = np.uint64(16)
CONTEXTS = 18  # bits of the order-2 table
CHECK = 11  # most bits of its context that an entry keeps, beside its id and confidence in 31 bits
EVERY = 64  # steps between two updates of order 0 and the weights


# next confidence after a miss (first half) and a hit; a miss below 2 makes room for another id
_NEXT = np.array([s >> 1 for s in range(16)] + [min(15, s + 1) for s in range(16)], np.int32)


class Model:
    """What has been learned of a block so far. Coder and decoder make the same calls in the same order."""

    def __init__(self, vocab: int):
        self.vocab = vocab
        self.one, self.two = np.zeros(vocab, np.int32), np.zeros(1 << CONTEXTS, np.int32)  # id * 16 + confidence; before it order 2's check
        self.above = vocab.bit_length() + 4
        self.checked = max(0, min(CHECK, 31 - self.above))
        self.counts = np.zeros(vocab, np.int64)
        self.right, self.tried = np.full((2, 16), 0.5), np.full((2, 16), 4.0)
        self.seen: list = []
        self.step = 0
        self._refresh()

    def _refresh(self) -> None:
        if self.seen:
            self.counts += 24 * np.bincount(np.concatenate([s[0] for s in self.seen]), minlength=self.vocab)
            for order in (0, 1):
                state = np.bincount(np.concatenate([s[1 + order] for s in self.seen]), minlength=32)
                self.tried[order] += state[:16] + state[16:]
                self.right[order] += state[16:]
            self.seen = []
        summed = np.concatenate(([0], np.cumsum(self.counts)))
        room = (1 << ORDER0) - self.vocab
        self.cum = (summed * room // max(1, int(summed[-1])) + np.arange(self.vocab + 1)).astype(np.int32)
        self.cum[-1] = 1 << ORDER0
        self.share = np.diff(self.cum)
        self.weights = np.clip(self.right / self.tried * (1 << MIX), 16, 50_000).astype(np.int32)
        # by both confidences: what order 1 gives, and what is left for order 0
        first, second = self.weights[0][:, None].astype(np.int64), self.weights[1].astype(np.int64)
        self.given = (((1 << MIX) - first) * second >> MIX).astype(np.int32).ravel()
        self.left = ((1 << MIX) - first - self.given.reshape(16, 16)).astype(np.float32).ravel() / (1 << ORDER0)

    def predict(self, a: np.ndarray, b: np.ndarray) -> None:
        """Predictions after the ids a, b of each lane: self.ids and self.cuts, the ends of their ranges."""
        mixed = (a.view(np.uint32) * np.uint32(0x9E3779B1) + b.view(np.uint32)) * np.uint32(0x2545F491)
        self.at = mixed >> np.uint32(32 - CONTEXTS)
        self.mark = (mixed.view(np.int32) & ((1 << self.checked) - 1)) << self.above
        self.last = b
        two, one = self.two.take(self.at) ^ self.mark, self.one.take(b)
        two *= two < (1 << self.above)  # another context's entry predicts nothing: id 0 without confidence
        self.found = two, one
        self.ids = two >> 4, one >> 4
        self.sure = two & 15, one & 15
        both = self.sure[0] * 16 + self.sure[1]
        left = self.left.take(both)
        first = self.weights[0].take(self.sure[0]) + (left * self.share.take(self.ids[0])).astype(np.int32)
        given = self.given.take(both)
        apart = self.ids[0] != self.ids[1]  # an id that both predict has the ranges of both
        ends = first + given + (left * self.share.take(self.ids[1])).astype(np.int32) * apart
        ends = np.minimum(ends, (1 << MIX) - LEAST)  # all other ids keep a share, however much the two have
        self.cuts = np.where(apart, np.minimum(first, ends - 1), ends), ends

    def learn(self, x: np.ndarray) -> None:
        states = []
        for table, at, found, sure, own in zip((self.two, self.one), (self.at, self.last), self.found, self.sure, self.ids):
            hit = x == own
            state = sure + 16 * hit
            # a hit or a miss that is too sure to be replaced keeps the id
            now = np.where(hit | (sure > 1), found - sure + _NEXT.take(state), x * 16 + 1)
            table[at] = now if table is self.one else now | self.mark
            states.append(state)
        self.seen.append((x, *states))
        self.step += 1
        if self.step % EVERY == 0 or self.step in (1, 2, 4, 8, 16):
            self._refresh()


def _lanes(n: int) -> tuple[int, int, int]:
    """(lanes, steps, lanes that have an id in the last step)."""
    lanes = int(min(LANES, max(1, n // STEPS)))
    steps = -(-n // lanes)
    return lanes, steps, n - lanes * (steps - 1)


def _normalised(low: np.ndarray, size: np.ndarray, moved) -> None:
    """Shift out the words that are settled, and where a range has become too small, settle them by cutting it."""
    while True:
        settled = ((low ^ (low + size)) >> TOP) == 0
        at = np.flatnonzero(settled | (size < BOTTOM))
        if not len(at):
            return
        cut = at[~settled[at]]
        size[cut] = (np.uint64(0) - low[cut]) & (BOTTOM - np.uint64(1))
        moved(at, low[at] >> TOP)
        low[at] <<= WORD
        size[at] <<= WORD


def encode(ids: np.ndarray, vocab: int) -> bytes:
    """A block: header, checksums of the ids and of the body, words of each lane."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    if n and int(ids.max()) >= vocab:
        raise ValueError(f"id {int(ids.max())} is outside a vocabulary of {vocab}")
    body = b""
    lanes = 0
    if n:
        lanes, steps, full = _lanes(n)
        starts = np.arange(lanes) * steps - np.maximum(0, np.arange(lanes) - full)
        low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        words, used = np.zeros((lanes, 2 * steps + 12), np.uint16), np.zeros(lanes, np.int64)

        def moved(at, word):
            words[at, used[at]] = word
            used[at] += 1

        model = Model(vocab)
        a, b = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        wide = ids.astype(np.int32)
        for t in range(steps):
            if t == steps - 1:
                low, size, a, b = low[:full], size[:full], a[:full], b[:full]
                starts = starts[:full]
                rest = low.base, size.base
            x = wide.take(starts + t)
            model.predict(a, b)
            first, both = model.cuts
            two = x == model.ids[0]
            one = (x == model.ids[1]) & ~two
            start = np.where(two, 0, np.where(one, first, both))
            end = np.where(two, first, np.where(one, both, 1 << MIX))
            part = size >> np.uint64(MIX)
            low += part * start.astype(np.uint64)
            np.multiply(part, (end - start).astype(np.uint64), out=size)
            escaped = np.flatnonzero(~(two | one))
            part, found = size.take(escaped) >> np.uint64(ORDER0), x.take(escaped)
            low[escaped] += part * model.cum.take(found).astype(np.uint64)
            size[escaped] = part * model.share.take(found).astype(np.uint64)
            _normalised(low, size, moved)
            model.learn(x)
            a, b = b, x
        low = rest[0]
        for _ in range(4):
            moved(np.arange(lanes), low >> TOP)
            low <<= WORD
        body = used.astype("<u4").tobytes() + b"".join(words[i, : used[i]].astype("<u2").tobytes() for i in range(lanes))
    head = struct.pack("<IIII", n, vocab, lanes, zlib.crc32(ids))
    return MAGIC + head + struct.pack("<I", zlib.crc32(head + body)) + body


def decode(block: bytes) -> np.ndarray:
    """Ids of a block; raises ValueError if the block or what it gives does not match its checksums."""
    size_of_head = len(MAGIC) + 20
    if block[: len(MAGIC)] != MAGIC or len(block) < size_of_head:
        raise ValueError("not a block of ids")
    head, body = block[len(MAGIC) : size_of_head - 4], block[size_of_head:]
    n, vocab, lanes, crc = struct.unpack("<IIII", head)
    if zlib.crc32(head + body) != struct.unpack("<I", block[size_of_head - 4 : size_of_head])[0]:
        raise ValueError("the block is damaged")
    if not n:
        return np.zeros(0, np.uint32)
    if lanes != _lanes(n)[0]:
        raise ValueError("the block has another number of lanes")
    _, steps, full = _lanes(n)
    used = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.concatenate((np.frombuffer(body, "<u2", offset=4 * lanes), np.zeros(8, "<u2"))).astype(np.uint64)
    place = np.concatenate(([0], np.cumsum(used)[:-1]))
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << WORD) | words[place]
        place += 1
    starts = np.arange(lanes) * steps - np.maximum(0, np.arange(lanes) - full)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out = np.zeros(n, np.int32)

    def moved(at, _):
        code[at] = (code[at] << WORD) | words[place[at]]
        place[at] += 1

    model = Model(vocab)
    a, b = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for t in range(steps):
        if t == steps - 1:
            low, size, a, b, starts, code = low[:full], size[:full], a[:full], b[:full], starts[:full], code[:full]
        model.predict(a, b)
        first, both = model.cuts
        part = size >> np.uint64(MIX)
        target = np.minimum((code - low) // part, np.uint64((1 << MIX) - 1)).astype(np.int32)
        two, known = target < first, target < both
        x = np.where(two, model.ids[0], model.ids[1])
        start = np.where(two, 0, np.where(known, first, both))
        end = np.where(two, first, np.where(known, both, 1 << MIX))
        low += part * start.astype(np.uint64)
        np.multiply(part, (end - start).astype(np.uint64), out=size)
        escaped = np.flatnonzero(~known)
        part, base = size.take(escaped) >> np.uint64(ORDER0), low.take(escaped)
        target = np.minimum((code.take(escaped) - base) // part, np.uint64((1 << ORDER0) - 1)).astype(np.int32)
        order = np.argsort(target)  # ascending targets are found faster
        found = np.empty(len(order), np.int32)
        found[order] = np.searchsorted(model.cum, target.take(order), "right") - 1
        x[escaped] = found
        low[escaped] = base + part * model.cum.take(found).astype(np.uint64)
        size[escaped] = part * model.share.take(found).astype(np.uint64)
        _normalised(low, size, moved)
        out[starts + t] = x
        model.learn(x)
        a, b = b, x
    ids = out.astype("<u4")
    if zlib.crc32(ids) != crc:
        raise ValueError("the ids do not match their checksum")
    return ids
