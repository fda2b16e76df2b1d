"""Adaptive context-mixing range coder for arrays of token ids, in numpy.

A block is cut into lanes that advance together, one id of every lane per step, so each
numpy operation codes thousands of ids. All lanes share one adaptive model, which starts
anew in each block and learns from a step only after it is coded; encoder and decoder
therefore see the same model. It makes three predictions:

- order 2 and order 1: the id that last followed the two ids, or the id, before, with a
  confidence from 0 to 15;
- order 0: how often each id occurred in the block.

The id that the highest confident order predicts is the candidate. Its chance, as each
order sees it, is mixed in the logistic domain with weights learned on the way; one binary
decision codes whether the candidate is right. If not, the id is coded by its order-0
frequency. Decisions drive one range coder per lane (48 bits, no carry, 16 bits out at
once). All arithmetic that both sides must agree on is integer or exactly rounded.

A block is a header, the number of 16-bit words of each lane, the lanes' words, and the
checksum of all of these. The header holds the checksum of the ids.
"""

from __future__ import annotations

import struct
import zlib
from decimal import Decimal

import numpy as np

_MAGIC = b"CMR1"
_HEADER = "<4sIIII"
_HEAD_BYTES = struct.calcsize(_HEADER)
#: Lanes of a full block, and the fewest ids that a lane is opened for.
_LANES = 8192
_LANE_IDS = 128

_TOP = np.uint64(1 << 32)
_BOTTOM = np.uint64(1 << 31)
_MASK = np.uint64((1 << 48) - 1)
_16, _32 = np.uint64(16), np.uint64(32)
#: Bits of order-0 frequencies and of binary decisions.
_SCALE = 17
_CHANCE = 12
_SLOTS = 1 << 18
_SURE = 15


def _curve() -> np.ndarray:
    """Chances of 4096 for the logistic scale from -2047 to 2047 in 256ths, exactly rounded."""
    knots = [int(4096 / (1 + (Decimal(-x) / 256).exp())) for x in range(-2048, 2049, 64)]
    at = np.arange(-2048, 2048)
    left = np.array(knots)[(at + 2048) >> 6]
    right = np.array(knots)[((at + 2048) >> 6) + 1]
    return np.clip(left + (((right - left) * ((at + 2048) & 63)) >> 6), 1, 4095)


_SQUASH = _curve()
#: The place on the scale for each chance, the inverse of the curve.
_STRETCH = np.clip(np.searchsorted(_SQUASH, np.arange(4097)) - 2048, -2047, 2047)
#: The curve for places that are cut at -2047; `_take` cuts them at both ends of the table.
_CHANCES = np.append(_SQUASH[1], _SQUASH[1:]).astype(np.float64)
#: Confidences of order 2 times those of order 1, which agrees with the candidate or not.
_STATES = 16 * 32
_FREQ_BITS = np.uint64(_SCALE + 1)
_FREQ = np.uint64((1 << _SCALE + 1) - 1)


class _Model:
    """The model of a block. Ids are below 65,536, so that 16 times an id fits 32 bits.

    Values are 32 bits wide, places in tables 64, as numpy takes them. Floating-point
    numbers hold integers below 2 ** 53 and are exact.
    """

    def __init__(self, lanes: int, ids: int) -> None:
        self.ids = ids
        self.counts = np.zeros(ids, np.int64)
        self.pending: list[np.ndarray] = []
        self.one, self.two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        # For each context 16 times the id that followed last, plus the confidence.
        self.seen = (np.zeros(ids, np.int32), np.zeros(_SLOTS, np.int32))
        # Hits and cases for each confidence of order 2, and of order 1 that agrees or not.
        self.hits, self.cases = np.ones(48, np.int64), np.full(48, 4, np.int64)
        self.weights = [1 << 15, 1 << 15, 1 << 13, 0]
        self.steps = 0
        self._refresh()

    def _refresh(self) -> None:
        """Order-0 frequencies from all ids so far, each at least 1, 2 ** _SCALE in all."""
        if self.pending:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=self.ids)
        self.pending = []
        spare = (1 << _SCALE) - self.ids
        total = int(self.counts.sum())
        share = np.floor(self.counts * (spare / total)) if total else np.zeros(self.ids)
        freq = 1 + share.astype(np.int64)
        freq[int(freq.argmax())] += (1 << _SCALE) - int(freq.sum())
        self.freq = freq
        # Where the ids' frequencies begin, above the frequencies.
        self.cum_freq = ((np.cumsum(freq) - freq).view(np.uint64) << _FREQ_BITS) | freq.view(np.uint64)
        # The size of a frequency on the logistic scale, by its power of two.
        power = (freq.astype(np.float32).view(np.int32) >> 23) - 126
        self.size = (power - _SCALE) * 177.0
        self._inverse: np.ndarray | None = None

    def inverse(self) -> np.ndarray:
        """The id at each place of the order-0 frequencies."""
        if self._inverse is None:
            self._inverse = np.repeat(np.arange(self.ids).astype(np.uint16), self.freq)
        return self._inverse

    def predict(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """For each lane the candidate and its chance of 2 ** _CHANCE."""
        self.one, self.two = self.one[:lanes], self.two[:lanes]
        # The 31 lowest bits decide, so a product may overflow.
        slot = self.one.astype(np.uint32) * np.uint32(0x9E3779B1)
        slot += self.two.astype(np.uint32) * np.uint32(0x85EBCA6B)
        slot >>= np.uint32(13)
        slot &= np.uint32(_SLOTS - 1)
        self.slot = slot.astype(np.int64)
        self.one_seen, self.two_seen = _take(self.seen[0], self.one), _take(self.seen[1], self.slot)
        # Order 2 if it has seen anything, else order 1.
        seen = self.two_seen | (self.one_seen & (self.two_seen - 1 >> 31))
        state = (self.two_seen & _SURE) << 5
        state |= _differs(seen, self.one_seen) & 16
        state |= self.one_seen & _SURE
        self.state = state.astype(np.int64)
        candidate = (seen >> 4).astype(np.int64)
        known = _STRETCH[(self.hits << 12) // self.cases]
        self.known = known[:16], known[16:]
        w2, w1, w0, bias = self.weights
        high = self.known[0] * w2 + bias * 256
        both = np.add.outer(high, self.known[1] * w1).ravel().astype(np.float64)
        self.known_size = _take(self.size, candidate)
        dot = self.known_size * w0
        dot += _take(both, self.state)
        dot *= 1 / 65536
        place = np.floor(dot, out=dot).astype(np.int64)
        place += 2048
        self.chance = _take(_CHANCES, place)
        return candidate, self.chance.astype(np.uint64)

    def learn(self, ids: np.ndarray, hits: np.ndarray) -> None:
        """Take in each lane's id; `hits` are the lanes whose candidate was right."""
        n = len(ids)
        fresh = ids.astype(np.int32) << 4
        for table, places, old in (
            (self.seen[0], self.one, self.one_seen),
            (self.seen[1], self.slot, self.two_seen),
        ):
            table[places] = _followed(old, fresh)
        cases = np.bincount(self.state, minlength=_STATES).reshape(16, 32)
        right = np.bincount(_take(self.state, hits), minlength=_STATES).reshape(16, 32)
        # The sum of errors in each state.
        chances = np.bincount(self.state, self.chance, _STATES).astype(np.int64)
        wrong = (right << _CHANCE) - chances.reshape(16, 32)
        self.cases += np.concatenate([cases.sum(axis=1), cases.sum(axis=0)])
        self.hits += np.concatenate([right.sum(axis=1), right.sum(axis=0)])
        if self.cases.max() > 1 << 20:
            self.cases, self.hits = (self.cases >> 1) + 2, (self.hits >> 1) + 1
        x0 = (int(_take(self.known_size, hits).sum()) << _CHANCE) - int(np.dot(self.known_size, self.chance))
        errors = (np.dot(self.known[0], wrong.sum(axis=1)), np.dot(self.known[1], wrong.sum(axis=0)), x0)
        for k, error in enumerate(errors):
            self.weights[k] += int(error) // (n << 5)
        self.weights[3] += int(wrong.sum()) // (n << 2)
        self.two, self.one = self.one, ids
        self.pending.append(ids)
        self.steps += 1
        if self.steps % 16 == 0 or self.steps in (1, 2, 4, 8):
            self._refresh()


def _take(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The values at places, which are cut at both ends of the table."""
    return table.take(places, mode="clip")


def _differs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All bits set where the ids of two states of contexts differ, else none."""
    return _SURE - (a ^ b) >> 31


def _either(bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a where all bits are set, b where none is; `np.where` takes three times as long."""
    a ^= b
    a &= bits
    a ^= b
    return a


def _followed(old: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The states of contexts that an id followed, 16 times that id given.

    The same id: one more, up to the most. Another: half of it, or the new id from one or none.
    """
    trust = old & _SURE
    up = old - (trust - _SURE >> 31)
    down = old - (trust + 1 >> 1)
    wrong = _either(trust - 2 >> 31, fresh + 1, down)
    return _either(_differs(old, fresh), wrong, up)


def _parts(sp: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each lane's range what a right candidate gets, and of the rest one part of a frequency."""
    bound = sp >> np.uint64(_CHANCE)
    bound *= chance
    part = sp - bound
    part >>= np.uint64(_SCALE)
    return bound, part


def _narrow(
    lo: np.ndarray, sp: np.ndarray, bound: np.ndarray, part: np.ndarray, hits: np.ndarray, model, ids
) -> None:
    """Narrow each lane's range to its decision and, where the candidate was wrong, its id."""
    cum = _take(model.cum_freq, ids)
    freq = cum & _FREQ
    cum >>= _FREQ_BITS
    cum *= part
    cum += bound
    cum[hits] = 0
    lo += cum
    np.multiply(part, freq, out=sp)
    sp[hits] = _take(bound, hits)


def _spent(lo: np.ndarray, sp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Shift out 16 bits of those lanes that have them settled; these lanes and their bits.

    A range that has become too small without settling is cut at the next border. The last
    result are the lanes that may have more.
    """
    a, b = _take(lo, at), _take(sp, at)
    settled = (a ^ (a + b)) < _TOP
    go = np.flatnonzero(settled | (b < _BOTTOM))
    at, a, b, settled = _take(at, go), _take(a, go), _take(b, go), _take(settled, go)
    b = np.where(settled, b, (~a + np.uint64(1)) & (_BOTTOM - np.uint64(1))) << _16
    lo[at] = (a << _16) & _MASK
    sp[at] = b
    return at, a >> _32, at[b < _TOP]


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps for n ids; only the last lane may be shorter."""
    steps = max(-(-n // _LANES), min(n, _LANE_IDS))
    return -(-n // steps), steps


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of ids below `vocabulary` (65,536 at most)."""
    n = len(ids)
    check = zlib.crc32(ids.astype("<u4").tobytes())
    if not n:
        return _sealed(struct.pack(_HEADER, _MAGIC, 0, vocabulary, 0, check))
    lanes, steps = _shape(n)
    padded = np.zeros(lanes * steps, np.int32)
    padded[:n] = ids
    columns = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model = _Model(lanes, vocabulary)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, _MASK)
    out_lane: list[np.ndarray] = []
    out_word: list[np.ndarray] = []
    for step in range(steps):
        live = lanes if (lanes - 1) * steps + step < n else lanes - 1
        now = columns[step, :live].astype(np.int64)
        candidate, chance = model.predict(live)
        hits = np.flatnonzero(candidate == now)
        lo, sp = low[:live], span[:live]
        bound, part = _parts(sp, chance)
        _narrow(lo, sp, bound, part, hits, model, now)
        # No range that is larger has settled bits.
        more = np.flatnonzero(sp < _TOP)
        while len(more):
            at, bits, more = _spent(lo, sp, more)
            out_lane.append(at.astype(np.uint16))
            out_word.append(bits.astype(np.uint16))
        model.learn(now, hits)
    every = np.arange(lanes).astype(np.uint16)
    for shift in (32, 16, 0):
        out_lane.append(every)
        out_word.append((low >> np.uint64(shift)).astype(np.uint16))
    lane = np.concatenate(out_lane)
    words = np.concatenate(out_word)[np.argsort(lane, kind="stable")]
    sizes = np.bincount(lane, minlength=lanes)
    head = struct.pack(_HEADER, _MAGIC, n, vocabulary, lanes, check)
    return _sealed(head + sizes.astype("<u4").tobytes() + words.astype("<u2").tobytes())


def _sealed(block: bytes) -> bytes:
    return block + struct.pack("<I", zlib.crc32(block))


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; ValueError if it is damaged."""
    block, seal = block[:-4], block[-4:]
    if len(block) < _HEAD_BYTES or struct.pack("<I", zlib.crc32(block)) != seal:
        raise ValueError("block is damaged")
    magic, n, vocabulary, lanes, check = struct.unpack_from(_HEADER, block)
    if magic != _MAGIC or (lanes, n) != (_shape(n)[0] if n else 0, n):
        raise ValueError("no block of token ids")
    ids = _decoded(block, n, vocabulary, lanes) if n else np.empty(0, np.int32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != check:
        raise ValueError("checksum of the ids does not match")
    return ids


def _decoded(block: bytes, n: int, vocabulary: int, lanes: int) -> np.ndarray:
    steps = _shape(n)[1]
    start = _HEAD_BYTES + 4 * lanes
    sizes = np.frombuffer(block, "<u4", lanes, _HEAD_BYTES).astype(np.int64)
    if len(block) != start + 2 * int(sizes.sum()):
        raise ValueError("block is cut short")
    words = np.append(np.frombuffer(block, "<u2", offset=start), np.zeros(3, "<u2"))
    at_word = np.cumsum(sizes) - sizes
    last = len(words) - 1
    code = np.zeros(lanes, np.uint64)
    for _ in range(3):
        code = code << _16 | words[np.minimum(at_word, last)].astype(np.uint64)
        at_word = at_word + 1
    model = _Model(lanes, vocabulary)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, _MASK)
    columns = np.zeros((steps, lanes), np.int32)
    for step in range(steps):
        live = lanes if (lanes - 1) * steps + step < n else lanes - 1
        candidate, chance = model.predict(live)
        lo, sp, co = low[:live], span[:live], code[:live]
        bound, part = _parts(sp, chance)
        offset = co - lo
        hits = np.flatnonzero(offset < bound)
        # Of a right candidate the place means nothing. Else the dividend has 48 bits, and a
        # quotient below a whole number by one part of the divisor is not rounded up to it.
        offset -= bound
        place = offset.astype(np.float64)
        place /= part
        now = _take(model.inverse(), place.astype(np.int64)).astype(np.int64)
        now[hits] = _take(candidate, hits)
        _narrow(lo, sp, bound, part, hits, model, now)
        more = np.flatnonzero(sp < _TOP)
        while len(more):
            at, _, more = _spent(lo, sp, more)
            word = _take(at_word, at)
            co[at] = ((_take(co, at) << _16) & _MASK) | _take(words, word)
            at_word[at] = word + 1
        columns[step, :live] = now
        model.learn(now, hits)
    return columns.T.ravel()[:n]
