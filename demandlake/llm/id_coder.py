"""Adaptive context-mixing range coder for token ids.

A block of ids is coded on its own: all model state starts anew, and a header
holds the number of ids and their crc32.  The next id is predicted by order 2 (the
last id seen after the same two ids) and order 1 (after the same id); how far each
is trusted is learned for every state of their confidences (how often in a row each
was right) and of whether they agree.  What neither predicts is coded by order 0:
adaptive counts of the ids' high bytes, and an even low byte.  The mixture's
intervals drive the range coder.

Blocks don't depend on each other, so many are coded at once, one numpy lane each.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDX2"
HEADER = struct.Struct("<4sIII")  # magic, ids, 32-bit words of code, crc32 of the ids
BLOCK_IDS = 4096
LANES = 2048
#: Entries of the tables of orders 1 and 2, for each lane.
TABLE_BITS = 10
TRUST_BITS, GROUP_BITS, LOW_BITS = 16, 12, 8
GROUPS = 256
#: Order-0 intervals follow the counts at the first of these steps, then every REFRESH ids.
EARLY, REFRESH = (0, 8, 32, 64, 128), 256
#: A state's trust adapts by 1 / 2**RATE, between these shares of 2**TRUST_BITS: what is left
#: by two predictions keeps 2**-12, so an interval of 2**32 still holds 2**20.
RATE, LEAST, MOST = 4, 512, 64_512
#: States of the trust: two confidences of 0 to 3, and whether the predictions agree.
STATES = 32
#: An entry of a table is id << 2 | confidence; no id is as large as the one of an empty entry.
EMPTY = 1 << 18
U64 = np.uint64
TOP = U64(1 << 32)
_MIX = np.array([[0x9E3779B1], [0x85EBCA6B]], dtype=np.uint32)
_MIX2 = np.uint32(0xC2B2AE35)


class _Model:
    """The mixture of all lanes.  Encoder and decoder make the same calls in the same order.

    Row 0 of the two-row arrays belongs to order 1, row 1 to order 2.  Lanes lie
    side by side in flat arrays, so a step is a few gathers, sums and scatters.
    """

    def __init__(self, lanes: int, slots: bool):
        self.size, self.steps = lanes, 0
        lane = np.arange(lanes)
        self.table = np.full(2 * lanes << TABLE_BITS, EMPTY, dtype=np.uint32)
        self.base = np.stack([lane, lanes + lane]) << TABLE_BITS
        # Trust in orders 1 and 2 (of order 1: where order 2 is wrong), by state.
        state = np.arange(STATES)
        first = np.stack([(state & 3 > 0) & (state < 16), state & 12 > 0])
        self.trust = np.repeat(np.where(first, 1 << 14, LEAST).astype(np.int32)[:, None], lanes, axis=1).ravel()
        self.states = np.stack([lane, lanes + lane]) * STATES
        # Counts of the groups and where their intervals begin, a row of GROUPS + 1 for each lane.
        self.counts = np.ones(lanes * (GROUPS + 1), dtype=np.int32)
        self.bounds = np.zeros(lanes * (GROUPS + 1), dtype=np.int32)
        self.slots = np.zeros(lanes << GROUP_BITS, dtype=np.uint8) if slots else None  # the group at each place
        self.last = np.zeros(lanes, dtype=np.uint32)
        self.last2 = np.zeros(lanes, dtype=np.uint32)

    def predict(self) -> None:
        """Sets the predicted ids and the trust in each."""
        if self.steps in EARLY or self.steps % REFRESH == 0:
            self._refresh()
        self.steps += 1
        mixed = self.last * _MIX
        mixed[1] += self.last2 * _MIX2
        mixed >>= 32 - TABLE_BITS
        self.at = mixed + self.base
        entry = self.table.take(self.at, mode="wrap")
        self.ids = entry >> 2
        self.sure = entry & 3
        state = self.sure[1] << 2
        state += self.sure[0]
        state += (self.ids[0] == self.ids[1]) * np.uint32(16)
        self.state = state + self.states
        self.trusted = self.trust.take(self.state, mode="wrap")

    def _refresh(self) -> None:
        n = self.size
        counts = self.counts.reshape(-1, GROUPS + 1)[:n, :GROUPS]
        share = (counts * ((1 << GROUP_BITS) - GROUPS) // counts.sum(axis=1, keepdims=True, dtype=np.int32)).astype(np.int32)
        share += 1
        share[:, -1] += (1 << GROUP_BITS) - share.sum(axis=1, dtype=np.int32)
        np.cumsum(share, axis=1, out=self.bounds.reshape(-1, GROUPS + 1)[:n, 1:])
        if self.slots is not None:
            groups = np.tile(np.arange(GROUPS, dtype=np.uint8), n)
            self.slots[: n << GROUP_BITS] = np.repeat(groups, share.ravel())

    def update(self, ids: np.ndarray, right: np.ndarray, asked: np.ndarray) -> None:
        """``right``: which predictions hold; ``asked``: places in ``counts`` of what order 0 coded."""
        change = np.multiply(right, np.int32(MOST - LEAST))
        change -= self.trusted
        change += LEAST
        change >>= RATE
        change[0] *= ~right[1]
        change += self.trusted
        self.trust[self.state] = change
        entry = np.minimum(self.sure, 2)  # right: one surer, 3 at most; else this id, at 1
        entry *= right
        entry += (ids << 2) | 1
        self.table[self.at] = entry
        self.counts[asked] += 8
        self.last2, self.last = self.last, ids

    def narrow(self, lanes: int) -> None:
        """Only the first lanes go on."""
        self.size = lanes
        self.last, self.last2 = self.last[:lanes], self.last2[:lanes]
        self.base, self.states = self.base[:, :lanes], self.states[:, :lanes]


def _longest_first(sizes: list[int]) -> np.ndarray:
    return np.argsort(-np.asarray(sizes), kind="stable")


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids as one self-contained, checksummed byte string; ids of 2**16 and more are refused."""
    if any(len(b) and b.max() >= 1 << 16 for b in blocks):
        raise ValueError("this coder takes ids below 65,536")
    out: list[bytes] = [b""] * len(blocks)
    for at in range(0, len(blocks), LANES):
        for i, code in zip(range(at, len(blocks)), _encode_lanes(blocks[at : at + LANES])):
            out[i] = code
    return out


def _encode_lanes(blocks: list[np.ndarray]) -> list[bytes]:
    order = _longest_first([len(b) for b in blocks])
    sizes = np.array([len(blocks[i]) for i in order])
    longest = int(sizes[0]) if len(sizes) else 0
    ids = np.zeros((len(blocks), longest), dtype=np.uint32)
    for lane, i in enumerate(order):
        ids[lane, : len(blocks[i])] = blocks[i]
    ids = np.ascontiguousarray(ids.T)
    model, n = _Model(len(blocks), slots=False), len(blocks)
    low, width = np.zeros(n, U64), np.full(n, 0xFFFFFFFFFFFFFFFF, U64)
    digits = np.zeros((n, longest + 3), dtype=np.int64)
    flat = digits.ravel()
    place = np.arange(n) * (longest + 3)  # in ``flat``
    bounds = model.bounds
    for t in range(longest):
        if t == sizes[model.size - 1]:  # the shortest lanes end
            live = int(np.searchsorted(-sizes, -t, side="left"))  # lanes of more than t ids
            _flush(flat, place, low[live:], live)
            low, width = low[:live], width[:live]
            model.narrow(live)
        now = ids[t, : model.size]
        model.predict()
        right = model.ids == now
        hit1, hit2 = right
        # Order 2 holds, or order 1, or neither.
        trust = model.trusted.astype(U64)
        share2 = (width >> U64(TRUST_BITS)) * trust[1]
        left = width - share2
        share1 = (left >> U64(TRUST_BITS)) * trust[0]
        width = np.where(hit2, share2, share1)
        shift = share2
        shift *= ~hit2
        missed = (~(hit1 | hit2)).nonzero()[0]
        ids0 = now.take(missed)
        at = missed * (GROUPS + 1)
        at += ids0 >> LOW_BITS
        lo = bounds.take(at, mode="wrap")
        share = bounds.take(at + 1, mode="wrap") - lo
        skip = share1.take(missed)
        step = (left.take(missed) - skip) >> U64(GROUP_BITS + LOW_BITS)
        lo <<= LOW_BITS
        lo += (ids0 & np.uint32(0xFF)).astype(np.int32) * share
        shift[missed] += skip + step * lo.astype(U64)
        width[missed] = step * share.astype(U64)
        before, low = low, low + shift
        over = (low < before).nonzero()[0]
        if len(over):  # a carry into the digit before; passed on at the end
            flat[place[over] - 1] += 1
        small = (width < TOP).nonzero()[0]
        own = low.take(small)
        to = place.take(small)
        flat[to] = own >> U64(32)
        place[small] = to + 1
        low[small] = own << U64(32)
        width[small] = width.take(small) << U64(32)
        model.update(now, right, at)
    _flush(flat, place, low, 0)
    place -= np.arange(n) * (longest + 3)
    for k in range(int(place.max(initial=0)) - 1, 0, -1):
        carry = digits[:, k] >> 32
        if carry.any():
            digits[:, k - 1] += carry
            digits[:, k] &= 0xFFFFFFFF
    out: list[bytes] = [b""] * len(blocks)
    for lane, i in enumerate(order):
        words = digits[lane, : place[lane]].astype("<u4").tobytes()
        out[i] = HEADER.pack(MAGIC, len(blocks[i]), int(place[lane]), zlib.crc32(np.asarray(blocks[i]).astype("<u4").tobytes())) + words
    return out


def _flush(flat: np.ndarray, place: np.ndarray, low: np.ndarray, first: int) -> None:
    lanes = np.arange(first, first + len(low))
    for part in (low >> U64(32), low & U64(0xFFFFFFFF)):
        flat[place[lanes]] = part
        place[lanes] += 1


def split(payload: bytes) -> list[bytes]:
    """The byte strings of ``encode``, from their concatenation."""
    out, at = [], 0
    while at < len(payload):
        magic, _, words, _ = HEADER.unpack_from(payload, at)
        if magic != MAGIC:
            raise ValueError("not a block of ids")
        end = at + HEADER.size + 4 * words
        out.append(payload[at:end])
        at = end
    return out


def decode(codes: list[bytes]) -> list[np.ndarray]:
    """Inverse of ``encode``; raises ValueError where a checksum doesn't hold."""
    out: list[np.ndarray] = []
    for at in range(0, len(codes), LANES):
        out += _decode_lanes(codes[at : at + LANES])
    return out


def _decode_lanes(codes: list[bytes]) -> list[np.ndarray]:
    heads = [HEADER.unpack_from(c) for c in codes]
    if any(h[0] != MAGIC or HEADER.size + 4 * h[2] != len(c) for h, c in zip(heads, codes)):
        raise ValueError("a block of ids is cut short")
    order = _longest_first([h[1] for h in heads])
    sizes = np.array([heads[i][1] for i in order])
    n, longest = len(codes), int(sizes[0]) if len(sizes) else 0
    row = max([h[2] for h in heads], default=0) + 3
    digits = np.zeros((n, row), dtype=np.uint32)
    for lane, i in enumerate(order):
        digits[lane, : heads[i][2]] = np.frombuffer(codes[i], "<u4", offset=HEADER.size)
    model = _Model(n, slots=True)
    code, width = (digits[:, 0].astype(U64) << U64(32)) | digits[:, 1], np.full(n, 0xFFFFFFFFFFFFFFFF, U64)
    digits = digits.ravel()
    place = np.arange(n) * row + 2
    ids = np.zeros((longest, n), dtype=np.uint32)
    bounds, slots = model.bounds, model.slots
    for t in range(longest):
        if t == sizes[model.size - 1]:
            live = int(np.searchsorted(-sizes, -t, side="left"))
            code, width, place = code[:live], width[:live], place[:live]
            model.narrow(live)
        model.predict()
        trust = model.trusted.astype(U64)
        share2 = (width >> U64(TRUST_BITS)) * trust[1]
        hit2 = code < share2
        left = width - share2
        share1 = (left >> U64(TRUST_BITS)) * trust[0]
        rest = code - share2  # where order 2 holds, this is beyond any share
        hit1 = rest < share1
        width = np.where(hit2, share2, share1)
        code = np.where(hit2, code, rest)
        now = np.where(hit2, model.ids[1], model.ids[0])
        missed = (hit1 == hit2).nonzero()[0]
        skip = share1.take(missed)
        rest = rest.take(missed) - skip
        step = (left.take(missed) - skip) >> U64(GROUP_BITS + LOW_BITS)
        v = np.minimum(rest // step, U64((1 << (GROUP_BITS + LOW_BITS)) - 1)).astype(np.int32)
        groups = slots.take((missed << GROUP_BITS) + (v >> LOW_BITS), mode="wrap")
        at = missed * (GROUPS + 1)
        at += groups
        lo = bounds.take(at, mode="wrap")
        share = bounds.take(at + 1, mode="wrap") - lo
        lo <<= LOW_BITS
        least = np.minimum((v - lo) // share, 0xFF)
        code[missed] = rest - step * (lo + least * share).astype(U64)
        width[missed] = step * share.astype(U64)
        now[missed] = groups.astype(np.int32) << LOW_BITS | least
        small = (width < TOP).nonzero()[0]
        to = place.take(small)
        code[small] = (code.take(small) << U64(32)) | digits.take(to, mode="clip")
        place[small] = to + 1
        width[small] = width.take(small) << U64(32)
        ids[t, : model.size] = now
        model.update(now, model.ids == now, at)
    ids = np.ascontiguousarray(ids.T)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * n
    for lane, i in enumerate(order):
        own = ids[lane, : sizes[lane]]
        if zlib.crc32(own.astype("<u4").tobytes()) != heads[i][3]:
            raise ValueError("a block of ids fails its checksum")
        out[i] = own
    return out
