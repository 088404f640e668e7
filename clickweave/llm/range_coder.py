"""Adaptive context-mixing range coder for token ids below 65,536.

Three models predict an id: what followed the last two ids (order 2), what followed
the last id (order 1), and how often each id occurs (order 0). The first two each
name one id, with a confidence that grows while they are right. Their confidences,
and whether they agree, choose a set of adaptive weights, by which the predictions
are mixed: a share of the coder's interval for the order-2 id, one for the order-1
id, and the rest divided by order 0, which can code every id.

Ids are coded in frames. A frame starts from the empty model and holds up to LANES
blocks, one numpy lane each, that go through it side by side: a step codes one id of
every block with what all blocks have taught the model in the steps before. Frames are
independent; every block has a coder and a checksum of its own.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 512
LANES = 4096
#: Log2 of the slots of order 2; order 1 has a slot for each id.
SLOTS_2 = 18
#: Log2 of the totals: of the weights, of order 0, and of a step.
MIX, ORDER_0 = 12, 19
WHOLE = MIX + ORDER_0
#: Ids are below this; as a guess it means that nothing was seen.
IDS = 1 << 16
#: In the tables of order 0, the whole: for ids that a higher order has named.
NAMED = IDS + 1
SURE = 7
#: Steps between two sums of order 0, and of the weights, when the model is warm.
SUM_STEPS, WEIGHT_STEPS = 64, 16
GAIN = 24
U = np.uint64
TOP, WORD, LOW48 = U(1 << 48), U(16), U((1 << 48) - 1)


class Models:
    """What the lanes of a frame share; ``m`` lanes take part in a step.

    A slot of order 1 or 2 holds ``8 * id + confidence``. The weights of a context are
    counts of how often order 2, order 1 or neither was right.
    """

    def __init__(self, lanes: int) -> None:
        self.slots2 = np.full(1 << SLOTS_2, 8 * IDS, np.int32)
        self.slots1 = np.full(IDS, 8 * IDS, np.int32)
        self.counts = np.ones(IDS, np.int64)
        self.weights = np.zeros((128, 4), np.int64)
        sure2, same, sure1 = (np.arange(128) >> s & b for s, b in ((4, 7), (3, 1), (0, 7)))
        self.can2, self.can1 = sure2 > 0, (sure1 > 0) & (same == 0)
        self.weights[:, 0], self.weights[:, 1], self.weights[:, 2] = self.can2, self.can1, 2
        self.before, self.last = np.zeros(lanes, np.uint32), np.zeros(lanes, np.int64)
        self.recent: list[np.ndarray] = []
        self.seen: list[np.ndarray] = []
        self.steps = 0
        self.sum()
        self.weigh()

    def sum(self) -> None:
        """Counts the ids since the last call; the shares of order 0 hold until the next."""
        if self.recent:
            self.counts += GAIN * np.bincount(np.concatenate(self.recent), minlength=IDS)
        self.recent = []
        cum = np.cumsum(self.counts)
        # Every id has a share of at least 1.
        ends = cum * ((1 << ORDER_0) - IDS) // cum[-1] + np.arange(1, IDS + 1)
        starts = np.concatenate([[0], ends]).astype(np.int32)
        self.cum = np.append(starts, np.int32(0))
        self.size = np.append(np.diff(starts), np.int32([0, 1 << ORDER_0]))

    def lookup(self) -> np.ndarray:
        """The id at each place of order 0."""
        return np.repeat(np.arange(IDS, dtype=np.uint16), self.size[:IDS])

    def weigh(self) -> None:
        """The shares of each context: where those of order 2, 1 and 0 begin."""
        if self.seen:
            self.weights += np.bincount(np.concatenate(self.seen), minlength=512).reshape(128, 4)
        self.seen = []
        part = self.weights[:, :2] * ((1 << MIX) - 3) // self.weights.sum(axis=1)[:, None]
        first = np.where(self.can2, part[:, 0] + 1, 0)
        second = first + np.where(self.can1, part[:, 1] + 1, 0)
        whole = np.full(128, 1 << MIX)
        edges = np.stack([0 * whole, first, second, whole, whole], axis=1)
        self.first, self.second = first << ORDER_0, second << ORDER_0
        self.start = edges[:, :4].reshape(-1) << ORDER_0
        self.share = np.diff(edges, axis=1).reshape(-1)

    def predict(self, m: int) -> None:
        last = self.last[:m]
        mixed = self.before[:m] * np.uint32(0x9E3779B1) + last.astype(np.uint32) * np.uint32(0x85EBCA6B)
        mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0xC2B2AE35)
        self.at2, self.at1 = (mixed >> np.uint32(32 - SLOTS_2)).astype(np.int64), last
        self.slot2, self.slot1 = self.slots2[self.at2], self.slots1[last]
        self.guess2, self.guess1 = self.slot2 >> 3, self.slot1 >> 3
        self.sure2, self.sure1 = self.slot2 & 7, self.slot1 & 7
        self.mix = (self.sure2 << 4) | self.sure1 | ((self.guess1 == self.guess2) << 3)

    @staticmethod
    def _learn(slots, at, slot, sure, right, fresh) -> None:
        # Of lanes that share a slot the last one is kept.
        slots[at] = np.where(right, slot + (sure < SURE), np.where(sure > 2, slot - 2, fresh))

    def update(self, m: int, ids: np.ndarray, taken: np.ndarray, right2: np.ndarray,
               right1: np.ndarray) -> bool:
        """``taken``: 4 * context + 0 where order 2 was right, 1 order 1, 2 neither. True
        when the shares of order 0 are new."""
        fresh = (ids << 3) + 1
        self._learn(self.slots2, self.at2, self.slot2, self.sure2, right2, fresh)
        self._learn(self.slots1, self.at1, self.slot1, self.sure1, right1, fresh)
        self.seen.append(taken)
        self.recent.append(ids)
        self.before[:m], self.last[:m] = self.last[:m], ids
        self.steps += 1
        early = self.steps & (self.steps - 1) == 0
        if early or self.steps % WEIGHT_STEPS == 0:
            self.weigh()
        if early or self.steps % SUM_STEPS == 0:
            self.sum()
            return True
        return False


def _shift(low: np.ndarray, width: np.ndarray, each) -> None:
    """Moves out words that are settled; ``each(lanes, low)`` emits or takes in one per lane."""
    lanes = np.flatnonzero(width < TOP)
    while len(lanes):
        own, wide = low[lanes], width[lanes]
        narrow = (own ^ (own + wide)) >= TOP
        wide = np.where(narrow, (~own + U(1)) & LOW48, wide) << WORD
        each(lanes, own)
        low[lanes], width[lanes] = own << WORD, wide
        lanes = lanes[wide < TOP]


def even(n: int, blocks: int) -> np.ndarray:
    return n // blocks + (np.arange(blocks) < n % blocks)


def lengths(n: int, block_ids: int = BLOCK_IDS) -> np.ndarray:
    """``n`` ids in blocks of about equal length, longer ones first."""
    return even(n, -(-n // block_ids))


def by_step(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of each step in a row, one of each block; 0 where a block has ended."""
    steps, whole = int(sizes[0]), int(np.count_nonzero(sizes == sizes[0]))
    out = np.zeros((steps, len(sizes)), np.uint16)
    out[:, :whole] = ids[:whole * steps].reshape(whole, steps).T
    out[:steps - 1, whole:] = ids[whole * steps:].reshape(len(sizes) - whole, steps - 1).T
    return out


def by_block(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The blocks one after the other, from what :func:`by_step` gives."""
    whole = int(np.count_nonzero(sizes == sizes[0]))
    return np.concatenate([ids[:, :whole].T.reshape(-1), ids[:-1, whole:].T.reshape(-1)])


def encode_blocks(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The consecutive blocks of ``ids``; ``sizes`` as from :func:`lengths`."""
    lanes, steps = len(sizes), int(sizes[0])
    model = Models(lanes)
    low, width = np.zeros(lanes, U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, U)
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def emit(at: np.ndarray, own: np.ndarray) -> None:
        out.append((at.astype(np.uint16), (own >> U(48)).astype("<u2")))

    ids = by_step(ids, sizes)
    for step in range(steps):
        m = lanes if step < sizes[-1] else int(np.count_nonzero(sizes > step))
        now = ids[step, :m].astype(np.int64)
        model.predict(m)
        right2, right1 = model.guess2 == now, model.guess1 == now
        outcome = (2 - right1) * ~right2
        taken = (model.mix << 2) + outcome
        inner = np.where(outcome == 2, now, NAMED)
        share = model.share[taken]
        start, size = model.start[taken] + share * model.cum[inner], share * model.size[inner]
        unit = width[:m] >> U(WHOLE)
        low[:m] += unit * start.view(U)
        width[:m] = unit * size.view(U)
        _shift(low[:m], width[:m], emit)
        model.update(m, now, taken, right2, right1)
    # Whatever follows, these two words name a place in the interval.
    for shift in (U(48), U(32)):
        out.append((np.arange(lanes, dtype=np.uint16),
                    ((low + U(0xFFFFFFFF)) >> shift).astype("<u2")))
    at, words = (np.concatenate(c) for c in zip(*out))
    words = words[np.argsort(at, kind="stable")].tobytes()
    ends = 2 * np.cumsum(np.bincount(at, minlength=lanes))
    return [words[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def decode_blocks(blocks: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks, one after the other."""
    lanes, steps = len(sizes), int(sizes[0])
    words = np.frombuffer(b"".join([*blocks, bytes(16)]), "<u2")
    place = np.cumsum([0, *map(len, blocks[:-1])]) // 2
    code = np.zeros(lanes, U)
    for _ in range(4):
        code = code << WORD | words[place]
        place += 1
    model = Models(lanes)
    low, width = np.zeros(lanes, U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, U)
    limit = len(words) - 1

    def take(at: np.ndarray, _) -> None:
        there = place[at]
        code[at] = (code[at] << WORD) | words[np.minimum(there, limit)]
        place[at] = there + 1

    ids = np.zeros((steps, lanes), np.uint16)
    lookup = model.lookup()
    for step in range(steps):
        m = lanes if step < sizes[-1] else int(np.count_nonzero(sizes > step))
        model.predict(m)
        unit = width[:m] >> U(WHOLE)
        value = np.minimum((code[:m] - low[:m]) // unit, U((1 << WHOLE) - 1)).view(np.int64)
        outcome = (value >= model.first[model.mix]).astype(np.int64) + (value >= model.second[model.mix])
        taken = (model.mix << 2) + outcome
        start, share = model.start[taken], model.share[taken]
        now = lookup[(value - start) // share].astype(np.int64)
        inner = np.where(outcome == 2, now, NAMED)
        now = np.where(outcome == 2, now, np.where(outcome == 1, model.guess1, model.guess2))
        start, size = start + share * model.cum[inner], share * model.size[inner]
        low[:m] += unit * start.view(U)
        width[:m] = unit * size.view(U)
        _shift(low[:m], width[:m], take)
        ids[step, :m] = now
        if model.update(m, now, taken, model.guess2 == now, model.guess1 == now):
            lookup = model.lookup()
    return by_block(ids, sizes)


# --- frames: blocks that were coded together ----------------------------------------------------

FRAME = struct.Struct("<4sIQ")
MAGIC = b"CMRC"


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u2").tobytes())


def pack_frame(ids: np.ndarray) -> bytes:
    """Header, lengths in ids and bytes, checksums, then the blocks. ``ids`` isn't empty."""
    sizes = lengths(len(ids))
    blocks = encode_blocks(ids, sizes)
    sums = [checksum(part) for part in np.split(ids, np.cumsum(sizes)[:-1])]
    table = np.array([sizes, [len(b) for b in blocks], sums], "<u4").T.tobytes()
    return b"".join([FRAME.pack(MAGIC, len(blocks), len(table) + sum(map(len, blocks))), table,
                     *blocks])


def unpack_frame(read) -> np.ndarray | None:
    """The ids of the next frame of a stream, verified; None at its end."""
    head = read(FRAME.size)
    if not head:
        return None
    magic, count, size = FRAME.unpack(head)
    body = read(size)
    if magic != MAGIC or len(body) != size:
        raise ValueError("not a whole frame of coded ids")
    table = np.frombuffer(body[:12 * count], "<u4").reshape(count, 3).astype(np.int64)
    sizes, held = table[:, 0], table[:, 1]
    if (not count or 12 * count + held.sum() != size or (held % 2).any()
            or (sizes != even(int(sizes.sum()), count)).any()):
        raise ValueError("the table of a frame doesn't hold")
    ends = 12 * count + np.cumsum(held)
    blocks = [body[end - n:end] for end, n in zip(ends.tolist(), held.tolist())]
    ids = decode_blocks(blocks, sizes)
    for part, want in zip(np.split(ids, np.cumsum(sizes)[:-1]), table[:, 2].tolist()):
        if checksum(part) != want:
            raise ValueError("a block's checksum doesn't hold")
    return ids
