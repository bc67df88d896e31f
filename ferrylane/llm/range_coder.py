"""Adaptive context-mixing range coder for token ids, many blocks side by side.

An id is predicted by what followed the id before it (order 1) and the two before it (order 2) in the same block, and by how
often ids of its neighbourhood have come (order 0). Orders 1 and 2 each name one id; how much of the range the two get is
learned in this block for each pair of confidences, apart for those that name the same id, and order 0 shares out the rest.
That mixture drives a range coder with 64-bit state and 16-bit output words; a carry is added to the word before.

Blocks start from nothing, so each can be decoded alone, and a numpy step codes the next id of every block: the more blocks
at once, the less a step costs each.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 4096
#: Of each block's tables for orders 1 and 2.
SLOT_BITS = 11
#: What an occurrence adds to the count of its neighbourhood.
INCREMENT = 24
#: Steps between two sums over all neighbourhoods, and steps that the encoder prepares at once.
RESUM, CHUNK = 128, 16
#: Of 65,536, what a prediction gets at first by its confidence, and what one that held gains; each loses a 16th of what it has.
AT_FIRST, GAIN = np.array([16, 6000, 20000, 28000, 34000, 40000, 46000, 52000], dtype=np.int64), 4078
LIMIT_BITS = 24
_RENORM, _TOP, _HALF, _WORD = np.uint64(1 << 48), np.uint64(48), np.uint64(32), np.uint64(16)
_HASH, _SLOT = np.array([[0xC2B2AE35], [0x9E3779B1]], dtype=np.uint32), np.uint32(32 - SLOT_BITS)
#: Rows are order 2 and order 1, here and below. An entry is an id + 1, then three bits of confidence for each order, of which
#: it uses its own; 0 stands for none.
_UNIT = np.array([[8], [1]], dtype=np.int32)
_MOST, _KEPT, _LOWER = 7 * _UNIT, 3 * _UNIT, 2 * _UNIT
_GAINS = np.array([[GAIN << 16], [GAIN]], dtype=np.uint32)
_GROUPS = np.arange(1, 256, dtype=np.float32)


class _Model:
    """The predictions of ``n`` blocks. Ids are below 2 ** ``id_bits``; a neighbourhood is all ids of the same 8 top bits.

    Tables lie flat, a stretch for each block. Neighbourhoods are counted and summed up now and then.
    """

    def __init__(self, n: int, id_bits: int):
        self.n, self.low = n, max(0, id_bits - 8)
        self.counts = np.ones(n << 8, dtype=np.int64)
        #: Where each neighbourhood starts, of 65,536; the next block's 0 stands for the end.
        self.starts = np.zeros((n << 8) + 1, dtype=np.uint16)
        self.coarse = np.empty((63, n), dtype=np.uint16)
        self.table = np.zeros(2 * n << SLOT_BITS, dtype=np.int32)
        #: What orders 2 (upper half) and 1 get, by whether they differ, confidences and block.
        two = np.tile(np.repeat(AT_FIRST, 8), 2)
        one = (65536 - two) * np.tile(AT_FIRST, 16) >> 16
        one[:64] = AT_FIRST[0]
        self.shares = np.tile((two << 16 | one).astype(np.uint32), n)
        self.summed = 0
        self.narrow(n)

    def narrow(self, k: int) -> None:
        """Only the first ``k`` blocks go on."""
        self.k, lanes = k, np.arange(k)
        self.at_table = np.stack([lanes, lanes + self.n]) << SLOT_BITS
        self.at_shares, self.at_fours = lanes << 7, lanes << 6
        self.to_id = 1 - (lanes << 8 << self.low)
        self.below = np.empty((63, k), dtype=bool)

    def sum_up(self, ids: np.ndarray, step: int) -> None:
        """Count what has come since the last time; ``ids`` (+ 1) has two rows before the first step."""
        new = ids[self.summed + 2:step + 2]
        self.summed = step
        if len(new):
            at = np.clip((new - 1) >> self.low, 0, 255) + (np.arange(self.n) << 8)
            self.counts += np.bincount(at.ravel(), minlength=self.n << 8) * INCREMENT
        total = np.cumsum(self.counts.reshape(self.n, 256), axis=1, dtype=np.int32).astype(np.float32)
        part = total[:, :-1] * (np.float32(65536 - 256) / total[:, -1:])
        part += _GROUPS
        self.starts[:-1].reshape(self.n, 256)[:, 1:] = part

    def slots(self, before: np.ndarray) -> np.ndarray:
        """Of orders 2 and 1, for the ids (+ 1) two steps and one step before, in the last two dimensions."""
        mixed = before.view(np.uint32) * _HASH
        mixed[..., 0, :] ^= mixed[..., 1, :]
        mixed >>= _SLOT
        return mixed

    def predict(self, slot: np.ndarray, span: np.ndarray, masses: np.ndarray) -> np.ndarray:
        """Puts what orders 2 and 1 get of the span into ``masses``, returns a 65,536th of the rest."""
        self.slot = slot
        self.entry = entry = self.table[slot]
        apart = entry[0] ^ entry[1]
        context = apart & 63
        context |= 64
        np.minimum(apart, context, out=context)
        self.context = self.at_shares + context
        self.both = self.shares.take(self.context)
        np.multiply(self.both.view(np.uint16).reshape(-1, 2).T[::-1], span >> _WORD, out=masses)
        rest = span - masses[0]
        rest -= masses[1]
        rest >>= _WORD
        return rest

    def update(self, fresh: np.ndarray, named: np.ndarray, came: np.ndarray) -> None:
        """``fresh``: entries of the ids that came. ``named``: whether each order named them; ``came``: which one was used."""
        entry, both = self.entry, self.both
        sure = entry & _MOST
        np.copyto(fresh, entry - _LOWER, where=sure >= _KEPT)
        np.copyto(fresh, entry + (sure < _MOST) * _UNIT, where=named)
        self.table[self.slot] = fresh
        lost = both >> np.uint32(4)
        lost &= np.uint32(0x0FFF0FFF)
        both -= lost
        gains = came * _GAINS
        both += gains[0]
        both += gains[1]
        self.shares[self.context] = both


def _by_length(lengths: np.ndarray) -> tuple[list[int], list[int]]:
    """Blocks from long to short, and for every step how many go on."""
    order = np.argsort(-lengths, kind="stable")
    going = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
    return order.tolist(), going.tolist()


def _sums_up(step: int) -> bool:
    return step % RESUM == 0 or step & (step - 1) == 0 and step < RESUM


def _carry(words: np.ndarray, after: np.ndarray) -> None:
    """Add one to the words before these places."""
    while len(after):
        after = after - 1
        words[after] += np.uint16(1)
        after = after[words[after] == 0]


def encode_blocks(blocks: list[np.ndarray], id_bits: int) -> list[np.ndarray]:
    """Each block's ids as 16-bit words."""
    if not 0 < id_bits <= LIMIT_BITS:
        raise ValueError(f"ids of {id_bits} bits can't be coded")
    lengths = np.array([len(b) for b in blocks], dtype=np.int64)
    order, going = _by_length(lengths)
    n, steps = len(blocks), len(going)
    lying = np.zeros((n, steps), dtype=np.int32)
    for lane, i in enumerate(order):
        lying[lane, :lengths[i]] = blocks[i]
    ids = np.zeros((steps + 2, n), dtype=np.int32)
    np.add(lying.T, 1, out=ids[2:])
    del lying
    model = _Model(n, id_bits)
    at_table, at_starts = model.at_table, np.arange(n) << 8
    bits, inside = np.uint64(model.low), (1 << model.low) - 1
    low, span = np.zeros(n, dtype=np.uint64), np.full(n, 2**64 - 1, dtype=np.uint64)
    room = steps + 8 * CHUNK
    out, used, ends = np.zeros((n, room), dtype=np.uint16), np.arange(n) * room, np.arange(1, n + 1) * room
    flat = out.reshape(-1)
    lows, useds, spans, masses = low, used, span, np.empty((2, n), dtype=np.uint64)
    first = 0
    for step, k in enumerate(going):
        if k != model.k:
            model.narrow(k)
            low, used, span, masses = lows[:k], useds[:k], spans[:k], np.empty((2, k), dtype=np.uint64)
        sums_up = _sums_up(step)
        if sums_up:
            model.sum_up(ids, step)
        if sums_up or step - first == CHUNK:
            first, m = step, min(CHUNK, steps - step)
            if int((useds - ends).max()) > -4 * CHUNK:
                out = np.concatenate([out, np.zeros_like(out)], axis=1)
                useds += np.arange(n) * room
                ends += np.arange(1, n + 1) * room
                flat, room = out.reshape(-1), 2 * room
            now = ids[step + 2:step + 2 + m]
            entries = (now << 6)[:, None] | _UNIT
            slots = model.slots(np.stack([ids[step:step + m], ids[step + 1:step + 1 + m]], axis=1)) + at_table
            now = np.maximum(now - 1, 0)
            at = (now >> model.low) + at_starts
            start = model.starts.take(at)
            widths = (model.starts.take(at + 1) - start).astype(np.uint64)
            starts, tails = start.astype(np.uint64), (now & inside).astype(np.uint64)
        i = step - first
        rest = model.predict(slots[i, :, :k], span, masses)
        fresh = entries[i, :, :k]
        named = (model.entry ^ fresh) < 64
        came = named.copy()
        np.greater(named[1], named[0], out=came[1])
        width = rest * widths[i, :k]
        width >>= bits
        moved = rest * starts[i, :k]
        moved += masses[1]
        moved += width * tails[i, :k]
        # An id that order 1 names comes right after order 2's mass, one that order 2 names at the very start.
        np.copyto(moved, np.uint64(0), where=named[1])
        moved += masses[0]
        np.copyto(moved, np.uint64(0), where=named[0])
        np.copyto(width, masses[1], where=came[1])
        np.copyto(width, masses[0], where=named[0])
        moved += low
        carry = (moved < low).nonzero()[0]
        if len(carry):
            _carry(flat, used[carry])
        # A word of every block is written, and counts where the span has become short.
        flat[used] = moved >> _TOP
        short = width < _RENORM
        used += short
        shift = short * _WORD
        np.left_shift(moved, shift, out=low)
        np.left_shift(width, shift, out=span)
        more = (span < _RENORM).nonzero()[0]
        while len(more):
            flat[used[more]] = low[more] >> _TOP
            used[more] += 1
            low[more] <<= _WORD
            span[more] <<= _WORD
            more = more[span[more] < _RENORM]
        model.update(fresh, named, came)
    # One word more names a value inside the last interval; words behind it read as zero.
    last = (lows + (_RENORM - np.uint64(1))) >> _TOP << _TOP
    _carry(flat, useds[last < lows])
    flat[useds] = last >> _TOP
    words: list[np.ndarray] = [np.zeros(0, dtype=np.uint16)] * n
    for lane, i in enumerate(order):
        words[i] = flat[lane * room:int(useds[lane]) + 1].copy()
    return words


def decode_blocks(words: list[np.ndarray], lengths: list[int], id_bits: int) -> list[np.ndarray]:
    """The ids of blocks of these lengths."""
    sizes = np.array(lengths, dtype=np.int64)
    order, going = _by_length(sizes)
    n, steps = len(words), len(going)
    room = max((len(w) for w in words), default=0) + 8
    lying = np.zeros((n, room), dtype=np.uint16)
    for lane, i in enumerate(order):
        lying[lane, :len(words[i])] = words[i]
    model = _Model(n, id_bits)
    bits = np.uint64(model.low)
    first = lying[:, :4].astype(np.uint64)
    read = lying.reshape(-1)
    used, span = np.arange(n) * room + 4, np.full(n, 2**64 - 1, dtype=np.uint64)
    # Rows: the value, order 2's mass, the value past it, order 1's mass.
    held = np.empty((4, n), dtype=np.uint64)
    held[0] = (first[:, 0] << _TOP) | (first[:, 1] << _HALF) | (first[:, 2] << _WORD) | first[:, 3]
    ids = np.zeros((steps + 2, n), dtype=np.int32)
    for step, k in enumerate(going):
        if k != model.k:
            model.narrow(k)
            span, used, held = span[:k], used[:k], held[:, :k].copy()
        if _sums_up(step):
            model.sum_up(ids, step)
            starts = model.starts[:-1]
            model.coarse[:] = starts.reshape(n, 256)[:, 4::4].T
            fours = starts.view(np.uint64)
        slot = model.slots(ids[step:step + 2, :k]) + model.at_table
        rest = model.predict(slot, span, held[1::2])
        value, mass_two, past_two, mass_one = held
        came = np.empty((2, k), dtype=bool)
        # Where order 2 holds the value, what is past it wraps round and is too large for order 1.
        np.less(value, mass_two, out=came[0])
        np.subtract(value, mass_two, out=past_two)
        np.less(past_two, mass_one, out=came[1])
        found = np.empty((2, k), dtype=np.uint64)
        past = past_two - mass_one
        place = (past // rest).astype(np.uint16)
        np.less_equal(model.coarse[:, :k], place, out=model.below)
        at = model.at_fours + np.add.reduce(model.below.view(np.int8), axis=0, dtype=np.int8)
        four = fours.take(at).view(np.uint16).reshape(k, 4)
        at <<= 2
        further = (four[:, 1] <= place).view(np.int8)
        further += (four[:, 2] <= place).view(np.int8)
        further += (four[:, 3] <= place).view(np.int8)
        at += further
        start = model.starts.take(at)
        past -= rest * start
        at += 1
        rest *= model.starts.take(at) - start
        at -= 1
        np.right_shift(rest, bits, out=found[1])
        tail, _ = np.divmod(past, found[1], out=(past, found[0]))
        at <<= model.low
        at += tail.view(np.int64)
        at += model.to_id
        now = at.astype(np.int32)
        named = model.entry >> 6
        np.copyto(now, named[1], where=came[1])
        np.copyto(now, named[0], where=came[0])
        np.copyto(found, held[2:], where=came[1])
        np.copyto(found, held[:2], where=came[0])
        short = found[1] < _RENORM
        found <<= short * _WORD
        word = read.take(used)
        word *= short
        found[0] += word
        used = used + short
        more = (found[1] < _RENORM).nonzero()[0]
        while len(more):
            found[0, more] = (found[0, more] << _WORD) | read[used[more]]
            used[more] += 1
            found[1, more] <<= _WORD
            more = more[found[1, more] < _RENORM]
        held[0], span = found
        ids[step + 2, :k] = now
        now <<= 6
        fresh = now | _UNIT
        model.update(fresh, (model.entry ^ fresh) < 64, came)
    lying = np.ascontiguousarray(ids[2:].T)
    lying -= 1
    blocks: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * n
    for lane, i in enumerate(order):
        blocks[i] = lying[lane, :sizes[i]]
    return blocks
