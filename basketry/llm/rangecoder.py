"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block is coded on its own, from a fresh state: first its alphabet, the ids it holds in ascending order (Elias-Fano: low bits
packed, high bits in unary), then the place of each of its ids in the alphabet. Two tables predict the next place, from the last
two (order 2) and from the last one (order 1), each with a confidence of 0 to 3. The chance that the order-2 prediction holds is
mixed from three adaptive estimates: by either confidence, and by how often the block held the predicted id so far (order 0); the
weights follow whichever erred less. The chance that it fails and the order-1 prediction holds comes from both confidences and
its id's order 0; an id that neither predicts is coded by order 0 alone: in proportion to how often the block held each id so far,
plus one, as of the last tally (after 16 ids, then whenever a quarter more and 16 have come). So an id takes one or two steps of
the range coder. All chances are integers of 15 bits, so every machine decodes alike. A lane's tables have the size of its
alphabet, whatever the width of ids, but for that of order 2.

Python would be slow id by id, so blocks are *lanes*: step t codes the t-th id of all lanes with a few dozen NumPy
operations. The range coder keeps 48 bits and emits 16-bit words; a carry stays with the word after which it came until the end.
"""

from __future__ import annotations

import numpy as np

BLOCK = 8192
LANES = 1024
_ONE = 1 << 15
#: 2 ** _SLOTS contexts of order 2, and as many places of an alphabet at most
_SLOTS = 13
#: steps of a count
_STEPS = 8
#: ids that 16 bits can count
_MOST = (1 << 15) - 1
_U, _I16 = np.uint64, np.int16
_HALF, _WORDS = np.array(15, _U), np.array(1 << 32, _U)
_MIX1, _MIX2 = 0x9E3779B1, 0x85EBCA6B
#: what an estimate moves towards after a miss and a hit: it stays above 0 and below 1
_AIM = np.array([32, _ONE - 32])
#: a hit makes a prediction surer, by its confidence
_SURER = np.array([1, 1, 1, 0])


def _place(starts: np.ndarray, digit: np.ndarray, after: np.ndarray | int = _ONE) -> tuple[np.ndarray, np.ndarray]:
    """Where each digit begins in its row, and how wide it is; rows end at ``after``."""
    flat = starts.ravel()
    at = np.arange(0, flat.size, 16) + digit
    begin = flat.take(at).astype(np.int64)
    return begin, np.where(digit == 15, after, flat.take(at + 1, mode="clip")) - begin


def _counted(starts: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The last place of each row that begins at or below ``value``: sixteen bytes of 0 or 1, counted eight at a time."""
    below = np.bitwise_count((starts <= value[:, None]).view(np.uint64))
    return (below[:, 0] + below[:, 1] - np.uint8(1)).astype(np.int64)


class _Writer:
    def __init__(self, lanes: int, words: int) -> None:
        self.low = np.zeros(lanes, _U)
        self.range = np.full(lanes, (1 << 48) - 1, _U)
        self.at = np.zeros(lanes, np.int64)
        # a word may hold a carry into the one before it until the end
        self.out = np.zeros((lanes, words), np.uint32)
        self._lanes = np.arange(lanes)

    def some(self, lanes: np.ndarray) -> _Writer:
        """A coder of these lanes; ``join`` takes back what it did."""
        part = _Writer.__new__(_Writer)
        part.low, part.range, part._lanes = self.low.take(lanes), self.range.take(lanes), lanes
        part.at, part.out = self.at, self.out
        return part

    def join(self, part: _Writer) -> None:
        self.low[part._lanes], self.range[part._lanes] = part.low, part.range

    def choice(self, lanes, one: np.ndarray, two: np.ndarray, kind: tuple[np.ndarray, np.ndarray]):
        """Code which of three comes: the first or second, of widths ``one`` and ``two``, or neither."""
        first, second = kind
        both = one + two
        start = np.where(first, 0, np.where(second, one, both))
        self.span(lanes, start, np.where(first, one, np.where(second, two, _ONE - both)))
        return kind

    def span(self, lanes, start: np.ndarray, width: np.ndarray) -> None:
        part = self.range[lanes] >> _HALF
        low = self.low[lanes] + start.view(_U) * part
        span = width.view(_U) * part
        small = (span < _WORDS).nonzero()[0]
        if len(small):
            full = self._lanes[lanes][small]
            at, old = self.at.take(full), low.take(small)
            self.out[full, at] = old >> _U(32)
            self.at[full] = at + 1
            low[small] = (old << _U(16)) & _U((1 << 48) - 1)
            span[small] <<= _U(16)
        self.low[lanes], self.range[lanes] = low, span

    def finish(self) -> list[bytes]:
        for word in (self.low >> _U(32), (self.low >> _U(16)) & _U(0xFFFF), self.low & _U(0xFFFF)):
            self.out[self._lanes, self.at] = word
            self.at += 1
        used = self.out[:, : int(self.at.max(initial=0))]
        while len((over := np.nonzero(used >> 16))[0]):
            used[over] &= 0xFFFF
            used[over[0], over[1] - 1] += 1
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.out, self.at, strict=True)]


class _Reader:
    """Reads what ``_Writer`` codes, by methods of the same names."""

    def __init__(self, blocks: list[bytes]) -> None:
        lengths = [len(b) // 2 for b in blocks]
        self.words = np.zeros((len(blocks), max(lengths, default=0) + 4), np.uint16)
        for row, b in zip(self.words, blocks, strict=True):
            row[: len(b) // 2] = np.frombuffer(b, "<u2")
        first, second, third = self.words[:, :3].T.astype(np.uint64)
        self.code = (first << _U(32)) | (second << _U(16)) | third
        self.range = np.full(len(blocks), (1 << 48) - 1, _U)
        self.at = np.full(len(blocks), 3, np.int64)
        self.last = self.words.shape[1] - 1
        self._lanes = np.arange(len(blocks))

    def some(self, lanes: np.ndarray) -> _Reader:
        part = _Reader.__new__(_Reader)
        part.code, part.range, part._lanes = self.code.take(lanes), self.range.take(lanes), lanes
        part.at, part.words, part.last = self.at, self.words, self.last
        return part

    def join(self, part: _Reader) -> None:
        self.code[part._lanes], self.range[part._lanes] = part.code, part.range

    def choice(self, lanes, one: np.ndarray, two: np.ndarray, kind: None):
        part, code = self.range[lanes] >> _HALF, self.code[lanes]
        both = one + two
        edge1, edge2 = one.view(_U) * part, both.view(_U) * part
        first, either = code < edge1, code < edge2
        second = either & ~first
        start = np.where(first, _U(0), np.where(second, edge1, edge2))
        end = np.where(first, edge1, np.where(second, edge2, part << _HALF))
        self._take(lanes, code - start, end - start)
        return first, second

    def value(self, lanes) -> np.ndarray:
        # below 2^48 by below 2^33: a double's quotient never rounds up to the next whole number
        part = (self.range[lanes] >> _HALF).astype(np.float64)
        return np.minimum(self.code[lanes].astype(np.float64) / part, _ONE - 1).astype(np.int16)

    def digit(self, lanes, starts: np.ndarray, digit: None, after: np.ndarray | int = _ONE, value=None) -> np.ndarray:
        """Read the digit whose place is coded, at ``value`` if that is known; rows of ``starts`` end at ``after``."""
        found = _counted(starts, self.value(lanes) if value is None else value)
        begin, width = _place(starts, found, after)
        part = self.range[lanes] >> _HALF
        self._take(lanes, self.code[lanes] - begin.view(_U) * part, width.view(_U) * part)
        return found

    def _take(self, lanes, code: np.ndarray, span: np.ndarray) -> None:
        small = (span < _WORDS).nonzero()[0]
        if len(small):
            which = self._lanes[lanes][small]
            at = self.at.take(which)
            # a damaged block may run out of words; its checksum tells
            code[small] = (code.take(small) << _U(16)) | self.words[which, np.minimum(at, self.last)]
            self.at[which] = at + 1
            span[small] <<= _U(16)
        self.code[lanes], self.range[lanes] = code, span


def _room(n: int) -> int:
    return -(-n // 16) * 16


class _Frequencies:
    """Order 0 of each lane: how often it held each id so far, and the places that follow from it, tallied anew now and then."""

    def __init__(self, sizes: np.ndarray) -> None:
        self.sizes, self.width = sizes, _room(int(sizes.max()) + 1)
        self.counts = np.zeros(len(sizes) * self.width, np.int16)
        self.base = np.arange(len(sizes), dtype=np.int64) * self.width
        self.none = np.where(np.arange(self.width) < sizes[:, None], 0, _ONE - 1).astype(np.int16)
        self.tally()

    def tally(self) -> None:
        """Places in proportion to the counts, one at least; ``levels`` are places, every 16th of them and so on, in rows of 16."""
        lanes, width = len(self.sizes), self.width
        starts = np.empty((lanes, width), np.int16)
        steps = np.arange(width)
        for lo in range(0, lanes, 64):
            hi = min(lo + 64, lanes)
            weight = self.counts[lo * width : hi * width].reshape(-1, width) + np.int64(1)
            weight *= self.none[lo:hi] == 0
            before = np.cumsum(weight, axis=1)
            share = ((_ONE - 1 - self.sizes[lo:hi]) << 24) // before[:, -1]
            before -= weight
            before *= share[:, None]
            before >>= 24
            before += steps
            np.maximum(np.minimum(before, _ONE - 1, out=before), self.none[lo:hi], out=before)
            starts[lo:hi] = before
        self.starts = starts.ravel()
        self.levels = [(starts.reshape(-1, 16), np.arange(lanes, dtype=np.int64) * (width // 16))]
        while starts.shape[1] > 16:
            every = starts[:, ::16]
            starts = np.full((lanes, _room(every.shape[1])), _ONE - 1, np.int16)
            starts[:, : every.shape[1]] = every
            self.levels.append((starts.reshape(-1, 16), np.arange(lanes, dtype=np.int64) * (starts.shape[1] // 16)))

    def read(self, coder: _Reader, lanes: np.ndarray) -> np.ndarray:
        """The place of the next id of ``lanes``, from row to row."""
        row, value = np.zeros(len(lanes), np.int64), coder.value(slice(None))
        for rows, first in self.levels[:0:-1]:
            row = row * 16 + _counted(rows.take(first.take(lanes) + row, axis=0), value)
        rows, first = self.levels[0]
        at = first.take(lanes) + row
        after = self.starts.take(at * 16 + 16, mode="clip")
        return row * 16 + coder.digit(slice(None), rows.take(at, axis=0), None, after, value)

    def write(self, coder: _Writer, lanes: np.ndarray, place: np.ndarray) -> None:
        at = self.base.take(lanes) + place
        begin = self.starts.take(at).astype(np.int64)
        coder.span(slice(None), begin, self.starts.take(at + 1) - begin)


def _run(coder, lengths: np.ndarray, sizes: np.ndarray, places: np.ndarray | None) -> np.ndarray:
    """Code ``places`` (steps by lanes) in alphabets of ``sizes`` or, if None, read them; ``lengths`` descend."""
    lanes, steps = len(lengths), int(lengths[0]) if len(lengths) else 0
    out = places if places is not None else np.zeros((steps, lanes), np.int16)
    if not steps:
        return out
    often = _Frequencies(sizes)
    counts, tallied = often.counts, 0
    each = np.arange(lanes, dtype=np.int64)
    # the tables of order 2, then those of order 1
    table = np.zeros((lanes << _SLOTS) + lanes * often.width, np.int16)
    base2, base1 = each << _SLOTS, (lanes << _SLOTS) + often.base
    # estimates by the confidence of order 2, by that of order 1, by the count of order 0
    by = np.full(3 * lanes * 8, _ONE // 4, np.int64)
    by_base = np.arange(3 * lanes, dtype=np.int64).reshape(3, lanes) * 8
    by_both = np.full(lanes * 16 * _STEPS, _ONE // 8, np.int32)
    both_base = each * (16 * _STEPS)
    step_of = np.minimum(np.frompyfunc(int.bit_length, 1, 1)(np.arange(steps + 1)).astype(np.int64), _STEPS - 1)
    weights = np.empty((2, lanes), np.int64)
    weights[0], weights[1] = 1 << 15, 1 << 12
    last1, last2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    active = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")
    n, here = -1, slice(0)
    for t in range(steps):
        if n != int(active[t]):
            n = int(active[t])
            here = slice(0, n)
            slots, at_by = np.empty((2, n), np.int64), np.empty((3, n), np.int64)
            apart, mixed = np.empty((2, n), np.int64), np.empty((2, n), np.int64)
            context, context1, count_base, of_by, of_both = base2[here], base1[here], often.base[here], by_base[:, here], both_base[here]
        if t >= tallied + (tallied >> 2) + 16:
            often.tally()
            tallied = t
        one, two = last1[here], last2[here]
        np.add(((one * _MIX1 + two * _MIX2) & 0xFFFFFFFF) >> (32 - _SLOTS), context, out=slots[0])
        np.add(context1, one, out=slots[1])
        entry = table.take(slots).astype(np.int64)
        guess, sure = entry >> 2, entry & 3
        guess2, guess1 = guess
        alike = guess2 == guess1
        step = step_of.take(counts.take(guess + count_base))
        np.add(sure << 1, alike, out=at_by[:2])
        at_by[2] = step[0]
        at_by += of_by
        chances = by.take(at_by)
        weight = weights[:, here]
        np.subtract(chances[0], chances[1], out=apart[0])
        np.add(chances[1], (weight[0] * apart[0]) >> 16, out=mixed[0])
        np.subtract(chances[2], mixed[0], out=apart[1])
        chance = np.add(mixed[0], (weight[1] * apart[1]) >> 16, out=mixed[1])
        at_both = ((sure[1] << 2) + sure[0]) * _STEPS
        at_both += step[1]
        at_both += of_both
        held = by_both.take(at_both).astype(np.int64)
        other = np.where(alike, 0, np.maximum(((_ONE - chance) * held) >> 15, 1))

        x = out[t, :n].astype(np.int64) if places is not None else None
        hit2, hit1 = coder.choice(here, chance, other, None if x is None else _hits(x, guess))
        seen = _AIM.take(hit2)
        by[at_by] = chances + ((seen - chances) >> 5)
        moved = weight + (((seen - mixed) * apart) >> 15)
        np.minimum(np.maximum(moved, 0, out=moved), 1 << 16, out=weights[:, here])
        by_both[at_both] = np.where(alike | hit2, held, held + ((_AIM.take(hit1) - held) >> 5))

        left = (~(hit2 | hit1)).nonzero()[0]
        found = np.where(hit2, guess2, guess1) if x is None else x
        if len(left):
            few = coder.some(left)
            if x is None:
                found[left] = often.read(few, left)
            else:
                often.write(few, left, x.take(left))
            coder.join(few)
        if x is None:
            out[t, :n] = found
        change = np.where(guess == found, _SURER.take(sure), -1)
        table[slots] = np.where(change + sure < 0, found << 2, entry + change)
        at = count_base + found
        counts[at] = counts.take(at) + _I16(1)
        last2[here] = one
        last1[here] = found
    return out


def _hits(x: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, second = x == guess
    return first, second & ~first


def _alphabet(present: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The ids that are ``present``; coded: how many (16 bits), width of the low bits (8), bits in unary (32), both parts."""
    ids = np.flatnonzero(present)
    low = max(0, (int(ids[-1]) // len(ids)).bit_length() - 1)
    high = np.zeros((int(ids[-1]) >> low) + len(ids), bool)
    high[(ids >> low) + np.arange(len(ids))] = True
    lows = np.packbits((ids[:, None] >> np.arange(low)) & 1 > 0)
    head = len(ids).to_bytes(2, "little") + bytes([low]) + len(high).to_bytes(4, "little")
    return ids, head + lows.tobytes() + np.packbits(high).tobytes()


def _read_alphabet(coded: bytes) -> tuple[np.ndarray, int]:
    """The ids and where the words begin."""
    n, low, unary = int.from_bytes(coded[:2], "little"), coded[2], int.from_bytes(coded[3:7], "little")
    middle = 7 + -(-n * low // 8)
    end = middle + -(-unary // 8)
    lows = np.unpackbits(np.frombuffer(coded[7:middle], np.uint8), count=n * low).reshape(n, low)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(coded[middle:end], np.uint8), count=unary))
    return ((high - np.arange(n)) << low) + lows @ (1 << np.arange(low)), end


def encode_blocks(blocks: list[np.ndarray], bits: int = 16) -> list[bytes]:
    """The alphabet and words of each block of ids below ``2 ** bits`` (20 at most); no block has much more than ``BLOCK``."""
    if not blocks:
        return []
    if bits > 20 or any(len(b) and int(b.max()) >> bits for b in blocks):
        raise ValueError("an id does not fit")
    if max(map(len, blocks)) > _MOST:
        raise ValueError("a block is too long")
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in order])
    places, sizes = np.zeros((int(lengths[0]), len(blocks)), np.int16), np.ones(len(blocks), np.int64)
    out: list[bytes] = [b""] * len(order)
    present, place = np.zeros(1 << bits, bool), np.zeros(1 << bits, np.int16)
    for lane, i in enumerate(order):
        if len(blocks[i]):
            present[blocks[i]] = True
            ids, out[i] = _alphabet(present)
            if len(ids) > 1 << _SLOTS:
                raise ValueError("a block has too many different ids")
            place[ids] = np.arange(len(ids))
            places[: len(blocks[i]), lane], sizes[lane] = place.take(blocks[i]), len(ids)
            present[ids] = False
    del blocks  # a caller that let go of them has them once in memory
    # a step of the range coder emits one word at most
    coder = _Writer(len(order), 2 * int(lengths[0]) + 3)
    _run(coder, lengths, sizes, places)
    for i, coded in zip(order, coder.finish(), strict=True):
        if out[i]:
            out[i] += coded
    return out


def decode_blocks(coded: list[bytes], lengths: list[int], bits: int = 16) -> list[np.ndarray]:
    """The ids of each block."""
    if not coded:
        return []
    order = sorted(range(len(coded)), key=lambda i: -lengths[i])
    steps = np.array([lengths[i] for i in order])
    alphabets, words = [], []
    for i in order:
        ids, at = _read_alphabet(coded[i]) if lengths[i] else (np.zeros(1, np.int64), 0)
        alphabets.append(ids.astype(np.uint32))
        words.append(coded[i][at:])
    places = _run(_Reader(words), steps, np.array([len(a) for a in alphabets]), None)
    ids = np.empty(places.shape[::-1], np.uint32)
    for row, lane, alphabet in zip(ids, places.T, alphabets, strict=True):
        alphabet.take(lane, out=row, mode="clip")
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(coded)
    for i, row, n in zip(order, ids, steps, strict=True):
        out[i] = row[:n]
    return out
