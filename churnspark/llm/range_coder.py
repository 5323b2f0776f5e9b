"""A range coder for token ids whose predictions mix orders 2, 1 and 0, run over many blocks in step.

A frame of ids has one model, which is learned from all its ids and stands before its blocks. Every block is coded on
its own, so with the model any block can be decoded alone; numpy advances all blocks of a frame together, one id at a
time. An id takes one step of the coder, whichever prediction meets it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

BLOCK_IDS = 512
BITS = 22  # all probabilities are in units of 2^-22
ONE = 1 << BITS
HALVES = 1 << 20  # a frame of more different ids is coded as 16-bit halves
FINE = 1 << 29  # what orders 1 and 0 share, in units that no frequency divides
MAGIC = b"CMR4"
MOST_ID = (1 << 31) - 1
WORD = float(1 << 24)  # the range of an output word; two words are open at a time
ENTRY = 28  # bits that a follower is taken to cost in the model
SHARES = 256  # the share of the followers of a context is in units of 1/256

# The coder's numbers are whole and below 2^52, so floats hold them exactly and divide faster than integers. A quotient
# of two of them has at most 22 bits before the point and cannot round up to a whole number.


class Encoder:
    """Narrows the ranges of all lanes; a carry stays in the word that it comes out with until the end."""

    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes), np.full(lanes, WORD * WORD)
        self.words, self.out = np.empty((steps + 1, lanes), np.uint32), np.ones((steps + 1, lanes), bool)
        self.step = 0

    def narrow(self, start: np.ndarray, size: np.ndarray) -> None:
        """Code the symbols that start at ``start`` and take ``size`` of ONE."""
        unit = np.floor(self.range * (1 / ONE))
        low, span = self.low + unit * start, unit * size
        short = np.less(span, WORD, out=self.out[self.step])
        word = np.floor(low * (1 / WORD))
        self.words[self.step] = word  # comes out if the range is short
        self.step += 1
        self.low = np.where(short, (low - word * WORD) * WORD, low)
        self.range = np.where(short, span * WORD, span)

    def blocks(self) -> list[bytes]:
        # The range is WORD at least, so one more word names a number within it.
        self.words[self.step] = np.ceil(self.low * (1 / WORD))
        out = np.ascontiguousarray(self.out.T)
        words, ends = np.ascontiguousarray(self.words.T)[out], np.cumsum(out.sum(axis=1)) * 3
        while (over := words >> 24).any():
            words &= (1 << 24) - 1
            words[:-1] += over[1:]  # never from a lane's first word
        data = words.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


class Decoder:
    def __init__(self, blocks: list[bytes]):
        sizes = np.array([len(b) // 3 for b in blocks])
        self.at = np.cumsum(sizes + 2) - sizes - 2  # two words of zeros after each block
        data = np.frombuffer(b"".join(b[: len(b) // 3 * 3] + bytes(6) for b in blocks), np.uint8).reshape(-1, 3)
        self.words = np.pad(data, ((0, 0), (0, 1))).view("<u4").reshape(-1).astype(float)
        self.range = np.full(len(blocks), WORD * WORD)
        self.value = self.words.take(self.at) * WORD + self.words.take(self.at + 1)  # less the lower end of the range
        self.at += 2

    def target(self) -> np.ndarray:
        """Where in 0 to ONE the next symbol of each lane lies."""
        self.unit = np.floor(self.range * (1 / ONE))
        return np.floor(self.value / self.unit)

    def narrow(self, start: np.ndarray, size: np.ndarray) -> None:
        value, span = self.value - self.unit * start, self.unit * size
        short = span < WORD
        # A damaged block may ask for more words than there are.
        self.value = np.where(short, value * WORD + self.words.take(self.at, mode="clip"), value)
        self.range = np.where(short, span * WORD, span)
        self.at += short


def shares(met: np.ndarray, total: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The share of contexts' followers that came ``met`` times out of ``total``, ``most`` at most."""
    return np.where(met > 0, np.clip(met * SHARES // np.maximum(total, 1), 1, most), 0).astype(np.int32)


def paying(context: np.ndarray, count: np.ndarray, total: np.ndarray, chance: np.ndarray, most: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Which symbols, that came ``count`` times in a context and have a ``chance`` there without being listed, save more
    than their place costs. A context that has some costs that much more, and what its other symbols lose."""
    saved = count * np.log2(count / (total[context] * chance)) - ENTRY
    pays = saved > 0
    for _ in range(2):
        met = np.bincount(context, count * pays, len(total))
        share = shares(met, total, most)
        gain = np.bincount(context, saved * pays, len(total)) + (total - met) * np.log2(1 - share / SHARES) - cost
        pays &= ((gain > 0) & (share > 0))[context]
    return pays


class Followers:
    """The symbols that follow each of a number of contexts, how often, and the share of ``one`` that they have together.

    A context gives the rest to the order below; the chances of a symbol under all orders add up. A context has every
    follower that saves more than its place costs, however many these are.
    """

    def __init__(self, share: np.ndarray, context: np.ndarray, symbol: np.ndarray, count: np.ndarray, different: int, one: int):
        self.share, self.context, self.symbol, self.count = share, context, symbol, count
        contexts = len(share)
        self.keys = keyed(context, symbol, contexts, different)
        self.first = np.searchsorted(context, np.arange(contexts + 1))
        self.left = (SHARES - share) * float(one // SHARES)
        # What the followers of a context have before each one and with it.
        upto = np.append(0, np.cumsum(count))
        base = upto[self.first]
        whole, total = one - self.left, np.diff(base)
        self.low, self.high = (np.floor(whole[context] * (u - base[context]) / total[context]) for u in (upto[:-1], upto[1:]))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many followers lie before each key, and whether it is one."""
        at = self.keys.searchsorted(keys)
        return at, self.keys.take(at, mode="clip") == keys if len(self.keys) else np.zeros(keys.shape, bool)

    def upto(self, context: np.ndarray, at: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the followers of each context have before a place, and with the symbol at it."""
        if not len(self.keys):
            return np.zeros(at.shape), np.zeros(at.shape)
        before = np.where(at > self.first.take(context), self.high.take(at - 1, mode="clip"), 0.0)
        return before, np.where(hit, self.high.take(at, mode="clip"), before)

    def columns(self) -> list[np.ndarray]:
        steps = np.diff(self.symbol, prepend=0)
        heads = self.first[:-1][np.diff(self.first) > 0]
        steps[heads] = self.symbol[heads]
        return [np.diff(self.first), self.share, steps, self.count]

    @staticmethod
    def restored(size: np.ndarray, share: np.ndarray, steps: np.ndarray, count: np.ndarray, different: int, one: int) -> Followers:
        context, walk = np.repeat(np.arange(len(size)), size), np.cumsum(steps, dtype=np.int64)
        heads = (np.cumsum(size) - size)[context]
        return Followers(share, context, walk - walk[heads] + steps[heads], count.astype(np.int64), different, one)


class Ranges:
    """The ranges that followers have in their contexts, in one ascending row, to find targets in.

    Every context begins with an empty range, so the last range that starts no later than a target is of its context.
    A context is cut into equal slots, four times as many as it has followers or more; a slot says which range to begin at.
    """

    def __init__(self, sizes: np.ndarray, low: np.ndarray, high: np.ndarray, after: np.ndarray, symbol: np.ndarray, leads: np.ndarray, one: int):
        contexts, rows = len(sizes), len(sizes) + len(low)
        self.one, of = float(one), np.repeat(np.arange(contexts), sizes)
        at, heads = np.arange(len(low)) + of + 1, np.cumsum(sizes + 1) - sizes - 1
        self.start, self.end, self.after = np.zeros(rows), np.zeros(rows), np.zeros(rows)
        self.symbol, self.leads = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
        self.start[at], self.end[at], self.after[at], self.symbol[at], self.leads[at] = low, high, after, symbol, leads
        self.next = np.append(self.start[1:], self.one)
        self.next[heads[1:] - 1] = self.one
        self.key = self.start.copy()
        self.key[at] += of * self.one
        self.key[heads] = np.arange(contexts) * self.one
        slots = 1 << np.minimum(np.ceil(np.log2(4 * sizes + 1)), np.log2(one)).astype(np.int64)
        self.base, self.per = np.cumsum(slots) - slots, slots / self.one
        of = np.repeat(np.arange(contexts), slots)
        place = (np.arange(len(of)) - self.base[of]) / self.per[of]
        self.slot = (self.key.searchsorted(of * self.one + place, "right") - 1).astype(np.int32)

    def find(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The last range of the context that starts no later than each target."""
        at = self.slot.take((target * self.per.take(context)).astype(np.intp) + self.base.take(context), mode="clip").astype(np.intp)
        on = np.flatnonzero(self.next.take(at) <= target)
        at[on] = np.maximum(self.key.searchsorted(context[on] * self.one + target[on], "right") - 1, 0)
        return at


class Model:
    """The different ids of a frame in ascending order with their frequencies, and what follows an id and two ids how often.

    The chances of an id are mixed: order 2 gives the followers of two ids their share, order 1 the followers of one id
    their share of the rest, and order 0 has all ids by their frequencies in what is left. An id has the sum of what
    the three give it. Order 2 has a context for each pair of ids that order 1 lists.
    """

    def __init__(self, ids: np.ndarray, frequency: np.ndarray, one: Followers, two: Followers | None = None):
        self.ids, self.frequency, self.one, self.two = ids.astype(np.int32), frequency, one, two
        self.upto = np.cumsum(frequency).astype(float)  # the last is a power of two
        self.before = self.upto - frequency
        self.scale = one.left / self.upto[-1]  # a whole number in each context

    @staticmethod
    def learn(ids: np.ndarray) -> tuple[Model, np.ndarray]:
        """The model of the ids (steps x lanes) and the place of each among the different ones."""
        return Model.coded(ids)[:2]

    @staticmethod
    def coded(ids: np.ndarray) -> tuple[Model, np.ndarray, Callable]:
        """What ``learn`` gives, and a function that gives the spans of some steps (see ``span``)."""
        top = int(ids.max())
        if top < 1 << 22:
            counts = np.bincount(ids.reshape(-1), minlength=top + 1)
            different = np.flatnonzero(counts)
            place = np.zeros(top + 1, np.int32)
            place[different] = np.arange(len(different))
            counts, symbols = counts[different], place.take(ids)
        else:
            different, symbols, counts = np.unique(ids, return_inverse=True, return_counts=True)
            symbols = symbols.reshape(ids.shape).astype(np.int32)
        n = len(different)
        bits = min(21, max(12, n.bit_length() + 2))
        frequency = 1 + counts * ((1 << bits) - n) // ids.size
        frequency[counts.argmax()] += (1 << bits) - frequency.sum()
        chance = frequency / (1 << bits)
        # What two orders leave is at least as wide as the frequencies, so every id stays possible.
        most1 = np.full(n, SHARES - max(SHARES // 32, int(np.ceil(SHARES * 2 ** ((bits - BITS) / 2)))))

        def most2(share: np.ndarray) -> np.ndarray:
            return np.append(0, SHARES - np.maximum(SHARES // 32, -(-(SHARES**2 << bits) // ((SHARES - share.astype(np.int64)) << BITS))))

        keys, count, order = grouped(keyed(shifted(symbols, 1), symbols, n, n).reshape(-1), n * n)
        last, symbol = np.divmod(keys.astype(np.int64), n)
        total = np.bincount(last, count, n)
        # A symbol that came once in a context saves less than its place costs.
        rows = np.flatnonzero(count > 1)
        listed = rows[paying(last[rows], count[rows], total, chance[symbol[rows]], most1, np.zeros(n))]

        def order1() -> Model:
            share = shares(np.bincount(last[listed], count[listed], n), total, most1)
            return Model(different, frequency, Followers(share, last[listed], symbol[listed], count[listed], n, FINE))

        model = order1()
        low, high = model.below(last, symbol, *model.one.places(keys))
        # Any pair may be a context of order 2; order 1 lists it then, if it did not before.
        kind = spread(count, order, ids.shape)
        keys2, count2, order = grouped(keyed(shifted(kind + 1, 1), symbols, len(keys) + 1, n).reshape(-1), (len(keys) + 1) * n)
        context = keys2 // n  # a pair's place among all, from 1
        total2 = np.bincount(context, count2, len(keys) + 1)
        rows = np.flatnonzero((count2 > 1) & (context > 0))
        ends = kind.reshape(-1)[order[(np.cumsum(count2) - count2)[rows]]]  # the pairs of the last id and the symbol
        cost = np.full(len(keys) + 1, float(ENTRY))
        cost[listed + 1] = 0
        rows = rows[paying(context[rows], count2[rows], total2, (high - low)[ends] / FINE, most2(model.one.share[symbol]), cost)]
        listed = np.union1d(listed, context[rows] - 1)
        model = order1()
        at, hit = model.one.places(keys)
        low, high = model.below(last, symbol, at, hit)
        number = np.append(0, np.where(hit, at + 1, 0)).astype(np.int32)
        context, after = number[context], (keys2 % n).astype(np.int64)
        total2 = np.append(0, total2[listed + 1])
        share = shares(np.bincount(context[rows], count2[rows], len(total2)), total2, most2(model.one.share[symbol[listed]]))
        model.two = two = Followers(share, context[rows].astype(np.int64), after[rows], count2[rows], n, ONE)
        # Where a symbol has no place in order 2, nothing of that order is looked up.
        number[share[number] == 0] = 0
        some = np.flatnonzero(share[context])
        start, end = (part.astype(np.int32) for part in two.upto(context[some], *two.places(keyed(context[some], after[some], len(total2), n))))
        low, high = low.astype(np.int32), high.astype(np.int32)
        kind2 = np.zeros(ids.shape, np.int32)
        kind2.reshape(-1)[order[np.repeat(share[context] > 0, count2)]] = np.repeat(np.arange(len(some), dtype=np.int32), count2[some])
        context = shifted(number.take(kind + 1), 1)

        def spans(rows: slice) -> tuple[np.ndarray, np.ndarray]:
            lows, highs = low.take(kind[rows]), high.take(kind[rows])
            begins, ends = np.floor(lows * (ONE / FINE)), np.floor(highs * (ONE / FINE))
            at = context[rows].nonzero()
            left, place = two.left.take(context[rows][at]) * (1 / FINE), kind2[rows][at]
            begins[at] = start.take(place) + np.floor(lows[at] * left)
            ends[at] = end.take(place) + np.floor(highs[at] * left)
            return begins, ends - begins

        return model, symbols, spans

    def below(self, last: np.ndarray, symbols: np.ndarray, at: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the symbols start and end in FINE after ``last`` by the orders 1 and 0; ``at`` and ``hit`` are their places in order 1."""
        scale = self.scale.take(last)
        start, end = self.one.upto(last, at, hit)
        return start + scale * self.before.take(symbols), end + scale * self.upto.take(symbols)

    def span(self, context: np.ndarray, last: np.ndarray, symbols: np.ndarray, at: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the symbols start in ONE after the pairs ``context`` by all orders, and how much they take."""
        left = self.two.left.take(context) * (1 / FINE)
        low, high = (np.floor(part * left) for part in self.below(last, symbols, at, hit))
        start, end = self.two.upto(context, *self.two.places(keyed(context, symbols, len(self.two.share), len(self.ids))))
        return low + start, high + end - (low + start)

    def spans(self, symbols: np.ndarray) -> Callable:
        """What ``coded`` gives, for symbols that the model may not have been learned from."""
        last = shifted(symbols, 1)
        at, hit = self.one.places(keyed(last, symbols, len(self.ids), len(self.ids)))
        context = shifted(np.where(hit, at + 1, 0).astype(np.int32), 1)
        return lambda rows: self.span(context[rows], last[rows], symbols[rows], at[rows], hit[rows])

    def ranges(self) -> tuple[Ranges, Ranges, np.ndarray]:
        """The ranges of the followers of orders 1 and 2, and what each context of order 2 leaves.

        Contexts of order 2 without followers are one, 0; each range leads to that of the pair that its symbol ends.
        """
        one, two, n = self.one, self.two, len(self.ids)
        sizes = np.diff(two.first)
        some = np.flatnonzero(sizes)
        number = np.zeros(len(sizes), np.int32)
        number[some] = np.arange(1, len(some) + 1)
        at = np.arange(len(one.keys))
        first = Ranges(np.diff(one.first), *self.below(one.context, one.symbol, at, np.ones(len(at), bool)), one.high, one.symbol, number[at + 1], FINE)
        last = one.symbol.take(two.context - 1) if len(two.keys) else two.symbol
        at, hit = one.places(keyed(last, two.symbol, n, n))
        start, size = self.span(two.context, last, two.symbol, at, hit)
        leads = number.take(np.where(hit, at + 1, 0))
        return first, Ranges(np.append(0, sizes[some]), start, start + size, two.high, two.symbol, leads, ONE), np.append(ONE, two.left[some])

    def packed(self) -> bytes:
        columns = [np.diff(self.ids, prepend=0), self.frequency, *self.one.columns(), *self.two.columns()]
        planes = b"".join(np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns)
        return struct.pack("<III", len(self.ids), len(self.one.keys), len(self.two.keys)) + zlib.compress(planes, 1)

    @staticmethod
    def unpacked(data: bytes) -> Model:
        n, ones, twos = struct.unpack_from("<III", data)
        planes, at, columns = zlib.decompress(data[12:]), 0, []
        for size in (n, n, n, n, ones, ones, ones + 1, ones + 1, twos, twos):
            plane = np.frombuffer(planes, np.uint8, 4 * size, at).reshape(4, size)
            columns.append(np.ascontiguousarray(plane.T).view("<u4").reshape(-1).astype(np.int32))
            at += 4 * size
        return Model(np.cumsum(columns[0]), columns[1], Followers.restored(*columns[2:6], n, FINE), Followers.restored(*columns[6:], n, ONE))


def keyed(context: np.ndarray, symbols: np.ndarray, contexts: int, different: int) -> np.ndarray:
    """One number for a context and a symbol after it."""
    kind = np.int32 if contexts * different < 1 << 31 else np.int64
    return context.astype(kind, copy=False) * kind(different) + symbols.astype(kind, copy=False)


def grouped(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in ascending order, how often each comes, and the places of all, those of equal keys together."""
    bits = len(keys).bit_length()
    if bound.bit_length() + bits < 64:
        both = keys.astype(np.int64) << bits | np.arange(len(keys))
        both.sort()
        order = (both & ((1 << bits) - 1)).astype(np.int32 if bits < 32 else np.int64)
        both >>= bits
    else:
        order = keys.argsort(kind="stable")
        both = keys[order]
    ends = np.flatnonzero(np.append(both[1:] != both[:-1], np.ones(min(len(both), 1), bool)))
    return both[ends].astype(keys.dtype), np.diff(ends, prepend=-1), order


def spread(count: np.ndarray, order: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Which of the groups each place is in."""
    out = np.empty(shape, np.int32)
    out.reshape(-1)[order] = np.repeat(np.arange(len(count), dtype=np.int32), count)
    return out


def shifted(symbols: np.ndarray, by: int) -> np.ndarray:
    """What stood ``by`` steps before in each lane; 0 before its start."""
    out = np.zeros_like(symbols)
    out[by:] = symbols[:-by]
    return out


AT_ONCE = 1 << 16  # symbols whose places are worked out together


def write(model: Model, symbols: np.ndarray, spans: Callable | None = None) -> list[bytes]:
    """The blocks of the symbols (steps x lanes)."""
    steps, lanes = symbols.shape
    coder, spans = Encoder(lanes, steps), spans or model.spans(symbols)
    for at in range(0, steps, rows := max(1, AT_ONCE // lanes)):
        for span in zip(*spans(slice(at, at + rows)), strict=True):
            coder.narrow(*span)
    return coder.blocks()


def run(model: Model, blocks: list[bytes], steps: int) -> np.ndarray:
    """The ids (steps x lanes) of the blocks."""
    lanes = len(blocks)
    out = np.zeros((steps, lanes), np.int32)
    coder = Decoder(blocks)
    one, two, left2 = model.ranges()
    found = np.repeat(np.arange(len(model.ids), dtype=np.int32), model.frequency)
    pair = last = np.zeros(lanes, np.intp)
    for t in range(steps):
        target = coder.target()
        # What the target is for orders 1 and 0: the greatest whole number of FINE that starts no later.
        rest = target * (FINE // ONE) + (FINE // ONE - 1)
        if len(some := np.flatnonzero(pair)):
            goal, context = target.take(some), pair.take(some)
            at2, left = two.find(context, goal), left2.take(context)
            after2 = two.after.take(at2)
            in2 = goal < two.end.take(at2)
            rest[some] = np.where(in2, 0.0, np.floor(((goal - after2 + 1) * FINE - 1) / left))
        at1 = one.find(last, rest)
        low, high, now, next_pair = one.start.take(at1), one.end.take(at1), one.symbol.take(at1), one.leads.take(at1)
        if len(out1 := np.flatnonzero(rest >= high)):
            after1, scale = one.after.take(at1.take(out1)), model.scale.take(last.take(out1))
            now[out1] = other = found.take(((rest.take(out1) - after1) / scale).astype(np.intp), mode="clip")
            other = other.astype(np.intp)
            low[out1], high[out1], next_pair[out1] = after1 + scale * model.before.take(other), after1 + scale * model.upto.take(other), 0
        start, end = np.floor(low * (ONE / FINE)), np.floor(high * (ONE / FINE))
        if len(some):
            left *= 1 / FINE
            start[some] = np.where(in2, two.start.take(at2), after2 + np.floor(low.take(some) * left))
            end[some] = np.where(in2, two.end.take(at2), after2 + np.floor(high.take(some) * left))
            here, at2 = some[in2], at2[in2]
            now[here], next_pair[here] = two.symbol.take(at2), two.leads.take(at2)
        coder.narrow(start, end - start)
        out[t] = now
        last, pair = now.astype(np.intp), next_pair.astype(np.intp)
    return model.ids.take(out)


def id_sums(ids: np.ndarray) -> list[int]:
    """The checksum of each block's ids."""
    return [zlib.crc32(ids[at : at + BLOCK_IDS].astype("<u4")) for at in range(0, len(ids), BLOCK_IDS)]


HEAD = "<4sQQIBI"


def encode_frame(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A frame: header, document table, block table (bytes, their checksum and that of the ids), model, blocks.

    All ids of 31 bits can be coded; the header says whether a frame holds them whole or, if more than 2^20 of them
    are different, as two halves each.
    """
    if len(ids) and not 0 <= ids.min() <= ids.max() <= MOST_ID:
        raise ValueError(f"token ids lie between 0 and {MOST_ID}")
    ids = ids.astype(np.int32, copy=False)
    lanes = -(-len(ids) // BLOCK_IDS)
    parts = 2 if ids.max(initial=0) >= HALVES and len(np.unique(ids)) > HALVES else 1
    blocks, packed = [], b""
    if lanes:
        padded = np.full(lanes * BLOCK_IDS, ids[0], np.int32)
        padded[: len(ids)] = ids
        rows = padded.reshape(lanes, BLOCK_IDS)[:, : min(BLOCK_IDS, len(ids))]
        if parts == 2:
            rows = np.stack([rows >> 16, rows & 0xFFFF], axis=2).reshape(lanes, -1)
        model, symbols, spans = Model.coded(np.ascontiguousarray(rows.T))
        blocks, packed = write(model, symbols, spans), model.packed()
    table = b"".join(struct.pack("<III", len(b), zlib.crc32(b), c) for b, c in zip(blocks, id_sums(ids), strict=True))
    docs = doc_ids.astype("<i8").tobytes() + lengths.astype("<u8").tobytes()
    head = struct.pack(HEAD, MAGIC, len(doc_ids), len(ids), lanes, parts, len(packed)) + docs + table + packed
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks)


def decode_frame(frame: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, lengths and the ids of all documents of a frame; a damaged frame is an error."""
    fixed = struct.calcsize(HEAD)
    magic, n_docs, n_ids, lanes, parts, n_model = struct.unpack_from(HEAD, frame)
    if magic != MAGIC:
        raise ValueError("not a frame of token ids")
    start = fixed + 16 * n_docs + 12 * lanes
    end = start + n_model
    if end + 4 > len(frame) or zlib.crc32(frame[:end]) != struct.unpack_from("<I", frame, end)[0]:
        raise ValueError("the header of a frame is damaged")
    doc_ids = np.frombuffer(frame, "<i8", n_docs, fixed)
    lengths = np.frombuffer(frame, "<u8", n_docs, fixed + 8 * n_docs).astype(np.int64)
    table = np.frombuffer(frame, "<u4", 3 * lanes, fixed + 16 * n_docs).reshape(lanes, 3)
    blocks, at = [], end + 4
    for k, (size, check, _) in enumerate(table):
        block = frame[at : at + size]
        if zlib.crc32(block) != check:
            raise ValueError(f"block {k} is damaged")
        blocks.append(block)
        at += int(size)
    if not lanes:
        return doc_ids, lengths, np.empty(0, np.int32)
    found = run(Model.unpacked(frame[start:end]), blocks, min(BLOCK_IDS, n_ids) * parts)
    if parts == 2:
        found = found[::2] << 16 | found[1::2]
    ids = np.ascontiguousarray(found.T).reshape(-1)[:n_ids]
    for k, check in enumerate(id_sums(ids)):
        if check != table[k, 2]:
            raise ValueError(f"block {k} is damaged: its ids do not agree with their checksum")
    return doc_ids, lengths, ids
