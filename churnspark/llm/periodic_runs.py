"""Periodic stretches of words, found in a grammar of each text.

Re-Pair replaces word pairs that a text repeats by nonterminals until no pair is left twice; what remains is
joined by a balanced tree. Every run crosses the middle of the smallest node that holds it, so it is enough to
look across the middle of each nonterminal once, to carry the findings to all places the nonterminal derives,
and to merge what overlaps.
"""

from __future__ import annotations

from itertools import chain, compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from churnspark.llm.rows import blocks_of
from churnspark.llm.words import MODULUS, mixed, prime_powers, prime_product, prime_sums

SLICE = 1 << 21  # pairs of words compared at a time

RUNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Nodes(NamedTuple):
    """Nodes of the derivation trees: where the two halves lie, and which nonterminal it is."""

    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray
    name: np.ndarray


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts, one after the other, with a sign of its own (negative) before and after each, and
    where each text begins."""
    flat = list(chain.from_iterable(texts))
    names = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths + 1) - lengths
    words = np.empty(len(flat) + len(texts) + 1, np.int64)
    gaps = np.concatenate([[0], first + lengths])
    inside = np.ones(len(words), bool)
    inside[gaps] = False
    words[gaps] = -1 - np.arange(len(gaps))
    words[inside] = np.fromiter(map(names.__getitem__, flat), np.int64, len(flat))
    return words, first


def pair_names(text: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """One number for each distinct (text, left, right); symbols are below ``n``."""
    one = text * n + left
    if int(text.max(initial=0) + 1) * n * n >= 1 << 63:
        one = np.unique(one, return_inverse=True)[1]
    return np.unique(one * n + right, return_inverse=True)[1]


def grammar(words: np.ndarray, first: np.ndarray) -> Nodes:
    """Re-Pair within each text: all occurrences of all nonterminals, then the nodes of the tree over the rest.

    A round replaces every pair that is more frequent than the pairs it overlaps with (ties by a hash); of a
    stretch of equal symbols every second pair. Rounds end when no text holds a pair twice.
    """
    symbol = words.copy()
    n = len(words)
    place = np.arange(n)
    after, before = place + 1, place - 1
    text = np.cumsum(words < 0) - 1
    alive = np.ones(n, bool)
    rank = np.zeros(n + 1, np.int64)  # how good the pair that starts here is; 0 if it must not be replaced now
    twin = np.zeros(n + 1, np.int64)
    live = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0))
    fresh = int(words.max(initial=0)) + 1
    found: list[Nodes] = []
    while len(live):
        name = pair_names(text[live], symbol[live], symbol[after[live]], fresh)
        count = np.bincount(name)
        often = count[name] > 1
        live, name = live[often], name[often]
        if not len(live):
            break
        # Every second pair of a stretch of equal pairs.
        twin[live] = name + 1
        begins = twin[before[live]] != name + 1
        turn = np.arange(len(live)) - np.maximum.accumulate(np.where(begins, np.arange(len(live)), 0))
        even = turn % 2 == 0
        order = (count[name] << np.int64(32)) | (mixed(name.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) + 1
        rank[live[even]] = order[even]
        best = even & (order > rank[before[live]]) & (order > rank[after[live]])
        if not best.any():  # equal hashes side by side: the first of the most frequent goes alone
            best[np.flatnonzero(even)[np.argmax(order[even])]] = True
        twin[live] = 0
        rank[live] = 0
        i = live[best]
        j = after[i]
        k = after[j]
        _, new = np.unique(name[best], return_inverse=True)
        found.append(Nodes(i, j, k, new + fresh))
        symbol[i] = new + fresh
        fresh += int(new.max()) + 1
        after[i], before[k] = k, i
        alive[j] = False
        rest = live[~best]
        live = np.unique(np.concatenate([rest[alive[rest]], i, before[i]]))
        live = live[(symbol[live] >= 0) & (symbol[after[live]] >= 0)]
    left = np.flatnonzero(alive)
    left, own = left[words[left] >= 0], text[left[words[left] >= 0]]
    ends = np.append(first[1:] - 1, n - 1)  # of each text
    while len(left):
        at = np.arange(len(left)) - np.searchsorted(own, own)
        odd = np.flatnonzero(at % 2 == 1)
        if not len(odd):
            break
        following = np.append(odd + 1, 0)[: len(odd)]
        more = (following < len(left)) & (own[np.minimum(following, len(left) - 1)] == own[odd])
        end = np.where(more, left[np.minimum(following, len(left) - 1)], ends[own[odd]])
        found.append(Nodes(left[odd - 1], left[odd], end, fresh + np.arange(len(odd))))
        fresh += len(odd)
        left, own = left[at % 2 == 0], own[at % 2 == 0]
    if not found:
        none = np.empty(0, np.int64)
        return Nodes(none, none, none, none)
    return Nodes(*(np.concatenate(c) for c in zip(*found, strict=True)))


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges, and the range that each comes from."""
    n = np.maximum(ends - starts, 0)
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) + np.repeat(starts - np.cumsum(n) + n, n), which


class Stretches:
    """How far two places of the words agree, by hashes in the field of 2^61 - 1 elements."""

    def __init__(self, words: np.ndarray, seed: int):
        base = int(mixed(np.array([seed * 2 + 1], np.uint64))[0]) % MODULUS
        self.power = prime_powers(base, len(words))
        values = mixed(words.astype(np.uint64) + np.uint64(seed)) % np.uint64(MODULUS)
        self.sums = prime_sums(prime_product(values, self.power[:-1]))

    def equal(self, one: np.ndarray, two: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ``n`` words from ``one`` equal those from ``two``, which is not before it."""
        p = np.uint64(MODULUS)
        a = (self.sums[one + n] + p - self.sums[one]) % p
        b = (self.sums[two + n] + p - self.sums[two]) % p
        return prime_product(a, self.power[two - one]) == b

    def forward(self, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(one), np.int64), np.maximum(most, 0)
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(one, two, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def back(self, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words that end with the given places."""
        low, high = np.zeros(len(one), np.int64), np.maximum(most, 0)
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(one - half + 1, two - half + 1, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def crossing(words: np.ndarray, nodes: Nodes, least: int, seed: int) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the periodic stretches within each node that cross its middle, with at
    least two periods and ``least`` words.

    Such a stretch has a whole period on one side of the middle: then the word before the middle comes again a
    period later, or the word after it came a period before.
    """
    size = nodes.end - nodes.start
    parts: list[tuple[np.ndarray, ...]] = []
    agree = None
    upto = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right")))
        start, middle, end = (c[at:to] for c in nodes[:3])
        half = size[at:to] // 2
        later, a = ranges(middle, np.minimum(end, middle + half))
        one, two = middle[a] - 1, later
        same = words[one] == words[two]
        a, one, two = a[same], one[same], two[same]
        earlier, b = ranges(np.maximum(start, middle - half), middle)
        same = words[earlier] == words[middle[b]]
        a, one, two = np.concatenate([a, b[same]]), np.concatenate([one, earlier[same]]), np.concatenate([two, middle[b[same]]])
        if least > 2:  # then a neighbouring pair of words agrees as well
            near = (words[one + 1] == words[np.minimum(two + 1, len(words) - 1)]) | (words[one - 1] == words[two - 1])
            a, one, two = a[near], one[near], two[near]
        if len(a):
            agree = agree or Stretches(words, seed)
            ahead = agree.forward(one, two, end[a] - two)
            behind = agree.back(one, two, one - start[a] + 1)
            period, low, high = two - one, one + 1 - behind, two + ahead
            good = high - low >= np.maximum(2 * period, least)
            parts.append((a[good] + at, low[good], high[good], period[good]))
        at = to
    if not parts:
        return (np.empty(0, np.int64),) * 4
    node, low, high, period = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((period, high, low, node))
    node, low, high, period = node[order], low[order], high[order], period[order]
    new = np.ones(len(node), bool)  # of the same stretch only the smallest period
    new[1:] = (node[1:] != node[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return node[new], low[new], high[new], period[new]


def merged(low: np.ndarray, high: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one period that overlap by at least it are one; the result is ordered by start, then period,
    and of the same interval has the smallest period only."""
    if not len(low):
        return low, high, period
    order = np.lexsort((low, period))
    low, high, period = low[order], high[order], period[order]
    group = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]]))
    far = group * (int(high.max()) + 1)
    reach = np.maximum.accumulate(high + far) - far
    new = np.ones(len(low), bool)
    new[1:] = (group[1:] != group[:-1]) | (low[1:] > reach[:-1] - period[1:])
    at = np.flatnonzero(new)
    low, high, period = low[at], np.maximum.reduceat(high, at), period[at]
    order = np.lexsort((period, high, low))
    low, high, period = low[order], high[order], period[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    low, high, period = low[new], high[new], period[new]
    order = np.lexsort((period, low))
    return low[order], high[order], period[order]


def true_runs(words: np.ndarray, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> bool:
    """Whether all intervals have their period and cannot be extended, word by word."""
    if (words[low - 1] == words[low - 1 + period]).any() or (words[high] == words[high - period]).any():
        return False
    upto = np.cumsum(high - low)
    at = 0
    while at < len(low):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right")))
        place, which = ranges(low[at:to], high[at:to] - period[at:to])
        if (words[place] != words[place + period[at:to][which]]).any():
            return False
        at = to
    return True


def runs_of(words: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs of the numbered words."""
    nodes = grammar(words, first)
    big = nodes.end - nodes.start >= max(least, 2)
    nodes = Nodes(*(c[big] for c in nodes))
    _, chosen, name = np.unique(nodes.name, return_index=True, return_inverse=True)
    once = Nodes(*(c[chosen] for c in nodes))
    seed = 1
    while True:
        node, low, high, period = crossing(words, once, least, seed)
        # To all places that derive the nonterminal.
        count = np.bincount(node, minlength=len(chosen))
        begin = np.cumsum(count) - count
        which, place = ranges(begin[name], begin[name] + count[name])
        shift = nodes.start[place] - once.start[node[which]]
        found = merged(low[which] + shift, high[which] + shift, period[which])
        if true_runs(words, *found):
            return found
        seed += 1  # two different stretches had the same hash


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """Return per row of ``docs`` (<id>, n_words, runs, collapsed).

    Words are runs without ASCII white space, numbered from 0. ``runs`` lists, by start and then period, the
    stretches of words with smallest period p that have at least two periods and ``least`` words and that no
    neighbouring word extends. ``collapsed`` is the text without the words that lie in a run after its first p
    words, joined by one space. Rows are independent of each other; no row leaves its task.

    Null and empty texts have no words, no runs and an empty collapsed text. Rows with null or repeated ids are
    rows like others. Extra columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def block(raw: list[bytes | None]) -> list[pa.Array]:
        split = [(t or b"").split() for t in raw]
        words, first = numbered(split)
        low, high, period = runs_of(words, first, least)
        n = np.array([len(s) for s in split], np.int64)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, low + period, 1)
        np.add.at(edge, high, -1)
        keep = np.cumsum(edge) == 0
        own = np.searchsorted(first, low, "right") - 1
        bounds = np.searchsorted(own, np.arange(len(raw) + 1))
        struct = pa.StructArray.from_arrays(
            [pa.array(low - first[own]), pa.array(high - low), pa.array(period)], ["start", "length", "period"]
        )
        some = set(own.tolist())
        kept = [
            b" ".join(compress(s, keep[a : a + len(s)].tolist()) if i in some else s)
            for i, (s, a) in enumerate(zip(split, first.tolist(), strict=True))
        ]
        runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct)
        return [pa.array(n), runs, pa.array(kept, pa.binary()).cast(pa.string())]

    def run(batches):
        for batch in batches:
            start = 0
            for raw in blocks_of(batch.column(1).cast(pa.large_binary())):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(raw)), *block(raw)], names=[id_col, "n_words", "runs", "collapsed"]
                )
                start += len(raw)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {RUNS}")
