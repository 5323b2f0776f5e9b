"""Alignment of the tokens of two tokenizers over the same bytes, and how many documents link each pair of ids.

Ids of both vocabularies with the same bytes are paired beforehand. Groups of one token each are of that kind
nearly always and are counted in vectors as long as the vocabulary; only other groups make pairs that are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.rows import blocks_of
from churnspark.llm.tokenizing import IDS, byte_tokenizer, kept, piece_tokenizer, pieces
from churnspark.session import staged

SHIFT = 20  # a pair is one number: the first id, shifted, and the second
HOT = 1 << 16  # pairs that hold more than this part of all occurrences travel with the code; there are fewer of them
EXPANDED = 1 << 22  # links made at a time
SHOWN = 8  # bytes of a decimal id and its sign, at most
REMEMBERED = 300_000  # pieces of text in a generation of the memory
_OTHER = re.compile("[^\x00-\u024f]|\\S{400}|\\s{400}")

# Fixed value: how byte-level tokenizers of this kind cut a text into stretches.
STRETCHES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Vocabularies:
    """The two tokenizers side by side: sizes and texts of their entries, and pieces of text encoded by both."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_tokenizer(path_a, True), piece_tokenizer(path_b)
        self.bytes_a, self.bytes_b = self.a.entry_bytes(), self.b.bytes
        self.size_a, self.size_b = (np.array([*map(len, entries)], np.int64) for entries in (self.bytes_a, self.bytes_b))
        by_bytes = {entry: i for i, entry in enumerate(self.bytes_b)}  # of entries with the same bytes the last
        self.same = np.array([by_bytes.get(entry, -1) for entry in self.bytes_a], np.int64)  # ids of B by ids of A, or -1
        # Decimal ids with the sign that follows (within A, at its end, within B, at its end), in rows of eight bytes.
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        shown = [b"%d%s" % (i, sign) for sign, n in ((b",", n_a), (b"|", n_a), (b",", n_b), (b";", n_b)) for i in range(n)]
        self.shown_size = np.array([*map(len, shown)], np.int64)
        self.shown = np.array(shown, f"S{SHOWN}").view(np.uint8).reshape(-1, SHOWN)
        # Encodes a whole text by the same entries and ranks; used where no library sees other letters or long words.
        special = set(self.a.tokenizer.get_added_tokens_decoder())
        ranks = {entry: i for i, entry in enumerate(self.bytes_a) if i not in special}
        self.quick = tiktoken.Encoding("aligned", pat_str=STRETCHES, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}  # ids of B for pieces of text, and the generation before
        self.older: dict[str, bytes] = {}
        self.lossy: set[str] = set()  # pieces whose bytes B does not give back

    def whole(self, ids: bytes, entries: list[bytes]) -> bytes:
        return b"".join(map(entries.__getitem__, np.frombuffer(ids, IDS).tolist()))

    def learn(self, new: list[str]) -> None:
        """Encode pieces by B, each after a space."""
        ids = [array("I", found).tobytes() if piece else self.b.alone for piece, found in zip(new, self.b.model.encode(new, num_threads=1), strict=True)]
        raw = [(" " + piece).encode() for piece in new]
        sizes = np.add.reduceat(np.append(self.size_b[np.frombuffer(b"".join(ids), IDS)], 0), np.cumsum([0, *(len(i) // 4 for i in ids)])[:-1])
        if sizes.tolist() != [*map(len, raw)] or self.whole(b"".join(ids), self.bytes_b) != b"".join(raw):
            self.lossy.update(p for p, i, r in zip(new, ids, raw, strict=True) if self.whole(i, self.bytes_b) != r)
        self.known.update(zip(new, ids, strict=True))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of a space and the text by A and B; nothing for texts that one of them does not give back."""
        cut = [pieces(" " + t) if t and self.b.apart and self.b.SPACE not in t else None for t in texts]
        cut = [c if c and not c[0] else None for c in cut]  # white space at the start: not by pieces
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        wanted = set().union(*(c[1:] for c in cut if c)).difference(self.known)
        self.known.update({p: self.older[p] for p in wanted if p in self.older})
        if new := list(wanted.difference(self.known)):
            self.learn(new)
        out = []
        for text, parts in zip(texts, cut, strict=True):
            plain = not _OTHER.search(text)
            a = array("I", self.quick.encode_ordinary(" " + text)).tobytes() if plain else self.a.encode(" " + text)
            if not text:
                a = b = b""
            elif parts:
                b = b"".join(map(self.known.__getitem__, parts[1:]))
                if self.lossy and not self.lossy.isdisjoint(parts[1:]):
                    a = b = b""
            else:
                b, raw = self.b.encode(text), (" " + text).encode()
                if self.whole(a, self.bytes_a) != raw or self.whole(b, self.bytes_b) != raw:
                    a = b = b""
            out.append((a, b))
        return out


def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return kept(("vocabularies", path_a, path_b), lambda: Vocabularies(path_a, path_b))


class Aligned(NamedTuple):
    """Documents of a block, in order: their numbers, and their distinct links with how often each occurs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    shown: list[bytes]
    document: np.ndarray  # of each distinct link, ascending
    pair: np.ndarray
    times: np.ndarray


def counted(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their times."""
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    return key[at], np.add.reduceat(times, at) if len(at) else times


def align(texts: list[str], path_a: str, path_b: str) -> Aligned:
    """At most 2^20 texts."""
    v = vocabularies(path_a, path_b)
    raw = v.encode(texts)
    n_a, n_b = (np.array([len(r[k]) // 4 for r in raw], np.int64) for k in (0, 1))
    a, b = (np.frombuffer(b"".join([r[k] for r in raw]), IDS).astype(np.int64) for k in (0, 1))
    # Both sides tile the same bytes, so ends can be compared across the whole block.
    end_a, end_b = np.cumsum(v.size_a[a]), np.cumsum(v.size_b[b])
    total = int(end_a[-1]) if len(end_a) else 0
    cut = np.zeros(total + 1, np.int8)
    cut[end_a] = 1
    cut[end_b] += 1
    before = np.cumsum(cut == 2)  # groups that end up to here
    group_a, group_b = before[end_a - 1], before[end_b - 1]
    groups = int(before[-1])
    in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    document = np.repeat(np.arange(len(texts)), n_a)[first_a]
    n_groups = np.bincount(document, minlength=len(texts))
    n_links = np.bincount(document, in_a * in_b, len(texts)).astype(np.int64)

    # The groups as text: tokens of both sides in their order, each with the sign after it.
    sizes = len(v.size_a), len(v.size_b)
    line = np.empty(len(a) + len(b), np.int64)
    line[np.arange(len(a)) + first_b[group_a]] = a
    line[np.arange(len(b)) + (first_a + in_a)[group_b]] = b + 2 * sizes[0]
    line[first_a + first_b + in_a - 1] += sizes[0]
    line[first_a + first_b + in_a + in_b - 1] += sizes[1]
    long = v.shown_size[line]
    text = v.shown[line][np.arange(SHOWN) < long[:, None]].tobytes()
    upto = np.concatenate([[0], np.cumsum(long)])[np.cumsum(n_a + n_b)].tolist()
    shown = [text[x : max(x, y - 1)] for x, y in zip([0, *upto[:-1]], upto, strict=True)]

    # Groups of one token each make one link; in the others, every distinct id of one side with every one of the other.
    single = (in_a == 1) & (in_b == 1)
    key, times = np.unique(document[single] << 2 * SHIFT | a[first_a[single]] << SHIFT | b[first_b[single]], return_counts=True)
    made = [(key, times)]
    more_a, more_b = ~single[group_a], ~single[group_b]
    key_a, t_a = counted(group_a[more_a] << SHIFT | a[more_a], np.ones(int(more_a.sum()), np.int64))
    key_b, t_b = counted(group_b[more_b] << SHIFT | b[more_b], np.ones(int(more_b.sum()), np.int64))
    g_a, g_b, ids = key_a >> SHIFT, key_b >> SHIFT, (1 << SHIFT) - 1
    distinct_b = np.bincount(g_b, minlength=groups)
    begin, many = (np.cumsum(distinct_b) - distinct_b)[g_a], distinct_b[g_a]
    upto = np.cumsum(many)
    at = 0
    while at < len(g_a):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + EXPANDED, "right")))
        left = np.repeat(np.arange(at, to), many[at:to])
        right = np.arange(len(left)) - np.repeat(upto[at:to] - many[at:to] - (upto[at] - many[at]), many[at:to]) + begin[left]
        key = document[g_a[left]] << 2 * SHIFT | (key_a[left] & ids) << SHIFT | key_b[right] & ids
        made.append(counted(key, t_a[left] * t_b[right]))
        at = to
    key, times = counted(*(np.concatenate(c) for c in zip(*made, strict=True)))
    return Aligned(n_a, n_b, n_groups, n_links, shown, key >> 2 * SHIFT, key & (1 << 2 * SHIFT) - 1, times)


LINKED = "block long, kind int, id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def align_tokenizers(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = True
) -> DataFrame:
    """Return per row of ``docs`` (<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    Tokenizer A (byte-level) encodes a space and the text, tokenizer B (sentence pieces) the text, before which it
    puts a space; strings of special tokens are ordinary text. Bytes at which tokens of both end cut the tokens
    into groups, and all tokens of a group are linked across. ``groups`` lists the ids by group, or holds the
    sha256 of that list. A pair of ids counts the documents that hold it linked; ``n_best`` counts the links whose
    pair has the highest count of its A id, ``count_sum`` adds up the counts of all links.

    * One pass encodes and aligns. Pairs of ids with the same bytes are counted in a vector of the size of the
      vocabulary for each task; of the other pairs the distinct ones of a block of texts are shuffled, with the
      number of documents, and added up.
    * Vectors, the highest count of each A id and the pairs with more than 1/65536 of all occurrences (fewer
      than 65536 pairs) travel with the code of the second pass. Counts of the rarer pairs go to the blocks that
      hold them; no pair that needs this is frequent.

    Texts that are null, empty or not given back byte by byte by both tokenizers have no tokens: zeros and an
    empty ``groups``. Rows with null or repeated ids are documents of their own. Extra columns are ignored; an
    empty table gives no rows.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = LINKED.format(id=kind)
    names = [part.split()[0] for part in schema.split(", ")]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(byte_path, piece_path)
        block = TaskContext.get().partitionId() << 32
        same = np.zeros(len(v.same), np.int64)  # documents that link an A id with the id of the same bytes

        def record(kind_: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
            fixed = {"block": pa.array(np.full(n, block)), "kind": pa.array(np.full(n, kind_, np.int32))}
            columns = fixed | columns
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, arrow[c]) for c in names], names=names)

        arrow: dict[str, pa.DataType] = {
            "block": pa.int64(), "kind": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
            "n_links": pa.int64(), "groups": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64()),
        }
        for batch in batches:
            arrow["id"] = batch.column(0).type
            at = 0
            for raw in blocks_of(batch.column(1).cast(pa.large_binary())):
                found = align([(t or b"").decode() for t in raw], byte_path, piece_path)
                irregular = v.same[found.pair >> SHIFT] != found.pair & (1 << SHIFT) - 1
                same += np.bincount(found.pair[~irregular] >> SHIFT, minlength=len(same))
                bounds = np.searchsorted(found.document, np.arange(len(raw) + 1)).astype(np.int32)
                shown = [hashlib.sha256(g).hexdigest() if g else "" for g in found.shown] if digest else [g.decode() for g in found.shown]
                yield record(
                    0, len(raw),
                    id=batch.column(0).slice(at, len(raw)),
                    n_a=pa.array(found.n_a), n_b=pa.array(found.n_b), n_groups=pa.array(found.n_groups), n_links=pa.array(found.n_links),
                    groups=pa.array(shown, pa.string()),
                    pairs=pa.ListArray.from_arrays(bounds, pa.array(found.pair)), times=pa.ListArray.from_arrays(bounds, pa.array(found.times)),
                )
                pairs, n = np.unique(found.pair[irregular], return_counts=True)
                yield record(1, 1, pairs=pa.array([pairs], pa.list_(pa.int64())), times=pa.array([n.astype(np.int64)], pa.list_(pa.int64())))
                block += 1
                at += len(raw)
        some = np.flatnonzero(same)
        if len(some):
            yield record(2, 1, pairs=pa.array([some], pa.list_(pa.int64())), times=pa.array([same[some]], pa.list_(pa.int64())))

    linked = staged(rows.mapInArrow(link, schema), "linked")

    def listed(kind_: int) -> DataFrame:
        part = linked.where(F.col("kind") == kind_).select("block", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        return part.select("block", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))

    same = listed(2).groupBy("pair").agg(F.sum("n").alias("n")).collect()  # at most as many rows as A has ids
    counts = staged(listed(1).groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * HOT > total)  # fewer than HOT rows, as their counts add up to no more than the total
    highest = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("n")).collect()  # one row per A id at most
    hot_rows = sorted((r["pair"], r["n"]) for r in hot.collect())
    cold = listed(1).select("block", "pair").join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(counts, "pair")
    cold = cold.select(F.col("block").alias("to_block"), "pair", "n")
    same_n = {r["pair"]: r["n"] for r in same}
    best = dict(same_n)
    for r in highest:
        best[r["a"]] = max(best.get(r["a"], 0), r["n"])
    same_at = np.array([*same_n], np.int64), np.array([*same_n.values()], np.int64)
    best_at = np.array([*best], np.int64), np.array([*best.values()], np.int64)
    hot_at = np.array([p for p, _ in hot_rows] or [-1], np.int64), np.array([n for _, n in hot_rows] or [0], np.int64)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        v = vocabularies(byte_path, piece_path)
        of_same, of_best = np.zeros(len(v.same), np.int64), np.zeros(len(v.same), np.int64)
        of_same[same_at[0]], of_best[best_at[0]] = same_at[1], best_at[1]
        pairs = left["pairs"].combine_chunks()
        pair, times = pairs.flatten().to_numpy(), left["times"].combine_chunks().flatten().to_numpy()
        own = np.repeat(np.arange(len(pairs)), pairs.value_lengths().to_numpy())
        a = pair >> SHIFT
        known = v.same[a] == pair & (1 << SHIFT) - 1
        count = np.where(known, of_same[a], 0)
        there = hot_at[0][np.minimum(np.searchsorted(hot_at[0], pair), len(hot_at[0]) - 1)] == pair
        count = np.where(there & ~known, hot_at[1][np.minimum(np.searchsorted(hot_at[0], pair), len(hot_at[0]) - 1)], count)
        if right.num_rows:
            rare, n = right["pair"].to_numpy(), right["n"].to_numpy()
            order = np.argsort(rare)
            rare, n = rare[order], n[order]
            at = np.minimum(np.searchsorted(rare, pair), len(rare) - 1)
            count = np.where(~known & ~there & (rare[at] == pair), n[at], count)
        n_best = np.bincount(own, times * (count == of_best[a]), len(pairs)).astype(np.int64)
        count_sum = np.zeros(len(pairs), np.int64)
        np.add.at(count_sum, own, times * count)
        return pa.table({
            id_col: left["id"], "n_a": left["n_a"], "n_b": left["n_b"], "n_groups": left["n_groups"], "n_links": left["n_links"],
            "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups": left["groups"],
        })

    documents = linked.where(F.col("kind") == 0).drop("kind")
    out = f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return documents.groupBy("block").cogroup(cold.groupBy("to_block")).applyInArrow(score, out)
