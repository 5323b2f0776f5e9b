"""Removal of word sequences that occur earlier in the corpus, found by difference-cover anchors."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.chunks import chunk_of, chunked, ordered_texts, shown_id, signed
from churnspark.llm.words import split_words, whole_windows, window_hashes, word_hashes

# Difference covers: for any two residues there is a shift that takes both into the cover.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves an anchor at least a third of the window."""
    period = max(p for p in COVERS if p <= max(1, 2 * (window + 1) // 3))
    return period, COVERS[period]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Return per row of ``docs`` (<id>, n_words, n_removed, kept_text).

    Words are runs without ASCII white space. A word goes when it lies in a window of ``window`` words whose
    sequence also starts earlier: at a smaller id, or earlier in the same text. Windows are judged on the input.

    Anchors are shorter windows that start only at cover positions modulo the period. Two equal windows share
    an aligned anchor, so a window is extended to its full width and compared only if one of its anchors occurs
    twice. Equal anchors and equal windows meet by hash (64 and 96 bits), one row per chunk.

    Null and empty texts have no words and an empty kept text. Rows with equal ids are ordered by text; of equal
    rows one counts as the earlier. A null id is the smallest. Extra columns are ignored; an empty table gives
    no rows.
    """
    period, cover = cover_for(window)
    width = window - period + 1

    def anchors_of(words, hashes):
        at = whole_windows(words, width)
        pos = at - words.first[words.text_of[at]]
        at = at[np.isin(pos % period, cover)]
        return at, window_hashes(hashes, width)[at] if len(at) else np.empty(0, np.uint64)

    def anchors(table: pa.Table) -> pa.Table:
        _, texts = ordered_texts(table)
        words = split_words(texts)
        found = np.unique(anchors_of(words, word_hashes(words))[1])
        chunk = table["chunk"][0].as_py()
        return pa.table({"chunk": pa.array(np.full(len(found), chunk)), "hash": signed(found)})

    def extended(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = ordered_texts(left)
        words = split_words(texts)
        hashes = word_hashes(words)
        at, anchor = anchors_of(words, hashes)
        _, back, count = np.unique(anchor, return_inverse=True, return_counts=True)
        repeated = np.isin(anchor, right["hash"].to_numpy().view(np.uint64)) | (count[back] > 1)
        before = np.zeros(len(hashes) + 1, np.int64)
        before[at[repeated] + 1] = 1
        before = np.cumsum(before)
        full = whole_windows(words, window)
        full = full[before[full + period] > before[full]]
        one = window_hashes(hashes, window)[full] if len(full) else np.empty(0, np.uint64)
        one, where = np.unique(one, return_index=True)
        full = full[where]
        two = window_hashes(word_hashes(words, 1), window, 1)[full] if len(full) else one
        return pa.table({
            "hash": signed(one),
            "hash2": pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32)),
            "id": pa.array(ids[words.text_of[full]].astype(np.int64)),
        })

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = ordered_texts(left)
        words = split_words(texts)
        full = whole_windows(words, window)
        found = window_hashes(word_hashes(words), window)[full] if len(full) else np.empty(0, np.uint64)
        later = np.ones(len(full), bool)
        later[np.unique(found, return_index=True)[1]] = False
        later |= np.isin(found, right["hash"].to_numpy().view(np.uint64))
        n = len(words.starts)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, full[later], 1)
        np.add.at(edge, full[later] + window, -1)
        keep = np.cumsum(edge)[:n] == 0
        kept = [
            b" ".join(compress((t or b"").split(), keep[a:b].tolist()))
            for t, a, b in zip(texts, words.first[:-1], words.first[1:], strict=True)
        ]
        n_words = np.diff(words.first)
        gone = np.concatenate([[0], np.cumsum(~keep)])
        return pa.table({
            "id": pa.array(ids.astype(np.int64)),
            "n_words": pa.array(n_words.astype(np.int64)),
            "n_removed": pa.array((gone[words.first[1:]] - gone[words.first[:-1]]).astype(np.int64)),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        })

    texts, n_chunks = chunked(docs, id_col, text_col)
    by_chunk = texts.groupBy("chunk")
    shared = (
        by_chunk.applyInArrow(anchors, "chunk long, hash long")
        .withColumn("n", F.count("*").over(Window.partitionBy("hash")))
        .where("n > 1")
        .select("chunk", "hash")
    )
    windows = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(extended, "hash long, hash2 int, id long")
    elsewhere = (
        windows.withColumn("lowest", F.min("id").over(Window.partitionBy("hash", "hash2")))
        .where("id > lowest")
        .select(chunk_of("id", n_chunks).alias("chunk"), "hash")
    )
    result = by_chunk.cogroup(elsewhere.groupBy("chunk")).applyInArrow(
        cut, "id long, n_words long, n_removed long, kept_text string"
    )
    return result.select(shown_id().alias(id_col), "n_words", "n_removed", "kept_text")
