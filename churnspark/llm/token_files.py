"""Token ids of documents as compressed binary frames, in document order, and their reading."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.chunks import NULL_ID, shown_id
from churnspark.llm.range_coder import BLOCK_IDS, decode_frame, encode_frame
from churnspark.llm.rows import blocks_of
from churnspark.llm.tokenizing import TOGETHER, byte_tokenizer, with_end
from churnspark.operators.ordering import with_running_total
from churnspark.session import shuffle_partitions, staged

END_ID = 2  # follows every document
FRAME_IDS = 4096 * BLOCK_IDS


class PieceTokenizer:
    """Encodes many texts as the tokenizer does, each different stretch of them once."""

    def __init__(self, path: str):
        self.tokenizer = byte_tokenizer(path)

    def arrays(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts with ``end_id`` after each, and how many each has."""
        return with_end(*self.tokenizer.encode_all(texts), end_id)

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, sizes = self.tokenizer.encode_all([t.encode() for t in texts])
        return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def write_token_frames(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode the texts and write frames of ids in ascending document order: rows (part, frame, payload).

    Documents are range-partitioned by id; ``part`` and ``frame`` follow that order. A frame holds whole
    documents and about two million ids; its blocks of 512 ids are coded independently after one model of the frame
    and carry a checksum each. A null or empty text has the end id alone. Rows with equal ids are ordered by text, a null id comes
    first. Extra columns are ignored; an empty table gives no rows. The frames are written to the shared folder.
    """
    texts = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    # Range bounds by id keep memory even only if ids are; a long run of long texts makes more frames, not larger ones.
    texts = texts.repartitionByRange(shuffle_partitions(docs.sparkSession), "id").sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceTokenizer(tokenizer)
        part, frame = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        runs: list[np.ndarray] = []
        lengths: list[int] = []
        total = 0

        def ready() -> pa.RecordBatch:
            nonlocal frame, ids, runs, lengths, total
            payload = encode_frame(np.array(ids, np.int64), np.array(lengths, np.int64), np.concatenate(runs))
            row = {"part": pa.array([part], pa.int32()), "frame": pa.array([frame], pa.int32()), "payload": pa.array([payload], pa.binary())}
            frame, ids, runs, lengths, total = frame + 1, [], [], [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            names, at = batch.column("id").to_pylist(), 0
            for texts in blocks_of(batch.column("text").cast(pa.large_binary()), **TOGETHER):
                found, sizes = pieces.arrays(texts, end_id)
                ends = np.cumsum(sizes).tolist()
                for name, n, end in zip(names[at:], sizes.tolist(), ends, strict=False):
                    ids.append(name)
                    lengths.append(n)
                    runs.append(found[end - n : end].astype(np.int32))
                    total += n
                    if total >= FRAME_IDS:
                        yield ready()
                at += len(texts)
        if ids:
            yield ready()

    return staged(texts.mapInArrow(write, "part int, frame int, payload binary"), "frames")


def read_token_frames(frames: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows (<id>, start, n_tokens, ids_crc32) from written frames; ``start`` counts the ids of all documents before."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, frame, payload in zip(batch.column("part"), batch.column("frame"), batch.column("payload"), strict=True):
                names, lengths, ids = decode_frame(payload.as_py())
                ends = np.cumsum(lengths)
                data = ids.astype("<u4")
                sums = [zlib.crc32(data[b - n : b]) for b, n in zip(ends, lengths, strict=True)]
                n = len(names)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(n, part.as_py(), np.int32)),
                    "frame": pa.array(np.full(n, frame.as_py(), np.int32)),
                    "id": pa.array(names.astype(np.int64)),
                    "before": pa.array(ends - lengths),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array(sums, pa.int64()),
                })

    rows = staged(frames.mapInArrow(read, "part int, frame int, id long, before long, n_tokens long, ids_crc32 long"), "tokens")
    sizes = rows.groupBy("part", "frame").agg(F.sum("n_tokens").alias("ids"))
    starts = with_running_total(sizes, ["part", "frame"], ["ids"])
    starts = starts.select("part", "frame", (F.col("ids_upto") - F.col("ids")).alias("offset"))
    return rows.join(starts, ["part", "frame"]).select(
        shown_id().alias(id_col), (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
