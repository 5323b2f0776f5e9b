"""Documents in chunks of bounded size: the unit in which Python code sees texts.

A chunk holds the documents of one hash bucket of the id; the number of chunks follows the bytes of text, so
a chunk stays at a few megabytes at any corpus size (one longer text makes one longer chunk).
Chunks talk to each other through small keyed rows, at most one per chunk and key: a key that very many
documents share costs one row per chunk, not one per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
NULL_ID = -(1 << 63)  # stands for a null id and so sorts first


def chunked(docs: DataFrame, id_col: str, text_col: str, null_id: int = NULL_ID) -> tuple[DataFrame, int]:
    """Rows (chunk, id, text), all other columns left out, and the number of chunks."""
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(null_id)).alias("id"), docs[text_col].alias("text"))
    n = chunk_count(rows)
    return rows.select(chunk_of("id", n).alias("chunk"), "id", "text"), n


def chunk_count(rows: DataFrame) -> int:
    """How many chunks the column ``text`` fills."""
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    return max(1, -(-int(total) // CHUNK_BYTES))


def chunk_of(id_col: str, n: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(n).cast("long"))


def shown_id(col: str = "id", null_id: int = NULL_ID) -> Column:
    return F.when(F.col(col) != null_id, F.col(col))


def ordered_texts(table: pa.Table) -> tuple[np.ndarray, list[bytes | None]]:
    """Ids and UTF-8 texts of a chunk in ascending (id, text) order."""
    ids = table["id"].to_numpy()
    texts = table["text"].cast(pa.large_binary()).to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or b""))
    return ids[order], [texts[i] for i in order]


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark's long."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
