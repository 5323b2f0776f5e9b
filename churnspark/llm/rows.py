"""Python columns beside the columns of a frame, computed batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 256


def blocks_of(texts: pa.Array, most: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[list[bytes | None]]:
    """Texts of a column as UTF-8, in runs of about ``most`` bytes, a megabyte (a longer text is a run of its own)."""
    run, size = [], 0
    for value in texts:
        text = value.as_py()
        run.append(text)
        size += len(text or b"")
        if size >= most or len(run) >= rows:
            yield run
            run, size = [], 0
    if run:
        yield run


def with_text_columns(
    df: DataFrame, text_col: str, function: Callable[[list[bytes | None]], dict[str, pa.Array]], schema: T.StructType
) -> DataFrame:
    """All columns of ``df`` and those that ``function`` returns for runs of texts; a column of the same name is replaced."""
    new = schema.fieldNames()
    keep = [f for f in df.schema.fields if f.name not in new]
    out = T.StructType(keep + schema.fields)
    at = df.columns.index(text_col)
    kept = [i for i, f in enumerate(df.schema.fields) if f.name not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for texts in blocks_of(batch.column(at).cast(pa.large_binary())):
                made = function(texts)
                part = batch.slice(start, len(texts))
                start += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in kept] + [made[n] for n in new], names=[out.fieldNames()[i] for i in range(len(out))]
                )

    return df.mapInArrow(run, out)
