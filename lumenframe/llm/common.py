"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: maps the bytes of A-Z to a-z and leaves all others, so UTF-8 stays UTF-8.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Text handled at once inside a task; a single longer text is still handled whole.
PIECE_BYTES = 4 << 20


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor``; null for null."""
    return F.pmod(F.crc32(column.cast("string")), F.lit(divisor))


def held_out(column: Column, divisor: int, rest: int) -> Column:
    """True where ``remainder`` is ``rest``; a null id is never held out."""
    return F.coalesce(remainder(column, divisor) == rest, F.lit(False))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(data: bytes | None) -> list[bytes]:
    """Lower-cased words between ASCII blanks (space and 9 to 13); none for null."""
    return data.translate(LOWER).split() if data else []


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` bytes of ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(text)
        sizes = np.asarray(pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False))
        group = (np.cumsum(sizes) - sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def carried(docs: DataFrame, keep: list[str]) -> tuple[list[Column], list[Column]]:
    """Columns to carry through under neutral names, and the selection that names them again.

    An operator can then add columns of its own beside them without a clash.
    """
    inner = [f"_c{i}" for i in range(len(keep))]
    return (
        [F.col(f"`{c}`").alias(x) for c, x in zip(keep, inner)],
        [F.col(x).alias(c) for c, x in zip(keep, inner)],
    )


def ddl(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
