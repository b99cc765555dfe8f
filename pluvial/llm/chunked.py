"""Corpus-wide numbers for the items of each document, without a row per item.

A chunk is a run of documents that one task read, in one row.  It lists each
distinct item of its documents once and numbers them; its documents hold those
numbers.  What meets the corpus-wide table in a shuffle is an entry for each
chunk and distinct item, far fewer than the items; an item that stands in every
document has one entry a chunk.  The answers go back to the chunk's row, which
travels once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed byte planes."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4")[:, 0]


def pack_sorted(numbers: np.ndarray) -> bytes:
    """As ``pack``, for runs of rising numbers: their steps, modulo 2^32."""
    return pack(np.diff(numbers.astype(np.uint32), prepend=np.uint32(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint32)


def answered(chunks: DataFrame, answers: DataFrame, answer: Callable[[pa.Table, dict], pa.RecordBatch],
             schema: str) -> DataFrame:
    """``answer(chunk's row, its answers as arrays)`` for each chunk.

    chunks: a row each, with its number in ``chunk``.  answers: (chunk, entry,
    ...) with entry the item's number in its chunk; the arrays come in its order.
    """
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["entry"].to_numpy(), kind="stable")
        columns = {n: right[n].to_numpy()[order] for n in right.column_names if n not in ("chunk", "entry")}
        return pa.Table.from_batches([answer(left, columns)])

    return (chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(meet, schema))
