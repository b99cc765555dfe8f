"""Harmonic packing of tokenised documents into sequences.

A document's ids end with an end id.  It is cut into pieces so that lengths
fall on, or just below, reciprocals of the capacity C: full sequences first,
then the largest powers of two down to ``GRAIN``, then a short tail.  Piece
lengths are partitioned into classes, class j holding (C/(j+1), C/j]; a bin of
class j takes j pieces, so power-of-two pieces fill theirs without a gap.
Tails up to C/LAST_CLASS (eight ids) are the last class.

Each worker fills its bins of each class on its own, by counting.  The pieces
of bins that it could not fill (fewer than j per worker and class) are counted
through over all workers and fill bins in the same way.  What is left then is
fewer than j pieces per class in the whole corpus, some thousand at most
whatever its size; one task packs these by first fit decreasing.  Positions
inside a bin are prefix sums of its at most LAST_CLASS pieces.

Pieces are written to the shared folder before bins are numbered, so numbers do
not depend on reruns.  Null and empty texts are the end id alone.  Very long texts
are encoded whole and cut.  Rows are packed one by one, so repeated rows are packed as
often as they come; an empty table gives an empty result.  Only doc_id and text are
read; other columns, whatever their names, are not.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvial.llm.common import materialize, plain_documents, table

CAPACITY = 2048
END_ID = 1
GRAIN = 64
LAST_CLASS = 256
#: Runs without a break longer than this go to the ``tokenizers`` library,
#: whose merging takes no quadratic time.
LONG_RUN = 2000


def cut(length: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of a document's pieces, in order."""
    full, rest = divmod(length, capacity)
    out = [capacity] * full
    size = capacity // 2
    while size >= grain:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class Encoder:
    """Ids as ``tokenizers`` gives them for a byte-level BPE file.

    The file's vocabulary is ordered by merge rank, so ``tiktoken`` gives the
    same ids from it, in a quarter of the time; texts with very long unbroken
    runs go to ``tokenizers`` itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        plain = _byte_of_sign()
        ranks = {bytes(plain[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        from public_tokenizers import PATTERN
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special)
        self.slow = Tokenizer.from_file(path)
        self.long_run = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))

    def ids(self, text: str) -> np.ndarray:
        if self.long_run.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode(text, allowed_special="all"), dtype="<u4")


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable
    Latin-1 signs for themselves, the other bytes from 256 on, in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "class int, worker int, at long")


def pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """One row per piece: its place in its document, its class, the worker that
    made it and its number (from 0) among that worker's pieces of the class."""
    def make(frames: Iterator) -> Iterator:
        import pyarrow as pa

        encode, worker = encoder(tokenizer), TaskContext.get().partitionId()
        count = np.zeros(LAST_CLASS + 1, np.int64)
        for batch in frames:
            cols: dict[str, list] = {n: [] for n in ("row", "start", "length", "crc", "tokens", "class", "at")}
            ids_out: list = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode.ids(text), np.uint32(END_ID)).astype("<u4")
                start = 0
                for length in cut(len(ids)):
                    own = ids[start:start + length]
                    j = min(LAST_CLASS, CAPACITY // length)
                    for name, value in (("row", row), ("start", start), ("length", length),
                                        ("crc", zlib.crc32(own.tobytes())), ("tokens", len(ids)),
                                        ("class", j), ("at", int(count[j]))):
                        cols[name].append(value)
                    if with_ids:
                        ids_out.append(own.astype(np.int32))
                    count[j] += 1
                    start += length
            arrays = [batch.column(0).take(pa.array(cols["row"], pa.int64())),
                      *(pa.array(cols[n], pa.int64()) for n in ("start", "length", "crc", "tokens")),
                      pa.array(cols["class"], pa.int32()),
                      pa.array([worker] * len(cols["row"]), pa.int32()), pa.array(cols["at"], pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "worker", "at"]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = _PIECE + (", ids array<int>" if with_ids else "")
    return plain_documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(make, schema)


def _first_fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """Bins of mixed lengths for the last pieces, longest first."""
    pdf = pdf.sort_values(["length", "worker", "class", "at"], ascending=[False, True, True, True])
    room: list[int] = []
    count: list[int] = []
    bins, slots = [], []
    for length in pdf["length"].tolist():
        bin_ = next((i for i, r in enumerate(room) if r >= length), len(room))
        if bin_ == len(room):
            room.append(CAPACITY)
            count.append(0)
        bins.append(bin_)
        slots.append(count[bin_])
        room[bin_] -= length
        count[bin_] += 1
    return pd.DataFrame({"worker": pdf["worker"], "class": pdf["class"], "at": pdf["at"],
                         "left_bin": bins, "left_slot": slots})


def pack(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their sequence and offset in it.

    sequence_id counts neither from zero nor without gaps, but is unique and
    the same in every rerun over the same files.  ``with_ids`` adds the ids.
    """
    made, _ = materialize(pieces(docs, tokenizer or default_tokenizer(), with_ids), "packing-pieces")
    # (worker, class): pieces made, how many fill whole bins, bins and rests before
    per = made.groupBy("worker", "class").agg(F.count("*").alias("n")) \
        .withColumn("filled", F.expr("n - n % class"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        F.col("worker").alias("w"), F.col("class").alias("c"), "filled", F.expr("n - filled").alias("rest"),
        F.coalesce(F.sum(F.expr("filled div class")).over(before), F.lit(0)).alias("bins_before"),
        F.coalesce(F.sum(F.expr("n - filled")).over(before), F.lit(0)).alias("rest_before"))
    per, _ = materialize(per, "packing-counts")
    totals = per.groupBy("c").agg(F.sum(F.expr("filled div c")).alias("whole_bins"),
                                  F.sum("rest").alias("rests")).withColumnRenamed("c", "k")
    numbered = (
        made.join(per, (F.col("worker") == F.col("w")) & (F.col("class") == F.col("c")))
        # at most one row per class: a few dozen
        .join(F.broadcast(totals), F.col("class") == F.col("k"))
        .withColumn("nth", F.expr("rest_before + at - filled"))
        .withColumn("last", F.expr("at >= filled AND nth >= rests - rests % class")))
    # fewer pieces than the sum of the classes' numbers: a few thousand
    left = (numbered.where("last").select("worker", "class", "at", "length")
            .groupBy().applyInPandas(
                _first_fit, "worker int, class int, at long, left_bin long, left_slot long"))
    numbered = (
        numbered.join(F.broadcast(left), ["worker", "class", "at"], "left")
        .withColumn("bin", F.expr("""CASE WHEN last THEN left_bin
            WHEN at < filled THEN bins_before + at div class
            ELSE whole_bins + nth div class END"""))
        .withColumn("slot", F.expr("""CASE WHEN last THEN left_slot
            WHEN at < filled THEN at % class ELSE nth % class END"""))
        .withColumn("sequence_id", F.expr(
            f"bin * {LAST_CLASS + 1} + CASE WHEN last THEN 0 ELSE class END")))
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    return numbered.select(
        *columns, F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"),
        *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, input_ids) of ``pack(..., with_ids=True)``: the ids in
    order, padded with the end id to the capacity unless their number is a
    power of two."""
    row = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    pad = F.when(F.bit_count("tokens") == 1, F.lit(0)).otherwise(CAPACITY - F.col("tokens")).cast("int")
    return row.select("sequence_id", "tokens", F.concat(ids, F.array_repeat(F.lit(END_ID), pad)).alias("input_ids"))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
