"""Cross-tokenizer alignment: groups of tokens between the cuts that two
tokenizers share, and how usual each pair of overlapping tokens is.

A text, with a space put before it, is encoded by a byte-level BPE (A) and a
piece model (B).  Both token sequences cover the same bytes; an offset where a token of
each ends is a shared cut.  Cuts are found by divide and conquer: in an interval
of A tokens, ends are looked up among B's by bisect, from the middle outward,
until one is shared; both halves are treated alike, and an interval without a
shared end is a leaf group.  All intervals of a batch of texts take a step
together, with a search window that doubles on each step without a hit.

A token of A and one of B are linked where their bytes overlap.  Links of an id
pair are counted over the whole corpus: documents are read in chunks, each chunk lists its
distinct pairs once (see ``chunked``), and the counts come back to the chunk.

Texts that are null or empty, and texts whose tokens do not spell the text byte
for byte, have no tokens: zeros and ''.  Strings of special tokens inside a text
are plain text.  Long texts are encoded by B in parts cut before single
spaces, which no piece reaches across, so that their ids are the same; A's
library takes whole texts.  Rows are aligned one by one: repeated rows and ids
give as many rows, each counted; a null doc_id stays null.  Where several A ids
are the most usual of a B id, all are best.  An empty table gives an empty
result.  Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.llm import chunked
from pluvial.llm.common import materialize, plain_documents, table
from pluvial.llm.packing import LONG_RUN, _byte_of_sign

#: Characters of a chunk and of a step of work; longer texts are one step alone.
CHUNK_CHARS, STEP_CHARS = 8 << 20, 1 << 20
#: Texts over this many characters are encoded by B in parts.
PART_CHARS = 1 << 18
_PART_END = re.compile(r"(?<=[^ ]) (?=[^ ])")


class Tokens:
    """Ids of a tokenizer's tokens and the bytes that each stands for."""

    data: list[bytes]     # by id

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and each text."""
        raise NotImplementedError

    def spells(self, ids: np.ndarray, text: str) -> bool:
        """The ids' bytes are those of a space and the text."""
        return b"".join(map(self.data.__getitem__, ids.tolist())) == (" " + text).encode("utf-8")


class ByteTokens(Tokens):
    """A byte-level BPE file.  Its vocabulary is in merge order, so ``tiktoken``
    gives the ids of ``tokenizers``; very long unbroken runs go to the latter."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        plain = _byte_of_sign()
        ranks = {bytes(plain[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        self.as_is = spec.get("normalizer") is None
        self.data = [b""] * (1 + max(spec["model"]["vocab"].values()))
        for token, i in ranks.items():
            self.data[i] = token
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.long_run = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if self.long_run.search(text):
                ids = self.slow.encode(" " + text, add_special_tokens=False).ids
            else:
                ids = self.fast.encode_to_numpy(" " + text, disallowed_special=())
            out.append(np.asarray(ids, np.int64))
        return out


    def spells(self, ids: np.ndarray, text: str) -> bool:
        # a text's bytes are merged, never changed, unless a normalizer comes before
        return self.as_is or super().spells(ids, text)


def parts(text: str, size: int = PART_CHARS) -> list[str]:
    """A text cut at single spaces between other characters, without these
    spaces, into parts of about ``size`` characters."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _PART_END.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.end()
    return [*out, text[at:]]


class PieceTokens(Tokens):
    """A piece model file, which adds the space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.data = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.data.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                             else piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [parts(t) for t in texts]
        found = iter(self.model.encode([p for own in cut for p in own], num_threads=1))
        return [np.array([i for _ in own for i in next(found)], np.int64) for own in cut]


_LOADED: dict[tuple[str, str], tuple[ByteTokens, PieceTokens]] = {}


def tokenizers(a_path: str, b_path: str) -> tuple[ByteTokens, PieceTokens]:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = ByteTokens(a_path), PieceTokens(b_path)
    return _LOADED[a_path, b_path]


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Marks of the A ends that are also B ends.

    ends_a, ends_b: rising byte offsets; A tokens first[i] .. last[i] cover what
    some B tokens cover, so the end of last[i] is shared.
    """
    cut = np.zeros(len(ends_a), bool)
    cut[last] = True
    lo, hi = first.copy(), last.copy()         # ends still to look at: lo .. hi - 1, in rising order
    reach = np.zeros(len(lo), np.int64)        # ends nearer to the middle than this are not shared
    while True:
        open_ = lo < hi
        lo, hi, reach = lo[open_], hi[open_], reach[open_]
        if not len(lo):
            return cut
        middle = (lo + hi) // 2
        wide = np.maximum(2 * reach, 1)
        # the ends at a distance of reach .. wide - 1, below the middle and above it
        below = np.maximum(middle - wide + 1, lo)
        n_below = np.maximum(np.minimum(middle - reach, middle - 1) + 1 - below, 0)
        above = middle + reach
        n = n_below + np.maximum(np.minimum(middle + wide, hi) - above, 0)
        of = np.repeat(np.arange(len(lo)), n)
        step = np.arange(len(of)) - (np.cumsum(n) - n)[of]
        at = below[of] + step
        over = step - n_below[of]
        at[over >= 0] = (above[of] + over)[over >= 0]
        ends = ends_a[at]
        place = np.searchsorted(ends_b, ends)      # rising ends: each bisect starts where the last one ended
        hit = np.flatnonzero(ends_b[np.minimum(place, len(ends_b) - 1)] == ends)
        of_hit, at_hit = of[hit], at[hit]
        if (n > 1).any():       # several in an interval: the nearest
            order = np.lexsort((np.abs(at_hit - middle[of_hit]), of_hit))
            of_hit, at_hit = of_hit[order], at_hit[order]
            nearest = np.ones(len(of_hit), bool)
            nearest[1:] = of_hit[1:] != of_hit[:-1]
            of_hit, at_hit = of_hit[nearest], at_hit[nearest]
        cut[at_hit] = True
        # an interval is split in two, or goes on, or is a leaf: all its ends were looked up
        times = ((middle - wide >= lo) | (middle + wide < hi)).astype(np.int64)
        times[of_hit] = 2
        split = np.repeat(times == 2, times)
        begin = np.cumsum(times) - times
        lo, hi, reach = np.repeat(lo, times), np.repeat(hi, times), np.repeat(wide, times)
        reach[split] = 0
        hi[begin[of_hit]] = at_hit
        lo[begin[of_hit] + 1] = at_hit + 1


class Aligned:
    """Texts aligned together: a number of each kind for every text, and all links."""

    def __init__(self, texts: list[str], a: Tokens, b: Tokens) -> None:
        ids_a, ids_b = a.encode(texts), b.encode(texts)
        for i, text in enumerate(texts):
            if not text or not all(t.spells(ids[i], text) for t, ids in ((a, ids_a), (b, ids_b))):
                ids_a[i] = ids_b[i] = np.empty(0, np.int64)
        self.n_a = np.array([len(x) for x in ids_a], np.int64)
        self.n_b = np.array([len(x) for x in ids_b], np.int64)
        full = self.n_a > 0
        flat_a, flat_b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (ids_a, ids_b))
        ends_a = np.cumsum(np.array([len(d) for d in a.data], np.int64)[flat_a])
        ends_b = np.cumsum(np.array([len(d) for d in b.data], np.int64)[flat_b])
        last = np.cumsum(self.n_a) - 1
        doc_a = np.repeat(np.arange(len(texts)), self.n_a)
        cut = shared_cuts(ends_a, ends_b, (last - self.n_a + 1)[full], last[full])
        self.n_groups = np.bincount(doc_a[cut], minlength=len(texts))
        # marks by byte offset: ends of A, ends of B, shared ends
        size = int(ends_a[-1]) + 1 if len(ends_a) else 1
        is_a, is_b, is_cut = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
        is_a[ends_a] = is_b[ends_b] = is_cut[ends_a[cut]] = True
        group_a, group_b = np.cumsum(cut) - cut, (np.cumsum(is_cut) - is_cut)[ends_b]
        self.sha256 = self._digests(flat_a, flat_b, cut, is_cut[ends_b], group_a, group_b, a, b)
        # every stretch between two neighbouring ends, of either, is one link
        bound = np.flatnonzero(is_a | is_b)
        link_a, link_b = (np.cumsum(is_a) - is_a)[bound], (np.cumsum(is_b) - is_b)[bound]
        self.code = flat_a[link_a] * len(b.data) + flat_b[link_b]
        self.n_links = np.bincount(doc_a[link_a], minlength=len(texts))

    def _digests(self, flat_a, flat_b, cut_a, cut_b, group_a, group_b, a: Tokens, b: Tokens) -> list[str]:
        """sha256 of a1,a2|b1;a3|b2,b3 for each text."""
        if not len(flat_a):
            return [""] * len(self.n_a)
        # a group's A tokens stand before its B tokens
        b_before = np.concatenate(([0], np.cumsum(np.bincount(group_b))))
        a_until = np.cumsum(np.bincount(group_a))
        words, size = _written(max(len(a.data), len(b.data)))
        sign = np.empty(len(flat_a) + len(flat_b), np.int64)
        sign[np.arange(len(flat_a)) + b_before[group_a]] = flat_a + size * cut_a
        sign[np.arange(len(flat_b)) + a_until[group_b]] = flat_b + 2 * size * cut_b
        tokens = list(map(words.__getitem__, sign.tolist()))
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256(b"".join(tokens[at:at + n])[:-1]).hexdigest() if n else "")
            at += n
        return out


@functools.cache
def _written(size: int) -> tuple[list[bytes], int]:
    """Each id with what follows it: a comma, then | after a group's A, then ; after its B."""
    return [b"%d%c" % (i, after) for after in b",|;" for i in range(size)], size


_DOC = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")
_CHUNK = f"chunk long, docs array<struct<{_DOC.replace(' long', ': long').replace(' string', ': string')}>>, " \
         "codes binary, counts binary, links binary"
_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _chunk_row(number: int, rows: list, steps: list[Aligned]) -> pa.RecordBatch:
    n_links = np.concatenate([s.n_links for s in steps])
    entry, codes = pd.factorize(np.concatenate([s.code for s in steps]))
    counts = np.bincount(entry, minlength=len(codes))
    order = np.argsort(-counts, kind="stable")       # usual pairs get small numbers
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.arange(len(codes))
    doc = np.repeat(np.arange(len(rows)), n_links)
    links = np.sort(doc << 32 | rank[entry]) & 0xFFFFFFFF
    docs = pa.StructArray.from_arrays(
        [pa.array(rows, pa.int64()), *(pa.array(np.concatenate([getattr(s, n) for s in steps]), pa.int64())
                                       for n in _FIELDS[1:5]),
         pa.array([x for s in steps for x in s.sha256], pa.string())], names=_FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), docs),
         pa.array([codes[order].astype("<i8").tobytes()], pa.binary()),
         pa.array([counts[order].astype("<i8").tobytes()], pa.binary()),
         pa.array([chunked.pack_sorted(links)], pa.binary())],
        names=["chunk", "docs", "codes", "counts", "links"])


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Chunks of aligned documents: a row each."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        rows, steps, size = [], [], 0
        ids, texts, chars = [], [], 0

        def step() -> None:
            nonlocal ids, texts, chars, size
            if ids:
                steps.append(Aligned(texts, a, b))
                rows.extend(ids)
                size += chars
                ids, texts, chars = [], [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                chars += len(text)
                if chars >= min(STEP_CHARS, chunk_chars) or len(ids) >= 1 << 16:
                    step()
                if size >= chunk_chars or len(rows) >= 1 << 20:
                    yield _chunk_row(number, rows, steps)
                    rows, steps, size, number = [], [], 0, number + 1
        step()
        if rows:
            yield _chunk_row(number, rows, steps)

    return (plain_documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(read, _CHUNK))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, entry, code, n) of every chunk's distinct pairs."""
    for batch in batches:
        for chunk, codes, counts in zip(*(c.to_pylist() for c in batch.columns)):
            code, n = np.frombuffer(codes, "<i8"), np.frombuffer(counts, "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), chunk)), pa.array(np.arange(len(code))), pa.array(code), pa.array(n)],
                names=["chunk", "entry", "code", "n"])


def _sums(chunk: pa.Table, answers: dict) -> pa.RecordBatch:
    """A row for each document of a chunk, with what its links add up to."""
    docs = pa.concat_arrays([c.flatten() for c in chunk["docs"].chunks])
    cols = {n: docs.field(i) for i, n in enumerate(_FIELDS)}
    links = chunked.unpack_sorted(chunk["links"][0].as_py()).astype(np.int64)
    end = np.cumsum(cols["n_links"].to_numpy())
    for name, value in (("n_best", answers["best"].astype(np.int64)), ("count_sum", answers["count"])):
        total = np.concatenate(([0], np.cumsum(value[links] if len(links) else np.empty(0, np.int64))))
        cols[name] = pa.array(total[end] - total[end - cols["n_links"].to_numpy()], pa.int64())
    names = _RESULT_FIELDS
    return pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_RESULT_FIELDS = [c.split()[0] for c in _RESULT.split(", ")]


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
          chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """A row for each document: tokens, groups, links and how usual its links are."""
    if a_path is None or b_path is None:
        a_path, b_path = default_paths()
    n_b = len(tokenizers(a_path, b_path)[1].data)
    chunks, _ = materialize(aligned_chunks(docs, a_path, b_path, chunk_chars), "align-chunks")
    entries = chunks.select("chunk", "codes", "counts").mapInArrow(
        _entries, "chunk long, entry long, code long, n long")
    pairs, _ = materialize(entries.groupBy("code").agg(F.sum("n").alias("count")), "align-pairs")
    b_id = F.col("code") % n_b
    most = pairs.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))     # a row for each B id at most
    rated = (pairs.withColumn("b", b_id).join(F.broadcast(most), "b")
             .select("code", "count", (F.col("count") == F.col("most")).alias("best")))
    answers = entries.select("chunk", "entry", "code").join(rated, "code").select("chunk", "entry", "count", "best")
    return chunked.answered(chunks.select("chunk", "docs", "links"), answers, _sums, _RESULT)


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
