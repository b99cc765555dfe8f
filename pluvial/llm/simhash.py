"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 r`` bits apart share a variant at most ``r`` bits
from each.  Every distinct fingerprint therefore emits all its variants within
``r`` bits (2,081 of them for r = 2), variants meet in a shuffle, and colliding
fingerprints are verified.

The shuffle carries no variants.  A variant's slice is the parity of k
interleaved groups of its bits; flipping up to r bits changes the parity of at
most r groups, so a fingerprint goes to 1 + k + k(k-1)/2 slices and its
variants of a slice are emitted there, next to all others of that slice.
Parities spread the members of a tight cluster over the slices, and copies
were folded to one fingerprint before, so no slice is hot.  k follows the
number of distinct fingerprints: a slice holds about ``SLICE_VARIANTS``.

All fingerprints that share a variant are within 2 r bits of each other, so a
slice answers with links to the smallest member of each group it sees (at most
one per fingerprint), never with all pairs; the groups of all slices are
joined by connected components.  No link is lost.

Null and empty texts have fingerprint zero, which links like any other.  A row
without doc_id gets the component of its fingerprint (null if no row of the
component has one).  Repeated rows are rows of their own with equal results;
an empty table gives an empty result.  Very long texts are read whole.  Only doc_id
and text are read; ``keep_first`` carries all columns along, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvial.llm.common import materialize, plain_documents, table
from pluvial.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Variants emitted by a slice, about; sets the number of slices.
SLICE_VARIANTS = 3_000_000
_CHUNK = 1 << 15


def shingle_hashes(text: str, words_per_shingle: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Blocks of XXH64 values of a text's shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()   # ASCII letters and spaces only
    if not words:
        return
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    n = max(1, len(words) - words_per_shingle + 1)
    start, end = start[:n].tolist(), end[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, _CHUNK):
        yield np.array([digest(joined[a:b], SEED) for a, b in
                        zip(start[lo:lo + _CHUNK], end[lo:lo + _CHUNK])], dtype=">u8")


def fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The 64 bits set in over half the shingles' hashes, as a signed long."""
    total, n = np.zeros(64, np.int64), 0
    for block in shingle_hashes(text, words_per_shingle):
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
        n += len(block)
    return int(np.packbits(total * 2 > n).view(">i8")[0])


def fingerprint_udf(words_per_shingle: int):
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([fingerprint(t, words_per_shingle) for t in part], dtype="int64")
    return of


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def parity_slice(fp: Column, k: int) -> Column:
    """Parities of the bit groups i mod k as one number."""
    bits = [F.shiftleft(F.bit_count(fp.bitwiseAND(F.lit(_signed(
        sum(1 << i for i in range(g, 64, k)))))) % 2, g) for g in range(k)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("int")


def _flips(k: int, radius: int) -> dict[int, np.ndarray]:
    """All flips of up to ``radius`` bits, by the parities they change."""
    found: dict[int, list[int]] = {0: [0]}
    level = [(0, 0, -1)]   # flip, changed parities, last bit
    for _ in range(radius):
        level = [(f | 1 << i, p ^ 1 << i % k, i) for f, p, last in level for i in range(last + 1, 64)]
        for f, p, _i in level:
            found.setdefault(p, []).append(f)
    return {p: np.array(f, dtype=np.uint64) for p, f in found.items()}


def local_groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index linked to each of n nodes by the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def slice_links(fps: np.ndarray, own: np.ndarray, slice_id: int, flips: dict[int, np.ndarray],
                max_bits: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest fingerprint of its group) of groups in a slice.

    Emits each fingerprint's variants that belong to the slice.  When a slice
    is far above its size, it is gone through in several passes, each taking
    the variants of one residue class.
    """
    changed = own ^ slice_id
    kinds = [(p, np.flatnonzero(changed == p)) for p in np.unique(changed)]
    passes = max(1, math.ceil(sum(len(at) * len(flips[int(p)]) for p, at in kinds) / limit))
    left, right = [], []
    for turn in range(passes):
        keys, index = [], []
        for p, at in kinds:
            flip = flips[int(p)]
            step = max(1, limit // len(flip))
            for lo in range(0, len(at), step):
                part = at[lo:lo + step]
                variant = (fps[part][:, None] ^ flip[None, :]).ravel()
                source = np.repeat(part.astype(np.int32), len(flip))
                if passes > 1:
                    mine = (variant * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % passes == turn
                    variant, source = variant[mine], source[mine]
                keys.append(variant)
                index.append(source)
        keys, index = np.concatenate(keys), np.concatenate(index)
        order = np.argsort(keys)
        keys, index = keys[order], index[order]
        met = keys[1:] == keys[:-1]
        a, b = index[:-1][met].astype(np.int64), index[1:][met].astype(np.int64)
        pair = np.unique(np.minimum(a, b) * len(fps) + np.maximum(a, b))
        a, b = pair // len(fps), pair % len(fps)
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits   # verify
        left.append(a[near])
        right.append(b[near])
    label = local_groups(len(fps), np.concatenate(left), np.concatenate(right))
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def ball_links(nodes: DataFrame, max_bits: int = MAX_BITS, limit: int = SLICE_VARIANTS) -> DataFrame:
    """Links (a, b) that join all fingerprints ``fp`` of ``nodes`` (distinct)
    at most ``max_bits`` apart, directly or through others that are."""
    radius = (max_bits + 1) // 2
    variants = sum(math.comb(64, i) for i in range(radius + 1))
    k = min(20, max(4, math.ceil(math.log2(max(1, nodes.count() * variants / limit)))))
    flips = _flips(k, radius)
    changes = sorted(flips)
    sent = (nodes.select("fp", parity_slice(F.col("fp"), k).alias("own"))
            .select("fp", "own", F.explode(F.array(*[F.lit(c) for c in changes])).alias("change"))
            .select("fp", "own", F.col("own").bitwiseXOR(F.col("change")).alias("slice")))

    def links(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fp")
        a, b = slice_links(pdf["fp"].to_numpy().view(np.uint64), pdf["own"].to_numpy(),
                           int(key[0]), flips, max_bits, limit)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return sent.groupBy("slice").applyInPandas(links, "a long, b long")


def fingerprint_groups(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component, component_id, first_id) of each distinct fingerprint.

    ``fps``: (doc_id, fp) per document.  component: the smallest fingerprint
    reachable by links; component_id: the smallest doc_id reachable, null if none
    of them has one; first_id: the smallest doc_id with this fingerprint.
    """
    nodes, _ = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    of = connected_components(ball_links(nodes, max_bits), "a", "b", "simhash-cc") \
        .select(F.col("node").alias("linked"), "component")
    members, _ = materialize(
        nodes.join(of, F.col("fp") == F.col("linked"), "left")
        .select("fp", "first_id", F.coalesce("component", "fp").alias("component")), "simhash-members")
    least, _ = materialize(members.groupBy("component").agg(
        F.min("first_id").alias("component_id")), "simhash-least")
    return members.join(least, "component").select("fp", "component", "component_id", "first_id")


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs`` (doc_id, text)."""
    of = fingerprint_udf(words_per_shingle)
    fps, _ = materialize(plain_documents(docs).select("doc_id", of("text").alias("fp")), "simhash-fps")
    groups, _ = materialize(fingerprint_groups(fps, max_bits).withColumnRenamed("fp", "group_fp"),
                            "simhash-groups")
    return fps.join(groups, F.col("fp") == F.col("group_fp")).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS,
               max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, with the columns of ``docs``: the one with the
    smallest doc_id (of repeated rows, the first by content)."""
    of, columns = fingerprint_udf(words_per_shingle), docs.columns
    marked, _ = materialize(docs.withColumn("__simhash", of(F.coalesce(F.col("text"), F.lit("")))),
                            "simhash-docs")
    groups = fingerprint_groups(marked.select("doc_id", F.col("__simhash").alias("fp")), max_bits)
    one = Window.partitionBy("component").orderBy("fp")
    chosen, _ = materialize(
        groups.where(F.col("first_id").eqNullSafe(F.col("component_id")))
        .withColumn("__n", F.row_number().over(one)).where("__n = 1")
        .select(F.col("fp").alias("__fp"), F.col("first_id").alias("__first")), "simhash-chosen")
    best = Window.partitionBy("__simhash").orderBy(F.xxhash64(*columns))
    return (marked.join(chosen, (F.col("__simhash") == F.col("__fp"))
                        & F.col("doc_id").eqNullSafe(F.col("__first")))
            .withColumn("__n", F.row_number().over(best)).where("__n = 1").select(*columns))


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
