"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Unit vectors are assigned to the nearest of k centroids, fitted on a bounded
sample; cosines are taken between the vectors of a cell in blocks, and one
representative of each group, the smallest id, is kept.

No link is lost at cell borders.  If b lies in cell c and a in cell h, and they
are linked, (h - c) . a <= |h - c| |a - b|, and |a - b| is at most the chord of
the smallest cosine.  A vector is therefore also a guest of every cell c with
(h - c) . a <= |h - c| chord, where it meets all its partners at home there.  Of two cells
one is host to the other's guests, by the parity of their numbers, so each pair is compared
once and counts for both its vectors.  Places are found in single precision, with a margin
for its rounding; a cosine that single precision cannot tell from the limit is taken in double.

Cells of any size are cut into blocks of at most about ``BLOCK`` vectors, and each
pair of a home block with another block is a task of its own.  A task answers
with counts and with links to the smallest member of each group that it sees,
never with pairs.  Comparisons within a cell grow with its size squared, and
where vectors have no cluster structure most vectors are guests of many cells;
that is the price of exact counts.

Only homes are written.  Guests are counted first, then found again in rounds of home blocks
that move about twice the table each, whose shuffles go when a round is done.  So a table
without structure takes more rounds, not more memory or disk.  A task holds
``PIECE`` numbers of a matrix and ``PIECE_BYTES`` of output at a time.

Equal vectors are one node with a number of rows.  Vectors that are null, zero
or hold null or non-finite components link with nothing: they are groups of
their own.  A row without vec_id takes no part: no links, no component, not
kept.  Vectors of different length are not linked.  An empty table gives an
empty result.  Only vec_id and embedding are read; other columns, whatever their
names, are not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvial.llm.common import discard, hash_fraction, materialize, table
from pluvial.llm.components import connected_components
from pluvial.llm.simhash import local_groups
from pluvial.llm.vectors import matrix, usable, with_usable
from pluvial.session import shuffles_dropped

COSINE = 0.95
CELL_ROWS = 4096
BLOCK = 2048
#: Vectors that centroids are fitted on, at most about; cells are at most a quarter of it.
SAMPLE = 16_384
ITERATIONS = 10
#: Numbers of a matrix, and bytes of output, that a task holds at a time.
PIECE, PIECE_BYTES = 1 << 20, 16 << 20
#: Rows that a round of comparisons moves at least; tables of more rows move twice theirs.
ROUND_ROWS = 1 << 19


def unit(m: np.ndarray) -> np.ndarray:
    scale = np.abs(m).max(axis=1, keepdims=True)
    m = m / scale
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def pieces(rows: int, width: int) -> Iterator[slice]:
    """Runs of rows whose products with ``width`` others are ``PIECE`` numbers, about."""
    step = max(1, PIECE // max(1, width))
    return (slice(i, i + step) for i in range(0, rows, step))


def nearest(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centre, and the cosine to it."""
    cell, best = np.zeros(len(v), np.int64), np.zeros(len(v), v.dtype)
    for at in pieces(len(v), len(centres)):
        close = v[at] @ centres.T
        cell[at] = close.argmax(axis=1)
        best[at] = close[np.arange(len(close)), cell[at]]
    return cell, best


def spherical_kmeans(sample: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """k unit centroids; empty cells are reseeded with the worst placed vectors."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(ITERATIONS):
        cell, best = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        empty = np.flatnonzero((sums * sums).sum(axis=1) < 1e-12)
        if len(empty):
            sums[empty] = sample[np.argsort(best)[:len(empty)]]
        centres = unit(sums)
    return centres


def fit_centroids(nodes: DataFrame, n: int) -> np.ndarray | None:
    """Centroids for vectors of the most frequent length (others are one cell each)."""
    if not n:
        return None
    length = nodes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    rows = (nodes.where(F.size("embedding") == length)
            .where(hash_fraction(F.col("embedding")) < min(1.0, SAMPLE / n))
            .select("node", "embedding").orderBy("node").limit(2 * SAMPLE).toArrow())
    if not rows.num_rows:
        return None
    sample = unit(matrix(rows.column("embedding").to_pylist()))
    k = max(1, min(math.ceil(n / CELL_ROWS), len(sample) // 4))
    return spherical_kmeans(sample, k)


def dtype_of(nodes: DataFrame) -> np.dtype:
    """Vectors travel as the numbers they came as; tasks scale them."""
    return np.dtype("<f4" if isinstance(nodes.schema["embedding"].dataType.elementType, T.FloatType) else "<f8")


def units(vectors, dtype: np.dtype) -> np.ndarray:
    """Equally long vectors' bytes as unit rows."""
    data = [bytes(x) for x in vectors]
    return unit(np.frombuffer(b"".join(data), dtype).reshape(len(data), -1).astype(np.float64))


def by_length(batch: pa.RecordBatch, dtype: np.dtype) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their numbers) of the batch's embeddings."""
    column = batch.column("embedding")
    starts = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    lengths = np.diff(starts)
    for length in np.unique(lengths).tolist():
        row = np.flatnonzero(lengths == length)
        for at in pieces(len(row), length):
            yield length, row[at], flat[starts[row[at]][:, None] + np.arange(length)]


def homes_of(nodes: DataFrame, centres: np.ndarray | None) -> DataFrame:
    """(cell, node, n, vector's bytes): each vector once, in its nearest centre's cell.
    Vectors of another length than the centres are in a cell by their length, below 0."""
    dtype = dtype_of(nodes)
    shared = nodes.sparkSession.sparkContext.broadcast(None if centres is None else centres.astype(np.float32))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for length, row, raw in by_length(batch, dtype):
                if c is None or length != c.shape[1]:
                    cell = np.full(len(row), -length, np.int64)
                else:
                    cell, _ = nearest(unit(raw.astype(np.float64)).astype(np.float32), c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), batch.column("node").take(pa.array(row)), batch.column("n").take(pa.array(row)),
                     pa.array([x.tobytes() for x in raw], pa.binary())], ["cell", "node", "n", "vector"])

    return nodes.select("node", "n", "embedding").mapInArrow(place, "cell long, node long, n long, vector binary")


def gaps_of(centres: np.ndarray) -> np.ndarray:
    """Distances between centres."""
    out = np.empty((len(centres), len(centres)), np.float32)
    for at in pieces(len(centres), len(centres)):
        out[at] = np.sqrt(np.maximum(0, 2 - 2 * (centres[at] @ centres.T)))
    return out


def visits(v: np.ndarray, own: np.ndarray, cells: np.ndarray, centres: np.ndarray, gaps: np.ndarray,
           cosine: float) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, whether each row is a guest of each of ``cells``) of runs of unit rows with homes ``own``."""
    chord = np.float32(math.sqrt(max(0.0, 2 - 2 * cosine)))
    slack = np.float32(4 * (v.shape[1] + 4) * 2.0 ** -24 + 1e-6)
    for at in pieces(len(v), len(cells)):
        home = own[at][:, None]
        near = (v[at] * centres[own[at]]).sum(axis=1)[:, None] - v[at] @ centres[cells].T
        guest = near <= gaps[own[at]][:, cells] * chord + slack
        host = ((home + cells) % 2 == 0) == (cells < home)      # of two cells, one
        yield at.start, guest & host & (cells != home)


def _guests(homes: DataFrame, centres: np.ndarray, dtype: np.dtype, cosine: float, cells: list[int], counted: bool) -> DataFrame:
    """Guests of ``cells``: a row for each as in ``homes_of``, or their number in each cell."""
    shared = homes.sparkSession.sparkContext.broadcast((centres, np.array(sorted(cells), np.int64)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, wanted = shared.value
        gaps, c = gaps_of(c), c.astype(np.float32)
        number = np.zeros(len(wanted), np.int64)
        for batch in batches:
            vectors = batch.column("vector")
            own = batch.column("cell").to_numpy()
            for part in pieces(len(own), c.shape[1]):
                v = units(vectors[part].to_pylist(), dtype).astype(np.float32)
                for first, guest in visits(v, own[part], wanted, c, gaps, cosine):
                    if counted:
                        number += guest.sum(axis=0)
                        continue
                    row, cell = np.nonzero(guest)
                    row += part.start + first
                    for some in pieces(len(row), PIECE * c.shape[1] * dtype.itemsize // PIECE_BYTES):
                        rows = pa.array(row[some])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(wanted[cell[some]]), batch.column("node").take(rows), batch.column("n").take(rows),
                             vectors.take(rows)], ["cell", "node", "n", "vector"])
        if counted:
            yield pa.RecordBatch.from_arrays([pa.array(wanted), pa.array(number)], ["cell", "visits"])

    if counted:
        return homes.select("cell", "vector").mapInArrow(place, "cell long, visits long")
    return homes.mapInArrow(place, "cell long, node long, n long, vector binary")


def rounds_of(sizes: dict[int, int], visits: dict[int, int], most: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Lists of (cell, home blocks, guest blocks, from, to): home blocks, each with all it
    is compared with, that move about ``most`` rows a list."""
    now, cost = [], 0
    for cell, size in sorted(sizes.items()):
        homes, guests = -(-size // BLOCK), visits.get(cell, 0)
        first = 0
        for i in range(homes):
            cost += 2 * (max(size - i * BLOCK, 0) + guests)     # the others, and this block for each of theirs
            if cost >= most or i + 1 == homes:
                now.append((cell, homes, -(-guests // BLOCK), first, i + 1))
                first = i + 1
            if cost >= most:
                yield now
                now, cost = [], 0
    if now:
        yield now


def _compare(pdf: pd.DataFrame, cosine: float, dtype: np.dtype, itself: bool) -> pd.DataFrame:
    """Links between a home block and another block (or itself)."""
    mine, other = pdf[pdf["left"]], pdf[~pdf["left"]]
    empty = pd.DataFrame({"node": [], "linked": [], "root": []}).astype("int64")
    if not len(mine) or not len(other):
        return empty
    a, b = units(mine["vector"], dtype), units(other["vector"], dtype)
    a4, b4 = a.astype(np.float32), b.astype(np.float32)
    ids_a, ids_b = mine["node"].to_numpy(), other["node"].to_numpy()
    n_a, n_b = (side["n"].to_numpy().astype(np.float64) for side in (mine, other))
    slack = np.float32(2 * (a.shape[1] + 4) * 2.0 ** -24)
    count_a, count_b, found = np.zeros(len(a)), np.zeros(len(b)), []
    for at in pieces(len(a), len(b)):
        close = a4[at] @ b4.T
        near = close >= np.float32(cosine)
        unsure = np.abs(close - np.float32(cosine)) <= slack
        if unsure.any():
            i, j = np.nonzero(unsure)
            if len(i) * a.shape[1] <= PIECE:
                near[i, j] = (a[at][i] * b[j]).sum(axis=1) >= cosine
            else:
                near = a[at] @ b.T >= cosine
        i, j = np.nonzero(near)
        differ = ids_a[at][i] != ids_b[j]
        i, j = i[differ] + at.start, j[differ]
        if len(i):
            count_a += np.bincount(i, n_b[j], len(a))
            count_b += np.bincount(j, n_a[i], len(b))
            found.append((i.astype(np.int32), j.astype(np.int32)))
    if not found:
        return empty
    i, j = (np.concatenate(x) for x in zip(*found))
    ids, at = np.unique(np.concatenate([ids_a, ids_b]), return_inverse=True)
    root = ids[local_groups(len(ids), at[i], at[len(ids_a) + j])]
    linked = np.zeros(len(ids), np.int64)
    linked[at[:len(ids_a)]] = count_a
    if not itself:
        linked[at[len(ids_a):]] = count_b
    shown = np.flatnonzero((root != ids) | (linked > 0))
    return pd.DataFrame({"node": ids[shown], "linked": linked[shown], "root": root[shown]})


def _round(homes: DataFrame, guests: DataFrame | None, blocks: list[tuple], cosine: float, dtype: np.dtype) -> DataFrame:
    """(node, linked, root) of a round's blocks: link counts to add up, and links (node, root)."""
    # at most a row per cell; the number of cells is bounded by a quarter of SAMPLE
    size = homes.sparkSession.createDataFrame(blocks, "c long, homes long, visits long, lo long, hi long")
    salt = F.xxhash64("node")

    def of_cells(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(size), F.col("cell") == F.col("c"))

    own = of_cells(homes).withColumn("block", F.pmod(salt, "homes"))
    left = own.where("block >= lo AND block < hi").select(
        "cell", F.col("block").alias("i"), F.explode(F.expr("sequence(block, homes + visits - 1)")).alias("j"),
        F.lit(True).alias("left"), "node", "n", "vector")
    right = own.where("block >= lo").select(
        "cell", F.explode(F.expr("sequence(lo, least(hi - 1, block))")).alias("i"), F.col("block").alias("j"),
        F.lit(False).alias("left"), "node", "n", "vector")
    if guests is not None:
        right = right.unionByName(of_cells(guests).select(
            "cell", F.explode(F.expr("sequence(lo, hi - 1)")).alias("i"), (F.col("homes") + F.pmod(salt, "visits")).alias("j"),
            F.lit(False).alias("left"), "node", "n", "vector"))

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _compare(pdf, cosine, dtype, key[1] == key[2])

    return left.unionByName(right).groupBy("cell", "i", "j").applyInPandas(compare, "node long, linked long, root long")


def compare_cells(homes: DataFrame, centres: np.ndarray | None, dtype: np.dtype, cosine: float) -> DataFrame:
    """(node, linked, root): link counts to add up, and links (node, root)."""
    spark = homes.sparkSession
    sizes = {r["cell"]: r["count"] for r in homes.groupBy("cell").count().collect()}
    known = [cell for cell in sizes if cell >= 0]
    visits = {}
    if len(known) > 1:
        counted = _guests(homes.where("cell >= 0"), centres, dtype, cosine, known, True)
        visits = {r["cell"]: r["n"] for r in counted.groupBy("cell").agg(F.sum("visits").alias("n")).collect()}
    paths = []
    for blocks in rounds_of(sizes, visits, max(ROUND_ROWS, 2 * sum(sizes.values()))):
        hosts = [cell for cell, _, guests, *_ in blocks if guests]
        guests = _guests(homes.where("cell >= 0"), centres, dtype, cosine, hosts, False) if hosts else None
        with shuffles_dropped(spark):
            paths.append(materialize(_round(homes, guests, blocks, cosine, dtype), "sem-links")[1])
    schema = "node long, linked long, root long"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``."""
    rows, _ = materialize(with_usable(vectors), "sem-rows")
    nodes, _ = materialize(
        rows.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "sem-nodes")
    centres = fit_centroids(nodes, nodes.count())
    homes, homes_path = materialize(homes_of(nodes, centres), "sem-cells")
    links = compare_cells(homes, centres, dtype_of(nodes), cosine)
    discard(vectors.sparkSession, homes_path)
    of = connected_components(links.where("node <> root"), "node", "root", "sem-cc") \
        .select(F.col("node").alias("linked_node"), "component")
    counts = links.groupBy(F.col("node").alias("counted")).agg(F.sum("linked").alias("linked"))
    members, _ = materialize(
        nodes.join(of, F.col("node") == F.col("linked_node"), "left")
        .join(counts, F.col("node") == F.col("counted"), "left")
        .select("embedding", "first_id", F.coalesce("component", "node").alias("component"),
                (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")), "sem-members")
    least = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    groups, _ = materialize(members.join(least, "component")
                            .select(F.col("embedding").alias("of"), "n_links", "component_id"), "sem-groups")
    found = rows.join(groups, F.col("embedding") == F.col("of")).select("vec_id", "n_links", "component_id")
    rest = vectors.where(F.col("vec_id").isNull() | ~usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id"))
    return found.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op8_semdedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
