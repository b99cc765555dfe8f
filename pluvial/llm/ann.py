"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash turns a unit vector by pseudo-rotations (three rounds of random
signs and a fast Hadamard transform each) and takes the nearest signed axis after
each of them: as many cross-polytopes, the last one over a part of the axes, as make about
``BUCKET_ROWS`` rows a bucket, so buckets stay small however large the table is.  A
vector is in one bucket of each of ``TABLES`` tables; a query looks into the buckets
that lie nearest to it, over all their axes together: ``PROBES`` of them on tables up to
``PROBED_ROWS`` rows, and as the cube root of the rows beyond.

Nearness is Euclidean distance, hashes know angles.  Where lengths differ, vectors
are hashed within bands of length, of a factor ``2^(1/BANDS)`` each, and with two more
coordinates: x becomes (x, (R^2 - |x|^2) / 2s, fill), all of one length, and a query
(q, s, 0), so that the angle between them orders by q.x - |x|^2 / 2, that is by
distance.  R and s are the band's mean and spread; a band of equal lengths needs no lift.

Vectors stand in numbered blocks of ``BLOCK``, in the order of their first hash.  Ids
only go through the tables: a bucket's rows are lists of places in blocks, and what a
query gets of each block is a list of places.  A query goes once to each block that
holds a candidate, with its list, and the block's task answers with its k nearest, by
exact Euclidean distance between original vectors in double precision.  A block's
queries are cut into parts of about ``QUERY_PLACES`` places.  A query that
finds fewer than k is compared with all rows.

Vectors that are null, zero or hold null or non-finite components, and rows
without vec_id, take no part.  Vectors of different length are not compared.
Rows that share a vec_id count as one candidate, the nearest of them, however
many they are, and none is a candidate of a query with that id; repeated queries
answer once, the first by value.  Ties go to the smaller vec_id.  An empty table gives an
empty result.  Only vec_id and embedding are read; other columns, whatever their
names, are not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvial.llm.common import discard, materialize, table
from pluvial.llm.vectors import matrix, with_usable
from pluvial.operators.ranks import number_rows

K = 10
TABLES, PROBES, PROBED_ROWS = 32, 32, 50_000
BUCKET_ROWS = 3
BANDS = 2
BLOCK, QUERY_PLACES = 4096, 1 << 20
#: Queries whose probes one task finds, about.
QUERY_ROWS = 500
#: Sums of distances that a task holds at a time.
PROBED_AT_ONCE = 1 << 20
SEED = 9
QUERY_STEP = 100
#: Bands whose lengths differ by less than this part are hashed without the lift.
EQUAL_LENGTHS = 1e-4


def hadamard(m: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long), orthonormal."""
    rows, n = m.shape
    h = 1
    while h < n:
        pairs = m.reshape(rows, -1, 2, h)
        out = np.empty_like(pairs)
        np.add(pairs[:, :, 0], pairs[:, :, 1], out=out[:, :, 0])
        np.subtract(pairs[:, :, 0], pairs[:, :, 1], out=out[:, :, 1])
        m, h = out.reshape(rows, n), 2 * h
    return m * m.dtype.type(1 / math.sqrt(n))


def rotated(m: np.ndarray, number: int) -> np.ndarray:
    """Unit rows, zero-padded to a power of two, turned by pseudo-rotation ``number``."""
    size = 1 << max(0, (m.shape[1] - 1).bit_length())
    rng = np.random.default_rng([SEED, number, m.shape[1]])
    out = np.zeros((len(m), size), m.dtype)
    out[:, :m.shape[1]] = m
    for _ in range(3):
        out = hadamard(out * rng.choice([-1.0, 1.0], size).astype(m.dtype))
    return out


def parts_for(rows: int, size: int) -> list[int]:
    """Axes of each cross-polytope of a hash: whole ones of ``size`` axes, and a last
    one, so that there are about rows / BUCKET_ROWS buckets (an axis counts twice)."""
    buckets, out = max(2.0, rows / BUCKET_ROWS), []
    while buckets > 2 * size:
        out.append(size)
        buckets /= 2 * size
    if out and buckets < 4:      # near enough
        return out
    return [*out, min(size, max(1, round(buckets / 2)))]


def probes_for(rows: int, probes: int = PROBES) -> int:
    return math.ceil(probes * max(1.0, rows / PROBED_ROWS) ** (1 / 3))


def _turned(unit: np.ndarray, tab: int, parts: list[int]) -> Iterator[np.ndarray]:
    """The rows' coordinates along each cross-polytope's axes in a table."""
    for i, axes in enumerate(parts):
        yield rotated(unit, tab * 8 + i)[:, :axes]


def bucket(unit: np.ndarray, tab: int, parts: list[int]) -> np.ndarray:
    """Each row's bucket: axis i is digit 2 i, its opposite 2 i + 1."""
    out = np.zeros(len(unit), np.int64)
    for turned in _turned(unit, tab, parts):
        axis = np.abs(turned).argmax(axis=1)
        out = out * (2 * turned.shape[1]) + 2 * axis + (turned[np.arange(len(axis)), axis] < 0)
    return out


def probed(unit: np.ndarray, tab: int, parts: list[int], probes: int) -> np.ndarray:
    """Each row's ``probes`` nearest buckets (all, if fewer): those of the least sum of
    squared distances between its best and the taken axis's coordinate."""
    step = max(1, PROBED_AT_ONCE // (probes * 2 * max(parts)))
    if len(unit) > step:
        return np.concatenate([probed(unit[i:i + step], tab, parts, probes) for i in range(0, len(unit), step)])
    code, cost = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1), unit.dtype)
    for turned in _turned(unit, tab, parts):
        both = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
        lack = (both.max(axis=1, keepdims=True) - both) ** 2
        new = (cost[:, :, None] + lack[:, None, :]).reshape(len(unit), -1)
        digits = (code[:, :, None] * both.shape[1] + np.arange(both.shape[1])).reshape(len(unit), -1)
        if new.shape[1] > probes:      # a best sum has best parts
            top = np.argpartition(new, probes - 1, axis=1)[:, :probes]
            new, digits = np.take_along_axis(new, top, 1), np.take_along_axis(digits, top, 1)
        code, cost = digits, new
    return code


@dataclass(frozen=True)
class Band:
    """Rows of one dimension and about one length, scaled by 2^exponent."""

    number: int
    dim: int
    band: int
    rows: int
    mean: float       # of the squared scaled lengths
    spread: float
    top: float        # the largest |x|^2 + lift^2 there can be

    @property
    def lifted(self) -> bool:
        return self.spread > 0

    @property
    def parts(self) -> list[int]:
        width = self.dim + 2 * self.lifted
        return parts_for(self.rows, 1 << max(0, (width - 1).bit_length()))

    def points(self, v: np.ndarray, exponent: np.ndarray) -> np.ndarray:
        """Rows of the band as unit vectors."""
        x = v * np.exp2(exponent - self.band / BANDS)[:, None]
        square = (x * x).sum(axis=1)
        if self.lifted:
            lift = (self.mean - square) / (2 * self.spread)
            fill = np.sqrt(np.maximum(self.top - square - lift * lift, 0))
            x = np.concatenate([x, lift[:, None], fill[:, None]], axis=1)
        return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)

    def queries(self, v: np.ndarray, exponent: np.ndarray) -> np.ndarray:
        """Any vectors as unit vectors that the band's points are compared with."""
        if self.lifted:
            # (q, s, 0) with both scaled so that the larger is about 1
            shift = exponent - self.band / BANDS
            high = np.maximum(shift, 0)
            v = np.concatenate([v * np.exp2(shift - high)[:, None],
                                (self.spread * np.exp2(-high))[:, None], np.zeros((len(v), 1))], axis=1)
        return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def scaled(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(v / 2^e, e): rows with a largest component between 1/2 and 1, so squares are finite."""
    exponent = np.frexp(np.abs(v).max(axis=1))[1].astype(np.float64)
    return np.ldexp(v, -exponent.astype(np.int64)[:, None]), exponent


def bands_of(v: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """The band of each row's length: unit vectors are in the middle of one."""
    return np.rint(BANDS * (exponent + 0.5 * np.log2((v * v).sum(axis=1)))).astype(np.int64)


def _bands(usable: DataFrame) -> list[Band]:
    """What each dimension and band of lengths holds: at most some thousand rows, as
    lengths are doubles."""
    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for dim, pdf in whole.groupby(whole["embedding"].map(len)):
                v, e = scaled(matrix(pdf["embedding"]))
                band = bands_of(v, e)
                x = v * np.exp2(e - band / BANDS)[:, None]
                yield pd.DataFrame({"dim": int(dim), "band": band, "square": (x * x).sum(axis=1)})

    got = (usable.select("embedding").mapInPandas(measure, "dim int, band long, square double")
           .groupBy("dim", "band").agg(F.count("*").alias("n"), F.avg("square").alias("mean"),
                                       F.stddev_pop("square").alias("sd"), F.min("square").alias("least"),
                                       F.max("square").alias("most")).orderBy("dim", "band").collect())
    out = []
    for i, r in enumerate(got):
        equal = r["most"] - r["least"] <= EQUAL_LENGTHS * r["mean"]
        spread = 0.0 if equal else r["sd"] / (2 * math.sqrt(r["mean"]))
        lift = max(r["most"] - r["mean"], r["mean"] - r["least"]) / (2 * spread) if spread else 0.0
        out.append(Band(i, r["dim"], r["band"], r["n"], r["mean"], spread, r["most"] + lift * lift))
    return out


def _placed(usable: DataFrame, bands: list[Band]) -> DataFrame:
    """(vec_id, dim, vector, band, block, place): rows in blocks, by band and first hash."""
    known = {(b.dim, b.band): b for b in bands}

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for dim, pdf in whole.groupby(whole["embedding"].map(len)):
                own = matrix(pdf["embedding"])
                v, e = scaled(own)
                band = bands_of(v, e)
                for value in np.unique(band).tolist():
                    at, b = np.flatnonzero(band == value), known[int(dim), value]
                    yield pd.DataFrame({
                        "vec_id": pdf["vec_id"].to_numpy()[at], "dim": int(dim), "band": b.number,
                        "code": bucket(b.points(v[at], e[at]), 0, b.parts),
                        "vector": [x.tobytes() for x in own[at]]})

    rows = usable.mapInPandas(first, "vec_id long, dim int, band int, code long, vector binary")
    # the driver samples what rows are ordered by, for each partition: numbers, no vectors
    return (number_rows(rows.withColumn("mark", F.xxhash64("vector")), ["dim", "band", "code", "vec_id", "mark"], "n")
            .select("vec_id", "dim", "band", "vector", F.expr(f"(n - 1) div {BLOCK}").alias("block"),
                    ((F.col("n") - 1) % BLOCK).cast("int").alias("place")))


def _hashed(placed: DataFrame, bands: list[Band], tables: int) -> DataFrame:
    """(band, tab, code, block, places): the rows of every bucket, by block."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for number, pdf in whole.groupby("band"):
                b = bands[number]
                unit = b.points(*scaled(np.array([np.frombuffer(x) for x in pdf["vector"]])))
                for tab in range(tables):
                    yield pd.DataFrame({"band": b.number, "tab": tab, "code": bucket(unit, tab, b.parts),
                                        "block": pdf["block"].to_numpy(), "place": pdf["place"].to_numpy()})

    found = placed.select("band", "vector", "block", "place").mapInPandas(
        rows, "band int, tab int, code long, block long, place int")
    # a list holds places of one block: BLOCK at most
    return found.groupBy("band", "tab", "code", "block").agg(F.collect_list("place").alias("places"))


def _probed(asked: DataFrame, bands: list[Band], tables: int, probes: int) -> DataFrame:
    """(query, band, tab, code): the buckets that each query looks into."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for dim, pdf in whole.groupby("dim"):
                v, e = scaled(np.array([np.frombuffer(x) for x in pdf["vector"]]))
                ids = pdf["vec_id"].to_numpy()
                for b in bands:
                    if b.dim != dim:
                        continue
                    unit = b.queries(v, e)
                    for tab in range(tables):
                        code = probed(unit, tab, b.parts, probes_for(b.rows, probes))
                        yield pd.DataFrame({"query": np.repeat(ids, code.shape[1]), "band": b.number,
                                            "tab": tab, "code": code.ravel()})

    # few rows, each of much work; counted from the files' footers
    tasks = math.ceil(asked.count() / QUERY_ROWS) or 1
    return (asked.select("vec_id", "dim", "vector").repartition(tasks, "vec_id")
            .mapInPandas(rows, "query long, band int, tab int, code long"))


def candidates(placed: DataFrame, asked: DataFrame, bands: list[Band], tables: int = TABLES,
               probes: int = PROBES) -> DataFrame:
    """(query, block, places): every candidate of each query, once."""
    # a query has thousands of buckets: by the size of the queries' table a plan would broadcast them
    met = (_probed(asked, bands, tables, probes).hint("merge")
           .join(_hashed(placed, bands, tables), ["band", "tab", "code"]))
    return (met.groupBy("query", "block").agg(F.collect_list("places").alias("lists"))
            .select("query", "block", F.array_distinct(F.flatten("lists")).alias("places")))


def _search(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k nearest of its places in a block; no list means all of them."""
    asked, there = pdf[pdf["asked"]], pdf[~pdf["asked"]].sort_values("place")
    at, ids = there["place"].to_numpy(), there["vec_id"].to_numpy()
    dims = there["dim"].to_numpy()
    vectors = [np.frombuffer(x) for x in there["vector"]]
    by_dim = {d: np.flatnonzero(dims == d) for d in np.unique(dims).tolist()}
    stacked = {d: np.array([vectors[i] for i in own]) for d, own in by_dim.items()}
    row_of = np.zeros(len(dims), np.int64)
    for own in by_dim.values():
        row_of[own] = np.arange(len(own))
    out: list[tuple[int, int, float]] = []
    for q, dim, data, places in zip(asked["vec_id"].tolist(), asked["dim"].tolist(), asked["vector"], asked["places"]):
        if dim not in by_dim:
            continue
        own = by_dim[dim] if places is None else np.searchsorted(at, np.sort(np.asarray(places)))
        own = own[(dims[own] == dim) & (ids[own] != q)]
        if not len(own):
            continue
        gap = stacked[dim][row_of[own]] - np.frombuffer(data)[None, :]
        far = np.sqrt((gap * gap).sum(axis=1))
        order = np.lexsort((far, ids[own]))
        first = order[np.flatnonzero(np.diff(ids[own][order], prepend=ids[own][order[0]] - 1))]   # each id's nearest row
        best = first[np.lexsort((ids[own][first], far[first]))[:k]]
        out.extend((q, int(ids[own][i]), float(far[i])) for i in best)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"})


def _nearest(placed: DataFrame, asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k nearest candidates of each block.

    found: (query, block, places), places null for all of the block.
    """
    n = F.coalesce(F.size("places"), F.lit(BLOCK))
    load = found.groupBy("block").agg(F.ceil(F.sum(F.greatest(n, F.lit(1))) / QUERY_PLACES).alias("parts"))
    queries = (found.join(asked.select(F.col("vec_id").alias("query"), "dim", "vector"), "query")
               .join(load, "block")
               .select("block", F.pmod(F.xxhash64("query"), F.col("parts")).alias("part"), F.lit(True).alias("asked"),
                       F.col("query").alias("vec_id"), "dim", "vector", "places", F.lit(None).cast("int").alias("place")))
    rows = placed.join(load, "block").select(
        "block", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(False).alias("asked"),
        "vec_id", "dim", "vector", F.lit(None).cast("array<int>").alias("places"), "place")
    return queries.unionByName(rows).groupBy("block", "part").applyInPandas(
        lambda pdf: _search(pdf, k), "query_id long, vec_id long, score double")


def index(vectors: DataFrame, is_query: Column) -> tuple[DataFrame, DataFrame, list[Band]]:
    """(rows in blocks, queries, bands) of a table of vectors."""
    usable, path = materialize(with_usable(vectors).dropDuplicates(["vec_id", "embedding"]), "ann-rows")
    bands = _bands(usable)
    placed, _ = materialize(_placed(usable, bands), "ann-placed")
    discard(vectors.sparkSession, path)
    one = Window.partitionBy("vec_id").orderBy("dim", "vector")      # a query id answers once
    asked, _ = materialize(
        placed.where(is_query).withColumn("nth", F.row_number().over(one)).where("nth = 1")
        .select("vec_id", "dim", "vector"), "ann-queries")
    return placed, asked, bands


def search(vectors: DataFrame, is_query: Column, k: int = K, tables: int = TABLES,
           probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each query row."""
    placed, asked, bands = index(vectors, is_query)
    found, _ = materialize(_nearest(placed, asked, candidates(placed, asked, bands, tables, probes), k), "ann-found")
    have = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n"))
    few, _ = materialize(
        asked.join(have, F.col("vec_id") == F.col("query_id"), "left")
        .where(F.coalesce("n", F.lit(0)) < k).select(F.col("vec_id").alias("query"), "dim"), "ann-few")
    if not few.isEmpty():   # compared with every block that holds rows of their dimension
        everywhere = few.join(placed.select("dim", "block").distinct(), "dim").select(
            "query", "block", F.lit(None).cast("array<int>").alias("places"))
        found = found.unionByName(_nearest(placed, asked, everywhere, k))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_ann(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)
