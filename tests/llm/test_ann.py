"""Nearest neighbours: what the index compares, and recall, on vectors without any structure."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvial.llm import ann


def frame(spark, m):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")


def measured(spark, m, step):
    """(recall of the ten nearest, share of rows compared a query)."""
    table = frame(spark, m).repartition(4)
    placed, asked, bands = ann.index(table, F.col("vec_id") % step == 0)
    share = (ann.candidates(placed, asked, bands).agg(F.sum(F.size("places"))).first()[0] or 0) / asked.count() / len(m)
    hits = n = 0
    got = {}
    for r in ann.search(table, F.col("vec_id") % step == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, len(m), step):
        far = ((m - m[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        assert len(got[q]) == 10
        hits += len(set(got[q]) & set(np.argpartition(far, 10)[:10].tolist()))
        n += 10
    return hits / n, share


def test_index_prunes_random_unit_vectors_and_more_as_they_grow(spark):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(50_000, 64))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    small, large = measured(spark, m[:5000], 100), measured(spark, m, 500)
    assert large[0] >= 0.9 and large[1] <= 0.1
    assert small[0] >= 0.9 and large[1] < 0.7 * small[1]


def test_index_prunes_where_lengths_differ(spark):
    rng = np.random.default_rng(8)
    m = rng.normal(size=(20_000, 64))
    m *= np.exp(rng.normal(0, 0.3, (len(m), 1))) / np.linalg.norm(m, axis=1, keepdims=True)
    recall, share = measured(spark, m, 200)
    assert recall >= 0.9 and share < 0.5


def test_a_hot_bucket_is_compared_whole(spark):
    """A third of the rows are alike: lists of places, block by block, nothing dropped."""
    rng = np.random.default_rng(9)
    m = rng.normal(size=(9000, 16))
    m[::3] = m[0]
    got = {}
    for r in ann.search(frame(spark, m), F.col("vec_id") % 900 == 0).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in range(0, 9000, 900):
        same = [i for i in range(0, 9000, 3) if i != q][:10]
        assert [v for v, _ in got[q]] == same and all(s == 0 for _, s in got[q])


def test_the_driver_gets_neither_probes_nor_vectors(spark, monkeypatch):
    """A query has thousands of probes, so these are never broadcast; range bounds hold no vectors."""
    orders, number_rows = [], ann.number_rows

    def seen(df, order, *rest):
        orders.append([df.schema[c].dataType.simpleString() for c in order])
        return number_rows(df, order, *rest)

    monkeypatch.setattr(ann, "number_rows", seen)
    m = np.random.default_rng(11).normal(size=(500, 16))
    placed, asked, bands = ann.index(frame(spark, m), F.col("vec_id") % 50 == 0)
    assert orders and not any("binary" in kinds for kinds in orders)
    plan = ann.candidates(placed, asked, bands)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_probes_of_many_queries_are_taken_in_parts(monkeypatch):
    unit = np.random.default_rng(12).normal(size=(40, 32)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    whole, shapes, partition = ann.probed(unit, 1, [32, 32], 20), [], np.argpartition
    monkeypatch.setattr(ann, "PROBED_AT_ONCE", 3 * 20 * 64, raising=False)
    monkeypatch.setattr(np, "argpartition", lambda a, *rest, **more: shapes.append(a.size) or partition(a, *rest, **more))
    assert (ann.probed(unit, 1, [32, 32], 20) == whole).all() and max(shapes) <= 3 * 20 * 64


def test_probes_are_the_nearest_buckets():
    rng = np.random.default_rng(10)
    unit = rng.normal(size=(6, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for parts in ([4], [16, 3], [16, 16, 2]):
        turned = [ann.rotated(unit, 5 * 8 + i)[:, :n] for i, n in enumerate(parts)]
        own = ann.bucket(unit, 5, parts)
        near = ann.probed(unit, 5, parts, 7)
        for row in range(len(unit)):
            costs = {0: 0.0}
            for t in turned:
                both = np.stack([t[row], -t[row]], axis=1).ravel()
                costs = {c * len(both) + j: v + (both.max() - both[j]) ** 2 for c, v in costs.items() for j in range(len(both))}
            best = sorted(costs, key=costs.get)[:7]
            assert best[0] == own[row]
            assert sorted(costs[c] for c in near[row].tolist()) == pytest.approx([costs[c] for c in best])


def test_lengths_of_any_size(spark):
    """Components near the limits of doubles: nothing overflows on the way to the buckets."""
    rng = np.random.default_rng(13)
    m = rng.normal(size=(300, 8))
    m[100:200] *= 1e150
    m[200:] *= 1e-150
    got = {}
    for r in ann.search(frame(spark, m), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert all(len(v) == 10 and all(np.isfinite(s) for _, s in v) for v in got.values())
