import json

import pytest

from pluvial.sources import hierarchy as H

ROOT = "http://h/icd/release/10/2019"


def _docs(spark, nodes):
    return spark.createDataFrame([(u, json.dumps(d)) for u, d in nodes.items()], "url string, doc string")


def test_bfs_first_discoverer_cycles_and_parsing(spark):
    u = lambda s: f"{ROOT}/{s}"
    nodes = {
        ROOT: {"title": {"@value": "root"}, "child": [u("I"), u("II")]},
        u("I"): {"title": {"@value": "Chapter I"}, "child": [u("A00-A09"), u("B00-B09")]},
        u("II"): {"title": {"@value": "Chapter II"}, "child": [u("A00-A09"), u("C00")]},
        u("A00-A09"): {"code": "A00-A09", "title": {"@value": "Block A"},
                       "definition": {"@value": "Intestinal"}, "child": [u("A00"), ROOT]},
        u("B00-B09"): {"code": "B00-B09", "title": {"@value": "Block B"}, "definition": "plain",
                       "child": [u("A00")]},
        u("C00"): {"code": "C00", "title": {"@value": "Lip"}},
        u("A00"): {"code": "A00", "title": {"@value": "Cholera"}, "child": [u("I")]},
    }
    docs = _docs(spark, nodes)
    out = {r.code: r for r in H.flatten(spark, H.parse_entities(docs),
                                        H.links_from_documents(docs), ROOT).collect()}
    assert set(out) == {"A00-A09", "B00-B09", "C00", "A00"}
    # A00-A09 is listed by I (first in queue) and II: I wins
    assert out["A00-A09"].parent_code == "I" and out["A00-A09"].depth == 2
    # A00 is listed by A00-A09 and B00-B09 at the same depth: A00-A09 is earlier in the queue
    assert out["A00"].parent_code == "A00-A09" and out["A00"].depth == 3
    assert out["C00"].parent_code == "II"
    assert out["A00-A09"].description == "Intestinal"
    assert out["B00-B09"].description is None          # definition not an object
    assert out["A00"].title == "Cholera"


def test_year_segment_gives_null_parent(spark):
    nodes = {ROOT: {"child": [f"{ROOT}/X1"]}, f"{ROOT}/X1": {"code": "X1", "title": {"@value": "x"}}}
    docs = _docs(spark, nodes)
    r = H.flatten(spark, H.parse_entities(docs), H.links_from_documents(docs), ROOT).collect()
    assert [(x.code, x.parent_code, x.depth) for x in r] == [("X1", None, 1)]


def test_recursive_query_agrees_with_the_walk(spark):
    """Shared children at the same and at different depths, a node listed twice, no cycle."""
    u = lambda s: f"{ROOT}/{s}"
    nodes = {ROOT: {"child": [u("A"), u("B"), u("C")]},
             u("A"): {"code": "A", "child": [u("X"), u("Y"), u("Y")]},
             u("B"): {"code": "B", "child": [u("Y"), u("X"), u("Z")]},
             u("C"): {"code": "C", "child": [u("Z"), u("W")]},
             u("X"): {"code": "X", "child": [u("W")]},
             u("Y"): {"code": "Y"}, u("Z"): {"code": "Z", "child": []}, u("W"): {"code": "W"}}
    docs = _docs(spark, nodes)
    links = H.links_from_documents(docs)
    one, two = (sorted(map(tuple, walk(spark, links, ROOT).select("url", "parent_url", "depth").collect()), key=str)
                for walk in (H.walk, H.walk_recursive))
    assert one == two and len(one) == 8
    found = {r.code: (r.parent_code, r.depth) for r in H.flatten(
        spark, H.parse_entities(docs), links, ROOT, H.walk_recursive).collect()}
    assert found["W"] == ("C", 2) and found["Z"] == ("B", 2) and found["Y"] == ("A", 2)


def test_recursive_query_fails_on_a_cycle(spark, monkeypatch):
    monkeypatch.setattr(H, "MAX_LEVELS", 20)
    docs = _docs(spark, {ROOT: {"child": [f"{ROOT}/A"]}, f"{ROOT}/A": {"code": "A", "child": [ROOT]}})
    with pytest.raises(Exception, match="RECURSION"):
        H.walk_recursive(spark, H.links_from_documents(docs), ROOT)
    assert H.walk(spark, H.links_from_documents(docs), ROOT).count() == 2


def test_links_and_documents_are_derived_once(spark, monkeypatch):
    """The recursive query joins written links on every level, and documents land in several tasks."""
    from conftest import SF_SMALL
    from pluvial.sources import derived as D
    from pluvial.sources import hierarchy as H
    from pluvial.sources.tables import Tables

    written, write = [], H.reliable_checkpoint
    monkeypatch.setattr(H, "reliable_checkpoint", lambda df: written.append(df.columns) or write(df))
    links = spark.createDataFrame([("r", "a", 0), ("r", "b", 1), ("a", "c", 0), ("b", "c", 0)],
                                  "parent_url string, child_url string, ordinal int")
    got = {(r.url, r.parent_url, r.depth) for r in H.walk_recursive(spark, links, "r").collect()}
    assert got == {("r", None, 0), ("a", "r", 1), ("b", "r", 1), ("c", "a", 2)}
    assert written == [["parent_url", "child_url", "ordinal"], ["url", "parent_url", "depth", "path"]]
    monkeypatch.setattr(D, "TASK_DOCUMENTS", 50)
    t = Tables(spark, SF_SMALL)
    landed, want = D.landed_documents(t), D.numbered_documents(t)
    assert len(landed.inputFiles()) > 2
    assert landed.exceptAll(want).isEmpty() and want.exceptAll(landed).isEmpty()
