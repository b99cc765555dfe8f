"""Source divergence audit against a brute-force version in plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pluvial.llm import divergence

DOC = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs, k):
    """rows: (text, lang, source)"""
    own, whole, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = TERM.findall(text.translate(LOWER))
        groups.add((lang, source))
        own[lang, source].update(terms)
        whole[lang].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        v = len(kept)

        def rates(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        q = rates(whole[lang])
        sources = [s for la, s in groups if la == lang]
        p = {s: rates(own[lang, s]) for s in sources}
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            out |= {(lang, s, "pair", o, -n, r) for r, (n, _, o) in enumerate(pairs, 1)}
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept
                           if own[lang, s][t] and p[s][t] > q[t])[:k]
            out |= {(lang, s, "term", t, -n, r) for r, (n, _, t) in enumerate(terms, 1)}
    return out


def result(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed=0, n=400, sources=9):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abXYé日🙂ß"), rng.integers(1, 4))) for _ in range(120)]
    mark = [" ", "-", "1", "_", "\n", "`", "\x7f", "[", "@"]
    rows = []
    for i in range(n):
        source = f"s{min(int(rng.zipf(1.4)) - 1, sources - 1)}"
        own = rng.choice(words[int(source[1:]) * 5:][:70], rng.integers(0, 30))
        rows.append((i, "".join(w + rng.choice(mark) for w in own), str(rng.choice(["en", "fr"])), source, 1))
    return rows


ODD = [(1, None, None, None, None), (2, "", "en", "s0", 0), (2, "", "en", "s0", 0), (None, "1 2 3", "xx", "only", 5),
       (3, "A a a" * 3, "", "", 9), (4, "A b", "yy", "z", 3), (5, None, "yy", "é", 3), (6, "-", "yy", "🙂", 1)]


@pytest.mark.parametrize("least,block,bucket", [(1, 256, 1 << 18), (3, 3, 40), (10, 1, 7)])
def test_against_brute_force(spark, least, block, bucket):
    rows = random_rows() + ODD
    df = spark.createDataFrame([(*r, 5, "x", 7) for r in rows], DOC + ", term long, item string, n long").repartition(5)
    got = result(divergence.audit(df, least_docs=least, source_block=block, bucket_rows=bucket))
    assert got == brute([r[1:4] for r in rows], least, 10)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang", "source").collect()
    assert result(E.queries()["op12_divergence"](spark, SF_SMALL)) == brute([tuple(r) for r in docs], 10, 10)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOC)).collect() == []


def test_large_counts_stay_exact(spark):
    df = spark.createDataFrame([(10**17, 3 * 10**17, 50_000)], "n long, total long, v long")
    got = df.select(divergence.rate(df.n, df.total, df.v)).first()[0]
    assert got == 1 + 10**9 * (10**17 + 2) // (3 * 10**17 + 100_000)
    p, q = 10**9 + 1, 1
    row = spark.createDataFrame([(p, q)], "p long, q long")
    assert row.select(divergence.difference(row.p, row.q)).first()[0] == (p - q) ** 2 // (p + q)


def test_skyband_keeps_all_that_can_be_ranked():
    rng = np.random.default_rng(2)
    for k in (1, 3, 10):
        own, lang = rng.integers(1, 40, 1500), rng.integers(1, 60, 1500)
        keep = divergence.skyband(own, lang, k, block=64)
        for i in range(len(own)):
            over = int(((own[:i] >= own[i]) & (lang[:i] <= lang[i])).sum())
            assert keep[i] == (over < k)


def test_long_texts_are_read_in_parts():
    text = "Ab cé-" * 400_000 + "z" * 3_000_000
    parts = list(divergence.term_parts(text))
    assert len(parts) > 2
    assert [t for p in parts for t in p] == [t.encode() for t in TERM.findall(text.translate(LOWER))]
