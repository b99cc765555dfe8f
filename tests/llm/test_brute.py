"""Scores of all rows against naive versions: a loop over every n-gram of every text, from the fitted numbers."""

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF_SMALL
from pluvial.llm import langid, mixing, ngrams, quality, toxicity
from pluvial.llm.extract import extract

EDGE = ".,;:!?\"'()[]{}<>«»„“”‘’…"
BASE, SPREAD, MASK = 0x100000001B3, 0x9E3779B97F4A7C15, (1 << 64) - 1


def gram_code(text, salt, shift):
    total = sum(ord(c) * pow(BASE, k, 1 << 64) for k, c in enumerate(text)) & MASK
    return ((total + salt) * SPREAD & MASK) >> shift


def word_grams(word, orders, buckets, whole=True):
    """(order, bucket, characters) of a marked word's n-grams; order 0 is the whole word."""
    shift = 64 - (buckets.bit_length() - 1)
    for n in orders:
        for i in range(len(word) - n + 1):
            yield n, gram_code(word[i:i + n], n, shift), word[i:i + n]
    if whole:
        total = sum(ord(c) * pow(BASE, k + 1, 1 << 64) for k, c in enumerate(word)) & MASK
        yield 0, (total * SPREAD & MASK) >> shift, word


def marked(text):
    return [f"<{w.strip(EDGE)}>" for w in text.lower().split()]


def naive_toxicity(text, model):
    values, before = [], None
    for word in marked(text):
        grams = list(word_grams(word, toxicity.ORDERS, toxicity.BUCKETS))
        if grams[-1][1] != before:
            values.append(sum(model.bucket[b] for _, b, _ in grams) / len(grams))
        before = grams[-1][1]
    width = toxicity.PASSAGE
    runs = [values[i:i + width] for i in range(max(1, len(values) - width + 1))]
    top = max((sum(r) / len(r) for r in runs if r), default=0.0)
    return 1 / (1 + math.exp(-(model.slope * (top + model.offset) + model.shift)))


def naive_quality(text, model):
    words, half = text.split(), quality.BUCKETS // 2
    own = {zlib.crc32(w.lower().encode("utf-8", "replace")) % half for w in words}
    signs = []
    for i, w in enumerate(words):
        plain = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in w)
        code = zlib.crc32(re.sub(r"(.)\1+", r"\1", plain).encode("utf-8", "replace")) & 0x3FFFFFFF
        signs.append(2 * code + (i > 0 and w == words[i - 1]))
    shapes = {s % 1_000_003 % half for s in signs}
    for n in quality.SHAPE_ORDERS[1:]:
        for i in range(len(signs) - n + 1):
            code = n
            for s in signs[i:i + n]:
                code = (code * 1_000_003 + s) % 2_147_483_647
            shapes.add(code % half)
    margin = model.offset
    for held in (own, {s + half for s in shapes}):
        if held:
            margin += sum(model.weight[b] for b in held) / math.sqrt(len(held))
    return 1 / (1 + math.exp(-(model.slope * margin + model.shift)))


ODD = ["", "   ", "…", "A", "x " * 20, "Word word WORD, (word)! " * 3, "é" * 300, "1 2 3 a-b c_d <tag> 日本 🙂🙂"]


@pytest.mark.parametrize("op,label,naive", [(toxicity, "toxic", naive_toxicity), (quality, "quality", naive_quality)])
def test_classifiers_score_every_text_as_the_naive_version(spark, op, label, naive):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = op.train(docs, labels)
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    texts = [(r.doc_id, r.text) for r in small.collect() if len(r.text or "") < 6000] + [(-1 - i, t) for i, t in enumerate(ODD)]
    got = {r.doc_id: r.score for r in op.classify(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert len(got) == len(texts) > 150
    for i, text in texts:
        assert got[i] == pytest.approx(naive(text or "", model), rel=1e-6, abs=1e-9), (i, text[:80])


def test_toxicity_passages_by_rank_and_bounded():
    rng = np.random.default_rng(0)
    means = rng.normal(size=5000) + 3
    taken = toxicity.starts_of(means, 1, 5, 0.1)
    assert taken[0] == means.argmax() and len(taken) == toxicity.TOXIC_PASSAGES
    assert all(abs(a - b) >= toxicity.PASSAGE // 2 for i, a in enumerate(taken) for b in taken[:i])
    # the highest wherever they stand, not the first ones
    assert min(means[taken]) >= np.sort(means)[-200]
    clean = toxicity.starts_of(means, 0, 5, 0.1)
    assert clean[0] == means.argmax() and 60 < len(clean) < 200
    assert toxicity.starts_of(np.zeros(1), 1, 0, 1.0) == [0]


def test_passage_weights_are_the_averaging_matrix():
    bucket = np.random.default_rng(1).normal(size=toxicity.BUCKETS)
    words = "These are, (some) words of übung x".split()
    used, mass = toxicity.weights(words)
    values = toxicity.word_values(" ".join(words), bucket)
    assert (bucket[used] * mass).sum() == pytest.approx(values.mean()) and mass.sum() == pytest.approx(1)
    assert set(used.tolist()) == {b for w in marked(" ".join(words))
                                  for _, b, _ in word_grams(w, toxicity.ORDERS, toxicity.BUCKETS)}


# --- language ----------------------------------------------------------------

def naive_likelihood(text, model):
    total = np.zeros(len(model.languages))
    for word in marked(text):
        if word == "<>":
            continue
        for n, bucket, chars in word_grams(word, langid.ORDERS, langid.BUCKETS, whole=False):
            if n > 1 or chars not in ("<", ">") or word[1:-1].count(chars):
                if n == 1 and chars in ("<", ">"):
                    continue
                total += model.log_share[bucket]
    return langid.TEMPER * total


def softmax(logs):
    e = np.exp(np.asarray(logs) - max(logs))
    return e / e.sum()


def naive_pages(rows, model):
    """{page: (language, confidence)} by plain loops over all pages."""
    n = len(model.languages)
    seen = []
    for page_id, url, html in rows:
        host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", url or "")
        host = host[1].lower() if host else ""
        said = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})(?![A-Za-z])", html or "", re.I)
        logs = naive_likelihood(extract(html or "", None), model)
        levels = (host, ".".join(host.split(".")[-2:]), host.split(".")[-1], "all")
        seen.append((page_id, levels, said[1].lower() if said else "", logs, softmax(logs)))
    counts, declared = defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n))
    for _, levels, said, _, post in seen:
        declared[said] += post
        for k, level in enumerate(levels):
            counts[k, level] += post
    total = sum(declared.values())
    out = {}
    for page_id, levels, said, logs, post in seen:
        prior = np.full(n, 1 / n)
        for k in (3, 2, 1, 0):
            own = np.maximum(counts[k, levels[k]] - post, 0)
            prior = (own + langid.SMOOTH_HOST * prior) / (own.sum() + langid.SMOOTH_HOST)
        if said:
            logs = logs + np.log((declared[said] + langid.SMOOTH_DECLARED) / (total + 10 * langid.SMOOTH_DECLARED))
        final = softmax(logs + np.log(prior))
        out[page_id] = (model.languages[int(final.argmax())], final.max())
    return out


def test_languages_of_all_pages_as_the_naive_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs)
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()][:150] + [(-1, None, None), (-2, "http://a.b.example/x", "<html lang=de>")]
    got = langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    want = naive_pages(rows, model)
    assert len(got) == len(rows)
    for r in got:
        assert r.lang == want[r.page_id][0] and r.confidence == pytest.approx(want[r.page_id][1], rel=1e-6)


def test_languages_of_all_texts_as_the_naive_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 4000] + [(-1 - i, t) for i, t in enumerate(ODD)]
    got = langid.identify_texts(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    logs = {i: naive_likelihood(t or "", model) for i, t in rows}
    posts = {i: softmax(x) for i, x in logs.items()}
    whole = sum(posts.values())
    for r in got:
        own = np.maximum(whole - posts[r.doc_id], 0)
        prior = (own + langid.SMOOTH_HOST / len(model.languages)) / (own.sum() + langid.SMOOTH_HOST)
        final = softmax(logs[r.doc_id] + np.log(prior))
        assert r.lang == model.languages[int(final.argmax())] and r.confidence == pytest.approx(final.max(), rel=1e-6)


# --- mixing ------------------------------------------------------------------

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_targets_are_met_beside_very_long_documents(spark):
    rows = [(i, "w " * 100, "en", "a", 0) for i in range(4000)] + [(5000 + i, "w " * 60_000, "en", "a", 0) for i in range(12)]
    rows += [(6000 + i, "w " * (50 + i % 40), "en", "b", 0) for i in range(3000)]
    rows += [(10_000 + i, f"{i} " * 30_000, "en", "c", 0) for i in range(5)]       # long ones only
    got = mixing.mix_report(spark.createDataFrame(rows, DOC).repartition(4)).collect()
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    for lo, hi, least in ((0, 6000, 100), (6000, 10_000, 90), (10_000, 20_000, 30_000)):
        own = [r for r in got if lo <= r.doc_id < hi]
        assert abs(sum(r.taken for r in own) - own[0].target) <= least


def test_many_sources_are_dealt_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCE_GROUP", 7)
    monkeypatch.setattr(mixing, "RANGE_BLOCKS", 5)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    rows = [(i, "w " * (20 + i % 30), "en", f"s{i % 60}", 0) for i in range(6000)]
    df = spark.createDataFrame(rows, DOC)
    sized = mixing.sizes(df)
    sources = mixing.source_targets(sized, block_words=200)
    where = mixing.placements(sized, sources, shard_words=6000).collect()
    taken, blocks = mixing.draws(sized, sources)
    assert len(where) == sum(r.copies for r in taken.collect())
    assert len({(r.sid, r.key, r.size, r.copy) for r in where}) == len(where)
    words = defaultdict(int)
    for r in where:
        words[r.shard] += r["size"]
    assert len(words) > 20 and max(words.values()) < 2 * sum(words.values()) / len(words)


# --- pipeline ----------------------------------------------------------------

def test_pipeline_on_odd_rows_and_an_empty_table(spark, tmp_dir):
    extra = ", score double, class int, node long"
    text = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(40).collect()
    rows = [(i, r.text, "en", f"s{i % 3}", len(r.text or "")) for i, r in enumerate(text)]
    rows += [(1, rows[1][1], "en", "s1", 5), (1, rows[1][1], "en", "s1", 5), (None, rows[2][1], None, None, None),
             (None, None, None, None, None), (60, "", "en", "s1", 0), (61, None, "en", "s0", None),
             (62, " ".join(rows[3][1].split() * 200), "en", "s1", 1), (63, "token=abcdef123456 " + rows[4][1], "en", "", 1)]
    for name, batch in (("odd", rows), ("empty", [])):
        folder = f"{tmp_dir}/{name}"
        df = spark.createDataFrame([(*r, 0.5, 1, 2) for r in batch], DOC + extra)
        df.repartition(2).write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert (len(out) > 0) == (name == "odd")
        by_doc = defaultdict(list)
        for r in out:
            by_doc[r.doc_id].append(r)
        for parts in by_doc.values():       # whole documents, each as often as it was taken
            assert sum(r.length for r in parts) == sum(r.doc_tokens for r in parts if r.start == 0)


def test_ngram_chunks_cut_between_words():
    text = "word " * 200_000
    assert len(list(ngrams.chunks(text))) > 2 and " ".join(ngrams.chunks(text)) == text
