"""Cross-tokenizer alignment against a brute-force version."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as E
from conftest import SF_SMALL
from pluvial.llm import alignment, chunked

DOC = "doc_id long, text string, lang string, source string, n_chars long"
A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_signs():
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


SIGNS = byte_signs()


def spelled(text):
    """(ids, token bytes) of A and of B."""
    a, b = A.encode(" " + text, add_special_tokens=False), B.encode(text)
    pieces = [B.id_to_piece(i) for i in b]
    return (a.ids, [bytes(SIGNS[c] for c in t) for t in a.tokens],
            b, [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)])


def brute(texts):
    """Per text (n_a, n_b, n_groups, links, digest), by walking along both sequences."""
    out = []
    for text in texts:
        text = text or ""
        ia, ta, ib, tb = spelled(text)
        whole = (" " + text).encode()
        if not text or b"".join(ta) != whole or b"".join(tb) != whole:
            out.append((0, 0, 0, [], ""))
            continue
        ea, eb = np.cumsum([len(t) for t in ta]).tolist(), np.cumsum([len(t) for t in tb]).tolist()
        shared = sorted(set(ea) & set(eb))
        groups, links, i, j = [], [], 0, 0
        for cut in shared:
            ga, gb = [], []
            while i < len(ea) and ea[i] <= cut:
                ga.append(i)
                i += 1
            while j < len(eb) and eb[j] <= cut:
                gb.append(j)
                j += 1
            for x in ga:
                for y in gb:
                    if max(ea[x] - len(ta[x]), eb[y] - len(tb[y])) < min(ea[x], eb[y]):
                        links.append((ia[x], ib[y]))
            groups.append(",".join(str(ia[x]) for x in ga) + "|" + ",".join(str(ib[y]) for y in gb))
        out.append((len(ia), len(ib), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def expected(rows):
    found = brute([t for _, t in rows])
    count = Counter(link for f in found for link in f[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(((i if i is not None else -1), f[0], f[1], f[2], len(f[3]),
                   sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]), f[4])
                  for (i, _), f in zip(rows, found))


def result(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best,
                   r.count_sum, r.groups_sha256) for r in df.collect())


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(E.queries()["op13_alignment"](spark, SF_SMALL)) == expected(rows)


ODD = [(1, "plain words, twice"), (1, "plain words, twice"), (None, "no id"), (2, None), (3, ""), (4, " "),
       (5, "▁marks▁"), (6, "a <|endoftext|> b <s> <0x41> </s>"), (7, "日本語とemoji 🙂🙃 mixed\r\n\ttabs\x00"),
       (8, "x" * 5000 + " " + "ab" * 3000), (9, " lead  and   trail   "), (10, "é   　 wide"),
       (11, None), (None, None), (12, "🙂" * 400), (13, "-" * 3000 + "=" * 2500)]


@pytest.mark.parametrize("chunk_chars", [1, 200, 1 << 22])
def test_odd_texts_and_chunk_sizes(spark, chunk_chars):
    df = spark.createDataFrame([(i, t, "en", "s", 1, 7, "x") for i, t in ODD],
                               DOC + ", chunk long, links string").repartition(3)
    assert result(alignment.align(df, chunk_chars=chunk_chars)) == expected(ODD)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], DOC)).collect() == []


def test_long_texts_in_parts_keep_ids():
    rng = np.random.default_rng(0)
    words = ["tion", "  ", "über", "x", "日本", "🙂", "\n", ".", "a" * 50]
    text = " ".join(rng.choice(words, 4000))
    tokens = alignment.tokenizers(*alignment.default_paths())[1]
    whole = B.encode(text)
    for size in (1, 17, 1000):
        split = alignment.parts(text, size)
        assert " ".join(split) == text and len(split) > 3
        assert [i for p in split for i in B.encode(p)] == whole
    assert tokens.encode([text])[0].tolist() == whole


def test_shared_cuts_of_random_ends():
    rng = np.random.default_rng(3)
    for density in (0.02, 0.3, 0.9):
        a, b, first, last, at = [], [], [], [], 0
        for _ in range(40):
            size = int(rng.integers(1, 300))
            inner = np.arange(1, size)
            own_a, own_b = inner[rng.random(size - 1) < density], inner[rng.random(size - 1) < 0.3]
            first.append(len(a))
            a += [*(at + own_a), at + size]
            b += [*(at + own_b), at + size]
            last.append(len(a) - 1)
            at += size
        cut = alignment.shared_cuts(np.array(a), np.array(b), np.array(first), np.array(last))
        assert cut.tolist() == np.isin(a, b).tolist()


def test_cutless_stretches_take_few_rounds():
    """A stretch of 2^20 ends without a shared one: windows double, nothing is looked up often."""
    n = 1 << 20
    a, b = np.append(np.arange(n) * 2 + 1, 2 * n + 2), np.append(np.arange(n) * 2 + 2, 2 * n + 2)[1:]
    cut = alignment.shared_cuts(a, b, np.array([0]), np.array([n]))
    assert cut.sum() == 1 and cut[-1]


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for numbers in (np.empty(0, np.int64), np.array([5, 5, 9, 0, 1, 2**32 - 1, 3]), rng.integers(0, 1 << 32, 1000)):
        assert chunked.unpack(chunked.pack(numbers)).tolist() == numbers.tolist()
        assert chunked.unpack_sorted(chunked.pack_sorted(numbers)).tolist() == numbers.tolist()
