"""Secret scans: keyword automaton, anchored patterns near hits, checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over the
whole text; a kind's pattern is tried only where its keyword stands, anchored
there.  Kinds whose secrets carry a checksum or a structure of their own are
then checked against it, so look-alikes are not reported.

Kinds, in the order in which equal starts are listed:

* ``assign``  a password, token or key that is given a value of 6+ characters
* ``access``  access key ids, AKIA and 20+ characters in all
* ``hex``     runs of 24+ lower-case hex digits
* ``forge``   code-forge tokens (ghp_ and the like), last six characters are the
              base-62 CRC-32 of the thirty before
* ``package`` package-registry tokens (npm_), with the same checksum
* ``jwt``     signed tokens whose first part decodes to a JSON object with alg
* ``pem``     private key blocks whose body decodes as base 64

``hex`` has no keyword: a run of 24 covers six successive positions of every
fourth one, so only such positions are looked at, and the run is read around them.

Matches of a kind do not overlap: each search goes on behind the match before,
also behind one that is dropped for its length.  Spans are (kind, start, end)
in code points.  Null and empty texts have no spans; very long texts are read whole, in
time that grows with their length, whatever they hold; every row has a result of
its own, repeated rows equal ones; an empty table gives an empty result.  Only
doc_id and text are read; other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.llm.common import plain_documents, table

KINDS = ("assign", "access", "hex", "forge", "package", "jwt", "pem")
BASE_KINDS = KINDS[:3]
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = {
    "forge": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "package": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++"),
}
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]*+")
_PEM_HEAD = re.compile(r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----")
_PEM_BODY = re.compile(r"\s[A-Za-z0-9+/=\s]++")
#: What begins a secret of each kind, in lower case.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "package": ("npm_",),
    "jwt": ("eyj",),
    "pem": ("-----begin",),
}
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HEX_PROBE = re.compile(r"[0-9a-f]{6,}")


def base62(n: int, width: int = 6) -> str:
    out = ""
    while n:
        n, d = divmod(n, 62)
        out = _DIGITS[d] + out
    return out.rjust(width, "0")


def _decoded(part: str) -> bytes | None:
    try:
        return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))
    except (binascii.Error, ValueError):
        return None


def _coded(text: str, start: int, kind: str) -> tuple[int, bool]:
    """(where the search goes on, whether it ends a secret) of a token at ``start``.

    A position in a run of ``jwt`` letters matches if the run's end goes on as it
    must, so a run that does not match is passed as a whole.
    """
    match = CHECKED[kind].match(text, start)
    if not match:
        return (_JWT_RUN.match(text, start).end() if kind == "jwt" and text.startswith("eyJ", start) else start), False
    if kind == "jwt":
        try:
            head = json.loads(_decoded(match[1]) or b"")
        except (ValueError, RecursionError):   # also of the decoding of the bytes
            return match.end(), False
        return match.end(), isinstance(head, dict) and "alg" in head
    return match.end(), base62(zlib.crc32(match[1].encode())) == match[2]


def _key_block(text: str, start: int) -> tuple[int, bool]:
    """As ``_coded``, of a key block: its body is read once, up to what ends it."""
    head = _PEM_HEAD.match(text, start)
    body = _PEM_BODY.match(text, head.end()) if head else None
    end = f"-----END {head[1]}PRIVATE KEY-----" if body else ""
    if not body or not text.startswith(end, body.end()):
        return start, False
    try:
        good = len(base64.b64decode("".join(body[0].split()), validate=True)) >= 32
    except (binascii.Error, ValueError):
        good = False
    return body.end() + len(end), good


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _lowered(text: str) -> str:
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else text.translate(_LOWER)


def _hex_spans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for probe in _HEX_PROBE.finditer(text[::4]):
        at, last = probe.start() * 4, probe.end() * 4
        while at < last:   # several runs, if what parts them stands between positions
            start = at
            while start > done and text[start - 1] in "0123456789abcdef":
                start -= 1
            done = HEX.match(text, start).end()
            if done - start >= HEX_LEAST:
                yield start, done
            at = -(-done // 4) * 4


def spans(text: str, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All secrets of a whole text, by start, then kind."""
    found = [("hex", a, b) for a, b in _hex_spans(text)]
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, length) in keywords.iter(_lowered(text)):
        start = last - length + 1
        if start < done[kind]:
            continue
        if kind == "assign":
            match = ASSIGN.match(text, start)
            end, good = (match.end(), len(match[2]) >= ASSIGN_LEAST) if match else (start, False)
        elif kind == "access":
            match = ACCESS.match(text, start)
            end, good = (match.end(), match.end() - start >= ACCESS_LEAST) if match else (start, False)
        else:
            end, good = _key_block(text, start) if kind == "pem" else _coded(text, start, kind)
        done[kind] = max(done[kind], end)
        if good:
            found.append((kind, start, end))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redacted(text: str, keywords: ahocorasick.Automaton) -> str:
    """The text with every run of overlapping spans replaced by the first one's
    kind in angle brackets."""
    out, at, end = [], 0, -1
    for kind, start, stop in spans(text, keywords):
        if start >= end:
            out += [text[at:start], f"<{kind}>"]
        at = end = max(end, stop)
    return "".join(out) + text[at:] if out else text


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, found: array of (kind, start, end)) per row of ``docs``."""
    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keywords = automaton()
        for part in texts:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in spans(t, keywords)]
                             for t in part])

    return plain_documents(docs).select("doc_id", scan("text").alias("found"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets taken out of ``text``; ``n_chars``, if there, follows."""
    @F.pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keywords = automaton()
        for part in texts:
            yield pd.Series([None if t is None else redacted(t, keywords) for t in part], dtype=object)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    text_of = F.transform("found", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    joined = F.concat_ws(",", F.transform(base, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    return found.select("doc_id", *map(count, BASE_KINDS),
                        F.sha2(joined.cast("binary"), 256).alias("base_sha256"),
                        F.concat_ws(",", text_of).alias("spans"))
