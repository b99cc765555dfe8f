"""Secret scans: linear time on whatever follows a keyword, and the spans of plain search."""

import base64
import json
import random
import re
import time

import pytest

from pluvial.llm import secrets

KEYS = secrets.automaton()
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----\s+([A-Za-z0-9+/=\s]+?)\s*-----END \1PRIVATE KEY-----")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")


def seconds(text):
    at = time.process_time()
    secrets.spans(text, KEYS)
    return time.process_time() - at


HEAD = "-----BEGIN PRIVATE KEY-----"


@pytest.mark.parametrize("unit", [
    HEAD + " " * 1_000_000, HEAD + "\n" + "A\n " * 330_000, HEAD + "A" * 1_000_000, (HEAD + " ") * 35_000,
    "-----BEGIN " + "A " * 500_000, "-----BEGIN " * 90_000, HEAD + " A" * 400_000 + "-----END RSA PRIVATE KEY-----",
    "eyJ" * 330_000, "eyJ." * 250_000, "eyJa." * 200_000, "eyJ-" * 200_000 + ".", "EYJ" * 330_000,
    ("eyJ" * 1000 + "." + "eyJ" * 1000) * 150, "eyJhIjp9." * 110_000,
    "token" * 200_000, "token " * 160_000, "token" + " " * 1_000_000, "token=" * 160_000, "token='" * 140_000,
    "api_key" + " " * 500_000 + ":" + " " * 500_000, "secret=" + "a" * 1_000_000,
    "AKIA" * 250_000, "akia" * 250_000, "AKIA" + "A" * 1_000_000,
    "a" * 1_000_000, "a0f" * 330_000, "abcdef0 " * 125_000, "abcdef" * 4 + "g", ("0" * 23 + "g") * 40_000,
    "ghp_" * 250_000, "ghp_" + "a" * 1_000_000, "npm_" * 250_000, "npm_a" * 200_000,
])
def test_a_megabyte_takes_linear_time(unit):
    assert seconds(unit) < 3


@pytest.mark.parametrize("make", [lambda n: HEAD + " " * n, lambda n: "eyJ" * n, lambda n: "eyJ." * n])
def test_twice_the_text_takes_about_twice_the_time(make):
    small, large = (min(seconds(make(n)) for _ in range(3)) for n in (200_000, 800_000))
    assert large < 10 * max(small, 0.005)


def plain(text):
    """jwt and pem by plain search over the whole text."""
    out = []
    for kind, pattern in (("jwt", JWT), ("pem", PEM)):
        at = 0
        while match := pattern.search(text, at):
            at = match.end()
            if kind == "jwt":
                try:
                    part = match[1]
                    head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
                    good = isinstance(head, dict) and "alg" in head
                except ValueError:
                    good = False
            else:
                try:
                    good = len(base64.b64decode("".join(match[2].split()), validate=True)) >= 32
                except ValueError:
                    good = False
            if good:
                out.append((kind, match.start(), match.end()))
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_jwt_and_pem_as_by_plain_search():
    rng = random.Random(1)

    def b64(data):
        return base64.urlsafe_b64encode(data).decode().rstrip("=")

    good = b64(b'{"alg":"HS256"}')
    key = base64.b64encode(bytes(range(60))).decode()
    parts = [good, b64(b'{"typ":"x"}'), "eyJ", "eyJx", ".", ".", "sig_1", " ", "\n", key, key[:7], "=", "-----",
             "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "-----END ", HEAD, " ", f"{HEAD}\n{key}\n-----END PRIVATE KEY-----",
             f"-----BEGIN RSA PRIVATE KEY-----\n {key[:40]}\n{key[40:]}-----END RSA PRIVATE KEY-----", f"{good}.eyJ9x.s-g", "é"]
    hits = 0
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        want = plain(text)
        hits += len(want)
        assert [s for s in secrets.spans(text, KEYS) if s[0] in ("jwt", "pem")] == want, text
    assert hits > 500


def test_deep_json_in_a_token_is_no_crash():
    text = "eyJ" + base64.urlsafe_b64encode(b'":' + b"[" * 300_000).decode().rstrip("=") + ".eyJx.y"
    assert secrets.spans(text, KEYS) == []
