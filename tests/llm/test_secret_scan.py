"""Secret scans against a plain scanner, and the tests' and the false-discovery control's figures."""

import hashlib
import random
import re
import string

import pytest

from demandflow.llm import secret_scan as ss
from demandflow.llm.queries import QUERIES
from tests.llm.conftest import SF, prose


def brute_base(text):
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_", "api"))
    either = either.replace("[aA][pP][iI]_|[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]")
    out = [(m.start(), 0, m.end()) for m in re.finditer(f"({either})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
           if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(out)


def as_text(spans):
    return ",".join(f"{ss.KINDS[k]}:{a}:{b}" for a, k, b in spans)


AWKWARD = [
    "password=abcdefghijkl", "Token: 'abcdefghijkl'", "secret=secret=abcdefghijklmnop", "token: secret: abcdefghijklmnop", "API_KEY = \"x.y-z_012345\"",
    "apikey:0123456789abcdef0", "paſswd=abcdefghijkl", "toKen=abcdefghijkl", "AKIA" + "A" * 13, "AKIAAKIA" + "B" * 12, "xAKIA" + "Z" * 14,
    "0123456789abcde", "0123456789abcdef", "\U0001f600 token=abcdefghijklmn \U0001f600 0123456789abcdef0123", "password=short password=abcdefghijklm",
    "", " ", "é" * 100, "passwd\"" + " " * 5000 + "=" + "k" * 5000, "api__key=abcdefghijklm", "password==abcdefghijklmnop", "token\n=abcdefghijklmnop"]


def test_base_spans_match_the_plain_patterns(spark, scratch):
    rng = random.Random(1)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "AKIA", "abc", "0f", "=", ":", " ", "'", '"', "Z9", "\n", "é", "deadbeef"]
    texts = AWKWARD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for t in texts:
        assert ss.base_spans(t) == brute_base(t), t
    rows = [(k, t) for k, t in enumerate(texts[:200])] + [(None, "token=abcdefghijklmn"), (3, None), (3, texts[3])]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, row string, base string")
    got = ss.find(frame, scratch).select("row.doc_id", "row.base", ss.span_text("spans").alias("s")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    mine = sorted(((r["doc_id"], ",".join(x for x in r["s"].split(",") if not x.startswith("random"))) for r in got), key=key)
    assert mine == sorted(((i, as_text(brute_base(t or ""))) for i, t in rows), key=key)
    assert {r["base"] for r in got} == {"y"}
    only = ss.find(frame.select("text").limit(3), scratch)
    assert only.count() == 3 and ss.find(frame.limit(0), scratch).count() == 0


def test_query_on_the_whole_table(spark):
    got = QUERIES["op12_secret_scan"](spark, SF).collect()
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        spans = brute_base(r["text"] or "")
        text = as_text(spans)
        want.append((r["doc_id"], *[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(text.encode()).hexdigest(), text))
    base = [",".join(x for x in r["spans"].split(",") if not x.startswith("random")) for r in got]
    assert sorted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], b) for r, b in zip(got, base, strict=True)) == sorted(want)


@pytest.mark.parametrize("name", ["hex", "base32", "base62", "base64"])
def test_p_values_are_even_for_random_tokens(name):
    rng = random.Random(7)
    encoding, alphabet = list(ss.ALPHABETS).index(name), ss.ALPHABETS[name]
    found = [ss.battery("".join(rng.choice(alphabet) for _ in range(400)), encoding) for _ in range(1500)]
    for j in range(3):
        for level in (0.05, 0.25, 0.5):
            assert abs(sum(p[j] < level for p in found) / len(found) - level) < 0.05
    # each test alone sees what the others don't
    assert ss.battery(alphabet[0] * 100 + alphabet[-1] * 100, encoding)[1] < 1e-6
    assert ss.battery(alphabet * (200 // len(alphabet) + 1), encoding)[2] < 1e-6
    assert ss.battery((alphabet[0] + alphabet[-1]) * 100, encoding)[0] < 1e-6


def test_encodings_are_the_smallest_that_hold_a_token():
    names = list(ss.ALPHABETS)
    for token, name in [("0123", "decimal"), ("12ab", "hex"), ("12AB", "upper hex"), ("xyz", "lower"), ("XYZ", "upper"), ("XYZ27", "base32"), ("xyz9", "lower base36"),
                        ("XYZ9", "upper base36"), ("xYz", "letters"), ("xY9", "base62"), ("x+Y9", "base64"), ("x_Y9", "base64url"), ("x_Y+9", "mixed")]:
        assert names[ss.encoding_of(token)] == name


def test_thresholds_are_benjamini_hochberg():
    rng = random.Random(2)
    for _ in range(200):
        candidates = {(rng.randrange(2), rng.randrange(8, 10), rng.randrange(6)): rng.randrange(1, 9) for _ in range(10)}
        decoys = {(rng.randrange(2), rng.randrange(8, 10), rng.randrange(2, 8)): rng.randrange(1, 90) for _ in range(12)}
        limits = ss.thresholds(candidates, decoys, 0.1)
        each = []
        for (e, n, s), k in candidates.items():
            own = [x for (e2, n2, x), m in decoys.items() for _ in range(m) if e2 == e and n2 <= n]
            each += [((1 + sum(x <= s for x in own)) / (1 + len(own)), (e, n, s))] * k
        each.sort(key=lambda t: t[0])
        last = max((i for i, (p, _) in enumerate(each, 1) if p <= 0.1 * i / len(each)), default=0)
        level = each[last - 1][0] if last else -1
        want = {key for p, key in each if p <= level}
        assert {key for key in candidates if key[2] <= limits.get(key[:2], -1)} == want


def test_random_tokens_are_found_and_ordinary_ones_are_not(spark, scratch):
    rng = random.Random(9)
    syllables = ["ver", "bind", "ung", "tion", "user", "get", "set", "Value", "From", "Map", "Index", "data", "List"]
    words = ["the", "of", "Other", "letters", "quick", "River", "junk", "zebra", "Over", "while", "exact", "Home", "cause", "And", "version2", "step14"]
    rows, secret = [], {}
    for k in range(400):
        text = [rng.choice(words) for _ in range(300)]
        if k % 4 == 0:
            token = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randrange(40, 64)))
            secret[k] = token
            text.insert(rng.randrange(300), token)
        elif k % 4 == 1:
            text.insert(rng.randrange(300), "".join(rng.choice(syllables) for _ in range(9)) + "2")
        rows.append((k, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for r in ss.find(frame, scratch).collect():
        for a, kind, b in r["spans"]:
            if kind == 3:
                found.setdefault(r["row"]["doc_id"], []).append(dict(rows)[r["row"]["doc_id"]][a:b])
    hits = sum(found.get(k) == [t] for k, t in secret.items())
    assert hits >= 0.9 * len(secret)
    assert len(set(found) - set(secret)) <= 0.1 * len(found)


def test_long_texts(spark, scratch):
    text = prose(random.Random(4), 200_000, 5000) + " token=" + "Ab1" * 100_000 + " " + "0123456789abcdef" * 1000
    frame = spark.createDataFrame([(1, text), (2, "a" * 1_000_000)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["spans"] for r in ss.find(frame, scratch).collect()}
    assert [tuple(s) for s in got[1] if s[1] < 3] == brute_base(text) and [tuple(s) for s in got[2] if s[1] < 3] == brute_base("a" * 1_000_000)
