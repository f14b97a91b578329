import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandflow.llm import lm_scoring
from demandflow.llm.elias_fano import EliasFano, Trie
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]  # None: the end


def brute(rows, mu=500.0):
    c, pairs, n_texts = Counter(), Counter(), 0
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    for (_, text), h in zip(rows, held, strict=True):
        if not h:
            t = tokens(text)
            c.update(t)
            pairs.update(zip(["<s>", *t[:-1]], t, strict=True))
            n_texts += 1
    n, v = sum(c.values()), len(c)
    out = []
    for (i, text), h in zip(rows, held, strict=True):
        t = tokens(text)
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)
        model = 0.0
        for a, b in zip([("<s>",), *[(x,) for x in t[:-1]]], t, strict=True):
            context = n_texts if a == ("<s>",) else c[a[0]]
            model += math.log10((pairs[a[0], b] + mu / (n + 1) * max(1, c[b])) / (context + mu))
        out.append((i, h, len(t), sum(c[x] > 0 for x in t), n, base, model))
    return out


def compare(got, want):
    got = sorted((tuple(r) for r in got), key=repr)
    want = sorted(want, key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=0.02, abs=0.3)  # masses are quantised


def test_the_query_matches_brute_force_and_beats_the_base(spark):
    from demandflow.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op9_lm_scoring"](spark, SF).collect()
    compare(got, brute(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_awkward_rows(spark, scratch, awkward):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    compare(lm_scoring.score(awkward, scratch).collect(), brute(rows))
    assert lm_scoring.score(awkward.limit(0), scratch).count() == 0
    # nothing to learn from: 9 is held out
    only = awkward.where("doc_id = 9")
    assert lm_scoring.is_held_out(9) == (zlib.crc32(b"9") % 5 == 1)
    compare(lm_scoring.score(only, scratch).collect(), brute([tuple(r) for r in only.select("doc_id", "text").collect()]))


def test_a_task_holds_one_part_and_returns_each_block_once(spark, scratch, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % 90}" for k in range(i % 50))) for i in range(300)] + [(i, "the same text") for i in range(40)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    compare(lm_scoring.score(docs, scratch).collect(), brute(rows))
    frequent, tokens, _ = lm_scoring.frequent_words(docs, scratch)
    sent = lm_scoring.messages(docs, list(frequent), 6).toArrow().sort_by([("shard", "ascending"), ("sub", "ascending")])
    held = []
    add = lm_scoring._add_part
    monkeypatch.setattr(lm_scoring, "_add_part", lambda totals, parts, *a: held.append(len(parts)) or add(totals, parts, *a))

    def sums(rows_of_batch, entries):
        monkeypatch.setattr(lm_scoring, "ENTRIES", entries)
        got = [r for b in lm_scoring.shard_sums(iter(sent.to_batches(rows_of_batch)), frequent, tokens, 500.0) for r in b.to_pylist()]
        assert sum(r["kind"] == "words" for r in got) == 1
        docs_of, sums_of = ({r["block"]: r for r in got if r["kind"] == k} for k in ("docs", "sums"))
        assert len(sums_of) == len(docs_of) == sum(r["kind"] == "sums" for r in got)  # once for all six shards
        return {b: np.r_[np.frombuffer(r["base"]), np.frombuffer(r["score"]), np.frombuffer(r["n_known"], "<u4")] for b, r in sums_of.items()}

    whole, cut = sums(10_000, 500_000), sums(3, 7)
    assert max(held) <= len(whole) and whole.keys() == cut.keys()
    for b, x in whole.items():
        assert cut[b] == pytest.approx(x, rel=1e-12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(5001, 10 ** 9))
def test_elias_fano_round_trip(values, universe):
    v = np.sort(np.array(values, np.uint64))
    e = EliasFano.of(v, universe)
    assert (e.get(np.arange(len(v))) == v).all()
    asked = np.array([*values, 0, 5000, universe - 1, *[x + 1 for x in values]], np.uint64)
    assert (e.successor(asked) == np.searchsorted(v, asked, "left")).all()


def test_trie_finds_exactly_its_pairs():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 60, (900, 2)), axis=0).astype(np.uint64) * np.uint64(7919 ** 3)
    log_p, contexts = rng.uniform(-5, 0, len(pairs)), np.unique(pairs[:, 0])
    backoff = rng.uniform(-5, -1, len(contexts))
    trie = Trie(pairs[:, 0], pairs[:, 1], log_p, backoff)
    asked = rng.integers(0, 70, (3000, 2)).astype(np.uint64) * np.uint64(7919 ** 3)
    got, weight = trie.query(asked[:, 0], asked[:, 1])
    p, b = dict(zip(map(tuple, pairs.tolist()), log_p, strict=True)), dict(zip(contexts.tolist(), backoff, strict=True))
    for (x, y), g, w in zip(asked.tolist(), got, weight, strict=True):
        assert ((x, y) in p) == (not np.isnan(g))
        assert (x, y) not in p or abs(p[x, y] - g) < 0.1
        assert abs(b.get(x, 0) - w) < 0.1
    trie.close()
    empty = Trie(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    assert np.isnan(empty.query(asked[:, 0], asked[:, 1])[0]).all()
    empty.close()
