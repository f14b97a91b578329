import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandflow.llm import packing
from tests.llm.conftest import SF


def encoder():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_first_fit_decreasing_matches_a_plain_scan(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 64)
    room, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(64)
        want[i] = (b, 64 - room[b])
        room[b] -= lengths[i]
    assert [want[i] for i in range(len(lengths))] == list(zip(bins.tolist(), offsets.tolist(), strict=True))


def test_ids_are_those_of_the_tokenizer():
    texts = ["", "  ", "a\tb c d", "It's İstanbul, ﬁne <|endoftext|>x y<|startoftext|>", "é ́a ÀÉ. ÀÉ,. ..., ½x x²", "Σας ΣΑΣ ẞ ǅ",
             "a​b c\x1cd\x85e", "x" * 100 + " " + "é" * 80, "<|STARTOFTEXT|> hi.,", "한글 각, 漢字。 abc", None,
             "it's' 'sa a_b a_ ___ (the) the). 5th 55,"]
    tok, own = encoder(), packing._tokenizer("word_bpe_49k.json")
    want = [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    flat, at = own.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    for text, ids in zip(texts, want, strict=True):
        assert own.encode(pa.array([text], pa.string()))[0].tolist() == ids


def check(rows, texts, size=2048):
    """Every id of every document once, sequences gapless and within the limit."""
    tok = encoder()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    for doc_id, text in texts:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(docs[doc_id], key=lambda r: r["start"])
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
        for r in own:
            piece = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert zlib.crc32(piece) == r["ids_crc32"]
    return seqs


def test_every_id_is_packed_once(spark):
    from demandflow.llm.queries import QUERIES
    rows = QUERIES["op2_packing"](spark, SF).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    seqs = check(rows, texts)
    tokens = sum(r["length"] for r in rows)
    assert len(seqs) <= 1.02 * tokens / 2048 + 1


def test_awkward_rows_and_sequences(spark, scratch, awkward):
    docs = awkward.where("doc_id < 9").dropDuplicates(["doc_id"])
    packed = packing.pack(packing.pieces(docs), scratch, group_pieces=4).withColumn("ids_crc32", F.crc32("ids"))
    rows = packed.collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    full = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in rows:
        own = full[r["sequence_id"]]
        assert own["n_tokens"] * 4 == len(own["ids"])
        assert own["ids"][4 * r["offset"]:4 * (r["offset"] + r["length"])] == r["ids"]
    # repeated rows and null ids are packed like any others
    every = packing.pack(packing.pieces(awkward), scratch).collect()
    assert sum(r["length"] for r in every if r["doc_id"] == 5) == 2 * next(r["doc_tokens"] for r in every if r["doc_id"] == 5)
    assert any(r["doc_id"] is None for r in every)
    assert packing.pack(packing.pieces(awkward.limit(0)), scratch).count() == 0
