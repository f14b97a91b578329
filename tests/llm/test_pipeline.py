"""The pipeline's stages against brute force on the smallest tables."""

import random

from tests.llm.conftest import SF, prose
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import check


def test_stages_match_brute_force(spark, scratch):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(cp.STAGES)
    kept = scratch.write(stages["quality_rules"](spark, docs, SF), "kept")
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    one = scratch.write(stages["ngram_join"](spark, kept, SF), "one")
    assert {r["doc_id"] for r in one.collect()} == {i for i, (_, c) in brute(rows).items() if i == c}
    clean = scratch.write(stages["decontamination"](spark, one, SF), "clean")
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(t in " ".join(r["text"].split()) for r in clean.collect() for t in items)
    hidden = scratch.write(stages["pii"](spark, clean, SF), "hidden")
    assert hidden.columns == docs.columns and hidden.count() == clean.count()
    check(stages["packing"](spark, hidden, SF).collect(), [tuple(r) for r in hidden.select("doc_id", "text").collect()])


def test_ids_link_no_texts(spark, scratch):
    import corpus_pipeline as cp

    rng = random.Random(3)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(1, a, "p"), (7, a + " w1x", "p"), (7, b, "p"), (9, b + " w2x", "p"), (9, c, "q"), (9, c, "p"), (None, d, "p"), (None, d, "p"),
            (None, c + " w3x", "p"), (5, None, "p"), (5, "", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in dict(cp.STAGES)["ngram_join"](spark, docs, SF).collect()]
    want = [(1, a, "p"), (7, b, "p"), (9, c, "p"), (None, d, "p"), (5, None, "p"), (5, "", "p")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_stages_with_any_columns_and_empty_tables(spark, scratch):
    import corpus_pipeline as cp

    rng = random.Random(8)
    text = prose(rng, 80)
    rows = [(1, text, {"a": 1}, 5, "e", 7, 1), (2, text + " w1x", {"a": 2}, 6, "e", 8, 2), (3, None, None, None, None, None, None), (4, "", {}, 1, "", 1, 3),
            (5, prose(rng, 30_000, 3000) + " joe@a.net", {"b": 0}, 1, "x", 150_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, n_entities int, row string, n_chars long, number int")
    stages = dict(cp.STAGES)
    for name in ("quality_rules", "ngram_join", "decontamination", "pii"):
        out = scratch.write(stages[name](spark, docs, SF), "out")
        assert out.columns == docs.columns and stages[name](spark, docs.limit(0), SF).count() == 0
        got = {r["doc_id"]: r for r in out.collect()}
        if name == "ngram_join":
            assert set(got) == {1, 3, 4, 5} and got[1]["m"] == {"a": 1}
        if name == "pii":
            assert len(got) == 5 and "joe@" not in got[5]["text"] and got[5]["n_chars"] == len(got[5]["text"]) and got[1]["n_entities"] == 5
    assert stages["packing"](spark, docs.limit(0), SF).count() == 0
