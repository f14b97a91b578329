import random
import re

from pyspark.sql import functions as F

from demandflow.llm import ngram_join
from demandflow.llm.graph import components
from tests.llm.conftest import SF, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n=5, percent=80):
    """Sizes and components by comparing all pairs; rows: (id, text), ids unique."""
    sets = {i: shingles(t, n) for i, t in rows}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                least[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_the_query_matches_all_pairs(spark):
    from demandflow.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op4_ngram_join"](spark, SF)) == brute(rows)


def near(rng, words, edits):
    words = words.split()
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_near_copies_chains_and_thresholds(spark, scratch):
    rng = random.Random(3)
    texts = []
    for _ in range(3):  # groups of near copies, many of them close to the threshold
        base = prose(rng, rng.randrange(60, 200), 5000)
        texts += [near(rng, base, rng.randrange(0, 6)) for _ in range(15)]
    chain = prose(rng, 120, 5000)
    for _ in range(8):  # only neighbours are alike
        chain = near(rng, chain, 2)
        texts.append(chain)
    passage = prose(rng, 50, 5000)
    texts += [f"{prose(rng, 30, 5000)} {passage} {prose(rng, 30, 5000)}" for _ in range(30)]
    texts += [prose(rng, n, 6) for n in (1, 2, 3, 4, 5, 6, 7, 8) for _ in range(6)]
    texts += ["a b c d e f g h i", "A B C D E F G H I", "a b c d e f g h i j", "", None, " "]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(ngram_join.clusters(docs, scratch)) == brute(rows)


def test_awkward_rows(spark, scratch, awkward):
    out = ngram_join.clusters(awkward, scratch).collect()
    assert len(out) == awkward.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[1] == by[2] or by[1][0][0] == by[2][0][0] == 0
    assert (by[1], by[2], by[3], by[4]) == ([(0, 1)], [(0, 2)], [(0, 3)], [(1, 4)])
    assert [c for _, c in by[5] + by[6]] == [5, 5, 5]
    assert [c for _, c in by[7] + by[8]] == [7, 7]
    assert {c for _, c in by[9]} == {9}
    assert by[None] == [(1, None)]
    assert ngram_join.clusters(awkward.limit(0), scratch).count() == 0


def test_components_of_chains_and_stars(spark, scratch):
    rng = random.Random(1)
    chain = list(range(40))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:], strict=False)) + [(1000, 1000 + i) for i in range(50)] + [(5000, 5000), (6001, 6000), (6000, 6001)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()}
    assert all(out[i] == 0 for i in chain)
    assert all(out[1000 + i] == 1000 for i in range(50))
    assert 5000 not in out and out[6001] == out[6000] == 6000


def test_a_null_id_beside_copies_hides_no_link(spark, scratch):
    rng = random.Random(11)
    words = prose(rng, 60, 5000).split()
    near = " ".join([*words[:-1], "other"])
    docs = spark.createDataFrame([(None, " ".join(words)), (4, " ".join(words)), (4, " ".join(words)), (9, near), (2, prose(rng, 60, 5000))],
                                 "doc_id long, text string")
    found = got(ngram_join.clusters(docs, scratch))
    assert found == {None: (56, None), 4: (56, 4), 9: (56, 4), 2: (56, 2)}


def test_bitmap_holds_every_listed_hash(spark):
    rng = random.Random(0)
    hashes = [rng.getrandbits(63) for _ in range(3000)] + [0, -1, -(2 ** 63), 2 ** 63 - 1]
    listed = spark.createDataFrame([(h,) for h in hashes], "h long")
    found = ngram_join.bitmap(listed, len(hashes))
    others = spark.createDataFrame([(-rng.getrandbits(63),) for _ in range(3000)], "h long")
    hit = ngram_join.maybe(spark, F.col("h"), *found)
    assert listed.where(hit).count() == len(hashes)
    assert others.where(hit).count() < 600  # about one in sixteen
    empty = ngram_join.bitmap(listed.limit(0), 0)
    assert listed.where(ngram_join.maybe(spark, F.col("h"), *empty)).count() == 0


def test_nearest_keeps_the_best_pair_of_each_set(spark):
    near = spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.2), (2, 3, 0.3), (3, 4, 0.2), (5, 6, 0.0)], "a long, b long, apart double")
    got = {tuple(r) for r in ngram_join._nearest(near).collect()}
    assert got == {(1, 2), (1, 3), (3, 4), (5, 6)}  # 3 is as near to 1 as to 4: the smaller one; 4 has only 3


def test_sets_with_many_pairs_are_verified_like_others(spark, scratch, monkeypatch):
    rng = random.Random(7)
    base = prose(rng, 80, 5000)
    rows = list(enumerate([base, base, *[near(rng, base, 1) for _ in range(12)], prose(rng, 80, 5000), near(rng, base, 40)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ngram_join, "BUSY", 1)  # some sets have one pair, others more
    assert got(ngram_join.clusters(docs, scratch)) == brute(rows)


def test_the_sets_of_a_pair_are_not_both_moved(spark, scratch):
    """One set of a pair moves to the bucket of the other: the table of sets itself is not shuffled."""
    members = scratch.write_bucketed(spark.createDataFrame([(i, bytes(8 * i)) for i in range(40)], "sid long, items binary").repartition("sid"), "members", "sid")
    pairs = scratch.write(spark.createDataFrame([(i, i + 1) for i in range(0, 39, 2)], "a long, b long"), "pairs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        both, _ = ngram_join._both_sets(pairs, members, scratch)
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 2  # of the pairs, then of the pairs with their first set
    assert {(r.a, r.b, len(r.x), len(r.y)) for r in both.collect()} == {(i, i + 1, 8 * i, 8 * i + 8) for i in range(0, 39, 2)}
    scratch.drop(members)


def test_stars_need_no_further_step(spark, scratch, monkeypatch):
    made = []
    monkeypatch.setattr(scratch, "write", lambda df, name, keep=scratch.write: (made.append(name), keep(df, name))[1])
    out = components(spark.createDataFrame([(5, 1), (6, 1), (8, 7)], "u long, v long"), scratch)
    assert {tuple(r) for r in out.collect()} == {(1, 1), (5, 1), (6, 1), (7, 7), (8, 7)}
    assert made == ["edges"]


def test_wide_rows_reach_python_in_small_batches(spark, scratch, monkeypatch):
    """An executor's memory: 400 texts of 100 kB came as one batch of 40 MB, and so did as many pairs of sets."""
    import pyarrow as pa

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(400).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word"), "id", F.lit(" ")), 12_000).alias("text"))

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"b": pa.array([batch.nbytes], pa.int64())})

    with scratch.small_batches():
        assert docs.mapInArrow(held, "b long").agg(F.max("b")).first()[0] < 10_000_000
    seen, keep = [], scratch.write
    monkeypatch.setattr(scratch, "write", lambda df, label: (seen.append(spark.conf.get(name)), keep(df, label))[1])
    ngram_join.links(docs.limit(3), scratch)
    assert len(seen) > 2 and set(seen) == {str(4 << 20)} and spark.conf.get(name) == before
