"""Brute-force and fixture tests of the quality rules, tiling, WARC, URL filter, PII, chat and classifier operators."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandflow.llm import chat_format, decontamination, pii, quality_classifier, quality_rules, url_filter, warc
from tests.llm.conftest import SF, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)} if len(windows) < 500 else None
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), None if covered is None else len(covered))


def test_quality_statistics_and_verdicts(spark, scratch, awkward):
    from demandflow.llm.queries import QUERIES
    texts = dict(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op7_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = statistics(texts[r["doc_id"]])
        assert tuple(r[1:5]) == want[:4] and want[4] in (None, r["n_repeat_words"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    quality = dict(tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    judged = [(r["kept"], quality[r["doc_id"]]) for r in rows if r["doc_id"] in quality and not r["base_failed"]]
    assert sum(k == (q == 1) for k, q in judged) >= 0.9 * len(judged)
    stats = scratch.write(quality_rules.with_statistics(awkward).select("row.doc_id", *quality_rules.STATISTICS, "base_failed"), "t")
    got = {r["doc_id"]: r for r in stats.collect()}
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0 and got[1]["base_failed"]
    assert got[7]["n_words"] == 4 and got[5]["n_words"] == 30_000
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.learn(stats, none, scratch) == []
    kept = quality_rules.keep(awkward, [])
    assert kept.columns == awkward.columns and {r["doc_id"] for r in kept.collect()} == {5, 6}
    assert quality_rules.keep(awkward.limit(0), []).count() == 0


def test_tiles_are_the_longest_first_and_order_free():
    rng = random.Random(2)

    def slow(p, t, k):
        free_p, free_t, out = [True] * len(p), [True] * len(t), 0
        while True:
            best = (0, 0, 0)
            for i, j in itertools.product(range(len(p)), range(len(t))):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and free_p[i + n] and free_t[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
            n, i, j = best[0], -best[1], -best[2]
            if n < k:
                return out
            out += n
            for x in range(n):
                free_p[i + x] = free_t[j + x] = False

    for _ in range(60):
        p, t = ([rng.randrange(3) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        got = decontamination.tiles(np.array(p, np.uint64), np.array(t, np.uint64), 3)
        assert sum(x[2] for x in got) == slow(p, t, 3)


def test_reordered_and_edited_items_leak_and_others_do_not(spark, scratch, awkward):
    rng = random.Random(4)
    items = [prose(rng, 40, 3000) for _ in range(6)]
    words = items[0].split()
    moved = " ".join([*words[20:], "between", *words[:20]])
    docs = [(1, f"{prose(rng, 200, 3000)} {items[1].upper()} {prose(rng, 200, 3000)}"), (2, moved), (3, prose(rng, 500, 3000)),
            (4, " ".join(items[2].split()[:15])), (5, " ".join(items[3].split()[:20])), (6, None), (7, ""), (1, items[1])]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(6, None), (7, "too short"), (None, items[4])], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for size in (8_000_000, 300):
        got = sorted((r["doc_id"], r["item_id"]) for r in decontamination.leaks(df, bench, scratch, block_bytes=size).collect())
        assert got == [(1, 1), (1, 1), (2, 0), (5, 3)]
        assert sorted(r["doc_id"] for r in decontamination.clean(df, bench, scratch, block_bytes=size).collect()) == [3, 4, 6, 7]
    assert decontamination.leaks(awkward, bench.limit(0), scratch).count() == 0
    assert decontamination.clean(awkward, bench, scratch).columns == awkward.columns


def test_items_that_share_seeds_or_repeat_leak_from_the_right_documents(spark, scratch, monkeypatch):
    rng = random.Random(6)
    common = prose(rng, 9, 3000)
    items = [f"{common} {prose(rng, 12, 3000)}" for _ in range(5)]
    items += [items[1], items[1].upper(), f"{common} {common}", "same " * 20, common, "two words", "TWO  words"]
    docs = ["", common, f"{prose(rng, 50, 3000)} {items[1]} {items[3]}", prose(rng, 60, 3000), f"{items[0]} {items[2]} tail", "same " * 40, None, f"x {items[4]}",
            f"{items[7]} two words", " ".join(items[1].split()[:13])]

    def codes(text):
        return np.array([zlib.crc32(w.lower().encode()) for w in (text or "").split()], np.uint64)

    def covered(item, doc):
        n = min(5, len(item))  # an item shorter than a tile is one tile
        return sum(x[2] for x in decontamination.tiles(item, doc, n))

    want = sorted((d, i, c, len(p)) for d, t in enumerate(docs) for i, p in enumerate(map(codes, items))
                  if 100 * (c := covered(p, codes(t))) >= (50 if len(p) >= 5 else 100) * len(p))
    assert len(want) == 25
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    assert sorted(tuple(r) for r in decontamination.leaks(df, bench, scratch).collect()) == want
    assert sorted(r["doc_id"] for r in decontamination.clean(df, bench, scratch).collect()) == sorted({*range(len(docs))} - {w[0] for w in want})
    # as many documents at once as have so many seeds
    monkeypatch.setattr(decontamination, "HITS", 7)
    block = decontamination._Block([*range(len(items))], items, 5)
    assert sorted(block.leaks(pa.array(docs), 50)) == want


def test_warc_rejects_records_inside_payloads(spark, scratch, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 99\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "x" * 1500
    rows = [(1, "http://a", f"before\r\n\r\n{fake}after"), (2, "http://b", big), (3, "http://c", big), (4, None, None), (5, "u\r\nv", "tail\r\n"),
            (6, "http://d", fake), (None, "http://e", big), (7, "é", "é\u2028"), (7, "é", "é\u2028"), (8, "s", "small"), (9, "s", "small")]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path, records=4)
    found = scratch.write(warc.candidates(spark, path), "w")
    assert found.where("page_id = 99").count() == 2
    got = warc.reachable(found, scratch).collect()
    assert len(got) == len(rows) and all(r["page_id"] != 99 for r in got)
    by = {r["page_id"]: r for r in got}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in by.items() if k in (2, 3, None)} == {
        2: ("revisit", 3), 3: ("response", None), None: ("revisit", 3)}
    for i, _, html in rows:
        assert bytes(by[i]["payload"]).decode() == ("" if i in (2, None) else html or "")


def test_warc_header_of_any_length_and_broken_chain(spark, scratch, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i}") for i in range(9)]
    rows[4] = (4, "http://h/?q=" + "x" * 100_000, "page 4")
    path = str(tmp_path / "long")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    got = warc.reachable(scratch.write(warc.candidates(spark, path), "long"), scratch).collect()
    assert sorted((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in got) == rows
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for k, tail in enumerate((b"", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", b"x")):
        (tmp_path / f"b{k}").mkdir()
        (tmp_path / f"b{k}" / "a.warc").write_bytes(whole * 3 + tail)
        found = scratch.write(warc.candidates(spark, str(tmp_path / f"b{k}")), "b")
        if tail:
            with pytest.raises(RuntimeError, match="does not end"):
                warc.reachable(found, scratch)
        else:
            assert warc.reachable(found, scratch).count() == 3
    # many magics before one header end take linear time and see the first of each field below them
    many = b"WARC/1.1\r\nX-Page-ID: 1\r\n" * 100_000 + b"WARC/1.0\r\nX-Page-ID: 2\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert [sum(r[3] == i for r in warc.records_at_magic(many)) for i in (1, 2)] == [100_000, 1]


def test_cascade_is_exact(spark, scratch):
    rng = np.random.default_rng(1)
    for n, m in ((0, 10), (10, 0), (500, 3000), (3000, 500), (1, 1)):
        keys = rng.integers(0, 2 ** 63, n + m).astype(np.uint64)
        levels = url_filter.build(keys[:n], keys[n:])
        assert url_filter.listed_of(levels, keys).tolist() == [True] * n + [False] * m
    rows = [(1, "HTTP://A.ÉX.org/a?b"), (2, None), (3, "nothing"), (4, "x://h#f/"), (5, "x://h?q://z/"), (6, "x://"), (6, "x://")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([("h",)], "key string"),
                           [("allow", "org", "/"), ("block", "org", "/a")], scratch, shard_keys=2, block_bytes=8).collect()
    assert sorted((r["row"]["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got)[0] == (1, "a.Éx.org", "/a", "org/a", "block")
    assert {r["row"]["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow"}


def test_surrogates_keep_type_format_identity_and_distinctness(spark, scratch, awkward):
    rows = [(1, "Mr. John Smith met Mrs Anna Smith; Mr Smith: John.Smith7@corp.example.com, JOHN.SMITH7@CORP.EXAMPLE.COM or a@b.co."),
            (2, "+1 (743) 555-3824 or (743) 555-3824, 743-555-3824; 10.0.0.1, 999.1.1.1, 4111 1111 1111 1111 / 4111111111111111, 078-05-1120"),
            (3, 'token = "2321bac4d15ec8f90433955bf9d3cf61da5bdd1e"'), (3, "clean text of version 3.1"), (4, None), (5, "")]
    got = {(r["doc_id"], i): r for i, r in enumerate(pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), scratch, "k").orderBy("doc_id", F.desc("n_entities")).collect())}
    text = [r["text"] for r in got.values()]
    assert text[3] == "clean text of version 3.1" and text[4] is None and text[5] == ""
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+); Mr (\w+): (\S+@\S+), (\S+@\S+) or (\S+@\S+)\.", text[0])
    assert m[2] == m[4] == m[5] and m[1] != m[3] and m[6] == m[7].lower() and "smith" not in text[0].lower()
    m = re.fullmatch(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or \(\1\) \2-\3, \1-\2-\3; [\d.]+, 999\.1\.1\.1, (\d{4}) (\d{4}) (\d{4}) (\d{4}) / \4\5\6\7, \d{3}-\d\d-\d{4}", text[1])
    digits = [int(c) for c in "".join(m.groups()[3:])]
    assert digits[0] == 4 and sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', text[2]) and text[2] != rows[2][1]
    emails = spark.createDataFrame([("email", f"{c}@x.org") for c in "abcdefghijklmnopqrstuvwxyz0123456789"], "type string, canon string")
    named = pii.surrogates(emails, scratch, "k").collect()
    assert len({r["surrogate"] for r in named}) == 36 and not {r["surrogate"] for r in named} & {r["canon"] for r in named}
    out = pii.replace(awkward, scratch, "k")
    assert out.count() == awkward.count() and out.columns == [*awkward.columns, "n_entities"]


def test_mentions_start_anywhere_in_a_run_and_in_any_script(spark, scratch):
    hidden = {"-john.doe@corp.com": "john.doe", "...john@corp.com": "john", "josé.garcia@corp.com": "garcia", "josé@corp.com": "jos", "a@münchen.de": "chen",
              "_" * 70 + "john@corp.com": "john", "иван@почта.рф": "иван", "a@b.com-maria@corp.com": "maria", "..10.1.2.3": "10.1.2.3",
              "Mr John McDonald": "McDonald", "Mr O'Brien": "Brien", "Mrs Anne-Marie": "Marie", "Mr O’Brien's": "Brien", "Mr SMITH": "SMITH"}
    long = ["x" * 300_000, ".-" * 150_000, "a.b-" * 80_000, "é" * 300_000, "1.2." * 80_000, "A-" * 100_000]
    rows = [(k, f"{x} {t} {x}") for k, (t, x) in enumerate((t, x) for t in hidden for x in ("so", *long[:2]))]
    rows += [(1000 + k, x) for k, x in enumerate(long)] + [(2000, "john.doe@corp.com"), (2001, "Mr O'Brien"), (2002, "Mr " + "A-" * 100_000 + "Ab")]
    got = {r["doc_id"]: r for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), scratch, "k").collect()}
    for k, (t, x) in enumerate((t, x) for t in hidden for x in ("so", *long[:2])):
        assert got[k]["n_entities"] >= 1 and hidden[t] not in got[k]["text"], t
        assert got[k]["text"].startswith(x + " ") and got[k]["text"].endswith(" " + x)
    assert all(got[1000 + k]["n_entities"] == 0 and got[1000 + k]["text"] == x for k, x in enumerate(long))
    places = {t: 3 * k for k, t in enumerate(hidden)}
    assert got[places["-john.doe@corp.com"]]["text"] == f"so -{got[2000]['text']} so"
    assert got[places["Mr O'Brien"]]["text"] == f"so {got[2001]['text']} so" and got[places["Mr O’Brien's"]]["text"] == f"so {got[2001]['text']}'s so"
    assert got[2002]["n_entities"] == 1


def test_surrogates_of_many_hosts_with_short_names(spark, scratch):
    emails = spark.range(30_000).selectExpr("'email' AS type", "concat(chr(97 + id % 26), '@', 'h', id, '.com') AS canon")
    named = scratch.write(pii.surrogates(emails, scratch, "k"), "named")
    assert named.count() == named.select("surrogate").distinct().count() == 30_000
    assert not named.join(emails.select(F.col("canon").alias("surrogate")), "surrogate").count()
    assert named.where("NOT surrogate RLIKE '^[a-z][0-9]{0,8}@example[.](com|net|org)$'").count() == 0


def test_repairs_are_legal_and_cheapest(spark, scratch):
    c = chat_format.Costs()
    rng = random.Random(7)

    def cheapest(roles):
        best = {0: 0}
        for r in roles:
            new = {}
            for s, cost in best.items():
                for step in chat_format.steps(r, s, c):
                    new[step[3]] = min(new.get(step[3], 1 << 30), cost + step[0])
            best = new
        return min(cost + chat_format.end_steps(s, c)[0] for s, cost in best.items())

    names = ["user", "assistant", "system", "tool", None, "USER "]
    talks = {k: [rng.choice(names) for _ in range(rng.randrange(1, 30))] for k in range(25)}
    rows = [(k, t, r, f"{k}.{t}<|im_end|>") for k, talk in talks.items() for t, r in enumerate(talk)] + [(None, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for size, fan in ((256, 256), (4, 2)):
        got = {r["conv_id"]: r for r in chat_format.rendered(chat_format.repair(df, scratch, chunk_turns=size, fan_out=fan)).collect()}
        assert len(got) == len(talks) + 1
        for k, talk in talks.items():
            assert got[k]["cost"] == cheapest([chat_format.code(r) for r in talk])
            turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", got[k]["text"], re.S)
            state = 0
            for role, _ in turns:
                assert chat_format.ROLES.index(role) in chat_format.LEGAL[state]
                state = chat_format.ROLES.index(role)
            assert state in c.accept and all(f"{k}.{t}" in got[k]["text"] for t in range(len(talk)))
    assert chat_format.repair(df.limit(0), scratch).count() == 0


def test_ordinal_model_separates_grades(spark, awkward):
    rng = random.Random(9)
    bad = ["zzqa", "zzqb"]
    texts = [(prose(rng, 60, 300) + "".join(f" {rng.choice(bad)}" for _ in range(2 - g)), g) for g in (0, 1, 2) for _ in range(150)]
    slots, at = quality_classifier.features(pa.array([t for t, _ in texts]))
    model = quality_classifier.fit([slots[a:b] for a, b in itertools.pairwise(at)], np.array([g for _, g in texts]))
    assert (np.diff(model.thresholds) > 0).all()
    expected = model.above(model.score(slots, at)).sum(axis=1)
    means = [expected[[g == k for _, g in texts]].mean() for k in (0, 1, 2)]
    assert means[0] + 0.2 < means[1] and means[1] + 0.2 < means[2]
    assert quality_classifier.scored(awkward, model).count() == awkward.count()
    empty = quality_classifier.train(awkward, spark.createDataFrame([], "doc_id long, grade long"))
    assert quality_classifier.scored(awkward, empty).where("tail_probability < 1").count() == 0


def test_warc_pages_that_share_an_id_and_large_pages(spark, tmp_path):
    from demandflow.llm.queries import QUERIES
    a, b = "a" * 1500, "b" * 2500
    rows = [(3, "u", a), (3, "u", b), (2, "u", b), (1, "u", a), (None, "u", "c" * 9_000_000), (7, "u", "d" * 20_000_000), (7, "u", "small")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(QUERIES["op6_warc"](spark, str(tmp_path)).collect(), key=lambda r: (r["page_id"] or 0, r["payload_bytes"]))
    import hashlib
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert [tuple(r) for r in got] == [
        (None, 9_000_000, sha("c" * 9_000_000), "response", None), (1, 1500, sha(a), "revisit", 3), (2, 2500, sha(b), "revisit", 3),
        (3, 1500, sha(a), "response", None), (3, 2500, sha(b), "response", None), (7, 5, sha("small"), "response", None),
        (7, 20_000_000, sha("d" * 20_000_000), "response", None)]


def test_warc_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(k, "u", "x" * (10 if k % 5 else 40_000)) for k in range(200)]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path, least=10**9, records=50, file_bytes=100_000)
    sizes = [len(warc.plain(p.read_bytes())) for p in (tmp_path / "w").rglob("*.gz")]
    assert len(sizes) > 8 and max(sizes) <= 2 * 100_000


def test_url_filter_with_clashing_names_and_shared_hashes(spark, scratch, monkeypatch):
    rows = [(k, f"http://h{k}.net/", "a", "b", 5, 6, "c") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, listed string, _h int, _shard int, verdict string")
    listed = spark.createDataFrame([(f"h{k}.net",) for k in range(0, 40, 3)], "key string")
    want = {k: "block" if k % 3 == 0 else "allow" for k in range(40)}
    for coarse in (False, True):
        if coarse:  # seven hashes for forty hosts: listed and unlisted ones share them
            monkeypatch.setattr(url_filter, "_hash", lambda key: F.pmod(F.xxhash64(key), F.lit(7)))
        got = url_filter.judge(pages, listed, [], scratch, shard_keys=10).collect()
        assert {r["row"]["page_id"]: r["verdict"] for r in got} == want and len(got) == 40
        assert got[0]["row"]["host"] == "a" and got[0]["row"]["listed"] == "b" and got[0]["row"]["_shard"] == 6
    with pytest.raises(ValueError):
        url_filter.build(np.array([1, 2], np.uint64), np.array([2], np.uint64))


def test_tiling_of_repeated_words_is_linear_and_short_items_match_whole(spark, scratch):
    import time
    begun = time.time()
    got = decontamination.tiles(np.array([7] * 30, np.uint64), np.array([7] * 1_000_000, np.uint64), 5)
    assert got == [(0, 0, 30)] and time.time() - begun < 10
    bench = spark.createDataFrame([(1, "Alpha beta"), (2, "gamma"), (3, "one two three four"), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha BETA y"), (2, "alpha"), (3, "beta alpha"), (4, "gamma"), (5, "one two three"), (6, "one two three four"), (7, "alpha"), (8, "beta")],
                                 "doc_id long, text string").coalesce(1)
    found = sorted(tuple(r) for r in decontamination.leaks(docs, bench, scratch).collect())
    assert found == [(1, 1, 2, 2), (4, 2, 1, 1), (6, 3, 4, 4)]
    assert sorted(r["doc_id"] for r in decontamination.clean(docs, bench, scratch, block_bytes=8).collect()) == [2, 3, 5, 7, 8]


def test_surrogates_of_long_secrets_deep_hosts_scripts_and_neutral_titles(spark, scratch):
    deep = "joe@" + ".".join(f"l{k}" for k in range(30)) + ".com"
    secret, token = "0123456789abcdef" * 20, "ghp_" + "aB3" * 100
    rows = [(1, f"a {deep} b"), (2, f"k={secret} and {token}."), (3, "Dr. Anna Schmidt, Prof Braun, Mr Γιώργος Παπαδόπουλος"), (4, "иван@почта.рф νίκος@παράδειγμα.gr"),
            (5, "Dr. Anna Weber and Mrs Γιώργος")]
    got = {r["doc_id"]: r for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), scratch, "k").collect()}
    assert [got[k]["n_entities"] for k in range(1, 6)] == [1, 2, 3, 2, 2]
    assert "joe@" not in got[1]["text"] and got[1]["text"].startswith("a ") and got[1]["text"].endswith(" b")
    new = re.fullmatch(r"k=([0-9a-f]{320}) and (ghp_[A-Za-z0-9]{300})\.", got[2]["text"])
    assert new and new[1] != secret and new[2] != token
    m = re.fullmatch(r"Dr\. ([A-Z][a-z]+) ([A-Z][a-z]+), Prof ([A-Z][a-z]+), Mr ([Α-Ω][α-ω]+) ([Α-Ω][α-ω]+)", got[3]["text"])
    assert m and "Anna" not in got[3]["text"] and "Παπαδ" not in got[3]["text"]
    assert re.fullmatch(r"[а-я]+[0-9]*@example\.(com|net|org) [α-ω]+[0-9]*@example\.(com|net|org)", got[4]["text"])
    assert got[5]["text"].split()[1] == m[1]  # the same given name under the same title
