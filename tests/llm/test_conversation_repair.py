"""Conversation repair against enumeration, a plain dynamic program and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from demandflow.llm import conversation_repair as cr
from demandflow.llm.queries import QUERIES
from tests.llm.conftest import SF

LEGAL = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    """[(role, text)] -> fault of each."""
    out, seen = [], set()
    for role, text in rows:
        t = text.rstrip(SPACE)
        out.append(1 if not t else 2 if (role, text) in seen else 3 if t[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def enumerated(rows, kinds):
    """(cost, audit, repaired) by trying every edit of every row with up to two inserts in each gap."""
    gaps = ["", "u", "a", "ua", "au"]
    best = None
    for edits in itertools.product(*[["D"] if k in (1, 2) else ["D", "K", "Ru", "Ra"] for k in kinds]):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            initials, audit, cost, lines = "", "", 0, []
            for i in range(len(rows) + 1):
                initials, audit, cost = initials + ins[i], audit + "I" * len(ins[i]), cost + 2 * len(ins[i])
                lines += ["user:" if c == "u" else "assistant:" for c in ins[i]]
                if i < len(rows):
                    e, (role, text) = edits[i], rows[i]
                    audit += e[0]
                    cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and kinds[i] == 3)
                    if e != "D":
                        own = role if e == "K" else {"u": "user", "a": "assistant"}[e[1]]
                        initials += own[:1] or "-"
                        lines.append(f"{own}:{text}")
            if LEGAL.fullmatch(initials):
                best = min(best, (cost, audit, lines)) if best else (cost, audit, lines)
    return best[0], best[1], "\n".join(best[2])


def plain(rows, kinds):
    """The same by a dynamic program over (row, state) that carries whole answers."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    after = {s: (0, "", []) if s in ("", "a") else (10**9, "", []) for s in ("", "s", "u", "a")}

    def close(table):
        for _ in range(4):
            for s in table:
                for c, role in (("u", "user:"), ("a", "assistant:")):
                    if (s, c) in step:
                        cost, audit, lines = table[step[s, c]]
                        table[s] = min(table[s], (cost + 2, "I" + audit, [role, *lines]))
        return table

    after = close(after)
    for (role, text), kind in zip(reversed(rows), reversed(kinds), strict=True):
        now = {}
        for s in after:
            c0, a0, l0 = after[s]
            options = [(c0 + 3, "D" + a0, l0)]
            if kind not in (1, 2):
                for letter, own, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if (s, own[:1]) in step:
                        c, a, l = after[step[s, own[:1]]]
                        options.append((c + price + (kind == 3), letter + a, [f"{own}:{text}", *l]))
            now[s] = min(options)
        after = close(now)
    cost, audit, lines = after[""]
    return cost, audit, "\n".join(lines)


def whole(rows, kinds):
    """The operator's way through one conversation."""
    symbols = [cr.symbol(r, k) for (r, _), k in zip(rows, kinds, strict=True)]
    parts = cr.runs(symbols, [1] * len(rows))
    audit, _, cost = cr.unroll(parts, 0, cr.FINAL, True)
    turns = cr.applied(audit, 0, [r for r, _ in rows], [t for _, t in rows], [1] * len(rows))
    return cost, audit, "\n".join(f"{r}:{t}" for _, r, t in turns)


ROLES = ["user", "assistant", "system", "tool", "", "User", "unknown"]
TEXTS = ["Yes.", "No!", "cut", " ", "", "Why? \n", "end.\x0b", "x "]


def test_repairs_match_enumeration():
    rng = random.Random(1)
    for n in (0, 1, 2, 3):
        for _ in range(1 if n == 0 else 25):
            rows = [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]
            kinds = faults(rows)
            want = enumerated(rows, kinds)
            assert plain(rows, kinds) == want
            assert whole(rows, kinds) == want


def test_repairs_match_the_plain_program():
    rng = random.Random(2)
    for _ in range(1500):
        n = rng.randrange(1, 40)
        few = rng.sample(ROLES, rng.randrange(1, 5))
        rows = [(rng.choice(few), f"{k if rng.random() < 0.8 else 0}{rng.choice(TEXTS)}") for k in range(n)]
        kinds = faults(rows)
        assert whole(rows, kinds) == plain(rows, kinds), rows


def test_long_runs_by_powers():
    for role, n in (("user", 700), ("assistant", 701), ("tool", 500), ("system", 333)):
        rows = [(role, f"{k}.") for k in range(n)]
        kinds = faults(rows)
        assert whole(rows, kinds)[:2] == plain(rows, kinds)[:2]
    sym = cr.symbol("user", 0)
    assert cr.cross(sym, 10**15, cr.FINAL)[0] == 10**15  # every second one becomes an assistant's
    a = cr.matrix_of([(sym, 5), (cr.MUST_DELETE, 7)])
    assert cr._apply(a, cr.FINAL) == cr.before([(sym, 5), (cr.MUST_DELETE, 7)], cr.FINAL)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def digest(rows):
    """rows: (turn, role, text) after damage."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    rows = ordered(rows)
    pairs = [(r, t) for _, r, t in rows]
    kinds = faults(pairs)
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
    cost, audit, text = plain(pairs, kinds)
    return (gaps, kinds.count(1), kinds.count(2), kinds.count(3), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        here += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {conv: digest(r) for conv, r in out.items()}


def as_rows(frame):
    return {r[0]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in frame.collect()}


def test_query_matches_the_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    frame = QUERIES["op13_conversation_repair"](spark, SF)
    assert as_rows(frame) == damage(rows)


@pytest.mark.parametrize("max_rows", [1, 3, 1024])
def test_conversations_over_many_blocks_and_partitions(spark, scratch, max_rows):
    rng = random.Random(3)
    rows = []
    for k in range(300):  # one conversation holds most rows
        rows.append((7, rng.randrange(200), rng.choice(ROLES[:4]), f"{rng.randrange(60)}{rng.choice(TEXTS)}"))
    rows += [(7, None, "user", "Hi."), (7, None, "user", "Hi."), (7, 5, None, None)] + [(7, 50, "user", "hot.")] * 40
    for conv in (None, 1, 2, 3, 8, 9):
        rows += [(conv, t, rng.choice(ROLES), rng.choice(TEXTS)) for t in [None, *range(rng.randrange(5))] for _ in range(rng.randrange(3))]
    rows += [(10, -2**62, "user", "a."), (10, 2**62, "assistant", "b."), (11, -2**63, "user", "a."), (11, 2**63 - 1, "assistant", "b.")]
    frame = spark.createDataFrame([(*r, "x", 1, "p") for r in rows],
                                  "conv_id long, turn long, role string, text string, conv string, part int, audit string").repartition(5)
    done = cr.repair(frame, scratch, max_rows=max_rows)
    got = as_rows(cr.digests(done))
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = {c: digest(r) for c, r in want.items()}
    want[11] = (None, *want[11][1:])
    assert got == want
    # the turns themselves, in order
    turns = sorted(done.turns().where("conv = 7").collect(), key=lambda r: (r["part"], r["idx"], r["place"]))
    text = "\n".join(f"{r['role']}:{r['text']}" for r in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == want[7][-1]
    assert LEGAL.fullmatch("".join(r["role"][:1] for r in turns))
    assert cr.digests(cr.repair(frame.limit(0), scratch)).count() == 0


def test_long_texts_and_a_hot_row(spark, scratch):
    rows = [(1, 0, "user", "a" * 6_000_000 + "."), (1, 1, "assistant", "b" * 5_000_000), (1, 2, "user", "c."), (1, 3, "assistant", "d.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    hot = spark.range(200_000).selectExpr("2L as conv_id", "4L as turn", "'user' as role", "'Again.' as text")
    got = as_rows(cr.digests(cr.repair(frame.unionByName(hot), scratch)))
    assert got[1] == digest([r[1:] for r in rows])
    assert got[2][:6] == (0, 0, 199_999, 0, 199_999, 3 * 199_999 + 2) and got[2][6] == "K" + "D" * 199_999 + "I"
