"""Conversation structure repair: cheapest edits by a run-length dynamic program.

Turns of a conversation are put in order (turn number, nulls first; ties by role, then by the
SHA-256 of the text), and each gets a symbol: the role's initial and its first fault (blank;
duplicate: role and text seen earlier; truncated: does not end in ``.``, ``!`` or ``?``).  Edits
are Keep (0), Rerole to user or assistant (2), Delete (3; the only choice for blank and duplicate
turns) and Insert an empty user or assistant turn anywhere (2); a truncated turn that stays adds 1.
The result's initials must read ``(s?(ua)+)?``.  Of the cheapest audits (the edits' initials in
order) the ASCII-least is taken.

A symbol is a (min, +) matrix over the four automaton states.  Equal consecutive symbols form a
run, which a vector of costs-to-go crosses by the symbol's cached binary powers; with the costs
known at every run's end the choices are unrolled forward.

A conversation may hold any share of the rows.  Equal rows collapse to a count before anything is
shuffled, rows are ordered by a range partitioning, which cuts a hot conversation over many tasks,
and a task's rows become blocks of bounded size.  A conversation inside one block is finished
there.  For the others, blocks are reduced to matrices, then to a map from the state at the start
to the state at the end; only the segments at the partitions' edges (two a partition at most) are
chained on the driver, without their texts.

Defined results: null role or text counts as one space.  A null conversation id is a conversation
of its own.  Repeated rows are duplicates of the first, rows of equal turn number are ordered as
above, an empty table gives an empty result, and columns beyond the four named ones are dropped.
Turn numbers whose span exceeds 64 bits give a null number of gaps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.llm.common import Scratch

# ------------------------------------------------------------------ the automaton

#: States: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ENDS = (0, 3)
_FAR = 1 << 60  # no way there
_INITIALS = "sua"
_ROLE = {"u": "user", "a": "assistant"}
#: Symbol numbers: 0 must be deleted; else 1 + 2 * (place of the initial, 3: other) + truncated.
MUST_DELETE = 0

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def symbol(role: str, fault: int) -> int:
    """``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated."""
    if fault in (1, 2):
        return MUST_DELETE
    place = _INITIALS.find(role[0]) if role else -1
    return 1 + 2 * (place if place >= 0 else 3) + (fault == 3)


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(_FAR, *(x + b[k][j] for k, x in enumerate(row))) for j in range(4)) for row in a)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(_FAR, *(x + y for x, y in zip(row, v, strict=True))) for row in a)


_IDENTITY: Matrix = tuple(tuple(0 if i == j else _FAR for j in range(4)) for i in range(4))


def _inserts() -> Matrix:
    """Costs of moving between states by inserted turns alone."""
    one = tuple(tuple(min([0] if i == j else [2 for c in "ua" if _STEP.get((i, c)) == j] or [_FAR]) for j in range(4)) for i in range(4))
    return _times(_times(one, one), _times(one, one))


INSERTS = _inserts()
#: Costs-to-go behind the last turn.
FINAL: Vector = _apply(INSERTS, tuple(0 if s in _ENDS else _FAR for s in range(4)))


def _row(sym: int) -> Matrix:
    """Costs of one turn of this symbol, without inserted ones."""
    cost = [[3 if i == j else _FAR for j in range(4)] for i in range(4)]
    if sym != MUST_DELETE:
        place, extra = divmod(sym - 1, 2)
        for i in range(4):
            for c, price in [*([(_INITIALS[place], 0)] if place < 3 else []), ("u", 2), ("a", 2)]:
                j = _STEP.get((i, c))
                if j is not None:
                    cost[i][j] = min(cost[i][j], price + extra)
    return tuple(map(tuple, cost))


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> Matrix:
    """Transition of ``2^k`` turns of one symbol, inserted turns before each included."""
    if k == 0:
        return _times(INSERTS, _row(sym))
    half = power(sym, k - 1)
    return _times(half, half)


@lru_cache(maxsize=200_000)
def _crossed(sym: int, n: int, v: Vector) -> Vector:
    k = 0
    while n:
        if n & 1:
            v = _apply(power(sym, k), v)
        n, k = n >> 1, k + 1
    return v


def cross(sym: int, n: int, v: Vector) -> Vector:
    """Costs-to-go before a run of ``n`` turns from those behind it.  Vectors are looked up by
    their differences, of which there are few."""
    low = min(v)
    return tuple(min(x + low, _FAR) for x in _crossed(sym, n, tuple(_FAR if x == _FAR else x - low for x in v)))


def runs(symbols: list[int], copies: list[int]) -> list[tuple[int, int]]:
    """(symbol, length) of a list of turns; copies of a turn beyond the first must be deleted."""
    out: list[list[int]] = []
    for sym, n in zip(symbols, copies, strict=True):
        for s, k in ((sym, 1), (MUST_DELETE, n - 1)):
            if k:
                if out and out[-1][0] == s:
                    out[-1][1] += k
                else:
                    out.append([s, k])
    return [(s, k) for s, k in out]


def before(parts: list[tuple[int, int]], v: Vector) -> Vector:
    for sym, n in reversed(parts):
        v = cross(sym, n, v)
    return v


def matrix_of(parts: list[tuple[int, int]]) -> Matrix:
    columns = []
    for j in range(4):
        v = tuple(_IDENTITY[i][j] for i in range(4))
        columns.append(before(parts, v))
    return tuple(zip(*columns, strict=True))


def unroll(parts: list[tuple[int, int]], state: int, end: Vector, last: bool) -> tuple[str, int, int]:
    """(audit, state behind, cost) of the cheapest, then ASCII-least way through the runs, given
    the costs-to-go behind them.  ``last``: nothing follows, so inserted turns may end it."""
    ends = [end]
    for sym, n in reversed(parts):
        ends.append(cross(sym, n, ends[-1]))
    audit: list[str] = []
    total = ends[-1][state]
    for (sym, n), behind in zip(parts, reversed(ends[:-1]), strict=True):
        if sym == MUST_DELETE:  # deleting leaves the state, and D precedes every other edit
            audit.append("D" * n)
            continue
        extra = (sym - 1) % 2
        keep = _INITIALS[(sym - 1) // 2] if (sym - 1) // 2 < 3 else ""
        for left in range(n, 0, -1):
            here, after = cross(sym, left, behind), cross(sym, left - 1, behind)
            while True:
                if 3 + after[state] == here[state]:
                    audit.append("D")
                    break
                inserted = _STEP.get((state, "a" if state == 2 else "u"))
                if 2 + here[inserted] == here[state]:
                    audit.append("I")
                    state = inserted
                    continue
                kept = _STEP.get((state, keep))
                if kept is not None and extra + after[kept] == here[state]:
                    audit.append("K")
                    state = kept
                else:
                    audit.append("R")
                    state = inserted
                break
    if last:
        while FINAL[state]:
            audit.append("I")
            state = _STEP[state, "a" if state == 2 else "u"]
        return "".join(audit), state, total
    return "".join(audit), state, total - end[state]


def applied(audit: str, state: int, roles: list[str], texts: list[str], copies: list[int]) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves."""
    out, at, left = [], 0, copies[0] if copies else 0
    for edit in audit:
        if edit == "I":
            c = "a" if state == 2 else "u"
            out.append((edit, _ROLE[c], ""))
            state = _STEP[state, c]
            continue
        if edit == "K":
            out.append((edit, roles[at], texts[at]))
            state = _STEP[state, roles[at][0]]
        elif edit == "R":
            c = "a" if state == 2 else "u"
            out.append((edit, _ROLE[c], texts[at]))
            state = _STEP[state, c]
        left -= 1
        if not left:
            at += 1
            left = copies[at] if at < len(copies) else 0
    return out


# ------------------------------------------------------------------ ordering and blocks

_BLOCK = T.StructType([T.StructField("part", T.LongType()), T.StructField("idx", T.LongType()), T.StructField("whole", T.BooleanType()),
                       *[T.StructField(c, T.LongType()) for c in (
                           "blank", "duplicate", "truncated", "illegal", "turns", "least", "most", "first_turn", "last_turn")],
                       T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()),
                       T.StructField("symbols", T.ArrayType(T.IntegerType())), T.StructField("copies", T.ArrayType(T.LongType())),
                       T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))])
_SPACES = r"' \t\n\u000b\u000c\r'"


def marked(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct rows ``conv, turn, role, text, copies, sha, fault``: ``fault`` is that of the
    first copy, further copies are duplicates."""
    one = turns.select("conv", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    # a hot row collapses before the shuffle
    one = one.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    trimmed = F.expr(f"rtrim({_SPACES}, text)")
    one = one.select("*", F.sha2("text", 256).alias("sha"), F.when(trimmed == "", 1).when(
        F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0).otherwise(3).alias("own"))
    one = scratch.write(one, "turns")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = one.where("own <> 1").groupBy(F.col("conv").alias("c2"), F.col("role").alias("r2"), F.col("sha").alias("s2")).agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    both = one.join(again, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("role") == F.col("r2")) & (F.col("sha") == F.col("s2")), "left")
    seen = (F.col("own") != 1) & F.col("first").isNotNull() & (order > F.col("first"))
    return both.select("conv", "turn", "role", "text", "copies", "sha", F.when(seen, 2).otherwise(F.col("own")).alias("fault"))


_LEGAL = {"su", "ua", "au"}


def _rows(batch: pa.RecordBatch, max_bytes: int = 8_000_000) -> Iterator[dict]:
    """Rows of a batch, a few megabytes of them as Python objects at a time."""
    step = max(1, batch.num_rows * max_bytes // max(batch.nbytes, 1))
    for i in range(0, batch.num_rows, step):
        yield from batch.slice(i, step).to_pylist()


def _batches(rows: Iterator[tuple[int, tuple]], schema: T.StructType, max_rows: int = 512, max_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """(size, row) pairs as record batches of bounded size."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), arrow.types, strict=True)], schema=arrow)

    for n, row in rows:
        held.append(row)
        size += n
        if len(held) >= max_rows or size >= max_bytes:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


class _Blocks:
    """Cuts an ordered stream of rows into blocks that hold rows of one conversation."""

    def __init__(self, part: int, max_rows: int, max_bytes: int):
        self.part, self.max_rows, self.max_bytes = part, max_rows, max_bytes
        self.idx, self.seen_other, self.ready = 0, False, []
        self.conv, self.begun = None, False
        self.last_turn, self.last_initial = None, None
        self._fresh(True)

    def _fresh(self, starts: bool) -> None:
        self.starts, self.bytes = starts, 0
        self.rows: list[tuple] = []
        self.sums = [0, 0, 0, 0, 0]
        self.known: list[int] = []

    def flush(self, ended: bool) -> None:
        if self.rows:
            turns, roles, texts, copies, symbols = (list(c) for c in zip(*self.rows, strict=True))
            whole = ended and self.starts and self.seen_other
            least, most = (self.known[0], self.known[-1]) if self.known else (None, None)
            self.ready.append((self.bytes, (self.conv, self.part, self.idx, whole, *self.sums, least, most, turns[0], turns[-1],
                                            roles[0][:1], roles[-1][:1], symbols, copies, roles, texts)))
            self.idx += 1
        self._fresh(ended)

    def add(self, conv, turn, role: str, text: str, copies: int, fault: int) -> None:
        if not self.begun or conv != self.conv:
            if self.begun:
                self.flush(True)
                self.seen_other = True
            self.conv, self.begun, self.last_turn, self.last_initial = conv, True, None, None
        elif len(self.rows) >= self.max_rows or self.bytes >= self.max_bytes:
            self.flush(False)
        initial = role[:1]
        blank, duplicate, truncated = (copies, 0, 0) if fault == 1 else (0, copies, 0) if fault == 2 else (0, copies - 1, int(fault == 3))
        illegal = (copies - 1) * (initial + initial not in _LEGAL)
        if self.last_initial is not None:
            illegal += self.last_initial + initial not in _LEGAL
        for k, n in enumerate((blank, duplicate, truncated, illegal, int(turn is not None and turn != self.last_turn))):
            self.sums[k] += n
        if turn is not None:
            self.known.append(turn)
        self.last_turn, self.last_initial = turn, initial
        self.rows.append((turn, role, text, copies, symbol(role, fault)))
        self.bytes += len(role) + len(text)


def blocks(rows: DataFrame, scratch: Scratch, max_rows: int = 1024, max_bytes: int = 4_000_000) -> DataFrame:
    """Ordered rows as blocks numbered by (part, idx); ``whole``: the conversation is in no other."""
    keys = ("conv", "turn", "role", "sha")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("conv", "turn", "role", "text", "copies", "fault")
    schema = T.StructType([rows.schema["conv"], *_BLOCK.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = _Blocks(TaskContext.get().partitionId(), max_rows, max_bytes)

        def ready() -> Iterator[tuple[int, tuple]]:
            for batch in batches:
                for row in _rows(batch):
                    out.add(*row.values())
                    yield from out.ready
                    out.ready.clear()
            out.flush(False)
            yield from out.ready

        return _batches(ready(), schema)

    return scratch.write(ordered.mapInArrow(cut, schema), "blocks")


# ------------------------------------------------------------------ conversations over several blocks

_SEGMENT = "part long, m array<array<long>>"
_PLACE = "part long, idx long, v array<long>, starts array<long>, ends array<long>"


def _edges(found: DataFrame) -> list[tuple[int, object, dict, object, dict]]:
    """Per non-empty partition in order: the conversation and border of its first and last block."""
    side = F.struct("conv", "first_turn", "last_turn", "first_initial", "last_initial")
    rows = found.groupBy("part").agg(F.min_by(side, "idx").alias("a"), F.max_by(side, "idx").alias("z")).collect()
    return [(r["part"], r["a"]["conv"], r["a"], r["z"]["conv"], r["z"]) for r in sorted(rows, key=lambda r: r["part"])]


def _spans(edges: list) -> list[tuple[object, list[int], int, int]]:
    """Conversations that cross partitions: (conversation, partitions, illegal pairs and turn
    numbers counted twice at the crossings)."""
    out: list[list] = []
    for (p, _, _, conv, last), (q, other, first, _, _) in zip(edges, edges[1:], strict=False):
        if conv != other:
            continue
        illegal = last["last_initial"] + first["first_initial"] not in _LEGAL
        twice = last["last_turn"] is not None and last["last_turn"] == first["first_turn"]
        if out and out[-1][1][-1] == p and out[-1][0] == conv:
            out[-1][1].append(q)
            out[-1][2] += illegal
            out[-1][3] += twice
        else:
            out.append([conv, [p, q], int(illegal), int(twice)])
    return [tuple(x) for x in out]


def _segments(conv_type: T.DataType, rest: DataFrame) -> DataFrame:
    """(conv, part) -> the matrix of its blocks there."""
    schema = T.StructType([T.StructField("conv", conv_type), *T.StructType.fromDDL(_SEGMENT).fields])

    def product(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        m = _IDENTITY
        for _, r in group.sort_values("idx").iterrows():
            m = _times(m, matrix_of(runs(r["symbols"].tolist(), r["copies"].tolist())))
        return pd.DataFrame({"conv": [group["conv"].iloc[0]], "part": [group["part"].iloc[0]], "m": [[list(x) for x in m]]})

    return rest.select("conv", "part", "idx", "symbols", "copies").groupBy("conv", "part").applyInPandas(product, schema)


def _places(rest: DataFrame, behind: dict) -> DataFrame:
    """Per block: costs-to-go behind it, and its first state for each state at its segment's
    start; ``ends``, on a segment's last block, the state behind that."""
    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("idx")
        conv = None if pd.isna(key[0]) else key[0]
        parts = [runs(s.tolist(), c.tolist()) for s, c in zip(group["symbols"], group["copies"], strict=True)]
        v, costs = behind.get((conv, key[1]), FINAL), []
        for p in reversed(parts):
            costs.append(v)
            v = before(p, v)
        starts, state = [], [0, 1, 2, 3]
        for p, c in zip(parts, reversed(costs), strict=True):
            starts.append(state)
            known = {s: unroll(p, s, c, False)[1] for s in set(state)}
            state = [known[s] for s in state]
        return pd.DataFrame({"part": group["part"], "idx": group["idx"], "v": [list(c) for c in reversed(costs)], "starts": starts,
                             "ends": [None] * (len(parts) - 1) + [state]})

    return rest.select("conv", "part", "idx", "symbols", "copies").groupBy("conv", "part").applyInPandas(place, _PLACE)


_DONE = T.StructType([T.StructField("part", T.LongType()), T.StructField("idx", T.LongType()), T.StructField("whole", T.BooleanType()),
                      *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most", "cost")],
                      T.StructField("audit", T.StringType()),
                      T.StructField("repaired", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("edit", "role", "text")])))])
_SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _finished(df: DataFrame, fix: dict) -> DataFrame:
    """Blocks with ``v``, ``start`` and ``last`` -> their audit and repaired turns."""
    schema = T.StructType([df.schema["conv"], *_DONE.fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[tuple[int, tuple]]:
            for batch in batches:
                for r in _rows(batch):
                    audit, _, cost = unroll(runs(r["symbols"], r["copies"]), r["start"], tuple(r["v"]), r["last"])
                    repaired = [dict(zip(("edit", "role", "text"), t, strict=True)) for t in applied(
                        audit, r["start"], r["roles"], r["texts"], r["copies"])]
                    illegal, twice = fix.get((r["conv"], r["part"]), (0, 0)) if r["last"] else (0, 0)
                    yield len(audit) + sum(map(len, r["texts"])), (
                        r["conv"], r["part"], r["idx"], r["whole"], r["blank"], r["duplicate"], r["truncated"], r["illegal"] + illegal,
                        r["turns"] - twice, r["least"], r["most"], cost, audit, repaired)

        return _batches(done(), schema)

    return df.mapInArrow(work, schema)


@dataclass(frozen=True)
class Repaired:
    """Blocks of repaired conversations: ``conv`` and its blocks' order (``part, idx``), the counts
    of faults, ``cost``, ``audit`` and ``repaired``, the turns that are left as (edit, role, text).
    Conversations of one block and those of several are apart."""
    single: DataFrame
    several: DataFrame

    def turns(self) -> DataFrame:
        """One row per turn that is left: ``conv, part, idx, place, edit, role, text``, in that order."""
        out = self.single.unionByName(self.several).select("conv", "part", "idx", F.posexplode("repaired").alias("place", "t"))
        return out.select("conv", "part", "idx", "place", "t.*")


def repair(df: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           max_rows: int = 1024) -> Repaired:
    """The cheapest repair of every conversation, in blocks of at most ``max_rows`` distinct turns."""
    turns = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    found = blocks(marked(turns, scratch), scratch, max_rows)
    final = F.array(*[F.lit(x).cast("long") for x in FINAL])
    whole = found.where("whole").select("*", final.alias("v"), F.lit(0).alias("start"), F.lit(True).alias("last"))

    rest = found.where("NOT whole")
    spans = _spans(_edges(found))
    crossing = {(c, p): k for k, (c, ps, _, _) in enumerate(spans) for p in ps}
    segments = _chosen(_segments(found.schema["conv"].dataType, rest), crossing)
    matrices = {(r["conv"], r["part"]): r["m"] for r in segments}
    behind = {}
    for c, ps, _, _ in spans:
        v = FINAL
        for p in reversed(ps):
            behind[c, p] = v
            v = _apply(matrices[c, p], v)
    places = scratch.write(_places(rest, behind), "places")
    ends = {(r["conv"], r["part"]): r["ends"] for r in _chosen(
        rest.select("conv", "part", "idx").join(places.where("ends IS NOT NULL").select("part", "idx", "ends"), ["part", "idx"]), crossing)}
    begins, fix, not_last = {}, {}, set()
    for c, ps, illegal, twice in spans:
        state = 0
        for p in ps:
            begins[c, p] = state
            state = ends[c, p][state]
        fix[c, ps[-1]] = (illegal, twice)
        not_last.update((c, p) for p in ps[:-1])
    return Repaired(_finished(whole, {}), _finished(_started(rest, places, begins, not_last), fix))


def _chosen(df: DataFrame, wanted: dict) -> list:
    """Rows of ``df`` whose (conv, part) is wanted: at most two a partition."""
    if not wanted:
        return []
    parts = sorted({p for _, p in wanted})
    return [r for r in df.where(F.col("part").isin(parts)).toLocalIterator() if (r["conv"], r["part"]) in wanted]


def _started(rest: DataFrame, places: DataFrame, begins: dict, not_last: set) -> DataFrame:
    """Blocks with the costs-to-go behind them, their first state, and whether they are the
    conversation's last."""
    schema = T.StructType([rest.schema["conv"], *T.StructType.fromDDL("part long, idx long, v array<long>, start int, last boolean").fields])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            r = batch.to_pydict()
            keys = list(zip(r["conv"], r["part"], strict=True))
            start = [s[begins.get(k, 0)] for k, s in zip(keys, r["starts"], strict=True)]
            last = [e is not None and k not in not_last for k, e in zip(keys, r["ends"], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                (r["conv"], r["part"], r["idx"], r["v"], start, last), arrow.types, strict=True)], schema=arrow)

    small = rest.select("conv", "part", "idx").join(places, ["part", "idx"]).select("conv", "part", "idx", "v", "starts", "ends")
    return rest.join(small.mapInArrow(look, schema).drop("conv"), ["part", "idx"])


_DIGEST = T.StructType([*[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def digests(done: Repaired) -> DataFrame:
    """One row per conversation with turns.  SHA-256 reads a conversation in order from its start:
    blocks of one that has several stream through one task, whatever their number, one in memory
    at a time; all other work on them is spread."""
    lines = F.when(F.size("repaired") > 0, F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n"))
    single, several = (part.withColumn("lines", lines).drop("repaired") for part in (done.single, done.several))
    gaps = F.when(F.col("least").isNull(), F.lit(0).cast("long")).otherwise(F.expr("try_subtract(most - (turns - 1), least)"))
    single = single.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           F.sha2(F.coalesce("lines", F.lit("")), 256).alias("repaired_sha256"))
    schema = T.StructType([several.schema["conv"], *_DIGEST.fields])
    sums = (*_SUMS, "cost")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished() -> Iterator[tuple[int, tuple]]:
            for conv, rows in groupby((r for batch in batches for r in _rows(batch)), lambda r: r["conv"]):
                total, least, most, audit, sha, apart = [0] * len(sums), None, None, [], hashlib.sha256(), ""
                for r in rows:
                    total = [n + r[c] for n, c in zip(total, sums, strict=True)]
                    if r["least"] is not None:
                        least = r["least"] if least is None else min(least, r["least"])
                        most = r["most"] if most is None else max(most, r["most"])
                    audit.append(r["audit"])
                    if r["lines"] is not None:
                        sha.update((apart + r["lines"]).encode())
                        apart = "\n"
                blank, duplicate, truncated, illegal, turns, cost = total
                gaps = 0 if least is None else most - least + 1 - turns
                yield 0, (conv, gaps if gaps < 2**63 else None, blank, duplicate, truncated, illegal, cost, "".join(audit), sha.hexdigest())

        return _batches(finished(), schema)

    several = several.repartition("conv").sortWithinPartitions("conv", "part", "idx")
    several = several.select("conv", "part", "idx", *sums, "least", "most", "audit", "lines").mapInArrow(stream, schema)
    return single.unionByName(several)


def damaged(df: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as ``conv_id, turn, role, text, code`` after the
    contract's damage; ``code`` 0 is to be dropped, 3 is there twice."""
    def blank(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    out = df.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = out.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "code")
    times = F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.withColumn("_copy", F.explode(times)).drop("_copy")
