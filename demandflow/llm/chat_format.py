"""Chat formatting: minimum-cost role repair, then rendering.

Legal conversations are those of an automaton: an optional system turn first, then user and
assistant in turn.  Each input turn is kept, relabelled, or merged into the turn before it, and
empty turns may be inserted before it or at the end; dynamic programming over the automaton's
states finds the cheapest repair.  Of equally cheap repairs the one whose last differing step
comes first in this order wins: keep or relabel, insert, merge, and system, user, assistant.

One turn is a (min, +) matrix over the states, and matrices multiply associatively.  A
conversation is cut into chunks of ``chunk_turns`` turn numbers; each chunk's matrix is
computed by itself, matrices are multiplied up a tree of fan-out ``fan_out``, the states at all
chunk borders are read off down the tree, and every chunk then repairs and renders its own
turns.  So one conversation may hold a third of all rows.  Turns are ordered by (turn, role, text),
nulls first; rows with the same turn number share a chunk.

Null, empty or unknown roles can only be relabelled or merged.  Null text is empty.  Repeated
rows are turns of their own, rows with a null conversation id are one conversation, an empty
table gives an empty result, and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import Scratch

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    relabel: int = 3
    relabel_unknown: int = 1
    insert: int = 2
    merge_same: int = 1
    merge_other: int = 4
    merge_unknown: int = 2
    accept: tuple[int, ...] = (USER, ASSISTANT)


Step = tuple[int, str, tuple[int, ...], int]  # cost, action, inserted roles, state after


def code(role: str | None) -> int:
    role = (role or "").strip().lower()
    return ROLES.index(role) if role in ROLES[1:] else START


def steps(role: int, state: int, c: Costs) -> list[Step]:
    """What may happen to a turn of a role (START: unknown) in a state, in order of preference."""
    def as_(q: int) -> tuple[int, str]:
        return (0, "keep") if q == role else (c.relabel_unknown if role == START else c.relabel, "relabel")

    out: list[Step] = [(as_(q)[0], as_(q)[1], (), q) for q in LEGAL[state]]
    out += [(c.insert + as_(q)[0], as_(q)[1], (p,), q) for p in LEGAL[state] for q in LEGAL[p]]
    if state != START:
        out.append((c.merge_unknown if role == START else c.merge_same if role == state else c.merge_other, "merge", (), state))
    return out


def end_steps(state: int, c: Costs) -> tuple[int, tuple[int, ...]]:
    """Cheapest way to a state that may end a conversation."""
    if state in c.accept:
        return 0, ()
    return min((c.insert + end_steps(q, c)[0], (q, *end_steps(q, c)[1])) for q in LEGAL[state])


def best(role: int, state: int, after: int, c: Costs) -> Step | None:
    """The cheapest step from one state to another (the first of equals)."""
    got = [s for s in steps(role, state, c) if s[3] == after]
    return min(got, key=lambda s: s[0]) if got else None


def turn_matrix(role: int, c: Costs) -> list[int]:
    return [s[0] if (s := best(role, i, j, c)) else FAR for i in range(4) for j in range(4)]


def product(a: list[int], b: list[int]) -> list[int]:
    return [min(FAR, *(a[4 * i + k] + b[4 * k + j] for k in range(4))) for i in range(4) for j in range(4)]


def borders(matrices: list[list[int]], first: int, last: int) -> list[int]:
    """States between matrices on the cheapest way from ``first`` to ``last``; ties: see the module."""
    costs = [[FAR] * 4]
    costs[0][first] = 0
    for m in matrices:
        before = costs[-1]
        costs.append([min(before[i] + m[4 * i + j] for i in range(4)) for j in range(4)])
    states = [last]
    for before, m in zip(reversed(costs[:-1]), reversed(matrices), strict=True):
        states.append(min(range(4), key=lambda i: before[i] + m[4 * i + states[-1]]))
    return states[::-1]


def by_group(df: DataFrame, keys: list[str], order: list, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Sorted groups, one at a time, through ``fn``; rows stream through a task."""
    names, out_names = df.columns, [c.strip().split(" ")[0] for c in schema.split(",")]
    at = [names.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[] for _ in names]
        done: list[list] = [[] for _ in out_names]

        def flush() -> None:
            got = fn(dict(zip(names, rows, strict=True)))
            for d, n in zip(done, out_names, strict=True):
                d.extend(got[n])

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(d, t) for d, t in zip(done, types, strict=True)], names=out_names)

        types = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}[c.strip().split(" ")[1]]
                 for c in schema.split(",")]
        last = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            keyed = list(zip(*[columns[i] for i in at], strict=True))
            cuts = [0, *[i for i in range(1, len(keyed)) if keyed[i] != keyed[i - 1]], len(keyed)]
            for a, b in pairwise(cuts):
                if a == b:
                    continue
                if last is not None and keyed[a] != last:
                    flush()
                    rows = [[] for _ in names]
                for r, c in zip(rows, columns, strict=True):
                    r.extend(c[a:b])
                last = keyed[a]
            if len(done[0]) > 5000:
                yield ready()
                done = [[] for _ in out_names]
        if last is not None:
            flush()
            yield ready()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _clean(text: str) -> str:
    """A text can't open or close turns."""
    return text.replace("<|im_", "<| im_")


def _opened(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


_CLOSED = "<|im_end|>\n"


def repair(rows: DataFrame, scratch: Scratch, costs: Costs | None = None, chunk_turns: int = 256, fan_out: int = 256) -> DataFrame:
    """One row per input turn: ``conv_id, turn, place, role, new_role, action, cost, fragment``.  ``place`` is
    its place in its chunk of turn numbers; the fragments of a conversation by (turn, place), in
    a row, are the rendered repaired conversation (see :func:`rendered`)."""
    c = costs or Costs()
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.floor(F.col("turn") / chunk_turns).cast("long").alias("chunk"),
                        F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    each = [turn_matrix(r, c) for r in range(4)]

    def chunk_matrix(g: dict[str, list]) -> dict[str, list]:
        m = None
        for role in g["role"]:
            m = each[code(role)] if m is None else product(m, each[code(role)])
        return {"conv_id": g["conv_id"][:1], "chunk": g["chunk"][:1], "m": [m]}

    def parent_matrix(g: dict[str, list]) -> dict[str, list]:
        m = g["m"][0]
        for x in g["m"][1:]:
            m = product(m, x)
        return {"conv_id": g["conv_id"][:1], "chunk": g["parent"][:1], "m": [m]}

    def child_borders(g: dict[str, list]) -> dict[str, list]:
        at = borders(g["m"], g["first"][0], g["last"][0])
        return {"conv_id": g["conv_id"], "chunk": g["chunk"], "first": at[:-1], "last": at[1:], "ends": [e if i == len(at) - 2 else 0 for i, e in enumerate(g["ends"])]}

    def whole(g: dict[str, list]) -> dict[str, list]:
        m = g["m"][0]
        last = min(range(4), key=lambda j: m[j] + end_steps(j, c)[0])
        return {"conv_id": g["conv_id"], "chunk": g["chunk"], "first": [START], "last": [last], "ends": [1]}

    # up the tree, until every conversation is one matrix
    levels = [scratch.write(by_group(turns.drop("text"), ["conv_id", "chunk"], ["turn", "role"], chunk_matrix, "conv_id long, chunk long, m array<long>"), "chunks")]
    while (most := levels[-1].groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > 1:
        parent = F.lit(0).cast("long") if most <= fan_out else F.floor(F.col("chunk") / fan_out).cast("long")
        levels[-1] = levels[-1].withColumn("parent", parent)
        levels.append(scratch.write(by_group(levels[-1], ["conv_id", "parent"], ["chunk"], parent_matrix, "conv_id long, chunk long, m array<long>"), "chunks"))
    known = by_group(levels[-1], ["conv_id", "chunk"], [], whole, "conv_id long, chunk long, first long, last long, ends long")
    # and down again
    for level in reversed(levels[:-1]):
        above = scratch.write(known, "borders").withColumnsRenamed({"conv_id": "c2", "chunk": "p2"})
        joined = level.join(above, F.col("conv_id").eqNullSafe(F.col("c2")) & F.col("parent").eqNullSafe(F.col("p2"))).drop("c2", "p2")
        known = by_group(joined, ["conv_id", "parent"], ["chunk"], child_borders, "conv_id long, chunk long, first long, last long, ends long")
    known = scratch.write(known, "borders").withColumnsRenamed({"conv_id": "c2", "chunk": "p2"})

    def render(g: dict[str, list]) -> dict[str, list]:
        roles = [code(r) for r in g["role"]]
        states = borders([each[r] for r in roles], g["first"][0], g["last"][0])
        out: dict[str, list] = {k: [] for k in ("conv_id", "turn", "place", "role", "new_role", "action", "cost", "fragment")}
        for i, (role, a, b) in enumerate(zip(roles, states, states[1:], strict=False)):
            cost, action, inserted, _ = best(role, a, b, c)
            text = _clean(g["text"][i] or "")
            if action == "merge":
                parts = ["\n\n", text]
            else:
                parts = [_CLOSED] if a != START else []
                for p in inserted:
                    parts += [_opened(p), _CLOSED]
                parts += [_opened(b), text]
            if g["ends"][0] and i == len(roles) - 1:
                parts.append(_CLOSED)
                more, added = end_steps(b, c)
                cost += more
                for p in added:
                    parts += [_opened(p), _CLOSED]
            values = (g["conv_id"][i], g["turn"][i], i, g["role"][i], ROLES[b], "insert+" + action if inserted else action, cost, "".join(parts))
            for k, v in zip(out, values, strict=True):
                out[k].append(v)
        return out

    joined = turns.join(known, F.col("conv_id").eqNullSafe(F.col("c2")) & F.col("chunk").eqNullSafe(F.col("p2"))).drop("c2", "p2")
    return by_group(joined, ["conv_id", "chunk"], ["turn", "role", "text"], render,
                    "conv_id long, turn long, place long, role string, new_role string, action string, cost long, fragment string")


def rendered(repaired: DataFrame) -> DataFrame:
    """``conv_id, cost, text`` of whole conversations, for those that fit one value."""
    parts = F.expr("transform(sort_array(collect_list(struct(turn, place, fragment))), x -> x.fragment)")
    return repaired.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.concat_ws("", parts).alias("text"))
