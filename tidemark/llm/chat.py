"""Chat formatting by minimum-cost role repair (operator 9).

A legal conversation is an optional system turn, then user and assistant
turns in alternation, the assistant last. Dynamic programming over this
automaton gives every row the role with the least total cost: a row may join
the turn before it (merge), take another role (relabel), or have empty turns
inserted before it. The repaired sequence is rendered row by row; a row's
``rendered`` closes the turn before it, if it starts a new one, so the pieces
of a conversation, joined in the order of ``place``, are its chat text.

One step of the program is a matrix of costs from state to state, and steps
combine by the associative (min, +) product. Rows are range-partitioned by
(conv_id, turn, ...) once and cut into chunks of ``CHUNK`` rows. A chunk sums
up the conversations that cross its ends as one matrix each; these are
combined per conversation (one small row per chunk), which fixes the states
at the chunk ends; then every chunk solves its rows by itself. So one
conversation may hold any share of all rows.

Defined cases: rows of one conversation are ordered by turn (NULL first), then
text; repeated rows are turns of their own; rows with a NULL conv_id form one
conversation; a NULL or unknown role takes any role at the cost of a guess; a
NULL text is empty; control marks inside a text are broken up so that they
cannot end a turn; extra columns are ignored; an empty table gives no rows.
Of equally cheap repairs the first by state order is taken; in a conversation
that crosses chunks this choice may depend on where they were cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, saved, to_batch

# fixed values: role names seen in chat data and the role they mean
ALIASES = {
    "system": "system", "developer": "system",
    "user": "user", "human": "user", "customer": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
}
STATES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: Turns that may follow a state; costs of the repairs; rows of a chunk.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, GUESS, INSERT = 1, 5, 1, 3
#: A late system turn reads best as part of the user's.
RELABEL_AS = {(SYSTEM, USER): 2}
CHUNK = 1024
NEVER = 1 << 40
ROLES = (SYSTEM, USER, ASSISTANT)

OPEN, CLOSE, MARK, BROKEN = "<|im_start|>{}\n", "<|im_end|>\n", "<|", "< |"


def _inserted(state: int, role: int) -> tuple[int, ...] | None:
    """The empty turns that make ``role`` legal after ``state``: none, some, or impossible."""
    if role in FOLLOWS[state]:
        return ()
    for a in FOLLOWS[state]:
        if role in FOLLOWS[a]:
            return (a,)
    return None


JOIN = {(s, r): _inserted(s, r) for s in range(4) for r in ROLES}
#: Empty turns that complete a conversation after its last row.
ENDING = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def known(role: str | None) -> int | None:
    return {v: k for k, v in enumerate(STATES)}.get(ALIASES.get((role or "").strip().lower(), ""))


def step(role: int | None) -> list[list[tuple[int, bool]]]:
    """Cost from each state to each role for a row, and whether it merges."""
    out = []
    for s in range(4):
        line = [(NEVER, False)] * 4
        for r in ROLES:
            change = GUESS if role is None else 0 if r == role else RELABEL_AS.get((role, r), RELABEL)
            joins = JOIN[s, r]
            choices = [] if joins is None else [(INSERT * len(joins) + change, False)]
            if s == r:
                choices.append((MERGE + change, True))
            if choices:
                line[r] = min(choices, key=lambda c: (c[0], not c[1]))
        out.append(line)
    return out


STEPS = {role: step(role) for role in (None, *ROLES)}
COSTS = {role: [[c for c, _ in line] for line in lines] for role, lines in STEPS.items()}
ONE = [[0 if a == b else NEVER for b in range(4)] for a in range(4)]


def product(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)] for row in a]


def solve(roles: list[int | None], entry: int, exit_: int | None) -> list[int]:
    """The cheapest states of the rows between an entry and an exit state (None: any, completed)."""
    cost = [0 if s == entry else NEVER for s in range(4)]
    back = []
    for role in roles:
        m = COSTS[role]
        best = [min(range(4), key=lambda s, j=j: (cost[s] + m[s][j], s)) for j in range(4)]
        cost = [cost[best[j]] + m[best[j]][j] for j in range(4)]
        back.append(best)
    if exit_ is None:
        exit_ = min(ROLES, key=lambda s: (cost[s] + INSERT * len(ENDING[s]), s))
    states = [exit_]
    for best in reversed(back[1:]):
        states.append(best[states[-1]])
    return states[::-1]


def repaired(roles: list[int | None], texts: list[str | None], entry: int, exit_: int | None, last: bool) -> Iterator[tuple]:
    """``(role, action, cost, rendered)`` of each row."""
    before = entry
    for k, (role, text, state) in enumerate(zip(roles, texts, solve(roles, entry, exit_), strict=True)):
        cost, merges = STEPS[role][before][state]
        said = (text or "").replace(MARK, BROKEN)
        actions = ["relabel"] if role != state else []
        if merges:
            actions.append("merge")
            piece = "\n\n" + said
        else:
            empty = JOIN[before, state]
            actions += ["insert"] * len(empty)
            piece = (CLOSE if before != START else "") + "".join(OPEN.format(STATES[e]) + CLOSE for e in empty) + OPEN.format(STATES[state]) + said
        if last and k == len(roles) - 1:
            cost += INSERT * len(ENDING[state])
            actions += ["insert"] * len(ENDING[state])
            piece += CLOSE + "".join(OPEN.format(STATES[e]) + CLOSE for e in ENDING[state])
        yield STATES[state], "+".join(actions) or "keep", cost, piece
        before = state


# ---- Spark stages ----------------------------------------------------------

ENDS = "chunk bigint, conv_id bigint, matrix array<bigint>"
BOUNDS = "chunk bigint, conv_id bigint, entry int, exit int, last boolean"
OUT = "conv_id bigint, place bigint, turn bigint, role string, action string, cost int, rendered string"


def _segments(conv: list) -> list[tuple[int, int]]:
    cuts = [0, *(k for k in range(1, len(conv)) if conv[k] != conv[k - 1]), len(conv)]
    return list(zip(cuts, cuts[1:], strict=False))


def _sorted(table: pa.Table, by: str) -> dict[str, list]:
    return table.sort_by(by).to_pydict()


def _summaries(table: pa.Table) -> pa.Table:
    """One matrix for the first and one for the last conversation of a chunk."""
    t = _sorted(table, "place")
    segments = _segments(t["conv_id"])
    rows = []
    for a, b in dict.fromkeys([segments[0], segments[-1]]):
        m = ONE
        for r in t["role"][a:b]:
            m = product(m, COSTS[known(r)])
        rows.append((t["chunk"][0], t["conv_id"][a], [min(x, NEVER) for line in m for x in line]))
    return pa.Table.from_batches([to_batch(rows, arrow_schema(ENDS))])


def _bounds(table: pa.Table) -> pa.Table:
    """The states at the chunk ends of one conversation."""
    t = _sorted(table, "chunk")
    ms = [[m[i : i + 4] for i in range(0, 16, 4)] for m in t["matrix"]]
    cost, back = [0, NEVER, NEVER, NEVER], []
    for m in ms:
        best = [min(range(4), key=lambda s, j=j: (cost[s] + m[s][j], s)) for j in range(4)]
        cost = [cost[best[j]] + m[best[j]][j] for j in range(4)]
        back.append(best)
    states = [min(ROLES, key=lambda s: (cost[s] + INSERT * len(ENDING[s]), s))]
    for best in reversed(back):
        states.append(best[states[-1]])
    states.reverse()
    rows = [(c, t["conv_id"][0], states[k], states[k + 1], k == len(ms) - 1) for k, c in enumerate(t["chunk"])]
    return pa.Table.from_batches([to_batch(rows, arrow_schema(BOUNDS))])


def _render(rows: pa.Table, bounds: pa.Table) -> pa.Table:
    t = _sorted(rows, "place")
    ends = {c: (e, x, last) for c, e, x, last in zip(*(bounds[n].to_pylist() for n in ("conv_id", "entry", "exit", "last")), strict=True)}
    out = []
    for a, b in _segments(t["conv_id"]):
        conv = t["conv_id"][a]
        entry, exit_, last = ends.get(conv, (START, None, True))
        new = repaired([known(r) for r in t["role"][a:b]], t["text"][a:b], entry, exit_, last)
        out += [(conv, t["place"][k], t["turn"][k], *row) for k, row in zip(range(a, b), new, strict=True)]
    return pa.Table.from_batches([to_batch(out, arrow_schema(OUT))])


def chat_format(conversations: DataFrame) -> DataFrame:
    """One row per row of ``conversations``: its repaired role, what was done, the cost, the rendered piece."""
    turns = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    order = ["conv_id", "turn", "text", "role"]
    placed = saved(
        turns.repartitionByRange(*(F.col(c).asc_nulls_first() for c in ("conv_id", "turn")), F.xxhash64("text", "role"))
        .sortWithinPartitions("conv_id", "turn", F.xxhash64("text", "role"), *order[2:])
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("chunk", F.floor(F.col("place") / CHUNK).cast("bigint")),
        "turns",
    )
    ends = placed.select("chunk", "place", "conv_id", "role").groupBy("chunk").applyInArrow(_summaries, ENDS)
    bounds = saved(ends.groupBy("conv_id").applyInArrow(_bounds, BOUNDS), "bounds")
    return placed.groupBy("chunk").cogroup(bounds.groupBy("chunk")).applyInArrow(_render, OUT)
