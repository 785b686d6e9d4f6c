"""Chat formatting: the cheapest repair of a conversation's roles, found over an automaton of legal turns, and its rendering."""

from __future__ import annotations

import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, partitions, tidied

#: The automaton. A conversation may open with a system turn; user and assistant turns alternate, user first.
ROLES = ("system", "user", "assistant")
START = 3
FOLLOWS = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
#: The cost of each repair.
MERGE, RELABEL, INSERT = 1, 2, 3
STATES = (0, 1, 2, START)
FAR = 1 << 60


def _moves() -> dict[int, list[tuple[int, int, int, str, int | None]]]:
    """For each role as written (-1: none that is known): (from, to, cost, what, inserted), cheapest kinds first."""
    out = {}
    for role in (-1, 0, 1, 2):
        change = lambda x: 0 if x == role else RELABEL  # noqa: B023, E731
        moves = [(s, x, change(x), "keep" if x == role else "relabel", None) for s in STATES for x in FOLLOWS[s]]
        moves += [(s, s, MERGE + change(s), "merge", None) for s in STATES if s != START]
        moves += [(s, x, INSERT + change(x), "insert", y) for s in STATES for y in FOLLOWS[s] for x in FOLLOWS[y]]
        out[role] = moves
    return out


MOVES = _moves()


def role_of(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES else -1


def transfer(roles: list[int]) -> list[list[int]]:
    """Least cost from each state to each over these turns."""
    out = []
    for s in STATES:
        cost = [0 if t == s else FAR for t in STATES]
        for role in roles:
            new = [FAR] * 4
            for a, b, c, _, _ in MOVES[role]:
                new[b] = min(new[b], cost[a] + c)
            cost = new
        out.append(cost)
    return out


def repair(roles: list[int], costs: list[int], end: int | None = None) -> tuple[int | None, list[tuple[int, str, int | None, int]]]:
    """The state before, and per turn (role it gets, what is done, role of an empty turn put before it, cost) of the cheapest repair.

    costs: what each state before these turns has cost. end: the state after them (None: the cheapest). Of equal repairs that with
    the move listed first, from the last turn to the first; so it doesn't matter where a conversation is cut. The state is None if
    the end can't be reached.
    """
    cost, back = list(costs), []
    for role in roles:
        new, how = [FAR] * 4, [None] * 4
        for m in MOVES[role]:
            if cost[m[0]] + m[2] < new[m[1]]:
                new[m[1]], how[m[1]] = cost[m[0]] + m[2], m
        back.append(how)
        cost = new
    at = end if end is not None else min(STATES, key=lambda t: (cost[t], t))
    out = []
    for how in reversed(back):
        move = how[at]
        if move is None:
            return None, []
        out.append((move[1], move[3], move[4], move[2]))
        at = move[0]
    return at, out[::-1]


def escaped(text: str | None) -> str:
    """A text that can't be taken for markers: what looks like the beginning of one, or of one escaped, gets a backslash more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text or "")


def plain(text: str) -> str:
    """What `escaped` was made of."""
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(steps, texts: list[str | None], opened: bool, closes: bool) -> str:
    """Turns as <|role|>, text (escaped), <|end|>; texts that are merged stand a line apart. opened: what comes before has left a turn open."""
    out = []
    for (role, what, empty, _), text in zip(steps, texts, strict=True):
        if what == "merge":
            out.append(f"\n{escaped(text)}")
            continue
        if opened:
            out.append("<|end|>\n")
        if empty is not None:
            out.append(f"<|{ROLES[empty]}|>\n<|end|>\n")
        out.append(f"<|{ROLES[role]}|>\n{escaped(text)}")
        opened = True
    return "".join([*out, "<|end|>\n" if closes and opened else ""])


#: Turns of a row of the result.
TURNS = 1000


def format_chats(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", rows_per_task: int = 50_000, turns_per_row: int = TURNS) -> DataFrame:
    """(conv_id, part, n_rows, n_turns, cost, merged, relabelled, inserted, rendered): a row for each `turns_per_row` turns of a conversation, in their order; so one row for a conversation of that many at most, however the rows are dealt over tasks.

    Turns are ordered by number (nulls first), then role and text. The renderings of a conversation's rows one after another are
    the rendering of the whole, and its repair is the cheapest over the whole. Unknown and null roles have to be relabelled or
    merged; null texts are empty; texts are escaped, so that none can forge a marker; rows of null conv_id are one conversation;
    repeated rows are turns of their own. An empty table gives an empty result; other columns are ignored.

    Rows are range-partitioned in that order, so a conversation of any length is spread over tasks of bounded size. For those that
    cross tasks the least costs between states are worked out first, then what each of a task's last states comes from (at most two
    of 16 and of 4 numbers from a task); these fix the states at the seams. A row of the result that crosses tasks is put together
    from its pieces, two a task at most.
    """
    rows = turns.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("n"), F.col(role_col).alias("r"), F.col(text_col).alias("t"))
    kind = rows.schema["c"].dataType.simpleString()
    count = rows.count()
    tasks = max(min(partitions(turns.sparkSession), 1 + count // 1000), -(-count // rows_per_task), 1)
    ensure_checkpoint_dir(turns.sparkSession)
    sorted_ = rows.repartitionByRange(tasks, "c", "n", "r", "t").sortWithinPartitions("c", "n", "r", "t").withColumn("p", F.spark_partition_id()).checkpoint()  # tasks and their order stay

    def conversations(batches):
        def flat():
            for b in batches:
                yield from zip(*(b.column(k).to_pylist() for k in range(5)), strict=True)

        return groupby(flat(), key=lambda x: x[0])

    def seams(batches):
        found = []
        for c, group in conversations(batches):
            group = [(role_of(r), p) for _, _, r, _, p in group]
            found = [*found[:1], (c, group[0][1], len(group), transfer([r for r, _ in group]))]
        cs, ps, ns, ms = zip(*found, strict=True) if found else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(cs, c_type), pa.array(ps, pa.int32()), pa.array(ns, pa.int64()), pa.array([sum(m, []) for m in ms], pa.list_(pa.int64()))], ["c", "p", "n", "m"])

    from pyspark.sql.pandas.types import to_arrow_type

    c_type = to_arrow_type(rows.schema["c"].dataType)
    narrow = sorted_.select("c", "n", "r", F.lit(None).cast("string").alias("t"), "p")
    met = narrow.mapInArrow(tidied(seams), f"c {kind}, p int, n long, m array<long>")
    by: dict = {}
    for r in met.collect():  # two rows a task at most
        by.setdefault(r.c, []).append((r.p, r.n, r.m))
    before = {}  # (conversation, task): turns before it and what each state there has cost
    for c, pieces in by.items():
        if len(pieces) > 1:
            pieces.sort()
            cost, n = [0 if t == START else FAR for t in STATES], 0
            for p, size, m in pieces:
                before[c, p] = n, cost
                cost, n = [min(FAR, min(cost[a] + m[4 * a + b] for a in STATES)) for b in STATES], n + size
            by[c].append(cost)

    def ways(batches):
        for c, group in conversations(batches):
            group = [(role_of(r), p) for _, _, r, _, p in group]
            if (c, group[0][1]) in before:
                origins = [repair([r for r, _ in group], before[c, group[0][1]][1], t)[0] for t in STATES]
                yield pa.RecordBatch.from_arrays([pa.array([c], c_type), pa.array([group[0][1]], pa.int32()), pa.array([origins], pa.list_(pa.int32()))], ["c", "p", "o"])

    origin = {(r.c, r.p): r.o for r in narrow.mapInArrow(tidied(ways), f"c {kind}, p int, o array<int>").collect()} if before else {}  # two rows a task at most
    fixed = {}  # (conversation, task): turns before, what the states before have cost, state after, whether it is the last
    for c, pieces in by.items():
        if len(pieces) > 1:
            cost = pieces.pop()
            at = min(STATES, key=lambda t: (cost[t], t))
            for j in range(len(pieces) - 1, -1, -1):
                fixed[c, pieces[j][0]] = (*before[c, pieces[j][0]], at, j == len(pieces) - 1)
                at = origin[c, pieces[j][0]][at]
    shared = turns.sparkSession.sparkContext.broadcast(fixed)  # two entries a task at most

    def rendered(whole: bool):
        """The rows of the result that lie within a task, or the pieces of the others."""

        def run(batches):
            names = ["c", "part", "piece", "n_rows", "n_turns", "cost", "merged", "relabelled", "inserted", "rendered"]
            kinds = [c_type, *[pa.int64()] * 8, pa.string()]
            held = []

            def flush():
                return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

            for c, group in conversations(batches):
                group = list(group)
                first, costs, after, last = shared.value.get((c, group[0][4]), (0, [0 if t == START else FAR for t in STATES], None, True))
                roles = [role_of(x[2]) for x in group]
                (origin, steps), a = repair(roles, costs, after), 0
                while a < len(group):
                    part = (first + a) // turns_per_row
                    b = min(len(group), (part + 1) * turns_per_row - first)
                    ends = last and b == len(group)
                    if whole == ((first + a) % turns_per_row == 0 and (ends or (first + b) % turns_per_row == 0)):
                        some, was = steps[a:b], roles[a:b]
                        held.append((c, part, first + a, b - a, sum((w != "merge") + (y is not None) for _, w, y, _ in some), sum(x for *_, x in some), sum(w == "merge" for _, w, _, _ in some), sum(x != r for (x, *_), r in zip(some, was, strict=True)), sum(y is not None for _, _, y, _ in some), render(some, [x[3] for x in group[a:b]], origin != START or a > 0, ends)))
                        if len(held) >= 500:
                            yield flush()
                            held = []
                    a = b
            if held:
                yield flush()

        return sorted_.mapInArrow(tidied(run), f"c {kind}, part long, piece long, n_rows long, n_turns long, cost long, merged long, relabelled long, inserted long, rendered string")

    figures = ("n_rows", "n_turns", "cost", "merged", "relabelled", "inserted")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "rendered"))), lambda x: x["rendered"]), "")
    joined = rendered(False).groupBy("c", "part").agg(*[F.sum(x).alias(x) for x in figures], text.alias("rendered"))  # turns_per_row turns at most
    return rendered(True).drop("piece").unionByName(joined).withColumnRenamed("c", "conv_id")
