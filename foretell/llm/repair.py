"""Conversation structure repair: the cheapest edits that turn rows into a well-formed dialogue.

Role initials must end up as nothing, or as user and assistant by turns behind at most one
system row. Edits and costs: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty
user or assistant row 5; a blank or duplicate row must go, and a truncated row that stays adds 5.

*Cost DP.* A node is (rows read, state of the grammar); its cost is that of the cheapest edits
from there to the end. An arc is optimal if it lies on such a cheapest path.
*Path ranking.* Nodes are ranked by the least audit (initials of the edits) of length 1, 2, 4,
... that optimal arcs spell from them: the rank for twice the length comes from the pair
(rank here, rank where the first half ends), and the pointer to that place doubles with it. An
audit that ends early ranks before its continuations. No two arcs of a node share an initial,
so the end of a least audit is one node. The ranks select every node's arc, and the pointers,
applied from the longest to the shortest, read the selected path without walking it.

An empty role has no initial, so a row with it is never kept as it is.
Rows of a conversation are taken by turn (nulls first), then role and text, copies side by
side. A null role or text is one space. A row's first fault counts: blank, duplicate (role and
text seen earlier), truncated (last character that is no white space is none of ``.!?``).
A null conv_id is a conversation of its own; a conversation without rows gets zeros and an
empty audit. Other columns, whatever their names, are not read. Rows reach a task sorted by
Spark; one conversation, whose audit is one value, must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import arrow_schema, slices

BLANKS = " \t\n\x0b\x0c\r"
#: Edits in ASCII order of their initials.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = (2, 5, 0, 1)
TRUNCATED = 5
#: States: nothing yet, after system, after user, after assistant; dialogues end in the first or last.
STATES, ENDS = 4, (0, 3)
#: State after a row of an initial, and the role (with the state after it) that a state waits for.
AFTER = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
WANTED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_FAR = 1 << 60


def faults_of(roles: list[str], texts: list[str]) -> list[str]:
    """For each row '', 'blank', 'duplicate' or 'truncated'."""
    seen, found = set(), []
    for role, text in zip(roles, texts):
        stripped = text.rstrip(BLANKS)
        mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        fault = "blank" if not stripped else "duplicate" if mark in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add(mark)
        found.append(fault)
    return found


def costs(initials: list[str], faults: list[str]) -> np.ndarray:
    """Cheapest cost from each node to the end, by rows read and state."""
    out = [(0, _FAR, _FAR, 0)]
    out[0] = _with_inserts(out[0])
    for initial, fault in zip(reversed(initials), reversed(faults)):
        after = out[-1]
        row = [COST[DELETE] + cost for cost in after]
        if fault not in ("blank", "duplicate"):
            stay = TRUNCATED if fault else 0
            kept = AFTER.get(initial, (-1,) * STATES)
            for state in range(STATES):
                row[state] = min(row[state], COST[REROLE] + stay + after[WANTED[state][1]])
                if kept[state] >= 0:
                    row[state] = min(row[state], stay + after[kept[state]])
        out.append(_with_inserts(row))
    return np.array(out[::-1], dtype=np.int64)


def _with_inserts(row) -> list[int]:
    row = list(row)
    for state in (3, 2, 3, 1, 0):
        row[state] = min(row[state], COST[INSERT] + row[WANTED[state][1]])
    return row


def optimal_arcs(initials: list[str], faults: list[str], cost: np.ndarray) -> np.ndarray:
    """Target node by edit and node (rows read * 4 + state); -1 where that arc is not optimal."""
    n = len(initials)
    here = np.arange((n + 1) * STATES).reshape(n + 1, STATES)
    wanted = np.array([state for _, state in WANTED])
    kept = np.array([AFTER.get(c, (-1,) * STATES) for c in initials], dtype=np.int64).reshape(n, STATES)
    stays = np.array([f not in ("blank", "duplicate") for f in faults], dtype=bool)[:, None]
    extra = np.array([TRUNCATED if f == "truncated" else 0 for f in faults], dtype=np.int64)[:, None]
    target = np.full((len(EDITS), n + 1, STATES), -1, dtype=np.int64)

    def arc(edit, rows, to, weight, allowed=True):
        fits = allowed & (cost[rows] < _FAR) & (cost.ravel()[to] + weight == cost[rows])
        target[edit, rows] = np.where(fits, to, -1)

    read = slice(0, n)
    arc(DELETE, read, here[1:], COST[DELETE])
    arc(INSERT, slice(0, n + 1), here[:, wanted], COST[INSERT])
    arc(KEEP, read, (here[1:, :1] + np.maximum(kept, 0)), COST[KEEP] + extra, stays & (kept >= 0))
    arc(REROLE, read, here[1:, wanted], COST[REROLE] + extra, stays)
    return target.reshape(len(EDITS), -1)


def least_path(target: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Edits and nodes of the path from ``start`` whose audit is least."""
    nodes = np.arange(target.shape[1])
    arcs = target >= 0
    ends = ~arcs.any(axis=0)
    first = np.where(ends, 0, arcs.argmax(axis=0))
    # rank 0: the audit has ended; a node without arcs points at itself
    rank = np.where(ends, 0, first + 1)
    pointers = [np.where(ends, nodes, target[first, nodes])]
    while not ends[pointers[-1]].all():
        pair = rank * (rank.max() + 1) + rank[pointers[-1]]
        rank = np.unique(pair, return_inverse=True)[1]
        pointers.append(pointers[-1][pointers[-1]])
    # initials first, then the rank of what follows
    size = int(rank.max()) + 1
    key = np.where(arcs, np.arange(len(EDITS))[:, None] * size + rank[np.maximum(target, 0)], len(EDITS) * size)
    chosen = key.argmin(axis=0)
    path = np.array([start])
    for pointer in pointers:  # 1, 2, 4, ... nodes of the path are known
        path = np.concatenate([path, pointer[path]])
    path = path[~ends[path]]
    return chosen[path], path


@dataclass
class Repaired:
    """What became of a conversation; ``rows`` are (edit, role, text) of the rows that stay."""

    gaps: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    audit: str = ""
    rows: list = field(default_factory=list)


def repair(turns: list, roles: list[str], texts: list[str]) -> Repaired:
    """Repairs one conversation; rows come in order."""
    initials, faults = [role[:1] for role in roles], faults_of(roles, texts)
    known = {turn for turn in turns if turn is not None}
    found = Repaired(gaps=max(known) - min(known) + 1 - len(known) if known else 0)
    for name in ("blank", "duplicate", "truncated"):
        setattr(found, name, faults.count(name))
    found.illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:]))
    if not roles:
        return found
    cost = costs(initials, faults)
    found.cost = int(cost[0, 0])
    edits, path = least_path(optimal_arcs(initials, faults, cost), 0)
    found.audit = "".join(EDITS[e] for e in edits)
    for edit, node in zip(edits.tolist(), path.tolist()):
        row, state = divmod(node, STATES)
        if edit == KEEP:
            found.rows.append(("K", roles[row], texts[row]))
        elif edit == REROLE:
            found.rows.append(("R", WANTED[state][0], texts[row]))
        elif edit == INSERT:
            found.rows.append(("I", WANTED[state][0], ""))
    return found


_SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _each_conversation(df, make, schema, conv_id, turn, role, text, present):
    """``make(Repaired)`` gives a conversation's result rows, without its id."""
    kind = dict(df.select(F.col(conv_id).alias("conv_id")).dtypes)["conv_id"]
    out = df.sparkSession.createDataFrame([], f"conv_id {kind}, {schema}").schema
    arrow = arrow_schema(out)
    rows = df.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(map(list, zip(*found)), arrow)], schema=arrow
            )

        current, held, found, size = None, ([], [], []), [], 0
        for batch in batches:
            for part in slices(batch, 3):
                for conv, *row, there in zip(*(c.to_pylist() for c in part.columns)):
                    if current is None or current[0] != conv:
                        if current is not None:
                            found += [(current[0], *r) for r in make(repair(*held))]
                        current, held = (conv,), ([], [], [])
                    if there:
                        size += len(row[2])
                        for column, value in zip(held, row):
                            column.append(value)
                if found and (len(found) > 5_000 or size > 1 << 22):
                    yield table(found)
                    found, size = [], 0
        if current is not None:
            found += [(current[0], *r) for r in make(repair(*held))]
        if found:
            yield table(found)

    return rows.mapInArrow(run, out)


_COLUMNS = ("conv_id", "turn", "role", "text")


def summaries(df: DataFrame, present: Column | None = None, columns: tuple = _COLUMNS) -> DataFrame:
    """One row for each conv_id: counts of faults, cost, audit and digest of the repaired rows.

    Rows for which ``present`` is given and not true only name their conversation.
    """

    def make(found: Repaired):
        digest = hashlib.sha256()
        for n, (_, role, text) in enumerate(found.rows):
            digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
        yield (
            found.gaps, found.blank, found.duplicate, found.truncated, found.illegal, found.cost, found.audit,
            digest.hexdigest(),
        )

    return _each_conversation(df, make, f"{_SUMMARY}, repaired_sha256 string", *columns, present)


def repaired_rows(df: DataFrame, present: Column | None = None, columns: tuple = _COLUMNS) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""

    def make(found: Repaired):
        return ((place, *row) for place, row in enumerate(found.rows))

    return _each_conversation(df, make, "place bigint, edit string, role string, text string", *columns, present)


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and whether the row is still there, after faults dealt by crc32 of ``conv_id:turn``."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return df.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
