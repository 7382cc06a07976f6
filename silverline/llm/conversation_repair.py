"""Repair of conversation structure by Viterbi with survivor coalescence.

A conversation should read s?(ua)+ in the initials of its roles, or be empty.
Rows are kept, given another role or deleted, and empty rows inserted, at the
least cost; of equal costs the edits whose initials come first in ASCII order.

A conversation's rows arrive in order. The search keeps one survivor for each
state of the pattern: the cheapest edits so far that end there. Survivors share
a tree of backpointers that counts the children of its nodes: a node without any
is freed, and when the root has one child left all survivors agree on that edit,
which is emitted at once. So memory holds the rows on which survivors differ,
not the conversation. Survivors have one symbol for every row, so none is the
beginning of another and their whole unresolved edits have a strict order. A
step appends to them, which cannot change that order: it is carried along as
ranks, and ties are decided as if the complete edits had been compared. Survivors
that others can stand in for at a lower cost are dropped, or the one that has
deleted everything would keep the whole tree alive.

Rows are sorted by range, so a conversation of any length is spread over tasks.
A conversation within one task is finished there. One that crosses a border
comes in pieces: a piece is searched from every state it may be entered in, and
the pieces' least costs and orders, a few numbers each, are put together per
conversation; then every piece applies the edits chosen for it. Repeated rows
are counted within a batch before they are sent, and one run of them is one step.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import BLANKS, cut

# Costs and role names of the edits (fixed by the operator's contract).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
END_MARKS = ".!?"

# States of the pattern: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}       # the role of an inserted or rerole row
# What it costs at most to do from a state (row) whatever may follow in another (column): inserts that lead there, or,
# for START, the deletion of the one row with s that only START can keep.
STAND_IN = ((0, 0, 3, 6), (6, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}                 # inserts that complete the pattern

HEAD_CHARS = 64          # of a text, for the borders of ranges only
FLUSH_BYTES = 1 << 20    # of repaired rows that a task holds before it passes them on
SLICE_ROWS = 256


def _moved(state: int) -> int:
    return AFTER[state, WANTED[state]]


@lru_cache(maxsize=None)
def _moves(initial: str, truncated: bool) -> tuple:
    """(entry, exit, cost, edits) of a row that need not go. Inserts before a deletion only come later in order."""
    found = [(s, s, DELETE, "D") for s in STATES]
    extra = TRUNCATED if truncated else 0
    for entry in STATES:
        at, edits, cost = entry, "", extra
        for _ in range(3):
            found.append((entry, _moved(at), cost + REROLE, edits + "R"))
            if (at, initial) in AFTER:
                found.append((entry, AFTER[at, initial], cost, edits + "K"))
            at, edits, cost = _moved(at), edits + "I", cost + INSERT
    return tuple(found)


@lru_cache(maxsize=1 << 16)
def _step(costs: tuple, ranks: tuple, initial: str, truncated: bool):
    """(added to all costs, costs, ranks, ((exit, entry, edits), ...)) after a row; costs are relative to the least."""
    best: dict[int, tuple] = {}
    for entry, leave, cost, edits in _moves(initial, truncated):
        if costs[entry] is not None:
            offer = (costs[entry] + cost, ranks[entry], edits, entry)
            if leave not in best or offer < best[leave]:
                best[leave] = offer
    # a survivor that another can stand in for at a lower cost is on no cheapest path, nor tied with one
    best = {s: offer for s, offer in best.items() if all(best[x][0] + STAND_IN[x][s] >= offer[0] for x in best)}
    least = min(offer[0] for offer in best.values())
    order = {leave: rank for rank, leave in enumerate(sorted(best, key=lambda x: best[x][1:3]))}
    return (least, tuple(best[s][0] - least if s in best else None for s in STATES), tuple(order.get(s, 0) for s in STATES),
            tuple((s, best[s][3], best[s][2]) for s in sorted(best)))


class Node:
    """An edit of one row in the tree of backpointers; it lives while it has children or is a survivor."""

    __slots__ = ("children", "edits", "parent", "state")

    def __init__(self, edits: str, parent: Node | None, state: int):
        self.edits, self.parent, self.state, self.children = edits, parent, state, []
        if parent is not None:
            parent.children.append(self)


class Search:
    """Survivors of a piece of a conversation entered in one state."""

    def __init__(self, entry: int):
        self.base, self.costs, self.ranks = 0, tuple(0 if s == entry else None for s in STATES), (0, 0, 0, 0)
        self.root = Node("", None, entry)
        self.survivors: dict[int, Node] = {entry: self.root}

    def row(self, initial: str, truncated: bool) -> list[str]:
        """The edits on which all survivors agree now, in order, one for each row or run that is resolved."""
        added, self.costs, self.ranks, back = _step(self.costs, self.ranks, initial, truncated)
        self.base += added
        return self._grow(back)

    def forced(self, copies: int) -> list[str]:
        """Rows that have to go."""
        self.base += DELETE * copies
        return self._grow(tuple((s, s, "D" * copies) for s in self.survivors))

    def _grow(self, back: tuple) -> list[str]:
        old = self.survivors
        self.survivors = {leave: Node(edits, old[entry], leave) for leave, entry, edits in back}
        for node in old.values():
            while node.parent is not None and not node.children:          # nobody descends from it any more
                node.parent.children.remove(node)
                node = node.parent
        emitted = []
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            emitted.append(self.root.edits)
        return emitted

    def unresolved(self, state: int) -> list[str]:
        """The edits of a survivor that are not emitted yet."""
        out, node = [], self.survivors[state]
        while node is not self.root:
            out.append(node.edits)
            node = node.parent
        return out[::-1]

    def exits(self) -> list[tuple[int, int, int, str]]:
        """(state, cost, rank, unresolved edits) of the survivors."""
        return [(s, self.base + self.costs[s], self.ranks[s], "".join(self.unresolved(s))) for s in sorted(self.survivors)]


def chosen_exit(exits) -> int:
    """The exit that is best once its tail is inserted; exits are (state, cost, rank, ...)."""
    return min(exits, key=lambda e: (e[1] + INSERT * TAIL[e[0]], e[2]))[0]


class Message(NamedTuple):
    """A row as it waits for its edit; a run of rows that have to go has no texts."""

    seq: int
    role: str | None
    text: str | None
    copies: int


def repaired(state: int, edits: str, role: str | None, text: str | None) -> tuple[int, list[tuple[str, str, str]]]:
    """(state, (edit, role, text) of the rows that the edits of one row leave)."""
    out = []
    for edit in edits:
        if edit == "K":
            out.append((edit, role, text))
            state = AFTER[state, role[:1]]
        elif edit != "D":
            out.append((edit, NAMES[WANTED[state]], text if edit == "R" else ""))
            state = _moved(state)
    return state, out


class Transcript:
    """Running digest of repaired rows, one `role:text` a line."""

    def __init__(self):
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1


class Counts:
    """Faults and turns of a run of rows; those of neighbouring runs can be joined."""

    FAULTS = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self, saved: dict | None = None):
        self.n = dict.fromkeys(self.FAULTS, 0)
        self.first = self.last = self.low = self.high = None     # initials and turns at the ends
        self.turns = 0
        if saved:
            self.__dict__.update(saved)

    def join(self, other: Counts) -> None:
        for fault, n in other.n.items():
            self.n[fault] += n
        if self.last is not None and other.first is not None:
            self.n["illegal"] += self.last + other.first not in LEGAL
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last
        self.turns += other.turns - (other.low is not None and other.low == self.high)
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high

    def add(self, turn: int | None, initial: str, copies: int, fault: str | None) -> None:
        one = Counts()
        one.n["illegal"] = copies - 1                              # equal neighbours are never legal
        if fault:
            one.n[fault] = copies if fault != "truncated" else 1
        if fault in (None, "truncated"):
            one.n["duplicate"] += copies - 1
        one.first = one.last = initial
        one.low = one.high = turn
        one.turns = int(turn is not None)
        self.join(one)

    def result(self) -> dict:
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return {"gaps": gaps, **self.n}


_OUT = ("kind string, conv_id long, part int, seq long, sub int, edit string, role string, text string, copies long, fate string, "
        "detail string")
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
_FIELDS = [(f.split()[0], _TYPES[f.split()[1]]) for f in _OUT.split(", ")]


class _Rows:
    """Rows to pass on, given by name, as batches of bounded size."""

    def __init__(self, fields=_FIELDS):
        self.fields, self.rows, self.size = fields, [], 0

    def add(self, **row) -> None:
        self.rows.append(row)
        self.size += 64 + len(row.get("text") or "") + len(row.get("detail") or "")

    def batches(self, least: int = FLUSH_BYTES):
        if self.rows and self.size >= least:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in self.rows], t) for n, t in self.fields],
                                             [n for n, _ in self.fields])
            self.rows, self.size = [], 0


class _Piece:
    """The rows of one conversation within one task."""

    def __init__(self, conv_id: int | None, part: int, whole: bool, out: _Rows):
        self.conv_id, self.part, self.whole, self.out = conv_id, part, whole, out
        self.searches = {s: Search(s) for s in ((START,) if whole else STATES)}
        self.emitted = {s: [] for s in self.searches}
        self.counts, self.waiting, self.transcript, self.seq, self.state = Counts(), deque(), Transcript(), 0, START

    def _pass(self, kind: str, **row) -> None:
        self.out.add(kind=kind, conv_id=self.conv_id, part=self.part, **row)

    def _resolve(self, edits: list[str]) -> None:
        for one in edits:
            message = self.waiting.popleft()
            self.state, rows = repaired(self.state, one, message.role, message.text)
            for sub, (edit, role, text) in enumerate(rows):
                self.transcript.add(role, text)
                self._pass("message", seq=message.seq, sub=sub, edit=edit, role=role, text=text)

    def _search(self, message: Message, step) -> None:
        if self.whole:
            self.waiting.append(message)
        else:
            self._pass("held", seq=message.seq, role=message.role, text=message.text, copies=message.copies)
        for entry, search in self.searches.items():
            edits = step(search)
            self.emitted[entry] += edits
            if self.whole:
                self._resolve(edits)

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: str | None) -> None:
        self.counts.add(turn, role[:1], copies, fault)
        if fault in (None, "truncated"):
            self._search(Message(self.seq, role, text, 1), lambda s: s.row(role[:1] if role[:1] in ("s", "u", "a") else "", fault is not None))
            copies, self.seq = copies - 1, self.seq + 1
        if copies:
            self._search(Message(self.seq, None, None, copies), lambda s: s.forced(copies))
            self.seq += 1

    def close(self, more: bool) -> None:
        """Finish the conversation, or, if ``more`` of it may lie beyond the borders of the task, describe this piece."""
        if self.whole and not more:
            search = self.searches[START]
            exits = search.exits()
            last = chosen_exit(exits)
            audit = "".join(self.emitted[START] + search.unresolved(last)) + "I" * TAIL[last]
            cost = next(e[1] for e in exits if e[0] == last) + INSERT * TAIL[last]
            self._resolve(search.unresolved(last))
            _, rows = repaired(self.state, "I" * TAIL[last], None, None)
            for sub, (edit, role, text) in enumerate(rows):
                self.transcript.add(role, text)
                self._pass("message", seq=self.seq, sub=sub, edit=edit, role=role, text=text)
            detail = {**self.counts.result(), "cost": cost, "audit": audit, "repaired_sha256": self.transcript.sha.hexdigest()}
            self._pass("whole", detail=json.dumps(detail))
            return
        for message in self.waiting:
            self._pass("held", seq=message.seq, role=message.role, text=message.text, copies=message.copies)
        entries = {}
        for entry, search in self.searches.items():
            # a piece entered in a known state has applied what it emitted; "held" rows go on from there
            done = "".join(self.emitted[entry])
            entries[entry] = {"exits": [e[:3] for e in search.exits()]}
            for state, _, _, rest in search.exits():
                self._pass("audit", seq=-1, fate=f"{entry}{state}", text=done + rest,
                           detail=json.dumps({"skip": len(done) if self.whole else 0, "state": self.state if self.whole else entry,
                                              "rows": self.seq}))
        self._pass("piece", detail=json.dumps({"counts": vars(self.counts), "entries": entries}))


def _combined(batches):
    """Equal rows of a batch as one row with their number."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        names = rows.column_names
        counted = rows.group_by(names).aggregate([([], "count_all")])
        yield from counted.select([*names, "count_all"]).rename_columns([*names, "copies"]).combine_chunks().to_batches()


def _walk(batches):
    """Searches the sorted rows of a task; the first and the last conversation of a task may be pieces."""
    from pyspark import TaskContext

    part, out, piece, begun = TaskContext.get().partitionId(), _Rows(), None, False
    place, marked, run = None, set(), None            # a run is [turn, role, text, copies, blank, truncated]

    def settle():
        if run is not None:
            turn, role, text, copies, blank, truncated = run
            if blank:
                fault = "blank"
            elif marked and hashlib.md5(text.encode()).hexdigest() in marked:
                fault = "duplicate"
            else:
                fault = "truncated" if truncated else None
            piece.add(turn, role, text, copies, fault)

    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            for conv_id, turn, role, _, text, blank, truncated, copies, digest in zip(
                    *(c.to_pylist() for c in batch.slice(first, SLICE_ROWS).columns), strict=True):
                if digest is None and run is not None and place == (conv_id, turn, role) and run[2] == text:
                    run[3] += copies
                    continue
                if place != (conv_id, turn, role):
                    settle()
                    run, marked = None, set()
                    if piece is None or piece.conv_id != conv_id:
                        if piece is not None:
                            piece.close(more=False)
                        piece, begun = _Piece(conv_id, part, begun, out), True
                    place = (conv_id, turn, role)
                if digest is not None:
                    marked.add(digest)
                    continue
                settle()
                run = [turn, role, text, copies, blank, truncated]
                yield from out.batches()
    settle()
    if piece is not None:
        piece.close(more=True)
    yield from out.batches(0)


_PLAN = "conv_id long, part int, fate string, tail int, final boolean, detail string"


def _put_together(table: pa.Table) -> pa.Table:
    """The entry and exit of each piece of a conversation, with its counts and cost on the last one."""
    order = sorted(range(len(table)), key=lambda i: table.column("part")[i].as_py())
    parts = [table.column("part")[i].as_py() for i in order]
    pieces = [json.loads(table.column("detail")[i].as_py()) for i in order]
    survivors, counts, back = {START: (0, 0)}, Counts(), []
    for piece in pieces:
        counts.join(Counts(piece["counts"]))
        best: dict[int, tuple] = {}
        for entry, (cost, rank) in survivors.items():
            for leave, more, inner in piece["entries"][str(entry)]["exits"]:
                offer = (cost + more, rank, inner, entry)
                if leave not in best or offer < best[leave]:
                    best[leave] = offer
        ranks = {leave: rank for rank, leave in enumerate(sorted(best, key=lambda x: best[x][1:3]))}
        survivors = {leave: (offer[0], ranks[leave]) for leave, offer in best.items()}
        back.append({leave: offer[3] for leave, offer in best.items()})
    at = chosen_exit([(s, *v) for s, v in survivors.items()])
    detail = json.dumps({**counts.result(), "cost": survivors[at][0] + INSERT * TAIL[at]})
    rows, tail = [], TAIL[at]
    for i in range(len(pieces) - 1, -1, -1):
        last = i == len(pieces) - 1
        rows.append((table.column("conv_id")[0].as_py(), parts[i], f"{back[i][at]}{at}", tail if last else 0, last, detail if last else None))
        at = back[i][at]
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _PLAN.split(", ")])


_MESSAGE = "conv_id long, part int, seq long, sub int, edit string, role string, text string"
_MESSAGE_FIELDS = [(f.split()[0], _TYPES[f.split()[1]]) for f in _MESSAGE.split(", ")]


def _apply(batches):
    """The held rows of pieces, repaired; a piece's audit comes before its rows."""
    out, key, audit, state, tail, at, end_seq = _Rows(_MESSAGE_FIELDS), None, "", START, 0, 0, 0

    def finish():
        if key is not None:
            for sub, (edit, role, text) in enumerate(repaired(state, "I" * tail, None, None)[1]):
                out.add(conv_id=key[0], part=key[1], seq=end_seq, sub=sub, edit=edit, role=role, text=text)

    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            for conv_id, part, seq, role, text, copies, inserts, detail in zip(
                    *(c.to_pylist() for c in batch.slice(first, SLICE_ROWS).columns), strict=True):
                if seq < 0:
                    finish()
                    given = json.loads(detail)
                    key, audit, tail, state, at, end_seq = (conv_id, part), text, inserts, given["state"], given["skip"], given["rows"]
                    continue
                end = at
                if role is None:
                    end += copies
                else:
                    while audit[end] == "I":
                        end += 1
                    end += 1
                state, rows = repaired(state, audit[at:end], role, text)
                at = end
                for sub, (edit, new_role, new_text) in enumerate(rows):
                    out.add(conv_id=conv_id, part=part, seq=seq, sub=sub, edit=edit, role=new_role, text=new_text)
            yield from out.batches()
    finish()
    yield from out.batches(0)


def _digest(batches):
    """(conv_id, digest) of repaired rows that come in order."""
    done, key, transcript = [], None, None
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.slice(first, SLICE_ROWS).columns), strict=True):
                if transcript is None or conv_id != key:
                    if transcript is not None:
                        done.append((key, transcript.sha.hexdigest()))
                    key, transcript = conv_id, Transcript()
                transcript.add(role, text)
    if transcript is not None:
        done.append((key, transcript.sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                                     ["conv_id", "repaired_sha256"])


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNT_NAMES = [f.split()[0] for f in _COUNTS.split(", ")]


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows by range and order, with a mark before each place that holds a text its conversation had at an earlier turn."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    bare = F.rtrim(text, F.lit(BLANKS))
    slim = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"),
                       (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*END_MARKS)).alias("truncated")) \
        .select("conv_id", "turn", "role", F.substring("text", 1, HEAD_CHARS).alias("head"), "text", "blank", "truncated")
    kinds = "conv_id long, turn long, role string, head string, text string, blank boolean, truncated boolean"
    body = slim.mapInArrow(_combined, f"{kinds}, copies long").withColumn("digest", F.lit(None).cast("string"))
    places = slim.filter("NOT blank").groupBy("conv_id", "role", F.md5(F.col("text").cast("binary")).alias("digest"), "turn") \
        .agg(F.min("head").alias("head"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = places.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), F.col("least.turn").alias("_turn"))
    again = places.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
                        & (F.col("digest") == F.col("_digest"))).filter(~F.col("turn").eqNullSafe(F.col("_turn")))
    marks = again.select("conv_id", "turn", "role", "head", F.lit(None).cast("string").alias("text"), F.lit(False).alias("blank"),
                         F.lit(False).alias("truncated"), F.lit(0).cast("long").alias("copies"), "digest")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return body.unionByName(marks).repartitionByRange(parts, "conv_id", "turn", "role", "head") \
        .sortWithinPartitions("conv_id", "turn", "role", F.col("digest").asc_nulls_last(), "text")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, messages) of rows (conv_id, turn, role, text).

    Conversations have conv_id, gaps (missing turns between the least and the
    greatest), the numbers of blank, duplicate, truncated rows (a row's first
    fault counts) and illegal neighbours, the cost and the audit (initials of
    the edits: Keep, Rerole, Delete, Insert) and the SHA-256 of the repaired
    rows as `role:text` lines. Messages are the repaired rows: conv_id, (part,
    seq, sub) by which they are ordered, edit, role and text.

    A null role or text is one space, a null turn comes first, a null conv_id
    is a conversation of its own. Rows of one turn are ordered by role and text,
    so repeated rows are neighbours. Other columns are not read. The digest of
    a conversation that crosses the borders of tasks is taken by one task that
    reads its repaired rows as a stream, as SHA-256 has no other order.
    """
    found = cut(_sorted_rows(rows).mapInArrow(_walk, _OUT), "conversations")
    key = ["conv_id", "part"]
    plans = cut(found.filter("kind = 'piece'").select(*key, "detail").groupBy("conv_id")
                .applyInArrow(lambda table: _put_together(table), _PLAN), "conversation-pieces")
    # plans and pieces have two rows for each task of the walk at most
    chosen = plans.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("fate").alias("_fate"), "tail")
    audits = found.filter("kind = 'audit'").join(F.broadcast(chosen), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
                                                 & (F.col("fate") == F.col("_fate"))).select(*found.columns, "tail")
    given = audits.unionByName(found.filter("kind = 'held'").withColumn("tail", F.lit(0)))
    applied = cut(given.select(*key, "seq", "role", "text", "copies", "tail", "detail").repartition(*key).sortWithinPartitions(*key, "seq")
                  .mapInArrow(_apply, _MESSAGE), "conversation-messages")
    direct = found.filter("kind = 'message'").select(*[n for n, _ in _MESSAGE_FIELDS])
    messages = direct.unionByName(applied)
    crossing = plans.filter("final").select(F.col("conv_id").alias("_conv"), F.col("detail").alias("_detail"))
    of_crossing = messages.join(F.broadcast(crossing.select("_conv")), F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    digests = of_crossing.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", "sub").select("conv_id", "role", "text") \
        .mapInArrow(_digest, "conv_id long, repaired_sha256 string").select(F.col("conv_id").alias("_sha_conv"), "repaired_sha256")
    joined = audits.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "")
                                           .alias("edits"), F.max("tail").alias("tail"))
    counts = F.from_json("_detail", _COUNTS)
    crossed = crossing.join(joined, F.col("conv_id").eqNullSafe(F.col("_conv")), "left") \
        .join(digests, F.col("_conv").eqNullSafe(F.col("_sha_conv")), "left").withColumn("c", counts) \
        .select(F.col("_conv").alias("conv_id"), *[f"c.{n}" for n in _COUNT_NAMES[:-2]],
                F.concat(F.col("edits"), F.repeat(F.lit("I"), F.col("tail"))).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    whole = found.filter("kind = 'whole'").withColumn("c", F.from_json("detail", _COUNTS)).select("conv_id", "c.*")
    return whole.unionByName(crossed), messages


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that crc32 of `conv_id:turn` (nulls: one space) modulo 20 gives them."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(named.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    changed = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).filter("fault <> 0")
    return changed.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", END_MARKS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of damaged conversations: one row for every conv_id, also if no row of it is left."""
    found, _ = repair(damage(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("_every")).distinct()
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left") \
        .select(F.col("_every").alias("conv_id"), *[F.coalesce(F.col(n), empty.get(n, F.lit(0).cast("long"))).alias(n) for n in _COUNT_NAMES])
