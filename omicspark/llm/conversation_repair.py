"""Repair of conversations: the cheapest edits that give turns a legal order, by Viterbi with coalescing survivors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Costs of the edits, and what a kept or reroled truncated row adds. Fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States after a part of ``(s?(ua)+)?``; the empty one and those after an assistant may be the last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: ``(p, q)``: at most so much more does it cost to go on from p as one can from q. Beyond it, a survivor in q cannot win.
MARGINS = {
    (EMPTY, SYSTEM): 0, (EMPTY, ASSISTANT): 0, (EMPTY, USER): INSERT, (SYSTEM, USER): INSERT, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
    (USER, ASSISTANT): INSERT, (USER, SYSTEM): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT, (SYSTEM, EMPTY): max(2 * INSERT, DELETE),
    (ASSISTANT, EMPTY): DELETE, (USER, EMPTY): INSERT + DELETE,
}


class Node:
    """An edit in the tree of back pointers; ``held`` survivors end in it and ``children`` go on from it.

    ``base`` and ``tail`` say it once more from the last row on: the survivor it comes from and the edits since.
    """

    __slots__ = ("parent", "edit", "role", "text", "children", "held", "cost", "base", "tail")

    def __init__(self, parent: Node | None, edit: str, role: str | None, text: str | None, cost: int, base: int = EMPTY, tail: str = ""):
        self.parent, self.edit, self.role, self.text, self.cost, self.base, self.tail = parent, edit, role, text, cost, base, tail
        self.children, self.held = [], 0
        if parent:
            parent.children.append(self)


def release(node: Node) -> None:
    """Take a node without survivors and children out of the tree, and its parents as far as that leaves them so."""
    while node.parent and not node.held and not node.children:
        node.parent.children.remove(node)
        node = node.parent


class Survivors:
    """The best edits to each state, as leaves of one tree whose resolved beginning has been handed on.

    How the whole unresolved suffixes of any two survivors compare is known from the row before and what was added since, so a tie
    costs no walk back: ``order`` is ``<`` or ``>`` or, where one begins the other, by how many inserted rows it is longer.
    """

    def __init__(self) -> None:
        self.root = Node(None, "", None, None, 0)
        self.root.held = 1
        self.last, self.order = {EMPTY: self.root}, {}
        self._insert()
        self._settle()

    def _compare(self, a: int, a_tail: str, b: int, b_tail: str) -> str | int:
        k = 0 if a == b else self.order[a, b]
        if isinstance(k, str):
            return k
        a_tail, b_tail = "I" * -k + a_tail, "I" * k + b_tail
        if a_tail.startswith(b_tail) or b_tail.startswith(a_tail):
            return len(b_tail) - len(a_tail)
        return "<" if a_tail < b_tail else ">"

    def _settle(self) -> None:
        """Compare all survivors, and start their tails anew."""
        self.order = {(p, q): self._compare(a.base, a.tail, b.base, b.tail) for p, a in self.last.items() for q, b in self.last.items() if p != q}
        for state, node in self.last.items():
            node.base, node.tail = state, ""

    def _take(self, state: int, node: Node) -> None:
        node.held += 1
        old = self.last.get(state)
        self.last[state] = node
        if old:
            old.held -= 1
            release(old)

    def _insert(self) -> None:
        for state, role in ((EMPTY, "user"), (SYSTEM, "user"), (ASSISTANT, "user"), (USER, "assistant")):
            if state in self.last:
                node, to = self.last[state], NEXT[state, role[0]]
                cost, old, tail = node.cost + INSERT, self.last.get(to), node.tail + "I"
                if old is None or cost < old.cost or cost == old.cost and self._compare(node.base, tail, old.base, old.tail) == "<":
                    self._take(to, Node(node, "I", role, "", cost, node.base, tail))

    def row(self, role: str, text: str, fault: str) -> Iterator[Node]:
        """Go on by a row; edits that all survivors share are handed out."""
        best: dict[int, tuple] = {}

        def offer(to: int | None, state: int, cost: int, edit: str, new_role: str | None) -> None:
            if to is not None:
                old = best.get(to)
                if old is None or cost < old[1] or cost == old[1] and self._compare(state, edit, old[0], old[2]) == "<":
                    best[to] = (state, cost, edit, new_role)

        extra = TRUNCATED if fault == "truncated" else 0
        for state, node in self.last.items():
            offer(state, state, node.cost + DELETE, "D", None)
            if fault in ("", "truncated"):
                offer(NEXT.get((state, role[:1])), state, node.cost + extra, "K", role)
                for other in ("user", "assistant"):
                    offer(NEXT.get((state, other[0])), state, node.cost + REROLE + extra, "R", other)
        before, self.last = self.last, {}
        for to, (state, cost, edit, new_role) in best.items():
            self._take(to, Node(before[state], edit, new_role, text if new_role is not None else None, cost, state, edit))
        for node in before.values():
            node.held -= 1
            release(node)
        self._insert()
        costs = {state: node.cost for state, node in self.last.items()}
        for state in costs:
            if any((other, state) in MARGINS and cost + MARGINS[other, state] < costs[state] for other, cost in costs.items()):
                node = self.last.pop(state)
                node.held -= 1
                release(node)
        self._settle()
        while not self.root.held and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield self.root

    def end(self) -> tuple[int, list[Node]]:
        """The cost of the best whole sequence and its edits not yet handed out."""
        final = [s for s in (EMPTY, ASSISTANT) if s in self.last]
        best = final[0]
        for state in final[1:]:
            cost, least = self.last[state].cost, self.last[best].cost
            if cost < least or cost == least and self.order[state, best] == "<":
                best = state
        node, rest = self.last[best], []
        cost = node.cost
        while node is not self.root:
            rest.append(node)
            node = node.parent
        return cost, rest[::-1]


def fault_of(text: str, again: bool) -> str:
    last = text.rstrip(BLANKS)[-1:]
    return "blank" if not last else "duplicate" if again else "" if last in ENDS else "truncated"


def repair(rows: Iterator[tuple]) -> Iterator[Node | dict]:
    """The edits of one conversation as they are resolved, and at the end what was counted.

    ``rows`` are ``(turn, role, text, again)`` in order. What is held are the edits not yet resolved; nothing else grows with the rows. Most are
    resolved within a few rows. Where the end decides over the beginning, as in a run of rows that all have to be given roles and whose number may turn out odd,
    the edits of that run wait for it.
    """
    found = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    survivors, least, most, turns, before = Survivors(), None, None, 0, None
    for turn, role, text, again in rows:
        fault = fault_of(text, again)
        if fault:
            found[fault] += 1
        if turn is not None:
            least = turn if least is None else least
            turns += turn != most
            most = turn
        found["illegal"] += before is not None and before + role[:1] not in ("su", "ua", "au")
        before = role[:1]
        yield from survivors.row(role, text, fault)
    found["cost"], rest = survivors.end()
    yield from rest
    yield {"gaps": 0 if least is None else most - least + 1 - turns, **found}


def _in_order(conversations: DataFrame) -> DataFrame:
    """Rows by conversation, in order, in one task each; ``again`` where role and text were there before."""
    have = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    present = F.col("present") if "present" in conversations.columns else F.lit(True)
    rows = conversations.select("conv_id", "turn", have("role"), have("text"), present.alias("present")).withColumn("mark", F.xxhash64("role", "text"))
    same = Window.partitionBy("conv_id", "present", "mark", "role", "text").orderBy("turn")
    rows = rows.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    return rows.select("conv_id", "present", "turn", "role", "text", "again").sortWithinPartitions("conv_id", "turn", "role", "text", "again")


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    flat = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for conv_id, rows in groupby(flat, itemgetter(0)):
        yield conv_id, (r[2:] for r in rows if r[1])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _written(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_summary(conversations: DataFrame) -> DataFrame:
    """Per conversation of ``conversations(conv_id, turn, role, text)``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn, nulls first, rows of one turn by role and text. The first fault of a row counts: blank, duplicate (role and text were there before), truncated
    (the last character that is not blank is none of ``.!?``). Keeping a row costs nothing, another role 3, deleting 4, inserting an empty
    row 3, and a truncated row that stays 3; blank and duplicate rows are deleted. ``audit`` has the initials of the cheapest
    edits that leave role initials of the form ``(s?(ua)+)?``, of equal ones the least in ASCII order.

    A Viterbi search keeps one survivor per state. Their edits form a tree; once all survivors share an edit it is handed on and leaves memory, so a long
    conversation needs only its unresolved end. Survivors that cost more than any way on can make up go. Conversations are dealt to tasks by id; as a digest
    of a conversation has to see its rows in order, one conversation is one task's work, in bounded memory.

    A null role or text counts as one space, a null id is a conversation. Where a column ``present`` is false a row only names its conversation;
    one without other rows has zeros, no edits and the digest of nothing. Other columns are ignored; an empty table gives an empty result.
    """
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, rows in _by_conversation(batches):
            digest, audit, empty = hashlib.sha256(), [], True
            for x in repair(rows):
                if isinstance(x, dict):
                    yield conv_id, *(x[c] for c in COUNTS), "".join(audit), digest.hexdigest()
                else:
                    audit.append(x.edit)
                    if x.role is not None:
                        digest.update(f"{'' if empty else chr(10)}{x.role}:{x.text}".encode())
                        empty = False

    made = "conv_id bigint, " + "".join(f"{c} bigint, " for c in COUNTS) + "audit string, repaired_sha256 string"
    return _in_order(conversations).mapInArrow(lambda batches: _written(summaries(batches), schema), made)


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The rows of every conversation after the edits of ``repair_summary``: ``conv_id, place, edit, role, text``, deleted rows left out."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, rows in _by_conversation(batches):
            edits = (x for x in repair(rows) if not isinstance(x, dict) and x.role is not None)
            for place, x in enumerate(edits):
                yield conv_id, place, {"K": "keep", "R": "rerole", "I": "insert"}[x.edit], x.role, x.text

    return _in_order(conversations).mapInArrow(lambda batches: _written(kept(batches), schema), "conv_id bigint, place bigint, edit string, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with known faults, by crc32 of ``conv_id:turn`` mod 20: 0 drops a row (``present`` is false), 1 empties its text, 2 takes its
    ``.!?``, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    have = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(have("conv_id"), F.lit(":"), have("turn"))) % 20
    text = F.when(case == 1, "").when(case == 2, F.translate(have("text"), ENDS, "")).otherwise(have("text"))
    role = F.when(case == 4, "user").otherwise(have("role"))
    times = F.when(case == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (case != 0).alias("present"), F.explode(times).alias("__copy")).drop("__copy")
