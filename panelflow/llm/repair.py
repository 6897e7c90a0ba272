"""Conversation structure repair: the cheapest edits to a legal sequence of roles, by a survivor-coalescence Viterbi search.

A legal conversation is empty, or an optional system turn followed by pairs of user and assistant. A
search over its four states reads a conversation's turns once, in order. Each state keeps one survivor,
a node of a tree of back pointers whose nodes count their live children. A node without any is given up, and so
are its parents in turn; when the oldest node has one live child left, all survivors share that child, its edits are
certain, and they are emitted and forgotten. So memory holds only the unresolved suffix, whatever the length
of the conversation. Two equally cheap ways into a state are told apart by the whole of their unresolved suffixes.

A survivor is also given up when another one can take over at less cost (`BRIDGE`); without that, the state in
which everything was deleted would live to the end and nothing would ever be certain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.llm.base import small_batches

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits; TRUNCATED is added for a truncated turn that is not deleted.
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: Nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a kept turn, by its role's first character.
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that a rerole or an insert gives in a state, and the state after it.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ENDS = (START, ASSISTANT)
#: BRIDGE[a][b]: finishing from state a never costs more than finishing from b plus this.
BRIDGE = {
    START: {SYSTEM: 0, USER: 5, ASSISTANT: 0},
    SYSTEM: {START: 10, USER: 5, ASSISTANT: 10},
    USER: {START: 7, SYSTEM: 5, ASSISTANT: 5},
    ASSISTANT: {START: 2, SYSTEM: 0, USER: 5},
}
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = " \t\n\v\f\r"
STOPS = ".!?"


class Node:
    """The edits of one turn (inserts before it, then its own) on one survivor's way."""

    __slots__ = ("live", "out", "parent", "piece", "tip")

    def __init__(self, parent: Node | None, piece: str, out: tuple) -> None:
        self.parent, self.piece, self.out = parent, piece, out
        self.live: list[Node] = []
        self.tip = True


def _inserts(state: int, most: int = 2) -> Iterator[tuple[int, int, str, tuple]]:
    """(state, cost, audit, edits) after up to `most` inserts; more only lead back to a state at more cost."""
    cost, audit, out = 0, "", ()
    yield state, cost, audit, out
    for _ in range(most):
        role, state = NEXT[state]
        cost, audit, out = cost + COST[INSERT], audit + INSERT, (*out, (INSERT, role, ""))
        yield state, cost, audit, out


#: All ways to insert before a turn or at the end.
INSERTS = {s: list(_inserts(s)) for s in NEXT}


class Search:
    """Edits of one conversation; `step` and `finish` return those that have become certain."""

    def __init__(self) -> None:
        self.root = Node(None, "", ())
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.cost: int | None = None
        self.most_nodes = 0

    @staticmethod
    def _less(p: Node, x: str, q: Node, y: str) -> bool:
        """Whether the way over p and then x is before the one over q and then y, back to where they part."""
        a, b = [x], [y]
        while p is not q:
            a.append(p.piece)
            b.append(q.piece)
            p, q = p.parent, q.parent
        return "".join(reversed(a)) < "".join(reversed(b))

    def _offer(self, found: dict, state: int, cost: int, node: Node, piece: str, out: tuple) -> None:
        held = found.get(state)
        if held is None or cost < held[0] or (cost == held[0] and self._less(node, piece, held[1], held[2])):
            found[state] = (cost, node, piece, out)

    def step(self, role: str, text: str, must_go: bool, truncated: bool) -> list[tuple]:
        """Read a turn. Deletes come before inserts, which order equal audits need: D is less than I."""
        found: dict[int, tuple] = {}
        initial, extra = role[:1], TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + COST[DELETE], node, DELETE, ((DELETE, role, text),))
            if must_go:
                continue
            for at, more, audit, out in INSERTS[state]:
                kept = AFTER[at].get(initial)
                if kept is not None:
                    self._offer(found, kept, cost + more + extra, node, audit + KEEP, (*out, (KEEP, role, text)))
                new, after = NEXT[at]
                if new != role:
                    total = cost + more + extra + COST[REROLE]
                    self._offer(found, after, total, node, audit + REROLE, (*out, (REROLE, new, text)))
        costs = {s: f[0] for s, f in found.items()}
        before = [n for _, n in self.best.values()]
        self.best = {}
        for s, (cost, node, piece, out) in found.items():
            if any(t != s and cost > c + BRIDGE[t][s] for t, c in costs.items()):
                continue
            child = Node(node, piece, out)
            node.live.append(child)
            self.best[s] = (cost, child)
        for node in before:
            node.tip = False
            self._release(node)
        return self._settled()

    def _release(self, node: Node) -> None:
        while not node.live and not node.tip and node is not self.root:
            parent = node.parent
            parent.live.remove(node)
            node = parent

    def _settled(self) -> list[tuple]:
        out: list[tuple] = []
        while len(self.root.live) == 1:
            child = self.root.live[0]
            out.extend(child.out)
            child.parent, child.out, child.piece = None, (), ""
            self.root = child
        return out

    def finish(self) -> list[tuple]:
        """The rest of the cheapest way to a legal end, of equal ones that with the least audit."""
        found: dict[int, tuple] = {}
        for state, (cost, node) in self.best.items():
            for at, more, audit, out in INSERTS[state]:
                if at in ENDS:
                    self._offer(found, 0, cost + more, node, audit, out)
        self.cost, node, _, last = found[0]
        parts = [last]
        while node is not self.root:
            parts.append(node.out)
            node = node.parent
        return [e for out in reversed(parts) for e in out]

    def held(self) -> int:
        """Nodes of the unresolved tree."""
        n, stack = 0, [self.root]
        while stack:
            node = stack.pop()
            n += 1
            stack.extend(node.live)
        return n


class Conversation:
    """Faults and edits of one conversation whose turns are read in order."""

    def __init__(self) -> None:
        self.search = Search()
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def read(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> Iterator[tuple]:
        """`copies` equal turns; `seen` if an earlier turn number has the same role and text."""
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.turns += 1
        kept = text.rstrip(SPACE)
        initial = role[:1]
        for i in range(copies):
            if self.before is not None and self.before + initial not in LEGAL_PAIRS:
                self.illegal += 1
            self.before = initial
            again = seen or i > 0
            cut = bool(kept) and not again and kept[-1] not in STOPS
            self.blank += not kept
            self.duplicate += bool(kept) and again
            self.truncated += cut
            yield from self.search.step(role, text, not kept or again, cut)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def fingerprint(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def _fingerprint(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal turns of a batch as one row, so that very many copies shrink before the shuffle."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["id", "turn", "role", "text"]).aggregate([("copies", "sum")])
        t = t.rename_columns([c.removesuffix("_sum") for c in t.column_names]).select(["id", "turn", "role", "text", "copies"])
        yield from t.to_batches()


def _prepared(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies: Column | None) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    n = (F.lit(1) if copies is None else copies).cast("long")
    return rows.select(
        F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"), n.alias("copies")
    )


def in_order(rows: DataFrame) -> DataFrame:
    """(id, turn, role, text, copies, mark): each conversation in one partition and in order.

    A row with a `mark` goes before the turn's own rows: it tells the fingerprint of a role and text that an earlier turn
    has, so the task that reads the conversation holds no set of all its texts.
    """
    kind = rows.schema["id"].dataType.simpleString()
    each = rows.filter("copies > 0").select("id", "turn", fingerprint(F.col("role"), F.col("text")).alias("mark"))
    place = F.struct("turn")  # nulls first
    first = each.groupBy("id", "mark").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last")
    first = first.select(F.col("id").alias("id_"), F.col("mark").alias("mark_"), "first")
    same = (F.col("mark") == F.col("mark_")) & F.col("id").eqNullSafe(F.col("id_"))
    late = each.join(first, same).filter(place > F.col("first")).select("id", "turn", "mark").distinct()
    none = F.lit(None).cast("string")
    marks = late.select("id", "turn", F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), "mark")
    small = F.when(F.col("copies") > 0, F.col("text")).otherwise("")
    turns = rows.withColumn("text", small).mapInArrow(_folded, f"id {kind}, turn bigint, role string, text string, copies bigint")
    both = turns.withColumn("mark", none).unionByName(marks)
    return both.repartition("id").sortWithinPartitions("id", F.col("turn").asc_nulls_first(), F.col("mark").asc_nulls_last(), "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("begin", id, talk), ("edit", edit, role, text) and ("end", id, talk) over sorted rows."""
    now, talk, marks, marked = None, None, set(), None
    held: tuple | None = None

    def read():
        """The row that is held back until all its copies, which batches have folded apart, are counted."""
        turn, role, text, copies = held
        seen = bool(marks) and marked == (turn,) and _fingerprint(role, text) in marks
        for e in talk.read(turn, role, text, copies, seen):
            yield ("edit", *e)

    def end():
        if held is not None:
            yield from read()
        for e in talk.search.finish():
            yield ("edit", *e)
        yield ("end", now[0], talk)

    for b in batches:
        for id_, turn, role, text, copies, mark in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now[0] != id_:
                if now is not None:
                    yield from end()
                now, talk, marks, marked, held = (id_,), Conversation(), set(), None, None
                yield ("begin", id_, talk)
            if held is not None and held[:3] == (turn, role, text) and mark is None:
                held = (*held[:3], held[3] + copies)
                continue
            if held is not None:
                yield from read()
                held = None
            if mark is not None:
                if marked != (turn,):
                    marks, marked = set(), (turn,)
                marks.add(mark)
            elif copies:
                held = (turn, role, text, copies)
    if now is not None:
        yield from end()


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, place, id_ = [], 0, None
    names = ["id", "place", "edit", "role", "text"]

    def out():
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])

    for kind, *event in _conversations(batches):
        if kind == "begin":
            id_, place = event[0], 0
        elif kind == "edit":
            rows.append((id_, place, *event))
            place += 1
            if len(rows) >= 1000:
                yield out()
                rows = []
    if rows:
        yield out()


def _typed(run, schema):
    def typed(batches):
        for b in run(batches):
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(b.columns, schema, strict=True)], names=b.schema.names)

    return typed


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    audit, digest, first = [], None, True
    for kind, *event in _conversations(batches):
        if kind == "begin":
            audit, digest, first = [], hashlib.sha256(), True
        elif kind == "edit":
            edit, role, text = event
            audit.append(edit)
            if len(audit) >= 4096:
                audit = ["".join(audit)]
            if edit != DELETE:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
        else:
            id_, t = event
            counts = {k: getattr(t, k) for k in ("blank", "duplicate", "truncated", "illegal")}
            rows.append({"id": id_, "gaps": t.gaps(), **counts, "cost": t.search.cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_pylist(rows)
                rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def _arrow_type(rows: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[column].dataType)


def repaired_edits(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None
) -> DataFrame:
    """(id, place, edit, role, text): the edits of each conversation in order, from 0; K, R and I rows are the repaired turns.

    See `repair_reports` for the rules.
    """
    small_batches(rows.sparkSession)
    turns = _prepared(rows, id_col, turn_col, role_col, text_col, copies)
    kind = turns.schema["id"].dataType.simpleString()
    types = [_arrow_type(turns, "id"), pa.int64(), pa.string(), pa.string(), pa.string()]
    return in_order(turns).mapInArrow(_typed(_edits, types), f"id {kind}, place bigint, edit string, role string, text string")


def repair_reports(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None
) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    Turns are read by turn number, nulls first; turns with one number by role and text. `copies` says how often a
    row counts; conversations that have only rows with 0 copies are there with zeros, an empty audit and the
    hash of nothing. A null role or text is one blank; an empty role has no initial, so it cannot be kept. Rows
    with a null id are a conversation. A turn number's faults are counted by the row: blank (white space only), duplicate (role
    and text seen before), truncated (its last character that is no white space is none of `.!?`). Blank and duplicate turns must go.
    An empty table gives no row; other columns are not touched.

    A conversation is read by one task, as its digest is made in order; it is streamed, and the task
    holds the unresolved suffix only.
    """
    small_batches(rows.sparkSession)
    turns = _prepared(rows, id_col, turn_col, role_col, text_col, copies)
    kind = turns.schema["id"].dataType.simpleString()
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    shape = f"id {kind}, {', '.join(f'{c} bigint' for c in longs)}, audit string, repaired_sha256 string"
    types = [_arrow_type(turns, "id"), *[pa.int64()] * len(longs), pa.string(), pa.string()]
    return in_order(turns).mapInArrow(_typed(_reports, types), shape)


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turn, role, text, copies): turns hit by the remainder of the checksum of `id:turn`, to try repairs on.

    Of 20 remainders, 0 drops the turn (0 copies), 1 empties the text, 2 takes out its `.!?`, 3 repeats it and 4 makes it
    the user's. Nulls count as one blank; a null id or turn stays null in its column.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(blank(id_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(blank(text_col), "[.!?]", "")).otherwise(blank(text_col))
    return rows.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.when(hit == 4, "user").otherwise(blank(role_col)).alias("role"),
        text.alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
