"""Conversation structure repair: the cheapest edits that make every conversation well formed.

A conversation is well formed if the initials of its roles are ``(s?(ua)+)?``. Edits, in order: Keep
(0), Rerole to user or assistant (1), Delete (2; the only edit for a blank or duplicate row), Insert an
empty user or assistant row (5); a truncated row that is not deleted adds 5. Among equally cheap
lists of edits the one whose initials are least in ASCII is taken.

*Lattice.* A node is (rows done, state: nothing yet, after s, after u, after a); every edit is an edge
and from each node at most one edge has a given initial, since a state allows only one of user and
assistant. :func:`search` runs Dijkstra from both ends; when the two heaps' least costs add up to more
than the best crossing, every node of every cheapest path has been settled from one side or the other.
Forward nodes that lead to a crossing of that cost are marked, and the least concatenated audit is read
off from the start: the least initial that stays on marked or backward-settled nodes.

*Plan.* Narrow rows (no texts) are counted by (conversation, turn, role, text), marked as first of
their (role, text) or not, and range-partitioned in conversation order, so a conversation with a third
of all rows is spread over many tasks. A task solves the conversations that lie within it; of those
at its two edges, and of each ``BLOCK`` rows of a long one, it gives the cost and audit from every state
to every state, and one small step multiplies these along the conversation. Texts move once, sorted, and
are edited as they stream by; a SHA-256 is a chain, so that stream is one task a conversation.

Defined results: a null role or text is one space; rows are taken by turn (nulls first), then role,
then the text's SHA-256; equal rows of a turn are one row and its duplicates. A role whose initial is
not s, u or a (or is empty) can be reroled or deleted only. A null conv_id is a conversation. A row with
``present`` false only says that its conversation exists. Very long texts are moved, never held
together. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starloom.llm.common import materialize

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# Rows of a long conversation that are searched together.
BLOCK = 1024
# Searches a worker remembers, of conversations up to so many rows.
MEMO, MEMO_ROWS = 100_000, 32

START, SYSTEM, USER, ASSISTANT = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
TURN = (USER, USER, ASSISTANT, USER)  # the state after a user or assistant row, whichever may follow
BEFORE_TURN = ((), (), (START, SYSTEM, ASSISTANT), (USER,))
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
FINAL = (START, ASSISTANT)

BLANK = r"^[\x20\x09-\x0D]*$"
# The last character that is not white space is no . ! or ?
CUT_OFF = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*$"

# An item is (initial, is truncated) or a number of rows that must be deleted.
Item = tuple[str, bool] | int


def _edges(items: list[Item], node: int) -> Iterator[tuple[str, int, int]]:
    """(edit, next node, cost) in ASCII order of the edits; node = 4 * rows done + state."""
    i, q = divmod(node, 4)
    if i < len(items):
        item = items[i]
        if isinstance(item, int):
            yield "D", node + 4, DELETE * item
        else:
            initial, cut = item
            more = TRUNCATED if cut else 0
            yield "D", node + 4, DELETE
            yield "I", 4 * i + TURN[q], INSERT
            if (p := STEP[q].get(initial)) is not None:
                yield "K", 4 * i + 4 + p, more
            yield "R", 4 * i + 4 + TURN[q], REROLE + more
            return
    yield "I", 4 * i + TURN[q], INSERT


def _back_edges(items: list[Item], node: int) -> Iterator[tuple[int, int]]:
    """(earlier node, cost) of all edges into a node."""
    i, q = divmod(node, 4)
    for p in BEFORE_TURN[q]:
        yield 4 * i + p, INSERT
    if not i:
        return
    item = items[i - 1]
    if isinstance(item, int):
        yield node - 4, DELETE * item
        return
    initial, cut = item
    more = TRUNCATED if cut else 0
    yield node - 4, DELETE
    for p in range(4):
        if STEP[p].get(initial) == q:
            yield 4 * i - 4 + p, more
    for p in BEFORE_TURN[q]:
        yield 4 * i - 4 + p, REROLE + more


def search(items: list[Item], start: int = START, finals: tuple[int, ...] = FINAL) -> tuple[int, str] | None:
    """(cost, audit) from ``start`` before the items to one of the states ``finals`` after them."""
    n = len(items)
    size = 4 * (n + 1)
    goals = {4 * n + q for q in finals}
    ahead, behind = {start: 0}, dict.fromkeys(goals, 0)  # least costs known so far
    settled, settled_back = set(), set()
    heap, heap_back = [start], sorted(goals)  # cost * size + node
    best = 0 if start in goals else None
    while heap and heap_back:
        top, top_back = heap[0] // size, heap_back[0] // size
        if best is not None and top + top_back > best:
            break
        if top < top_back or (top == top_back and len(heap) <= len(heap_back)):
            cost, node = divmod(heappop(heap), size)
            if node in settled:
                continue
            settled.add(node)
            for _, to, w in _edges(items, node):
                c = cost + w
                if c < ahead.get(to, c + 1):
                    ahead[to] = c
                    heappush(heap, c * size + to)
                    if to in behind and (best is None or c + behind[to] < best):
                        best = c + behind[to]
        else:
            cost, node = divmod(heappop(heap_back), size)
            if node in settled_back:
                continue
            settled_back.add(node)
            for to, w in _back_edges(items, node):
                c = cost + w
                if c < behind.get(to, c + 1):
                    behind[to] = c
                    heappush(heap_back, c * size + to)
                    if to in ahead and (best is None or c + ahead[to] < best):
                        best = c + ahead[to]
    if best is None:
        return None

    def ends(node: int) -> int | None:
        return behind[node] if node in settled_back or node in goals else None

    # Crossings of the best cost, and the settled nodes from which one is reached.
    waiting = []
    for node in settled:
        cost = ahead[node]
        if ends(node) == best - cost or any(ends(to) == best - cost - w for _, to, w in _edges(items, node)):
            waiting.append(node)
    marked = set(waiting)
    while waiting:
        node = waiting.pop()
        for to, w in _back_edges(items, node):
            if to in settled and to not in marked and ahead[to] + w == ahead[node]:
                marked.add(to)
                waiting.append(to)
    audit, node, cost = [], start, 0
    while node not in goals or cost < best:
        for edit, to, w in _edges(items, node):
            c = cost + w
            if ends(to) == best - c or (to in marked and ahead[to] == c):
                item = items[node // 4] if edit == "D" else 1
                audit.append(edit * item if isinstance(item, int) else edit)
                node, cost = to, c
                break
        else:
            raise RuntimeError("no edge stays on a cheapest path")
    return best, "".join(audit)


# Pairs of states between which there is a path.
BETWEEN = [(p, q) for p in range(4) for q in range(4) if q >= USER or q == START == p or (q == SYSTEM and p <= SYSTEM)]
Table = dict[tuple[int, int], tuple[int, str]]


def table(items: list[Item]) -> Table:
    """The cheapest (cost, audit) over the items from each state to each."""
    found = {(p, q): search(items, p, (q,)) for p, q in BETWEEN}
    return {k: v for k, v in found.items() if v is not None}


def joined(a: Table, b: Table) -> Table:
    """The table over the items of ``a``, then those of ``b``."""
    out: Table = {}
    for (p, m), (cost_a, audit_a) in a.items():
        for q in range(4):
            if (m, q) in b:
                cost_b, audit_b = b[m, q]
                new = (cost_a + cost_b, audit_a + audit_b)
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) with planted faults, by crc32(conv_id:turn) % 20: 0 drops a
    row (present is false), 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it a user's."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long"), spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("f"))
    text = F.when(F.col("f") <= 1, "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("f") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("f") != 0).alias("present"), "f")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("f") == 3, 2).otherwise(1)))).drop("f", "copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, key, present), nulls as one space."""
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    own = lambda c: F.when(present, c)
    return rows.select(
        "conv_id", own(F.col("turn").cast("long")).alias("turn"), own(role).alias("role"), own(text).alias("text"),
        own(F.unhex(F.sha2(text, 256))).alias("key"), F.coalesce(present, F.lit(False)).alias("present"),
    )


def marked_rows(rows: DataFrame) -> DataFrame:
    """One row per (conv_id, turn, role, text) with its number ``n``, and whether it is ``blank``,
    ``first`` of its role and text, ``cut`` off. No key of a shuffle is a conversation alone."""
    narrow = _keyed(rows).select(
        "conv_id", "turn", "role", "key", "present", F.col("text").rlike(BLANK).alias("blank"), F.col("text").rlike(CUT_OFF).alias("cut")
    )
    runs = narrow.groupBy("conv_id", "turn", "role", "key", "present").agg(
        F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.count("*").alias("n")
    )
    runs = materialize(runs, "conversation-runs")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = runs.where("present").groupBy("conv_id", "role", "key").agg(F.min(at).alias("at"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), F.col("at.turn").alias("t"), F.lit(True).alias("first"))
    here = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    return runs.join(first, here, "left").select("conv_id", "turn", "role", "key", "present", "blank", "cut", "n", F.coalesce("first", F.lit(False)).alias("first"))


_MEMO: dict[tuple, tuple[int, str]] = {}


class _Piece:
    """Rows of one conversation in turn: its counts so far and the items not yet searched."""

    COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.items: list[Item] = []
        self.at: tuple | None = None  # the first row's place
        self.least = self.most = None
        self.first = self.last = None  # initials
        self.counts = dict.fromkeys(self.COUNTS, 0)

    def add(self, turn: int | None, role: str, key: bytes, blank: bool, cut: bool, first: bool, n: int) -> None:
        if self.at is None:
            self.at = (turn, role, key)
        c = self.counts
        if turn is not None and turn != self.most:
            c["turns"] += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        initial = role[:1]
        if self.last is not None:
            c["illegal"] += self.last + initial not in LEGAL
        else:
            self.first = initial
        c["illegal"] += n - 1  # a row beside its copy
        self.last = initial
        forced = n
        if blank:
            c["blank"] += n
        elif first:
            c["duplicate"] += n - 1
            c["truncated"] += cut
            self.items.append((initial, cut))
            forced = n - 1
        else:
            c["duplicate"] += n
        if forced:
            self.items.append(forced)

    def solve(self) -> tuple[int, str]:
        if len(self.items) > MEMO_ROWS:
            return search(self.items)
        key = tuple(self.items)
        if key not in _MEMO:
            if len(_MEMO) >= MEMO:
                _MEMO.clear()
            _MEMO[key] = search(self.items)
        return _MEMO[key]


def _outcome(conv_id, gaps: int, counts: dict[str, int], cost: int, audit: str) -> dict:
    return {"conv_id": conv_id, "gaps": gaps, **{c: counts[c] for c in _Piece.COUNTS[1:]}, "cost": cost, "audit": audit}


def _gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else min(most - least + 1 - turns, 2**63 - 1)


AUDIT_COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PIECE_COLUMNS = (
    "turns long, least long, most long, first string, last string, at_turn long, at_role string, at_key binary, "
    "frm array<int>, `to` array<int>, costs array<long>, audits array<string>"
)


def _record(piece: _Piece, whole: bool) -> dict:
    if whole:
        return _outcome(piece.conv_id, _gaps(piece.least, piece.most, piece.counts["turns"]), piece.counts, *piece.solve())
    own = table(piece.items)
    at = piece.at or (None, None, None)
    return {
        "conv_id": piece.conv_id, **piece.counts, "least": piece.least, "most": piece.most, "first": piece.first, "last": piece.last,
        "at_turn": at[0], "at_role": at[1], "at_key": at[2], "frm": [p for p, _ in own], "to": [q for _, q in own],
        "costs": [c for c, _ in own.values()], "audits": [a for _, a in own.values()],
    }


def _decide(schema: pa.Schema, block: int):
    """Sorted marked rows to one record per conversation, or per piece of those at the task's edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, edge, out = None, True, []
        columns = ("conv_id", "turn", "role", "key", "present", "blank", "cut", "n", "first")
        for b in batches:
            for conv_id, turn, role, key, present, blank, cut, n, first in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                if piece is None or piece.conv_id != conv_id:
                    if piece is not None:
                        out.append(_record(piece, whole=not edge))
                        edge = False
                    piece = _Piece(conv_id)
                elif len(piece.items) >= block:
                    out.append(_record(piece, whole=False))
                    piece, edge = _Piece(conv_id), True
                if present:
                    piece.add(turn, role, key, blank, cut, first, n)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if piece is not None:
            yield pa.RecordBatch.from_pylist([_record(piece, whole=False)], schema)

    return run


def _finish(schema: pa.Schema):
    """All pieces of one conversation to its outcome. Pieces hold audits, not texts."""

    def run(pieces: pa.Table) -> pa.Table:
        rows = sorted(
            pieces.to_pylist(), key=lambda r: (r["at_key"] is not None, r["at_turn"] is not None, r["at_turn"] or 0, (r["at_role"] or "").encode(), r["at_key"] or b"")
        )
        counts = dict.fromkeys(_Piece.COUNTS, 0)
        tables: list[Table] = []
        least = most = last = None
        for r in rows:
            for c in counts:
                counts[c] += r[c]
            if r["least"] is not None:
                counts["turns"] -= r["least"] == most  # a turn that goes on from the piece before
                least, most = r["least"] if least is None else least, r["most"]
            if r["first"] is not None:
                if last is not None:
                    counts["illegal"] += last + r["first"] not in LEGAL
                last = r["last"]
            ends = zip(r["frm"], r["to"], strict=True)
            tables.append(dict(zip(ends, zip(r["costs"], r["audits"], strict=True), strict=True)))
        while len(tables) > 1:
            tables = [joined(*tables[i : i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        cost, audit = min(tables[0][START, q] for q in FINAL if (START, q) in tables[0])
        own = _outcome(rows[0]["conv_id"], _gaps(least, most, counts["turns"]), counts, cost, audit)
        return pa.Table.from_pylist([own], schema)

    return run


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _in_order() -> list:
    """Conversation order; rows that are not present come first."""
    return [F.col("conv_id").asc_nulls_first(), F.col("present").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()]


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of
    ``rows`` (conv_id, turn, role, text and, if wanted, present)."""
    own = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, "
    marked = materialize(marked_rows(rows), "conversation-rows")
    ordered = marked.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order())
    ddl = own + AUDIT_COLUMNS + ", " + _PIECE_COLUMNS
    decided = materialize(ordered.mapInArrow(_decide(_arrow(ddl), block), ddl), "conversation-pieces")
    whole = decided.where("audit IS NOT NULL").select("conv_id", *(c.split()[0] for c in AUDIT_COLUMNS.split(", ")))
    pieces = decided.where("audit IS NULL").drop("gaps", "cost", "audit")
    return whole.unionByName(pieces.groupBy("conv_id").applyInArrow(_finish(_arrow(own + AUDIT_COLUMNS)), own + AUDIT_COLUMNS))


class _Editor:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows to insert here."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = TURN[self.state]
            yield "I", ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEP[self.state][role[:1]]
            yield edit, role, text
        elif edit == "R":
            self.state = TURN[self.state]
            yield edit, ROLES[self.state], text


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator | None]]:
    """(the audit's row, edited rows) again and again: first (audit, None) when a conversation begins,
    then (audit, its next edited rows), at last those inserted at its end."""
    names = None
    head, editor = None, None
    for b in batches:
        names = names or b.schema.names
        for values in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            r = dict(zip(names, values, strict=True))
            if r["audit"] is not None:
                if head is not None:
                    yield head, editor.inserts()
                head, editor = r, _Editor(r["audit"])
                yield head, None
            else:
                yield head, editor.row(r["role"], r["text"])
    if head is not None:
        yield head, editor.inserts()


def _stream(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Audits and present rows by conversation, each audit before its rows."""
    texts = _keyed(rows).where("present")
    both = decided.withColumn("present", F.lit(False)).unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*_in_order()).drop("key", "present")


def _rows_out(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out, size = 0, [], 0
        for head, edited in _edited(batches):
            if edited is None:
                place = 0
                continue
            for edit, role, text in edited:
                out.append({"conv_id": head["conv_id"], "place": place, "edit": edit, "role": role, "text": text})
                place, size = place + 1, size + len(text)
            if len(out) >= 5000 or size > 8_000_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def repaired_rows(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations, row by row."""
    ddl = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, edit string, role string, text string"
    return _stream(rows, decided).mapInArrow(_rows_out(_arrow(ddl)), ddl)


def _digests(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, begun, last = [], hashlib.sha256(), False, None

        def close() -> None:
            out.append({**{c: last[c] for c in schema.names if c in last}, "repaired_sha256": digest.hexdigest()})

        for head, edited in _edited(batches):
            if edited is None:
                if last is not None:
                    close()
                digest, begun, last = hashlib.sha256(), False, head
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
                continue
            for _, role, text in edited:
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                begun = True
        if last is not None:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """:func:`audits` with repaired_sha256, the digest of the repaired ``role:text`` lines."""
    ddl = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {AUDIT_COLUMNS}, repaired_sha256 string"
    decided = materialize(audits(rows, block), "conversation-audits")
    return _stream(rows, decided).mapInArrow(_digests(_arrow(ddl)), ddl)
