"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, role state); its edges are the edits
Keep, Rerole, Delete and Insert with their costs.  Forward and reverse heaps
grow from both ends until no cheaper or equally cheap meeting is left; of all
equally cheap crossings the one of the ASCII-least concatenated audit counts.

Conversations of any length: rows are dealt over ranges of (conversation,
turn), so a long conversation lies in many tasks.  Each task solves its part
of a conversation, in stretches of bounded length, from every role state it
can begin in to every one it can end in; the parts are then joined state by
state.  Equal rows travel once, with a count.  Only the rewriting of a
conversation, whose output is one sequence, streams through one task.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.common import discard, stored, workspace

KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 1, 2, 5, 5
#: Role states: nothing yet, after system, after user, after assistant.  From each, the initial that may follow leads to the next state.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that Rerole and Insert may give in each state, and where it leads.
GIVEN = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
BEFORE = {USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
DONE = (NOTHING, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a row.
FINE, BLANK, COPY, TRUNCATED = range(4)
#: Rows of a conversation solved at once; longer ones are solved in stretches, from every state to every state.
STRETCH = 192
BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _onward(row, state):
    """(cost, edit, state after) of the edits that consume ``row`` in ``state``."""
    initial, fault = row
    yield DELETE, "D", state
    if fault not in (BLANK, COPY):
        more = OPEN_END if fault == TRUNCATED else 0
        if (state, initial) in NEXT:
            yield KEEP + more, "K", NEXT[state, initial]
        yield REROLE + more, "R", GIVEN[state]


def _back(row, state):
    """(cost, edit, state before) of the edits that consume ``row`` and end in ``state``."""
    initial, fault = row
    yield DELETE, "D", state
    if fault not in (BLANK, COPY):
        more = OPEN_END if fault == TRUNCATED else 0
        for (before, one), after in NEXT.items():
            if after == state and one == initial:
                yield KEEP + more, "K", before
        for before in BEFORE.get(state, ()):
            yield REROLE + more, "R", before


def cheapest(rows: list[tuple[str, int]], entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of (initial, fault) rows from state ``entry`` to one of ``exits``.

    Of equally cheap edits those of the ASCII-least audit; None if there are
    none.  Nodes of one cost leave a heap in the order of the rows, as only
    Keep may cost nothing, so their audits are final by then.
    """
    n = len(rows)
    ahead, behind = {(0, entry): (0, "")}, {(n, x): (0, "") for x in exits}
    front, rear = [(0, 0, entry)], [(0, 0, x) for x in exits]
    closed: tuple[set, set] = (set(), set())
    best = min((0 for x in behind if x in ahead), default=None)
    while front and rear and (best is None or front[0][0] + rear[0][0] <= best):
        if front[0][0] <= rear[0][0]:
            cost, i, state = heappop(front)
            if (i, state) in closed[0]:
                continue
            closed[0].add((i, state))
            audit = ahead[i, state][1]
            steps = [(INSERT, "I", (i, GIVEN[state]))]
            if i < n:
                steps += [(c, e, (i + 1, s)) for c, e, s in _onward(rows[i], state)]
            for c, e, node in steps:
                new, old = (cost + c, audit + e), ahead.get(node)
                if old is None or new < old:
                    ahead[node] = new
                    heappush(front, (new[0], *node))
                    if node in behind and (best is None or new[0] + behind[node][0] < best):
                        best = new[0] + behind[node][0]
        else:
            cost, left, state = heappop(rear)
            i = n - left
            if (i, state) in closed[1]:
                continue
            closed[1].add((i, state))
            audit = behind[i, state][1]
            steps = [(INSERT, "I", (i, s)) for s in BEFORE.get(state, ())]
            if i:
                steps += [(c, e, (i - 1, s)) for c, e, s in _back(rows[i - 1], state)]
            for c, e, node in steps:
                new, old = (cost + c, e + audit), behind.get(node)
                if old is None or new < old:
                    behind[node] = new
                    heappush(rear, (new[0], n - node[0], node[1]))
                    if node in ahead and (best is None or new[0] + ahead[node][0] < best):
                        best = new[0] + ahead[node][0]
    if best is None:
        return None
    return min((a[0] + b[0], a[1] + b[1]) for node, a in ahead.items() if (b := behind.get(node)) and a[0] + b[0] == best)


def join(labels: dict[int, tuple[int, str]], part: list[tuple[int, int, int, str]]) -> dict[int, tuple[int, str]]:
    """Cheapest labels by state after a solved part, given those before it."""
    out: dict[int, tuple[int, str]] = {}
    for entry, leave, cost, audit in part:
        if entry in labels:
            new = (labels[entry][0] + cost, labels[entry][1] + audit)
            if leave not in out or new < out[leave]:
                out[leave] = new
    return out


def damage(rows: DataFrame) -> DataFrame:
    """Rows of a conversation table with faults put in by crc32 of ``conv_id:turn``; a null counts as one space.

    Columns conv_id, turn, role, text; repeated rows are damaged each for itself.
    """
    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    out = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"), text.alias("text"),
                      F.explode(F.array_repeat(F.lit(0), copies)).alias("_c"))
    return out.drop("_c")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with null roles and texts as one space, and the digest that orders rows of one turn after their role."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def classified(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, whether blank, truncated, or said earlier; and a first row (copies 0) per conversation."""
    body = F.expr(f"trim(TRAILING {BLANKS} FROM text)")
    flags = rows.select("conv_id", "turn", "role", "digest", (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open"))
    distinct = flags.groupBy("conv_id", "turn", "role", "digest", "blank", "open").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct(F.col("turn").isNotNull(), "turn")
    first = distinct.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    marked = distinct.join(first, same, "left").select("conv_id", F.lit(1).alias("kind"), "turn", F.substring("role", 1, 1).alias("initial"), "role", "digest",
                                                        "blank", "open", "copies", F.coalesce(place > F.col("first"), F.lit(False)).alias("said"))
    marker = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("initial"), F.lit("").alias("role"),
        F.lit(b"").alias("digest"), F.lit(False).alias("blank"), F.lit(False).alias("open"), F.lit(0).cast("long").alias("copies"), F.lit(False).alias("said"))
    return marked.unionByName(marker)


class _Part:
    """A conversation's rows of one task, up to the next stretch."""

    def __init__(self, conv, opens):
        self.conv, self.opens = conv, opens
        self.clear()

    def clear(self):
        self.rows, self.counts = [], [0, 0, 0]
        self.illegal, self.turns, self.low, self.high = 0, 0, None, None

    def add(self, turn, initial, blank, opened, copies, said):
        if turn is not None and copies:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        fault = BLANK if blank else COPY if said else TRUNCATED if opened else FINE
        for k in range(copies):
            one = fault if k == 0 or fault == BLANK else COPY
            if self.rows and self.rows[-1][0] + initial not in ("su", "ua", "au"):
                self.illegal += 1
            if one:
                self.counts[one - 1] += 1
            self.rows.append((initial, one))
            if len(self.rows) >= STRETCH:
                yield self.solve(False)

    def solve(self, closes):
        """The part as a row, and the part begun anew (no longer opening its conversation)."""
        exits = [DONE] if closes else [(x,) for x in range(4)]
        found = [(e, x[0] if not closes else ASSISTANT, got) for e in ([NOTHING] if self.opens else range(4)) for x in exits if (got := cheapest(self.rows, e, x))]
        row = (self.conv, len(self.rows), self.rows[0][0] if self.rows else None, self.rows[-1][0] if self.rows else None, *self.counts, self.illegal,
               self.turns, self.low, self.high, [{"entry": e, "leave": x, "cost": c, "audit": a} for e, x, (c, a) in found])
        self.opens = False
        self.clear()
        return row


LABEL = pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
PART_FIELDS = ["n", "first", "last", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "labels"]
PART_TYPES = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 7, LABEL]
PART_SQL = ("n long, first string, last string, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, "
            "labels array<struct<entry: int, leave: int, cost: long, audit: string>>")


def _solver(conv_type):
    def run(batches):
        pid, seq, part, ready = TaskContext.get().partitionId(), 0, None, []

        def flush():
            nonlocal ready, seq
            cols = list(zip(*ready))
            at = range(seq, seq + len(ready))
            seq, ready = seq + len(ready), []
            return pa.RecordBatch.from_arrays([pa.array(cols[0], conv_type), pa.array([pid] * len(at), pa.int32()), pa.array(at, pa.int64()),
                                               *[pa.array(c, t) for c, t in zip(cols[1:], PART_TYPES)]], names=["conv_id", "pid", "seq", *PART_FIELDS])
        for batch in batches:
            for conv, kind, turn, initial, blank, opened, copies, said in zip(*[c.to_pylist() for c in batch.columns]):
                if part is None or conv != part.conv or not kind:
                    if part is not None:
                        ready.append(part.solve(True))
                    part = _Part(conv, not kind)
                ready += part.add(turn, initial, blank, opened, copies, said)
                if len(ready) >= 256:
                    yield flush()
        if part is not None:
            ready.append(part.solve(False))  # it may go on in the next range
            yield flush()
    return run


class _Whole:
    """A conversation: its parts joined."""

    def __init__(self):
        self.labels = {NOTHING: (0, "")}
        self.counts, self.illegal, self.turns, self.low, self.high, self.last = [0, 0, 0], 0, 0, None, None, None

    def add(self, part: dict):
        self.labels = join(self.labels, [(x["entry"], x["leave"], x["cost"], x["audit"]) for x in part["labels"]])
        self.counts = [a + part[k] for a, k in zip(self.counts, ("blank", "duplicate", "truncated"))]
        self.illegal += part["illegal"]
        if part["n"]:
            if self.last is not None and self.last + part["first"] not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = part["last"]
        if part["turns"]:
            self.turns += part["turns"] - (part["low"] == self.high)
            self.low, self.high = part["low"] if self.low is None else self.low, part["high"]

    def summary(self):
        cost, audit = min(self.labels[x] for x in DONE if x in self.labels)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, *self.counts, self.illegal, cost, audit)


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
EDIT_SQL = "step long, edit string, role string, text string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
EDIT_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]


class _Script:
    """The edits of an audit, taken one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def inserts(self):
        """Roles of the turns inserted before the next edit of a row (or at the end)."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, GIVEN[self.state]
            yield NAMES[self.state]

    def take(self, role: str) -> tuple[str, str | None]:
        """The edit of the next row, and the role it has then (None: deleted)."""
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return edit, None
        self.state = NEXT[self.state, role[:1]] if edit == "K" else GIVEN[self.state]
        return edit, role if edit == "K" else NAMES[self.state]


def _writer(conv_type):
    """Streams parts, then rows, of each conversation; emits step 0 with its summary, then its edits with roles and texts."""
    def run(batches):
        ready, size, step = [], 0, 0
        whole = conv = script = None

        def out():
            nonlocal ready, size
            cols = list(zip(*ready))
            ready, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [conv_type, *EDIT_TYPES])], names=["conv_id", "step", "edit", "role", "text", *SUMMARY])

        def tell(edit, role, text):
            nonlocal step
            step += 1
            ready.append((conv, step, edit, role, text, *[None] * len(SUMMARY)))

        def inserted():
            """The summary, once all parts are in, and the turns to insert next."""
            nonlocal script
            if script is None:
                summary = whole.summary()
                ready.append((conv, 0, None, None, None, *summary))
                script = _Script(summary[-1])
            for role in script.inserts():
                tell("I", role, "")
        for batch in batches:
            for one, kind, part, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if whole is None or one != conv:
                    if whole is not None:
                        inserted()
                    whole, conv, script, step = _Whole(), one, None, 0
                if not kind:
                    whole.add(part)
                    continue
                inserted()
                edit, given = script.take(role)
                tell(edit, given, None if edit == "D" else text)
                size += len(text)
                if len(ready) >= 4096 or size > 1 << 22:
                    yield out()
        if whole is not None:
            inserted()
        if ready:
            yield out()
    return run


def repair(spark: SparkSession, rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Edits of every conversation of ``conversations`` (conv_id), from its ``rows`` (conv_id, turn, role, text).

    Per conversation a row of step 0 with gaps, the numbers of blank,
    duplicate, truncated and illegally following rows, cost and audit; then
    one row per edit, in order: step, edit (K, R, D, I), role and text as
    repaired (null when deleted).  Rows are taken by turn, nulls first; equal
    turns by role, then by sha256 of the text.  Null roles and texts are one
    space, an empty role has no legal neighbour, null conv_ids are one
    conversation.  A conversation without rows has zeros and an empty audit;
    an empty table gives no row.  Repeated rows count each (the later ones are
    duplicates).  Other columns are ignored.  Edits come sorted by conversation
    and step in every partition, a conversation never in two.
    """
    folder = workspace(spark, "repair")
    ordered = _ordered(rows)
    kinds = stored(classified(ordered, conversations), f"{folder}/rows")
    conv = kinds.schema["conv_id"].dataType.simpleString()
    conv_type = pa.string() if conv == "string" else pa.int32() if conv == "int" else pa.int64()
    order = ["conv_id", "kind", "turn", "role", "digest"]
    dealt = kinds.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = dealt.select("conv_id", "kind", "turn", "initial", "blank", "open", "copies", "said").mapInArrow(
        _solver(conv_type), f"conv_id {conv}, pid int, seq long, {PART_SQL}")
    parts = stored(parts, f"{folder}/parts")
    discard(spark, f"{folder}/rows")
    none = F.lit(None)
    left = parts.select("conv_id", F.lit(0).alias("kind"), F.struct(*PART_FIELDS).alias("part"), none.cast("string").alias("role"), none.cast("string").alias("text"),
                        "pid", "seq", none.cast("long").alias("turn"), none.cast("binary").alias("digest"))
    right = ordered.select("conv_id", F.lit(1).alias("kind"), none.cast(left.schema["part"].dataType).alias("part"), "role", "text",
                           F.lit(0).alias("pid"), F.lit(0).cast("long").alias("seq"), "turn", "digest")
    stream = left.unionByName(right).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "pid", "seq", "turn", "role", "digest")
    return stream.select("conv_id", "kind", "part", "role", "text").mapInArrow(_writer(conv_type), f"conv_id {conv}, {EDIT_SQL}")


def _digester(conv_type):
    """Step 0 of every conversation with the sha256 of its repaired ``role:text`` lines, hashed as they stream by."""
    def run(batches):
        ready, head, sha, some = [], None, None, False

        def out():
            nonlocal ready
            cols = list(zip(*ready))
            ready = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()])],
                                              names=["conv_id", *SUMMARY, "repaired_sha256"])
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                conv, step, edit, role, text, *summary = row
                if not step:
                    if head:
                        ready.append((*head, sha.hexdigest()))
                    head, sha, some = (conv, *summary), hashlib.sha256(), False
                elif edit != "D":
                    sha.update(((f"\n{role}:" if some else f"{role}:") + text).encode())
                    some = True
                if len(ready) >= 1024:
                    yield out()
        if head:
            ready.append((*head, sha.hexdigest()))
        if ready:
            yield out()
    return run


def repair_digest(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The rows of the registered query: the table damaged, repaired, and digested."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    edits = repair(spark, damage(rows), rows)
    conv = edits.schema["conv_id"].dataType.simpleString()
    conv_type = pa.string() if conv == "string" else pa.int32() if conv == "int" else pa.int64()
    schema = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return edits.mapInArrow(_digester(conv_type), schema)  # edits are in order, nothing is shuffled
