"""Structure repair of conversations: the cheapest edits that give alternating roles, found from both ends.

The edit lattice has a node for every place between two rows and every state of the role pattern
``(s?(ua)+)?``. From one place to the next lead the edits of that row (keep, rerole, delete); an insertion stays at
its place. Dijkstra's search runs over it from the first node and backwards from the last ones. Labels are
(cost, audit), the audit being the initials of the edits; heaps go by cost, then by rows passed, then by
audit, so that a settled label is the least of its node. The heaps meet when the sum of their least
costs exceeds the best crossing: by then all crossings of equal cost are known, and the one whose two audits,
put together, come first wins.

A conversation is one character per row to the search. Rows are dealt out by ranges of (conversation,
turn), whatever the conversations' sizes; equal rows are counted once. A conversation that lies within a range
and has at most ``PIECE`` rows is one search. Others are searched piece by piece, from every state to every
state, in the tasks that hold the pieces, and the pieces' results form a lattice of the same kind.
Only the digest of a repaired text needs the texts in one place: they pass through one task in order,
which holds one row at a time and the audit.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import keep

PIECE = 128  # rows that are searched as one
FAN = 16  # pieces that are put together at once

SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, and the role that came last
ROLES = {"u": "user", "a": "assistant"}
# The role pattern as (state before, role's initial, state after).
MOVES = ((START, "s", SYSTEM), (START, "u", USER), (SYSTEM, "u", USER), (USER, "a", ASSISTANT), (ASSISTANT, "u", USER))
FINAL = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")

Step = tuple[int, int, int, str]  # state before, state after, cost, audit
Label = tuple[int, str]  # cost, audit


@dataclass(frozen=True)
class Costs:
    """What an edit costs; keeping costs nothing. A truncated row that is not deleted adds its own cost."""

    # The costs of the edits.

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self) -> None:
        if min(self.rerole, self.delete, self.truncated) < 0 or self.insert <= 0:
            raise ValueError("costs are not negative, and an insertion costs something")


COSTS = Costs()


# --- the search ------------------------------------------------------------------------------


def row_steps(kind: str, costs: Costs = COSTS) -> list[Step]:
    """The edits of one row. ``kind`` is its role's initial, ``o`` for any other role; a capital if the row is
    truncated; ``D`` if it has to go."""
    steps = [(state, state, costs.delete, "D") for state in range(4)]
    if kind == "D":
        return steps
    more = costs.truncated if kind.isupper() else 0
    for before, role, after in MOVES:
        if role == kind.lower():
            steps.append((before, after, more, "K"))
        if role in ROLES:
            steps.append((before, after, costs.rerole + more, "R"))
    return steps


def insertions(costs: Costs = COSTS) -> list[Step]:
    return [(before, after, costs.insert, "I") for before, role, after in MOVES if role in ROLES]


class _Front:
    """One of the two searches: labels, settled nodes and the heap."""

    def __init__(self, starts: Iterable[tuple[int, int]]):
        self.label: dict[tuple[int, int], Label] = {node: (0, "") for node in starts}
        self.settled: set[tuple[int, int]] = set()
        self.heap = [(0, 0, "", node) for node in self.label]

    def least(self) -> int | None:
        """Cost of the next node to settle, None if there is none."""
        while self.heap and (self.heap[0][3] in self.settled or self.label[self.heap[0][3]] != (self.heap[0][0], self.heap[0][2])):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def reach(self, node: tuple[int, int], passed: int, label: Label) -> bool:
        if node in self.label and self.label[node] <= label:
            return False
        self.label[node] = label
        heapq.heappush(self.heap, (label[0], passed, label[1], node))
        return True


def cheapest(rows: Sequence[Sequence[Step]], stay: Sequence[Step], source: int, sinks: Iterable[int]) -> Label | None:
    """Cost and audit of the cheapest way through the lattice, None if there is none."""
    n = len(rows)
    ahead, back = _Front([(0, source)]), _Front([(n, s) for s in sinks])
    best: int | None = 0 if n == 0 and source in sinks else None
    while True:
        left, right = ahead.least(), back.least()
        if left is None or right is None or (best is not None and left + right > best):
            break
        front, other, forward = (ahead, back, True) if left <= right else (back, ahead, False)
        cost, _, audit, node = heapq.heappop(front.heap)
        front.settled.add(node)
        at, state = node
        edges = [(at, e) for e in stay]
        if forward and at < n:
            edges += [(at + 1, e) for e in rows[at]]
        elif not forward and at > 0:
            edges += [(at - 1, e) for e in rows[at - 1]]
        for to, (before, after, price, name) in edges:
            if state != (before if forward else after):
                continue
            target = (to, after if forward else before)
            label = (cost + price, audit + name if forward else name + audit)
            if front.reach(target, to if forward else n - to, label) and target in other.label:
                total = label[0] + other.label[target][0]
                best = total if best is None else min(best, total)
    if best is None:
        return None
    met = [node for node in ahead.label.keys() & back.label.keys() if ahead.label[node][0] + back.label[node][0] == best]
    return best, min(ahead.label[node][1] + back.label[node][1] for node in met)


def between_states(rows: Sequence[Sequence[Step]], stay: Sequence[Step]) -> list[Step]:
    """The cheapest way from every state to every state, as the edges of one step."""
    found = ((p, q, cheapest(rows, stay, p, (q,))) for p in range(4) for q in range(4))
    return [(p, q, *way) for p, q, way in found if way is not None]


def joined(pieces: Sequence[Sequence[Step]]) -> Label:
    """The cheapest way through consecutive pieces, put together ``FAN`` at a time."""
    while len(pieces) > FAN:
        pieces = [between_states(pieces[i : i + FAN], ()) for i in range(0, len(pieces), FAN)]
    return cheapest(pieces, (), START, FINAL)


# --- rows ------------------------------------------------------------------------------------


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the given rows with faults made by a checksum of conversation and turn.

    A null counts as one space. By crc32 of ``conv_id:turn`` modulo 20, 0 drops the row (no copies), 1 empties the
    text, 2 removes its full stops, exclamation and question marks, 3 doubles the row and 4 makes it the user's.
    """
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(_text("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(_text("text"), ".!?", "")).otherwise(_text("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def rows_of(turns: DataFrame) -> DataFrame:
    """conv_id, turn, key, initial, role, text, blank, truncated, copies; ``key`` stands for role and text."""
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"), copies.alias("copies")
    )
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.left("role", F.lit(1))
    return rows.withColumns(
        {
            "key": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))),
            "initial": F.when(initial.isin("s", "u", "a"), initial).otherwise("o"),
            "blank": last == "",
            "truncated": ~last.isin("", ".", "!", "?"),
        }
    )


def counted(rows: DataFrame) -> DataFrame:
    """One line for equal rows: conv_id, turn, key, initial, copies, and how many of them have which fault."""
    lines = rows.groupBy("conv_id", "turn", "key").agg(
        F.sum("copies").alias("copies"), F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("truncated").alias("cut")
    )
    # The earliest turn of a role and text, a missing turn first; counted before it is joined.
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = lines.where("copies > 0").groupBy("conv_id", "key").agg(F.min(place).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    lines = lines.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left").drop("c", "k")
    fresh = (F.col("copies") > 0) & ~F.col("blank") & (F.col("first") == place)
    lines = lines.withColumn("fresh", F.coalesce(fresh, F.lit(False)))
    none = F.lit(0).cast("long")
    return lines.select(
        "conv_id",
        "turn",
        "key",
        "initial",
        "copies",
        F.when(F.col("blank"), F.col("copies")).otherwise(none).alias("blank"),
        F.when(~F.col("blank"), F.col("copies") - F.col("fresh").cast("long")).otherwise(none).alias("duplicate"),
        (F.col("fresh") & F.col("cut")).cast("long").alias("truncated"),
        F.when(F.col("fresh") & F.col("cut"), F.upper("initial")).when(F.col("fresh"), F.col("initial")).otherwise("D").alias("kind"),
    )


# --- conversations ---------------------------------------------------------------------------

_EDGES = "array<struct<before:int,after:int,cost:long,audit:string>>"


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def _search(lines: DataFrame, costs: Costs) -> DataFrame:
    """A line per conversation, or per piece of one: part, piece, whole, illegal, cost, audit, ends, edges."""
    kind = lines.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, part int, piece int, whole boolean, illegal long, cost long, audit string, ends string, edges {_EDGES}"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stay = TaskContext.get().partitionId(), insertions(costs)
        steps = {k: row_steps(k, costs) for k in "suaoSUAOD"}
        nobody = object()
        conv, rows, initials, piece, first = nobody, [], "", 0, True  # the first may have begun in another part
        out: list[tuple] = []

        def put(ended: bool) -> None:
            """The rows so far: a whole conversation if both its ends were seen here, else a piece."""
            nonlocal rows, initials, piece
            if not rows:
                return
            ends, illegal = initials[0] + initials[-1], _illegal(initials)
            if ended and not first and piece == 0:
                out.append((conv, part, 0, True, illegal, *cheapest(rows, stay, START, FINAL), ends, []))
            else:
                edges = [dict(zip(("before", "after", "cost", "audit"), e, strict=True)) for e in between_states(rows, stay)]
                out.append((conv, part, piece, False, illegal, 0, "", ends, edges))
            rows, initials, piece = [], "", piece + 1

        for batch in batches:
            for at, initial, kinds, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv is not nobody and at != conv:
                    put(True)
                    piece, first = 0, False
                conv = at
                for k in range(copies):
                    if len(rows) == PIECE:
                        put(False)
                    rows.append(steps[kinds if k == 0 else "D"])
                    initials += initial
            yield _batch(out, schema_arrow)
            out.clear()
        put(False)
        yield _batch(out, schema_arrow)

    schema_arrow = _arrow(schema, lines.sparkSession)
    rows = lines.where("copies > 0").repartitionByRange("conv_id", "turn", "key").sortWithinPartitions("conv_id", "turn", "key")
    return rows.select("conv_id", "initial", "kind", "copies").mapInArrow(search, schema)


def _arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _joined(found: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit of the conversations that were searched in pieces."""

    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for pieces in batch.to_pylist():
                cost, audit = joined([[(e["before"], e["after"], e["cost"], e["audit"]) for e in p["edges"]] for p in pieces])
                seams = sum(a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(pieces, pieces[1:]))
                out.append({"illegal": sum(p["illegal"] for p in pieces) + seams, "cost": cost, "audit": audit})
            yield pa.array(out, pa.struct([("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))

    pieces = F.sort_array(F.collect_list(F.struct("part", "piece", "illegal", "ends", "edges")))
    udf = F.arrow_udf(join, "illegal long, cost long, audit string")
    return found.where("NOT whole").groupBy("conv_id").agg(pieces.alias("pieces")).select("conv_id", udf("pieces").alias("found")).select("conv_id", "found.*")


class _Repaired:
    """A conversation as its edits are applied, row by row."""

    def __init__(self, line: tuple):
        self.line, self.audit = line, line[-1]
        self.at, self.state, self.any, self.sha = 0, START, False, hashlib.sha256()

    def _say(self, role: str, text: str) -> None:
        self.sha.update(f"{'\n' if self.any else ''}{role}:{text}".encode())
        self.any = True
        self.state = next(after for before, r, after in MOVES if before == self.state and r == role[0])

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._say(self._due(), "")
            self.at += 1

    def _due(self) -> str:
        return ROLES["a" if self.state == USER else "u"]

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else self._due(), text)

    def done(self) -> tuple:
        self._insert()
        return (*self.line, self.sha.hexdigest())


def _digests(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """The lines with repaired_sha256: texts follow their conversation's line in order of turn and key."""
    names = lines.columns
    head = lines.select("conv_id", F.lit(True).alias("head"), F.struct(*names).alias("line"))
    texts = rows.where("copies > 0").select("conv_id", F.lit(False).alias("head"), "turn", "key", "role", "text", "copies")
    both = head.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.col("head").desc(), "turn", "key").select("head", "line", "role", "text", "copies")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema) + ", repaired_sha256 string"
    schema_arrow = _arrow(schema, lines.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for head, line, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if head:
                    out += [now.done()] if now else []
                    now = _Repaired(tuple(line[n] for n in names))
                else:
                    for _ in range(copies):
                        now.row(role, text)
            yield _batch(out, schema_arrow)
        yield _batch([now.done()] if now else [], schema_arrow)

    return both.mapInArrow(digest, schema)


def repair(turns: DataFrame, costs: Costs = COSTS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation.

    ``turns`` has conv_id, turn, role, text and, if wanted, ``copies``, how often a row counts; a conversation
    whose rows all count 0 times has no rows, but is returned. Rows go by turn, nulls first, and
    rows of one turn by the md5 of role and text. A null role or text counts as one space; rows without a
    conv_id form one conversation. A role is known by its first letter, in lower case; any other role can
    only be changed or deleted. Each row's first fault counts: blank, duplicate of an earlier role and text, truncated.
    Other columns are ignored.
    """
    rows = rows_of(turns)
    lines = keep(counted(rows), "repair-lines")
    found = keep(_search(lines, costs), "repair-found")
    audits = found.where("whole").select("conv_id", "illegal", "cost", "audit").unionByName(_joined(found))
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    gaps = F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)
    zero = F.lit(0).cast("long")
    sums = lines.groupBy("conv_id").agg(F.coalesce(gaps, zero).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    audits = audits.withColumnRenamed("conv_id", "c")
    whole = sums.join(audits, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    whole = whole.fillna({"illegal": 0, "cost": 0, "audit": ""})
    return _digests(whole, rows)
