"""Conversation structure repair: the cheapest edits after which roles read ``(s?(ua)+)?``.

Each row of a conversation has at most one fault, the first of: blank, a duplicate of an earlier row, truncated. Row by
row the role and the fault make a letter, and a conversation is the string of its letters, its signature. What it costs
to repair the rest of a conversation depends on the rest of its signature alone, so the signatures of all conversations
share one automaton (a DAWG) in which a node is a suffix. Distinct signatures are sorted by their reversed letters: those
with a common suffix follow each other, and only the nodes that the one before does not have are made. Each node gets,
for every state of the role grammar, the cost to the end and the first letter of the best audit from there; letters of
the next rows are read off the nodes that follow. Equal nodes, up to a constant cost, are worked out once per task.

Edits: Keep (free), Rerole to the role the grammar wants (1), Delete (2; the only edit of blank and duplicate rows) and
Insert an empty row of that role (5). A truncated row that is not deleted costs 5 more. In a state each edit has one
successor, so of equally cheap audits the one that is first in ASCII order begins with the smallest letter.

Rows are taken by turn (NULL first), role and digest of the text. NULL roles and texts count as one space, and so they are
blank and have no role of the grammar. A NULL id is a conversation like any other. Repeated rows are duplicates. Turns may
be any numbers. A conversation is streamed through a task in its order, never gathered: what is held of it is one
letter for each row, as the audit itself has. An empty table gives no rows. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .batches import small_batches
from .scratch import Scratch

#: ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar: the beginning, after a system row, after a user row, after an assistant row.
STATES, START, ENDS = range(4), 0, (0, 3)
#: The state after the role that the grammar wants in each state, and that role.
NEXT, WANTED = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: Pairs of initials that may follow each other.
LEGAL = ("su", "ua", "au")
NEVER = 1 << 40


def kept(state: int, letter: str) -> int | None:
    """The state after a row with this role is kept, None if it cannot be."""
    if letter == "s":
        return 1 if state == START else None
    return NEXT[state] if letter == WANTED[state][0] else None


def _closed(before: list[tuple[int, str]]) -> tuple[tuple[int, ...], str]:
    """Costs and first letters, after insertions were tried in every state."""
    costs = [cost for cost, _ in before]
    for _ in STATES:
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    first = [min((costs[s], own) if cost == costs[s] else (NEVER, "~"), (INSERT + costs[NEXT[s]], "I"))[1]
             for s, (cost, own) in enumerate(before)]
    return tuple(costs), "".join(first)


#: The node of the empty suffix: a point means that nothing follows.
END = _closed([(0, ".") if s in ENDS else (NEVER, "~") for s in STATES])


def node(letter: str, following: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """(cost to the end, first letter of the audit) in each state, for a row in front of a suffix with these costs.

    ``letter`` is d for a row that has to go, else the initial of its role (x: none of the grammar), in upper case if truncated.
    """
    more, own = TRUNCATED * letter.isupper(), letter.lower()
    options = []
    for state in STATES:
        found = [(DELETE + following[state], "D")]
        if own != "d":
            after = kept(state, own)
            found += [(KEEP + more + following[after], "K")] if after is not None else []
            found.append((REROLE + more + following[NEXT[state]], "R"))
        options.append(min(found))
    return _closed(options)


class Suffixes:
    """The nodes of one signature from its end, and those worked out before."""

    def __init__(self) -> None:
        self._known: dict[tuple[str, tuple[int, ...]], tuple[tuple[int, ...], str]] = {}
        self._letters: str = ""
        self._nodes: list[tuple[int, tuple[int, ...], str]] = [(0, *END)]

    def _node(self, letter: str, base: int, following: tuple[int, ...]) -> tuple[int, tuple[int, ...], str]:
        found = self._known.get((letter, following))
        if found is None:
            found = self._known[letter, following] = node(letter, following)
        costs, first = found
        least = min(costs)
        return base + least, tuple(c - least for c in costs), first

    def solve(self, backwards: str) -> tuple[int, str]:
        """(cost, audit) of a signature given from its end; it shares the nodes of what the one before begins with."""
        common = 0
        for a, b in zip(self._letters, backwards):
            if a != b:
                break
            common += 1
        del self._nodes[common + 1:]
        for letter in backwards[common:]:
            self._nodes.append(self._node(letter, *self._nodes[-1][:2]))
        self._letters = backwards
        base, costs, _ = self._nodes[-1]
        return base + costs[START], self._audit()

    def _audit(self) -> str:
        at, state, audit = len(self._letters), START, []
        while (edit := self._nodes[at][2][state]) != ".":
            audit.append(edit)
            if edit == "I":
                state = NEXT[state]
                continue
            at -= 1
            if edit == "K":
                state = kept(state, self._letters[at].lower())
            elif edit == "R":
                state = NEXT[state]
        return "".join(audit)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    suffixes = Suffixes()
    for batch in batches:
        backwards = batch.column("backwards").to_pylist()
        found = [suffixes.solve(s) for s in backwards]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s[::-1] for s in backwards], pa.string()), pa.array([c for c, _ in found], pa.int64()),
             pa.array([a for _, a in found], pa.string())], names=["signature", "cost", "audit"])


def solved(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit for each distinct ``signature``."""
    backwards = signatures.select(F.reverse("signature").alias("backwards")).distinct()
    tasks = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return backwards.repartitionByRange(tasks, "backwards").sortWithinPartitions("backwards").mapInArrow(
        _solved, "signature string, cost long, audit string")


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Faults and signature of each conversation, from rows in order; a row that is not there only names its conversation."""
    kinds = ("blank", "duplicate", "truncated")
    current, kind = None, None

    def done(found: dict) -> pa.RecordBatch:
        turns = found["last"] - found["first"] + 1 - found["turns"] if found["turns"] else 0
        return pa.RecordBatch.from_arrays(
            [pa.array([found["id"]], kind), *[pa.array([n], pa.int64()) for n in (turns, *[found[k] for k in kinds], found["illegal"])],
             pa.array([found["letters"].decode()], pa.string())], names=["id", "gaps", *kinds, "illegal", "signature"])

    for batch in batches:
        kind = batch.column("id").type
        made = []
        for row in batch.to_pylist():
            if current is None or current["id"] != row["id"]:
                if current is not None:
                    made.append(done(current))
                current = {"id": row["id"], "letters": bytearray(), "turns": 0, "first": 0, "last": None, "illegal": 0, "initial": None,
                           **dict.fromkeys(kinds, 0)}
            if not row["there"]:
                continue
            turn, initial, fault = row["turn"], row["role"][:1], row["fault"]
            if turn is not None and turn != current["last"]:
                current["first"] = current["first"] if current["turns"] else turn
                current["turns"], current["last"] = current["turns"] + 1, turn
            current["illegal"] += current["initial"] is not None and current["initial"] + initial not in LEGAL
            current["initial"] = initial
            if fault:
                current[fault] += 1
            letter = initial if initial in ("s", "u", "a") else "x"
            current["letters"] += (letter.upper() if fault == "truncated" else "d" if fault else letter).encode()
        if made:
            yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
    if current is not None:
        yield done(current)


def prepared(rows: DataFrame, *, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
             text_column: str = "text") -> DataFrame:
    """id, turn, role, text, digest of each row, with NULL roles and texts as one space."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_column, "role"), (text_column, "text"))]
    named = rows.select(F.col(id_column).alias("id"), F.col(turn_column).cast("long").alias("turn"), *filled)
    return named.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))


def described(rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """id, gaps, blank, duplicate, truncated, illegal, signature of each conversation of prepared ``rows`` and of each id in ``names``.

    Texts stay where they are: what is shuffled is their digest and their fault.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    state = F.when(end == "", "blank").when(F.right(end, F.lit(1)).isin(".", "!", "?"), "").otherwise("truncated")
    narrow = rows.select("id", "turn", "role", "digest", state.alias("state"), F.lit(True).alias("there"))
    if names is not None:
        narrow = narrow.unionByName(names.select("id", F.lit(False).alias("there")).distinct(), allowMissingColumns=True)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = narrow.repartition(tasks, "id")
    seen = F.row_number().over(Window.partitionBy("id", "role", "digest", "there").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(F.col("state") == "blank", "blank").when(seen, "duplicate").otherwise(F.nullif("state", F.lit("")))
    ordered = placed.withColumn("fault", fault).drop("state").sortWithinPartitions("id", *_order())
    kind = rows.schema["id"].dataType.simpleString()
    return ordered.mapInArrow(
        _described, f"id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows after their edits; the audit of a conversation stands before its rows."""
    walk: _Walk | None = None
    kind = None
    for batch in batches:
        kind = batch.column("id").type
        made = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                made += walk.inserted() if walk else []
                walk = _Walk(row["id"], row["audit"])
            else:
                made += walk.row(row["role"], row["text"])
        yield _rows(made, kind)
    if walk:
        yield _rows(walk.inserted(), kind)


class _Walk:
    """A conversation on its way through its audit."""

    def __init__(self, name, audit: str) -> None:
        self._name, self._audit, self._at, self._state, self._place = name, audit, 0, START, 0

    def _emit(self, role: str, text: str, edit: str) -> dict:
        self._place += 1
        return {"id": self._name, "place": self._place, "role": role, "text": text, "edit": edit}

    def inserted(self) -> list[dict]:
        """The rows that are inserted here."""
        made = []
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            made.append(self._emit(WANTED[self._state], "", "I"))
            self._state, self._at = NEXT[self._state], self._at + 1
        return made

    def row(self, role: str, text: str) -> list[dict]:
        made = self.inserted()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            made.append(self._emit(role, text, edit))
            self._state = kept(self._state, role[:1])
        elif edit == "R":
            made.append(self._emit(WANTED[self._state], text, edit))
            self._state = NEXT[self._state]
        return made


def _rows(made: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(made, pa.schema([
        ("id", kind), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """id, place, role, text, edit: prepared ``rows`` after the edits of ``audits`` (id, audit), each conversation in order.

    The rows of a conversation are in one partition and in their order.
    """
    given = rows.select("id", "turn", "role", "text", "digest").unionByName(audits.select("id", "audit"), allowMissingColumns=True)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = given.repartition(tasks, "id").sortWithinPartitions("id", F.col("audit").isNull(), *_order()).drop("turn", "digest")
    kind = rows.schema["id"].dataType.simpleString()
    return ordered.mapInArrow(_applied, f"id {kind}, place long, role string, text string, edit string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest, kind = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()], pa.string())], names=["id", "sha256"])

    for batch in batches:
        kind = batch.column("id").type
        for name, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "place", "role", "text"))):
            if place == 1:
                if digest is not None:
                    yield done()
                current, digest = name, hashlib.sha256()
            digest.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode())
    if digest is not None:
        yield done()


def digests(repaired_rows: DataFrame) -> DataFrame:
    """id, sha256 of ``role:text`` of the rows of each conversation, joined by newlines; none for those without rows."""
    kind = repaired_rows.schema["id"].dataType.simpleString()
    return repaired_rows.mapInArrow(_hashed, f"id {kind}, sha256 string")


def repair(rows: DataFrame, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows) of prepared ``rows``; conversations that are only in ``names`` (id) have no rows.

    The report has id, gaps, blank, duplicate, truncated, illegal, cost and audit. The input is read twice, the texts are shuffled once.
    """
    small_batches(rows.sparkSession)
    with Scratch(rows.sparkSession) as scratch:
        found = scratch.store(described(rows, names), "signatures")
        best = scratch.store(solved(found.select("signature")), "audits")
        report = scratch.store(found.join(best, "signature").drop("signature"), "reports")
        scratch.keep(report)
    return report, repaired(rows, report)


def damaged(rows: DataFrame, *, id_column: str = "conv_id", turn_column: str = "turn") -> DataFrame:
    """Prepared rows with planted faults, told by crc32 of ``id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its final marks, 3 repeats it, 4 makes it a user's.
    """
    def name(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(name(id_column), F.lit(":"), name(turn_column)).cast("binary")) % 20
    given = rows.select(id_column, turn_column, "role", F.coalesce(F.col("text"), F.lit(" ")).alias("text")).withColumn("fate", fate)
    changed = given.where("fate <> 0").select(
        id_column, turn_column, F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return prepared(changed.drop("copy"), id_column=id_column, turn_column=turn_column)
