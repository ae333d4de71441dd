"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed if it is empty, or an optional system turn followed by pairs of user and
assistant turns. Edits per row: Delete (4, forced for blank and duplicate rows), Insert an empty user
or assistant turn before it (3), Keep (0) and Rerole to user or assistant (3); a truncated row that is
not deleted costs 3 more. The cheapest audit, the edits' initials in order, is wanted, and the least
in ASCII order among equals.

The search is a depth-first one that tries edits in ASCII order under a bound on the cost. A table
keeps, for every row and grammar state that failed, what at least is still missing there; it cuts
branches, raises the bound to the least cost that is not excluded, and starts as the sum of the rows'
own unavoidable costs. The first accepting path is the cheapest and the least in ASCII order.

A conversation of any length is spread over tasks: rows are cut by range of (conv_id, turn, role,
text), a task searches stretches of at most `STRETCH` rows for every pair of grammar states they may
begin and end in, and joins the answers of neighbouring stretches. Only conversations that reach over
a task's range are put together afterwards, from one row a task. Equal rows travel as one row with a
count. The repaired turns are then made in one sorted stream, which holds the audit and one batch of
rows; the hash of one conversation's text is a chain, so one task reads that conversation.

Defined results: nulls in role and text are one space, an empty role has that initial too; rows are
taken by turn (null first), then role, then the text's first 64 characters, then its SHA-256; rows
that agree in all of these are repetitions; a null conv_id is a conversation of its own; a
conversation without rows has zeros, an empty audit and no turns; an empty table gives an empty
result; columns other than conv_id, turn, role and text (and `copies`, if told) are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scope
from . import common
from .registry import query

# Costs and the characters of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = [".", "!", "?"]

STRETCH = 32  # rows searched at once
HEAD = 64  # characters of a text that take part in the order of rows of one turn and role
REMEMBERED = 1 << 15  # searches a task remembers
OUT_ROWS, OUT_CHARACTERS = 1000, 4 << 20  # size of a batch of repaired turns

# Grammar states: nothing yet, after a system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT, ACCEPTED = range(5)
# What the end still needs, as inserted turns.
MISSING = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
FINE, BLANK, DUPLICATE, CUT = "fbdc"
_NEVER = 1 << 60


def after(state: int, initial: str) -> int | None:
    """The state after a turn with this role initial, None where the grammar forbids it."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def made(state: int) -> int:
    """The state after an inserted or reroled turn: an assistant turn after a user turn, else a user turn."""
    return ASSISTANT if state == USER else USER


class Search:
    """Cheapest edits of one stretch of rows for one goal: ACCEPTED, or the state after the last row."""

    def __init__(self, initials: str, faults: str, goal: int):
        self.initials, self.faults, self.n = initials, faults, len(initials)
        own = [DELETE if f in (BLANK, DUPLICATE) else TRUNCATED if f == CUT else 0 for f in faults]
        rest = [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            rest[i] = rest[i + 1] + own[i]
        # need[i][q]: what the rows from i on cost at least, beginning in state q.
        if goal == NOTHING:
            self.need = [[DELETE * (self.n - i), _NEVER, _NEVER, _NEVER] for i in range(self.n)]
        elif goal == SYSTEM:
            keeps = [False] * (self.n + 1)  # a system turn that may be kept stands at i or later
            for i in range(self.n - 1, -1, -1):
                keeps[i] = keeps[i + 1] or (initials[i] == "s" and faults[i] in (FINE, CUT))
            self.need = [[DELETE * (self.n - i - 1) if keeps[i] else _NEVER, DELETE * (self.n - i), _NEVER, _NEVER]
                         for i in range(self.n)]
        else:
            self.need = [[rest[i]] * 4 for i in range(self.n)]
        self.need.append([INSERT * MISSING[q] if goal == ACCEPTED else 0 if q == goal else _NEVER for q in range(4)])

    def run(self, entry: int) -> tuple[int, str] | None:
        """(cost, audit), None if the goal cannot be reached from `entry`."""
        while (bound := self.need[0][entry]) < _NEVER:
            path: list[str] = []
            if self._reaches(0, entry, bound, path):
                return bound, "".join(path)
        return None

    def _moves(self, i: int, q: int):
        yield "D", DELETE, i + 1, q
        yield "I", INSERT, i, made(q)
        fault = self.faults[i]
        if fault in (FINE, CUT):
            extra = TRUNCATED if fault == CUT else 0
            kept = after(q, self.initials[i])
            if kept is not None:
                yield "K", extra, i + 1, kept
            yield "R", REROLE + extra, i + 1, made(q)

    def _reaches(self, i: int, q: int, budget: int, path: list[str]) -> bool:
        need = self.need
        if i == self.n:
            if need[i][q] > budget:
                return False
            path.append("I" * (need[i][q] // INSERT))
            return True
        least = _NEVER
        for letter, cost, j, r in self._moves(i, q):
            if cost + need[j][r] <= budget:
                path.append(letter)
                if self._reaches(j, r, budget - cost, path):
                    return True
                path.pop()
            least = min(least, cost + need[j][r])
        need[i][q] = least
        return False


def moves_of(initials: str, faults: str, entries, goals) -> dict[tuple[int, int], tuple[int, str]]:
    """(entry, goal) -> (cost, audit) of a stretch, for all pairs that can be."""
    found = {}
    for goal in goals:
        search = Search(initials, faults, goal)
        for entry in entries:
            if (answer := search.run(entry)) is not None:
                found[entry, goal] = answer
    return found


def join_moves(first: dict, second: dict) -> dict:
    """Edits of two neighbouring stretches. Audits of the same rows are never beginnings of one
    another, so among equal costs the audit of the first stretch decides."""
    found: dict = {}
    for (p, r), (cost, audit) in first.items():
        for (r2, q), (cost2, audit2) in second.items():
            if r == r2:
                option = (cost + cost2, audit, audit2)
                if (p, q) not in found or option < found[p, q]:
                    found[p, q] = option
    return {k: (cost, a + b) for k, (cost, a, b) in found.items()}


def accept(moves: dict) -> tuple[int, str]:
    """The cheapest audit from the beginning to a well-formed end."""
    cost, audit, end = min((cost + INSERT * MISSING[q], audit, "I" * MISSING[q])
                           for (p, q), (cost, audit) in moves.items() if p == NOTHING)
    return cost, audit + end


STATS = ["rows", "blank", "duplicate", "truncated", "illegal", "turns", "least", "most"]


class Piece:
    """One conversation's rows in one task, read in order."""

    def __init__(self, key: tuple, first_of_task: bool, remembered: dict):
        self.key, self.first_of_task, self.remembered = key, first_of_task, remembered
        self.n = dict.fromkeys(STATS, 0) | {"least": None, "most": None}
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None
        self.initials, self.faults = [], []  # of the stretch that is open
        self.joined: list[tuple[int, dict]] = []  # (size class, moves) of the stretches before

    def add(self, turn, initial: str, fault: str, copies: int) -> None:
        n = self.n
        if n["rows"] == 0:
            self.first_turn, self.first_initial = turn, initial
        elif self.last_initial + initial not in ("su", "ua", "au"):
            n["illegal"] += 1
        if turn is not None:
            if turn != self.last_turn:
                n["turns"] += 1
            n["least"], n["most"] = turn if n["least"] is None else n["least"], turn
        n["illegal"] += copies - 1  # equal rows have equal roles, which never alternate
        n["rows"] += copies
        self.last_turn, self.last_initial = turn, initial
        for name, letter in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT)):
            n[name] += fault == letter
        again = BLANK if fault == BLANK else DUPLICATE
        n["blank" if again == BLANK else "duplicate"] += copies - 1
        for k in range(copies):
            if len(self.initials) == STRETCH:
                self._close()
            self.initials.append(initial)
            self.faults.append(again if k else fault)

    def _search(self, entries, goals) -> dict:
        about = "".join(self.initials), "".join(self.faults), entries, goals
        if about not in self.remembered:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[about] = moves_of(*about)
        return self.remembered[about]

    def _close(self) -> None:
        entries = (NOTHING,) if not self.joined and not self.first_of_task else (NOTHING, SYSTEM, USER, ASSISTANT)
        moves, size = self._search(entries, (NOTHING, SYSTEM, USER, ASSISTANT)), 0
        while self.joined and self.joined[-1][0] == size:  # equal sizes are joined, as in a binary counter
            moves, size = join_moves(self.joined.pop()[1], moves), size + 1
        self.joined.append((size, moves))
        self.initials, self.faults = [], []

    def finish(self, last_of_task: bool) -> dict:
        """The row of this piece: whole with its answer, or open with the moves of all pairs of states."""
        whole = not self.first_of_task and not last_of_task
        if whole and not self.joined:
            moves = self._search((NOTHING,), (ACCEPTED,))
        else:
            self._close()
            moves = self.joined.pop()[1]
            while self.joined:
                moves = join_moves(self.joined.pop()[1], moves)
            if whole:
                moves = {(NOTHING, ACCEPTED): accept(moves)}
        conv_id, turn, role, head, digest = self.key
        return {"conv_id": conv_id, "turn": turn, "role": role, "head": head, "digest": digest, "whole": whole, **self.n,
                "first_turn": self.first_turn, "last_turn": self.last_turn,
                "first_initial": self.first_initial, "last_initial": self.last_initial,
                "moves": [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in moves.items()]}


ORDER = ["conv_id", "turn", "role", "head", "digest"]
_PIECE = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("head", pa.string()), ("digest", pa.string()),
     ("whole", pa.bool_()), *((s, pa.int64()) for s in STATS), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
     ("first_initial", pa.string()), ("last_initial", pa.string()),
     ("moves", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
_PIECE_DDL = ("conv_id long, turn long, role string, head string, digest string, whole boolean, "
              + ", ".join(f"{s} long" for s in STATS) + ", first_turn long, last_turn long, first_initial string, "
              "last_initial string, moves array<struct<p: int, q: int, cost: long, audit: string>>")
VERDICT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_VERDICT = pa.schema([("conv_id", pa.int64()), *((s, pa.int64()) for s in VERDICT), ("audit", pa.string())])
_VERDICT_DDL = "conv_id long, " + ", ".join(f"{s} long" for s in VERDICT) + ", audit string"


def prepared(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, head, digest, copies: the rows with nulls replaced and their order."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        text.alias("text"), F.substring(text, 1, HEAD).alias("head"), F.sha2(text.cast("binary"), 256).alias("digest"),
        (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """Distinct rows in a conversation with their number of copies and the fault of the first copy."""
    seen = F.rtrim("text", F.lit(BLANK_CHARACTERS))
    one = rows.where("copies > 0").withColumns({
        "blank": seen == "", "cut": ~F.substring(seen, -1, 1).isin(SENTENCE_ENDS),
    }).groupBy(*ORDER, "blank", "cut").agg(F.sum("copies").alias("copies"))
    again = one.where("not blank").groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select(
        F.col("conv_id").alias("conv_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"), "first")
    same = (F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_"))
            & (F.col("digest") == F.col("digest_")))
    fault = F.when(F.col("blank"), BLANK).when(
        F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn")), DUPLICATE).when(
        F.col("cut"), CUT).otherwise(FINE)
    return one.join(again, same, "left").select(*ORDER, fault.alias("fault"), "copies")


def pieces(rows: DataFrame) -> DataFrame:
    """Conversations or their parts in one task's range, with the cheapest edits; rows as from `judged`."""
    def run(batches):
        remembered: dict = {}
        piece, out = None, []
        for batch in batches:
            for conv_id, turn, role, head, digest, fault, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None or conv_id != piece.key[0]:
                    if piece is not None:
                        out.append(piece.finish(False))
                    piece = Piece((conv_id, turn, role, head, digest), piece is None, remembered)
                piece.add(turn, role[:1] or " ", fault, copies)
            if out:
                yield pa.RecordBatch.from_pylist(out, _PIECE)
                out = []
        if piece is not None:
            yield pa.RecordBatch.from_pylist([piece.finish(True)], _PIECE)

    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, _PIECE_DDL)


def verdicts(found: DataFrame) -> DataFrame:
    """One row per conversation from its pieces: counts, cost and audit."""
    def verdict(p: dict, cost: int, audit: str) -> dict:
        span = 0 if p["least"] is None else p["most"] - p["least"] + 1
        return {"conv_id": p["conv_id"], "gaps": span - p["turns"], "cost": cost, "audit": audit,
                **{s: p[s] for s in ("blank", "duplicate", "truncated", "illegal")}}

    def put_together(batches):
        held = moves = None
        for batch in batches:
            for p in batch.to_pylist():
                own = {(m["p"], m["q"]): (m["cost"], m["audit"]) for m in p["moves"]}
                if held is None or p["conv_id"] != held["conv_id"]:
                    if held is not None:
                        yield pa.RecordBatch.from_pylist([verdict(held, *accept(moves))], _VERDICT)
                    held, moves = p, own
                    continue
                moves = join_moves(moves, own)
                for s in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
                    held[s] += p[s]
                held["illegal"] += held["last_initial"] + p["first_initial"] not in ("su", "ua", "au")
                held["turns"] -= p["first_turn"] is not None and p["first_turn"] == held["last_turn"]
                held["least"] = p["least"] if held["least"] is None else held["least"]
                held["most"] = held["most"] if p["most"] is None else p["most"]
                held["last_turn"], held["last_initial"] = p["last_turn"], p["last_initial"]
        if held is not None:
            yield pa.RecordBatch.from_pylist([verdict(held, *accept(moves))], _VERDICT)

    own = F.col("moves")[0]
    gaps = F.coalesce(F.col("most") - F.col("least") + 1, F.lit(0)) - F.col("turns")
    whole = found.where("whole").select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                                        own["cost"].alias("cost"), own["audit"].alias("audit"))
    over = found.where("not whole").repartition("conv_id").sortWithinPartitions(*ORDER)
    return whole.unionByName(over.mapInArrow(put_together, _VERDICT_DDL))


_TURN = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                   ("role", pa.string()), ("text", pa.string()), *((s, pa.int64()) for s in VERDICT), ("audit", pa.string())])
_TURN_DDL = ("conv_id long, place long, edit string, turn long, role string, text string, "
             + ", ".join(f"{s} long" for s in VERDICT) + ", audit string")
_NAMES = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}  # role made in a state


def replay(rows: DataFrame, verdict: DataFrame) -> DataFrame:
    """The repaired turns of each conversation in order (place from 0), after a row of place -1 that
    carries its verdict. Rows of one conversation follow one another in one partition."""
    columns = [*ORDER, "kind", "text", "copies", *VERDICT, "audit"]
    blank = {c: F.lit(None).cast(t) for c, t in
             [("turn", "long"), ("role", "string"), ("head", "string"), ("digest", "string"), ("text", "string"),
              ("copies", "long"), ("audit", "string"), *((s, "long") for s in VERDICT)]}
    told = verdict.withColumns({"kind": F.lit(0)} | {c: blank[c] for c in ("turn", "role", "head", "digest", "text", "copies")})
    read = rows.withColumns({"kind": F.lit(1)} | {c: blank[c] for c in (*VERDICT, "audit")})
    stream = told.select(*columns).unionByName(read.select(*columns)).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", *ORDER[1:]).select("conv_id", "kind", "turn", "role", "text", "copies", *VERDICT, "audit")

    def run(batches):
        out, size = [], 0
        conv, audit, at, place, state = object(), "", 0, 0, NOTHING

        def turn_row(edit, turn, role, text):
            nonlocal place, size
            out.append({"conv_id": conv, "place": place, "edit": edit, "turn": turn, "role": role, "text": text})
            place, size = place + 1, size + len(text)

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                turn_row("I", None, _NAMES[state], "")
                at, state = at + 1, made(state)

        def begin(r, told):
            nonlocal conv, audit, at, place, state
            if conv is not start:
                inserts()
            conv, at, place, state = r["conv_id"], 0, 0, NOTHING
            audit = r["audit"] if told else ""
            out.append({"conv_id": conv, "place": -1, "audit": audit} | {s: r[s] if told else 0 for s in VERDICT})

        start = conv
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0 or conv is start or r["conv_id"] != conv:
                    begin(r, r["kind"] == 0)
                if r["kind"] == 0:
                    continue
                for _ in range(r["copies"]):
                    inserts()
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        turn_row(edit, r["turn"], r["role"], r["text"])
                        state = after(state, r["role"][:1] or " ")
                    elif edit == "R":
                        turn_row(edit, r["turn"], _NAMES[state], r["text"])
                        state = made(state)
                    if len(out) >= OUT_ROWS or size >= OUT_CHARACTERS:
                        yield pa.RecordBatch.from_pylist(out, _TURN)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, _TURN)
                out, size = [], 0
        if conv is not start:
            inserts()
            if out:
                yield pa.RecordBatch.from_pylist(out, _TURN)

    return stream.mapInArrow(run, _TURN_DDL)


def digest(turns: DataFrame) -> DataFrame:
    """One row per conversation of `replay`: its verdict and the SHA-256 of its `role:text` lines."""
    columns = ["conv_id", *VERDICT, "audit", "repaired_sha256"]
    schema = pa.schema([*_VERDICT, ("repaired_sha256", pa.string())])

    def run(batches):
        held = hashed = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["place"] < 0:
                    if held is not None:
                        out.append(held | {"repaired_sha256": hashed.hexdigest()})
                    held, hashed = {c: r[c] for c in columns[:-1]}, hashlib.sha256()
                else:
                    hashed.update(f"{chr(10) if r['place'] else ''}{r['role']}:{r['text']}".encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held | {"repaired_sha256": hashed.hexdigest()}], schema)

    return turns.mapInArrow(run, _VERDICT_DDL + ", repaired_sha256 string")


def repair(scope: Scope, rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The stream of `replay` for conversations (conv_id, turn, role, text). `copies` names a column with
    the number of times a row counts; a conversation whose rows count zero times is still reported."""
    ready = prepared(rows, copies)
    found = scope.table(pieces(scope.table(judged(ready), "rows")), "pieces")
    return replay(ready, scope.table(verdicts(found), "verdicts"))


def repaired(scope: Scope, rows: DataFrame) -> DataFrame:
    """conv_id, place, edit, turn, role, text of all repaired conversations; turn is null where inserted."""
    return repair(scope, rows).where("place >= 0").select("conv_id", "place", "edit", "turn", "role", "text")


def damage(rows: DataFrame) -> DataFrame:
    """The rows as the contract damages them, by crc32 of `conv_id:turn`; `copies` is 0 for dropped ones."""
    def part(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", part("conv_id"), part("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark, sf_dir):
    common.small_batches(spark)
    with Scope(spark, "repair") as scope:
        rows = damage(common.table(spark, sf_dir, "conversations"))
        return scope.keep(digest(repair(scope, rows, "copies")))
