"""Repair of conversations by the cheapest edits, one pass over sorted turns.

Rows are dealt by conversation and sorted by turn; a task reads them batch by batch. What
the edits leave must read ``s?(ua)+`` by role initials, or nothing. Four places in that
pattern (nothing yet, after s, after u, after a) each carry the cost of the cheapest edits
that lead there and the order of their audit strings. Up to a constant only few such
situations exist, so they are numbered once, and a row moves from one number to the next.
Going back over the numbers gives the edits. What a conversation needs for that, three bytes a row
and its texts, goes to a temporary file of the task when it is large.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import SPACE, need

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3  # of a truncated row that stays

_START, _S, _U, _A = range(4)
_GO = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}
_NEXT = {_START: "u", _S: "u", _U: "a", _A: "u"}  # the only initial that an insert or a new role may have
_ROLE = {"u": "user", "a": "assistant"}
#: Two inserts and a deletion make up for any other place, so whatever costs more than that never wins.
_BEHIND = 2 * COST[INSERT] + COST[DELETE]
_INITIALS = "sua"
_OTHER = 3  # code of any other initial
_SOUND, _TRUNCATED, _DUPLICATE, _BLANK, _ABSENT = range(5)
_LEGAL = (_INITIALS.index("s") * 4 + 1, 1 * 4 + 2, 2 * 4 + 1)


class Moves:
    """The situations that rows can lead to, and the edits between them."""

    def __init__(self):
        first = ((0, None, None, None), (0, 0, 0, 0))
        self.numbers, queue = {first: 0}, [first]
        self.step: list[list[int]] = []  # by situation and code of a row: the next situation
        self.paid: list[list[int]] = []  # what the cheapest cost rises by
        self.back: list[list[list]] = []  # by place after the row: the place before it, and the edits
        self.last: list[tuple[int, int, int]] = []  # cost left, place and inserts at the end
        while len(self.step) < len(queue):
            costs, order = queue[len(self.step)]
            steps, paid, back = [], [], []
            for code in range(12):
                after, cheapest, came = self._after(costs, order, code)
                if after not in self.numbers:
                    self.numbers[after] = len(queue)
                    queue.append(after)
                steps.append(self.numbers[after]), paid.append(cheapest), back.append(came)
            self.step.append(steps), self.paid.append(paid), self.back.append(back)
            ends = [
                (costs[p] + COST[INSERT] * n, order[p], p, n)
                for p, n in ((_START, 0), (_A, 0), (_U, 1), (_S, 2))
                if costs[p] is not None
            ]
            cost, _, place, n = min(ends)
            self.last.append((cost, place, n))

    def _after(self, costs, order, code):
        fault, initial = divmod(code, 4)
        found = [[] for _ in range(4)]
        for before, cost in enumerate(costs):
            if cost is None:
                continue
            place, edits = before, ""
            for _ in range(3):
                here = [(place, DELETE)]
                if fault < _DUPLICATE:
                    here.append((_GO[place, _NEXT[place]], REROLE))
                    if initial != _OTHER and (place, _INITIALS[initial]) in _GO:
                        here.append((_GO[place, _INITIALS[initial]], KEEP))
                for to, edit in here:
                    extra = TRUNCATED_COST if fault == _TRUNCATED and edit != DELETE else 0
                    # Strings that end in different places never start one another, so their order decides.
                    found[to].append((cost + COST[edit] + extra, order[before], edits + edit, before))
                place, edits, cost = _GO[place, _NEXT[place]], edits + INSERT, cost + COST[INSERT]
        best = [min(f) if f else None for f in found]
        cheapest = min(b[0] for b in best if b)
        best = [b if b and b[0] <= cheapest + _BEHIND else None for b in best]
        ranked = sorted((b[1], b[2], k) for k, b in enumerate(best) if b)
        places = [0] * 4
        for n, (_, _, k) in enumerate(ranked):
            places[k] = n
        after = (tuple(b[0] - cheapest if b else None for b in best), tuple(places))
        return after, cheapest, [(b[3], b[2][::-1]) if b else None for b in best]


class _Tape:
    """Blobs in the order they came, to be read from either end; in a file beyond ``most`` bytes."""

    def __init__(self, most: int):
        self.file, self.ends = tempfile.SpooledTemporaryFile(max_size=most), [0]

    def add(self, blob: bytes) -> None:
        self.file.seek(self.ends[-1])
        self.file.write(blob)
        self.ends.append(self.ends[-1] + len(blob))

    def blobs(self, backwards: bool = False) -> Iterator[bytes]:
        spans = list(zip(self.ends[:-1], self.ends[1:]))
        for a, b in reversed(spans) if backwards else spans:
            self.file.seek(a)
            yield self.file.read(b - a)


class Conversation:
    """The state that one conversation carries from batch to batch."""

    def __init__(self, moves: Moves, key: pa.Scalar, spill: int):
        self.moves, self.key, self.kind, self.spill = moves, key.as_py(), key.type, spill
        self.cost = self.at = self.held = 0
        self.faults, self.illegal = [0] * 5, 0
        self.initial = self.first_turn = self.last_turn = None
        self.turns = 0
        self.steps: list[tuple[list[int], list[int]]] = []
        self.rows: list[pa.RecordBatch] = []
        self.step_tape = self.row_tape = None

    def add(self, codes: list[int], turns: list, rows: pa.RecordBatch) -> None:
        """Rows that follow: their codes, turns, and ``role`` and ``text``."""
        step, paid, at, cost = self.moves.step, self.moves.paid, self.at, self.cost
        path, initial = [], self.initial
        for code in codes:
            fault, now = divmod(code, 4)
            self.faults[fault] += 1
            if initial is not None and initial * 4 + now not in _LEGAL:
                self.illegal += 1
            initial = now
            if fault >= _DUPLICATE:
                code = _DUPLICATE * 4
            path.append(at)
            cost += paid[at][code]
            at = step[at][code]
        self.at, self.cost, self.initial = at, cost, initial
        for turn in turns:
            if turn is not None:
                if turn != self.last_turn or not self.turns:
                    self.turns += 1
                self.first_turn = turn if self.first_turn is None else self.first_turn
                self.last_turn = turn
        self.steps.append((codes, path))
        self.rows.append(rows)
        self.held += len(codes)
        if self.step_tape is not None or self.held > self.spill:
            self._unload()

    def _unload(self) -> None:
        if self.step_tape is None:
            self.step_tape, self.row_tape = _Tape(1 << 20), _Tape(1 << 20)
        for codes, path in self.steps:
            self.step_tape.add(np.array([codes, path], np.uint16).tobytes())
        for rows in self.rows:
            self.row_tape.add(pickle.dumps([c.to_pylist() for c in rows.columns]))
        self.steps, self.rows = [], []

    def _steps_back(self) -> Iterator[tuple[list[int], list[int]]]:
        if self.step_tape is None:
            yield from reversed(self.steps)
        else:
            for blob in self.step_tape.blobs(backwards=True):
                codes, path = np.frombuffer(blob, np.uint16).reshape(2, -1).tolist()
                yield codes, path

    def _rows(self) -> Iterator[tuple[list[str], list[str]]]:
        if self.row_tape is None:
            for batch in self.rows:
                yield batch["role"].to_pylist(), batch["text"].to_pylist()
        else:
            yield from map(pickle.loads, self.row_tape.blobs())

    def finish(self) -> str:
        """The audit string; ``cost`` is then the total."""
        left, place, inserts = self.moves.last[self.at]
        self.cost += left
        back, edits = self.moves.back, [INSERT * inserts]
        for codes, path in self._steps_back():
            for code, at in zip(reversed(codes), reversed(path)):
                place, edit = back[at][code if code < _DUPLICATE * 4 else _DUPLICATE * 4][place]
                edits.append(edit)
        return "".join(edits)[::-1]

    def repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of every row that the edits leave."""
        place, todo = _START, iter(audit)

        def inserted():
            nonlocal place
            role = _NEXT[place]
            place = _GO[place, role]
            return INSERT, _ROLE[role], ""

        for roles, texts in self._rows():
            for role, text in zip(roles, texts):
                while (edit := next(todo)) == INSERT:
                    yield inserted()
                if edit == REROLE:
                    role = _ROLE[_NEXT[place]]
                if edit != DELETE:
                    place = _GO[place, role[0]]
                    yield edit, role, text
        for _ in todo:
            yield inserted()

    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0


def _conversations(batches: Iterator[pa.RecordBatch], spill: int) -> Iterator[Conversation]:
    """Each conversation once its last row was read."""
    moves, now = Moves(), None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch["key"].dictionary_encode(null_encoding="encode")
        numbers = keys.indices.to_numpy(zero_copy_only=False)
        heads = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(batch)]
        codes, turns = batch["code"].to_pylist(), batch["turn"].to_pylist()
        rows = batch.select(["role", "text"])
        for a, b in zip(heads[:-1], heads[1:]):
            key = batch["key"][a]
            if now is None or key.as_py() != now.key:
                if now is not None:
                    yield now
                now = Conversation(moves, key, spill)
            while b > a and codes[b - 1] >= _ABSENT * 4:  # rows that only name their conversation come last
                b -= 1
            if b > a:
                now.add(codes[a:b], turns[a:b], rows.slice(a, b - a))
    if now is not None:
        yield now


def _sorted(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """Rows dealt by conversation, sorted by turn, with the code of fault and role initial."""
    need(df, id_col, turn_col, role_col, text_col)
    rows = df.select(
        F.col(id_col).alias("key"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        (F.lit(False) if present is None else ~present).alias("absent"),
    ).repartition("key")
    # Both orders need rows of one conversation together, so one exchange serves them.
    same = Window.partitionBy("key", "absent", "role", "text").orderBy("turn")
    core = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(F.col("absent"), _ABSENT)
        .when(core == "", _BLANK)
        .when(F.row_number().over(same) > 1, _DUPLICATE)
        .when(~F.substring(core, -1, 1).isin(".", "!", "?"), _TRUNCATED)
        .otherwise(_SOUND)
    )
    initial = F.substring("role", 1, 1)
    number = F.lit(_OTHER)
    for k, letter in enumerate(_INITIALS):
        number = F.when(initial == letter, k).otherwise(number)
    return (
        rows.withColumn("code", fault * 4 + number)
        .sortWithinPartitions("key", "absent", "turn", "role", "text")
        .select("key", "turn", "role", "text", "code")
    )


def _batch(rows: list, kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    key, *others = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(key, kind), *map(pa.array, others)], names)


def repair(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    spill: int = 100_000,
) -> DataFrame:
    """Per conversation what was wrong, the cheapest edits, their cost, and a digest of what they leave.

    Columns: the identifier, ``gaps`` in the turns, ``blank``, ``duplicate`` and ``truncated``
    rows (each counts once, in this order), ``illegal`` neighbours, ``cost``, ``audit`` (an
    initial per edit: Keep, Rerole, Delete, Insert), ``repaired_sha256`` (of ``role:text``
    lines). Of equally cheap edits the audit that sorts first is taken.

    A NULL role or text counts as one space; NULL turns come first and leave no gaps; rows of
    one turn go by role and text. Rows without identifier are one conversation. Rows for which
    ``present`` is false only name their conversation, which then may have no rows: zeros, an empty
    audit, the digest of nothing. An empty table gives an empty result; other columns are
    not read. Beyond ``spill`` rows a conversation goes to a file.

    A digest of all texts in order can only be taken by one task, so a conversation is read
    by one task whatever its size, batch by batch; only its audit string is held whole.
    """
    rows = _sorted(df, id_col, turn_col, role_col, text_col, present)
    kind = rows.schema["key"].dataType.simpleString()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["key", *numbers, "audit", "repaired_sha256"]

    def row(one: Conversation) -> list:
        audit, digest, lead = one.finish(), hashlib.sha256(), b""
        for _, role, text in one.repaired(audit):
            digest.update(lead + f"{role}:{text}".encode())
            lead = b"\n"
        counts = [one.gaps(), one.faults[_BLANK], one.faults[_DUPLICATE], one.faults[_TRUNCATED], one.illegal, one.cost]
        return [one.key, *counts, audit, digest.hexdigest()]

    def run(batches):
        made = []

        for one in _conversations(batches, spill):
            made.append(row(one))
            if len(made) == 5000 or one.held > spill:
                yield _batch(made, one.kind, names)
                made = []
        if made:
            yield _batch(made, one.kind, names)

    schema = ", ".join([f"key {kind}", *(f"{c} long" for c in numbers), "audit string, repaired_sha256 string"])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", id_col)


def repaired_turns(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    spill: int = 100_000,
) -> DataFrame:
    """The repaired conversations row by row: the identifier, ``place`` from 0, ``role``, ``text``, ``edit``.

    The edits are those of ``repair``, and so are the rules for NULL, repeated and absent rows. A
    conversation of which nothing is left has no row here.
    """
    rows = _sorted(df, id_col, turn_col, role_col, text_col, present)
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "place", "role", "text", "edit"]

    def run(batches):
        made = []
        for one in _conversations(batches, spill):
            for place, (edit, role, text) in enumerate(one.repaired(one.finish())):
                made.append((one.key, place, role, text, edit))
                if len(made) == 5000:
                    yield _batch(made, one.kind, names)
                    made = []
        if made:
            yield _batch(made, one.kind, names)

    schema = f"key {kind}, place long, role string, text string, edit string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", id_col)


def damage(df: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by a hash of conversation and turn: the input of a trial.

    NULLs become one space. By crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), loses its
    text (1) or its ``.!?`` (2), is repeated (3), or gets the role user (4). A dropped row
    stays with ``present`` false, so that its conversation is known.
    """
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    marks = F.translate(filled["text"], ".!?", "")
    return df.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(filled["role"]).alias("role"),
        F.when(fault == 1, "").when(fault == 2, marks).otherwise(filled["text"]).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
