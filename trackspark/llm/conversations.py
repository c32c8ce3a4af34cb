"""Conversation structure repair by Wagner-Fischer alignment with the strings of a grammar.

The turns of a conversation, in order, should have role initials ``(s?(ua)+)?``. Edits make them so: **K**eep
(free), **R**erole to user or assistant (3), **D**elete (4), **I**nsert an empty user or assistant
turn (3). Blank turns and repeats of an earlier (role, text) have to be deleted; a truncated turn that stays
costs 3 more. The answer is the cheapest script, and of several the one whose letters are ASCII-least.

* **Targets.** After its first letter the grammar alternates, so a start and a length name one target.
  Turns are aligned with every feasible length by Wagner-Fischer; lengths are tried from the number of
  turns that may stay outwards, and one whose least cost exceeds the incumbent is not tried.
* **Bands.** A cell of the table is left out when the inserts and deletes that its diagonal needs, before and after
  it, cost more than the incumbent (Ukkonen). Equal cost stays in, because audits are compared.
* **Audits.** Costs are filled from the end, so that tracing from the start can always take the
  least letter that still reaches the optimum; of all lengths the cheapest, then least audit wins.
* **Long conversations** are not one task's work. Turns are range-partitioned in their order, so any
  conversation is cut; pieces of ``PIECE`` turns are aligned from every state of the grammar to every other,
  and such tables of (cost, audit) combine associatively: a state fixes what may follow, and no audit of a
  piece is the beginning of another of equal cost, so the least parts give the least whole.
* What is one sequential value, the audit and the text that is hashed, streams turn by turn through a task,
  which holds the letters of one conversation but not its texts.

Defined cases: NULL role and text are one space here (role initial " ", blank text). Turns come by turn, NULL
first; at one turn by role, then SHA-256 of the text, and repeated rows stand side by side. Rows without
conv_id are a conversation of their own. A role other than those with initials s, u, a can only be reroled or
deleted. Conversations without any turn left have zeros, an empty audit and the hash of the empty string. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import stored, tasks

RETYPE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
#: Turns aligned as one piece.
PIECE = 16
#: Tables that a task keeps, as short conversations often have the same letters.
KNOWN = 1 << 14
#: States of the grammar: nothing yet, after system, after user, after assistant.
STATES = "^sua"
_NEXT = {"^": "u", "s": "u", "u": "a", "a": "u"}
_ROLE = {"u": "user", "a": "assistant"}
_FAR = 1 << 40

Table = dict[str, dict[str, tuple[int, str]]]


def target(start: str, length: int) -> str:
    """The alternating string of a length that begins with ``start`` (u, a, or s before u)."""
    if start == "s":
        return "s" + ("ua" * length)[:length - 1]
    return (("ua" if start == "u" else "au") * length)[:length]


def _align(turns: str, goal: str, limit: int, gone: list[int]) -> tuple[int, str] | None:
    """Cost and least audit of turning ``turns`` into ``goal``, if it costs at most ``limit``.

    A turn is a letter: D has to be deleted, an upper-case initial is truncated, x is a role that cannot stay.
    ``gone[i]`` counts the D among the first i.
    """
    n, m = len(turns), len(goal)

    def least(rows: int, dropped: int, wanted: int) -> int:
        spare = rows - dropped - wanted
        return DELETE * dropped + (DELETE * spare if spare > 0 else -INSERT * spare)

    togo = [[_FAR] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = togo[i], togo[i + 1] if i < n else None
        for j in range(m, -1, -1):
            if least(i, gone[i], j) + least(n - i, gone[n] - gone[i], m - j) > limit:
                continue
            best = 0 if i == n and j == m else _FAR
            if i < n:
                best = min(best, below[j] + DELETE)
                if j < m and turns[i] != "D":
                    turn, short = turns[i].lower(), CUT_SHORT if turns[i].isupper() else 0
                    if turn == goal[j]:
                        best = min(best, below[j + 1] + short)
                    elif goal[j] != "s":
                        best = min(best, below[j + 1] + RETYPE + short)
            if j < m and goal[j] != "s":
                best = min(best, row[j + 1] + INSERT)
            row[j] = best
    cost = togo[0][0]
    if cost > limit:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        here = togo[i][j]
        if i < n and togo[i + 1][j] + DELETE == here:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != "s" and togo[i][j + 1] + INSERT == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == goal[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _family(turns: str, start: str) -> tuple[tuple[int, str] | None, ...]:
    """Best alignments with targets that begin with ``start``, by last letter: u, a (at least one letter), s."""
    if start == "s" and "s" not in turns.lower():
        return None, None, None
    gone = [0]
    for t in turns:
        gone.append(gone[-1] + (t == "D"))
    stay = len(turns) - gone[-1]
    best: dict[str, tuple[int, str]] = {}
    longest = stay + (DELETE * len(turns) + 2 * INSERT) // INSERT + 2
    for length in sorted(range(1, longest + 1), key=lambda k: (abs(k - stay), k)):
        goal = target(start, length)
        # deleting all and inserting anew bounds what a target without s can cost
        limit = best[goal[-1]][0] if goal[-1] in best else _FAR if start == "s" else DELETE * len(turns) + 2 * INSERT
        spare = stay - length
        if DELETE * gone[-1] + (DELETE * spare if spare > 0 else -INSERT * spare) > limit:
            continue
        found = _align(turns, goal, limit, gone)
        if found and (goal[-1] not in best or found < best[goal[-1]]):
            best[goal[-1]] = found
    return tuple(best.get(last) for last in "uas")


def align(turns: str) -> Table:
    """Cheapest (cost, audit) from every state before ``turns`` to every state after them."""
    deleted = (DELETE * len(turns), "D" * len(turns))
    begun = {start: _family(turns, start) for start in "uas"}
    out: Table = {}
    for before in STATES:
        ends = {before: deleted}
        for start in (_NEXT[before], "s") if before == "^" else _NEXT[before]:
            for last, found in zip("uas", begun[start]):
                if found and (last not in ends or found < ends[last]):
                    ends[last] = found
        out[before] = ends
    return out


def combine(a: Table, b: Table) -> Table:
    """The table of two neighbouring pieces."""
    out: Table = {}
    for before, ends in a.items():
        best: dict[str, tuple[int, str]] = {}
        for middle, (cost, audit) in ends.items():
            for after, (more, rest) in b[middle].items():
                total = cost + more
                if after not in best or total < best[after][0] or total == best[after][0] and audit + rest < best[after][1]:
                    best[after] = (total, audit + rest)
        out[before] = best
    return out


def combine_all(tables: list[Table]) -> Table:
    while len(tables) > 1:
        tables = [combine(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return tables[0]


def best_script(tables: list[Table]) -> tuple[int, str]:
    """Cost and audit of a conversation from the tables of its pieces in order."""
    if not tables:
        return 0, ""
    ends = combine_all(tables)["^"]
    return min(ends[x] for x in "^a" if x in ends)


# ---- the turns as a table --------------------------------------------------------------------


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with what their place and their fault depend on, and a number of their own; written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return stored(turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                               F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                               F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                               F.monotonically_increasing_id().alias("row")), "turns")


_PLACE = ["conv_id", "turn", "role", "digest", "row"]


def classified(placed: DataFrame) -> DataFrame:
    """Turns without their text: ``kind`` is B (blank), P (repeat), or the initial, upper-case if cut short; ``initial``."""
    visible = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    blank = F.length(visible) == 0
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    slim = placed.select(*_PLACE, blank.alias("blank"), (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("short"),
                         initial.alias("initial"), known.alias("known"))
    # who came first is found by a combined minimum and matched by row number, so no group of equal turns comes together
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "row")).alias("f")).select(F.col("f.row").alias("first_row"))
    repeat = F.col("first_row").isNull()
    kind = (F.when(F.col("blank"), "B").when(repeat, "P")
            .when(F.col("short"), F.upper("known")).otherwise(F.col("known")))
    return (slim.join(first, slim["row"] == first["first_row"], "left")
            .select(*_PLACE, kind.alias("kind"), "initial"))


_SUMMARY = ("part long, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, "
            "first_initial string, last_initial string, least_turn long, most_turn long, turns long")
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_LEGAL = {"su", "ua", "au"}


class _Piece:
    """What is known of consecutive turns of one conversation."""

    def __init__(self, conv, known: dict[str, Table]) -> None:
        self.conv, self.tables, self.letters, self.known = conv, [], [], known
        self.count = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = self.least = self.most = None
        self.turns = 0

    def add(self, turn: int | None, kind: str, initial: str) -> None:
        self.letters.append("D" if kind in "BP" else kind)
        self.count["blank"] += kind == "B"
        self.count["duplicate"] += kind == "P"
        self.count["truncated"] += kind in "SUAX"
        if self.first is None:
            self.first = initial
        else:
            self.count["illegal"] += self.last + initial not in _LEGAL
        self.last = initial
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        if len(self.letters) == PIECE:
            self.close()

    def close(self) -> None:
        if self.letters:
            turns = "".join(self.letters)
            if turns not in self.known:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[turns] = align(turns)
            self.tables.append(self.known[turns])
            self.letters = []

    def row(self) -> dict:
        self.close()
        table = combine_all(self.tables)
        cells = [table[a].get(b) for a in STATES for b in STATES]
        return {"conv_id": self.conv, "costs": [c and c[0] for c in cells], "audits": [c and c[1] for c in cells], **self.count,
                "first_initial": self.first, "last_initial": self.last, "least_turn": self.least, "most_turn": self.most,
                "turns": self.turns}


def _summaries(turns: DataFrame) -> DataFrame:
    """A row for each conversation and range of turns in which it occurs."""
    # the whole order deals the turns out, so that one conversation may take many ranges
    dealt = (turns.repartitionByRange(tasks(turns.sparkSession), *_PLACE).sortWithinPartitions(*_PLACE)
             .select("conv_id", "turn", "kind", "initial", F.spark_partition_id().cast("long").alias("part")))
    key = dealt.schema["conv_id"].dataType
    schema = f"conv_id {key.simpleString()}, {_SUMMARY}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, part, kind, known = None, [], None, None, {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([r | {"part": part} for r in out], kind)

        for batch in batches:
            kind = kind or _arrow(batch.schema.field("conv_id").type)
            lists = [c.to_pylist() for c in batch.columns]
            for conv, turn, letter, initial, part in zip(*lists):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.row())
                    now = _Piece(conv, known)
                now.add(turn, letter, initial)
            if len(out) > 1000:
                yield flush()
                out.clear()
        if now is not None:
            out.append(now.row())
            yield flush()

    return dealt.mapInArrow(work, schema)


def _arrow(conv: pa.DataType) -> pa.Schema:
    text, number = pa.string(), pa.int64()
    return pa.schema([("conv_id", conv), ("part", number), ("costs", pa.list_(number)), ("audits", pa.list_(text)),
                      *[(c, number) for c in _COUNTS], ("first_initial", text), ("last_initial", text),
                      ("least_turn", number), ("most_turn", number), ("turns", number)])


class _Conversation:
    """One conversation while its summaries and then its turns pass by."""

    def __init__(self, conv) -> None:
        self.conv, self.tables = conv, []
        self.count = dict.fromkeys(_COUNTS, 0)
        self.last = self.least = self.most = None
        self.turns = 0
        self.audit = None

    def summary(self, r: dict) -> None:
        cells = iter(zip(r["costs"], r["audits"]))
        self.tables.append({a: {b: (c, t) for b, (c, t) in zip(STATES, cells) if c is not None} for a in STATES})
        for c in _COUNTS:
            self.count[c] += r[c]
        if self.last is not None:
            self.count["illegal"] += self.last + r["first_initial"] not in _LEGAL
        self.last = r["last_initial"]
        if r["least_turn"] is not None:
            self.turns += r["turns"] - (r["least_turn"] == self.most)
            self.least = r["least_turn"] if self.least is None else self.least
            self.most = r["most_turn"]

    def decide(self) -> None:
        if self.audit is None:
            self.cost, self.audit = best_script(self.tables)
            self.tables, self.at, self.state, self.place = [], 0, "^", 0

    def _emit(self, role: str, text: str, edit: str) -> tuple:
        self.state = role[:1]
        self.place += 1
        return self.place - 1, role, text, edit

    def _inserts(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._emit(_ROLE[_NEXT[self.state]], "", "I")

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        self.decide()
        yield from self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._emit(role if edit == "K" else _ROLE[_NEXT[self.state]], text, edit)

    def end(self) -> Iterator[tuple]:
        self.decide()
        yield from self._inserts()


def _passing(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """Per conversation its name, its summaries, then its turns: sorted, in one task each."""
    placed = _ordered(turns)
    summaries = _summaries(classified(placed))
    named = (turns if originals is None else originals).select("conv_id").distinct().withColumn("kind", F.lit(0))
    rows = (named.unionByName(summaries.withColumn("kind", F.lit(1)), allowMissingColumns=True)
            .unionByName(placed.withColumn("kind", F.lit(2)), allowMissingColumns=True))
    return (rows.repartition(tasks(turns.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "kind", "part", "turn", "role", "digest", "row").drop("digest", "row", "turn"))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Iterator[tuple] | None]]:
    """Each conversation with the repaired turns of one turn, or with None at its end."""
    now = None
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            for r in batch.slice(start, 500).to_pylist():
                if now is None or r["conv_id"] != now.conv:
                    if now is not None:
                        yield now, now.end()
                        yield now, None
                    now = _Conversation(r["conv_id"])
                if r["kind"] == 1:
                    now.summary(r)
                elif r["kind"] == 2:
                    yield now, now.turn(r["role"], r["text"])
    if now is not None:
        yield now, now.end()
        yield now, None


def repair_report(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit and SHA-256 of the repaired turns.

    ``turns`` has conv_id, turn, role, text. Conversations of ``originals`` that have no turn left are reported too.
    """
    conv = turns.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
              "repaired_sha256 string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, kind = [], hashlib.sha256(), None
        for now, repaired in _stream(_typed(batches, held := {})):
            if repaired is not None:
                for place, role, text, _ in repaired:
                    digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                continue
            gaps = now.most - now.least + 1 - now.turns if now.least is not None else 0
            out.append((now.conv, gaps, *now.count.values(), now.cost, now.audit, digest.hexdigest()))
            digest = hashlib.sha256()
            kind = kind or pa.schema([("conv_id", held["conv"]), *[(c, pa.int64()) for c in ("gaps", *_COUNTS, "cost")],
                                      ("audit", pa.string()), ("repaired_sha256", pa.string())])
            if len(out) > 1000:
                yield _batch(out, kind)
                out = []
        if out:
            yield _batch(out, kind)

    return _passing(turns, originals).mapInArrow(work, schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, position (from 0), role, text, edit (K, R or I)."""
    conv = turns.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], {}
        for now, repaired in _stream(_typed(batches, held)):
            kind = pa.schema([("conv_id", held["conv"]), ("position", pa.int64()), ("role", pa.string()),
                              ("text", pa.string()), ("edit", pa.string())])
            out += [(now.conv, *r) for r in repaired or ()]
            if len(out) > 500:
                yield _batch(out, kind)
                out = []
        if out:
            yield _batch(out, kind)

    return _passing(turns).mapInArrow(work, f"conv_id {conv}, position long, role string, text string, edit string")


def _typed(batches: Iterator[pa.RecordBatch], held: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held["conv"] = batch.schema.field("conv_id").type
        yield batch


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults planted by crc32 of ``conv_id:turn``, modulo 20; NULLs are one space."""
    blank = F.lit(" ")
    spelled = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                                (F.crc32(spelled.cast("binary")) % 20).alias("fault"))
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return (rows.where("fault <> 0").withColumn("copy", copies)
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text")))
