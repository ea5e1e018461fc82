"""Repair of conversations by a min-plus scan over their turns.

A turn is a matrix over four states (nothing yet, after the system turn, after a user's, after an
assistant's): the entry ``(i, j)`` is the cheapest way, with its audit, to edit the turn so that the
conversation goes from state i to j.  Entries are pairs of cost and audit; the sum takes the lesser
pair, the product adds costs and joins audits.  Insertions, which need no turn, are closed over once
and multiplied to each matrix.  Two ways between the same states that cost the same read the same
turns from the same state, so neither audit is the start of the other and the order of pairs holds
under products: the product is associative, and a conversation may be cut anywhere.

Turns are range-partitioned by conversation and turn, so one with a third of all rows lies in many
partitions; each partition multiplies its piece, and pieces are multiplied in groups of ``FAN``
neighbours until one is left.  The audit is then cut into the pieces' parts, which are applied where
the turns lie.  Only keys and marks travel: a text is read for its marks, and once more for the
repaired turns.

Equal rows of a turn are counted before anything is shuffled, so thousands of copies are one row.
Nulls in role or text are one space; null conversations are one conversation; null turns come
first.  Rows of one turn stand in the order of role, then of the SHA-256 of the row.  An empty
table gives an empty one.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import textkernels as K
from spanloom.llm.work import drop_stage, map_texts, stage

Entry = tuple[int, str]
Matrix = tuple[Entry | None, ...]  # sixteen entries by rows; None where no way leads

START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT = 3, 4, 3
TRUNCATED = 3
#: Pieces that one task multiplies, and rows of keys and marks that a range partition is made for.
FAN, RANGE_ROWS = 16, 100_000
#: States after each state for a turn of a system, user and assistant.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Marks of a turn: initial (s, u, a or other), and sound, truncated or to be deleted.
INITIALS = "sua?"
BLANKS = " \t\n\x0b\x0c\r"
SOUND, CUT, GONE = range(3)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    out: list[Entry | None] = []
    for i in range(0, 16, 4):
        row = [(k, e) for k, e in enumerate(a[i : i + 4]) if e is not None]
        for j in range(4):
            best = None
            for k, (cost, audit) in row:
                e = b[4 * k + j]
                if e is not None and (best is None or cost + e[0] <= best[0]):
                    new = (cost + e[0], audit + e[1])
                    if best is None or new < best:
                        best = new
            out.append(best)
    return tuple(out)


def _filled(entries: dict[tuple[int, int], Entry]) -> Matrix:
    return tuple(entries.get((i, j)) for i in range(4) for j in range(4))


ONE = _filled({(i, i): (0, "") for i in range(4)})
#: All insertions: a user's turn after nothing, the system or an assistant; an assistant's after a user.
_STEP = _filled({(i, i): (0, "") for i in range(4)} | {(i, j): (INSERT, "I") for r in "ua" for i, j in NEXT[r].items()})
CLOSURE = times(times(_STEP, _STEP), _STEP)


@lru_cache(maxsize=None)
def turn_matrix(code: int) -> Matrix:
    """The matrix of a turn with mark ``code`` (initial + 4 x state), insertions before and after it closed."""
    initial, state = INITIALS[code % 4], code // 4
    ways: dict[tuple[int, int], Entry] = {(i, i): (DELETE, "D") for i in range(4)}
    if state != GONE:
        more = TRUNCATED if state == CUT else 0
        for role in "ua":
            for i, j in NEXT[role].items():
                ways[i, j] = (REROLE + more, "R")
        for i, j in NEXT.get(initial, {}).items():
            ways[i, j] = (more, "K")
    return times(times(CLOSURE, _filled(ways)), CLOSURE)


@lru_cache(maxsize=4096)
def _pair(a: int, b: int) -> Matrix:
    return times(turn_matrix(a), turn_matrix(b))


def _gone(n: int) -> Matrix:
    """The matrix of ``n`` turns that must go: D sorts before I, so insertions come after them."""
    return tuple(e and (e[0] + DELETE * n, "D" * n + e[1]) for e in CLOSURE)


def product(parts: list[Matrix]) -> Matrix:
    """The product of neighbours, pair by pair, so that audits stay short for as long as they can."""
    while len(parts) > 1:
        parts = [times(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else CLOSURE


def piece_matrix(turns: list[tuple[int, int]]) -> Matrix:
    """The matrix of turns in order, given as (mark, copies); copies beyond a sound first one are deleted."""
    parts: list[Matrix] = []
    waiting: int | None = None
    for code, n in turns:
        lone = code // 4 != GONE
        if lone:
            if waiting is None:
                waiting = code
            else:
                parts.append(_pair(waiting, code))
                waiting = None
        gone = n - lone
        if gone:
            if waiting is not None:
                parts.append(turn_matrix(waiting))
                waiting = None
            parts.append(_gone(gone))
    if waiting is not None:
        parts.append(turn_matrix(waiting))
    return product(parts)


def answer(m: Matrix) -> Entry:
    """Cost and audit of a whole conversation: nothing, or one that ends with an assistant."""
    return min(e for e in (m[START], m[ASSISTANT]) if e is not None)


def illegal_pairs(turns: list[tuple[int, int]]) -> int:
    """Neighbours whose initials are none of su, ua and au; copies stand side by side."""
    r = [INITIALS[c % 4] for c, _ in turns]
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(r, r[1:])) + sum(n - 1 for _, n in turns)


_ENTRY = pa.struct([("cost", pa.int64()), ("audit", pa.string())])
_PIECE = "conv {}, part long, n_turns long, first int, last int, illegal long, m array<struct<cost bigint, audit string>>"


def _pack(m: Matrix) -> list:
    return [e and {"cost": e[0], "audit": e[1]} for e in m]


def _unpack(rows: list) -> Matrix:
    return tuple(e and (e["cost"], e["audit"]) for e in rows)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One matrix for each part of a conversation."""
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        for turns in b.column(2).to_pylist():
            t = [(x["code"], x["n"]) for x in turns]
            for col, v in zip(out, (sum(n for _, n in t), t[0][0] % 4, t[-1][0] % 4, illegal_pairs(t), _pack(piece_matrix(t)))):
                col.append(v)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(_ENTRY))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(out, kinds))],
            ["conv", "part", "n_turns", "first", "last", "illegal", "m"],
        )


def _joined(rows: list[dict]) -> dict:
    """Neighbouring pieces as one."""
    border = sum(INITIALS[x["last"]] + INITIALS[y["first"]] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    return {
        "part": rows[0]["part"], "n_turns": sum(r["n_turns"] for r in rows), "first": rows[0]["first"], "last": rows[-1]["last"],
        "illegal": sum(r["illegal"] for r in rows) + border, "m": _pack(product([_unpack(r["m"]) for r in rows])),
    }


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("part", pa.int64()), ("n_turns", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("illegal", pa.int64()), ("m", pa.list_(_ENTRY))])
    for b in batches:
        done = pa.array([_joined(rows) for rows in b.column(1).to_pylist()], kind)
        yield pa.RecordBatch.from_arrays([b.column(0), *done.flatten()], ["conv", *(f.name for f in kind)])


def reduce_pieces(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: its pieces are multiplied in groups of FAN neighbours, level by level."""
    shape = _PIECE.format(pieces.schema["conv"].dataType.simpleString())
    whole = None
    while True:
        n = pieces.groupBy("conv").agg(F.count("*").alias("n_pieces"), F.min("part").alias("from"), F.max("part").alias("to"))
        n = stage(n.where("n_pieces > 1"), "cut")
        cut = pieces.join(n.select(F.col("conv").alias("c"), "from"), F.col("c").eqNullSafe(F.col("conv")), "left")
        one = cut.where("`from` is null").select(*pieces.columns)
        whole = one if whole is None else whole.unionByName(one)
        if n.isEmpty():
            return whole
        of = F.floor((F.col("part") - F.col("from")) / FAN).alias("of")
        row = F.struct("part", "n_turns", "first", "last", "illegal", "m")
        groups = cut.where("`from` is not null").groupBy("conv", of).agg(F.sort_array(F.collect_list(row)).alias("rows")).select("conv", "rows", "of")
        # neighbours get neighbouring numbers, so the next level's groups are neighbours too
        pieces = stage(_renumbered(groups, shape), "level")


def _renumbered(groups: DataFrame, shape: str) -> DataFrame:
    def run(batches):
        for b in batches:
            for made in _join_groups([pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["conv", "rows"])]):
                yield made.set_column(1, "part", b.column(2).cast(pa.int64()))

    return groups.mapInArrow(K.freeing(run), shape)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surviving and inserted turns of a conversation's piece, from its part of the audit."""
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        for i, (turns, audit, kept, system) in enumerate(zip(*(b.column(c).to_pylist() for c in (2, 3, 4, 5)))):
            rows = ((t, c) for t in turns for c in range(t["n"]))
            last = turns[0]["at"]
            for k, op in enumerate(audit):
                t = None
                if op != "I":
                    t = next(rows)[0]
                    last = t["at"]
                if op == "D":
                    continue
                role = None
                if op != "K":
                    role = NAMES[USER if (kept - system) % 2 == 0 else ASSISTANT]
                kept += 1
                for col, v in zip(out, (i, last, k, role, t and t["id"])):
                    col.append(v)
        rows_ = pa.array(out[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(rows_), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()), pa.array(out[4], pa.binary())],
            ["conv", "at", "step", "new_role", "id"],
        )


def _cut_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit cut into those of its pieces (part, turns), with the turns kept before each."""
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        for i, (pieces, audit) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
            # the system turn, if any survives, is the first that is kept, and the rest is then even
            alive = len(audit) - audit.count("D")
            at, kept = 0, 0
            for p in pieces:
                left, end = p["n_turns"], at
                while left:
                    left -= audit[end] != "I"
                    end += 1
                if p is pieces[-1]:
                    end = len(audit)
                part = audit[at:end]
                for col, v in zip(out, (i, p["part"], part, kept, alive % 2)):
                    col.append(v)
                at, kept = end, kept + len(part) - part.count("D")
        rows = pa.array(out[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(rows), *(pa.array(c, k) for c, k in zip(out[1:], (pa.int64(), pa.string(), pa.int64(), pa.int64())))],
            ["conv", "part", "audit", "kept", "system"],
        )


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops the row, 1 empties its text, 2 removes the marks that end sentences, 3 repeats it, 4 makes it the user's."""
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat_ws(":", held("conv_id"), held("turn"))) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(held("text"), ".!?", "")).otherwise(held("text"))
    rows = conversations.select("conv_id", "turn", F.when(how == 4, "user").otherwise(held("role")).alias("role"), text.alias("text"), how.alias("how"))
    copies = F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("how != 0").select("conv_id", "turn", "role", "text", F.explode(copies).alias("c")).drop("c")


def _row_id(conv: Column, turn: Column, role: Column, text: Column) -> Column:
    """A row's identity: the SHA-256 of its four values."""
    part = lambda c: F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat(part(conv), part(turn), part(role), text), 256))


class Repair:
    """The repair of a table of turns: ``summary`` (a row for each conversation) and ``turns`` (the repaired turns)."""

    def __init__(self, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        self._name, self._turn = conv, turn
        texts = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"))
        self._texts = texts.select("*", _row_id(F.col("conv"), F.col("turn"), F.col("role"), F.col("text")).alias("id"))
        self.ordered = self._order()
        groups = self.ordered.groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("at", "code", "n", "id"))).alias("turns"))
        self._kind = groups.schema["conv"].dataType.simpleString()
        self._groups = stage(groups, "groups")
        pieces = stage(self._groups.mapInArrow(K.freeing(_pieces), _PIECE.format(self._kind)), "pieces")
        self.solved = stage(self._solve(pieces), "solved")
        self._cuts = pieces.select("conv", "part", "n_turns")

    def _order(self) -> DataFrame:
        """Distinct rows with their copies, marks and place, cut into ranges of conversation and turn."""
        bare = F.rtrim("text", F.lit(BLANKS))
        blank = bare == ""
        sound = F.substring(bare, -1, 1).isin(".", "!", "?")
        fault = F.when(blank, GONE).when(sound, SOUND).otherwise(CUT)
        same = F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256))
        initial = F.substring("role", 1, 1)
        first = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        marks = self._texts.select("conv", "turn", "role", same.alias("same"), "id", fault.alias("fault"), first.alias("first"), blank.alias("blank"))
        rows = stage(marks.groupBy("id").agg(*(F.first(c).alias(c) for c in ("conv", "turn", "role", "same", "fault", "first", "blank")), F.count("*").alias("n")), "marks")
        # the first place of each role and text, found by an aggregate and joined by the row's own identity: no key is hot
        early = rows.groupBy("conv", "same").agg(F.min(F.struct("turn", "id")).alias("f")).select(F.col("f.id").alias("id"), F.lit(True).alias("early"))
        joined = rows.join(early, "id", "left")
        late = F.col("early").isNull()
        code = F.col("first") + 4 * F.when(late, GONE).otherwise(F.col("fault"))
        # written, so that ranges drawn anew after a lost executor are the same ranges
        marked = stage(joined.select("conv", "turn", "role", "id", code.alias("code"), "n", "blank", F.col("fault").alias("own")), "marked")
        parts = max(marked.count() // RANGE_ROWS, int(self._texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        order = ["conv", "turn", "role", "id"]
        ranged = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        place = (F.monotonically_increasing_id().alias("at"), F.spark_partition_id().cast("long").alias("part"))
        out = stage(ranged.select("conv", "turn", "code", "n", "id", "blank", "own", *place), "ordered")
        drop_stage(rows, marked)
        return out

    def _solve(self, pieces: DataFrame) -> DataFrame:
        shape = f"conv {self._kind}, n_turns long, illegal long, cost long, audit string"

        def run(batches):
            for b in batches:
                got = [answer(_unpack(m)) for m in b.column("m").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv"), b.column("n_turns"), b.column("illegal"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string())],
                    ["conv", "n_turns", "illegal", "cost", "audit"],
                )

        return reduce_pieces(pieces).mapInArrow(K.freeing(run), shape)

    def summary(self) -> DataFrame:
        """Faults, gaps, cost and audit of each conversation that has rows."""
        blank, gone = F.col("blank"), F.floor(F.col("code") / 4) == GONE
        duplicate = F.when(blank, 0).when(gone, F.col("n")).otherwise(F.col("n") - 1)
        cut = F.when(~gone & (F.col("own") == CUT), 1).otherwise(0)
        span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
        faults = self.ordered.groupBy("conv").agg(
            F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blank"),
            F.sum(duplicate).cast("long").alias("duplicate"), F.sum(cut).cast("long").alias("truncated"),
        )
        solved = self.solved.select(F.col("conv").alias("c"), "illegal", "cost", "audit")
        return faults.join(solved, F.col("c").eqNullSafe(F.col("conv"))).drop("c").withColumnRenamed("conv", self._name)

    def turns(self) -> DataFrame:
        """The repaired turns: conversation, ``at`` and ``step`` (their order), role, text (empty where inserted), and the turn they were."""
        shape = f"conv {self._kind}, part long, audit string, kept long, system long"
        cuts = self._cuts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "n_turns"))).alias("pieces"))
        both = cuts.join(self.solved.select(F.col("conv").alias("c"), "audit"), F.col("c").eqNullSafe(F.col("conv"))).select("conv", "pieces", "audit")
        parts = both.mapInArrow(K.freeing(_cut_audits), shape).toDF("c", "p", "audit", "kept", "system")
        here = self._groups.join(parts, F.col("c").eqNullSafe(F.col("conv")) & (F.col("p") == F.col("part")))
        edits = here.select("conv", "part", "turns", "audit", "kept", "system").mapInArrow(K.freeing(_edits), f"conv {self._kind}, at long, step long, new_role string, id binary")
        # inserted turns have no identity and so meet no text; copies of a row are one text
        texts = self._texts.groupBy("id").agg(F.first("turn").alias("turn"), F.first("role").alias("role"), F.first("text").alias("text"))
        kept = edits.where("id is not null").join(texts, "id").select("conv", "at", "step", F.coalesce("new_role", "role").alias("role"), "text", "turn")
        new = edits.where("id is null").select("conv", "at", "step", F.col("new_role").alias("role"), F.lit("").alias("text"), F.lit(None).cast(texts.schema["turn"].dataType).alias("turn"))
        return kept.unionByName(new).withColumnsRenamed({"conv": self._name, "turn": self._turn})


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order; no more than a batch is held."""
    state, now, any_ = None, None, False
    for b in batches:
        done: list[tuple] = []
        for conv, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not any_ or conv != now:
                if any_:
                    done.append((now, state.hexdigest()))
                state, now, any_ = hashlib.sha256(line.encode()), conv, True
            else:
                state.update(b"\n" + line.encode())
        yield _hashes(done, b.schema.field(0).type)
        kind = b.schema.field(0).type
    if any_:
        yield _hashes([(now, state.hexdigest())], kind)


def _hashes(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], ["conv", "repaired_sha256"])


def turn_hashes(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The SHA-256 of each conversation's ``role:text`` lines.

    A hash of one byte sequence has no parallel form, so a conversation's lines stream through one task; nothing of them is held."""
    line = turns.select(F.col(conv).alias("conv"), "at", "step", F.concat_ws(":", "role", "text").alias("line"))
    kind = line.schema["conv"].dataType.simpleString()
    in_order = line.repartition("conv").sortWithinPartitions("conv", "at", "step").select("conv", "line")
    return map_texts(in_order, _hash_runs, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conv)


def repair_digests(original: DataFrame, repair: Repair, conv: str = "conv_id") -> DataFrame:
    """A row for each conversation of ``original``, with zeros and hashes of nothing where none of its rows came to the repair."""
    ids = original.select(F.col(conv).alias("conv")).distinct()
    summary, hashes = repair.summary().withColumnRenamed(conv, "c"), turn_hashes(repair.turns(), conv).withColumnRenamed(conv, "h")
    out = ids.join(summary, F.col("c").eqNullSafe(F.col("conv")), "left").join(hashes, F.col("h").eqNullSafe(F.col("conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.col("conv").alias(conv), *(F.coalesce(c, F.lit(0)).cast(T.LongType()).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
