"""Repair of conversations against a plain walk over whole conversations."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest

from spanloom.llm import conversations as C

SHAPE = "conv_id long, turn long, role string, text string, at long, code int, conv string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = ":".join(" " if x is None else str(x) for x in (conv, turn))
        how = zlib.crc32(k.encode()) % 20
        if how:
            text = "" if how == 1 else text.translate(str.maketrans("", "", ".!?")) if how == 2 else text
            out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def walk(rows):
    """One conversation's columns, by the cheapest audit from the left."""
    def key(r):
        part = lambda x: "-" if x is None else f"{len(str(x))}:{x}"
        return (r[1] is not None, r[1] or 0, r[2], hashlib.sha256((part(r[0]) + part(r[1]) + part(r[2]) + r[3]).encode()).digest())

    rows = sorted(rows, key=key)
    seen, best = set(), {0: (0, "", [])}
    blank = duplicate = truncated = 0
    grow = lambda x, cost, op, line: (x[0] + cost, x[1] + op, x[2] + line)

    def inserted(best):
        for _ in range(3):
            for i, j, role in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
                if i in best:
                    new = grow(best[i], 3, "I", [role + ":"])
                    if j not in best or new < best[j]:
                        best[j] = new
        return best

    best = inserted(best)
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        bad = not bare or (role, text) in seen
        blank += not bare
        duplicate += bool(bare) and bad
        late = 0 if bad or bare[-1] in ".!?" else 3
        truncated += late // 3
        seen.add((role, text))
        new = {}
        for i, x in best.items():
            ways = [(i, 4, "D", [])]
            if not bad:
                for j, name in ((2, "user"), (3, "assistant")):
                    if (j == 3) == (i == 2):
                        ways.append((j, 3 + late, "R", [f"{name}:{text}"]))
                        if role[:1] == name[0]:
                            ways.append((j, late, "K", [f"{role}:{text}"]))
                if i == 0 and role[:1] == "s":
                    ways.append((1, late, "K", [f"{role}:{text}"]))
            for j, cost, op, line in ways:
                y = grow(x, cost, op, line)
                if j not in new or y < new[j]:
                    new[j] = y
        best = inserted(new)
    cost, audit, lines = min(best[i] for i in (0, 3) if i in best)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def columns(g):
    return g.gaps, g.blank, g.duplicate, g.truncated, g.illegal, g.cost, g.audit, g.repaired_sha256


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def compare(spark, rows, damage=True):
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], SHAPE).repartition(4)
    got = C.repair_digests(df, C.Repair(C.damage(df) if damage else df)).collect()
    by = {}
    for r in damaged(rows) if damage else [(c, t, " " if x is None else x, " " if y is None else y) for c, t, x, y in rows]:
        by.setdefault(r[0], []).append(r)
    want = {c: walk(by[c]) if c in by else EMPTY for c in {r[0] for r in rows}}
    assert len(got) == len(want)
    assert {g.conv_id: columns(g) for g in got} == want


def random_rows(r, n_conv, longest):
    rows = []
    for c in range(n_conv):
        for t in range(r.randrange(1, longest)):
            role = r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"])
            text = r.choice(["Yes.", "No!", "and then", " \n", "", None, f"Line {r.randrange(9)}.", "word? \t", "x" * r.randrange(5)])
            rows.append((None if c == 0 else c, None if r.random() < 0.05 else t + (t > 3) * 2, role, text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_walk(spark, seed):
    compare(spark, random_rows(random.Random(seed), 40, 14))


def test_long_and_hot_conversations_cross_partitions(spark, monkeypatch):
    """One conversation has most rows, over more pieces than FAN squared holds; another has one turn thousands of times."""
    r = random.Random(5)
    rows = random_rows(r, 10, 8) + [(77, t, r.choice(["user", "assistant", "tool"]), f"Line {r.randrange(300)}{r.choice(['.', ''])}") for t in range(700)]
    rows += [(78, 4, "user", "Yes.")] * 1500 + [(78, 5, "assistant", "No.")]
    monkeypatch.setattr(C, "RANGE_ROWS", 9)
    monkeypatch.setattr(C, "FAN", 4)
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        compare(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)


def test_without_damage_empty_and_lone_rows(spark):
    compare(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "system", "Be kind."), (3, None, None, None), (4, 7, "user", "long " * 30000 + ".")], damage=False)
    df = spark.createDataFrame([], SHAPE)
    assert C.repair_digests(df, C.Repair(C.damage(df))).collect() == []


def test_products_may_be_cut_anywhere():
    r = random.Random(2)
    for _ in range(60):
        turns = [(r.randrange(12), r.choice([1, 1, 1, 3])) for _ in range(r.randrange(2, 12))]
        k = r.randrange(1, len(turns))
        assert C.times(C.piece_matrix(turns[:k]), C.piece_matrix(turns[k:])) == C.piece_matrix(turns)
        assert C.illegal_pairs(turns) >= 0


def test_repaired_turns_are_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "More.")]
    got = C.Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).turns().orderBy("at", "step").collect()
    assert [(g.turn, g.role, g.text) for g in got] == [(0, "user", "Hi."), (2, "assistant", "Yes."), (None, "user", ""), (3, "assistant", "More.")]
    assert [k for k, _ in groupby(g.role for g in got)] == ["user", "assistant", "user", "assistant"]
