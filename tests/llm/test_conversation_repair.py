"""Conversation repair against a brute-force search over all edits, whole and in small blocks."""
import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from vireo.llm import conversation_repair as cr

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """One conversation: counts, cost, audit and repaired lines."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.strip(SPACE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def best(i, at, inserted):
        options = []
        if i == len(rows) and at in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if (at, role[0]) in follow:
                    c, a, lines = best(i, follow[at, role[0]], inserted + 1)
                    options.append((c + 5, "I" + a, (role + ":", *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, lines = best(i + 1, at, 0)
            options.append((c + 2, "D" + a, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for name, cost, edit in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if (at, name[:1]) in follow and (edit == "K" or name[0] in "ua"):
                        c, a, lines = best(i + 1, follow[at, name[:1]], 0)
                        options.append((c + cost + more, edit + a, (f"{name}:{text}", *lines)))
        return min(options, key=lambda o: o[:2]) if options else (10 ** 9, "", ())

    cost, audit, lines = best(0, "", 0)
    return ((max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows):
    by = defaultdict(list)
    for r in brute_damage(rows):
        by[r[0]].append(r)
    return {c: brute_repair(by[c]) for c in {r[0] for r in rows}}


def collected(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_runs_and_powers_against_single_steps():
    rng = random.Random(3)
    for _ in range(300):
        symbols = [((rng.choice("suax"), rng.choice(["", "t"])) if rng.random() < .8 else ("", "d"), rng.randint(1, 9)) for _ in range(rng.randint(0, 6))]
        runs = cr.runs_of(symbols)
        single = [(s, 1) for s, n in symbols for _ in range(n)]
        costs = cr.END
        for symbol, _ in reversed(single):
            costs = cr.apply(cr.power(symbol, 0), costs)
        assert cr.apply(cr.matrix(runs), cr.END) == costs
        assert cr.unroll(runs, cr.END)[0] == cr.unroll([[s, 1] for s, _ in single], cr.END)[0]


def awkward_rows():
    rng = random.Random(7)
    rows = [(1, None, "user", "Hi."), (1, None, None, None), (1, 3, "assistant", "Yes."), (1, 3, "assistant", "Yes."), (1, 9, "assistant", "Yes."),
            (None, 1, "user", "a!"), (None, 2, "assistant", "b?"), (None, 2, "assistant", "b?"), (2, 0, "", "x."), (2, 1, "system", " \t"),
            (2, 1 << 40, "unknown", "word" * 50_000 + "."), (3, 0, "system", "Only system."), (4, -5, "user", "é "), (4, 5, "user", "same."),
            (5, None, None, None), (5, None, None, None), (8, 0, "assistant", "No.\n"), (8, 1, "user", "No.\n")]
    for c in range(100, 160):
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]),
                         rng.choice(["Fine.", "Why?", "cut", "", "Well. ", f"text {t}!", f"text {t}", None])))
    return rows


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 2}, {"block_rows": 3, "block_chars": 40}])
def test_awkward_conversations(spark, blocks):
    from pyspark.sql import functions as F
    rows = awkward_rows()
    df = spark.createDataFrame(rows, COLUMNS)
    for c in ("copies", "block", "place", "seen", "n", "conv", "conv_missing", "audit", "kind"):
        df = df.withColumn(c, F.lit("extra"))
    assert collected(cr.damaged_and_repaired(df, **blocks)) == brute(rows)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 50}])
def test_one_hot_conversation(spark, blocks):
    rng = random.Random(1)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"turn {t % 350}" + rng.choice([".", ""])) for t in range(400)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(20) if c != 7 for t in range(4)]
    got = collected(cr.damaged_and_repaired(spark.createDataFrame(rows, COLUMNS), **blocks))
    import sys
    sys.setrecursionlimit(20_000)
    assert got == brute(rows)


def test_repair_gives_well_formed_conversations(spark):
    import re
    df = spark.createDataFrame(awkward_rows(), COLUMNS)
    report, parts = cr.repair_conversations(df, block_rows=4)
    lines = defaultdict(list)
    for r in sorted(parts.collect(), key=lambda r: (r.conv_id or 0, r.part)):
        assert r.repaired.count("\n") >= max(0, r.lines - 1)
        lines[r.conv_id] += [x[:1] for x in r.repaired.split("\n")] if r.lines and "\n" not in r.repaired.replace("\n", "", r.lines - 1) else []
    assert report.count() == df.select("conv_id").distinct().count()
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for c, x in lines.items() if c not in (8,))


def test_empty_and_given_tables(spark):
    assert cr.damaged_and_repaired(spark.createDataFrame([], COLUMNS)).count() == 0
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = collected(cr.damaged_and_repaired(df))
    assert got == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
