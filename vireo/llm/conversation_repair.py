"""Repair of conversation structure by a run-length dynamic program.

A conversation should read ``(s?(ua)+)?``: an optional system turn, then user
and assistant in turn.  Every row is a symbol (initial of its role, first
fault); a symbol is a min-plus transition between the four positions in that
pattern.  Equal consecutive symbols are one run, and a run of any length is
crossed by the binary powers of its transition, which are kept per symbol.
The choices are unrolled afterwards from the costs to go.

Rows are dealt by sorted ranges of (conversation, turn, role, start of the
text), so a conversation that holds a third of all rows is spread over many
tasks.  A conversation inside one range is repaired in one pass over it.  One
that crosses a border, or is longer than a block, goes by blocks: transitions
multiply, so each block gives one small matrix, a fold over those gives every
block its costs to go and its starting position, and the blocks are unrolled
independently.  Equal rows are counted before the shuffle.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import SPACE_CHARS, WORD_PATTERN, ship_package, stage

#: edits: keep, give another role, delete, insert; what a kept truncated row adds
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: adjacent role initials that are in order
LEGAL_PAIRS = ("su", "ua", "au")
#: rows or characters of a conversation handled at once
BLOCK_ROWS, BLOCK_CHARS = 100_000, 16_000_000

# positions in the pattern: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
INF = 1 << 60
#: the role that comes next by an insertion or a new role
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE_NAMES = {AFTER_U: "user", AFTER_A: "assistant"}
#: (position, initial of a kept role) -> position
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
OK, CUT, GONE = "", "t", "d"  # a sound row, a truncated one, one that must go


# --- the dynamic program (plain Python on small matrices) ---------------------

def times(a, b):
    """Min-plus product of 4 x 4 matrices."""
    return tuple(tuple(min(INF, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def apply(m, v):
    """Costs to go before a step, from those after it."""
    return tuple(min(INF, *(m[i][k] + v[k] for k in range(4))) for i in range(4))


def _insertions():
    c = [[0 if i == j else INF for j in range(4)] for i in range(4)]
    for i in range(4):
        at, cost = i, 0
        for _ in range(3):
            at, cost = NEXT[at], cost + INSERT
            c[i][at] = min(c[i][at], cost)
    return tuple(map(tuple, c))


IDENTITY = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))
INSERTIONS = _insertions()
#: costs to go after the last row
END = apply(INSERTIONS, (0, INF, INF, 0))


@lru_cache(maxsize=None)
def power(symbol: tuple[str, str], k: int):
    """Transition of 2^k rows of one symbol, insertions before each included."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    initial, fault = symbol
    edit = [[INF] * 4 for _ in range(4)]
    more = TRUNCATED if fault == CUT else 0
    for i in range(4):
        edit[i][i] = DELETE
        if fault != GONE:
            edit[i][NEXT[i]] = min(edit[i][NEXT[i]], REROLE + more)
            j = KEPT.get((i, initial))
            if j is not None:
                edit[i][j] = min(edit[i][j], KEEP + more)
    return times(INSERTIONS, edit)


def cross(symbol, count: int, costs):
    """Costs to go before a run from those after it."""
    k = 0
    while count >> k:
        if count >> k & 1:
            costs = apply(power(symbol, k), costs)
        k += 1
    return costs


def runs_of(symbols):
    """[[symbol, count]] of equal consecutive (symbol, count) entries."""
    out = []
    for symbol, count in symbols:
        if out and out[-1][0] == symbol:
            out[-1][1] += count
        else:
            out.append([symbol, count])
    return out


def matrix(runs):
    """Transition of a whole list of runs."""
    m = IDENTITY
    for symbol, count in runs:
        k = 0
        while count >> k:
            if count >> k & 1:
                m = times(m, power(symbol, k))
            k += 1
    return m


def unroll(runs, costs, position: int = START, last: bool = True):
    """(audit, position afterwards): the cheapest edits, ties ASCII-least, from
    a position to the ``costs`` to go after the last run."""
    before = [costs]
    for symbol, count in reversed(runs):
        before.append(cross(symbol, count, before[-1]))
    before.reverse()
    out = []
    for (symbol, count), start, after in zip(runs, before, before[1:]):
        initial, fault = symbol
        if fault == GONE:
            # a deletion leaves the position as it is and comes first in ASCII
            out.append("D" * count)
            continue
        goals = [after]
        for _ in range(count - 1):
            goals.append(apply(power(symbol, 0), goals[-1]))
        goals.append(start)
        more = TRUNCATED if fault == CUT else 0
        while len(goals) > 1:
            now, then = goals[-1][position], goals[-2]
            kept = KEPT.get((position, initial))
            if DELETE + then[position] == now:
                out.append("D")
            elif INSERT + goals[-1][NEXT[position]] == now:
                out.append("I")
                position = NEXT[position]
                continue
            elif kept is not None and KEEP + more + then[kept] == now:
                out.append("K")
                position = kept
            else:
                out.append("R")
                position = NEXT[position]
            goals.pop()
    while last and costs[position]:
        out.append("I")
        position = NEXT[position]
    return "".join(out), position


def apply_edits(audit: str, rows, position: int = START):
    """``role:text`` of the repaired rows; ``rows`` gives (role, text, count)."""
    out = []
    rows, left = iter(rows), 0
    role = text = None
    for edit in audit:
        if edit == "I":
            position = NEXT[position]
            out.append(ROLE_NAMES[position] + ":")
            continue
        if not left:
            role, text, left = next(rows)
        left -= 1
        if edit == "K":
            position = KEPT[position, role[:1]]
            out.append(f"{role}:{text}")
        elif edit == "R":
            position = NEXT[position]
            out.append(f"{ROLE_NAMES[position]}:{text}")
    return out


def fault_of(text: str) -> str:
    """blank, truncated or neither, by the last character that is not space."""
    text = text.rstrip(SPACE_CHARS)
    return "blank" if not text else "" if text[-1] in ".!?" else "truncated"


class Block:
    """Rows of one conversation in order, with their counts and symbols."""

    def __init__(self):
        self.rows, self.symbols = [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = self.first_turn = self.last_turn = None
        self.first = self.last = None

    def add(self, turn, role: str, text: str, count: int, seen: bool) -> None:
        initial, fault = role[:1], fault_of(text)
        if fault == "blank":
            self.blank += count
            self.symbols.append((("", GONE), count))
        else:
            fresh = 0 if seen else 1
            self.duplicate += count - fresh
            if fresh:
                self.truncated += fault == "truncated"
                self.symbols.append(((initial, CUT if fault else OK), 1))
            if count > fresh:
                self.symbols.append((("", GONE), count - fresh))
        if self.rows:
            self.illegal += self.last + initial not in LEGAL_PAIRS
        else:
            self.first = initial
        self.illegal += count - 1
        self.last = initial
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.turns = (self.turns or 0) + 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.rows.append((role, text, count))


# --- the Spark side -----------------------------------------------------------

_KEY = ("conv_missing boolean, conv long, ")
_OPEN = "block long, place long, turn long, role string, text string, n long, seen boolean"
_CLOSED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string"
_STATS = ("blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
          "turns long, first_turn long, last_turn long")


def _optional(values, kind="Int64"):
    return pd.array([None if pd.isna(x) else x for x in values], dtype=kind)


def _scan(frames, block_rows: int, block_chars: int):
    """One pass over a sorted range: conversations that begin and end inside it
    come out repaired; the rows of its first and last one, and of those longer
    than a block, come out as they are, numbered by block."""
    number = TaskContext.get().partitionId() << 24
    key, block, first = None, None, True
    closed, opened = [], []

    def open_rows():
        nonlocal number
        for place, (turn, role, text, n, seen) in enumerate(block):
            opened.append((*key, number, place, turn, role, text, n, seen))
        number += 1

    def close():
        b = Block()
        for row in block:
            b.add(*row)
        runs = runs_of(b.symbols)
        audit, _ = unroll(runs, END)
        cost = END
        for symbol, count in reversed(runs):
            cost = cross(symbol, count, cost)
        gaps = 0 if b.turns is None else b.last_turn - b.first_turn + 1 - b.turns
        closed.append((*key, gaps, b.blank, b.duplicate, b.truncated, b.illegal, cost[START], audit,
                       "\n".join(apply_edits(audit, b.rows))))

    def out():
        cols = [c.split()[0] for c in (_KEY + _OPEN + ", " + _CLOSED).split(", ")]
        n_open = len(_OPEN.split(", "))
        data = [(*r, *([None] * 8)) for r in opened] + [(*r[:2], *([None] * n_open), *r[2:]) for r in closed]
        frame = pd.DataFrame(data, columns=cols)
        for c in ("conv", "block", "place", "turn", "n", *(x.split()[0] for x in _CLOSED.split(", ")[:6])):
            frame[c] = _optional(frame[c])
        frame["seen"] = _optional(frame["seen"], "boolean")
        opened.clear()
        closed.clear()
        return frame

    size = held = 0
    overflow = False
    for frame in frames:
        for missing, conv, turn, role, text, n, seen in zip(
                frame["conv_missing"].tolist(), frame["conv"].tolist(), frame["turn"].tolist(), frame["role"].tolist(),
                frame["text"].tolist(), frame["n"].tolist(), frame["seen"].tolist()):
            if key != (missing, conv):
                if key is not None:
                    open_rows() if first or overflow else close()
                    first = False
                key, block, size, overflow = (missing, conv), [], 0, False
            block.append((None if pd.isna(turn) else int(turn), role, text, int(n), bool(seen)))
            size += len(role) + len(text)
            held += len(role) + len(text)
            if len(block) >= block_rows or size >= block_chars:
                open_rows()
                block, size, overflow = [], 0, True
            if held >= block_chars:
                yield out()
                held = 0
    if block:
        open_rows()
    if opened or closed:
        yield out()


def _block_matrix(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("place")
    b = Block()
    for turn, role, text, n, seen in zip(frame["turn"].tolist(), frame["role"].tolist(), frame["text"].tolist(),
                                         frame["n"].tolist(), frame["seen"].tolist()):
        b.add(None if pd.isna(turn) else int(turn), role, text, int(n), bool(seen))
    runs = runs_of(b.symbols)
    k = frame.iloc[0]
    out = pd.DataFrame({"conv_missing": [bool(k["conv_missing"])], "conv": [int(k["conv"])], "block": [int(k["block"])],
                        "blank": [b.blank], "duplicate": [b.duplicate], "truncated": [b.truncated], "illegal": [b.illegal],
                        "first_initial": [b.first], "last_initial": [b.last],
                        "turns": _optional([b.turns]), "first_turn": _optional([b.first_turn]), "last_turn": _optional([b.last_turn]),
                        "moves": [[x for row in matrix(runs) for x in row]],
                        "initials": [[s[0] for s, _ in runs]], "faults": [[s[1] for s, _ in runs]], "counts": [[c for _, c in runs]]})
    return out


def _goals(frame: pd.DataFrame) -> pd.DataFrame:
    """Costs to go after every block of one conversation."""
    frame = frame.sort_values("block")
    costs, goals = END, []
    for moves in reversed(frame["moves"].tolist()):
        goals.append(list(costs))
        costs = apply([moves[i:i + 4] for i in range(0, 16, 4)], costs)
    return pd.DataFrame({"conv_missing": frame["conv_missing"], "conv": frame["conv"], "block": frame["block"],
                         "goal": [[int(x) for x in g] for g in goals[::-1]],
                         "cost": [int(min(costs[START], INF))] * len(frame), "is_last": [False] * (len(frame) - 1) + [True]})


def _exits(frames):
    """Every block unrolled from each position it can begin in."""
    for frame in frames:
        audits, exits = [], []
        for initials, faults, counts, goal, last in zip(frame["initials"], frame["faults"], frame["counts"], frame["goal"], frame["is_last"]):
            runs = [((a, b), int(c)) for a, b, c in zip(initials, faults, counts)]
            goal = tuple(int(x) for x in goal)
            each = [unroll(runs, goal, s, last) for s in range(4)]
            audits.append([a for a, _ in each])
            exits.append([e for _, e in each])
        frame = frame[["conv_missing", "conv", "block"]].copy()
        frame["audits"], frame["exits"] = audits, exits
        yield frame


def _starts(frame: pd.DataFrame) -> pd.DataFrame:
    """Position in which every block of one conversation begins."""
    frame = frame.sort_values("block")
    at, starts = START, []
    for exits in frame["exits"].tolist():
        starts.append(at)
        at = int(exits[at])
    return pd.DataFrame({"conv_missing": frame["conv_missing"], "conv": frame["conv"], "block": frame["block"], "begins": starts})


def _sum_up(frame: pd.DataFrame) -> pd.DataFrame:
    """Counts of one conversation from those of its blocks."""
    frame = frame.sort_values("block")
    illegal, distinct, low, high, before = int(frame["illegal"].sum()), 0, None, None, None
    for first, last, turns, lo, hi in zip(frame["first_initial"], frame["last_initial"], frame["turns"], frame["first_turn"], frame["last_turn"]):
        illegal += before is not None and before + first not in LEGAL_PAIRS
        before = last
        if not pd.isna(turns):
            distinct += int(turns) - (high is not None and high == int(lo))
            low, high = int(lo) if low is None else low, int(hi)
    return pd.DataFrame({"conv_missing": frame["conv_missing"].iloc[:1], "conv": frame["conv"].iloc[:1],
                         "gaps": [0 if low is None else high - low + 1 - distinct], "blank": [int(frame["blank"].sum())],
                         "duplicate": [int(frame["duplicate"].sum())], "truncated": [int(frame["truncated"].sum())], "illegal": [illegal]})


def _edit_block(rows: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    k = plan.iloc[0]
    lines = apply_edits(k["audit"], zip(rows["role"].tolist(), rows["text"].tolist(), (int(x) for x in rows["n"])), int(k["begins"]))
    return pd.DataFrame({"conv_missing": [bool(k["conv_missing"])], "conv": [int(k["conv"])], "part": [int(k["block"])],
                         "lines": [len(lines)], "repaired": ["\n".join(lines)]})


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """Find the faults of every conversation and its cheapest repair.

    Rows count in the order of turn (nulls first), role, text.  Returns two
    tables.  The report has a row per conversation: ``conv_id``, ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` and
    ``audit`` (initials of Keep, Rerole, Delete and Insert).  The parts hold
    the repaired conversations: ``conv_id``, ``part``, ``parts`` (how many the
    conversation has), ``lines`` and ``repaired`` (``role:text`` lines joined
    by newline); nearly all have one part, longer ones a part per block, to be
    read in the order of ``part``.

    A null role or text counts as one space; null conversation ids are one
    conversation; null turns come first and count for no gap.  Equal rows
    are duplicates of the first one.  An empty table gives empty tables;
    other columns are ignored, whatever their names.
    """
    blank = F.lit(" ")
    return _repair(turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), blank).alias("text"), F.lit(1).alias("copies")),
                   block_rows, block_chars)


def _repair(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """The same for rows that each stand for a number of ``copies``."""
    ship_package(turns.sparkSession)
    keys = ["conv_missing", "conv"]
    rows = turns.select(F.col("conv_id").isNull().alias("conv_missing"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
                        "turn", "role", "text", F.col("copies").cast("long").alias("copies"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    counted = rows.groupBy(*keys, "turn", "role", "text").agg(F.sum("copies").alias("n"))
    # where a role and text stand at several turns, all but the first were seen; blank rows have their own fault
    mark = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2")]
    first = (rows.where(F.col("text").rlike(WORD_PATTERN)).select(*keys, *mark, order.alias("at")).groupBy(*keys, "h1", "h2")
             .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at")).where("first_at <> last_at").drop("last_at"))
    seen = (counted.select("*", *mark, order.alias("at")).join(first, [*keys, "h1", "h2"], "left")
            .select(*keys, "turn", "role", "text", "n", F.coalesce(F.col("at") > F.col("first_at"), F.lit(False)).alias("seen")))
    head = F.substring("text", 1, 64)
    ranges = (seen.repartitionByRange(*keys, F.col("turn").asc_nulls_first(), "role", head)
              .sortWithinPartitions(*keys, F.col("turn").asc_nulls_first(), "role", head, "text"))
    done = stage(ranges.mapInPandas(lambda frames: _scan(frames, block_rows, block_chars), _KEY + _OPEN + ", " + _CLOSED), "conversations")

    closed = done.where("block IS NULL")
    opened = done.where("block IS NOT NULL").select(*keys, "block", "place", "turn", "role", "text", "n", "seen")
    group = [*keys, "block"]
    blocks = stage(opened.groupBy(*group).applyInPandas(_block_matrix, _KEY + "block long, " + _STATS +
                   ", moves array<long>, initials array<string>, faults array<string>, counts array<long>"), "blocks")
    goals = blocks.select(*group, "moves").groupBy(*keys).applyInPandas(
        _goals, _KEY + "block long, goal array<long>, cost long, is_last boolean")
    goals = stage(goals, "goals")
    exits = stage(blocks.select(*group, "initials", "faults", "counts").join(goals, group)
                  .mapInPandas(_exits, _KEY + "block long, audits array<string>, exits array<int>"), "exits")
    begins = exits.select(*group, "exits").groupBy(*keys).applyInPandas(_starts, _KEY + "block long, begins int")
    plan = stage(exits.join(begins, group).select(*group, "begins", F.col("audits")[F.col("begins")].alias("audit")), "plan")
    audits = (plan.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("a"))
              .select(*keys, F.array_join(F.col("a.audit"), "").alias("audit")))
    summary = blocks.drop("moves", "initials", "faults", "counts").groupBy(*keys).applyInPandas(
        _sum_up, _KEY + "gaps long, blank long, duplicate long, truncated long, illegal long")
    columns = [*keys, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    long_ones = summary.join(goals.where("is_last").select(*keys, "cost"), keys).join(audits, keys).select(*columns)
    parts = (opened.groupBy(*group).cogroup(plan.groupBy(*group))
             .applyInPandas(_edit_block, _KEY + "part long, lines long, repaired string"))

    conv = F.when(~F.col("conv_missing"), F.col("conv")).alias("conv_id")
    report = closed.select(*columns).unionByName(long_ones).select(conv, *columns[2:])
    parts = parts.join(plan.groupBy(*keys).agg(F.count("*").alias("parts")), keys)
    whole = closed.select(*keys, F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), F.length(F.translate("audit", "D", "")).cast("long").alias("lines"), "repaired")
    return report, whole.unionByName(parts).select(conv, "part", "parts", "lines", "repaired")


def _digest(frames):
    """SHA-256 of every conversation from its parts in order; parts stream."""
    import hashlib
    key = state = None
    some = False
    out = []
    for frame in frames:
        for missing, conv, lines, text in zip(frame["conv_missing"].tolist(), frame["conv"].tolist(), frame["lines"].tolist(), frame["repaired"].tolist()):
            if key != (missing, conv):
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state, some = (missing, conv), hashlib.sha256(), False
            if lines:
                if some:
                    state.update(b"\n")
                state.update(text.encode("utf-8", "surrogatepass"))
                some = True
        yield pd.DataFrame(out, columns=["conv_missing", "conv", "sha256"])
        out = []
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["conv_missing", "conv", "sha256"])


def repaired_digests(parts: DataFrame) -> DataFrame:
    """SHA-256 of every repaired conversation: (conv_id, repaired_sha256).

    A digest needs the bytes in order, so several parts of one conversation
    stream through one task, a part in memory at a time."""
    ship_package(parts.sparkSession)
    whole = parts.where("parts = 1").select("conv_id", F.sha2("repaired", 256).alias("repaired_sha256"))
    rows = parts.where("parts > 1").select(F.col("conv_id").isNull().alias("conv_missing"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "part", "lines", "repaired")
    sums = (rows.repartition("conv_missing", "conv").sortWithinPartitions("conv_missing", "conv", "part")
            .mapInPandas(_digest, _KEY + "sha256 string"))
    return whole.unionByName(sums.select(F.when(~F.col("conv_missing"), F.col("conv")).alias("conv_id"), F.col("sha256").alias("repaired_sha256")))


def damage(turns: DataFrame) -> DataFrame:
    """Damage by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    its text, 2 removes ``.!?`` from it, 3 repeats it (``copies`` = 2), 4 makes
    its role user.  Nulls count as one space; ``conv_id`` and ``turn`` stay null."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
                         F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
                         F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))
            .where("kind <> 0").withColumn("copies", F.when(F.col("kind") == 3, 2).otherwise(1)).drop("kind"))


def damaged_and_repaired(turns: DataFrame, **blocks) -> DataFrame:
    """Damage the rows, repair what is left, and report on every original
    conversation; one that lost all its rows has zeros and an empty repair."""
    report, parts = _repair(damage(turns), **blocks)
    zero = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = {"audit": "", "repaired_sha256": "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
    ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    digests = repaired_digests(parts).withColumnRenamed("conv_id", "of")
    return (ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
            .join(digests, F.col("id").eqNullSafe(F.col("of")), "left").drop("of").withColumnRenamed("id", "conv_id")
            .fillna(zero | nothing, subset=[*zero, *nothing]))
