"""Repair of conversation structure by a Viterbi search whose survivors coalesce.

A well-formed conversation has the role initials ``(s?(ua)+)?``. Four states read them:
START, SYSTEM (after s), USER (after u) and ASSISTANT (after a); START and ASSISTANT end a
conversation. Before each row, and after the last, empty user or assistant turns may be
inserted (I, cost 5); the row itself is kept (K, 0), given the role user or assistant (R, 1) or
deleted (D, 2). Blank and duplicate rows must be deleted; a truncated row that stays costs 5
more. Of the cheapest edits, those whose letters are ASCII-least are taken. Roles follow from
the letters: a kept first s opens, all else alternates u and a.

The search keeps one survivor a state, without those that are dearer than another by more than
any way on could make up for. Survivors are leaves of a tree of back pointers whose
nodes count their references: a node that no survivor descends from is freed, and as soon as all
survivors share an ancestor, the edits up to it are emitted. What is held is what is still
undecided. Survivors of equal cost are compared by all their undecided letters; two of the
same rows and equal cost are never one the beginning of the other, as letters that differ only by
inserted turns differ in cost, so this comparison is final.

A conversation may hold a third of all rows. Its rows' places are found without gathering
them (``operators.ordered``); SEGMENT rows in order are one segment. For conversations of more
than one, a segment is first summed up as its least costs between each two states; the costs
from its end to the conversation's end follow from these sums alone, a row a segment. With
them, a segment's search ends as the whole conversation's cheapest, ASCII-least edits do there
(insertions are made before rows, so that segments end on a row's letter), for each state that
it may begin in; following these from the first segment gives every segment its first state,
and the segments are searched on their own. Duplicates are found by the
least place of a role and text, aggregated on the map side.

Defined results: null roles and texts count as one space, an empty role as a space too; rows
are ordered by turn, nulls first, then by role, by a hash of the text and by their number in the
table, so rows repeated in the table are duplicates of each other; a null conv_id is a conversation
of its own; a conversation without rows has no edits and cost 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocline.operators.ordered import with_successor
from thermocline.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
KEEP_COST, RELABEL_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
#: Rows of a segment; conversations of more are searched in segments.
SEGMENT = 65_536
GOOD, BLANK, DUPLICATE, TRUNCATED = range(4)
NEVER = 1 << 60

#: State after a turn of this initial.
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}


def _inserted(state: int) -> list[tuple[int, int, str]]:
    """(state, cost, letters) after inserted turns; more than two of them come back to a state."""
    out = [(state, 0, "")]
    while len(out) < 3:
        before, cost, letters = out[-1]
        after = _AFTER.get((before, "u"), _AFTER.get((before, "a")))
        out.append((after, cost + INSERT_COST, letters + "I"))
    return out


def _steps(initial: str, fault: int) -> dict[int, list[tuple[int, int, str]]]:
    """state after -> (state before, cost, letters) of the best way over a row with this initial and fault."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        for state, cost, letters in _inserted(before):
            ways = [(state, DELETE_COST, "D")]
            if fault in (GOOD, TRUNCATED):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                if (state, initial) in _AFTER:
                    ways.append((_AFTER[state, initial], KEEP_COST + more, "K"))
                ways += [(_AFTER[state, r], RELABEL_COST + more, "R") for r in "ua" if (state, r) in _AFTER]
            for after, extra, letter in ways:
                way = (cost + extra, letters + letter)
                if way < best.get((before, after), (NEVER, "")):
                    best[before, after] = way
    return {after: [(b, *best[b, after]) for b in range(4) if (b, after) in best] for after in range(4)}


STEPS = {(i, f): _steps(i, f) for i in "sua?" for f in range(4)}
#: Cost and letters from a state to the conversation's end.
FINAL = {s: min((c, t) for state, c, t in _inserted(s) if state in ENDS) for s in range(4)}


#: Most that any way on from the first state costs more from the second: inserted turns, and once the
#: deletion of a system row that only START could keep. A survivor that is dearer by more cannot win.
MORE_FROM = {
    START: {SYSTEM: 2 * INSERT_COST + DELETE_COST, USER: INSERT_COST + DELETE_COST, ASSISTANT: DELETE_COST},
    SYSTEM: {START: 0, USER: INSERT_COST, ASSISTANT: 0},
    USER: {START: INSERT_COST, SYSTEM: INSERT_COST, ASSISTANT: INSERT_COST},
    ASSISTANT: {START: 0, SYSTEM: 2 * INSERT_COST, USER: INSERT_COST},
}


class _Node:
    """Letters of one row's edits below those of ``parent``; ``refs`` counts children and survivors."""

    __slots__ = ("parent", "letters", "refs")

    def __init__(self, parent: _Node | None, letters: str):
        self.parent, self.letters, self.refs = parent, letters, 0
        if parent is not None:
            parent.refs += 1


def _undecided(node: _Node, root: _Node) -> str:
    letters = []
    while node is not root:
        letters.append(node.letters)
        node = node.parent
    return "".join(reversed(letters))


class Survivors:
    """The search over one run of rows, from the given costs of the first states."""

    def __init__(self, first: dict[int, int]):
        self.root = _Node(None, "")
        self.root.refs += 1  # held by the search
        self.held = {s: (c, _Node(self.root, "")) for s, c in first.items()}
        for _, node in self.held.values():
            node.refs += 1

    def _free(self, node: _Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node = node.parent
            node.refs -= 1

    def _better(self, cost: int, node: _Node, letters: str, than: tuple | None) -> bool:
        if than is None or cost != than[0]:
            return than is None or cost < than[0]
        return _undecided(node, self.root) + letters < _undecided(than[1], self.root) + than[2]

    def step(self, initial: str, fault: int) -> str:
        """Take a row; returns the letters that are decided by now."""
        chosen = {}
        for after, ways in STEPS[initial, fault].items():
            best = None
            for before, cost, letters in ways:
                if before in self.held:
                    c, node = self.held[before]
                    if self._better(c + cost, node, letters, best):
                        best = (c + cost, node, letters)
            if best:
                chosen[after] = best
        lost = [s for s, own in chosen.items() if any(t in chosen and own[0] > chosen[t][0] + more for t, more in MORE_FROM[s].items())]
        for s in lost:
            del chosen[s]
        old, self.held = self.held, {s: (c, _Node(node, letters)) for s, (c, node, letters) in chosen.items()}
        for _, node in self.held.values():
            node.refs += 1
        for _, node in old.values():
            self._free(node)
        return self._emit()

    def _emit(self) -> str:
        """Move the root to the survivors' last common ancestor."""
        if self.root.refs != 2:  # the search's own and one child's
            return ""
        path, node = [], next(iter(self.held.values()))[1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        out = []
        for node in reversed(path):
            if self.root.refs != 2:
                break
            node.parent, out = None, [*out, node.letters]
            node.refs += 1
            self.root = node
        return "".join(out)

    def end(self, last: dict[int, tuple[int, str]]) -> tuple[int, int, str]:
        """(cost, state, letters still undecided) of the best survivor, with the cost and letters that follow a state."""
        best = state = None
        for s, (c, node) in self.held.items():
            cost, letters = last.get(s, (NEVER, ""))
            if cost < NEVER and self._better(c + cost, node, letters, best):
                best, state = (c + cost, node, letters), s
        return best[0], state, _undecided(best[1], self.root) + best[2]

    def nodes(self) -> int:
        """Nodes alive, for the tests of bounded memory."""
        seen = set()
        for _, node in self.held.values():
            while node is not None:
                seen.add(id(node))
                node = node.parent
        return len(seen)


def repair(rows: Iterable[tuple[str, int]], first: int = START, last: dict[int, tuple[int, str]] | None = None) -> Iterator[tuple[str, int, int]]:
    """(letters, 0, -1) as they are decided, from rows (initial, fault); last come (letters, cost, end state)."""
    search = Survivors({first: 0})
    for initial, fault in rows:
        if letters := search.step(initial, fault):
            yield letters, 0, -1
    cost, state, letters = search.end(FINAL if last is None else last)
    yield letters, cost, state


def costs_between(rows: Iterable[tuple[str, int]]) -> np.ndarray:
    """Least cost from each state before the rows to each after them."""
    out = np.where(np.eye(4, dtype=bool), 0, NEVER)
    memo: dict[tuple[str, int], np.ndarray] = {}
    for kind in rows:
        if kind not in memo:
            one = np.full((4, 4), NEVER)
            for after, ways in STEPS[kind].items():
                for before, cost, _ in ways:
                    one[before, after] = cost
            memo[kind] = one
        out = np.minimum((out[:, :, None] + memo[kind][None]).min(axis=1), NEVER)
    return out


ROLES = {"u": "user", "a": "assistant"}
FAULTS = {BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}
EDIT_KINDS = [("conv", pa.int64()), ("no_conv", pa.bool_()), ("seg", pa.int64()), ("n", pa.int64()), ("letter", pa.string()), ("pos", pa.int64()), ("role", pa.string()), ("cost", pa.int64())]
EDIT_DDL = "conv long, no_conv boolean, seg long, n long, letter string, pos long, role string, cost long"
#: One conversation of the table: conv_id without nulls, and whether it was null.
CONV = ["conv", "no_conv"]


def _conv(col: str = "conv_id") -> dict[str, Column]:
    return {"conv": F.coalesce(F.col(col).cast("long"), F.lit(0)), "no_conv": F.col(col).isNull()}


def placed_rows(conversations: DataFrame) -> DataFrame:
    """conv, no_conv, turn, role, text, row (a number), pos (place in the conversation from 1), initial, fault and
    next_initial (null on the last row) of every row of ``conversations`` (conv_id, turn, role, text)."""
    filled = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = conversations.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role"), filled("text"), F.monotonically_increasing_id().alias("row"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), -1, 1)
    initial = F.when(F.col("role") == "", F.lit(" ")).otherwise(F.substring("role", 1, 1))
    own = {"initial": initial, "last": last, "digest": F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256), "by_text": F.xxhash64("text")}
    rows = materialize(rows.withColumns(_conv() | own).drop("conv_id"), "repair-rows")
    # the place of a row among all that say the same: turn, nulls first, then its number
    place = F.struct(F.col("turn").alias("turn"), F.col("row").alias("row"))
    firsts = rows.where("last <> ''").groupBy(*CONV, "digest").agg(F.min(place)["row"].alias("first_row"))
    fault = F.when(F.col("last") == "", F.lit(BLANK)).when(F.col("row") != F.col("first_row"), F.lit(DUPLICATE)).when(~F.col("last").isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(GOOD))
    narrow = rows.join(firsts, [*CONV, "digest"], "left").select(*CONV, "turn", "role", "by_text", "row", "initial", fault.alias("fault"))
    narrow = materialize(narrow, "repair-faults")
    ordered = with_successor(narrow, CONV, ["turn", "role", "by_text", "row"], ["initial"], position_col="pos")
    places = ordered.select("row", "pos", "initial", "fault", "next_initial")
    return materialize(rows.select(*CONV, "turn", "row", "role", "text").join(places, "row"), "repair-places")


def _runs(batches, keys: list[str]):
    """(key, rows) for each run of equal keys in sorted batches, rows as an iterator of (initial, fault)."""
    def rows():
        for batch in batches:
            kinds = [i if i in ("s", "u", "a") else "?" for i in batch.column("initial").to_pylist()]
            yield from zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), kinds, batch.column("fault").to_pylist(), strict=True)

    for key, own in itertools.groupby(rows(), key=lambda r: r[0]):
        yield key, ((initial, fault) for _, initial, fault in own)


def _written(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


def _over_runs(rows: DataFrame, keys: list[str], outcome, schema: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    """``outcome(key, rows)`` gives result rows of each run; runs stream through the task that holds them."""

    def run(batches):
        out = []
        for key, own in _runs(batches, keys):
            for r in outcome(key, own):
                out.append(r)
                if len(out) >= 4096:
                    yield _written(out, schema)
                    out = []
        yield _written(out, schema)

    dealt = rows.select(*keys, "pos", "initial", "fault").repartition(*CONV, "seg").sortWithinPartitions(*CONV, "seg", "pos")
    return dealt.mapInArrow(run, ddl)


def _ends(costs: np.ndarray) -> np.ndarray:
    """From each segment's costs between states: the least cost from each state at its end to the conversation's end."""
    after = np.array([FINAL[s][0] for s in range(4)])
    out = []
    for one in costs[::-1]:
        out.append(after)
        after = np.minimum((one + after[None, :]).min(axis=1), NEVER)
    return np.array(out[::-1])


def segment_plan(rows: DataFrame) -> DataFrame:
    """conv, no_conv, seg, first (state) and after (least costs from the states at its end to the conversation's; null
    for the last) of the segments of conversations with more than one."""
    many = rows.groupBy(*CONV).agg(F.max("seg").alias("top")).where("top > 0")
    many = materialize(many, "repair-long")
    keys = [*CONV, "seg"]
    ddl = "conv long, no_conv boolean, seg long, "
    kinds = [("conv", pa.int64()), ("no_conv", pa.bool_()), ("seg", pa.int64())]
    long_rows = rows.join(many.drop("top"), CONV, "left_semi")
    sums = _over_runs(long_rows, keys, lambda key, own: [(*key, costs_between(own).ravel().tolist())], [*kinds, ("costs", pa.list_(pa.int64()))], ddl + "costs array<long>")
    sums = materialize(sums, "repair-sums")

    def ends(t: pa.Table) -> pa.Table:
        t = t.sort_by("seg")
        costs = np.array(t["costs"].to_pylist()).reshape(-1, 4, 4)
        return t.select(keys).append_column("after", pa.array(_ends(costs).tolist(), pa.list_(pa.int64())))

    after = materialize(sums.groupBy(*CONV).applyInArrow(ends, ddl + "after array<long>"), "repair-ends")
    asked = [*keys, "after"]

    def exits(key, own):
        own, last = list(own), {s: (c, "") for s, c in enumerate(key[3])}
        out = []
        for first in range(4):
            search = Survivors({first: 0})
            for initial, fault in own:
                search.step(initial, fault)
            possible = any(last[s][0] < NEVER for s in search.held)
            out.append(search.end(last)[1] if possible else -1)
        return [(*key[:3], out)]

    joined = long_rows.join(after, keys)
    moves = _over_runs(joined, asked, exits, [*kinds, ("moves", pa.list_(pa.int64()))], ddl + "moves array<long>")
    moves = materialize(moves, "repair-moves")

    def follow(t: pa.Table) -> pa.Table:
        t, state, firsts = t.sort_by("seg"), START, []
        for move in t["moves"].to_pylist():
            firsts.append(state)
            state = move[state]
        return t.select(keys).append_column("first", pa.array(firsts, pa.int64()))

    plan = materialize(moves.groupBy(*CONV).applyInArrow(follow, ddl + "first long"), "repair-plan")
    last = F.when(F.col("seg") < F.col("top"), F.col("after"))
    return plan.join(after, keys).join(many, CONV).select(*keys, "first", last.alias("after"))


def edits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for each edit: conv, no_conv, seg and n (its order), letter, pos (of the row it is about; null for I),
    role (a new one, for R and I) and cost. ``rows`` are placed_rows."""
    rows = rows.select(*CONV, "pos", "initial", "fault", F.floor((F.col("pos") - 1) / segment).alias("seg"))
    plan = segment_plan(rows)
    own = rows.join(plan, [*CONV, "seg"], "left").withColumn("first", F.coalesce("first", F.lit(START)))
    keys = [*CONV, "seg", "first", "after"]

    def outcome(key, run):
        taken: deque[tuple[str, int]] = deque()  # rows whose letter is not decided yet

        def noted():
            for r in run:
                taken.append(r)
                yield r

        n, pos, state = 0, key[2] * segment, key[3]
        last = {s: (c, "") for s, c in enumerate(key[4])} if key[4] else None
        for letters, _, _ in repair(noted(), state, last):
            for letter in letters:
                n += 1
                if letter == "I":
                    initial, cost, place = "a" if state == USER else "u", INSERT_COST, None
                else:
                    initial, fault = taken.popleft()
                    pos, place = pos + 1, pos + 1
                    cost = DELETE_COST if letter == "D" else (RELABEL_COST if letter == "R" else KEEP_COST) + (TRUNCATED_COST if fault == TRUNCATED else 0)
                    initial = initial if letter == "K" else "a" if state == USER else "u"
                if letter != "D":
                    state = _AFTER[state, initial]
                yield (*key[:3], n, letter, place, ROLES[initial] if letter in "RI" else None, cost)

    return _over_runs(own, keys, outcome, EDIT_KINDS, EDIT_DDL)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv, no_conv, seg and n (their order), letter, turn, role and text of the repaired conversations' turns."""
    own = rows.select(*CONV, "pos", "turn", F.col("role").alias("old_role"), F.col("text").alias("old_text"))
    kept = found.where("letter <> 'D'").join(own, [*CONV, "pos"], "left")
    return kept.select(*CONV, "seg", "n", "letter", "turn", F.coalesce("role", "old_role").alias("role"), F.coalesce("old_text", F.lit("")).alias("text"))


def faults_and_costs(conversations: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conv_id of ``conversations``."""
    every = conversations.select("conv_id").distinct().withColumns(_conv())
    pair = F.concat("initial", "next_initial")
    count = lambda c: F.count(F.when(c, 1))
    turns = rows.groupBy(*CONV, "turn").agg(
        *[count(F.col("fault") == k).alias(n) for k, n in FAULTS.items()], count(pair.isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal")
    )
    sums = {n: F.sum(n) for n in (*FAULTS.values(), "illegal")}
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))  # a row a turn; nulls do not count
    counted = turns.groupBy(*CONV).agg(gaps.alias("gaps"), *[a.alias(n) for n, a in sums.items()])
    # letters in runs of bounded length first, then the runs of a conversation
    runs = found.groupBy(*CONV, "seg", F.floor(F.col("n") / 4096).alias("run")).agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "letter"))), lambda x: x["letter"]), "").alias("letters")
    )
    audits = runs.groupBy(*CONV).agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "run", "letters"))), lambda x: x["letters"]), "").alias("audit")
    )
    out = every.join(counted, CONV, "left").join(audits, CONV, "left")
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *FAULTS.values(), "illegal", "cost")]
    return out.select("conv_id", *CONV, *longs, F.coalesce("audit", F.lit("")).alias("audit"))


def text_digests(turns: DataFrame) -> DataFrame:
    """conv, no_conv and the SHA-256 of a conversation's ``role:text`` lines, which stream through its task."""

    def run(batches):
        key = digest = None
        out = []
        for batch in batches:
            for conv, no_conv, role, text in zip(*(batch.column(c).to_pylist() for c in (*CONV, "role", "text")), strict=True):
                if (conv, no_conv) != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (conv, no_conv), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if key:
            out.append((*key, digest.hexdigest()))
        yield _written(out, [("conv", pa.int64()), ("no_conv", pa.bool_()), ("sha", pa.string())])

    return turns.repartition(*CONV).sortWithinPartitions(*CONV, "seg", "n").select(*CONV, "role", "text").mapInArrow(run, "conv long, no_conv boolean, sha string")


def repair_report(conversations: DataFrame, damaged: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The faults, cheapest edits and digest of the repaired text of each conversation of ``conversations``, whose rows
    are those of ``damaged`` (the same table, or what is left of it)."""
    rows = placed_rows(damaged)
    found = materialize(edits(rows, segment), "repair-edits")
    digests = text_digests(repaired_turns(rows, found))
    out = faults_and_costs(conversations, rows, found).join(digests, CONV, "left").drop(*CONV)
    return out.withColumn("repaired_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256))).drop("sha")


def damage(conversations: DataFrame) -> DataFrame:
    """The query's damage, by crc32 of ``conv_id:turn`` (nulls are one space) modulo 20."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), code.alias("code")).where("code <> 0")
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
