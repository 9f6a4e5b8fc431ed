"""Conversation structure repair by a bidirectional search over the edit lattice.

A conversation's rows, in order of turn, must come to give the roles ``(s?(ua)+)?`` (first
letters of system, user, assistant). A lattice node is (rows taken, state); the states are
nothing yet, after the system row, after a user, after an assistant. Edges: Keep a row whose
letter fits (0), Rerole it to the role that fits (1), Delete it (2, a must for blank and
duplicate rows), Insert an empty row of the role that fits (5); keeping or reroling a
truncated row adds 5. Dijkstra runs forward from the start and in reverse from the goals;
the search ends when both heaps' tops sum to more than the best crossing, so that all
crossings of the least cost are known, and the least concatenated audit among them wins. As
the letters of an audit fix the states, no audit of a node is the start of another one of
equal cost, so least parts give a least whole.

Nothing but one flag row per message meets its neighbours: messages are dealt by ranges of
(conversation, turn), so a conversation with most of the rows is spread over many tasks.
Conversations that lie inside one task and have up to ``SEGMENT`` rows are solved there. Of
all others, each run of up to ``SEGMENT`` rows is solved for the four states it may begin
and the four it may end with (no insert after its last row: the next run, or the end of the
conversation, does those), and a chain over the runs' costs picks one of the sixteen; only
80 bytes a run meet in one task there. The digest of a repaired conversation is over all of
its text in order: it streams, sorted, through one task, holding the audit (a letter a row).

Defined results: null ids, turns, roles and texts count as one space where a string is
needed; a null id is a conversation, a null turn comes first; rows of one turn are ordered
by role, then by a digest of role and text; equal rows follow each other; a conversation
without rows gives zeros and the digest of ''; very long conversations and texts: as above;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice, repeat

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import ASCII_SPACE, checkpoint

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # after an inserted or reroled row
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
GOALS = (NOTHING, ASSISTANT)
SEGMENT = 512
FAR = 1 << 60

Row = tuple[str, bool, bool]  # first letter of the role, must be deleted, truncated


# ---- the search ---------------------------------------------------------------------------


def kept_state(state: int, letter: str) -> int | None:
    """The state after keeping a row with this role letter, or None if it does not fit."""
    if letter == "s":
        return SYSTEM if state == NOTHING else None
    if letter == "u":
        return USER if state != USER else None
    return ASSISTANT if letter == "a" and state == USER else None


def _ahead(rows: list[Row], i: int, state: int, tail: bool) -> Iterator[tuple[int, int, int, str]]:
    """Edges that leave a node: (rows taken, state, cost, letter)."""
    if i < len(rows) or tail:
        yield i, NEXT[state], INSERT, "I"
    if i < len(rows):
        letter, must, cut = rows[i]
        yield i + 1, state, DELETE, "D"
        if not must:
            more = TRUNCATED if cut else 0
            yield i + 1, NEXT[state], REROLE + more, "R"
            kept = kept_state(state, letter)
            if kept is not None:
                yield i + 1, kept, KEEP + more, "K"


def _back(rows: list[Row], i: int, state: int, tail: bool) -> Iterator[tuple[int, int, int, str]]:
    """Edges that reach a node, from where they come."""
    before = [s for s in range(4) if NEXT[s] == state]
    if i < len(rows) or tail:
        for s in before:
            yield i, s, INSERT, "I"
    if i:
        letter, must, cut = rows[i - 1]
        yield i - 1, state, DELETE, "D"
        if not must:
            more = TRUNCATED if cut else 0
            for s in before:
                yield i - 1, s, REROLE + more, "R"
            for s in range(4):
                if kept_state(s, letter) == state:
                    yield i - 1, s, KEEP + more, "K"


def search(rows: list[Row], start: int = NOTHING, goals: Iterable[int] = GOALS, tail: bool = True) -> tuple[int, str] | None:
    """Least cost and least audit from (0, start) to one of (all rows, goals), or None.
    ``tail``: whether rows may be inserted after the last one.

    Heaps are ordered by cost, then by the way each side runs; edges without cost always
    take a row, so a node's label is final when it leaves its heap."""
    n = len(rows)
    labels: tuple[dict, dict] = ({(0, start): (0, "")}, {(n, g): (0, "") for g in goals})
    heaps: tuple[list, list] = ([(0, 0, start)], [(0, 0, g) for g in goals])
    closed: tuple[set, set] = (set(), set())
    best = min((0 for v in labels[0] if v in labels[1]), default=FAR)
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, taken, state = heappop(heaps[side])
        node = (taken if side == 0 else n - taken, state)
        own, other = labels[side], labels[1 - side]
        if node in closed[side]:
            continue
        closed[side].add(node)
        audit = own[node][1]
        for i, s, more, letter in (_ahead, _back)[side](rows, *node, tail):
            to = (i, s)
            if to in closed[side]:
                continue
            label = (cost + more, audit + letter if side == 0 else letter + audit)
            known = own.get(to)
            if known is None or label < known:
                own[to] = label
                if known is None or label[0] < known[0]:
                    heappush(heaps[side], (label[0], i if side == 0 else n - i, s))
                if to in other:
                    best = min(best, label[0] + other[to][0])
    crossings = (f[1] + labels[1][v][1] for v, f in labels[0].items() if v in labels[1] and f[0] + labels[1][v][0] == best)
    return None if best >= FAR else (best, min(crossings))


def repaired(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation; rows: (role, text) in order."""
    edits, state = iter(audit), NOTHING
    for role, text in rows:
        for edit in edits:
            if edit == "I":
                state = NEXT[state]
                yield NAMES[state], ""
                continue
            if edit == "K":
                state = kept_state(state, role[:1])
                yield role, text
            elif edit == "R":
                state = NEXT[state]
                yield NAMES[state], text
            break
    for _ in edits:
        state = NEXT[state]
        yield NAMES[state], ""


# ---- runs of rows ---------------------------------------------------------------------------

RUN = ("part int, idx int, whole boolean, n long, blank long, duplicate long, truncated long, illegal long, "
       "first_letter string, last_letter string, low long, high long, turns long, cost long, audit string, costs array<long>, audits array<string>")


class _Run:
    """Rows of one conversation that follow each other in one task."""

    def __init__(self) -> None:
        self.rows: list[Row] = []
        self.faults = [0, 0, 0]
        self.illegal = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, letter: str, blank: bool, duplicate: bool, cut: bool) -> None:
        if self.rows and self.rows[-1][0] + letter not in LEGAL:
            self.illegal += 1
        fault = 0 if blank else 1 if duplicate else 2 if cut else None
        if fault is not None:
            self.faults[fault] += 1
        self.rows.append((letter, blank or duplicate, fault == 2))
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns += 1
            self.high = turn

    def solved(self, whole: bool) -> list:
        ends = [self.rows[0][0], self.rows[-1][0]] if self.rows else [None, None]
        figures = [len(self.rows), *self.faults, self.illegal, *ends, self.low, self.high, self.turns]
        if whole:
            cost, audit = search(self.rows)
            return [*figures, cost, audit, None, None]
        ways = [search(self.rows, a, (b,), tail=False) for a in range(4) for b in range(4)]
        return [*figures, None, None, [w[0] if w else FAR for w in ways], [w[1] if w else None for w in ways]]


def _runs(messages: DataFrame, kind: str, segment: int) -> DataFrame:
    """Runs of messages (conv, turn, role, mark, letter, blank, cut, n, first), already dealt by ranges and sorted."""
    names = ["conv", "part", "idx", "whole"]
    schema = f"conv {kind}, {RUN}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, idx = TaskContext.get().partitionId(), 0
        out: list[list] = []
        now, conv, pieces, seen = _Run(), None, 0, False
        at_start = True  # the task's first conversation may have begun in another task

        def end(last: bool, more: bool) -> None:
            nonlocal now, idx, pieces, at_start
            whole = not (last or more or pieces or at_start)
            out.append([conv, part, idx, whole, *now.solved(whole)])
            now, idx, pieces = _Run(), idx + 1, pieces + 1
            if not more:
                pieces, at_start = 0, False

        def batch() -> pa.RecordBatch:
            cols = [pa.array(x, t) for x, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, fields)

        first = True
        for b in batches:
            if first:
                types = [b.schema.field(0).type, pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 4,
                         pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
                fields = [*names, "n", "blank", "duplicate", "truncated", "illegal", "first_letter", "last_letter", "low", "high", "turns", "cost", "audit", "costs", "audits"]
                first = False
            for own, turn, letter, blank, cut, n, head in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if seen and own != conv:
                    end(False, False)
                conv, seen = own, True
                for k in range(n):
                    if len(now.rows) >= segment:
                        end(False, True)
                    now.add(turn, letter, blank, not (head and k == 0), cut)
            if len(out) >= 2000:
                yield batch()
        if seen:
            end(True, False)
        if out:
            yield batch()

    return messages.mapInArrow(run, schema)


def _chained(runs: DataFrame, kind: str) -> DataFrame:
    """For conversations of several runs: per run the chosen way, and what its border adds.
    Runs come sorted by conversation; 16 costs and the order of 16 audits are held per run."""
    schema = f"conv {kind}, part int, idx int, seq int, way int, cost long, more_illegal long, same_turn long, closing int"
    columns = ["conv", "part", "idx", "n", "first_letter", "last_letter", "low", "high", "costs", "ranks"]

    def solve(own: list[tuple]) -> Iterator[tuple]:
        rest = [[0, 2 * INSERT, INSERT, 0]]  # from each state to the end of the conversation
        for *_, costs, _ in reversed(own):
            rest.append([min(costs[4 * a + b] + rest[-1][b] for b in range(4)) for a in range(4)])
        rest.reverse()
        state, letter, high = NOTHING, None, None
        for k, (conv, part, idx, n, first, last, low, top, costs, ranks) in enumerate(own):
            fit = [b for b in range(4) if costs[4 * state + b] < FAR and costs[4 * state + b] + rest[k + 1][b] == rest[k][state]]
            to = min(fit, key=lambda b: ranks[4 * state + b])
            border = int(bool(n) and letter is not None and letter + first not in LEGAL)
            same = int(low is not None and low == high)
            way, state = 4 * state + to, to
            closing = rest[-1][state] // INSERT if k == len(own) - 1 else 0
            yield conv, part, idx, k, way, costs[way] + closing * INSERT, border, same, closing
            letter, high = (last if n else letter), (top if top is not None else high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[tuple] = []
        kinds = [pa.null(), *[pa.int32()] * 4, *[pa.int64()] * 3, pa.int32()]
        names = ["conv", "part", "idx", "seq", "way", "cost", "more_illegal", "same_turn", "closing"]

        def flush() -> Iterator[pa.RecordBatch]:
            got = list(solve(own))
            own.clear()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*got), kinds)], names)

        for b in batches:
            kinds[0] = b.schema.field(0).type
            for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if own and own[-1][0] != row[0]:
                    yield from flush()
                own.append(row)
        if own:
            yield from flush()

    # Place of each audit among all of its run: equal audits cannot be of one way.
    ranks = F.transform("audits", lambda a: F.when(a.isNotNull(), F.array_position(F.array_sort(F.array_compact("audits")), a)).cast("int"))
    dealt = runs.withColumn("ranks", ranks).select(*columns).repartition("conv").sortWithinPartitions("conv", "part", "idx")
    return dealt.mapInArrow(run, schema)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """Per conversation: its id, ``gaps`` (turns that are missing between its least and its
    largest), how many rows are ``blank``, ``duplicate`` and ``truncated`` (the first fault of
    a row counts), ``illegal`` neighbours, the least ``cost``, the ``audit`` (letters of the
    edits, in order) and ``repaired_sha256`` of the repaired ``role:text`` lines. ``copies``:
    how often each row counts (once by default; a row that counts 0 times leaves its
    conversation in the result)."""
    kind = df.schema[conv_col].dataType.simpleString()
    space = F.lit(" ")
    base = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), space).alias("role"),
                     F.coalesce(F.col(text_col), space).alias("text"), F.coalesce(copies if copies is not None else F.lit(1), F.lit(0)).cast("long").alias("n"))
    mark = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    base = base.withColumn("mark", mark)
    bare = F.rtrim("text", F.lit(ASCII_SPACE))
    flags = base.select("conv", "turn", "role", "mark", "n", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    # Equal rows of a turn are one row with a count, so copies meet summed up.
    rows = checkpoint(flags.groupBy("conv", "turn", "role", "mark", "blank", "cut").agg(F.sum("n").alias("n")))
    age = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("at"))
    firsts = rows.where((F.col("n") > 0) & ~F.col("blank")).groupBy(F.col("conv").alias("c"), F.col("mark").alias("m")).agg(F.min(age).alias("age"))
    rows = rows.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")) & (age == F.col("age")), "left")
    order = ["conv", "turn", "role", "mark"]
    rows = checkpoint(rows.select(*order, F.substring("role", 1, 1).alias("letter"), "blank", "cut", "n", F.col("m").isNotNull().alias("head")))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "letter", "blank", "cut", "n", "head")
    runs = checkpoint(_runs(dealt, kind, segment))

    figures = ["blank", "duplicate", "truncated"]
    gaps = lambda low, high, turns: F.coalesce(high - low + 1 - turns, F.lit(0).cast("long")).alias("gaps")
    whole = runs.where("whole").select("conv", gaps(F.col("low"), F.col("high"), F.col("turns")), *figures, "illegal", "cost", "audit")
    opened = runs.where(~F.col("whole"))
    ways = _chained(opened, kind).select("part", "idx", "seq", "way", F.col("cost").alias("own_cost"), "more_illegal", "same_turn", "closing")
    letters = F.concat(F.element_at("audits", F.col("way") + 1), F.repeat(F.lit("I"), F.col("closing")))
    joined = opened.join(ways, ["part", "idx"]).withColumn("letters", F.struct("seq", letters.alias("a")))
    pieced = joined.groupBy("conv").agg(
        gaps(F.min("low"), F.max("high"), F.sum(F.col("turns") - F.col("same_turn"))), *[F.sum(c).alias(c) for c in figures],
        F.sum(F.col("illegal") + F.col("more_illegal")).alias("illegal"), F.sum("own_cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list("letters")), lambda x: x["a"]), "").alias("audit"))
    judged = whole.unionByName(pieced)
    return _digested(judged, base.where("n > 0"), kind).withColumnRenamed("conv", conv_col)


def _digested(judged: DataFrame, base: DataFrame, kind: str) -> DataFrame:
    """``judged`` plus the digest; each conversation's messages follow its audit in one sorted stream."""
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = F.lit(None)
    heads = judged.select("conv", F.lit(0).alias("is_text"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("mark"),
                          F.lit(1).cast("long").alias("n"), F.col("audit").alias("text"), F.array(*figures).alias("figures"))
    texts = base.select("conv", F.lit(1).alias("is_text"), "turn", "role", "mark", "n", "text", none.cast("array<long>").alias("figures"))
    order = ["conv", "is_text", "turn", "role", "mark"]
    stream = heads.unionByName(texts).repartition("conv").sortWithinPartitions(*order).select("conv", "is_text", "role", "n", "text", "figures")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def messages() -> Iterator[tuple]:
            nonlocal conv_type
            for b in batches:
                conv_type = b.schema.field(0).type
                for at in range(0, b.num_rows, 64):  # long texts become Python strings in turn
                    yield from zip(*(b.column(i).slice(at, 64).to_pylist() for i in range(b.num_columns)))

        def own_of(rows: Iterator[tuple], rest: list) -> Iterator[tuple[str, str]]:
            """Messages up to the next conversation's head, which goes to ``rest``."""
            for row in rows:
                if not row[1]:
                    rest.append(row)
                    return
                yield from repeat((row[2], row[4]), row[3])

        conv_type, out = pa.null(), []
        rows, rest = messages(), []
        rest.extend(islice(rows, 1))
        while rest:
            conv, _, _, _, audit, figures = rest.pop()
            digest, lead = hashlib.sha256(), b""
            for role, text in repaired(own_of(rows, rest), audit):
                digest.update(lead + role.encode() + b":")
                digest.update(text.encode())
                lead = b"\n"
            out.append((conv, *figures, audit, digest.hexdigest()))
            if len(out) >= 2000:
                yield pack(out, conv_type)
                out = []
        if out:
            yield pack(out, conv_type)

    def pack(out: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        kinds = [conv_type, *[pa.int64()] * len(figures), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], ["conv", *figures, "audit", "repaired_sha256"])

    return stream.mapInArrow(run, f"conv {kind}, {', '.join(f'{c} long' for c in figures)}, audit string, repaired_sha256 string")


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, Column]:
    """Rows (conv_id, turn, role, text) with the test damage, and how often each counts:
    by crc32(``conv_id:turn``) % 20, 0 drops a row, 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 makes its role user. Nulls are one space first."""
    space = F.lit(" ")
    text, role = F.coalesce(F.col(text_col), space), F.coalesce(F.col(role_col), space)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv_col, turn_col)])
    kind = F.crc32(key.cast("binary")) % 20
    out = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                    F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
    return out, F.col("copies")
