"""Repair of conversation structure by a dynamic programme with square-root checkpoints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import Saved, pick

# Least rows of a block; blocks grow with the square root of the longest conversation.
BLOCK = 1024
# Copies of one row that stand in one row of the sorted table.
COPIES = 65_536
NULL_TEXT = " "
_SHORT = 64
_WHITE = r"[\x20\x09-\x0D]"
# Faults in the order that counts, as codes; a blank or repeated row must go.
_SOUND, _TRUNCATED, _GONE = 0, 1, 2
# Grammar (s?(ua)+)?: start, after s, after u, after a. What follows on an initial, and on an inserted row.
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_INITIALS = "sua"
_FORCED = (2, 2, 3, 2)
_FORCED_ROLE = ("user", "user", "assistant", "user")
_NEVER = 1 << 60
_ROW_END = (0, _NEVER, _NEVER, 0)
_PASS = tuple(tuple(0 if r == q else _NEVER for q in range(4)) for r in range(4))

Costs = tuple[int, int, int, int]


def closed(own: list[int]) -> Costs:
    """Costs with insertions (2 each) before the row; more than two in a row never help."""
    return tuple(min(own[q], 2 + own[_FORCED[q]], 4 + own[_FORCED[_FORCED[q]]], _NEVER) for q in range(4))


def row_costs(code: int, after: Costs) -> list[int]:
    """Cheapest edit of one row and all after it, by the state before it, without insertions."""
    fault, initial = divmod(code, 4)
    if fault == _GONE:
        return [3 + c for c in after]
    extra = int(fault == _TRUNCATED)
    follows = _NEXT[_INITIALS[initial]] if initial < 3 else (None,) * 4
    return [min(3 + after[q], 2 + extra + after[_FORCED[q]],
                extra + after[follows[q]] if follows[q] is not None else _NEVER) for q in range(4)]


def before(codes: bytes, after: Costs) -> Costs:
    """State costs before the rows ``codes``, given those after them."""
    for code in reversed(codes):
        after = closed(row_costs(code, after))
    return after


def walk(codes: bytes, after: Costs, state: int, last: bool) -> tuple[str, int, int]:
    """``_walk``, remembered for the short conversations that most are."""
    return _short_walk(codes, after, state, last) if len(codes) <= _SHORT else _walk(codes, after, state, last)


def _walk(codes: bytes, after: Costs, state: int, last: bool) -> tuple[str, int, int]:
    """The ASCII-least of the cheapest edits of a block, their cost, and the state they end in.

    ``after`` has the state costs behind the block, ``last`` whether it ends the conversation, where rows may
    still be inserted. Backward cost vectors are kept at every square root of the block only; walking forward, one
    stretch between two of them at a time is computed again.
    """
    n = len(codes)
    step = max(1, isqrt(n))
    starts = range(0, n, step)
    ends: dict[int, Costs] = {}
    costs = closed(list(after)) if last else after
    for at in reversed(starts):
        ends[at] = costs
        costs = before(codes[at:at + step], costs)
    edits: list[str] = []
    spent = 0
    for at in starts:
        stretch = codes[at:at + step]
        vectors = [ends[at]]
        for code in reversed(stretch):
            vectors.append(closed(row_costs(code, vectors[-1])))
        vectors.reverse()
        for i, code in enumerate(stretch):
            here, then = vectors[i], vectors[i + 1]
            fault, initial = divmod(code, 4)
            extra = int(fault == _TRUNCATED)
            while True:
                wanted, forced = here[state], _FORCED[state]
                if 3 + then[state] == wanted:
                    edit, price, goes = "D", 3, state
                elif 2 + here[forced] == wanted:
                    edits.append("I")
                    spent, state = spent + 2, forced
                    continue
                elif fault != _GONE and initial < 3 and (to := _NEXT[_INITIALS[initial]][state]) is not None and (
                        extra + then[to] == wanted):
                    edit, price, goes = "K", extra, to
                else:
                    edit, price, goes = "R", 2 + extra, forced
                edits.append(edit)
                spent, state = spent + price, goes
                break
    while last and state in (_AFTER_S, _AFTER_U):
        edits.append("I")
        spent, state = spent + 2, _FORCED[state]
    return "".join(edits), spent, state


_short_walk = lru_cache(maxsize=16_384)(_walk)


def faults(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, n)`` without their texts: equal rows as one, and the first fault of each.

    Adds ``text_sha``, ``n`` (how many equal rows), ``blank``, ``truncated`` and ``repeated`` (role and text are in an earlier
    turn). Rows are known by the SHA-256 of their text. Both groupings combine map-side, and the join that brings back the
    first turn of a text is one that adaptive execution can split.
    """
    text = F.col("text")
    last = F.regexp_extract(text, rf"([^\x20\x09-\x0D]){_WHITE}*\z", 1)
    marked = rows.select("conv_id", "turn", "role", F.sha2(text.cast("binary"), 256).alias("text_sha"), "n",
                         (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
    equal = marked.groupBy("conv_id", "turn", "role", "text_sha").agg(
        F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("open").alias("open")).filter("n > 0")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    earliest = equal.groupBy("conv_id", "role", "text_sha").agg(first)
    e, f = equal.alias("e"), earliest.alias("f")
    met = e.join(f, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("e.role") == F.col("f.role")) & (
        F.col("e.text_sha") == F.col("f.text_sha")))
    return met.select("e.conv_id", "e.turn", "e.role", "e.text_sha", "e.n", "e.blank",
                      (~F.col("e.turn").eqNullSafe(F.col("f.first.turn"))).alias("repeated"),
                      (F.col("e.open") & ~F.col("e.blank")).alias("truncated"))


_BLOCKS = ("conv_id long, part int, nth int, codes binary, turns array<long>, roles array<string>, shas array<string>, "
           "head string, tail string, illegal long")


def _initial(role: str) -> int:
    return _INITIALS.find(role[0]) if role and role[0] in _INITIALS else 3


def _blocks(size: int):
    """Arrow function over rows sorted by conversation: blocks of at most ``size`` rows of one conversation."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, held, nth, out = None, [], 0, []

        def closed_block() -> dict:
            roles = [r[2] for r in held]
            pairs = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
            return {"conv_id": block[0], "part": part, "nth": nth, "codes": bytes(r[0] for r in held),
                    "turns": [r[1] for r in held], "roles": roles, "shas": [r[3] for r in held],
                    "head": roles[0][:1], "tail": roles[-1][:1], "illegal": pairs}

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:8]]
            for conv, turn, role, sha, n, blank, repeated, cut in zip(*columns, strict=True):
                code = _initial(role) + 4 * (_GONE if blank or repeated else _TRUNCATED if cut else _SOUND)
                if block is not None and block[0] != conv:
                    out.append(closed_block())
                    held, nth = [], 0
                block = (conv,)
                for copy in range(n):
                    if len(held) == size:
                        out.append(closed_block())
                        held, nth = [], nth + 1
                    held.append((code if not copy else 4 * _GONE + _initial(role), turn, role, sha))
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if held:
            out.append(closed_block())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _scans(blocks: DataFrame) -> DataFrame:
    """``conv_id, part, nth, after, state, last`` of each block of the conversations that have several.

    A block is a min-plus matrix from the states before it to those after it. The matrices are combined
    from the last block backwards, which gives the costs behind every block, and what each block makes of each state
    then forwards. A conversation has about the square root of its rows as blocks, so one group stays small.
    """
    key = ["conv_id", "part", "nth"]

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[c for r in range(4) for c in before(codes, _PASS[r])] for codes in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(columns, pa.list_(pa.int64()))], [*key, "m"])

    def behind(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "nth"], ascending=False)
        costs, told = closed(list(_ROW_END)), []
        for m in rows["m"]:
            told.append(list(costs))
            costs = tuple(min(_NEVER, *(int(m[4 * r + q]) + costs[r] for r in range(4))) for q in range(4))
        return rows.assign(after=told, last=[i == 0 for i in range(len(rows))])[[*key, "after", "last"]]

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            ends = [[walk(codes, tuple(after), q, last)[2] for q in range(4)] for codes, after, last in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *batch.columns[4:], pa.array(ends, pa.list_(pa.int32()))], [*key, "after", "last", "ends"])

    def ahead(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "nth"])
        state, told = _START, []
        for ends in rows["ends"]:
            told.append(state)
            state = int(ends[state])
        return rows.assign(state=told)[[*key, "after", "last", "state"]]

    kinds = "conv_id long, part int, nth int, "
    costs = blocks.select(*key, "codes").mapInArrow(matrices, kinds + "m array<long>").groupBy("conv_id").applyInPandas(
        behind, kinds + "after array<long>, last boolean")
    b, c = blocks.alias("b"), costs.alias("c")
    met = b.join(c, F.col("b.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("b.part") == F.col("c.part")) & (
        F.col("b.nth") == F.col("c.nth"))).select("b.conv_id", "b.part", "b.nth", "b.codes", "c.after", "c.last")
    return met.mapInArrow(ways, kinds + "after array<long>, last boolean, ends array<int>").groupBy(
        "conv_id").applyInPandas(ahead, kinds + "after array<long>, last boolean, state int")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of every block, and the rows they leave: place in the block, role, and the row they come from."""
    for batch in batches:
        codes, after, last, state = (batch.column(i).to_pylist() for i in range(3, 7))
        done = [walk(c, tuple(a), q, end) for c, a, end, q in zip(codes, after, last, state, strict=True)]
        rows = []
        for (edits, _, _), turns, roles, shas, q in zip(done, *(batch.column(i).to_pylist() for i in (7, 8, 9)), state,
                                                        strict=True):
            i, left = 0, []
            for place, edit in enumerate(edits):
                if edit == "I":
                    left.append((place, edit, _FORCED_ROLE[q], None, None, None))
                elif edit != "D":
                    role = roles[i] if edit == "K" else _FORCED_ROLE[q]
                    left.append((place, edit, role, turns[i], roles[i], shas[i]))
                if edit != "D":
                    q = _NEXT[left[-1][2][0]][q]
                i += edit != "I"
            rows.append([dict(zip(("place", "edit", "role", "turn", "old_role", "text_sha"), r, strict=True)) for r in left])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()),
             pa.array(rows, pa.list_(pa.struct([("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), (
                 "turn", pa.int64()), ("old_role", pa.string()), ("text_sha", pa.string())])))],
            ["conv_id", "part", "nth", "edits", "cost", "rows"])


def prepared(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n`` of ``rows``, role and text without nulls (a space each), ``n`` 1 if there is none."""
    columns = [("conv_id", "long", "conv_id"), ("turn", "long", "turn"), ("role", "string", "role"), ("text", "string", "text")]
    n = ("n", "long", "n")
    out = pick(rows, *columns, n) if "n" in rows.columns else pick(rows, *columns).withColumn("n", F.lit(1).cast("long"))
    filled = {c: F.coalesce(F.col(c), F.lit(NULL_TEXT)) for c in ("role", "text")}
    return out.withColumns(filled)


class Repair:
    """What ``repair`` gives: ``reports`` has a row per conversation, ``turns()`` the repaired conversations."""

    def __init__(self, rows: DataFrame, reports: DataFrame, edits: DataFrame):
        self.rows, self.reports, self.edits = rows, reports, edits

    def _left(self) -> DataFrame:
        return self.edits.select("conv_id", "part", "nth", F.inline("rows"))

    def turns(self) -> DataFrame:
        """``conv_id, part, nth, place, edit, role, text`` of all rows kept, re-roled or inserted; the four in the middle
        give their order. Texts come by a join that adaptive execution can split."""
        texts = self.rows.filter("n > 0").select(
            "conv_id", "turn", F.col("role").alias("old_role"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha"),
            "text").dropDuplicates(["conv_id", "turn", "old_role", "text_sha"])
        left, t = self._left().alias("l"), texts.alias("t")
        same = (F.col("l.text_sha") == F.col("t.text_sha")) & (F.col("l.old_role") == F.col("t.old_role")) & F.col(
            "l.conv_id").eqNullSafe(F.col("t.conv_id")) & F.col("l.turn").eqNullSafe(F.col("t.turn"))
        return left.join(t, same, "left").select(
            "l.conv_id", "l.part", "l.nth", "l.place", "l.edit", "l.role", F.coalesce("t.text", F.lit("")).alias("text"))

    def digests(self) -> DataFrame:
        """``conv_id, sha256`` of each repaired conversation's ``role:text`` lines.

        A hash of a whole conversation has to see its rows in order; they pass through a running hash one by
        one, so the task holds a batch, however long the conversation.
        """
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            conv, running = None, None
            for batch in batches:
                ids, shas = [], []
                for owner, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 4, 5)), strict=True):
                    if conv is None or conv[0] != owner:
                        if conv is not None:
                            ids.append(conv[0])
                            shas.append(running.hexdigest())
                        conv, running = (owner,), hashlib.sha256()
                    else:
                        running.update(b"\n")
                    running.update(f"{role}:{text}".encode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shas, pa.string())], ["conv_id", "sha256"])
            if conv is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv[0]], pa.int64()), pa.array([running.hexdigest()])], ["conv_id", "sha256"])

        ordered = self.turns().select("conv_id", "part", "nth", "place", "role", "text").repartition(
            "conv_id").sortWithinPartitions("conv_id", "part", "nth", "place")
        return ordered.mapInArrow(run, "conv_id long, sha256 string")


def repair(conversations: DataFrame, block: int = BLOCK) -> Repair:
    """Reports and repaired turns of ``conversations(conv_id, turn, role, text)``, with an optional count ``n`` of equal rows.

    Rows are taken by turn, nulls first, then role and the SHA-256 of the text. The first fault of a row counts: blank,
    repeated (role and text are in an earlier row) or truncated (the last character that is not white space is none of
    ``.!?``). The cheapest edits make the roles a conversation of the form ``(s?(ua)+)?``: keep (0), re-role (2), delete (3,
    always for blank and repeated rows), insert an empty row (2), and 1 for each truncated row that stays. Of equally
    cheap ones the ASCII-least string of D, I, K, R is taken.

    ``reports`` has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation, also of one whose
    rows all have ``n`` 0 (zeros, empty audit). Null roles and texts count as one space, a null conv_id is a conversation,
    an empty role fits nothing. Equal rows after the first are repeated ones. An empty table gives an empty result; very
    long texts are read once and known by their hash; columns with other names do not matter.

    Conversations are cut into blocks of about the square root of the longest one's rows. Rows are sorted over
    the whole table by ranges, so a conversation that is a third of it is spread over a third of the tasks.
    """
    saved = Saved(conversations.sparkSession, "conversations")
    rows = prepared(conversations)
    marks = saved(faults(rows), "marks")
    longest = marks.groupBy("conv_id").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    size = max(block, isqrt(longest))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text_sha", "chunk")]
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))
    dealt = marks.withColumn("chunk", chunks).select(
        "conv_id", "turn", "role", "text_sha", F.least(F.col("n") - F.col("chunk") * COPIES, F.lit(COPIES)).alias("n"), "blank",
        (F.col("repeated") | (F.col("chunk") > 0)).alias("repeated"), "truncated", "chunk")
    ranged = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = saved(ranged.mapInArrow(_blocks(size), _BLOCKS), "blocks")

    several = blocks.groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("long_id"))
    long_blocks = saved(blocks.join(several, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi"), "long")
    after = F.array(*(F.lit(c).cast("long") for c in _ROW_END))
    columns = ["conv_id", "part", "nth", "codes", "after", "last", "state", "turns", "roles", "shas"]
    alone = {"after": after, "last": F.lit(True), "state": F.lit(_START)}
    if long_blocks.isEmpty():
        placed = blocks.withColumns(alone).select(*columns)
    else:
        scans = saved(_scans(long_blocks), "scans")
        b, s = blocks.alias("b"), scans.alias("s")
        met = b.join(s, F.col("b.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("b.part") == F.col("s.part")) & (
            F.col("b.nth") == F.col("s.nth")), "left")
        placed = met.select("b.conv_id", "b.part", "b.nth", "b.codes", *(
            F.coalesce(F.col(f"s.{name}"), value).alias(name) for name, value in alone.items()),
            "b.turns", "b.roles", "b.shas").select(*columns)
    edits = saved(placed.mapInArrow(
        _edits, "conv_id long, part int, nth int, edits string, cost long, rows array<struct<place:long,edit:string,"
        "role:string,turn:long,old_role:string,text_sha:string>>"), "edits")

    by = Window.partitionBy("conv_id").orderBy("part", "nth")
    joint = F.concat(F.lag("tail").over(by), F.col("head"))
    between = (F.lag("tail").over(by).isNotNull() & ~joint.isin("su", "ua", "au")).cast("long")
    illegal = blocks.select("conv_id", "part", "nth", "head", "tail", "illegal").withColumn(
        "illegal", F.col("illegal") + between).groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    turns = marks.groupBy("conv_id", "turn").agg(*(F.sum(c).alias(name) for name, c in _counted().items()))
    counted = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(name).alias(name) for name in _counted()))
    told = edits.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "nth", "edits"))), lambda e: e.edits), "").alias(
            "audit"))
    # Every conversation, also one without rows, and what is known of it, added up in one grouping.
    together = rows.select("conv_id").distinct()
    for found in (counted, illegal, told):
        together = together.unionByName(found, allowMissingColumns=True)
    zero = {c: F.coalesce(F.sum(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    reports = together.groupBy("conv_id").agg(*zero.values(), F.coalesce(F.max("audit"), F.lit("")).alias("audit"))
    return Repair(rows, reports, edits)


def _counted() -> dict[str, Column]:
    """Rows by first fault; of ``n`` equal rows that are not blank all but the first are repeated."""
    n, none = F.col("n"), F.lit(0).cast("long")
    return {"blank": F.when(F.col("blank"), n).otherwise(none),
            "duplicate": F.when(F.col("blank"), none).when(F.col("repeated"), n).otherwise(n - 1),
            "truncated": (F.col("truncated") & ~F.col("repeated")).cast("long")}
