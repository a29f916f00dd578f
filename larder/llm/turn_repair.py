"""Repair of the structure of conversations by iterative-deepening A*.

The rows of a conversation, by turn, are edited until the initials of their
roles read ``(s?(ua)+)?``.  A row may be kept (K), rerole to user or assistant
(R), or be deleted (D); a turn without text may be inserted anywhere (I).  Blank
rows and repetitions must be deleted, truncated rows that stay cost more.  Of
the cheapest repairs the one whose edits are least in ASCII order is taken.

The state of a search is how many rows are done and which role came last.  A
depth-first search tries the edits in ASCII order and turns back where cost and
estimate pass the bound; the bound then grows to the least cost that passed it.
The estimate is what the rows still to come cost each by itself.  A table keeps,
for states that failed, the least cost that was missing, which later passes take
as their estimate.  The first path that ends in an accepting state is the
answer: the bound is its cost, and no cheaper one exists.

A search runs over ``BLOCK`` rows.  A longer conversation is cut into blocks:
from the last block to the first, searches from each of the four roles give the
cost of all that follows; then each block is searched once from where the one
before has ended, with these costs at its end, which gives the same answer.

Conversations of at most ``WHOLE`` rows and ``WHOLE_BYTES`` are grouped, each in one task.  The rows
of longer ones, of which one may hold a third of a table, are numbered without a
global sort and stay in segments: the cost tables of all segments are made side
by side, and only those (sixteen numbers each) are walked in one task per
conversation, back and then forth; the segments are then repaired side by side.
The repaired rows of a conversation are hashed as they stream by in order.

Null roles and texts are one space.  Rows are ordered by turn, role and text,
nulls first.  Rows without conversation id are one conversation.  Initials other
than s, u and a can only be changed or deleted.  A table without rows has no
conversations; a conversation without rows has an empty audit.  Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.numbering import number_rows
from larder.session import pin

#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5

#: What came last: nothing, system, user, assistant; a repair may end after nothing or an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
WHOLE_ENDS = (0, NEVER, NEVER, 0)

#: Kinds of rows are initial + 4 * fault.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, FINE, MUST_GO, CUT = 3, 0, 1, 2

#: Rows of a search, of a conversation that is repaired in one task, and of a segment of a longer one.
BLOCK, WHOLE, SEGMENT = 48, 2048, 1024

#: Bytes of text of a conversation that is repaired in one task.
WHOLE_BYTES = 32 << 20

#: What a text is blank without.
SPACES = " \t\n\x0b\x0c\r"

#: Repairs that a task keeps, as many conversations are alike.
KEPT = 1 << 16


def _after(state: int, initial: int) -> int | None:
    """What comes last if a row with this initial is put after ``state``."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return None if state == USER else USER
    return ASSISTANT if state == USER and initial == 2 else None


def _edits() -> list[list[list[tuple[str, int, int, int]]]]:
    """By state and kind of row: edit, cost, rows it uses and the state after it, in ASCII order of the edits."""
    table = []
    for state in range(4):
        other = ASSISTANT if state == USER else USER
        rows = []
        for kind in range(12):
            initial, fault = kind % 4, kind // 4
            more = TRUNCATED if fault == CUT else 0
            own = [("D", DELETE, 1, state), ("I", INSERT, 0, other)]
            if fault != MUST_GO:
                if (kept := _after(state, initial)) is not None:
                    own.append(("K", KEEP + more, 1, kept))
                if initial != other - 1:
                    own.append(("R", REROLE + more, 1, other))
            rows.append(own)
        table.append(rows)
    return table


EDITS = _edits()


def _least(kind: int) -> int:
    """What a row costs at least."""
    initial, fault = kind % 4, kind // 4
    stays = NEVER if fault == MUST_GO else (TRUNCATED if fault == CUT else 0) + (REROLE if initial == OTHER else 0)
    return min(DELETE, stays)


class Search:
    """Searches over a few rows, whose costs at the end depend on the state there."""

    def __init__(self, kinds: bytes, ends: tuple[int, ...]) -> None:
        self.kinds, self.ends = kinds, ends
        self.rest = [0]
        for kind in reversed(kinds):
            self.rest.append(self.rest[-1] + _least(kind))
        self.rest.reverse()
        # no way leads back to nothing or to a system turn
        self.least_end = [min(ends), min(ends[SYSTEM:]), min(ends[USER:]), min(ends[USER:])]
        self.failed: dict[tuple[int, int], int] = {}

    def _lower(self, at: int, state: int) -> int:
        return self.failed.get((at, state), self.rest[at] + self.least_end[state])

    def _visit(self, at: int, state: int, left: int, path: list[str]) -> int | None:
        """The state at the end of the first accepting path that costs at most ``left``."""
        final = at == len(self.kinds)
        if final and self.ends[state] <= left:
            return state
        if self._lower(at, state) > left:
            return None
        missing = self.ends[state] if final else NEVER
        for edit, cost, used, after in EDITS[state][MUST_GO * 4][1:] if final else EDITS[state][self.kinds[at]]:
            if cost + self._lower(at + used, after) <= left:
                path.append(edit)
                if (found := self._visit(at + used, after, left - cost, path)) is not None:
                    return found
                path.pop()
            missing = min(missing, cost + self._lower(at + used, after))
        self.failed[at, state] = missing
        return None

    def best(self, state: int) -> tuple[int, str, int]:
        """Cost, edits and last state of the answer from ``state``; cost ``NEVER`` if there is none."""
        bound = self._lower(0, state)
        while bound < NEVER:
            path: list[str] = []
            found = self._visit(0, state, bound, path)
            if found is not None:
                return bound, "".join(path), found
            bound = self._lower(0, state)
        return NEVER, "", state


def _blocks(kinds: bytes) -> list[bytes]:
    return [kinds[k : k + BLOCK] for k in range(0, len(kinds), BLOCK)] or [b""]


def costs_before(kinds: bytes, ends: tuple[int, ...]) -> tuple[int, ...]:
    """What rows and all that follows cost from each state, given the costs ``ends`` after them."""
    for block in reversed(_blocks(kinds)):
        search = Search(block, ends)
        ends = tuple(search.best(state)[0] for state in range(4))
    return ends


def repair(kinds: bytes, state: int = START, ends: tuple[int, ...] = WHOLE_ENDS) -> tuple[int, str, int]:
    """Cost, audit and last state of the best repair of rows."""
    blocks = _blocks(kinds)
    after = [ends]
    for block in reversed(blocks[1:]):
        after.append(costs_before(block, after[-1]))
    audit, total = [], None
    for block in blocks:
        cost, edits, state = Search(block, after.pop()).best(state)
        total = cost if total is None else total
        audit.append(edits)
    return total, "".join(audit), state


def segment_costs(kinds: bytes) -> list[int]:
    """By state before and state after the rows: what they cost."""
    tables = [costs_before(kinds, tuple(0 if s == end else NEVER for s in range(4))) for end in range(4)]
    return [min(tables[end][begin], NEVER) for begin in range(4) for end in range(4)]


class Mender:
    """Carries out the edits of an audit on rows as they come."""

    def __init__(self, audit: str, state: int = START) -> None:
        self.audit, self.at, self.state = audit, 0, state

    def _put(self, text: str) -> tuple[str, str]:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user", text

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Turns that are inserted before the next row, or at the end."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put("")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Turns up to and with the next row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _after(self.state, INITIALS[role[0]])
            yield role, text
        elif edit == "R":
            yield self._put(text)


# rows


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` after the damage that the hash of conversation and turn decides."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    luck = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", spaced[2].alias("role"), spaced[3].alias("text"), luck.alias("_luck"))
    text = F.when(F.col("_luck") == 1, "").when(F.col("_luck") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("_luck") == 0, 0).when(F.col("_luck") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(F.col("_luck") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_"),
    ).drop("_")


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def row_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``initial`` and with ``fault``: blank, truncated or null; repetitions are found in order."""
    said = _trimmed(F.col("text"))
    fault = F.when(said == "", "blank").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated")
    return rows.withColumns({"initial": F.left("role", F.lit(1)), "fault": fault})


def _kind(initial: str, fault: str | None) -> int:
    return INITIALS.get(initial, OTHER) + 4 * (CUT if fault == "truncated" else FINE if fault is None else MUST_GO)


#: What is returned per conversation, but for its id.
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

#: The same of a conversation that is repaired in one task, with its repaired turns.
_OWN = (*FIELDS[:7], "turns")
_TYPES = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]
_SCHEMA = ", ".join(f"{name} long" for name in FIELDS[:6]) + ", audit string, turns array<struct<role:string,text:string>>"

_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

#: Hash of a conversation without turns.
EMPTY = hashlib.sha256(b"").hexdigest()

#: No conversation; a missing id is one.
_NONE = object()


def _whole(rows: list[tuple], known: dict[bytes, tuple[int, str, int]]) -> tuple:
    """The result for the rows (turn, role, text, initial, fault) of a conversation in order."""
    seen, kinds, counts = set(), bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text, initial, fault in rows:
        if fault != "blank" and (role, text) in seen:
            fault = "duplicate"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kinds.append(_kind(initial, fault))
    numbers = {row[0] for row in rows if row[0] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum((a[3], b[3]) not in _LEGAL for a, b in zip(rows, rows[1:], strict=False))
    if (key := bytes(kinds)) not in known:
        if len(known) >= KEPT:
            known.clear()
        known[key] = repair(key)
    cost, audit, _ = known[key]
    mender = Mender(audit)
    turns = [turn for row in rows for turn in mender.row(row[1], row[2])] + list(mender.inserted())
    return gaps, *counts.values(), illegal, cost, audit, [{"role": role, "text": text} for role, text in turns]


def _repaired_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation, turn, role and text: the result per conversation, each of at most ``WHOLE`` rows."""
    now, rows, kind, known = _NONE, [], None, {}
    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        columns = [batch.column(c).to_pylist() for c in ("turn", "role", "text", "initial", "fault")]
        for own, *row in zip(batch.column("conv_id").to_pylist(), *columns, strict=True):
            if own != now and now is not _NONE:
                done.append((now, *_whole(rows, known)))
                rows = []
            now = own
            rows.append(row)
        yield _results(done, kind)
    if now is not _NONE:
        yield _results([(now, *_whole(rows, known))], kind)


def _results(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    arrays = [pa.array([r[k] for r in done], t) for k, t in enumerate([kind, *_TYPES])]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_OWN])


def _repaired(rows: DataFrame, whole: int, segment: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Per conversation its result and turns, if it is repaired in one task; results of the others, and their turns in order."""
    given = rows.schema["conv_id"].dataType.simpleString()
    own = row_faults(
        rows.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        )
    )
    sizes = own.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_n"), F.sum(F.octet_length("text")).alias("_bytes"))
    large = pin(sizes.filter((F.col("_n") > whole) | (F.col("_bytes") > WHOLE_BYTES)).select("_conv"))
    of_large = F.col("conv_id").eqNullSafe(F.col("_conv"))
    none = large.isEmpty()
    few = own if none else own.join(large, of_large, "left_anti")
    dealt = few.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    short = dealt.mapInArrow(_repaired_whole, f"conv_id {given}, {_SCHEMA}")
    return (short, None, None) if none else (short, *_repair_long(own.join(large, of_large, "left_semi"), segment))


def repair_conversations(rows: DataFrame, whole: int = WHOLE, segment: int = SEGMENT) -> DataFrame:
    """The faults and the repair of every conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``)."""
    short, long, _ = _repaired(rows, whole, segment)
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    hashed = short.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("turns")
    return hashed if long is None else hashed.unionByName(long)


def repaired_turns(rows: DataFrame, whole: int = WHOLE, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``step`` (in order, gaps between segments), ``role`` and ``text``."""
    short, _, long = _repaired(rows, whole, segment)
    made = short.select("conv_id", F.posexplode("turns").alias("step", "made"))
    made = made.select("conv_id", F.col("step").cast("long").alias("step"), "made.role", "made.text")
    if long is not None:
        step = (F.col("segment") * F.lit(1 << 32) + F.col("step")).alias("step")
        made = made.unionByName(long.select("conv_id", step, "role", "text"))
    return made


# long conversations


def _ascending(name: str) -> Column:
    return F.col(name).asc_nulls_first()


def _segment_kinds(rows: DataFrame, segment: int) -> DataFrame:
    """Numbered rows with their segment and the kind that the search sees; repetitions are rows after the first equal one."""
    digest = F.sha2(F.concat(F.lpad(F.length("role").cast("string"), 10, "0"), "role", "text"), 256)
    marked = rows.withColumn("digest", digest)
    first = marked.groupBy("conv_id", "digest").agg(F.min("place").alias("_first"))
    first = first.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "_first")
    joined = marked.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
    again = (F.col("place") > F.col("_first")) & ~F.col("fault").eqNullSafe("blank")
    fault = F.when(again, "duplicate").otherwise(F.col("fault"))
    code = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in INITIALS.items() for x in pair]), F.col("initial")), F.lit(OTHER))
    bad = F.when(fault == "truncated", CUT).when(fault.isNull(), FINE).otherwise(MUST_GO)
    return joined.select(
        "conv_id", "place", "turn", "role", "text", "initial", fault.alias("fault"), (code + 4 * bad).cast("int").alias("kind"),
        F.floor(F.col("place") / segment).cast("long").alias("segment"),
    )


def _repair_long(rows: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Results and turns of conversations of any length; no task holds more than a segment or the numbers of all segments."""
    given = rows.schema["conv_id"].dataType.simpleString()
    numbered = number_rows(rows, ["conv_id", "turn", "role", "text"], into="place")
    marked = pin(_segment_kinds(numbered, segment))
    kinds = marked.groupBy("conv_id", "segment").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "kind"))), lambda x: x["kind"]).alias("kinds")
    )

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [segment_costs(bytes(k)) for k in batch.column("kinds").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("segment"), batch.column("kinds"), pa.array(tables, pa.list_(pa.int64()))],
                names=["conv_id", "segment", "kinds", "costs"],
            )

    costed = pin(kinds.mapInArrow(cost, f"conv_id {given}, segment long, kinds array<int>, costs array<long>"))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments from the last to the first: the costs of all that follows each."""
        now, ends = _NONE, WHOLE_ENDS
        for batch in batches:
            after = []
            for own, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist(), strict=True):
                if own != now:
                    now, ends = own, WHOLE_ENDS
                after.append(ends)
                ends = tuple(min(min(costs[4 * s + e] + ends[e] for e in range(4)), NEVER) for s in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("segment"), pa.array(after, pa.list_(pa.int64()))],
                names=["conv_id", "segment", "ends"],
            )

    ends = (
        costed.select("conv_id", "segment", "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment"))
        .mapInArrow(back, f"conv_id {given}, segment long, ends array<long>")
    )
    ends = ends.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "ends")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment"))

    def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments side by side: the repair from each of the four states."""
        for batch in batches:
            costs, audits, lasts = [], [], []
            for kinds_, ends_ in zip(batch.column("kinds").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                found = [repair(bytes(kinds_), state, tuple(ends_)) for state in range(4)]
                costs.append([f[0] for f in found])
                audits.append([f[1] for f in found])
                lasts.append([f[2] for f in found])
            arrays = [pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())), pa.array(lasts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("segment"), *arrays], names=["conv_id", "segment", "total", "audits", "lasts"]
            )

    ways = pin(
        costed.select("conv_id", "segment", "kinds")
        .join(ends, same)
        .select("conv_id", "segment", "kinds", "ends")
        .mapInArrow(forth, f"conv_id {given}, segment long, total array<long>, audits array<string>, lasts array<int>")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments from the first to the last: the state that each begins with, and the cost of the whole."""
        now, state = _NONE, START
        for batch in batches:
            begins, totals = [], []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "total", "lasts")]
            for own, total, lasts in zip(*columns, strict=True):
                first = own != now
                if first:
                    now, state = own, START
                totals.append(total[state] if first else None)
                begins.append(state)
                state = lasts[state]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("segment"), pa.array(begins, pa.int32()), pa.array(totals, pa.int64())],
                names=["conv_id", "segment", "state", "cost"],
            )

    walked = pin(
        ways.select("conv_id", "segment", "total", "lasts").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
        .mapInArrow(walk, f"conv_id {given}, segment long, state int, cost long")
    )
    begins = walked.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "state", "cost")
    chosen = ways.join(begins, same).select("conv_id", "segment", "state", "cost", F.col("audits")[F.col("state")].alias("audit"))
    chosen = pin(chosen)
    edits = chosen.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "state", "audit")

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of conversation and place: the repaired turns with their order in the segment."""
        key, mender, count, made, kind = None, Mender(""), 0, [], None

        def out() -> pa.RecordBatch:
            kinds_ = (kind, pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array([m[k] for m in made], t) for k, t in enumerate(kinds_)]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "segment", "step", "role", "text"])

        for batch in batches:
            made, kind = [], batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text", "state", "audit")]
            for *own, role, text, state, audit in zip(*columns, strict=True):
                if own != key:
                    made += [(*key, count + k, *turn) for k, turn in enumerate(mender.inserted())] if key else []
                    key, mender, count = own, Mender(audit, state), 0
                for turn in mender.row(role, text):
                    made.append((*own, count, *turn))
                    count += 1
            yield out()
        made = [(*key, count + k, *turn) for k, turn in enumerate(mender.inserted())] if key else []
        if made:
            yield out()

    made = (
        marked.select("conv_id", "segment", "place", "role", "text")
        .join(edits, same)
        .select("conv_id", "segment", "place", "role", "text", "state", "audit")
        .repartition("conv_id", "segment")
        .sortWithinPartitions("conv_id", "segment", "place")
        .mapInArrow(mend, f"conv_id {given}, segment long, step long, role string, text string")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Turns in order: the hash of each conversation as they stream by."""
        now, sha, kind = _NONE, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], kind), pa.array([sha.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"]
            )

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if own != now:
                    if now is not _NONE:
                        yield out()
                    now, sha = own, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
        if now is not _NONE:
            yield out()

    digests = (
        made.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "step")
        .mapInArrow(hashed, f"conv_id {given}, repaired_sha256 string")
    )
    digests = digests.select(F.col("conv_id").alias("_d"), "repaired_sha256")
    audits = chosen.groupBy(F.col("conv_id").alias("_a")).agg(
        F.max("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    # adjacent initials: within segments, and across their borders by the row before each segment
    ahead = marked.select(F.col("conv_id").alias("_conv"), (F.col("place") + 1).alias("_next"), F.col("initial").alias("_before"))
    beside = marked.join(ahead, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_next")), "left")
    pair = F.concat("_before", F.lit("|"), "initial")
    wrong = F.col("_before").isNotNull() & ~pair.isin("s|u", "u|a", "a|u")
    turns = beside.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")], F.count_if(wrong).alias("illegal")
    )
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal")],
    )
    results = (
        counts.join(audits, F.col("conv_id").eqNullSafe(F.col("_a")))
        .join(digests, F.col("conv_id").eqNullSafe(F.col("_d")), "left")
        .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY)))
        .select("conv_id", *FIELDS)
    )
    return results, made


def repair_damaged(turns: DataFrame) -> DataFrame:
    """The faults and the repair of every conversation after its damage, also of those that lost all rows."""
    found = repair_conversations(damaged(turns))
    given = turns.schema["conv_id"].dataType.simpleString()
    every = turns.select(F.col("conv_id").alias("_all")).distinct()
    joined = every.join(found, F.col("_all").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("_all").cast(given).alias("conv_id"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in FIELDS[:6]],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"),
    )


def oracle() -> str:
    def edit(source: str, letter: str, cost: str, turn: str = "''") -> str:
        return f"CASE WHEN {source} IS NOT NULL THEN {{'c': {source}.c + {cost}, 'a': {source}.a || '{letter}', 't': {source}.t || {turn}}} END"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def only(condition: str, way: str) -> str:
        return f"CASE WHEN {condition} THEN {way} END"

    def insert(source: str, role: str) -> str:
        return edit(source, "I", str(INSERT), f"'{role}:' || chr(10)")

    def stays(source: str, initial: str, role: str) -> list[str]:
        keep = edit(source, "K", f"{KEEP} + more", "role || ':' || text || chr(10)")
        change = edit(source, "R", f"{REROLE} + more", f"'{role}:' || text || chr(10)")
        return [only(f"NOT must_go AND initial = '{initial}'", keep), only(f"NOT must_go AND initial <> '{initial}'", change)]

    state = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    user = best("s2", insert("s0", "user"), insert("s1", "user"), insert("s3", "user"))
    delete = [edit(s, "D", str(DELETE)) for s in ("s0", "s1", "u", "x")]
    kept_system = only("NOT must_go AND initial = 's'", edit("s0", "K", f"{KEEP} + more", "role || ':' || text || chr(10)"))
    spaces = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    return f"""
    WITH RECURSIVE bytes AS (
      SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
      FROM range(256) AS r(i)),
    given AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
    hashed AS (
      SELECT g.*, xor(list_reduce(list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                                  lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 20 AS luck
      FROM given g, bytes),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN luck = 4 THEN 'user' ELSE role END AS role,
             CASE luck WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM hashed, LATERAL (SELECT unnest(range(CASE luck WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again)),
    convs AS MATERIALIZED (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
    places AS (
      SELECT v.c, d.turn, d.role, d.text, left(d.role, 1) AS initial, rtrim(d.text, {spaces}) AS said,
             row_number() OVER (PARTITION BY v.c ORDER BY d.turn NULLS FIRST, d.role, d.text) AS i
      FROM damaged d JOIN convs v ON v.conv_id IS NOT DISTINCT FROM d.conv_id),
    marked AS (
      SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
             lag(initial) OVER (PARTITION BY c ORDER BY i) AS before
      FROM places),
    faults AS MATERIALIZED (
      SELECT *, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate'
                     WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM marked),
    steps AS (
      SELECT *, fault IN ('blank', 'duplicate') AS must_go, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS more FROM faults),
    walk AS (
      SELECT c, 0::BIGINT AS i, CAST({{'c': 0, 'a': '', 't': ''}} AS {state}) AS s0, CAST(NULL AS {state}) AS s1,
             CAST(NULL AS {state}) AS s2, CAST(NULL AS {state}) AS s3
      FROM convs
      UNION ALL
      SELECT c, i, {delete[0]}, {best(delete[1], kept_system)},
             {best(delete[2], *stays("s0", "u", "user"), *stays("s1", "u", "user"), *stays("x", "u", "user"))},
             {best(delete[3], *stays("u", "a", "assistant"))}
      FROM (SELECT c, i, s0, s1, u, {best("s3", insert("u", "assistant"))} AS x, role, text, initial, must_go, more
            FROM (SELECT w.c, r.i, s0, s1, s3, {user} AS u, role, text, initial, must_go, more
                  FROM walk w JOIN steps r ON r.c = w.c AND r.i = w.i + 1))),
    ends AS (
      SELECT c, {best("s0", "s3", insert("u", "assistant"))} AS b
      FROM (SELECT *, {user} AS u FROM walk WHERE i = (SELECT count(*) FROM steps r WHERE r.c = walk.c))),
    counts AS (
      SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM faults GROUP BY c)
    SELECT v.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
           CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
           CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
           sha256(CASE WHEN b.t = '' THEN '' ELSE left(b.t, length(b.t) - 1) END) AS repaired_sha256
    FROM convs v JOIN ends e ON e.c = v.c LEFT JOIN counts n ON n.c = v.c
    """
