"""Repair of conversations by generalised LR parsing over the grammar of their roles.

    conversation -> (nothing) | pairs | s pairs        pairs -> u a | pairs u a

(s, u, a: the initials of system, user and assistant.)  A conversation is read row by row with a
graph-structured stack.  Under this grammar a stack holds at most ``s pairs u``, and what may be
shifted depends on its top alone, so stacks with equal tops merge into one node, which keeps the link
with the least (cost, audit): rows are kept, re-roled or deleted, and empty turns are inserted, each
at its price.  How the nodes of one row follow from those of the row before depends only on their
relative costs and order, a small number of cases that are worked out once.

Conversations of usual size are repaired whole, each within one task.  A longer one is cut: its rows
are sorted over many tasks, each of which reads its run from every possible top, and the runs are
joined in order."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import ordered_totals, read_table, save

#: a longer conversation is cut over many tasks
MAX_ROWS = 2_000
MAX_BYTES = 4 << 20
#: rows that one run of a long conversation spans
RUN_ROWS = 50_000

BLANKS = " \t\n\x0b\x0c\r"
#: fixed values: the price of each action, and what a truncated row that stays adds
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: fixed values: the top of the stack after an initial is shifted and what is complete is reduced
#: (``0`` nothing yet, ``s`` the system row, ``u`` an open pair, ``B`` pairs), and the tops that may end
SHIFT = {"0": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "B"}, "B": {"u": "u"}}
TOPS, ENDS = "0suB", "0B"
ROLES = {"u": "user", "a": "assistant"}


def expected(top: str) -> str:
    """The initial that an inserted or re-roled row takes."""
    return "u" if "u" in SHIFT[top] else "a"


def inserted(top: str):
    """(top, cost, audit) after no, one or two inserted rows; more would come back to a top."""
    yield top, 0, ""
    for n in (1, 2):
        top = SHIFT[top][expected(top)]
        yield top, n * INSERT, "I" * n


def moves(kind: tuple[str, bool, bool]) -> dict[str, dict[str, tuple[int, str]]]:
    """From each top to each that one row can lead to, the least (cost, audit).  ``kind``: the row's
    initial, whether it is truncated, and whether it has to go."""
    initial, truncated, must_go = kind
    stay = TRUNCATED if truncated else 0
    out: dict[str, dict[str, tuple[int, str]]] = {}
    for start in TOPS:
        best: dict[str, tuple[int, str]] = {}
        for top, cost, audit in inserted(start):
            steps = [(top, DELETE, "D")]
            if not must_go:
                steps += [(SHIFT[top][expected(top)], REROLE + stay, "R")]
                steps += [(SHIFT[top][initial], KEEP + stay, "K")] if initial in SHIFT[top] else []
            for end, price, letter in steps:
                best[end] = min(best.get(end, (1 << 60, "")), (cost + price, audit + letter))
        out[start] = best
    return out


class Stack:
    """The graph-structured stack.  A frontier is a tuple of (top, relative cost, rank) per live node;
    ``rank`` orders the audits of its nodes.  All audits of a frontier end with the letter of the same
    row, so none begins another, and the order of two longer ones is that of their first difference."""

    def __init__(self):
        self.moves: dict = {}
        self.steps: dict = {}

    def step(self, frontier: tuple, kind: tuple[str, bool, bool]):
        key = frontier, kind
        if key not in self.steps:
            table = self.moves.setdefault(kind, moves(kind))
            best: dict[str, tuple] = {}
            for top, cost, rank in frontier:
                for end, (price, audit) in table[top].items():
                    link = cost + price, rank, audit, top
                    best[end] = min(best.get(end, link), link)
            low = min(link[0] for link in best.values())
            order = sorted(best, key=lambda end: best[end][1:3])
            after = tuple((end, best[end][0] - low, order.index(end)) for end in sorted(best))
            self.steps[key] = after, low, {end: (link[3], link[2]) for end, link in best.items()}
        return self.steps[key]

    def read(self, kinds: list[tuple[str, bool, bool]], start: str) -> dict[str, tuple[int, str]]:
        """The least (cost, audit) from top ``start`` to each top that the rows can lead to."""
        frontier, total, links = ((start, 0, 0),), 0, []
        for kind in kinds:
            frontier, low, link = self.step(frontier, kind)
            total += low
            links.append(link)
        out = {}
        for top, cost, _ in frontier:
            letters, at = [], top
            for link in reversed(links):
                at, audit = link[at]
                letters.append(audit)
            out[top] = total + cost, "".join(reversed(letters))
        return out


def finish(tops: dict[str, tuple[int, str]]) -> tuple[int, str]:
    """The least (cost, audit) that ends the conversation."""
    return min((cost + price, audit + more) for top, (cost, audit) in tops.items()
               for end, price, more in inserted(top) if end in ENDS)


class Applied:
    """Applies an audit to the rows, one after the other."""

    def __init__(self, audit: str):
        self.audit, self.at, self.top = audit, 0, "0"

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.at = expected(self.top), self.at + 1
            self.top = SHIFT[self.top][role]
            yield ROLES[role], ""

    def row(self, role: str, text: str):
        yield from self.inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter != "D":
            initial = role[:1] if letter == "K" else expected(self.top)
            self.top = SHIFT[self.top][initial]
            yield (role if letter == "K" else ROLES[initial]), text


def last_mark(text: str) -> str:
    return text.rstrip(BLANKS)[-1:]


#: counts of a run of rows, in order: see :func:`count_run`
COUNTS = "n_rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, n_turns long"


def count_run(initials: list[str], faults: list[str], turns: list) -> tuple:
    """Rows, faults, adjacent initials that may not meet, end initials, and the turns' ends and number."""
    known = [t for t in turns if t is not None]            # in ascending order
    return (len(initials), faults.count("b"), faults.count("d"), faults.count("t"),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
            initials[0] if initials else None, initials[-1] if initials else None,
            known[0] if known else None, known[-1] if known else None,
            sum(1 for _ in groupby(known)))


def add_runs(a: tuple, b: tuple) -> tuple:
    """Counts of a run and the one that follows it."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    meet = int((a[6] or "") + (b[5] or "") not in ("su", "ua", "au"))
    same = int(a[8] is not None and a[8] == b[7])
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3], a[4] + b[4] + meet, a[5], b[6],
            b[7] if a[7] is None else a[7], a[8] if b[8] is None else b[8], a[9] + b[9] - same)


def gaps(counts: tuple) -> int:
    """Turns missing between the first and the last, as a signed 64-bit integer."""
    low, high, n = counts[7:]
    return 0 if low is None else (high - low + 1 - n + (1 << 63)) % (1 << 64) - (1 << 63)


def kind_of(role: str, fault: str) -> tuple[str, bool, bool]:
    return role[:1], fault == "t", fault in ("b", "d")


def _summary_schema(conv_type: T.DataType) -> T.StructType:
    return (T.StructType([T.StructField("conv_id", conv_type)])
            .add("gaps", "long").add("blank", "long").add("duplicate", "long").add("truncated", "long")
            .add("illegal", "long").add("cost", "long").add("audit", "string"))


@dataclass
class Repaired:
    """``whole``: one row per conversation of usual size, with its turns as an array;
    ``long_ones``: one row per long conversation; ``long_turns``: their turns, (conv_id, position, role,
    text), each conversation's in order within one partition.  The last two are None without long ones."""

    whole: DataFrame
    long_ones: DataFrame | None
    long_turns: DataFrame | None

    def summaries(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
        whole = self.whole.drop("turns")
        return whole if self.long_ones is None else whole.unionByName(self.long_ones)

    def turns(self) -> DataFrame:
        """(conv_id, position, role, text) of every repaired conversation."""
        whole = self.whole.select("conv_id", F.posexplode("turns").alias("position", "t")).select(
            "conv_id", F.col("position").cast("long").alias("position"), "t.role", "t.text")
        return whole if self.long_turns is None else whole.unionByName(self.long_turns)

    def digests(self) -> DataFrame:
        """:meth:`summaries` with ``repaired_sha256``: SHA-256 of the turns as ``role:text`` lines."""
        lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
        whole = self.whole.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("turns")
        if self.long_ones is None:
            return whole
        schema = T.StructType([self.long_turns.schema["conv_id"]]).add("repaired_sha256", "string")

        def digest(batches):
            conv, state, none = None, None, True
            for b in batches:
                for c, position, role, text in zip(*(col.to_pylist() for col in b.columns)):
                    if none or position == 0:
                        if not none:
                            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema=_arrow(schema))
                        conv, state, none = c, hashlib.sha256(), False
                    state.update((("\n" if position else "") + f"{role}:{text}").encode())
            if not none:
                yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema=_arrow(schema))

        found = self.long_turns.mapInArrow(digest, schema).withColumnRenamed("conv_id", "__conv")
        empty = hashlib.sha256().hexdigest()
        longs = self.long_ones.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
        return whole.unionByName(longs.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty))))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def repair_conversations(rows: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, run_rows: int = RUN_ROWS) -> Repaired:
    """Repair (conv_id, turn, role, text) rows; with a boolean column ``live``, rows where it is not
    true only announce their conversation, which may thus be empty.

    Rows are taken by turn, nulls first, and within a turn by role and text (equal rows are
    interchangeable).  A null role or text is one space, an empty role cannot be kept; rows of a null
    conv_id are one conversation.
    Each row's first fault counts: blank (white space only), duplicate (role and text seen earlier),
    truncated (its last mark does not end a sentence).  The edits are those of the least (cost,
    audit); see the module's text.  An empty table gives empty results; other columns are not read,
    and may have any names.

    Memory: a task holds one conversation of up to ``max_rows`` rows and ``max_bytes`` of text, or
    ``run_rows`` rows without text.  For a longer conversation one task joins the audits of its runs
    (a letter per row: its part of the result), and one streams its turns (as SHA-256 must)."""
    live = F.col("live") if "live" in rows.columns else F.lit(True)
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce(live, F.lit(False)).alias("live"))
    sizes = base.where("live").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
    longs = save(sizes.where((F.col("n") > max_rows) | (F.col("b") > max_bytes)).select(F.col("conv_id").alias("__conv")), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("__conv"))
    if longs.isEmpty():
        return Repaired(_whole(base), None, None)
    summary, turns = _cut(base.join(longs, same, "left_semi").where("live"), run_rows)
    return Repaired(_whole(base.join(longs, same, "left_anti")), summary, turns)


def _whole(rows: DataFrame) -> DataFrame:
    """Conversations that fit a task, each repaired at once."""
    schema = _summary_schema(rows.schema["conv_id"].dataType).add("turns", T.ArrayType(T.StructType().add("role", "string").add("text", "string")))

    def repair(batches):
        stack, arrow = Stack(), _arrow(schema)

        def one(conv, held):
            seen, initials, faults, kinds = set(), [], [], []
            for _, role, text in held:
                fault = ""
                if not text.strip(BLANKS):
                    fault = "b"
                elif (role, text) in seen:
                    fault = "d"
                elif last_mark(text) not in ".!?":
                    fault = "t"
                seen.add((role, text))
                initials.append(role[:1])
                faults.append(fault)
                kinds.append(kind_of(role, fault))
            counts = count_run(initials, faults, [r[0] for r in held])
            cost, audit = finish(stack.read(kinds, "0"))
            applied, turns = Applied(audit), []
            for _, role, text in held:
                turns += applied.row(role, text)
            turns += applied.inserts()
            return {"conv_id": conv, "gaps": gaps(counts), "blank": counts[1], "duplicate": counts[2], "truncated": counts[3],
                    "illegal": counts[4], "cost": cost, "audit": audit, "turns": [{"role": r, "text": t} for r, t in turns]}

        done, held, current, none, weight = [], [], None, True, 0
        for b in batches:
            for conv, turn, role, text, live in zip(*(c.to_pylist() for c in b.columns)):
                if none or conv != current:
                    if not none:
                        done.append(one(current, held))
                        if weight > MAX_BYTES:
                            yield pa.RecordBatch.from_pylist(done, schema=arrow)
                            done, weight = [], 0
                    current, held, none = conv, [], False
                if live:
                    held.append((turn, role, text))
                    weight += len(text)
        if not none:
            yield pa.RecordBatch.from_pylist([*done, one(current, held)], schema=arrow)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(repair, schema)


def _cut(rows: DataFrame, run_rows: int) -> tuple[DataFrame, DataFrame]:
    """Summaries and turns of conversations that are cut into runs over many tasks."""
    conv_field = T.StructField("conv_id", rows.schema["conv_id"].dataType)
    numbered = save(ordered_totals(rows.select("conv_id", "turn", "role", "text"), ["conv_id", "turn", "role", "text"], [], "turns"), "turns")
    text, blanks = F.col("text"), F.lit(BLANKS)
    slim = numbered.select("conv_id", "__row_no", "turn", "role", F.md5("text").alias("digest"), (F.trim(text, blanks) == "").alias("blank"),
                           F.substring(F.rtrim(text, blanks), -1, 1).alias("mark"))
    first = (slim.groupBy("conv_id", "role", "digest").agg(F.min("__row_no").alias("first_no"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("__conv"), F.col("role").alias("__role"), F.col("digest").alias("__digest"), "first_no"))
    fault = (F.when(F.col("blank"), "b").when(F.col("__row_no") > F.coalesce("first_no", F.col("__row_no")), "d")
             .when(~F.col("mark").isin(".", "!", "?"), "t").otherwise(""))
    marked = slim.join(first, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest")), "left")
    runs_schema = T.StructType([conv_field]).add("run_no", "long").add("start", "string").add("end", "string").add("cost", "long").add("audit", "string")
    for name, kind in (c.strip().split() for c in COUNTS.split(",")):
        runs_schema = runs_schema.add(name, kind)

    def read(batches):
        stack, arrow = Stack(), _arrow(runs_schema)

        def run(conv, number, held):
            kinds = [kind_of(role, f) for _, role, f in held]
            counts = count_run([r[:1] for _, r, _ in held], [f for _, _, f in held], [t for t, _, _ in held])
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*[
                (conv, number, start, end, cost, audit, *counts)
                for start in TOPS for end, (cost, audit) in stack.read(kinds, start).items()]), arrow)], schema=arrow)

        held, current, number = [], None, None
        for b in batches:
            for conv, no, turn, role, f in zip(*(c.to_pylist() for c in b.columns)):
                if held and (conv != current or len(held) >= run_rows):
                    yield run(current, number, held)
                    held = []
                if not held:
                    current, number = conv, no
                held.append((turn, role, f))
        if held:
            yield run(current, number, held)

    runs = (marked.select("conv_id", "__row_no", "turn", "role", fault.alias("fault"))
            .repartitionByRange("__row_no").sortWithinPartitions("__row_no").mapInArrow(read, runs_schema))
    schema = _summary_schema(conv_field.dataType)

    def join(table: pa.Table) -> pa.Table:
        tops, counts = {"0": (0, "")}, (0,) * 5 + (None,) * 4 + (0,)
        for _, group in groupby(sorted(table.to_pylist(), key=lambda r: r["run_no"]), key=lambda r: r["run_no"]):
            group = list(group)
            ends: dict[str, list] = {}
            for r in group:
                if r["start"] in tops:
                    cost, audit = tops[r["start"]]
                    ends.setdefault(r["end"], []).append((cost + r["cost"], audit + r["audit"]))
            tops = {end: min(found) for end, found in ends.items()}
            counts = add_runs(counts, tuple(group[0][c.split()[0]] for c in COUNTS.split(", ")))
        cost, audit = finish(tops)
        return pa.Table.from_pylist([{"conv_id": table.column("conv_id")[0].as_py(), "gaps": gaps(counts), "blank": counts[1], "duplicate": counts[2],
                                      "truncated": counts[3], "illegal": counts[4], "cost": cost, "audit": audit}], schema=_arrow(schema))

    summary = save(runs.groupBy("conv_id").applyInArrow(join, schema), "long-summaries")
    stream = (numbered.select("conv_id", "__row_no", "role", "text")
              .unionByName(summary.select("conv_id", F.lit(-1).cast("long").alias("__row_no"), F.lit("").alias("role"), F.col("audit").alias("text")))
              .repartition("conv_id").sortWithinPartitions("conv_id", "__row_no"))
    turns_schema = T.StructType([conv_field]).add("position", "long").add("role", "string").add("text", "string")

    def apply(batches):
        arrow, applied, conv, position = _arrow(turns_schema), None, None, 0
        for b in batches:
            out = []
            for c, no, role, text in zip(*(col.to_pylist() for col in b.columns)):
                turns = applied.row(role, text) if no >= 0 else applied.inserts() if applied else ()
                for r, t in turns:
                    out.append((conv, position, r, t))
                    position += 1
                if no < 0:
                    applied, conv, position = Applied(text), c, 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)
        tail = list(applied.inserts()) if applied else []
        if tail:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "position": position + i, "role": r, "text": t} for i, (r, t) in enumerate(tail)], schema=arrow)

    return summary, stream.mapInArrow(apply, turns_schema)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): each row damaged as crc32 of ``conv_id:turn`` modulo 20 says.
    0 drops it (``live`` false), 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes its
    role user.  Nulls are one space, in the key as well."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case: Column = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (conversations.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), case.alias("case"))
            .select("conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    (F.col("case") != 0).alias("live"), F.explode(F.sequence(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(read_table(spark, sf_dir, "conversations"))).digests()
