r"""Operator 13: repair of conversations, by iterative-deepening A*.

A row's first fault counts: blank (no character outside space and 0x09-0x0D), duplicate (role and text seen earlier in
the conversation), truncated (its last such character is none of `.!?`). The repaired conversation's role initials must
read `(s?(ua)+)?`. Edits, by the initials of the audit: Delete 3, required for blank and duplicate rows; Insert an empty
user or assistant turn 2; Keep 0; Rerole to user or assistant 2; a truncated row that is not deleted adds 1. The answer
is the cheapest edit string, of equal ones the ASCII-least.

The search goes depth first in the order D, I, K, R under a cost bound that rises from the heuristic's value by one. What
failed is remembered as (row, grammar state) with the largest budget that did not suffice, over all bounds, so each is
entered again only with more to spend; the first accepting path is the answer. The heuristic is the cheapest repair of
each block of BLOCK rows for itself, whatever the states at its borders, hence never too high.

Two passes over rows sorted by conversation: the search needs a row's role, digest and fault, no text; then the audit
comes before its rows in the stream, and the repaired rows leave one by one, hashed or as rows, with no text held. One
conversation is one task's, at some bytes a row in the search.

Rows are ordered by turn, null first, then role and SHA-256 of the text. Null roles and texts are one space. Rows of a
null conv_id take no part. Other columns are left out. A conversation without rows has zeros, an empty audit and the
hash of an empty string. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.graph import shared_folder
from strataflow.llm.oracles import crc32
from strataflow.sources.sinks import write_once

BLOCK = 256
SPACE = " \t\n\x0b\x0c\r"
#: Grammar states: before all, after s, after u, after a; the turn that each takes next, and where that leads.
WANT, NEXT, ACCEPT = "uuau", (2, 2, 3, 2), (0, 3)
FULL = {"u": "user", "a": "assistant"}
NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
PLAN = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in NUMBERS), ("audit", pa.string())])
HASHED = pa.schema([*PLAN, ("repaired_sha256", pa.string())])
TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

Row = tuple[str, bool, int]  # role initial, must go, 1 if truncated


def edits(row: Row | None, q: int) -> list[tuple[str, int, int, int]]:
    """(letter, rows taken, next state, cost) of every edit in a state, in ASCII order."""
    out = [("I", 0, NEXT[q], 2)]
    if row:
        out.insert(0, ("D", 1, q, 3))
        first, must, cut = row
        if not must:
            if first == WANT[q]:
                out.append(("K", 1, NEXT[q], cut))
            elif q == 0 and first == "s":
                out.append(("K", 1, 1, cut))
            out.append(("R", 1, NEXT[q], 2 + cut))
    return out


def bounds(rows: list[Row]) -> list[int]:
    """For each row, a lower bound on the cost from there: blocks repaired one by one, with free states at both ends."""
    out, after = [0] * (len(rows) + 1), [0, 4, 2, 0]
    for i in range(len(rows) - 1, -1, -1):
        if (i + 1) % BLOCK == 0:
            after = [min(after)] * 4
        now = [min(cost + after[to] for _, taken, to, cost in edits(rows[i], q) if taken) for q in range(4)]
        after = [min(now[q], 2 + now[NEXT[q]], 4 + now[NEXT[NEXT[q]]]) for q in range(4)]
        out[i] = min(after)
    return out


def descend(rows: list[Row], least: list[int], failed: dict[tuple[int, int], int], bound: int) -> str | None:
    """The first accepting path in edit order that costs at most bound."""
    n, letters = len(rows), []
    stack = [(0, 0, bound, iter(edits(rows[0] if rows else None, 0)))]
    if not rows:
        return ""
    while stack:
        i, q, left, moves = stack[-1]
        for letter, taken, to, cost in moves:
            j, rest = i + taken, left - cost
            if least[j] > rest or failed.get((j, to), -1) >= rest:
                continue
            letters.append(letter)
            if j == n and to in ACCEPT:
                return "".join(letters)
            stack.append((j, to, rest, iter(edits(rows[j] if j < n else None, to))))
            break
        else:
            failed[i, q] = left
            stack.pop()
            if letters:
                letters.pop()
    return None


def search(rows: list[Row]) -> tuple[int, str]:
    """Cost and edit letters of the answer."""
    least, failed = bounds(rows), {}
    bound = least[0]
    while (found := descend(rows, least, failed, bound)) is None:
        bound += 1
    return bound, found


class Told:
    """What is kept of a conversation while its rows pass by."""

    def __init__(self, conv_id: int):
        self.conv_id, self.rows, self.seen, self.turns = conv_id, [], set(), []
        self.count, self.illegal, self.last = [0, 0, 0], 0, None

    def add(self, turn: int | None, role: str, sha: bytes, blank: bool, cut: bool) -> None:
        fault = 0 if blank else 1 if (role, sha) in self.seen else 2 if cut else None
        self.seen.add((role, sha))
        if fault is not None:
            self.count[fault] += 1
        first = role[:1]
        self.illegal += self.last is not None and self.last + first not in ("su", "ua", "au")
        self.last = first
        if turn is not None and (not self.turns or self.turns[1] != turn):
            self.turns = [self.turns[0], turn, self.turns[2] + 1] if self.turns else [turn, turn, 1]
        self.rows.append((first, fault in (0, 1), int(fault == 2)))

    def plan(self) -> dict:
        cost, audit = search(self.rows)
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return dict(zip(PLAN.names, (self.conv_id, gaps, *self.count, self.illegal, cost, audit), strict=True))


def plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    told = None
    for b in batches:
        out = []
        for conv_id, turn, role, sha, blank, cut, present in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if told is None or told.conv_id != conv_id:
                if told:
                    out.append(told.plan())
                told = Told(conv_id)
            if present:
                told.add(turn, role, sha, blank, cut)
        yield pa.RecordBatch.from_pylist(out, schema=PLAN)
    if told:
        yield pa.RecordBatch.from_pylist([told.plan()], schema=PLAN)


class Repaired:
    """The repaired turns of one conversation, as its rows pass by."""

    def __init__(self, plan: dict):
        self.plan, self.at, self.q = plan, 0, 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        audit = self.plan["audit"]
        while self.at < len(audit) and audit[self.at] == "I":
            yield FULL[WANT[self.q]], "", "I"
            self.q, self.at = NEXT[self.q], self.at + 1

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.plan["audit"][self.at]
        self.at += 1
        if letter == "K":
            yield role, text, letter
            self.q = 1 if self.q == 0 and role[:1] == "s" else NEXT[self.q]
        elif letter == "R":
            yield FULL[WANT[self.q]], text, letter
            self.q = NEXT[self.q]


def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Repaired | None, list[tuple[str, str, str]]]]:
    """(conversation, its next repaired turns), and (None, []) at the end of each batch."""
    now = None
    for b in batches:
        for plan, role, text in zip(*(b.column(c).to_pylist() for c in ("plan", "role", "text")), strict=True):
            if plan is None:
                yield now, list(now.take(role, text))
                continue
            if now:
                yield now, list(now.inserted())
            now = Repaired(plan)
            yield now, []
        yield None, []
    if now:
        yield now, list(now.inserted())


def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, now, h, any_yet = [], None, None, False
    for conversation, turns in repairs(batches):
        if conversation is None:
            yield pa.RecordBatch.from_pylist(done, schema=HASHED)
            done = []
            continue
        if conversation is not now:
            if now:
                done.append(now.plan | {"repaired_sha256": h.hexdigest()})
            now, h, any_yet = conversation, hashlib.sha256(), False
        for role, text, _ in turns:
            h.update(f"{chr(10) if any_yet else ''}{role}:{text}".encode())
            any_yet = True
    if now:
        done.append(now.plan | {"repaired_sha256": h.hexdigest()})
    yield pa.RecordBatch.from_pylist(done, schema=HASHED)


def as_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place = [], {}
    for conversation, turns in repairs(batches):
        if conversation is None:
            yield pa.RecordBatch.from_pylist(out, schema=TURNS)
            out = []
            continue
        if conversation not in place:
            place = {conversation: 0}
        for role, text, letter in turns:
            out.append({"conv_id": conversation.plan["conv_id"], "position": place[conversation], "role": role, "text": text, "edit": letter})
            place[conversation] += 1
    yield pa.RecordBatch.from_pylist(out, schema=TURNS)


def damaged(turns: DataFrame) -> DataFrame:
    """turns with planted damage, by crc32(`conv_id:turn`) % 20: 0 drops the row (present is false), 1 empties the text,
    2 takes its `.!?` out, 3 repeats the row, 4 makes the role user; nulls are one space."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    own = turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    hit = own.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "fault")
    return hit.withColumn("copy", F.explode(F.expr("sequence(1, if(fault = 3, 2, 1))"))).withColumn("present", F.col("fault") != 0).drop("fault", "copy")


def prepared(turns: DataFrame, present: str | None) -> DataFrame:
    blank = F.lit(" ")
    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.col(present) if present else F.lit(True)).alias("present"))
    return own.withColumn("sha", F.unhex(F.sha2("text", 256)))


def repair_plans(turns: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit per conversation. Rows where the column named by
    present is false only say that their conversation exists."""
    core = F.rtrim("text", F.lit(SPACE))
    own = prepared(turns, present).select("conv_id", "turn", "role", "sha", (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("cut"), "present")
    return own.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "sha").mapInArrow(plans, f"conv_id long, {', '.join(f'{c} long' for c in NUMBERS)}, audit string")


def with_plans(turns: DataFrame, made: DataFrame, present: str | None) -> DataFrame:
    """The rows of each conversation after its plan, in order."""
    rows = prepared(turns, present).where("present").select("conv_id", F.lit(None).cast(made.select(F.struct("*").alias("p")).schema["p"].dataType).alias("plan"), "turn", "role", "sha", "text")
    heads = made.select("conv_id", F.struct("*").alias("plan"), *(F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("sha", "binary"), ("text", "string"))))
    both = heads.unionByName(rows).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("plan").isNull(), F.asc_nulls_first("turn"), "role", "sha").select("plan", "role", "text")


def repair(turns: DataFrame, present: str | None = None) -> DataFrame:
    """The columns of repair_plans() and repaired_sha256, of the repaired `role:text`, joined by line feeds."""
    made = write_once(turns.sparkSession, repair_plans(turns, present), f"{shared_folder(turns.sparkSession)}/repair-{uuid.uuid4().hex}")
    return with_plans(turns, made, present).mapInArrow(hashes, f"conv_id long, {', '.join(f'{c} long' for c in NUMBERS)}, audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, position, role, text, edit: the repaired conversations, turn by turn."""
    made = write_once(turns.sparkSession, repair_plans(turns, present), f"{shared_folder(turns.sparkSession)}/repair-{uuid.uuid4().hex}")
    return with_plans(turns, made, present).mapInArrow(as_turns, "conv_id long, position long, role string, text string, edit string")


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
with recursive own as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32("cast(conv_id as varchar) || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as f
  from conversations where conv_id is not null),
hit as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case when f = 1 then '' when f = 2 then translate(text, '.!?', '') else text end as text, unnest(case when f = 3 then [1, 2] else [1] end)
  from own where f <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i, rtrim(text, {_SPACES}) as core from hit),
judged as (
  select *, case when core = '' then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd' when right(core, 1) not in ('.', '!', '?') then 't' else '' end as fault,
    left(role, 1) as o, lag(left(role, 1)) over (partition by conv_id order by i) as p from placed),
counts as (
  select c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'b') as blank, count(*) filter (where fault = 'd') as duplicate,
    count(*) filter (where fault = 't') as truncated, count(*) filter (where p is not null and p || o not in ('su', 'ua', 'au')) as illegal, coalesce(max(i), 0) as n
  from (select distinct conv_id from own) c left join judged using (conv_id) group by c.conv_id),
ins(q, pre, m, paid) as (values (0, '', 0, 0), (0, 'I', 2, 2), (0, 'II', 3, 4), (1, '', 1, 0), (1, 'I', 2, 2), (1, 'II', 3, 4), (2, '', 2, 0), (2, 'I', 3, 2), (3, '', 3, 0), (3, 'I', 2, 2)),
kinds(e) as (values ('D'), ('K'), ('R')),
walk as (
  select conv_id, 0 as i, 0 as q, 0 as cost, '' as audit, cast(1 as bigint) as seq from counts
  union all
  select conv_id, i, q, cost, audit, seq from (
    select *, row_number() over (partition by conv_id, q order by cost, audit) as seq from (
      select w.conv_id, w.i + 1 as i, w.cost + ins.paid + case e when 'D' then 3 when 'K' then 0 else 2 end + case when e <> 'D' and fault = 't' then 1 else 0 end as cost, w.audit || ins.pre || e as audit,
        case when e = 'D' then m when e = 'K' and m = 0 and o = 's' then 1 when m = 2 then 3 else 2 end as q
      from walk w join judged j on j.conv_id = w.conv_id and j.i = w.i + 1 join ins on ins.q = w.q cross join kinds
      where e = 'D' or (fault not in ('b', 'd') and (e = 'R' or o = case when m = 2 then 'a' else 'u' end or (m = 0 and o = 's')))))
  where seq = 1),
best as (
  select conv_id, cost, audit from (
    select w.conv_id, w.cost + paid as cost, w.audit || pre as audit, row_number() over (partition by w.conv_id order by w.cost + paid, w.audit || pre) as r
    from walk w join counts c on c.conv_id = w.conv_id and w.i = c.n join ins on ins.q = w.q where m in (0, 3)) where r = 1),
letters as (select conv_id, unnest(string_split(audit, '')) as e, generate_subscripts(string_split(audit, ''), 1) as k from best where audit <> ''),
lined as (
  select *, sum(case when e <> 'I' then 1 else 0 end) over w as i, sum(case when e <> 'D' then 1 else 0 end) over w as z from letters window w as (partition by conv_id order by k)),
shown as (
  select l.conv_id, l.e, l.z, j.role, j.text, l.z - max(case when l.z = 1 and l.e = 'K' and j.o = 's' then 1 else 0 end) over (partition by l.conv_id) as z2
  from lined l left join judged j on l.e <> 'I' and j.conv_id = l.conv_id and j.i = l.i where l.e <> 'D'),
texts as (
  select conv_id, string_agg(case when e = 'K' then role when z2 % 2 = 1 then 'user' else 'assistant' end || ':' || case when e = 'I' then '' else text end, chr(10) order by z) as t from shown group by conv_id)
select c.conv_id, gaps, blank, duplicate, truncated, illegal, cast(cost as bigint) as cost, audit, sha256(coalesce(t, '')) as repaired_sha256
from counts c join best using (conv_id) left join texts using (conv_id)
"""
