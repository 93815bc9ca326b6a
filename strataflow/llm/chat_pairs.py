"""Operator 1: preference pairs: shared prompt once, two masked completions.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (equal role and text) is rendered
once as the prompt; the turns after it are each side's completion, rendered with its loss spans: character ranges of the
completion that an assistant turn's text and end mark cover. Everything else is masked.

Turns are ordered by turn number, then role and text; exact repeats of a turn count once; turns without a number come
first. Null roles and texts are rendered as empty strings. Equal conversations give empty completions; a pair of which
a side has no turns is left out. Rows of a null conv_id take no part. Other columns are left out. An empty table gives
no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN = "concat('<|', x.role, '|>\\n', x.text, '<|end|>\\n')"
SIDE = ["pair_id", "is_chosen"]


def rejections(turns: DataFrame) -> DataFrame:
    """Turns of pairs made from plain conversations (pair_id, is_chosen, conv_id, turn, role, text): chosen is each
    conversation that has an assistant turn; rejected is its copy with the last of these (of equal numbers, the one of
    greatest text) answered by the last assistant text of conversation `conv_id xor 1` instead, which is then the
    rejected one's conv_id; an empty text if that has none."""
    own = turns.selectExpr("cast(conv_id as long) conv_id", "turn", "coalesce(role, '') role", "coalesce(text, '') text").where("conv_id is not null")
    last = own.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("x"))
    donor = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("x.text").alias("other"))
    both = own.join(last.join(donor, "conv_id", "left"), "conv_id")
    swap = "role = 'assistant' and turn <=> x.turn and text = x.text"
    sides = F.expr(f"array(named_struct('is_chosen', true, 'conv_id', conv_id, 'text', text), named_struct('is_chosen', false, 'conv_id', conv_id ^ 1, 'text', case when {swap} then coalesce(other, '') else text end))")
    return both.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")).select("pair_id", "s.is_chosen", "s.conv_id", "turn", "role", "s.text")


def preference_pairs(turns: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected, chosen_loss, rejected_loss.

    pairs: (conv_id, pair_id, is_chosen), joined to the turns. Without it, turns have pair_id and is_chosen themselves,
    as those of rejections().
    """
    told = turns.drop("pair_id", "is_chosen").join(pairs.select("conv_id", "pair_id", "is_chosen"), "conv_id") if pairs is not None else turns
    own = told.where("conv_id is not null and pair_id is not null and is_chosen is not null").selectExpr("cast(pair_id as long) pair_id", "is_chosen", "cast(conv_id as long) conv_id", "turn", "coalesce(role, '') role", "coalesce(text, '') text")
    # One shuffle for all that follows; a group is the turns of two conversations, whatever the number of pairs.
    own = own.repartition("pair_id").dropDuplicates([*SIDE, "turn", "role", "text"])
    run = Window.partitionBy(*SIDE).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumn("upto", F.sum(F.length("role") + F.length("text") + 13).over(run).cast("int"))
    item = F.struct("turn", "role", "text", "upto")
    side = lambda chosen: F.sort_array(F.collect_list(F.when(F.col("is_chosen") == chosen, item)))
    who = lambda chosen: F.min(F.when(F.col("is_chosen") == chosen, F.col("conv_id")))
    both = own.groupBy("pair_id").agg(who(True).alias("chosen_id"), who(False).alias("rejected_id"), side(True).alias("a"), side(False).alias("b")).where("size(a) > 0 and size(b) > 0")
    both = both.withColumn("differ", F.expr("transform(sequence(0, least(size(a), size(b)) - 1), i -> a[i].role != b[i].role or a[i].text != b[i].text)"))
    both = both.withColumn("k", F.expr("case when exists(differ, x -> x) then cast(array_position(differ, true) as int) - 1 else size(differ) end"))
    both = both.withColumn("cut", F.expr("case when k = 0 then 0 else a[k - 1].upto end"))
    render = lambda s: f"array_join(transform({s}, x -> {TURN}), '')"
    rest = lambda s: f"slice({s}, k + 1, size({s}))"
    # A turn's text ends eight characters and a line feed before its end; the loss takes in the end mark.
    spans = lambda s: f"transform(filter({rest(s)}, x -> x.role = 'assistant'), x -> named_struct('start', x.upto - cut - length(x.text) - 8, 'stop', x.upto - cut - 1))"
    return both.selectExpr("pair_id", "chosen_id", "rejected_id", "k as n_prompt_turns", f"{render('slice(a, 1, k)')} as prompt", f"{render(rest('a'))} as chosen", f"{render(rest('b'))} as rejected", f"{spans('a')} as chosen_loss", f"{spans('b')} as rejected_loss")


def span_text(c: str) -> str:
    """SQL: spans as `start-stop,start-stop`."""
    return f"array_join(transform({c}, s -> concat(s.start, '-', s.stop)), ',')"


ORACLE = """
with own as (select cast(conv_id as bigint) conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
last as (select * from (select *, row_number() over (partition by conv_id order by turn desc nulls last, text desc) as seq from own where role = 'assistant') where seq = 1),
met as (select o.*, l.turn as l_turn, l.text as l_text, d.text as other from own o join last l using (conv_id) left join last d on d.conv_id = xor(o.conv_id, 1)),
sides as (
  select distinct conv_id as pair_id, 'c' as side, turn, role, text from met union
  select distinct conv_id, 'r', turn, role, case when role = 'assistant' and turn is not distinct from l_turn and text = l_text then coalesce(other, '') else text end from met),
told as (
  select *, row_number() over w as i, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as shown, sum(length(role) + length(text) + 13) over w as upto
  from sides window w as (partition by pair_id, side order by turn nulls first, role, text)),
heads as (
  select pair_id, coalesce(min(i) filter (where c.role is distinct from r.role or c.text is distinct from r.text) - 1, count(*)) as k
  from (select * from told where side = 'c') c full join (select * from told where side = 'r') r using (pair_id, i) group by pair_id),
cuts as (select h.*, coalesce((select upto from told t where t.pair_id = h.pair_id and side = 'c' and i = k), 0) as cut from heads h)
select pair_id, pair_id as chosen_id, xor(pair_id, 1) as rejected_id, cast(k as integer) as n_prompt_turns,
  coalesce(string_agg(shown, '' order by i) filter (where side = 'c' and i <= k), '') as prompt,
  coalesce(string_agg(shown, '' order by i) filter (where side = 'c' and i > k), '') as chosen,
  coalesce(string_agg(shown, '' order by i) filter (where side = 'r' and i > k), '') as rejected,
  coalesce(string_agg((upto - cut - length(text) - 8)::bigint || '-' || (upto - cut - 1)::bigint, ',' order by i) filter (where side = 'c' and i > k and role = 'assistant'), '') as chosen_loss,
  coalesce(string_agg((upto - cut - length(text) - 8)::bigint || '-' || (upto - cut - 1)::bigint, ',' order by i) filter (where side = 'r' and i > k and role = 'assistant'), '') as rejected_loss
from told join cuts using (pair_id) group by pair_id, k
"""
