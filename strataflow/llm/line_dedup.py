"""Operator 7: repeated runs of lines, by a suffix array with prefix doubling; DataFrame functions only.

Every line start is a suffix of its document's sequence of line ids. Doubling ranks suffixes by their first 1, 2, 4, 8...
lines: a round gives each suffix the pair of its own rank and of the rank so many lines further on, sorts the pairs and
ranks them anew. Suffixes of one rank at depth d are an interval of the suffix array whose longest common prefix is d at
least. A suffix alone in its interval has found its longest common prefix and leaves; the others go on, until none is
left, so a round costs what still repeats. In an interval of min_lines lines or more the suffix first in (doc_id, line)
order stays; the others are later copies. Each is deleted at the deepest interval in which it is one, and deletions that
touch are put together to the maximal repeated runs.

Lines are split at line feeds and told apart by two 64-bit hashes whose seeds differ from the first byte on, so that
neither follows from the other; ranks of hashes are in the order of hashes, so the
array's order is not that of the letters, which its intervals don't need. A run may overlap itself. Null texts stay null,
empty ones empty; documents under min_lines lines stay as they are. With long_words, a repeated line of at least so many
words is a run by itself, also where it is a whole document; op7 goes by its SQL, without it. A document is a doc_id with
a text: rows that repeat both are one document and each get its result, other texts of one doc_id are documents of
their own, in the order of their hashes. Rows with a null doc_id are kept unread. Each row gives one row. If all lines
go, text_kept is empty and n_kept is 0. Other columns are left out, but those named in carry, as one struct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.graph import keep

MIN_LINES = 2
#: For callers that take long single lines too: passages of over 50 words.
LONG_WORDS = 51
PLACE = ["doc_id", "t", "pos"]


def line_rows(docs: DataFrame, long_words: int | None) -> DataFrame:
    """(doc_id, t, pos, x, y, long): every line with its two hashes."""
    lines = docs.where("text is not null and doc_id is not null").select("doc_id", "t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "l"))
    long = F.expr(f"length(l) >= {2 * long_words - 1} and size(filter(split(l, r'\\s+'), w -> w != '')) >= {long_words}") if long_words else F.lit(False)
    return lines.select(*PLACE, F.xxhash64("l").alias("x"), F.xxhash64(F.lit(7), "l").alias("y"), long.alias("long"))


def ranked(suffixes: DataFrame, key: list[str]) -> DataFrame:
    """suffixes of which another has the same key, with the key's rank r and the interval's first suffix. The intervals
    are counted with a combine; only they are sorted."""
    first = F.min(F.struct(*PLACE)).alias("first")
    intervals = suffixes.groupBy(*key).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ranks = intervals.orderBy(*key).withColumn("rank", F.monotonically_increasing_id())
    return keep(suffixes.join(ranks, key).select(*PLACE, "long", F.col("rank").alias("r"), "first"))


def depths(min_lines: int) -> list[tuple[int, int]]:
    """(depth, step) of the rounds up to min_lines: doubled, the last step overlapping."""
    out, have = [], 1
    while have < min_lines:
        step = min(have, min_lines - have)
        have += step
        out.append((have, step))
    return out


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None) -> DataFrame:
    """(doc_id, t, pos, size): suffixes that are later copies, with the depth of each interval in which they are."""
    # Ranked twice and shuffled narrow; texts are read once.
    at, depth, out = ranked(keep(line_rows(docs, long_words)), ["x", "y"]), 1, []
    rounds = depths(min_lines)
    while True:
        late = at.where(F.struct(*PLACE) > F.col("first")).select(*PLACE, F.lit(depth).alias("size"), "long")
        if depth >= min_lines:
            out.append(late.drop("long"))
        elif long_words and depth == 1:
            out.append(late.where("long").drop("long"))
        depth, step = rounds.pop(0) if rounds else (2 * depth, depth)
        ahead = Window.partitionBy("doc_id", "t").orderBy("pos").rangeBetween(step, step)
        pairs = at.select(*PLACE, "long", "r", F.first("r").over(ahead).alias("r2")).where("r2 is not null")
        at = ranked(pairs, ["r", "r2"])
        if at.isEmpty():
            break
    if not out:
        return at.select(*PLACE, F.lit(0).alias("size"))
    return reduce(DataFrame.union, out)


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None) -> DataFrame:
    """(doc_id, t, runs): the maximal runs [lo, hi) of lines of each document that are later copies, in order."""
    by = Window.partitionBy("doc_id", "t").orderBy("pos")
    spans = later_copies(docs, min_lines, long_words).groupBy(*PLACE).agg((F.col("pos") + F.max("size")).alias("hi"))
    new = F.col("pos") > F.coalesce(F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    runs = spans.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(by))
    one = runs.groupBy("doc_id", "t", "run").agg(F.min("pos").alias("lo"), F.max("hi").alias("hi"))
    return one.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"))


def kept_lines(text: str, runs: str) -> Column:
    """The lines of text outside its runs: the pieces between one run's end and the next one's start."""
    start = "case when j = 0 then 0 else z.g[j - 1].hi end"
    stop = "case when j = size(z.g) then size(z.l) else z.g[j].lo end"
    pieces = f"flatten(transform(sequence(0, size(z.g)), j -> slice(z.l, 1 + {start}, greatest(0, {stop} - ({start})))))"
    return F.expr(f"transform(array(named_struct('l', split({text}, '\\n', -1), 'g', coalesce({runs}, array()))), z -> {pieces})[0]")


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None, carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_lines, n_kept, text_kept per row, and carried, if carry names columns."""
    rest = [F.struct(*carry).alias("carried")] if carry else []
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"), *rest)
    lines = F.split("text", "\n", -1)
    out = own.join(repeated_runs(own.select("doc_id", "t", "text"), min_lines, long_words), ["doc_id", "t"], "left").withColumn("kept", kept_lines("text", "runs"))
    return out.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"), F.when(F.col("text").isNull(), 0).otherwise(F.size("kept")).cast("long").alias("n_kept"), F.array_join("kept", "\n").alias("text_kept"), *(["carried"] if carry else []))


ORACLE = f"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents where text is not null),
win as (
  select doc_id, pos, line as l1, lead(line) over w as l2, row_number() over (order by doc_id, pos) as seq
  from lines window w as (partition by doc_id order by pos)),
late as (
  select doc_id, pos from (select *, min(seq) over (partition by l1, l2) as head from win where l2 is not null) where seq > head),
gone as (select doc_id, pos from late union select doc_id, pos + {MIN_LINES - 1} from late),
kept as (
  select l.doc_id, count(*) as n_lines, count(*) filter (where g.pos is null) as n_kept,
         coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where g.pos is null), '') as text_kept
  from lines l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos group by l.doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_kept, 0) as n_kept, case when d.text is not null then coalesce(text_kept, '') end as text_kept
from documents d left join kept k on d.doc_id = k.doc_id
"""
