"""Operator 4: surrogates for personal data and secrets; DataFrame functions only.

Detected: e-mail addresses, phone numbers, card numbers, US social security numbers, IBANs, IP addresses, access keys,
assigned passwords and tokens, names behind an honorific, and the same full or family names without one in the same document.

An entity is a type and a canonical form, and its surrogate follows from these and a secret key, so every mention, in
any format, gets the same one: digits become digits and letters letters of their case and script, separators stay. Card
numbers and IBANs keep right check digits. A phone number goes by its national digits, its country code stays. Of a mail
address only the last label stays. Names go by their words: the first of several is a given name, with one surrogate of
its gender and script, all others are family names, with one surrogate behind any honorific or none, so `Mr. Stone`, `Mr
Bob Stone` and `Bob Stone` stay one person; particles (von, de la) stay. A given name's gender is that of most honorifics
it stands behind in the corpus; behind `Dr` alone it is drawn. Family names that an honorific tells are replaced
everywhere in their document; a given name alone, and names of documents without an honorific, are not detected. Names
without capitals are not either.

The key is a parameter; without one each run draws its own, so nobody can recompute the surrogates, and two runs differ.

Surrogates of one type are checked over the whole corpus: where two entities meet in one, or one is a real entity, the
later ones (by canonical form) draw again, until none clash. Entities that had to draw again and given names of mixed
honorifics are few; they are joined back by document.

Null texts stay null, empty ones empty, with n_entities 0. Repeated rows give repeated rows; other columns stay out.
A doc_id that is null is treated like any other, but what is joined back is looked up by doc_id and text hash.
"""

from __future__ import annotations

import hashlib
import secrets
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.graph import keep

HONORIFIC_F = r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|госпожа"
HONORIFIC_M = r"Mr|Herr|Monsieur|Señor|Sr|господин"
HONORIFIC = f"{HONORIFIC_F}|{HONORIFIC_M}|Dr|Prof"
ASSIGN = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)(?:[^\w\n=:]{0,4}[=:][^\w\n]{0,5}|\s{1,3}is\s{1,3})"
#: A word of a name, and several with particles between; an initial may have its dot.
WORD = r"\p{Lu}\p{L}*+(?:['’-]\p{L}{2,}+)*+"
GAP = r"[ \t\x{A0}]{1,2}"
PARTICLES = rf"(?:(?:von|van|vom|zu|zur|der|den|de|del|della|di|da|dos|du|la|le|el|al|bin|ibn|ter|y|e){GAP})*+"
ONE = rf"{PARTICLES}(?!(?:{HONORIFIC})(?!\p{{L}})){WORD}"
NAMES = rf"{ONE}(?:(?:(?<=(?<!\p{{L}})\p{{Lu}})\.)?{GAP}{ONE}){{0,6}}+"
#: Country calling codes; all others have three digits.
CODES = r"1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
#: A text without a mark or an honorific cannot hold an entity; plain searches are much cheaper than the pattern.
MARKS = r"[@0-9=:]"
TITLES = HONORIFIC.split("|")
HINTS = ["sk-", "sk_", "ghp", "gho", "xox", "AKIA", *(t for t in TITLES if not any(o != t and o in t for o in TITLES))]
#: One pattern for all; each part starts where a word starts, so no start is tried twice.
PATTERN = "|".join(
    [
        r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
        rf"(?<![\w]){ASSIGN}(?=[A-Za-z_\-]{{0,40}}\d)[A-Za-z0-9_\-]{{8,}}+",
        r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
        r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![\w:])",
        r"(?<![\w:.])::(?=[A-Fa-f:]{0,30}\d)(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4}(?![\w:])",
        r"(?<![\w.-])(?=[A-Fa-f]{0,31}\d)[A-Fa-f0-9]{32,}+(?![\w])",
        r"\bAKIA[0-9A-Z]{16}\b",
        r"\b(?:sk|ghp|gho|xoxb|xoxp)[_-][A-Za-z0-9_-]{16,}+",
        r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
        r"(?<![\w.+-])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
        r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-])",
        r"(?<![\w.+-])\d{3} \d{2} \d{4}(?![\w-]| \d)",
        r"(?<![\w.+-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?!\w)",
        r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)",
        r"(?<![\w.+-])(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)",
        r"(?<![\w.+-])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![\w-]| \d)",
        rf"(?<!\p{{L}})(?:{HONORIFIC})\.?\s{{1,3}}{NAMES}",
    ]
)
# Names are put together from syllables, so that there are as many as a corpus needs; a later draw takes one more.
ON = ["Al", "Bel", "Cor", "Dan", "El", "Fer", "Gar", "Hel", "Is", "Jul", "Kar", "Lor", "Mar", "Nel", "Or", "Per", "Ros", "Sel", "Tam", "Val"]
MID = ["an", "ber", "di", "el", "ga", "in", "li", "mo", "ri", "ven"]
END = {"f": ["a", "ia", "ina", "ella", "ette", "ine"], "m": ["o", "ald", "ert", "us", "ian", "ek"]}
FAMILY_END = ["cott", "den", "field", "gard", "land", "mann", "mont", "ner", "ston", "well"]
ON_C = ["Ал", "Бел", "Вор", "Гор", "Дан", "Ел", "Зор", "Кар", "Лен", "Мар", "Нов", "Ол", "Пав", "Род", "Сол", "Тим"]
MID_C = ["ан", "вар", "ди", "ел", "ги", "ил", "мо", "ри", "сан", "та"]
END_C = {"f": ["а", "ия", "ина", "ана"], "m": ["ей", "ан", "ий", "ир"]}
FAMILY_END_C = ["енко", "ских", "юк", "аго", "ых", "ман"]


def span(first: str, n: int, step: int = 1) -> str:
    return "".join(chr(ord(first) + step * i) for i in range(n))


#: Letters by script, small and, where there are such, capital; others are replaced by Latin ones.
SCRIPTS = {
    "Latin": (span("a", 26), span("A", 26)),
    "Cyrillic": (span("а", 32), span("А", 32)),
    "Greek": (span("α", 17) + span("σ", 7), span("Α", 17) + span("Σ", 7)),
    "Armenian": (span("ա", 38), span("Ա", 38)),
    "Georgian": (span("ა", 33), ""),
    "Hebrew": (span("א", 27), ""),
    "Arabic": (span("ا", 20) + span("ف", 10), ""),
    "Devanagari": (span("क", 37), ""),
    "Thai": (span("ก", 46), ""),
    "Hiragana": (span("か", 60), ""),
    "Katakana": (span("カ", 60), ""),
    "Hangul": (span("가", 150, 28), ""),
    "Han": (span("一", 150, 37), ""),
}


def kind(e: str) -> str:
    """SQL: the type of a mention."""
    return f"""case when {e} like '%@%' then 'email' when {e} like '%:%:%' and {e} rlike r'^[0-9A-Fa-f:]+$' then 'ip6' when {e} rlike r'^(?:{ASSIGN}|[A-Fa-f0-9]{{32,}}$)' then 'secret'
      when {e} rlike r'^(?:AKIA|(?:sk|ghp|gho|xoxb|xoxp)[_-])' then 'key' when not {e} rlike '[0-9]' then 'name' when {e} rlike r'^\\d+(\\.\\d+){{3}}$' then 'ip'
      when {e} rlike r'^[A-Z]{{2}}\\d' then 'iban' when {e} rlike r'^\\d{{3}}[ -]\\d{{2}}[ -]\\d{{4}}$' then 'ssn' when {e} rlike r'^\\d{{4}}[ -]?\\d{{4}}[ -]?\\d{{4}}' then 'card' else 'phone' end"""


def canon(t: str, e: str) -> str:
    """SQL: what all mentions of one entity share. Of phone numbers, the national digits."""
    digits = f"regexp_replace({e}, r'\\D', '')"
    return f"""case when {t} in ('email', 'ip6', 'given', 'family') then lower({e}) when {t} = 'secret' then regexp_extract({e}, r'([A-Za-z0-9_\\-]+)$', 1)
      when {t} = 'phone' then regexp_replace(regexp_replace({e}, r'^(?:\\+(?:{CODES})|0)', ''), r'\\D', '')
      when {t} in ('card', 'ssn') then {digits} when {t} = 'iban' then replace({e}, ' ', '') else {e} end"""


def behind(e: str) -> str:
    """SQL: a name without its honorific."""
    return f"regexp_replace({e}, r'^(?:{HONORIFIC})\\.?\\s{{1,3}}', '')"


def words_of(e: str) -> str:
    return f'regexp_extract_all({behind(e)}, r"{WORD}", 0)'


def mention(m: str) -> str:
    """SQL: (b, p) of m.t and m.e: what stays before the parts, and the parts (t, c, e, g, s); g is the gender that an
    honorific tells, s what stands between a part and the one before."""
    gender = f"case when {m}.e rlike r'^(?:{HONORIFIC_F})\\.?\\s' then 'f' when {m}.e rlike r'^(?:{HONORIFIC_M})\\.?\\s' then 'm' else 'n' end"
    kinds = f"case when i = 0 and size({words_of(f'{m}.e')}) > 1 then 'given' else 'family' end"
    gaps = f'split({behind(f"{m}.e")}, r"{WORD}", -1)'
    many = f"transform({words_of(f'{m}.e')}, (w, i) -> named_struct('t', {kinds}, 'c', lower(w), 'e', w, 'g', case when {kinds} = 'given' then {gender} else 'n' end, 's', {gaps}[i]))"
    one = f"named_struct('t', {m}.t, 'c', {canon(f'{m}.t', f'{m}.e')}, 'e', {m}.e, 'g', 'n', 's', '')"
    return f"case when {m}.t = 'name' then named_struct('b', substr({m}.e, 1, length({m}.e) - length({behind(f'{m}.e')})), 'p', {many}) else named_struct('b', '', 'p', array({one})) end"


def listed(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def surrogate(t: str, c: str, e: str, n: str, g: str, key: str) -> str:
    """SQL: the surrogate of part e of the entity (t, c) of gender g at draw n."""
    stream = f"concat(sha2(concat_ws('|', '{key}', {t}, {c}, {n}, 'a'), 256), sha2(concat_ws('|', '{key}', {t}, {c}, {n}, 'b'), 256))"
    byte = lambda i: f"cast(conv(substr(y.s, 1 + 2 * (({i}) % 60), 4), 16, 10) as int)"
    pick = lambda values, i: f"element_at({listed(values)}, 1 + {byte(i)} % {len(values)})"
    # Letters and digits by their place among such, so that separators don't matter; these are put back after.
    letter = lambda letters: f"substr('{letters}', 1 + {byte('i')} % {len(letters)}, 1)"
    latin = f"case when x rlike r'\\p{{Lu}}' then {letter(SCRIPTS['Latin'][1])} else {letter(SCRIPTS['Latin'][0])} end"
    scripts = " ".join(f"when x rlike r'\\p{{Is{name}}}' then " + (f"case when x rlike r'\\p{{Lu}}' then {letter(large)} else {letter(small)} end" if large else letter(small)) for name, (small, large) in SCRIPTS.items() if name != "Latin")
    swap = f"""case when {t} = 'ip6' then substr('0123456789abcdef', 1 + {byte('i')} % 16, 1) when x rlike r'\\p{{N}}' then cast({byte('i')} % 10 as string) when x rlike '[A-Za-z]' then {latin} {scripts} else {latin} end"""
    plain = r"regexp_replace(y.head, r'[^\p{L}\p{N}]', '')"
    swapped = f"""case when {plain} = '' then y.head else array_join(zip_with(split(y.head, r'[\\p{{L}}\\p{{N}}]', -1), transform(split({plain}, ''), (x, i) -> {swap}), (a, b) -> concat(a, coalesce(b, ''))), '') end"""
    head = f"""case {t} when 'email' then regexp_extract({e}, r'^(.*)\\.[\\p{{L}}\\p{{N}}-]+$', 1) when 'secret' then regexp_extract({e}, r'([A-Za-z0-9_\\-]+)$', 1)
      when 'phone' then regexp_replace({e}, r'^(?:\\+(?:{CODES})|0)', '') when 'key' then regexp_replace({e}, r'^(?:AKIA|(?:sk|ghp|gho|xoxb|xoxp)[_-])', '') when 'iban' then substr({e}, 3) else {e} end"""
    before = f"case when {t} in ('secret', 'phone', 'key', 'iban') then substr({e}, 1, length({e}) - length(y.head)) else '' end"
    after = f"case {t} when 'email' then substr({e}, 1 + length(y.head)) else '' end"
    digits = "transform(split(regexp_replace(p.out, r'[^0-9]', ''), ''), x -> cast(x as int))"
    luhn = "aggregate(d.d, named_struct('s', 0, 'i', size(d.d)), (z, x) -> named_struct('s', z.s + case when z.i = 1 then 0 when z.i % 2 = 1 then x when x > 4 then 2 * x - 9 else 2 * x end, 'i', z.i - 1)).s"
    card = f"transform(array(named_struct('d', {digits})), d -> concat(substr(p.out, 1, length(p.out) - 1), cast((10 - {luhn} % 10) % 10 as string)))[0]"
    mod = "aggregate(split(concat(substr(d.s, 5), substr(d.s, 1, 2), '00'), ''), 0, (z, x) -> case when x rlike '[0-9]' then (10 * z + cast(x as int)) % 97 else (100 * z + ascii(upper(x)) - 55) % 97 end)"
    iban = f"transform(array(named_struct('s', replace(p.out, ' ', ''))), d -> concat(substr(p.out, 1, 2), lpad(cast(98 - {mod} as string), 2, '0'), substr(p.out, 5)))[0]"
    ip = f"array_join(transform(sequence(0, 3), i -> cast(1 + {byte('2 * i')} % 223 as string)), '.')"
    cyr = f"{e} rlike r'\\p{{IsCyrillic}}'"
    female = f"({g} = 'f' or {g} = 'n' and {byte('40')} % 2 = 0)"
    middle = lambda values, more: f"array_join(transform(sequence(1, {more}), k -> {pick(values, '4 + 3 * k')}), '')"
    given = f"""case when {cyr} then concat({pick(ON_C, 1)}, {middle(MID_C, f'1 + {n}')}, case when {female} then {pick(END_C['f'], 3)} else {pick(END_C['m'], 3)} end)
      else concat({pick(ON, 1)}, {middle(MID, f'1 + {n}')}, case when {female} then {pick(END['f'], 3)} else {pick(END['m'], 3)} end) end"""
    # Other scripts have no syllables here: letters for letters.
    own = f"({e} rlike r'\\p{{IsLatin}}' or {cyr})"
    family = f"case when {cyr} then concat({pick(ON_C, 1)}, {middle(MID_C, f'1 + {n}')}, {pick(FAMILY_END_C, 3)}) else concat({pick(ON, 1)}, {middle(MID, f'1 + {n}')}, {pick(FAMILY_END, 3)}) end"
    made = f"case {t} when 'ip' then {ip} when 'given' then case when {own} then {given} else {swapped} end when 'family' then case when {own} then {family} else {swapped} end else concat({before}, {swapped}, {after}) end"
    step = f"transform(array(named_struct('head', {head}, 's', {stream})), y -> named_struct('out', {made}))"
    return f"transform({step}, p -> case when {t} = 'card' then {card} when {t} = 'iban' then {iban} else p.out end)[0]"


def found(docs: DataFrame) -> DataFrame:
    """docs with pattern, which takes in the full and family names that the document's honorifics tell, and ents: its
    mentions in order as (b, p)."""
    hint = reduce(lambda a, b: a | b, [F.col("text").rlike(MARKS), *(F.col("text").contains(h) for h in HINTS)])
    none = F.array().cast("array<string>")
    first = F.coalesce(F.when(hint, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))), none)
    names = f"filter(ents, e -> {kind('e')} = 'name')"
    known = f"transform({names}, e -> concat(case when size({words_of('e')}) > 1 then array({behind('e')}, element_at({words_of('e')}, -1)) else array() end, slice({words_of('e')}, case when size({words_of('e')}) > 1 then 2 else 1 end, 9)))"
    # Longer ones first, so that a full name is not taken for its family name.
    two = docs.withColumn("ents", first).withColumn("known", F.expr(f"array_sort(array_distinct(filter(flatten({known}), x -> length(x) > 1)), (a, b) -> length(b) - length(a))"))
    own = F.concat(F.lit(PATTERN + r"|(?<!\p{L})(?:"), F.array_join("known", "|"), F.lit(r")(?!\p{L}|['’-]\p{L}{2})"))
    two = two.withColumn("pattern", F.when(F.size("known") > 0, own).otherwise(F.lit(PATTERN)))
    again = F.when(F.size("known") > 0, F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(F.col("ents"))
    return two.withColumn("ents", again).drop("known").withColumn("ents", F.expr(f"transform(transform(ents, e -> named_struct('t', {kind('e')}, 'e', e)), m -> {mention('m')})"))


def redraws(entities: DataFrame, key: str) -> DataFrame:
    """(t, c, n, g): the entities that need a draw after the first, and which, or whose mentions differ in gender."""
    draw = keep(entities.withColumn("n", F.lit(0)))
    real = draw.select("t", F.col("c").alias("out"))
    while True:
        made = draw.withColumn("out", F.expr(surrogate("t", "c", "e", "n", "g", key))).withColumn("out", F.expr(canon("t", "out")))
        first = made.groupBy("t", "out").agg(F.min(F.struct("n", "c")).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1")
        late = made.join(first, ["t", "out"]).where("struct(n, c) > first").select("t", "c")
        taken = made.join(real, ["t", "out"], "left_semi").select("t", "c")
        again = keep(late.union(taken).distinct())
        if again.isEmpty():
            return draw.where("n > 0 or mixed").select("t", "c", "n", "g")
        draw = keep(draw.join(again.withColumn("hit", F.lit(1)), ["t", "c"], "left").select("t", "c", "e", "g", "mixed", (F.col("n") + F.coalesce("hit", F.lit(0))).cast("int").alias("n")))


def entities_of(mentions: DataFrame) -> DataFrame:
    """(t, c, e, g, mixed) per entity: a mention, the gender of most of its honorifics, whether mentions differ in it."""
    one = mentions.groupBy("t", "c").agg(F.min("e").alias("e"), F.count_if(F.col("g") == "f").alias("f"), F.count_if(F.col("g") == "m").alias("m"), (F.min("g") != F.max("g")).alias("mixed"))
    return one.select("t", "c", "e", F.when((F.col("f") >= F.col("m")) & (F.col("f") > 0), "f").when(F.col("m") > 0, "m").otherwise("n").alias("g"), "mixed")


def replace_entities(docs: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, n_entities, text_safe per document. The same key gives the same surrogates."""
    key = hashlib.sha256(key.encode()).hexdigest() if key is not None else secrets.token_hex(32)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = found(own)
    mentions = seen.select("doc_id", F.xxhash64("text").alias("h"), F.explode(F.flatten("ents.p")).alias("x")).select("doc_id", "h", "x.*")
    late = keep(redraws(entities_of(mentions), key))
    if late.isEmpty():
        drawn = seen.withColumn("late", F.expr("cast(map() as map<string, struct<n: int, g: string>>)"))
    else:
        some = mentions.select("doc_id", "h", "t", "c").join(late, ["t", "c"]).select("doc_id", "h", F.concat_ws("|", "t", "c").alias("k"), F.struct("n", "g").alias("v")).distinct()
        some = some.groupBy("doc_id", "h").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("late"))
        drawn = seen.withColumn("h", F.xxhash64("text")).alias("a").join(some.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.h") == F.col("b.h")), "left").select("a.doc_id", "a.text", "a.ents", "a.pattern", "b.late")
    # Each part with its draw and gender, then its surrogate.
    told = "transform(m.p, w -> named_struct('t', w.t, 'c', w.c, 'e', w.e, 'n', coalesce(late[concat_ws('|', w.t, w.c)].n, 0), 'g', coalesce(late[concat_ws('|', w.t, w.c)].g, w.g), 's', w.s))"
    new = f"transform(ents, m -> concat(m.b, array_join(transform({told}, v -> concat(v.s, {surrogate('v.t', 'v.c', 'v.e', 'v.n', 'v.g', key)})), '')))"
    safe = F.array_join(F.zip_with(F.expr("split(text, pattern, -1)"), F.expr(new), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return drawn.select("doc_id", F.size("ents").cast("long").alias("n_entities"), F.when(F.size("ents") > 0, safe).otherwise(F.col("text")).alias("text_safe"))
