"""The library's own queries with their SQL. The driver's tables stand in for the layers: lineitem is the long fact,
embeddings the wide matrix, labels a dimension that misses part of documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.scalars import digest, is_zero, null_class, partition_value, share, skew_class, strip
from strataflow.operators import features, join, keysets, metrics, profiling, quality, reshape, states
from strataflow.plans import lineage, pipeline
from strataflow.session import shared_folder
from strataflow.sources import footers, formats, readers, sinks
from strataflow.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MODES = {"A": "returned", "N": "open", "X": "unused"}


def query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def feature_sql(keys: str, value: str, source: str) -> str:
    return f"""select {keys}, round(avg(ln(1 + v)), 9) mean_log1p, round(case when count(*) >= 2 then stddev_pop(ln(1 + v)) end, 9) std_log1p,
      round(median(ln(1 + v)), 9) median_log1p, cast(count(*) as integer) sample_count, round(avg(case when v = 0 then 1.0 else 0.0 end), 9) zero_fraction
      from (select {keys}, cast({value} as double) v from {source} where {value} is not null) group by {keys}"""


def rounded(df: DataFrame, places: int = 9) -> DataFrame:
    return df.select(*(F.round(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query(feature_sql("l_suppkey, l_returnflag", "l_tax", "lineitem"))
def gold_features(spark, sf):
    return rounded(features.group_features(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_tax", double=True))


@query(feature_sql("l_suppkey, l_partkey", "l_discount", "lineitem"))
def gold_features_sparse(spark, sf):
    return rounded(features.group_features(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"], "l_discount", double=True))


@query(feature_sql("l_suppkey, l_returnflag", "l_tax", "lineitem"))
def gold_increments(spark, sf):
    """Features kept by mergeable states: the table arrives in two parts, and the second update reads its files only."""
    t, keys = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber", "l_tax"), ["l_suppkey", "l_returnflag"]
    source, path = _path(spark, "arrivals"), _path(spark, "states")
    for part in ("l_linenumber <= 3", "not l_linenumber <= 3"):
        t.where(part).write.mode("append").parquet(source)
        kept = states.refresh(spark, source, path, lambda df: states.feature_states(df, keys, "l_tax"), lambda a, b: states.merge_features(a, b, keys))
    return rounded(states.features_of(kept, keys, double=True))


DISTINCT = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]


@query(" union all ".join(f"""select '{c}' as "column", count({c}) known, count(distinct {c}) exact_count, true as within, true as bounded from lineitem""" for c in DISTINCT))
def distinct_sketches(spark, sf):
    """Distinct counts from sketches stored per file, beside the exact ones: within 4 standard errors of them."""
    t, source, path = table(spark, sf, "lineitem").select(*DISTINCT), _path(spark, "parts"), _path(spark, "sketches")
    t.repartition(6).write.parquet(source)
    kept = states.refresh(spark, source, path, lambda df: states.distinct_states(df, DISTINCT), DataFrame.unionByName)
    both = states.distinct_estimates(kept).join(F.broadcast(states.exact_distincts(t, DISTINCT)), "column")
    error = 4 * 1.04 / 2 ** (states.HLL / 2)
    return both.select("column", "known", "exact_count", (F.abs(F.col("estimate") - F.col("exact_count")) <= error * F.col("exact_count")).alias("within"), (F.col("least") <= F.col("exact_count")).alias("bounded"))


@query(feature_sql("user_id, event_type", "value", "events"))
def event_features(spark, sf):
    return rounded(features.group_features(table(spark, sf, "events"), ["user_id", "event_type"], "value", double=True))


@query("""with r as (select l_suppkey, l_returnflag, l_tax, row_number() over (partition by l_suppkey, l_returnflag order by md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey)), l_tax) seq from lineitem)
  select l_suppkey, l_returnflag, round(median(ln(1 + l_tax)), 9) reservoir_median, count(*) reservoir_size from r where seq <= 10 group by all""")
def reservoir_median(spark, sf):
    order = [F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")), F.col("l_tax")]
    return rounded(features.reservoir_median(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_tax", order))


@query("select l_orderkey, l_linenumber, l_partkey, sample_id, tpm_value from (select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax from lineitem) unpivot include nulls (tpm_value for sample_id in (l_quantity, l_extendedprice, l_discount, l_tax))")
def unpivot_lineitem(spark, sf):
    return reshape.to_long(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], MEASURES, kind="double")


@query("select vec_id, generate_subscripts(embedding, 1)::integer - 1 as pos, cast(unnest(embedding) as double) as value from embeddings")
def posexplode_embeddings(spark, sf):
    long = reshape.array_to_long(table(spark, sf, "embeddings"), ["vec_id"], "embedding")
    return long.withColumn("value", F.col("value").cast("double"))


#: Value columns that wide_unpivot makes of each position of a vector.
FOLD = 24


@query(f"""select 'p' || pos || '_' || k as sample_id, count(*) n, count(v) known, round(sum(v), 6) total, min(v) low, max(v) high from (
  select pos, k, cast(cast(x as double) * k as float)::double as v from (select generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding) as x from embeddings), range(1, {FOLD + 1}) t(k)) group by all""")
def wide_unpivot(spark, sf):
    """A wide matrix (FOLD columns for each vector position, over 1,000 for 64 positions), written, read and made long."""
    t, path = table(spark, sf, "embeddings"), _path(spark, "wide")
    width = t.agg(F.max(F.size("embedding"))).first()[0] or 0
    t.selectExpr("vec_id", *(f"cast(cast(embedding[{i}] as double) * {k} as float) as p{i}_{k}" for i in range(width) for k in range(1, FOLD + 1))).write.parquet(path)
    wide = spark.read.parquet(path)
    long = reshape.to_long(wide, ["vec_id"], readers.value_columns(wide, ["vec_id"]))
    v = F.col("tpm_value").cast("double")
    return long.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("known"), F.round(F.sum(v), 6).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"))


@query("""select pos, cast(count(*) as integer) sample_count, round(avg(ln(1 + v)), 7) mean_log1p, round(case when count(*) >= 2 then stddev_pop(ln(1 + v)) end, 7) std_log1p, round(median(ln(1 + v)), 7) median_log1p, round(avg(case when v = 0 then 1.0 else 0.0 end), 7) zero_fraction
  from (select generate_subscripts(embedding, 1)::integer - 1 as pos, cast(unnest(embedding) as double) v from embeddings) group by pos""")
def wide_features(spark, sf):
    # Few positions, so their groups grow with the table.
    return rounded(features.group_features(reshape.array_to_long(table(spark, sf, "embeddings"), ["vec_id"], "embedding"), ["pos"], "value", double=True, large_groups=True), 7)


def _modes(spark):
    return spark.createDataFrame(list(MODES.items()), "l_returnflag string, mode string")


MODE_SQL = "(values ('A', 'returned'), ('N', 'open'), ('X', 'unused')) m(l_returnflag, mode)"


@query(f"select mode, count(*) n, round(sum(l_quantity), 4) quantity from lineitem join {MODE_SQL} using (l_returnflag) group by mode")
def long_join_dim(spark, sf):
    matched, _ = join.attach(table(spark, sf, "lineitem"), _modes(spark), "l_returnflag")
    return matched.groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))


@query("select doc_id, lang, source, n_chars, 'no_label_match' reason from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def quarantine_docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return join.attach(docs, table(spark, sf, "labels"), "doc_id", "no_label_match")[1]


@query("select d.doc_id, lang, source, n_chars, quality, toxic from documents d join labels using (doc_id)")
def matched_docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return join.attach(docs, table(spark, sf, "labels"), "doc_id")[0]


@query(feature_sql("l_suppkey, l_returnflag", "l_tax", "(select * from lineitem where l_orderkey < 0)"))
def empty_features(spark, sf):
    """Features of no rows: no groups, the same columns."""
    return rounded(features.group_features(table(spark, sf, "lineitem").where("l_orderkey < 0"), ["l_suppkey", "l_returnflag"], "l_tax", double=True))


@query("""with v as (select event_type, case when event_id % 7 = 0 then 'NaN'::double when event_id % 11 = 0 then null when event_id % 13 = 0 then 0 else value end as x from events)
  select count(*) row_count, count(*) filter (where event_type is null) nulls_event_type, count(*) filter (where x is null) nulls_value, count(*) filter (where isnan(x)) nan_value, count(*) filter (where x = 0) zero_count,
  count(distinct event_type) group_count, round(count(*) filter (where x = 0) / count(*)::double, 9) zero_fraction from v""")
def nan_metrics(spark, sf):
    """NaN is neither null nor zero."""
    x = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 13 == 0, 0.0).otherwise(F.col("value"))
    return rounded(metrics.silver(table(spark, sf, "events").select("event_type", x.alias("x")), ["event_type"], "x", "event_type"))


@query("""with m as (select count(*) n, count(*) filter (where l_tax = 0) / count(*)::double z, count(*) - count(distinct (l_orderkey, l_linenumber)) d, count(*) filter (where l_comment is null) k from (select *, cast(null as varchar) as l_comment from lineitem))
  select 'row_count' as name, format('{:,}', n + 1) as expected, format('{:,}', n) as actual, 'difference -1' as detail, format('[FAIL] row_count (critical): expected {:,}, got {:,}', n + 1, n) as summary from m
  union all select 'duplicates_line', '0', format('{:,}', d), format('difference {:,}', d), format('[{}] duplicates_line (critical): expected 0, got {:,}', case when d = 0 then 'PASS' else 'FAIL' end, d) from m
  union all select 'nulls_l_comment', '<= 0', format('{:,}', k), '', format('[FAIL] nulls_l_comment (critical): expected <= 0, got {:,}', k) from m
  union all select 'zero_fraction', '0.9000 +- 0.0500', format('{:.4f}', z), '', format('[FAIL] zero_fraction (warning): expected 0.9000 +- 0.0500, got {:.4f}', z) from m""")
def check_texts(spark, sf):
    """What checks say: numbers with separators, shares with their digits, and one line each."""
    t = table(spark, sf, "lineitem").withColumn("l_comment", F.lit(None).cast("string"))
    m, d = metrics.silver(t, ["l_comment"], "l_tax", "l_returnflag").first(), profiling.duplicates(t, ["l_orderkey", "l_linenumber"]).first()
    checks = [quality.row_count(m.row_count, m.row_count + 1), quality.no_duplicates(d["duplicates"], "line"), quality.nulls(m.nulls_l_comment, "l_comment"), quality.near("zero_fraction", m.zero_fraction, 0.9)]
    return spark.createDataFrame([(c.name, c.expected, c.actual, c.detail, c.summary()) for c in checks], "name string, expected string, actual string, detail string, summary string")


@query("""with w as (select 'g' || vec_id as gene_id, 'l' || label as gene_symbol, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as i from embeddings)
  select gene_id, gene_symbol, 's' || i as sample_id, cast(v as float)::double as tpm_value, case when i % 5 > 0 then 't' || i % 5 end as tissue_id, i % 5 = 0 as quarantined from w""")
def matrix_pipeline(spark, sf):
    """A matrix with names, made long, joined with its dimension and split into both layers."""
    t = table(spark, sf, "embeddings")
    width = t.agg(F.max(F.size("embedding"))).first()[0] or 0
    wide = t.selectExpr("concat('g', vec_id) as Name", "concat('l', label) as Description", *(f"embedding[{i}] as s{i}" for i in range(width)))
    dim = spark.createDataFrame([(f"s{i}", f"t{i % 5}") for i in range(width) if i % 5], "sample_id string, tissue_id string")
    kept, lost = pipeline.long_form(wide, dim)
    one = kept.withColumn("quarantined", F.lit(False)).unionByName(lost.drop("reason").withColumn("tissue_id", F.lit(None).cast("string")).withColumn("quarantined", F.lit(True)))
    return one.withColumn("tpm_value", F.col("tpm_value").cast("double"))


@query("select user_id, event_type from (select user_id, event_type, row_number() over (partition by user_id order by event_id desc) seq from events) where seq = 1")
def dim_last_wins(spark, sf):
    return readers.last_wins(table(spark, sf, "events"), "user_id", "event_type", "event_id")


@query("select l_orderkey, l_linenumber, l_partkey, coalesce(mode, 'unknown') as mode from lineitem left join " + MODE_SQL + " using (l_returnflag)")
def lookup_fallback(spark, sf):
    return join.lookup(table(spark, sf, "lineitem"), _modes(spark), "l_returnflag", "mode", "unknown").select("l_orderkey", "l_linenumber", "l_partkey", "mode")


@query("""select (select count(*) from documents join labels using (doc_id)) * 2 silver_count, (select count(*) from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)) * 2 quarantine_count,
  (select count(*) from documents) source_count, (select count(*) from documents) * 2 expected_total, true closes""")
def closure_check(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", "cast(n_chars as double) n_chars", "cast(length(text) as double) n_text")
    long = reshape.to_long(docs, ["doc_id"], ["n_chars", "n_text"])
    return metrics.closure(join.tagged(long, table(spark, sf, "labels").select("doc_id"), "doc_id"), docs, 2)


@query("select count(*) total, count(*) filter (where l.doc_id is null) quarantined, round(case when count(*) = 0 then 0 else count(*) filter (where l.doc_id is null) / count(*)::double end, 9) fraction from documents d left join labels l using (doc_id)")
def quarantine_ratio(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(join.sized(table(spark, sf, "labels").select("doc_id", F.lit(1).alias("hit"))), "doc_id", "left")
    one = joined.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("hit").isNull()).alias("quarantined"))
    return one.withColumn("fraction", F.round(share(F.col("quarantined"), F.col("total")), 9))


@query("""select count(*) row_count, count(*) filter (where l_orderkey is null) nulls_l_orderkey, count(*) filter (where l_returnflag is null) nulls_l_returnflag, count(*) filter (where l_tax is null) nulls_value,
  count(*) filter (where isnan(l_tax)) nan_value, count(*) filter (where l_tax = 0) zero_count, count(distinct l_returnflag) group_count, round(count(*) filter (where l_tax = 0) / count(*)::double, 9) zero_fraction from lineitem""")
def silver_metrics(spark, sf):
    return rounded(metrics.silver(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"], "l_tax", "l_returnflag"))


@query(f"""select count(*) row_count, count(*) filter (where l_suppkey is null) nulls_l_suppkey, count(*) filter (where l_returnflag is null) nulls_l_returnflag, count(distinct l_returnflag) group_count, min(sample_count) min_sample_count, round(avg(z), 7) mean_zero_fraction
  from (select l_suppkey, l_returnflag, cast(count(*) as integer) sample_count, avg(case when l_tax = 0 then 1.0 else 0.0 end) z from lineitem where l_tax is not null group by all)""")
def gold_metrics(spark, sf):
    f = features.group_features(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_tax", double=True)
    return rounded(metrics.gold(f, ["l_suppkey", "l_returnflag"], "l_returnflag"), 7)


def report_rows(spark: SparkSession, report: quality.Report) -> DataFrame:
    """The checks of a report with its verdict as rows."""
    return spark.createDataFrame([(c.name, c.severity, c.passed, report.passed) for c in report.checks], "name string, severity string, passed boolean, report_passed boolean")


@query("""with m as (select count(*) n, count(*) filter (where l_orderkey is null) k, count(*) filter (where l_tax = 0) / count(*)::double z, count(*) - count(distinct (l_orderkey, l_linenumber)) d from lineitem)
  select 'row_count' as name, 'critical' severity, n > 0 passed from m union all select 'nulls_l_orderkey', 'critical', k = 0 from m
  union all select 'duplicates_line', 'critical', d = 0 from m union all select 'zero_fraction', 'warning', z between 0.5189 - 0.05 and 0.5189 + 0.05 from m""")
def quality_report_rows(spark, sf):
    """Checks of a scan; the rows expected are those of the footers."""
    t = table(spark, sf, "lineitem")
    d = profiling.duplicates(t, ["l_orderkey", "l_linenumber"]).first()["duplicates"]
    m = metrics.silver(t, ["l_orderkey"], "l_tax", "l_returnflag").first()
    report = quality.Report("lineitem", [quality.row_count(m.row_count, footers.row_count(spark, f"{sf}/lineitem.parquet")), quality.nulls(m.nulls_l_orderkey, "l_orderkey"), quality.no_duplicates(d, "line"), quality.near("zero_fraction", m.zero_fraction, 0.5189)])
    return report_rows(spark, report).drop("report_passed")


@query("""with m as (select count(*) n, count(distinct p_partkey) k, count(*) filter (where p_brand is null) x from part), c as (
  select 'row_count' as name, n = (select count(*) from part) passed from m union all select 'duplicates_p_partkey', n = k from m union all select 'nulls_Description', x = 0 from m)
  select name, 'critical' severity, passed, (select bool_and(passed) from c) report_passed from c""")
def bronze_suite(spark, sf):
    """The checks of a raw copy: rows as in the source, unique names, no null descriptions."""
    source, path = f"{sf}/part.parquet", f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    sinks.copy_raw(spark, source, path)
    raw = spark.read.parquet(path)
    d = profiling.duplicates(raw, ["p_partkey"]).first()
    return report_rows(spark, quality.bronze_report(d["duplicates"], d["total"], raw.where("p_brand is null").count(), spark.read.parquet(source).count(), "p_partkey"))


@query("""with d as (select count(*) n from documents), m as (select count(*) n, count(*) filter (where lang is null) k, count(*) filter (where l.toxic = 0) / count(*)::double z from documents join labels l using (doc_id)),
  c as (select 'nulls_doc_id' as name, 'critical' severity, true passed union all select 'nulls_lang', 'critical', k = 0 from m
  union all select 'quarantine_threshold', 'critical', (d.n - m.n) / greatest(d.n, 1)::double <= 0.01 from d, m union all select 'lineage_closure', 'critical', true
  union all select 'zero_fraction', 'warning', z between 0.5189 - 0.05 and 0.5189 + 0.05 from m)
  select name, severity, passed, (select bool_and(passed) from c where severity = 'critical') report_passed from c""")
def silver_suite(spark, sf):
    """The checks of a long form: labels are the dimension, toxic the value; documents without a label are quarantined."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    both = join.tagged(docs, table(spark, sf, "labels"), "doc_id")
    matched, lost = join.split(both, docs.columns)
    m = metrics.silver(matched, ["doc_id", "lang"], "toxic", "lang").first().asDict()
    return report_rows(spark, quality.silver_report(m, ["doc_id", "lang"], lost.count(), docs.count(), 1))


@query("""with f as (select l_suppkey, l_returnflag, count(*) n, avg(case when l_tax = 0 then 1.0 else 0.0 end) z from lineitem where l_tax is not null group by all), e as (select count(distinct l_suppkey) s, count(distinct l_returnflag) g from lineitem),
  c as (select 'nulls_l_suppkey' as name, 'critical' severity, count(*) filter (where l_suppkey is null) = 0 passed from f union all select 'nulls_l_returnflag', 'critical', count(*) filter (where l_returnflag is null) = 0 from f
  union all select 'gold_row_count', 'critical', (select count(*) from f) = s * g from e union all select 'gold_tissue_count', 'critical', (select count(distinct l_returnflag) from f) = g from e
  union all select 'gold_min_sample_count', 'critical', min(n) >= 1 from f union all select 'gold_zero_fraction_consistency', 'warning', avg(z) between (select avg((l_tax = 0)::int) from lineitem) - 0.05 and (select avg((l_tax = 0)::int) from lineitem) + 0.05 from f)
  select name, severity, passed, (select bool_and(passed) from c where severity = 'critical') report_passed from c""")
def gold_suite(spark, sf):
    """The checks of a feature layer against the rows that it was made from."""
    t, keys = table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"]
    g = metrics.gold(features.group_features(t, keys, "l_tax", double=True), keys, "l_returnflag").first().asDict()
    base = metrics.silver(t, keys, "l_tax", "l_returnflag").first()
    return report_rows(spark, quality.gold_report(g, keys, t.agg(F.count_distinct("l_suppkey")).first()[0], base.group_count, base.zero_fraction))


@query("""select user_id, n, n >= 100 ok, case when n = 0 then 'the mapping is empty' when n < 100 then n || ' samples, 100 are needed' else n || ' samples' end message from (select user_id, count(distinct event_id) n from events group by 1)
  union all select -1, n, n >= 100, case when n = 0 then 'the mapping is empty' when n < 100 then n || ' samples, 100 are needed' else n || ' samples' end from (select count(distinct event_id) n from events)""")
def mapping_validation(spark, sf):
    """Each user's events as a mapping, and all of them as one (user -1), judged by size."""
    t, n = table(spark, sf, "events").select("user_id", "event_id"), F.count_distinct("event_id").alias("n")
    sizes = t.groupBy(F.col("user_id").cast("long").alias("user_id")).agg(n).unionByName(t.agg(n).select(F.lit(-1).cast("long").alias("user_id"), "n"))
    return quality.mapping_checks(sizes, "n").select("user_id", "n", "ok", "message")


@query("select cast(count(*) as bigint) total, count(distinct (l_orderkey, l_linenumber)) distinct_keys, count(*) - count(distinct (l_orderkey, l_linenumber)) duplicates from lineitem")
def duplicates_index(spark, sf):
    return profiling.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(ORACLES["duplicates_index"])
def duplicates_filtered(spark, sf):
    """The same through filters of the partitions: unique keys are not shuffled."""
    return keysets.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select count(*) total, count(distinct (o_custkey, o_orderstatus)) distinct_keys, count(*) - count(distinct (o_custkey, o_orderstatus)) duplicates from orders")
def duplicates_of_customers(spark, sf):
    """Keys that mostly repeat."""
    return keysets.duplicates(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@query("""with k as (select distinct event_type as g, user_id from events where event_type is not null and user_id is not null)
  select x.g as a, y.g as b, count(*) n from k x join k y using (user_id) where x.g <= y.g group by all""")
def group_overlaps(spark, sf):
    """Users that two kinds of events share, for all kinds, by bitmaps."""
    return keysets.overlaps(table(spark, sf, "events"), "event_type", "user_id")


@query("""with k as (select distinct l_suppkey as g, l_partkey as p from lineitem), o as (select x.g as a, y.g as b, count(*) n from k x join k y using (p) where x.g < y.g group by all)
  select a, b, n from o""")
def supplier_overlaps(spark, sf):
    """Parts that two suppliers share, for all suppliers."""
    return keysets.overlaps(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey").where("a < b")


def _profile_sql(column: str) -> str:
    return f"""select '{column}' as "column", count(*) total, count(*) filter (where {column} is null) nulls, count(*) filter (where {column} = 0) zeros, round(count(*) filter (where {column} is null) * 100.0 / count(*), 4)::double null_pct,
      round(count(*) filter (where {column} = 0) * 100.0 / count(*), 2)::double zero_pct, case when count(*) filter (where {column} is null) * 100.0 / count(*) < 0.1 then 'clean' when count(*) filter (where {column} is null) * 100.0 / count(*) < 1 then 'acceptable' else 'review' end verdict from lineitem"""


@query(" union all ".join(_profile_sql(c) for c in MEASURES))
def null_zero_profile(spark, sf):
    return profiling.null_zero(table(spark, sf, "lineitem"), MEASURES)


@query("select event_type, count(*) n from events where event_type is not null group by event_type")
def value_counts(spark, sf):
    return profiling.value_counts(table(spark, sf, "events"), "event_type")


@query("select l_suppkey, count(*) n from lineitem where l_suppkey is not null group by l_suppkey order by n desc, l_suppkey limit 10")
def top10(spark, sf):
    return profiling.top(table(spark, sf, "lineitem"), "l_suppkey")


@query("select l_suppkey, count(*) n from lineitem where l_suppkey is not null group by l_suppkey order by n, l_suppkey limit 5")
def bottom5(spark, sf):
    return profiling.bottom(table(spark, sf, "lineitem"), "l_suppkey")


@query("""with c as (select l_suppkey v, count(*) n from lineitem where l_suppkey is not null group by 1), a as (select count(*) distinct_values, max(n) largest, min(n) smallest from c)
  select distinct_values, largest, smallest, (select v from c order by n desc, v limit 1) largest_value, (select v from c order by n, v limit 1) smallest_value, round(largest / smallest::double, 1) ratio,
  case when round(largest / smallest::double, 1) > 10 then 'SEVERE' when round(largest / smallest::double, 1) > 5 then 'MODERATE' else 'LOW' end skew from a""")
def skew_ratio(spark, sf):
    return profiling.skew(table(spark, sf, "lineitem"), "l_suppkey")


@query("select count(*) filter (where l_tax = 0) l_tax_zeros, count(*) filter (where l_discount = 0) l_discount_zeros from lineitem")
def zero_count_when(spark, sf):
    return profiling.zero_counts(table(spark, sf, "lineitem"), ["l_tax", "l_discount"])


@query("select l_returnflag, count(*) as groups from (select distinct l_suppkey, l_returnflag from lineitem where l_tax is not null) group by l_returnflag")
def groups_per_tissue(spark, sf):
    f = features.group_features(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_tax")
    return features.groups_per(f, "l_returnflag")


@query("select l_linestatus, count(*) n, round(sum(l_tax), 4) tax from (select * from lineitem where l_returnflag = 'A' union all select * from lineitem where l_returnflag <> 'A') group by l_linestatus")
def union_all_chunks(spark, sf):
    t = table(spark, sf, "lineitem")
    both = t.where("l_returnflag = 'A'").unionByName(t.where("l_returnflag <> 'A'"))
    return both.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_tax"), 4).alias("tax"))


@query("select distinct o_custkey as key from orders where exists (select 1 from customer where c_custkey = o_custkey)")
def overlap_semi(spark, sf):
    return join.overlap(table(spark, sf, "orders").select(F.col("o_custkey").alias("key")), table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), "key")


@query("select o_custkey as key from orders intersect select c_custkey from customer")
def overlap_intersect(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("key")).intersect(table(spark, sf, "customer").select(F.col("c_custkey").alias("key")))


@query("""select l_suppkey, round(min(m), 9) min_mean, round(max(z), 9) max_zero_fraction from (select l_suppkey, l_returnflag, avg(ln(1 + l_tax)) m, avg(case when l_tax = 0 then 1.0 else 0.0 end) z from lineitem where l_tax is not null group by all) group by l_suppkey""")
def gene_validation(spark, sf):
    f = features.group_features(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_tax", double=True)
    return rounded(features.validate_genes(f, "l_suppkey"))


@query("select count(*) n_rows, cast(sum(len(embedding)) as bigint) long_rows, round(sum(len(embedding)) * 40 / 1073741824.0::double, 6) long_gb, max(len(embedding)) * count(distinct label) feature_rows from embeddings")
def reshape_sizing(spark, sf):
    return profiling.long_sizes(table(spark, sf, "embeddings"), "embedding", "label")


@query("""with c as (select count(*) n from information_schema.columns where table_name = 'lineitem')
  select count(*) n_rows, any_value(c.n)::integer n_columns, any_value(c.n)::integer - 2 n_value_columns, case when any_value(c.n) > 100 then 'Wide' else 'Long' end topology from lineitem, c""")
def schema_dims(spark, sf):
    return profiling.dimensions(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select o_custkey, o_orderstatus, count(*) n, round(sum(o_totalprice), 2) total from orders group by all")
def sink_roundtrip(spark, sf):
    """Written by status, checked, published, and read back with string partitions."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    back = sinks.publish(spark, orders, f"{shared_folder(spark)}/layer-{uuid.uuid4().hex}", "o_orderstatus", lambda df: None, spread=sinks.spread_for(orders, "o_orderstatus", 10_000))
    return back.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(ORACLES["silver_metrics"])
def written_metrics(spark, sf):
    """The metrics of a long form, taken on its write; nothing is read again but footers and folder names."""
    t, keys, found = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_returnflag"), ["l_orderkey", "l_returnflag"], []
    sinks.publish(spark, t, _path(spark, "long"), "l_returnflag", found.append, measures=metrics.silver_measures(keys, "l_tax"))
    m = metrics.with_share(found[0])
    names = ["row_count", *(f"nulls_{k}" for k in keys), "nulls_value", "nan_value", "zero_count", "group_count"]
    return rounded(spark.createDataFrame([(*(m[n] for n in names), float(m["zero_fraction"]))], ", ".join(f"{n} long" for n in names) + ", zero_fraction double"))


@query("""with o as (select o_orderpriority = '1-URGENT' or o_orderkey % 3 > 0 as hot, o_orderpriority as p from orders), v as (select case when hot then 'hot' else p end as value, count(*) n from o group by 1)
  select value, n, cast(greatest(ceil(n / 2000.0), 1) as bigint) as files, true even from v""")
def spread_files(spark, sf):
    """A skewed layer written by counted spread: files by value, and whether each has about its share of rows."""
    path, hot = _path(spark, "spread"), F.expr("o_orderpriority = '1-URGENT' or o_orderkey % 3 > 0")
    t = table(spark, sf, "orders").select("o_orderkey", F.when(hot, "hot").otherwise(F.col("o_orderpriority")).alias("value"))
    sinks.write_layer(t, path, "value", spread=sinks.spread_for(t, "value", 2_000))
    each = footers.footers(spark, path).where("column is null").groupBy("file").agg(F.sum("rows").alias("rows")).withColumn("value", partition_value(F.element_at(F.split("file", "/"), -2)))
    whole = each.groupBy("value").agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("files"), (F.max("rows") <= 2 * F.min("rows")).alias("even"))
    return whole


@query("select o_orderstatus, count(*) n, round(sum(o_totalprice), 2) total from orders where o_orderdate >= (select min(o_orderdate) + interval 1 year from orders) group by 1")
def layer_versions(spark, sf):
    """A layer published twice: readers resolve its pointer to the second data folder."""
    path, t = _path(spark, "layer"), table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    sinks.publish(spark, t, path, "o_orderstatus", lambda df: None)
    since = F.add_months(F.lit(t.agg(F.min("o_orderdate")).first()[0]), 12)
    sinks.publish(spark, t.where(F.col("o_orderdate") >= since), path, "o_orderstatus", lambda df: None)
    return readers.layer(spark, path, ("o_orderstatus",)).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


#: Columns of lineitem by how their ranges are written; texts have none.
RANGED = {"l_orderkey": "bigint", "l_linenumber": "bigint", "l_tax": "double", "l_extendedprice": "double"}


@query(" union all ".join(f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls, min({c})::double low, max({c})::double high from lineitem""" for c in RANGED) + """ union all select 'l_returnflag', count(*), count(*) - count(l_returnflag), null, null from lineitem""")
def footer_profile(spark, sf):
    """Rows, nulls and ranges of columns from Parquet footers."""
    told = footers.column_profile(spark, f"{sf}/lineitem.parquet", [*RANGED, "l_returnflag"])
    return told.withColumns({c: F.col(c).cast("double") for c in ("low", "high")})


@query("select source, lang, count(*) n, substring(sha256(source), 1, 16) digest from (select trim(source) source, lang from documents) group by all")
def scalar_functions(spark, sf):
    d = table(spark, sf, "documents").select(strip(F.col("source")).alias("source"), "lang")
    return d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", digest(F.col("source")))


@query("""select l_returnflag, round(n0 * 1.0::double / n1, 6) ratio, case when n0 * 1.0 / n1 > 10 then 'SEVERE' when n0 * 1.0 / n1 > 5 then 'MODERATE' else 'LOW' end skew, case when z < 0.1 then 'clean' when z < 1 then 'acceptable' else 'review' end verdict
  from (select l_returnflag, count(*) n0, count(*) filter (where l_tax = 0) + 1 n1, count(*) filter (where l_tax = 0) * 100.0 / count(*) z from lineitem group by 1)""")
def verdict_classes(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n0"), F.count_if(is_zero(F.col("l_tax"))).alias("z"))
    ratio = F.col("n0") / (F.col("z") + 1)
    return g.select("l_returnflag", F.round(ratio, 6).alias("ratio"), skew_class(ratio).alias("skew"), null_class(F.col("z") * 100.0 / F.col("n0")).alias("verdict"))


@query("select quality, toxic, lang, count(*) n, round(avg(n_chars), 6) mean_chars from documents join labels using (doc_id) group by all")
def labelled_summary(spark, sf):
    matched, _ = join.attach(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf, "labels"), "doc_id")
    return matched.groupBy("quality", "toxic", "lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("select cast(c_custkey as varchar) as c_custkey, trim(c_mktsegment) as c_mktsegment from customer where trim(c_mktsegment) <> ''")
def tsv_dimension(spark, sf):
    """A dimension as a tab-separated file, read back by its header."""
    path = _path(spark, "tsv")
    rows = table(spark, sf, "customer").select(F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit("  ")).alias("c_custkey"), "c_name", F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("c_mktsegment"))
    rows.write.csv(path, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.dimension(spark, path, "c_custkey", "c_mktsegment")


@query("select cast(c_custkey as varchar) as c_custkey, trim(c_mktsegment) as c_mktsegment from customer where trim(c_mktsegment) <> '' and c_custkey in (1, 5, 77, 100)")
def tsv_format(spark, sf):
    """The same as a named format, with a filter that reaches the source."""
    path = _path(spark, "tsv")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("c_mktsegment"))
    rows.write.csv(path, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    formats.register(spark)
    dim = spark.read.format("tsv_dimension").option("key", "c_custkey").option("value", "c_mktsegment").load(path)
    return dim.where(F.col("c_custkey").isin("1", "5", "77", "100"))


@query("""select 'p' || pos as sample_id, vec_id, cast(x as double) as v from (select vec_id, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding) as x from embeddings) where pos in (0, 3, 17)""")
def matrix_format(spark, sf):
    """A wide matrix as a named format; the filter on the long name chooses its columns."""
    t, path = table(spark, sf, "embeddings"), _path(spark, "wide")
    width = t.agg(F.max(F.size("embedding"))).first()[0] or 0
    t.selectExpr("vec_id", *(f"embedding[{i}] as p{i}" for i in range(width))).write.parquet(path)
    formats.register(spark)
    long = spark.read.format("wide_matrix").option("ids", "vec_id").load(path)
    return long.where(F.col("sample_id").isin("p0", "p3", "p17")).select("sample_id", "vec_id", F.col("tpm_value").cast("double").alias("v"))


@query("select event_type, count(*) n from events where event_type is not null group by 1")
def json_document(spark, sf):
    """Counts as a JSON document, written and read through Spark's file systems."""
    path, counts = f"{_path(spark, 'doc')}.json", profiling.value_counts(table(spark, sf, "events"), "event_type")
    sinks.save_json(spark, {"counts": [r.asDict() for r in counts.collect()]}, path)
    return spark.createDataFrame([(x["event_type"], x["n"]) for x in readers.json_document(spark, path)["counts"]], "event_type string, n long")


@query("select o_orderstatus, count(*) n, round(sum(o_totalprice), 2) total from orders group by 1")
def raw_copy(spark, sf):
    """A byte copy, checked by size, then read."""
    path = _path(spark, "raw")
    sinks.copy_raw(spark, f"{sf}/orders.parquet", path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


GOLD_TYPES = "l_suppkey long, l_returnflag string, mean_log1p double, std_log1p double, median_log1p double, sample_count int, zero_fraction double"


@query(feature_sql("l_suppkey, l_returnflag", "l_quantity", "lineitem"))
def gold_write(spark, sf):
    """Features published in a layer of their own schema, a folder per group, zstandard; then read back."""
    made = features.group_features(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_quantity", double=True)
    schema = spark.createDataFrame([], GOLD_TYPES).schema
    return rounded(sinks.publish(spark, made, _path(spark, "gold"), "l_returnflag", lambda df: None, "zstd", schema=schema))


@query("select reason, count(*) n from (select 'no_label_match' reason from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)) group by 1")
def quarantine_write(spark, sf):
    path, docs = _path(spark, "quarantine"), table(spark, sf, "documents").select("doc_id", "lang")
    for _ in range(2):  # a second run replaces the first one's rows
        sinks.write_quarantine(join.attach(docs, table(spark, sf, "labels"), "doc_id", "no_label_match")[1], path)
    return spark.read.parquet(path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) n_rows, true complete, false incomplete, false missing from supplier")
def completeness(spark, sf):
    """Whether a layer has the rows expected of it, from its footers."""
    path, t = _path(spark, "layer"), table(spark, sf, "supplier")
    n = sinks.write_once(spark, t, path).count()
    return t.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", *(F.lit(v).alias(k) for k, v in (("complete", sinks.is_complete(spark, path, n)), ("incomplete", sinks.is_complete(spark, path, n + 1)), ("missing", sinks.is_complete(spark, path + "-none", n)))))


@query("select l_returnflag, l_orderkey, l_linenumber, l_partkey, cast(l_tax as float)::double l_tax from lineitem")
def schema_realign(spark, sf):
    """Columns in another order and of narrower types, realigned to a layer's schema."""
    schema = spark.createDataFrame([], "l_returnflag string, l_orderkey long, l_linenumber int, l_partkey long, l_tax float").schema
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_tax").cast("float").alias("l_tax"), "l_returnflag")
    return sinks.conform(t, schema).withColumn("l_tax", F.col("l_tax").cast("double"))


@query("select sample_id, count(*) n, round(sum(tpm_value), 4) total from (select l_quantity, l_extendedprice, l_discount, l_tax from lineitem) unpivot include nulls (tpm_value for sample_id in (l_quantity, l_extendedprice, l_discount, l_tax)) group by 1")
def unpivot_groups(spark, sf):
    """The long form made by groups of columns and put together."""
    t = table(spark, sf, "lineitem")
    parts = [reshape.to_long(t, ["l_orderkey"], group, kind="double") for group in reshape.column_groups(MEASURES, 3)]
    return parts[0].unionAll(parts[1]).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("tpm_value"), 4).alias("total"))


@query(" union all ".join(_profile_sql(c) for c in ("l_discount", "l_tax")))
def prefix_profile(spark, sf):
    """A seeded sample of the columns that a prefix names, profiled."""
    t = table(spark, sf, "lineitem")
    return profiling.null_zero(t, profiling.sample_columns(readers.columns_with_prefix(t, "l_d", "l_t"), 200))


@query("select l_returnflag, count(*) n from lineitem group by 1")
def nested_files(spark, sf):
    """Every file below a folder of folders."""
    path = _path(spark, "nested")
    table(spark, sf, "lineitem").select("l_returnflag", F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).write.partitionBy("f", "s").parquet(path)
    return readers.files_below(spark, path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderstatus, count(*) n from orders group by 1")
def corrupt_files(spark, sf):
    """A layer with a file that is no Parquet, which is skipped on request."""
    path = _path(spark, "layer")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    sinks.save_json(spark, {"not": "parquet"}, f"{path}/o_orderstatus=F/broken.parquet")
    schema = spark.createDataFrame([], "o_orderkey long, o_orderstatus string").schema
    return readers.layer(spark, path, ("o_orderstatus",), skip_corrupt=True, schema=schema).groupBy("o_orderstatus").agg(F.count("o_orderkey").alias("n"))


@query("select o_orderpriority as priority, split_part(o_orderpriority, '-', 1) as head, starts_with(o_orderpriority, '1') as first, count(*) n from orders group by all")
def path_values(spark, sf):
    """Values out of escaped folder names, and parts of strings."""
    value = partition_value(F.concat(F.lit("priority="), F.regexp_replace(F.url_encode("o_orderpriority"), r"\+", "%20")))
    g = table(spark, sf, "orders").select(value.alias("priority")).groupBy("priority").agg(F.count(F.lit(1)).alias("n"))
    return g.select("priority", F.split("priority", "-")[0].alias("head"), F.startswith("priority", F.lit("1")).alias("first"), "n")


@query("""select (select count(*) from documents) * 2 expected_total, (select count(*) from documents) * 2 actual_total, cast(0 as bigint) as delta, true closes, 'complete' status, '1/1' layers_complete""")
def lineage_documents(spark, sf):
    """The lineage of a long form, saved and read again."""
    docs, path = table(spark, sf, "documents").selectExpr("doc_id", "cast(n_chars as double) n_chars", "cast(length(text) as double) n_text"), f"{_path(spark, 'lineage')}.json"
    m = metrics.closure(join.tagged(reshape.to_long(docs, ["doc_id"], ["n_chars", "n_text"]), table(spark, sf, "labels").select("doc_id"), "doc_id"), docs, 2).first()
    line = lineage.document("silver", {"path": sf}, {}, quality.Report("silver"), ["unpivot"], lineage_closure=lineage.closure(m.source_count, 2, m.silver_count, m.quarantine_count))
    sinks.save_json(spark, lineage.chain("documents", {}, {"silver": line}), path)
    back = readers.json_document(spark, path)
    c = back["silver"]["lineage_closure"]
    return spark.createDataFrame([(c["expected_total"], c["actual_total"], c["delta"], c["closes"], back["status"], back["layers_complete"])], "expected_total long, actual_total long, delta long, closes boolean, status string, layers_complete string")
