"""Operators on small fixtures: features, reshape, joins, checks, sources, sinks, the whole pipeline."""

from __future__ import annotations

import json
import math
import subprocess
import sys
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow import session
from strataflow.operators import features, join, keysets, metrics, profiling, quality, reshape, states
from strataflow.plans import lineage, pipeline
from strataflow.sources import footers, formats, readers, sinks, versions
from strataflow.streaming.incremental import stream_silver

FEATURES = "g string, v float"


def test_features_match_numpy(spark):
    x = np.random.default_rng(7).exponential(scale=1.5, size=9_000).astype(np.float32)
    df = spark.createDataFrame([("a", float(v)) for v in x], FEATURES)
    r = features.group_features(df, ["g"], "v", double=True).first()
    lv = np.log1p(x.astype(np.float64))
    assert abs(r.mean_log1p - lv.mean()) < 1e-6 and abs(r.std_log1p - lv.std()) < 1e-6 and r.sample_count == 9_000


def test_features_zero_share_and_median(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (0, 0, 0, 1, 2, 3, 4, 5, 6, 7)], FEATURES)
    r = features.group_features(df, ["g"], "v").first()
    assert r.zero_fraction == pytest.approx(0.3) and r.sample_count == 10
    assert [r.mean_log1p, r.std_log1p, r.median_log1p] == pytest.approx([1.060460290, 0.792135694, 1.242453325], abs=1e-6)


def test_features_edges(spark):
    df = spark.createDataFrame([("one", 5.0), ("none", None), (None, 1.0), ("nan", math.nan), ("nan", 0.0), ("low", -1.0)], FEATURES)
    got = {r.g: r for r in features.group_features(df, ["g"], "v", double=True).collect()}
    assert "none" not in got and got["one"].std_log1p is None and got[None].sample_count == 1
    assert math.isnan(got["nan"].mean_log1p) and got["nan"].zero_fraction == 0.5 and got["low"].mean_log1p is None
    assert features.group_features(df.limit(0), ["g"], "v").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.floats(0, 100, width=32))), max_size=20))
def test_features_properties(spark, data):
    df = spark.createDataFrame([(str(g), v) for g, v in data], FEATURES)
    got = features.group_features(df, ["g"], "v").collect()
    assert sum(r.sample_count for r in got) == sum(v is not None for _, v in data)
    assert all(0 <= r.zero_fraction <= 1 for r in got)


def test_median_of_large_groups(spark):
    rng = np.random.default_rng(11)
    data = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 5_001), ("d", 30_000), (None, 6)) for v in rng.integers(0, 4_000, n) / 7]
    df = spark.createDataFrame([*data, ("e", None), ("f", -2.0), *[("g", 3.0)] * 50], FEATURES)
    forms = [sorted(map(tuple, features.group_features(df, ["g"], "v", True, large).collect()), key=str) for large in (False, True)]
    assert len(forms[0]) == len(forms[1]) == 7
    for a, b in zip(*forms, strict=True):
        assert a[0] == b[0] and all(x == y or math.isclose(x, y, abs_tol=1e-12) for x, y in zip(a[1:], b[1:], strict=True))


def test_states_of_increments_equal_one_run(spark, tmp_path):
    """Two increments, then a changed file: states equal those of one run, and only new files are read."""
    rng, made, keys = np.random.default_rng(2), [], ["g"]
    rows = lambda n, shift: [(None if i % 9 == 0 else f"g{i % 4}", None if i % 13 == 0 else 0.0 if i % 5 == 0 else float(rng.exponential(3) + shift)) for i in range(n)]
    source, path = f"{tmp_path}/in", f"{tmp_path}/states"

    def make(df):
        made.append(len(df.inputFiles()))
        return states.feature_states(df, keys, "v")

    def refresh():
        return states.refresh(spark, source, path, make, lambda a, b: states.merge_features(a, b, keys))

    with pytest.raises(Exception):  # noqa: B017  no such folder
        refresh()
    spark.createDataFrame([*rows(900, 0), ("only first", 4.0)], FEATURES).coalesce(2).write.parquet(source)
    refresh()
    spark.createDataFrame([*rows(700, 5e5), ("only last", 2.0)], FEATURES).coalesce(1).write.mode("append").parquet(source)
    kept = refresh()
    assert made == [2, 1] and refresh().count() == kept.count() and made == [2, 1]
    want = {r.g: tuple(r)[1:] for r in features.group_features(spark.read.parquet(source), keys, "v", True).collect()}
    for again in range(2):
        got = {r.g: tuple(r)[1:] for r in states.features_of(refresh(), keys, True).collect()}
        assert set(got) == set(want) and all(x == y or math.isclose(x, y, rel_tol=1e-9) for g in want for x, y in zip(got[g], want[g], strict=True))
        if not again:  # a file goes: all others are read anew
            gone = next(p for p in (tmp_path / "in").glob("*.parquet") if pq.read_table(p).num_rows == 701)
            gone.unlink()
            want = {r.g: tuple(r)[1:] for r in features.group_features(spark.read.parquet(source), keys, "v", True).collect()}
    assert made == [2, 1, 2]


def test_median_of_merged_sketches_is_within_its_bound(spark):
    x = np.random.default_rng(4).lognormal(1.5, 2.0, 40_000)
    parts = [spark.createDataFrame([("a", float(v)) for v in x[i::2]], FEATURES.replace("float", "double")) for i in (0, 1)]
    merged = states.merge_features(*(states.feature_states(p, ["g"], "v") for p in parts), ["g"])
    got = states.features_of(merged, ["g"], True).first()
    rank = (np.log1p(x) <= got.median_log1p).mean()
    assert abs(rank - 0.5) <= states.median_error() < 0.006 and got.sample_count == 40_000
    assert math.isclose(got.mean_log1p, np.log1p(x).mean()) and math.isclose(got.std_log1p, np.log1p(x).std())


def test_distinct_sketches_union_without_a_scan(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 20011 as a", "cast(id % 7 as string) as b", "cast(null as int) as c")
    df.repartition(5).write.parquet(f"{tmp_path}/in")
    make = lambda d: states.distinct_states(d, ["a", "b", "c"])
    kept = states.refresh(spark, f"{tmp_path}/in", f"{tmp_path}/s", make, lambda a, b: a.unionByName(b))
    spark.range(60_000, 60_000 + 500).selectExpr("id as a", "cast(id as string) as b", "1 as c").write.mode("append").parquet(f"{tmp_path}/in")
    kept = states.refresh(spark, f"{tmp_path}/in", f"{tmp_path}/s", make, lambda a, b: a.unionByName(b))
    files = {f.rsplit("/", 1)[1] for f in spark.read.parquet(f"{tmp_path}/in").inputFiles()}
    got = {r.column: r for r in states.distinct_estimates(kept).collect()}
    assert {r.file.rsplit("/", 1)[1] for r in kept.collect()} == files
    assert not any("/in/" in f for f in states.distinct_estimates(kept).inputFiles())
    for c, exact, known in (("a", 20_511, 60_500), ("b", 507, 60_500), ("c", 1, 500)):
        assert got[c].known == known and abs(got[c].estimate - exact) <= 0.033 * exact and got[c].least <= exact


def test_exact_distinct_counts_send_words_not_values(spark, tmp_path):
    """100,000 values of one file leave the tasks as some 1,600 words; with null, negative, repeated and text values."""
    df = spark.range(100_000, numPartitions=2).selectExpr("id - 50000 as a", "if(id % 3 = 0, null, cast(id % 1000 - 500 as int)) as `b.c`", "if(id < 9, concat('t', id div 2), null) as d", "cast(null as int) as e")
    df = df.unionByName(df.limit(500)).unionByName(spark.sql("select cast('-9223372036854775808' as bigint) a, -128 `b.c`, '' d, cast(null as int) e"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    back = spark.read.parquet(f"{tmp_path}/in")
    want = {c: back.select(F.count_distinct(f"`{c}`")).first()[0] for c in back.columns}
    assert {r.column: r.exact_count for r in states.exact_distincts(back, back.columns).collect()} == want
    kept = states.distinct_states(back, back.columns)
    assert {r.column: (r.known, r.in_file) for r in kept.collect()} == {c: (back.where(f"`{c}` is not null").count(), n) for c, n in want.items()}
    assert "Expand" not in kept._jdf.queryExecution().toString()
    words = states.exact_distinct(back, "a", [])
    words.collect()
    plan = words._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("hashpartitioning") == 1 and "__word" in plan.split("hashpartitioning")[1].split(")")[0]
    assert back.selectExpr("shiftright(a, 6) w").distinct().count() < 1_600


KEYS_DDL = "a string, b int"


@pytest.mark.parametrize(("n", "repeat"), [(0, 0), (1, 3), (4_000, 0), (4_000, 700), (10, 5_000)])
def test_duplicates_behind_a_filter(spark, n, repeat):
    rows = [(f"k{i}", i % 5) for i in range(n)] + [(f"k{i % 90}", 1) for i in range(repeat)] + [(None, 1), (None, 1), ("x", None), (None, None)]
    df = spark.createDataFrame(rows, KEYS_DDL).repartition(5)
    assert keysets.duplicates(df, ["a", "b"]).first() == profiling.duplicates(df, ["a", "b"]).first()


def test_a_unique_key_is_hardly_shuffled(spark):
    df = spark.range(0, 400_000, 1, 8).selectExpr("concat('a-key-of-some-length-', id) as k")
    parts = keysets.positions_of(df, ["k"], 400_000 * keysets.ROOM).select("__at").mapInArrow(keysets.filter_parts(400_000 * keysets.ROOM), "slot int, bits binary")
    sent = parts.agg(F.sum(F.octet_length("bits"))).first()[0]
    twice = parts.groupBy("slot").applyInArrow(keysets.hit_twice(400_000 * keysets.ROOM), "__at long").count()
    assert sent / 400_000 < 2.5 and twice < 1_000
    values = np.unique(np.random.default_rng(1).integers(0, 2**40, 1000))
    assert (keysets.unpacked(keysets.packed(values)) == values).all() and (keysets.unpacked(keysets.packed(np.zeros(1, np.int64))) == 0).all()


def test_overlaps_equal_semi_joins(spark):
    rng = np.random.default_rng(6)
    rows = [(f"g{rng.integers(5)}", int(k)) for k in rng.integers(0, 90_000, 60_000)] + [(None, 1), ("g0", None), ("alone", -5), ("g1", -5), ("alone", -5)]
    df = spark.createDataFrame(rows, "g string, k long")
    got = {(r.a, r.b): r.n for r in keysets.overlaps(df, "g", "k").collect()}
    names = sorted({r[0] for r in rows} - {None})
    for i, a in enumerate(names):
        for b in names[i:]:
            left, right = (df.where(F.col("g") == x).select("k") for x in (a, b))
            assert got.get((a, b), 0) == join.overlap(left, right, "k").where("k is not null").count()
    codes = keysets.coded(df, "k").orderBy("k").collect()
    assert [r.code for r in codes] == list(range(len({r[1] for r in rows} - {None})))
    assert keysets.overlaps(df.limit(0), "g", "k").count() == 0


def test_overlaps_of_many_groups_need_no_table_of_all_pairs(spark):
    """40,000 groups in one bucket of keys: a matrix of all of them would take 12.8 GB."""
    df = spark.range(80_000).selectExpr("id div 2 as g", "(id + 1) div 2 as k")
    got = keysets.overlaps(df, "g", "k")
    assert got.agg(F.expr("count_if(a = b and n = 2)"), F.expr("count_if(b = a + 1 and n = 1)"), F.count("n")).first() == (40_000, 39_999, 79_999)


@pytest.mark.parametrize("kind", ["string", "long"])
def test_overlaps_by_lists_equal_bitmaps(spark, monkeypatch, kind):
    """With few pairs a task, so that blocks are many, and a group of all keys and a key of all groups, so that some are split."""
    rng = np.random.default_rng(8)
    rows = [(int(g), int(k)) for g, k in rng.integers(0, (70, 900), (3_000, 2))] + [(0, k) for k in range(900)] + [(g, 17) for g in range(70)] + [(None, 1), (3, None), (5, 17), (5, 17)]
    df = spark.createDataFrame(rows, "g long, k long").select(F.col("g").cast(kind).alias("g"), F.when(F.col("k") == 1, float("nan")).otherwise(F.col("k")).alias("k"))
    rows = lambda: sorted(tuple(r) for r in keysets.overlaps(df, "g", "k").collect())
    want = rows()
    for name, value in (("DENSE", 0), ("PAIRS", 800), ("FLUSH", 400)):
        monkeypatch.setattr(keysets, name, value)
    jobs = []
    real = keysets.dealt
    monkeypatch.setattr(keysets, "dealt", lambda lists, width, split, heavy: jobs.append(split) or real(lists, width, split, heavy))
    for told in (keysets.TOLD, 0):
        monkeypatch.setattr(keysets, "TOLD", told)
        assert rows() == want and len(want) > 2_000
    assert max(jobs[0].values()) > 1 and len(jobs) == 4
    assert keysets.overlaps(df.limit(0), "g", "k").count() == 0


def test_publish_keeps_the_old_layer(spark, tmp_path):
    path, df = f"{tmp_path}/layer", spark.createDataFrame([("a", 1), ("01", 2)], "k string, v int")
    wider = spark.createDataFrame([], "v long, k string").schema
    assert sinks.publish(spark, df, path, "k", lambda d: None, spread=sinks.spread_for(df, "k"), schema=wider).schema["v"].dataType.simpleString() == "bigint"

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.publish(spark, df.limit(0), path, "k", refuse)
    assert {r.k for r in readers.layer(spark, path, ("k",)).collect()} == {"a", "01"}
    sinks.publish(spark, df.limit(1), path, "k", lambda d: None)
    assert readers.layer(spark, path, ("k",)).count() == 1 and sinks.is_complete(spark, path, 1)
    plain = f"{tmp_path}/plain"
    sinks.write_quarantine(df, f"{plain}.staged")
    sinks.replace_folder(spark, f"{plain}.staged", plain)
    with pytest.raises(OSError):
        sinks.replace_folder(spark, f"{tmp_path}/nothing", plain)
    assert spark.read.parquet(plain).count() == 2 and not (tmp_path / "plain.previous").exists()


@pytest.mark.parametrize("step", ["write", "check", "create", "half"])
def test_a_crash_leaves_the_old_layer_or_the_new(spark, tmp_path, monkeypatch, step):
    path, one = f"{tmp_path}/layer", spark.createDataFrame([("a", 1)], "k string, v int")
    two = one.unionAll(one)
    sinks.publish(spark, one, path, "k", lambda d: None)
    whole, write = versions.files.write_text, sinks.write_layer

    def crash(*_, **__):
        raise RuntimeError("crash")

    def half(session, file, text, replace=True):
        whole(session, file, text[: len(text) // 2], replace)
        crash()

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_layer", crash if step == "write" else write)
        m.setattr(versions.files, "write_text", crash if step == "create" else half if step == "half" else whole)
        with pytest.raises(RuntimeError):
            sinks.publish(spark, two, path, "k", crash if step == "check" else lambda d: None)
    assert readers.layer(spark, path, ("k",)).count() == 1
    sinks.publish(spark, two, path, "k", lambda d: None)
    assert readers.layer(spark, path, ("k",)).count() == 2
    assert versions.current(spark, path)["number"] == (3 if step == "half" else 2)
    assert len(versions.sweep(spark, path)) == (1 if step in ("create", "half") else 0) and readers.layer(spark, path, ("k",)).count() == 2


def test_concurrent_publishers(spark, tmp_path):
    path, one = f"{tmp_path}/layer", spark.createDataFrame([("a", 1)], "k string, v int")

    def meanwhile(_):
        sinks.publish(spark, one.unionAll(one), path, "k", lambda d: None)

    with pytest.raises(versions.Conflict):
        sinks.publish(spark, one, path, "k", meanwhile)
    assert readers.layer(spark, path, ("k",)).count() == 2
    with pytest.raises(versions.Conflict):  # both saw version 1, the other's pointer is there when this one creates its own
        versions.files.write_text(spark, versions.pointer(path, 2), "")
        monkey = pytest.MonkeyPatch()
        monkey.setattr(versions, "last_number", lambda *_: 1)
        try:
            versions.commit(spark, path, "x", 1)
        finally:
            monkey.undo()
    for n in (3, 4, 5):
        sinks.publish(spark, one, path, "k", lambda d: None)
        assert versions.current(spark, path)["number"] == n
    assert len(versions.files.names(spark, f"{path}.data")) == 3 and len(versions.sweep(spark, path)) == 1


def test_measures_come_from_the_write(spark, tmp_path, monkeypatch):
    rows = [("a", None, 0.0), ("a", "x", math.nan), ("b", "y", 3.0), (None, "z", None)] * 50
    df, keys = spark.createDataFrame(rows, "t string, g string, v double").repartition(7), ["g", "t"]
    want = metrics.silver(df, keys, "v", "t").first().asDict()
    for i, wrong in enumerate((False, True)):
        found = []
        with monkeypatch.context() as m:
            if wrong:  # what the write counted does not agree with the files: measured again
                m.setattr(sinks, "row_count", lambda *_: 1)
            else:  # else the layer is not read
                m.setattr(sinks, "layer", lambda *_, **__: None)
            sinks.publish(spark, df, f"{tmp_path}/l{i}", "t", found.append, spread=sinks.spread_for(df, "t", 60), measures=metrics.silver_measures(keys, "v"))
        assert metrics.with_share(found[0]) == want
    empty = []
    sinks.publish(spark, df.limit(0), f"{tmp_path}/empty", "t", empty.append, measures=metrics.silver_measures(keys, "v"))
    assert metrics.with_share(empty[0])["zero_fraction"] == 0.0 and empty[0]["row_count"] == 0 == empty[0]["group_count"]


def test_spread_makes_even_files(spark, tmp_path):
    sizes = {"huge": 40_000, "big": 21_000, "mid": 10_500, "small": 900, "one": 1}
    df = spark.createDataFrame([(k,) for k in sizes], "k string").select("k", F.explode(F.expr("sequence(1, " + "".join(f"if(k = '{k}', {n}, " for k, n in sizes.items()) + "0" + ")" * len(sizes) + ")")).alias("v"))
    spread = sinks.spread_for(df, "k", 5_000)
    assert spread == {"huge": 8, "big": 5, "mid": 3}
    for i in (0, 1):  # the same rows in the same parts each time
        sinks.write_layer(df, f"{tmp_path}/{i}", "k", spread=spread)
    files = [sorted((p.parent.name, pq.read_metadata(p).num_rows) for p in (tmp_path / str(i)).rglob("*.parquet")) for i in (0, 1)]
    assert files[0] == files[1] and spark.read.parquet(f"{tmp_path}/0").count() == sum(sizes.values())
    heavy = [n for k, n in files[0] if k[2:] in spread]
    assert len(heavy) == 16 and max(heavy) <= 2 * min(heavy) and len(files[0]) == 18


def test_footers_answer_like_a_scan(spark, tmp_path):
    import datetime

    day = datetime.date(2024, 2, 29)
    one = pa.table({"i": [2**60 + 1, None, -5], "f": [math.nan, 0.5, None], "s": ["a", None, "b"], "d": [day, None, day], "n": pa.nulls(3, pa.int32()), "l": [[1], None, []]})
    two = pa.table({"i": [7], "f": [2.5], "s": ["z"], "d": [None], "n": pa.array([4], pa.int32()), "l": [[3]]}, schema=one.schema)
    pq.write_table(one, tmp_path / "a.parquet", row_group_size=2)
    pq.write_table(two, tmp_path / "b b%20.parquet", write_statistics=False)
    got = {r.column: tuple(r)[1:] for r in footers.column_profile(spark, str(tmp_path)).collect()}
    assert got == {"i": (4, 1, "-5", str(2**60 + 1)), "f": (4, 1, "0.5", "2.5"), "s": (4, 1, None, None), "d": (4, 2, "2024-02-29", "2024-02-29"), "n": (4, 3, "4", "4"), "l": (4, 1, None, None)}
    assert footers.row_count(spark, str(tmp_path)) == 4
    groups = footers.footers(spark, str(tmp_path)).where("column is null").collect()
    assert sorted((r.row_group, r.rows) for r in groups) == [(0, 1), (0, 2), (1, 1)]


def test_footers_read_no_data_page(spark, tmp_path):
    """Every data page is destroyed; the footer still answers, a scan cannot."""
    file = tmp_path / "a.parquet"
    pq.write_table(pa.table({"i": list(range(10_000))}), file, compression="none", use_dictionary=False)
    raw = file.read_bytes()
    size = int.from_bytes(raw[-8:-4], "little") + 8
    file.write_bytes(raw[:4] + b"\xff" * (len(raw) - size - 4) + raw[-size:])
    assert footers.row_count(spark, str(tmp_path)) == 10_000 and sinks.is_complete(spark, str(tmp_path), 10_000)
    assert tuple(footers.column_profile(spark, str(tmp_path)).first()) == ("i", 10_000, 0, "0", "9999")
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(str(tmp_path)).agg(F.sum("i")).collect()


def test_copy_fails_on_another_size(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (tmp_path / "b.bin").write_bytes(b"123")
    with pytest.raises(OSError):
        sinks.copy_raw(spark, f"{tmp_path}/a.bin", f"{tmp_path}/b.bin")
    assert sinks.copy_raw(spark, f"{tmp_path}/none.bin", f"{tmp_path}/c.bin") == {} and sinks.copy_raw(spark, f"{tmp_path}/a.bin", f"{tmp_path}/d.bin")["bytes"] == 5


def test_object_store_settings(spark):
    readers.object_store(spark, "http://store", "k", "s")
    conf = spark._jsc.hadoopConfiguration()
    assert [conf.get(f"fs.s3a.{x}") for x in ("endpoint", "access.key", "path.style.access")] == ["http://store", "k", "true"]
    with pytest.raises(RuntimeError):
        quality.require_match(0)


def test_unpivot_keeps_nulls_and_both_forms_agree(spark):
    wide = spark.createDataFrame([("a", 1.0, None), ("b", 0.0, 2.0)], "id string, x double, y double")
    long = reshape.to_long(wide, ["id"], ["x", "y"])
    assert long.count() == 4 and long.where("tpm_value is null").count() == 1
    assert dict(long.dtypes)["tpm_value"] == "float"
    cols = [f"c{i}" for i in range(130)]
    many = spark.createDataFrame([(1, *map(float, range(130)))], "id int, " + ", ".join(f"{c} double" for c in cols))
    forms = [sorted(map(tuple, f.collect())) for f in (reshape.to_long(many, ["id"], cols), many.selectExpr("id", *(f"cast({c} as float) {c}" for c in cols)).unpivot(["id"], cols, "sample_id", "tpm_value"))]
    assert forms[0] == forms[1]


def test_wide_unpivot_by_record_batches(spark):
    """Over 1,000 columns in several slices, odd names, nulls, other types, null and repeated ids: as unpivot."""
    cols = [f"c{i}" for i in range(1_300)] + ["a.b", "tick`s", "Ümlaut x"]
    kinds = ["double" if i % 3 else "int" for i in range(len(cols))]
    rows = [(k, "x" * (k or 0), *((None if (i + (k or 0)) % 11 == 0 else i if i % 3 == 0 else i / 7) for i in range(len(cols)))) for k in (1, 2, 2, None)]
    wide = spark.createDataFrame(rows, "id int, tag string, " + ", ".join(f"{reshape.quoted(c)} {t}" for c, t in zip(cols, kinds, strict=True)))
    got = reshape.to_long(wide, ["id", "tag"], cols, width=500)
    want = wide.selectExpr("id", "tag", *(f"cast({reshape.quoted(c)} as float) as {reshape.quoted(c)}" for c in cols)).unpivot(["id", "tag"], [reshape.quoted(c) for c in cols], "sample_id", "tpm_value")
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert reshape.to_long(wide.limit(0), ["id"], cols).count() == 0
    some = reshape.to_long(wide, ["id"], cols[:200])
    assert some.columns == ["id", "sample_id", "tpm_value"] and some.count() == 800


def test_matrix_of_20000_columns(spark, tmp_path):
    """Written, read and made long: one node of the plan for each slice, its own columns only in its scan."""
    rng = np.random.default_rng(5)
    data = rng.random((30, 20_000)).astype(np.float32) * (rng.random((30, 20_000)) > 0.5)
    names = [f"s{i}" for i in range(20_000)]
    pq.write_table(pa.table({"Name": [f"g{i}" for i in range(30)], **dict(zip(names, data.T, strict=True))}), tmp_path / "wide.parquet", row_group_size=10)
    wide = spark.read.parquet(f"{tmp_path}/wide.parquet")
    began = time.perf_counter()
    long = reshape.to_long(wide, ["Name"], readers.value_columns(wide, ["Name"]))
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - began < 30  # some 4 s on a free machine
    assert plan.count("MapInArrow") == 20_000 // reshape.SLICE == plan.count("FileScan parquet")
    r = long.agg(F.count("*").alias("n"), F.sum(F.col("tpm_value").cast("double")).alias("s"), F.count_if(F.col("tpm_value") == 0).alias("z"), F.count_distinct("sample_id").alias("k")).first()
    assert (r.n, r.z, r.k) == (600_000, int((data == 0).sum()), 20_000) and math.isclose(r.s, data.sum(dtype=np.float64))


def test_attach_routes_everything(spark):
    facts = spark.createDataFrame([("s1", 1), ("s2", 2), (None, 3)], "sample_id string, v int")
    dim = spark.createDataFrame([("s1", "Liver")], "sample_id string, tissue_id string")
    matched, lost = join.attach(facts, dim, "sample_id")
    assert matched.count() == 1 and lost.count() == 2 and {r.reason for r in lost.collect()} == {"no_tissue_match"}
    assert {r.tissue_id for r in join.lookup(facts, dim, "sample_id", "tissue_id", "unknown").collect()} == {"Liver", "unknown"}


def test_dimension_rules(spark, tmp_path):
    p = tmp_path / "d.tsv"
    p.write_text('SAMPID\tX\tSMTSD\ns1\t.\tLiver\ns1\t.\t \ns1\t.\t Blood \ns2\t.\ns3\t.\t"Q" A\ns4\t.\t\n')
    got = dict(map(tuple, readers.dimension(spark, str(p), "SAMPID", "SMTSD").collect()))
    assert got == {"s1": "Blood", "s3": '"Q" A'}
    with pytest.raises(KeyError):
        readers.dimension(spark, str(p), "SAMPID", "NOPE")


def test_dimension_as_a_format(spark, tmp_path, monkeypatch):
    folder = tmp_path / "dims"
    folder.mkdir()
    (folder / "a.tsv").write_text('SAMPID\tX\tSMTSD\ns1\t.\tLiver\ns1\t.\t \ns1\t.\t Blood \ns2\t.\ns3\t.\t"Q" A\ns4\t.\t\n')
    (folder / "b.tsv").write_text("SAMPID\tX\tSMTSD\ns5\t.\tÄ\ns3\t.\tlate\n" + "".join(f"n{i}\t.\tt{i % 3}\n" for i in range(500)))
    formats.register(spark)
    for size in (1 << 20, 1_000):  # one partition, several
        monkeypatch.setattr(formats, "PART", size)
        reader = formats.DimensionReader(str(folder), "SAMPID", "SMTSD")
        assert sorted(r for p in reader.partitions() for r in reader.read(p)) == sorted(map(tuple, readers.dimension(spark, str(folder), "SAMPID", "SMTSD").collect()))
    dim = spark.read.format("tsv_dimension").option("key", "SAMPID").option("value", "SMTSD").load(str(folder))
    assert sorted(map(tuple, dim.collect())) == sorted(map(tuple, readers.dimension(spark, str(folder), "SAMPID", "SMTSD").collect()))
    assert {tuple(r) for r in dim.where("SAMPID in ('s1', 's3', 'no')").collect()} == {("s1", "Blood"), ("s3", "late")}
    assert {tuple(r) for r in dim.where("SAMPID = 's1' and SMTSD = 'x'").collect()} == set()
    with pytest.raises(KeyError):
        formats.DimensionReader(str(folder), "SAMPID", "NOPE")


def test_matrix_as_a_format(spark, tmp_path):
    rng = np.random.default_rng(9)
    cells = {f"s{i}": pa.array([None if rng.random() < 0.1 else float(v) for v in rng.random(40)], pa.float64()) for i in range(130)}
    whole = pa.table({"Name": [f"g{i % 30}" for i in range(40)], "Description": [None if i % 7 == 0 else f"d{i}" for i in range(40)], **cells})
    (tmp_path / "m").mkdir()
    pq.write_table(whole, tmp_path / "m" / "a.parquet", row_group_size=15)
    pq.write_table(whole.slice(0, 3), tmp_path / "m" / "b.parquet")
    formats.register(spark)
    long = spark.read.format("wide_matrix").option("width", "50").load(str(tmp_path / "m"))
    wide = spark.read.parquet(str(tmp_path / "m"))
    want = reshape.to_long(wide, ["Name", "Description"], readers.value_columns(wide, ["Name", "Description"]))
    assert sorted(map(str, long.collect())) == sorted(map(str, want.collect())) and long.rdd.getNumPartitions() == 4 * 3
    some = "sample_id in ('s3', 's77', 'none') and Name = 'g4' and tpm_value > 0.2"
    assert sorted(map(str, long.where(some).collect())) == sorted(map(str, want.where(some).collect()))
    assert long.where("sample_id = 's3'").rdd.getNumPartitions() == 4 and long.where("sample_id = 'none'").count() == 0


def test_checks():
    q = quality
    assert q.quarantine(1, 100).passed and not q.quarantine(2, 100).passed and q.quarantine(0, 0).passed
    assert q.bronze_report(0, 74_628, 0, 74_628).passed
    m = {"nulls_g": 0, "row_count": 74_628 * 19_788, "zero_fraction": 0.5189}
    assert q.silver_report(m, ["g"], 0, 74_628, 19_788).passed
    short = q.silver_report(m | {"row_count": m["row_count"] - 37}, ["g"], 0, 74_628, 19_788)
    assert [c.name for c in short.failures] == ["lineage_closure"]
    g = {"nulls_g": 0, "row_count": 74_628 * 68, "group_count": 68, "min_sample_count": 5, "mean_zero_fraction": 0.5252}
    assert q.gold_report(g, ["g"], 74_628, 68).passed
    assert [c.name for c in q.gold_report(g | {"row_count": g["row_count"] - 11}, ["g"], 74_628, 68).failures] == ["gold_row_count"]
    only_warning = q.Report("x", [q.near("z", 0.9, 0.5)])
    assert only_warning.passed and only_warning.failures and q.Report("x").passed
    with pytest.raises(q.QualityError):
        q.gate(q.Report("x", [q.row_count(1, 2)]))
    assert q.valid_mapping(0)[0] is False and q.valid_mapping(100)[0] and not q.valid_mapping(99)[0]
    assert json.dumps(only_warning.to_dict()) and only_warning.summary().startswith("x: PASS")


def test_profiles(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", None), ("b", -0.0), (None, math.nan)], "k string, v double")
    r = profiling.null_zero(df, ["v"]).first()
    assert (r.nulls, r.zeros, r.verdict) == (1, 2, "review")
    assert profiling.skew(df, "k").first().ratio == 2.0 and profiling.duplicates(df, ["k"]).first().duplicates == 1
    assert profiling.sample_columns([str(i) for i in range(300)]) == profiling.sample_columns([str(i) for i in range(300)])
    assert metrics.silver(df, ["k"], "v", "k").first().nan_value == 1
    assert profiling.skew(df.limit(0), "k").first().ratio == 999.0


def test_mapping_rule_is_one(spark):
    sizes = spark.createDataFrame([(n,) for n in (0, 1, 99, 100, 5_000)], "n int")
    for least in (100, 1, 0):
        assert [(r.ok, r.message) for r in quality.mapping_checks(sizes, "n", least).orderBy("n").collect()] == [quality.valid_mapping(n, least) for n in (0, 1, 99, 100, 5_000)]


def test_session_is_built_from_a_preset():
    """In a process of its own: a session of the mode, the memory and the preset."""
    code = "from strataflow import session as s; p = s.preset_named('BALANCED'); b = s.build('local', '1g', p, {'spark.ui.enabled': 'false'}); print('CONF', all(b.conf.get(k) == v for k, v in p.conf().items()), b.conf.get('spark.driver.memory'), b.conf.get('spark.ui.enabled'), b.range(5).count()); b.stop()"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout
    assert said.strip().endswith("CONF True 1g false 5")


def test_layers_in_a_store_that_only_spark_reads(spark, tmp_path):
    """A mounted store, as an object store is: read, written, published and copied by its own path."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shop.link./in", f"file://{tmp_path}")
    at, df = "viewfs://shop/in", spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    found = []
    sinks.publish(spark, df, f"{at}/layer", "k", found.append, measures=[F.sum("v").alias("s")])
    assert found == [{"row_count": 3, "s": 6, "group_count": 2}] and readers.layer(spark, f"{at}/layer", ("k",)).count() == 3
    assert sinks.is_complete(spark, f"{at}/layer", 3) and not sinks.is_complete(spark, f"{at}/none", 3)
    df.coalesce(1).write.parquet(f"{at}/raw")
    assert {r.column: r.high for r in footers.column_profile(spark, f"{at}/raw").collect()} == {"k": None, "v": "3"}
    assert sinks.copy_raw(spark, f"{at}/raw", f"{at}/copy")["bytes"] > 0 and spark.read.parquet(f"{at}/copy").count() == 3
    sinks.save_json(spark, {"é": 1}, f"{at}/x.json")
    assert readers.json_document(spark, f"{at}/x.json") == {"é": 1}
    kept = states.refresh(spark, f"{at}/raw", f"{at}/states", lambda d: states.feature_states(d, ["k"], "v"), lambda a, b: states.merge_features(a, b, ["k"]))
    assert kept.count() == 2


def test_session_presets():
    assert [session.preset_for(x).name for x in (1, 4, 16, 64)] == ["SURVIVAL", "BALANCED", "PERFORMANCE", "PRO"]
    assert session.downgrade(session.preset_named("pro")).name == "PERFORMANCE" and session.downgrade(session.preset_named("survival")) is None
    assert session.parse_memory("512m") == 0.5 and session.parse_memory("4g") == 4
    facts = {"total": 1, "available": 2, "cores": 3}
    assert session.fingerprint(facts) == session.fingerprint(facts | {"available": 9})
    for mode in ("local", "yarn", "k8s"):
        assert session.mode_conf(mode, 8, 4)["spark.sql.shuffle.partitions"] == ("6" if mode == "local" else "12")
    with pytest.raises(ValueError):
        session.mode_conf("mesos", 8, 4)
    with pytest.raises(ValueError):
        session.preset_named("none")
    assert session.preset_for(4).static_conf().keys().isdisjoint(session.preset_for(4).dynamic_conf())


def test_lineage():
    assert lineage.closure(3, 4, 10, 2)["closes"] and lineage.closure(3, 4, 10, 1)["delta"] == -1
    assert lineage.chain("d", {}, {"silver": None, "gold": None})["layers_complete"] == "0/2"


def fixture(spark, tmp_path, missing=False):
    wide = spark.createDataFrame([("g1", "A|x", 1.0, 0.0, 3.0), ("g2", "B", 0.0, 5.0, 0.0)], "Name string, Description string, s1 float, s2 float, s3 float")
    src, tsv = f"{tmp_path}/src.parquet", tmp_path / "m.tsv"
    wide.coalesce(1).write.mode("overwrite").parquet(src)
    tsv.write_text("SAMPID\tSMTSD\ns1\t01\ns2\tLiver - Portal/Tract\n" + ("" if missing else "s3\t01\n"))
    return src, str(tsv)


def test_pipeline_end_to_end(spark, tmp_path):
    src, tsv = fixture(spark, tmp_path)
    line = pipeline.run(spark, src, tsv, f"{tmp_path}/out", tolerance=0.5, least_samples=1)
    assert line["status"] == "complete" and line["silver"]["lineage_closure"]["closes"]
    gold = {(r.gene_id, r.tissue_id): r for r in readers.layer(spark, f"{tmp_path}/out/gold").collect()}
    assert set(gold) == {(g, t) for g in ("g1", "g2") for t in ("01", "Liver - Portal/Tract")} and gold["g1", "01"].sample_count == 2
    assert gold["g1", "01"].gene_symbol == "A|x" and gold["g1", "Liver - Portal/Tract"].std_log1p_tpm is None
    assert readers.json_document(spark, f"{tmp_path}/out/lineage/pipeline.json")["status"] == "complete"
    assert readers.json_document(spark, f"{tmp_path}/none.json") == {}
    again = pipeline.run(spark, src, tsv, f"{tmp_path}/out", tolerance=0.5, least_samples=1)
    assert again["silver"]["output"]["row_count"] == line["silver"]["output"]["row_count"]
    assert sinks.is_complete(spark, f"{tmp_path}/out/silver", 6) and not sinks.is_complete(spark, f"{tmp_path}/nowhere", 1)


def test_gate_publishes_nothing(spark, tmp_path):
    src, tsv = fixture(spark, tmp_path, missing=True)
    with pytest.raises(quality.QualityError):
        pipeline.run(spark, src, tsv, f"{tmp_path}/out", least_samples=1)
    assert not (tmp_path / "out" / "silver").exists() and not (tmp_path / "out" / "quarantine").exists()
    assert spark.read.parquet(f"{tmp_path}/out/staged/quarantine").count() == 2
    with pytest.raises(ValueError):
        pipeline.run(spark, src, tsv, f"{tmp_path}/out1")
    with pytest.raises(quality.QualityError):
        pipeline.run(spark, src, tsv, f"{tmp_path}/out3", least_samples=1, expected_rows=3)
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, f"{tmp_path}/nothing", tsv, f"{tmp_path}/out2")


def test_stream_and_generated_matrix(spark, tmp_path):
    wide = readers.synthetic_matrix(spark, 5, 4)
    dim = readers.synthetic_dimension(spark, 4, {"Blood": 3, "Liver": 1})
    assert dim.groupBy("tissue_id").count().count() == 2
    wide.write.parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds no new file
        stream_silver(spark, f"{tmp_path}/in", wide.schema, dim, f"{tmp_path}/silver", f"{tmp_path}/q", f"{tmp_path}/ck").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/silver").count() == 20


def test_entry_imports_without_extras():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
