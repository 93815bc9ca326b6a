"""The layers: raw copy, long form with quarantine, features. Each is checked before it is published."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strataflow import session
from strataflow.operators import join, metrics, quality
from strataflow.operators.features import group_features
from strataflow.operators.profiling import duplicates
from strataflow.operators.reshape import to_long
from strataflow.plans import lineage
from strataflow.sources import readers, sinks
from strataflow.sources.footers import row_count

IDS = ["gene_id", "gene_symbol"]
KEYS = [*IDS, "tissue_id"]
NAMES = {"mean_log1p": "mean_log1p_tpm", "std_log1p": "std_log1p_tpm", "median_log1p": "median_log1p_tpm"}
LONG = [*IDS, "sample_id", "tpm_value"]
#: The schemas of the layers.
SILVER = "gene_id string, gene_symbol string, sample_id string, tpm_value float, tissue_id string"
GOLD = "gene_id string, gene_symbol string, tissue_id string, mean_log1p_tpm float, std_log1p_tpm float, median_log1p_tpm float, sample_count int, zero_fraction float"


@dataclass(frozen=True)
class Layout:
    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def tagged_long(wide: DataFrame, dim: DataFrame, measured: bool = False) -> DataFrame:
    """The long rows of a matrix with Name, Description and one column per sample, with tissue_id and matched; measured
    as in join.tagged()."""
    named = wide.withColumnsRenamed({"Name": "gene_id", "Description": "gene_symbol"})
    return join.tagged(to_long(named, IDS, readers.value_columns(named, IDS)), dim, "sample_id", measured)


def long_form(wide: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine), two views of tagged_long()."""
    return join.split(tagged_long(wide, dim), LONG)


#: Rows of a group from which its median is bracketed first, so that its buffer stays bounded.
LARGE_GROUP = 1_000_000


def summary(silver: DataFrame, largest: int = 0) -> DataFrame:
    """Features; largest is the number of rows that a group may have."""
    return group_features(silver, KEYS, "tpm_value", large_groups=largest > LARGE_GROUP).withColumnsRenamed(NAMES)


def schema(spark: SparkSession, text: str):
    return spark.createDataFrame([], text).schema


def run(spark: SparkSession, source: str, dimension_tsv: str, out: str, key: str = "SAMPID", value: str = "SMTSD", zero_baseline: float = 0.5189, tolerance: float = 0.05, most_quarantined: float = 0.01, least_samples: int = 100, expected_rows: int | None = None) -> dict:
    """Runs all layers and returns the pipeline's lineage. A failed critical check raises and publishes nothing, the
    quarantine neither. A scan of the raw copy must find expected_rows rows, or as many as the footers of the source say."""
    at, infra = Layout(out), {"infra_fingerprint": session.fingerprint(session.machine())}
    bronze = sinks.copy_raw(spark, source, at.bronze)
    if not bronze:
        raise FileNotFoundError(source)
    wide = spark.read.parquet(at.bronze)
    samples = readers.value_columns(wide, ["Name", "Description"])
    expected = row_count(spark, source) if expected_rows is None else expected_rows
    dup = duplicates(wide, ["Name"]).first()
    rows = dup["total"]
    quality.gate(quality.bronze_report(dup["duplicates"], rows, wide.where("Description is null").count(), expected))

    began = time.time()
    dim = readers.dimension(spark, dimension_tsv, key, value).withColumnsRenamed({key: "sample_id", value: "tissue_id"})
    quality.require_mapping(dim.count(), least_samples)
    # The unpivot and its join run once; silver and quarantine both read what was written.
    both = sinks.write_once(spark, tagged_long(wide, dim), f"{at.staged}/long")
    silver, unmatched = join.split(both, LONG)
    sinks.write_quarantine(unmatched, f"{at.staged}/quarantine")
    lost = spark.read.parquet(f"{at.staged}/quarantine").count()
    found: dict = {}

    def check_silver(measures: dict) -> None:
        m = found["silver"] = metrics.with_share(measures)
        quality.require_match(m["row_count"])
        found["silver_report"] = quality.gate(quality.silver_report(m, KEYS, lost, rows, len(samples), zero_baseline, tolerance, most_quarantined))

    spread = sinks.spread_for(silver, "tissue_id")
    silver = sinks.publish(spark, silver, at.silver, "tissue_id", check_silver, spread=spread, schema=schema(spark, SILVER), measures=metrics.silver_measures(KEYS, "tpm_value"))
    sinks.replace_folder(spark, f"{at.staged}/quarantine", at.quarantine)
    m = found["silver"]
    s_line = lineage.document("silver", bronze, {"path": at.silver, "partition_col": "tissue_id", "row_count": m["row_count"], "tissue_count": m["group_count"], "quarantine_count": lost, "quarantine_path": at.quarantine}, found["silver_report"], ["unpivot", "attach tissue", "cast to float", "route unmatched"], lineage_closure=lineage.closure(rows, len(samples), m["row_count"], lost), duration_seconds=time.time() - began, **infra)
    sinks.save_json(spark, s_line, f"{at.lineage}/silver.json")

    began = time.time()
    entities = silver.select(*IDS).distinct().count()

    def check_gold(g: dict) -> None:
        found["gold"] = g
        # Features must agree with the share of zeros that silver has, not with the one expected of the source.
        found["gold_report"] = quality.gate(quality.gold_report(g, KEYS, entities, m["group_count"], m["zero_fraction"], tolerance))

    # One entity's rows in a tissue: its samples, unless names repeat.
    largest = (dim.groupBy("tissue_id").count().agg({"count": "max"}).first()[0] or 0) * -(-rows // max(entities, 1))
    sinks.publish(spark, summary(silver, largest), at.gold, "tissue_id", check_gold, "zstd", schema=schema(spark, GOLD), measures=metrics.gold_measures(KEYS))
    g = found["gold"]
    g_line = lineage.document("gold", s_line["output"], {"path": at.gold, "partition_col": "tissue_id", "row_count": g["row_count"], "tissue_count": g["group_count"]}, found["gold_report"], ["group features of log1p"], duration_seconds=time.time() - began, **infra)
    sinks.save_json(spark, g_line, f"{at.lineage}/gold.json")
    whole = lineage.chain(source, bronze, {"silver": s_line, "gold": g_line})
    sinks.save_json(spark, whole, f"{at.lineage}/pipeline.json")
    return whole
