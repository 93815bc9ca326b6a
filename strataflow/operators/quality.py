"""Quality checks: predicates over metrics, reports, and the gate."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Severities, and below the names, limits and baselines of the checks and the fields of their records,
#: which readers of the reports look up.
CRITICAL, WARNING = "critical", "warning"


@dataclass(frozen=True)
class Check:
    name: str
    passed: bool
    severity: str
    expected: str
    actual: str
    detail: str = ""

    def summary(self) -> str:
        return f"[{'PASS' if self.passed else 'FAIL'}] {self.name} ({self.severity}): expected {self.expected}, got {self.actual}"


@dataclass
class Report:
    layer: str
    checks: list[Check] = field(default_factory=list)
    run_at_utc: str = field(default_factory=lambda: datetime.now(UTC).isoformat())

    @property
    def passed(self) -> bool:
        """Warnings never block; an empty report passes."""
        return all(c.passed for c in self.checks if c.severity == CRITICAL)

    @property
    def failures(self) -> list[Check]:
        return [c for c in self.checks if not c.passed]

    def to_dict(self) -> dict:
        return {"layer": self.layer, "passed": self.passed, "run_at_utc": self.run_at_utc, "checks": [asdict(c) for c in self.checks]}

    def summary(self) -> str:
        return "\n".join([f"{self.layer}: {'PASS' if self.passed else 'FAIL'}", *(c.summary() for c in self.checks)])


class QualityError(RuntimeError):
    def __init__(self, report: Report):
        super().__init__(report.summary())
        self.report = report


def gate(report: Report) -> Report:
    """The report, or an error if a critical check failed."""
    if not report.passed:
        raise QualityError(report)
    return report


def equals(name: str, actual: int, expected: int, severity: str = CRITICAL) -> Check:
    return Check(name, actual == expected, severity, f"{expected:,}", f"{actual:,}", f"difference {actual - expected:,}")


def row_count(actual: int, expected: int) -> Check:
    return equals("row_count", actual, expected)


def nulls(count: int, column: str, allowed: int = 0) -> Check:
    return Check(f"nulls_{column}", count <= allowed, CRITICAL, f"<= {allowed:,}", f"{count:,}")


def no_duplicates(count: int, index: str) -> Check:
    return equals(f"duplicates_{index}", count, 0)


def quarantine(count: int, total: int, most: float = 0.01) -> Check:
    part = count / total if total else 0.0
    return Check("quarantine_threshold", part <= most, CRITICAL, f"<= {most:.2%}", f"{part:.4%}", f"{count:,} of {total:,}")


def near(name: str, actual: float, baseline: float, tolerance: float = 0.05) -> Check:
    """A warning outside baseline +- tolerance, ends included."""
    ok = baseline - tolerance <= actual <= baseline + tolerance
    return Check(name, ok, WARNING, f"{baseline:.4f} +- {tolerance:.4f}", f"{actual:.4f}")


def closes(silver: int, quarantined: int, rows: int, columns: int) -> Check:
    return equals("lineage_closure", silver + quarantined, rows * columns)


def at_least(name: str, actual: int | None, least: int) -> Check:
    return Check(name, actual is not None and actual >= least, CRITICAL, f">= {least:,}", str(actual))


def bronze_report(duplicates: int, rows: int, description_nulls: int, expected_rows: int, index: str = "Name", allowed_nulls: int = 0) -> Report:
    return Report("bronze", [row_count(rows, expected_rows), no_duplicates(duplicates, index), nulls(description_nulls, "Description", allowed_nulls)])


def silver_report(m: dict, keys: list[str], quarantined: int, rows: int, columns: int, baseline: float = 0.5189, tolerance: float = 0.05, most_quarantined: float = 0.01) -> Report:
    return Report("silver", [*(nulls(m[f"nulls_{k}"], k) for k in keys), quarantine(quarantined, m["row_count"] + quarantined, most_quarantined), closes(m["row_count"], quarantined, rows, columns), near("zero_fraction", m["zero_fraction"], baseline, tolerance)])


def gold_report(m: dict, keys: list[str], entities: int, groups: int, baseline: float = 0.5252, tolerance: float = 0.05) -> Report:
    return Report("gold", [*(nulls(m[f"nulls_{k}"], k) for k in keys), equals("gold_row_count", m["row_count"], entities * groups), equals("gold_tissue_count", m["group_count"], groups), at_least("gold_min_sample_count", m["min_sample_count"], 1), near("gold_zero_fraction_consistency", m["mean_zero_fraction"] or 0.0, baseline, tolerance)])


#: What is said of an empty, a small and a large enough mapping; the numbers are its size and the least one.
MAPPING = ("the mapping is empty", "%1$d samples, %2$d are needed", "%1$d samples")


def valid_mapping(size: int, least: int = 100) -> tuple[bool, str]:
    said = MAPPING[0 if size == 0 else 1 if size < least else 2]
    return size >= max(least, 1), said.replace("%1$d", str(size)).replace("%2$d", str(least))


def mapping_checks(sizes: DataFrame, size: str, least: int = 100) -> DataFrame:
    """sizes with ok and message, by the rule of valid_mapping()."""
    n = F.col(size)
    said = [F.format_string(text, n, F.lit(least)) for text in MAPPING]
    return sizes.withColumn("ok", n >= max(least, 1)).withColumn("message", F.when(n == 0, said[0]).when(n < least, said[1]).otherwise(said[2]))


def require_mapping(size: int, least: int = 100) -> None:
    """Raises unless a dimension of so many keys is large enough."""
    ok, message = valid_mapping(size, least)
    if not ok:
        raise ValueError(message)


def require_match(matched: int) -> None:
    if matched == 0:
        raise RuntimeError("no sample matches the dimension")
