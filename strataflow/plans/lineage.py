"""Documents that say what a layer was made from, derived from its metrics and its report."""

from __future__ import annotations

from datetime import UTC, datetime

from strataflow.operators.quality import Report


def closure(rows: int, columns: int, matched: int, unmatched: int) -> dict:
    """Whether matched and unmatched cells make up rows times columns."""
    expected, actual = rows * columns, matched + unmatched
    return {"expected_total": expected, "actual_total": actual, "delta": actual - expected, "closes": actual == expected}


def document(layer: str, source: dict, output: dict, report: Report, steps: list[str], **more: object) -> dict:
    """The document of one layer. The keys, which readers of the documents look up."""
    return {"layer": layer, "generated_at_utc": datetime.now(UTC).isoformat(), "source": source, "output": output, "transformations": steps, "quality_report": report.to_dict(), **more}


def chain(dataset: str, raw: dict, layers: dict[str, dict | None]) -> dict:
    """The document of a whole run: complete if every layer is there."""
    done = sum(x is not None for x in layers.values())
    return {"dataset": dataset, "generated_at_utc": datetime.now(UTC).isoformat(), "status": "complete" if done == len(layers) else "in_progress", "layers_complete": f"{done}/{len(layers)}", "bronze": raw, **{k: x or {"status": "pending"} for k, x in layers.items()}}
