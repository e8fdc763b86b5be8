"""Configured reports: sums of some fields (dice) by some others (slice)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.names import quoted, require_columns
from ledgerleaf.scratch import settle
from ledgerleaf.sources.csv import write_csv


@dataclass(frozen=True)
class Report:
    slice: tuple[str, ...]
    dice: tuple[str, ...]
    output_path: str | None = None

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> Report:
        return cls(tuple(raw["slice"]), tuple(raw["dice"]), raw.get("output_path"))


def reports_from(config: dict[str, Any]) -> list[Report]:
    return [Report.from_dict(raw) for raw in config["queries"]]


def _sums(df: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    require_columns(df, [*by, *fields])
    return df.groupBy(*[quoted(c) for c in by]).agg(*[F.sum(quoted(c)).alias(c) for c in fields])


def slice_and_dice(df: DataFrame, report: Report, where: Column | None = None) -> DataFrame:
    """One report, in the order of its slice fields."""
    rows = df if where is None else df.where(where)
    return _sums(rows, list(report.slice), list(report.dice)).orderBy(
        *[quoted(c) for c in report.slice]
    )


def all_reports(
    df: DataFrame, reports: list[Report], where: Column | None = None
) -> list[DataFrame]:
    """All reports, reading ``df`` once per family of nested slices.

    A report whose slice fields are among those of a finer report is added up
    from the finer report's groups, which are stored in the shared folder.
    """
    rows = df if where is None else df.where(where)
    slices = {frozenset(r.slice) for r in reports}
    finest = [s for s in slices if not any(s < other for other in slices)]
    bases: dict[frozenset, DataFrame] = {}
    results = []
    for report in reports:
        base = next(s for s in finest if frozenset(report.slice) <= s)
        if base not in bases:
            fields = sorted({d for r in reports if frozenset(r.slice) <= base for d in r.dice})
            bases[base] = settle(_sums(rows, sorted(base), fields), "report-base")
        results.append(slice_and_dice(bases[base], report))
    return results


def write_reports(df: DataFrame, reports: list[Report], where: Column | None = None) -> None:
    """Write every report as CSV to its ``output_path``."""
    for report, result in zip(reports, all_reports(df, reports, where), strict=True):
        if report.output_path is None:
            raise ValueError(f"report by {report.slice} has no output_path")
        write_csv(result, report.output_path)
