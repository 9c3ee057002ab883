"""Logs to a stored evaluation set; judged results to a quality report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from corpusmill.constants import IMPROVE_GENERATION, IMPROVE_RETRIEVAL, REPORT_COLUMNS
from corpusmill.operators.evalset import SAVED_COLUMNS, potential_evaluation_set
from corpusmill.operators.quality import (
    WITHOUT_TRUTH,
    Rule,
    classify,
    frequencies,
    issue_report,
    summary_metrics,
)
from corpusmill.session import spill
from corpusmill.sources.tables import overwrite_table


@dataclass(frozen=True)
class QualityReport:
    labelled: DataFrame
    summary: DataFrame
    root_causes: DataFrame
    rationales: DataFrame
    retrieval_issues: DataFrame
    generation_issues: DataFrame


def save_evaluation_set(
    request_log: DataFrame, assessment_log: DataFrame, table: str, fmt: str = "parquet", path: str | None = None
) -> DataFrame:
    """Build the evaluation set, replace ``table`` by it, return the stored rows."""
    rows = potential_evaluation_set(request_log, assessment_log).select(*SAVED_COLUMNS)
    return overwrite_table(rows, table, fmt, path)


def quality_report(
    results: DataFrame, rules: Sequence[Rule] = WITHOUT_TRUTH, columns: Sequence[str] = REPORT_COLUMNS
) -> QualityReport:
    """Label the results once, store them, and derive all parts of the report from that."""
    labelled = spill(classify(results, rules))
    return QualityReport(
        labelled,
        summary_metrics(labelled),
        frequencies(labelled, "root_cause"),
        frequencies(labelled, "rationale"),
        issue_report(labelled, IMPROVE_RETRIEVAL, columns),
        issue_report(labelled, IMPROVE_GENERATION, columns),
    )
