"""Retrieval metrics, root-cause labels, their frequencies, and detail reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import (
    PRECISION_CUT,
    REPORT_COLUMNS,
    REPORT_NAMES,
    RULES_WITH_TRUTH,
    RULES_WITHOUT_TRUTH,
)


MAX_CASES = 10_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- metrics ---------------------------------------------------------------------------


def chunk_precision(ratings: Column | str) -> Column:
    """Share of ``yes`` among the chunk ratings of a request; NULL without ratings."""
    ratings = _col(ratings)
    n = F.when(F.size(ratings) > 0, F.size(ratings))
    return F.size(F.filter(ratings, lambda r: r == "yes")) / n


def document_hits(expected: Column | str, retrieved: Column | str) -> Column:
    """Number of distinct expected documents among the retrieved ones."""
    return F.size(F.array_intersect(_col(expected), _col(retrieved)))


def document_recall(expected: Column | str, retrieved: Column | str) -> Column:
    """Distinct hits over distinct expected documents; NULL when none is expected."""
    n = F.size(F.array_distinct(_col(expected)))
    return document_hits(expected, retrieved) / F.when(n > 0, n)


def document_precision(expected: Column | str, retrieved: Column | str) -> Column:
    """Distinct hits over distinct retrieved documents; NULL when none is expected."""
    n = F.size(F.array_distinct(_col(retrieved)))
    return document_hits(expected, retrieved) / F.when((F.size(_col(expected)) > 0) & (n > 0), n)


def summary_metrics(results: DataFrame, ratings: Sequence[str] = ("groundedness", "relevance", "correctness")) -> DataFrame:
    """One row over all results: counts, mean precision, share of ``yes`` per rating."""

    def share(name: str) -> Column:
        yes = F.count(F.when(F.col(name) == "yes", 1))
        return F.round(100.0 * yes / F.nullif(F.count(name), F.lit(0)), 6).alias(f"pct_{name}")

    return results.agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count(F.nanvl("precision", F.lit(None))).alias("n_precision"),
        F.round(F.avg(F.nanvl("precision", F.lit(None))), 6).alias("avg_precision"),
        *[share(r) for r in ratings],
    )


# --- classification --------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Conditions that must all hold, and the label given then.

    ``side`` is ``low`` (precision below the cut), ``high``, or None; ``ratings`` maps
    rating columns to the value they must have.
    """

    side: str | None
    ratings: Mapping[str, str]
    root_cause: str
    assessment: str
    rationale: str

    def holds(self, cell: Mapping[str, str | None]) -> bool:
        """Whether the rule matches a case: ``side`` and the ratings, None for unknown."""
        return (self.side is None or self.side == cell["side"]) and all(cell[c] == v for c, v in self.ratings.items())


WITHOUT_TRUTH = [
    Rule(side, {"groundedness": g, "relevance": r}, *label) for side, g, r, *label in RULES_WITHOUT_TRUTH
]
WITH_TRUTH = [
    Rule(side, {"groundedness": g, "correctness": c} | ({"relevance": r} if r else {}), *label)
    for side, g, c, r, *label in RULES_WITH_TRUTH
]


def rules_from_table(table: DataFrame, ratings: Sequence[str]) -> list[Rule]:
    """Rules kept as rows (``place``, ``side``, rating columns, the labels), in order of ``place``; NULL is any value.

    At most ``MAX_CASES`` rules are read to the driver.
    """
    rows = table.orderBy("place").limit(MAX_CASES + 1).collect()
    if len(rows) > MAX_CASES:
        raise ValueError(f"more than {MAX_CASES} rules")
    return [
        Rule(r["side"], {c: r[c] for c in ratings if r[c] is not None}, r["root_cause"], r["assessment"], r["rationale"])
        for r in rows
    ]


def cases(rules: Sequence[Rule]) -> list[tuple[dict[str, str | None], list[int]]]:
    """Every case that the rules can tell apart, with the places of the rules that match it.

    A case is a side of the cut and a value per rating column: those that some rule names, or None for any other
    value and NULL. The list is complete, so a case without a rule is a gap and one with several an overlap.
    """
    domain: dict[str, list[str | None]] = {"side": ["low", "high", None]}
    for rule in rules:
        if rule.side not in domain["side"]:
            raise ValueError(f"side is 'low', 'high' or None, not {rule.side!r}")
        for column, value in rule.ratings.items():
            known = domain.setdefault(column, [None])
            if value not in known:
                known.insert(len(known) - 1, value)
    if prod(map(len, domain.values())) > MAX_CASES:
        raise ValueError(f"the rules tell more than {MAX_CASES} cases apart")
    told = [dict(zip(domain, values, strict=True)) for values in product(*domain.values())]
    return [(case, [i for i, rule in enumerate(rules) if rule.holds(case)]) for case in told]


def gaps(rules: Sequence[Rule]) -> list[dict[str, str]]:
    """Cases of known values that no rule matches."""
    return [case for case, found in cases(rules) if not found and None not in case.values()]


def overlaps(rules: Sequence[Rule]) -> list[tuple[dict[str, str], list[int]]]:
    """Cases of known values that several rules match with different labels, and the places of these rules."""
    def labels(found: list[int]) -> set[tuple]:
        return {(rules[i].root_cause, rules[i].assessment, rules[i].rationale) for i in found}

    return [(case, found) for case, found in cases(rules) if len(labels(found)) > 1 and None not in case.values()]


def case_number(rules: Sequence[Rule], cut: float = PRECISION_CUT) -> Column:
    """Place in :func:`cases` of a row's case: a number per column, added up. Never NULL."""
    # NaN compares as larger than any number in Spark and as unknown in the rules.
    precision = F.nanvl(F.col("precision").cast("double"), F.lit(None).cast("double"))
    number = F.when(precision < cut, 0).when(precision >= cut, 1).otherwise(2)
    domain: dict[str, dict[str | None, int]] = {}
    for case, _ in cases(rules):
        for column, value in case.items():
            if column != "side":
                domain.setdefault(column, {}).setdefault(value, len(domain.get(column, ())))
    for column, places in domain.items():
        place = F.lit(places[None])
        known = [(v, i) for v, i in places.items() if v is not None]
        for value, i in reversed(known):
            place = F.when(F.col(column) == value, i).otherwise(place)
        number = number * len(places) + place
    return number


def classify(results: DataFrame, rules: Sequence[Rule] = WITHOUT_TRUTH, cut: float = PRECISION_CUT) -> DataFrame:
    """Add root_cause, assessment and rationale; rows no rule matches keep NULLs.

    Where several rules match, the last one in the list wins. The rules are compiled to a table from case to label:
    a row looks up its case's number, however many rules there are.
    """
    if not rules:
        raise ValueError("no rules given")
    label = F.array(
        *[
            F.struct(
                F.lit(rule.root_cause).alias("root_cause"),
                F.lit(rule.assessment).alias("assessment"),
                F.lit(rule.rationale).alias("rationale"),
            )
            for rule in rules
        ]
    )
    winner = F.array(*[F.lit(found[-1] if found else -1) for _, found in cases(rules)])
    kept = [c for c in results.columns if c not in ("root_cause", "assessment", "rationale")]
    named = results.select(*kept, F.get(label, F.get(winner, case_number(rules, cut))).alias("_label"))
    return named.select(*kept, "_label.*")


def rule_coverage(results: DataFrame, rules: Sequence[Rule], cut: float = PRECISION_CUT) -> DataFrame:
    """A row per case of :func:`cases`: its side and ratings, how many rules match it, and how many results fall in it."""
    told = cases(rules)
    columns = list(told[0][0])
    rows = [(i, *case.values(), len(found)) for i, (case, found) in enumerate(told)]
    schema = ", ".join(["_case int", *(f"`{c}` string" for c in columns), "n_rules long"])
    known = results.sparkSession.createDataFrame(rows, schema)
    counted = results.groupBy(case_number(rules, cut).alias("_case")).agg(F.count(F.lit(1)).alias("n_results"))
    n = F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results")
    return known.join(counted, "_case", "left").select(*columns, "n_rules", n)


# --- frequencies and reports -----------------------------------------------------------------------


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Percentage of each value of ``column`` among its non-NULL values, largest first.

    The shuffle carries partial counts. The total is a scalar subquery over the same
    counts, so no task receives more than its share of the distinct values. NULLs go by
    their count of zero: a filter before the grouping would compute the value twice.
    """
    counts = df.groupBy(column).agg(F.count(column).alias("n")).filter(F.col("n") > 0)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", F.round(100.0 * F.col("n") / total, 6).alias("pct")).orderBy(
        F.col("n").desc(), F.col(column).asc()
    )


def with_report_names(df: DataFrame, names: Mapping[str, str] = REPORT_NAMES) -> DataFrame:
    """Short column names to the long ones used in reports."""
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def tolerant_select(df: DataFrame, columns: Sequence[str] = REPORT_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the order asked for. Runs no job."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in have])


def issue_report(classified: DataFrame, root_cause: str, columns: Sequence[str] = REPORT_COLUMNS) -> DataFrame:
    """Detail rows of one root cause under the report's column names."""
    return tolerant_select(with_report_names(classified.filter(F.col("root_cause") == root_cause)), columns)


def is_empty(report: DataFrame) -> bool:
    """Whether a report has no rows; stops at the first row found."""
    return report.isEmpty()
