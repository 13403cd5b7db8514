"""Data tests: row checks as DataFrames of violations, load checks as pure rules over counts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..operators.lookups import unseen
from ..operators.profile import duplicate_keys, fill_rates
from ..schemas import PIPELINE_COLUMNS

log = logging.getLogger(__name__)
ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """A named test; it passes if its DataFrame of violations is empty."""

    name: str
    violations: Callable[[], DataFrame]
    severity: str = ERROR


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return duplicate_keys(df.dropna(subset=list(columns)), list(columns))


def accepted(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list; null passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def unmapped(df: DataFrame, raw: str, mapped: str) -> DataFrame:
    """A word that is there and has no translation."""
    return df.where(F.col(raw).isNotNull() & F.col(mapped).isNull())


def unknown_country(staged: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Spellings that the seed has never seen; one that it maps to no country counts as seen."""
    return unseen(staged, country_codes, "country_raw", "country_raw")


def unrelated(df: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose value the dimension lacks; an inner join would drop them silently."""
    return df.where(F.col(column).isNotNull()).join(dimension.select(F.col(key).alias(column)), column, "left_anti")


def leftover_markup(df: DataFrame, column: str = "description_text") -> DataFrame:
    return df.where(F.col(column).rlike("<[a-zA-Z/]"))


def differs(df: DataFrame, got: str, wanted: str) -> DataFrame:
    """Rows where two columns are distinct, null being a value."""
    return df.where(~F.col(got).eqNullSafe(F.col(wanted)))


SEED_KEYS = {
    "country_codes": ["country_raw"], "countries": ["country_code"], "us_states": ["state_raw"],
    "workplace_type_map": ["source", "workplace_type_raw"], "salary_interval_map": ["source", "salary_interval_raw"],
    "employment_type_map": ["source", "employment_type_raw"],
}


def seed_checks(seeds: dict[str, DataFrame]) -> list[Check]:
    """A seed key that comes twice would double postings in every join."""
    return [Check(f"{name} key", lambda df=seeds[name], k=keys: unique(df, *k)) for name, keys in SEED_KEYS.items() if name in seeds]


def staging_checks(source: str, staged: DataFrame, seeds: dict[str, DataFrame]) -> list[Check]:
    checks = [Check(f"{source} {c} {kind}", lambda c=c, t=test: t(staged, c)) for c in ("source_job_id",) for kind, test in (("not null", not_null), ("unique", unique))]
    checks += [Check(f"{source} {c} not null", lambda c=c: not_null(staged, c)) for c in ("title", "job_url", "company_slug", "workplace_type", "first_seen_at", "last_seen_at")]
    for column, values in (("workplace_type", v.WORKPLACES), ("salary_interval", v.INTERVALS), ("employment_type", v.EMPLOYMENTS)):
        if column in staged.columns:
            checks.append(Check(f"{source} {column} accepted", lambda c=column, x=values: accepted(staged, c, x)))
    if source in ("ashby", "recruitee", "workable"):
        checks.append(Check(f"{source} employment type mapped", lambda: unmapped(staged, "employment_type_raw", "employment_type")))
    if source in ("ashby", "lever", "recruitee", "workable"):
        raw = "salary_period_raw" if source == "recruitee" else "salary_interval_raw"
        checks.append(Check(f"{source} salary interval mapped", lambda: unmapped(staged, raw, "salary_interval")))
    if source in ("ashby", "recruitee", "teamtailor", "workable"):
        checks.append(Check(f"{source} country known", lambda: unknown_country(staged, seeds["country_codes"])))
    if source in ("lever", "recruitee"):
        checks.append(Check(f"{source} description clean", lambda: leftover_markup(staged), ERROR if source == "lever" else WARN))
    return checks


def union_checks(postings: DataFrame) -> list[Check]:
    return [
        Check("posting_key not null", lambda: not_null(postings, "posting_key")),
        Check("posting_key unique", lambda: unique(postings, "posting_key")),
        Check("workplace_type accepted", lambda: accepted(postings, "workplace_type", v.WORKPLACES)),
        Check("source accepted", lambda: accepted(postings, "source", v.SOURCES)),
    ]


def country_checks(countries: DataFrame) -> list[Check]:
    return [
        Check("country unique", lambda: unique(countries, "country_code")),
        Check("business region accepted", lambda: accepted(countries, "business_region", v.BUSINESS_REGIONS)),
    ]


def fact_checks(fact: DataFrame, countries: DataFrame) -> list[Check]:
    return [
        Check("country related", lambda: unrelated(fact, "country_key", countries, "country_code")),
        Check("is_open not null", lambda: not_null(fact, "is_open")),
    ]


def remote_checks(remote: DataFrame) -> list[Check]:
    return [Check("remote unique", lambda: unique(remote, "posting_key"))]


def run_checks(checks: Iterable[Check]) -> dict[str, str]:
    """Results by name: pass, warn or error.  One violation is looked for, not all are counted."""
    results = {c.name: "pass" if c.violations().isEmpty() else c.severity for c in checks}
    for name, result in results.items():
        if result != "pass":
            log.warning("check %s: %s", name, result)
    return results


# Load checks.  Rules are functions of counts, so they are tested without data.


def files_verdict(expected: set[str], files: dict[str, int], known_failed: set[str] | None = None) -> tuple[str, set[str]]:
    """Whether every registered company has landed: verdict and the companies it is about.

    No file at all is an error.  With the extract's own list of failures, a gap that it explains is
    a warning and any other an error; without it, gaps are an error beyond half of the companies.
    """
    gaps = expected - files.keys()
    if not sum(files.values()):
        return ERROR, gaps
    if known_failed is not None:
        unexplained = gaps - known_failed
        return (ERROR, unexplained) if unexplained else (WARN if gaps else "pass", gaps)
    return (ERROR if 2 * len(gaps) > len(expected) else WARN if gaps else "pass"), gaps


def staging_verdict(rows: int, files: int, expected: int, exact: bool = True) -> str:
    """Boards without jobs give no rows, so fewer files are an error only if the loader counted them."""
    if not rows or files > expected:
        return ERROR
    return "pass" if files == expected else ERROR if exact else WARN


def final_verdict(rows: int, ids: int, unmerged: int) -> str:
    return ERROR if rows != ids or unmerged else "pass"


def staging_counts(incoming: DataFrame) -> DataFrame:
    return incoming.agg(F.count(F.lit(1)).alias("rows_total"), F.countDistinct("landed_at").alias("files_total"))


def final_counts(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("rows_total"), F.countDistinct("id").alias("ids_total"))


def unmerged_ids(incoming: DataFrame, table: DataFrame) -> DataFrame:
    return incoming.select("id").subtract(table.select("id"))


def load_verdicts(incoming: DataFrame, table: DataFrame, expected_files: int, exact: bool = True) -> dict[str, str]:
    staged, final = staging_counts(incoming).first(), final_counts(table).first()
    return {
        "staging": staging_verdict(staged["rows_total"], staged["files_total"], expected_files, exact),
        "final": final_verdict(final["rows_total"], final["ids_total"], unmerged_ids(incoming, table).count()),
    }


def posting_fill_rates(table: DataFrame) -> DataFrame:
    return fill_rates(table, PIPELINE_COLUMNS)


def freshness(table: DataFrame, now: datetime, warn_hours: int = 30, error_hours: int = 48, seen: str = "last_seen_at") -> DataFrame:
    """One row: the last sight and whether it is fresh; an empty table is an error."""
    age = (F.unix_timestamp(F.lit(now)) - F.unix_timestamp("last_seen")) / 3600
    status = F.when(F.col("last_seen").isNull() | (age > error_hours), ERROR).when(age > warn_hours, WARN).otherwise("pass")
    return table.agg(F.max(seen).alias("last_seen")).select("last_seen", status.alias("status"))
