"""From six staging models to one union, a star and a wide serving table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vocabulary import UNKNOWN_COUNTRY
from ..operators.lookups import small
from ..operators.profile import open_on_last_day
from ..schemas import FACT_TYPES, OPTIONAL, UNIONED


def _aligned(source: str, staged: DataFrame) -> DataFrame:
    """The 22 shared columns; what a source lacks is a typed null."""
    if source == "lever":
        staged = staged.withColumn("department", F.col("team"))
    lacks = {c: F.lit(None).cast(kind) for c, kind in OPTIONAL.items() if c not in staged.columns}
    return staged.withColumns(lacks).select(*UNIONED) if lacks else staged.select(*UNIONED)


def postings_unioned(staged: dict[str, DataFrame], companies: DataFrame) -> DataFrame:
    """All postings with their key and, by both halves of the registry's key, the company's name."""
    rows = reduce(DataFrame.unionByName, [_aligned(s, df) for s, df in sorted(staged.items())])
    names = small(companies.select(F.col("external_id").alias("company_slug"), F.col("ats").alias("source"), F.col("name").alias("company_name")))
    keyed = rows.join(names, ["company_slug", "source"], "left")
    return keyed.select(F.concat("source", F.lit("/"), "source_job_id").alias("posting_key"), *UNIONED, "company_name")


def dim_country(countries: DataFrame) -> DataFrame:
    """Countries and the member for postings without one."""
    unknown = countries.sparkSession.createDataFrame([(UNKNOWN_COUNTRY, *["Unknown"] * 4)], countries.schema)
    return countries.unionByName(unknown)


FACT = tuple(FACT_TYPES)


def _as_fact(postings: DataFrame) -> DataFrame:
    return postings.withColumn("country_key", F.coalesce("country_code", F.lit(UNKNOWN_COUNTRY))).select(*FACT)


def fct_job_postings(postings: DataFrame) -> DataFrame:
    """A posting is open if it was seen on the last day on which its source was seen."""
    return _as_fact(open_on_last_day(postings, "source", "last_seen_at"))


def last_days(postings: DataFrame) -> DataFrame:
    """(source, last_day), one row a source: kept as a table, it saves reading the fact for it."""
    return postings.groupBy("source").agg(F.max(F.to_date("last_seen_at")).alias("last_day"))


def later_days(days: DataFrame, more: DataFrame) -> DataFrame:
    return days.unionByName(more).groupBy("source").agg(F.max("last_day").alias("last_day"))


def fact_patch(fact: DataFrame, days: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows by which the fact follows a load, without being built anew.

    ``changed`` are the postings (as in the union) that the load has written, ``days`` the last days before
    it.  Besides the changed rows themselves, these are the rows that close: open ones of a source whose
    last day has moved on.  Replacing rows by these gives what a full build gives.
    """
    after = small(later_days(days, last_days(changed)))
    opened = changed.join(after, "source", "left").withColumn("is_open", F.coalesce(F.to_date("last_seen_at") == F.col("last_day"), F.lit(False)))
    moved = small(after.join(days.withColumnRenamed("last_day", "before"), "source").where("before < last_day").select("source"))
    closed = fact.where("is_open").join(moved, "source", "left_semi").join(changed.select("posting_key"), "posting_key", "left_anti")
    return _as_fact(opened).unionByName(closed.withColumn("is_open", F.lit(False)).select(*FACT))


def replaced(fact: DataFrame, patch: DataFrame) -> DataFrame:
    """The fact (or the buckets of it that the patch touches) with the patch's rows in place of its own."""
    return fact.join(patch.select("posting_key"), "posting_key", "left_anti").select(*fact.columns).unionByName(patch.select(*fact.columns))


def remote_jobs(fact: DataFrame, countries: DataFrame) -> DataFrame:
    """Open remote postings with their country's names."""
    wanted = fact.where((F.col("workplace_type") == "remote") & F.col("is_open"))
    joined = wanted.join(small(countries), F.col("country_key") == F.col("country_code"))
    return joined.select(
        "posting_key", "title", "company_name", "country_name", "business_region", "employment_type", "salary_min", "salary_max",
        "salary_currency", "salary_interval", "job_url", "source", "published_at", "last_seen_at",
    )
