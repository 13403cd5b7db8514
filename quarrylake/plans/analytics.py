"""The questions that are asked of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pay_label
from ..functions.values import day_text, gibibytes, minute_text, percent
from ..functions.vocabulary import UNKNOWN_COUNTRY, WORKPLACES
from ..operators.profile import counts, pivot_share, top


def kpi(fact: DataFrame) -> DataFrame:
    is_open = F.col("is_open")
    return fact.agg(
        F.count_if(is_open).alias("open_postings"),
        F.count_if(is_open & (F.col("workplace_type") == "remote")).alias("open_remote"),
        F.countDistinct(F.when(is_open, F.concat("source", F.lit("/"), "company_slug"))).alias("companies"),
        F.countDistinct(F.when(is_open & (F.col("country_key") != UNKNOWN_COUNTRY), F.col("country_key"))).alias("countries"),
        day_text(F.max("last_seen_at")).alias("as_of"),
    )


def by_region(remote: DataFrame) -> DataFrame:
    return counts(remote, F.col("business_region").alias("region"))


def by_country(remote: DataFrame, n: int = 12) -> DataFrame:
    known = counts(remote.where("country_name != 'Unknown'"), F.col("country_name").alias("country"))
    return top(known, n, F.desc("postings"), F.asc("country"))


def by_source(fact: DataFrame) -> DataFrame:
    return counts(fact.where("is_open"), "source", "workplace_type")


def workplace_share(fact: DataFrame) -> DataFrame:
    return pivot_share(by_source(fact), "source", "workplace_type", list(WORKPLACES), "postings")


def by_employment(remote: DataFrame) -> DataFrame:
    return counts(remote.where("employment_type IS NOT NULL"), "employment_type")


def top_companies(remote: DataFrame, n: int = 200) -> DataFrame:
    known = F.countDistinct(F.when(F.col("country_name") != "Unknown", F.col("country_name")))
    found = remote.groupBy(F.col("company_name").alias("company"), "source").agg(F.count(F.lit(1)).alias("open_remote_postings"), known.alias("countries"))
    return top(found, n, F.desc("open_remote_postings"), F.asc("company"), F.asc("source"))


def latest(remote: DataFrame, n: int = 1500) -> DataFrame:
    newest = top(remote.where("published_at IS NOT NULL"), n, F.desc("published_at"), F.asc("posting_key"))
    return newest.select(
        day_text(F.col("published_at")).alias("published"), "title", F.col("company_name").alias("company"), F.col("country_name").alias("country"),
        F.col("business_region").alias("region"), F.replace("employment_type", F.lit("_"), F.lit(" ")).alias("type"),
        pay_label(*map(F.col, ("salary_min", "salary_max", "salary_currency", "salary_interval"))).alias("pay"), "job_url",
    )


def per_source(fact: DataFrame) -> DataFrame:
    is_open = F.col("is_open")
    found = fact.groupBy("source").agg(
        F.count_if(is_open).alias("open_postings"), F.count_if(~is_open).alias("closed_postings"),
        F.count_if(is_open & F.col("description_text").isNotNull()).alias("with_description"), minute_text(F.max("last_seen_at")).alias("last_run_utc"),
    )
    return found.withColumn("description_fill", percent(F.col("with_description"), F.col("open_postings"))).orderBy(F.desc("open_postings"), "source")


def daily_reads(jobs: DataFrame, days: int = 21) -> DataFrame:
    """GiB and jobs by day, from jobs with their start and bytes (``sources.eventlog.jobs``)."""
    recent = jobs.where(F.col("started_at") >= F.current_timestamp() - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(F.to_date("started_at").alias("day")).agg(gibibytes(F.sum("bytes_read")).alias("gb_read"), F.count(F.lit(1)).alias("jobs")).orderBy("day")


def month_reads(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.to_date("started_at") >= F.trunc(F.current_date(), "MONTH")).agg(gibibytes(F.sum("bytes_read")).alias("gb"))
