"""Vocabularies as data: small mapping tables, and rules on free text."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import matches

SOURCES = ("greenhouse", "lever", "ashby", "recruitee", "teamtailor", "workable")

# Each source's word and the common one.
WORKPLACE_TYPES = [
    ("lever", "remote", "remote"), ("lever", "hybrid", "hybrid"), ("lever", "onsite", "in_person"), ("lever", "unspecified", "unknown"),
    ("ashby", "Remote", "remote"), ("ashby", "Hybrid", "hybrid"), ("ashby", "OnSite", "in_person"),
    ("teamtailor", "fully", "remote"), ("teamtailor", "hybrid", "hybrid"), ("teamtailor", "onsite", "in_person"),
    ("teamtailor", "none", "in_person"), ("teamtailor", "temporary", "hybrid"),
    ("workable", "on_site", "in_person"), ("workable", "hybrid", "hybrid"), ("workable", "remote", "remote"),
]
SALARY_INTERVALS = [
    ("lever", "per-year-salary", "year"), ("lever", "per-month-salary", "month"), ("lever", "semi-month-salary", "semi_month"),
    ("lever", "bi-week-salary", "bi_week"), ("lever", "per-day-wage", "day"), ("lever", "per-hour-wage", "hour"),
    ("ashby", "1 YEAR", "year"), ("ashby", "1 MONTH", "month"), ("ashby", "1 WEEK", "week"), ("ashby", "1 HOUR", "hour"),
    ("ashby", "1 TIME", "one_time"), ("ashby", "1 DAY", "day"),
    ("recruitee", "month", "month"), ("recruitee", "year", "year"), ("recruitee", "hour", "hour"),
    ("workable", "year", "year"),
]
EMPLOYMENT_TYPES = [
    ("ashby", "FullTime", "full_time"), ("ashby", "PartTime", "part_time"), ("ashby", "Contract", "contract"),
    ("ashby", "Temporary", "temporary"), ("ashby", "Intern", "internship"),
    ("workable", "Full-time", "full_time"), ("workable", "Part-time", "part_time"), ("workable", "Contract", "contract"),
    ("workable", "Temporary", "temporary"), ("workable", "Other", "other"),
    ("recruitee", "fulltime", "full_time"), ("recruitee", "fulltime_permanent", "full_time"), ("recruitee", "fulltime_fixed_term", "full_time"),
    ("recruitee", "parttime", "part_time"), ("recruitee", "parttime_permanent", "part_time"), ("recruitee", "parttime_fixed_term", "part_time"),
    ("recruitee", "parttime_minijob", "part_time"), ("recruitee", "contract", "contract"), ("recruitee", "freelance", "contract"),
    ("recruitee", "temporary", "temporary"), ("recruitee", "seasonal", "temporary"), ("recruitee", "internship", "internship"),
    ("recruitee", "apprenticeship", "internship"), ("recruitee", "volunteer", "other"),
]
# Codes and names of the states of the US and of its capital's district.
US_STATES = [
    ("AL", "Alabama"), ("AK", "Alaska"), ("AZ", "Arizona"), ("AR", "Arkansas"), ("CA", "California"), ("CO", "Colorado"),
    ("CT", "Connecticut"), ("DE", "Delaware"), ("DC", "District of Columbia"), ("FL", "Florida"), ("GA", "Georgia"),
    ("HI", "Hawaii"), ("ID", "Idaho"), ("IL", "Illinois"), ("IN", "Indiana"), ("IA", "Iowa"), ("KS", "Kansas"),
    ("KY", "Kentucky"), ("LA", "Louisiana"), ("ME", "Maine"), ("MD", "Maryland"), ("MA", "Massachusetts"), ("MI", "Michigan"),
    ("MN", "Minnesota"), ("MS", "Mississippi"), ("MO", "Missouri"), ("MT", "Montana"), ("NE", "Nebraska"), ("NV", "Nevada"),
    ("NH", "New Hampshire"), ("NJ", "New Jersey"), ("NM", "New Mexico"), ("NY", "New York"), ("NC", "North Carolina"),
    ("ND", "North Dakota"), ("OH", "Ohio"), ("OK", "Oklahoma"), ("OR", "Oregon"), ("PA", "Pennsylvania"), ("RI", "Rhode Island"),
    ("SC", "South Carolina"), ("SD", "South Dakota"), ("TN", "Tennessee"), ("TX", "Texas"), ("UT", "Utah"), ("VT", "Vermont"),
    ("VA", "Virginia"), ("WA", "Washington"), ("WV", "West Virginia"), ("WI", "Wisconsin"), ("WY", "Wyoming"),
]

WORKPLACES = ("remote", "hybrid", "in_person", "unknown")
INTERVALS = ("year", "month", "semi_month", "bi_week", "week", "day", "hour", "one_time")
EMPLOYMENTS = ("full_time", "part_time", "contract", "temporary", "internship", "other")
BUSINESS_REGIONS = ("NAMER", "LATAM", "EMEA", "APAC", "Unknown")
UNKNOWN_COUNTRY = "ZZ"

# What a job's free-text commitment says, the first pattern that occurs wins.
COMMITMENTS = [
    (r"intern|apprentice|student|co-op|fellowship", "internship"),
    (r"temporary|seasonal|fixed.?term|per.?diem", "temporary"),
    (r"contract|freelance|consultant|1099", "contract"),
    (r"part.{0,3}time", "part_time"),
    (r"full.{0,3}time|^ft\z|permanent", "full_time"),
]


def first_pattern(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The value of the first rule whose pattern occurs in the text, else null."""
    (pattern, value), *rest = rules
    return reduce(lambda c, rule: c.when(matches(text, rule[0]), F.lit(rule[1])), rest, F.when(matches(text, pattern), F.lit(value)))


def employment_from_text(c: Column) -> Column:
    return first_pattern(F.lower(c), COMMITMENTS)


def workplace_from_text(c: Column) -> Column:
    """``remote`` if the text says so, else ``unknown``."""
    return F.when(matches(F.lower(c), "remote"), F.lit("remote")).otherwise(F.lit("unknown"))


def workplace_from_flags(remote: Column, hybrid: Column, on_site: Column) -> Column:
    return F.when(remote, "remote").when(hybrid, "hybrid").when(on_site, "in_person").otherwise("unknown")


def flags_joined(sep: str = "-", **flags: Column) -> Column:
    """Names of the flags that are true, joined; null if none is."""
    named = F.array(*[F.when(c, F.lit(name)) for name, c in flags.items()])
    return F.nullif(F.array_join(named, sep), F.lit(""))


def mapping(spark: SparkSession, rows: list[tuple], raw: str, canonical: str) -> DataFrame:
    return spark.createDataFrame(rows, f"source string, {raw} string, {canonical} string")


def us_states(spark: SparkSession) -> DataFrame:
    """Codes and names, each with its code."""
    rows = [pair for code, name in US_STATES for pair in ((code, code), (name, code))]
    return spark.createDataFrame(rows, "state_raw string, state_code string")
