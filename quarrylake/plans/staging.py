"""One staging model for each publisher: its words become the common vocabulary; rows are never filtered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, html_to_text, join_sections, last_piece, trim_all
from ..functions.values import json_array, json_scalar, midnight
from ..functions.vocabulary import employment_from_text, flags_joined, workplace_from_flags, workplace_from_text
from ..operators.lookups import country_of, small, translate

Seeds = dict[str, DataFrame]
SHARED = ("title", "first_seen_at", "last_seen_at", "company_slug")


def _workplace(df: DataFrame, seeds: Seeds, source: str, word: Column) -> DataFrame:
    return translate(df, seeds["workplace_type_map"], source, word, "workplace_type_raw", "workplace_type", "_workplace")


def _interval(df: DataFrame, seeds: Seeds, source: str, word: Column) -> DataFrame:
    return translate(df, seeds["salary_interval_map"], source, word, "salary_interval_raw", "salary_interval", "_interval")


def _employment(df: DataFrame, seeds: Seeds, source: str, word: Column) -> DataFrame:
    return translate(df, seeds["employment_type_map"], source, word, "employment_type_raw", "employment_type", "_employment")


def _plain(c: Column) -> Column:
    return empty_to_null(html_to_text(c))


def _source(name: str) -> list[Column]:
    return [F.lit(name).alias("source"), F.col("id").cast("string").alias("source_job_id"), F.col("url").alias("job_url")]


def greenhouse(raw: DataFrame, seeds: Seeds) -> DataFrame:
    """Country and workplace come from the free-text location; its HTML is stored escaped, hence decoded twice."""
    df = raw.withColumn("_place", last_piece(F.col("location"), r"[\t\n\f\r ]+-[\t\n\f\r ]+|;|•"))
    long_enough = (F.length("_place") > 2) | F.col("_place").isin("US", "UK")  # two letters are mostly a state
    df = country_of(df, seeds["country_codes"], F.col("_place"), also=long_enough)
    states = small(seeds["us_states"].select(F.col("state_raw").alias("_state")))
    df = df.join(states, F.col("_place") == F.col("_state"), "left")
    return df.select(
        *_source("greenhouse"), trim_all(F.col("title")).alias("title"), "company", F.col("location").alias("location_raw"),
        F.coalesce("_code", F.when(F.col("_state").isNotNull(), "US")).alias("country_code"), F.col("_spelling").alias("country_raw"),
        F.lit(None).cast("string").alias("workplace_type_raw"), workplace_from_text(F.col("location")).alias("workplace_type"),
        "department", "language", "first_seen_at", "last_seen_at", "published_at", "updated_at",
        empty_to_null(html_to_text(html_to_text(F.col("content")))).alias("description_text"), "company_slug",
    )


def lever(raw: DataFrame, seeds: Seeds) -> DataFrame:
    """The description is assembled from HTML parts, the titled lists among them in the payload's order."""
    df = _workplace(raw, seeds, "lever", F.col("workplace_type"))
    df = _interval(df, seeds, "lever", F.col("salary_interval"))
    section = lambda x: F.concat(json_scalar(x, "$.text"), F.lit(": "), html_to_text(json_scalar(x, "$.content")))
    sections = F.filter(F.transform(json_array(F.col("raw"), "$.lists"), section), lambda x: x.isNotNull())
    lists = F.when(F.size(sections) > 0, F.array_join(sections, "\n\n"))
    df = df.withColumn("lists_text", lists)
    return df.select(
        *_source("lever"), "title", F.col("country").alias("country_code"), "first_seen_at", "last_seen_at",
        F.col("workplace_type").alias("workplace_type_raw"), F.col("_workplace").alias("workplace_type"), F.col("location").alias("location_raw"),
        F.col("department").alias("team"), "published_at", "salary_min", "salary_max", "salary_currency",
        F.col("salary_interval").alias("salary_interval_raw"), F.col("_interval").alias("salary_interval"), "lists_text", "company_slug",
        employment_from_text(F.col("commitment")).alias("employment_type"), empty_to_null(trim_all(F.col("commitment"))).alias("employment_type_raw"),
        join_sections(
            html_to_text(json_scalar(F.col("raw"), "$.opening")), html_to_text(F.col("content")), F.col("lists_text"), html_to_text(F.col("additional"))
        ).alias("description_text"),
    )


def ashby(raw: DataFrame, seeds: Seeds) -> DataFrame:
    """Silence about the workplace is ``unknown``; a word nobody knows stays null for the tests to find."""
    df = _workplace(raw, seeds, "ashby", F.col("workplace_type"))
    df = _interval(df, seeds, "ashby", F.col("salary_interval"))
    df = _employment(df, seeds, "ashby", F.col("employment_type"))
    df = country_of(df, seeds["country_codes"], trim_all(F.col("country")))
    return df.select(
        *_source("ashby"), "title", F.col("_code").alias("country_code"), empty_to_null(trim_all(F.col("country"))).alias("country_raw"),
        "first_seen_at", "last_seen_at", F.col("workplace_type").alias("workplace_type_raw"),
        F.when(F.col("workplace_type").isNull(), "unknown").otherwise(F.col("_workplace")).alias("workplace_type"), F.col("location").alias("location_raw"),
        "department", "team", "published_at", "salary_min", "salary_max", "salary_currency", F.col("salary_interval").alias("salary_interval_raw"),
        F.col("_interval").alias("salary_interval"), "compensation_summary", F.col("employment_type").alias("employment_type_raw"),
        F.col("_employment").alias("employment_type"), empty_to_null(trim_all(F.col("content"))).alias("description_text"), "company_slug",
    )


def recruitee(raw: DataFrame, seeds: Seeds) -> DataFrame:
    df = _interval(raw, seeds, "recruitee", F.col("salary_period"))
    df = _employment(df, seeds, "recruitee", F.col("employment_type"))
    df = country_of(df, seeds["country_codes"], trim_all(F.col("country_code")))
    flags = {c: F.col(c) for c in ("remote", "hybrid", "on_site")}
    return df.select(
        *_source("recruitee"), "title", "language", F.col("_code").alias("country_code"), empty_to_null(trim_all(F.col("country_code"))).alias("country_raw"),
        "first_seen_at", "last_seen_at", workplace_from_flags(*flags.values()).alias("workplace_type"), flags_joined("-", **flags).alias("workplace_type_raw"),
        F.col("location").alias("location_raw"), "department", F.col("employment_type").alias("employment_type_raw"), F.col("_employment").alias("employment_type"),
        "published_at", "updated_at", "salary_min", "salary_max", "salary_currency", F.col("salary_period").alias("salary_period_raw"),
        F.col("_interval").alias("salary_interval"), "company_slug",
        join_sections(*[html_to_text(F.col(c)) for c in ("highlight", "content", "requirements")]).alias("description_text"),
    )


def teamtailor(raw: DataFrame, seeds: Seeds) -> DataFrame:
    df = _workplace(raw, seeds, "teamtailor", F.col("remote_status"))
    df = country_of(df, seeds["country_codes"], trim_all(F.col("country")))
    return df.select(
        *_source("teamtailor"), "title", "first_seen_at", "last_seen_at", F.col("remote_status").alias("workplace_type_raw"),
        F.col("_workplace").alias("workplace_type"), F.col("_code").alias("country_code"), F.col("country").alias("country_raw"),
        F.col("location").alias("location_raw"), "role", "department", "published_at", _plain(F.col("content")).alias("description_text"), "company_slug",
    )


def workable(raw: DataFrame, seeds: Seeds) -> DataFrame:
    """A word for the workplace counts before the telecommuting flag."""
    df = _workplace(raw, seeds, "workable", F.col("workplace"))
    df = _interval(df, seeds, "workable", F.col("salary_frequency"))
    df = _employment(df, seeds, "workable", F.col("employment_type"))
    df = country_of(df, seeds["country_codes"], trim_all(F.col("country_code")))
    place = F.when(F.col("workplace").isNotNull(), F.col("_workplace")).when(F.col("telecommuting"), "remote").otherwise("unknown")
    return df.select(
        *_source("workable"), "title", "first_seen_at", "last_seen_at", F.col("workplace").alias("workplace_type_raw"), place.alias("workplace_type"),
        "telecommuting", F.col("country_code").alias("country_raw"), F.col("_code").alias("country_code"), "department",
        F.col("employment_type").alias("employment_type_raw"), F.col("_employment").alias("employment_type"), "experience", "education", "industry",
        "job_function", "language", midnight(F.col("published_on")).alias("published_at"), "salary_min", "salary_max", "salary_currency",
        F.col("salary_frequency").alias("salary_interval_raw"), F.col("_interval").alias("salary_interval"), _plain(F.col("content")).alias("description_text"),
        "company_slug",
    )


STAGING = {
    "greenhouse": greenhouse, "lever": lever, "ashby": ashby, "recruitee": recruitee, "teamtailor": teamtailor, "workable": workable,
}
#: The seeds that each model reads.
READS = {
    "greenhouse": ("country_codes", "us_states"), "lever": ("workplace_type_map", "salary_interval_map"),
    "ashby": ("workplace_type_map", "salary_interval_map", "employment_type_map", "country_codes"),
    "recruitee": ("salary_interval_map", "employment_type_map", "country_codes"), "teamtailor": ("workplace_type_map", "country_codes"),
    "workable": ("workplace_type_map", "salary_interval_map", "employment_type_map", "country_codes"),
}
