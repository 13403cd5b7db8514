"""Declared schemas: nothing is inferred, money is decimal, instants are UTC timestamps."""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "decimal(38,9)"
_SEEN = "company_slug string, first_seen_at timestamp, last_seen_at timestamp"
_PAY = f"salary_min {MONEY}, salary_max {MONEY}, salary_currency string"

COMPANIES = "name string, external_id string, ats string"

#: Current-state tables, one row for each posting, by source.
POSTINGS = {
    "greenhouse": "id bigint, title string, url string, location string, company string, department string, office string, "
    "language string, content string, updated_at timestamp, published_at timestamp, deadline_at timestamp, raw string, " + _SEEN,
    "lever": "id string, title string, url string, location string, department string, commitment string, workplace_type string, "
    f"country string, content string, additional string, {_PAY}, salary_interval string, published_at timestamp, raw string, " + _SEEN,
    "ashby": "id string, title string, url string, location string, department string, team string, employment_type string, "
    f"workplace_type string, country string, content string, is_listed boolean, {_PAY}, salary_interval string, "
    "compensation_summary string, published_at timestamp, raw string, " + _SEEN,
    "recruitee": "id bigint, title string, language string, url string, location string, remote boolean, hybrid boolean, "
    "on_site boolean, country_code string, department string, employment_type string, content string, requirements string, "
    f"highlight string, {_PAY}, salary_period string, published_at timestamp, updated_at timestamp, raw string, " + _SEEN,
    "teamtailor": "id string, title string, url string, location string, city string, country string, remote_status string, "
    "department string, role string, content string, published_at timestamp, raw string, " + _SEEN,
    "workable": "id string, title string, url string, city string, region string, country string, country_code string, "
    "telecommuting boolean, department string, employment_type string, education string, experience string, industry string, "
    "job_function string, published_on date, workplace string, language string, content string, requirements string, "
    f"benefits string, {_PAY}, salary_frequency string, raw string, raw_detail string, detail_fetched_at timestamp, " + _SEEN,
}

#: Columns that the pipeline adds; fill rates leave them out.
PIPELINE_COLUMNS = ("id", "raw", "first_seen_at", "last_seen_at", "landed_at")

#: Workable's columns that come from a detail call; a load without details leaves them as they are.
DETAIL_COLUMNS = (
    "workplace", "language", "requirements", "benefits", "salary_min", "salary_max", "salary_currency", "salary_frequency", "raw_detail", "detail_fetched_at",
)

UNIONED = (
    "source", "source_job_id", "company_slug", "title", "job_url", "country_code", "workplace_type", "workplace_type_raw",
    "description_text", "published_at", "first_seen_at", "last_seen_at", "location_raw", "department", "country_raw",
    "salary_min", "salary_max", "salary_currency", "salary_interval", "language", "updated_at", "employment_type",
)
#: Types of those union columns that some source lacks.
OPTIONAL = {
    "location_raw": "string", "country_raw": "string", "salary_min": MONEY, "salary_max": MONEY, "salary_currency": "string",
    "salary_interval": "string", "language": "string", "updated_at": "timestamp", "employment_type": "string",
}

#: The fact's columns with their types.
FACT_TYPES = {
    c: OPTIONAL.get(c, "timestamp" if c.endswith("_at") else "boolean" if c == "is_open" else "string")
    for c in (
        "posting_key", "source", "title", "country_key", "source_job_id", "company_slug", "company_name", "job_url", "workplace_type", "employment_type",
        "department", "language", "location_raw", "salary_min", "salary_max", "salary_currency", "salary_interval", "description_text", "published_at",
        "updated_at", "first_seen_at", "last_seen_at", "is_open",
    )
}

SEEDS = {
    "country_codes": "country_raw string, country_code string",
    "countries": "country_code string, country_name string, region string, sub_region string, business_region string",
    "us_states": "state_raw string, state_code string",
    "workplace_type_map": "source string, workplace_type_raw string, workplace_type string",
    "salary_interval_map": "source string, salary_interval_raw string, salary_interval string",
    "employment_type_map": "source string, employment_type_raw string, employment_type string",
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def incoming(source: str) -> str:
    """Schema of a day's load: the final columns with the landing time; Workable says whether it has details."""
    ddl = POSTINGS[source].replace("detail_fetched_at timestamp", "has_detail boolean")
    return ddl + ", landed_at timestamp"
