"""Seed tables: small CSV files with a header; mapping tables come with the library.

The two country tables are the user's own files; ``country_rows`` and ``country_spellings`` make
them from an ISO list and from the spellings that feeds use.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..functions.text import trim_all
from ..schemas import SEEDS, struct
from .landing import write_bytes
from ..operators.lookups import small


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """An empty cell is null; all columns are text, so ``NA`` stays a country."""
    return spark.read.option("header", "true").schema(struct(SEEDS[name])).csv(path)


def seeds(spark: SparkSession, country_codes: str | DataFrame, countries: str | DataFrame) -> dict[str, DataFrame]:
    """All six seed tables; the country tables from paths or DataFrames."""
    given = {"country_codes": country_codes, "countries": countries}
    return {k: read_seed(spark, x, k) if isinstance(x, str) else x for k, x in given.items()} | {
        "us_states": v.us_states(spark),
        "workplace_type_map": v.mapping(spark, v.WORKPLACE_TYPES, "workplace_type_raw", "workplace_type"),
        "salary_interval_map": v.mapping(spark, v.SALARY_INTERVALS, "salary_interval_raw", "salary_interval"),
        "employment_type_map": v.mapping(spark, v.EMPLOYMENT_TYPES, "employment_type_raw", "employment_type"),
    }


def write_seed(df: DataFrame, path: str) -> None:
    """One sorted CSV with a header and plain line ends; for tables of a seed's size."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(df.columns)
    writer.writerows([["" if x is None else x for x in r] for r in df.orderBy(*df.columns).collect()])
    write_bytes(df.sparkSession, path, out.getvalue().encode())


# Business regions by UN sub-region, and what the ISO list lacks or abbreviates.
REGIONS = {
    "Northern America": "NAMER", "Latin America and the Caribbean": "LATAM",
    "Northern Europe": "EMEA", "Western Europe": "EMEA", "Southern Europe": "EMEA", "Eastern Europe": "EMEA",
    "Northern Africa": "EMEA", "Sub-Saharan Africa": "EMEA", "Western Asia": "EMEA",
    "Eastern Asia": "APAC", "South-eastern Asia": "APAC", "Southern Asia": "APAC", "Central Asia": "APAC",
    "Australia and New Zealand": "APAC", "Melanesia": "APAC", "Micronesia": "APAC", "Polynesia": "APAC",
}
COUNTRY_NAMES = {"US": "United States", "GB": "United Kingdom"}
COUNTRY_REGIONS = {"TW": ("Asia", "Eastern Asia")}
MORE_COUNTRIES = [("XK", "Kosovo", "Europe", "Southern Europe")]
# Spellings that ISO names do not cover, and words that are no country.
COUNTRY_ALIASES = {
    "brasil": "BR", "svalbard and jan mayen": "SJ", "uk": "GB", "england": "GB", "scotland": "GB", "wales": "GB", "northern ireland": "GB",
    "south korea": "KR", "korea": "KR", "russia": "RU", "turkey": "TR", "czech republic": "CZ", "vietnam": "VN", "taiwan": "TW",
    "hong kong": "HK", "macau": "MO", "iran": "IR", "syria": "SY", "laos": "LA", "moldova": "MD", "bolivia": "BO", "venezuela": "VE",
    "tanzania": "TZ", "ivory coast": "CI", "cote d'ivoire": "CI", "côte d'ivoire": "CI", "the netherlands": "NL", "holland": "NL",
    "kosovo": "XK", "xk": "XK", "united states": "US", "u.s.": "US", "u.s.a": "US", "united kingdom": "GB", "méxico": "MX", "turkiye": "TR",
    "hong kong sar": "HK", "hong kong sar, china": "HK", "people's republic of china": "CN", "reunion": "RE", "france, metropolitan": "FR",
    "bolivia, plurinational state of": "BO", "congo, the democratic republic of the": "CD", "tanzania, united republic of": "TZ",
    "venezuela, bolivarian republic of": "VE",
}
NO_COUNTRY = [
    "anywhere", "europe", "europa", "european union", "latam", "latin america", "north america", "eu, latam, canada", "remote",
    "remote - emea", "remote - global", "remote - south america", "us | eu",
]


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def country_rows(iso: DataFrame) -> DataFrame:
    """ISO rows (code, name, region, sub_region) as the countries table with business regions."""
    spark = iso.sparkSession
    more = spark.createDataFrame(MORE_COUNTRIES, "code string, name string, region string, sub_region string")
    rows = iso.where(F.coalesce("code", F.lit("")) != "").unionByName(more)
    code = F.col("code")
    region = F.coalesce(_lookup({k: x[0] for k, x in COUNTRY_REGIONS.items()}, code), F.nullif("region", F.lit("")))
    sub = F.coalesce(_lookup({k: x[1] for k, x in COUNTRY_REGIONS.items()}, code), F.nullif("sub_region", F.lit("")))
    return rows.select(
        code.alias("country_code"), F.coalesce(_lookup(COUNTRY_NAMES, code), F.col("name")).alias("country_name"),
        region.alias("region"), sub.alias("sub_region"), _lookup(REGIONS, sub).alias("business_region"),
    )


def country_spellings(observed: DataFrame, iso_names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observed spellings (column country_raw) with their codes, and those nobody knows.

    ``iso_names`` gives (name, country_code, rank); of equal names the smallest rank counts.  Known
    non-countries get a null code, so that they are not reported again.
    """
    spark = observed.sparkSession
    seen = observed.select(trim_all(F.col("country_raw")).alias("country_raw")).where("country_raw != ''").distinct()
    aliases = spark.createDataFrame(list(COUNTRY_ALIASES.items()), "name string, country_code string").withColumn("rank", F.lit(-1))
    names = aliases.unionByName(iso_names.select(F.lower("name").alias("name"), "country_code", F.col("rank").cast("int").alias("rank")))
    best = names.groupBy("name").agg(F.min_by("country_code", "rank").alias("country_code"))
    known = seen.join(small(best), F.lower("country_raw") == F.col("name"), "left").withColumn("no_country", F.lower("country_raw").isin(NO_COUNTRY))
    seed = known.where(F.col("country_code").isNotNull() | F.col("no_country"))
    code = F.when(~F.col("no_country"), F.col("country_code"))
    return seed.select("country_raw", code.alias("country_code")), known.where(F.col("country_code").isNull() & ~F.col("no_country")).select("country_raw")


def new_companies(slugs: DataFrame, registry: DataFrame, ats: str) -> DataFrame:
    """Registry rows for slugs (pos, slug) that a source does not have yet: decoded, each once, titled names."""
    from ..functions.text import percent_decoded, titled

    given = slugs.select("pos", percent_decoded(F.col("slug")).alias("external_id")).groupBy("external_id").agg(F.min("pos").alias("pos"))
    known = registry.where(F.col("ats") == ats).select("external_id")
    new = given.join(known, "external_id", "left_anti")
    return new.select(titled(F.col("external_id")).alias("name"), "external_id", F.lit(ats).alias("ats"))
