"""Six publishers' payloads to incoming rows, by declared schemas.

Each parser takes landed files (content, company_slug, landed_at) and explodes their items; an
item's own text is kept as ``raw``.  A payload without its list, or an item without its id, stops
the job: silence would pass for a board without jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_to_null
from ..functions.values import first_of, from_epoch_ms, from_iso, from_rfc822, match_else_first, only_match, preferred_key, required
from ..schemas import MONEY, incoming, struct

GREENHOUSE = (
    "id bigint, title string, absolute_url string, company_name string, language string, content string, updated_at string, "
    "first_published string, application_deadline string, location struct<name:string>, departments array<struct<name:string>>, "
    "offices array<struct<location:string>>"
)
LEVER = (
    "id string, text string, hostedUrl string, description string, additional string, workplaceType string, country string, "
    "createdAt bigint, categories struct<location:string,team:string,commitment:string>, "
    f"salaryRange struct<min:{MONEY},max:{MONEY},currency:string,interval:string>"
)
ASHBY = (
    "id string, title string, jobUrl string, location string, department string, team string, employmentType string, "
    "workplaceType string, descriptionPlain string, isListed boolean, publishedAt string, "
    "address struct<postalAddress:struct<addressCountry:string>>, compensation struct<compensationTierSummary:string,"
    f"summaryComponents:array<struct<compensationType:string,interval:string,currencyCode:string,minValue:{MONEY},maxValue:{MONEY}>>>"
)
_TEXTS = "title:string,description:string,requirements:string,highlight:string"
RECRUITEE = (
    "id bigint, title string, description string, requirements string, highlight string, careers_url string, location string, "
    "country_code string, department string, employment_type_code string, remote boolean, hybrid boolean, on_site boolean, "
    f"published_at string, updated_at string, salary struct<min:{MONEY},max:{MONEY},currency:string,period:string>, "
    f"translations map<string,struct<{_TEXTS}>>"
)
TEAMTAILOR = (
    "guid string, title string, description string, pubDate string, link string, remoteStatus string, "
    "`tt:locations` struct<`tt:location`:array<struct<`tt:name`:string,`tt:city`:string,`tt:country`:string>>>, "
    "`tt:department` string, `tt:role` string"
)
WORKABLE = (
    "shortcode string, title string, url string, city string, state string, country string, locations array<struct<countryCode:string>>, "
    "telecommuting boolean, department string, employment_type string, education string, experience string, industry string, "
    "`function` string, published_on date, description string"
)
WORKABLE_DETAIL = (
    f"workplace string, language string, requirements string, benefits string, salary_from {MONEY}, salary_to {MONEY}, "
    "salary_currency_iso_code string, salary_frequency string"
)


def _items(files: DataFrame, envelope: str, path: Column, schema: str) -> DataFrame:
    """One row for each item: its text as ``raw``, its fields as ``x``."""
    whole = F.from_json("content", envelope)
    listed = files.withColumn("items", path(whole))
    listed = listed.withColumn("items", required(F.col("items"), "list of items"))
    raw = listed.select("company_slug", "landed_at", F.explode("items").alias("raw"))
    return raw.withColumn("x", F.from_json("raw", schema))


def _stamped(rows: DataFrame, source: str) -> DataFrame:
    """The source's incoming columns, with a file's landing time as first and last sight."""
    stamped = rows.withColumns({"first_seen_at": F.col("landed_at"), "last_seen_at": F.col("landed_at"), "id": required(F.col("id"), "id")})
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct(incoming(source))])


def greenhouse(files: DataFrame) -> DataFrame:
    rows = _items(files, "jobs array<string>", lambda w: w["jobs"], GREENHOUSE)
    return _stamped(
        rows.select(
            "*", "x.id", "x.title", F.col("x.absolute_url").alias("url"), F.col("x.location.name").alias("location"),
            F.col("x.company_name").alias("company"), first_of(F.col("x.departments"))["name"].alias("department"),
            first_of(F.col("x.offices"))["location"].alias("office"), "x.language", "x.content",
            from_iso(F.col("x.updated_at")).alias("updated_at"), from_iso(F.col("x.first_published")).alias("published_at"),
            from_iso(F.col("x.application_deadline")).alias("deadline_at"),
        ),
        "greenhouse",
    )


def lever(files: DataFrame) -> DataFrame:
    rows = _items(files, "array<string>", lambda w: w, LEVER)
    return _stamped(
        rows.select(
            "*", "x.id", F.col("x.text").alias("title"), F.col("x.hostedUrl").alias("url"), "x.categories.location",
            F.col("x.categories.team").alias("department"), "x.categories.commitment", F.col("x.workplaceType").alias("workplace_type"),
            "x.country", F.col("x.description").alias("content"), "x.additional", F.col("x.salaryRange.min").alias("salary_min"),
            F.col("x.salaryRange.max").alias("salary_max"), F.col("x.salaryRange.currency").alias("salary_currency"),
            F.col("x.salaryRange.interval").alias("salary_interval"), from_epoch_ms(F.col("x.createdAt")).alias("published_at"),
        ),
        "lever",
    )


def ashby(files: DataFrame) -> DataFrame:
    rows = _items(files, "jobs array<string>", lambda w: w["jobs"], ASHBY)
    pay = only_match(F.col("x.compensation.summaryComponents"), lambda c: c["compensationType"] == "Salary")
    rows = rows.withColumn("pay", pay)
    return _stamped(
        rows.select(
            "*", "x.id", "x.title", F.col("x.jobUrl").alias("url"), "x.location", "x.department", "x.team",
            F.col("x.employmentType").alias("employment_type"), F.col("x.workplaceType").alias("workplace_type"),
            F.col("x.address.postalAddress.addressCountry").alias("country"), F.col("x.descriptionPlain").alias("content"),
            F.col("x.isListed").alias("is_listed"), F.col("pay.minValue").alias("salary_min"), F.col("pay.maxValue").alias("salary_max"),
            F.col("pay.currencyCode").alias("salary_currency"), F.col("pay.interval").alias("salary_interval"),
            F.col("x.compensation.compensationTierSummary").alias("compensation_summary"), from_iso(F.col("x.publishedAt")).alias("published_at"),
        ),
        "ashby",
    )


def recruitee(files: DataFrame) -> DataFrame:
    rows = _items(files, "offers array<string>", lambda w: w["offers"], RECRUITEE)
    rows = rows.withColumn("lang", preferred_key(F.col("x.translations"), "en", "pt"))
    rows = rows.withColumn("told", F.try_element_at("x.translations", "lang"))

    def text(name: str) -> Column:
        """From the chosen translation, even if it says nothing; from the top level without any."""
        return F.when(F.col("lang").isNotNull(), F.col("told")[name]).otherwise(F.col("x")[name])

    return _stamped(
        rows.select(
            "*", "x.id", text("title").alias("title"), F.col("lang").alias("language"), F.col("x.careers_url").alias("url"), "x.location",
            "x.remote", "x.hybrid", "x.on_site", "x.country_code", "x.department", F.col("x.employment_type_code").alias("employment_type"),
            text("description").alias("content"), text("requirements").alias("requirements"), text("highlight").alias("highlight"),
            F.col("x.salary.min").alias("salary_min"), F.col("x.salary.max").alias("salary_max"), F.col("x.salary.currency").alias("salary_currency"),
            F.col("x.salary.period").alias("salary_period"), from_iso(F.col("x.published_at")).alias("published_at"),
            from_iso(F.col("x.updated_at")).alias("updated_at"),
        ),
        "recruitee",
    )


#: One token of a feed: a section whose text is no markup, a comment, an instruction, a declaration, a tag, or text.
FEED_TOKEN = (
    r"(?s)(<!\[CDATA\[.*?\]\]>|<!--.*?-->|<\?.*?\?>|<![A-Za-z][^>]*>"
    r"|</?[^!?/>\"'\s][^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|[^<]+|<)"
)


def feed_items(files: DataFrame) -> DataFrame:
    """One row for each item of a channel, its text as ``raw``; a feed that is not whole stops the load.

    The feed is read as tokens, so that markup inside a CDATA section or a comment is never a tag.  A fold
    over the tags keeps the depth: an item is what lies right below a channel that lies right below the root.
    """
    tokens = files.select("company_slug", "landed_at", F.regexp_extract_all("content", F.lit(FEED_TOKEN), F.lit(1)).alias("token"))

    def tag(t: Column, i: Column) -> Column:
        step = F.when(t == "<", 9).when(~t.rlike("^<[^!?]"), 8).when(t.startswith("</"), -1).when(t.endswith("/>"), 0).otherwise(1)
        return F.struct(i.alias("i"), step.alias("step"), F.regexp_extract(t, r"^</?([^\s/>]+)", 1).alias("name"))

    tags = tokens.withColumn("tag", F.filter(F.transform("token", tag), lambda x: x["step"] != 8))
    start = F.expr("named_struct('depth', 0, 'channel', false, 'channels', 0, 'from', 0, 'found', cast(array() AS array<struct<a:int,b:int>>))")

    def step(acc: Column, x: Column) -> Column:
        d, opens, ends = acc["depth"], x["step"] >= 0, x["step"] <= 0
        below = F.when(x["step"] == -1, d - 1).otherwise(d)  # the depth at which the tag's element lies
        channel = (below == 1) & (x["name"] == "channel")
        item = (below == 2) & acc["channel"] & (x["name"] == "item")
        begin = F.when(item & opens, x["i"]).otherwise(acc["from"])
        found = F.when(item & ends, F.array_append(acc["found"], F.struct(begin.alias("a"), x["i"].alias("b")))).otherwise(acc["found"])
        depth = F.when((d < 0) | (x["step"] == 9), F.lit(-1)).otherwise(d + x["step"])
        inside = F.when(channel, x["step"] == 1).otherwise(acc["channel"])
        return F.struct(
            depth.alias("depth"), inside.alias("channel"), (acc["channels"] + F.when(channel & opens, 1).otherwise(0)).alias("channels"),
            begin.alias("from"), found.alias("found"),
        )

    read = tags.withColumn("read", F.aggregate("tag", start, step))
    whole = (F.col("read.depth") == 0) & (F.col("read.channels") > 0)
    spans = F.when(F.coalesce(whole, F.lit(False)), F.col("read.found")).otherwise(F.raise_error(F.lit("the feed has no whole channel")))
    item = lambda x: F.array_join(F.slice("token", x["a"] + 1, x["b"] - x["a"] + 1), "")
    return read.withColumn("span", spans).select("company_slug", "landed_at", F.explode(F.transform("span", item)).alias("raw"))


def teamtailor(files: DataFrame) -> DataFrame:
    """RSS: each item's own text keeps its prefixes; an empty element is null."""
    # The parser needs no declared namespace for prefixed names.
    options = {"rowTag": "item", "ignoreSurroundingSpaces": "false"}
    rows = feed_items(files).withColumn("x", F.from_xml("raw", TEAMTAILOR, options))
    here = match_else_first(F.col("x")["tt:locations"]["tt:location"], lambda c: c["tt:country"].isin("Brazil", "Brasil"))
    rows = rows.withColumn("here", here)

    def text(name: str) -> Column:
        return empty_to_null(F.col("x")[name])

    return _stamped(
        rows.select(
            "*", F.col("x.guid").alias("id"), text("title").alias("title"), text("link").alias("url"),
            empty_to_null(F.col("here")["tt:name"]).alias("location"), empty_to_null(F.col("here")["tt:city"]).alias("city"),
            empty_to_null(F.col("here")["tt:country"]).alias("country"), text("remoteStatus").alias("remote_status"),
            text("tt:department").alias("department"), text("tt:role").alias("role"), text("description").alias("content"),
            from_rfc822(text("pubDate")).alias("published_at"),
        ),
        "teamtailor",
    )


def workable(files: DataFrame) -> DataFrame:
    """List entries of one shortcode are one posting: the first gives the fields, ``raw`` keeps all."""
    envelope = "account struct<jobs:array<string>>, details map<string,string>"
    whole = files.withColumn("w", required(F.from_json("content", envelope, {"mode": "FAILFAST"}), "payload"))
    listed = whole.select(
        "path", "company_slug", "landed_at", F.col("w.details").alias("details"), F.posexplode("w.account.jobs").alias("pos", "entry")
    ).withColumn("id", required(F.get_json_object("entry", "$.shortcode"), "shortcode"))
    grouped = listed.groupBy("path", "company_slug", "landed_at", "id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "entry"))).alias("entries"),  # one posting's entries in one file
        F.first(F.nullif(F.try_element_at("details", "id"), F.lit("{}"))).alias("raw_detail"),
    )
    entries = F.transform("entries", lambda e: e["entry"])
    rows = grouped.withColumns({
        "raw": F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]")),
        "x": F.from_json(F.get(entries, F.lit(0)), WORKABLE),
        "d": F.from_json("raw_detail", WORKABLE_DETAIL),
    })
    text = lambda c: empty_to_null(F.col(c))
    return _stamped(
        rows.select(
            "raw", "raw_detail", "company_slug", "landed_at", "id", F.col("x.title").alias("title"), F.col("x.url").alias("url"), F.col("x.city").alias("city"),
            F.col("x.state").alias("region"), F.col("x.country").alias("country"), first_of(F.col("x.locations"))["countryCode"].alias("country_code"),
            "x.telecommuting", text("x.department").alias("department"), text("x.employment_type").alias("employment_type"),
            text("x.education").alias("education"), text("x.experience").alias("experience"), text("x.industry").alias("industry"),
            text("x.function").alias("job_function"), "x.published_on", F.col("d.workplace").alias("workplace"), F.col("d.language").alias("language"),
            text("x.description").alias("content"), F.col("d.requirements").alias("requirements"), F.col("d.benefits").alias("benefits"),
            F.col("d.salary_from").alias("salary_min"), F.col("d.salary_to").alias("salary_max"), F.col("d.salary_currency_iso_code").alias("salary_currency"),
            F.col("d.salary_frequency").alias("salary_frequency"), F.col("raw_detail").isNotNull().alias("has_detail"),
        ),
        "workable",
    )


PARSERS = {
    "greenhouse": greenhouse, "lever": lever, "ashby": ashby, "recruitee": recruitee, "teamtailor": teamtailor, "workable": workable,
}
