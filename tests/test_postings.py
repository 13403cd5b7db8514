"""Payloads of six publishers through landing, parsing, merging, models, checks and questions."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.merge import merge_current_state, merge_postings
from quarrylake.plans import analytics, marts, quality
from quarrylake.plans.runner import Lake, build, load_day, nightly, run_all
from quarrylake.schemas import POSTINGS, UNIONED, struct
from quarrylake.sources import landing, seeds
from quarrylake.sources.parsers import PARSERS
from quarrylake.streaming.arrivals import merge_arrivals

LEVER = [
    {"id": "l1", "text": "Engineer", "hostedUrl": "u1", "description": "<p>Body</p>", "additional": " ", "opening": "<b>Hi</b>",
     "workplaceType": "remote", "country": "US", "createdAt": 1600000000000, "categories": {"location": "NYC", "team": "Core", "commitment": "Full-time"},
     "salaryRange": {"min": 100000, "max": 120000.5, "currency": "USD", "interval": "per-year-salary"},
     "lists": [{"text": "Must", "content": "<li>a</li><li>b</li>"}, {"text": "Nice", "content": "<li>c</li>"}]},
    {"id": "l2"},
]
ASHBY = {"jobs": [
    {"id": "a1", "title": "Dev", "workplaceType": "OnSite", "address": {"postalAddress": {"addressCountry": " Brazil "}}, "isListed": True,
     "employmentType": "FullTime", "publishedAt": "2026-09-25T10:47:06.123+00:00", "jobUrl": "u", "descriptionPlain": " text ",
     "compensation": {"compensationTierSummary": "s", "summaryComponents": [{"compensationType": "EquityPercentage"}, {"compensationType": "Salary", "minValue": 1, "maxValue": 2, "currencyCode": "EUR", "interval": "1 YEAR"}]}},
    {"id": "a2", "title": "Two", "address": None, "compensation": {"summaryComponents": [{"compensationType": "Salary", "minValue": 1}, {"compensationType": "Salary", "minValue": 2}]}},
]}
GREENHOUSE = {"jobs": [
    {"id": 7, "title": " Lead ", "absolute_url": "g", "company_name": "Acme", "location": {"name": "Remote - US"}, "departments": [{"name": "D1"}, {"name": "D2"}],
     "offices": [], "content": "&lt;p&gt;x&amp;amp;y&lt;/p&gt;", "updated_at": "2026-01-01T00:00:00-04:00", "first_published": "2026-01-01T00:00:00-04:00", "language": "en"},
    {"id": 8, "title": "Other", "location": {"name": "San Francisco, CA"}}, {"id": 9, "title": "Third", "location": {"name": "Seoul, South Korea"}}, {"id": 10, "title": "x", "location": None},
]}
RECRUITEE = {"offers": [
    {"id": 1, "title": "top", "translations": {"pt": {"title": "pt"}, "en": {"title": "en", "description": "<p>d</p>"}}, "remote": True, "hybrid": True, "country_code": "BR",
     "employment_type_code": "fulltime", "salary": {"min": "10", "max": None, "currency": "EUR", "period": "month"}, "published_at": "2026-09-25 10:47:06 UTC", "highlight": "h"},
    {"id": 2, "title": "top", "translations": {}, "requirements": "r"}, {"id": 3, "translations": {"nl": {"title": "nl"}, "de": {"title": "de"}}, "title": "top"},
]}
TEAMTAILOR = """<?xml version="1.0"?><rss xmlns:tt="x"><channel><title>Jobs</title><item><title>Dev</title><description>&lt;p&gt;Hi&lt;/p&gt;</description>
<pubDate>Wed, 30 Sep 2026 09:36:12 +0200</pubDate><link>http://t</link><guid>t1</guid><remoteStatus>fully</remoteStatus><tt:locations>
<tt:location><tt:name>L</tt:name><tt:city>Lisbon</tt:city><tt:country>Portugal</tt:country></tt:location>
<tt:location><tt:name>S</tt:name><tt:city>Sao Paulo</tt:city><tt:country>Brazil</tt:country></tt:location></tt:locations><tt:department>Eng</tt:department><tt:role/></item>
<item><guid>t2</guid></item></channel></rss>"""
WORKABLE = {"account": {"name": "W", "jobs": [
    {"shortcode": "w1", "title": "A", "city": "X", "country": "C", "locations": [{"countryCode": "BR"}], "telecommuting": True, "department": "", "published_on": "2026-09-01", "function": "IT"},
    {"shortcode": "w1", "title": "A", "city": "Y"}, {"shortcode": "w2", "title": "B", "telecommuting": False, "employment_type": "Full-time"},
]}, "details": {"w2": {"workplace": "on_site", "language": "en", "salary_from": 5, "salary_frequency": "year"}}}
PAYLOADS = {"lever": LEVER, "ashby": ASHBY, "greenhouse": GREENHOUSE, "recruitee": RECRUITEE, "workable": WORKABLE}
DAY = datetime(2026, 10, 6, 6, 35, 12)


def files(spark, source, payload, at=DAY):
    body = payload if isinstance(payload, str) else json.dumps(payload)
    return spark.createDataFrame([(f"{source}/ingest_date=2026-10-06/acme/063512.json", "acme", at, body)], "path string, company_slug string, landed_at timestamp, content string")


def parsed(spark, source, payload, at=DAY):
    return PARSERS[source](files(spark, source, payload, at))


def by_id(df):
    return {r["id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def words(spark):
    codes = [("US", "US"), ("UK", "GB"), ("Brazil", "BR"), ("BR", "BR"), ("South Korea", "KR"), ("Georgia", "GE"), ("CA", "CA"), ("Anywhere", None), ("Portugal", "PT")]
    countries = [("US", "United States", "Americas", "Northern America", "NAMER"), ("BR", "Brazil", "Americas", "Latin America and the Caribbean", "LATAM"), ("KR", "Korea", "Asia", "Eastern Asia", "APAC")]
    return seeds.seeds(
        spark, spark.createDataFrame(codes, "country_raw string, country_code string"),
        spark.createDataFrame(countries, "country_code string, country_name string, region string, sub_region string, business_region string"),
    )


def test_lever(spark):
    rows = by_id(parsed(spark, "lever", LEVER))
    one = rows["l1"]
    assert (one.title, one.url, one.location, one.department, one.commitment) == ("Engineer", "u1", "NYC", "Core", "Full-time")
    assert one.published_at == datetime(2020, 9, 13, 12, 26, 40) and float(one.salary_max) == 120000.5
    assert json.loads(one.raw) == LEVER[0] and one.first_seen_at == one.last_seen_at == one.landed_at == DAY and one.company_slug == "acme"
    assert rows["l2"].title is None and rows["l2"].published_at is None


def test_ashby(spark):
    rows = by_id(parsed(spark, "ashby", ASHBY))
    assert (rows["a1"].country, float(rows["a1"].salary_min), rows["a1"].salary_interval) == (" Brazil ", 1, "1 YEAR")
    assert rows["a2"].salary_min is None and rows["a2"].country is None
    assert parsed(spark, "ashby", {"jobs": []}).count() == 0


def test_a_payload_without_its_list_stops(spark):
    with pytest.raises(Exception, match="missing"):
        parsed(spark, "ashby", {"other": []}).collect()
    with pytest.raises(Exception, match="missing"):
        parsed(spark, "lever", [{"text": "no id"}]).collect()


def test_greenhouse(spark):
    rows = by_id(parsed(spark, "greenhouse", GREENHOUSE))
    assert (rows[7].department, rows[7].office, rows[7].updated_at) == ("D1", None, datetime(2026, 1, 1, 4))
    assert rows[10].location is None


def test_recruitee(spark):
    rows = by_id(parsed(spark, "recruitee", RECRUITEE))
    assert (rows[1].title, rows[1].language, rows[1].content, rows[1].highlight) == ("en", "en", "<p>d</p>", None)
    assert rows[1].published_at == datetime(2026, 9, 25, 10, 47, 6)
    assert (rows[2].title, rows[2].language, rows[2].requirements) == ("top", None, "r")
    assert (rows[3].title, rows[3].language) == ("de", "de")


def test_teamtailor(spark):
    rows = by_id(parsed(spark, "teamtailor", TEAMTAILOR))
    assert (rows["t1"].location, rows["t1"].city, rows["t1"].country, rows["t1"].role) == ("S", "Sao Paulo", "Brazil", None)
    assert rows["t1"].published_at == datetime(2026, 9, 30, 7, 36, 12) and rows["t1"].content == "<p>Hi</p>"
    assert "tt:department" in rows["t1"].raw and rows["t2"].title is None


def test_workable(spark):
    rows = by_id(parsed(spark, "workable", WORKABLE))
    assert (rows["w1"].city, rows["w1"].country_code, rows["w1"].department, rows["w1"].has_detail, rows["w1"].job_function) == ("X", "BR", None, False, "IT")
    assert len(json.loads(rows["w1"].raw)) == 2 and rows["w1"].raw_detail is None
    assert (rows["w2"].workplace, rows["w2"].has_detail, float(rows["w2"].salary_min)) == ("on_site", True, 5)


def state(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_rules(spark):
    ddl = "id int, c string, first_seen_at int, last_seen_at int"
    target = spark.createDataFrame([(1, "old", 5, 5), (2, "old", 5, 5), (3, "old", 5, 5), (5, "old", 5, 5)], ddl)
    source = spark.createDataFrame([(1, "new", 7, 7), (2, "new", 3, 3), (3, "new", 5, 5), (4, "new", 6, 6)], ddl)
    merged = merge_current_state(target, source)
    assert state(merged) == [(1, "new", 5, 7), (2, "old", 3, 5), (3, "old", 5, 5), (4, "new", 6, 6), (5, "old", 5, 5)]
    assert state(merge_current_state(merged, source)) == state(merged)


def test_merges_of_days_commute(spark):
    ddl = "id int, c string, first_seen_at int, last_seen_at int"
    days = [spark.createDataFrame([(i, f"{d}-{i}", d, d) for i in range(6) if (i + d) % 3], ddl) for d in range(1, 4)]
    empty, results = spark.createDataFrame([], ddl), []
    for order in ((0, 1, 2), (2, 0, 1), (1, 2, 0)):
        table = empty
        for k in order:
            table = merge_current_state(table, days[k])
        results.append(state(table))
    assert results[0] == results[1] == results[2]


def test_workable_keeps_details(spark):
    target = spark.createDataFrame([], struct(POSTINGS["workable"]))
    first = merge_postings("workable", target, parsed(spark, "workable", WORKABLE))
    later = datetime(2026, 10, 7, 6)
    no_detail = {"account": {"jobs": [{"shortcode": "w2", "title": "B2"}]}, "details": {}}
    row = by_id(merge_postings("workable", first, parsed(spark, "workable", no_detail, later)))["w2"]
    assert (row.title, row.workplace, row.detail_fetched_at, row.first_seen_at, row.last_seen_at) == ("B2", "on_site", DAY, DAY, later)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory, words):
    root = str(tmp_path_factory.mktemp("lake"))
    for source, payload in [*PAYLOADS.items(), ("teamtailor", TEAMTAILOR)]:
        body = payload if isinstance(payload, str) else json.dumps(payload)
        landing.write_bytes(spark, f"file://{root}/landing/{landing.landed_path(source, '2026-10-06', 'acme', DAY)}", body.encode())
    return Lake(spark, f"file://{root}/tables"), f"file://{root}/landing"


def test_nightly_run_and_models(spark, lake, words):
    tables, landed = lake
    verdicts = {s: load_day(tables, landed, s, "2026-10-06") for s in PARSERS}
    assert all((v["staging"], v["final"]) == ("pass", "pass") and "freshness" in v for v in verdicts.values())
    again = load_day(tables, landed, "lever", "2026-10-06")
    assert again["final"] == "pass" and tables.read("lever_postings", POSTINGS["lever"]).count() == 2

    companies = spark.createDataFrame([("Acme Inc", "acme", "lever"), ("Acme A", "acme", "ashby")], "name string, external_id string, ats string")
    with pytest.raises(ValueError, match="failed checks"):  # id-only items have no title: the tests must see that
        build(tables, words, companies)
    staged = {s: __import__("quarrylake.plans.staging", fromlist=["STAGING"]).STAGING[s](tables.read(f"{s}_postings", POSTINGS[s]), words) for s in PARSERS}
    assert all(df.count() == tables.read(f"{s}_postings", POSTINGS[s]).count() for s, df in staged.items())
    green = {r.source_job_id: r for r in staged["greenhouse"].collect()}
    assert (green["7"].country_code, green["7"].workplace_type, green["7"].description_text, green["7"].title) == ("US", "remote", "x&y", "Lead")
    assert (green["8"].country_code, green["8"].country_raw) == ("US", None)  # California, not Canada
    assert green["9"].country_code == "KR" and green["10"].workplace_type == "unknown"
    lever = {r.source_job_id: r for r in staged["lever"].collect()}
    assert lever["l1"].lists_text == "Must: a b\n\nNice: c" and lever["l1"].description_text == "Hi\n\nBody\n\nMust: a b\n\nNice: c"
    assert lever["l1"].salary_interval == "year" and lever["l1"].employment_type == "full_time" and lever["l2"].description_text is None
    ashby = {r.source_job_id: r for r in staged["ashby"].collect()}
    assert (ashby["a1"].country_code, ashby["a1"].workplace_type, ashby["a2"].workplace_type, ashby["a1"].country_raw) == ("BR", "in_person", "unknown", "Brazil")
    recruitee = {r.source_job_id: r for r in staged["recruitee"].collect()}
    assert (recruitee["1"].workplace_type, recruitee["1"].workplace_type_raw, recruitee["1"].description_text) == ("remote", "remote-hybrid", "d")
    workable = {r.source_job_id: r for r in staged["workable"].collect()}
    assert (workable["w1"].workplace_type, workable["w2"].workplace_type, workable["w1"].published_at) == ("remote", "in_person", datetime(2026, 9, 1))

    union = marts.postings_unioned(staged, companies)
    assert union.columns == ["posting_key", *UNIONED, "company_name"] and union.count() == sum(df.count() for df in staged.values())
    names = {r.posting_key: r.company_name for r in union.collect()}
    assert names["lever/l1"] == "Acme Inc" and names["ashby/a1"] == "Acme A" and names["greenhouse/7"] is None
    countries, fact = marts.dim_country(words["countries"]), marts.fct_job_postings(union)
    remote = marts.remote_jobs(fact, countries)
    k = analytics.kpi(fact).first()
    assert (k.open_postings, k.as_of) == (fact.count(), fact.select(F.date_format(F.max("last_seen_at"), "yyyy-MM-dd")).first()[0])
    assert sum(r.postings for r in analytics.by_region(remote).collect()) == remote.count() == k.open_remote
    share = {r.source: r for r in analytics.workplace_share(fact).collect()}
    assert share["greenhouse"].remote == 1 and share["greenhouse"].remote_share == 25.0
    assert analytics.latest(remote).first().pay is not None or analytics.latest(remote).count()
    for table in (analytics.by_country(remote), analytics.by_employment(remote), analytics.top_companies(remote), analytics.per_source(fact)):
        table.collect()


@pytest.mark.parametrize("source, body", [("workable", "<html>502</html>"), ("workable", '{"account": {"jobs": [{"shortcode"'), ("workable", ""), ("teamtailor", TEAMTAILOR[:-60]), ("teamtailor", "<html/>"), ("lever", "oops")])
def test_payloads_that_cannot_be_read_stop_the_load(spark, source, body):
    with pytest.raises(Exception):
        parsed(spark, source, body).collect()


def test_a_missing_board_is_an_error_in_the_nightly_run(spark, lake, words, tmp_path):
    _, landed = lake
    tables = Lake(spark, f"file://{tmp_path}/t")
    names = [("Acme", "acme", "lever"), ("Gone", "gone", "lever"), ("Lost", "lost", "lever"), ("Acme", "acme", "ashby")]
    tables.write("companies", spark.createDataFrame(names, "name string, external_id string, ats string"))
    results = nightly(tables, landed, "2026-10-06", words)
    assert "files" in results["lever"] and results["lever"].startswith("error")
    assert load_day(tables, landed, "lever", "2026-10-06", failed={"gone", "lost"})["files"] == "warn"
    assert load_day(tables, landed, "ashby", "2026-10-06")["files"] == "pass"
    assert spark.read.parquet(f"{tables.root}/runs").count() == len(PARSERS) + 1


def test_a_failed_source_does_not_stop_the_rest(spark, lake, words):
    tables, landed = lake
    results = nightly(tables, landed + "/nowhere", "2026-10-06", words)
    assert all(r.startswith("error") for s, r in results.items() if s in PARSERS)
    done = run_all(tables, {"bad": lambda: 1 / 0, "good": lambda: None})
    assert done["good"] == "pass" and done["bad"].startswith("error")
    runs = spark.read.parquet(f"{tables.root}/runs")
    assert {r.status for r in runs.where("model = 'good'").collect()} == {"pass"} and {r.status for r in runs.where("model = 'bad'").collect()} == {"error"}


def test_open_means_seen_on_the_sources_last_day(spark):
    rows = [("a", datetime(2026, 1, 2, 1)), ("a", datetime(2026, 1, 2, 23)), ("a", datetime(2026, 1, 1)), ("b", datetime(2026, 1, 1))]
    from quarrylake.operators.profile import open_on_last_day

    df = open_on_last_day(spark.createDataFrame(rows, "source string, last_seen_at timestamp"), "source", "last_seen_at")
    assert sorted((r.source, r.last_seen_at.day, r.is_open) for r in df.collect()) == [("a", 1, False), ("a", 2, True), ("a", 2, True), ("b", 1, True)]


def test_arrivals_as_a_stream(spark, lake, tmp_path):
    tables, landed = lake
    own = Lake(spark, f"file://{tmp_path}/tables")
    for _ in range(2):  # the second run finds nothing new
        merge_arrivals(own, landed, "lever", f"file://{tmp_path}/checkpoint").awaitTermination()
    assert own.read("lever_postings", POSTINGS["lever"]).count() == 2


def test_file_verdicts():
    e = {"a", "b", "c", "d"}
    assert quality.files_verdict(e, dict.fromkeys(e, 1)) == ("pass", set())
    assert quality.files_verdict(e, {})[0] == "error"
    assert quality.files_verdict(e, {"a": 1, "b": 1}) == ("warn", {"c", "d"})  # exactly half
    assert quality.files_verdict(e, {"a": 1})[0] == "error"
    assert quality.files_verdict(e, {"a": 1}, {"b", "c", "d"})[0] == "warn"
    assert quality.files_verdict(e, {"a": 1, "b": 1, "c": 1}, {"x"}) == ("error", {"d"})


def test_count_verdicts():
    assert quality.staging_verdict(0, 1, 1) == "error" and quality.staging_verdict(5, 3, 2, False) == "error"
    assert quality.staging_verdict(5, 2, 3) == "error" and quality.staging_verdict(5, 2, 3, False) == "warn" and quality.staging_verdict(5, 3, 3) == "pass"
    assert quality.final_verdict(2, 1, 0) == quality.final_verdict(2, 2, 1) == "error" and quality.final_verdict(2, 2, 0) == "pass"


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1),)], "last_seen_at timestamp")
    got = [quality.freshness(df, datetime(2026, 1, d, h)).first().status for d, h in ((2, 0), (2, 8), (3, 2))]
    assert got == ["pass", "warn", "error"] and quality.freshness(df.limit(0), datetime(2026, 1, 1)).first().status == "error"


def test_seed_checks_find_duplicates(spark, words):
    assert set(quality.run_checks(quality.seed_checks(words)).values()) == {"pass"}
    twice = words | {"us_states": words["us_states"].union(words["us_states"].limit(1))}
    assert quality.run_checks(quality.seed_checks(twice))["us_states key"] == "error"


def test_retries_and_truncated_pages():
    tries = []

    def flaky(slug):
        tries.append(slug)
        if len(tries) < 3:
            raise landing.Unavailable(503)
        return b"x"

    assert landing.with_retries(flaky, "a", pause=0) == b"x" and landing.with_retries(lambda s: (_ for _ in ()).throw(landing.Unavailable(404)), "a", pause=0) is None
    assert landing.not_truncated(b"<item>" * 2, page=2) is None and landing.not_truncated(b"<item>", page=2) == b"<item>"


def test_details_to_fetch(spark):
    details = spark.createDataFrame([("a", datetime(2026, 1, 9)), ("b", datetime(2026, 1, 1)), ("c", None)], "id string, detail_fetched_at timestamp")
    fresh = landing.fresh_details(details, "2026-01-10", 7)
    assert [r.id for r in fresh.collect()] == ["a"]
    wanted = spark.createDataFrame([(0, "x"), (1, "a"), (2, "y"), (3, "x"), (4, "z")], "pos int, id string")
    assert [r.id for r in landing.to_fetch(wanted, fresh, 2).orderBy("pos").collect()] == ["x", "y"] and landing.to_fetch(wanted, fresh, -1).count() == 0


def test_country_seeds(spark, tmp_path):
    iso = spark.createDataFrame([("GB", "UK of GB", "Europe", "Northern Europe"), ("TW", "Taiwan", "", ""), ("AQ", "Antarctica", "", ""), ("NA", "Namibia", "Africa", "Sub-Saharan Africa"), (None, "x", "", "")], "code string, name string, region string, sub_region string")
    rows = {r.country_code: r for r in seeds.country_rows(iso).collect()}
    assert rows["GB"].country_name == "United Kingdom" and rows["TW"].business_region == "APAC" and rows["AQ"].business_region is None and rows["XK"].business_region == "EMEA"
    names = spark.createDataFrame([("Brazil", "BR", 2), ("BRA", "BR", 1)], "name string, country_code string, rank int")
    seen = spark.createDataFrame([(" Brazil ",), ("BRASIL",), ("Remote",), ("Atlantis",), ("",)], "country_raw string")
    known, unknown = seeds.country_spellings(seen, names)
    assert {tuple(r) for r in known.collect()} == {("Brazil", "BR"), ("BRASIL", "BR"), ("Remote", None)} and [r[0] for r in unknown.collect()] == ["Atlantis"]
    seeds.write_seed(seeds.country_rows(iso), f"file://{tmp_path}/c.csv")
    back = {r.country_code: r for r in seeds.read_seed(spark, f"file://{tmp_path}/c.csv", "countries").collect()}
    assert back == rows


def test_new_companies(spark):
    registry = spark.createDataFrame([("Acme", "acme", "lever")], "name string, external_id string, ats string")
    slugs = spark.createDataFrame([(0, "it%20labs"), (1, "acme"), (2, "it%20labs"), (3, "o-neil")], "pos int, slug string")
    assert {tuple(r) for r in seeds.new_companies(slugs, registry, "lever").collect()} == {("It Labs", "it labs", "lever"), ("O Neil", "o-neil", "lever")}
    assert DAY.replace(tzinfo=timezone.utc)
