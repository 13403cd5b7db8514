"""The library's operators as queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as t
from .functions import values as val
from .functions import vocabulary as voc
from .operators import distinct, lookups, profile
from .operators.merge import latest_per_key, merge_current_state
from .plans import analytics, marts, quality
from .plans.staging import STAGING
from .sources import seeds
from .sources.extract import details_to_fetch
from .sources.lake import Lake
from .sources.landing import files_per_company, to_fetch
from .sources.parsers import PARSERS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder by name; only the columns that a query uses are read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def rows(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)


def query(sql: str) -> Callable:
    """Register a query under its function's name with its SQL."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        SQL[f.__name__] = sql
        return f

    return register


def values_sql(rows: list[tuple]) -> str:
    cell = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + ")"


TRIM_SQL = r"regexp_replace({}, '^[\t-\r\x{{85}}\p{{Z}}]+|[\t-\r\x{{85}}\p{{Z}}]+$', '', 'g')"


def html_sql(c: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    bare = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    plain = reduce(lambda e, p: f"replace({e}, {quote(p[0])}, {quote(p[1])})", [*t.ENTITIES, ("&amp;", "&")], bare)
    return TRIM_SQL.format(rf"regexp_replace({plain}, '[\t\n\f\r ]+', ' ', 'g')")


# Text and free-text rules


@query(f"SELECT page_id, {html_sql('html')} AS body FROM pages")
def html_to_text_pages(d):
    return d.pages.select("page_id", t.html_to_text(F.col("html")).alias("body"))


@query(f"SELECT page_id, nullif({html_sql(html_sql('html'))}, '') AS body FROM pages")
def html_to_text_twice(d):
    return d.pages.select("page_id", t.empty_to_null(t.html_to_text(t.html_to_text(F.col("html")))).alias("body"))


@query("SELECT doc_id, " + TRIM_SQL.format("' \t' || text || '\n '") + " AS body FROM documents")
def trim_unicode(d):
    return d.documents.select("doc_id", t.trim_all(F.concat(F.lit(" \t"), "text", F.lit("\n "))).alias("body"))


@query("SELECT p_partkey, " + TRIM_SQL.format("split(regexp_replace(p_name, ' ', ',', 'g'), ',')[-1]") + " AS last_word FROM part")
def last_piece(d):
    return d.part.select("p_partkey", t.last_piece(F.col("p_name"), " ").alias("last_word"))


PIECES = [("fr", "FR"), ("en", "GB"), ("de", "DE"), ("x", "XX"), ("top", "TP"), ("ref", None)]


@query(
    "WITH p AS (SELECT page_id, " + TRIM_SQL.format("split(regexp_replace(url, '[/?=&#]+', ',', 'g'), ',')[-1]") + " AS piece FROM pages) "
    f"SELECT page_id, piece, c.spelling, c.code FROM p LEFT JOIN {values_sql(PIECES)} c(spelling, code) "
    "ON p.piece = c.spelling AND (length(piece) > 2 OR piece IN ('fr', 'en'))"
)
def lookup_residual_join(d):
    pages = d.pages.select("page_id", t.last_piece(F.col("url"), "[/?=&#]+").alias("piece"))
    seed = d.rows(PIECES, "country_raw string, country_code string")
    guard = (F.length("piece") > 2) | F.col("piece").isin("fr", "en")
    return lookups.country_of(pages, seed, F.col("piece"), also=guard).select("page_id", "piece", F.col("_spelling").alias("spelling"), F.col("_code").alias("code"))


COMMITMENT_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(x), '{p}') THEN '{v}'" for p, v in voc.COMMITMENTS) + " END"
#: Ends of commitments, by a part's size.
WORDS = [(1, "International Permanent"), (2, "Contractor Full-Time"), (3, "Intern / Part-Time"), (4, "Sales"), (5, "FT"), (6, "Fixed Term"), (7, None), (8, "ft\n"), (9, "Per-diem")]


@query(f"SELECT p_partkey, x AS commitment, {COMMITMENT_SQL} AS employment_type FROM (SELECT p_partkey, p_type || ' ' || w.x AS x FROM part LEFT JOIN {values_sql(WORDS)} w(id, x) ON id = p_size % 10)")
def employment_from_text(d):
    said = d.part.join(lookups.small(d.rows(WORDS, "id int, x string")), F.col("id") == F.col("p_size") % 10, "left")
    said = said.select("p_partkey", F.concat("p_type", F.lit(" "), "x").alias("commitment"))
    return said.select("p_partkey", "commitment", voc.employment_from_text(F.col("commitment")).alias("employment_type"))


TYPE_RULES = [("^promo", "promo"), ("steel|tin", "metal"), ("brushed.{0,12}copper", "brushed"), ("copper|brass|nickel", "alloy")]


@query(
    "SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(lower(p_type), '{p}') THEN '{v}'" for p, v in TYPE_RULES) + " END AS kind FROM part"
)
def regex_case_order(d):
    return d.part.select("p_partkey", voc.first_pattern(F.lower("p_type"), TYPE_RULES).alias("kind"))


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'remote|token') THEN 'yes' ELSE 'no' END AS says, "
       "nullif(regexp_extract(text, '[0-9]+', 0), '') AS first_number FROM documents")  # fmt: skip
def regex_find(d):
    says = F.when(t.matches(F.lower("text"), "remote|token"), "yes").otherwise("no")
    return d.documents.select("doc_id", says.alias("says"), t.first_match(F.col("text"), "[0-9]+").alias("first_number"))


@query("""SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS folder,
          contains(html, '<script') AS scripted FROM pages""")
def path_pieces(d):
    return d.pages.select("page_id", t.path_piece(F.col("url"), 3).alias("host"), t.path_piece(F.col("url"), 4).alias("folder"), F.contains("html", F.lit("<script")).alias("scripted"))


@query("SELECT page_id, url_decode(replace(replace(url, '+', '%2B') || '%20a+b', 'a+b', 'a%2Bb')) AS plain FROM pages")
def percent_decode(d):
    return d.pages.select("page_id", t.percent_decoded(F.concat("url", F.lit("%20a+b"))).alias("plain"))


@query("""SELECT s_suppkey, CASE WHEN s_acctbal IS NOT NULL OR low IS NOT NULL THEN
            coalesce(format('{:,}', cast(round(low) AS BIGINT)), '?') || ' - ' || coalesce(format('{:,}', cast(round(cast(s_acctbal AS DECIMAL(38,9))) AS BIGINT)), '?')
            || ' ' || coalesce(currency, '') || ' / ' || coalesce(span, '?') END AS pay
          FROM (SELECT *, CASE WHEN s_suppkey % 3 > 0 THEN cast(s_suppkey * 1000.5 AS DECIMAL(38,9)) END AS low,
                CASE WHEN s_suppkey % 2 = 0 THEN 'EUR' END AS currency, CASE WHEN s_suppkey % 5 = 0 THEN 'year' END AS span FROM supplier)""")
def pay_label(d):
    money = "decimal(38,9)"
    low = F.when(F.col("s_suppkey") % 3 > 0, (F.col("s_suppkey") * F.lit(1000.5).cast("decimal(6,1)")).cast(money))
    currency, span = F.when(F.col("s_suppkey") % 2 == 0, "EUR"), F.when(F.col("s_suppkey") % 5 == 0, "year")
    return d.supplier.select("s_suppkey", t.pay_label(low, F.col("s_acctbal").cast(money), currency, span).alias("pay"))


@query("SELECT n_nationkey, upper(left(replace('full_' || n_name, '_', ' '), 1)) || lower(substr(replace('full_' || n_name, '_', ' '), 2)) AS shown FROM nation")
def spoken_words(d):
    return d.nation.select("n_nationkey", t.spoken(F.concat(F.lit("full_"), "n_name")).alias("shown"))


@query("""SELECT doc_id, nullif(array_to_string(list_filter([nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''), source,
            nullif(text, '')], lambda x: x IS NOT NULL), chr(10) || chr(10)), '') AS body FROM documents""")
def assemble_sections(d):
    lang = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return d.documents.select("doc_id", t.join_sections(lang, F.col("source"), F.col("text")).alias("body"))


# Values


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(user_id AS VARCHAR) AS nested,
          CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) END AS sometimes_object, CASE WHEN event_id % 5 = 0 THEN event_type END AS sometimes_absent FROM events""")
def json_scalar(d):
    js = F.to_json(F.struct(F.struct(F.col("user_id").alias("b")).alias("a")))
    mixed = F.when(F.col("event_id") % 3 == 0, F.to_json(named(a=F.col("event_id")))).otherwise(js)
    absent = F.to_json(named(c=F.when(F.col("event_id") % 5 == 0, F.col("event_type"))))
    return d.events.select(
        "event_id", val.json_scalar(F.col("props"), "$.k").alias("k"), val.json_scalar(js, "$.a.b").alias("nested"),
        val.json_scalar(mixed, "$.a").alias("sometimes_object"), val.json_scalar(absent, "$.c").alias("sometimes_absent"),
    )


@query("""SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS body, count(*) AS turns FROM conversations GROUP BY conv_id""")
def json_array_agg(d):
    return d.conversations.groupBy("conv_id").agg(
        F.expr("listagg(concat(role, ': ', text), '\n') within group (order by turn)").alias("body"), F.count(F.lit(1)).alias("turns")
    )


@query("""SELECT event_id, json_extract_string(props, '$.k') AS first_item, CAST(1 + user_id % 4 AS INTEGER) AS items FROM events""")
def json_array_items(d):
    more = F.repeat(F.lit(',{"z":1}'), (F.col("user_id") % 4).cast("int"))
    items = val.json_array(F.concat(F.lit('{"l":['), F.get_json_object("props", "$.k"), more, F.lit("]}")), "$.l")
    return d.events.select("event_id", val.first_of(items).alias("first_item"), F.size(items).alias("items"))


@query("""SELECT conv_id, role AS first_role, text AS first_text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""")
def first_group_in_order(d):
    first = F.min_by(F.struct("role", "text"), "turn")
    return d.conversations.groupBy("conv_id").agg(first.alias("first")).select("conv_id", F.col("first.role").alias("first_role"), F.col("first.text").alias("first_text"))


@query("""SELECT conv_id, [x.text FOR x IN list_sort(list({'turn': turn, 'text': text})) IF x.turn % 2 = 1] [1] AS first_reply,
          CASE WHEN count(*) FILTER (WHERE turn % 2 = 1) = 1 THEN max(CASE WHEN turn % 2 = 1 THEN text END) END AS only_reply
          FROM conversations GROUP BY conv_id""")
def array_choice(d):
    grouped = d.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    odd = lambda x: x["turn"] % 2 == 1
    return grouped.select(
        "conv_id", F.get(F.filter("turns", odd), F.lit(0))["text"].alias("first_reply"), val.only_match(F.col("turns"), odd)["text"].alias("only_reply")
    )


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'en' WHEN doc_id % 4 = 1 THEN 'pt' WHEN doc_id % 4 = 2 THEN 'de' END AS chosen,
          CASE WHEN doc_id % 4 < 3 THEN source END AS told FROM documents""")
def map_preference(d):
    keys = F.when(F.col("doc_id") % 4 == 0, F.array(F.lit("pt"), F.lit("en"))).when(F.col("doc_id") % 4 == 1, F.array(F.lit("de"), F.lit("pt"))).when(F.col("doc_id") % 4 == 2, F.array(F.lit("fr"), F.lit("de"))).otherwise(F.array().cast("array<string>"))
    told = F.map_from_arrays(keys, F.transform(keys, lambda k: F.col("source")))
    chosen = val.preferred_key(told, "en", "pt")
    return d.documents.select("doc_id", chosen.alias("chosen"), F.try_element_at(told, chosen).alias("told"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS minute, CAST(o_orderdate AS DATE) AS on_day, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def fmt_ts(d):
    at = F.col("o_orderdate")
    return d.orders.select("o_orderkey", val.day_text(at).alias("day"), val.minute_text(at).alias("minute"), val.day(at).alias("on_day"), F.trunc(val.day(at), "MONTH").alias("month"))


@query("""SELECT event_id, strftime(make_timestamp(event_id * 1000 * 86400), '%Y-%m-%d %H:%M') AS from_ms,
          strftime(CAST(ts AS DATE), '%Y-%m-%d') || ' 07:36' AS from_mail, strftime(CAST(ts AS DATE), '%Y-%m-%d') || ' 00:00' AS midnight FROM events""")
def parse_times(d):
    mail = F.concat(F.lit("Mon, "), F.date_format("ts", "d MMM yyyy"), F.lit(" 09:36:12 +0200"))
    return d.events.select(
        "event_id", val.minute_text(val.from_epoch_ms(F.col("event_id") * 86400)).alias("from_ms"), val.minute_text(val.from_rfc822(mail)).alias("from_mail"),
        val.minute_text(val.midnight(val.day(F.col("ts")))).alias("midnight"),
    )


@query("""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(CAST(o_totalprice AS DECIMAL(18,2))) / pow(1024, 1), 1) AS kib,
          count(*) AS jobs FROM orders GROUP BY 1""")
def month_rollup(d):
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return d.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "MONTH").alias("month")).agg(F.round(price / F.pow(F.lit(1024.0), F.lit(1)), 1).alias("kib"), F.count(F.lit(1)).alias("jobs"))


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'remote' WHEN quality = 1 THEN 'hybrid' WHEN doc_id % 2 = 0 THEN 'in_person' ELSE 'unknown' END AS workplace FROM labels""")
def flags_priority(d):
    place = voc.workplace_from_flags(F.col("toxic") == 1, F.col("quality") == 1, F.when(F.col("doc_id") % 2 == 0, F.lit(True)))
    return d.labels.select("doc_id", place.alias("workplace"))


@query("""SELECT doc_id, nullif(array_to_string(list_filter([CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 1 THEN 'quality' END], lambda x: x IS NOT NULL), '-'), '') AS flags FROM labels""")
def flags_joined(d):
    return d.labels.select("doc_id", voc.flags_joined("-", toxic=F.col("toxic") == 1, quality=F.col("quality") == 1).alias("flags"))


# Newest rows and merges


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_user(d):
    return latest_per_key(d.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


ORDER_HALF = """SELECT o_custkey AS id, o_orderkey, o_orderpriority, o_orderstatus = 'F' AS has_detail, CAST(o_orderdate AS DATE) AS first_seen_at, CAST(o_orderdate AS DATE) AS last_seen_at
  FROM orders WHERE {} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
MERGE_SQL = """WITH t AS ({t}), s AS ({s})
SELECT coalesce(t.id, s.id) AS id,
  CASE WHEN t.id IS NULL OR t.last_seen_at < s.last_seen_at THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
  CASE WHEN t.id IS NULL OR (t.last_seen_at < s.last_seen_at AND {guard}) THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
  CASE WHEN t.id IS NULL THEN s.first_seen_at WHEN t.last_seen_at < s.last_seen_at THEN t.first_seen_at
       WHEN s.first_seen_at < t.first_seen_at THEN s.first_seen_at ELSE t.first_seen_at END AS first_seen_at,
  CASE WHEN t.id IS NULL OR t.last_seen_at < s.last_seen_at THEN s.last_seen_at ELSE t.last_seen_at END AS last_seen_at
FROM t FULL OUTER JOIN s ON t.id = s.id"""
#: Halves of the orders by month, so that either side has newer rows for some customers.
EVEN, ODD = "month(o_orderdate) % 2 = 0", "month(o_orderdate) % 2 = 1"


def order_half(d: Tables, condition: str) -> DataFrame:
    rows = d.orders.where(condition).select(
        F.col("o_custkey").alias("id"), "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").alias("has_detail"),
        F.to_date("o_orderdate").alias("first_seen_at"), F.to_date("o_orderdate").alias("last_seen_at"),
    )
    return latest_per_key(rows, ["id"], [F.col("last_seen_at"), F.col("o_orderkey")])


@query(MERGE_SQL.format(t=ORDER_HALF.format(EVEN), s=ORDER_HALF.format(ODD), guard="true"))
def merge_newest(d):
    return merge_current_state(order_half(d, EVEN).drop("has_detail"), order_half(d, ODD))


@query(MERGE_SQL.format(t=ORDER_HALF.format(EVEN), s=ORDER_HALF.format(ODD), guard="s.has_detail"))
def merge_guarded(d):
    return merge_current_state(order_half(d, EVEN).drop("has_detail"), order_half(d, ODD), guarded=["o_orderpriority"], guard="has_detail")


@query("SELECT * FROM (" + MERGE_SQL.format(t=ORDER_HALF.format(EVEN), s=ORDER_HALF.format(ODD), guard="true") + ")")
def merge_again(d):
    """Merging the same rows once more changes nothing."""
    source = order_half(d, ODD)
    return merge_current_state(merge_current_state(order_half(d, EVEN).drop("has_detail"), source), source)


# Lookups, unions and dimensions

EVENT_WORDS = [("web", "click", "use"), ("web", "view", "use"), ("web", "purchase", "buy"), ("app", "signup", "join")]


@query(f"SELECT event_id, event_type, m.common FROM events LEFT JOIN {values_sql(EVENT_WORDS)} m(source, word, common) ON m.source = 'web' AND m.word = event_type")
def seed_translate_left(d):
    seed = d.rows(EVENT_WORDS, "source string, word string, common string")
    return lookups.translate(d.events.select("event_id", "event_type"), seed, "web", F.col("event_type"), "word", "common", "common")


@query(f"""SELECT event_type, count(*) AS n FROM events LEFT JOIN {values_sql(EVENT_WORDS)} m(source, word, common) ON m.source = 'web' AND m.word = event_type
           WHERE event_type IS NOT NULL AND m.common IS NULL GROUP BY event_type""")
def seed_unmapped(d):
    return profile.counts(quality.unmapped(seed_translate_left(d), "event_type", "common"), "event_type", name="n")


@query("""SELECT l_linestatus, count(*) AS rows_total, count(o_orderkey) AS matched FROM lineitem LEFT JOIN orders
          ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus GROUP BY l_linestatus""")
def left_composite_join(d):
    lines = d.lineitem.select(F.col("l_orderkey").alias("key"), "l_linestatus")
    orders = d.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("l_linestatus"), "o_orderkey")
    joined = lines.join(orders, ["key", "l_linestatus"], "left")
    return joined.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("rows_total"), F.count("o_orderkey").alias("matched"))


@query("""SELECT 'customer/' || c_custkey AS key, 'customer' AS source, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DECIMAL(38,9)) AS price FROM customer
          UNION ALL SELECT 'supplier/' || s_suppkey, 'supplier', s_name, NULL, NULL FROM supplier
          UNION ALL SELECT 'part/' || p_partkey, 'part', p_name, NULL, CAST(p_retailprice AS DECIMAL(38,9)) FROM part""")
def union_typed_nulls(d):
    def side(df, source, key, name):
        return df.select(F.concat(F.lit(source + "/"), F.col(key).cast("string")).alias("key"), F.lit(source).alias("source"), F.col(name).alias("name"), "*")

    none = lambda kind: F.lit(None).cast(kind)
    money = "decimal(38,9)"
    parts = [
        side(d.customer, "customer", "c_custkey", "c_name").withColumns({"segment": F.col("c_mktsegment"), "price": none(money)}),
        side(d.supplier, "supplier", "s_suppkey", "s_name").withColumns({"segment": none("string"), "price": none(money)}),
        side(d.part, "part", "p_partkey", "p_name").withColumns({"segment": none("string"), "price": F.col("p_retailprice").cast(money)}),
    ]
    return reduce(DataFrame.unionByName, [p.select("key", "source", "name", "segment", "price") for p in parts])


def nation_dim(d: Tables) -> DataFrame:
    return d.nation.select("n_nationkey", "n_name").unionByName(d.rows([(-1, "Unknown")], "n_nationkey int, n_name string"))


NATION_SQL = "(SELECT n_nationkey, n_name FROM nation UNION ALL SELECT -1, 'Unknown')"


@query(f"SELECT n_nationkey, n_name FROM {NATION_SQL}")
def dim_with_unknown(d):
    return nation_dim(d)


@query(f"SELECT n_name, count(*) AS customers FROM customer JOIN {NATION_SQL} n ON n.n_nationkey = CASE WHEN c_acctbal >= 0 THEN c_nationkey ELSE -1 END GROUP BY n_name")
def fact_unknown_key(d):
    key = F.coalesce(F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")), F.lit(-1))
    facts = d.customer.select(key.alias("n_nationkey"))
    return profile.counts(facts.join(lookups.small(nation_dim(d)), "n_nationkey"), "n_name", name="customers")


@query("""SELECT e.event_type, count(*) FILTER (WHERE CAST(ts AS DATE) = last_day) AS open_events, count(*) FILTER (WHERE CAST(ts AS DATE) <> last_day) AS closed_events
          FROM events e JOIN (SELECT event_type, max(CAST(ts AS DATE)) AS last_day FROM events GROUP BY 1) m ON e.event_type = m.event_type GROUP BY 1""")
def open_by_source_day(d):
    marked = profile.open_on_last_day(d.events.select("event_type", "ts"), "event_type", "ts")
    return marked.groupBy("event_type").agg(F.count_if("is_open").alias("open_events"), F.count_if(~F.col("is_open")).alias("closed_events"))


# Aggregates and top lists


@query("""SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS returned_final,
          count(*) AS rows_total, CAST(max(l_shipdate) AS DATE) AS as_of, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM lineitem""")
def kpi_countif(d):
    back = F.col("l_returnflag") == "R"
    return d.lineitem.agg(
        F.count_if(back).alias("returned"), F.count_if(back & (F.col("l_linestatus") == "F")).alias("returned_final"), F.count(F.lit(1)).alias("rows_total"),
        F.to_date(F.max("l_shipdate")).alias("as_of"), F.sum("l_linenumber").alias("line_sum"),
    )


@query("""SELECT count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey || '/' || l_suppkey END) AS pairs,
          count(DISTINCT CASE WHEN l_linestatus = 'O' AND l_suppkey <> 1 THEN l_suppkey END) AS suppliers FROM lineitem""")
def conditional_distinct(d):
    pair = F.concat(F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string"))
    return d.lineitem.agg(
        F.countDistinct(F.when(F.col("l_returnflag") == "R", pair)).alias("pairs"),
        F.countDistinct(F.when((F.col("l_linestatus") == "O") & (F.col("l_suppkey") != 1), F.col("l_suppkey"))).alias("suppliers"),
    )


@query("""SELECT n_name AS country, count(*) AS postings FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          WHERE o_orderstatus <> 'P' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""")
def topk_groups(d):
    orders = d.orders.where("o_orderstatus != 'P'").select("o_custkey")
    customers = d.customer.select("c_custkey", "c_nationkey").join(lookups.small(d.nation.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    named = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return profile.top(profile.counts(named, F.col("n_name").alias("country")), 12, F.desc("postings"), F.asc("country"))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey FROM orders WHERE o_orderpriority IS NOT NULL ORDER BY o_orderdate DESC, o_orderkey LIMIT 1500""")
def latest_n(d):
    newest = profile.top(d.orders.where("o_orderpriority IS NOT NULL").select("o_orderdate", "o_orderkey"), 1500, F.desc("o_orderdate"), F.asc("o_orderkey"))
    return newest.select(val.day_text(F.col("o_orderdate")).alias("day"), "o_orderkey")


@query("""WITH c AS (SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS F, count(*) FILTER (WHERE l_linestatus = 'O') AS O,
          count(*) FILTER (WHERE l_linestatus = 'X') AS X FROM lineitem GROUP BY 1)
          SELECT l_returnflag, F, O, X, round(F * 100.0 / (F + O + X), 1) AS F_share, round(O * 100.0 / (F + O + X), 1) AS O_share, round(X * 100.0 / (F + O + X), 1) AS X_share FROM c""")
def pivot_share(d):
    counted = profile.counts(d.lineitem, "l_returnflag", "l_linestatus", name="n")
    return profile.pivot_share(counted, "l_returnflag", "l_linestatus", ["F", "O", "X"], "n")


JOINED_LABELS = "(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def labelled(d: Tables) -> DataFrame:
    return d.documents.select("doc_id", "lang", "source").join(d.labels, "doc_id", "left")


@query(f"SELECT count(*) AS rows_total, count(*) - count(lang) AS lang, count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic FROM {JOINED_LABELS}")
def null_profile(d):
    return profile.null_profile(labelled(d), ["lang", "quality", "toxic"])


@query(f"""SELECT c AS column_name, round(n / total * 100, 1) AS fill_percent FROM (SELECT unnest(['lang', 'source', 'quality', 'toxic']) AS c,
           unnest([count(lang), count(source), count(quality), count(toxic)]) AS n, count(*) AS total FROM {JOINED_LABELS})""")
def fill_rate(d):
    return profile.fill_rates(labelled(d), skip=["doc_id"])


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(d):
    return profile.duplicate_keys(d.lineitem, ["l_orderkey", "l_partkey"])


@query("SELECT DISTINCT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_ids(d):
    return quality.unmerged_ids(d.documents.select(F.col("doc_id").alias("id")), d.labels.select(F.col("doc_id").alias("id")))


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer UNION SELECT lang FROM documents")
def union_distinct(d):
    sides = [(d.nation, "n_name"), (d.region, "r_name"), (d.customer, "c_mktsegment"), (d.documents, "lang")]
    return reduce(DataFrame.union, [df.select(F.col(c).alias("name")) for df, c in sides]).distinct()


@query(f"SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL AND event_type NOT IN (SELECT word FROM {values_sql(EVENT_WORDS)} m(source, word, common))")
def anti_unseen(d):
    return lookups.unseen(d.events, d.rows(EVENT_WORDS, "source string, word string, common string"), "event_type", "word")


@query("""SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
          AND c_custkey IN (SELECT s_suppkey * 3 FROM supplier)""")
def explained_gaps(d):
    wanted = d.customer.select("c_custkey")
    gaps = lookups.missing(wanted, d.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    return lookups.explained(gaps, d.supplier.select((F.col("s_suppkey") * 3).alias("c_custkey")), "c_custkey").distinct()


@query("""SELECT s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def append_new_rows(d):
    table = d.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return lookups.append_new(table, d.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), ["key"])


@query("""SELECT l_partkey AS id, min(l_orderkey * 10 + l_linenumber) AS pos FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)
          GROUP BY 1 ORDER BY 2 LIMIT 300""")
def budgeted_prefix(d):
    wanted = d.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), F.col("l_partkey").alias("id"))
    return to_fetch(wanted, d.part.where("p_size < 25").select(F.col("p_partkey").alias("id")), 300)


@query("SELECT source AS company_slug, count(*) AS files FROM documents GROUP BY source")
def files_by_company(d):
    return files_per_company(d.documents.select(F.col("source").alias("company_slug")))


# Data tests


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def accepted_values(d):
    return quality.accepted(d.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("""SELECT 'not null' AS test, count(*) AS violations FROM documents WHERE lang IS NULL UNION ALL
          SELECT 'unique', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)""")
def not_null_unique(d):
    checks = [("not null", quality.not_null(d.documents, "lang")), ("unique", quality.unique(d.lineitem, "l_orderkey"))]
    return reduce(DataFrame.union, [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("test"), "violations") for name, df in checks])


@query("""SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS last_seen, CASE WHEN TIMESTAMP '2024-02-01 06:00:00' - max(ts) > INTERVAL 48 HOUR THEN 'error'
          WHEN TIMESTAMP '2024-02-01 06:00:00' - max(ts) > INTERVAL 30 HOUR THEN 'warn' ELSE 'pass' END AS status FROM events""")
def freshness(d):
    events = d.events.select(F.col("ts").cast("timestamp").alias("last_seen_at"))
    return quality.freshness(events, datetime(2024, 2, 1, 6)).select(val.minute_text(F.col("last_seen")).alias("last_seen"), "status")


@query("SELECT page_id FROM pages WHERE regexp_matches(html, '<[a-zA-Z/]')")
def leftover_markup(d):
    return quality.leftover_markup(d.pages, "html").select("page_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS DISTINCT FROM l.toxic")
def distinct_from(d):
    return quality.differs(labelled(d), "quality", "toxic").select("doc_id")


@query("SELECT c_custkey FROM customer WHERE CASE WHEN c_acctbal < 0 THEN c_nationkey + 100 ELSE c_nationkey END NOT IN (SELECT n_nationkey FROM nation)")
def unrelated_rows(d):
    key = F.when(F.col("c_acctbal") < 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    return quality.unrelated(d.customer.select("c_custkey", key.alias("key")), "key", d.nation, "n_nationkey").select("c_custkey")


@query("""SELECT count(*) AS rows_total, count(DISTINCT event_type) AS files_total, count(DISTINCT user_id) AS ids_total FROM events""")
def load_counts(d):
    events = d.events.select(F.col("event_type").alias("landed_at"), F.col("user_id").alias("id"))
    return quality.staging_counts(events).join(quality.final_counts(events), "rows_total")


# Payloads: each customer is an item of a file of at most 50, written from the table and parsed again

LANDED = "TIMESTAMP '2026-10-06 06:35:12'"


def payload_files(d: Tables, item: Column, body: Callable[[Column], Column]) -> DataFrame:
    """Landed files: ``body`` makes a file's content of its items."""
    rows = d.customer.withColumn("file", F.floor(F.col("c_custkey") / 50)).groupBy("file").agg(F.collect_list(item).alias("items"))
    return rows.select(
        F.concat(F.lit("x/ingest_date=2026-10-06/f"), F.col("file").cast("string"), F.lit("/1.json")).alias("path"),
        F.concat(F.lit("f"), F.col("file").cast("string")).alias("company_slug"), F.expr(LANDED).alias("landed_at"), body(F.col("items")).alias("content"),
    )


def named(**columns: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


@query("""SELECT 'c' || c_custkey AS id, c_name AS title, c_mktsegment AS location, CASE WHEN c_custkey % 3 > 0 THEN 'Team ' || c_nationkey END AS department,
          CASE WHEN c_acctbal < 0 THEN 'remote' END AS workplace_type, '<p>' || c_name || '</p>' AS content, CAST(c_acctbal AS DECIMAL(38,9)) AS salary_min,
          strftime(make_timestamp(c_custkey * 86400 * 1000000), '%Y-%m-%d %H:%M') AS published, 'f' || (c_custkey // 50) AS company_slug FROM customer""")
def parse_bare_array(d):
    key = F.col("c_custkey")
    item = named(
        id=F.concat(F.lit("c"), key.cast("string")), text=F.col("c_name"), description=F.concat(F.lit("<p>"), "c_name", F.lit("</p>")),
        workplaceType=F.when(F.col("c_acctbal") < 0, "remote"), createdAt=key * 86_400_000,
        categories=named(location=F.col("c_mktsegment"), team=F.when(key % 3 > 0, F.concat(F.lit("Team "), F.col("c_nationkey").cast("string")))),
        salaryRange=named(min=F.col("c_acctbal").cast("decimal(12,2)")),
    )
    rows = PARSERS["lever"](payload_files(d, item, F.to_json))
    return rows.select("id", "title", "location", "department", "workplace_type", "content", "salary_min", val.minute_text(F.col("published_at")).alias("published"), "company_slug")


@query("""SELECT c_custkey AS id, c_name AS title, c_mktsegment AS location, CASE WHEN c_custkey % 2 = 0 THEN 'D' || c_nationkey END AS department,
          '2026-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || ' 04:00' AS updated, c_name AS raw_title FROM customer""")
def parse_wrapped_array(d):
    key = F.col("c_custkey")
    day = F.lpad((1 + key % 28).cast("string"), 2, "0")
    offices = F.when(key % 2 == 0, F.array(named(name=F.concat(F.lit("D"), F.col("c_nationkey").cast("string"))), named(name=F.lit("other")))).otherwise(F.array().cast("array<struct<name:string>>"))
    item = named(id=key, title=F.col("c_name"), location=named(name=F.col("c_mktsegment")), departments=offices, updated_at=F.concat(F.lit("2026-01-"), day, F.lit("T00:00:00-04:00")))
    rows = PARSERS["greenhouse"](payload_files(d, item, lambda items: F.to_json(named(jobs=items))))
    return rows.select("id", "title", "location", "department", val.minute_text(F.col("updated_at")).alias("updated"), val.json_scalar(F.col("raw"), "$.title").alias("raw_title"))


@query("""SELECT 'a' || c_custkey AS id, c_name AS title, CASE WHEN c_custkey % 4 = 1 THEN CAST(c_acctbal AS DECIMAL(38,9)) END AS salary_min,
          CASE WHEN c_custkey % 4 = 1 THEN 'EUR' END AS salary_currency, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS country FROM customer""")
def parse_only_match(d):
    key = F.col("c_custkey")
    pay = lambda kind, amount: named(compensationType=F.lit(kind), minValue=amount, currencyCode=F.lit("EUR"))
    equity, salary = pay("EquityPercentage", F.lit(1).cast("decimal(12,2)")), pay("Salary", F.col("c_acctbal").cast("decimal(12,2)"))
    parts = F.when(key % 4 == 1, F.array(equity, salary)).when(key % 4 == 2, F.array(salary, salary)).when(key % 4 == 3, F.array(equity))
    item = named(
        id=F.concat(F.lit("a"), key.cast("string")), title=F.col("c_name"), compensation=named(summaryComponents=parts),
        address=F.when(key % 3 == 0, named(postalAddress=named(addressCountry=F.col("c_mktsegment")))),
    )
    rows = PARSERS["ashby"](payload_files(d, item, lambda items: F.to_json(named(jobs=items))))
    return rows.select("id", "title", "salary_min", "salary_currency", "country")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'en' WHEN c_custkey % 4 = 1 THEN 'pt' WHEN c_custkey % 4 = 2 THEN 'de' END AS language,
          CASE WHEN c_custkey % 4 < 3 THEN c_mktsegment ELSE c_name END AS title, c_acctbal < 0 AS remote, CAST(c_acctbal AS DECIMAL(38,9)) AS salary_min FROM customer""")
def parse_translations(d):
    key = F.col("c_custkey")
    keys = F.when(key % 4 == 0, F.array(F.lit("pt"), F.lit("en"))).when(key % 4 == 1, F.array(F.lit("de"), F.lit("pt"))).when(key % 4 == 2, F.array(F.lit("fr"), F.lit("de"))).otherwise(F.array().cast("array<string>"))
    told = F.map_from_arrays(keys, F.transform(keys, lambda k: named(title=F.col("c_mktsegment"))))
    item = named(id=key, title=F.col("c_name"), translations=told, remote=F.col("c_acctbal") < 0, salary=named(min=F.col("c_acctbal").cast("decimal(12,2)").cast("string")))
    rows = PARSERS["recruitee"](payload_files(d, item, lambda items: F.to_json(named(offers=items))))
    return rows.select("id", "language", "title", "remote", "salary_min")


@query("""SELECT 't' || c_custkey AS id, c_name AS title, CASE WHEN c_custkey % 2 = 0 THEN 'B' || c_nationkey ELSE 'A' || c_nationkey END AS city,
          CASE WHEN c_custkey % 2 = 0 THEN 'Brasil' ELSE 'Portugal' END AS country, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS role,
          '<b>' || c_mktsegment || CASE WHEN c_custkey % 5 = 0 THEN '</item><item>' ELSE '</b>' END AS content,
          '2026-09-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || ' 07:36' AS published FROM customer""")
def parse_feed(d):
    key = F.col("c_custkey")
    nation = F.col("c_nationkey").cast("string")
    place = lambda city, country: F.concat(F.lit("<tt:location><tt:city>"), city, F.lit("</tt:city><tt:country>"), F.lit(country), F.lit("</tt:country></tt:location>"))
    second = F.when(key % 2 == 0, place(F.concat(F.lit("B"), nation), "Brasil")).otherwise("")
    role = F.when(key % 3 > 0, F.concat(F.lit("<tt:role>"), "c_mktsegment", F.lit("</tt:role>"))).otherwise("<tt:role/>")
    escaped = F.concat(F.lit("&lt;b&gt;"), "c_mktsegment", F.lit("&lt;/b&gt;"))
    section = F.concat(F.lit("<![CDATA[<b>"), "c_mktsegment", F.lit("</item><item>]]>"))  # no tags, though they look like some
    item = F.concat(
        F.lit("<item><title>"), "c_name", F.lit("</title><!-- </item> --><description>"), F.when(key % 5 == 0, section).otherwise(escaped),
        F.lit("</description><pubDate>"), F.lpad((1 + key % 28).cast("string"), 2, "0"), F.lit(" Sep 2026 09:36:12 +0200</pubDate><guid>t"),
        key.cast("string"), F.lit("</guid><tt:locations>"), place(F.concat(F.lit("A"), nation), "Portugal"), second, F.lit("</tt:locations>"), role, F.lit("</item>"),
    )
    feed = lambda items: F.concat(F.lit("<?xml version='1.0'?><rss xmlns:tt='x'><channel>"), F.array_join(items, "\n"), F.lit("</channel></rss>"))
    rows = PARSERS["teamtailor"](payload_files(d, item, feed))
    return rows.select("id", "title", "city", "country", "role", "content", val.minute_text(F.col("published_at")).alias("published"))


@query("""SELECT 'w' || (c_custkey // 2) AS id, min_by(c_name, c_custkey) AS title, count(*) AS entries, bool_or(c_custkey % 6 = 0) AS has_detail,
          max(CASE WHEN c_custkey % 6 = 0 THEN CAST(c_acctbal AS DECIMAL(38,9)) END) AS salary_min FROM customer GROUP BY 1""")
def parse_envelope(d):
    """Two entries of one shortcode are one posting; every third posting has a detail."""
    key = F.col("c_custkey")
    code = F.concat(F.lit("w"), F.floor(key / 2).cast("string"))
    item = named(key=key, entry=named(shortcode=code, title=F.col("c_name"), department=F.lit("")), detail=F.when(key % 6 == 0, named(salary_from=F.col("c_acctbal").cast("decimal(12,2)"))))

    def body(items: Column) -> Column:
        in_order = F.array_sort(items)
        told = F.filter(in_order, lambda x: x["detail"].isNotNull())
        details = F.map_from_arrays(F.transform(told, lambda x: x["entry"]["shortcode"]), F.transform(told, lambda x: x["detail"]))
        return F.to_json(named(account=named(jobs=F.transform(in_order, lambda x: x["entry"])), details=details))

    rows = PARSERS["workable"](payload_files(d, item, body))
    return rows.select("id", "title", F.size(F.from_json("raw", "array<string>")).cast("long").alias("entries"), "has_detail", "salary_min")


# Questions over marts that are made of the driver's tables


def remote_mart(d: Tables) -> DataFrame:
    nations = d.nation.join(d.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("country_name"), F.col("r_name").alias("business_region"))
    places = d.customer.join(lookups.small(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = d.orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return orders.select("country_name", "business_region", kind.alias("employment_type"), F.col("c_name").alias("company_name"), F.col("o_orderstatus").alias("source"))


REMOTE_SQL = """(SELECT n_name AS country_name, r_name AS business_region, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS employment_type, c_name AS company_name, o_orderstatus AS source
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(f"SELECT business_region AS region, count(*) AS postings FROM {REMOTE_SQL} GROUP BY 1")
def question_by_region(d):
    return analytics.by_region(remote_mart(d))


@query(f"SELECT employment_type, count(*) AS postings FROM {REMOTE_SQL} WHERE employment_type IS NOT NULL GROUP BY 1")
def question_by_employment(d):
    return analytics.by_employment(remote_mart(d))


@query(f"""SELECT company_name AS company, source, count(*) AS open_remote_postings, count(DISTINCT country_name) AS countries FROM {REMOTE_SQL}
           GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 200""")
def question_top_companies(d):
    return analytics.top_companies(remote_mart(d))


@query("""SELECT *, round(with_description * 100.0 / nullif(open_postings, 0), 1) AS description_fill FROM (
          SELECT o_orderpriority AS source, count(*) FILTER (WHERE o_orderstatus = 'O') AS open_postings, count(*) FILTER (WHERE o_orderstatus <> 'O') AS closed_postings,
          count(*) FILTER (WHERE o_orderstatus = 'O' AND o_totalprice > 1000) AS with_description, strftime(max(o_orderdate), '%Y-%m-%d %H:%M') AS last_run_utc FROM orders GROUP BY 1)""")
def question_per_source(d):
    fact = d.orders.select(
        F.col("o_orderpriority").alias("source"), (F.col("o_orderstatus") == "O").alias("is_open"),
        F.when(F.col("o_totalprice") > 1000, "said").alias("description_text"), F.col("o_orderdate").alias("last_seen_at"),
    )
    return analytics.per_source(fact)


@query("SELECT p_partkey, string_agg(upper(left(w, 1)) || lower(substr(w, 2)), ' ' ORDER BY i) AS shown FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) GROUP BY 1")
def slug_titles(d):
    return d.part.select("p_partkey", t.titled(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("shown"))


@query("SELECT event_id, strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M') AS from_iso FROM events")
def parse_iso_times(d):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return d.events.select("event_id", val.minute_text(val.from_iso(iso)).alias("from_iso"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 3 = 0 THEN 'remote' ELSE 'unknown' END AS workplace FROM customer""")
def workplace_from_text(d):
    word = F.when(F.col("c_mktsegment") == "BUILDING", " (REMOTE)").when(F.col("c_mktsegment") == "MACHINERY", ", fully remote").otherwise(" rem ote")
    return d.customer.select("c_custkey", voc.workplace_from_text(F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, word).otherwise(""))).alias("workplace"))


# Staging models: payloads that are made of the tables, parsed and translated

STAGE_CODES = [("Portugal", "PT"), ("Brazil", "BR"), ("Anywhere", None)]


def stage_seeds(d: Tables) -> dict[str, DataFrame]:
    codes = d.rows(STAGE_CODES, "country_raw string, country_code string")
    tables = {"workplace_type": voc.WORKPLACE_TYPES, "salary_interval": voc.SALARY_INTERVALS, "employment_type": voc.EMPLOYMENT_TYPES}
    words = {f"{c}_map": voc.mapping(d.spark, rows, f"{c}_raw", c) for c, rows in tables.items()}
    return words | {"country_codes": codes, "us_states": voc.us_states(d.spark)}


def choice(key: Column, *values: str | None) -> Column:
    """One of the values by the key, in turn."""
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def choice_sql(*values: str | None) -> str:
    return "CASE c_custkey % " + str(len(values)) + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None) + " END"


@query(f"""SELECT 'c' || c_custkey AS source_job_id, {choice_sql("remote", "hybrid", "in_person", "unknown", None)} AS workplace_type, {choice_sql("year", "hour", None)} AS salary_interval,
           {choice_sql("full_time", "internship", "contract", None)} AS employment_type,
           '<b>' || c_name || '</b> & co' || chr(10) || chr(10) || 'Segment: ' || c_mktsegment
           || CASE WHEN c_custkey % 2 = 0 THEN chr(10) || chr(10) || 'Nation: ' || c_nationkey ELSE '' END AS description_text FROM customer""")
def stage_lever(d):
    """Words of an interval and a workplace, free text about the commitment, and titled lists inside the payload."""
    key = F.col("c_custkey")
    section = lambda title, body: named(text=F.lit(title), content=F.concat(F.lit("<ul><li>"), body, F.lit("</li></ul>")))
    lists = F.array_compact(F.array(section("Segment", F.col("c_mktsegment")), F.when(key % 2 == 0, section("Nation", F.col("c_nationkey").cast("string")))))
    item = named(
        id=F.concat(F.lit("c"), key.cast("string")), text=F.col("c_name"), workplaceType=choice(key, "remote", "hybrid", "onsite", "unspecified", "elsewhere"),
        description=F.concat(F.lit("<p>&lt;b&gt;"), "c_name", F.lit("&lt;/b&gt;&nbsp;&amp; co</p>")), lists=lists,
        categories=named(commitment=choice(key, "Full-Time", "Summer INTERN", "Freelance ", "")), salaryRange=named(interval=choice(key, "per-year-salary", "per-hour-wage", "per-moon")),
    )
    rows = STAGING["lever"](PARSERS["lever"](payload_files(d, item, F.to_json)), stage_seeds(d))
    return rows.select("source_job_id", "workplace_type", "salary_interval", "employment_type", "description_text")


@query(f"""SELECT 'c' || c_custkey AS source_job_id, {choice_sql("remote", "in_person", "unknown", None)} AS workplace_type, {choice_sql("one_time", "week", None)} AS salary_interval,
           {choice_sql("full_time", "other", None)} IN ('full_time') AS full_time, {choice_sql("PT", "BR", None, None, None)} AS country_code, {choice_sql("Portugal", "Brazil", "Anywhere", "Atlantis", None)} AS country_raw FROM customer""")
def stage_ashby(d):
    """A silent workplace is unknown, a strange one null; a spelling that means no country is not a strange one."""
    key = F.col("c_custkey")
    item = named(
        id=F.concat(F.lit("c"), key.cast("string")), title=F.col("c_name"), workplaceType=choice(key, "Remote", "OnSite", None, "moon"),
        employmentType=choice(key, "FullTime", "Contract", "Strange"), address=named(postalAddress=named(addressCountry=choice(key, " Portugal", "Brazil ", "Anywhere", "Atlantis", " "))),
        compensation=named(summaryComponents=F.array(named(compensationType=F.lit("Equity"), interval=F.lit("1 DAY")), named(compensationType=F.lit("Salary"), interval=choice(key, "1 TIME", "1 WEEK", "never")))),
    )
    rows = STAGING["ashby"](PARSERS["ashby"](payload_files(d, item, lambda items: F.to_json(named(jobs=items)))), stage_seeds(d))
    return rows.select("source_job_id", "workplace_type", "salary_interval", (F.col("employment_type") == "full_time").alias("full_time"), "country_code", "country_raw")


@query(f"""SELECT 'c' || c_custkey AS source_job_id,
           CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN {choice_sql("in_person", "hybrid", None, "", "")} WHEN c_custkey % 2 = 0 THEN 'remote' ELSE 'unknown' END AS workplace_type,
           {choice_sql("full_time", "part_time", "other", None, None)} AS employment_type, CASE WHEN c_custkey % 5 < 3 THEN 'year' END AS salary_interval FROM customer""")
def stage_workable(d):
    """A word for the workplace comes from the details and counts before the flag; a word nobody knows stays null."""
    key = F.col("c_custkey")
    code = F.concat(F.lit("c"), key.cast("string"))
    item = named(shortcode=code, title=F.col("c_name"), telecommuting=key % 2 == 0, employment_type=choice(key, "Full-time", "Part-time", "Other", "Strange", ""))
    detail = F.to_json(named(workplace=choice(key, "on_site", "hybrid", "moon", None, None), salary_frequency=F.when(key % 5 < 3, "year")))

    def body(items: Column) -> Column:
        return F.to_json(named(account=named(jobs=F.transform(items, lambda x: x["item"])), details=F.map_from_entries(F.transform(items, lambda x: F.struct(x["item"]["shortcode"], F.from_json(x["detail"], "workplace string, salary_frequency string"))))))

    rows = STAGING["workable"](PARSERS["workable"](payload_files(d, named(item=item, detail=detail), body)), stage_seeds(d))
    return rows.select("source_job_id", "workplace_type", "employment_type", "salary_interval")


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS source_job_id, {choice_sql("PT", "US", None, "US", None, "BR")} AS country_code, {choice_sql("unknown", "remote", "unknown", "unknown", "unknown", "remote")} AS workplace_type,
           c_name || ' & sons' AS description_text FROM customer""")
def stage_greenhouse(d):
    """Country and workplace from a free-text location, whose last piece may be a state; HTML that is stored escaped."""
    key = F.col("c_custkey")
    places = choice(key, "Lisbon, Portugal", "Remote - CA", "Nowhere", "Austin - Texas", "PT", "Remote; Brazil")
    item = named(id=key, title=F.col("c_name"), location=named(name=places), content=F.concat(F.lit("&lt;p&gt;"), "c_name", F.lit("&amp;nbsp;&amp;amp; sons&lt;/p&gt;")))
    rows = STAGING["greenhouse"](PARSERS["greenhouse"](payload_files(d, item, lambda items: F.to_json(named(jobs=items)))), stage_seeds(d))
    return rows.select("source_job_id", "country_code", "workplace_type", "description_text")


# Questions and seeds

FACT_SQL = """(SELECT o_orderkey AS posting_key, o_orderpriority AS source, CAST(o_custkey AS VARCHAR) AS company_slug, o_orderstatus = 'O' AS is_open,
  CASE o_orderkey % 3 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' ELSE 'unknown' END AS workplace_type, CASE WHEN o_orderkey % 7 = 0 THEN 'ZZ' ELSE CAST(o_custkey % 25 AS VARCHAR) END AS country_key,
  o_orderdate AS last_seen_at FROM orders)"""


def fact_of_orders(d: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return d.orders.select(
        key.alias("posting_key"), F.col("o_orderpriority").alias("source"), F.col("o_custkey").cast("string").alias("company_slug"), (F.col("o_orderstatus") == "O").alias("is_open"),
        F.when(key % 3 == 0, "remote").when(key % 3 == 1, "hybrid").otherwise("unknown").alias("workplace_type"),
        F.when(key % 7 == 0, voc.UNKNOWN_COUNTRY).otherwise((F.col("o_custkey") % 25).cast("string")).alias("country_key"), F.col("o_orderdate").alias("last_seen_at"),
    )


@query(f"""SELECT count(*) FILTER (is_open) AS open_postings, count(*) FILTER (is_open AND workplace_type = 'remote') AS open_remote,
           count(DISTINCT CASE WHEN is_open THEN source || '/' || company_slug END) AS companies, count(DISTINCT CASE WHEN is_open AND country_key <> 'ZZ' THEN country_key END) AS countries,
           strftime(max(last_seen_at), '%Y-%m-%d') AS as_of FROM {FACT_SQL}""")
def question_kpi(d):
    return analytics.kpi(fact_of_orders(d))


@query(f"SELECT source, workplace_type, count(*) AS postings FROM {FACT_SQL} WHERE is_open GROUP BY ALL")
def question_by_source(d):
    return analytics.by_source(fact_of_orders(d))


@query(f"SELECT country_name AS country, count(*) AS postings FROM {REMOTE_SQL} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12")
def question_by_country(d):
    return analytics.by_country(remote_mart(d))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS published, CAST(o_orderkey AS VARCHAR) AS title, o_orderstatus AS company, o_orderpriority AS country, o_orderpriority AS region, 'full time' AS type,
          CAST(o_orderkey AS VARCHAR) || 'u' AS job_url FROM orders WHERE o_orderkey % 5 > 0 ORDER BY o_orderdate DESC, o_orderkey LIMIT 1500""")
def question_latest(d):
    """The newest postings; a posting without a date is none of them."""
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    remote = d.orders.select(
        key.alias("posting_key"), F.when(key % 5 > 0, F.col("o_orderdate")).alias("published_at"), text.alias("title"), F.col("o_orderstatus").alias("company_name"),
        F.col("o_orderpriority").alias("country_name"), F.col("o_orderpriority").alias("business_region"), F.lit("full_time").alias("employment_type"),
        *[F.lit(None).cast(k).alias(c) for c, k in (("salary_min", "decimal(38,9)"), ("salary_max", "decimal(38,9)"), ("salary_currency", "string"), ("salary_interval", "string"))],
        F.concat(text, F.lit("u")).alias("job_url"),
    )
    return analytics.latest(remote).drop("pay")


@query("""SELECT country_raw, CASE lower(country_raw) WHEN 'iran' THEN 'IR' WHEN 'russia' THEN 'RU' WHEN 'vietnam' THEN 'VN' WHEN 'united states' THEN 'US' WHEN 'united kingdom' THEN 'GB' ELSE code END AS country_code,
          lower(country_raw) NOT IN ('iran', 'russia', 'vietnam', 'united states', 'united kingdom') AND code IS NULL AS nobody_knows FROM (
          SELECT DISTINCT CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE lower(n_name) END AS country_raw, CASE WHEN n_nationkey % 3 > 0 THEN 'N' || n_nationkey END AS code
          FROM nation JOIN customer ON c_nationkey = n_nationkey)""")
def country_spellings(d):
    """Spellings that customers use, by names that cover two thirds of the nations; aliases count before names."""
    observed = d.customer.join(d.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit(" "), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.lower("n_name"))).alias("country_raw")
    )
    names = d.nation.where("n_nationkey % 3 > 0").select(F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"), F.lit(1).alias("rank"))
    known, unknown = seeds.country_spellings(observed, names)
    return known.withColumn("nobody_knows", F.lit(False)).unionByName(unknown.select("country_raw", F.lit(None).cast("string").alias("country_code"), F.lit(True).alias("nobody_knows")))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name AS country_name, r_name AS region,
          CASE r_name WHEN 'AFRICA' THEN 'Northern Africa' WHEN 'ASIA' THEN 'Central Asia' WHEN 'EUROPE' THEN 'Western Europe' WHEN 'AMERICA' THEN 'Northern America' END AS sub_region,
          CASE r_name WHEN 'AFRICA' THEN 'EMEA' WHEN 'ASIA' THEN 'APAC' WHEN 'EUROPE' THEN 'EMEA' WHEN 'AMERICA' THEN 'NAMER' END AS business_region
          FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'XK', 'Kosovo', 'Europe', 'Southern Europe', 'EMEA'""")
def country_rows(d):
    name = F.col("r_name")
    sub = F.when(name == "AFRICA", "Northern Africa").when(name == "ASIA", "Central Asia").when(name == "EUROPE", "Western Europe").when(name == "AMERICA", "Northern America")
    iso = d.nation.join(d.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), name.alias("region"), sub.alias("sub_region")
    )
    return seeds.country_rows(iso)


# Upserts into a table of buckets

LAKE_DDL = "id bigint, o_orderkey bigint, o_orderpriority string, first_seen_at date, last_seen_at date"


def forget(lake: Lake) -> None:
    """Delete a query's own tables when the process ends, if its session is still there."""
    with contextlib.suppress(Exception):
        lake.delete(lake.root)


@query(MERGE_SQL.format(t=ORDER_HALF.format(EVEN), s=ORDER_HALF.format(ODD), guard="true"))
def merge_into_buckets(d):
    """Two upserts into a table of the lake; the second rewrites the buckets that its keys fall into."""
    base = d.spark.conf.get("spark.checkpoint.dir", None) or d.spark.conf.get("spark.sql.warehouse.dir")
    lake = Lake(d.spark, f"{base.rstrip('/')}/lake-{uuid.uuid4().hex[:12]}", buckets=16)
    atexit.register(forget, lake)
    columns = [c.split()[0] for c in LAKE_DDL.split(", ")]
    for half in (EVEN, ODD):
        lake.upsert("orders", LAKE_DDL, order_half(d, half).select(*columns), merge_current_state)
    return lake.read("orders", LAKE_DDL)


# Distinct counts that add up, one budget for all boards


@query("""SELECT coalesce(CAST(month AS VARCHAR), 'all') AS month, status, customers FROM (SELECT month(o_orderdate) AS month, o_orderstatus AS status, count(DISTINCT o_custkey) AS customers
          FROM orders GROUP BY GROUPING SETS ((month(o_orderdate), o_orderstatus), (o_orderstatus)))""")
def distinct_by_bitmaps(d):
    """Sets of customers by day of order become counts by month and over all days, without another look at the orders."""
    rows = d.orders.select(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status"), "o_custkey")
    sets = distinct.bitmaps(rows, "o_custkey", distinct.dictionary(d.customer, "c_custkey"), "day", "status")
    months = distinct.sizes(sets.withColumn("month", F.month("day").cast("string")), "month", "status", name="customers")
    return months.unionByName(distinct.sizes(sets, "status", name="customers").withColumn("month", F.lit("all")))


@query("""WITH wanted AS (SELECT o_orderpriority AS board, o_custkey AS id, min(o_orderkey) AS pos FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY ALL)
          SELECT board, id, pos, row_number() OVER (ORDER BY board, pos, id) AS place, row_number() OVER (ORDER BY board, pos, id) <= (SELECT count(*) // 10 FROM orders) AS chosen FROM wanted""")
def shared_budget(d):
    """Details of five boards, a tenth as many as there are orders, in the order of the boards."""
    wanted = d.orders.select(F.col("o_orderpriority").alias("board"), F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("pos"))
    known = d.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return details_to_fetch(wanted, known, d.orders.count() // 10)


@query("""SELECT posting_key, source, is_open, title FROM (SELECT CAST(o_custkey AS VARCHAR) AS posting_key, o_orderpriority AS source, max(o_orderdate) AS seen, CAST(max(o_orderkey) AS VARCHAR) AS title,
          CAST(max(o_orderdate) AS DATE) = max(CAST(max(o_orderdate) AS DATE)) OVER (PARTITION BY o_orderpriority) AS is_open FROM orders GROUP BY 1, 2)""")
def fact_by_patches(d):
    """A fact over the orders of the first half year, patched by those of the second, is the fact over all."""
    def postings(rows: DataFrame) -> DataFrame:
        made = rows.groupBy(F.col("o_custkey").cast("string").alias("source_job_id"), F.col("o_orderpriority").alias("source")).agg(
            F.max("o_orderdate").cast("timestamp").alias("last_seen_at"), F.max("o_orderkey").cast("string").alias("title"))
        lacks = {c: F.lit(None).cast("string") for c in ("country_code", *marts.FACT) if c not in (*made.columns, "country_key", "is_open")}
        return made.withColumns(lacks).withColumn("posting_key", F.concat_ws("/", "source_job_id", "source"))

    early, late = postings(d.orders.where("month(o_orderdate) <= 6")), postings(d.orders)
    fact = marts.fct_job_postings(early)
    patch = marts.fact_patch(fact, marts.last_days(early), late)
    return marts.replaced(fact, patch).select(F.col("source_job_id").alias("posting_key"), "source", "is_open", "title")
