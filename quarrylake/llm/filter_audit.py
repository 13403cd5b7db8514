"""Filter interaction audit: what each filter removes in every order, by inclusion-exclusion.

One pass flags every document (bit ``i`` of ``fails``: filter ``i`` fails) and groups equal flags.  For each
part, the joint-failure count of each of the 2**n intersections of filters is a sum of flag products, so all
are partial sums of one aggregate.  A fast Möbius transform of these counts gives the survivors of every set of
filters, and from them everything else: what a filter removes after a prefix is the difference of two
survivors, its unique failures are that difference after all others, what earlier filters took before it is its
own count less what it removes.  The removals summed over all orders are n! times the Shapley value, the
sum of the filter's Harsanyi dividends (plus or minus a joint-failure count) over the set's size.

The duplicate filter looks at equal texts of the whole table.  Counts are combined by (text, part, labels) before
texts meet, so a text that a third of all documents share costs each task a few rows, and only a digest of a
text is shuffled (SHA-256).

Rows: a null text counts as empty, a null part as the empty string.  A row whose key is null is no duplicate
and makes none, since null is not smaller; rows of one key with one text are no duplicates of each other.
Several label rows of a key count as one that has any of their marks; a null label is no mark.  Rows of
one key each count.  An empty table gives no row, since it has no part.  Other columns are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

#: Characters of ``[\x20\x09-\x0D]``.
SPACE = " \t\n\x0b\x0c\r"


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text and its words."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))  # one byte each
    return {
        "A": n < 200,
        "B": 100 * distinct.cast("long") < 50 * n.cast("long"),
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def words_of(text: Column) -> Column:
    """All ``[^\\x20\\x09-\\x0D]+`` of a text."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _bits(flags: Mapping[str, Column]) -> Column:
    total = F.lit(0)
    for i, fails in enumerate(flags.values()):
        total = total + F.when(fails, 1 << i).otherwise(0)
    return total


def flagged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Rows (part, fails, good, toxic, n): documents with the same failures and labels, the duplicate filter last."""
    rows = docs.select(docs[key].alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    own = failures(F.col("text"), F.col("words"))
    rows = rows.select("id", "part", _bits(own).alias("fails"), F.unhex(F.sha2("text", 256)).alias("digest"))
    marks = labels.groupBy(labels[key].alias("id")).agg(
        F.coalesce(F.max(labels["quality"] == 1), F.lit(False)).alias("good"), F.coalesce(F.max(labels["toxic"] == 1), F.lit(False)).alias("toxic")
    )
    marks = small(marks.where("id IS NOT NULL AND (good OR toxic)"))
    rows = rows.join(marks, "id", "left").fillna(False, ["good", "toxic"])
    # Of one text in one part with one kind of label: how many rows, how many without a key, how many with the smallest key.
    kind = ["digest", "part", "fails", "good", "toxic"]
    kinds = rows.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n")).groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("id").alias("own_first"), F.min_by("n", "id").alias("at_first"),
    )
    first = kinds.groupBy("digest").agg(F.min("own_first").alias("first"))
    held = kinds.join(first, "digest").withColumn(
        "stays", F.col("no_id") + F.when(F.col("own_first") == F.col("first"), F.col("at_first")).otherwise(0)
    )
    copy = 1 << len(own)
    each = F.array(F.struct("fails", F.col("stays").alias("n")), F.struct((F.col("fails") + copy).alias("fails"), (F.col("n") - F.col("stays")).alias("n")))
    return held.select("part", "good", "toxic", F.explode(each).alias("x")).select("part", "x.fails", "good", "toxic", "x.n")


def _sets(n: int, holds: Callable[[Column], Column]) -> Column:
    """The sets of ``n`` filters (as bits) that pass a test, as an array."""
    return F.filter(F.sequence(F.lit(0), F.lit((1 << n) - 1)), holds)


def joint(rows: DataFrame, n: int) -> DataFrame:
    """Rows (part, set, all, good, toxic): how many documents fail every filter of a set; the empty set holds all.

    A document adds its flags' product to each set, which is one for the subsets of its failures.  Equal
    flags are added up first, so a part has at most 2**n kinds with two marks each, whatever its size.
    """
    kinds = rows.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))
    each = kinds.withColumn("set", F.explode(_sets(n, lambda s: s.bitwiseAND(F.col("fails")) == s)))
    marked = lambda mark: F.coalesce(F.sum(F.when(F.col(mark), F.col("n"))), F.lit(0))
    return each.groupBy("part", "set").agg(F.sum("n").alias("all"), marked("good").alias("good"), marked("toxic").alias("toxic"))


def survivors(counts: DataFrame, n: int) -> DataFrame:
    """Möbius inversion: (part, left), where ``left[p]`` counts (all, good, toxic) documents that fail no filter of the set ``p``."""
    sign = F.when(F.bit_count("set") % 2 == 1, -1).otherwise(1)
    each = counts.withColumn("of", F.explode(_sets(n, lambda p: p.bitwiseAND(F.col("set")) == F.col("set"))))
    left = each.groupBy("part", "of").agg(*[F.sum(sign * F.col(c)).alias(c) for c in ("all", "good", "toxic")])
    return left.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("of", "all", "good", "toxic"))).alias("left"))  # 2**n entries


def shares(counts: DataFrame, n: int) -> DataFrame:
    """(part, shares): for each filter n! times its Shapley value, from the dividends of the sets that hold it."""
    size, orders = F.bit_count("set"), F.lit(math.factorial(n)).cast("long")
    dividend = F.col("all") * F.when(size % 2 == 1, 1).otherwise(-1) * (orders / F.greatest(size, F.lit(1))).cast("long")
    return counts.groupBy("part").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("set").bitwiseAND(F.lit(1 << i)) != 0, dividend)), F.lit(0)) for i in range(n)]).alias("shares")
    )


def interaction(rows: DataFrame, names: str) -> DataFrame:
    """From rows (part, fails, good, toxic, n), the audit's row for each part, order of ``names`` and step."""
    n = len(names)
    counts = joint(rows, n)
    places = []
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order, 1):
            places.append({"filter_order": "".join(names[j] for j in order), "step": step, "f": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    plan = F.from_json(F.lit(json.dumps(places)), "array<struct<filter_order:string,step:int,f:int,before:int,after:int>>")
    steps = survivors(counts, n).join(shares(counts, n), "part").withColumn("o", F.explode(plan))  # n * n! rows for each part
    left = lambda mark, place: F.col("left")[place][mark]
    f, before, after, full = F.col("o.f"), F.col("o.before"), F.col("o.after"), F.lit((1 << n) - 1)
    own = after - before
    lost = {mark: left(mark, before) - left(mark, after) for mark in ("all", "good", "toxic")}
    return steps.select(
        "part", "o.filter_order", "o.step", left("all", after).alias("kept"), lost["all"].alias("removed"),
        (left("all", F.lit(0)) - left("all", own) - lost["all"]).alias("redundant"),
        (left("all", full - own) - left("all", full)).alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), F.col("shares")[f].alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return interaction(flagged(docs, labels), "ABCDE")


#: DuckDB SQL for the rows of ``op11_filter_audit``: every order applied to every document.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(l.toxic, false) AS toxic, map {
    'A': len(words) < 200,
    'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(w.doc_id > first, false)} AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
kinds AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
ran AS (
  SELECT part, good, toxic, n, filter_order, step,
    fails[filter_order[step]] AS own,
    len(list_filter(range(1, step), lambda i: fails[filter_order[i]])) > 0 AS before,
    len(list_filter(range(1, 6), lambda i: i <> step AND fails[filter_order[i]])) > 0 AS others
  FROM kinds, steps),
summed AS (
  SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (NOT own AND NOT before), 0) AS kept,
    coalesce(sum(n) FILTER (own AND NOT before), 0) AS removed,
    coalesce(sum(n) FILTER (own AND before), 0) AS redundant,
    coalesce(sum(n) FILTER (own AND NOT others), 0) AS unique_fails,
    coalesce(sum(n) FILTER (own AND NOT before AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (own AND NOT before AND toxic), 0) AS toxic_lost
  FROM ran GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley
FROM summed
"""
