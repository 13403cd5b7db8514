"""Source divergence audit: chi-square-like distances of word distributions, by inclusion-exclusion over supports.

A language's kept terms are those in enough of its documents.  A group is a source within a language.  The
distance of two groups is a sum over all kept terms, but most terms occur in few groups, so it is put together
from supports: a histogram of counts for each group prices the terms that the group holds as if the other held
none; a join of postings (who holds a term, how often) corrects the terms that both hold; and the terms that
neither holds are a constant times their number.  So the work follows the postings, not groups times terms.

Words are counted by Spark tasks over Arrow batches and leave a task as counts.  Postings are joined on
(language, term), one row for each unordered pair of groups that share a term, which gives both directions.
All arithmetic is on integers: shares are parts of ``SCALE``, computed in decimals so that no count overflows.

Rows: a null text, language or source counts as empty; every row is a document, rows of one id each count.
A group without terms, or a language without kept terms, gives rows too, with value 0 where nothing is kept.  A
source that is alone in its language has no pairs.  Ties are ranked by the item's bytes.  An empty table
gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BATCHES, settings, slices, small, store, strings

SCALE = 1_000_000_000
#: Documents of a language that must hold a term; ranks of the report of terms.
LEAST, TOP = 3, 200

#: Bytes of terms: A-Z become lower case, a-z and all of other scripts stay, everything else ends a term.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
#: Counts that a task gathers before it adds up those of one term, and that it keeps before it hands them on.
GATHERED, HELD = 1_000_000, 500_000


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and each text's offsets into them."""
    texts = pa.concat_arrays([texts])  # an array of its own, from offset 0
    _, offsets, data = texts.buffers()
    body = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    lists = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(_LETTER[body])))
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    return flat.filter(pa.array(full)), np.r_[0, np.cumsum(full)][ends - ends[0]]


def _cells(part: pa.RecordBatch, places: dict[tuple[str, str], int]) -> pa.Table:
    """Counts (group, term, n, docs) of a slice; ``places`` numbers the groups."""
    flat, offsets = terms(strings(part.column("text")))
    coded = flat.dictionary_encode()
    code, width = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
    text = np.repeat(np.arange(part.num_rows), np.diff(offsets))
    names = zip(strings(part.column("lang")).to_pylist(), strings(part.column("source")).to_pylist())
    group = np.array([places.setdefault(g, len(places)) for g in names], np.int64)
    own, n = np.unique(text * width + code, return_counts=True)  # a text's terms
    cell, at = np.unique(group[own // width] * width + own % width, return_inverse=True)
    return pa.table({
        "group": pa.array(cell // width), "term": coded.dictionary.take(pa.array(cell % width)),
        "n": pa.array(np.bincount(at, n, len(cell)).astype(np.int64)), "docs": pa.array(np.bincount(at, minlength=len(cell))),
    })


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (language, source, term) that a task sees, and a row for each group."""
    places: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([g[i] for g in places], pa.string()) for i in (0, 1))
        for batch in table.to_batches(max_chunksize=100_000):
            group = batch.column("group")
            yield pa.RecordBatch.from_arrays([langs.take(group), sources.take(group), *(batch.column(c) for c in names[2:])], names=names)

    def added() -> pa.Table:
        sums = pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return sums.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"]).combine_chunks()

    for batch in batches:
        for part in slices(batch, "text"):
            held.append(_cells(part, places))
            if sum(map(len, held)) >= GATHERED:
                held = [added()]
                if len(held[0]) >= HELD:
                    yield from out(held.pop())
    if held:
        yield from out(added())
    marks = len(places)
    yield from out(pa.table({"group": pa.array(range(marks), pa.int64()), "term": pa.nulls(marks, pa.string()), "n": pa.array([0] * marks, pa.int64()), "docs": pa.array([0] * marks, pa.int64())}))


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), in decimals: exact at any size.  Without kept terms it is never used."""
    above = f"cast({count} + 1 AS decimal(20,0)) * cast({SCALE} AS decimal(10,0))"
    return F.expr(f"1 + ({above}) div cast(greatest({total} + {kept}, 1) AS decimal(20,0))")


def gap(p: str, q: str) -> str:
    """SQL for floor((p - q)**2 / q) of whole numbers up to some 10**9."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def postings(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST) -> DataFrame:
    """Rows (lang, source, term, n, lang_n, head) of kept terms, and one without a term for each group.

    ``lang_n`` counts the term in its language; ``head`` marks one row of each (language, term).
    """
    rows = docs.select(docs[text].alias("text"), docs[lang].cast("string").alias("lang"), docs[source].cast("string").alias("source"))
    with settings(docs.sparkSession, BATCHES):
        seen = rows.mapInArrow(count_terms, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        everywhere = Window.partitionBy("lang", "term")  # a row for each group that holds the term
        seen = seen.withColumns({
            "lang_n": F.sum("n").over(everywhere), "in_docs": F.sum("docs").over(everywhere), "head": F.col("source") == F.min("source").over(everywhere),
        })
        return store(seen.where(F.col("term").isNull() | (F.col("in_docs") >= least)).select("lang", "source", "term", "n", "lang_n", "head"), "postings")


def group_sizes(held: DataFrame) -> DataFrame:
    """For each group: occurrences ``total`` and number ``own`` of its terms, those of its language, and the share ``p0`` of a term it lacks."""
    groups = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("term").alias("own"), F.count_if(F.col("head") & F.col("term").isNotNull()).alias("heads"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("heads").alias("kept"))
    return groups.drop("heads").join(langs, "lang").withColumn("p0", share("0", "total", "kept"))


def both_ways(sums: DataFrame) -> DataFrame:
    """From sums of a group's and another's ``there`` and ``back``, a row for each direction."""
    each = F.array(F.struct("source", F.col("other").alias("item"), F.col("there").alias("value")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))
    return sums.select("lang", F.explode(each).alias("x")).select("lang", "x.*")


def distances(priced: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value): each group against each other group of its language."""
    ours = sizes.select("lang", "source", "own", "kept", "p0")
    theirs = small(sizes.select("lang", F.col("source").alias("other"), F.col("own").alias("other_own"), F.col("p0").alias("q0")))
    pairs = ours.join(theirs, "lang").where("source <> other")
    neither = pairs.select("lang", "source", F.col("other").alias("item"), F.expr(f"(kept - own - other_own) * {gap('p0', 'q0')}").alias("value"))

    bins = priced.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    one = bins.join(theirs, "lang").where("source <> other").groupBy("lang", "source", "other").agg(
        F.expr(f"sum(terms * {gap('p', 'q0')})").alias("there"), F.expr(f"sum(terms * {gap('q0', 'p')})").alias("back")
    )

    mine = priced.select("lang", "term", "source", "p", "p0")
    yours = priced.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    correct = lambda a, a0, b, b0: f"sum({gap(a, b)} - {gap(a, b0)} - {gap(a0, b)} + {gap(a0, b0)})"
    both = mine.join(yours, ["lang", "term"]).where("source < other").groupBy("lang", "source", "other").agg(
        F.expr(correct("p", "p0", "q", "q0")).alias("there"), F.expr(correct("q", "q0", "p", "p0")).alias("back")
    )
    parts = neither.unionByName(both_ways(one)).unionByName(both_ways(both))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): distances to other sources, and the terms a source has most above its language."""
    held = postings(docs, text, lang, source, least)
    sizes = store(group_sizes(held), "groups")
    priced = held.where("term IS NOT NULL").join(small(sizes), ["lang", "source"])
    priced = priced.select("lang", "source", "term", "p0", share("n", "total", "kept").alias("p"), share("lang_n", "lang_total", "kept").alias("q"))
    above = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    pairs = distances(priced, sizes).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(above.select("*", rank).where(F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB SQL for the rows of ``op12_source_divergence``: every group against every kept term, without supports.
OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT lang, source, doc, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
groups AS (SELECT DISTINCT lang, source FROM d),
counted AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
priced AS (
  SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 1)) // (sum(lang_n) OVER g + count(*) OVER g) AS q
  FROM dense WINDOW g AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM priced WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
