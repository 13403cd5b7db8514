"""Mixing overlapping sources to target weights by minimum-cost flow.

Documents are counted by membership pattern (the set of sources they belong to).  A small network
routes each pattern's tokens to its sources' quotas: one copy of a document is free, each further
copy costs one more than the last, so repeats are bought only where single copies cannot fill a
quota.  As costs lie on the arcs that leave the network's start, filling by levels of cost with
augmenting paths gives a flow of least cost.

Documents are then drawn in the order of a seeded hash.  A pattern's order is cut into buckets of
about ``BUCKET`` documents by hash; running totals over buckets say which buckets a quota takes
whole, and the documents of a bucket in which a quota ends are filled in one by one.  No task sees
more than a bucket, whatever a pattern's share of the corpus.

The network falls apart where no pattern links sources: connected components of sources, found by
Spark, are networks of their own, each solved in one task from its patterns' totals.  Neither the
number of sources nor that of patterns has a cap; where each document has one source, each source is a
network.

Rows: a null or empty text has size 0 and is never taken; a null source is a source of its own, ordered
last.  Rows of one key are drawn each on its own; equal rows in any order.  An empty table gives an
empty result.  Other columns are never read.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hashed, store
from .components import components
from .exact_dedup import located, on_files, rows_at

#: Documents that one task draws from at a time.
BUCKET = 2000
Source = str | None
Targets = Callable[[dict[Source, int]], dict[Source, float]]


def ordered(sources: set[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def shared_targets(sizes: dict[Source, int], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict[Source, float]:
    """Targets that share ``share`` of all sizes by repeating weights; none is above ``most`` times its size."""
    names = ordered(set(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, targets = share * sum(sizes.values()), list(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * unit > most * sizes[s]]
        if not above:
            return targets | {s: weight[s] * unit for s in free}
        for s in above:
            targets[s] = most * sizes[s]
            left -= targets[s]
        free = [s for s in free if s not in targets]
    return targets


def route(capacity: dict[tuple, int], quota: dict[Source, int], copies: int) -> dict[tuple, list[dict[Source, int]]]:
    """Least-cost flow: for each pattern and copy, the tokens that go to each source."""
    members = defaultdict(list)
    for pattern in capacity:
        for s in pattern:
            members[s].append(pattern)
    sent: dict[tuple, dict[Source, int]] = {p: dict.fromkeys(p, 0) for p in capacity}
    room = dict(quota)
    total = {p: 0 for p in capacity}
    levels: dict[tuple, list[dict[Source, int]]] = {p: [] for p in capacity}
    for level in range(1, copies + 1):
        for start in capacity:
            while total[start] < level * capacity[start]:
                # Breadth first from the pattern to a source with room; a full source passes on to
                # patterns that send to it, which may send elsewhere instead.
                came: dict = {("p", start): None}
                queue, end = deque([("p", start)]), None
                while queue and end is None:
                    kind, x = node = queue.popleft()
                    if kind == "p":
                        for s in x:
                            if ("s", s) not in came:
                                came["s", s] = node
                                if room.get(s, 0) > 0:
                                    end = ("s", s)
                                    break
                                queue.append(("s", s))
                    else:
                        for p in members[x]:
                            if sent[p][x] > 0 and ("p", p) not in came:
                                came["p", p] = node
                                queue.append(("p", p))
                if end is None:
                    break
                path = [end]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                amount = min(level * capacity[start] - total[start], room[end[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "s":
                        amount = min(amount, sent[b[1]][a[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "p":
                        sent[a[1]][b[1]] += amount
                    else:
                        sent[b[1]][a[1]] -= amount
                total[start] += amount
                room[end[1]] -= amount
    # Split each pattern's flow into copies: the first holds up to its capacity, then the next.
    for p, flow in sent.items():
        rest = [(s, n) for s, n in flow.items() if n]
        for _ in range(copies):
            here, space = {}, capacity[p]
            while rest and space:
                s, n = rest.pop(0)
                here[s] = min(n, space)
                space -= here[s]
                if here[s] < n:
                    rest.insert(0, (s, n - here[s]))
            if here:
                levels[p].append(here)
    return levels


def draw(pdf: pd.DataFrame, lower: int, segments: list[tuple[int, int, int]]) -> np.ndarray:
    """Which segment each document of a bucket goes to (-1: none); ``pdf`` is in drawing order.

    A segment (from, to, number) is a stretch of the pattern's running total; ``lower`` is where
    the bucket begins.  Documents that fit are taken in order; at last one that comes nearer.
    """
    sizes = pdf["size"].to_numpy()
    upper, taken = lower + int(sizes.sum()), np.full(len(sizes), -1)
    for a, b, number in segments:
        a, b = max(a, lower), min(b, upper)
        if a >= b:
            continue
        if (a, b) == (lower, upper):
            taken[:] = number
            break
        left = b - a
        for i in np.flatnonzero(taken < 0):
            if sizes[i] <= left:
                taken[i] = number
                left -= int(sizes[i])
        open_ = np.flatnonzero(taken < 0)
        if left and len(open_):
            best = open_[np.argmin(np.abs(sizes[open_] - left))]
            if abs(int(sizes[best]) - left) < left:
                taken[best] = number
    return taken


def numbered(sizes: DataFrame) -> DataFrame:
    """Sources (source, source_size) with ``rank``: by code point, null last, inside ranges and the ranges one after another."""
    order = F.col("source").asc_nulls_last()
    ranges = store(sizes.repartitionByRange(32, order).withColumn("part", F.spark_partition_id()), "sources")
    before, offsets = 0, []
    for part, n in sorted(map(tuple, ranges.groupBy("part").count().collect())):  # at most 32 rows
        offsets.append((part, before))
        before += n
    starts = sizes.sparkSession.createDataFrame(offsets, "part int, start long")
    rank = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return store(ranges.join(F.broadcast(starts), "part").withColumn("rank", rank).drop("part", "start"), "sources")


def with_shared_targets(known: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``shared_targets`` for any number of sources: adds target to (source, source_size, rank)."""
    known = known.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int")))
    # The level that free sources share; each round holds more sources at ``most`` times their size.
    total = known.agg(F.sum("source_size")).first()[0] or 0
    unit, held = 0.0, -1
    while True:
        above = F.col("weight") * unit > most * F.col("source_size") if held >= 0 else F.lit(False)
        n, sizes, free = known.agg(F.count_if(above), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == held or not free:
            break
        held, unit = n, (share * total - most * (sizes or 0)) / free
    # Sources that were held stay so when none is free.
    return known.withColumn("target", F.least(F.col("weight") * unit, most * F.col("source_size"))).drop("weight")


def with_targets(known: DataFrame, targets: Targets) -> DataFrame:
    """A caller's own targets: a function of a dict of sizes, so for as many sources as a dict may hold."""
    goal = targets({r["source"]: r["source_size"] for r in known.collect()})
    own = known.sparkSession.createDataFrame([(s, float(t)) for s, t in goal.items()], "own string, target double")
    return known.join(own, F.col("source").eqNullSafe(F.col("own")), "left").drop("own").fillna(0.0, ["target"])


SEGMENTS = "array<struct<copy:int,start:bigint,stop:bigint,source:string>>"


def routed(patterns: DataFrame, known: DataFrame, copies: int) -> DataFrame:
    """Least-cost flow for every network: per pattern (members, tokens, n) its segments, and whether they take it whole.

    Sources that patterns link form a network of their own, which no quota or capacity outside it
    touches; so each is solved in one task.  A segment is a stretch of the pattern's running total.
    """
    arcs = patterns.select("number", "tokens", F.explode("members").alias("source"))
    to = known.select(F.col("source").alias("own"), "rank", F.rint("target").cast("long").alias("quota"))
    arcs = store(arcs.join(to, F.col("source").eqNullSafe(F.col("own"))).drop("own"), "arcs")
    first = arcs.groupBy("number").agg(F.min("rank").alias("a"))
    linked = components(arcs.join(first, "number").select("a", F.col("rank").alias("b")))
    arcs = arcs.join(linked, F.col("rank") == F.col("node"), "left").withColumn("network", F.coalesce("component", "rank"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        name = {r: None if pd.isna(s) else s for r, s in zip(pdf["rank"], pdf["source"])}
        quota = dict(zip(pdf["rank"], pdf["quota"].tolist()))
        own = {tuple(sorted(x["rank"])): (number, int(x["tokens"].iloc[0])) for number, x in pdf.groupby("number")}
        flow = route({p: own[p][1] for p in sorted(own)}, quota, copies)
        out = []
        for p, levels in flow.items():
            segments, whole = [], True
            for copy, level in enumerate(levels):
                at = 0
                for s, n in level.items():
                    segments.append({"copy": copy, "start": at, "stop": at + n, "source": name[s]})
                    at += n
                whole &= len(level) == 1 and at == own[p][1]
            out.append((own[p][0], segments, whole))
        return pd.DataFrame(out, columns=["number", "segments", "whole"])

    return arcs.groupBy("network").applyInPandas(solve, f"number bigint, segments {SEGMENTS}, whole boolean")


def mix(
    docs: DataFrame,
    members: Column,
    targets: Targets | None = None,
    copies: int = 2,
    seed: int = 3,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """The mix, and its sources.

    First: per row id, members, size, routes (the source that each copy counts for) and columns to
    carry.  Second: source, source_size, target.  ``members`` is an array of the row's sources (null:
    none).  Without ``targets`` they are ``shared_targets``, for any number of sources.
    """
    size = F.coalesce(F.regexp_count(docs[text], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    place = F.xxhash64(F.lit(seed), docs[key], F.lit(seed + 1)).bitwiseAND((1 << 52) - 1)
    belongs = F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>"))))
    rows = store(docs.select(docs[key].alias("id"), belongs.alias("members"), size.alias("size"), place.alias("place"), *carry), "sizes")

    patterns = rows.groupBy("members").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("n"))
    patterns = store(patterns.withColumn("number", F.monotonically_increasing_id()), "patterns")
    known = numbered(patterns.select("tokens", F.explode("members").alias("source")).groupBy("source").agg(F.sum("tokens").alias("source_size")))
    sources = store(with_targets(known, targets) if targets else with_shared_targets(known), "targets")
    plan = store(patterns.join(routed(patterns, sources, copies), "number").where("size(segments) > 0"), "plan")

    tagged = rows.join(plan, "members", "left")
    none = F.array().cast("array<string>")
    result = ["id", "members", "size", "routes", *carry]
    settled = tagged.where("whole IS NULL OR whole OR size = 0")
    settled = settled.withColumn("routes", F.when(F.col("whole") & (F.col("size") > 0), F.col("segments.source")).otherwise(none)).select(*result)
    open_ = tagged.where("NOT whole AND size > 0")
    buckets = F.greatest(F.lit(1), F.expr(f"n div {BUCKET}"))
    open_ = open_.withColumn("bucket", (F.col("place") * buckets / float(1 << 52)).cast("long"))
    totals = open_.groupBy("number", "bucket").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("number", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("lower"))
    kinds = {f.name: f.dataType.simpleString() for f in settled.schema}

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "id", "size"], kind="stable", ignore_index=True)
        lower, segments = int(pdf["lower"].iloc[0]), list(pdf["segments"].iloc[0])
        routes: list[list[Source]] = [[] for _ in range(len(pdf))]
        for copy in range(copies):
            own = [(x["start"], x["stop"], i) for i, x in enumerate(segments) if x["copy"] == copy]
            for i, number in enumerate(draw(pdf, lower, own)):
                if number >= 0:
                    routes[i].append(segments[number]["source"])
        return pdf.assign(routes=routes)[result]

    drawn = open_.join(totals, ["number", "bucket"]).groupBy("number", "bucket").applyInPandas(fill, ", ".join(f"`{c}` {kinds[c]}" for c in result))
    return settled.unionByName(drawn), sources.select("source", "source_size", "target")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed, sources = mix(docs, F.array("source"))
    told = mixed.join(sources, F.get("members", F.lit(0)).eqNullSafe(F.col("source")), "left")
    taken = (F.col("size") * F.size("routes")).cast("long")
    return told.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def sources_of_copies(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``members``: the sources of all rows with an equal text (null: empty), its own among them.

    Sources are counted once a text before texts meet, so a text that most rows share costs each task a few rows.
    """
    rows = docs.withColumn("_digest", F.unhex(F.sha2(F.coalesce(docs[text], F.lit("")), 256)))
    held = rows.select("_digest", F.col(source).alias("_source")).distinct()
    several = held.groupBy("_digest").agg(F.collect_set(F.struct("_source")).alias("_all")).where("size(_all) > 1")  # no more than there are sources
    members = F.coalesce(F.transform("_all", lambda x: x["_source"]), F.array(rows[source]))
    return rows.join(several, "_digest", "left").withColumn("members", members).drop("_digest", "_all")


def mixing_by_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix in which a document belongs to every source that holds its text, so that the flow decides which quota it fills.

    Per row: doc_id, source, members (how many sources), size, taken, and the sources that its copies count for.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixed, _ = mix(sources_of_copies(docs), F.col("members"), carry=("source",))
    routes = F.array_join("routes", ",", "")
    return mixed.select(
        F.col("id").alias("doc_id"), "source", F.size("members").alias("members"), "size", (F.col("size") * F.size("routes")).cast("long").alias("taken"), routes.alias("routes"),
    )


def take_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it, with all its columns.

    A null text has no words and is not taken; a null source is a source of its own; an empty table stays empty.
    """
    docs = on_files(docs)
    content = located(docs.select("doc_id", "text", "source"))
    mixed, _ = mix(content, F.array("source"), carry=("_file", "_row"))
    copies = store(mixed.select("_file", "_row", F.size("routes").alias("copies")).where("copies > 0"), "copies")
    rows = rows_at(docs).join(hashed(copies), ["_file", "_row"])
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
