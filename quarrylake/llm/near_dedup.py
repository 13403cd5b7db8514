"""Near-duplicate groups by bottom-k sketches of one hash function.

A document's set holds a 64-bit hash of each distinct run of five words; its sketch holds the
``K`` smallest.  Steps:

1. Equal sets (by a 128-bit digest) become one class; only its representative goes on.
2. Sketch values are counted over all classes.  Of two sets with a Jaccard index of 0.75 or more the
   sketches share at least ``s`` values (exactly where a set fits its sketch, else but for a chance
   of ``RISK``).  So a class with fewer than ``s`` values that others retain too has no link, and for
   the rest it is enough to look at the a - s + 1 rarest of its a such values: two linked classes
   meet in the inverted list of at least one of them.  Passages that many documents share are the
   most frequent values and drop out.
3. Inverted lists give candidates.  First each class meets the first and the most typical member of
   its lists (the one with the fewest values of its own), so a group of thousands of near copies
   needs a few pairs for each; then, in lists that still hold several components, pairs across
   components meet.  Short lists are joined.  Classes that long lists hold together are a family.
   A family is split by set size, as linked sets differ by a third at most, and each part into
   blocks bounded in classes and bytes.  Two blocks of the same or of neighbouring sizes meet with
   their full sets in one task, which counts all overlaps at once as a product of matrices and emits
   only links that join components.
4. The union of two sketches estimates the index and drops pairs that are far below 0.75.
5. The others are decided exactly on full sets, which a second pass over the texts makes for the
   classes that still matter; links give components.

Nothing is dropped for being frequent: step 3 leaves out only pairs in one component already.

Rows: a null text or one without words has an empty set and is linked with nothing.  Fewer than
five words make one run.  A key that comes with several texts links their sets to each other, and
each of them is compared.  A null key is never linked, its component is null and it is kept.  Equal
rows get equal results.  An empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, may_hold, slices, store, strings, words
from .components import SALTS, components
from .exact_dedup import located, on_files, only

WIDTH, K, RISK = 5, 64, 1e-10
#: Linked: ``HUNDREDTHS`` * union <= 100 * intersection.
HUNDREDTHS = 75
#: A pair whose estimate lies this many standard deviations below the limit is dropped.
SPREAD = 6.5
#: The same for a class's values that others hold too, which scatter more.
WIDE = 8.0
#: Longest inverted list whose pairs are joined; classes and about the bytes of a family's block, and hashes that a task lays out at a time.
SHORT_LIST, BLOCK, BLOCK_BYTES, COLUMNS = 48, 400, 1 << 20, 4096
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Each text's set as a sorted array of 64-bit hashes."""
    flat, offsets = words(pc.ascii_lower(texts))
    coded = flat.dictionary_encode()
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    hashes = each[coded.indices.to_numpy()] if len(coded) else each
    runs = hashes
    if len(hashes) >= width:
        runs = hashes[: len(hashes) - width + 1].copy()
        for j in range(1, width):
            runs *= _MULTIPLY
            runs += hashes[j : len(hashes) - width + 1 + j]
        runs = _mixed(runs)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            yield np.unique(runs[a : b - width + 1])
        elif b > a:
            yield np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), seed=b - a)], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def least_overlap(n: int, k: int = K, hundredths: int = HUNDREDTHS) -> int:
    """Values that the sketches of a set of ``n`` and of any set linked with it share at least."""
    if n <= k:
        return max(1, min(-(-n * hundredths // 100), k - (n * (100 - hundredths)) // hundredths))
    p, tail, s = hundredths / 100, 0.0, 0
    while s < k:
        tail += math.comb(k, s) * p**s * (1 - p) ** (k - s)
        if tail > RISK:
            break
        s += 1
    return max(1, s)


def _lists(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def sketches(docs: DataFrame, key: str, text: str, width: int, k: int, carry: tuple[str, ...]) -> DataFrame:
    """Per row: id, n (set size), digest, sketch (the k smallest hashes, ascending unsigned)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, digests, low = [], [], []
                for own in shingle_sets(strings(part.column("text")), width):
                    n.append(len(own))
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    low.append(own[:k])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), _lists(low), *(part.column(c) for c in carry)],
                    names=["id", "n", "digest", "sketch", *carry],
                )

    kinds = dict(docs.dtypes)
    schema = ", ".join(["id bigint, n bigint, digest binary, sketch array<bigint>", *(f"{c} {kinds[c]}" for c in carry)])
    return docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"), *carry).mapInArrow(rows, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, hashes) of the wanted classes (id, digest).  A filter keeps most other texts out before the shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = [own.tobytes() for own in shingle_sets(strings(part.column("text")), width)]
                digests = [xxhash.xxh3_128_digest(own) for own in made]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(digests, pa.binary()), pa.array(made, pa.binary())], names=["id", "digest", "hashes"])

    body = docs.where(docs[key].isNotNull()).select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    made = may_hold(body, wanted, "id").mapInArrow(rows, "id bigint, digest binary, hashes binary")
    return made.join(wanted, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"]).drop("digest")


def shared_of_union(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Values of the union's sketch that both sketches hold, and the union's sketch size."""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    distinct = np.cumsum(np.r_[True, ~twice])
    size = min(k, int(distinct[-1]))
    return int((twice & (distinct[1:] <= size)).sum()), size


def may_link(shared: int, size: int, hundredths: int = HUNDREDTHS) -> bool:
    p = hundredths / 100
    return shared >= size * p - SPREAD * math.sqrt(size * p * (1 - p))


def _estimated(pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) whose sketches' union does not speak against a link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            left, right = (batch.column(c) for c in ("sketch_a", "sketch_b"))
            ends = [c.offsets.to_numpy() for c in (left, right)]
            values = [c.values.to_numpy().view(np.uint64) for c in (left, right)]
            for i in range(batch.num_rows):
                x, y = (v[e[i] : e[i + 1]] for v, e in zip(values, ends))
                keep.append(may_link(*shared_of_union(x, y, k)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])
        give_back()

    one = classes.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"))
    two = classes.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(rows, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, hundredths: int) -> DataFrame:
    """The pairs whose full sets are linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = np.concatenate([u, v])
                both.sort()
                n = int((both[1:] == both[:-1]).sum())
                keep.append(100 * n >= hundredths * (len(both) - n))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])
        give_back()

    one = sets.select(F.col("id").alias("a"), F.col("hashes").alias("set_a"))
    two = sets.select(F.col("id").alias("b"), F.col("hashes").alias("set_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b").mapInArrow(rows, "a bigint, b bigint")  # a class may come twice, for keys with several texts


def _mixed_lists(members: DataFrame) -> DataFrame:
    """Members (value, id, n, component, ...) of those lists that hold several components."""
    several = members.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return members.join(several.select("value"), "value", "left_semi")


def _able(k: int, hundredths: int):
    """Whether ``a`` values shared with others suffice for a link in a list with sizes from low to high.

    Sets that are linked overlap in 75/175 of their sizes' sum.  A set within its sketch can lose of
    that only what a larger partner's sketch leaves out; of larger sets the sketches share a part
    that scatters, hence ``WIDE`` standard deviations.
    """
    share, n, a = hundredths / (100 + hundredths), F.col("n"), F.col("a")
    low, high = F.greatest(F.col("low"), n * hundredths / 100), F.least(F.col("high"), n * 100 / hundredths)
    part = share * (1 + F.least(low / n, n / high))
    sure = F.least(share * (n + low), F.when(high > k, share * n - (1 - share) * high + k).otherwise(share * (n + low)))
    return F.when(n > k, a >= k * part - WIDE * F.sqrt(k * part * (1 - part))).otherwise(a >= sure - 0.01)


def _near_in_size(x: str, y: str, hundredths: int):
    return F.lit(100) * F.least(x, y) >= F.lit(hundredths) * F.greatest(x, y)


def _met_most(ends: DataFrame, hundredths: int) -> DataFrame:
    """Pairs of each class (id, n, end) with the three ends of near size that it meets most often."""
    met = ends.where("id != end.id").where(_near_in_size("n", "end.n", hundredths)).groupBy("id", F.col("end.id").alias("end")).agg(F.count(F.lit(1)).alias("times"))
    order = F.sort_array(F.collect_list(F.struct("times", (-F.col("end")).alias("end"))), False)  # as many ends as a class has lists
    best = met.groupBy("id").agg(F.slice(order, 1, 3).alias("best"))
    first = best.select("id", F.explode("best.end").alias("end")).withColumn("end", -F.col("end"))
    return first.select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")).distinct()


def _across(members: DataFrame, hundredths: int) -> DataFrame:
    """Pairs across components of short lists."""
    x, y = members.alias("x"), members.alias("y")
    apart = x.join(y, "value").where("x.id < y.id AND x.component != y.component").where(_near_in_size("x.n", "y.n", hundredths))
    return apart.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _overlaps(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``rows`` with all sets."""
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    column = np.cumsum(counts > 1) - 1
    several = counts[place] > 1
    owner, place = owner[several], column[place[several]]
    total = np.zeros((len(rows), len(sets)), np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for a in range(0, int((counts > 1).sum()), COLUMNS):
        x, y = np.searchsorted(place, [a, a + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[x:y], place[x:y] - a] = 1
        total += has[rows] @ has.T
    return total


MEETING = "array<struct<band:int,across:int,i:int,j:int>>"


def _in_blocks(members: DataFrame, sets: DataFrame, hundredths: int) -> DataFrame:
    """Links that join components of a family (columns family, id, component)."""
    held = members.join(sets, "id").withColumn("n", F.octet_length("hashes") / 8)
    # Sizes of linked sets lie in the same band or in neighbouring ones.
    held = held.withColumn("band", F.floor(F.log("n") / math.log(100 / hundredths + 0.01)).cast("int"))
    held = store(held.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), "held")
    # Counted for each salt first and joined back so, as one family may hold most rows.
    parts = held.groupBy("family", "band", "salt").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("hashes"))
    blocks = F.ceil(F.greatest(F.sum("rows") / BLOCK, F.sum("hashes") * 8 / BLOCK_BYTES)).cast("int")
    sizes = parts.groupBy("family", "band").agg(blocks.alias("blocks"))
    others = [sizes.select("family", (F.col("band") + step).alias("band"), F.col("blocks").alias(name)) for step, name in ((-1, "above"), (1, "below"))]
    sizes = sizes.join(others[0], ["family", "band"], "left").join(others[1], ["family", "band"], "left").fillna(0, ["above", "below"])
    sizes = parts.select("family", "band", "salt").join(sizes, ["family", "band"])
    placed = held.join(sizes, ["family", "band", "salt"]).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))

    def blocks_of(count: str, at) -> Column:
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), at)).otherwise(F.array().cast(MEETING))

    def meeting(band, across: int, i, j) -> Column:
        return F.struct(band.alias("band"), F.lit(across).alias("across"), i.alias("i"), j.alias("j"))

    band, own = F.col("band"), F.col("own")
    met = F.concat(
        blocks_of("blocks", lambda x: meeting(band, 0, F.least(own, x), F.greatest(own, x))),
        blocks_of("above", lambda x: meeting(band, 1, own, x)),
        blocks_of("below", lambda x: meeting(band - 1, 1, x, own)),
    )
    placed = placed.select("family", "id", "component", "hashes", F.explode(met).alias("met")).select("family", "id", "component", "hashes", "met.*")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, comp = pdf["id"].to_numpy(), pdf["component"].to_numpy()
        each = [np.frombuffer(h, np.uint64) for h in pdf["hashes"]]
        n = np.array([len(x) for x in each])
        names, comp, counts = np.unique(comp, return_inverse=True, return_counts=True)
        rows = np.flatnonzero(comp != counts.argmax())  # of two in different components one is not in the largest
        found, parent = [], list(range(len(names)))

        def find(x: int) -> int:
            while parent[x] != x:
                x = parent[x]
            return x

        if len(rows):
            common = _overlaps(each, rows)
            linked = 100 * common >= hundredths * (n[rows][:, None] + n - common)
            for r, y in zip(*np.nonzero(linked & (comp[rows][:, None] != comp))):
                x = rows[r]
                u, v = find(comp[x]), find(comp[y])
                if u != v:
                    parent[max(u, v)] = min(u, v)
                    found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return placed.groupBy("family", "band", "across", "i", "j").applyInPandas(meet, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, k: int = K,
    hundredths: int = HUNDREDTHS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable), kept; and columns to carry."""
    made = store(sketches(docs, key, text, width, k, carry), "sketches")
    full = made.where("n > 0 AND id IS NOT NULL")
    classes = full.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # A class is known by its smallest id; ``part`` tells apart the classes of an id with several texts.
    twice = store(full.groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least != most").select("id"), "twice")
    several = store(full.select("id", "digest").join(twice, "id", "left_semi").distinct(), "several")
    parts = several.select("id", "digest", F.row_number().over(Window.partitionBy("id").orderBy("digest")).alias("part"))
    classes = store(classes.join(parts, ["id", "digest"], "left").fillna(0, ["part"]), "classes")
    same_id = several.join(classes.select("digest", F.col("id").alias("node")), "digest")
    same_id = same_id.where("id != node").select(F.least("id", "node").alias("a"), F.greatest("id", "node").alias("b"))

    values = classes.select("id", "part", "n", F.explode("sketch").alias("value"))
    frequent = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    retained = values.join(frequent, "value")
    enough = F.lit(least_overlap(k + 1, k, hundredths))
    small = F.array(*[F.lit(least_overlap(n, k, hundredths)) for n in range(k + 1)])
    own = retained.groupBy("id", "part", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))  # at most k values
    least = F.when(F.col("n") > k, enough).otherwise(F.get(small, F.col("n").cast("int")))
    own = own.withColumn("take", F.size("shared") - least + 1).where("take > 0")
    prefix = own.select("id", "n", F.size("shared").alias("a"), F.explode(F.slice("shared", F.lit(1), F.col("take"))).alias("x"))
    prefix = store(prefix.select("id", "n", "a", "x.value"), "prefix")

    # A class stays in a list if its shared values allow a link with a class of the list's sizes.
    sizes = prefix.groupBy("value").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("length")).where("length > 1")
    prefix = store(prefix.join(sizes, "value").where(_able(k, hundredths)).select("id", "n", "a", "value"), "able")

    lists = prefix.groupBy("value").agg(
        F.count(F.lit(1)).alias("length"), F.min(F.struct("id", "n")).alias("first"), F.max(F.struct("a", "id", "n")).alias("typical")
    ).where("length > 1")
    lists = lists.select("value", "length", "first", F.struct("typical.id", "typical.n").alias("typical"))
    listed = store(prefix.drop("a").join(lists, "value"), "listed")
    wanted = store(listed.select("id").distinct().join(classes.select("id", "digest"), "id"), "wanted")
    sets = store(full_sets(docs, wanted, key, text, width), "sets")

    # First round: each class and those two of its lists.
    tested = store(_met_most(listed.select("id", "n", F.explode(F.array("first", "typical")).alias("end")), hundredths), "tested")
    links = _confirmed(_estimated(tested, classes, k), sets, hundredths)
    known = components(links.union(same_id))

    # Second round: pairs across components, in lists that hold several.
    members = listed.select("value", "id", "n", "length", F.col("first.id").alias("head")).join(known.withColumnRenamed("node", "id"), "id", "left")
    members = store(_mixed_lists(members.withColumn("component", F.coalesce("component", "id"))), "members")
    pairs = _across(members.where(F.col("length") <= SHORT_LIST), hundredths)

    pairs = pairs.distinct().join(tested, ["a", "b"], "left_anti")
    long = members.where(F.col("length") > SHORT_LIST)
    families = store(components(long.select(F.col("head").alias("a"), F.col("id").alias("b"))), "families")
    family = long.select("id", "component").distinct().join(families.select(F.col("node").alias("id"), F.col("component").alias("family")), "id")
    blocks = _in_blocks(family, sets, hundredths)
    more = store(_confirmed(_estimated(pairs, classes, k), sets, hundredths).union(blocks), "more")
    if not more.isEmpty():
        known = components(more.union(known.select(F.col("component").alias("a"), F.col("node").alias("b"))))

    ids = made.join(classes.select("digest", F.col("id").alias("class")), "digest", "left")
    ids = ids.withColumn("class", F.coalesce("class", "id"))
    found = ids.join(known.withColumnRenamed("node", "class"), "class", "left")
    component = F.coalesce("component", "class")
    return found.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), *carry)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group stays (the smallest doc_id), with all its columns.

    Texts without words and rows without an id are in no group and stay; repeated rows of an id that
    stays do too; an empty table stays empty.
    """
    docs = on_files(docs)
    return only(docs, near_duplicates(located(docs.select("doc_id", "text")), carry=("_file", "_row")).where("kept"))
