"""Current-state upsert: newest row by key, then a guarded merge, on tables without MERGE."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """One row for each key, the largest by ``newest`` (end it with a tie-breaker for fixed results; nulls are smallest).

    An aggregate, which is combined before the shuffle: a key that most rows share costs each task one row.
    """
    best = F.max_by(F.struct(*[rows[c] for c in rows.columns]), F.struct(*newest))
    return rows.groupBy(*keys).agg(best.alias("_best")).select("_best.*")


def merge_current_state(
    target: DataFrame, source: DataFrame, key: str = "id", first: str = "first_seen_at", last: str = "last_seen_at",
    guarded: Iterable[str] = (), guard: str | None = None,
) -> DataFrame:
    """The target after a merge of ``source`` (one row for each key).

    A newer row replaces all columns but keeps the first sight; an older one can only lower the
    first sight (one that is null stays null); a new key is inserted; an equal time changes nothing; nothing is deleted.
    ``guarded`` columns are replaced only where the source's ``guard`` is true; on insert they take
    the source's values.  One full outer join on the key.
    """
    guarded = set(guarded)
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    new = F.col(f"t.{key}").isNull()
    newer = F.col(f"t.{last}") < F.col(f"s.{last}")
    out = []
    for c in target.columns:
        old, got = F.col(f"t.{c}"), F.col(f"s.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        if c == key:
            value = F.coalesce(old, got)
        elif c == first:
            value = F.when(new, got).when(~F.coalesce(newer, F.lit(False)) & (old > got), got).otherwise(old)
        elif c in guarded and guard:
            value = F.when(new, got).when(newer & F.col(f"s.{guard}"), got).otherwise(old)
        else:
            value = F.when(new | newer, got).otherwise(old)
        out.append(value.alias(c))
    return joined.select(*out)


def merge_postings(source: str, target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merge a day's incoming rows of one publisher: newest landing for each id, then the guarded merge."""
    from ..schemas import DETAIL_COLUMNS

    newest = latest_per_key(incoming, ["id"], [F.col("landed_at"), F.xxhash64("raw")])
    if source != "workable":
        return merge_current_state(target, newest)
    newest = newest.withColumn("detail_fetched_at", F.when(F.col("has_detail"), F.col("last_seen_at")))
    return merge_current_state(target, newest, guarded=DETAIL_COLUMNS, guard="has_detail")
