"""Merge rows into a table by key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str], last: bool) -> DataFrame:
    """The best row per key. The first version column, a number or a time, is aggregated by hash before the shuffle;
    the rest of the version only decides among the rows that share its best value, so a table is never sorted."""
    names = {k: f"_key_{n}" for n, k in enumerate(keys)}
    found = F.max(version[0]) if last else F.min(version[0])
    best = rows.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(found.alias("_best"))
    same = rows[version[0]].eqNullSafe(best["_best"])
    for k, n in names.items():
        same = same & rows[k].eqNullSafe(best[n])
    near = rows.join(best, same, "left_semi")
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(*version, *[c for c in rest if c not in version])
    pick = F.max_by(F.struct(*rest), order) if last else F.min_by(F.struct(*rest), order)
    return near.groupBy(*keys).agg(pick.alias("row")).select(*keys, "row.*").select(*rows.columns)


def latest_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the highest version per key; the other columns decide ties."""
    return _one_per_key(rows, keys, version, last=True)


def earliest_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the lowest version per key; the other columns decide ties."""
    return _one_per_key(rows, keys, version, last=False)


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source replace those with the same key, other source rows are added.

    `source` holds a key at most once; use `latest_per_key` before if it may not. The match is null-safe.
    """
    updates = source.select(*target.columns)
    t, s = target.alias("t"), updates.alias("s")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    return t.join(s, same, "left_anti").unionByName(updates)


def count_known(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Keys of the source that the target does not have, and those that it has. Of both only the keys are read; as in `only_new_rows`, a null key is never known."""
    known = target.select(*keys, F.lit(True).alias("_known")).distinct()
    found = source.select(*keys).distinct().join(known, list(keys), "left").agg(F.count_if(F.col("_known").isNull()).alias("new"), F.count("_known").alias("old")).first()
    return found["new"], found["old"]


#: Keys that are sent to all executors rather than to have wide rows shuffled; some 50 MB of match numbers.
MOST_KEYS = 500_000


def only_new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], most_sent: int = 0) -> DataFrame:
    """Source rows whose key the target does not have. With `most_sent` the keys are counted, and sent to the rows if they are no more."""
    known = target.select(*keys).distinct()
    if most_sent and known.limit(most_sent + 1).count() <= most_sent:
        known = F.broadcast(known)
    return source.join(known, list(keys), "left_anti")
