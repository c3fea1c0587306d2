"""Physical layout a user asks for by hand, and proof of what the plan makes of it."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.sources.sinks import write_text


def spread_by(rows: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """`partitions` parts by hash of the keys. For stored layouts; joins and groupings shuffle by themselves."""
    return rows.repartition(partitions, *keys)


def enrich_with_group_counts(rows: DataFrame, by: str = "operator", counts_name: str = "group_events") -> DataFrame:
    """Each row with the size of its group.

    Groups are counted first and joined back: a window would bring a whole group into one task. Whether the
    counts are broadcast is left to the planner, which sees their size at run time.
    """
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias(counts_name))
    return rows.join(counts, by)


def sample_by_key(rows: DataFrame, fraction: float, key: Sequence[str], seed: int) -> DataFrame:
    """A Bernoulli sample that a row's key and the seed decide: the same rows on every cluster, however the
    table is partitioned."""
    parts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key)
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return rows.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < F.lit(fraction * 2**32))


def plan_text(rows: DataFrame, mode: str = "extended") -> str:
    """What `explain` prints."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        rows.explain(mode)
    return printed.getvalue()


def save_plan(rows: DataFrame, path: str, mode: str = "formatted") -> None:
    """The plan as a text file, as evidence beside the result."""
    write_text(rows.sparkSession, plan_text(rows, mode), path)


def store_bucketed(rows: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """`rows` as a table of the catalog, in `buckets` files by hash of `keys` and in their order.

    Joins and groupings on the keys then need no exchange of this table, as often as it is read. Rows are dealt
    before they are written, so that there is one file per bucket and not one per bucket and task.
    """
    dealt = rows.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return rows.sparkSession.table(name)
