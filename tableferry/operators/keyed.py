"""Operators on tables that have a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from .quality import require

# Copies of a key left after the first round of `membership_keys`.
MEMBERSHIP_COPIES = 8

Order = Sequence[tuple[str, str]]


def order_columns(order: Order) -> list[Column]:
    """Sort columns from (name, 'asc' | 'desc') pairs, nulls last either way."""
    out = []
    for name, direction in order:
        if direction not in ("asc", "desc"):
            raise ValueError(f"direction must be 'asc' or 'desc', got {direction!r}")
        c = F.col(name)
        out.append(c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last())
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Order) -> DataFrame:
    """The first row of each key in the given order.

    ``order_by`` must end in a tie-break that makes the order total within a
    key, else the winner is undefined. Spark cuts every map task's rows to one
    per key before the shuffle (``WindowGroupLimit``), so a key that holds a
    large share of the table reaches its reducer as one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_columns(order_by)))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def latest_values(df: DataFrame, keys: Sequence[str], order_by: Order) -> DataFrame:
    """One row per key holding, column by column, the first value that is not null in the given order.

    What rows written one after the other leave behind where nulls do not
    overwrite. With one direction throughout, an aggregate with a partial step
    does it, so a key with many rows is cut down before the shuffle; mixed
    directions need each row's rank within its key.
    """
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.select(*keys).distinct()
    directions = {direction for _, direction in order_by}
    if len(directions) == 1:
        down = directions == {"desc"}
        # nulls last either way, as in order_columns
        place = F.struct(*[
            part
            for i, (name, _) in enumerate(order_by)
            for part in ((F.col(name).isNotNull() if down else F.col(name).isNull()).alias(f"n{i}"), F.col(name).alias(f"v{i}"))
        ])
        pick = F.max_by if down else F.min_by
    else:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_columns(order_by)))
        df, place, pick = df.withColumn("__rank", rank), F.col("__rank"), F.min_by
    return df.groupBy(*keys).agg(*[pick(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in values])


def key_list(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return require(df.select(col), [col]).distinct()


def membership_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each non-null key a bounded number of times, for the inner side of a semi or anti join.

    A plain ``distinct`` ends hashed on the key, the join then takes its output
    as it is, and adaptive execution no longer splits a hot key on the other
    side (it only does so between two fresh exchanges). Grouping by key *and* a
    few task groups removes the bulk of the copies just as well, but leaves the
    join its own exchange. Both shuffles carry key columns only.
    """
    task_group = F.pmod(F.spark_partition_id(), F.lit(MEMBERSHIP_COPIES))
    return (
        require(df.select(*keys), keys)
        .groupBy(*keys, task_group.alias("__task_group"))
        .agg(F.lit(1))
        .select(*keys)
    )


def keep_keys(
    df: DataFrame, keys_df: DataFrame, on: str | Sequence[str], keys_unique: bool = False
) -> DataFrame:
    """Rows whose key is in ``keys_df``; column order and duplicates of ``df`` are kept.

    Same rows as an inner join with the distinct list. Null keys never match.
    ``keys_unique`` states that ``keys_df`` holds each key once, which saves
    the copy removal; use it for a stored table, not for the output of a
    ``distinct`` (see ``membership_keys``). Spark broadcasts the list when its measured size is under
    the session's broadcast threshold and shuffles both sides otherwise.
    """
    on = [on] if isinstance(on, str) else list(on)
    wanted = require(keys_df.select(*on), on) if keys_unique else membership_keys(keys_df, on)
    return df.join(wanted, on, "left_semi").select(*df.columns)


def sort_for_load(df: DataFrame, order: Order, global_: bool = True) -> DataFrame:
    """Sort before a load: across the whole table, or within each task's rows only.

    End ``order`` with a column that varies within a hot key, so that the range
    exchange of the global form can split it.
    """
    cols = order_columns(order)
    return df.orderBy(*cols) if global_ else df.sortWithinPartitions(*cols)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values: text by its length, nested values by their JSON, others 8 bytes."""
    size = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size += F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
        size += F.lit(8)
    return df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0


def _refuse_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {
            k: F.coalesce(
                F.col(k),
                F.raise_error(F.lit(f"null in key column {k}")).cast(df.schema[k].dataType),
            )
            for k in keys
        }
    )


def _refuse_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows as they are; a key that repeats fails the job. Leaves them hashed by key, as the join wants them."""
    values = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__times"), *[F.first(c).alias(c) for c in values])
    checked = F.when(F.col("__times") == 1, F.col(keys[0])).otherwise(
        F.raise_error(F.lit(f"new rows repeat a key of {', '.join(keys)}")).cast(df.schema[keys[0]].dataType)
    )
    return once.withColumn(keys[0], checked).select(*df.columns)


def upsert(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order_by: Order | None = None,
    ignore_nulls: bool = True,
    new_unique: bool = False,
) -> DataFrame:
    """The keyed table after ``new`` is written over ``old``.

    A key in one side only is kept as it is. For a key in both, each non-key
    column takes the new value unless that is null; with
    ``ignore_nulls=False`` the new row replaces the old one whole. ``old``
    holds each key once. Of several new rows of a key, each column takes the
    newest value that is not null by ``order_by`` (with ``ignore_nulls=False``
    the newest row counts whole), or ``new`` must be declared ``new_unique``, which is checked: a
    repeated key fails the job, and so does a null key (filter those with ``require`` first). The columns are those of
    ``old``; a column ``new`` lacks counts as null there.

    One plan at all sizes: ``old`` keeps its rows through a left join, and keys
    it lacks are added. Where ``new`` is below the session's broadcast threshold,
    Spark broadcasts it and ``old`` is never shuffled (a full outer join always
    would); above it the rows of ``old`` are shuffled once, and its keys once
    more. ``new`` is read several times: pass a stored table (``sources.stage``).
    """
    keys = list(keys)
    if order_by is None and not new_unique:
        raise ValueError("new may repeat a key: give order_by, or declare new_unique=True")
    values = [c for c in old.columns if c not in keys]
    new = _refuse_null_keys(new, keys)
    if order_by is None:
        new = _refuse_repeats(new, keys)
    else:
        new = (latest_values if ignore_nulls else latest_per_key)(new, keys, order_by)
    new = new.select(
        *[F.col(k).cast(old.schema[k].dataType).alias(k) for k in keys],
        *[
            (F.col(c) if c in new.columns else F.lit(None)).cast(old.schema[c].dataType).alias(f"__new_{c}")
            for c in values
        ],
        F.lit(True).alias("__is_new"),
    )

    def merged(c: str) -> Column:
        replacement = F.col(f"__new_{c}")
        if ignore_nulls:
            return F.coalesce(replacement, F.col(c))
        return F.when(F.col("__is_new"), replacement).otherwise(F.col(c))

    kept = old.join(new, keys, "left")
    # few keys at most: those of `new` that are in `old`
    found = old.select(*keys).join(new.select(*keys), keys, "left_semi")
    added = new.join(found, keys, "left_anti").select(
        *[F.col(c) if c in keys else F.col(f"__new_{c}").alias(c) for c in old.columns]
    )
    return kept.select(*[merged(c).alias(c) if c in values else F.col(c) for c in old.columns]).unionByName(added)
