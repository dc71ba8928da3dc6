"""Keyed changes to tables: last row per key, upserts, change batches, memberships."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.names import exactly
from tidemark.operators.relational import join_anti, join_left, join_semi


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order`` (missing order values come first).

    An aggregate, not a window: tasks keep one row per key before the shuffle,
    so a key with very many rows costs no more than any other.
    """
    last = F.max_by(F.struct(*exactly(df.columns)), F.struct(*exactly(order))).alias("_last")
    return df.groupBy(*exactly(keys)).agg(last).select("_last.*")


def upsert_rows(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` with a key in ``batch`` give way to the batch's rows."""
    return join_anti(base, batch, list(keys)).unionByName(batch)


def apply_changes(
    base: DataFrame, changes: DataFrame, key: str, seq: str = "seq", op: str = "op"
) -> DataFrame:
    """Apply a batch of ``create``, ``update`` and ``delete`` by key, in ``seq`` order.

    An update sets only the fields given (not null), and needs a row to change:
    on an unknown or deleted key it does nothing. A create starts the key's row
    anew. ``seq`` is unique per key; keys of ``base`` are unique and present.
    """
    fields = [c for c in base.columns if c != key]
    mark = F.when(F.col(op) != "update", F.col(seq))
    folded = changes.groupBy(key).agg(
        F.max(mark).alias("_marked"),
        F.max_by(op, mark).alias("_mark"),
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(seq))).alias(f"_new_{f}") for f in fields],
        *[F.max(F.when(F.col(f).isNotNull(), F.col(seq))).alias(f"_seq_{f}") for f in fields],
    )
    # A field set before the key's last create or delete no longer counts.
    given = folded.select(
        key,
        "_mark",
        *[
            F.when(F.col("_marked").isNull() | (F.col(f"_seq_{f}") >= F.col("_marked")), F.col(f"_new_{f}")).alias(f"_new_{f}")
            for f in fields
        ],
    )
    created = F.col("_mark") == "create"
    kept = join_left(base, given, [key]).where(F.col("_mark").isNull() | created)
    changed = kept.select(
        key,
        *[F.when(created, F.col(f"_new_{f}")).otherwise(F.coalesce(f"_new_{f}", f)).alias(f) for f in fields],
    )
    fresh = _without(given.where(created), base, [key])
    return changed.unionByName(fresh.select(key, *[F.col(f"_new_{f}").alias(f) for f in fields]))


def _without(few: DataFrame, many: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``few`` whose key ``many`` lacks, without moving all of ``many``:
    its keys are first narrowed to those of ``few``, which may be broadcast."""
    return join_anti(few, join_semi(many.select(*keys), few, keys), keys)


# -- group memberships -------------------------------------------------------------

MEMBER = ["group_id", "user_id"]


def add_members(members: DataFrame, additions: DataFrame) -> DataFrame:
    """Memberships with more users added; those already in are not repeated."""
    new = additions.select(*MEMBER).distinct()
    return members.select(*MEMBER).unionByName(_without(new, members, MEMBER))


def create_groups(
    groups: DataFrame, members: DataFrame, new_groups: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Groups and memberships after creating groups (``group_id``, ``name``,
    ``active``, ``users``). A users list with a number below 1 adds nobody."""
    users = F.filter("users", lambda u: F.array_min("users") > 0)
    additions = new_groups.select("group_id", F.explode(users).alias("user_id"))
    return groups.unionByName(new_groups.select(*groups.columns)), add_members(members, additions)


def remove_members(members: DataFrame, removals: DataFrame) -> DataFrame:
    return join_anti(members.select(*MEMBER), removals, MEMBER)


def delete_groups(
    groups: DataFrame, members: DataFrame, doomed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Groups and memberships left after deleting the groups in ``doomed``."""
    return join_anti(groups, doomed, ["group_id"]), join_anti(members, doomed, ["group_id"])


def group_members(groups: DataFrame, group_id: object = None) -> DataFrame:
    """Flat user ids of each group's ``users`` list, or of one group's."""
    if group_id is not None:
        groups = groups.where(F.col("group_id") == F.lit(group_id))
    return groups.select("group_id", F.explode("users").alias("user_id"))
