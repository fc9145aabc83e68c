"""Keyed merges as pure functions: (target, batch) -> new target.

Plain files have no MERGE or UPDATE. The callers write the result as a new
table version or over the touched partitions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.operators.joins import not_in


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Append batch rows with unseen keys; a conflicting row is ignored."""
    return target.unionByName(not_in(batch, target, keys).select(*target.columns))


def new_keys_only(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Just the rows ``insert_if_absent`` would append."""
    return not_in(batch, target, keys)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    overwrite: list[str],
    keep: list[str] = (),
    computed: dict[str, str] | None = None,
    apply_when: str | None = None,
    insert_when: str | None = None,
) -> DataFrame:
    """Insert or update by key in one join, with a policy per column.

    ``overwrite``: taken from the batch on a match, nulls included.
    ``keep``: the target's value survives a match; a new row takes the batch's.
    ``computed``: an expression over target (``t.``) and batch (``b.``) columns,
    used for every row the batch touches.
    ``apply_when``: a match that fails it keeps its ``overwrite`` columns.
    ``insert_when``: an unmatched batch row that fails it is not inserted.
    The batch must hold each key once. Conditions are SQL texts and count as
    false when null.
    """
    computed = computed or {}
    t = target.selectExpr("*", "true AS _known").alias("t")
    b = batch.selectExpr("*", "true AS _sent").alias("b")
    on = F.expr(" AND ".join(f"t.{k} = b.{k}" for k in keys))
    is_new, sent = "t._known IS NULL", "b._sent IS NOT NULL"
    applies = sent if apply_when is None else f"{sent} AND ({is_new} OR coalesce({apply_when}, false))"

    def merged(name: str) -> str:
        if name in keys:
            return f"coalesce(t.{name}, b.{name})"
        if name in computed:
            return f"CASE WHEN {sent} THEN {computed[name]} ELSE t.{name} END"
        if name in overwrite:
            return f"CASE WHEN {applies} THEN b.{name} ELSE t.{name} END"
        if name in keep:
            return f"CASE WHEN {is_new} THEN b.{name} ELSE t.{name} END"
        raise ValueError(f"no merge policy for column {name}")

    joined = t.join(b, on, "full_outer")
    if insert_when is not None:
        joined = joined.where(f"NOT ({is_new}) OR coalesce({insert_when}, false)")
    return joined.selectExpr(
        *[f"CAST({merged(f.name)} AS {f.dataType.simpleString()}) AS {f.name}" for f in target.schema.fields]
    )


def update_join(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set columns from matching update rows; every other row is unchanged."""
    u = updates.selectExpr(*keys, *[f"{c} AS _new_{c}" for c in columns], "true AS _hit")
    return target.join(u, keys, "left").selectExpr(*[
        f"CASE WHEN _hit THEN _new_{c} ELSE {c} END AS {c}" if c in columns else c for c in target.columns
    ])


def delete_keys(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove the rows whose key is listed."""
    return target.join(keys, keys.columns, "left_anti")
