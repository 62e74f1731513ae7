"""Find, update, delete and bulk changes, each as the table that results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.operators.filters import predicate
from dayline.operators.joins import newest_per_key


def _condition(where) -> Column:
    if where is None:
        return F.lit(True)
    cond = where if isinstance(where, Column) else predicate(where)
    return F.coalesce(cond, F.lit(False))


def find(df: DataFrame, where=None, select: Sequence[str] | None = None,
         order_by: Sequence[tuple[str, int]] | tuple[str, int] | None = None,
         limit: int | None = None) -> DataFrame:
    """Filter, project, sort by (column, 1 or -1) pairs, and limit if told to."""
    out = df if where is None else df.filter(_condition(where))
    if order_by is not None:
        pairs = [order_by] if isinstance(order_by, tuple) else list(order_by)
        out = out.orderBy(*[F.col(c).desc() if d < 0 else F.col(c).asc() for c, d in pairs])
    if limit is not None:
        out = out.limit(limit)
    return out.select(*select) if select else out


def _only_first(df: DataFrame, cond: Column, order_by: Sequence[str]) -> Column:
    """Narrows a condition to the matching row with the smallest ``order_by`` (a unique key)."""
    if not order_by:
        raise ValueError("only_one needs order_by, a unique key that says which row is first")
    first = df.filter(cond).agg(F.min(F.struct(*order_by)).alias("k")).select("k").scalar()
    return cond & F.coalesce(F.struct(*order_by) == first, F.lit(False))


def update_where(df: DataFrame, where, values: Mapping[str, object], only_one: bool = False,
                 order_by: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``values`` (constants or columns) set on matching rows."""
    cond = _condition(where)
    if only_one:
        cond = _only_first(df, cond, order_by)
    types = dict(df.dtypes)
    return df.withColumns({
        c: F.when(cond, (v if isinstance(v, Column) else F.lit(v)).cast(types[c]))
        .otherwise(F.col(c)) for c, v in values.items()})


def modified_count(df: DataFrame, where, values: Mapping[str, object], only_one: bool = False,
                   order_by: Sequence[str] = ()) -> DataFrame:
    """How many rows ``update_where`` would change to something different."""
    cond = _condition(where)
    if only_one:
        cond = _only_first(df, cond, order_by)
    types, changed = dict(df.dtypes), F.lit(False)
    for c, v in values.items():
        new = (v if isinstance(v, Column) else F.lit(v)).cast(types[c])
        changed = changed | ~F.col(c).eqNullSafe(new)
    return df.agg(F.count_if(cond).alias("matched"), F.count_if(cond & changed).alias("modified"))


def delete_where(df: DataFrame, where=None, only_one: bool = False, delete_all: bool = False,
                 order_by: Sequence[str] = ()) -> DataFrame:
    """``df`` without matching rows; rows where the condition is NULL stay.

    An empty condition is refused unless ``delete_all`` says so, and the other way round.
    """
    empty = where is None or (isinstance(where, Mapping) and not where)
    if not only_one and empty != delete_all:
        raise ValueError("an empty condition and delete_all go together")
    cond = _condition(where)
    if only_one:
        cond = _only_first(df, cond, order_by)
    return df.filter(~cond)


def _last_changes(changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return newest_per_key(changes, keys, seq)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = "seq",
                  op: str = "op") -> DataFrame:
    """``target`` after ``upsert``/``insert``/``update``/``delete`` changes.

    The last change of a key (by ``seq``) counts. Inserts and upserts carry whole rows and land
    on a key whether or not it is stored; an update or delete of an unknown key does nothing.
    """
    last = _last_changes(changes, keys, seq)
    # the changes are the side that is broadcast if small; the target keeps its place
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    landed = last.filter(~F.col(op).isin("delete", "update")).select(target.columns)
    updates = last.filter(F.col(op) == "update")
    known = target.join(updates.select(*keys), list(keys), "left_semi").select(*keys)
    return kept.unionByName(landed).unionByName(
        updates.join(known, list(keys), "left_semi").select(target.columns))


def change_counts(target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = "seq",
                  op: str = "op") -> DataFrame:
    """What ``apply_changes`` does: rows matched, inserted, modified, upserted and deleted."""
    values = [c for c in target.columns if c not in keys]
    last = _last_changes(changes, keys, seq).select(
        *keys, F.col(op).alias("_op"), F.struct(*values).alias("_new"))
    old = target.join(last.select(*keys), list(keys), "left_semi") \
        .select(*keys, F.struct(*values).alias("_old"))
    both = last.join(old, list(keys), "left")
    stored = F.col("_old").isNotNull()
    writes = F.col("_op").isin("update", "upsert", "insert")
    return both.agg(
        F.count_if(stored & writes).alias("matched"),
        F.count_if(~stored & (F.col("_op") == "insert")).alias("inserted"),
        F.count_if(stored & writes & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("modified"),
        F.count_if(~stored & (F.col("_op") == "upsert")).alias("upserted"),
        F.count_if(stored & (F.col("_op") == "delete")).alias("deleted"))


def count_where(df: DataFrame, where=None) -> DataFrame:
    out = df if where is None else df.filter(_condition(where))
    return out.agg(F.count(F.lit(1)).alias("n"))
