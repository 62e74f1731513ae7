"""Declared keys and references, checked as queries; and the load report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.schemas import KEYS, REFERENCES


def audit_keys(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1"))


def orphans(child: DataFrame, parent: DataFrame, fk: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Child rows whose reference is set but not found; ``fk`` maps child to parent columns."""
    pairs = fk if isinstance(fk, Mapping) else {c: c for c in fk}
    keys = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in pairs.items()]).distinct()
    match = [F.col(c) == F.col(f"_p_{c}") for c in pairs]
    set_ = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pairs])
    return child.filter(set_).join(keys, match, "left_anti")


def audit_entities(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = KEYS,
                   references: Mapping[str, Sequence[tuple]] = REFERENCES) -> DataFrame:
    """``(entity, check, columns, parent, n)``: how often each declared key or reference is broken.

    For a key ``n`` counts values that occur more than once, for a reference rows whose parent is not
    there. Declarations of tables that are not given, or whose parent is not, are left out.
    """
    def counted(found: DataFrame, entity: str, check: str, columns: Sequence[str], parent: str | None) -> DataFrame:
        return found.agg(F.lit(entity).alias("entity"), F.lit(check).alias("check"), F.lit(",".join(columns)).alias("columns"),
                         F.lit(parent).cast("string").alias("parent"), F.count(F.lit(1)).alias("n"))

    parts = [counted(audit_keys(tables[name], pk), name, "key", pk, None) for name, pk in keys.items() if name in tables]
    parts += [counted(orphans(tables[name], tables[parent], dict(zip(own, theirs))), name, "reference", own, parent)
              for name, declared in references.items() if name in tables
              for own, parent, theirs in declared if parent in tables]
    if not parts:
        raise ValueError("no declared key or reference among these tables")
    return reduce(DataFrame.unionByName, parts)


def load_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Entity, status, number of records, first and last date, one row per loaded table."""
    parts = [df.agg(F.lit(name).alias("entity"),
                    F.when(F.count(F.lit(1)) > 0, "loaded").otherwise("empty").alias("status"),
                    F.count(F.lit(1)).alias("records"),
                    F.min(F.to_date(date)).alias("first_date"),
                    F.max(F.to_date(date)).alias("last_date"))
             for name, (df, date) in tables.items()]
    return reduce(DataFrame.unionByName, parts)
