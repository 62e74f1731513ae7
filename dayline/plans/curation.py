"""The curated table: one integrated row per region and day."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.functions.columns import AGE_BANDS, RISK_ORDER, reband, row_sum
from dayline.operators.aggregates import pivot_sum
from dayline.operators.filters import gate_complete, scan_between
from dayline.operators.incremental import rows_after
from dayline.operators.joins import attach_lookup, cover_flag, left_join_all, written
from dayline.operators.projections import columns_like
from dayline.operators.windows import daily_change, latest_row, running_total, share_of
from dayline.schemas import conform
from dayline.sinks.loads import Latest, append_load, read_latest

KEYS = ["region"]
ON = ["region", "date"]

# The dose columns of the curated table.
_DOSES = {"first_dose": "new_first_doses", "second_dose": "new_second_doses"}
_NEW_DOSES = [f"{name}{suffix}" for name in _DOSES.values() for suffix in ("_ag0", "_ag1", "_ag2", "")]
_TOTALS = {c: c.removeprefix("new_") for c in _NEW_DOSES}

# the last row of each region: its date is the mark, its totals go on
SEED = Latest(KEYS, "date", [*_TOTALS.values(), "deaths"])


class Sources(NamedTuple):
    """Preprocessed tables, each with a ``region``, but for country-wide ones.

    ``stringency`` and ``holidays`` may come without it and then hold for every region.
    """

    status: DataFrame
    risk: DataFrame
    stringency: DataFrame
    vaccines: DataFrame
    holidays: DataFrame
    population: DataFrame


def _keyed(df: DataFrame) -> list[str]:
    return [c for c in KEYS if c in df.columns]


def dose_table(vaccines: DataFrame) -> DataFrame:
    """Doses per region and day by age band, with totals over the bands."""
    banded = vaccines.select(*ON, reband("age_group").alias("band"), *_DOSES)
    return pivot_sum(banded, ON, "band", [b.label for b in sorted(AGE_BANDS)], _DOSES,
                     name="{col}_ag{value}")


def curate(sources: Sources, curated: DataFrame | None = None, lo=None, hi=None,
           seed: DataFrame | None = None) -> DataFrame:
    """Rows to append to ``curated``: everything when it is None or empty, else newer days only.

    ``seed`` has the last curated row of each region; it is looked up in ``curated`` if not given.

    A region yields rows only if status, risk, stringency and vaccines all have new days.
    Appending increments gives the same table as one run over all days.
    """
    bounded = {name: scan_between(df, "date", lo, hi)
               for name, df in sources._asdict().items() if name not in ("holidays", "population")}
    if seed is None and curated is not None:
        seed = latest_row(curated.select(*ON, *SEED.cols), KEYS, "date")
    if seed is not None:
        for name in ("status", "risk", "vaccines"):
            bounded[name] = rows_after(bounded[name], seed, KEYS, "date", lo, measured=False)

    # doses are summed once, written small, and serve the gate as well
    doses = written(dose_table(bounded["vaccines"]), "doses")
    status = gate_complete(bounded["status"], [bounded["risk"], doses], KEYS)
    stringency = bounded["stringency"]
    if _keyed(stringency):
        if seed is not None:
            stringency = rows_after(stringency, seed, KEYS, "date", lo, measured=False)
        status = gate_complete(status, [stringency], KEYS)
    else:
        status = attach_lookup(status, stringency.agg(F.max("date").alias("_until")), [], ["_until"])
        if seed is not None:
            status = attach_lookup(status, seed.select("region", F.col("date").alias("_after")),
                                   KEYS, ["_after"])
        else:
            status = status.withColumn("_after", F.lit(None).cast("date"))
        status = status.filter(F.col("_until").isNotNull() & (
            F.col("_after").isNull() | (F.col("_until") > F.col("_after")))).drop("_until", "_after")

    # several values for one day become one, so that a day stays one row: the gravest colour
    # (one that is no known colour counts least) and the largest index
    grave = F.array_position(F.array(*[F.lit(c) for c in RISK_ORDER]), F.col("risk"))
    worst = F.max(F.when(F.col("risk").isNotNull(), F.struct(grave.alias("grave"), "risk")))
    risk = bounded["risk"].groupBy(*ON).agg(worst["risk"].alias("risk"))
    index = stringency.groupBy(*_keyed(stringency), "date").agg(
        F.max("value").alias("stringency_index"))
    joined = left_join_all(status, [risk, doses], ON)
    joined = joined.join(index, [*_keyed(stringency), "date"], "left")
    per = [*_keyed(sources.holidays), "date"]
    flagged = cover_flag(bounded["status"].select(*per).distinct(), sources.holidays, keys=per[:-1])
    joined = joined.join(flagged, per, "left")

    joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in _NEW_DOSES})
    joined = joined.withColumn("hospitalized", row_sum(columns_like(joined, "hospitalized")))
    out = running_total(joined, KEYS, "date", _TOTALS, seed)
    out = daily_change(out, KEYS, "date", {"deaths": "new_deaths"}, seed)
    out = attach_lookup(out, sources.population, KEYS, ["population"])
    out = share_of(out, {"first_doses": "vaccinated_population",
                         "second_doses": "fully_vaccinated_population"}, "population")
    return conform(out, "curated")


def run_curation(spark: SparkSession, sources: Sources, path: str, reprocess_all: bool = False,
                 lo=None, hi=None, partition_by: Sequence[str] = ()) -> int:
    """Load the new days into the stored curated table, or build it anew; returns rows written.

    Totals go on from the seeds that the last load has left; curated rows are not read again.
    :func:`dayline.sinks.loads.read_loads` reads the table.
    """
    if reprocess_all:
        return append_load(curate(sources, None, lo, hi), path, partition_by=partition_by, latest=SEED, replace=True)
    fresh = curate(sources, None, lo, hi, read_latest(spark, path, SEED))
    return append_load(fresh, path, partition_by=partition_by, latest=SEED)
