"""Model configurations: the grid, and which of them make sense."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Config(NamedTuple):
    """Orders (p, d, q) and seasonal orders (sp, sd, sq) at period m, and trend n, c, t or ct."""

    p: int = 1
    d: int = 0
    q: int = 0
    sp: int = 0
    sd: int = 0
    sq: int = 0
    m: int = 0
    trend: str = "n"

    @property
    def valid(self) -> bool:
        seasonal = self.sp + self.sd + self.sq > 0
        return self.d + self.sd <= 2 and not (seasonal and self.m < 2)

    @property
    def ar_lags(self) -> list[int]:
        return _lags(self.p, self.sp, self.m)

    @property
    def ma_lags(self) -> list[int]:
        return _lags(self.q, self.sq, self.m)


@lru_cache(maxsize=None)
def _lags(order: int, seasonal: int, m: int) -> list[int]:
    return sorted({*range(1, order + 1), *(k * m for k in range(1, seasonal + 1))})


CONFIG_DDL = "p int, d int, q int, sp int, sd int, sq int, m int, trend string"


def configurations(p: Sequence[int], d: Sequence[int], q: Sequence[int], sp: Sequence[int],
                   sd: Sequence[int], sq: Sequence[int], m: Sequence[int],
                   trend: Sequence[str] = ("n",)) -> list[Config]:
    """Every combination of the lists, the first list slowest."""
    return [Config(*orders) for orders in product(p, d, q, sp, sd, sq, m, trend)]


def config_grid(spark: SparkSession, **lists: Sequence) -> DataFrame:
    """``configurations`` as a table with a ``cfg_id`` in loop order."""
    rows = [(i, *c) for i, c in enumerate(configurations(**lists))]
    return spark.createDataFrame(rows, f"cfg_id int, {CONFIG_DDL}")


def valid_configs(cfg: DataFrame) -> DataFrame:
    """Without configurations that difference more than twice or have seasons without a period."""
    seasonal = F.col("sp") + F.col("sd") + F.col("sq") > 0
    return cfg.filter((F.col("d") + F.col("sd") <= 2) & ~(seasonal & (F.col("m") < 2)))


def config_array(configs: Sequence[Config]) -> Column:
    """The configurations as one constant array of structs, ``cfg_id`` first."""
    text = json.dumps([{"cfg_id": i, **c._asdict()} for i, c in enumerate(configs)])
    return F.from_json(F.lit(text), f"array<struct<cfg_id int, {CONFIG_DDL}>>")


def cross(df: DataFrame, configs: Sequence[Config]) -> DataFrame:
    """Every row with every configuration, which travel along as a constant."""
    return df.select("*", F.inline(config_array(configs)))


def config_struct():
    """The stored form of a configuration, from its columns."""
    return F.struct(F.array("p", "d", "q").alias("arima_order"),
                    F.array("sp", "sd", "sq", "m").alias("seasonal_order"),
                    F.col("trend").alias("trend"))


def config_columns(cfg):
    """The columns of a configuration, from its stored form."""
    arima, seasonal = cfg["arima_order"], cfg["seasonal_order"]
    return [*[arima[i].alias(n) for i, n in enumerate(("p", "d", "q"))],
            *[seasonal[i].alias(n) for i, n in enumerate(("sp", "sd", "sq", "m"))],
            cfg["trend"].alias("trend")]
