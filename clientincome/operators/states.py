"""Monthly states: what a month adds to the features, computed once and kept.

The features of a run read six months of history, of which five were read by
the run before.  A state table keeps, for each month and client, what the
features need of that month:

* deposits: the client's sums of the month (``deposits.client_months``),
* transfers and currency: the distinct history rows of the month with their
  number of copies (``services.history_counted``).

A run adds the months of its window that are not there yet, normally the new
one alone, and merges the window's states: totals and active months add up,
recencies take the minimum, trimmed totals walk the few monthly amounts.  The
month that leaves is not read.  A month is written by overwriting its own
partition, so a run that failed can be run again.

Layout: partitioned by month, so a window reads its folders only; bucketed and
sorted by client, so joins and groups by client need no exchange of a state.
States hold a few rows for each client and month, never a client's raw rows,
so a client with a third of all history rows weighs no more than any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientincome.functions.periods import months_of, recency
from clientincome.operators import deposits, services
from clientincome.semantics import REFERENCE, RunParams, Semantics
from clientincome.sources.fixtures import Inputs

MONTH, CLIENT = "num_periodo_mes", "id_master"


def deposit_state(account_hist: DataFrame, month: int, sem: Semantics = REFERENCE) -> DataFrame:
    """(id_master, num_periodo_mes, measures): the client sums of ``month``."""
    of_month = RunParams(month, 1)
    rows = deposits.account_months(account_hist.where((F.col(MONTH) == month) & (F.col(CLIENT) > 0)), of_month, sem)
    return deposits.client_months(rows, sem).select(CLIENT, MONTH, *deposits.MEASURES)


def service_state(hist: DataFrame, month: int, values: tuple[str, ...]) -> DataFrame:
    """(id_master, num_periodo_mes, values, w): the distinct history rows of ``month``."""
    return services.history_counted(hist.where(F.col(MONTH) == month), RunParams(month, 1), values)


class StateTable:
    """The states of one family under ``folder``, a table of the session's catalog."""

    def __init__(self, spark: SparkSession, folder: str, family: str, buckets: int):
        self.spark, self.folder, self.buckets = spark, f"{folder.rstrip('/')}/{family}", buckets
        self.name = f"state_{family}_{zlib.crc32(self.folder.encode()):08x}"

    def _create(self, state: DataFrame) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields)
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING PARQUET PARTITIONED BY ({MONTH}) "
            f"CLUSTERED BY ({CLIENT}) SORTED BY ({CLIENT}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
        )
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")  # months that an earlier session wrote

    def months(self) -> set[int]:
        return {int(r["partition"].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def add(self, months: list[int], state_of: Callable[[int], DataFrame]) -> list[int]:
        """Write the states of those ``months`` that are missing; returns them."""
        self._create(state_of(months[0]))
        new = sorted(set(months) - self.months())
        for month in new:
            # each bucket in one task: a file for each bucket of a month
            state = state_of(month).drop(MONTH).repartition(self.buckets, CLIENT)
            view = f"{self.name}_{month}"
            state.createOrReplaceTempView(view)
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({MONTH} = {month}) SELECT * FROM {view}")
            self.spark.catalog.dropTempView(view)
        return new

    def window(self, params: RunParams) -> DataFrame:
        return self.spark.table(self.name).where(F.col(MONTH).between(params.start, params.mes))


class States:
    """The states of the three families under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, sem: Semantics = REFERENCE):
        """``buckets``: fixed once a state is written; by default the session's shuffle partitions.  With fewer than
        those, Spark shuffles the states to the other side's partitions."""
        self.sem = sem
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.deposits, self.transfers, self.fx = (StateTable(spark, folder, f, buckets) for f in ("deposits", "transfers", "fx"))

    def roll(self, i: Inputs, params: RunParams) -> dict[str, list[int]]:
        """Add the months that the window of ``params`` lacks; returns the months added to each family."""
        months = months_of(params.start, params.mes)
        return {
            "deposits": self.deposits.add(months, lambda m: deposit_state(i.account_hist, m, self.sem)),
            "transfers": self.transfers.add(months, lambda m: service_state(i.transfer_hist, m, services.TRANSFER_VALUES)),
            "fx": self.fx.add(months, lambda m: service_state(i.fx_hist, m, services.FX_VALUES)),
        }

    def deposit_features(self, population: DataFrame, params: RunParams) -> DataFrame:
        months = self.deposits.window(params).withColumn("per_ref", F.lit(params.mes))
        months = months.withColumn("diff_mes", recency(F.lit(params.mes), F.col(MONTH)))
        return deposits.client_features(population, months, params, self.sem)

    def transfer_features(self, population: DataFrame, calendar: DataFrame, params: RunParams) -> DataFrame:
        return services.transfer_features(population, calendar, self.transfers.window(params), params, self.sem)

    def fx_features(self, population: DataFrame, calendar: DataFrame, params: RunParams) -> DataFrame:
        return services.fx_features(population, calendar, self.fx.window(params), params, self.sem)
