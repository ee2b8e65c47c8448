"""The lags of every store kept current as days arrive, in whatever order.

The state of a store is its newest days, as many as the longest lag needs. A day that arrives late
is put in its place, a day that arrives again replaces what was known of it, and a day older than
the oldest held is passed over, as it can change no lag. A query that runs on can drop the states of
stores that no day has reached for some time; it then runs batches without rows, on the clock, so a
run over what is there now keeps all states.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfcast.operators.timeseries import LAGS

FORGET_AFTER = 400 * 24 * 3600 * 1000  # milliseconds, for queries that run on
MEAN_OVER = 7
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "Store bigint, Date date, sales_lag_1 double, sales_lag_7 double, sales_lag_30 double, sales_roll_mean_7 double"


class NewestDays(StatefulProcessor):
    """Days and sales of one store, in order, and the lags of the last of them."""

    def __init__(self, held: int = max(LAGS) + 1, forget_after: int | None = None):
        self.held, self.forget_after = held, forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getValueState("days", "days array<int>, sales array<double>", self.forget_after)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.days.get()  # a call to the JVM; none if there is no state
        known = dict(zip(*held)) if held else {}
        for block in rows:
            days = block["Date"].to_numpy().astype("datetime64[D]")
            if np.isnat(days).any():
                raise ValueError("sales without a day")
            days = days.astype("int64")
            known.update(zip(days.tolist(), block["Sales"].astype("float64").tolist()))
            known = dict(sorted(known.items())[-self.held:])
        self.days.update((list(known), list(known.values())))
        yield latest_lags(key[0], known)

    def close(self) -> None:
        pass


def latest_lags(store: int, known: dict[int, float]) -> pd.DataFrame:
    """The lags of the last day; null where the store has too few days."""
    sales = list(known.values())
    row = {"Store": [store], "Date": [dt.date(1970, 1, 1) + dt.timedelta(days=max(known))]}
    row.update({f"sales_lag_{k}": [sales[-1 - k] if len(sales) > k else math.nan] for k in LAGS})
    row[f"sales_roll_mean_{MEAN_OVER}"] = [sum(sales[-MEAN_OVER:]) / MEAN_OVER if len(sales) >= MEAN_OVER else math.nan]
    return pd.DataFrame(row)


def current_lags(days: DataFrame, held: int = max(LAGS) + 1, forget_after: int | None = None) -> DataFrame:
    """A stream of (Store, Date, Sales) as a stream of every changed store's last lags. The session
    must keep state in RocksDB: see ``PROVIDER``."""
    return days.select("Store", "Date", "Sales").groupBy("Store").transformWithStateInPandas(
        NewestDays(held, forget_after), OUTPUT, "Update", "ProcessingTime" if forget_after else "None")
