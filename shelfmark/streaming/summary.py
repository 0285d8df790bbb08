"""Overall progress of runs, kept by a stream: counts of each run are state, which a restart goes on with."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfmark.plans.report import OUTCOMES, verdict_of

#: RocksDB keeps the state; transformWithState needs it.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
COUNTS = "run_key string, ok_pages long, failed_pages long, cards long, expected_records int"


class _Counts(StatefulProcessor):
    """Pages of a run, its cards, and the records that its earliest page says there are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counts", "ok long, failed long, cards long, expected int, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        ok, failed, cards, expected, seq = self.state.get() if self.state.exists() else (0, 0, 0, 0, None)
        for part in rows:
            good = part[part["error"].isna()]
            ok, failed, cards = ok + len(good), failed + len(part) - len(good), cards + int(good["n_cards"].sum())
            said = good[good["total_records"] > 0]
            if len(said):
                first = said.loc[said["arrival_seq"].idxmin()]
                if seq is None or first["arrival_seq"] < seq:
                    expected, seq = int(first["total_records"]), int(first["arrival_seq"])
        self.state.update((ok, failed, cards, expected, seq))
        yield pd.DataFrame({"run_key": [key[0]], "ok_pages": [ok], "failed_pages": [failed], "cards": [cards], "expected_records": [expected]})

    def close(self) -> None:
        pass


def running_counts(outcomes: DataFrame) -> DataFrame:
    """COUNTS of each run that a batch has pages of, over all batches so far. outcomes: a stream of run_key and OUTCOMES."""
    columns = [x.split()[0] for x in OUTCOMES.split(", ")]
    return outcomes.select("run_key", *columns).groupBy("run_key").transformWithStateInPandas(statefulProcessor=_Counts(), outputStructType=COUNTS, outputMode="Update", timeMode="None")


def summaries(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """COUNTS with overall_pages, percent and verdict, as run_summary() has them. targets: run_key and target (pages of the run)."""
    rows = counts.join(targets.select("run_key", "target"), "run_key", "left")
    percent = F.round(F.col("ok_pages") * 100.0 / F.nullif(F.col("target"), F.lit(0)), 1)
    return rows.select("run_key", "ok_pages", "failed_pages", "cards", "expected_records", F.col("ok_pages").alias("overall_pages"), percent.alias("percent"), verdict_of(F.col("ok_pages") == F.col("target")).alias("verdict"))
