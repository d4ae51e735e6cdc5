"""Identity of one run, stamped on every Gold row."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """Created once per run, so all tables of the run carry the same three values."""

    anchor_month: dt.date
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    generated_at: dt.datetime = field(default_factory=dt.datetime.now)

    def columns(self, window_anchor: bool = True) -> dict[str, Column]:
        cols = {
            "run_id": F.lit(self.run_id),
            "generated_at": F.lit(self.generated_at).cast("timestamp"),
        }
        if window_anchor:
            cols["date_max_window"] = F.lit(self.anchor_month).cast("timestamp")
        return cols

    def stamp(self, df: DataFrame, window_anchor: bool = True) -> DataFrame:
        return df.withColumns(self.columns(window_anchor))


def stamp_silver(df: DataFrame, source: str, processed_at: dt.datetime) -> DataFrame:
    """Silver's audit pair; the processing time is kept as text, as its consumers expect."""
    return df.withColumns(
        {
            "date_traitement": F.lit(processed_at.strftime("%Y-%m-%d %H:%M:%S")),
            "source_fichier": F.lit(source),
        }
    )


def stamp_raw_load(df: DataFrame, loaded_at: dt.datetime, user: str, reason: str) -> DataFrame:
    """Who loaded a raw table, when and why."""
    return df.withColumns(
        {
            "Sys_LoadDate": F.lit(loaded_at).cast("timestamp"),
            "Sys_LoadedBy": F.lit(user),
            "Sys_Reason": F.lit(reason),
        }
    )
