"""The inspection report: sizes of all tables and the two headline questions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playstar.operators.quality import table_counts
from playstar.plans.analytics import plays_by_am_pm, top_song_by_daytype


def report(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each answer as a frame; a failing query raises instead of looking empty."""
    return {
        "table_counts": table_counts(tables),
        "plays_by_am_pm": plays_by_am_pm(tables["fact_songplay"], tables["dim_time"]),
        "top_song_by_daytype": top_song_by_daytype(
            tables["fact_songplay"], tables["dim_artist"], tables["dim_song"], tables["dim_date"]
        ),
    }


def print_report(tables: dict[str, DataFrame], ready: dict[str, DataFrame] | None = None) -> None:
    """Print all answers; those that are ``ready`` take the place of answers from the tables."""
    for title, answer in (report(tables) | (ready or {})).items():
        print(title)
        answer.show(truncate=False)
