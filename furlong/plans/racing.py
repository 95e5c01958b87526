"""Racing Silver and Gold models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.functions.predicates import not_scratched
from furlong.operators.joins import repeat_rows

RACE_KEY = ["track", "race_number", "race_date"]
GOLD_RACE = ("track", "race_number", "race_date", "race_name", "distance_m", "track_condition")
GOLD_RUNNER = ("horse_name", "jockey", "trainer", "barrier", "weight_kg", "overall_win_pct")


def races(silver_runners: DataFrame) -> DataFrame:
    """Race columns, one row per runner: the source is not reduced to one row per race."""
    return silver_runners.select(
        "track", "race_number", "race_date", "race_name", "distance_m", "race_class", "track_condition"
    )


def runners(silver_runners: DataFrame) -> DataFrame:
    """Runner columns of the runners that were not scratched."""
    return silver_runners.where(not_scratched(F.col("scratched"))).select(
        "race_date", "track", "race_number", "horse_name", "jockey", "trainer", "barrier",
        "weight_kg", "overall_starts", "overall_wins", "overall_win_pct",
    )


def race_runners_counted(races: DataFrame, runners: DataFrame) -> DataFrame:
    """The races x runners join with equal race rows folded into ``copies``.

    Equal race rows are counted before the shuffle, so the race side has about one row per
    race and the join works on runners only. A race with a huge field is a hot key of the
    runner side, which the adaptive planner splits.
    """
    folded = races.groupBy(*GOLD_RACE).agg(F.count(F.lit(1)).alias("copies"))
    return folded.join(runners, RACE_KEY).select(*GOLD_RACE, *GOLD_RUNNER, "copies")


def race_runners(races: DataFrame, runners: DataFrame) -> DataFrame:
    """Races joined to runners on track, race number and date.

    A race with N race rows and M runners gives N x M rows, as an inner join does. The rows are
    matched once and repeated afterwards, in the task that holds the match, so the pairs never
    travel.
    """
    return repeat_rows(race_runners_counted(races, runners), "copies")
