"""Target derivation (TG1–TG11) as column expressions.

Every target is a CASE over NULL-clean inputs; a missing input gives the value the
reference's row function returns when all its comparisons are false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bands import band_half, band_unit
from .missing import col_, to_double

# Distance thresholds and their target-name suffixes, in output order.
DISTANCE_THRESHOLDS = (("15", 1.5), ("10", 1.0), ("07", 0.7), ("05", 0.5), ("03", 0.3), ("02", 0.2))
OVER_GOAL_LINES = (("Ov05", 0), ("Ov15", 1), ("Ov25", 2), ("Ov35", 3), ("Ov45", 4))
EXACT_GOALS = tuple(range(6))


def _d(c) -> Column:
    return to_double(c)


def flag(cond: Column) -> Column:
    """0/1 INT flag; NULL condition → 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def match_result(goal_diff) -> Column:
    """TG1 FTR: 1 home win, 2 away win, 0 draw, −1 missing."""
    g = _d(goal_diff)
    return F.when(g > 0, F.lit(1)).when(g < 0, F.lit(2)).when(g == 0, F.lit(0)).otherwise(F.lit(-1))


def result_flags(ftr) -> dict[str, Column]:
    """TG2: win flags and their negations (negations include FTR = −1)."""
    r = col_(ftr)
    return {
        "Team1Win": flag(r == 1), "NotTeam1Win": flag(r != 1),
        "Team2Win": flag(r == 2), "NotTeam2Win": flag(r != 2),
        "TeamNWin": flag(r == 0), "NotTeamNWin": flag(r != 0),
    }


def double_chance(ftr) -> dict[str, Column]:
    """TG3: Team1N = home win or draw, Team2N = away win or draw."""
    r = col_(ftr)
    return {"Team1N": flag(r.isin(1, 0)), "Team2N": flag(r.isin(2, 0))}


def over_goals(total) -> dict[str, Column]:
    """TG4: Ov05 … Ov45 = total > 0 … 4; missing → 0."""
    t = _d(total)
    return {name: flag(t > k) for name, k in OVER_GOAL_LINES}


def exact_goals(total, prefix: str = "totgoal") -> dict[str, Column]:
    """TG5: totgoal0 … totgoal5 = total == k."""
    t = _d(total)
    return {f"{prefix}{k}": flag(t == k) for k in EXACT_GOALS}


def both_score(home, away) -> Column:
    """TG6 LDEM: both sides scored; missing → 0."""
    return flag((_d(home) > 0) & (_d(away) > 0))


def trend(nxt, cur) -> Column:
    """TG7: sign of next − current as −1/0/1; missing → 0."""
    d = _d(nxt) - _d(cur)
    return F.when(d > 0, F.lit(1)).when(d < 0, F.lit(-1)).otherwise(F.lit(0))


def at_or_above(a, b) -> Column:
    """TG8: 1 when a − b >= 0; missing → 0."""
    return flag((_d(a) - _d(b)) >= 0)


def distance_flags(a, b, prefix: str, thresholds=DISTANCE_THRESHOLDS) -> dict[str, Column]:
    """TG9 / TG10: abs(a − b) >= d for every threshold."""
    diff = F.abs(_d(a) - _d(b))
    return {f"{prefix}{suffix}": flag(diff >= d) for suffix, d in thresholds}


def player_targets(df: DataFrame, rating="rating", prev="PrevRating", prev2="PrevRating2",
                   avg="avg", avg2="avg2", nxt="NextRating", reference_compat: bool = True) -> DataFrame:
    """TG11: the full player target set in one projection.

    ``reference_compat=True`` computes ``NextRatingDiffOv07`` with the 0.2 rule, as the
    reference does; ``False`` uses 0.7.
    """
    bands = {
        "RatingRange": band_half(rating), "PrevRatingRange": band_half(prev),
        "PrevRating2Range": band_half(prev2), "avgRange": band_half(avg),
        "avg2Range": band_half(avg2), "NextRatingRange": band_unit(nxt),
    }
    out = df.withColumns(bands)
    targets = {
        "NextTrend": trend(nxt, rating),
        "NextTrendRng": trend("NextRatingRange", "RatingRange"),
        "NextOvAvg": at_or_above(nxt, avg),
        "NextRngOvAvg": at_or_above("NextRatingRange", avg),
        "NextRngOvAvgRng": at_or_above("NextRatingRange", "avgRange"),
        "NextOvAvgRng": at_or_above(nxt, "avgRange"),
    }
    diffs = distance_flags(nxt, rating, "NextRatingDiffOv")
    if reference_compat:
        diffs["NextRatingDiffOv07"] = flag(F.abs(_d(nxt) - _d(rating)) >= 0.2)
    targets.update(diffs)
    targets.update(distance_flags(nxt, avg, "NextRatingDiffAvgOv"))
    return out.withColumns(targets)


PLAYER_TARGETS = (
    ["RatingRange", "PrevRatingRange", "PrevRating2Range", "avgRange", "avg2Range", "NextRatingRange",
     "NextTrend", "NextTrendRng", "NextOvAvg", "NextRngOvAvg", "NextRngOvAvgRng", "NextOvAvgRng"]
    + [f"NextRatingDiffOv{s}" for s, _ in DISTANCE_THRESHOLDS]
    + [f"NextRatingDiffAvgOv{s}" for s, _ in DISTANCE_THRESHOLDS]
)


def fixture_targets(df: DataFrame, home="goalsHomeTeam", away="goalsAwayTeam",
                    exact: bool = True) -> DataFrame:
    """PJ5 + TG1–TG6: totals, differences, FTR and every fixture label in one projection."""
    out = df.withColumns({
        "totgoal": _d(home) + _d(away), "goalDiff": _d(home) - _d(away),
        "FTHG": _d(home), "FTAG": _d(away),
    })
    out = out.withColumn("FTR", match_result("goalDiff"))
    cols = {}
    if exact:
        cols.update(exact_goals("totgoal"))
    cols.update(result_flags("FTR"))
    cols.update(double_chance("FTR"))
    cols.update(over_goals("totgoal"))
    cols["LDEM"] = both_score("FTHG", "FTAG")
    return out.withColumns(cols)
