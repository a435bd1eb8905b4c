"""Column groups, thresholds and hyper-parameters of the football schema.

Operators never hard-code these; pipelines pass them in, so the same operators run on
any table.  Fixed values are listed in the reference's order.
"""

from __future__ import annotations

from dataclasses import dataclass

from .operators.lineup import slot_id_columns, slot_score_columns

PLAYER_ID_COLS = slot_id_columns()
PLAYER_SCORE_COLS = slot_score_columns()

# Odds columns.
BET_COLS = ["BW1", "BWN", "BW2", "BOver1_5goals", "BUnder1_5goals", "BOver2_5goals", "BUnder2_5goals",
            "BOver3_5goals", "BUnder3_5goals", "BLDEM_YES", "BLDEM_NO"]
# Provider probability columns (may hold text).
PROBA_COLS = ["W1", "W2", "WN", "LDEM_YES", "Over0_5goals", "Over1_5goals", "Over2_5goals", "Over3_5goals",
              "Over4_5goals"]
# Season sums normalised per round, and the difference columns built from them.
PER_ROUND_COLS = ["HTGS", "HTGC", "HTP", "ATGS", "ATGC", "ATP"]
# The name columns that are label-encoded.
NAME_COLS = ["region_name", "country_name", "league_name", "homeTeam", "awayTeam"]
# Raw columns dropped at once, and columns hidden from the prepared table.
DROPPED_RAW_COLS = ["homeUpdated", "awayUpdated", "statusShort", "status"]
HIDDEN_COLS = ["event_date", "totgoal", "goalDiff", "goalsHomeTeam", "goalsAwayTeam", "FTHG", "FTAG",
               "pred_match_winner", "country_code"]


@dataclass(frozen=True)
class FixturePreset:
    """The differing choices of the fixture-preparation variants."""
    name: str
    season_gt: int
    round_ge: int
    check_over05: bool
    required_slots: tuple
    halftime: str               # "lookup" (JN1) or "group_mean" (AG1)
    numeric_cols: tuple
    int_cols: tuple
    idnull_before_filters: bool
    exact_goal_labels: bool
    keep_ftr_totgoal: bool
    drop_ids: bool
    shuffle: bool


_G_BOTH = ("HTPlayerG", "ATPlayerG")
_GDMF_BOTH = ("HTPlayerG", "HTPlayerD1", "HTPlayerM1", "HTPlayerF1", "ATPlayerG", "ATPlayerD1", "ATPlayerM1", "ATPlayerF1")

PRESETS = {
    "base": FixturePreset("base", 2015, 2, True, _GDMF_BOTH, "group_mean", ("W1", "W2"), ("HTF", "ATF", "round"),
                          False, False, False, False, True),
    "vocab": FixturePreset("vocab", 2015, 2, True, _G_BOTH, "lookup", ("W1", "W2"), ("round",),
                           False, True, False, False, True),
    "stack": FixturePreset("stack", 2015, 3, False, _G_BOTH, "lookup", ("W1", "W2"), ("HTF", "ATF", "round"),
                           False, True, True, False, False),
    # v5 repeats the home ids in its id list; here both sides are used.
    "v5": FixturePreset("v5", 2016, 2, False, ("HTPlayerG",), "lookup", tuple(PROBA_COLS), ("HTF", "ATF", "round"),
                        True, True, False, True, True),
}


# Limits and column groups of the player preparation.
@dataclass(frozen=True)
class PlayerPreset:
    train_until: str = "2020-12-01"
    round_gt: int = 2
    season_ge: int = 2018
    excluded_next: tuple = (3.5, 3.7)
    numeric_cols: tuple = ("LastTrend", "CumulTrend", "NextRating", "age", "height", "weight")
    dropped: tuple = ("event_date", "H2Hid", "fixture_id", "country_code", "team2_id", "Nextteam2Id")
    text_unknown: tuple = ("position", "birth_country")
    encoded: tuple = ("team1", "team2", "Nextteam2", "position", "birth_country")
    zero_fill: tuple = ("avg", "avg2", "std2", "varSTD", "varSTDdiff", "varSTDratio", "Nextfixture_id", "rating",
                        "PrevRating2", "teamPointsTo", "teamPointsFrom", "teamPoints", "age", "height", "weight",
                        "team1Gavg", "team1Mavg", "team1Favg", "team1Davg", "team2Gavg", "team2Mavg", "team2Favg",
                        "team2Davg", "Nextteam2Gavg", "Nextteam2Mavg", "Nextteam2Favg", "Nextteam2Davg",
                        "LH2HFTR", "LH2Hteam1Mavg", "LH2Hteam1Gavg", "LH2Hteam1Favg", "LH2Hteam1Davg",
                        "LH2Hteam2Mavg", "LH2Hteam2Gavg", "LH2Hteam2Favg", "LH2Hteam2Davg", "LH2Hrating",
                        "AvgH2Hteam1Mavg", "AvgH2Hteam1Gavg", "AvgH2Hteam1Favg", "AvgH2Hteam1Davg",
                        "AvgH2Hteam2Mavg", "AvgH2Hteam2Gavg", "AvgH2Hteam2Favg", "AvgH2Hteam2Davg", "AvgH2Hrating")
    minus_fill: tuple = ("OverAvg", "OverAvg2", "LastTrend", "varSTDSign")
    siblings: tuple = (("PrevRating", "rating"), ("PrevRating2", "PrevRating"), ("LH2Hrating", "PrevRating"),
                       ("CumulTrend", "LastTrend"))
    int_cols: tuple = ("varSTDSign", "OverAvg", "OverAvg2", "LastTrend", "CumulTrend", "Nextfixture_id",
                       "teamPointsTo", "teamPointsFrom", "teamPoints", "age", "height", "weight")
    nonzero: tuple = ("PrevRating", "rating")


# Level-0 and level-1 model hyper-parameters, the defaults of stacks and boosted trees.
RF_LEVEL0 = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 3}
RF_LEVEL1 = {"numTrees": 150, "maxDepth": 12, "minInstancesPerNode": 1}
GBT_LEVEL0 = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
MAX_TREE_DEPTH = 30

# Perceptron layouts by name: hidden widths (input and output sizes are added at fit time).
# Dropout, normalisation and penalties that a name speaks of have no counterpart in Spark ML.
MLP_LAYOUTS = {
    "small": [64, 32, 16, 8],
    "medium": [256, 128, 64, 32, 16, 8],
    "medium_wide": [256, 128, 64, 32, 16],
    "large": [256, 128, 32],
    "wide5x200": [200] * 5,
    "deep3": [256] * 3, "deep4": [256] * 4, "deep5": [256] * 5, "deep6": [256] * 6, "deep7": [256] * 7,
    # The 22 named networks, in the reference's order.
    "model_small": [64, 32, 16, 8], "model_medium": [256, 128, 64, 32, 16, 8], "model_large": [256] * 5, "model_vlarge": [256] * 7,
    "model_small_drop": [64, 32, 16, 8], "model_medium_drop": [256, 256, 128, 64, 32, 16], "model_mlarge_drop": [200] * 5, "model_large_drop": [256] * 5,
    "model_vsmall_L2Regul": [256, 128, 32], "model_small_L2Regul": [256] * 3, "model_large_L2Regul": [256] * 5, "model_vlarge_L2Regul": [256] * 6,
    "model_medium_L1Regul": [256] * 4, "model_large_L1Regul": [256] * 5,
    "model_medium_BatchNormalization": [256, 128, 64, 32, 16, 8], "model_large_BatchNormalization": [256] * 5,
    "model_large_layer1_BatchNormalization": [256] * 5, "model_large_Droupout_BatchNormalization": [256] * 5,
    "model_large_L2Regul_BatchNormalization": [256] * 5, "model_large_L2Regul_drop_BatchNormalization": [256] * 5,
    "model_vlarge_L2Regul_BatchNormalization": [256] * 6,
    "model_large_L1L2Regul_BatchNormalization": [256] * 5,
}

# Per-label forest hyper-parameters as (min_samples_leaf, max_features,
# max_depth), in the reference's order.  Depths above Spark's limit are clipped when used.
FOREST_BY_LABEL = {
    "FTR": (3, 16, 31), "LDEM": (2, 15, 13), "Team1Win": (3, 23, 15), "NotTeam1Win": (1, 33, 10),
    "Team2Win": (1, 25, 8), "NotTeam2Win": (1, 19, 34), "TeamNWin": (1, 10, 26), "NotTeamNWin": (3, 11, 14),
    "Ov05": (1, 6, 35), "Ov15": (2, 23, 11), "Ov25": (3, 8, 32), "Ov35": (2, 4, 15), "Ov45": (1, 3, 18),
    "totgoal0": (1, 16, 34), "totgoal1": (1, 24, 21), "totgoal2": (2, 32, 32), "totgoal3": (9, 23, 28),
    "totgoal4": (3, 14, 17), "totgoal5": (1, 35, 10),
}


def forest_params(label: str, n_features: int | None = None, num_trees: int = 100) -> dict:
    """ML4: Spark ML parameters of a label's forest preset (leaf size → minInstancesPerNode,
    max_features → featureSubsetStrategy, depth → maxDepth, clipped later to 30)."""
    leaf, feats, depth = FOREST_BY_LABEL[label]
    feats = min(feats, n_features) if n_features else feats
    return {"numTrees": num_trees, "minInstancesPerNode": leaf, "featureSubsetStrategy": str(feats),
            "maxDepth": depth}
