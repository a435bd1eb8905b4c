"""Fixture preparation (CL1), formatting with encoders (CL3) and the cleaning report.

One function with four presets replaces the reference's five near-copies.  The whole
preparation is one lazy plan of narrow projections and one filter; the only wide
operations are the half-time lookup (a broadcast join behind a size check, or a
group mean computed as aggregate-then-join) and, in CL3, the dictionary encoders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as pj
from ..functions import targets as tg
from ..functions.missing import fill_int, to_double
from ..operators import clean, joins, profile
from ..operators.encode import encode_columns, fit_dictionary
from ..operators.split import head_tail_split
from ..session import materialize
from ..presets import (DROPPED_RAW_COLS, HIDDEN_COLS, NAME_COLS, PER_ROUND_COLS, PRESETS,
                       FixturePreset)

LABELS_EXACT = [f"totgoal{k}" for k in range(6)]
LABEL_COLUMNS = (["FTR", "Team1Win", "NotTeam1Win", "Team2Win", "NotTeam2Win", "TeamNWin", "NotTeamNWin",
                  "Team1N", "Team2N", "Ov05", "Ov15", "Ov25", "Ov35", "Ov45", "LDEM"] + LABELS_EXACT)


def _slot_groups(score_cols):
    """Team-mean groups: ``<side>Player<D|M|F>Score`` → the side's slots of that line."""
    groups = {}
    for c in score_cols:
        side, slot = c[:2], c[len("HTPlayer"):-len("Score")]
        if slot[0] in "DMF" and slot != "G":
            groups.setdefault(f"{side}Player{slot[0]}Score", []).append(c)
    return groups


def filter_steps(preset: FixturePreset, proba_cols, required_slots):
    """The ordered filter chain of a preset as ``(name, predicate)`` pairs (FL2–FL4)."""
    steps = [("season", F.col("season") > preset.season_gt), ("round", F.col("round") >= preset.round_ge)]
    steps += [(c, to_double(c) > 0) for c in ("BW1", "BW2", "BWN")]
    ranged = [c for c in proba_cols if preset.check_over05 or c != "Over0_5goals"]
    steps.append(("probabilities", reduce(lambda a, b: a & b, [to_double(c).between(0, 1) for c in ranged])))
    if required_slots:
        steps.append(("lineup", reduce(lambda a, b: a & b, [(F.col(s) != "IDnull") for s in required_slots])))
    return steps


def raw_filters(df: DataFrame, p: FixturePreset, proba_cols) -> list:
    """Those steps of the chain that hold for the raw numeric columns already, before any
    is cast or filled: they drop no other rows than the chain, and reach the scan.  A
    missing round is filled with 0 first, so it stays out while 0 passes the limit."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    preds = [F.col("season") > p.season_gt] if "season" in numeric else []
    if "round" in numeric and p.round_ge > 0:
        preds.append(F.col("round") >= p.round_ge)
    preds += [F.col(c) > 0 for c in ("BW1", "BW2", "BWN") if c in numeric]
    return preds + [F.col(c).between(0, 1) for c in proba_cols if c in numeric and (p.check_over05 or c != "Over0_5goals")]


def prepare_fixtures(df: DataFrame, label: str | None, preset: str | FixturePreset = "v5",
                     halftime: DataFrame | None = None, id_cols=None, score_cols=None,
                     proba_cols=None, max_halftime_rows: int = 1_000_000,
                     observed: clean.ObservedSteps | None = None) -> DataFrame:
    """CL1: clean, derive targets, add team means and half-time rates, filter, normalise
    per round and fill, in the preset's step order.  ``label=None`` keeps every label.
    With ``observed``, the pass that makes the rows also counts the cleaning report's."""
    p = PRESETS[preset] if isinstance(preset, str) else preset
    from ..presets import PLAYER_ID_COLS, PLAYER_SCORE_COLS, PROBA_COLS
    ids = [c for c in (id_cols or PLAYER_ID_COLS) if c in df.columns]
    scores = [c for c in (score_cols or PLAYER_SCORE_COLS) if c in df.columns]
    probas = [c for c in (proba_cols or PROBA_COLS) if c in df.columns]
    required = [s for s in p.required_slots if s in ids]

    out = clean.drop_columns(df, DROPPED_RAW_COLS)
    if p.halftime != "group_mean" and observed is None:  # a group's mean is taken over the rows before any filter
        out = clean.filter_all(out, raw_filters(out, p, probas))
    out = out.withColumns({"event_date": pj.to_date("event_date")})
    out = out.withColumns({c: to_double(c) for c in p.numeric_cols if c in out.columns})
    out = out.withColumns({c: fill_int(c) for c in p.int_cols if c in out.columns})
    out = tg.fixture_targets(out, exact=p.exact_goal_labels)
    if p.idnull_before_filters:
        out = out.withColumns({c: pj.replace_idnull(c) for c in ids})
    out = out.withColumns({c: pj.zero_to_null(c) for c in scores})
    out = out.withColumns({g: pj.row_mean_nonzero(cols) for g, cols in _slot_groups(scores).items()})
    out = out.withColumns({c: pj.null_to_zero(c) for c in scores})
    if halftime is not None and p.halftime == "lookup":
        out = joins.lookup(out.drop("homeWin_halftime", "awayWin_halftime"), halftime, "league_id",
                           ["homeWin_halftime", "awayWin_halftime"], max_broadcast_rows=max_halftime_rows)
    elif p.halftime == "group_mean":
        for c in ("homeWin_halftime", "awayWin_halftime"):
            if c in out.columns:
                out = profile.group_mean(out, "league_id", c, f"_cf_{c}").drop(c).withColumnRenamed(f"_cf_{c}", c)
    if "pred_match_winner" in out.columns:
        out = out.withColumns(pj.indicator_flags("pred_match_winner"))
    out = out.withColumns({c: pj.shift_negative(c) for c in ("pred_goals_home", "pred_goals_away") if c in out.columns})
    steps = filter_steps(p, probas, required if p.idnull_before_filters else [])
    if observed is not None:
        out = observed.watch(out, report_steps(p, probas, [s for s in p.required_slots if s in ids]))
    out = clean.filter_all(out, [pred for _, pred in steps])
    out = out.withColumns({"DiffWin12": pj.diff_pair("W1", "W2"), "DiffWin1N": pj.diff_pair("W1", "WN"),
                           "DiffWin2N": pj.diff_pair("W2", "WN")})
    out = out.withColumns({c: pj.per_unit(c, "round") for c in PER_ROUND_COLS if c in out.columns})
    out = out.withColumns({"HTGD": F.col("HTGS") - F.col("HTGC"), "ATGD": F.col("ATGS") - F.col("ATGC")})
    out = clean.fill_all(out, 0, "0")
    if not p.idnull_before_filters:
        out = out.withColumns({c: pj.replace_idnull(c) for c in ids})
        out = clean.require_present(out, required)
    labels_made = [c for c in LABEL_COLUMNS if c in out.columns]
    keep_labels = labels_made if label is None else [label]
    drop = list(HIDDEN_COLS) + [c for c in labels_made if c not in keep_labels]
    if p.keep_ftr_totgoal:
        drop = [c for c in drop if c not in ("FTR", "totgoal")]
    if p.drop_ids:
        drop += ids
    return clean.drop_columns(out, drop)


def report_steps(p: FixturePreset, probas, required) -> list:
    """The steps of the cleaning report; line-up ids count as missing whether or not they
    have been replaced yet."""
    steps = filter_steps(p, probas, [])
    if required:
        steps.append(("lineup", reduce(lambda a, b: a & b, [pj.replace_idnull(s) != "IDnull" for s in required])))
    return steps


def fixture_cleaning_report(df: DataFrame, preset: str | FixturePreset = "v5", proba_cols=None,
                            id_cols=None) -> DataFrame:
    """FL7 for fixtures: rows removed by each step of the preset's chain, one pass."""
    p = PRESETS[preset] if isinstance(preset, str) else preset
    from ..presets import PLAYER_ID_COLS, PROBA_COLS
    ids = [c for c in (id_cols or PLAYER_ID_COLS) if c in df.columns]
    probas = [c for c in (proba_cols or PROBA_COLS) if c in df.columns]
    d = df.withColumns({c: pj.replace_idnull(c) for c in ids})
    d = d.withColumn("round", fill_int("round"))
    return clean.cleaning_report(d, filter_steps(p, probas, [s for s in p.required_slots if s in ids]))


def format_fixtures(df: DataFrame, label: str, preset: str | FixturePreset = "v5",
                    halftime: DataFrame | None = None, dictionary: DataFrame | None = None,
                    split_ratio: float | None = None, order_cols=("fixture_id",), **kw):
    """CL3: CL1 + dictionary encoding of the name columns and the rating columns,
    optionally a head/tail split (SP4).  Returns ``(frame, dictionary)``."""
    out = prepare_fixtures(df, label, preset, halftime, **kw)
    if dictionary is None or split_ratio is not None:
        # the prepared table feeds the dictionary fit, the encoding and the ranking:
        # write it once to the shared checkpoint folder instead of preparing it 3-4 times
        out = materialize(out, "prepared-fixtures")
    names = [c for c in NAME_COLS if c in out.columns]
    from ..presets import PLAYER_SCORE_COLS
    ratings = [c for c in (kw.get("score_cols") or PLAYER_SCORE_COLS) if c in out.columns]
    cols = names + ratings
    if dictionary is None:
        dictionary = fit_dictionary(out, cols)
    out = encode_columns(out, dictionary, cols)
    if split_ratio is not None:
        out = head_tail_split(out, list(order_cols), split_ratio)
    return out, dictionary

