"""Player-table preparation (CL2) and its filters (FL5, FL6).

One lazy plan: coercions, filters, fills, sibling coalesces and casts are narrow
projections that Catalyst collapses into one stage; the label encoding adds one small
dictionary aggregation per text column and a join against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import coalesce_sibling
from ..functions.missing import fill_int, ne_keep_missing, to_double
from ..operators import clean
from ..operators.encode import encode_columns, fit_dictionary
from ..presets import PlayerPreset


def player_filters(df: DataFrame, predict: bool = False, preset: PlayerPreset = PlayerPreset(),
                   next_rating="NextRating", avg="avg", round_col="round", season="season",
                   event_date="event_date") -> DataFrame:
    """FL5: training-only date and positive-target filters, then the common ones.
    ``NextRating != v`` keeps missing ratings (pandas semantics)."""
    preds = []
    if not predict:
        preds += [F.col(event_date).cast("string") <= F.lit(preset.train_until), *clean.above(df, next_rating, 0)]
    preds += [*clean.above(df, avg, 0), F.col(round_col) > preset.round_gt, F.col(season) >= preset.season_ge]
    preds += [ne_keep_missing(clean.as_number(df, next_rating), float(v)) for v in preset.excluded_next]
    return clean.filter_all(df, preds)


def prepare_players(df: DataFrame, predict: bool = False, preset: PlayerPreset = PlayerPreset(),
                    dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """CL2: returns ``(prepared, dictionary)``.  Pass the training dictionary when
    preparing rows to score so that codes agree; otherwise one is fitted on ``df``."""
    cols = set(df.columns)
    out = clean.to_numeric(df, [c for c in preset.numeric_cols if c in cols])
    out = player_filters(out, predict, preset)
    out = clean.drop_columns(out, preset.dropped)
    out = clean.fill_groups(out, {"Unknown": [c for c in preset.text_unknown if c in cols]})
    enc = [c for c in preset.encoded if c in cols]
    if dictionary is None:
        dictionary = fit_dictionary(out, enc)
    out = encode_columns(out, dictionary, enc)
    out = clean.fill_groups(out, {0: list(preset.zero_fill), -9999: list(preset.minus_fill)})
    out = out.withColumns({a: coalesce_sibling(a, b) for a, b in preset.siblings[:1] if a in cols})
    for a, b in preset.siblings[1:]:
        if a in cols and b in out.columns:
            out = out.withColumn(a, coalesce_sibling(a, b))
    out = out.withColumns({c: fill_int(c, 0, "bigint" if c.endswith("_id") else "int")
                           for c in preset.int_cols if c in out.columns})
    out = clean.filter_all(out, [F.col(c) != 0 for c in preset.nonzero if c in out.columns])
    return out, dictionary
