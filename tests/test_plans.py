"""Composed plans: every preset runs, and the cleaning report agrees with the filter."""

import pytest
from pyspark.sql import functions as F

from colforge.plans.catalog.composed import IDS, PROBAS, SCORES, fixtures_raw, halftime_table
from colforge.plans.fixtures import fixture_cleaning_report, format_fixtures, prepare_fixtures
from colforge.presets import PRESETS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("preset", sorted(PRESETS))
def test_every_preset_runs(spark, preset):
    out = prepare_fixtures(fixtures_raw(spark, SF), None, preset, halftime_table(spark, SF),
                           id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)
    assert out.count() > 0
    assert "fixture_id" in out.columns and "HTGD" in out.columns
    assert out.where(F.col("round") < PRESETS[preset].round_ge).count() == 0


def test_report_matches_prepared_rows(spark):
    raw = fixtures_raw(spark, SF)
    rep = {r.step: r.rows_after for r in fixture_cleaning_report(raw, "v5", PROBAS, IDS).collect()}
    out = prepare_fixtures(raw, "Team1Win", "v5", halftime_table(spark, SF), id_cols=IDS, score_cols=SCORES,
                           proba_cols=PROBAS)
    assert rep["total"] == out.count()


def test_format_split_and_codes(spark):
    out, d = format_fixtures(fixtures_raw(spark, SF), "Team1Win", "v5", halftime_table(spark, SF),
                             split_ratio=0.8, id_cols=IDS, score_cols=SCORES, proba_cols=PROBAS)
    n = out.count()
    assert out.where(F.col("split") == "head").count() == int(n * 0.8)
    assert out.where(F.col("homeTeam") < 0).count() == 0
    assert d.where(F.col("feature") == "homeTeam").count() == out.select("homeTeam").distinct().count()


def test_observed_report_of_every_preset_takes_no_scan_of_its_own(spark):
    """The counts of the pass that prepares equal the report's, for each preset, and the
    prepared rows are the same."""
    from colforge.operators.clean import ObservedSteps
    raw, halftime = fixtures_raw(spark, SF), halftime_table(spark, SF)
    kw = {"id_cols": IDS, "score_cols": SCORES, "proba_cols": PROBAS}
    for preset in PRESETS:
        observed = ObservedSteps()
        rows = prepare_fixtures(raw, "Team1Win", preset, halftime, observed=observed, **kw)
        n = len(rows.collect())
        assert n == prepare_fixtures(raw, "Team1Win", preset, halftime, **kw).count()
        got = sorted(map(tuple, observed.report(spark).collect()))
        assert got == sorted(map(tuple, fixture_cleaning_report(raw, preset, proba_cols=PROBAS, id_cols=IDS).collect())), preset
        assert got[0][4] == n
        empty = ObservedSteps()
        prepare_fixtures(raw.limit(0), "Team1Win", preset, halftime, observed=empty, **kw).collect()
        assert {tuple(r)[2:] for r in empty.report(spark).collect()} == {(0, 0, 0)}
