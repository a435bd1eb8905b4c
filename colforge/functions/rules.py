"""Decision rules over predicted probabilities (RL1–RL8) as ordered CASE expressions.

The rules are user-level calls over one row of level-1 outputs.  Column names are
arguments with the reference's names as defaults.  Thresholds are kept literally,
including the mix of 0–1 and percent scales in ``five_way_call``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import to_double


def _d(c) -> Column:
    return to_double(c)


def _all(*conds) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, conds), F.lit(False))


def final_call(t1="Team1Win", t2="Team2Win", nt1="NotTeam1Win", nt2="NotTeam2Win",
               w="W", d="D", lo="L", tn="TeamNWin") -> Column:
    """RL1: '1' / '2' / 'N' / ' ? '."""
    T1, T2, N1, N2, W, D, L, TN = map(_d, (t1, t2, nt1, nt2, w, d, lo, tn))
    home = _all(T1 > 0.51, N2 > 0.51, W > L, W > D, TN == 0)
    away = _all(T2 > 0.51, N1 > 0.51, L > W, L > D, TN == 0)
    draw = _all(N1 > 0.55, N2 > 0.55, D > 0.51, D > W, D > L, TN == 1)
    return F.when(home, "1").when(away, "2").when(draw, "N").otherwise(" ? ")


def over_line(ov05="Ov05", ov15="Ov15", ov25="Ov25", ov35="Ov35", ov45="Ov45") -> Column:
    """RL2: highest supported over-goals line; later rules override earlier ones."""
    o0, o1, o2, o3, o4 = map(_d, (ov05, ov15, ov25, ov35, ov45))
    return (F.when(_all(o4 > 0, o3 > 0, o2 > 0, o1 > 0, o0 > 0), "Over 4.5")
            .when(_all(o3 > 0, o2 > 0, o1 > 0, o0 > 0), "Over 3.5")
            .when(_all(o2 > 0, o1 > 0, o0 > 0), "Over 2.5")
            .when(_all(o1 > 0, o0 > 0), "Over 1.5")
            .when(_all(o0 > 1), "Over 1.5")
            .otherwise(""))


def under_line(ov05="Ov05", ov15="Ov15", ov25="Ov25", ov35="Ov35", ov45="Ov45") -> Column:
    """RL3: lowest supported under-goals line; later rules override earlier ones."""
    o0, o1, o2, o3, o4 = map(_d, (ov05, ov15, ov25, ov35, ov45))
    return (F.when(_all(o4 < 1, o3 < 1, o2 < 1, o1 < 0, o0 < 0), "under 0.5")
            .when(_all(o4 < 1, o3 < 1, o2 < 1, o1 < 0), "Under 1.5")
            .when(_all(o4 < 1, o3 < 1, o2 < 1), "Under 2.5")
            .when(_all(o4 < 1, o3 < 1), "Under 3.5")
            .when(_all(o4 < 1), "Under 4.5")
            .otherwise(""))


def over_call(c, threshold: float = 0.5) -> Column:
    """RL4: 'Over' when the probability exceeds the threshold."""
    return F.when(_all(_d(c) > threshold), "Over").otherwise("")


def home_call(t1="Team1Win", nt2="NotTeam2Win", w="W", lo="L", tn="TeamNWin") -> Column:
    """RL5: '1' or ''."""
    T1, N2, W, L, TN = map(_d, (t1, nt2, w, lo, tn))
    return F.when(_all(T1 > 0.5, N2 > 0.51, W > L, TN == 0), "1").otherwise("")


def away_call(t2="Team2Win", nt1="NotTeam1Win", w="W", lo="L", tn="TeamNWin") -> Column:
    """RL5: '2' or ''."""
    T2, N1, W, L, TN = map(_d, (t2, nt1, w, lo, tn))
    return F.when(_all(T2 > 0.5, N1 > 0.51, L > W, TN == 0), "2").otherwise("")


def draw_call(nt1="NotTeam1Win", nt2="NotTeam2Win", w="W", d="D", lo="L", tn="TeamNWin") -> Column:
    """RL5: 'N' or ''."""
    N1, N2, W, D, L, TN = map(_d, (nt1, nt2, w, d, lo, tn))
    return F.when(_all(N1 > 0.60, N2 > 0.60, D > W, D > L, TN == 1), "N").otherwise("")


def five_way_call(nt1="NotTeam1Win", nt2="NotTeam2Win", w="W", d="D", lo="L", tn="TeamNWin") -> Column:
    """RL6: '1', '2', '1N', 'N2', 'N' or ''."""
    N1, N2, W, D, L, TN = map(_d, (nt1, nt2, w, d, lo, tn))
    return (F.when(_all(W > D, W > L, W > 0.5, TN == 0), "1")
            .when(_all(L > D, L > W, L > 0.5, TN == 0), "2")
            .when(_all(D > W, W > L, (50 - D) > (D - W), (W - L) > 6, TN == 1), "1N")
            .when(_all(D > L, L > W, (50 - D) > (D - L), (L - W) > 6, TN == 1), "N2")
            .when(_all(D > W, D > L, N1 > 0.60, N2 > 0.60, TN == 1), "N")
            .otherwise(""))


def not_whole(c) -> Column:
    """True when a score is not a whole number; missing counts as not whole."""
    x = _d(c)
    return F.coalesce(x != F.floor(x), F.lit(True))


def rating_errors(cols) -> Column:
    """RL7: number of slots whose score is not a whole number."""
    return reduce(lambda a, b: a + b, [not_whole(c).cast("int") for c in cols])


def invalid_slots(cols) -> Column:
    """RL8: comma-joined names of the slots with a bad score, in slot order."""
    return F.array_join(F.array_compact(F.array(*[F.when(not_whole(c), F.lit(c)) for c in cols])), ", ")


def lineup_verdict(cols, keeper_cols) -> Column:
    """RL8: OK / ERROR (a goalkeeper score is bad) / WARNING (another slot is bad)."""
    any_bad = reduce(lambda a, b: a | b, [not_whole(c) for c in cols])
    keeper_bad = reduce(lambda a, b: a | b, [not_whole(c) for c in keeper_cols])
    return F.when(~any_bad, "OK").when(keeper_bad, "ERROR").otherwise("WARNING")
