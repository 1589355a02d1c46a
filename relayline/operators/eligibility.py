"""Eligibility (F1-F5, U1, J1, R1): which (lead, stage, platform) to send now.

A gold row becomes one candidate per platform it has a signal for (its own
click ID, or the platform's paid origin) inside that platform's window.
Candidates already accepted in the control table are removed by a left anti
join on the three-part key.

The default plan reads gold once and fans each row out with
``explode(filter(array(when ...)))`` instead of a three-arm UNION ALL, which
Catalyst would plan as three scans. A pre-filter with the OR of the platform
predicates is pushed to the scan. The anti join is left to Catalyst/AQE:
broadcast when the accepted keys are measured small, sort-merge otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import expression_cache
from ..functions.timefmt import days_before, ts_lit
from ..schemas import KEY, PLATFORM_RULES, PlatformRule

CANDIDATE_COLUMNS = ["lead_id", "etapa_funil", "data_hora_conversao", "plataforma"]


@expression_cache
def platform_signal(rule: PlatformRule) -> Column:
    """the platform's own click ID, or a lead that came from its paid media."""
    return F.col(rule.click_col).isNotNull() | (F.col("origem_midia") == F.lit(rule.paid_origin))


@expression_cache
def platform_predicate(rule: PlatformRule, as_of, windowed: bool = True,
                       future_guard: bool = False, day: str | None = None) -> Column:
    """``day`` names a column with the conversion's day: bounds on it too, so
    that a table partitioned by it opens the folders of the window only."""
    cond = platform_signal(rule)
    ts = F.col("data_hora_conversao")
    if windowed:  # inclusive lower bound, no upper bound
        cond = cond & (ts >= days_before(as_of, rule.window_days))
        if day:
            cond = cond & (F.col(day) >= F.to_date(days_before(as_of, rule.window_days)))
    if day and future_guard:
        cond = cond & (F.col(day) <= F.to_date(ts_lit(as_of)))
    if future_guard:  # F3
        cond = cond & (ts <= ts_lit(as_of))
    return cond


def candidates(gold: DataFrame, as_of=None, windowed: bool = True, future_guard: bool = False,
               one_scan: bool = True, carry: bool = False, rules=PLATFORM_RULES, day: str | None = None) -> DataFrame:
    """Gold fanned out to (lead, stage, platform) candidates.

    ``carry=True`` keeps every gold column next to ``plataforma`` (used when the
    gold key is known unique, so routing needs no second join).
    """
    preds = [(r.name, platform_predicate(r, as_of, windowed, future_guard, day)) for r in rules]
    if one_scan:
        any_platform = reduce(lambda a, b: a | b, [p for _, p in preds])
        platforms = F.filter(F.array(*[F.when(p, F.lit(name)) for name, p in preds]),
                             lambda x: x.isNotNull())
        fanned = gold.where(any_platform).withColumn("plataforma", F.explode(platforms))
    else:
        arms = [gold.where(p).withColumn("plataforma", F.lit(name)) for name, p in preds]
        fanned = reduce(lambda a, b: a.unionByName(b), arms)
    if carry:
        return fanned
    return fanned.select(*CANDIDATE_COLUMNS)


def blocking_keys(control: DataFrame, block_dead_letter: bool = False) -> DataFrame:
    """Keys that must not be sent again: accepted (and optionally dead-lettered)."""
    statuses = ["aceito"] + (["dead_letter"] if block_dead_letter else [])
    # distinct (combined map-side): a key repeated in control is one row on the
    # build side of the anti join, never a buffer of all its copies
    return control.where(F.col("status_envio").isin(*statuses)).select(*KEY).distinct()


def eligible(gold: DataFrame, control: DataFrame, as_of=None, windowed: bool = True,
             future_guard: bool = False, block_dead_letter: bool = False,
             one_scan: bool = True, carry: bool = False, day: str | None = None) -> DataFrame:
    """Candidates minus what the control table already holds as accepted.

    Only ``aceito`` blocks by default, so ``erro`` and ``dead_letter`` rows are
    offered again; NULL keys never match and stay eligible.
    """
    cand = candidates(gold, as_of, windowed, future_guard, one_scan, carry, day=day)
    return cand.join(blocking_keys(control, block_dead_letter), KEY, "left_anti")
