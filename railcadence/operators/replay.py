"""Every cycle of a day at once, each from what was known at its time.

A cycle sees the passages observed up to its own stamp. Running the cycles one by one reads the
day again for each; here every passage is read once. A fact that changes from snapshot to
snapshot (a real time, the leader of an instant) becomes versions with the stamps between which
it held, versions meet the cycles that need them, and what lies before a cycle's horizon comes
from an as-of lookup (``operators/asof.py``).

``cycles`` holds one row per cycle: service_date and as_of_us (microseconds). Passages and cycles
belong together by service_date. Intervals are half open: a version holds from ``born`` and no
longer at ``dies`` (NULL: to the end of the day).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from railcadence import schema as S
from railcadence.functions import times
from railcadence.operators import ordered as O
from railcadence.operators.asof import between, latest_value
from railcadence.operators.regularity import _RATIO, score_columns
from railcadence.session import Keep

PLACE = ("service_date", "direction", "stop_key")
AT = "as_of_us"


def _observed(passages: DataFrame) -> DataFrame:
    return passages.withColumn("observed_us", times.micros(passages, "observed_at")).withColumn(
        "t_us", times.micros(passages, "t")
    )


# ------------------------------------------------------------------- scores
def real_versions(real: DataFrame) -> DataFrame:
    """Latest known real time per mission and place, as versions: PLACE, mission, us, born, dies."""
    key = [*PLACE, "mission"]
    known = _observed(real).where(O.all_known(*key, "t")).groupBy(*key, "observed_us").agg(F.max("t_us").alias("us"))
    order = Window.partitionBy(*key).orderBy("observed_us")
    most = F.max("us").over(order.rowsBetween(Window.unboundedPreceding, -1))
    changes = known.withColumn("_most", most).where("_most is null or us > _most").drop("_most")
    return changes.select(*key, "us", F.col("observed_us").alias("born"), F.lead("observed_us").over(order).alias("dies"))


def planned_firsts(planned: DataFrame, is_key: Column) -> DataFrame:
    """Planned times from the first snapshot of each mission: PLACE, mission, us, born."""
    rows, mission = _observed(planned), ["service_date", "mission"]
    first = rows.groupBy(*mission).agg(F.min("observed_us").alias("born"))
    key = [*PLACE, "mission"]
    calls = rows.where(is_key & O.all_known(*key, "t")).groupBy(*key, F.col("t_us").alias("us")).agg(
        F.min("observed_us").alias("born")
    )
    return calls.join(first, [*mission, "born"], "left_semi")


def _leaders(calls: DataFrame) -> DataFrame:
    """Smallest mission of every instant, as versions: PLACE, us, mission, born, dies."""
    instant = [*PLACE, "us"]
    known = calls.groupBy(*instant, "born").agg(F.min("mission").alias("mission"))
    order = Window.partitionBy(*instant).orderBy("born")
    least = F.min("mission").over(order.rowsBetween(Window.unboundedPreceding, -1))
    changes = known.withColumn("_least", least).where("_least is null or mission < _least").drop("_least")
    return changes.withColumn("dies", F.lead("born").over(order))


def _minutes(instants: DataFrame, group: Sequence[str], slice_seconds: float) -> DataFrame:
    """Minutes since the instant before, ``group`` and ``us``; NULL for the first."""
    found = O.with_previous(instants.select(*group, "us").distinct(), group, "us", slice_seconds=slice_seconds)
    return found.select(*group, "us", times.whole_minutes(F.col("us"), F.col("prev_us")).alias("minutes"))


def _due(versions: DataFrame, cycles: DataFrame, horizon_us: int) -> DataFrame:
    """Versions at every cycle whose horizon they fall into."""
    last = F.least(F.col("us"), F.coalesce(F.col("dies") - 1, F.col("us")))
    first = F.greatest(F.col("us") - horizon_us, F.col("born"))
    return between(versions, cycles, ["service_date"], AT, first, last, horizon_us)


def _passed(versions: DataFrame, cycles: DataFrame, due: DataFrame, horizon_us: int) -> DataFrame:
    """The last time before each cycle's stamp: PLACE, as_of_us, us.

    What never changes again counts from its time on. What changed after its time had passed
    counts for the cycles in between.
    """
    gone = F.greatest(F.col("us") + 1, F.col("born"))
    lasting = latest_value(
        versions.where("dies is null").select(*PLACE, gone.alias(AT), "us"), due, PLACE, AT, "us"
    ).where("us is not null")
    brief = between(versions.where("dies is not null"), cycles, ["service_date"], AT, gone, F.col("dies") - 1, horizon_us)
    at = [*PLACE, AT]
    brief = brief.select(*at, "us").join(due.select(*at).distinct(), at, "left_semi")
    return lasting.select(*at, "us").unionByName(brief).groupBy(*at).agg(F.max("us").alias("us"))


def _planned_minutes(pairs: DataFrame, calls: DataFrame, width: int, slice_seconds: float, keep: Keep) -> DataFrame:
    """Planned headways at every cycle that has a pair: PLACE, as_of_us, us, minutes.

    At a cycle the planned times from its earliest to its latest pair matter, and the one before.
    The lower ends are made non-decreasing from cycle to cycle, so a time that has fallen
    below them stays there and the one before is an as-of lookup again.
    """
    at = [*PLACE, AT]
    later = Window.partitionBy(*PLACE).orderBy(F.col(AT).desc())
    bounds = pairs.groupBy(*at).agg(F.min("us").alias("low"), F.max("us").alias("high")).withColumn(
        "low", F.min("low").over(later)
    )
    bounds = keep(bounds, "bounds")
    instants = calls.groupBy(*PLACE, "us").agg(F.min("born").alias("born"))
    inside = between(bounds, instants, PLACE, "us", F.col("low"), F.col("high"), width).where(F.col("born") <= F.col(AT))
    # the first cycle whose lower end is above a planned time: the axis turned round
    turned = bounds.select(*PLACE, (-F.col("low")).alias("_key"), (-F.col(AT)).alias("_cycle"))
    asks = instants.withColumn("_key", -F.col("us") - 1)
    below = asks.join(latest_value(turned, asks, PLACE, "_key", "_cycle"), [*PLACE, "_key"]).where("_cycle is not null")
    below = below.select(*PLACE, F.greatest("born", -F.col("_cycle")).alias(AT), "us")
    before = latest_value(keep(below, "below"), bounds, PLACE, AT, "us").where("us is not null")
    times_ = keep(inside.select(*at, "us").unionByName(before.select(*at, "us")), "planned-times")
    return _minutes(times_, at, slice_seconds)


def replay_scores(
    passages: DataFrame,
    cycles: DataFrame,
    stop_keys: Sequence[str],
    keep: Keep,
    horizon_min: float = S.HORIZON_MINUTES,
    slice_seconds: float = O.SLICE_SECONDS,
) -> DataFrame:
    """service_date, as_of_us, direction, stop_key, n_pairs, avg_excess, score: for every cycle
    what ``regularity_scores`` gives on the passages it has seen. ``keep`` stores what is used
    more than once (see ``session.work_tables``)."""
    horizon_us, at = int(horizon_min * times.MICROS_PER_MINUTE), [*PLACE, AT]
    is_key = F.col("stop_key").isin(*stop_keys)
    versions = keep(real_versions(passages.where(F.col("kind") == "real").where(is_key)), "real-versions")
    due = keep(_due(versions, cycles, horizon_us).select(*at, "mission", "us"), "due")
    leading = keep(due.groupBy(*at, "us").agg(F.min("mission").alias("lead")), "leading")
    before = _passed(versions, cycles, leading.select(*at), horizon_us)
    minutes = _minutes(keep(leading.select(*at, "us").unionByName(before.select(*at, "us")), "real-times"), at, slice_seconds)
    real_min = F.when(F.col("mission") == F.col("lead"), F.col("minutes")).otherwise(0)
    real = due.join(leading, [*at, "us"]).join(minutes, [*at, "us"]).select(*at, "mission", real_min.alias("real_min")).where(
        "real_min is not null"
    )

    calls = keep(planned_firsts(passages.where(F.col("kind") == "planned"), is_key), "planned-firsts")
    pairs = real.join(calls, [*PLACE, "mission"]).where(F.col("born") <= F.col(AT)).drop("born")
    leads = (F.col("born") <= F.col(AT)) & F.coalesce(F.col(AT) < F.col("dies"), F.lit(True))
    pairs = pairs.join(_leaders(calls), [*PLACE, "us", "mission"]).where(leads).select(*at, "mission", "us", "real_min")
    pairs = keep(pairs, "pairs")
    planned = _planned_minutes(pairs, calls, horizon_us, slice_seconds, keep).where("minutes > 0")
    ratio = (F.col("real_min") - F.col("minutes")) / F.col("minutes").cast("double")
    excess = pairs.join(planned, [*at, "us"]).withColumn("excess", F.greatest(F.lit(0.0), ratio).cast(_RATIO))
    sums = excess.groupBy(*at).agg(F.sum("excess").alias("_total"), F.count("*").alias("_n"))
    return sums.select(
        "service_date", AT, "direction", "stop_key",
        *[c.alias(k) for k, c in score_columns(F.col("_total"), F.col("_n")).items()],
    )


# ------------------------------------------------------------------- stamps
def stamps_of(passages: DataFrame) -> list[tuple]:
    """(service_date, kind, observed_us) of all snapshots, in order. A day has one per landed payload and kind."""
    rows = _observed(passages).select("service_date", "kind", "observed_us").where("observed_us is not null").distinct()
    return sorted(tuple(r) for r in rows.collect())


def newest_snapshots(stamps: list[tuple], cycles: list[tuple]) -> list[tuple]:
    """(service_date, kind, observed_us, as_of_us): each kind's newest snapshot at each cycle
    (service_date, as_of_us) that has one."""
    seen: dict[tuple, list[int]] = {}
    for day, kind, us in stamps:
        seen.setdefault((day, kind), []).append(us)
    out = []
    for day, at in cycles:
        for (d, kind), known in seen.items():
            n = bisect_right(known, at) if d == day else 0
            if n:
                out.append((day, kind, known[n - 1], at))
    return out


# ---------------------------------------------------------------- reference
_SHAPE = ["direction", "origin", "destination", "n_stops"]


def _reconciled(current: set[tuple], incoming: set[tuple], letter: str, rules: dict[str, str], grow: bool) -> set[tuple]:
    """``reconcile_reference`` for the rows (direction, origin, destination, n_stops) of one mission type."""
    if not current:
        merged = incoming
    else:
        merged = set()
        for row in current:
            for other in (incoming if None in row else ()) or {row}:
                merged.add(tuple(a if a is not None else b for a, b in zip(row, other, strict=True)))
    if grow and incoming:
        most = max(r[3] for r in incoming)
        merged = {(*r[:3], most if r[3] is None else max(r[3], most)) for r in merged}
    return {(r[0], r[1], rules[letter] if letter in rules else r[2], r[3]) for r in merged}


def replay_reference(
    trips: DataFrame, current: DataFrame | None, cycles: list[tuple], newest: list[tuple],
    rules: dict[str, str] | None = None, grow_stop_counts: bool = False,
) -> DataFrame:
    """The reference after each cycle that changes it: mission_type, direction, origin, destination, n_stops,
    from_us, to_us (NULL: as left by the last cycle).

    ``trips`` are planned ones with service_date and observed_us. Mission types don't depend on each
    other; those of a type are reduced to distinct shapes per snapshot before they meet in a task.
    Without ``current`` the first cycle builds the reference, as one by one.
    """
    rules = S.DESTINATION_RULES if rules is None else rules
    planned = {(day, at): us for day, kind, us, at in newest if kind == "planned"}
    active = sorted({(at, day) for day, _, _, at in newest})
    steps = [(at, day, planned.get((day, at)), i == 0 and current is None) for i, (at, day) in enumerate(active)]
    shapes = trips.where("mission_type is not null").select(
        "mission_type", "direction", "origin", "destination", F.col("n_served").alias("n_stops"), "service_date", "observed_us"
    ).distinct()
    if current is not None:
        shapes = shapes.unionByName(current.select("mission_type", *_SHAPE), allowMissingColumns=True)
    result = "mission_type string, direction string, origin string, destination string, n_stops int, from_us bigint, to_us bigint"

    def simulate(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = pdf["mission_type"].iloc[0]
        letter = kind[:1] if isinstance(kind, str) else ""
        rows, now = [], set()
        for *shape, day, us in pdf[[*_SHAPE, "service_date", "observed_us"]].itertuples(index=False):
            row = tuple(None if pd.isna(x) else x for x in shape[:3]) + (None if pd.isna(shape[3]) else int(shape[3]),)
            if pd.isna(us):
                now.add(row)
            else:
                rows.append((int(us), day, row))
        rows.sort(key=lambda r: r[0])
        out, since, seen, day_of, place = [], None, {}, None, 0
        by_day: dict = {}
        for us, day, row in rows:
            by_day.setdefault(day, []).append((us, row))

        def close(upto):
            out.extend((kind, *row, since, upto) for row in now)

        for at, day, snapshot, first in steps:
            if day != day_of:
                seen, day_of, place = {}, day, 0
            known = by_day.get(day, [])
            while place < len(known) and known[place][0] <= at:
                seen[known[place][1]] = known[place][0]
                place += 1
            counts = [r[3] for r in seen if r[3] is not None]
            fullest = {r for r in seen if counts and r[3] == max(counts)}
            if first:
                after = fullest
            else:
                after = _reconciled(now, {r for r in fullest if seen[r] == snapshot}, letter, rules, grow_stop_counts)
            if after != now or since is None:
                if since is not None:
                    close(at)
                now, since = after, at
        if since is not None:
            close(None)
        elif now:  # no cycle at all
            close(None)
        return pd.DataFrame(out, columns=[c.split()[0] for c in result.split(", ")]).astype({"n_stops": "Int32", "from_us": "Int64", "to_us": "Int64"})

    return shapes.groupBy("mission_type").applyInPandas(simulate, result)


# --------------------------------------------------------------------- gaps
def replay_mission_gaps(passages: DataFrame, newest: DataFrame, reference: DataFrame) -> DataFrame:
    """service_date, as_of_us, mission, direction, max_gap_min for every cycle.

    ``newest`` names the newest snapshot of each kind at each cycle (service_date, kind,
    observed_us, as_of_us). Only those snapshots are read, planned and real in one pass.
    """
    limits = reference.groupBy("mission_type", "direction", "from_us", "to_us").agg(F.max("n_stops").alias("_n_stops"))
    calls = _observed(passages).select(
        "service_date", "kind", "observed_us", "mission", "mission_type", "stop_key", "n_served", "t_us"
    ).join(newest, ["service_date", "kind", "observed_us"])
    holds = (F.coalesce("from_us", AT) <= F.col(AT)) & F.coalesce(F.col(AT) < F.col("to_us"), F.lit(True))
    running = calls.join(limits, "mission_type").where(holds & (F.col("n_served") < F.col("_n_stops")))
    at = ["service_date", AT, "mission", "direction"]
    sides = [F.max(F.when(F.col("kind") == kind, F.col("t_us"))).alias(kind) for kind in ("real", "planned")]
    stops = running.groupBy(*at, "stop_key").agg(*sides)
    gap = times.whole_minutes(F.col("real"), F.col("planned"))
    return stops.groupBy(*at).agg(F.max(gap).alias("max_gap_min"))


def replay_drift(history: DataFrame, cycles: DataFrame) -> DataFrame:
    """service_date, as_of_us, direction, n_missions, mean_drift for every cycle.

    ``history`` holds service_date, us, mission, direction and max_gap_min, once per mission and
    stamp. A mission's first gap doesn't change, so one aggregate serves all cycles; each looks at
    the newest stamp it knows.
    """
    key = ["service_date", "mission", "direction"]
    firsts = history.groupBy(*key).agg(F.min("us").alias("_first"), F.min_by("max_gap_min", "us").alias("_first_gap"))
    minutes = times.elapsed_minutes(F.col("us"), F.col("_first"))
    change = F.coalesce(F.col("max_gap_min") - F.col("_first_gap"), F.lit(0)) / (minutes + 1)
    stats = history.join(firsts, key).groupBy("service_date", "us", "direction").agg(
        F.count("*").alias("n_missions"),
        (F.sum(change.cast("decimal(28,12)")).cast("double") / F.count("*")).alias("mean_drift"),
    )
    newest = latest_value(
        history.select("service_date", F.col("us").alias(AT), "us"), cycles, ["service_date"], AT, "us"
    ).where("us is not null")
    return stats.join(newest, ["service_date", "us"]).select("service_date", AT, "direction", "n_missions", "mean_drift")
