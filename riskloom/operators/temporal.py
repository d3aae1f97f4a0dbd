"""Temporal features: time since the previous transaction, velocity, recency / frequency / monetary, gaps.

One key may own a third of all rows, so no window runs over the raw rows of a key. Rows first
collapse to one tick per (key, second); a tick window covers one (key, day), at most 86,400 ticks,
and a per-(key, day) table carries totals across days. Sliding counts are differences of two
running totals, so their cost does not depend on the window length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import clock
from riskloom.functions.bins import labelled
from riskloom.operators.keyed import KeyTable, attach, columns_as_keys, key_rows, key_table
from riskloom.operators.ordering import row_index
from riskloom.operators.state import TimelineState, day_table, gap_table, seconds_of
from riskloom.session import written

TIME, ROW_ID, AMOUNT = "TransactionDT", "TransactionID", "TransactionAmt"

# Default keys per feature family, and window lengths in seconds.
SINCE_KEYS = ("card1", "card2", "P_emaildomain", "R_emaildomain", "DeviceInfo", "DeviceType", "addr1")
VELOCITY_KEYS = ("card1", "P_emaildomain", "DeviceInfo", "addr1")
RFM_KEYS = ("card1", "card2", "P_emaildomain", "addr1", "DeviceInfo")
GAP_KEYS = ("card1", "P_emaildomain", "DeviceInfo")
GAP_PARTS = ("mean_gap", "std_gap", "min_gap", "max_gap")
RFM_PARTS = ("recency", "frequency", "monetary_total", "monetary_mean", "monetary_std", "rfm_score")
VELOCITY_WINDOWS = {"1h": 3600, "6h": 6 * 3600, "24h": 24 * 3600, "7d": 7 * 24 * 3600}

_TICK = ["name", "key", "at"]


def _present(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def _ticks(seconds: DataFrame, windows: Mapping[str, int], past: TimelineState | None = None,
           fast: Sequence[str] | None = None) -> DataFrame:
    """One row per (key name, key, second) that occurs, with what happened strictly before it.

    n_before: rows earlier than this second; prev_at: the latest earlier second; first_at: the first
    second of the key; v_<w>: rows in [at - w, at), of the key names in ``fast`` (all by default), others have nulls.
    Rows of ``past`` count as earlier rows and have no ticks.
    """
    labels = list(windows)
    zero = F.lit(0).cast("long")
    seconds = seconds.withColumn("own", F.lit(True))
    if past is not None:
        seconds = seconds.unionByName(past.ticks.select(*_TICK, "n", F.lit(False).alias("own")))
    if labels:
        # A row adds 1 to every later tick and takes it back once it is older than the window.
        events = [F.struct(F.col("at").alias("at"), F.col("n").alias("n"), *[zero.alias(f"out_{w}") for w in labels])]
        events += [F.struct((F.col("at") + windows[w]).alias("at"), zero.alias("n"),
                            *[(F.col("n") if x == w else zero).alias(f"out_{x}") for x in labels]) for w in labels]
        made = F.array(*events)
        if fast is not None:
            # Without a velocity to tell, a second is one mark and not one more per window.
            made = F.when(F.col("name").isin(list(fast)), made).otherwise(F.array(events[0]))
        marks = seconds.select("name", "key", "own", F.inline(made))
    else:
        marks = seconds
    sums = ["n"] + [f"out_{w}" for w in labels]
    seen = F.when(F.col("n") > 0, F.col("at"))
    marks = marks.withColumn("day", F.floor(F.col("at") / clock.DAY)).where(F.col("day").isNotNull())

    # At most 86,400 seconds times (1 + windows) marks share a (key, day).
    today = Window.partitionBy("name", "key", "day").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    local = marks.withColumns({
        **{f"loc_{m}": F.coalesce(F.sum(m).over(today), F.lit(0)) for m in sums}, "loc_prev": F.max(seen).over(today),
    }).where((F.col("n") > 0) & F.col("own"))

    days = marks.groupBy("name", "key", "day").agg(
        *[F.sum(m).alias(m) for m in sums], F.max(seen).alias("last_seen"), F.min(seen).alias("first_seen"))
    if past is not None:
        # Days before those kept by second have left every window.
        old = past.days.where(F.col("day") < past.first_day)
        days = days.unionByName(old.select(
            "name", "key", "day", "n", *[F.col("n").alias(f"out_{w}") for w in labels],
            F.col("last_at").alias("last_seen"), F.col("first_at").alias("first_seen")))
    past_days = Window.partitionBy("name", "key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    all_days = Window.partitionBy("name", "key")
    carried = days.select(
        "name", "key", "day", *[F.coalesce(F.sum(m).over(past_days), F.lit(0)).alias(f"day_{m}") for m in sums],
        F.max("last_seen").over(past_days).alias("day_prev"), F.min("first_seen").over(all_days).alias("first_at"))

    joined = local.join(carried, ["name", "key", "day"])
    total = {m: F.col(f"loc_{m}") + F.col(f"day_{m}") for m in sums}
    counted = F.lit(True) if fast is None else F.col("name").isin(list(fast))
    return joined.select(
        *_TICK, total["n"].alias("n_before"), F.coalesce("loc_prev", "day_prev").alias("prev_at"), "first_at",
        *[F.when(counted, total["n"] - total[f"out_{w}"]).alias(f"v_{w}") for w in labels])


# A key's rows of one second are ordered in one task up to this number.
CROWD_LIMIT = 1_000_000


def _placed(rows: DataFrame, seconds: DataFrame, ticks: DataFrame, crowd_limit: int) -> DataFrame:
    """Rows with their tick's columns and ``_r``, their 1-based place among the rows of the tick."""
    same_second = Window.partitionBy(*_TICK).orderBy(ROW_ID)
    crowded = seconds.where(F.col("n") > crowd_limit).select(*_TICK)
    if crowded.isEmpty():
        return rows.withColumn("_r", F.row_number().over(same_second)).join(ticks, _TICK)
    # Crowded ticks number at most rows / crowd_limit; their rows are placed by a global order.
    calm = rows.join(F.broadcast(crowded), _TICK, "left_anti").withColumn("_r", F.row_number().over(same_second))
    packed = row_index(rows.join(F.broadcast(crowded), _TICK), [*_TICK, ROW_ID], "_pos")
    starts = packed.groupBy(*_TICK).agg(F.min("_pos").alias("_start"))
    packed = packed.join(F.broadcast(starts), _TICK).withColumn("_r", F.col("_pos") - F.col("_start") + 1)
    few = ticks.join(F.broadcast(crowded), _TICK, "left_semi")
    return calm.join(ticks, _TICK).unionByName(packed.drop("_pos", "_start").join(F.broadcast(few), _TICK))


def key_timeline(df: DataFrame, keys: Sequence[str], windows: Mapping[str, int] | None = None,
                 crowd_limit: int = CROWD_LIMIT, past: TimelineState | None = None,
                 fast: Sequence[str] | None = None) -> DataFrame:
    """Per (row, key name): gap to the previous row, hours since the first, running count, velocities.

    Rows of one key in the same second are ordered by row id. With ``past`` the rows go on from those it is the state of,
    which must all be earlier, and whose reach must cover the windows. With ``fast`` only these key names have velocities.
    """
    return _timeline(df, keys, windows, crowd_limit, past, fast)[0]


def _timeline(df: DataFrame, keys: Sequence[str], windows: Mapping[str, int] | None = None, crowd_limit: int = CROWD_LIMIT,
              past: TimelineState | None = None, fast: Sequence[str] | None = None,
              seconds: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The timeline, and the (name, key, at, n) seconds it was made from, which may have been written before."""
    rows = key_rows(df, columns_as_keys(df, keys), [ROW_ID, F.col(TIME).alias("at")]).where(F.col("at").isNotNull())
    seconds = written(rows.groupBy(*_TICK).agg(F.count("*").alias("n"))) if seconds is None else seconds
    if past is not None:
        if past.reach < max((windows or {}).values(), default=0):
            raise ValueError("the state does not reach back as far as the windows")
        start = seconds.agg(F.min("at")).first()[0]
        if None not in (start, past.end) and start <= past.end:
            raise ValueError(f"rows begin at {start}, not after the state's end {past.end}; pass the earlier rows instead")
    placed = _placed(rows, seconds, _ticks(seconds, windows or {}, past, fast), crowd_limit)
    gap = F.when(F.col("_r") > 1, F.lit(0.0)).otherwise((F.col("at") - F.col("prev_at")) / clock.HOUR)
    return placed.select(
        ROW_ID, "name", "key", gap.alias("gap"),
        ((F.col("at") - F.col("first_at")) / clock.HOUR).alias("since_first"),
        (F.col("n_before") + F.col("_r")).alias("so_far"),
        *[f"v_{w}" for w in (windows or {})]), seconds


def _spread(timeline: DataFrame, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Back to one row per transaction: output column -> (key name, timeline column).

    A transaction's key names come from as many tasks, so nothing can be summed up before the narrow rows are shuffled.
    """
    return timeline.select(ROW_ID, "name", *dict.fromkeys(c for _, c in wanted.values())).repartition(ROW_ID).groupBy(ROW_ID).agg(
        *[F.max(F.when(F.col("name") == k, F.col(c))).alias(out) for out, (k, c) in wanted.items()])


def _attach(df: DataFrame, spread: DataFrame, zero_filled: Sequence[str] = ()) -> DataFrame:
    out = df.join(spread, ROW_ID, "left")
    if zero_filled:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_filled})
    return out


def _since_columns(keys: Sequence[str]) -> dict[str, tuple[str, str]]:
    parts = {"time_since_prev": "gap", "time_since_first": "since_first", "txn_count_so_far": "so_far"}
    return {f"{k}_{label}": (k, c) for k in keys for label, c in parts.items()}


def _velocity_columns(keys: Sequence[str], windows: Mapping[str, int]) -> dict[str, tuple[str, str]]:
    return {f"{k}_velocity_{w}": (k, f"v_{w}") for k in keys for w in windows}


def _gap_table(timeline: DataFrame, seconds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(name, key, n, mean, spread and range of the key's gaps); whole seconds need no look at the rows."""
    if isinstance(seconds.schema["at"].dataType, T.IntegralType):
        return gap_table(day_table(seconds.where(F.col("name").isin(list(keys)))))
    return timeline.where(F.col("name").isin(list(keys))).groupBy("name", "key").agg(
        F.count("*").alias("n"), F.avg("gap").alias("mean_gap"), F.stddev_samp("gap").alias("std_gap"),
        F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"))


def _attach_gaps(df: DataFrame, table: KeyTable, keys: Sequence[str], gaps: Mapping[str, str]) -> DataFrame:
    """Gap statistics per key, and a flag where the row's own gap (column ``gaps[key]``) is far from the mean."""
    outputs = {k: {f"{k}_{p}": p for p in GAP_PARTS} for k in keys}
    out = attach(df, columns_as_keys(df, keys), table, outputs)
    far = {f"{k}_unusual_gap": F.coalesce(
        F.abs(F.col(gaps[k]) - F.col(f"{k}_mean_gap")) > 2 * F.col(f"{k}_std_gap"), F.lit(False)).cast("int") for k in keys}
    return out.withColumns(far)


def _gap_names(keys: Sequence[str]) -> list[str]:
    return [f"{k}_{p}" for k in keys for p in (*GAP_PARTS, "unusual_gap")]


def create_time_since_features(df: DataFrame, keys: Sequence[str] = SINCE_KEYS) -> tuple[DataFrame, list[str]]:
    keys = _present(df, keys)
    if TIME not in df.columns or not keys:
        return df, []
    wanted = _since_columns(keys)
    return _attach(df, _spread(key_timeline(df, keys), wanted)), list(wanted)


def create_velocity_features(df: DataFrame, keys: Sequence[str] = VELOCITY_KEYS,
                             windows: Mapping[str, int] = VELOCITY_WINDOWS) -> tuple[DataFrame, list[str]]:
    """Earlier rows of the same key with t - w <= t' < t; 0 where the key is missing."""
    keys = _present(df, keys)
    if TIME not in df.columns or not keys:
        return df, []
    wanted = _velocity_columns(keys, windows)
    return _attach(df, _spread(key_timeline(df, keys, windows), wanted), list(wanted)), list(wanted)


def create_transaction_gap_features(df: DataFrame, keys: Sequence[str] = GAP_KEYS) -> tuple[DataFrame, list[str]]:
    keys = _present(df, keys)
    if TIME not in df.columns or not keys:
        return df, []
    timeline, seconds = _timeline(df, keys)
    own = {f"_gap_{k}": (k, "gap") for k in keys}
    out = _attach_gaps(_attach(df, _spread(timeline, own)), key_table(_gap_table(timeline, seconds, keys)), keys,
                       {k: f"_gap_{k}" for k in keys})
    return out.select(*df.columns, *_gap_names(keys)), _gap_names(keys)


def create_rfm_features(df: DataFrame, keys: Sequence[str] = RFM_KEYS,
                        source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Recency (hours), frequency, monetary total / mean / std and their simple score, per key."""
    keys = _present(df, keys)
    if not {TIME, AMOUNT} <= set(df.columns):
        return df, []
    return _attach_rfm(df, rfm_table(df if source is None else source, keys), keys)


def _attach_rfm(df: DataFrame, table: KeyTable, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    outputs = {k: {f"{k}_{p}": p for p in RFM_PARTS} for k in keys}
    out = attach(df, columns_as_keys(df, keys), table, outputs)
    names = [c for k in keys for c in outputs[k]]
    return out.select(*df.columns, *names), names


def rfm_table(source: DataFrame, keys: Sequence[str]) -> KeyTable:
    """Recency, frequency, monetary sums and score per key of ``source``, as of its latest row."""
    latest = source.agg(F.max(TIME)).scalar()
    groups = key_rows(source, columns_as_keys(source, keys), [F.col(TIME).alias("at"), F.col(AMOUNT).alias("amount")]).groupBy("name", "key").agg(
        F.count("*").alias("n"), F.max("at").alias("last"), F.count("at").alias("frequency"),
        F.sum("amount").alias("monetary_total"), F.avg("amount").alias("monetary_mean"),
        F.stddev_samp("amount").alias("monetary_std"))
    groups = written(groups.withColumn("recency", (latest - F.col("last")) / clock.HOUR))
    # One row per key name.
    tops = groups.groupBy("name").agg(F.max("frequency").alias("_f"), F.max("monetary_total").alias("_m"))
    score = (1 / (F.col("recency") + 1) + F.col("frequency") / (F.col("_f") + 1)
             + F.try_divide(F.col("monetary_total"), F.col("_m") + 1))
    return key_table(groups.join(F.broadcast(tops), "name").withColumn("rfm_score", score).drop("_f", "_m"))


# Day parts, closed on the right, hour 0 included.
DAY_PART_EDGES = (0, 6, 12, 18, 24)
DAY_PARTS = ("night", "morning", "afternoon", "evening")


def create_time_pattern_features(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Calendar hour and weekday (kept if already there), hour flags, cyclic encodings, day part."""
    if TIME not in df.columns:
        return df, []
    clocked = {}
    if "DT_hour" not in df.columns:
        clocked["DT_hour"] = clock.calendar_hour(F.col(TIME))
    if "DT_day_of_week" not in df.columns:
        clocked["DT_day_of_week"] = clock.calendar_weekday(F.col(TIME))
    base = df.withColumns(clocked) if clocked else df
    h, d = F.col("DT_hour"), F.col("DT_day_of_week")
    hour_sin, hour_cos = clock.on_circle(h, 24)
    day_sin, day_cos = clock.on_circle(d, 7)
    made = {
        "is_business_hours": clock.in_range(h, 9, 17),
        "is_late_night": F.coalesce(h < 6, F.lit(False)).cast("int"),
        "hour_sin": hour_sin, "hour_cos": hour_cos, "day_sin": day_sin, "day_cos": day_cos,
        "time_of_day": labelled(h, DAY_PART_EDGES, DAY_PARTS, include_lowest=True),
    }
    return base.withColumns(made), [*clocked, *made]


def create_temporal_features(df: DataFrame, include_velocity: bool = True,
                             source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """All temporal features; since, velocity and gap features share one key timeline.

    Timelines and groups are formed from ``source``, the frame itself by default.
    """
    if TIME not in df.columns:
        return df, []
    source = df if source is None else source
    since, gaps = _present(df, SINCE_KEYS), _present(df, GAP_KEYS)
    fast = _present(df, VELOCITY_KEYS) if include_velocity else []
    windows = VELOCITY_WINDOWS if include_velocity else {}
    keys = list(dict.fromkeys([*since, *fast, *gaps]))
    out, names = df, []
    if keys:
        wanted = {**_since_columns(since), **_velocity_columns(fast, windows)}
        timeline, seconds = _timeline(source, keys, windows, fast=fast)
        own = {f"_gap_{k}": (k, "gap") for k in gaps}
        out = _attach(df, _spread(timeline, {**wanted, **own}), list(_velocity_columns(fast, windows)))
        out = _attach_gaps(out, key_table(_gap_table(timeline, seconds, gaps)), gaps, {k: f"_gap_{k}" for k in gaps}).drop(*own)
        names = [*wanted, *_gap_names(gaps)]
    out, rfm = create_rfm_features(out, source=source)
    out, pattern = create_time_pattern_features(out)
    return out, names + rfm + pattern


class TemporalFeatures:
    """The temporal features of later rows, learnt from a frame: key statistics, and the state its timelines go on from."""

    def __init__(self, windows: Mapping[str, int] = VELOCITY_WINDOWS):
        self.windows = dict(windows)
        self.state: TimelineState | None = None
        self.seconds: DataFrame | None = None
        self.gaps: KeyTable | None = None
        self.rfm: KeyTable | None = None

    def _keys(self, columns: Sequence[str]) -> tuple[list[str], list[str], list[str], list[str]]:
        since, fast, gaps = ([k for k in own if k in columns] for own in (SINCE_KEYS, VELOCITY_KEYS, GAP_KEYS))
        return since, fast, gaps, list(dict.fromkeys([*since, *fast, *gaps]))

    def fit(self, df: DataFrame) -> TemporalFeatures:
        self.columns = list(df.columns)
        if TIME not in df.columns:
            return self
        *_, gaps, keys = self._keys(self.columns)
        self.seconds = written(seconds_of(df, keys, TIME))
        self.state = TimelineState.of_seconds(self.seconds, self.windows)
        self.gaps = key_table(gap_table(self.state.days.where(F.col("name").isin(gaps))))
        if AMOUNT in df.columns:
            self.rfm = rfm_table(df, _present(df, RFM_KEYS))
        return self

    def transform(self, df: DataFrame, history: DataFrame | None = None, own: bool = False) -> DataFrame:
        """Features of ``df``, whose rows come after those learnt from; ``own`` for the rows learnt from themselves.

        Velocities, counts and times since go on from the learnt state, or from the rows of ``history`` if it is given.
        """
        if self.state is None:
            return df
        since, fast, gaps, keys = self._keys(self.columns)
        wanted = {**_since_columns(since), **_velocity_columns(fast, self.windows)}
        gap_columns = {f"_gap_{k}": (k, "gap") for k in gaps}
        source = df.select(ROW_ID, TIME, *keys)
        if history is not None:
            source = source.unionByName(history.select(ROW_ID, TIME, *keys))
        past = None if own or history is not None else self.state
        timeline, _ = _timeline(source, keys, self.windows, past=past, fast=fast, seconds=self.seconds if own and history is None else None)
        out = _attach(df, _spread(timeline, {**wanted, **gap_columns}), list(_velocity_columns(fast, self.windows)))
        out = _attach_gaps(out, self.gaps, gaps, {k: f"_gap_{k}" for k in gaps}).drop(*gap_columns)
        if self.rfm is not None:
            out, _ = _attach_rfm(out, self.rfm, [k for k in RFM_KEYS if k in self.columns])
        return create_time_pattern_features(out)[0]
