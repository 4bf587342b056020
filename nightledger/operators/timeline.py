"""Point-in-time lookups that never build (target, earlier row) pairs.

A look-back feature compares every target with every earlier row of the same
key, which grows with the square of a busy key. Here both sides are laid on one
time line per key instead and answered by running aggregates:

1. Rows and probes are grouped by (key, instant) first. The partial aggregation
   runs before the shuffle, so copies of one instant travel as one row and equal
   probes are asked once.
2. The line of a key is cut into hours (or days). One small row per (key, hour)
   carries the totals; a window over those gives each hour its opening value.
3. Only hours that hold a probe are kept, and a second window runs inside the
   hour. A busy key is therefore spread over as many tasks as it has hours.

Answers come back one row per distinct probe; callers join them to their rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions.calendar import day_number, hour_number

GRAINS = {"hour": hour_number, "day": day_number}

LOWER, UPPER, ROW = 0, 1, 2


def _slotted(lines: DataFrame, keys: Sequence[str], grain: str) -> DataFrame:
    """Lines placed by (key, slot): one shuffle serves slot totals, join and inner window.

    The slot leads wherever rows are sorted, since sorting compares the first column
    cheaply and most rows differ there.
    """
    return (
        lines.withColumn("_slot", GRAINS[grain](F.col("_at")))
        .where(F.col("_slot").isNotNull())
        .repartition("_slot", *keys)
    )


def _opening(lines: DataFrame, keys: Sequence[str], totals: dict[str, Column], carry: dict, forward: bool) -> DataFrame:
    """Per (key, slot) with a probe: the aggregate over all slots passed before it."""
    per_slot = lines.groupBy("_slot", *keys).agg(
        *[expr.alias(name) for name, expr in totals.items()],
        F.max(F.col("_kind") != ROW).alias("_asked"),
    )
    order = F.col("_slot").desc() if forward else F.col("_slot")
    passed = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_slot.select(
            *keys,
            "_slot",
            "_asked",
            *[fold(name).over(passed).alias(f"_open_{name}") for name, fold in carry.items()],
        )
        .where("_asked")
        .drop("_asked")
    )


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with every one of ``columns`` present.

    Said with plain IS NOT NULL tests, the ones a join would add to one branch
    only, so that both uses of the lines keep one plan and share its exchange.
    """
    return df.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns)))


def window_totals(
    rows: DataFrame,
    probes: DataFrame,
    keys: Sequence[str],
    at: str,
    lower: str,
    upper: str,
    measures: Sequence[str],
    carry: Sequence[str] = (),
    grain: str = "hour",
) -> DataFrame:
    """Sums of ``measures`` over the rows with ``lower <= at < upper``, per distinct probe.

    ``probes`` has ``keys``, ``lower``, ``upper`` and the ``carry`` columns that
    tell probes apart. Probes with no row in their range come back with zeros.
    Rows and probes with a missing key or bound match nothing and are dropped.
    """
    keys, carry = list(keys), list(carry)
    types = dict(probes.dtypes)
    rows = _complete(rows, [*keys, at])
    probes = _complete(probes, [*keys, lower, upper])
    nothing = {c: F.lit(None).cast(types[c]) for c in carry}

    def mark(kind: int, instant: str, told_by: dict[str, Column]) -> Column:
        return F.struct(
            F.col(instant).alias("_at"), F.lit(kind).alias("_kind"), *[told_by[c].alias(c) for c in carry]
        )

    ends = F.array(mark(LOWER, lower, nothing), mark(UPPER, upper, {c: F.col(c) for c in carry}))
    lines = (
        rows.select(
            *keys,
            F.lit(None).cast(types[lower]).alias("_start"),
            F.col(at).alias("_at"),
            F.lit(ROW).alias("_kind"),
            *[nothing[c].alias(c) for c in carry],
            *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in measures],
        )
        .unionByName(
            probes.select(*keys, F.col(lower).alias("_start"), F.explode(ends).alias("_end")).select(
                *keys, "_start", "_end.*", *[F.lit(0).cast("long").alias(m) for m in measures]
            )
        )
        .groupBy(*keys, "_at", "_start", "_kind", *carry)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    lines = _slotted(lines, keys, grain)
    opening = _opening(
        lines,
        keys,
        {m: F.sum(m) for m in measures},
        {m: F.sum for m in measures},
        forward=False,
    )
    # Probes sort before rows of the same instant, so a row at the bound is not yet counted.
    inside = (
        Window.partitionBy("_slot", *keys)
        .orderBy("_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    asked = (
        lines.join(opening, ["_slot", *keys])
        .select(
            *keys,
            "_at",
            "_start",
            "_kind",
            *carry,
            *[(F.coalesce(f"_open_{m}", F.lit(0)) + F.sum(m).over(inside)).alias(m) for m in measures],
        )
        .where(F.col("_kind") != ROW)
    )
    same_start = Window.partitionBy("_start", *keys)
    return (
        asked.select(
            *keys,
            F.col("_start").alias(lower),
            F.col("_at").alias(upper),
            "_kind",
            *carry,
            *[(F.col(m) - F.max(F.when(F.col("_kind") == LOWER, F.col(m))).over(same_start)).alias(m) for m in measures],
        )
        .where(F.col("_kind") == UPPER)
        .drop("_kind")
    )


def nearest_row(
    rows: DataFrame,
    probes: DataFrame,
    keys: Sequence[str],
    at: str,
    moment: str,
    payload: Sequence[str] = (),
    tie: Sequence[str] = (),
    carry: Sequence[str] = (),
    inclusive: bool = True,
    forward: bool = False,
    keep_unmatched: bool = False,
    grain: str = "hour",
) -> DataFrame:
    """The row nearest to each distinct probe: the latest before it, or the first after it.

    Returns ``keys``, ``moment``, the ``carry`` columns of the probe, ``at`` and
    ``payload``; probes without such a row are dropped unless ``keep_unmatched``.
    Among rows of one instant the greatest ``(tie, payload)`` wins looking back and
    the least looking forward.
    """
    keys, carry = list(keys), list(carry)
    rows = _complete(rows, [*keys, at])
    probes = _complete(probes, [*keys, moment])
    types = dict(probes.dtypes)
    pick = F.min if forward else F.max
    # A bare instant can be hash-aggregated; a struct is only needed to carry more than that.
    bare = not payload and not tie
    found = F.col(at) if bare else F.struct(F.col(at).alias("_seen_at"), *[F.col(c).alias(f"_tie_{c}") for c in tie], *payload)
    # Within one instant the row comes first exactly when it counts.
    row_turn, probe_turn = (0, 1) if inclusive else (1, 0)

    line_rows = rows.select(
        *keys,
        F.col(at).alias("_at"),
        F.lit(ROW).alias("_kind"),
        *[F.lit(None).cast(types[c]).alias(c) for c in carry],
        found.alias("_found"),
    )
    line_probes = probes.select(
        *keys,
        F.col(moment).alias("_at"),
        F.lit(UPPER).alias("_kind"),
        *carry,
        F.lit(None).cast(line_rows.schema["_found"].dataType).alias("_found"),
    )
    lines = (
        line_rows.unionByName(line_probes)
        .groupBy(*keys, "_at", "_kind", *carry)
        .agg(pick("_found").alias("_found"))
    )
    lines = _slotted(lines, keys, grain)
    opening = _opening(lines, keys, {"_found": pick("_found")}, {"_found": pick}, forward)
    walk = F.col("_at").desc() if forward else F.col("_at")
    inside = (
        Window.partitionBy("_slot", *keys)
        .orderBy(walk, F.when(F.col("_kind") == ROW, row_turn).otherwise(probe_turn))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = (
        lines.join(opening, ["_slot", *keys])
        .select(
            *keys,
            F.col("_at").alias(moment),
            "_kind",
            *carry,
            F.coalesce(pick("_found").over(inside), F.col("_open__found")).alias("_found"),
        )
        .where(F.col("_kind") != ROW)
    )
    if not keep_unmatched:
        answered = answered.where(F.col("_found").isNotNull())
    seen_at = F.col("_found" if bare else "_found._seen_at")
    return answered.select(
        *keys, moment, *carry, seen_at.alias(at), *[F.col(f"_found.{c}").alias(c) for c in payload]
    )


def with_previous(rows: DataFrame, keys: Sequence[str], at: str, column: str, grain: str = "hour") -> DataFrame:
    """Add ``previous_<column>``, its value at the instant before; one row per key and instant."""
    keys = list(keys)
    lines = (
        _complete(rows, [*keys, at])
        .withColumn("_slot", GRAINS[grain](F.col(at)))
        .where(F.col("_slot").isNotNull())
        .repartition("_slot", *keys)
    )
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    opening = (
        lines.groupBy("_slot", *keys)
        .agg(F.max_by(column, at).alias("_last"))
        .select("_slot", *keys, F.lag("_last").over(by_slot).alias("_before"))
    )
    inside = Window.partitionBy("_slot", *keys).orderBy(at)
    return lines.join(opening, ["_slot", *keys]).select(
        *rows.columns, F.coalesce(F.lag(column).over(inside), F.col("_before")).alias(f"previous_{column}")
    )


def numbered(rows: DataFrame, keys: Sequence[str], at: str, tie: Sequence[str] = (), grain: str = "hour") -> DataFrame:
    """Add ``rn``, the place of each row within its key by ``at`` and ``tie``, counted slot by slot."""
    keys = list(keys)
    lines = (
        _complete(rows, [*keys, at])
        .withColumn("_slot", GRAINS[grain](F.col(at)))
        .where(F.col("_slot").isNotNull())
    )
    passed = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        lines.groupBy("_slot", *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slot", *keys, F.coalesce(F.sum("_n").over(passed), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_slot", *keys).orderBy(at, *tie)
    return lines.join(opening, ["_slot", *keys]).select(
        *rows.columns, (F.col("_before") + F.row_number().over(inside)).alias("rn")
    )


def totals_before(
    rows: DataFrame, probes: DataFrame, keys: Sequence[str], at: str, measures: Sequence[str]
) -> DataFrame:
    """``probes`` with the sums of ``measures`` over the rows of the same keys strictly before ``at``.

    One walk per key, for keys that hold little each, as the days of one stay date or the bookings of one day.
    """
    keys = list(keys)
    more = [c for c in probes.columns if c not in (*keys, at)]
    types = dict(probes.dtypes)
    lines = (
        _complete(rows, [*keys, at])
        .select(
            *keys,
            at,
            F.lit(ROW).alias("_kind"),
            *[F.lit(None).cast(types[c]).alias(c) for c in more],
            *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(f"_{m}") for m in measures],
        )
        .unionByName(
            _complete(probes, [*keys, at]).select(
                *keys, at, F.lit(UPPER).alias("_kind"), *more, *[F.lit(0).cast("long").alias(f"_{m}") for m in measures]
            )
        )
        .withColumn("_walk", F.xxhash64(*keys))
        .repartition("_walk")
    )
    # Probes sort before rows of the same instant, so a row at the bound is not yet counted.
    so_far = (
        Window.partitionBy("_walk", *keys).orderBy(at, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        lines.select("_walk", *probes.columns, "_kind", *[F.sum(f"_{m}").over(so_far).alias(m) for m in measures])
        .where(F.col("_kind") != ROW)
        .drop("_kind", "_walk")
    )


def latest_before(
    rows: DataFrame,
    probes: DataFrame,
    keys: Sequence[str],
    at: str,
    moment: str,
    payload: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """``probes`` with ``at`` and ``payload`` of the latest row of the same keys up to ``moment``; those without one drop out.

    Among rows of one instant the greatest ``(tie, payload)`` wins. One shuffle and one walk per key, for keys that hold
    little each, as the changes of one room and stay date; ``nearest_row`` is for keys that hold much.
    """
    keys = list(keys)
    types, row_types = dict(probes.dtypes), dict(rows.dtypes)
    more = [c for c in probes.columns if c not in keys]
    seen = {f"_tie_{c}": c for c in tie} | {f"_own_{c}": c for c in (at, *payload)}
    lines = (
        _complete(rows, [*keys, at])
        .select(
            *keys,
            F.col(at).alias("_at"),
            F.lit(ROW).alias("_kind"),
            *[F.lit(None).cast(types[c]).alias(c) for c in more],
            *[F.col(c).alias(name) for name, c in seen.items()],
        )
        .unionByName(
            _complete(probes, [*keys, moment]).select(
                *keys,
                F.col(moment).alias("_at"),
                F.lit(ROW + 1).alias("_kind"),
                *more,
                *[F.lit(None).cast(row_types[c]).alias(name) for name, c in seen.items()],
            )
        )
        .withColumn("_walk", F.xxhash64(*keys))
        .repartition("_walk")
    )
    # Probes sort after rows of the same instant, which count.
    order = ["_at", "_kind", *[f"_tie_{c}" for c in tie], *[f"_own_{c}" for c in payload]]
    so_far = Window.partitionBy("_walk", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.struct(*[F.col(f"_own_{c}").alias(c) for c in (at, *payload)])
    found = F.last(F.when(F.col("_kind") == ROW, row), ignorenulls=True).over(so_far).alias("_found")
    return (
        lines.select("_kind", *probes.columns, found)
        .where((F.col("_kind") != ROW) & F.col("_found").isNotNull())
        .select(*probes.columns, "_found.*")
    )


def day_span_totals(
    rows: DataFrame, spans: DataFrame, keys: Sequence[str], day: str, first: str, last: str, measures: Sequence[str]
) -> DataFrame:
    """Sums over the rows with ``first <= day < last``, per distinct (keys, first, last) of ``spans``.

    For rows that are totals of days already: a walk has no more lines than the calendar has days, however busy the key is.
    """
    keys = list(keys)
    bounds = F.array(
        F.struct(F.col(first).alias("_at"), F.lit(-1).alias("_sign")),
        F.struct(F.col(last).alias("_at"), F.lit(1).alias("_sign")),
    )
    ends = spans.select(*keys, F.col(first).alias("_first"), F.col(last).alias("_last"), F.explode(bounds).alias("_b")).select(
        *keys, "_first", "_last", "_b.*"
    )
    sums = totals_before(rows.select(*keys, F.col(day).alias("_at"), *measures), ends, keys, "_at", measures)
    return (
        sums.groupBy(*keys, "_first", "_last")
        .agg(*[F.sum(F.col(m) * F.col("_sign")).alias(m) for m in measures])
        .withColumnsRenamed({"_first": first, "_last": last})
    )


def daily_window_totals(
    rows: DataFrame, probes: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], days: int
) -> DataFrame:
    """Sums over the ``days`` days before each distinct (key, day) probe, the day itself left out.

    One row per key and calendar day reaches the window, however busy the key is.
    """
    keys = list(keys)
    rows = _complete(rows, [*keys, day])
    probes = _complete(probes, [*keys, day])
    per_day = (
        rows.select(
            *keys, day, F.lit(0).alias("_asked"), *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in measures]
        )
        .unionByName(
            probes.select(*keys, day, F.lit(1).alias("_asked"), *[F.lit(0).cast("long").alias(m) for m in measures])
        )
        .groupBy(*keys, day)
        .agg(F.max("_asked").alias("_asked"), *[F.sum(m).alias(m) for m in measures])
    )
    before = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    return (
        per_day.select(*keys, day, "_asked", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(m) for m in measures])
        .where("_asked = 1")
        .drop("_asked")
    )
