"""Ordered series without one task per series.

A window over ``partitionBy(symbol)`` sends a whole series to one task, so one symbol that holds a
third of all rows would decide the run time. Everything here works on *pieces* of a series instead:

* **Buckets** cut a series along its time axis. A bucket spans ``slots`` steps of the time grid, and
  (key, order) is unique on that grid, so a bucket holds at most ``slots`` rows, whatever the data.
  Prefix operators (row number, running total, exponential average, carry forward and back) run
  inside the bucket; what a bucket needs from the ones before it comes from a summary with one row
  per bucket, joined back on (key, bucket). The summary is scanned by levels: where the time axis has
  room for more than ``fan`` buckets, groups of ``fan`` of them are summed up, the groups are scanned
  in the same way, and each group starts from what came before it. So no task orders and no array
  holds more than ``fan`` summary rows, however fine the grid and however long the series.
* **Blocks** cut a series by row position. Every block also gets the few rows before and after it
  that a finite frame can reach, so ``lag``, ``lead`` and ``rolling(n)`` are exact inside it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BUCKET = "_bucket"
BLOCK = "_block"
OWN = "_own"
POSITION = "row_pos"
TOTAL = "row_total"

DAY_SECONDS = 86_400
MAX_DOUBLE_EXPONENT = 600.0  # e^600 leaves room for the values themselves in a double
TIME_AXIS_SECONDS = 9_999 * 366 * DAY_SECONDS  # years 1 to 9999, where dates and timestamps lie


@dataclass(frozen=True)
class Series:
    """How rows form series: the key columns, the order column and its time grid.

    ``order`` is a DATE when ``step_seconds`` is one day, otherwise a TIMESTAMP of which at most
    one row per key falls into each step. ``fan`` bounds the summary rows that are scanned together.
    """

    keys: tuple[str, ...] = ("symbol",)
    order: str = "date"
    step_seconds: int = DAY_SECONDS
    slots: int = 1024
    fan: int = 4096

    def bucket(self) -> Column:
        if self.step_seconds == DAY_SECONDS:
            tick = F.unix_date(F.col(self.order))
        else:
            tick = F.floor(F.unix_seconds(F.col(self.order).cast("timestamp")) / self.step_seconds)
        return F.floor(tick / self.slots).cast("long")

    @property
    def piece(self) -> list[str]:
        return [*self.keys, BUCKET]

    def in_bucket(self) -> WindowSpec:
        return Window.partitionBy(*self.piece).orderBy(self.order)

    @property
    def buckets(self) -> int:
        """Buckets that the time axis has room for."""
        return -(-TIME_AXIS_SECONDS // (self.step_seconds * self.slots))


DAILY = Series()


def _with_summary(pieces: DataFrame, summary: DataFrame, series: Series) -> DataFrame:
    """Join one summary row per bucket back onto the rows of the bucket.

    The rows lie sorted by (key, bucket) after their window, so a merge join moves only the summary;
    the hint keeps the planner from broadcasting the rows instead when there are few of them.
    """
    return pieces.join(summary.hint("merge"), series.piece)


def _bucketed(df: DataFrame, series: Series) -> DataFrame:
    return df.withColumn(BUCKET, series.bucket())


@dataclass(frozen=True)
class Scan:
    """What to carry along the places (buckets, or groups of them) of a series, from and to which columns.

    ``before``: the sum over earlier places (``_before_c``). ``whole``: the sum over all places
    (``_whole_c``). ``last`` and ``next``: the nearest value that is not null in earlier and in later
    places (``_last_c``, ``_next_c``). ``decays``: for a name k with the rate r, a place with ``n`` rows
    maps an average x to r^n * x + ``_end_k``; ``_carry_k`` is the average on entry, and the first
    place is entered with its ``_start_k``.
    """

    before: tuple[str, ...] = ()
    whole: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    next: tuple[str, ...] = ()
    decays: Mapping[str, float] = field(default_factory=dict)

    @property
    def made(self) -> list[str]:
        return [f"_{kind}_{c}" for kind in ("before", "whole", "last", "next") for c in getattr(self, kind)] + [
            f"_carry_{k}" for k in self.decays]

    def along(self, summary: DataFrame, series: Series) -> DataFrame:
        """Add the carried columns to a summary with one row per bucket."""
        return self._levels(summary, series.keys, BUCKET, series.buckets, series.fan)

    def _levels(self, summary: DataFrame, keys: tuple[str, ...], place: str, places: int, fan: int) -> DataFrame:
        if places <= fan:
            return self._within(summary, keys, place)
        above = f"{place}_above"
        lower = summary.withColumn(above, F.floor(F.col(place) / fan).cast("long"))
        groups = lower.groupBy(*keys, above).agg(*self._of_group(place))
        known = self._levels(groups, keys, above, -(-places // fan), fan).select(
            *keys, above, *[F.col(c).alias(f"_above{c}") for c in self.made])
        entered = lower.join(known, [*keys, above]).withColumns(
            {f"_start_{k}": F.col(f"_above_carry_{k}") for k in self.decays})
        inside = self._within(entered, (*keys, above), place)
        return inside.withColumns({
            **{f"_before_{c}": F.col(f"_above_before_{c}") + F.col(f"_before_{c}") for c in self.before},
            **{f"_whole_{c}": F.col(f"_above_whole_{c}") for c in self.whole},
            **{f"_{kind}_{c}": F.coalesce(F.col(f"_{kind}_{c}"), F.col(f"_above_{kind}_{c}"))
               for kind in ("last", "next") for c in getattr(self, kind)},
        }).drop(above, *[f"_above{c}" for c in self.made])

    def _of_group(self, place: str) -> list[Column]:
        """A group of places summed up, under the names that a place has."""
        summed = dict.fromkeys([*self.before, *self.whole, *(["n"] if self.decays else [])])
        found = [F.sum(c).alias(c) for c in summed]
        found += [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(place))).alias(c) for c in self.last]
        found += [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(place))).alias(c) for c in self.next]
        line = F.sort_array(F.collect_list(F.struct(place, "n", *[f"_end_{k}" for k in self.decays]))) if self.decays else None
        for k, r in self.decays.items():
            found += [F.aggregate(line, F.lit(0.0), _through(k, r)).alias(f"_end_{k}"),
                      F.min_by(f"_start_{k}", place).alias(f"_start_{k}")]
        return found

    def _within(self, summary: DataFrame, keys: tuple[str, ...], place: str) -> DataFrame:
        """The scan over the few places of each key."""
        whole = Window.partitionBy(*keys)
        earlier, later = (
            whole.orderBy(turn(place)).rowsBetween(Window.unboundedPreceding, -1) for turn in (F.asc, F.desc))
        scanned = summary.withColumns({
            **{f"_before_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in self.before},
            **{f"_whole_{c}": F.sum(c).over(whole) for c in self.whole},
            **{f"_last_{c}": F.last(c, ignorenulls=True).over(earlier) for c in self.last},
            **{f"_next_{c}": F.last(c, ignorenulls=True).over(later) for c in self.next},
        })
        return _fold_averages(scanned, keys, place, self.decays) if self.decays else scanned


def _through(name: str, rate: float) -> Callable[[Column, Column], Column]:
    """The average at the end of a place from the one on entry."""
    return lambda c, at: at[f"_end_{name}"] + F.pow(F.lit(rate), at["n"]) * c


def _bucket_offsets(counts: DataFrame, series: Series) -> DataFrame:
    """From (keys, bucket, n): rows in earlier buckets, and rows in the whole series."""
    return Scan(before=("n",), whole=("n",)).along(counts, series).withColumnsRenamed(
        {"_before_n": "_before", "_whole_n": TOTAL})


# ---------------------------------------------------------------- row position

def number_rows(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Add ``row_pos`` (0-based position in the series) and ``row_total`` (rows in the series)."""
    pieces = _bucketed(df, series)
    offsets = _bucket_offsets(
        pieces.groupBy(*series.piece).agg(F.count(F.lit(1)).alias("n")), series
    )
    numbered = pieces.withColumn("_rank", F.row_number().over(series.in_bucket()))
    return (
        _with_summary(numbered, offsets.select(*series.piece, "_before", TOTAL), series)
        .withColumn(POSITION, F.col("_before") + F.col("_rank") - 1)
        .drop(BUCKET, "_rank", "_before")
    )


def last_rows(df: DataFrame, n: int, series: Series = DAILY) -> DataFrame:
    """The newest ``n`` rows of every series, with ``recency`` 1 for the newest."""
    numbered = number_rows(df, series)
    return (
        numbered.withColumn("recency", F.col(TOTAL) - F.col(POSITION))
        .filter(F.col("recency") <= n)
        .drop(POSITION, TOTAL)
    )


# ---------------------------------------------------------------- carry forward / back

def with_previous(df: DataFrame, values: Mapping[str, Column], series: Series = DAILY) -> DataFrame:
    """For each name: the newest non-null value of the expression strictly before the row."""
    return with_neighbours(df, values, {}, series)


def with_next(df: DataFrame, values: Mapping[str, Column], series: Series = DAILY) -> DataFrame:
    """For each name: the nearest non-null value of the expression strictly after the row."""
    return with_neighbours(df, {}, values, series)


def with_neighbours(
    df: DataFrame, previous: Mapping[str, Column], following: Mapping[str, Column],
    series: Series = DAILY,
) -> DataFrame:
    """``with_previous`` and ``with_next`` in one go: one bucket summary, one join."""
    order = F.col(series.order)
    pieces = _bucketed(df, series)
    edges, near = [], {}
    # Backward means the same running frame over the reversed order.
    for values, turn, edge in ((previous, F.asc, F.max_by), (following, F.desc, F.min_by)):
        inner = Window.partitionBy(*series.piece).orderBy(turn(series.order)).rowsBetween(
            Window.unboundedPreceding, -1)
        for name, value in values.items():
            edges.append(edge(value, F.when(value.isNotNull(), order)).alias(f"edge_{name}"))
            near[f"_near_{name}"] = F.last(value, ignorenulls=True).over(inner)
    scan = Scan(last=tuple(f"edge_{k}" for k in previous), next=tuple(f"edge_{k}" for k in following))
    carry = {k: f"_{kind}_edge_{k}" for kind, values in (("last", previous), ("next", following)) for k in values}
    summary = scan.along(pieces.groupBy(*series.piece).agg(*edges), series).select(*series.piece, *carry.values())
    joined = _with_summary(pieces.withColumns(near), summary, series)
    return joined.withColumns(
        {k: F.coalesce(F.col(f"_near_{k}"), F.col(c)) for k, c in carry.items()}
    ).drop(BUCKET, *near, *carry.values())


# ---------------------------------------------------------------- running total

def with_running_total(df: DataFrame, totals: Mapping[str, Column], series: Series = DAILY) -> DataFrame:
    """For each name: the sum of the expression over the series up to and including the row."""
    pieces = _bucketed(df, series)
    upto = series.in_bucket().rowsBetween(Window.unboundedPreceding, 0)
    sums = pieces.groupBy(*series.piece).agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"sum_{k}") for k, v in totals.items()])
    offsets = Scan(before=tuple(f"sum_{k}" for k in totals)).along(sums, series).select(
        *series.piece, *[F.col(f"_before_sum_{k}").alias(f"_before_{k}") for k in totals])
    local = pieces.withColumns({f"_upto_{k}": F.sum(v).over(upto) for k, v in totals.items()})
    return (
        _with_summary(local, offsets, series)
        .withColumns({
            k: F.coalesce(F.col(f"_before_{k}"), F.lit(0)) + F.coalesce(F.col(f"_upto_{k}"), F.lit(0))
            for k in totals
        })
        .drop(BUCKET, *[f"_before_{k}" for k in totals], *[f"_upto_{k}" for k in totals])
    )


# ---------------------------------------------------------------- exponential average, volume balance

def _filled(column: str) -> Column:
    """The column itself; a null is an error, because it would count as zero in a running sum."""
    value = F.col(column)
    message = F.lit(f"{column} must be filled before a running operator")
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def with_scans(
    df: DataFrame,
    spans: Mapping[str, int],
    value: str = "close",
    balance: tuple[str, str] | None = None,
    series: Series = DAILY,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Add recursive exponential averages and, optionally, the on-balance volume.

    ``spans`` maps an output name to its span: y0 = x0, y = a*x + (1-a)*y_prev, a = 2/(span+1).
    ``balance = (output, volume)`` adds the running sum of sign(change of value) * volume.
    ``row_pos`` and ``row_total`` come along, as the same bucket summary yields them.
    ``seed`` continues earlier output: its newest row per series, with the columns made here.

    The recursion is an affine map, and affine maps compose. With r = 1-a and c the average at the
    end of the bucket before, row j of a bucket has y_j = sum(a * x_i * r^(j-i)) + r^(j+1) * c. The
    sum is a running sum of x_i * r^-i scaled by a * r^j, and c is folded along the bucket summaries.
    The first bucket starts from c = x0, which gives y0 = x0.
    """
    slots = series.slots
    decays = {}
    for name, span in spans.items():
        if span < 1:
            raise ValueError(f"span of {name} must be at least 1, got {span}")
        if span > 1:
            decays[name] = 1.0 - 2.0 / (span + 1.0)
            slots = min(slots, int(MAX_DOUBLE_EXPONENT / -math.log(decays[name])))
    if slots != series.slots:
        series = replace(series, slots=slots)
    inner = series.in_bucket()
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    rank = F.col("_rank")

    pieces = (
        _bucketed(df, series)
        .withColumn("_x", _filled(value).cast("double"))
        .withColumn("_rank", F.row_number().over(inner) - 1)
    )
    if balance:
        signed = F.signum(F.col("_x") - F.lag("_x").over(inner)) * F.col(balance[1])
        pieces = pieces.withColumn("_signed", F.coalesce(signed, F.lit(0.0)))

    # One row per bucket: its size, its own part of every recursion, its edges.
    parts = [F.count(F.lit(1)).alias("n"), F.min_by("_x", series.order).alias("_first")]
    for name, r in decays.items():
        parts.append(F.sum(F.col("_x") * F.pow(F.lit(r), -rank)).alias(f"_sum_{name}"))
    if balance:
        parts += [
            F.sum("_signed").alias("_signed"),
            F.max_by("_x", series.order).alias("_last"),
            F.min_by(F.col(balance[1]), series.order).alias("_first_volume"),
        ]
    summary = Scan(before=("n",), whole=("n",), last=("_last",) if balance else ()).along(
        pieces.groupBy(*series.piece).agg(*parts), series
    ).withColumnsRenamed({"_before_n": "_before", "_whole_n": TOTAL})
    summary = summary.withColumns({
        f"_end_{k}": F.lit(1 - r) * F.pow(F.lit(r), F.col("n") - 1) * F.col(f"_sum_{k}")
        for k, r in decays.items()
    })
    start = {k: F.col("_first") for k in decays}
    before, start_value, start_balance = F.lit(0), F.lit(None).cast("double"), F.lit(0.0)
    if seed is not None:
        known = [POSITION, value, *decays, *([balance[0]] if balance else [])]
        summary = summary.join(
            seed.select(*series.keys, *[F.col(c).alias(f"_seed_{c}") for c in known]),
            list(series.keys), "left",
        )
        start = {k: F.coalesce(F.col(f"_seed_{k}"), F.col("_first")) for k in decays}
        before = F.coalesce(F.col(f"_seed_{POSITION}") + 1, F.lit(0))
        start_value = F.col(f"_seed_{value}")
        if balance:
            start_balance = F.coalesce(F.col(f"_seed_{balance[0]}"), F.lit(0.0))
    summary = summary.withColumns({
        "_before": F.col("_before") + before,
        TOTAL: F.col(TOTAL) + before,
        **{f"_start_{k}": v for k, v in start.items()},
    })
    keep = ["_before", TOTAL]
    if balance:
        # The first change of a bucket needs the last value of the bucket before it.
        last = F.coalesce(F.col("_last__last"), start_value)
        step = F.signum(F.col("_first") - last) * F.col("_first_volume")
        summary = summary.withColumn("_step", F.coalesce(step, F.lit(0.0))).withColumn(
            "_moved", F.col("_signed") + F.col("_step"))
    summary = Scan(before=("_moved",) if balance else (), decays=decays).along(summary, series)
    if balance:
        summary = summary.withColumn("_balance", start_balance + F.col("_before__moved") + F.col("_step"))
        keep.append("_balance")
    summary = summary.select(*series.piece, *keep, *[f"_carry_{k}" for k in decays])

    local = {
        f"_upto_{k}": F.sum(F.col("_x") * F.pow(F.lit(r), -rank)).over(upto)
        for k, r in decays.items()
    }
    if balance:
        local["_upto_balance"] = F.sum("_signed").over(upto)
    columns = {POSITION: F.col("_before") + rank}
    for name in spans:
        r = decays.get(name)
        columns[name] = F.col("_x") if r is None else (
            F.lit(1 - r) * F.pow(F.lit(r), rank) * F.col(f"_upto_{name}")
            + F.pow(F.lit(r), rank + 1) * F.col(f"_carry_{name}")
        )
    if balance:
        columns[balance[0]] = F.col("_balance") + F.col("_upto_balance")
    result = _with_summary(pieces.withColumns(local), summary, series).withColumns(columns)
    extra = [c for c in result.columns if c not in df.columns]
    return result.select(*df.columns, *[c for c in extra if not c.startswith("_")])


def _fold_averages(
    summary: DataFrame, keys: tuple[str, ...], place: str, decays: Mapping[str, float]
) -> DataFrame:
    """Carry every average along the places of each key, of which there are no more than the fan."""
    rest = [c for c in summary.columns if c not in keys and c != place]
    folded = summary.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(place, *rest))).alias("_line"))
    line = F.col("_line")

    def carries(name: str, r: float) -> Column:
        start = F.struct(
            line[0][f"_start_{name}"].alias("c"), F.array().cast("array<double>").alias("seen")
        )

        through = _through(name, r)

        def advance(state: Column, x: Column) -> Column:
            return F.struct(
                through(state["c"], x).alias("c"),
                F.concat(state["seen"], F.array(state["c"])).alias("seen"),
            )

        return F.aggregate(line, start, advance, lambda state: state["seen"])

    folded = folded.withColumns({f"_carry_{k}": carries(k, r) for k, r in decays.items()})
    zipped = F.arrays_zip("_line", *[f"_carry_{k}" for k in decays])
    exploded = folded.select(*keys, F.explode(zipped).alias("_z"))
    return exploded.select(
        *keys,
        *[F.col(f"_z._line.{c}").alias(c) for c in (place, *rest)],
        *[F.col(f"_z._carry_{k}").alias(f"_carry_{k}") for k in decays],
    )


# ---------------------------------------------------------------- finite frames

RADIX = 4


def _powers(n: int) -> list[int]:
    """Powers of RADIX up to ``n``."""
    found = [1]
    while found[-1] * RADIX <= n:
        found.append(found[-1] * RADIX)
    return found


def _tiles(n: int) -> list[tuple[int, int]]:
    """A frame of ``n`` rows as (size, rows back) of side-by-side partial frames."""
    tiles, back = [], 0
    for size in reversed(_powers(n)):
        while n - back >= size:
            tiles.append((size, back))
            back += size
    return tiles


def _cover(n: int) -> list[tuple[int, int]]:
    """A frame of ``n`` rows as (size, rows back) of partial frames that may overlap."""
    size = _powers(n)[-1]
    return [(size, min(back, n - size)) for back in range(0, n, size)]


class Frames:
    """Collects finite-frame expressions and evaluates them with a handful of projections.

    ``lag``/``lead`` look at input columns, ``row`` adds arithmetic on them, and the rolling
    functions run over input or ``row`` columns. All return column references to use in ``out``.
    Asking twice for the same thing computes it once.

    A rolling value over ``n`` rows is put together from partial frames of 1, 4, 16, ... rows that end
    at or before the row, each made of four smaller ones. That takes a few lags per row where a sliding
    frame would visit ``n`` rows, and as nothing is ever subtracted it stays as exact. A partial frame
    with a null or a missing row is null, so a value exists only where all ``n`` rows have one: the
    full-window rule.
    """

    def __init__(self, keys: tuple[str, ...]):
        self._window = Window.partitionBy(*keys, BLOCK).orderBy(POSITION)
        self._near: dict[str, Column] = {}
        self._row: dict[str, Column] = {}
        self._levels: dict[str, dict[str, int]] = {}
        self._lagged: dict[str, Column] = {}
        self._rolled: dict[str, Column] = {}
        self._out: dict[str, Column] = {}
        self._kept = F.col(OWN)

    def lag(self, column: str, k: int = 1) -> Column:
        return self._add(self._near, f"_{column}_lag_{k}", F.lag(column, k).over(self._window))

    def lead(self, column: str, k: int = 1) -> Column:
        return self._add(self._near, f"_{column}_lead_{k}", F.lead(column, k).over(self._window))

    def row(self, name: str, expression: Column) -> str:
        self._row[name] = expression
        return name

    def mean(self, column: str, n: int) -> Column:
        name = f"_mean_{column}_{n}"
        if name not in self._rolled:
            parts = [self._part("sum", column, size, back) for size, back in _tiles(n)]
            total = parts[0]
            for part in parts[1:]:
                total = total + part
            self._rolled[name] = total / n
        return F.col(name)

    def std(self, column: str, n: int) -> Column:
        """Sample deviation, from the spread inside the parts and between their means."""
        if n < 2:
            raise ValueError("a deviation needs at least two rows")
        name = f"_std_{column}_{n}"
        if name not in self._rolled:
            tiles = _tiles(n)
            means = [self._part("sum", column, size, back) / size for size, back in tiles]
            spread = _between(means, [size for size, _ in tiles])
            for size, back in tiles:
                if size > 1:
                    spread = spread + self._part("dev", column, size, back)
            self._rolled[name] = F.sqrt(spread / (n - 1))
        return F.col(name)

    def min(self, column: str, n: int) -> Column:
        return self._extreme("min", column, n)

    def max(self, column: str, n: int) -> Column:
        return self._extreme("max", column, n)

    def out(self, name: str, expression: Column) -> None:
        self._out[name] = expression

    def require(self, condition: Column) -> None:
        """Return only rows that meet the condition."""
        self._kept = self._kept & condition

    def apply(self, df: DataFrame, keep: list[str]) -> DataFrame:
        for stage in (self._near, self._row):
            if stage:
                df = df.withColumns(stage)
        for size in _powers(max((top for kinds in self._levels.values() for top in kinds.values()), default=1)):
            level = {
                f"_{kind}{size}_{column}": self._grown(kind, column, size)
                for column, kinds in self._levels.items()
                for kind, top in kinds.items()
                if size <= top and not (kind == "dev" and size == 1)
            }
            if level:
                df = df.withColumns(level)
        for stage in (self._lagged, self._rolled):
            if stage:
                df = df.withColumns(stage)
        return df.filter(self._kept).select(
            *keep, *[v.alias(k) for k, v in self._out.items() if k not in keep]
        )

    @staticmethod
    def _add(stage: dict[str, Column], name: str, expression: Column) -> Column:
        stage[name] = expression
        return F.col(name)

    def _need(self, kind: str, column: str, size: int) -> None:
        kinds = self._levels.setdefault(column, {})
        kinds[kind] = max(kinds.get(kind, 1), size)

    def _part(self, kind: str, column: str, size: int, back: int) -> Column:
        """The partial frame of ``size`` rows that ends ``back`` rows before the current one."""
        self._need(kind, column, size)
        if kind == "dev":
            self._need("sum", column, size)
        name = f"_{kind}{size}_{column}"
        if back == 0:
            return F.col(name)
        return self._add(self._lagged, f"{name}_back_{back}", F.lag(name, back).over(self._window))

    def _grown(self, kind: str, column: str, size: int) -> Column:
        """A partial frame of ``size`` rows from RADIX frames of a quarter of them."""
        if size == 1:
            return F.col(column).cast("double")
        quarter = size // RADIX

        def parts(of: str) -> list[Column]:
            name = f"_{of}{quarter}_{column}"
            return [F.col(name), *[F.lag(name, i * quarter).over(self._window) for i in range(1, RADIX)]]

        if kind in ("min", "max"):
            return _known_extreme(kind, parts(kind))
        sums = parts("sum")
        if kind == "sum":
            return (sums[0] + sums[1]) + (sums[2] + sums[3])
        spread = _between([part / quarter for part in sums], [quarter] * RADIX)
        for part in parts("dev") if quarter > 1 else []:
            spread = spread + part
        return spread

    def _extreme(self, kind: str, column: str, n: int) -> Column:
        name = f"_{kind}_{column}_{n}"
        if name not in self._rolled:
            parts = [self._part(kind, column, size, back) for size, back in _cover(n)]
            self._rolled[name] = _known_extreme(kind, parts)
        return F.col(name)


def _between(means: list[Column], sizes: list[int]) -> Column:
    """Squared deviations between parts of these means and sizes.

    Taken relative to the first mean: equal means give exactly zero, and no large squares cancel.
    """
    if len(means) == 1:
        return F.when(means[0].isNotNull(), 0.0)
    squares, total = None, None
    for mean, size in zip(means[1:], sizes[1:]):
        gap = mean - means[0]
        square, weighted = size * gap * gap, size * gap
        squares = square if squares is None else squares + square
        total = weighted if total is None else total + weighted
    return F.greatest(squares - total * total / sum(sizes), F.when(squares.isNotNull(), 0.0))


def _known_extreme(kind: str, parts: list[Column]) -> Column:
    """Smallest or largest of the parts, null when one of them is (``least`` alone skips nulls)."""
    if len(parts) == 1:
        return parts[0]
    known = parts[0].isNotNull()
    for part in parts[1:]:
        known = known & part.isNotNull()
    return F.when(known, (F.least if kind == "min" else F.greatest)(*parts))


def in_blocks(
    df: DataFrame,
    compute: Callable[[Frames], None],
    before: int,
    after: int = 0,
    series: Series = DAILY,
    block: int = 1024,
) -> DataFrame:
    """Add the columns that ``compute`` puts out, working on blocks of ``block`` rows.

    A block also holds ``before``/``after`` neighbour rows: as far as ``compute`` may look. Rows are
    numbered first unless ``row_pos`` and ``row_total`` are there already.
    """
    block = max(block, before, after)
    columns = df.columns
    if POSITION not in columns:
        df = number_rows(df, series)
    home = F.floor(F.col(POSITION) / block)
    offset = F.col(POSITION) % block
    newest = F.floor((F.col(TOTAL) - 1) / block)
    targets = [home]
    if before:
        targets.append(F.when((offset >= block - before) & (home < newest), home + 1))
    if after:
        targets.append(F.when((offset < after) & (home > 0), home - 1))
    spread = df.select(
        "*", home.alias("_home"), F.explode(F.array_compact(F.array(*targets))).alias(BLOCK)
    ).withColumn(OWN, F.col(BLOCK) == F.col("_home"))
    frames = Frames(series.keys)
    compute(frames)
    return frames.apply(spread, columns)


# ---------------------------------------------------------------- calendar frames and skew-safe joins

def in_recent_days(
    df: DataFrame, values: Mapping[str, Column], days: int, series: Series = DAILY
) -> DataFrame:
    """For each name: the aggregate over the rows of the last ``days`` calendar days, this one included.

    Works per bucket; the last ``days - 1`` days of a bucket are also given to the next one.
    """
    if series.step_seconds != DAY_SECONDS or days > series.slots:
        raise ValueError("calendar frames need a daily series and a span within one bucket")
    day = F.unix_date(F.col(series.order))
    home = series.bucket()
    reached = F.floor((day + days - 1) / series.slots).cast("long")
    spread = df.select(
        "*", home.alias("_home"),
        F.explode(F.array_distinct(F.array(home, reached))).alias(BUCKET),
    )
    window = Window.partitionBy(*series.piece).orderBy(day).rangeBetween(1 - days, 0)
    return (
        spread.withColumns({k: v.over(window) for k, v in values.items()})
        .filter(F.col(BUCKET) == F.col("_home"))
        .drop(BUCKET, "_home")
    )


def spread_join(
    fact: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
    by: str = "date", salts: int | None = None,
) -> DataFrame:
    """Join per-key rows onto facts of which one key may hold a third.

    Facts of one key are dealt to ``salts`` groups by the hash of column ``by``; ``small`` (one row
    per key) is repeated once per group. Spark still picks a broadcast where ``small`` fits one.
    There are as many groups as the session has shuffle partitions (32 at least), so a key spreads over all of them.
    """
    salts = salts or max(32, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
