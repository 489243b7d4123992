"""Ordered series, laid out so that no symbol has to fit in one task.

A window partitioned by symbol alone sends a whole series to one task, so one heavy symbol would
hold up the job. Instead each series is numbered and cut into blocks of consecutive rows, and each
block also receives the few neighbouring rows (its *margin*) that its windows look at. Every bounded
window is then exact inside ``(symbol, block)``, all of them share one exchange, and the longest
unit of work is a block. Whatever is unbounded (running totals, gap filling, whole-series
statistics) goes through a small table with one row per block or per series, joined back on
``(symbol, block)``: the key the rows are already partitioned by.

Exponential averages are bounded too: after ``ln(1e-18) / ln(decay)`` rows the past weighs less
than a double can show, so that many margin rows are enough.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import staged

BLOCK_ROWS = 4096
KEYS = ("symbol",)
RN, BLK = "_rn", "_blk"

#: One calendar slice for numbering: 1024 days, or 2**20 seconds (about 12 days) for timestamps.
SLICE_DAYS = 1024
SLICE_SECONDS = 2**20


def _slice(df: DataFrame, order: str, width: float | None) -> Column:
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.floor(F.unix_date(order) / (width or SLICE_DAYS)).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        micros = F.unix_micros(F.col(order).cast("timestamp"))
        return F.floor(micros / ((width or SLICE_SECONDS) * 1e6)).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.floor(F.col(order) / (width or SLICE_DAYS)).cast("long")
    raise TypeError(f"cannot number rows by {order}: {kind.simpleString()}")


def with_ordinal(
    df: DataFrame, keys: Sequence[str] = KEYS, order: str = "date", out: str = RN, slice_width: float | None = None
) -> DataFrame:
    """Number each series 1, 2, … by ``order`` without sending a whole series to one task.

    Rows are numbered inside calendar slices; the slice sizes, one small row each, give the offset
    that the slices before add. ``(keys, order)`` must be unique and not NULL. ``slice_width`` is in
    days, seconds or units of an integer order; make it smaller for rows denser than one a second.
    ``df`` is read twice, once for its keys only: pass a table or a staged result if it is costly.
    """
    sliced = df.withColumn("_slice", _slice(df, order, slice_width))
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(order)
    return (
        sliced.withColumn("_local", F.row_number().over(inside).cast("long"))
        .join(offsets, [*keys, "_slice"])
        .withColumn(out, F.col("_before") + F.col("_local"))
        .drop("_slice", "_local", "_before")
    )


@dataclass(frozen=True)
class Series:
    """A DataFrame laid out in blocks. ``add`` extends it, ``rows`` gives the plain result."""

    df: DataFrame
    keys: tuple[str, ...]
    order: str
    block: int
    before: int = 0
    after: int = 0

    def over(self, first: int | None = None, last: int = 0) -> WindowSpec:
        """Rows ``first`` … ``last`` relative to the current one; the whole block order if None."""
        spec = Window.partitionBy(*self.keys, BLK).orderBy(RN)
        return spec if first is None else spec.rowsBetween(first, last)

    def so_far(self, backwards: bool = False) -> WindowSpec:
        """Rows of the block up to the current one, from its start or from its end."""
        by = F.desc(RN) if backwards else F.asc(RN)
        spec = Window.partitionBy(*self.keys, BLK).orderBy(by)
        return spec.rowsBetween(Window.unboundedPreceding, 0)

    def last_rows(self, n: int) -> WindowSpec:
        return self.over(-(n - 1), 0)

    def lag(self, column: str | Column, n: int = 1) -> Column:
        return F.lag(column, n).over(self.over())

    def lead(self, column: str | Column, n: int = 1) -> Column:
        return F.lead(column, n).over(self.over())

    def warm(self, n: int, value: Column, column: str | Column) -> Column:
        """``value`` once ``column`` is present in all of the last ``n`` rows, else NULL."""
        return F.when(F.count(column).over(self.last_rows(n)) == n, value)

    def add(self, columns: dict[str, Column]) -> "Series":
        return replace(self, df=self.df.withColumns(columns))

    def drop(self, *columns: str) -> "Series":
        return replace(self, df=self.df.drop(*columns))

    def staged(self) -> "Series":
        """Write the rows once, for steps that read them several times."""
        return replace(self, df=staged(self.df))

    def core(self) -> DataFrame:
        """The rows proper, without the margin copies."""
        return self.df.where(F.expr(f"({RN} - 1) div {self.block} = {BLK}"))

    def rows(self, keep_ordinal: str | None = None) -> DataFrame:
        out = self.core().drop(BLK)
        return out.withColumnRenamed(RN, keep_ordinal) if keep_ordinal else out.drop(RN)

    # -- values that cross blocks ------------------------------------------------------------

    def join_series(self, *aggregates: Column) -> "Series":
        """Add per-series aggregates to every row.

        The aggregate combines map-side; its one row per series is repeated per block, so the
        join key is ``(keys, block)`` and a heavy series stays spread out.
        """
        return self._repeat(self._lengths(*aggregates))

    def join_per_series(self, per_series: DataFrame) -> "Series":
        """Add the columns of a table with one row per series to every row."""
        return self._repeat(self._lengths().join(per_series, [*self.keys], "left"))

    def _lengths(self, *aggregates: Column) -> DataFrame:
        # the last block that holds any row, margins included
        blocks = F.expr(f"(max({RN}) - 1 + {self.before}) div {self.block}").alias("_blocks")
        return self.core().groupBy(*self.keys).agg(blocks, *aggregates)

    def _repeat(self, per_series: DataFrame) -> "Series":
        number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks")))
        repeated = per_series.withColumn(BLK, number).drop("_blocks")
        return replace(self, df=self.df.join(repeated, [*self.keys, BLK], "left"))

    def join_blocks(
        self, aggregates: Sequence[Column], carry: Callable[[WindowSpec, WindowSpec], Sequence[Column]]
    ) -> "Series":
        """Summarise each block, carry the summaries along the series, and join them back.

        ``carry(before, after)`` gets windows over the earlier and later blocks of the series and
        returns the columns to join; ``last`` is the nearest block in both. The block table has one row per ``block`` data rows.
        """
        table = self.core().groupBy(*self.keys, BLK).agg(*aggregates)
        order = Window.partitionBy(*self.keys).orderBy(BLK)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        # a growing frame over descending order: "1 to unbounded following" is rescanned per row
        after = Window.partitionBy(*self.keys).orderBy(F.desc(BLK)).rowsBetween(Window.unboundedPreceding, -1)
        table = table.select(*self.keys, BLK, *carry(before, after))
        return replace(self, df=self.df.join(table, [*self.keys, BLK], "left"))

    def running(self, how: Callable[[Column], Column], columns: dict[str, str],
                merge: Callable[[Column, Column], Column]) -> "Series":
        """Running aggregate over the whole series, e.g. ``how=F.sum`` and ``merge`` = addition.

        ``columns`` maps output name to input column. Exact on the rows proper (not on margins).
        """
        mine = F.expr(f"({RN} - 1) div {self.block} = {BLK}")
        s = self.join_blocks(
            [how(F.col(src)).alias(f"_t_{out}") for out, src in columns.items()],
            lambda before, _: [how(F.col(f"_t_{out}")).over(before).alias(f"_c_{out}") for out in columns],
        )
        s = s.add({out: how(F.when(mine, F.col(src))).over(s.so_far()) for out, src in columns.items()})
        s = s.add({
            out: F.when(F.col(f"_c_{out}").isNull(), F.col(out))
            .when(F.col(out).isNull(), F.col(f"_c_{out}"))
            .otherwise(merge(F.col(f"_c_{out}"), F.col(out)))
            for out in columns
        })
        return s.drop(*[f"_c_{out}" for out in columns])

    # -- exponential scan --------------------------------------------------------------------

    def exponential(self, steps: dict[str, tuple[Column, float]]) -> "Series":
        """``y(t) = decay * y(t-1) + step(t)`` for each ``name: (step, decay)``, in one window pass.

        ``step`` carries the seed at the first row. With weights taken from a fixed origin, ``y(t)``
        is ``decay^t`` times a running sum of ``step * decay^-t``. Where a block is too long for the
        weights to stay inside a double, the origin moves every ``span`` rows; over one span the
        past has faded to nothing, so one carried value is enough.
        """
        rows = self.block + self.before + self.after
        here = f"({RN} - 1 - {BLK} * {self.block} + {self.before})"
        plain, moving = {}, {}
        for out, (step, decay) in steps.items():
            span = 2**31 if decay <= 0 else min(max(2, int(500 / -math.log10(decay))), 2**31)
            if decay <= 0:
                plain[out] = step
            elif rows <= span:
                place = F.expr(f"{here} - {span // 2}")
                total = F.sum(step * F.pow(F.lit(decay), -place)).over(self.so_far())
                plain[out] = total * F.pow(F.lit(decay), place)
            else:
                moving[out] = (step, decay, span)
        s = self.add(plain) if plain else self
        for out, (step, decay, span) in moving.items():
            s = s._moving_origin(out, step, decay, span, here)
        return s

    def _moving_origin(self, out: str, step: Column, decay: float, span: int, here: str) -> "Series":
        half = span // 2
        s = self.add({"_part": F.expr(f"{here} div {span}"), "_place": F.expr(f"{here} % {span} - {half}"), "_u": step})
        inside = Window.partitionBy(*self.keys, BLK, "_part").orderBy(RN).rowsBetween(Window.unboundedPreceding, 0)
        weighted = F.col("_u") * F.pow(F.lit(decay), -F.col("_place"))
        s = s.add({"_y": F.sum(weighted).over(inside) * F.pow(F.lit(decay), F.col("_place"))})
        previous = Window.partitionBy(*self.keys, BLK).orderBy("_part").rangeBetween(-1, -1)
        s = s.add({"_carry": F.max_by("_y", RN).over(previous)})
        faded = F.col("_carry") * F.pow(F.lit(decay), F.col("_place") + (half + 1))
        s = s.add({out: F.col("_y") + F.coalesce(faded, F.lit(0.0))})
        return s.drop("_part", "_place", "_u", "_y", "_carry")


def memory(decay: float) -> int:
    """Rows after which an exponential average has forgotten its past to double precision."""
    return 1 if decay <= 0 else math.ceil(math.log(1e-18) / math.log(decay))


def lay_out(
    df: DataFrame,
    before: int = 0,
    after: int = 0,
    keys: Sequence[str] = KEYS,
    order: str = "date",
    block_rows: int | None = None,
    slice_width: float | None = None,
) -> Series:
    """Number the rows and place them in blocks with ``before``/``after`` margin rows each.

    By default a block is at least four times its margins, so at most a quarter of the rows is
    copied.
    """
    block = block_rows or max(BLOCK_ROWS, 4 * (before + after))
    numbered = with_ordinal(df, keys, order, slice_width=slice_width)
    index = f"({RN} - 1)"
    if before or after:
        targets = f"sequence(greatest({index} - {after}, 0) div {block}, ({index} + {before}) div {block})"
        placed = numbered.withColumn(BLK, F.explode(F.expr(targets)))
    else:
        placed = numbered.withColumn(BLK, F.expr(f"{index} div {block}"))
    return Series(placed, tuple(keys), order, block, before, after)


@dataclass(frozen=True)
class Step:
    """One computation on a laid-out series and how far it looks back and ahead, in rows."""

    build: Callable[[Series], Series]
    back: int = 0
    ahead: int = 0


def compute(
    df: DataFrame,
    *stages: Step | Sequence[Step],
    keys: Sequence[str] = KEYS,
    order: str = "date",
    block_rows: int | None = None,
    keep_ordinal: str | None = None,
    slice_width: float | None = None,
) -> DataFrame:
    """Run steps over one shared layout. Later stages may use columns of earlier ones.

    Steps within a stage are independent, so the margin is the sum over stages of the largest
    reach in each.
    """
    groups = [[g] if isinstance(g, Step) else list(g) for g in stages]
    back = sum(max((s.back for s in g), default=0) for g in groups)
    ahead = sum(max((s.ahead for s in g), default=0) for g in groups)
    series = lay_out(df, back, ahead, keys, order, block_rows, slice_width)
    for group in groups:
        for step in group:
            series = step.build(series)
    return series.rows(keep_ordinal)


# -- whole-series quantiles ----------------------------------------------------------------------


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keys: Sequence[str] = KEYS,
    order: str = "date",
    accuracy: int = 20000,
) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per series: ``<column>_q<i>``.

    A bounded sketch brackets each wanted rank; a second pass counts the rows below the bracket and
    keeps only the distinct values inside it (about 4/accuracy of the series), from which the exact
    order statistics are read. No task ever holds a series. If a bracket should ever miss its rank
    the job fails rather than give an inexact value.
    """
    keys = list(keys)
    salts = 64
    spread = F.pmod(F.xxhash64(order), F.lit(salts)).cast("int").alias("_salt")
    long = df.select(*keys, spread, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in columns
    ])).alias("_e")).select(*keys, "_salt", "_e.*").where("_x is not null and not isnan(_x)")
    slack = 2.0 / accuracy
    brackets = []
    for p in probabilities:
        brackets += [max(0.0, p - slack), min(1.0, p + slack)]
    sketch = long.groupBy(*keys, "_col").agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_x", brackets, accuracy).alias("_b"),
    )
    wanted = sketch.select(*keys, "_col", F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("_i"),
            (F.lit(float(p)) * (F.col("_n") - 1)).alias("_h"),
            F.col("_b")[2 * i].alias("_lo"),
            F.col("_b")[2 * i + 1].alias("_hi"),
        )
        for i, p in enumerate(probabilities)
    ])).alias("_w")).select(*keys, "_col", "_w.*")
    # the few rows of ``wanted`` are repeated per salt, so a heavy series joins in many tasks
    fanned = wanted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    zone = F.when(F.col("_x") < F.col("_lo"), -1).when(F.col("_x") > F.col("_hi"), 1).otherwise(0)
    tallied = (
        long.join(fanned, [*keys, "_col", "_salt"])
        .withColumn("_zone", zone)
        .groupBy(*keys, "_col", "_i", "_h", "_zone", F.when(F.col("_zone") == 0, F.col("_x")).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    )
    line = Window.partitionBy(*keys, "_col", "_i").orderBy("_zone", "_v")
    ranked = tallied.withColumn(
        "_end", F.sum("_c").over(line.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(k: Column) -> Column:
        # below the bracket only its largest value is known, above it only its smallest
        value = (
            F.when((F.col("_zone") == -1) & (F.col("_end") - 1 == k), F.col("_max"))
            .when((F.col("_zone") == 1) & (F.col("_start") == k), F.col("_min"))
            .when((F.col("_zone") == 0) & (F.col("_start") <= k) & (k < F.col("_end")), F.col("_v"))
        )
        return F.max(value)

    low = F.floor("_h")
    picked = ranked.groupBy(*keys, "_col", "_i").agg(
        at(low).alias("_a"), at(F.ceil("_h")).alias("_z"), F.max(F.col("_h") - low).alias("_f")
    )
    value = F.when(
        F.col("_a").isNull() | F.col("_z").isNull(), F.raise_error(F.lit("quantile bracket missed its rank"))
    ).otherwise(F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_f"))
    return picked.withColumn("_q", value.cast("double")).groupBy(*keys).agg(*[
        F.max(F.when((F.col("_col") == c) & (F.col("_i") == i), F.col("_q"))).alias(f"{c}_q{i}")
        for c in columns
        for i in range(len(probabilities))
    ])
