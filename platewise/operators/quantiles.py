"""Exact percentiles per key that hold when one key owns most of the rows.

Spark's own ``percentile`` is exact but keeps every value of a group in one
buffer. That is right for ordinary groups and impossible for a key with a third
of a huge table. Keys above a row limit are therefore read twice: a mergeable
quantile sketch per key brackets the wanted rank, then one scan counts the values
below the bracket and those inside by value, about a hundredth of all. The rank among
these is exact. Where more values are inside than one task may rank, the small table
of counted values is narrowed: a round counts them per bin, at most ``BINS`` rows per
key and task, and picks the bin with the rank as the next bracket. The sketch is a
promise of chance; a key whose bracket missed is narrowed over its rows instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.columns import column, columns
from platewise.operators.joins import join_null_safe
from platewise.session import materialize, settled, small_side

# Values of one key that Spark's own aggregate may buffer, about 200 MB.
MAX_GROUP_ROWS = 2_000_000
BINS = 1024
# Bins of a first round over values that are dear to compute: few values share one then.
FINE_BINS = 1 << 16
# Values in all brackets that may be written out, to be narrowed there and not computed anew.
LISTED = 200_000_000
# Size of a key's sketch, about 40 KB, and how far on both sides of the rank a bracket
# reaches, as a share of the values: over twice the sketch's error at 99 %.
SKETCH, MARGIN = 2048, 0.006

# Work columns of the narrowing state, one row per key.
_N, _K, _FRAC, _BELOW, _INSIDE = "__n", "__k", "__frac", "__below", "__inside"
_LO, _HI, _LOWER, _UPPER = "__lo", "__hi", "__lower", "__upper"
_LEAST, _MOST = "__least", "__most"
BIN, COUNT, BIN_MIN, BIN_MAX, VALUE = "__bin", "__count", "__bin_min", "__bin_max", "__value"
BRACKET = (_LO, _HI)

Histogram = Callable[[DataFrame, int, bool], DataFrame]
Values = Callable[[DataFrame, int], DataFrame]


def start_state(sizes: DataFrame, p: float, counted: bool = False) -> DataFrame:
    """Narrowing state from keys with ``__n`` values between ``__lo`` and ``__hi``.

    ``counted`` says that ``__below`` and ``__inside`` are there already.
    """
    if not counted:
        sizes = sizes.withColumn(_BELOW, F.lit(0).cast("long")).withColumn(_INSIDE, F.col(_N))
    position = F.lit(float(p)) * (F.col(_N) - 1)
    flat = F.col(_LO) == F.col(_HI)
    return (
        sizes.withColumn(_K, F.floor(position).cast("long"))
        .withColumn(_FRAC, position - F.floor(position))
        .withColumn(_LOWER, F.when(flat, F.col(_LO)))
        .withColumn(_UPPER, F.when(flat, F.col(_HI)))
    )


def _upper_rank() -> Column:
    return F.col(_K) + F.when(F.col(_FRAC) > 0, 1).otherwise(0)


def _checked(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless a bracket holds as many values as were counted when it was made.

    Values that are computed anew each round could differ between machines in the
    last bit and leave their bracket; then no exact rank can be given.
    """
    counted = F.sum(COUNT).over(Window.partitionBy(*columns(keys)))
    lost = F.raise_error(F.lit("values of a bracket changed between two readings"))
    return placed.withColumn(_K, F.when(counted == F.col(_INSIDE), F.col(_K)).otherwise(lost))


def _advance(state: DataFrame, counts: DataFrame, keys: Sequence[str], hot: int) -> DataFrame:
    """Move every bracket onto the bin that holds the wanted rank."""
    # At most BINS rows per key, so the window is bounded.
    running = Window.partitionBy(*columns(keys)).orderBy(BIN)
    start = F.sum(COUNT).over(running) - F.col(COUNT) + F.col(_BELOW)
    carried = [_N, _K, _FRAC, _BELOW, _INSIDE]
    placed = join_null_safe(
        counts, small_side(state.select(*columns(keys), *carried), hot), keys
    ).withColumn("__start", start)
    end = F.col("__start") + F.col(COUNT)

    def holds(rank: Column) -> Column:
        return (F.col("__start") <= rank) & (rank < end)

    placed = _checked(placed, keys)

    here, there = holds(F.col(_K)), holds(_upper_rank())
    moved = placed.groupBy(*columns(keys)).agg(
        *[F.first(c).alias(c) for c in (_N, _K, _FRAC)],
        F.max(F.when(here, F.col("__start"))).alias(_BELOW),
        F.max(F.when(here, F.col(COUNT))).alias(_INSIDE),
        F.max(F.when(here, F.col(BIN_MIN))).alias(_LO),
        F.max(F.when(here, F.col(BIN_MAX))).alias(_HI),
        F.max(F.when(here & there, F.lit(True))).alias("__same"),
        F.max(F.when(there, F.col(BIN_MIN))).alias("__next"),
    )
    # Ranks in two bins are neighbours: the largest value below meets the smallest above.
    flat = F.col(_LO) == F.col(_HI)
    same = F.col("__same").isNotNull()
    return (
        moved.withColumn(_LOWER, F.when(~same | flat, F.col(_HI)))
        .withColumn(_UPPER, F.when(~same, F.col("__next")).when(flat, F.col(_HI)))
        .drop("__same", "__next")
    )


def _rank_directly(state: DataFrame, values: DataFrame, keys: Sequence[str], hot: int) -> DataFrame:
    """Finish brackets that hold few distinct values by ranking these."""
    counted = values.groupBy(*columns(keys), VALUE).agg(F.sum(COUNT).alias(COUNT))
    running = Window.partitionBy(*columns(keys)).orderBy(VALUE)
    placed = join_null_safe(
        counted, small_side(state.select(*columns(keys), _K, _FRAC, _BELOW, _INSIDE), hot), keys
    ).withColumn("__start", F.sum(COUNT).over(running) - F.col(COUNT) + F.col(_BELOW))
    placed = _checked(placed, keys)
    end = F.col("__start") + F.col(COUNT)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__start") <= rank) & (rank < end), F.col(VALUE)))

    return placed.groupBy(*columns(keys)).agg(
        F.first(_FRAC).alias(_FRAC),
        at(F.col(_K)).alias(_LOWER),
        at(_upper_rank()).alias(_UPPER),
    )


def _over_listed(counted: DataFrame, keys: Sequence[str]) -> tuple[Histogram, Values]:
    """The two readings of ``narrow`` over a table of values and their counts."""

    def inside(state: DataFrame, hot: int) -> DataFrame:
        brackets = small_side(state.select(*columns(keys), *BRACKET), hot)
        return join_null_safe(counted, brackets, keys).where(F.col(VALUE).between(F.col(_LO), F.col(_HI)))

    def histogram(state: DataFrame, hot: int, first: bool) -> DataFrame:
        bin_ = _bin(F.col(VALUE), F.col(_LO), F.col(_HI), first).alias(BIN)
        return (
            inside(state, hot)
            .groupBy(*columns(keys), bin_)
            .agg(F.sum(COUNT).alias(COUNT), F.min(VALUE).alias(BIN_MIN), F.max(VALUE).alias(BIN_MAX))
        )

    def values(state: DataFrame, hot: int) -> DataFrame:
        return inside(state, hot).select(*columns(keys), VALUE, COUNT)

    return histogram, values


def narrow(
    state: DataFrame,
    keys: Sequence[str],
    alias: str,
    histogram: Histogram,
    values: Values,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Run narrowing rounds until every key is solved; returns keys and ``alias``.

    ``histogram(state, hot, first)`` counts the values in each bracket per bin,
    ``values(state, hot)`` lists the values in each bracket with their counts. Once the
    brackets hold few enough in all, their values are written out and narrowed there,
    so a source that is dear to compute is read twice, whatever its size.
    """
    done = []
    result = [*columns(keys), _FRAC, _LOWER, _UPPER]
    first, left, listed = True, None, False
    while True:
        state, _ = settled(state, "brackets")
        done.append(state.where(F.col(_LOWER).isNotNull()).select(*result))
        state = state.where(F.col(_LOWER).isNull())
        hot, inside, total = state.agg(F.count("*"), F.max(_INSIDE), F.sum(_INSIDE)).first()
        if not hot or inside <= max_group_rows:
            break
        if not listed and total <= LISTED and not first:
            held = values(state, hot).groupBy(*columns(keys), VALUE).agg(F.sum(COUNT).alias(COUNT))
            histogram, values = _over_listed(materialize(held, "listed"), keys)
            listed = True
        # From the second round on the ends of a bracket are values in different bins: it shrinks.
        if left is not None and total >= left:
            raise RuntimeError("a bracket does not shrink")
        left = None if first else total
        state = _advance(state, histogram(state, hot, first), keys, hot)
        first = False
    if hot:
        done.append(_rank_directly(state, values(state, hot), keys, hot).select(*result))
    interpolated = F.when(F.col(_LOWER) == F.col(_UPPER), F.col(_LOWER)).otherwise(
        F.col(_LOWER) * (1 - F.col(_FRAC)) + F.col(_UPPER) * F.col(_FRAC)
    )
    return reduce(DataFrame.unionAll, done).select(*columns(keys), interpolated.alias(alias))


def _log_scale(value: Column) -> Column:
    """Order-keeping squeeze of all doubles into a short range, infinities included."""
    squeezed = F.signum(value) * F.log1p(F.abs(value))
    return F.least(F.greatest(squeezed, F.lit(-800.0)), F.lit(800.0))


def _ratio(value: Column, lo: Column, hi: Column) -> Column:
    """Where a value lies between two ends, as a share; logarithmic where the ends are far apart."""
    linear = (value - lo) / (hi - lo)
    above, below = (lo > 0) & (hi > lo * BINS), (hi < 0) & (lo < hi * BINS)
    rising = F.ln(value / lo) / F.ln(hi / lo)
    falling = 1 - F.ln(value / hi) / F.ln(lo / hi)
    return F.when(above, rising).when(below, falling).otherwise(linear)


def _bin(value: Column, lo: Column, hi: Column, first: bool) -> Column:
    """Bin of a value inside its bracket; the lower end is in the first bin, the upper in the last.

    The first round squeezes all doubles, unless that makes the ends equal.
    """
    share = _ratio(value, lo, hi)
    if first:
        a, b = _log_scale(lo), _log_scale(hi)
        share = F.when(b > a, (_log_scale(value) - a) / F.nullif(b - a, F.lit(0.0))).otherwise(share)
    bin_ = F.least(F.greatest(F.floor(share * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    return F.when(value == lo, 0).when(value == hi, BINS - 1).otherwise(bin_)


def percentile_by_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    alias: str,
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact percentile of a double column per key, linear between neighbours.

    Null values and NaN are skipped, null keys are keys, a key with only such values
    gives null. ``df`` is read more than once, four times, only when a key exceeds the
    limit; give a materialised frame when it is costly to compute.
    """
    if not keys:
        whole = df.select(F.lit(0).alias("__all"), column(value))
        return percentile_by_key(
            whole, ["__all"], value, p, alias, max_group_rows=max_group_rows
        ).drop("__all")
    v = F.nanvl(column(value), F.lit(None).cast("double"))
    large = df.groupBy(*columns(keys)).agg(F.count(v).alias(_N)).where(F.col(_N) > max_group_rows)
    large, found = settled(large.select(*columns(keys)), "hot-keys")
    if not found:
        return df.groupBy(*columns(keys)).agg(F.percentile(v, F.lit(float(p))).alias(alias))
    side = small_side(large, found)
    hot = join_null_safe(df, side, keys, "left_semi")
    rest = join_null_safe(df, side, keys, "left_anti")
    solved = percentile_of_large_keys(hot, keys, value, p, alias, max_group_rows=max_group_rows)
    ordinary = rest.groupBy(*columns(keys)).agg(F.percentile(v, F.lit(float(p))).alias(alias))
    return ordinary.unionAll(solved)


def percentile_of_large_keys(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    alias: str,
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``percentile_by_key`` for keys that all have very many values: two scans of ``df``."""
    v = F.nanvl(column(value), F.lit(None).cast("double"))
    sketched = df.groupBy(*columns(keys)).agg(
        F.count(v).alias(_N), F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("__sketch")
    )
    ends = {_LO: max(p - MARGIN, 0.0), _HI: min(p + MARGIN, 1.0), _LEAST: 0.0, _MOST: 1.0}
    brackets, hot = settled(
        sketched.select(
            *columns(keys),
            _N,
            *[
                F.when(F.col(_N) > 0, F.kll_sketch_get_quantile_double("__sketch", F.lit(share))).alias(end)
                for end, share in ends.items()
            ],
        ),
        "sketched",
    )
    side = small_side(brackets.select(*columns(keys), *BRACKET), hot)
    upto = join_null_safe(df, side, keys).where(v <= F.col(_HI))
    inside = F.when(v >= F.col(_LO), v)
    # One row per value in a bracket, and one without value for all that lie below.
    counted = upto.groupBy(*columns(keys), inside.alias(VALUE)).agg(F.count("*").alias(COUNT))
    counted = materialize(counted, "bracketed")
    known = F.col(VALUE).isNotNull()
    totals = counted.groupBy(*columns(keys)).agg(
        F.coalesce(F.sum(F.when(~known, F.col(COUNT))), F.lit(0)).alias(_BELOW),
        F.coalesce(F.sum(F.when(known, F.col(COUNT))), F.lit(0)).alias(_INSIDE),
        F.min(VALUE).alias(_LO),
        F.max(VALUE).alias(_HI),
    )
    numbers = brackets.select(*columns(keys), _N, _LEAST, _MOST)
    state = join_null_safe(small_side(numbers, hot), totals, keys, "left")
    ranked = start_state(state.drop(_LEAST, _MOST), p, counted=True)
    within = (F.col(_BELOW) <= F.col(_K)) & (_upper_rank() < F.col(_BELOW) + F.col(_INSIDE))
    met = within | (F.col(_N) == 0)
    ranked, _ = settled(ranked.withColumn("__met", F.coalesce(met, F.lit(False))), "ranked")

    def bracketed(rows: DataFrame, state: DataFrame, hot: int, at: Column) -> DataFrame:
        brackets = small_side(state.select(*columns(keys), *BRACKET), hot)
        return join_null_safe(rows, brackets, keys).where(at.between(F.col(_LO), F.col(_HI)))

    none = ranked.where(F.col(_N) == 0).select(*columns(keys), F.lit(None).cast("double").alias(alias))
    hits = ranked.where(F.col("__met") & (F.col(_N) > 0)).drop("__met")
    # Ranking the counted values sorts them and buffers none, so the callers' limit need not hold.
    few = max(max_group_rows, MAX_GROUP_ROWS)
    solved = none.unionAll(narrow(hits, keys, alias, *_over_listed(counted, keys), few))
    missed = ranked.where(~F.col("__met")).select(*columns(keys))
    number = missed.count()
    if not number:
        return solved

    def row_histogram(state: DataFrame, hot: int, first: bool) -> DataFrame:
        return (
            bracketed(df, state, hot, v)
            .withColumn(BIN, _bin(v, F.col(_LO), F.col(_HI), first))
            .groupBy(*columns(keys), BIN)
            .agg(F.count("*").alias(COUNT), F.min(v).alias(BIN_MIN), F.max(v).alias(BIN_MAX))
        )

    def row_values(state: DataFrame, hot: int) -> DataFrame:
        found = bracketed(df, state, hot, v)
        return found.select(*columns(keys), v.alias(VALUE), F.lit(1).cast("long").alias(COUNT))

    # The ends of a sketch are the least and the largest value themselves.
    whole = join_null_safe(brackets, small_side(missed, number), keys, "left_semi").select(
        *columns(keys), _N, F.col(_LEAST).alias(_LO), F.col(_MOST).alias(_HI)
    )
    again = narrow(start_state(whole, p), keys, alias, row_histogram, row_values, max_group_rows)
    return solved.unionAll(again)
