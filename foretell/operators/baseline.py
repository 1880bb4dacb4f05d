"""Rolling seven-day baselines and the thresholds they imply."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretell import constants as C
from foretell.functions.numeric import FINE, finite, round_to, to_units
from foretell.functions.times import instant

DAY_MICROS = 86_400_000_000
KEYS = ("location_name", "market_type")
#: Values from here on are not summed in fine units, whose squares would leave a decimal(38,0).
EXACT = 1e4


def mean_of(total: Column, n: Column) -> Column:
    """Mean of values summed in 10^-4 units; 0 on an empty set."""
    return F.when(n > 0, total.cast("double") / n.cast("double") / F.lit(1e4)).otherwise(0.0)


def spread_of(total: Column, squares: Column, n: Column) -> Column:
    """Population standard deviation from exact integer sums.

    n*sum(x^2) - sum(x)^2 stays in decimal(38,0), so equal values give exactly 0.
    """
    wide = "decimal(19,0)"
    scatter = n.cast(wide) * squares.cast(wide) - total.cast(wide) * total.cast(wide)
    return F.when(
        n > 0, F.sqrt(scatter.cast("double")) / n.cast("double") / F.lit(1e4)
    ).otherwise(0.0)


def mean_std(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Mean and population deviation of the values as they are, rounded once at the end.

    NaN and infinities are left out. Values below ``EXACT`` are summed exactly in fine units;
    larger ones as doubles.
    """
    value = finite(value)
    large = F.when(F.abs(value) >= EXACT, value)
    wide = to_units(F.when(F.abs(value) < EXACT, value), FINE).cast("decimal(14,0)")
    one = float(10**FINE)

    def total(fine: Column, coarse: Column, unit: float) -> Column:
        exact = F.coalesce(F.sum(fine), F.lit(0)).cast("double") / F.lit(unit)
        return exact + F.coalesce(F.sum(coarse), F.lit(0.0))

    sums = df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        total(wide, large, one).alias("s"),
        total(wide * wide, large * large, one * one).alias("q"),
    )
    mean = F.when(F.col("n") > 0, F.col("s") / F.col("n")).otherwise(0.0)
    scatter = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
    std = F.when(F.col("n") > 0, F.sqrt(scatter / F.col("n"))).otherwise(0.0)
    return sums.select(*keys, "n", round_to(mean, 4).alias("mean"), round_to(std, 4).alias("std"))


def over_history(rows: DataFrame, ts: str, days: int, values: Mapping[str, Column]) -> DataFrame:
    """Adds sums of ``values`` over each row's key and trailing ``days``, rows of the same instant included.

    A row counts from its time on and is taken off once ``days`` have passed, so the sums are
    running totals of signed events: one pass in time order, whatever a window holds. A key's
    timeline is cut into chunks of ``days``; the events of a chunk are its own rows and, as
    bare values, the coming and going of the chunk before. No task holds more of a key, and
    whole rows are shuffled once. Nulls add nothing; rows without time are dropped.
    """
    span = days * DAY_MICROS
    at, home = F.col("__at"), F.floor(F.col("__at") / F.lit(span)).cast("bigint")
    whole = F.struct(*[F.col(c) for c in rows.columns])
    absent = F.lit(None).cast(rows.schema)

    def event(chunk, order, sign, row):
        signed = [(F.coalesce(F.col(f"__{n}"), F.lit(0)) * sign).alias(f"v{n}") for n in range(len(values))]
        return F.struct(chunk.alias("chunk"), order.alias("order"), row.alias("row"), *signed)

    # at one instant rows come first, are read next, and go last
    events = F.array(
        event(home, at * 2, 1, whole),
        event(home + 1, at * 2, 1, absent),
        event(home + 1, (at + F.lit(span)) * 2 + 1, -1, absent),
    )
    timed = rows.withColumn("__at", F.unix_micros(F.col(ts))).where("__at is not null")
    timed = timed.withColumns({f"__{n}": value for n, value in enumerate(values.values())})
    exploded = timed.select(*KEYS, F.explode(events).alias("e")).select(*KEYS, "e.*")
    running = Window.partitionBy(*KEYS, "chunk").orderBy("order")
    sums = {name: F.sum(f"v{n}").over(running) for n, name in enumerate(values)}
    return exploded.withColumns(sums).where("row is not null").select("row.*", *values)


def history(aggregates: DataFrame, ts: str = "window_end", days: int = C.BASELINE_DAYS) -> DataFrame:
    """What each aggregate's baseline rests on: points and predictions behind it."""
    total = F.col("total_predictions")
    values = {"points": F.lit(1).cast("bigint"), "predictions": total, "__known": total.isNotNull().cast("bigint")}
    summed = over_history(aggregates, ts, days, values)
    return summed.withColumn("predictions", F.when(F.col("__known") > 0, F.col("predictions"))).drop("__known")


def rolling_sums(aggregates: DataFrame, ts: str, days: int, abs_bias: bool) -> DataFrame:
    """Integer sums of the last ``days`` of a row's key, the row included."""
    bias = F.abs(F.col("bias_score")) if abs_bias else F.col("bias_score")
    acc, dev = to_units(F.col("accuracy_rate"), 4), to_units(bias, 4)
    values = {
        "n_rows": F.lit(1).cast("bigint"),
        "n_acc": acc.isNotNull().cast("bigint"),
        "s_acc": acc,
        "q_acc": acc * acc,
        "n_bias": dev.isNotNull().cast("bigint"),
        "s_bias": dev,
        "q_bias": dev * dev,
    }
    return over_history(aggregates, ts, days, values)


SUM_COLUMNS = ("n_acc", "s_acc", "q_acc", "n_bias", "s_bias", "q_bias")


def thresholds(with_sums: DataFrame, sigmas: float = C.SIGMAS, min_points: int = C.BASELINE_MIN_POINTS) -> DataFrame:
    c = F.col
    enough = c("n_rows") >= min_points
    acc_mean, acc_std = mean_of(c("s_acc"), c("n_acc")), spread_of(c("s_acc"), c("q_acc"), c("n_acc"))
    bias_mean = mean_of(c("s_bias"), c("n_bias"))
    bias_std = spread_of(c("s_bias"), c("q_bias"), c("n_bias"))
    return with_sums.withColumns(
        {
            "accuracy_threshold": F.when(
                enough, F.greatest(F.lit(0.0), acc_mean - F.lit(sigmas) * acc_std)
            ).otherwise(C.ACCURACY_FLOOR),
            "bias_threshold": F.when(enough, bias_mean + F.lit(sigmas) * bias_std).otherwise(
                C.BIAS_CEILING
            ),
            "acc_mean": F.when(enough, round_to(acc_mean, 4)),
            "acc_std": F.when(enough, round_to(acc_std, 4)),
            "bias_mean": F.when(enough, round_to(bias_mean, 4)),
            "bias_std": F.when(enough, round_to(bias_std, 4)),
            "baseline_source": F.when(enough, "7day_statistical").otherwise("static_fallback"),
            "baseline_n": c("n_rows"),
        }
    ).drop("n_rows", *SUM_COLUMNS)


def newest_judged(
    aggregates: DataFrame, as_of, ts: str = "window_end", order: str = "window_start", days: int = C.BASELINE_DAYS
) -> DataFrame:
    """The newest aggregate of each place and type against the ``days`` before ``as_of``.

    A key silent for longer has no points and gets the static thresholds. One grouped pass:
    the newest row and the sums of recent rows combine map-side, and ``aggregates`` is read once.
    """
    recent = F.col(ts) >= instant(as_of) - F.expr(f"interval {days} days")
    acc = F.when(recent, to_units(F.col("accuracy_rate"), 4))
    dev = F.when(recent, to_units(F.abs(F.col("bias_score")), 4))
    sums = {"n_acc": F.count(acc), "s_acc": F.sum(acc), "q_acc": F.sum(acc * acc)}
    sums |= {"n_bias": F.count(dev), "s_bias": F.sum(dev), "q_bias": F.sum(dev * dev), "n_rows": F.count_if(recent)}
    # rows of one window by what they hold, so that ties give the same row in any run
    row = F.struct(*[F.col(c) for c in aggregates.columns])
    newest = F.max_by(row, F.struct(order, ts, "accuracy_rate", "bias_score", "total_predictions")).alias("__row")
    grouped = aggregates.groupBy(*KEYS).agg(newest, *[F.coalesce(s, F.lit(0)).alias(n) for n, s in sums.items()])
    return thresholds(grouped.select("__row.*", *sums))


def baselines(
    aggregates: DataFrame,
    ts: str = "window_end",
    days: int = C.BASELINE_DAYS,
    abs_bias: bool = True,
    min_total: int = 0,
) -> DataFrame:
    """Aggregates plus thresholds. ``min_total`` keeps thin windows out of the history."""
    rows = aggregates
    if min_total:
        rows = rows.where(F.coalesce(F.col("total_predictions"), F.lit(0)) >= min_total)
    return thresholds(rolling_sums(rows, ts, days, abs_bias))
