"""Evaluation of predictions: metrics, residuals and the data behind their plots.

Results are bounded by bins or grid points, so any plotting tool can take them. Only the automatic
number of bins follows the rows, up to about twice their square root. NaN and the infinities have no
place on an axis of finite bins: rows with one are left out of histograms, densities and joint counts, as
are NULLs; ``not_finite`` tells how many there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.bins import bin_edge, fixed_bin
from gustline.operators.selection import quantiles

# Points of a density curve, cells it is computed from, bins per axis of a 2-D count.
GRID_POINTS = 200
DENSITY_CELLS = 2048
JOINT_BINS = 50


def metrics(
    scored: DataFrame, actual: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """MSE, RMSE, MAE and R² in one aggregate pass (per group of ``by``).

    R² relates the squared error to the squared deviation from the mean, taken as a numerically
    stable variance; for a constant label it is undefined and NULL.
    """
    pairs = scored.filter(F.col(actual).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(actual) - F.col(prediction)
    summary = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("spread"),
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))
    return summary.select(*by, "rows", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def with_residual(scored: DataFrame, actual: str, prediction: str = "prediction") -> DataFrame:
    """Add ``residual`` = actual - prediction."""
    return scored.withColumn("residual", F.col(actual) - F.col(prediction))


@dataclass(frozen=True)
class Spread:
    """Summary of one column; the only row that reaches the driver."""

    rows: int
    low: float
    high: float
    deviation: float
    quartile_range: float | None

    def width(self, bins: int) -> float:
        return (self.high - self.low) / bins

    def auto_bins(self) -> int:
        """Number of bins: the narrower of the Freedman-Diaconis and the Sturges width, the former not
        below half the square-root width, so that a far outlier cannot ask for any number of bins."""
        if self.quartile_range is None:
            raise ValueError("quartiles were not taken")
        if self.rows == 0 or self.deviation == 0:
            return 1
        extent = self.high - self.low
        width = extent / (math.log2(self.rows) + 1)
        if self.quartile_range > 0:
            robust = 2 * self.quartile_range / self.rows ** (1 / 3)
            width = min(width, max(robust, extent / self.rows**0.5 / 2))
        return max(1, math.ceil(extent / width))

    def bandwidth(self) -> float:
        """Scott's rule for a Gaussian kernel."""
        return self.deviation * max(self.rows, 1) ** -0.2


def spread(df: DataFrame, column: str, quartiles: bool = False) -> Spread:
    """One pass over a column. Quartiles are exact, interpolated between neighbours; they are found by
    counting in a few more passes (see ``selection``), with nothing sorted or gathered."""
    summary = [
        F.count(column).alias("rows"),
        F.min(column).alias("low"),
        F.max(column).alias("high"),
        F.stddev_samp(column).alias("deviation"),
    ]
    row = df.agg(*summary).first()
    between = None
    if row["rows"] == 0:
        return Spread(0, 0.0, 1.0, 0.0, 0.0 if quartiles else None)
    if quartiles:
        lower, upper = quantiles(df, column, (0.25, 0.75))
        between = upper - lower
    low, high = float(row["low"]), float(row["high"])
    if low == high:
        low, high = low - 0.5, high + 0.5
    return Spread(row["rows"], low, high, float(row["deviation"] or 0.0), between)


def _numbers(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(F.abs(F.col(column)) < F.lit(math.inf))  # NaN is beyond infinity
    return df


def not_finite(df: DataFrame, *columns: str) -> DataFrame:
    """(column, missing, not_a_number, infinite): the rows that have no place on the axis of each column."""
    counts = []
    for i, column in enumerate(columns):
        value = F.col(column).cast("double")
        missing, odd = value.isNull(), F.coalesce(F.isnan(value), F.lit(False))
        infinite = F.coalesce((F.abs(value) == F.lit(math.inf)), F.lit(False))
        counts += [F.count_if(test).alias(f"{name}_{i}") for name, test in (("missing", missing), ("odd", odd), ("infinite", infinite))]
    parts = ", ".join(f"'{_escaped(c)}', missing_{i}, odd_{i}, infinite_{i}" for i, c in enumerate(columns))
    return df.agg(*counts).selectExpr(f"stack({len(columns)}, {parts}) as (column, missing, not_a_number, infinite)")


def _escaped(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """Fixed-width histogram: bin, its edges, rows in it (0 for an empty bin). Without ``bins`` their
    number follows from the data. No rows, no bins."""
    known = _numbers(df, column)
    stats = spread(known, column, quartiles=bins is None)
    bins = bins or stats.auto_bins()
    width = stats.width(bins)
    counts = known.groupBy(fixed_bin(F.col(column), stats.low, width, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    number = F.col("bin")
    every = df.sparkSession.range(bins if stats.rows else 0).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        bin_edge(number, stats.low, width).alias("low"),
        bin_edge(number + F.lit(1), stats.low, width).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def _kernel(distance: Column) -> Column:
    return F.exp(distance * distance * F.lit(-0.5)) / F.lit(math.sqrt(2 * math.pi))


def density(
    df: DataFrame, column: str, points: int = GRID_POINTS, cells: int = DENSITY_CELLS, cut: float = 0.0
) -> DataFrame:
    """Gaussian kernel density on an even grid of ``points`` over the column's range, widened by
    ``cut`` bandwidths on both sides.

    Rows are first reduced to at most ``cells`` cells (count and mean of each) with map-side partials;
    the kernel runs per cell and grid point, so its cost does not grow with the rows.
    """
    known = _numbers(df, column)
    stats = spread(known, column)
    bandwidth = stats.bandwidth()
    spark = df.sparkSession
    if stats.rows < 2 or bandwidth == 0.0:
        # no spread, no curve
        return spark.createDataFrame([], "point int, x double, density double")
    low, high = stats.low - cut * bandwidth, stats.high + cut * bandwidth
    step = (high - low) / (points - 1)
    reduced = known.groupBy(fixed_bin(F.col(column), stats.low, stats.width(cells), cells).alias("cell")).agg(
        F.count(F.lit(1)).alias("weight"), F.avg(column).alias("centre")
    )
    x = bin_edge(F.col("point"), low, step)
    mass = _kernel((x - F.col("centre")) / F.lit(bandwidth)) * F.col("weight")
    return (
        reduced.select("weight", "centre", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .groupBy("point")
        .agg((F.sum(mass) / F.lit(stats.rows * bandwidth)).alias("density"))
        .select("point", x.alias("x"), "density")
    )


def joint_counts(
    scored: DataFrame, actual: str, prediction: str = "prediction", bins: int = JOINT_BINS
) -> DataFrame:
    """Actual against prediction as counts of square cells on one common scale, with the end of the
    y = x line (the largest actual value)."""
    known = _numbers(scored, actual, prediction)
    row = known.agg(
        F.least(F.min(actual), F.min(prediction)).alias("low"),
        F.greatest(F.max(actual), F.max(prediction)).alias("high"),
        F.max(actual).alias("line_end"),
    ).first()
    low, high = (0.0, 1.0) if row["low"] is None else (row["low"], row["high"])
    width = ((high - low) or 1.0) / bins
    cells = known.groupBy(
        fixed_bin(F.col(actual), low, width, bins).alias("actual_bin"),
        fixed_bin(F.col(prediction), low, width, bins).alias("prediction_bin"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    return cells.select(
        "actual_bin",
        "prediction_bin",
        bin_edge(F.col("actual_bin"), low, width).alias("actual_low"),
        bin_edge(F.col("prediction_bin"), low, width).alias("prediction_low"),
        "rows",
        F.lit(row["line_end"]).cast("double").alias("line_end"),
    )
