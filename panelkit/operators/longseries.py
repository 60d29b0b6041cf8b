"""One series of any length: positions, lags, decomposition, outliers and splines over many tasks.

``prep`` works on keyed panels, where a series fits a task. Here a single series may be the whole table. Rows get
their global position from a range sort and the partitions' sizes. Positions are cut into blocks, and a block's
neighbouring rows are copied to it as far as an operator looks, so that windows run by block, each over a bounded
number of rows; no window is without keys. The exact median comes from rounds of counting within a shrinking range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.constants import OUTLIER_K, SEASON
from panelkit.session import materialize

POS = "pos"
#: Rows of a block, and values that the driver sorts at the end of a selection.
BLOCK = 50_000
FEW = 10_000
#: Knots of a block of a spline, and knots beside it that are solved with it. The equations' off-diagonal entries have
#: half the weight of the diagonal, so what lies k knots beyond changes a solution by less than 2 ** -k.
KNOTS = 1024
DECAY = 64


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos``, the 0-based place in the order, written once to the shared folder.

    ``order`` should name rows uniquely; rows with equal values get places in any order. The driver gets one number
    for each partition.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_id", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    offsets, before = [], 0
    for r in placed.groupBy(part.alias("_part")).count().orderBy("_part").collect():
        offsets.append((r["_part"], before))
        before += r["count"]
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    return (placed.join(F.broadcast(starts), part == F.col("_part"))
            .withColumn(POS, F.col("_start") + inside).drop("_id", "_part", "_start"))


def in_blocks(df: DataFrame, before: int, after: int, size: int = BLOCK) -> tuple[DataFrame, Window]:
    """Rows by block, with ``before`` and ``after`` rows of its neighbours, and the window over a block.

    ``_own`` marks a block's own rows; drop the others after the window functions.
    """
    if max(before, after) > size:
        raise ValueError("a block must be longer than what an operator looks at beside it")
    block = F.floor(F.col(POS) / size)
    first = F.greatest(F.floor((F.col(POS) - after) / size), F.lit(0).cast("long"))
    rows = df.withColumn("_block", F.explode(F.sequence(first, F.floor((F.col(POS) + before) / size))))
    return rows.withColumn("_own", F.col("_block") == block), Window.partitionBy("_block").orderBy(POS)


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_own", "_block")


def difference(df: DataFrame, col: str, lag: int = 1, out: str | None = None, size: int = BLOCK) -> DataFrame:
    """``x - x.shift(lag)`` by position."""
    rows, w = in_blocks(df, lag, 0, size)
    return own_rows(rows.withColumn(out or f"{col}_diff", F.col(col) - F.lag(col, lag).over(w)))


def decompose(df: DataFrame, col: str, period: int = SEASON, size: int = BLOCK) -> DataFrame:
    """Additive decomposition as ``prep.decompose``: centred moving average, phase means, residual.

    The phase means are one row for each phase.
    """
    h = period // 2
    rows, w = in_blocks(df, h, h, size)
    x, near = F.col(col), w.rowsBetween(-h, h)
    trend = F.sum(x).over(near)
    if period % 2 == 0:
        trend = trend - 0.5 * F.lag(x, h).over(w) - 0.5 * F.lead(x, h).over(w)
    trend = trend / (period if period % 2 == 0 else 2 * h + 1)
    d = own_rows(rows.withColumn("trend", F.when(F.count(x).over(near) == 2 * h + 1, trend)))
    d = d.withColumn("_phase", F.col(POS) % period)
    means = d.groupBy("_phase").agg(F.avg(x - F.col("trend")).alias("_mean"))
    seasonal = means.select("_phase", (F.col("_mean") - means.select(F.avg("_mean")).scalar()).alias("seasonal"))
    return (d.join(F.broadcast(seasonal), "_phase", "left").drop("_phase")  # a row for each phase of the period
            .withColumn("resid", x - F.col("trend") - F.col("seasonal")))


def median(df: DataFrame, col: str) -> float | None:
    """The exact median: each round counts the rows below and within a range that holds it, and narrows the range.

    NULL and NaN are left out. A round reads the column once; the range shrinks by a factor of hundreds, so a few rounds
    leave FEW values or a single repeated one.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n = v.count()
    if not n:
        return None
    ranks = ((n - 1) // 2, n // 2)  # from 0
    low, high, below, within = float("-inf"), float("inf"), 0, n
    while within > FEW and low < high:
        now = v.where(F.col("v").between(low, high))
        for slack in (0.002, 0.02, 1.0):  # the sketch may miss by its error; then the range is wider
            p = [max(0.0, (ranks[0] - below) / within - slack), min(1.0, (ranks[1] - below) / within + slack)]
            a, b = now.agg(F.percentile_approx("v", p, 10_000)).first()[0]
            less, inside = v.agg(F.count_if(F.col("v") < a), F.count_if(F.col("v").between(a, b))).first()
            if less <= ranks[0] and ranks[1] < less + inside:
                break
        if inside == within:  # many values, none of which the sketch can part: halve between its ends
            middle = a / 2 + b / 2  # never over the ends, also of neighbouring doubles
            middle = a if not a <= middle < b else middle
            lower = now.where(F.col("v") <= middle).count()
            if ranks[1] < below + lower:
                b = now.where(F.col("v") <= middle).agg(F.max("v")).first()[0]
            elif ranks[0] >= below + lower:
                a = now.where(F.col("v") > middle).agg(F.min("v")).first()[0]
            else:  # the two middle values lie on both sides
                return (now.where(F.col("v") <= middle).agg(F.max("v")).first()[0]
                        + now.where(F.col("v") > middle).agg(F.min("v")).first()[0]) / 2
            less, inside = v.agg(F.count_if(F.col("v") < a), F.count_if(F.col("v").between(a, b))).first()
        low, high, below, within = a, b, less, inside
    if low == high:
        return low
    values = sorted(r.v for r in v.where(F.col("v").between(low, high)).collect())
    return (values[ranks[0] - below] + values[ranks[1] - below]) / 2


def outlier_blank(df: DataFrame, col: str, k: float = OUTLIER_K) -> DataFrame:
    """``col`` with values further than ``k`` standard deviations from the median blanked and filled by it; ``is_outlier``."""
    middle = F.lit(median(df, col)).cast("double")
    far = F.coalesce(F.abs(F.col(col) - middle) > k * df.select(F.stddev_samp(col)).scalar(), F.lit(False))
    return df.withColumn("is_outlier", far).withColumn(col, F.coalesce(F.when(~F.col("is_outlier"), F.col(col)), middle))


def spline_bends(knots: DataFrame, x: str, y: str, size: int = KNOTS) -> DataFrame:
    """The natural spline's second derivative ``bend`` at each knot (``pos``, x, y), solved block by block.

    A block's tridiagonal equations are eliminated and solved back by two folds over its knots and DECAY more on either
    side. At the ends of the series the bend is zero, as the spline is natural.
    """
    rows, _ = in_blocks(knots, DECAY + 1, DECAY + 1, size)
    k = F.struct(POS, F.col(x).alias("x"), F.col(y).alias("y"), "_own")
    blocks = rows.groupBy("_block").agg(F.array_sort(F.collect_list(k)).alias("k"))
    at = lambda i: F.get("k", i)

    def equation(v: Column, i: Column) -> Column:
        h0, h1 = v["x"] - at(i - 1)["x"], at(i + 1)["x"] - v["x"]
        turn = (at(i + 1)["y"] - v["y"]) / h1 - (v["y"] - at(i - 1)["y"]) / h0
        return F.struct(v[POS].alias(POS), v["_own"].alias("own"), h0.alias("a"), (2 * (h0 + h1)).alias("b"),
                        h1.alias("c"), (6 * turn).alias("r"))

    zero = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("r"))

    def ahead(done: Column, q: Column) -> Column:
        last = F.element_at(done, -1)
        rest = q["b"] - q["a"] * last["c"]
        return F.array_append(done, F.when(rest.isNull(), zero).otherwise(
            F.struct((q["c"] / rest).alias("c"), ((q["r"] - q["a"] * last["r"]) / rest).alias("r"))))

    def back(done: Column, q: Column) -> Column:
        return F.array_append(done, q["r"] - q["c"] * F.element_at(done, -1))

    e = blocks.select("_block", F.transform("k", equation).alias("e"))
    e = e.select("e", F.aggregate("e", F.array(zero), ahead).alias("f"))  # f has one entry before the first knot
    e = e.select("e", F.aggregate(F.reverse(F.slice("f", 2, F.size("e"))), F.array(F.lit(0.0)), back).alias("g"))
    bends = F.reverse(F.slice("g", 2, F.size("e")))
    return (e.select(F.explode(F.arrays_zip(F.col("e").alias("e"), bends.alias("bend"))).alias("z"))
            .where("z.e.own").select(F.col(f"z.e.{POS}").alias(POS), F.col("z.bend").alias("bend")))


def interpolate_spline(df: DataFrame, col: str, size: int = KNOTS) -> DataFrame:
    """``col``'s gaps filled by the natural cubic spline through its known values, x being ``pos``.

    As ``prep.interpolate_spline``: known cells are unchanged, leading gaps stay, trailing ones follow the spline's
    straight end. A gap is filled by the task of the knot before it.
    """
    value = F.when(~F.isnan(col), F.col(col).cast("double"))
    known = df.select(F.col(POS).alias("x"), value.alias("y")).where("y IS NOT NULL")
    knots = positions(known, ["x"])
    bends = spline_bends(knots, "x", "y", size)
    rows, w = in_blocks(knots.join(bends, POS), 1, 1, max(size, 2))
    piece = lambda f: F.struct(f("x").over(w).alias("x"), f("y").over(w).alias("y"), f("bend").over(w).alias("bend"))
    pieces = own_rows(rows.select("*", piece(F.lead).alias("after"), piece(F.lag).alias("before")))
    # each knot serves the gap behind it; the gaps' rows come from the knots, so no row looks for its knot
    gap = F.sequence(F.col("x") + 1, F.col("after.x") - 1)
    inner = pieces.where(F.col("after.x") > F.col("x") + 1).select("*", F.explode(gap).alias("_at"))
    h = F.col("after.x") - F.col("x")
    a, b = (F.col("after.x") - F.col("_at")) / h, (F.col("_at") - F.col("x")) / h
    inner = inner.select(F.col("_at").alias(POS), (a * F.col("y") + b * F.col("after.y") + (
        (a * a * a - a) * F.col("bend") + (b * b * b - b) * F.col("after.bend")) * h * h / 6).alias("_filled"))
    last = pieces.where(F.col("after.x").isNull()).select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.coalesce(
        (F.col("y") - F.col("before.y")) / (F.col("x") - F.col("before.x"))
        + (F.col("x") - F.col("before.x")) * (2 * F.col("bend") + F.col("before.bend")) / 6, F.lit(0.0)).alias("_slope"))
    end = last.select(F.struct("_x", "_y", "_slope")).scalar()
    tail = F.when(F.col(POS) > end["_x"], end["_y"] + end["_slope"] * (F.col(POS) - end["_x"]))
    return (df.join(inner, POS, "left").withColumn(col, F.coalesce(value, F.col("_filled"), tail)).drop("_filled"))
