"""Running totals, exact quantiles and exact splits that never sort one group in one task.

A plain ``Window.orderBy`` over a whole class or a whole column puts that class
in one task. The operators here cut the order into buckets first, total the
buckets, and sort only inside a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import bucket_of, number_sql, quoted, text_sql
from cohortkit.session import broadcast_if_small, materialise

# Rows that a bucket of the order should hold, and the fewest and most buckets. A
# bucket is sorted in one task; the most are bounded because every row finds its bucket among them.
BUCKET_ROWS, FEWEST, MOST = 200_000, 64, 65_536

# Accuracy of the sketch that narrows quantiles: its ranks are off by at most this part of the rows.
_SKETCH = 10_000

_COMBINE = {
    "sum": (F.sum, lambda before, inside: F.coalesce(before, F.lit(0)) + inside),
    "min": (F.min, lambda before, inside: F.least(before, inside)),
    "max": (F.max, lambda before, inside: F.greatest(before, inside)),
}


def running(
    df: DataFrame,
    order: str,
    outputs: dict[str, tuple[str, str]],
    *,
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Running sum, min or max of columns along ``order``.

    ``outputs`` maps a new column to ``(kind, column)``. Values of ``order`` must
    be distinct within ``by`` (aggregate first). ``df`` is read several times, so it
    should be a written table. The order is cut into buckets by a quantile sketch,
    as many as the number of rows asks for unless given; a poor sketch costs
    balance, not correctness.
    """
    direction = F.desc if descending else F.asc
    buckets = bucket_count(df.count()) if buckets is None else buckets
    marks = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(order, marks, 40 * buckets)).scalar()
    placed = (
        df.select("*", bounds.alias("_bounds"))
        .withColumn("_bucket", bucket_of(order, "_bounds", buckets - 1))
        .drop("_bounds")
    )
    kinds = {out: _COMBINE[kind] for out, (kind, _) in outputs.items()}
    totals = placed.groupBy(*by, "_bucket").agg(
        *[kinds[out][0](column).alias(f"_total_{out}") for out, (_, column) in outputs.items()]
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy(direction("_bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *by,
        "_bucket",
        *[kinds[out][0](f"_total_{out}").over(earlier).alias(f"_before_{out}") for out in outputs],
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most ``buckets`` rows
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = placed.join(offsets, [*by, "_bucket"])
    return joined.select(
        *[quoted(c) for c in df.columns],
        *[
            kinds[out][1](F.col(f"_before_{out}"), kinds[out][0](column).over(inside)).alias(out)
            for out, (_, column) in outputs.items()
        ],
    )


def bucket_count(rows: int) -> int:
    """Buckets for so many rows."""
    return min(MOST, max(FEWEST, -(-rows // BUCKET_ROWS)))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``keep``, ``feature``, ``value`` as double; nulls dropped."""
    pairs = ", ".join(f"named_struct('feature', {text_sql(c)}, 'value', {number_sql(c)})" for c in columns)
    return (
        df.select(*[quoted(k) for k in keep], F.explode(F.expr(f"array({pairs})")).alias("_pair"))
        .select(*[quoted(k) for k in keep], "_pair.feature", "_pair.value")
        .where(F.col("value").isNotNull())
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    by: Sequence[str] = (),
    buckets: int = _SKETCH // 2,
) -> DataFrame:
    """Linearly interpolated quantiles: ``by``, ``feature``, ``n``, ``quantiles`` (array).

    Rows with a null ``by`` are ignored. The few values around each rank, a ``buckets``-th of the
    rows on either side of it, are found by counting, at any size.
    """
    present = df
    for column in by:
        present = present.where(quoted(column).isNotNull())
    values = long_values(present, columns, by)
    return _quantiles(values, [*by, "feature"], list(probabilities), 1 / buckets)


def _quantiles(values: DataFrame, keys: list[str], probabilities: list[float], slack: float) -> DataFrame:
    """Quantiles in two passes over one column, shuffling counts rather than rows.

    Pass 1 sketches a lower and an upper bound of the values at each probability, pass 2 counts each value
    between such bounds and the rows of each gap outside them. Should a rank lie in a gap, because the sketch was
    poor, both passes run again with bounds further apart, which in the end leave no gap.
    """
    spots = [(max(0.0, p - slack), min(1.0, p + slack)) for p in probabilities]
    marks = sorted({m for spot in spots for m in spot})
    frame = broadcast_if_small(
        values.groupBy(*keys).agg(F.count("value").alias("n"), F.percentile_approx("value", marks, _SKETCH).alias("_bounds"))
    )
    bound = [F.get("_bounds", F.lit(i)) for i in range(len(marks))]
    value = F.col("value")
    gap = reduce(Column.__add__, [F.when(b < value, 1).otherwise(0) for b in bound], F.lit(0))
    near = reduce(Column.__or__, [(value >= bound[marks.index(lo)]) & (value <= bound[marks.index(hi)]) for lo, hi in spots])
    if slack >= 1:
        near = F.lit(True)
    counts = (
        values.join(frame, keys)
        .groupBy(*keys, F.when(near, F.lit(-1)).otherwise(gap).alias("_gap"), F.when(near, value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("value").alias("_low"), F.max("value").alias("_high"), F.first("n").alias("n"))
    )
    upto = Window.partitionBy(*keys).orderBy("_low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.array(*[
        F.struct(F.lit(i).alias("_i"), F.lit(float(p)).alias("_p"), F.lit(side).alias("_side"))
        for i, p in enumerate(probabilities)
        for side in (0, 1)
    ])
    position = (F.col("n") - 1) * F.col("_want._p")
    picked = (
        counts.withColumn("_upto", F.sum("_rows").over(upto))
        .withColumn("_want", F.explode(ranks))
        .withColumn("_rank", F.when(F.col("_want._side") == 0, F.floor(position)).otherwise(F.ceil(position)))
        .where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_rows")))
    )
    exact = F.when(F.col("_low") == F.col("_high"), F.col("_low") + F.lit(0.0))
    ends = picked.groupBy(*keys, "n", F.col("_want._i").alias("_i"), F.col("_want._p").alias("_p")).agg(
        F.max(F.when(F.col("_want._side") == 0, exact)).alias("_a"),
        F.max(F.when(F.col("_want._side") == 1, exact)).alias("_b"),
    )
    place = (F.col("n") - 1) * F.col("_p")
    value = F.col("_a") + (place - F.floor(place)) * (F.col("_b") - F.col("_a"))
    found = materialise(
        ends.groupBy(*keys, "n")
        .agg(F.sort_array(F.collect_list(F.struct("_i", value.alias("_v")))).alias("_found"))
        .select(*keys, "n", F.transform("_found", lambda f: f["_v"]).alias("quantiles")),
        "quantiles",
    )
    if found.where(F.exists("quantiles", lambda q: q.isNull())).isEmpty():
        return found
    return _quantiles(values, keys, probabilities, 30 * slack)


def shuffle_token(key: str, seed: int) -> Column:
    """A 31-bit hash of the key; uniform, and the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(quoted(key), F.lit(seed)), 33)


def cut_by_rank(
    df: DataFrame,
    key: str,
    by: str,
    fractions: Sequence[float],
    token: Column,
    label: str,
) -> DataFrame:
    """Cut each ``by`` group, in order of ``token``, at exact fractions of its size.

    ``token`` is a number in [0, 2^31); ties are ordered by ``key``. Adds ``label``
    = how many cuts lie before the row. The rows themselves are never shuffled or
    sorted: counting finds the (token, key) at each cut, and rows compare with it.
    Rows with a null ``by`` get a null label.
    """
    tokened = df.withColumn("_token", token.cast("bigint"))
    placed = tokened.select(
        quoted(by).alias("_by"), quoted(key).alias("_key"), "_token",
        F.shiftright("_token", 15).alias("_bucket"),
    )
    counts = placed.groupBy("_by", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("_by")
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = F.array(*[F.lit(float(f)) for f in fractions])
    wanted = (
        counts.withColumn("_n", F.sum("_rows").over(group))
        .withColumn("_upto", F.sum("_rows").over(upto))
        .withColumn("_before", F.col("_upto") - F.col("_rows"))
        .select("*", F.posexplode(cuts).alias("_cut", "_fraction"))
        .withColumn("_rank", F.floor(F.col("_n") * F.col("_fraction") + 0.5))
        .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_upto")))
        .select("_by", "_bucket", "_cut", "_before", "_rank")
    )
    wanted = broadcast_if_small(wanted)
    inside = Window.partitionBy("_by", "_bucket", "_cut").orderBy("_token", "_key")
    edges = (
        placed.join(wanted, ["_by", "_bucket"])
        .withColumn("_row", F.row_number().over(inside) + F.col("_before"))
        .where(F.col("_row") == F.col("_rank"))
        .groupBy("_by")
        .agg(F.collect_list(F.struct("_token", "_key")).alias("_edges"))
    )
    edges = broadcast_if_small(edges.withColumnRenamed("_by", by))
    here = F.struct(F.col("_token"), quoted(key).alias("_key"))
    # A cut whose rank is 0 has no edge row: it lies before every row of the group.
    behind = len(fractions) - F.size("_edges") + F.size(F.filter("_edges", lambda e: e < here))
    edge_type = f"array<struct<_token:bigint,_key:{df.schema[key].dataType.simpleString()}>>"
    return (
        tokened.join(edges, by, "left")
        .withColumn("_edges", F.coalesce("_edges", F.array().cast(edge_type)))
        .select(*[quoted(c) for c in df.columns], F.when(quoted(by).isNotNull(), behind).alias(label))
    )
