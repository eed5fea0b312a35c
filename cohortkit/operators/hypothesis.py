"""Chi-square and Welch tests of features against the target, with false-discovery control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.functions.columns import count_if, number, one_hot_code, quoted
from cohortkit.functions.tails import chi2_p, t_p
from cohortkit.operators.ordering import running
from cohortkit.session import materialise


def level_counts(
    df: DataFrame,
    groups: dict[str, Column],
    target: str = domain.TARGET,
    classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """Long contingency tables of several features: ``feature``, ``level``, ``n_<class>``.

    All features are counted in one pass; counts combine before the shuffle, so
    a level that holds most rows stays one row per task. Rows of other target
    levels than ``classes`` do not count.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("feature"), column.cast("double").alias("level"))
        for name, column in groups.items()
    ])
    long = df.select(quoted(target).alias("_target"), F.explode(pairs).alias("_pair"))
    long = long.select("_target", "_pair.feature", "_pair.level").where(
        F.col("level").isNotNull() & ~F.isnan("level") & F.col("_target").isin(*classes)
    )
    return long.groupBy("feature", "level").agg(
        *[count_if(F.col("_target") == c).alias(f"n_{c}") for c in classes]
    )


def chi_square(
    counts: DataFrame,
    classes: Sequence[int] = (0, 1),
    *,
    key: str = "feature",
    with_p: bool = True,
) -> DataFrame:
    """Chi-square test of independence per feature from ``level_counts``.

    Columns: the key, ``n``, ``levels``, ``statistic``, ``dof`` and ``p_value``;
    undefined (null) with fewer than two observed rows or columns. A 2 x 2 table
    gets the Yates correction.
    """
    names = [f"n_{c}" for c in classes]
    row_total = F.col(names[0])
    for n in names[1:]:
        row_total = row_total + F.col(n)
    rows = counts.withColumn("_row", row_total).where("_row > 0")
    totals = rows.groupBy(key).agg(
        F.sum("_row").alias("n"), *[F.sum(n).alias(f"_c{i}") for i, n in enumerate(names)]
    )
    joined = rows.join(totals, key)
    cells = []
    for i, name in enumerate(names):
        expected = F.col("_row") * F.col(f"_c{i}") / F.col("n")
        cells.append((F.col(name) - expected, expected))
    off = cells[0][0]
    squares = F.lit(0.0)
    for gap, expected in cells:
        squares = squares + F.coalesce(F.try_divide(gap * gap, expected), F.lit(0.0))
    columns = [f"_c{i}" for i in range(len(names))]
    observed = sum(((F.max(c) > 0).cast("int") for c in columns[1:]), (F.max(columns[0]) > 0).cast("int"))
    inverse = F.lit(0.0)
    for c in columns:
        inverse = inverse + F.coalesce(F.try_divide(F.lit(1.0), F.max(c)), F.lit(0.0))
    summary = joined.groupBy(key).agg(
        F.max("n").alias("n"),
        F.count(F.lit(1)).alias("levels"),
        observed.alias("_classes"),
        F.sum(squares).alias("_plain"),
        F.max(F.abs(off)).alias("_gap"),
        F.sum(1.0 / F.col("_row")).alias("_inverse_rows"),
        inverse.alias("_inverse_columns"),
    )
    # In a 2 x 2 table every cell is off by the same amount and
    # the inverse expected counts sum to n * sum(1/row) * sum(1/column).
    gap = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    yates = gap * gap * F.col("n") * F.col("_inverse_rows") * F.col("_inverse_columns")
    defined = (F.col("levels") >= 2) & (F.col("_classes") >= 2)
    dof = (F.col("levels") - 1) * (F.col("_classes") - 1)
    tested = summary.select(
        key,
        "n",
        "levels",
        F.when(defined, F.when((F.col("levels") == 2) & (F.col("_classes") == 2), yates).otherwise(F.col("_plain"))).alias("statistic"),
        F.when(defined, dof.cast("int")).alias("dof"),
    )
    return tested.withColumn("p_value", chi2_p("statistic", F.col("dof").cast("double"))) if with_p else tested


def welch_test(
    df: DataFrame, columns: Sequence[str], target: str = domain.TARGET, *, with_p: bool = True
) -> DataFrame:
    """Welch's t-test of each numeric column between target 0 and 1, in one pass.

    Columns: ``feature``, ``n_0``, ``n_1``, ``statistic``, ``dof``, ``p_value``; columns with
    fewer than two values on a side are left out.
    """
    measures = []
    for c in columns:
        sides = []
        for k in (0, 1):
            value = F.when(quoted(target) == k, number(quoted(c)))
            sides += [
                F.count(value).alias(f"n_{k}"),
                F.avg(value).alias(f"m_{k}"),
                F.var_samp(value).alias(f"v_{k}"),
            ]
        measures.append(F.struct(*sides).alias(c))
    one_row = df.agg(*measures)
    rows = one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).alias("s")) for c in columns]))
    ).select("feature", "s.*").where("n_0 >= 2 AND n_1 >= 2")
    a, b = F.col("v_0") / F.col("n_0"), F.col("v_1") / F.col("n_1")
    tested = rows.select(
        "feature",
        "n_0",
        "n_1",
        F.try_divide(F.col("m_0") - F.col("m_1"), F.sqrt(a + b)).alias("statistic"),
        F.try_divide((a + b) * (a + b), a * a / (F.col("n_0") - 1) + b * b / (F.col("n_1") - 1)).alias("dof"),
    )
    return tested.withColumn("p_value", t_p("statistic", "dof")) if with_p else tested


def fdr_adjust(
    tests: DataFrame,
    p: str = "p_value",
    *,
    alpha: float = domain.ALPHA,
    buckets: int | None = None,
) -> DataFrame:
    """Add Benjamini-Hochberg ``p_fdr`` and ``significant``; undefined p-values take no part.

    Ranks and minima are running totals over the distinct p-values, so no task
    sorts all tests.
    """
    tests = materialise(tests, "tests")
    known = tests.where(quoted(p).isNotNull())
    total = known.count()
    ties = materialise(known.groupBy(quoted(p).alias("_p")).agg(F.count(F.lit(1)).alias("_ties")), "p-values")
    ranked = running(ties, "_p", {"_rank": ("sum", "_ties")}, buckets=buckets)
    scaled = materialise(ranked.select("_p", (F.col("_p") * total / F.col("_rank")).alias("_scaled")), "scaled")
    lowest = running(scaled, "_p", {"_low": ("min", "_scaled")}, descending=True, buckets=buckets)
    lowest = lowest.select("_p", F.least(F.lit(1.0), F.col("_low")).alias("p_fdr"))
    adjusted = tests.join(lowest, quoted(p) == F.col("_p"), "left").drop("_p")
    return adjusted.withColumn("significant", F.coalesce(F.col("p_fdr") <= alpha, F.lit(False)))


def feature_screen(
    df: DataFrame,
    *,
    target: str = domain.TARGET,
    ignore: Sequence[str] = ("location", domain.KEY, domain.REGISTRY_DATE),
    binary: Sequence[str] = tuple(domain.BINARY_COLUMNS),
    one_hot_groups: dict[str, Sequence[str]] | None = None,
    snp_prefix: str = domain.SNP_PREFIX,
    alpha: float = domain.ALPHA,
) -> DataFrame:
    """Test every feature against the target and adjust all p-values together.

    SNPs, binary columns and one-hot groups get a chi-square test, other numeric
    columns Welch's test: ``feature``, ``test_group``, ``statistic``, ``dof``, ``p_value``,
    ``p_fdr``, ``significant``.
    """
    from cohortkit.operators.profile import numeric_columns

    if one_hot_groups is None:
        one_hot_groups = {"race": list(domain.RACE_LABELS), "smoking": list(domain.SMOKING_LABELS)}
    grouped = {c for members in one_hot_groups.values() for c in members}
    candidates = [c for c in df.columns if c != target and c not in ignore and c not in grouped]
    counted = {c: number(quoted(c)) for c in candidates if c.startswith(snp_prefix) or c in binary}
    for name, members in one_hot_groups.items():
        if any(c in df.columns for c in members):
            counted[name] = one_hot_code(members, 0, df.columns)
    numeric = [c for c in candidates if c not in counted and c in numeric_columns(df)]
    parts = []
    if counted:
        chi = chi_square(level_counts(df, counted, target), with_p=False)
        parts.append(chi.select("feature", F.lit("chi2").alias("test_group"), "statistic", F.col("dof").cast("double").alias("dof")))
    if numeric:
        t = welch_test(df, numeric, target, with_p=False)
        parts.append(t.select("feature", F.lit("ttest").alias("test_group"), "statistic", "dof"))
    if not parts:
        raise ValueError("no testable feature")
    tests = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    p_value = F.when(F.col("test_group") == "chi2", chi2_p("statistic", "dof")).otherwise(t_p("statistic", "dof"))
    return fdr_adjust(tests.withColumn("p_value", p_value), alpha=alpha)
