"""Dataset overview, distributions, class and time breakdowns, SNP summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators import columns as cols
from cohortkit.operators import crosstab, distribution, profile, snp, temporal
from workload.registry import integers, query, rounded
from workload.tables import table, view

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("table_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_shape(spark, folder):
    return profile.shape(table(spark, folder, "lineitem")).drop("columns")


@query(
    "missing_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM pheno"
        for c in ("patient_id", "year", "gender", "age", "smoking_history", "bmi", "diabetes")
    ),
)
def missing_values(spark, folder):
    chosen = ["patient_id", "year", "gender", "age", "smoking_history", "bmi", "diabetes"]
    return profile.missing_values(view(spark, folder, "pheno"), chosen)


@query(
    "numeric_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM lineitem"
        for c in LINE_NUMBERS
    ),
)
def numeric_summary(spark, folder):
    return profile.numeric_summary(table(spark, folder, "lineitem"), LINE_NUMBERS, 4)


@query("date_range", "SELECT min(d) AS start, max(d) AS end FROM (SELECT CAST(try_strptime(registry_date, '%Y-%m-%d') AS DATE) AS d FROM requests)")
def date_range(spark, folder):
    return profile.date_range(view(spark, folder, "requests"))


@query(
    "dataset_overview",
    "SELECT 'orders' AS dataset_name, count(*) AS n_rows, 6 AS n_columns, 0 AS missing_price, "
    "round(avg(o_totalprice), 4) AS mean_price, round(stddev_samp(o_totalprice), 4) AS std_price FROM orders",
)
def dataset_overview(spark, folder):
    return integers(profile.overview(table(spark, folder, "orders"), "orders").select(
        "dataset_name", "n_rows", "n_columns",
        F.col("missing_values")["o_totalprice"].alias("missing_price"),
        F.col("numeric_summary")["o_totalprice"]["mean"].alias("mean_price"),
        F.col("numeric_summary")["o_totalprice"]["std"].alias("std_price"),
    ), "missing_price")


def _dated(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("registry_date"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END").alias("diabetes"),
    )


_TRUTH = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"


@query("cohort_size_by_year", "SELECT CAST(year(o_orderdate) AS INTEGER) AS time_key, count(*) AS n FROM orders GROUP BY 1")
def cohort_size_by_year(spark, folder):
    return temporal.cohort_size(_dated(spark, folder), "year")


@query("cohort_size_by_date", "SELECT CAST(o_orderdate AS DATE) AS time_key, count(*) AS n FROM orders GROUP BY 1")
def cohort_size_by_date(spark, folder):
    return temporal.cohort_size(_dated(spark, folder), "registry_date")


@query(
    "prevalence_by_year",
    f"SELECT CAST(year(o_orderdate) AS INTEGER) AS time_key, round(avg({_TRUTH}), 6) AS prevalence FROM orders GROUP BY 1",
)
def prevalence_by_year(spark, folder):
    return rounded(temporal.prevalence(_dated(spark, folder), "year"), 6, "prevalence")


@query(
    "prevalence_by_date",
    f"SELECT CAST(o_orderdate AS DATE) AS time_key, round(avg({_TRUTH}), 6) AS prevalence FROM orders GROUP BY 1",
)
def prevalence_by_date(spark, folder):
    return rounded(temporal.prevalence(_dated(spark, folder), "registry_date"), 6, "prevalence")


@query(
    "mean_trend",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS time_key, round(avg(o_totalprice), 3) AS value FROM orders GROUP BY 1",
)
def mean_trend(spark, folder):
    return rounded(temporal.feature_trend(_dated(spark, folder), "o_totalprice", "year", "mean"), 3, "value")


@query(
    "median_trend",
    "SELECT CAST(o_orderdate AS DATE) AS time_key, round(median(o_totalprice), 3) AS value FROM orders GROUP BY 1",
)
def median_trend(spark, folder):
    return rounded(temporal.feature_trend(_dated(spark, folder), "o_totalprice", "registry_date", "median"), 3, "value")


@query(
    "time_keys",
    "SELECT count(DISTINCT year(o_orderdate)) AS n_keys, count(DISTINCT year(o_orderdate)) = 1 AS single_key FROM orders",
)
def time_keys(spark, folder):
    return temporal.time_key_summary(_dated(spark, folder), "year")


@query(
    "year_column_sizes",
    "SELECT CAST(year AS INTEGER) AS time_key, count(*) AS n FROM pheno WHERE year IS NOT NULL GROUP BY 1",
)
def year_column_sizes(spark, folder):
    return temporal.cohort_size(view(spark, folder, "pheno"), "year")


@query(
    "grouped_counts",
    "SELECT l_linestatus AS level, count(*) FILTER (WHERE l_returnflag <> 'R') AS class_0, "
    "count(*) FILTER (WHERE l_returnflag = 'R') AS class_1 FROM lineitem GROUP BY 1",
)
def grouped_counts(spark, folder):
    line = table(spark, folder, "lineitem").select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return crosstab.grouped_counts(line, "l_linestatus", "y")


@query(
    "snp_grouped_counts",
    "SELECT rs4 AS level, count(*) FILTER (WHERE diabetes = 0) AS class_0, count(*) FILTER (WHERE diabetes = 1) AS class_1 "
    "FROM snps WHERE rs4 IS NOT NULL AND diabetes IS NOT NULL GROUP BY 1",
)
def snp_grouped_counts(spark, folder):
    return crosstab.grouped_counts(view(spark, folder, "snps"), "rs4")


def _encoded_sql(labels):
    numbered = list(enumerate(labels.items(), 1))
    code = "CASE " + " ".join(f"WHEN {c} = 1 THEN {i}" for i, (c, _) in reversed(numbered)) + " END"
    name = "CASE code " + " ".join(f"WHEN {i} THEN '{v}'" for i, (_, v) in numbered) + " END"
    return (
        f"SELECT code, {name} AS label, count(*) FILTER (WHERE diabetes = 0) AS class_0, "
        f"count(*) FILTER (WHERE diabetes = 1) AS class_1 FROM (SELECT {code} AS code, diabetes FROM clean) "
        "WHERE code IS NOT NULL GROUP BY code"
    )


@query("race_counts", _encoded_sql(domain.RACE_LABELS))
def race_counts(spark, folder):
    return crosstab.encoded_counts(cols.normalise_names(view(spark, folder, "pheno")), domain.RACE_LABELS)


@query("smoking_counts", _encoded_sql(domain.SMOKING_LABELS))
def smoking_counts(spark, folder):
    from cohortkit.operators.cleaning import one_hot

    pheno = cols.normalise_names(view(spark, folder, "pheno"))
    return crosstab.encoded_counts(
        one_hot(pheno, "smoking_history", domain.SMOKING_ANSWERS, "smoking"), domain.SMOKING_LABELS
    )


def _histogram_sql(rows: str, bins: int, classes: str | None = None) -> str:
    """Equal-width bins over ``rows`` (class, value), empty bins included, edges checked."""
    return (
        f"WITH r AS ({rows}), s AS (SELECT class, min(value) - CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS lo, "
        "max(value) + CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS hi FROM r GROUP BY class), "
        f"e AS (SELECT class, lo, hi, (hi - lo) / {bins} AS step, b AS bin FROM s, (SELECT unnest(range(0, {bins})) AS b)), "
        f"g AS (SELECT r.class, r.value, s.lo, (s.hi - s.lo) / {bins} AS step, "
        f"least(floor((r.value - s.lo) / (s.hi - s.lo) * {bins}), {bins - 1}) AS b FROM r JOIN s ON r.class = s.class), "
        "c AS (SELECT class, CAST(b - CASE WHEN value < lo + b * step THEN 1 ELSE 0 END + "
        f"CASE WHEN value >= lo + (b + 1) * step AND b < {bins - 1} THEN 1 ELSE 0 END AS BIGINT) AS bin, count(*) AS n "
        "FROM g GROUP BY 1, 2) "
        f"SELECT {'' if classes is None else 'CAST(e.class AS INTEGER) AS class, '}CAST(e.bin AS INTEGER) AS bin, "
        "round(e.lo + e.bin * e.step, 3) AS bin_start, "
        f"round(CASE WHEN e.bin = {bins - 1} THEN e.hi ELSE e.lo + (e.bin + 1) * e.step END, 3) AS bin_end, "
        "coalesce(c.n, 0) AS n FROM e LEFT JOIN c ON e.class = c.class AND e.bin = c.bin"
    )


@query("price_histogram", _histogram_sql("SELECT 0 AS class, l_extendedprice AS value FROM lineitem", 30))
def price_histogram(spark, folder):
    return rounded(distribution.histogram(table(spark, folder, "lineitem"), "l_extendedprice"), 3, "bin_start", "bin_end")


@query("dosage_histogram", _histogram_sql("SELECT 0 AS class, rs1 AS value FROM snps WHERE rs1 IS NOT NULL", 3))
def dosage_histogram(spark, folder):
    return rounded(distribution.histogram(view(spark, folder, "snps"), "rs1"), 3, "bin_start", "bin_end")


_CLASS_ROWS = "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS class, l_extendedprice AS value FROM lineitem"


def _classed(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("diabetes")
    )


@query("class_histogram", _histogram_sql(_CLASS_ROWS, 30, "class"))
def class_histogram(spark, folder):
    return rounded(distribution.class_histogram(_classed(spark, folder), "l_extendedprice"), 3, "bin_start", "bin_end")


def _box_sql(rows: str, keep_class: bool) -> str:
    return (
        f"WITH r AS ({rows}), q AS (SELECT class, count(*) AS n, quantile_cont(value, 0.25) AS q1, median(value) AS med, "
        "quantile_cont(value, 0.75) AS q3 FROM r GROUP BY class) "
        f"SELECT {'CAST(q.class AS INTEGER) AS class, ' if keep_class else ''}q.n, round(q1, 2) AS q1, round(med, 2) AS median, "
        "round(q3, 2) AS q3, "
        "round(least(q1, min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))), 2) AS whisker_low, "
        "round(greatest(q3, max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))), 2) AS whisker_high, "
        "count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers "
        "FROM r JOIN q ON r.class = q.class GROUP BY q.class, q.n, q1, med, q3"
    )


BOX = ["q1", "median", "q3", "whisker_low", "whisker_high"]
_SKEWED = "l_extendedprice * l_extendedprice / 1000"


@query("box_statistics", _box_sql(f"SELECT 0 AS class, {_SKEWED} AS value FROM lineitem", False))
def box_statistics(spark, folder):
    line = table(spark, folder, "lineitem").selectExpr(f"{_SKEWED} AS v")
    return rounded(distribution.box_statistics(line, "v"), 2, *BOX)


@query(
    "class_box_statistics",
    _box_sql(f"SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS class, {_SKEWED} AS value FROM lineitem", True),
)
def class_box_statistics(spark, folder):
    line = table(spark, folder, "lineitem").selectExpr(f"{_SKEWED} AS v", "int(l_returnflag = 'R') AS diabetes")
    return rounded(distribution.box_statistics(line, "v", "diabetes"), 2, *BOX)


@query(
    "narrowed_box_statistics",
    _box_sql(f"SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS class, {_SKEWED} AS value FROM lineitem", True),
)
def narrowed_box_statistics(spark, folder):
    """The same statistics from a table cut into many files."""
    line = table(spark, folder, "lineitem").selectExpr(f"{_SKEWED} AS v", "int(l_returnflag = 'R') AS diabetes")
    return rounded(distribution.box_statistics(line.repartition(40), "v", "diabetes"), 2, *BOX)


# A row order that both engines can compute; the library's own order is a hash of the key.
_LINE_TOKEN = "((l_orderkey * 8 + l_linenumber) % 2147483648 * 2654435761) % 2147483648"


@query(
    "scatter_points",
    f"SELECT round(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END + CAST({_LINE_TOKEN} AS DOUBLE) / 2147483648 * 0.1 - 0.05, 9) AS x, "
    "CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem WHERE l_extendedprice IS NOT NULL",
)
def scatter_points(spark, folder):
    line = table(spark, folder, "lineitem").selectExpr("*", "int(l_returnflag = 'R') AS diabetes")
    return rounded(distribution.scatter_points(line, "l_extendedprice", token=F.expr(_LINE_TOKEN)), 9, "x")


@query(
    "contingency_table",
    'SELECT l_linenumber AS "left", l_returnflag AS "right", count(*) AS n FROM lineitem GROUP BY 1, 2',
)
def contingency_table(spark, folder):
    return crosstab.contingency(table(spark, folder, "lineitem"), "l_linenumber", "l_returnflag")


_MAF_SQL = "SELECT snp, least(avg(dosage) / 2, 1 - avg(dosage) / 2) AS maf, var_samp(dosage) AS variance FROM long_snps GROUP BY snp"


@query("minor_allele_frequency", f"SELECT snp, round(maf, 6) AS maf FROM ({_MAF_SQL})")
def minor_allele_frequency(spark, folder):
    return rounded(snp.minor_allele_frequency(view(spark, folder, "snps")), 6, "maf")


@query("dosage_variance", f"SELECT snp, round(variance, 6) AS variance FROM ({_MAF_SQL})")
def dosage_variance(spark, folder):
    return rounded(snp.dosage_variance(view(spark, folder, "snps")), 6, "variance")


@query("maf_histogram", _histogram_sql(f"SELECT 0 AS class, maf AS value FROM ({_MAF_SQL})", 30))
def maf_histogram(spark, folder):
    return rounded(snp.maf_histogram(view(spark, folder, "snps")), 3, "bin_start", "bin_end")


@query("variance_histogram", _histogram_sql(f"SELECT 0 AS class, variance AS value FROM ({_MAF_SQL})", 30))
def variance_histogram(spark, folder):
    return rounded(snp.variance_histogram(view(spark, folder, "snps")), 3, "bin_start", "bin_end")


@query("snp_count_cube", "SELECT snp, dosage, target, count(*) AS n FROM long_snps GROUP BY 1, 2, 3")
def snp_count_cube(spark, folder):
    return snp.snp_cube(view(spark, folder, "snps"))


_FREQUENCY = ", ".join(f"round(avg(CASE WHEN dosage = {d} THEN 1 ELSE 0 END), 6) AS freq_{d}" for d in (0, 1, 2))


@query("genotype_frequencies", f"SELECT snp, {_FREQUENCY} FROM long_snps WHERE dosage IN (0, 1, 2) GROUP BY snp")
def genotype_frequencies(spark, folder):
    shares = snp.genotype_frequencies(snp.snp_cube(view(spark, folder, "snps")))
    return rounded(shares, 6, "freq_0", "freq_1", "freq_2")


_SHARES = " UNION ALL ".join(
    f"SELECT snp, {d} AS dosage, {t} AS target, "
    f"round(avg(CASE WHEN dosage = {d} AND target = {t} THEN 1 ELSE 0 END), 6) AS share FROM valid GROUP BY snp"
    for d in (0, 1, 2)
    for t in (0, 1)
)


@query(
    "genotype_outcome_shares",
    f"WITH valid AS (SELECT * FROM long_snps WHERE dosage IN (0, 1, 2) AND target IS NOT NULL) {_SHARES}",
)
def genotype_outcome_shares(spark, folder):
    return rounded(snp.genotype_outcome_shares(snp.snp_cube(view(spark, folder, "snps"))), 6, "share")
