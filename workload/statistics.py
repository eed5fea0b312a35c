"""Correlations, selection and hypothesis tests."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import functions as F

from cohortkit.operators import correlation, hypothesis, selection, snp
from cohortkit.operators import columns as cols
from cohortkit.operators.cleaning import clean_phenotypes, one_hot
from cohortkit import domain
from workload.registry import chi2_tail_sql, integers, query, rounded, t_tail_sql
from workload.tables import SNP_NAMES, table, view

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "steady"]
_LINE = (
    "line AS (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity, l_extendedprice, l_discount, "
    "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_tax + l_discount END AS l_tax, CAST(1 AS DOUBLE) AS steady, "
    "CASE WHEN l_returnflag = 'R' AND l_quantity > 10 THEN 1 ELSE 0 END AS y FROM lineitem)"
)


def _line(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity",
        "l_extendedprice",
        "l_discount",
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_tax + l_discount END AS l_tax",
        "CAST(1 AS DOUBLE) AS steady",
        "CASE WHEN l_returnflag = 'R' AND l_quantity > 10 THEN 1 ELSE 0 END AS y",
    )


def _corr(a: str, b: str) -> str:
    """Correlation in SQL, null where a side is constant."""
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


@query(
    "correlation_matrix",
    f"WITH {_LINE} " + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round({_corr(a, b)}, 6) AS r FROM line"
        for a in NUMBERS for b in NUMBERS
    ),
)
def correlation_matrix(spark, folder):
    return rounded(correlation.correlation_matrix(_line(spark, folder), NUMBERS), 6, "r")


_PAIRS_SQL = f"WITH {_LINE} " + " UNION ALL ".join(
    f"SELECT {NUMBERS.index(a)} AS position_a, {NUMBERS.index(b)} AS position_b, '{a}' AS feature_a, "
    f"'{b}' AS feature_b, round({_corr(a, b)}, 6) AS r FROM line"
    for a, b in combinations(NUMBERS, 2)
)


@query("correlation_pairs", _PAIRS_SQL)
def correlation_pairs(spark, folder):
    return rounded(correlation.correlation_pairs(_line(spark, folder), NUMBERS), 6, "r")


@query("correlation_pair_expressions", _PAIRS_SQL)
def correlation_pair_expressions(spark, folder):
    """The same pairs, each computed by itself: the number of columns offered does not matter."""
    line = _line(spark, folder)
    listed = NUMBERS
    parts = [
        correlation.cross_correlations(line, [a], [b]).select(
            F.lit(listed.index(a)).alias("position_a"), F.lit(listed.index(b)).alias("position_b"), "feature_a", "feature_b", "r")
        for a, b in combinations(listed, 2)
    ]
    return rounded(reduce(lambda x, y: x.unionByName(y), parts), 6, "r")


@query(
    "target_correlations",
    f"WITH {_LINE} " + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, round(abs({_corr(a, 'y')}), 6) AS abs_r FROM line" for a in NUMBERS
    ),
)
def target_correlations(spark, folder):
    return rounded(correlation.target_correlations(_line(spark, folder), NUMBERS, "y"), 6, "abs_r")


@query(
    "redundant_features",
    f"WITH {_LINE}, pairs AS (" + " UNION ALL ".join(
        f"SELECT '{b}' AS feature, abs({_corr(a, b)}) AS r FROM line" for a, b in combinations(NUMBERS, 2)
    ) + ") SELECT DISTINCT feature FROM pairs WHERE r > 0.6",
)
def redundant_features(spark, folder):
    return correlation.redundant_features(correlation.correlation_pairs(_line(spark, folder), NUMBERS, above=0.6), 0.6)


@query(
    "weak_target_features",
    f"WITH {_LINE}, r AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, abs({_corr(a, 'y')}) AS r FROM line" for a in NUMBERS
    ) + ") SELECT feature FROM r WHERE r < 0.1",
)
def weak_target_features(spark, folder):
    return selection.weak_target_features(correlation.target_correlations(_line(spark, folder), NUMBERS, "y"), 0.1)


_CHAIN = " UNION ALL ".join(
    f"SELECT {i} AS position, '{s}' AS snp, var_samp({s}) AS variance, abs({_corr(s, 'diabetes')}) AS abs_r FROM snps"
    for i, s in enumerate(SNP_NAMES)
)
_PASSES = "coalesce(variance >= 0.01 AND abs_r >= 0.05, false)"


@query(
    "snp_filter_chain",
    f"SELECT snp, round(variance, 6) AS variance, round(abs_r, 6) AS abs_r, {_PASSES} AS passes FROM ({_CHAIN})",
)
def snp_filter_chain(spark, folder):
    chain = selection.snp_filter_chain(
        view(spark, folder, "snps"), SNP_NAMES, "diabetes", selection.Selection().thresholds
    )
    return rounded(chain.drop("position"), 6, "variance", "abs_r")


def _selection_sql(features: list[str]) -> str:
    pairs = [(a, b) for a, b in combinations(features, 2)]
    snp_pairs = list(combinations(SNP_NAMES, 2))
    return (
        "WITH pt AS (" + " UNION ALL ".join(f"SELECT '{a}' AS f, abs({_corr(a, 'diabetes')}) AS r FROM clean" for a in features)
        + "), pp AS (" + " UNION ALL ".join(f"SELECT '{b}' AS f, abs({_corr(a, b)}) AS r FROM clean" for a, b in pairs)
        + f"), ch AS ({_CHAIN}), ok AS (SELECT snp FROM ch WHERE {_PASSES}), sp AS ("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, abs({_corr(a, b)}) AS r FROM snps" for a, b in snp_pairs
        )
        + "), red AS (SELECT b FROM sp WHERE r > 0.98 AND a IN (SELECT snp FROM ok) AND b IN (SELECT snp FROM ok)) "
        "SELECT 'phenotypic' AS family, f AS feature, CASE WHEN coalesce(r < 0.05, false) OR f IN "
        "(SELECT f FROM pp WHERE r > 0.8) THEN 'dropped' ELSE 'selected' END AS status FROM pt UNION ALL "
        "SELECT 'genotype', snp, CASE WHEN snp IN (SELECT snp FROM ok) AND snp NOT IN (SELECT b FROM red) "
        "THEN 'selected' ELSE 'dropped' END FROM ch"
    )


CLINICAL = ["age", "hypertension", "heart_disease", "bmi", "hba1c_level", "blood_glucose_level"]


@query("feature_selection", _selection_sql(CLINICAL))
def feature_selection(spark, folder):
    pheno = clean_phenotypes(view(spark, folder, "pheno"), check=False)
    chosen = selection.fit_selection(pheno, CLINICAL, [], phenotype_target_corr_threshold=0.05)
    genetic = selection.fit_selection(view(spark, folder, "snps"), [], SNP_NAMES)
    log = chosen.to_frame(spark).unionByName(genetic.to_frame(spark))
    return log.select("family", "feature", "status")


def _chi_sql(rows: str, classes: str = "(0, 1)") -> str:
    """Chi-square per feature over ``rows`` (feature, level, y), Yates for 2 x 2."""
    return (
        f"WITH r AS (SELECT * FROM ({rows}) WHERE level IS NOT NULL AND y IN {classes}), "
        "lv AS (SELECT feature, level, count(*) AS rn FROM r GROUP BY 1, 2), "
        "cl AS (SELECT feature, y, count(*) AS cn FROM r GROUP BY 1, 2), "
        "tot AS (SELECT feature, count(*) AS n FROM r GROUP BY 1), "
        "dims AS (SELECT t.feature, t.n, (SELECT count(*) FROM lv WHERE lv.feature = t.feature) AS levels, "
        "(SELECT count(*) FROM cl WHERE cl.feature = t.feature) AS classes FROM tot t), "
        "ob AS (SELECT feature, level, y, count(*) AS o FROM r GROUP BY 1, 2, 3), "
        "cells AS (SELECT d.feature, d.n, d.levels, d.classes, coalesce(ob.o, 0) AS o, "
        "CAST(lv.rn AS DOUBLE) * cl.cn / d.n AS e FROM dims d JOIN lv ON lv.feature = d.feature "
        "JOIN cl ON cl.feature = d.feature LEFT JOIN ob ON ob.feature = lv.feature AND ob.level = lv.level AND ob.y = cl.y), "
        "stat AS (SELECT feature, n, levels, CASE WHEN levels >= 2 AND classes >= 2 THEN sum(pow(abs(o - e) - "
        "CASE WHEN levels = 2 AND classes = 2 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e) END AS statistic, "
        "CASE WHEN levels >= 2 AND classes >= 2 THEN CAST((levels - 1) * (classes - 1) AS INTEGER) END AS dof "
        "FROM cells GROUP BY feature, n, levels, classes)"
    )


_LEVELS = (
    "SELECT 'l_linenumber' AS feature, CAST(l_linenumber AS DOUBLE) AS level, y FROM src UNION ALL "
    "SELECT 'l_quantity', l_quantity, y FROM src UNION ALL "
    "SELECT 'status', CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END, y FROM src UNION ALL "
    "SELECT 'steady', 1, y FROM src"
)
_SRC = "(SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"


@query(
    "chi_square_tests",
    _chi_sql(_LEVELS.replace("FROM src", f"FROM {_SRC}"))
    + f" SELECT feature, n, levels, round(statistic, 6) AS statistic, dof, round({chi2_tail_sql('statistic', 'dof')}, 6) "
    "AS p_value FROM stat",
)
def chi_square_tests(spark, folder):
    line = table(spark, folder, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    groups = {
        "l_linenumber": F.col("l_linenumber"),
        "l_quantity": F.col("l_quantity"),
        "status": (F.col("l_linestatus") == "F").cast("int"),
        "steady": F.lit(1),
    }
    tested = hypothesis.chi_square(hypothesis.level_counts(line, groups, "y"))
    return rounded(tested, 6, "statistic", "p_value")


_ADJUST = (
    "adj AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(1.0, min(p * m / rk) OVER (ORDER BY rk DESC "
    "ROWS UNBOUNDED PRECEDING)) END AS q FROM (SELECT *, CASE WHEN p IS NOT NULL THEN "
    "row_number() OVER (PARTITION BY p IS NULL ORDER BY p) END AS rk, count(p) OVER () AS m FROM tests))"
)
_SNP_ROWS = "SELECT snp AS feature, dosage AS level, target AS y FROM long_snps WHERE dosage IN (0, 1, 2)"
_SCAN = (
    _chi_sql(_SNP_ROWS)
    + f", tests AS (SELECT feature AS snp, statistic, dof, {chi2_tail_sql('statistic', 'dof')} AS p FROM stat "
    f"WHERE statistic IS NOT NULL), {_ADJUST}"
)
_SCAN_SELECT = (
    "SELECT snp, round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, round(q, 6) AS p_fdr, q <= 0.05 AS significant FROM adj"
)


@query("snp_association_scan", f"{_SCAN} {_SCAN_SELECT}")
def snp_association_scan(spark, folder):
    scan = snp.snp_association(view(spark, folder, "snps"))
    return rounded(scan, 6, "statistic", "p_value", "p_fdr")


@query("long_snp_association_scan", f"{_SCAN} {_SCAN_SELECT}")
def long_snp_association_scan(spark, folder):
    """The scan for tables that arrive in long form, with any number of SNPs."""
    long = snp.to_long(view(spark, folder, "snps"), SNP_NAMES, ["patient_id", "diabetes"])
    return rounded(snp.association(snp.count_cube(long)), 6, "statistic", "p_value", "p_fdr")


@query("significant_snps", f"{_SCAN} SELECT snp, round(q, 6) AS p_fdr FROM adj WHERE q <= 0.05")
def significant_snps(spark, folder):
    return rounded(snp.significant_snps(view(spark, folder, "snps")), 6, "p_fdr")


@query("top_significant_snps", f"{_SCAN} SELECT snp, round(q, 6) AS p_fdr FROM adj WHERE q <= 0.05 ORDER BY q, snp LIMIT 2")
def top_significant_snps(spark, folder):
    return rounded(snp.top_significant(snp.snp_association(view(spark, folder, "snps")), 2), 6, "p_fdr")


@query(
    "top_snp_frequencies",
    f"{_SCAN}, top AS (SELECT snp FROM adj WHERE q <= 0.05 ORDER BY q, snp LIMIT 10) SELECT snp, "
    + ", ".join(f"round(avg(CASE WHEN dosage = {d} THEN 1 ELSE 0 END), 6) AS freq_{d}" for d in (0, 1, 2))
    + " FROM long_snps WHERE dosage IN (0, 1, 2) AND snp IN (SELECT snp FROM top) GROUP BY snp",
)
def top_snp_frequencies(spark, folder):
    cube = snp.snp_cube(view(spark, folder, "snps"))
    scan = snp.association(cube)
    return rounded(snp.genotype_frequencies(cube, scan, 10), 6, "freq_0", "freq_1", "freq_2")


def _welch_sql(source: str, features: list[str], y: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) FILTER (WHERE {y} = 0) AS n_0, count({c}) FILTER (WHERE {y} = 1) AS n_1, "
        f"avg({c}) FILTER (WHERE {y} = 0) AS m_0, avg({c}) FILTER (WHERE {y} = 1) AS m_1, "
        f"var_samp({c}) FILTER (WHERE {y} = 0) AS v_0, var_samp({c}) FILTER (WHERE {y} = 1) AS v_1 FROM {source}"
        for c in features
    )


_WELCH_STAT = (
    "SELECT feature, n_0, n_1, (m_0 - m_1) / nullif(sqrt(v_0 / n_0 + v_1 / n_1), 0) AS statistic, "
    "pow(v_0 / n_0 + v_1 / n_1, 2) / nullif(pow(v_0 / n_0, 2) / (n_0 - 1) + pow(v_1 / n_1, 2) / (n_1 - 1), 0) AS dof"
)


@query(
    "welch_tests",
    f"WITH {_LINE}, m AS ({_welch_sql('line', NUMBERS, 'y')}), t AS ({_WELCH_STAT} FROM m WHERE n_0 >= 2 AND n_1 >= 2) "
    f"SELECT feature, n_0, n_1, round(statistic, 5) AS statistic, round(dof, 3) AS dof, "
    f"round({t_tail_sql('statistic', 'dof')}, 6) AS p_value FROM t",
)
def welch_tests(spark, folder):
    tested = hypothesis.welch_test(_line(spark, folder), NUMBERS, "y")
    return rounded(rounded(rounded(tested, 5, "statistic"), 3, "dof"), 6, "p_value")


_P = "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE CAST(pow(CAST((o_orderkey * 7919) % 10007 AS DOUBLE) / 10007, 3) AS DOUBLE) END"


@query(
    "false_discovery_adjustment",
    f"WITH tests AS (SELECT o_orderkey AS test, {_P} AS p FROM orders), {_ADJUST} "
    "SELECT test, round(q, 6) AS p_fdr, coalesce(q <= 0.05, false) AS significant FROM adj",
)
def false_discovery_adjustment(spark, folder):
    tests = table(spark, folder, "orders").selectExpr("o_orderkey AS test", f"{_P} AS p_value")
    return rounded(hypothesis.fdr_adjust(tests), 6, "p_fdr").select("test", "p_fdr", "significant")


_SMOKING_CODE = "CASE " + " ".join(
    f"WHEN {c} = 1 THEN {i}" for i, c in reversed(list(enumerate(domain.SMOKING_LABELS)))
) + " END"
_RACE_CODE = "CASE " + " ".join(
    f"WHEN {c} = 1 THEN {i}" for i, c in reversed(list(enumerate(domain.RACE_LABELS)))
) + " END"
_SCREEN_ROWS = (
    "SELECT 'hypertension' AS feature, hypertension AS level, diabetes AS y FROM pheno UNION ALL "
    "SELECT 'heart_disease', heart_disease, diabetes FROM pheno UNION ALL "
    f"SELECT 'race', {_RACE_CODE}, diabetes FROM clean UNION ALL "
    f"SELECT 'smoking', {_SMOKING_CODE}, diabetes FROM clean"
)
SCREENED = ["year", "age", "bmi", "hba1c_level", "blood_glucose_level"]


@query(
    "feature_screen",
    _chi_sql(_SCREEN_ROWS)
    + f", m AS ({_welch_sql('pheno', SCREENED, 'diabetes')}), t AS ({_WELCH_STAT} FROM m WHERE n_0 >= 2 AND n_1 >= 2), "
    f"tests AS (SELECT feature, 'chi2' AS test_group, statistic, {chi2_tail_sql('statistic', 'dof')} AS p FROM stat UNION ALL "
    f"SELECT feature, 'ttest', statistic, {t_tail_sql('statistic', 'dof')} FROM t), {_ADJUST} "
    "SELECT feature, test_group, round(statistic, 5) AS statistic, round(p, 6) AS p_value, round(q, 6) AS p_fdr, "
    "coalesce(q <= 0.05, false) AS significant FROM adj",
)
def feature_screen(spark, folder):
    pheno = one_hot(cols.normalise_names(view(spark, folder, "pheno")), "smoking_history", domain.SMOKING_ANSWERS, "smoking")
    screen = hypothesis.feature_screen(pheno.drop("gender"))
    return rounded(rounded(screen.drop("dof"), 6, "p_value", "p_fdr"), 5, "statistic")


@query(
    "chi2_view_of_screen",
    _chi_sql(_SCREEN_ROWS) + " SELECT feature, round(statistic, 5) AS statistic, dof FROM stat",
)
def chi2_view_of_screen(spark, folder):
    pheno = one_hot(cols.normalise_names(view(spark, folder, "pheno")), "smoking_history", domain.SMOKING_ANSWERS, "smoking")
    screen = hypothesis.feature_screen(pheno.drop("gender")).where("test_group = 'chi2'")
    return integers(rounded(screen.select("feature", "statistic", "dof"), 5, "statistic"), "dof")
