import time
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators.selection import Selection
from cohortkit.operators.training import Grid
from cohortkit.plans import arrivals
from cohortkit.plans.cohort import build_feature_store, run_cohort, store_sizes
from cohortkit.plans.featurize import store_features, transform_features
from cohortkit.plans.preprocess import preprocess_cohort, preprocess_patients
from cohortkit.session import scratch_path
from cohortkit.sources.writers import replace_table
from cohortkit.streaming import arrivals as stream_arrivals
from cohortkit.streaming.arrivals import arriving, mark_scored_before, score_stream
from tests.conftest import new_store
from tests.people import five_patients, geno_rows, pheno_rows

SNPS = ["rs1", "rs2"]


def _one(spark):
    return pheno_rows(spark, [{"patient_id": 1, "year": 2015.0}]), geno_rows(spark, {1: 1})


def test_patient_without_consent_is_processed_and_not_stored(spark, store):
    done = preprocess_patients(*_one(spark), store, registry_date="2025-12-25", consent_to_store=False)
    assert done.joined.count() == 1 and done.stored is False
    assert spark.catalog.listTables(store.database) == []
    assert domain.REGISTRY_DATE not in done.joined.columns


def test_patient_with_consent_is_stored(spark, store):
    done = preprocess_patients(*_one(spark), store, registry_date="2025-12-25", consent_to_store=True)
    assert done.stored and spark.table(store.merged).count() == 1
    assert str(spark.table(store.merged).first()["registry_date"]) == "2025-12-25"


def test_cohort_without_consent_is_refused(spark, store):
    with pytest.raises(PermissionError):
        preprocess_cohort(*_one(spark), store, registry_date="2025-12-25", consent_to_store=False)
    assert spark.catalog.listTables(store.database) == []
    with pytest.raises(ValueError, match="needs phenotypic and genotypic"):
        preprocess_cohort(None, None, store, registry_date=None, consent_to_store=True)


def test_cohort_with_consent_is_stored(spark, store):
    done = preprocess_cohort(*_one(spark), store, registry_date="2025-12-25", consent_to_store=True, buckets=2)
    assert done.stored and spark.table(store.merged).count() == 1
    assert set(domain.SNPS) <= set(done.joined.columns)


def test_unmatched_patients_are_reported_and_the_rest_go_on(spark, store):
    done = preprocess_cohort(*five_patients(spark), store, registry_date="2025-12-25", consent_to_store=True)
    assert done.joined.count() == 4 and [r["patient_id"] for r in done.unmatched.collect()] == [15]
    pheno = pheno_rows(spark, [{"patient_id": 9}])
    with pytest.raises(ValueError, match="no matching genotype"):
        preprocess_patients(pheno, geno_rows(spark, {8: 1}), store, registry_date=None, consent_to_store=False)


def test_bad_cohort_leaves_no_table(spark, store):
    pheno = pheno_rows(spark, [{"patient_id": 1, "age": 130.0}])
    with pytest.raises(ValueError, match="age"):
        preprocess_cohort(pheno, geno_rows(spark, {1: 1}), store, registry_date=None, consent_to_store=True)
    assert spark.catalog.listTables(store.database) == []


def _cohort(spark, n=240):
    rng = np.random.default_rng(10)
    y = rng.integers(0, 2, n)
    pheno = [
        {"patient_id": i, "bmi": float(24 + 8 * y[i] + rng.normal() * 3), "hba1c_level": float(5.5 + y[i] + rng.random()),
         "age": float(rng.integers(20, 80)), "gender": ["Female", "Male"][i % 2], "diabetes": int(y[i])}
        for i in range(n)
    ]
    geno = {i: [int(np.clip(y[i] + rng.integers(0, 2), 0, 2)), int(rng.integers(0, 3))] for i in range(n)}
    return pheno_rows(spark, pheno), geno_rows(spark, geno, SNPS)


@pytest.fixture(scope="module")
def trained(spark):
    """One trained cohort; tests work on copies of its tables."""
    store = new_store(spark)
    preprocess_cohort(*_cohort(spark), store, registry_date="2025-12-25", consent_to_store=True)
    result = run_cohort(
        spark, store, scratch_path(spark, "model"), grid=Grid((1.0,), (5,), (3,)), candidates=["logistic_regression"]
    )
    assert result.metadata["best_score"] > 0.8
    return store, arrivals.Scoring(*store.load_fits(spark), Selection.from_frame(spark.table(store.selection)), result.model)


@pytest.fixture()
def scoring(spark, store, trained):
    base, fitted = trained
    for name in ("phenotypes", "genotypes", "merged", "features"):
        replace_table(spark.table(getattr(base, name)), getattr(store, name), folder=store.folder)
    return fitted


def _batch(spark):
    """Six arrivals: all consents, none, inconsistent, bad date, no genotype, out of range; one known already."""
    people = pheno_rows(spark, [
        {"patient_id": 1000, "diabetes": 1, "bmi": 40.0}, {"patient_id": 1001}, {"patient_id": 1002}, {"patient_id": 1003},
        {"patient_id": 1004}, {"patient_id": 1005, "bmi": 5.0}, {"patient_id": 5},
    ])
    geno = geno_rows(spark, {k: [1, 2] for k in (1000, 1001, 1002, 1003, 1005, 5)}, SNPS)
    flags = spark.createDataFrame(
        [(1000, "2026-01-01", True, True, True), (1001, "2026-01-02", False, False, False), (1002, "2026-01-02", True, True, False),
         (1003, "01-01-2026", True, True, True), (1004, "2026-01-01", True, True, True), (1005, "2026-01-01", True, True, True),
         (5, "2026-01-01", True, True, True)],
        "patient_id bigint, registry_date string, consent_raw boolean, consent_integrate boolean, consent_retrain boolean",
    )
    return arrivals.join_arrivals(people, geno, flags)


STATUS = {1000: "scored", 1001: "scored", 1002: "rejected", 1003: "rejected", 1004: "rejected", 1005: "rejected", 5: "rejected"}


def test_arrivals_are_scored_then_stored_by_consent(spark, store, scoring):
    before = store_sizes(spark, store)
    done = arrivals.process_arrivals(_batch(spark), scoring, store)
    rows = {r["patient_id"]: r for r in done.collect()}
    assert {k: r["status"] for k, r in rows.items()} == STATUS
    assert rows[1000]["y_prob"] > rows[1001]["y_prob"] and rows[1004]["y_prob"] is None
    assert rows[1004]["errors"] == ["no matching genotype"] and rows[1005]["errors"] == ["invalid bmi"]
    assert rows[5]["errors"] == ["patient is already stored"]
    after = store_sizes(spark, store)
    assert {n: after[n] - before[n] for n in after} == {n: 1 for n in after}  # only 1000 gave consent
    stored = spark.table(store.features).where("patient_id = 1000").first()
    assert stored["diabetes"] == 1
    # The same batch again stores nothing.
    arrivals.store_arrivals(_batch(spark), done, scoring, store)
    assert store_sizes(spark, store) == after


def test_twice_in_one_batch_is_rejected(spark, store, scoring):
    batch = _batch(spark).where("patient_id = 1000")
    done = arrivals.score_arrivals(batch.unionByName(batch), scoring, store)
    assert {r["status"] for r in done.collect()} == {"rejected"}


def test_stream_gives_the_batch_results_and_survives_a_replay(spark, store, scoring):
    batch = _batch(spark)
    source, results = scratch_path(spark, "arriving"), scratch_path(spark, "results")
    batch.repartition(3, "patient_id").write.parquet(source)

    def run(progress):
        stream = score_stream(arriving(spark, source, batch.schema, max_files=1), scoring, store, results, progress).start()
        stream.awaitTermination()
        return {r["patient_id"]: r["status"] for r in spark.read.parquet(results).collect()}

    assert run(scratch_path(spark, "progress")) == STATUS
    sizes = store_sizes(spark, store)
    # Progress lost: every micro-batch runs again, keeps its results and stores nothing twice.
    assert run(scratch_path(spark, "progress")) == STATUS
    assert store_sizes(spark, store) == sizes


def test_stream_scores_a_patient_once_whatever_was_stored(spark, store, scoring):
    """Patient 1001 consents to nothing, so no table knows it; 1005 is rejected first and then corrected."""
    first = _batch(spark)
    keyless = first.where("patient_id = 1002").withColumn("patient_id", F.lit(None).cast("bigint"))
    second = first.where("patient_id in (1000, 1001)").unionByName(
        first.where("patient_id = 1005").withColumn("bmi", F.lit(25.0).cast(first.schema["bmi"].dataType))
    ).unionByName(keyless).unionByName(keyless)
    source, results, progress = (scratch_path(spark, label) for label in ("arriving", "results", "progress"))

    def run(rows, **options):
        rows.coalesce(1).write.mode("append").parquet(source)
        score_stream(arriving(spark, source, first.schema), scoring, store, results, progress, **options).start().awaitTermination()
        done = spark.read.parquet(results)
        last = done.agg(F.max("batch")).first()[0]
        return [(r["patient_id"], r["status"], r["errors"]) for r in done.where(F.col("batch") == last).collect()]

    assert {k: status for k, status, _ in run(first)} == STATUS
    got = sorted(run(second), key=lambda r: (r[0] is None, r[0] or 0))
    assert [(k, status) for k, status, _ in got] == [
        (1000, "rejected"), (1001, "rejected"), (1005, "scored"), (None, "rejected"), (None, "rejected"),
    ]
    assert got[1][2] == ["patient was scored before"]
    # The two rows without a key stay two rows, each with that reason.
    assert all("patient_id is missing" in errors for _, _, errors in got[3:])


def _marked(spark, rows, paths, **options):
    """The last micro-batch's rows, marked by a stream over all files so far."""
    source, sink, progress = paths
    rows.coalesce(1).write.mode("append").parquet(source)
    fitted = SimpleNamespace(geno_fit=SimpleNamespace(snps=SNPS))
    batches = []

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        batches.append(number)

    mark_scored_before(arriving(spark, source, rows.schema), fitted, **options).writeStream.foreachBatch(keep).option(
        "checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    # A batch without new data only lets state run out; the one before it holds the rows.
    frames = [spark.read.parquet(f"{sink}/batch={n}") for n in batches]
    return next(f for f in reversed(frames) if not f.isEmpty())


def test_state_marks_patients_and_changes_no_value(spark):
    paths = [scratch_path(spark, label) for label in ("arriving", "marked", "progress")]
    first = _batch(spark).withColumn("age", F.when(F.col("patient_id") != 1001, F.col("age")))
    twice = first.where("patient_id = 5")
    got = _marked(spark, first.unionByName(twice), paths)
    assert not any(r["scored_before"] for r in got.collect())
    back = got.drop("scored_before")
    assert back.schema.simpleString() == first.schema.simpleString()
    assert back.exceptAll(first.unionByName(twice)).isEmpty() and got.count() == first.count() + 1
    keyless = first.where("patient_id = 1000").withColumn("patient_id", F.lit(None).cast("bigint"))
    second = _marked(spark, first.unionByName(keyless).unionByName(keyless), paths).collect()
    marks = {r["patient_id"]: r["scored_before"] for r in second}
    # Valid single rows are remembered; rejected rows and rows that came twice are not.
    assert marks == {1000: True, 1001: True, **dict.fromkeys((1002, 1003, 1004, 1005, 5, None), False)}
    assert sum(r["patient_id"] is None for r in second) == 2


def test_state_takes_a_row_as_one_column_whatever_its_texts(spark):
    fitted = SimpleNamespace(geno_fit=SimpleNamespace(snps=SNPS))
    paths = [scratch_path(spark, label) for label in ("arriving", "marked", "progress")]
    texts = ['a "quoted" one', "two\nlines\t\\n", "", "\u00e9\u4e2d\U0001f600", "{}"]
    odd = _batch(spark).where("patient_id = 1000").drop("location").crossJoin(
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, None)], "at long, location string"))
    odd = odd.withColumn("patient_id", F.col("patient_id") + F.col("at")).drop("at")
    got = _marked(spark, odd, paths).drop("scored_before")
    assert got.count() == 6 and got.select(*odd.columns).exceptAll(odd).isEmpty()
    plan = mark_scored_before(arriving(spark, paths[0], odd.schema), fitted)._jdf.queryExecution().analyzed().toString()
    state = next(line for line in plan.splitlines() if "FlatMapGroupsInPandasWithState" in line)
    assert "location" not in state and "_row" in state


def test_state_ends_with_its_time_limit(spark):
    paths = [scratch_path(spark, label) for label in ("arriving", "marked", "progress")]
    batch = _batch(spark)
    for patient in (1001, 1003, 1001):  # the state of 1001 runs out in the batch of 1003, which leaves none
        got = _marked(spark, batch.where(F.col("patient_id") == patient), paths, days=1e-6, clock_skew="0 seconds")
        assert [r["scored_before"] for r in got.collect()] == [False]
        time.sleep(0.3)


def test_patients_share_states_and_each_keeps_its_own_limit(spark, monkeypatch):
    monkeypatch.setattr(stream_arrivals, "STATE_GROUPS", 1)
    paths = [scratch_path(spark, label) for label in ("arriving", "marked", "progress")]
    one = _batch(spark).where("patient_id = 1000")
    many = one.crossJoin(spark.range(300)).withColumn("patient_id", F.col("id") + 5000).drop("id")
    limits = {"days": 1e-5, "clock_skew": "0 seconds"}
    assert not any(r["scored_before"] for r in _marked(spark, many, paths, **limits).collect())
    time.sleep(1.2)
    again = _marked(spark, many.where("patient_id = 5000"), paths, days=30, clock_skew="0 seconds").collect()
    assert [r["scored_before"] for r in again] == [True]
    # The batch without data that followed let the others run out, but not the one that had come again.
    back = _marked(spark, many.where("patient_id < 5003"), paths, **limits).collect()
    assert {r["patient_id"]: r["scored_before"] for r in back} == {5000: True, 5001: False, 5002: False}
    assert spark.read.format("statestore").load(paths[2]).count() == 1


def test_feature_store_needs_labels_and_selected_features(spark, store, scoring):
    merged = spark.table(store.merged)
    with pytest.raises(ValueError, match="label"):
        store_features(merged.drop("diabetes"), scoring.selection, store)
    with pytest.raises(ValueError, match="missing columns"):
        transform_features(merged.drop("rs1"), Selection(["age"], {}, ["rs1"]))
    matrix = transform_features(merged, scoring.selection)
    assert matrix.columns == ["patient_id", *scoring.selection.features]


def test_steps_need_the_step_before(spark, store):
    with pytest.raises(RuntimeError, match="analysis_master is missing or empty"):
        build_feature_store(spark, store)


def test_an_engineered_patient_row(spark):
    row = {"patient_id": "p-7", "year": 2022, "registry_date": "2022-09-03", "gender": 0, "age": 44, "location": "north",
           "raceother": 1, "hypertension": 0, "heart_disease": 1, "bmi": 24.2, "hba1c_level": 5.5, "blood_glucose_level": 101,
           "diabetes": 0, "smoking_never": 0, "smoking_former": 0, "smoking_current": 1, "smoking_not_current": 0,
           "smoking_no_info": 0, "smoking_ever": 0, "rs9554188": 2}
    df = spark.createDataFrame([tuple(row.values())], list(row))
    wanted = Selection(["bmi_group", "age_group", "metabolic_risk_score", "smoking_ordinal"], {}, ["rs9554188"])
    assert tuple(transform_features(df, wanted).first()) == ("p-7", 1, 1, 1, 3, 2)
