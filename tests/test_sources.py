import json
import threading

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators import genotypes, quality
from cohortkit.plans import analysis
from cohortkit.plans.ingest import ingest_uploads
from cohortkit.session import broadcast_if_small, is_small, materialise, release_scratch, scratch_path
from cohortkit.sources import manifest, readers, writers
from tests.people import PHENO_COLUMNS, pheno_rows


def test_csv_types_follow_names_not_positions(spark, tmp_path):
    (tmp_path / "p.csv").write_text("diabetes,bmi,patient_id,extra\n1,20.5,7,x\n0,,8,\n")
    rows = readers.read_phenotypes(spark, str(tmp_path / "p.csv")).collect()
    assert [(r["patient_id"], r["bmi"], r["diabetes"], r["extra"]) for r in rows] == [(7, 20.5, 1, "x"), (8, None, 0, None)]
    assert readers.read_csv(spark, str(tmp_path / "p.csv")).schema["bmi"].dataType.simpleString() == "double"


def test_json_array(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"patient_id": 1, "bmi": 2.5}, {"patient_id": 2}], indent=1))
    assert {(r["patient_id"], r["bmi"]) for r in readers.read_json(spark, str(tmp_path / "p.json")).collect()} == {(1, 2.5), (2, None)}


def test_replace_keeps_the_old_table_when_the_check_fails(spark, store):
    name = store.phenotypes
    writers.replace_table(spark.range(3).withColumnRenamed("id", "patient_id"), name, folder=store.folder)

    def check(table):
        raise ValueError("bad")

    with pytest.raises(ValueError, match="bad"):
        writers.replace_table(spark.range(9).withColumnRenamed("id", "patient_id"), name, folder=store.folder, check=check)
    assert readers.count_rows(spark, name) == 3
    assert [t.name for t in spark.catalog.listTables(store.database)] == ["phenotypes_clean"]
    writers.replace_table(spark.table(name).union(spark.table(name)), name, folder=store.folder)
    assert readers.count_rows(spark, name) == 6


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_reader_never_misses_a_table_being_replaced(spark, store, buckets):
    name, folder = store.merged, store.folder if buckets else None

    def replace(content):
        rows = spark.range(100).select(F.col("id").alias("patient_id"), F.lit(content).alias("content"))
        writers.replace_table(rows, name, buckets=buckets, folder=folder)

    replace(0)
    session, seen, stop = spark.newSession(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                session.catalog.refreshTable(name)
                seen.append(tuple(session.table(name).agg(F.count("*"), F.min("content"), F.max("content")).first()))
            except Exception as error:
                seen.append(str(error))

    reader = threading.Thread(target=read)
    reader.start()
    for content in range(1, 5):
        replace(content)
    stop.set()
    reader.join()
    assert len(seen) > 2 and all(row[0] == 100 and row[1] == row[2] for row in seen), seen
    assert spark.table(name).first()["content"] == 4
    began = spark.table(name)  # files of the content before stay for it
    replace(5)
    assert began.count() == 100 and {r["content"] for r in began.collect()} == {4}
    writers.append_table(spark.table(name), name)
    assert spark.table(name).count() == 200


@pytest.mark.parametrize("step", ["SET LOCATION", "SET TBLPROPERTIES", "DROP TABLE", "RENAME TO"])
def test_a_replacement_that_stops_at_any_step_leaves_the_table_whole(spark, store, monkeypatch, step):
    name = store.merged
    rows = spark.range(3).withColumnRenamed("id", "patient_id")
    other = rows.withColumn("more", F.lit(1))  # another layout takes the two renames
    newer = other if step == "RENAME TO" else rows.unionByName(rows)
    writers.replace_table(rows, name, folder=store.folder)
    run = type(spark).sql

    def stopped(session, text, *args, **kwargs):
        if step in text:
            if step == "RENAME TO" and "__old" in text:
                return run(session, text, *args, **kwargs)  # stops at the second rename
            raise RuntimeError("stopped")
        return run(session, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        writers.replace_table(newer, name, folder=store.folder)
    monkeypatch.undo()
    if step != "RENAME TO":
        assert spark.table(name).count() == (3 if step == "SET LOCATION" else 6)
    writers.replace_table(newer, name, folder=store.folder)
    assert spark.table(name).columns == newer.columns and spark.table(name).count() == newer.count()


def test_append_matches_names_and_feature_store_matches_order(spark, store):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    writers.append_table(df, store.merged, folder=store.folder)
    writers.append_table(spark.createDataFrame([(20, 10)], "b int, a int"), store.merged, folder=store.folder)
    assert sorted(tuple(r) for r in spark.table(store.merged).select("a", "b").collect()) == [(1, 2), (10, 20)]
    with pytest.raises(ValueError, match="differ"):
        writers.append_table(df.drop("b"), store.merged, folder=store.folder)
    writers.append_feature_store(df, store.features, folder=store.folder)
    with pytest.raises(ValueError, match="schema mismatch"):
        writers.append_feature_store(df.select("b", "a"), store.features, folder=store.folder)


def test_bucketed_tables_join_without_a_shuffle(spark, store):
    for name in (store.phenotypes, store.genotypes):
        writers.replace_table(spark.range(1000).withColumnRenamed("id", "patient_id"), name, buckets=4, folder=store.folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table(store.phenotypes).join(spark.table(store.genotypes), "patient_id")
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 1000


def test_load_table_guards(spark, store):
    assert readers.count_rows(spark, store.merged) == 0
    writers.replace_table(pheno_rows(spark, []), store.merged, folder=store.folder)
    with pytest.raises(ValueError, match="empty"):
        readers.load_table(spark, store.merged)
    writers.replace_table(pheno_rows(spark, [{}]).drop("diabetes"), store.merged, folder=store.folder)
    with pytest.raises(ValueError, match="missing"):
        readers.load_table(spark, store.merged)


def test_registry_knows_its_names(spark):
    registry = readers.DatasetRegistry({"raw": ("Raw phenotype", lambda s: s.range(2))})
    df, label = registry.load(spark, "raw")
    assert (df.count(), label, registry.names) == (2, "Raw phenotype", ["raw"])
    with pytest.raises(ValueError, match="unknown dataset"):
        registry.load(spark, "other")


def test_manifest_of_real_files(spark, store, tmp_path):
    header = ",".join(PHENO_COLUMNS)
    files = {"good.csv": f"{header}\n{'1,' * 16}1\n", "norows.csv": f"{header}\n", "short.csv": "patient_id,bmi\n1,2\n", "empty.png": "", "ok.PNG": "x"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    kinds = {"good.csv": "phenotypic", "norows.csv": "phenotypic", "short.csv": "phenotypic", "empty.png": "image",
             "ok.PNG": "image", "gone.csv": "phenotypic", "good.CSV.exe": "phenotypic"}
    rows = [(str(tmp_path / n), k, "p1", "2025-12-25", True, "ui") for n, k in kinds.items()]
    uploads = spark.createDataFrame(
        rows, "path string, data_type string, patient_id string, registry_date string, consent_raw_storage boolean, source string"
    )
    folder = str(tmp_path)
    checked = manifest.validate_manifest(uploads, manifest.file_sizes(spark, folder), manifest.file_contents(spark, folder))
    errors = {r["path"].rsplit("/", 1)[1]: r["errors"] for r in checked.collect()}
    assert errors["good.csv"] == [] and errors["ok.PNG"] == []
    assert errors["norows.csv"] == ["tabular file has no rows"]
    assert errors["empty.png"] == ["file is missing or empty"]
    assert errors["gone.csv"] == ["file is missing or empty"]
    assert errors["good.CSV.exe"] == ["unsupported file format", "file is missing or empty"]
    assert errors["short.csv"][0].startswith("missing columns: year, gender")
    assert manifest.valid_uploads(checked).count() == 2
    undated = uploads.withColumn("registry_date", F.when(F.col("path").endswith("ok.PNG"), None).otherwise(F.col("registry_date")))
    done = ingest_uploads(undated, folder, store)
    assert done.where("size(errors) = 0").count() == 1
    assert done.where("path LIKE '%ok.PNG'").first()["errors"] == ["registry_date is missing"]
    assert [r["filename"] for r in spark.table(store.audit).collect()] == ["good.csv"]
    audit = writers.audit_rows(uploads).where("filename = 'good.csv'").first()
    assert audit["is_single_patient"] and audit["uploaded_at"] is not None


def test_unknown_kind_is_an_error(spark):
    df = spark.createDataFrame([("a.csv", "audio"), ("a.csv", None), ("a.vcf", "genotypic")], "path string, kind string")
    got = [r[0] for r in df.select(manifest.format_error(F.col("path"), F.col("kind"))).collect()]
    assert got == ["invalid data type", "invalid data type", None]


def test_consent_reports_every_broken_rule(spark):
    df = spark.createDataFrame([(False, True, True), (True, True, False), (True, True, True), (False, False, False)], "a boolean, b boolean, c boolean")
    errors = [len(r[0]) for r in df.select(quality.consent_errors(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert errors == [2, 1, 0, 0]


def test_duplicates_are_refused_only_with_raw_consent(spark):
    requests = spark.createDataFrame([(1, True), (2, True), (1, False), (3, None)], "patient_id int, consent_raw boolean")
    stored = spark.createDataFrame([(1,)], "patient_id int")
    assert quality.already_stored(requests, stored).count() == 1
    assert sorted(r["patient_id"] for r in quality.not_yet_stored(requests, stored).collect()) == [1, 2, 3]


def test_feature_catalogue_folds_complete_groups(spark):
    names = [*domain.RACE_LABELS, "smoking_never", "bmi", "rs1", "gender", "patient_id", "year", "location"]
    df = spark.createDataFrame([tuple([1] * len(names))], names)
    assert analysis.feature_names(df.columns, "relationship") == ["bmi", "gender", "race (encoded)", "rs1"]
    kinds = {r["feature"]: r["kind"] for r in analysis.feature_catalogue(df, "relationship").collect()}
    assert kinds == {"bmi": "numeric", "gender": "binary", "race (encoded)": "encoded", "rs1": "snp"}
    assert "smoking_never" in analysis.feature_names(df.columns)


def test_features_are_routed_to_their_analysis(spark):
    df = spark.createDataFrame([(0, 1.0, 2, 1, 0), (1, 3.0, 1, 0, 1)], "diabetes int, bmi double, rs1 int, raceasian int, raceother int")
    assert analysis.relationship(df, "race (encoded)").columns == ["code", "label", "class_0", "class_1"]
    assert analysis.relationship(df, "rs1", "anything").columns == ["level", "class_0", "class_1"]
    assert analysis.relationship(df, "bmi", "hist").count() == 60
    assert analysis.relationship(df, "bmi", "box").count() == 2
    assert analysis.relationship(df, "bmi", "scatter").count() == 2
    assert analysis.distribution(df, "rs1").count() == 3
    assert analysis.distribution(df, "bmi", "box", highlight_outliers=True).isEmpty()
    for feature, plot in (("patient_id", "hist"), ("gone", "hist"), ("bmi", "pie")):
        with pytest.raises(ValueError):
            analysis.relationship(df, feature, plot)


def test_only_tables_of_few_bytes_are_broadcast(spark):
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan(broadcast_if_small(spark.range(3)))
    assert "strategy=broadcast" not in plan(broadcast_if_small(spark.range(3), 10))


def test_csv_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("age,bmi\n60,21.5\n")
    (tmp_path / "b.csv").write_text("bmi,age\n22.5,61\n")
    (tmp_path / "c.csv").write_text('"race:other",age,"a, b"\n1,62,x\n')
    (tmp_path / "d.csv").write_text("age,bmi\n63,23.5\n")
    df = readers.read_csv(spark, str(tmp_path), {"age": "double", "bmi": "double", "race:other": "int"})
    assert sorted(df.columns) == ["a, b", "age", "bmi", "race:other"]
    got = sorted(tuple(r) for r in df.select("age", "bmi", "`race:other`", "`a, b`").collect())
    assert got == [(60.0, 21.5, None, None), (61.0, 22.5, None, None), (62.0, None, 1, "x"), (63.0, 23.5, None, None)]
    inferred = readers.read_csv(spark, str(tmp_path))
    assert dict(inferred.dtypes)["age"] == "int" and inferred.count() == 4


def test_header_names(spark):
    lines = ["a,b", '﻿"a,b", c ,"d ""x"""\r', "", '"a"']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
    got = [r["h"] for r in df.orderBy("i").select(manifest.header_names(F.col("x")).alias("h")).collect()]
    assert got == [["a", "b"], ["a,b", "c", 'd "x"'], [""], ["a"]]


def test_contents_of_json_and_upper_case_files(spark, tmp_path):
    (tmp_path / "a.JSON").write_text('[{"a": 1, "b": null},\n {"c": {"d": 2}}]')
    (tmp_path / "b.json").write_text('{"a": 1}')
    (tmp_path / "c.json").write_text("nothing")
    (tmp_path / "d.CSV").write_text('"a","b, c"\n1,2\n\n3,4\n')
    found = {r["path"].rsplit("/", 1)[1]: (r["header"], r["n_rows"]) for r in manifest.file_contents(spark, str(tmp_path)).collect()}
    assert found == {"a.JSON": (["a", "b", "c"], 2), "b.json": (["a"], 1), "c.json": ([], 0), "d.CSV": (["a", "b, c"], 2)}
    only = spark.createDataFrame([(f"{tmp_path}/d.CSV",)], "path string")
    assert [r["n_rows"] for r in manifest.file_contents(spark, str(tmp_path), only).collect()] == [2]


def test_long_genotypes(spark):
    rows = [(p, f"rs{s}", None if (p + s) % 19 == 0 else float((p * s + p // 3) % 3)) for p in range(60) for s in range(40)]
    rows += [(p, "rare", 0.0) for p in range(60)] + [(p, "missing", None if p % 5 == 0 else 1.0) for p in range(60)]
    rows += [(1, None, 2.0), (None, "rs1", None)]
    long = spark.createDataFrame(rows, "patient_id long, snp string, dosage double").repartition(4)
    report = {r["snp"]: r for r in genotypes.long_snp_quality(long).collect()}
    assert not report["rare"]["kept"] and not report["missing"]["kept"] and report["missing"]["missing_rate"] == pytest.approx(0.2)
    both = [genotypes.clean_long_genotypes(long, max_bytes=b) for b in (4 << 20, 0)]
    assert ["_salt" in d._jdf.queryExecution().analyzed().toString() for d in both] == [False, True]
    first, second = (sorted(map(repr, d.collect())) for d in both)
    assert first == second
    means = {s: r["mean_dosage"] for s, r in report.items() if r["kept"]}
    assert first == sorted(repr(Row(patient_id=p, snp=s, dosage=means[s] if d is None else d)) for p, s, d in rows if s in means)
    wide = genotypes.wide_genotypes(both[0].where("patient_id IS NOT NULL"), ["rs1", "rs2"])
    assert wide.count() == 60 and wide.columns == ["patient_id", "rs1", "rs2"]
    with pytest.raises(ValueError, match="invalid dosages"):
        genotypes.clean_long_genotypes(long.unionByName(spark.createDataFrame([(1, "rs3", 5.0)], long.schema)))
    assert genotypes.clean_long_genotypes(long.limit(0)).collect() == []
    with pytest.raises(ValueError, match="missing"):
        genotypes.clean_long_genotypes(long.drop("snp"))


def test_scratch_is_named_by_the_session_and_can_be_released(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    spark.range(1).write.parquet(scratch_path(spark, "x"))
    assert release_scratch(spark) and not release_scratch(spark)


def test_a_long_table_of_snps_is_merged_and_never_broadcast(spark):
    rows = [(p, f"rs{s}", float((p + s) % 3)) for p in range(9) for s in range(30)]
    long = spark.createDataFrame(rows, "patient_id long, snp string, dosage double")
    clean = genotypes.clean_long_genotypes(long, max_bytes=0)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, clean.collect())) == sorted(rows)


def test_rows_that_files_hold_in_little_space_are_not_small(spark):
    many = materialise(spark.range(300_000).select(F.lit("the same text").alias("a"), F.lit(1.0).alias("b")), "many")
    assert many.inputFiles() and not is_small(many, 1 << 18) and is_small(many, 1 << 22)


def test_long_queries_leave_no_view_behind(spark):
    from workload.genetics import long_snp_quality

    before = {t.name for t in spark.catalog.listTables()}
    spark.createDataFrame([(1, 1, 1)], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(
        f"{(folder := scratch_path(spark, 'given'))}/lineitem.parquet")
    assert long_snp_quality(spark, folder).count() == 1
    assert {t.name for t in spark.catalog.listTables()} == before


_JSON = {
    "flat": ('[{"a": 1, "b": null},\n {"c": "x"}]\n', ["a", "b", "c"], 2), "single": ('{"a":{"b":{}},"c":[1]} tail', ["a", "c"], 1),
    "brace": ('[{"a":"x}y","b":"\\"}{"},{"c":"]"}]', ["a", "b", "c"], 2), "quotes": ("[{'a':1},{'b':'}'}]", ["a", "b"], 2),
    "blanks": ('  \n[ \n{"z":1}\r\n,\t{"y":[{"q":1},{}]} , {} ]  ', ["z", "y"], 3), "nulls": ('[null, {"a":1}, null]', ["a"], 1),
    "garbage": ('[{"a":1}]{"b":2}', ["a"], 1), "lines": ('{"a":1}\n{"b":2}', ["a"], 1), "empty": ("[]", [], 0), "hollow": ("[{}]", [], 1),
    **{f"bad{i}": (text, [], 0) for i, text in enumerate([
        '[{"a":1},{"b":2}', '{"a":1', '[{"a":1},]', '[{"a":1} {"b":2}]', '[1, {"a":2}]', '[{"a":1},{"b":tru}]', '[{"a":{"b":tru}},{"c":1}]',
        '[{"a":1}}]', "[", "null", '[,{"a":1}]', '[["x"]]'])},
}


@pytest.mark.parametrize("size", ["128m", "8"])
def test_json_files_in_fragments(spark, tmp_path, size):
    for name, (text, _, _) in _JSON.items():
        (tmp_path / f"{name}.json").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = {r["path"].rsplit("/", 1)[1][:-5]: (r["header"], r["n_rows"]) for r in manifest.file_contents(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {name: (header, n) for name, (_, header, n) in _JSON.items()}


def test_a_json_file_is_never_read_as_one_row(spark, tmp_path):
    (tmp_path / "p.json").write_text("[" + ",\n".join(f'{{"a": {i}, "b": "x"}}' for i in range(5000)) + "]")
    longest = manifest._json_fragments(spark, str(tmp_path), lambda df: df).agg(F.max(F.length("value"))).first()[0]
    assert longest < 40
    row = manifest.file_contents(spark, str(tmp_path)).first()
    assert (row["header"], row["n_rows"]) == (["a", "b"], 5000)
