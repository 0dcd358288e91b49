import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from sparkrank import schemas
from sparkrank.functions.embedding import Embedder, HashedBow
from sparkrank.operators import evaluate, tracking
from sparkrank.operators.entities import COMPANIES, Dictionary
from sparkrank.plans import retrieve, track
from sparkrank.plans.index import StoredCollection, build_collection
from sparkrank.sources import collection as store
from sparkrank.sources import readers, writers

TS = dt.datetime(2025, 1, 2, 3, 4, 5)


def manifest(spark, entries):
    return spark.createDataFrame(list(entries.items()), "name string, md5 string")


def test_manifest_diff(spark):
    main = manifest(spark, {"x": "1", "y": "2", "z": "3", "n": None})
    current = manifest(spark, {"x": "1", "y": "9", "w": "4", "n": "5"})
    diff = tracking.with_new_versions(tracking.compare_manifests(main, current), F.lit("v1.0"))
    out = {r.name: (r.status, r.new_version) for r in diff.collect()}
    assert out == {
        "x": ("unchanged", None),
        "y": ("changed", "v1.1"),
        "w": ("new", "v1.0"),
        "n": ("new", "v1.0"),
        "z": ("missing", None),
    }
    assert tracking.integrity(diff).first().asDict() == {
        "data_integrity_passed": False, "n_unchanged": 1, "n_changed": 1, "n_new": 2, "n_missing": 1
    }
    entry = tracking.version_entries(diff, F.lit("v1.0")).first()
    assert (entry.changed_files, entry.new_files, entry.missing_files) == (["y"], ["n", "w"], ["z"])
    assert entry.data_version == tracking.UPDATED_VERSION and entry.intentional_data_update
    same = tracking.compare_manifests(main, main.filter("md5 is not null"))
    assert tracking.integrity(same.filter("name <> 'n'")).first().data_integrity_passed
    nothing = tracking.compare_manifests(main.limit(0), main.limit(0))
    assert tracking.integrity(nothing).first().data_integrity_passed


def runs(spark, rows):
    return spark.createDataFrame([(n, b, TS, "recall", v) for n, b, v in rows], schemas.RUNS)


def test_promotion(spark):
    main = runs(spark, [("m1", "main", 0.7), ("m2", "main", 0.79)])
    new = runs(spark, [("a", "dev", 0.80), ("b", "dev", 0.79), ("c", "main", 0.9), ("d", "prod", 0.9)])
    out = {r.run_name: r.promotion_status for r in tracking.promotion_decisions(new, main).collect()}
    assert out == {"a": "approved", "b": "skipped"}
    first = tracking.promotion_decisions(new, main.limit(0)).filter("run_name = 'b'").first()
    assert first.promotion_status == "approved" and first.main_score == 0.0
    assert tracking.best_run(main).first().run_name == "m2"
    assert tracking.best_run(main, branch="dev").count() == 0
    best = tracking.best_run_per_branch(main.unionByName(new)).collect()
    assert {r.branch: r.run_name for r in best} == {"main": "c", "dev": "a", "prod": "d"}
    assert tracking.latest_run(main).first().run_name == "m2"


def test_run_name_and_settings(spark):
    one = spark.range(1).select(tracking.run_name(F.lit("dev"), F.lit(TS)).alias("n"))
    assert one.first().n == "dev_run_20250102_030405"
    rows = spark.createDataFrame(
        [("r", {"splitter": {"chunk_size": "300"}, "data": {"a": "b"}})],
        "run_name string, settings map<string,map<string,string>>",
    )
    flat = tracking.flatten_settings(rows)
    assert {r.key: r.value for r in flat.collect()} == {"splitter.chunk_size": "300", "data.a": "b"}
    other = spark.createDataFrame([("splitter.chunk_size", "200"), ("x.y", "1")], "key string, value string")
    out = {r.key: (r.main, r.current, r.differs) for r in tracking.compare_settings(flat, other).collect()}
    assert out == {
        "splitter.chunk_size": ("300", "200", True), "data.a": ("b", None, True), "x.y": (None, "1", True)
    }


def test_readers_and_writers(spark, tmp_path):
    lines = tmp_path / "corpus.jsonl"
    lines.write_text('{"_id": "A1", "title": "t", "text": "x"}\n{"_id": "B2", "title": "", "text": "y z"}\n')
    docs = readers.read_documents(spark, str(lines))
    assert [tuple(r) for r in docs.orderBy("_id").collect()] == [("A1", "t", "x"), ("B2", "", "y z")]
    tsv = tmp_path / "judged.tsv"
    tsv.write_text("query_id\tcorpus_id\tscore\nq1\tA1\t1\n")
    assert tuple(readers.read_judgments(spark, str(tsv)).first()) == ("q1", "A1", 1)

    rows = spark.createDataFrame([("q2", 0.1, 0.5, 0.25), ("q1", 0.0, 0.0, 0.0)], schemas.METRICS)
    writers.write_metrics(rows, str(tmp_path / "metrics"))
    assert readers.read_metrics(spark, str(tmp_path / "metrics")).count() == 2
    log = str(tmp_path / "log")
    writers.append_log(rows.limit(1), log)
    writers.append_log(rows.limit(1), log)
    assert spark.read.json(log).count() == 2

    files = {"corpus": str(lines), "gone": str(tmp_path / "gone")}
    found = {r.name: r.md5 for r in readers.file_manifest(spark, files).collect()}
    assert found == {"corpus": hashlib.md5(lines.read_bytes()).hexdigest(), "gone": None}
    assert readers.file_manifest(spark, {"gone": files["gone"]}).first().md5 is None

    def mark(df):
        return readers.table_fingerprint(df).first().md5

    assert mark(docs) == mark(docs.repartition(3)) != mark(docs.limit(1))


def test_stored_collection_is_reused_and_follows_its_inputs(spark, tmp_path):
    rows = [(f"AAPL2023{i}", "AAPL report", f"text number {i} about phones", i) for i in range(6)]
    source = str(tmp_path / "docs")
    schema = "_id string, title string, text string, pos long"
    spark.createDataFrame(rows, schema).write.parquet(source)

    def stored():
        return StoredCollection(
            spark.read.parquet(source), Dictionary(COMPANIES), HashedBow(16), folder=str(tmp_path / "shared")
        )

    first = stored()
    assert first.table.count() == 6 and store.is_complete(spark, f"{first.path}/chunks")
    assert stored().path == first.path
    assert first.table.first().text.startswith("appl report text number")
    assert {r.word for r in first.weights.collect()} >= {"appl", "phones"}
    plan = first.table.filter("ticker = 'aapl'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan
    spark.createDataFrame([("V20231", "t", "x", 9)], schema).write.mode("append").parquet(source)
    assert stored().path != first.path and stored().table.count() == 7


def test_retrieval_end_to_end(spark, tmp_path):
    docs = spark.createDataFrame(
        [
            ("MSFT20230001", "MSFT cloud", "azure cloud revenue grew", 0),
            ("MSFT20230002", "MSFT games", "xbox games and consoles sold", 1),
            ("V20230001", "V cards", "cloud of cards and payments", 2),
        ],
        "_id string, title string, text string, pos long",
    )
    queries = spark.createDataFrame(
        [("q1", "", "MSFT cloud revenue?", 0), ("q2", "", "games and consoles", 1), ("q3", "", "Visa payments", 2)],
        "_id string, title string, text string, pos long",
    )
    judged = spark.createDataFrame(
        [("q1", "MSFT.20230001", 1), ("q2", "MSFT20230002", 1)], schemas.JUDGMENT
    )
    words = Dictionary(COMPANIES)
    embedder = HashedBow(64)
    coll = build_collection(docs, words, embedder)
    for options in ({}, {"strategy": "blocks"}):
        out = retrieve.retrieve_and_evaluate(
            queries, judged, words.table(spark), coll, embedder, **options
        ).orderBy("query_id").collect()
        assert [tuple(r) for r in out] == [("q1", 0.5, 1.0, 1.0), ("q2", 0.5, 1.0, 1.0)]

    def load():
        return lambda q, t: [1.0 if "games" in x else 0.0 for x in t]

    ranked = retrieve.retrieve_and_rerank(
        queries, None, words.table(spark), coll, embedder, scorer=retrieve.pair_scorer(load)
    )
    top = {r.query_id: r.corpus_id for r in ranked.filter("rank = 1").collect()}
    assert top == {"q1": "msft20230002", "q2": "msft20230002", "q3": "v20230001"}


def test_track_and_promote(spark, tmp_path):
    history = str(tmp_path / "runs")
    runs(spark, [("m", "main", 0.5)]).write.parquet(history)
    scores = spark.createDataFrame([("q", 0.1, 0.8, 0.3)], schemas.METRICS)
    run = track.run_rows(scores, F.lit("dev"), F.lit(TS))
    settings = spark.createDataFrame([("dev_run_20250102_030405", "splitter.size", "300")], schemas.RUN_PARAMS)
    main_settings = spark.createDataFrame([("splitter.size", "200")], "key string, value string")
    main, current = manifest(spark, {"x": "1"}), manifest(spark, {"x": "2"})
    folder = str(tmp_path / "out")
    decision = track.track_and_promote(
        run, settings, history, main, current, main_settings, F.lit("v1.0"), folder
    ).first()
    assert decision.promotion_status == "approved" and decision.main_score == 0.5
    assert decision.intentional_data_update and decision.data_version == tracking.UPDATED_VERSION
    assert spark.read.parquet(history).count() == 2
    entry = spark.read.json(f"{folder}/version_log").first()
    assert entry.run_name == "dev_run_20250102_030405"
    assert entry.changed_files == ["x"] and entry.changed_versions == ["v1.1"]
    assert (entry.timestamp, entry.branch, entry.commit) == ("20250102_030405", "dev", "unknown")
    assert spark.read.json(f"{folder}/model_version_log").first().differs
    section = spark.read.json(f"{folder}/section_log").first()
    assert (section.section, section.branch, section.current.size, section.main.size) == ("splitter", "dev", "300", "200")
    logged = {tuple(r) for r in spark.read.parquet(f"{folder}/run_params").collect()}
    assert logged == {("dev_run_20250102_030405", "splitter.size", "300")}


def test_parameters_sections_and_commits(spark):
    settings = spark.createDataFrame([("r", "embedding.type", "new"), ("r", "splitter.type", "s2"), ("r", "plain", "1")], schemas.RUN_PARAMS)
    main = spark.createDataFrame([("embedding.type", "old"), ("splitter.type", "s1"), ("vectordb.storage", "disk"), ("plain", "1")], "key string, value string")
    found = {r.section: r for r in tracking.model_entries(main, settings).collect()}
    assert {s: (r.type, r.storage, r.differs) for s, r in found.items()} == {
        "embedding": ("new", None, True), "splitter": ("s1", None, True), "vectordb": (None, "disk", True), "plain": (None, None, False)
    }
    files = spark.createDataFrame([("r", "corpus", "m"), ("r", "gone", None)], "run_name string, name string, md5 string")
    system = spark.createDataFrame([("r", "python", "3.13")], schemas.RUN_PARAMS)
    rows = {tuple(r)[1:] for r in tracking.parameter_rows(settings, files, system).collect()}
    assert rows >= {("data.corpus", "m"), ("data.gone", None), ("system.python", "3.13"), ("plain", "1")} and len(rows) == 6
    run = spark.createDataFrame([("r", "dev", TS)], "run_name string, branch string, ts timestamp")
    assert tracking.stamped(main.limit(1), run, commit=F.lit("abc")).first().commit == "abc"


def test_both_means(spark):
    scores = spark.createDataFrame([("a", 0.5, 1.0, 0.5), ("b", 0.1, 0.0, 0.5)], schemas.METRICS)
    judged = spark.createDataFrame([(q, "d", 1) for q in ("a", "a", "b", "c", "d", None)], schemas.JUDGMENT)
    row = evaluate.both_means(scores, judged).first()
    assert (row.n_queries, row.n_judged, row.recall, row.recall_zero_filled, row.map_zero_filled) == (2, 4, 0.5, 0.25, 0.25)


@pytest.mark.parametrize("buckets", [1, 8, 1000])
def test_manifests_by_buckets(spark, buckets):
    main = manifest(spark, {f"f{i}": None if i % 50 == 3 else str(i) for i in range(300)})
    changes = {f"f{i}": "other" if i == 7 else None if i % 50 == 3 else str(i) for i in range(299)} | {"new": "1"}
    for current in (manifest(spark, changes), main, main.filter("false")):
        got = tracking.compare_large_manifests(main, current, buckets)
        assert sorted(map(str, got.collect())) == sorted(map(str, tracking.compare_manifests(main, current).collect()))
    assert tracking.compare_large_manifests(main, main).count() == 300


def test_digests_of_many_and_of_very_large_files(spark, tmp_path):
    size = (2 << 30) + 12_345
    with open(tmp_path / "large", "wb") as out:
        out.truncate(size)  # takes no disk
    names = [f"n{i}" for i in range(1_000)]
    for name in names:
        (tmp_path / name).write_text(name * 3)
    (tmp_path / "empty").write_text("")
    listed = [(n, str(tmp_path / n)) for n in [*names, "large", "empty", "gone"]] + [("uri", f"file://{tmp_path}/n1"), ("folder", str(tmp_path))]
    found = {r.name: r.md5 for r in readers.file_manifest(spark, spark.createDataFrame(listed, "name string, path string")).collect()}
    zeros, expected = bytes(1 << 20), hashlib.md5()
    for at in range(0, size, 1 << 20):
        expected.update(zeros[: min(1 << 20, size - at)])
    assert found["large"] == expected.hexdigest() and found["empty"] == hashlib.md5(b"").hexdigest()
    assert found["gone"] is None and found["folder"] is None and found["uri"] == found["n1"]
    assert all(found[n] == hashlib.md5((n * 3).encode()).hexdigest() for n in names) and len(found) == len(listed)
    with open(tmp_path / "large", "wb"):
        pass


def test_scores_that_are_no_numbers_do_not_count(spark):
    nan = float("nan")
    main = runs(spark, [("m1", "main", nan), ("m2", "main", 0.5), ("m3", "main", None)])
    assert tracking.best_run(main).first().run_name == "m2"
    assert tracking.best_run_per_branch(main).first().run_name == "m2"
    assert tracking.best_run(main.filter("run_name <> 'm2'")).count() == 0
    new = runs(spark, [("a", "dev", 0.9), ("b", "dev", nan), ("c", "dev", None)])
    out = {r.run_name: (r.promotion_status, r.main_score) for r in tracking.promotion_decisions(new, main).collect()}
    assert out == {"a": ("approved", 0.5), "b": ("skipped", 0.5), "c": ("skipped", 0.5)}


def test_stored_collection_tells_rows_models_and_options_apart(spark, tmp_path):
    rows = [(f"AAPL2023{i}", "AAPL report", f"text number {i} about phones", i) for i in range(20)]
    source = str(tmp_path / "docs")
    spark.createDataFrame(rows, "_id string, title string, text string, pos long").write.parquet(source)
    docs = spark.read.parquet(source)

    def stored(rows=docs, model=None, words=None, **options):
        model = model or HashedBow(16)
        return StoredCollection(rows, words or Dictionary(COMPANIES), model, folder=str(tmp_path / "shared"), **options)

    few = stored(docs.filter("pos < 10"))
    assert stored().table.count() == 20 and few.table.count() == 10
    table = Dictionary(COMPANIES).table(spark)

    def load():
        return lambda texts: [[1.0]] * len(texts)

    paths = [
        stored().path, few.path, stored(model=HashedBow(8)).path, stored(size=100).path, stored(version="2").path,
        stored(clean={"substring": True}).path, stored(words=table).path, stored(words=table.limit(3)).path,
        stored(model=Embedder(load, 1, "a")).path, stored(model=Embedder(load, 1, "b")).path,
    ]
    assert len(set(paths)) == len(paths)
    with pytest.raises(ValueError):
        stored(model=Embedder(load, 1))


def test_a_dictionary_table_of_any_size_builds_a_collection(spark):
    many = spark.range(5_000).select(
        F.concat(F.lit("c"), "id").alias("company"), F.concat(F.lit("t"), "id").alias("ticker"), F.col("id").alias("pos")
    )
    assert Dictionary.fitting(many) is many and isinstance(Dictionary.fitting(many.limit(9)), Dictionary)
    docs = spark.createDataFrame(
        [("T4321.1", "T4321 rose", "words", 0), ("1A", "none", "other words", 1)],
        "_id string, title string, text string, pos long",
    )
    out = {r._id: r for r in build_collection(docs, many, HashedBow(8)).collect()}
    assert len(out) == 2 and any(r.text.startswith("c4321 rose") for r in out.values())


def test_bad_rows_are_put_aside(spark, tmp_path):
    lines = ['{"_id": "A", "title": "t", "text": "x"}', '{"_id": "B"', "no json", '{"_id": "C", "title": null, "text": "y"}']
    (tmp_path / "docs.jsonl").write_text("\n".join(lines))
    good = readers.read_with_quarantine(spark, str(tmp_path / "docs.jsonl"), "documents", str(tmp_path / "bad"), tolerated=0.5)
    assert sorted(r._id for r in good.select("_id").collect()) == ["A", "C"]
    aside = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.line for r in aside) == sorted(lines[1:3]) and all(r.file.endswith("docs.jsonl") and r.block == 0 for r in aside)
    with pytest.raises(readers.TooManyBadRows, match="2 of 4"):
        readers.read_with_quarantine(spark, str(tmp_path / "docs.jsonl"), "documents", str(tmp_path / "bad2"), tolerated=0.4)
    (tmp_path / "j.tsv").write_text("query_id\tcorpus_id\tscore\nq1\tA\t1\nq2\tB\tone\nq3\n")
    good = readers.read_with_quarantine(spark, str(tmp_path / "j.tsv"), "judgments", str(tmp_path / "bad3"), tolerated=0.9)
    assert [r.query_id for r in good.select("query_id").collect()] == ["q1"]
    (tmp_path / "m.csv").write_text("query_id,precision,recall,map\nq1,0.5,1.0,x\nq2,0.1,0.2,0.3\n")
    good = readers.read_with_quarantine(spark, str(tmp_path / "m.csv"), "metrics", str(tmp_path / "bad4"), tolerated=0.5)
    assert [r.query_id for r in good.select("query_id").collect()] == ["q2"]
