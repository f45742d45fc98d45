import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle.operators import boosting, scoring
from brindle.session import settle, shared_folder
from brindle.sources import synthetic, tables as src
from brindle.streaming import streams as st


def test_sensor_readings_are_seeded_and_in_range(spark):
    df = synthetic.sensor_readings(spark, 5000, 10, 20, seed=1)
    low = df.agg(F.min("device_id"), F.max("device_id"), F.min("trip_id"), F.max("trip_id"), F.min("sensor_reading"), F.max("sensor_reading")).first()
    assert tuple(low)[:4] == (0, 9, 0, 19) and 0 <= low[4] and low[5] < 1000
    again = synthetic.sensor_readings(spark, 5000, 10, 20, seed=1).repartition(3)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))
    assert df.exceptAll(synthetic.sensor_readings(spark, 5000, 10, 20, seed=2)).count() > 0


def test_feature_table(spark):
    df = synthetic.feature_table(spark, 2000)
    assert df.dtypes == [("sensor1", "float"), ("sensor2", "float"), ("sensor3", "float"), ("result", "string")]
    assert {r.result for r in df.select("result").distinct().collect()} == set(synthetic.CLASSES)
    top = df.agg(*[F.max(c) for c in synthetic.SENSORS]).first()
    assert [t <= high for t, (_, high) in zip(top, synthetic.SENSORS.values())] == [True] * 3


@pytest.mark.parametrize("kind, settings", [("boosted", {"rounds": 2}), ("forest", {"numTrees": 5}), ("logistic", {"maxIter": 5})])
def test_classifier_scores_every_row(spark, kind, settings):
    df = synthetic.feature_table(spark, 1000)
    model, test = scoring.train_classifier(df, list(synthetic.SENSORS), "result", kind=kind, **settings)
    assert 200 < test.count() < 400
    scored = scoring.score_topn(df, model, 3)
    assert scored.columns[4:] == [f"predicted_{what}_{i}" for i in (1, 2, 3) for what in ("class", "probability")]
    assert scored.count() == 1000
    assert scored.filter("predicted_probability_1 < predicted_probability_2 OR predicted_class_1 = predicted_class_2").isEmpty()
    assert kind == "boosted" or "Python" not in scored._jdf.queryExecution().executedPlan().toString()


def _exact_boosting(x, y, labels, model, rounds, depth, rate, penalty, least):
    """Plain boosting on the coded features, node by node."""
    codes = model.codes([x[:, k] for k in range(x.shape[1])]).astype(int)
    margins = np.tile(model.prior, (len(x), 1))
    for _ in range(rounds):
        p = boosting.softmax(margins)
        for k, name in enumerate(labels):
            g, h = (y == name) - p[:, k], p[:, k] * (1 - p[:, k])

            def grow(rows, level):
                worth = lambda r: g[r].sum() ** 2 / (h[r].sum() + penalty)
                best = (0, None)
                if level < depth:
                    for f in range(codes.shape[1]):
                        for cut in range(32):
                            left, right = rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]
                            if h[left].sum() >= least and h[right].sum() >= least:
                                gain = round(worth(left) + worth(right) - worth(rows), 9)
                                if gain > best[0]:
                                    best = (gain, (left, right))
                if best[1] is None:
                    margins[rows, k] += rate * g[rows].sum() / (h[rows].sum() + penalty)
                else:
                    for side in best[1]:
                        grow(side, level + 1)

            grow(np.arange(len(x)), 0)
    return boosting.softmax(margins)


def test_boosted_trees_equal_plain_boosting(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, 3))
    x[::17, 1] = np.nan
    y = np.array(["a", "b", "c"])[np.where(x[:, 0] > 0.3, 0, np.where(x[:, 2] > 0, 1, 2))]
    df = spark.createDataFrame([(*map(float, r), c) for r, c in zip(x, y)], "u double, v double, w double, label string").repartition(5)
    model = boosting.fit_boosted_trees(df, ["u", "v", "w"], "label", rounds=3, depth=2)
    want = _exact_boosting(x, y, ["a", "b", "c"], model, 3, 2, 0.3, 1.0, 1e-3)
    got = {tuple(np.nan_to_num(r[:3], nan=9.0)): r.p for r in model.add_probabilities(df, "p").collect()}
    assert np.allclose([got[tuple(np.nan_to_num(r, nan=9.0))] for r in x], want)


def test_boosted_trees_are_no_worse_than_a_forest(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    names = [f"s{k}" for k in range(64)]
    df = vectors.select("vec_id", *[F.col("embedding")[k].alias(n) for k, n in enumerate(names)], F.concat(F.lit("c"), "label").alias("label"))
    shares = {}
    for kind, settings in (("boosted", {"rounds": 5}), ("forest", {"numTrees": 20, "seed": 42})):
        model, test = scoring.train_classifier(df, names, "label", key="vec_id", kind=kind, **settings)
        top = scoring.score_topn(test, model, 1)
        shares[kind] = top.agg(F.avg((F.col("label") == F.col("predicted_class_1")).cast("int"))).first()[0]
    assert shares["boosted"] >= shares["forest"] - 0.03, shares


def test_csv_with_line_ends_and_quotes(spark, tmp_path):
    rows = [("a", 'one\ntwo "quoted", and more'), ("b", "plain")]
    src.write_csv_table(spark.createDataFrame(rows, "k string, text string"), str(tmp_path / "csv"))
    back = src.read_csv_table(spark, str(tmp_path / "csv"), "k string, text string")
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_is_read_in_splits(spark, tmp_path):
    rng = np.random.default_rng(8)
    bits = ["a", "b c", '"', ",", "\n", "x" * 40, "\n\n", "é"]
    rows = [(k, "".join(rng.choice(bits, rng.integers(0, 30))) or None, float(k)) for k in range(300)]
    rows.append((300, "long\n" * 3000, 0.5))  # one record over many splits
    schema = "k int, text string, v double"
    df = spark.createDataFrame(rows, schema)
    src.write_csv_table(df.coalesce(2), str(tmp_path / "csv"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        back = src.read_csv_table(spark, str(tmp_path / "csv"), schema)
        splits = spark.read.text(str(tmp_path / "csv")).rdd.getNumPartitions()
        got = sorted(map(tuple, back.collect()))
        names = src.read_csv_table(spark, str(tmp_path / "csv")).columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    one_task = spark.read.options(header=True, multiLine=True, quote='"', escape='"').schema(schema).csv(str(tmp_path / "csv"))
    assert splits > 10 and got == sorted(map(tuple, one_task.collect())) == rows
    assert names == ["k", "text", "v"]


def test_code_corpus(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.c").write_text("int a;\nint ü;\n", encoding="utf-8")
    (tmp_path / "sub" / "b.c").write_text("int b;")
    (tmp_path / "c.h").write_text("no")
    got = {r.path.rsplit("/", 1)[1]: r.content for r in src.read_code_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a.c": "int a;\nint ü;\n", "b.c": "int b;"}


def test_tables_replace_and_merge(spark, tmp_path):
    src.reset_schema(spark, ["notes", "work"])
    src.write_table(spark.createDataFrame([(1, "x")], "id int, old string"), "notes.t")
    src.write_table(spark.createDataFrame([(2, 0.5)], "id int, new double"), "notes.t", merge_schema=True)
    assert spark.table("notes.t").collect() == [(2, 0.5, None)]
    src.write_table(spark.createDataFrame([(3,)], "id int"), "notes.t")
    assert src.read_table(spark, "notes.t").columns == ["id"]
    src.reset_schema(spark, ["notes"])
    assert not spark.catalog.tableExists("notes.t") and spark.catalog.databaseExists("work")


def test_document_map_and_noop(spark):
    df = spark.createDataFrame([({"a": ["x", "y"], "b": []},)], "m map<string, array<string>>")
    assert sorted(map(tuple, src.explode_document_map(df, "m").collect())) == [("a", "x"), ("a", "y")]
    src.noop_sink(df)


def test_sync_embeds_only_new_keys(spark):
    chunks = spark.createDataFrame([("a",), ("b",), ("b",)], "chunk_id string")
    index = spark.createDataFrame([("b", "kept"), ("gone", "kept")], "chunk_id string, v string")
    synced = src.incremental_sync(chunks, index, embed=lambda new: new.withColumn("v", F.lit("new")))
    assert sorted(map(tuple, synced.collect())) == [("a", "new"), ("b", "kept")]
    assert sorted(map(tuple, src.incremental_sync(chunks, synced, embed=lambda new: new.withColumn("v", F.lit("x"))).collect())) == [("a", "new"), ("b", "kept")]


def test_settled_tables_live_in_the_checkpoint_folder(spark):
    df = settle(spark.range(10), "x")
    assert all(shared_folder(spark).removeprefix("file:") in f for f in df.inputFiles())
    assert spark.conf.get("spark.checkpoint.dir") == shared_folder(spark)


def test_small_settled_sides_are_broadcast_and_large_ones_are_not(spark):
    left = settle(spark.range(1000), "left")
    side = settle(spark.range(1000).withColumn("v", F.lit(1)), "side")
    plan = lambda: left.join(side, "id", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


EVENTS = "id int, user string, ts timestamp, value double"


def test_late_rows_and_open_hours(spark, tmp_path):
    folder = tmp_path / "events"
    batches = [
        [(1, "u", "2024-01-01 10:10:00", 1.0), (2, "u", "2024-01-01 10:50:00", 2.0), (3, "v", "2024-01-01 10:20:00", 3.0)],
        [(4, "u", "2024-01-01 13:00:00", 4.0)],
        [(5, "u", "2024-01-01 10:55:00", 5.0), (6, "u", "2024-01-01 15:30:00", 6.0)],
    ]
    schema = spark.createDataFrame([], EVENTS).schema
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for batch in batches:
        df = spark.createDataFrame(batch, EVENTS.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(str(folder))
        stream = st.read_parquet_stream(spark, str(folder), schema)
        dedup = st.stream_dedup_hourly(stream, ["user"], "ts", tie_break="id")
        st.finish(st.write_available(dedup, out, state))
    rows = sorted((r.user, r.id) for r in spark.read.parquet(out).collect())
    # The hour 10 closed before row 5 came; the hour 15 is still open.
    assert rows == [("u", 2), ("u", 4), ("v", 3)]


def test_index_sync_can_be_replayed(spark, tmp_path):
    index = st.StreamedIndex(spark, str(tmp_path / "index"), StructType().add("chunk_id", "string").add("v", "string"))
    rows = lambda *r: spark.createDataFrame(list(r), "chunk_id string, gone boolean")
    mark = lambda name: lambda new: new.withColumn("v", F.lit(name))
    read = lambda: sorted(map(tuple, index.read().collect()))
    index.sync(rows(("a", False), ("b", False), ("b", False)), 0, mark("first"), "gone")
    index.sync(rows(("b", False), ("c", False), ("a", True)), 1, mark("second"), "gone")
    assert read() == [("b", "first"), ("c", "second")]
    index.sync(rows(("b", False), ("c", False), ("a", True)), 1, mark("replayed"), "gone")
    assert read() == [("b", "first"), ("c", "replayed")]
    index.sync(rows(("a", False)), 2, mark("third"), "gone")
    assert read() == [("a", "third"), ("b", "first"), ("c", "replayed")]


def test_hourly_latest_accounts_for_every_row(spark, tmp_path):
    schema = spark.createDataFrame([], EVENTS).schema
    latest = st.HourlyLatest(spark, str(tmp_path / "hourly"), schema, ["user"], "ts", "id")
    batches = [
        [(1, "u", "2024-01-01 10:10:00", 1.0), (2, "u", "2024-01-01 10:50:00", 2.0), (3, "v", "2024-01-01 10:20:00", 3.0)],
        [(4, "u", "2024-01-01 13:00:00", 4.0), (9, "u", "2024-01-01 10:50:00", 9.0)],
        [(5, "u", "2024-01-01 10:55:00", 5.0), (6, "u", "2024-01-01 15:30:00", 6.0), (7, "v", None, 7.0)],
        [],
    ]
    frames = [spark.createDataFrame(b, EVENTS.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp")) for b in batches]
    ids = lambda df: sorted(r.id for r in df.collect())
    for n, df in enumerate(frames):
        latest.apply(df, n)
    for _ in range(2):
        assert (ids(latest.closed()), ids(latest.late()), ids(latest.flush())) == ([2, 3, 4], [5], [6])
        latest.apply(frames[3], 3)  # a replay adds nothing
    latest.apply(frames[2], 2)
    assert (ids(latest.closed()), ids(latest.late())) == ([2, 3, 4], [5])


def test_both_logs_from_one_pass(spark, tmp_path):
    from brindle.plans import payload_plans as pp

    path = "/root/testdata/sf0.001"
    payloads = pp.chat_payloads(spark, path).unionByName(pp.feedback_payloads(spark, path), allowMissingColumns=True)
    folder = str(tmp_path / "in")
    payloads.repartition(3).write.parquet(folder)
    logs = st.PayloadLogs(spark, str(tmp_path / "logs"), payloads.schema)
    query = st.run_batches(st.read_parquet_stream(spark, folder, payloads.schema, files_per_batch=2), str(tmp_path / "state"), logs.apply)
    st.finish(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == payloads.count()  # each row is read once
    want = [df.count() for df in st.stream_request_log(spark.read.schema(payloads.schema).parquet(folder))]
    assert [logs.read(name).count() for name in logs.TABLES] == want and min(want) > 0
    first = spark.read.schema(payloads.schema).parquet(folder).limit(5)
    logs.apply(first, 99)
    once = [logs.read(name).count() for name in logs.TABLES]
    logs.apply(first, 99)
    assert [logs.read(name).count() for name in logs.TABLES] == once


def files_read(df):
    """Files that the scans of an executed plan have read."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(k).metrics().get("numFiles") for k in range(leaves.size())]
    return sum(m.get().value() for m in metrics if m.isDefined())


def test_index_reads_only_the_buckets_of_a_batch(spark, tmp_path):
    index = st.StreamedIndex(spark, str(tmp_path / "index"), StructType().add("chunk_id", "string").add("v", "string"), buckets=16, compact_every=3)
    mark = lambda name: lambda new: new.withColumn("v", F.lit(name))
    rows = lambda keys, gone=False: spark.createDataFrame([(k, gone) for k in keys], "chunk_id string, gone boolean")
    keys = [f"k{n}" for n in range(120)]
    for batch in range(4):
        index.sync(rows(keys[30 * batch : 30 * batch + 30]), batch, mark(f"b{batch}"), "gone")
    index.sync(rows(keys[:10], True), 4, mark("never"), "gone")
    assert {r.chunk_id: r.v for r in index.read().collect()} == {k: f"b{n // 30}" for n, k in enumerate(keys) if n >= 10}
    few, every = index.touched(rows(["k50"]), 5), index._changes(5)
    assert {r.bucket for r in few.collect()} == {r.bucket for r in every.where("chunk_id = 'k50'").collect()}
    every.collect()
    assert 0 < files_read(few) <= 3 < files_read(every) / 4  # one bucket of the base and of two batches
    names = every.inputFiles()
    assert all("/base/batch=2" in f or "batch=3" in f or "batch=4" in f for f in names)  # earlier batches lie in the base
    index.sync(rows(keys[:10], True), 4, mark("never"), "gone")
    assert index.read().count() == 110


def test_files_are_replaced_and_others_stay(spark, tmp_path):
    schema = StructType().add("file_path", "string").add("id", "integer")
    rows = spark.createDataFrame([(f"f{n}", n * 10 + k) for n in range(40) for k in range(3)], schema)
    index = src.FileIndex(spark, str(tmp_path / "index"), schema, buckets=8)
    index.create(rows)
    before = {f: list((tmp_path / "index").glob(f"{f}/*.parquet")) for f in (f"file_bucket={b}" for b in range(8))}
    files = spark.createDataFrame([("f3",), ("f5",)], "f string")
    for _ in range(2):
        index.replace(spark.createDataFrame([("f3", 1), ("f3", 2), ("new", 3)], schema), files)
        want = sorted([(f"f{n}", n * 10 + k) for n in range(40) if n not in (3, 5) for k in range(3)] + [("f3", 1), ("f3", 2), ("new", 3)])
        assert sorted(map(tuple, index.read().collect())) == want
    same = [b for b, names in before.items() if list((tmp_path / "index").glob(f"{b}/*.parquet")) == names]
    assert len(same) >= 5  # untouched buckets keep their very files
    index.replace(spark.createDataFrame([], schema), spark.createDataFrame([(f"f{n}",) for n in range(40)] + [("new",)], "f string"))
    assert index.read().isEmpty()


def test_a_batch_has_a_file_for_each_split(spark, tmp_path, monkeypatch):
    from brindle.plans import streaming_plans as sp

    docs = spark.range(400).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 4 = 0, 'es', 'en') as lang")
    docs.repartition(5).write.option("maxRecordsPerFile", 20).parquet(str(tmp_path / "documents.parquet"))
    parts = sp._parts(spark, str(tmp_path), "documents")
    monkeypatch.setattr(sp, "shared_path", lambda spark, label: str(tmp_path / label))
    stream = sp._arriving(docs, "many", 7)
    seen = []
    from brindle.session import shared_path
    from brindle.streaming import streams as st

    st.finish(st.run_batches(stream, shared_path(spark, "many-state"), lambda rows, batch: seen.append(rows.count())))
    assert parts > 1 and len(seen) == 4 and sum(seen) == 400
    assert len(list((tmp_path / "many").glob("part-*"))) == 28


def test_settled_tables_are_small(spark):
    import glob
    from brindle.session import settle

    files = glob.glob(settle(spark.range(100), "small").inputFiles()[0].removeprefix("file:"))
    assert files and all(".zstd." in f for f in files)
