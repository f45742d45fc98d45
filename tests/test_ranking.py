import pytest
from pyspark.sql import functions as F

from brindle.operators import ranking as r


@pytest.fixture
def tied(spark):
    """A third of the rows share one value."""
    return spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("v"))


@pytest.mark.parametrize("k", [0, 1, 999, 1000, 1700, 2999, 3000, 9999])
def test_first_rows_among_ties(tied, k, monkeypatch):
    monkeypatch.setattr(r, "SMALL_LIMIT", 40)
    ordered = sorted((row.v, row.id) for row in tied.collect())
    head, tail = r.first_rows(tied, ["v", "id"], k)
    assert sorted((row.v, row.id) for row in head.collect()) == ordered[:k]
    assert sorted((row.v, row.id) for row in tail.collect()) == ordered[k:]


def test_first_rows_with_nulls(spark, monkeypatch):
    monkeypatch.setattr(r, "SMALL_LIMIT", 5)
    df = spark.range(60).select("id", F.when(F.col("id") % 4 != 0, F.col("id")).alias("v"))
    head, tail = r.first_rows(df, ["v", "id"], 20)
    assert head.count() == 20 and tail.count() == 40
    assert head.filter("v IS NULL").count() == 15


def test_split_sizes(tied):
    train, test = r.positional_split(tied, ["id"])
    assert (train.count(), test.count()) == (1800, 1200)
    assert train.agg(F.max("id")).first()[0] == 1799


def test_longest_and_shortest(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(1, 11)], "id int, text string")
    ids = lambda d: sorted(x.id for x in d.collect())
    assert ids(r.shortest(df, "text", 3, "id")) == [1, 2, 3]
    assert ids(r.all_but_longest(df, "text", 3, "id")) == list(range(1, 8))
    assert ids(r.all_but_longest(df, "text", 3, "id", drop="shortest")) == list(range(4, 11))
    assert ids(r.eval_holdout(df, "text", "id", n=5)) == [4, 5]
    with pytest.raises(ValueError):
        r.all_but_longest(df, "text", 3, "id", drop="middle")


def test_topn_order_ties_and_bounds(spark):
    df = spark.createDataFrame([(1, [0.2, 0.5, 0.2, 0.1])], "id int, p array<double>")
    row = r.topn_classes(df, "p", ["a", "b", "c", "d"], 4).first()
    assert [row[f"predicted_class_{i}"] for i in range(1, 5)] == ["b", "a", "c", "d"]
    assert [row[f"predicted_probability_{i}"] for i in range(1, 5)] == [0.5, 0.2, 0.2, 0.1]
    with pytest.raises(ValueError):
        r.topn_classes(df, "p", ["a", "b"], 3)


ASSESSMENT = (
    "request_id string, step_id string, source struct<id: string>, timestamp timestamp, "
    "text_assessment struct<step_id: string>, retrieval_assessment struct<position: int>"
)


def test_assessment_keys_and_hours(spark):
    rows = [
        ("r", "s", ("u",), "2024-01-01 10:05:00", ("old",), None),
        ("r", "s", ("u",), "2024-01-01 10:55:00", ("new",), None),
        ("r", "s", ("u",), "2024-01-01 11:00:00", ("next hour",), None),
        ("r", "s", ("u",), "2024-01-01 10:30:00", None, (0,)),
        ("r", "s", ("u",), "2024-01-01 10:40:00", None, (1,)),
        ("r", "s", ("v",), "2024-01-01 10:40:00", ("other user",), None),
    ]
    schema = ASSESSMENT.replace("timestamp timestamp", "timestamp string")
    df = spark.createDataFrame(rows, schema).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    texts = lambda d: sorted(x.text_assessment.step_id for x in d.collect() if x.text_assessment)
    assert texts(r.dedup_assessment_logs(df)) == ["next hour", "other user"]
    assert r.dedup_assessment_logs(df).count() == 4
    assert texts(r.dedup_assessment_logs(df, "hour")) == ["new", "next hour", "other user"]
    once = r.dedup_assessment_logs(df)
    assert sorted(map(str, r.dedup_assessment_logs(once).collect())) == sorted(map(str, once.collect()))
    with pytest.raises(ValueError):
        r.dedup_assessment_logs(df, "day")


def test_dedup_ships_one_row_per_key_and_task(spark, tied):
    plan = r.latest_per_key(tied, ["v"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
