import pandas as pd
import pytest
from pyspark.sql import functions as F

from brindle.operators import grouped as g
from brindle.sources.synthetic import sensor_readings

KINDS = ["turbine", "turbine", "propeller", "turbine", "propeller", "propeller"]
READINGS = [10.0, 7.0, 25.0, 12.0, 29.0, 36.0]
RATIO = {"turbine": 3.841143835488627, "propeller": 5.388159060803248}
MINUS = {"turbine": 15.992189497844706, "propeller": 14.445174272530085}


@pytest.fixture
def six(spark):
    return spark.createDataFrame(list(zip(KINDS, READINGS)), "type string, sensor_reading double")


def by_type(df):
    return {r.type: r.normalized for r in df.collect()}


@pytest.mark.parametrize("engine", ["native", "pandas"])
def test_six_rows(six, engine):
    assert by_type(g.normalize_group(six, ["type"], "sensor_reading", engine=engine)) == pytest.approx(RATIO)
    average = six.agg(F.avg("sensor_reading")).first()[0]
    assert average == pytest.approx(19.833333333333332)
    minus = g.normalize_with_value(six, ["type"], "sensor_reading", average, engine=engine)
    assert by_type(minus) == pytest.approx(MINUS)


def test_average_as_scalar_subquery(six):
    minus = g.normalize_with_value(six, ["type"], "sensor_reading", g.global_average(six, "sensor_reading"))
    assert by_type(minus) == pytest.approx(MINUS)


@pytest.mark.parametrize("engine", ["native", "pandas"])
def test_single_constant_and_null_groups(spark, engine):
    rows = [("one", 1.0), ("flat", 2.0), ("flat", 2.0), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "type string, sensor_reading double")
    got = by_type(g.normalize_group(df, ["type"], "sensor_reading", engine=engine))
    assert got["one"] is None and got["flat"] is None
    assert got[None] == pytest.approx(2 / 2**0.5)


@pytest.fixture
def skewed(spark):
    """A third of the rows in one group."""
    readings = sensor_readings(spark, 6000, 20, 5, seed=3)
    hot = F.pmod(F.xxhash64("sensor_reading"), F.lit(3)) == 0
    return readings.withColumn("device_id", F.when(hot, -1).otherwise(F.col("device_id")))


def rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_hot_groups_take_the_native_form(skewed):
    native = g.normalize_group(skewed, ["device_id"], "sensor_reading")
    pandas = g.normalize_group(skewed, ["device_id"], "sensor_reading", engine="pandas", max_group_rows=500)
    assert rows(native) == rows(pandas)


def test_coarse_groups_equal_fine_groups(skewed):
    native = g.normalize_group(skewed, ["device_id", "trip_id"], "sensor_reading")
    for limit in (200, 1000, 10**6):
        coarse = g.normalize_coarse(skewed, ["device_id"], ["trip_id"], "sensor_reading", max_group_rows=limit)
        assert rows(native) == rows(coarse)


def test_unbounded_group_is_refused(skewed):
    with pytest.raises(ValueError, match="beyond"):
        g.grouped_map(skewed, ["device_id"], lambda pdf: pdf, skewed.schema, max_group_rows=100)


def test_denormalize_splits_long_lists_without_loss(spark, skewed):
    whole = g.denormalize(skewed, "device_id", "trip_id", ["sensor_reading"])
    assert whole.filter("part > 0").isEmpty()
    cut = g.denormalize(skewed, "device_id", "trip_id", ["sensor_reading"], max_list=300)
    assert cut.filter("device_id = -1").count() > 1
    entries = lambda df: sorted((r.device_id, r.trip_id) for r in g.relist(df, "trip_id").collect())
    assert entries(cut) == entries(whole) == sorted((r.device_id, r.trip_id) for r in skewed.collect())
    pandas = g.denormalize_pandas(skewed, "device_id", "trip_id", ["sensor_reading"], max_list=300)
    assert entries(pandas) == entries(whole)


def test_denormalize_parts_are_sorted_ranges_at_every_size(spark, skewed):
    extra = spark.createDataFrame([(500, None, 1.0), (500, None, 3.0), (501, 7, 2.0)], "device_id long, trip_id long, sensor_reading double")
    df = skewed.select("device_id", "trip_id", "sensor_reading").unionByName(extra)
    lists = {500: [], 501: [7]}
    for r in skewed.collect():
        lists.setdefault(r.device_id, []).append(r.trip_id)
    for size in (None, 7, 300):
        want = {}
        for k, own in lists.items():
            own, step = sorted(own), size or len(own) or 1
            want |= {(k, p): own[at : at + step] for p, at in enumerate(range(0, len(own) or 1, step))}
        for form in (g.denormalize, g.denormalize_pandas, lambda *a, **kw: g.denormalize_pandas(*a, **kw, max_group_rows=500)):
            out = form(df, "device_id", "trip_id", ["sensor_reading"], max_list=size).collect()
            assert len(out) == len(want) and {(r.device_id, r.part): r.trip_id for r in out} == want
            assert {r.sensor_reading for r in out if r.device_id == 500} == {2.0}


def test_denormalize_keeps_a_very_long_list_whole(spark):
    n = 1_000_001
    df = spark.range(n, numPartitions=4).selectExpr("0 AS key", f"cast({n} - id AS int) AS entry")
    lists = g.denormalize(df, "key", "entry", [])
    assert lists.select("part", F.size("entry"), F.col("entry") == F.sequence(F.lit(1), F.lit(n))).collect() == [(0, n, True)]


def test_relist_keeps_empty_lists(spark):
    df = spark.createDataFrame([(1, [4, 5]), (2, [])], "device_id int, trip_id array<int>")
    want = [(1, 4), (1, 5), (2, None)]
    assert [tuple(r) for r in g.relist(df, "trip_id").orderBy("device_id", "trip_id").collect()] == want
    assert [tuple(r) for r in g.relist_pandas(df, "trip_id").orderBy("device_id", "trip_id").collect()] == want


def test_long_lists_are_relisted_in_portions():
    rows = pd.DataFrame({"k": range(6), "v": [[1, 2, 3], [], None, [4], [5] * 9, [6, 7]]})
    parts = list(g.relisted(rows, "v", 4))
    assert max(map(len, parts)) < len(pd.concat(parts)) and len(parts) > 2
    pd.testing.assert_frame_equal(pd.concat(parts, ignore_index=True), rows.explode("v", ignore_index=True))
    assert sum(map(len, g.relisted(rows[:0], "v"))) == 0


def test_group_sizes_name_the_shuffle_key(spark):
    readings = sensor_readings(spark, 10_000, 10, 20)
    coarse = g.group_size_stats(readings, ["device_id"]).first()
    fine = g.group_size_stats(readings, ["device_id", "trip_id"]).first()
    assert (coarse.rows_per_key, fine.rows_per_key) == (1000, 50)
    assert g.group_size_stats(readings, ["device_id"], approximate=True).first().key_count == 10


def test_closure_parameters(six):
    def plus(amount):
        return lambda pdf: pdf.assign(sensor_reading=pdf.sensor_reading + amount)

    out = g.grouped_map(six, ["type"], g.with_params(plus, amount=5), six.schema)
    assert sorted(r.sensor_reading for r in out.collect()) == sorted(r + 5 for r in READINGS)


def test_sqrt_forms_agree(six):
    native = [r.sqrt_reading for r in g.sqrt_reading(six, "sensor_reading").collect()]
    assert native == pytest.approx([r.sqrt_reading for r in g.sqrt_reading_pandas(six, "sensor_reading").collect()])
    assert native == pytest.approx(list(pd.Series(READINGS) ** 0.5))


def test_rmse(six):
    got = g.rmse(six.withColumn("guess", F.col("sensor_reading") + 2), "guess", "sensor_reading").first()[0]
    assert got == pytest.approx(2)


def test_grouped_reduce_never_holds_a_group(spark):
    import pandas as pd

    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 7)) AS k", "id AS v").repartition(6)

    def partial(pdf):
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "n": [len(pdf)], "total": [pdf["v"].sum()]})

    def merge(pdf):
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "mean": [pdf["total"].sum() / pdf["n"].sum()]})

    got = g.grouped_reduce(df, ["k"], partial, merge, "k string, n long, total long", "k string, mean double")
    want = df.groupBy("k").avg("v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
