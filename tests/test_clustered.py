"""Layout by interleaved places: equal rows, few files per lookup, odd inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardwarden.sources import clustered

SCHEMA = "user_id long, card_id long, at timestamp, amount decimal(15,2), row_id long"
COLUMNS = ["user_id", "card_id", "at"]


def _rows(n, seed=3):
    dice = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        user = 7 if i % 3 == 0 else dice.randrange(2_000)  # one customer holds a third of all rows
        out.append((user, dice.randrange(4_000), start + dt.timedelta(seconds=dice.randrange(2_600_000)), None, i))
    return out


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    df = spark.createDataFrame(_rows(24_000), SCHEMA)
    clustered.write_clustered(df, path, COLUMNS, ["row_id"], least_files=64)
    return df, path


def test_all_rows_are_kept(spark, laid):
    df, path = laid
    back = spark.read.parquet(f"{path}/rows/*")
    assert back.columns == df.columns
    assert back.exceptAll(df).isEmpty() and back.count() == df.count()
    assert clustered.file_ranges(spark, path).agg(F.sum("n_rows")).first()[0] == df.count()


@pytest.mark.parametrize("column,share", [("user_id", 0.4), ("card_id", 0.4), ("at", 0.4)])
def test_lookups_read_few_files(spark, laid, column, share):
    df, path = laid
    files = clustered.file_ranges(spark, path).count()
    assert files > 50
    dice = random.Random(1)
    values = [r[0] for r in df.filter("user_id != 7").select(column).limit(2_000).collect()]
    touched = 0
    for value in dice.sample(values, 5):
        found = clustered.by_value(spark, path, column, value)
        assert found.exceptAll(df.filter(F.col(column) == F.lit(value))).isEmpty()
        assert found.count() == df.filter(F.col(column) == F.lit(value)).count()
        touched += len(clustered.files_between(spark, path, column, value, value))
    assert touched <= share * 5 * files


def test_frequent_customer_is_split(spark, laid):
    df, path = laid
    assert clustered.by_value(spark, path, "user_id", 7).count() == df.filter("user_id = 7").count()
    assert clustered.file_ranges(spark, path).agg(F.max("n_rows")).first()[0] < 24_000 / 64 * 4


def test_batches_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = (spark.createDataFrame(_rows(300, s), SCHEMA) for s in (1, 2))
    clustered.write_clustered(first, path, COLUMNS, batch=0, least_files=3)
    clustered.write_clustered(second, path, COLUMNS, batch=1, least_files=3)
    clustered.write_clustered(second, path, COLUMNS, batch=1, least_files=2)
    want = first.unionAll(second).filter("user_id = 7")
    got = clustered.by_value(spark, path, "user_id", 7)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert {r["batch"] for r in clustered.file_ranges(spark, path).collect()} == {0, 1}


def test_empty_null_and_equal_rows(spark, tmp_path):
    empty, odd = str(tmp_path / "e"), str(tmp_path / "o")
    clustered.write_clustered(spark.createDataFrame([], SCHEMA), empty, COLUMNS)
    assert clustered.by_value(spark, empty, "user_id", 1).count() == 0
    assert clustered.by_value(spark, empty, "user_id", 1).columns == [*COLUMNS, "amount", "row_id"]
    rows = [(None, 1, None, None, 1), (5, None, None, None, 2)] + [(5, 5, dt.datetime(2024, 1, 1), None, 3)] * 40
    clustered.write_clustered(spark.createDataFrame(rows, SCHEMA), odd, COLUMNS, ["row_id"], least_files=4)
    assert clustered.by_value(spark, odd, "user_id", 5).count() == 41
    assert clustered.by_value(spark, odd, "card_id", 5).count() == 40
    assert clustered.by_value(spark, odd, "user_id", None).count() == 0
    with pytest.raises(ValueError):
        clustered.quantile_cuts(spark.createDataFrame([("a",)], "name string"), ["name"])


def test_places_against_plain_code(spark):
    cuts = sorted(random.Random(5).choices(range(100), k=15))
    df = spark.range(-3, 110)
    got = df.select("id", clustered.place(F.col("id"), cuts, 4).alias("p")).collect()
    assert all(r["p"] == sum(c <= r["id"] for c in cuts) for r in got)
    two = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    for r in two.select("a", "b", clustered.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect():
        bits = "".join(x + y for x, y in zip(f"{r['a']:03b}", f"{r['b']:03b}"))
        assert r["z"] == int(bits, 2)
