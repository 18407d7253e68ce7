import random
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from holdfast.plans.churn import Study
from holdfast.session import materialise, shared_root
from holdfast.sources import load, multiline, order_tables, parse_timestamps, read_scored, read_table, write_scored
from holdfast.sources.schemas import KEY, TABLES


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_is_matched_by_name_and_may_hold_line_breaks(spark, tmp_path):
    path = write(
        tmp_path / "order_reviews.csv",
        'review_id,review_score,order_id,comment,review_creation_date\n'
        'r1,5,o1,"two\nlines, ""quoted""",2018-01-02 00:00:00\nr2,1,o2,,\n',
    )
    rows = read_table(spark, "order_reviews", path).orderBy("order_id").collect()
    assert [tuple(r) for r in rows] == [("o1", 5, datetime(2018, 1, 2)), ("o2", 1, None)]


@pytest.mark.parametrize("seed, ends", [(1, "\n"), (2, "\r\n")])
def test_split_files_equal_the_one_task_reader(spark, tmp_path, seed, ends):
    """Quotes, doubled quotes, commas and line breaks anywhere, in two files cut into some fifty splits."""
    rng, bits = random.Random(seed), ['""', ",", "\n", "a", "é", " ", '""\n""', "\n\n", "word"]

    def value():
        kind = rng.random()
        return "" if kind < 0.1 else "plain" if kind < 0.5 else '"' + "".join(rng.choices(bits, k=rng.randint(0, 12))) + '"'

    for name in ("a.csv", "b.csv"):
        rows = ["id,one,two"] + [f"{name}{i},{value()},{value()}" for i in range(300)]
        (tmp_path / name).write_bytes(ends.join(rows).encode() + (b"\n" if name == "a.csv" else b""))
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    want = sorted(map(tuple, whole.collect()))
    held = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 50))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = multiline.read_csv(spark, str(tmp_path))
        splits = spark.read.text(str(tmp_path)).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        got = sorted(map(tuple, found.collect()))
    finally:
        for name, setting in held.items():
            spark.conf.set(name, setting)
    assert splits >= 45 and len(got) == 600
    assert got == want


@pytest.mark.parametrize("name", ["products", "order_reviews"])
def test_files_with_another_order_of_columns_raise(spark, tmp_path, name):
    folder = tmp_path / name
    folder.mkdir()
    columns = list(TABLES[name])
    write(folder / "a.csv", ",".join(columns) + "\n" + ",".join("1" for _ in columns) + "\n")
    write(folder / "b.csv", ",".join(reversed(columns)) + "\n" + ",".join("2" for _ in columns) + "\n")
    table = read_table(spark, name, str(folder), lenient=True)
    with pytest.raises(Exception, match="header"):
        table.collect()
    for column in (columns[0], columns[1]):
        with pytest.raises(Exception, match="header"):
            table.select(column).collect()


def test_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path / "products.csv", "product_id\np1\n")
    with pytest.raises(ValueError, match="product_category_name"):
        read_table(spark, "products", path)


def test_malformed_values_raise_or_become_null(spark, tmp_path):
    path = write(tmp_path / "order_payments.csv", "order_id,payment_value\no1,12.5\no2,oops\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_table(spark, "order_payments", path).collect()
    lenient = read_table(spark, "order_payments", path, lenient=True).orderBy("order_id").collect()
    assert [r.payment_value for r in lenient] == [12.5, None]
    text = spark.createDataFrame([("2018-01-02 03:04:05",), ("no",)], "t string")
    assert parse_timestamps(text, ["t"], lenient=True).where("t IS NULL").count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_timestamps(text, ["t"]).collect()


def test_all_tables_load_with_a_file_name_pattern(spark, tmp_path):
    for name, columns in TABLES.items():
        write(tmp_path / f"shop_{name}_dataset.csv", ",".join(columns or ["zip"]) + "\n")
    tables = load(spark, str(tmp_path), pattern="shop_{table}_dataset.csv")
    assert set(tables) == set(TABLES)
    assert all(dict(tables[n].dtypes) == c for n, c in TABLES.items() if c)


def test_study_runs_from_csv(spark, sf_dir, tmp_path):
    source = order_tables(spark, sf_dir)
    for name, df in source.items():
        df.write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    tables = {
        name: read_table(spark, name, str(tmp_path / f"{name}.csv"), columns=df.columns) for name, df in source.items()
    }
    from_csv = Study(tables).features().withColumn(KEY, F.col(KEY).cast("long"))
    assert from_csv.exceptAll(Study(source).features()).count() == 0
    assert from_csv.count() == 143


def test_scored_table_is_laid_out_by_tier(spark, tmp_path):
    path = str(tmp_path / "scored")
    rows = spark.createDataFrame([("x", "High risk"), ("y", None)], f"{KEY} string, risk_tier string")
    write_scored(rows, path)
    assert (tmp_path / "scored" / "risk_tier=High risk").is_dir()
    assert read_scored(spark, path).exceptAll(rows).count() == 0


def session_with(master, folder=None, checkpoints=None):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoints)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda _, default: folder or default), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert shared_root(session_with("yarn", "hdfs://cluster/shared/")) == "hdfs://cluster/shared/app-1"
    assert shared_root(session_with("yarn", checkpoints="hdfs://cluster/c")) == "hdfs://cluster/c"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session_with("yarn"))


def test_written_tables_cut_the_lineage(spark):
    df = materialise(spark.range(5).withColumn("x", F.col("id") * 2), "five")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().toString()
