"""Reading, writing, versions and staging."""

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import publish, tables
from tallyloom.sources.staging import stage, staging_folder


@pytest.fixture
def root(spark, tmp_path):
    return str(tmp_path)


def test_versions_are_immutable_and_the_latest_is_read(spark, root, rows):
    df = spark.createDataFrame([(1, "a")], "k int, `Odd, name?` string")
    publish.publish({"My Table": df}, root, "Data_for_R", "v1", "first")
    publish.publish({"My Table": df.withColumn("k", F.lit(2))}, root, "data_for_r", "v2", "second")
    assert rows(publish.read_version(spark, root, "DATA_FOR_R", "my table")) == [(2, "a")]
    assert rows(publish.read_version(spark, root, "data_for_r", "My Table", "v1")) == [(1, "a")]
    assert publish.latest_version(spark, root, "data_for_r")["description"] == "second"
    with pytest.raises(Exception, match="exist"):
        publish.publish({"My Table": df}, root, "data_for_r", "v2", "again")
    publish.retire(spark, root, "data_for_r", "v2")
    assert publish.latest_version(spark, root, "data_for_r")["version"] == "v1"
    with pytest.raises(ValueError, match="unknown version"):
        publish.retire(spark, root, "data_for_r", "v9")
    publish.retire(spark, root, "data_for_r", "v1")
    with pytest.raises(ValueError, match="no current"):
        publish.latest_version(spark, root, "data_for_r")


def test_a_failed_publish_is_not_visible(spark, root):
    good = spark.range(1)
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    publish.publish({"t": good}, root, "set", "v1", "ok")
    with pytest.raises(Exception, match="broken"):
        publish.publish({"t": good, "u": bad}, root, "set", "v2", "half")
    assert publish.latest_version(spark, root, "set")["version"] == "v1"


def test_period_overwrite_leaves_other_periods(spark, root, rows):
    path = root + "/history"
    df = spark.createDataFrame([(2022, "a"), (2023, "b"), (2023, "c")], "y int, v string")
    tables.overwrite_periods(df, path, "y")
    tables.overwrite_periods(spark.createDataFrame([(2023, "d")], "y int, v string"), path, "y")
    assert rows(spark.read.parquet(path), "y", "v") == [(2022, "a"), (2023, "d")]


def test_lineage_and_row_order(spark, root, rows):
    spark.range(3).coalesce(1).write.parquet(root + "/x/extract_20240102.parquet")
    df = tables.read_with_lineage(spark, root + "/x/*", date_regex=r"part")
    assert df.columns == ["id", "source_file", "pull_date"]
    ordered = tables.with_row_order(spark.read.parquet(root + "/x/*"))
    assert sorted(r.row_ix for r in ordered.collect()) == [0, 1, 2]


def test_pull_date_comes_from_the_file_name(spark, root):
    import shutil

    spark.range(1).coalesce(1).write.parquet(root + "/raw")
    import glob

    part = glob.glob(root + "/raw/part-*.parquet")[0]
    shutil.copy(part, root + "/pull_20240428.parquet")
    row = tables.read_with_lineage(spark, root + "/pull_*.parquet").first()
    assert row.source_file == "pull_20240428.parquet" and str(row.pull_date) == "2024-04-28"


def test_table_sets_keep_leading_zeros(spark, root, rows):
    df = spark.createDataFrame([("00501", "a|b")], "zip string, v string")
    df.write.csv(root + "/s/one", header=True)
    df.withColumn("zip", F.lit(501)).write.parquet(root + "/p/one")
    assert rows(tables.read_table_set(spark, root + "/s", ["one"], "csv")["one"]) == [("00501", "a|b")]
    got = tables.read_table_set(spark, root + "/p", ["one"], overrides={"zip": "string", "absent": "string"})["one"]
    assert got.dtypes[0] == ("zip", "string")


def test_staging_uses_the_cluster_folder(spark):
    assert staging_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    out = stage(spark.range(5).withColumn("a.b", F.col("id")))
    assert out.count() == 5 and out.columns == ["id", "a.b"]
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()


def test_two_names_may_not_share_a_directory(spark, root):
    with pytest.raises(ValueError, match="share"):
        tables.write_table_set({"A b": spark.range(1), "a-b": spark.range(1)}, root)


def test_released_tables_are_empty_and_settings_stay(spark):
    from tallyloom.sources.staging import release, stage

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    table = stage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert table.count() == 7
    release(table)
    assert spark.read.parquet(table.staged_at).count() == 0
    assert spark.conf.get(name, None) == before


def test_history_versions_refer_to_unchanged_periods(spark, root, rows):
    def frame(*years_and_values):
        return spark.createDataFrame(list(years_and_values), "y string, v string")

    def put(fresh, replaced, version):
        publish.publish_periods(fresh, replaced.select("y"), root, "History", version, version, "y")

    put(frame(("2021", "a"), ("2022", "b"), (None, "n"), ("a/b=c %", "odd")), frame(), "v1")
    put(frame(("2022", "c"), ("2022", "d")), frame(("2022", "x"), ("2021", "returned")), "v2")
    assert rows(publish.read_history(spark, root, "history")) == [("2022", "c"), ("2022", "d"), ("a/b=c %", "odd"), (None, "n")]
    assert rows(publish.read_history(spark, root, "history", "v1"))[:2] == [("2021", "a"), ("2022", "b")]
    versions = {r.version: {p.version for p in r.parts} for r in publish.manifest(spark, root, "history").collect()}
    assert versions == {"v1": {"v1"}, "v2": {"v1", "v2"}}
    put(frame(), frame((None, "x")), "v3")
    assert rows(publish.read_history(spark, root, "history")) == [("2022", "c"), ("2022", "d"), ("a/b=c %", "odd")]
    publish.retire(spark, root, "history", "v3")
    assert len(rows(publish.read_history(spark, root, "history"))) == 4
    with pytest.raises(ValueError):
        publish.read_history(spark, root, "history", "v9")
    with pytest.raises(ValueError):
        publish.read_history(spark, root, "no such")


def test_a_failed_history_run_leaves_the_old_version(spark, root, rows, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "y int, v string")
    publish.publish_periods(df, df, root, "h", "v1", "", "y")

    def fail(*_, **__):
        raise RuntimeError("lost between the data and the manifest")

    with monkeypatch.context() as broken:
        broken.setattr(publish, "_append", fail)
        with pytest.raises(RuntimeError):
            publish.publish_periods(df.withColumn("v", F.lit("new")), df, root, "h", "v2", "", "y")
    assert rows(publish.read_history(spark, root, "h")) == [(1, "a"), (2, "b")]
    publish.publish_periods(df.withColumn("v", F.lit("new")).where("y = 2"), df, root, "h", "v3", "", "y")
    assert rows(publish.read_history(spark, root, "h")) == [(2, "new")]


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_rows_of_csv_are_numbered_whatever_the_splits(spark, root, split):
    import pathlib

    want = {}
    for f, n in (("a.csv", 0), ("b.csv", 1), ("c.csv", 700), ("d.csv", 33)):
        lines = [f"{f}-{i},{'x' * (i % 37)}" for i in range(n)]
        pathlib.Path(root, f).write_text("\n".join(["k,v", *lines]) + "\n")
        want |= {line.split(",")[0]: i for i, line in enumerate(lines)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = tables.with_row_order(tables.read_table(spark, root, "csv"), "csv")
        assert df.columns == ["k", "v", "source_path", "row_ix"]
        got = {r.k: (r.row_ix, r.source_path.rsplit("/", 1)[1]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: i for k, (i, _) in got.items()} == want
    assert all(k.startswith(f) for k, (_, f) in got.items())


def test_only_unread_files_are_read(spark, root, rows):
    from tallyloom.sources import ledger

    def put(name, n):
        spark.range(n).coalesce(1).write.mode("overwrite").parquet(f"{root}/in/{name}")

    where, book = f"{root}/in/*/*.parquet", f"{root}/ledger"
    put("e_20230131.parquet", 3)
    put("e_undated.parquet", 2)
    df, files = ledger.read_unread(spark, where, book, level=-2)
    assert [str(r[1]) for r in rows(df.groupBy("source_file", "pull_date").count(), "source_file", "pull_date")] == ["2023-01-31", "None"]
    assert len(files) == 2 and len(ledger.read_unread(spark, where, book)[1]) == 2  # not recorded, so read again
    ledger.record(spark, book, files, "one")
    assert ledger.read_unread(spark, where, book) == (None, [])
    put("e_20230201.parquet", 1)
    put("e_undated.parquet", 5)  # changed since
    df, files = ledger.read_unread(spark, where, book, level=-2)
    assert rows(df.groupBy("source_file").count()) == [("e_20230201.parquet", 1), ("e_undated.parquet", 5)]
    ledger.record(spark, book, files, "two")
    assert rows(ledger.recorded(spark, book).groupBy("batch").count()) == [("one", 2), ("two", 2)]
