import pytest
from pyspark.sql import functions as F

from shelfwise.schema import LOG_V1, LOG_V2
from shelfwise.session import shared_dir
from shelfwise.sources.csv_log import csv_log_scan
from shelfwise.sources.tables import Table, exists, table_append, table_overwrite, table_scan


def numbers(df):
    return sorted(r.n for r in df.collect())


def frame(spark, *values):
    return spark.createDataFrame([(v, v * 10) for v in values], "n int, m int")


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_overwrite_from_itself_and_append(spark, tmp_path, format):
    table = Table(str(tmp_path / "t"), format)
    assert not exists(spark, table)
    table_overwrite(frame(spark, 1, 2), table)
    table_append(frame(spark, 2), table)
    assert numbers(table_scan(spark, table)) == [1, 2, 2]
    doubled = table_scan(spark, table).select((F.col("n") * 2).cast("int").alias("n"), "m")
    table_overwrite(doubled, table, reads_target=True)
    assert numbers(table_scan(spark, table)) == [2, 4, 4]
    assert table_scan(spark, table, ["n"]).columns == ["n"]


def test_an_unfinished_version_is_ignored_and_replaced(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    table_overwrite(frame(spark, 1), table)
    broken = tmp_path / "t" / "version=1"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half")
    assert numbers(table_scan(spark, table)) == [1]
    table_overwrite(frame(spark, 5), table)
    assert numbers(table_scan(spark, table)) == [5]


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    table_overwrite(frame(spark, 1), table)
    opened = table_scan(spark, table)
    table_overwrite(frame(spark, 2), table)
    assert numbers(opened) == [1]
    table_overwrite(frame(spark, 3), table)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version=1", "version=2"]


def test_suffix_names_another_table(tmp_path):
    assert Table("/x/recs").suffixed("_v2").path == "/x/recs_v2"
    assert Table("/x/recs").suffixed("").path == "/x/recs"
    stored = Table(None, "mongodb", {"collection": "recs"})
    assert stored.suffixed("_v2").options == {"collection": "recs_v2"}


def test_csv_types_come_from_the_schema(spark, tmp_path, rows):
    path = tmp_path / "log.csv"
    path.write_text(
        "user_id,item_id,cat_id,brand_id,merchant_id,action,gender,age_range,province\n1,2,3,4,5,0,1,2,Fujian\n,2,3,,5,1,,2,\n"
    )
    got = csv_log_scan(spark, str(path), LOG_V1)
    assert got.schema == LOG_V1
    assert rows(got) == [(1, 2, 3, 4, 5, 0, 1, 2, "Fujian"), (None, 2, 3, None, 5, 1, None, 2, None)]


def test_csv_with_another_header_fails(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("item_id,customer_id,category_id,brand_id,action,unix_created_at\n1,2,3,4,0,9\n")
    with pytest.raises(Exception, match="CSV header"):
        csv_log_scan(spark, str(path), LOG_V2).collect()


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
