"""CSV and Parquet readers, staging, and the writers."""

import csv
import datetime as dt

import pytest
import shop
from conftest import rows
from pyspark.sql import DataFrameWriter

from starmill import schemas, staging
from starmill.plans.clean import clean
from starmill.plans.model import Warehouse
from starmill.session import restore, tune
from starmill.sources import sinks
from starmill.sources.raw import RAW_TABLES, REVIEWS_SCHEMA, read_csv, read_raw


@pytest.fixture
def csv_folder(tmp_path):
    for name, columns in shop.COLUMNS.items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(columns.split())
            writer.writerows(shop.ROWS[name])
    return tmp_path


def test_csv_columns_are_text_and_empty_is_null(spark, csv_folder):
    products = read_csv(spark, str(csv_folder / "products.csv"))
    assert {f.dataType.simpleString() for f in products.schema.fields} == {"string"}
    book = products.where("product_id = 'p2'").first()
    assert book.product_description_lenght is None and book.product_name_lenght == "x"


def test_zip_keeps_its_leading_zero(spark, csv_folder):
    customers = read_csv(spark, str(csv_folder / "customers.csv"))
    assert customers.where("customer_zip_code_prefix = '01'").count() == 3


REVIEWS = (
    "a,b,c,d,e,f,g\n"
    'r1,o1,x,"say ""hi""","first line\nsecond, line",2018-01-01,2018-01-02 03:04:05\n'
    "r2,o1,4,,,junk,\n"
)


def test_reviews_with_schema_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(REVIEWS)
    found = rows(read_csv(spark, str(path), REVIEWS_SCHEMA, multiline=True))
    assert found == [
        ("r1", "o1", None, 'say "hi"', "first line\nsecond, line", dt.date(2018, 1, 1),
         dt.datetime(2018, 1, 2, 3, 4, 5)),
        ("r2", "o1", 4, None, None, None, None),
    ]
    # Plain options read one record per line: the text splits.
    assert read_csv(spark, str(path), REVIEWS_SCHEMA, plain=True).count() == 3


WIDE = "id string, a string, b string, n int, day date"


def csv_text(rows, newline="\n"):
    out = ["id,a,b,n,day"]
    for row in rows:
        out.append(",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n\r') else c for c in row))
    return newline.join(out) + newline


def awkward(count, start=0):
    """Records with line breaks, quotes, commas, empty fields, and texts longer than blocks."""
    for k in range(start, start + count):
        a = ["plain", 'say "hi"\nand ""go""', "x" * (k % 50), "line\n\n\nbreaks, too", '"', "", "é\nü"][k % 7]
        b = "long\n" * 4000 if k % 211 == 5 else ['"\n"', "b", "", "c,d"][k % 4]
        yield str(k), a, b, str(k) if k % 3 else "junk", "2018-01-02" if k % 5 else ""


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_one_file_with_line_breaks_is_read_by_several_tasks(spark, tmp_path, settings, newline):
    folder = tmp_path / "reviews"
    folder.mkdir()
    (folder / "one.csv").write_text(csv_text(awkward(900), newline), newline="")
    (folder / "two.csv").write_text(csv_text(awkward(40, 5000), newline).rstrip("\r\n"), newline="")
    (folder / "empty.csv").write_text("id,a,b,n,day\n")
    expected = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    expected = expected.schema(WIDE).csv(str(folder))
    assert expected.count() == 940
    for size in ("1m", "8k", "1k"):
        settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0")
        found = read_csv(spark, str(folder), WIDE, multiline=True)
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
        assert found.dtypes == expected.dtypes
    lines = spark.read.text(str(folder / "one.csv"))
    assert lines.rdd.getNumPartitions() > 100
    texts = read_csv(spark, str(folder), multiline=True)
    assert texts.columns == ["id", "a", "b", "n", "day"] and texts.where("n = 'junk'").count() > 300


def test_a_file_of_one_record_without_end(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('a,b\n1,"never\nclosed\n')
    assert read_csv(spark, str(path), multiline=True).count() == 1


def test_read_raw_csv_and_renamed_file(spark, csv_folder):
    (csv_folder / "people.csv").write_text((csv_folder / "customers.csv").read_text())
    raw = read_raw(spark, str(csv_folder), files={"customers": "people.csv"})
    assert set(raw) == set(RAW_TABLES)
    assert raw["customers"].count() == 5
    assert raw["reviews"].schema["review_score"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        read_raw(spark, str(csv_folder), format="xml")


def test_job_from_csv_equals_job_from_frames(spark, csv_folder, tmp_path):
    from_csv = Warehouse(clean(read_raw(spark, str(csv_folder))), closed="right")
    from_frames = Warehouse(clean(shop.raw(spark)), closed="right")
    for name in schemas.TABLES:
        assert rows(from_csv.table(name)) == rows(from_frames.table(name)), name


def test_read_raw_parquet(spark, tmp_path):
    for name, df in shop.raw(spark).items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    raw = read_raw(spark, str(tmp_path), format="parquet")
    assert raw["orders"].count() == 6


@pytest.fixture
def warehouse(spark):
    return Warehouse(clean(shop.raw(spark)), closed="right")


def test_parquet_append_and_overwrite(spark, warehouse, tmp_path):
    target = str(tmp_path / "out")
    sizes = []
    for mode in ("append", "append", "overwrite"):
        sinks.write_warehouse(warehouse, target, mode=mode)
        sizes.append(spark.read.parquet(f"{target}/fact_orderpayments").count())
    assert sizes == [4, 8, 4]
    for name in schemas.TABLES:
        stored = spark.read.parquet(f"{target}/{name}")
        assert schemas.schema_mismatches(stored, name) == []
        assert rows(stored) == rows(warehouse.table(name))


def test_jdbc_load_order_and_options(warehouse, monkeypatch):
    """No database is started here: the calls to Spark's own writer are recorded."""
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **given: calls.append(given))
    login = {"user": "loader", "driver": "some.Driver"}
    sinks.write_warehouse(warehouse, "jdbc:db", "jdbc", properties=login)
    assert [c["table"] for c in calls] == list(schemas.TABLES)
    assert {c["mode"] for c in calls} == {"append"}
    assert calls[0]["properties"].items() >= login.items() and calls[0]["url"] == "jdbc:db"
    assert calls[0]["properties"]["numPartitions"] == str(sinks.CONNECTIONS)
    assert "truncate" not in calls[0]["properties"]
    calls.clear()
    sinks.write_warehouse(
        warehouse, "jdbc:db", "jdbc", mode="overwrite", properties=login, connections=7
    )
    assert {c["properties"]["truncate"] for c in calls} == {"true"}
    assert {c["properties"]["numPartitions"] for c in calls} == {"7"}
    # Facts refer to dimensions, so emptying a dimension has to empty them as well.
    cascading = {c["table"] for c in calls if c["properties"].get("cascadeTruncate") == "true"}
    assert cascading == {t for t in schemas.TABLES if t.startswith("dim_")}
    with pytest.raises(ValueError):
        sinks.write_warehouse(warehouse, "x", "other")


def test_parents_are_loaded_before_children():
    order = list(schemas.TABLES)
    for (child, _), parent in schemas.FOREIGN_KEY.items():
        assert order.index(parent) < order.index(child)


def test_staged_table_is_written_to_the_shared_folder(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) name")
    staged = staging.stage(df, "numbers")
    assert rows(staged) == rows(df) and staged.dtypes == df.dtypes
    root = staging.staging_root(spark)
    assert all(root in f for f in staged.inputFiles())


def test_staged_tables_can_be_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "own"))
    assert staging.stage(spark.range(3), "numbers").count() == 3
    staging.release_staged(spark)
    assert not (tmp_path / "own").exists()


def test_warehouses_release_only_their_own_tables(spark):
    first, second = (Warehouse(clean(shop.raw(spark))) for _ in range(2))
    before = rows(second.table("fact_orderpayments"))
    first.table("fact_orderpayments").count()
    first.release()
    assert rows(second.table("fact_orderpayments")) == before
    with pytest.raises(Exception, match="(?i)not.?exist"):
        first.table("fact_orderpayments").collect()


def test_a_failed_load_releases_too(spark, tmp_path, monkeypatch):
    built = Warehouse(clean(shop.raw(spark)))

    def fail(*_):
        raise OSError("target is full")

    monkeypatch.setattr(sinks, "write_parquet", fail)
    released = []
    monkeypatch.setattr(Warehouse, "release", lambda self: released.append(self))
    with pytest.raises(OSError, match="full"):
        sinks.write_warehouse(built, str(tmp_path), release=True)
    assert released == [built]


def test_key_width_follows_the_row_counts(warehouse, monkeypatch):
    assert not sinks.needs_wide_keys(warehouse)
    monkeypatch.setattr(schemas, "INT_MAX", 3)
    assert sinks.needs_wide_keys(warehouse)


def test_numbers_beyond_int_stop_the_load(spark):
    items = [("o1", str(2**40), "p1", "s1", "2018-01-02 12:00:00", "10.0", "1.5")]
    built = Warehouse(clean(shop.raw(spark, order_items=items)))
    fact = built.table("fact_orderlifecycle")
    assert [r.order_item_id for r in fact.collect()] == [2**40, 2**40]
    with pytest.raises(Exception, match="exceeds INT"):
        schemas.conform(fact, "fact_orderlifecycle").collect()


def test_staging_refuses_a_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Cluster()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(Session())


def test_tune_sizes_shuffles(spark, settings):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    settings(**{name.replace(".", "__"): "1"})
    forced = spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin", None)
    before = tune(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(name)) == spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    tune(spark, "/root/testdata/sf0.001", partition_bytes=1024, most=500)
    assert spark.conf.get(name) == "500"
    restore(spark, before)
    assert spark.conf.get(name) == "1"
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin", None) == forced
