import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from comanda import schemas, staging
from comanda.operators import profiling
from comanda.plans import pipeline
from comanda.sources import files, jdbc, lake, tables
from comanda.sources.star_adapter import raw_table

FOLDER = "/root/testdata/sf0.001"
PROPS = {"user": "reader", "password": "secret"}


def test_jdbc_options():
    url = jdbc.sqlserver_url("host", "orders")
    assert url == "jdbc:sqlserver://host:1433;databaseName=orders"
    whole = jdbc.jdbc_options(url, "dbo.order_items", PROPS)
    assert whole["dbtable"] == "dbo.order_items" and whole["driver"] == jdbc.SQLSERVER_DRIVER
    assert whole["user"] == "reader" and "numPartitions" not in whole
    split = jdbc.jdbc_options(url, "t", {**PROPS, "driver": "other"}, "ID", 1, 900, 16)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"], split["driver"]) == ("ID", "1", "900", "16", "other")
    with pytest.raises(ValueError):
        jdbc.jdbc_options(url, "t", PROPS, "ID", 1)


def test_jdbc_slices_pass_one_predicate_per_partition():
    class Reader:
        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    class Session:
        read = Reader()

    url, table, predicates, properties = jdbc.read_jdbc_slices(Session(), "u", "t", PROPS, ("a = 1", "a IS NULL"))
    assert (url, table, predicates) == ("u", "t", ["a = 1", "a IS NULL"])
    assert properties == {"driver": jdbc.SQLSERVER_DRIVER, **PROPS}


def test_extract_strips_the_schema_counts_and_stops_at_the_first_failure(spark, tmp_path):
    def read(name):
        if name == "dbo.broken":
            raise RuntimeError(name)
        return spark.range(7)

    assert lake.extract_tables(read, ["dbo.a", "b"], str(tmp_path)) == {"a": 7, "b": 7}
    assert lake.read_layer(spark, str(tmp_path), "a").count() == 7
    with pytest.raises(RuntimeError):
        lake.extract_tables(read, ["dbo.broken", "c"], str(tmp_path))
    assert not (tmp_path / "c").exists()


def test_promote_replaces_the_target(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    for n in (5, 3):
        lake.write_layer(spark.range(n), raw, "t")
        lake.promote(spark, raw, bronze, ["t"])
    assert lake.read_layer(spark, bronze, "t").count() == 3


def test_partitioned_write(spark, tmp_path):
    lake.write_layer(spark.range(4).selectExpr("id", "id % 2 AS half"), str(tmp_path), "t", ("half",))
    assert (tmp_path / "t" / "half=0").is_dir()
    assert lake.read_layer(spark, str(tmp_path), "t").count() == 4


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id, item name ,price\n1,"a ""b"", c",2.50\n2,,\n')
    inferred = files.sanitize_columns(files.read_csv_table(spark, str(tmp_path / "t.csv")))
    assert inferred.dtypes == [("id", "int"), ("item_name", "string"), ("price", "double")]
    assert [tuple(r) for r in inferred.collect()] == [(1, 'a "b", c', 2.5), (2, None, None)]
    declared = files.read_csv_table(spark, str(tmp_path / "t.csv"), "id bigint, n string, p decimal(10,2)")
    assert declared.dtypes[2] == ("p", "decimal(10,2)")
    (tmp_path / "lines.csv").write_text('id,note\n1,"two\nlines"\n')
    assert files.read_csv_table(spark, str(tmp_path / "lines.csv"), multi_line=True).first()["note"] == "two\nlines"


@pytest.mark.parametrize("name, safe", [
    ("a b", "a_b"), (" a, ;b ", "a_b"), ("{x}=(y)\n\tz", "x_y_z"), ("plain", "plain"), ("_a_", "a")])
def test_safe_names(name, safe):
    assert files.safe_name(name) == safe


def test_tables_and_saved_profiles(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    tables.save_table(df, "t_saved")
    tables.save_table(df.limit(1), "t_saved")
    assert tables.read_table(spark, "t_saved").count() == 1
    assert spark.sql("SELECT * FROM t_saved").count() == 1
    profiling.profile_and_save(df, "t_profile", ["a"])
    nulls = {tuple(r) for r in tables.read_table(spark, "t_profile_null_summary").collect()}
    assert nulls == {("a", 0), ("b", 1)}
    assert [tuple(r) for r in tables.read_table(spark, "t_profile_duplicates").collect()] == [(1, 2)]


def test_missing_gold_is_empty_and_broken_gold_raises(spark, tmp_path):
    root = str(tmp_path)
    empty = lake.load_gold(spark, root, "sales_trends")
    assert empty.isEmpty() and dict(empty.dtypes)["SALES_DATE"] == "timestamp"
    names = {r[0] for r in lake.missing_datasets(spark, root).collect()}
    assert names == set(schemas.REPORT_DATASETS)
    (tmp_path / "loyalty_program_impact").mkdir()
    (tmp_path / "loyalty_program_impact" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        lake.load_gold(spark, root, "loyalty_program_impact").collect()
    assert not isinstance(error.value, AnalysisException) or "PATH_NOT_FOUND" not in str(error.value)


def test_required_columns(spark):
    df = spark.range(1).selectExpr("id AS A", "id AS b")
    assert schemas.require_columns(df, ["a", "B"]) is df
    with pytest.raises(schemas.MissingColumns, match="C.*D"):
        schemas.require_columns(df, ["a", "C", "D"])


def test_stage_reads_back_and_counts(spark):
    staged = staging.stage(spark.range(1234).repartition(3), "t")
    assert staged.rows == 1234 and staged.df.count() == 1234
    assert staged.buckets(100) == 13 and staged.buckets(10_000) == 1
    assert staging.shared_root(spark) in staged.df.inputFiles()[0]


def test_stage_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_root(Session)


def test_pipeline_twice_gives_the_same_gold(spark, tmp_path):
    root = str(tmp_path)

    def run():
        counts = pipeline.run_pipeline(
            spark, lambda name: raw_table(spark, FOLDER, name.split(".")[-1]), root,
            source_tables=[f"dbo.{t}" for t in schemas.RAW_TABLES])
        gold = {}
        for name in pipeline.METRICS:
            stored = lake.read_layer(spark, f"{root}/gold", name)
            declared = schemas.schema_of(schemas.GOLD[name])
            # a partition column comes last in the folder and where it is declared in the dataset
            assert set(stored.schema.simpleString()[7:-1].split(",")) == set(declared.simpleString()[7:-1].split(","))
            df = lake.read_layer(spark, f"{root}/gold", name, schemas.GOLD[name])
            assert df.columns == declared.fieldNames()
            gold[name] = sorted(map(str, df.collect()))
        return counts, gold

    first, second = run(), run()
    assert first == second
    assert first[0]["order_items"] == 6358 and first[0]["order_item_options"] == 5939
    assert all(first[1].values())
    silver = {t: lake.read_layer(spark, f"{root}/silver", t).count() for t in schemas.RAW_TABLES}
    assert (silver["order_items"], silver["order_item_options"]) == (5698, 5905)

    sales = lake.read_layer(spark, f"{root}/gold", "sales_trends")
    totals = sales.groupBy("SALES_PERIOD").agg(F.sum("TOTAL_REVENUE")).collect()
    assert len({r[1] for r in totals}) == 1 and len(totals) == 3


def test_pipeline_runs_chosen_metrics_and_passes_errors_on(spark, tmp_path):
    with pytest.raises(KeyError):
        pipeline.build_gold(spark, str(tmp_path), str(tmp_path), ["no_such_metric"])


def staged_folders(spark):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{staging.shared_root(spark)}/comanda/{spark.sparkContext.applicationId}")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in files.listStatus(root)} if files.exists(root) else set()


def test_a_batch_leaves_no_staged_table_behind(spark, tmp_path):
    def source(table):
        return raw_table(spark, "/root/testdata/sf0.001", table)

    before = staged_folders(spark)
    pipeline.run_pipeline(spark, source, str(tmp_path / "good"), ["customer_segmentation", "top_performing_locations"])
    assert staged_folders(spark) == before

    def broken(table):
        return source(table).withColumn("ITEM_PRICE", F.raise_error(F.lit("broken"))) if table == "order_items" else source(table)

    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, broken, str(tmp_path / "bad"))
    assert staged_folders(spark) == before


def test_star_lines_that_come_again_are_shuffled_once(spark, tmp_path):
    from comanda.sources.star_adapter import order_items_raw

    spark.range(40).selectExpr(
        "id AS l_orderkey", "id % 5 AS l_partkey", "id % 3 AS l_suppkey", "1 AS l_linenumber", "2.0D AS l_quantity"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).selectExpr(
        "id AS o_orderkey", "id % 9 AS o_custkey", "'p' AS o_orderpriority", "timestamp_ntz'2023-01-01 00:00:00' AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(5).selectExpr("id AS p_partkey", "'n' AS p_name", "'t' AS p_type", "3.0D AS p_retailprice").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    lines = order_items_raw(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("l_quantity") and plan.split("Join")[0].count("Generate") == 1
    again = [r.ORDER_ID for r in lines.groupBy("ORDER_ID").count().where("count = 2").collect()]
    assert sorted(again) == ["0", "17", "34"] and lines.count() == 43
