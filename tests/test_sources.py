from pyspark.sql import types as T

from tabkit.session import scratch_path

from tabkit.sources import csv as csvio
from tabkit.sources import tables, text

LINES = ["1,2.5,abc", "0,,nan", "", "7", "1, 3 ,0x10,1e3,007"]


def test_parse_labeled_points(spark):
    path = scratch_path(spark, "test")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.mode("overwrite").text(path)
    rows = text.parse_labeled_points(text.read_lines(spark, path), as_vector=False).collect()
    got = sorted((r.label, list(r.features)) for r in rows)
    assert got == sorted([(1.0, [2.5, -1.0]), (0.0, [-1.0, -1.0]), (-1.0, []), (7.0, []),
                          (1.0, [3.0, -1.0, 1000.0, 7.0])])


def test_vector_form(spark):
    df = spark.createDataFrame([("1,2,3",)], "value string")
    r = text.parse_labeled_points(df).first()
    assert r.label == 1.0 and r.features.toArray().tolist() == [2.0, 3.0]


def test_indexed_csv_round_trip(spark):
    path = scratch_path(spark, "test") + "/t"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    df = spark.createDataFrame([(1, "a b", 1.5), (2, None, None)], schema)
    csvio.write_indexed_csv(df, path, "id")
    headers = {r.value for r in spark.read.text(path).where("value like '%name,x'").collect()}
    assert headers == {'"",name,x'}  # the row label is an unnamed (empty) first column
    back = csvio.read_indexed_csv(spark, path, schema, "id")
    assert sorted(back.collect()) == sorted(df.collect())


def test_positional_and_prediction_files(spark):
    base = scratch_path(spark, "test")
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    csvio.write_headerless_csv(df, base + "/p")
    back = csvio.read_positional_csv(spark, base + "/p", 3)
    assert back.columns == ["0", "1", "2"] and back.first()["2"] == 3.0
    preds = spark.createDataFrame([(5, 1.0)], "id bigint, prediction double")
    assert csvio.write_predictions(preds, None, "id", "target").first().asDict() == {"id": 5, "target": 1}
    csvio.write_predictions(preds, base + "/s", "id", "target")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("target", T.IntegerType())])
    assert csvio.read_table_csv(spark, base + "/s", schema).first().asDict() == {"id": 5, "target": 1}


def test_file_inventory(spark, sf_dir):
    inv = tables.file_inventory(spark, f"{sf_dir}/nation.parquet").collect()
    assert [(r.file_name, r.rows) for r in inv] == [("nation.parquet", 25)]


def test_csv_is_read_by_name_as_the_frame_reader_does(spark):
    """Shuffled columns, doubled quotes, commas and missing words, against pandas."""
    import io

    import pandas as pd

    raw = 'z,b,id,a\n9,"say ""hi"", ok",1,1.5\n9,NA,2,NaN\n9,"x,y",3,\n9, null ,4,-inf\n9,n/a,5,abc\n'
    path = scratch_path(spark, "csv-name")
    spark.createDataFrame([(raw.rstrip("\n"),)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())])
    got = sorted(tuple(r) for r in csvio.read_table_csv(spark, path, schema).collect())
    assert got == [(1, 1.5, 'say "hi", ok'), (2, None, None), (3, None, "x,y"), (4, float("-inf"), None), (5, None, None)]
    want = pd.read_csv(io.StringIO(raw.replace(" null ", "null")))
    assert [g[2] for g in got] == [None if pd.isna(x) else x for x in want["b"]]
    bad = {r.column: r.malformed for r in csvio.malformed_fields(spark, path, schema).collect()}
    assert bad == {"id": 0, "a": 1, "b": 0}


def test_csv_line_breaks_inside_quotes(spark):
    path = scratch_path(spark, "csv-lines")
    spark.createDataFrame([('id,t\n1,"two\nlines"\n2,one',)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    got = sorted(tuple(r) for r in csvio.read_table_csv(spark, path, schema, multi_line=True).collect())
    assert got == [(1, "two\nlines"), (2, "one")]


def test_files_of_a_folder_have_their_own_headers(spark):
    path = scratch_path(spark, "csv-orders")
    for k, raw in enumerate(["id,a,b\n1,10,x", "id,b,a\n2,y,20", "b,id\nz,3", "id,extra,a\n4,e,40", "id,a,b"]):
        spark.createDataFrame([(raw,)], "value string").coalesce(1).write.mode("append").text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                           T.StructField("nowhere", T.DoubleType())])
    for multi_line in (False, True):
        got = sorted(tuple(r) for r in csvio.read_table_csv(spark, path, schema, multi_line=multi_line).collect())
        assert got == [(1, 10, "x", None), (2, 20, "y", None), (3, None, "z", None), (4, 40, None, None)]


def test_one_file_with_quoted_line_breaks_is_read_by_many_tasks(spark):
    """Blocks begin anywhere: in a record, in quotes, and one record is longer than a block."""
    import csv as plain
    import io
    import random

    r = random.Random(4)
    rows = [["id", "t", "u"]]
    for i in range(1500):
        text = "".join(r.choice(["a", "b,", '"', "\n", " x ", "é", "\r\n", "\n\n"]) for _ in range(r.randrange(12)))
        rows.append([str(i), text + "." if text else "", "long\n" * 2000 if i == 700 else "u"])
    raw = io.StringIO()
    plain.writer(raw, lineterminator="\n").writerows(rows)
    path = scratch_path(spark, "csv-blocks")
    spark.createDataFrame([(raw.getvalue().rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("u", T.StringType())])
    want = sorted((int(a), b or None, c) for a, b, c in rows[1:])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700b", "4k", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = csvio.read_table_csv(spark, path, schema, multi_line=True)
            assert sorted(tuple(x) for x in df.collect()) == want, size
            if size != old:
                assert csvio._lines(spark, [f"{path}/*.txt"]).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quotes_survive_the_indexed_round_trip(spark):
    path = scratch_path(spark, "csv-quotes")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([(1, 'a "b", c'), (2, 'back\\slash "q"'), (3, "  spaces  ")], schema)
    csvio.write_indexed_csv(df, path, "id")
    assert sorted(csvio.read_indexed_csv(spark, path, schema, "id").collect()) == sorted(df.collect())


def test_inventory_keeps_equal_names_apart_and_lists_empty_files(spark):
    path = scratch_path(spark, "inventory test")
    for part, n in (("a", 3), ("b", 4), ("c", 0)):
        spark.range(n).coalesce(1).write.parquet(f"{path}/{part}")
    found = tables.file_inventory(spark, path).collect()
    assert sorted((r.file_name.split("/")[0], r.rows) for r in found) == [("a", 3), ("b", 4), ("c", 0)]


def test_binary_points(spark):
    df = spark.createDataFrame([("1,2",), ("0,3",), ("x,4",), ("2,5",), ("",)], "value string")
    got = text.binary_points(text.parse_labeled_points(df, as_vector=False)).collect()
    assert sorted((r.label, list(r.features)) for r in got) == [(0.0, [3.0]), (1.0, [2.0])]
