import os

from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.sources import readers as R
from basketry.sources import sinks as K


def test_useraction_csv_roundtrip(spark, tmpdir_path):
    rows = [(1, "S", None, 'say "hi", ok', "u1"), (2, "O", 7, "", "u2"), (3, "C", 8, None, None),
            (4, "S", None, "two\nlines", "u4")]
    df = spark.createDataFrame(rows, S.USERACTION)
    out = os.path.join(tmpdir_path, "log")
    K.write_csv(df, out, header=False)
    with open(os.path.join(out, "ignored.txt"), "w") as f:
        f.write("not,a,csv,part,x\n")
    back = R.read_useraction(spark, out, multi_line=True)
    got = sorted(back.collect(), key=lambda r: r.timestamp)
    assert [tuple(r) for r in got][0] == (1, "S", None, 'say "hi", ok', "u1")
    assert got[3].search_keyword == "two\nlines"
    # Spark CSV reads both '' and null back as null: stages exchange Parquet instead
    assert got[1].search_keyword is None and got[2].search_keyword is None


def test_metadata_by_name_keeps_leading_zeros(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "user.csv")
    with open(p, "w") as f:
        f.write("m_id,age,comp_mid,sex\nU1,30,00012,1\n")
    df = R.read_metadata(spark, p, "user")
    assert df.columns == ["comp_mid", "sex", "age", "m_id"]
    assert tuple(df.first()) == ("00012", 1, 30, "U1")


def test_lookup_last_id_wins(spark, tmpdir_path):
    for name, text in [("ids.tsv", "5\n7\n5\n"), ("titles.tsv", "a \nb\nc\n"), ("vectors.tsv", "1 2\n3 4\n5\t6\n")]:
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    df = R.read_lookup(spark, *[os.path.join(tmpdir_path, n) for n in ("ids.tsv", "titles.tsv", "vectors.tsv")])
    got = {r.prod_no: (r.title, list(r.vector)) for r in df.collect()}
    assert got == {5: ("c", [5.0, 6.0]), 7: ("b", [3.0, 4.0])}


def test_order_extract_size_band(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "parts")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write("1,O,1,,u\n2,C,1,,u\n")
    with open(os.path.join(d, "part-1.csv"), "w") as f:
        f.write("".join(f"{i},O,2,,v\n" for i in range(200)))
    small = os.path.getsize(os.path.join(d, "part-0.csv"))
    log = R.read_useraction(spark, d)
    got = R.extract_orders(log, small, None).collect()
    assert len(got) == 200 and all(r.prod_no == 2 for r in got)
    got = R.extract_orders(log, 0, small).collect()
    assert [r.timestamp for r in got] == [1]


def test_instances_partitioned_by_split(spark, tmpdir_path):
    inst = spark.createDataFrame([(0, [1, 2], [3], 4, "training"), (1, [2, 3], [-1], 5, "test")],
                                 "user_idx int, orders array<int>, clicks array<int>, label int, split string")
    p = os.path.join(tmpdir_path, "instances")
    K.save_instances(inst, p)
    df = R.read_instances(spark, p, split="test")
    assert "PartitionFilters: [isnotnull(split" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.label for r in df.collect()] == [5] and "clicks" not in df.columns


def test_export_vectors_tsv(spark, tmpdir_path):
    items = spark.createDataFrame([(1, "t a", [0.5, 1.0])], "prod_no int, title string, vector array<double>")
    p = os.path.join(tmpdir_path, "tsv")
    K.export_vectors_tsv(items, p)
    assert spark.read.text(p).first().value == "1\tt a\t0.5\t1.0"


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, c int")
    assert sorted(R.union_by_name([a, b]).columns) == ["a", "b", "c"]


def test_rejected_records_are_kept_whole(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "log.csv"), "w") as f:
        f.write('1,O,2,,u\nx,O,2,,u\n3,C,4,"say ""hi"", ok",u\n4,C\n5,S,,red,u,more\n')
    got = R.read_useraction_with_rejects(spark, tmpdir_path)
    assert got.where("_rejected is not null").count() == 3
    rows = {(r.timestamp, r.search_keyword, r._rejected) for r in got.collect()}
    assert rows == {(1, None, None), (3, 'say "hi", ok', None), (None, None, "x,O,2,,u"), (None, None, "4,C"), (None, None, "5,S,,red,u,more")}
    assert R.parse_csv_lines(got.limit(0).selectExpr("_rejected as value")).count() == 0


def test_csv_parts_read_each_file_once(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "some parts")
    os.makedirs(d)
    for name, text in (("a.csv", "x,y\n1,p\n2,q\n"), ("b.csv", "y,x\nr,3\n"), ("c.csv", "x,z,y\n4,9,s\n"), ("d.csv", ""), ("e.txt", "no,csv\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    df = R.read_csv_parts(spark, d)
    assert sorted((r.x, r.y, r.z) for r in df.collect()) == [("1", "p", None), ("2", "q", None), ("3", "r", None), ("4", "s", "9")]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 3
    assert dict(R.first_lines(spark, df.inputFiles()))[os.path.join("file:" + d, "b.csv")] == "y,x"


def test_lines_are_numbered_over_blocks_and_files(spark, tmpdir_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    for name, part in (("b", lines[1200:]), ("a", lines[:1200])):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write("\n".join(part) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = R.numbered_lines(spark, tmpdir_path)
        assert got.rdd.getNumPartitions() > 1
        assert {r.line: r.value for r in got.collect()} == dict(enumerate(lines))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_new_instances_replace_their_days_only(spark, tmpdir_path):
    p, day = os.path.join(tmpdir_path, "instances"), 86400
    schema = "user_idx int, timestamp long, orders array<int>, label int, split string"
    first = [(0, 100 * day, [1], 1, "training"), (1, 101 * day, [1], 2, "training"), (2, 101 * day, [1], 3, "test")]
    K.save_new_instances(spark.createDataFrame(first, schema), p)
    K.save_new_instances(spark.createDataFrame([(1, 101 * day, [1], 7, "training"), (3, 102 * day, [1], 8, "training")], schema), p)
    assert sorted((r.user_idx, r.label) for r in R.read_instances(spark, p).collect()) == [(0, 1), (1, 7), (2, 3), (3, 8)]
    one = R.read_instances(spark, p, split="training", first_day="1970-04-12", last_day="1970-04-12")
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    assert [(r.user_idx, r.label) for r in one.collect()] == [(1, 7)]
