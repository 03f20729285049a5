"""OE export (X12) and the parallel global numbering."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillprice.operators.windows import global_row_number
from quillprice.plans.export import oe_tagged_export


def test_oe_vector(spark):
    oe = spark.createDataFrame([("A", "p1"), ("A", "p2"), ("B", "p1")], "Manufacturer string, PartNumber string")
    got = sorted(tuple(r) for r in oe_tagged_export(oe).collect())
    assert got == sorted([("A", "<A>", 0), ("A", "p1", 1), ("A", "p2", 2), ("A", "</A>", 3),
                          ("B", "<B>", 2), ("B", "p1", 3), ("B", "</B>", 4)])


def test_null_manufacturer_collapses_to_one_tag_row(spark):
    oe = spark.createDataFrame([(None, "x"), ("A", "p1")], "Manufacturer string, PartNumber string")
    got = [tuple(r) for r in oe_tagged_export(oe).collect()]
    assert len(got) == 5
    assert set(got) == {(None, None, None), (None, "x", 1), ("A", "</A>", 3), ("A", "<A>", 1),
                        ("A", "p1", 2)}


def test_global_row_number_matches_window(spark):
    # duplicates, a hot key and NULLs, over many partitions
    rows = [("hot", f"p{i % 7}") for i in range(300)] + [(None, "z"), ("a", None), ("b", "q")] * 3
    df = spark.createDataFrame(rows, "m string, p string").repartition(5)
    ours = global_row_number(df, ["m", "p"], "id", num_partitions=6)
    ref = df.withColumn("id", F.row_number().over(
        Window.orderBy(F.col("m").asc_nulls_first(), F.col("p").asc_nulls_first())).cast("long"))
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
    ids = [r.id for r in ours.collect()]
    assert sorted(ids) == list(range(1, len(rows) + 1))


def test_export_row_count_and_nesting(spark):
    from quillprice.sources.fixtures import Fixtures
    oe = Fixtures(spark, "/root/testdata/sf0.001").oe_list
    n, makes = oe.count(), oe.select("Manufacturer").distinct().count()
    out = oe_tagged_export(oe)
    assert out.count() == n + 2 * makes
    # ordered by (Manufacturer, id, tag-first) each manufacturer starts with its open
    # tag and ends with its close tag
    rows = out.orderBy("Manufacturer", "id", F.col("PartNumber").startswith("</"),
                       ~F.col("PartNumber").startswith("<")).collect()
    by_make = {}
    for r in rows:
        by_make.setdefault(r.Manufacturer, []).append(r.PartNumber)
    for m, parts in by_make.items():
        assert parts[0] == f"<{m}>" and parts[-1] == f"</{m}>"


def test_numbering_does_not_rest_on_shuffle_reuse(spark):
    # a payload column beside the order column, many rows, and no exchange reuse
    df = spark.range(400_000, numPartitions=8).select(
        ((F.col("id") * 7919) % 400_000).alias("k"), F.sha1(F.col("id").cast("string")).alias("payload"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = global_row_number(df, ["k"], "id", num_partitions=8)
            off = got.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"),
                          F.sum((F.col("id") != F.col("k") + 1).cast("int")).alias("wrong")).first()
        finally:
            spark.conf.set("spark.sql.exchange.reuse", before)
        assert (off.n, off.d, off.wrong) == (400_000, 400_000, 0)


def test_hot_group_of_copies_is_split_across_partitions(spark):
    from quillprice.operators.windows import ordered_partitions
    hot = [("HOT", "same")] * 3000                     # one group of identical rows: 1/3 of all
    rest = [(f"m{i % 40}", f"p{i}") for i in range(6000)]
    df = spark.createDataFrame(hot + rest, "m string, p string").repartition(8)
    sizes = [r["count"] for r in ordered_partitions(df, ["m", "p"], 8).groupBy("__pid").count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 3000 / 2
    ids = [r.id for r in global_row_number(df, ["m", "p"], "id", num_partitions=8).collect()]
    assert sorted(ids) == list(range(1, 9001))


def test_rows_of_a_stored_table_are_stored_once_and_others_twice(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from quillprice.operators import windows
    stored, real = [], windows.materialize
    monkeypatch.setattr(windows, "materialize", lambda df, name: stored.append(name) or real(df, name))
    rows = [(i % 7 if i % 3 else 1, f"p{i % 50}", i) for i in range(2000)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "m int, p string, n int").repartition(5).write.parquet(path)
    table = spark.read.parquet(path)
    for df, names in ((table.select("m", "p"), ["ranged"]), (table.filter("n >= 10").withColumn("q", F.upper("p")), ["ranged"]),
                      (table.distinct(), ["row-number", "ranged"]), (table.withColumn("r", F.rand()), ["row-number", "ranged"])):
        stored.clear()
        got = global_row_number(df, ["m", "p"], "id", num_partitions=6).select("id", "m", "p").collect()
        assert stored == names
        assert [(r.m, r.p) for r in sorted(got, key=lambda r: r.id)] == sorted((r.m, r.p) for r in df.collect())
        assert sorted(r.id for r in got) == list(range(1, len(got) + 1))
