"""Row numbers within groups beside a window over each whole group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.operators.ordinal import with_ordinal


def test_places_match_a_window(spark):
    rows = [(k % 3 if k % 7 else None, (k * 37) % 101 if k % 11 else None, k) for k in range(2_000)]
    # One hot group with a third of all rows and more.
    rows += [(5, k, 10_000 + k) for k in range(1_500)]
    df = spark.createDataFrame(rows, "g int, v int, id long").repartition(7)
    got = with_ordinal(df, ["v", "id"], ["g"], partitions=9).collect()
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first(), "id")
    want = df.select("id", (F.row_number().over(w) - 1).alias("ordinal"), F.count("*").over(Window.partitionBy("g")).alias("ordinal_of")).collect()
    assert sorted((r.id, r.ordinal, r.ordinal_of) for r in got) == sorted((r.id, r.ordinal, r.ordinal_of) for r in want)
    assert len(got) == len(rows)


def test_no_groups_ties_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (0, "c")], "v int, s string")
    got = with_ordinal(df, ["v"], partitions=3).collect()
    assert sorted(r.ordinal for r in got) == [0, 1, 2, 3] and {r.ordinal_of for r in got} == {4}
    assert [r.s for r in sorted(got, key=lambda r: r.ordinal)][:2] == ["b", "c"]
    assert with_ordinal(df.where("false"), ["v"]).collect() == []
