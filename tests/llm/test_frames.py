"""Tables that operators write on their way."""

from pyspark.sql import functions as F

from tillflow.llm import frames


def files(df):
    return df.select(F.input_file_name().alias("file")).distinct().count()


def test_narrow_rows_are_not_a_file_for_each_partition(spark, confs):
    """pipeline: its near duplicates wrote thousands of files of a few rows."""
    confs(spark__sql__shuffle__partitions="400", spark__sql__adaptive__coalescePartitions__enabled="false")
    most = frames.narrow_files(spark)
    assert most == max(4 * spark.sparkContext.defaultParallelism, 50)
    rows = spark.range(0, 4000, 1, 4).groupBy("id").count()
    for dealt in (False, True):
        kept = frames.saved_narrow(rows, "narrow", dealt)
        assert files(kept) <= most
        assert sorted(r.id for r in kept.collect()) == [*range(4000)]
    links = spark.range(0, 2000, 1, 4).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 2).alias("b"))
    found = {r.node: r.component for r in frames.components(links).collect()}
    assert found == {i: i - i % 2 for i in range(2000)}


def test_components_are_few_files(spark, confs, monkeypatch):
    confs(spark__sql__shuffle__partitions="400", spark__sql__adaptive__coalescePartitions__enabled="false")
    seen, save = [], frames.saved

    def watched(df, name):
        seen.append(files(out := save(df, name)))
        return out

    monkeypatch.setattr(frames, "saved", watched)
    frames.components(spark.range(0, 3000, 1, 4).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))).count()
    assert seen and max(seen) <= frames.narrow_files(spark)
