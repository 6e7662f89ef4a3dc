"""Stage boundaries: what is committed is read back, what is not does not exist, and facts are scanned once."""

import pytest
from pyspark.sql import functions as F

from dockplan.plans import catalog
from dockplan.stages import Stages, kept


def test_kept_is_written_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    df = spark.range(10).select(F.udf(count, "long")("id").alias("id"))
    table = kept(df)
    assert table.count() == 10 and table.join(table, "id").count() == 10 and seen.value == 10


def test_a_named_run_goes_on_after_its_last_stage(spark, tmp_path):
    def build():
        built.append(1)
        return spark.createDataFrame([(1, None), (2, "x")], "a int, b string")

    built = []
    first = Stages(spark, "week-12", str(tmp_path)).keep("plan", build)
    again = Stages(spark, "week-12", str(tmp_path)).keep("plan", build)
    assert len(built) == 1 and again.schema == first.schema
    assert sorted(map(tuple, again.collect()), key=str) == [(1, None), (2, "x")]
    assert Stages(spark, "week-13", str(tmp_path)).committed("plan") is None


def test_data_without_a_marker_is_not_a_stage(spark, tmp_path):
    """An attempt that dies while it writes, or before its marker, leaves nothing that is read."""
    stages = Stages(spark, "r", str(tmp_path))
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        stages.keep("t", lambda: bad)
    assert stages.committed("t") is None
    spark.range(3).write.parquet(f"{stages.folder}/t-orphan")
    (tmp_path / "run-r" / "t.committed").mkdir()
    assert stages.committed("t") is None
    assert stages.keep("t", lambda: spark.range(5)).count() == 5


def test_two_attempts_that_both_commit_agree(spark, tmp_path):
    stages = Stages(spark, "r", str(tmp_path))
    for name, rows in (("t-b", 2), ("t-a", 2)):
        spark.range(rows).write.parquet(f"{stages.folder}/{name}")
        marker = [(name, spark.range(1).schema.json())]
        spark.createDataFrame(marker, "folder string, schema string").write.mode("append").json(f"{stages.folder}/t.committed")
    assert "t-a" in stages.committed("t").inputFiles()[0]


class Counting(Stages):
    """Scans of the fact files in the plan of every stage that is written."""

    def keep(self, name, build):
        def counted():
            df = build()
            self.scans = getattr(self, "scans", [])
            self.scans.append((name, scans(df)))
            return df

        return super().keep(name, counted)


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    files = [leaves.apply(i).toString() for i in range(leaves.size())]
    facts = {f.name for f in df.sparkSession.read.parquet("/root/testdata/sf0.001/lineitem.parquet").schema}
    return sum("parquet" in f and any(f"{c}#" in f for c in facts) for f in files)


@pytest.mark.parametrize("finish, names", [
    (catalog.weekly_schedule, ["sized", "dated"]),
    (catalog.weekly_audit, ["sized", "dated", "schedule"]),
])
def test_facts_are_scanned_once(spark, finish, names):
    tables = catalog._t(spark, "/root/testdata/sf0.001")
    stages = Counting(spark)
    out = finish(tables, catalog.WP, stages)
    assert dict(stages.scans) == {n: int(n == "sized") for n in names}
    assert scans(out) == 0 and out.count() > 0


def test_resumed_schedule_is_the_same(spark):
    tables = catalog._t(spark, "/root/testdata/sf0.001")
    stages = Stages(spark, "resumed")
    first = sorted(map(str, catalog.weekly_schedule(tables, catalog.WP, stages).collect()))
    assert stages.committed("sized") is not None
    assert sorted(map(str, catalog.weekly_schedule({"forecast": tables["forecast"]}, catalog.WP, Stages(spark, "resumed")).collect())) == first
