import pytest
from pyspark.sql import functions as F

from platewise.plans.aggregate import aggregate
from platewise.plans.report import build_report
from platewise.session import materialize, scratch_root


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = materialize(spark.range(3).withColumn("odd name.x", F.lit("a")))
    assert sorted(r.id for r in df.collect()) == [0, 1, 2]
    assert df.columns == ["id", "odd name.x"]


def test_aggregate_file_to_file(spark, tmp_path):
    spark.createDataFrame([("b", 1.0), ("a", 2.0), ("a", 4.0)], "w string, Cells_x double").write.parquet(str(tmp_path / "in"))
    aggregate(spark, str(tmp_path / "in"), str(tmp_path / "deep" / "out"), strata=["w"])
    got = spark.read.parquet(str(tmp_path / "deep" / "out"))
    assert {r.w: r.Cells_x for r in got.collect()} == {"a": 3.0, "b": 1.0}


def test_report(spark, cohort):
    frame = cohort()
    profiles = spark.createDataFrame(frame)
    consensus = profiles.groupBy("Metadata_Compound").agg(
        *[F.median(c).alias(c) for c in frame.columns if c.startswith("feature_")]
    )
    report = build_report(profiles=profiles, consensus=consensus, top_n=4)
    assert report.skipped == {}
    assert report.plates_label == "mean |feature|" and report.plates.count() == 3 * 96
    assert report.plates_maximum.first().value_max > 0
    assert report.embedding.count() == 48
    assert {r.plate_rank for r in report.embedding.collect()} == {0, 1, 2}
    assert report.replicates.percent_replicating > 50
    assert report.similarity.count() == 16


def test_report_skips_what_the_data_cannot_support(spark, cohort):
    report = build_report(profiles=spark.createDataFrame(cohort(plates=1, wells=3, compounds=6)))
    assert set(report.skipped) == {"embedding", "replicates", "similarity"}
    with pytest.raises(AttributeError):
        report.embedding.count()


def test_report_goes_on_after_a_failed_job(spark, cohort):
    profiles = spark.createDataFrame(cohort())
    broken = profiles.withColumn("Metadata_Well", F.expr("raise_error('disk gone')").cast("string"))
    report = build_report(cells=broken, profiles=profiles)
    assert "disk gone" in report.skipped["plates"]
    assert report.embedding.count() == 48


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        def __init__(self, master, **conf):
            self.conf = Conf(conf)
            self.sparkContext = type("Context", (), {"master": master})

    with pytest.raises(ValueError, match="all machines share"):
        scratch_root(Session("spark://host:7077", **{"spark.sql.warehouse.dir": "file:/opt/warehouse"}))
    shared = Session("yarn", **{"spark.sql.warehouse.dir": "hdfs://names/warehouse"})
    assert scratch_root(shared) == "hdfs://names/warehouse-intermediate"
    assert scratch_root(Session("yarn", **{"spark.checkpoint.dir": "hdfs://names/x/"})) == "hdfs://names/x"
    assert "platewise-" in scratch_root(Session("local[2]"))
