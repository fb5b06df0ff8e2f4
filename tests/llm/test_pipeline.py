from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from platewise.llm.exactdedup import exact_dedup
from platewise.llm.mixing import mix_order
from platewise.llm.quality import score_quality
from platewise.llm.queries import OTHER, TARGETS
from platewise.llm.simhash import drop_near_copies
from platewise.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
def test_each_stage_does_what_its_operator_says(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    decide = {
        "quality": lambda d: score_quality(d, labels).filter("predicted = 1"),
        "exact_copies": lambda d: exact_dedup(d).filter("kept"),
        "near_copies": drop_near_copies,
        "mixing": lambda d: d,
        "pieces": lambda d: d,
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == list(decide)
    for name, stage in corpus_pipeline.STAGES:
        wanted = {r.doc_id for r in decide[name](docs).select("doc_id").collect()}
        out = materialize(stage(spark, docs, SF), name)
        rows = out.select("doc_id").collect()
        assert sorted(r.doc_id for r in rows) == sorted(wanted), name
        if name == "pieces":
            assert out.filter("not lossless OR n_tokens <> size(ids)").count() == 0
        else:
            assert out.columns == columns
            assert out.join(docs, columns, "left_anti").count() == 0
        docs = out


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    rows = [(i, f"Plain words number {i} in a row. " * 5, "en", "src0", 1) for i in range(40)]
    rows += [(None, None, None, None, None), (50, "", None, "s", 0), (51, "x" * 200_000, "en", None, 1), rows[0], rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], schema + ", slot int, component_id string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(40)], "doc_id long, quality int")
    labels.filter(F.lit(False)).write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    # The null text and the empty one are copies of each other.
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for i in [*range(40), 50, 51])
    docs.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "none/labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_positions_follow_the_mix(spark, tmp_path):
    names = ["src0", "src1", "src2", "other"]
    rows = [(i, "text " * (1 + i % 7 * 40), names[i % 4 if i % 3 else 3]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    written = materialize(corpus_pipeline.mixing(spark, docs, ""), "mix")
    out = materialize(corpus_pipeline.pieces(spark, written, ""), "pieces").orderBy("position").collect()
    assert [r.position for r in out] == list(range(len(rows)))
    order = [r.doc_id for r in mix_order(docs, TARGETS, OTHER).orderBy("slot", "place").collect()]
    assert [r.doc_id for r in out] == order
    # Shares along the column, to a block of each source.
    source = {i: s for i, _, s in rows}
    first = [source[r.doc_id] for r in out[:400]]
    assert abs(first.count("src0") - 400 * 25 / 90) <= 16 and abs(first.count("src1") - 400 * 15 / 90) <= 16
    # Uneven files, which a plain scan deals out by size.
    path = str(tmp_path / "uneven")
    uneven = spark.range(3000).withColumn("text", F.expr("repeat(uuid(), IF(id > 2000, 9, 1))"))
    uneven.repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(path)
    again = spark.read.parquet(path).withColumnRenamed("id", "doc_id")
    got = corpus_pipeline.pieces(spark, again, "").select("doc_id", "position").collect()
    assert [tuple(r) for r in got] == [(i, i) for i in range(3000)]
