"""The stages of the corpus pipeline on one small table, each against what it must do."""
import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ride_analytics.sources.storage import fresh_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark):
    draw = random.Random(31)
    vocabulary = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(2, 8))) for _ in range(2000)]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n)).capitalize() + "."
    items = [(k, text(30)) for k in range(10)]
    rows = [(i, text(draw.randrange(30, 200))) for i in range(150)]
    bad = [(1000 + i, " ".join(draw.choice(vocabulary).upper() + "!!" for _ in range(80))) for i in range(60)]
    copies = [(2000 + i, rows[i][1].replace(" ", "\n")) for i in range(10)]
    near = [(3000 + i, rows[20 + i][1] + " " + draw.choice(vocabulary)) for i in range(10)]
    leaks = [(4000 + i, text(60) + " " + items[i % 10][1] + " " + text(60)) for i in range(10)]
    odd = [(5000, None), (5001, ""), (None, text(50)), (5002, text(40)), (5002, text(40)), (5003, rows[0][1]), (5003, rows[0][1])]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows + bad + copies + near + leaks + odd]
    root = fresh_path(spark, "pipeline-test")
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in rows + bad], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "minhash near-dedup", "benchmark decontamination", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("keep", F.lit("extra"))
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        path = fresh_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == [*(c.split()[0] for c in COLUMNS.split(", ")), "keep"]
        seen.append([r.doc_id for r in docs.select("doc_id").collect()])
    quality, exact, near, clean = seen
    assert sum(1000 <= (i or 0) < 1060 for i in quality) <= 1 and sum((i if i is not None else 9999) < 150 for i in quality) >= 149
    assert not any(2000 <= (i or 0) < 2010 for i in exact) and 5003 not in exact and sum(i == 5002 for i in exact) == 2
    assert not any(3000 <= (i or 0) < 3010 for i in near) and set(exact) - set(near) <= set(range(3000, 3010))
    assert set(near) - set(clean) == set(range(4000, 4010))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(clean)


def test_run_and_empty_tables(spark, folder):
    whole = corpus_pipeline.run(spark, folder)
    assert whole.count() > 0 and "sequence_id" in whole.columns
    empty = fresh_path(spark, "pipeline-empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_rows_of_one_id_that_differ_in_white_space(spark):
    rows = [(1, "a b", "en", "s", 3), (1, "ab", "en", "s", 2), (2, "c d", "en", "s", 3), (2, "c\nd", "en", "s", 3), (2, "cd", "en", "s", 2), (3, "e", "en", "s", 1)]
    got = corpus_pipeline.exact(spark, spark.createDataFrame(rows, COLUMNS), "").collect()
    assert sorted((r.doc_id, len(r.text)) for r in got) == [(1, 3), (2, 3), (3, 1)]
