"""The pipeline: every stage's decisions take effect on all that its predecessor kept."""

from pyspark.sql import functions as F


def test_pipeline(spark, small):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash_dedup", "suffix_dedup", "mix", "bpe"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    sizes = []
    now = docs
    for i, (_, stage) in enumerate(cp.STAGES):
        now = stage(spark, now, small).cache()
        sizes.append(now.count())
        if i < len(cp.STAGES) - 1:
            assert now.columns == docs.columns
    assert sizes[0] < docs.count()
    assert sizes[1] < sizes[0]
    assert sizes[2] == sizes[1]
    assert sizes[4] == sizes[3]
    out = cp.run(spark, small)
    assert out.columns == ["doc_id", "ids", "decoded"]
    assert out.count() == sizes[4]
    assert out.select(F.countDistinct("doc_id")).first()[0] <= sizes[1]


def test_registered(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names
