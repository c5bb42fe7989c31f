"""Which of several rows with one id, source and size the mix repeats does not depend on the order of the rows."""

from pyspark.sql import functions as F

from cytoframe.llm import mixing


def test_ties_and_null_ids(spark):
    rows = [(None if i % 3 else i % 5, f"w{i} " + "a b c", ["x", "y", None][i % 3], "k") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, `_id` string")
    count = lambda df: sorted((r.text, r.n) for r in df.groupBy("text").agg(F.count("*").alias("n")).collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    first = count(out)
    assert first == count(mixing.mixed_documents(docs.repartition(7).orderBy(F.rand(4))))
    want = mixing.mix_copies(docs).agg(F.sum("copies")).first()[0]
    assert sum(n for _, n in first) == want
