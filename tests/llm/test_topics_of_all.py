"""Topics are those of all documents."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fluvion.llm.mixing import topics


def test_topics_that_only_late_documents_have_are_found(spark):
    # late: beyond the first 20,000 by the hash of their id
    a, b, late = "flood gauge weir discharge", "sediment bottle filter paper", "ledger invoice postage stamp"
    rank = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.xxhash64("doc_id", F.lit(42))))
    text = F.when(F.col("r") > 20_000, late).when(F.col("r") % 2 == 0, a).otherwise(b)
    docs = spark.range(40_000).select(F.col("id").alias("doc_id")).withColumn("r", rank).select("doc_id", text.alias("text")).repartition(4)
    got = {(r["text"], r["topic"]) for r in topics(docs, "doc_id", "text", k=3).select("text", "topic").distinct().collect()}
    assert len(got) == 3 and len({t for _, t in got}) == 3
