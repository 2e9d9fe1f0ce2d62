"""Given tables used by the tests of the training-data operators."""

SF01 = "/root/testdata/sf0.01"


def joined(spark, result):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    return result.join(docs, "doc_id").join(labels, "doc_id", "left")
