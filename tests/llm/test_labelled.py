"""The bounded sample of labelled documents."""

import zlib

from pyspark.sql import functions as F

from flowgauge.llm.labelled import labelled_sample


def test_ids_that_docs_lack_use_up_nothing(spark):
    """Half of the labelled ids are not in the table; the sample is still full, one row an id, none held out."""
    docs = spark.range(0, 4000, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 < 2).cast("int").alias("y"))
    got = labelled_sample(docs, labels, "y", 300).collect()
    assert len({r["doc_id"] for r in got}) == len(got) == 600 and sum(r["y"] for r in got) == 300
    assert all(r["doc_id"] % 2 == 0 and zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in got)
    again = labelled_sample(docs.repartition(7), labels.repartition(5), "y", 300).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_a_repeated_id_is_one_row(spark):
    """One labelled id on most of the rows: one of its texts is taken, whatever the partitions."""
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionAll(spark.createDataFrame([(2, "b"), (2, None), (3, None), (None, "x")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (None, 1), (9, 1), (2, 7)], "doc_id long, y int")
    rows = [sorted(map(tuple, labelled_sample(docs.repartition(p), labels, "y", 10).collect())) for p in (2, 9)]
    assert rows[0] == rows[1] and [(r[0], r[2]) for r in rows[0]] == [(1, 0), (2, 1), (3, 0)]
    assert rows[0][1][1] == "b" and rows[0][2][1] is None
