"""The posting view over the driver tables reaches every rule of the operators."""

from pyspark.sql import functions as F

from postclust.sources.tables import postings_from_tables


def test_view_reaches_the_rules(spark, sf_small):
    p = postings_from_tables(spark, sf_small).cache()
    q, a = p.where("posting_type = 1"), p.where("posting_type = 2")
    assert q.where("accepted_answer IS NOT NULL").count() > 0 and q.where("accepted_answer IS NULL").count() > 0
    assert q.where("score < 0").count() > 0 and q.where("score > 0").count() > 0
    assert q.groupBy("id").count().where("count > 1").count() > 0
    assert a.where("parent_id IS NULL").count() > 0
    assert p.where("posting_type = 3 AND parent_id IS NOT NULL").count() > 0
    # answers to ids without a question, and questions without an answer
    ids, parents = q.select("id").distinct(), a.select(F.col("parent_id").alias("id")).distinct()
    assert parents.where("id IS NOT NULL").join(ids, "id", "left_anti").count() > 0
    p.unpersist()
