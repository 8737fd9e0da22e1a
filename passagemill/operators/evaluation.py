"""Retrieval quality: which documents should be found, and measures over ranked hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words
from ..session import materialise

#: A question is looked up by its first words, at most so many, before it is compared whole.
ANCHOR_WORDS = 8


def _padded(w: Column) -> Column:
    """Words as one text with single spaces between and around, so that parts match at word ends only."""
    return F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))


def truth_by_containment(
    questions: DataFrame, docs: DataFrame, query_id: str = "qid", question: str = "question", doc_id: str = "source_file", text: str = "text"
) -> DataFrame:
    """(query_id, doc_id), distinct: the documents whose words hold the question's words in a row.

    Documents are cut into runs of words as long as the questions' anchors; runs whose hash is an
    anchor's meet the question, and the texts are compared. Null and blank questions are in no document.
    """
    asked = questions.select(query_id, words(F.lower(F.col(question))).alias("w")).where(F.size("w") > 0)
    asked = asked.withColumn("size", F.least(F.size("w"), F.lit(ANCHOR_WORDS)))
    # the number of words is part of the hash: distinct hashes are found by hashing, distinct pairs by comparing all with all
    anchor = F.xxhash64("size", F.array_join(F.slice("w", F.lit(1), F.col("size")), " "))
    asked = asked.select(query_id, _padded(F.col("w")).alias("whole"), "size", anchor.alias("anchor"))
    asked = materialise(asked, "anchors")
    lengths = sorted(r[0] for r in asked.select("size").distinct().collect())  # at most ANCHOR_WORDS numbers
    if not lengths:
        return _no_pairs(questions, docs, query_id, doc_id)
    cut = words(F.lower(F.col(text)))
    rows = docs.select(doc_id, cut.alias("w"))

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.lit(size), F.array_join(F.slice("w", i, F.lit(size)), " ")))

    places = rows.select(doc_id, F.explode(F.array_distinct(F.concat(*[runs(n) for n in lengths]))).alias("anchor"))
    maybe = places.join(asked, "anchor").select(query_id, doc_id, "whole").distinct()
    # texts meet only the few pairs that share an anchor
    texts = docs.select(doc_id, _padded(cut).alias("doc"))
    return materialise(maybe, "maybe").join(texts, doc_id).where(F.contains("doc", "whole")).select(query_id, doc_id).distinct()


def _no_pairs(questions: DataFrame, docs: DataFrame, query_id: str, doc_id: str) -> DataFrame:
    schema = f"{query_id} {questions.schema[query_id].dataType.simpleString()}, {doc_id} {docs.schema[doc_id].dataType.simpleString()}"
    return questions.sparkSession.createDataFrame([], schema)


def retrieval_quality(hits: DataFrame, truth: DataFrame, k: int, query_id: str = "qid", doc_id: str = "source_file") -> DataFrame:
    """One row: questions, hit_rate, reciprocal_rank and ndcg at ``k`` over the questions that have a true document.

    A document found by several of its chunks counts at its best rank. The ideal order has all true
    documents, at most ``k``, first. A question without hits counts as 0 everywhere.
    """
    wanted = truth.groupBy(query_id).agg(F.count("*").alias("relevant"))
    first = hits.where(F.col("rk") <= k).groupBy(query_id, doc_id).agg(F.min("rk").alias("rk"))
    good = first.join(truth, [query_id, doc_id], "left_semi")
    gains = good.groupBy(query_id).agg(F.min("rk").alias("best"), F.collect_list("rk").alias("ranks"))  # at most k a question
    # sums in the order of the ranks, so that they don't depend on the order of arrival
    gain = F.aggregate(F.array_sort("ranks"), F.lit(0.0), lambda s, r: s + F.lit(1.0) / F.log2(r + 1))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("relevant"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, r: s + F.lit(1.0) / F.log2(r + 1))
    each = wanted.join(gains, query_id, "left").select(
        F.col("best").isNotNull().cast("double").alias("hit"),
        F.coalesce(F.lit(1.0) / F.col("best"), F.lit(0.0)).alias("rr"),
        (F.coalesce(gain, F.lit(0.0)) / ideal).alias("ndcg"),
    )
    return each.agg(
        F.count("*").alias("questions"), F.avg("hit").alias("hit_rate"), F.avg("rr").alias("reciprocal_rank"), F.avg("ndcg").alias("ndcg")
    )
