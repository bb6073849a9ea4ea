"""Building and querying a section index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import retrieval as rt
from tidemark.operators import vectors as vec
from tidemark.sources import readers, sinks


def build_index(documents: DataFrame, root: str, encoder=None) -> int:
    """Write sections and their vectors as two tables; returns the number of vectors.

    Vectors are hashed unless an encoder is given. The text is stored once and never
    shuffled; search reads the vectors and fetches the text of the winners.
    """
    cut = rt.sections(documents)
    sinks.write_table(cut, f"{root}/sections")
    stored = documents.sparkSession.read.schema(cut.schema).parquet(f"{root}/sections")
    text = vec.index_text(stored)
    if encoder is None:
        vectors = vec.hash_embed(text, rt.SECTION_KEY)
    else:
        vectors = vec.encode_texts(text.select(*rt.SECTION_KEY, "text"), "text", encoder).drop("text")
    return sinks.write_index(vectors, f"{root}/vectors")


def search(spark: SparkSession, questions: Sequence[str] | DataFrame, root: str, k: int = 3, encoder=None) -> DataFrame:
    """Top ``k`` sections per question by cosine similarity, with their text."""
    asked = rt.as_questions(spark, questions).withColumnRenamed("question", "text")
    if encoder is None:
        queries = vec.hash_embed(asked, ["question_id"])
    else:
        queries = vec.encode_texts(asked, "text", encoder)
    queries = queries.withColumnRenamed("embedding", "vector")
    found = vec.cosine_topk(readers.vector_table(spark, f"{root}/vectors"), queries, k, rt.SECTION_KEY)
    # the winners of one block of questions are small, those of a large table are not: the join is left to the planner
    stored = spark.read.parquet(f"{root}/sections")
    return stored.join(found, list(rt.SECTION_KEY)).select(
        "question_id", "rank", "similarity", *rt.SECTION_KEY, "path", "section", "title", "content"
    )


def answer(
    spark: SparkSession, questions: Sequence[str] | DataFrame, documents: DataFrame, k: int = 3, index: str | None = None,
    rules: Sequence[rt.TopicRule] = (), encoder=None,
) -> DataFrame:
    """Answers from token overlap, or from the vector index where one is given."""
    if index is None:
        matches = rt.overlap_topk(rt.sections(documents), questions, k)
    else:
        matches = search(spark, questions, index, k, encoder)
    tools = rt.observations(documents, rules) if rules else None
    return rt.answers(spark, questions, matches, tools, rules)
