"""Operators on workers that cannot import the package."""

from tests.test_text import without_package


def test_workers_need_no_copy_of_the_package(tmp_path):
    without_package(tmp_path, """
from tidemark.llm import decontamination, extraction, lexical, neighbours, periodic
from pyspark.sql import functions as F
text = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id bigint, text string")
items = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
assert decontamination.contamination(text, items).filter("contaminated").count() == 1
assert lexical.search(text, items).count() == 1
assert text.select(periodic.periodic_runs(F.col("text")).alias("f")).filter("size(f.runs) = 0").count() == 2
page = spark.createDataFrame([(1, "http://a/b", "<div class='menu'>x</div><article><p>y</p></article>")],
                             "page_id bigint, url string, html string")
assert extraction.extract(page).first().text == "y"
v = spark.createDataFrame([(1, [1.0, 0.0]), (50, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
assert neighbours.search(v, v).count() == 2
""")
