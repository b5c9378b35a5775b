"""Tables that operators store on the way, and which of them are left."""

import os

import pytest
from conftest import frame, prose
from pyspark.sql import functions as F

from qualitymart.llm import decontaminate, jaccard_join, lexical_search, repeated_spans
from qualitymart.llm.common import only_last, stored
from qualitymart.session import shared_folder


@pytest.fixture
def new_tables(spark):
    """Names of the tables stored since the test began."""
    folder = f"{shared_folder(spark).removeprefix('file://')}/llm"
    names = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = names()
    return lambda: sorted(n.rsplit("-", 1)[0] for n in names() - before)


def test_only_the_last_table_is_left(spark, new_tables):
    def inner():
        stored(spark.range(2), "first")
        return stored(spark.range(4), "second").where("id > 0")

    def outer():
        twice = only_last(spark, inner)
        assert new_tables() == ["second"]
        return stored(twice.withColumn("more", F.lit(1)), "third")

    assert only_last(spark, outer).count() == 3
    assert new_tables() == ["third"]
    stored(spark.range(1), "outside")
    assert new_tables() == ["outside", "third"]


def test_a_step_that_fails_leaves_nothing(spark, new_tables):
    def inner():
        return stored(spark.range(2), "kept-by-the-inner-step")

    def step():
        only_last(spark, inner)
        stored(spark.range(2), "first")
        return stored(spark.range(1).select(F.raise_error(F.lit("no"))), "second")

    with pytest.raises(Exception, match="no"):
        only_last(spark, step)
    assert new_tables() == []


@pytest.mark.parametrize(
    ("operator", "left"),
    [
        (lambda docs, items: jaccard_join.near_duplicates(docs), {"classes"}),
        (lambda docs, items: jaccard_join.one_of_each(docs), {"duplicates", "ids-of-several-texts", "repeated-ids"}),
        (lambda docs, items: decontaminate.remove_contaminated(docs, items), {"contaminated"}),
        (lambda docs, items: lexical_search.search(docs, items), {"best"}),
        (lambda docs, items: repeated_spans.remove_repeats(docs), {"removals", "repeated-ids"}),
    ],
    ids=["near_duplicates", "one_of_each", "remove_contaminated", "search", "remove_repeats"],
)
def test_operators_leave_what_their_result_reads(spark, new_tables, operator, left):
    texts = [prose(k, 60) for k in range(6)]
    docs = frame(spark, [*enumerate(texts), (6, texts[0] + " and more"), (7, texts[1])])
    items = docs.where("doc_id < 2").select(F.col("doc_id").alias("item_id"), "text")
    found = operator(docs, items)
    assert set(new_tables()) == left
    assert found.count() > 0
