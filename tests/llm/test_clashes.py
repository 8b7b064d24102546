"""Result names that the table has already are lengthened; the table's own columns stay as they are."""

import pytest
from pyspark.sql import functions as F

from showroom.llm import decontaminate, line_dedup, mixing, quality, url_filter
from showroom.llm.shared import fresh, hash_sample

WORDS = "one two three four five six seven eight nine ten"


def marked(docs, make):
    items = make([("i", WORDS), ("j", "short item")], "item_id string, text string")
    return decontaminate.mark(docs, items, block_words=5)  # two blocks: a pass reads what the one before it marked


CASES = {
    "contamination": (marked, lambda c: c["n_hit"]),
    "lines": (lambda d, make: line_dedup.without_boilerplate(d), lambda c: c["n_lines"]),
    "mix": (lambda d, make: mixing.mix(d), lambda c: c["size"]),
    "quality": (lambda d, make: quality.judge(d, make([(1, 1), (2, 0)], "doc_id bigint, quality int")), lambda c: c["kept"]),
    "url_verdict": (lambda d, make: url_filter.judge(d, [url_filter.Rule("allow", "org", "/")], url="text"), lambda c: c["verdict"]),
}


@pytest.mark.parametrize("name", CASES)
def test_own_column_of_the_name_stays(make, name):
    run, field = CASES[name]
    rows = [(1, f"a {WORDS} b", "s", "en"), (2, "plain words", "t", "fr"), (3, None, None, None)]
    docs = make(rows, "doc_id bigint, text string, source string, lang string")
    want = {r["doc_id"]: r["found"] for r in run(docs, make).select("doc_id", field(F.col(name)).alias("found")).collect()}
    own = docs.withColumn(name.upper(), F.col("doc_id") * 10)
    out = run(own, make)
    assert out.columns == [*own.columns, name + "_"]
    got = out.select("doc_id", F.col(name.upper()).alias("own"), field(F.col(name + "_")).alias("found")).collect()
    assert {r["doc_id"]: r["own"] for r in got} == {1: 10, 2: 20, 3: 30}
    assert {r["doc_id"]: r["found"] for r in got} == want


def test_fresh_names():
    assert fresh(["A", "b"], "c") == "c" and fresh(["Mix", "mix_"], "mix") == "mix__"


def test_samples_keep_their_size(spark):
    """The bound holds whatever the number of rows; a limit of whole 2^-20 parts would not."""
    numbers = spark.range(200_000)
    assert 60 < hash_sample(numbers, F.col("id"), 100).count() < 150
    assert hash_sample(numbers, F.col("id"), 300_000).count() == 200_000
    one = hash_sample(numbers, F.col("id"), 1000).collect()
    assert 850 < len(one) < 1150 and sorted(one) == sorted(hash_sample(numbers.repartition(7), F.col("id"), 1000).collect())
