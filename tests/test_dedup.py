import pytest
from pyspark.sql import functions as F

from siltworks.operators import dedup


def docs(spark, *lines):
    rows = [(i, "\n".join(x) if x is not None else None, i % 2) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard int")


def ids(df):
    return {r["doc_id"]: r["line_ids"] for r in df.collect()}


D0, D1 = ["_Hello", "_World", "I'm so original"], ["_world", "I'm originaler", "_Hello"]


def test_keep_first(spark):
    df = docs(spark, D0, D1)
    out = dedup.rebuild(df, dedup.keep_first_lines(dedup.documents_with_lines(df)))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["line_ids"] == [0, 1, 2] and rows[0]["text"] == "\n".join(D0)
    assert rows[1]["line_ids"] == [1] and rows[1]["text"] == "I'm originaler"
    assert (rows[1]["original_nlines"], rows[1]["nlines"]) == (3, 1)


def test_collected_hashes(spark):
    df = docs(spark, D0, D1)
    assert sorted(r["n_docs"] for r in dedup.collect_hashes(dedup.documents_with_lines(df)).collect()) == [1, 1, 2, 2]


def test_repeats_inside_one_document_are_no_duplicates(spark):
    df = docs(spark, ["a", "a", "b"], ["c"])
    assert ids(dedup.rebuild(df, dedup.two_pass_lines(dedup.documents_with_lines(df)))) == {0: [0, 2], 1: [0]}
    assert ids(dedup.intra_document(df)) == {0: [0, 2], 1: [0]}


def test_from_known_hashes(spark):
    known = dedup.exploded(dedup.documents_with_lines(docs(spark, ["_hello", "i'm originaler"])))
    df = docs(spark, D0, D1)
    assert ids(dedup.rebuild(df, dedup.known_lines_removed(dedup.documents_with_lines(df), known))) == {0: [1, 2], 1: [0]}


def test_scopes_hide_duplicates_from_each_other(spark):
    df = docs(spark, ["x", "1a"], ["x", "2b"], ["x", "c"], ["y"])
    lines = dedup.documents_with_lines(df, keep=("shard",))
    assert ids(dedup.rebuild(df, dedup.two_pass_lines(lines, ("shard",)))) == {0: [1], 1: [0, 1], 2: [1], 3: [0]}
    assert ids(dedup.rebuild(df, dedup.two_pass_lines(dedup.documents_with_lines(df)))) == {0: [1], 1: [1], 2: [1], 3: [0]}


def test_merged_shards_equal_one_pass(spark):
    df = docs(spark, D0, D1, ["_hello", "z"], ["z"])
    lines = dedup.documents_with_lines(df, keep=("shard",))
    merged = dedup.merge_hashes(dedup.collect_hashes(lines, ("shard",)))
    assert sorted(merged.collect()) == sorted(dedup.collect_hashes(dedup.documents_with_lines(df)).collect())


def test_blank_lines_and_empty_documents(spark):
    df = docs(spark, ["a", "", "b", " "], ["c", ""], [], None)
    kept = dedup.two_pass_lines(dedup.documents_with_lines(df))
    assert ids(dedup.rebuild(df, kept)) == {0: [0, 2], 1: [0]}


def test_documents_that_lose_everything(spark):
    df = docs(spark, ["a"], ["a"], ["b"])
    kept = dedup.two_pass_lines(dedup.documents_with_lines(df))
    assert ids(dedup.rebuild(df, kept)) == {2: [0]}
    assert ids(dedup.rebuild(df, kept, keep_empty=True)) == {0: [], 1: [], 2: [0]}


def test_two_pass_is_idempotent(spark):
    df = docs(spark, D0, D1, ["only", "me"])
    once = dedup.rebuild(df, dedup.two_pass_lines(dedup.documents_with_lines(df))).cache()
    twice = dedup.rebuild(once, dedup.two_pass_lines(dedup.documents_with_lines(once)))
    assert {r["doc_id"]: r["text"] for r in once.collect()} == {r["doc_id"]: r["text"] for r in twice.collect()}


def test_rate_grows_with_known_shards(spark):
    df = docs(spark, ["a"], ["a"], ["a", "b"])
    curve = {r["shards"]: r["n_duplicates"] for r in dedup.duplicate_rate(dedup.documents_with_lines(df, keep=("shard",)), "shard", [0, 1, 2]).collect()}
    assert curve == {0: 0, 1: 3, 2: 3}


def test_empty_table(spark):
    df = docs(spark).limit(0)
    assert dedup.rebuild(df, dedup.two_pass_lines(dedup.documents_with_lines(df))).count() == 0


@pytest.mark.parametrize("step", ["line_ids", "nlines"])
def test_clashing_columns_are_not_in_the_way(spark, step):
    df = docs(spark, D0).withColumn(step, F.lit("mine")).withColumn("hash", F.lit(1))
    out = dedup.rebuild(df, dedup.two_pass_lines(dedup.documents_with_lines(df)))
    assert out.first()["line_ids"] == [0, 1, 2]
