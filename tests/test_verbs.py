import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks.functions import pieces
from siltworks.operators import buckets, describe, lid, lm, metadata, tags, verbs
from siltworks.plans.cli import stages
from siltworks.plans.config import PRESETS, Config
from siltworks.sources import readers, sinks


def test_select_prints_none_and_missing_fields(spark):
    df = spark.createDataFrame([(1, None), (2, "b\nc")], "x int, y string")
    assert [r[0] for r in verbs.select(df, ["x", "y", "gone"]).collect()] == ["1\tNone\t", "2\tb\nc\t"]
    assert [r[0] for r in verbs.select(df, ["y"], skip_empty=True, newline=" N ").collect()] == ["b N c"]
    assert verbs.select(df, ["*"]).count() == 2


def test_where_is_a_conjunction_and_null_is_false(spark):
    df = spark.createDataFrame([(1, "aa"), (2, None), (3, "bbb")], "x int, y string")
    assert [r["x"] for r in verbs.where(df, ["length({y}) > 1", "{x} > 1"]).collect()] == [3]


def test_merge_types(spark):
    df = spark.createDataFrame([("7\t1.5\ttrue\tx",), ("z\t\tfalse",)], "line string")
    rows = [tuple(r) for r in verbs.merge(df, ["a%i", "b%f", "c%b", "d"]).collect()]
    assert rows == [(7, 1.5, True, "x"), (None, None, False, None)]
    assert verbs.merge(spark.createDataFrame([('{"k":"v"}',)], "line string"), ["_"]).first()[0] == {"k": "v"}


def test_filters(spark):
    df = spark.createDataFrame([("en", "head", "abc"), (None, None, ""), ("fr", "tail", None)], "language string, bucket string, t string")
    assert verbs.keep_lang(df, whitelist=("fr",)).count() == 1
    assert {r["language"] for r in verbs.keep_lang(df, whitelist=("fr",), blacklist=("fr",)).collect()} == {"en", None}
    assert verbs.keep_lang(df).count() == 3
    assert verbs.keep_bucket(df, ("all", "tail")).count() == 2
    assert verbs.remove_small(df, "t", 0).count() == 1


def test_split(spark):
    df = spark.createDataFrame([("a", "en"), ("b", "fr"), ("c", "en"), ("d", None), ("e", "")], "text string, lang string")
    assert {tuple(r) for r in verbs.split_counts(df, "out_{lang}").collect()} == {("out_en", 2), ("out_fr", 1)}
    with pytest.raises(KeyError):
        verbs.split_counts(df, "{language}")


@pytest.mark.parametrize(
    ("values", "bins", "expected"),
    [([0.1] * 4 + [0.4] * 2 + [0.9] * 2, 8, [4, 0, 0, 2, 0, 0, 0, 2]), ([0] + [0.1] * 4 + [0.4] * 2 + [0.8] * 2 + [1], 10, [1, 4, 0, 0, 2, 0, 0, 0, 2, 1])],
)
def test_histogram(spark, values, bins, expected):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    found = {r["bin"]: r["n"] for r in describe.histogram(df, "v", bins).collect()}
    assert [found[i] for i in range(bins)] == expected
    upto = describe.cumulative(describe.histogram(df, "v", bins)).orderBy("bin").collect()
    assert upto[-1]["upto"] == len(values)
    assert len(describe.bar_chart(expected).split("\n")) == bins


def test_describe(spark):
    df = spark.createDataFrame([("aaaaa", None)] * 8, "title string, text string")
    found = {r["field"]: tuple(r) for r in describe.presence(df, ["title", "text"]).collect()}
    assert found["title"] == ("title", 8, 8, 5.0) and found["text"] == ("text", 8, 0, None)
    assert [tuple(r) for r in describe.label_counts(df, "title").collect()] == [("aaaaa", 8)]
    assert (describe.parse_bins("5"), describe.parse_bins("1,2"), describe.parse_bins("auto")) == (5, [1.0, 2.0], "auto")


FULL = "url string, digest string, cc_segment string, raw_content string, language string, language_score double, perplexity double, bucket string, line_ids array<int>"


def test_minify_and_fetch(spark):
    full = spark.createDataFrame([("u1", "sha1:A", "s", "a\nb\nc", "en", 0.987, 12.345, "head", [0, 2]), ("u2", "sha1:B", "s", "x", "en", 0.5, None, "all", [0, 9])], FULL)
    small = metadata.minify(full)
    assert {r["digest"]: (r["language_score"], r["perplexity"], r["line_ids"]) for r in small.collect()}["sha1:A"] == (0.99, 12.3, "AAACAA==")
    docs = full.select("url", "digest", "cc_segment", "raw_content").union(spark.createDataFrame([("u9", "sha1:A", "s", "a\nb\nc"), ("u9", None, "s", "q")], "url string, digest string, cc_segment string, raw_content string"))
    back = {r["digest"]: r for r in metadata.fetch_metadata(docs, small.union(small), ["perplexity"]).collect()}
    assert set(back) == {"sha1:A", "sha1:B"}
    assert (back["sha1:A"]["raw_content"], back["sha1:A"]["nlines"], back["sha1:A"]["original_nlines"]) == ("a\nc", 2, 3)
    assert back["sha1:B"]["raw_content"] == "x"
    assert metadata.fetch_metadata(docs, small, ["perplexity"], once=False).count() == 3


def test_paragraphs_skip_ids_out_of_range(spark):
    docs = spark.createDataFrame([("s", "d", "a\nb")], "cc_segment string, digest string, raw_content string")
    meta = spark.createDataFrame([("s", "d", [1, 5], ["en_XX", "fr_XX"], [-1.0, -2.0])], "cc_segment string, digest string, line_ids array<int>, languages array<string>, lm_scores array<double>")
    found = metadata.paragraphs(docs, meta)
    assert [tuple(r) for r in found.collect()] == [("s", "d", "en_XX", "b", -1.0)]
    assert metadata.snapshot_filter(found, "2018-34", "2018-51").count() == 0
    assert metadata.snapshot_filter(found, "2018-51", "2018-51").count() == 1
    assert metadata.snapshot_filter(found, "2018-51", "2018-51", compat=True).count() == 0


def test_buckets(spark):
    cut = spark.createDataFrame([(30, 340.0, None), (60, 520.0, None), (10, 1.0, 1.0)], "pct int, en double, zh double")
    rows = [(339.9, "en", "head"), (340.0, "en", "middle"), (520.0, "en", "tail"), (None, "en", "all"), (-1.0, "en", "all"), (float("nan"), "en", "all"), (5.0, "zh", "all"), (5.0, None, "all")]
    df = spark.createDataFrame(rows, "perplexity double, language string, expected string")
    assert buckets.perplexity_bucket(df, cut).filter("bucket <> expected").count() == 0


def test_languages(spark):
    rows = [(i, "the garden of the house and the river", "en") for i in range(4)] + [(i + 4, "der garten und das haus an dem fluss", "de") for i in range(4)] + [(8, "", "en"), (9, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = lid.train(df)
    scored = lid.scores(df, model)
    best = {r["doc"]: r["lang"] for r in lid.classify(df, model).collect()}
    assert best == {i: "en" if i < 4 else "de" for i in range(8)}
    assert lid.classify(df, model, k=5).count() == 16 and scored.count() == 16
    votes = spark.createDataFrame([(1, "en", 0.9, 3), (1, "de", 0.6, 10)], "doc int, lang string, score double, length int")
    assert lid.length_weighted(votes).first()["lang"] == "de"


def test_language_model(spark):
    df = spark.createDataFrame([(1, "a a b", "en"), (2, "a zz", "en"), (3, "a", "xx"), (4, None, "en")], "doc_id bigint, text string, lang string")
    vocab = lm.vocabulary(df.filter("doc_id = 1"))
    pp = {r["doc"]: r["perplexity"] for r in lm.unigram_perplexity(df, lm.unigram_model(vocab)).collect()}
    # counts a 2, b 1, total 3 + 2 + 1; document 1 has three words and one end of sentence
    assert pp[1] == round((3 / 6 * 3 / 6 * 2 / 6) ** -0.25, 1)
    assert pp[2] == round((3 / 6 * 1 / 6) ** (-1 / 3), 1)
    assert pp[3] is None and pp[4] is None
    two = {r["doc"]: r["perplexity"] for r in lm.bigram_perplexity(df, vocab, least=1).collect()}
    assert set(two) == {1, 2, 3, 4} and two[1] and two[2] and two[3] is None and two[4] is None


def test_ngram_model_sums_to_one_and_backs_off(spark, tmp_path):
    text = "a b a b c a b a".split()
    df = spark.createDataFrame([(1, text, "en"), (2, ["b", "a", "c"], "en"), (3, ["a", "zz", "a", "b"], "en"), (4, ["a"], "xx"), (5, None, "en")], "doc_id bigint, w array<string>, lang string")
    model = lm.NgramModel.train(lm.places(df.filter("doc_id = 1"), F.col("w"), order=3), order=3)
    model.save(str(tmp_path / "model"))
    model = lm.NgramModel.load(spark, str(tmp_path / "model"), 3)
    pp = {r["doc"]: r["perplexity"] for r in lm.ngram_perplexity(df, model, F.col("w")).collect()}

    tokens, d = ["<s>", *text, "</s>"], 0.75
    grams = {k: Counter(tuple(tokens[i - k + 1 : i + 1]) for i in range(1, len(tokens)) if i - k + 1 >= 0) for k in (1, 2, 3)}

    def p(gram):
        if not gram:
            return 1 / (len(grams[1]) + 1)
        own = {g: n for g, n in grams[len(gram)].items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        c = sum(own.values())
        return max(own.get(gram, 0) - d, 0) / c + d * len(own) / c * p(gram[1:])

    vocabulary = [g[0] for g in grams[1]] + ["other"]
    for context in ((), ("a",), ("a", "b"), ("zz",)):
        assert abs(sum(p((*context, w)) for w in vocabulary) - 1) < 1e-9
    for doc, words in ((1, text), (2, ["b", "a", "c"]), (3, ["a", "zz", "a", "b"])):
        x = ["<s>", *words, "</s>"]
        logs = sum(math.log10(p(tuple(x[max(0, i - 2) : i + 1]))) for i in range(1, len(x)))
        assert pp[doc] == pytest.approx(10 ** (-logs / (len(words) + 1)), abs=0.051)
    assert set(pp) == {1, 2, 3}


def test_pieces_by_language(spark):
    model = "/opt/tokenizers/piece_bpe_32k.model"
    df = spark.createDataFrame([(1, "en", "The old house."), (2, "de", "Das alte Haus"), (3, None, "x"), (4, "en", None), (5, "en", "")], "doc_id int, language string, raw_content string")
    out = {r["doc_id"]: r["tokenized"] for r in pieces.tokenize(df, {"en": model}).collect()}
    assert out[1].split(" ")[0] == "▁the" and out[2] is None and out[3] is None and out[4] is None and out[5] == ""
    every = {r["doc_id"]: r["tokenized"] for r in pieces.tokenize(df, {"en": model, "*": model}, plain=False).collect()}
    assert every[2] and every[3] == "▁x" and every[1].startswith("▁The")


def test_language_restriction(spark):
    rows = [("the garden of the house and the river", "en")] * 3 + [("der garten und das haus an dem fluss", "de")] * 3
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)] + [(9, "", "de"), (10, "12", None)], "doc_id bigint, text string, lang string")
    out = {r["doc_id"]: (r["language"], r["language_score"]) for r in lid.with_language(df.withColumn("language", F.col("lang")), lid.train(df), "text", 0.5, "de").collect()}
    assert out[0] == ("en", None) and out[4] == ("de", 1.0) and 9 not in out and 10 not in out


def test_sampling_by_perplexity(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 1200).cast("double").alias("perplexity"))
    out = lm.sample_by_perplexity(df, "id", samples=2)
    steps = {r["step"]: r["count"] for r in out.groupBy("step").count().collect()}
    assert steps[0.0] == 2 and steps[100.0] == 3 and max(steps) <= 1000 and out.count() == 21


def test_sentences(spark):
    df = spark.createDataFrame([("Hi there. Ok! Hi there.", "en"), (None, "en")], "text string, lang string")
    assert {r["sentence"] for r in lm.sentences(df).collect()} == {"Hi there.", "Ok!"}


def test_tags(spark):
    rows = spark.createDataFrame([("h", "a", 1), ("h", "b", 1), ("h", "a", 2), ("u://h/x", "c", 1)], "key string, tag string, source int")
    pairs = tags.intersect_tags(rows)
    assert {tuple(r) for r in pairs.collect()} == {("h", "a"), ("u://h/x", "c")}
    docs = spark.createDataFrame([("u://h/x", "T\nT" * 99), ("u://h/y", "T" * 300), ("u://g/y", "T" * 300), ("u://h/z", "T")], "url string, raw_content string")
    lines = {r["url"]: r["line"] for r in tags.labelled_lines(docs, tags.tag_map(pairs)).collect()}
    assert set(lines) == {"u://h/x", "u://h/y"}
    assert lines["u://h/x"].startswith("__label__c t t") and lines["u://h/y"].startswith("__label__a ttt")


WET = """WARC/1.0
WARC-Type: warcinfo
Content-Length: 3

x: y

WARC/1.0
WARC-Type: conversion
WARC-Target-URI: http://sample_x.example/a
WARC-Date: 2019-03-18T00:00:00Z
WARC-Block-Digest: sha1:ABC
Content-Length: 35

A title
First line about WARC/1.0? no.

Last line.


WARC/1.0
WARC-Type: conversion
WARC-Target-URI: http://b.example/
WARC-Date: 2019-03-18T00:00:01Z
WARC-Block-Digest: sha1:DEF
Content-Length: 6

only


"""


def test_wet(spark, tmp_path):
    path = tmp_path / "a.warc.wet"
    path.write_text(WET)
    rows = readers.read_wet(spark, str(path), 1).collect()
    assert [(r["url"], r["title"], r["nlines"], r["length"], r["source_domain"], r["digest"]) for r in rows] == [("http://sample_x.example/a", "A title", 3, 35, "sample_x.example", "sha1:ABC")]
    assert rows[0]["raw_content"] == "First line about WARC/1.0? no.\n\nLast line." and rows[0]["cc_segment"].endswith("a.warc.wet")
    assert readers.read_wet(spark, str(path), 0).count() == 2


def test_json_lines(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"url": "u", "nlines": 2}\nnot json\n\n{"url": "v"}\n')
    assert sorted(r["url"] for r in readers.read_jsonl(spark, str(path)).collect()) == ["u", "v"]
    assert readers.bad_lines(spark, str(path)).count() == 1
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        readers.read_jsonl(spark, str(path), strict=True).collect()


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(i, ["en", "fr", None][i % 3], "head") for i in range(9)], "id int, language string, bucket string")
    sinks.write_split(df, str(tmp_path / "split"))
    assert sorted(p.name for p in (tmp_path / "split").glob("split=*")) == ["split=en_head", "split=fr_head"]
    sinks.write_sharded(df, str(tmp_path / "shards"), 3)
    sinks.regroup(spark, str(tmp_path / "shards"), str(tmp_path / "one"), 1, ["id"])
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    back = spark.read.json(str(tmp_path / "one"))
    assert [r["id"] for r in back.collect()] == list(range(9))
    assert sinks.checksum(back, ["id"]).first() == sinks.checksum(df.orderBy(F.desc("id")), ["id"]).first()
    sinks.write_sized(df, str(tmp_path / "sized"), 5000, "2K", "none")
    assert len(list((tmp_path / "sized").glob("part-*"))) == 3


def test_sizes_and_groups(spark):
    assert sinks.parse_size("4G") == 4 << 30 and sinks.parse_size("1k") == 1024
    with pytest.raises(ValueError, match="size"):
        sinks.parse_size("x")
    files = spark.createDataFrame([("p", f"f{i}", 10) for i in range(5)], "prefix string, name string, size bigint")
    rows = sinks.size_groups(files, 25).orderBy("name").collect()
    assert [r["grp"] for r in rows] == [0, 0, 1, 1, 2] and [r["offset"] for r in rows] == [0, 10, 0, 10, 0]


def test_shards_of_a_manifest():
    names = [str(i) for i in range(10)]
    assert sum((readers.shard_segments(names, k, 4) for k in range(4)), []) == names
    assert readers.shard_segments(names, 0, 2, 3) == ["0", "1", "2"]
    with pytest.raises(ValueError, match="range"):
        readers.shard_segments(names, 4, 4)
    assert readers.dump_names("x CC-MAIN-2019-09 y CC-MAIN-2018-51 CC-MAIN-2019-09") == ["2018-51", "2019-09"]


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('// note\n{"dump": "2019-09", "lang_whitelist": ["fr"], "execution": "local"}')
    conf = Config.from_json(path)
    assert conf.dump == "2019-09" and not conf.wants_model("de") and conf.wants_model("fr")
    assert conf.folder("split") == "data/mined.split/2019-09" and conf.folder() == "data/mined/2019-09"
    assert stages(["a", "--", "b", "c"]) == [["a"], ["b", "c"]]


def test_pipeline_runs_every_step(spark):
    from siltworks.plans.pipeline import Pipeline

    rows = [(i, "\n".join([f"the garden number {i} of the old house", "same line for all of them", f"a river {i} and the sea"] * 4), 0) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, raw_content string, shard int")
    model = docs.withColumn("lang", F.lit("en")).withColumn("text", F.col("raw_content"))
    cut = spark.createDataFrame([(30, 1.0), (60, 1e9)], "pct int, en double")
    run = Pipeline(Config(min_len=10), lid.train(model), lm.unigram_model(lm.vocabulary(model)), cut)
    out = run.run(docs).collect()
    # digits are 0 for comparing, so all lines are duplicates of another document's
    assert out == []
    unique = docs.withColumn("raw_content", F.concat("raw_content", F.lit("\nunique "), F.element_at(F.array(*map(F.lit, ["a", "b", "c", "d", "e", "f"])), (F.col("doc_id") + 1).cast("int"))))
    out = run.run(unique).collect()
    assert {r["bucket"] for r in out} == {"middle"} and {r["nlines"] for r in out} == {1}


def test_stream_keeps_the_first(spark, tmp_path):
    from siltworks.streaming.keep_first import keep_first_lines

    spark.sql("select timestamp'2024-01-01 00:00:00' t, 'a\nb' raw_content union all select timestamp'2024-01-01 00:10:00', 'A\nc'").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, raw_content string").parquet(str(tmp_path / "in"))
    q = keep_first_lines(stream, "t").writeStream.format("memory").queryName("first").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("first").count() == 3


def test_pipeline_fetches_the_last_version(spark):
    from siltworks.plans.config import Config
    from siltworks.plans.pipeline import Pipeline

    docs = spark.createDataFrame([(k, "s", f"d{k}", "a\nb") for k in range(20)], "doc_id bigint, cc_segment string, digest string, raw_content string")
    versions = [("s", f"d{k}", "AAA=", bucket, at) for k in range(20) for bucket, at in ([("old", 1), ("new", 2)] if k % 2 else [("new", 2), ("old", 1)])]
    meta = spark.createDataFrame(versions, "cc_segment string, digest string, line_ids string, bucket string, written_at int")
    step = dict(Pipeline(Config(pipeline=["fetch_metadata"]), meta=meta).steps())["fetch_metadata"]
    assert [(r["bucket"], r["raw_content"]) for r in step(docs).collect()] == [("new", "a")] * 20
