import glob
import gzip
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltworks.functions.text import tokenize_documents
from siltworks.operators import dedup, describe, lid, verbs
from siltworks.plans import cli, jobs
from siltworks.plans.config import PRESETS, Config
from siltworks.sources import readers, sinks

WORDS = {
    "en": ["the garden", "an old house", "a river", "some bread", "the market", "a letter"],
    "fr": ["le jardin", "une vieille maison", "la rivière", "du pain", "le marché", "une lettre"],
}


def record(url, title, lines):
    body = "\n".join([title, *lines])
    return f"WARC/1.0\nWARC-Type: conversion\nWARC-Target-URI: {url}\nWARC-Date: 2019-02-15T00:00:00Z\nWARC-Block-Digest: sha1:{abs(hash(url)):032d}\nContent-Length: {len(body)}\n\n{body}\n\n\n"


def text(lang, k, n=8):
    pool = WORDS[lang]
    join = " and " if lang == "en" else " et "
    return [pool[(k + i) % 6] + join + pool[(k * i + 1) % 6] + " " + "".join("abcdefghij"[int(c)] for c in f"{k:03}{i:03}") for i in range(n)]


@pytest.fixture
def archive(tmp_path):
    """Four WET files, two of them gzip, with a line that all pages share, and a manifest."""
    names = []
    for s in range(4):
        data = "WARC/1.0\nWARC-Type: warcinfo\n\nsoftware\n\n\n"
        for k in range(6):
            lang = "en" if k % 2 else "fr"
            data += record(f"http://site{s}.example/{k}", f"Title {s} {k}", ["Share this page with your friends", *text(lang, s * 6 + k)])
        name = f"crawl/part-{s:05}.warc.wet" + (".gz" if s % 2 else "")
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(gzip.compress(data.encode()) if s % 2 else data.encode())
        names.append(name)
    (tmp_path / "wet.paths").write_text("\n".join(names) + "\n")
    train = [{"language": lang, "raw_content": "\n".join(text(lang, k))} for lang in WORDS for k in range(30)]
    (tmp_path / "train.json").write_text("\n".join(map(json.dumps, train)))
    (tmp_path / "cut.csv").write_text("pct,en,fr\n30,5.0,1.0\n60,1000000.0,2.0\n")
    settings = {"output_dir": str(tmp_path / "out"), "dump": "d", "num_shards": 2, "hash_in_mem": 0, "min_len": 50, "cutoff": str(tmp_path / "cut.csv"), "target_size": "1M"}
    (tmp_path / "settings.json").write_text("// a comment\n" + json.dumps(settings))
    return tmp_path


def lines_of(pattern):
    return [json.loads(x) for f in sorted(glob.glob(pattern)) for x in gzip.open(f, "rt")]


def test_mine_from_archives_to_regrouped_files(spark, archive):
    common = ["--config", str(archive / "settings.json"), "--manifest", str(archive / "wet.paths"), "--root", str(archive)]
    cli.main(["hashes", *common])
    saved = {r["shard"]: r["n"] for r in spark.read.parquet(str(archive / "out/mined.hashes/d")).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert set(saved) == {0, 1}
    cli.main(["hashes", *common])  # nothing is left to do
    assert spark.read.parquet(str(archive / "out/mined.hashes/d")).count() == sum(saved.values())
    cli.main(["mine", *common, "--train", str(archive / "train.json")])
    cli.main(["regroup", "--config", str(archive / "settings.json")])
    found = sorted(f.rsplit("/", 1)[-1] for f in glob.glob(str(archive / "out/mined/d/*.json.gz")))
    assert found == ["en_middle_0000.json.gz", "fr_tail_0000.json.gz"]
    docs = lines_of(str(archive / "out/mined/d/*.json.gz"))
    assert len(docs) == 24 and {d["language"] for d in docs} == {"en", "fr"} and not any("Share this" in d["raw_content"] for d in docs)
    assert all(d["nlines"] == 8 and d["original_nlines"] == 9 and d["line_ids"] == list(range(1, 9)) and "tokenized" not in d for d in docs)
    assert {d["cc_segment"] for d in docs} == {f"crawl/part-{s:05}.warc.wet" + (".gz" if s % 2 else "") for s in range(4)}
    assert not glob.glob(str(archive / "out/mined.split/d/*"))  # cleaned up


def test_minify_and_fetch_come_back_to_the_mined_text(spark, archive):
    config = Config.from_json(archive / "settings.json")
    docs = jobs.documents(spark, config, str(archive / "wet.paths"), str(archive))
    models = jobs.train(spark, config, readers.read_jsonl(spark, str(archive / "train.json"), None), 3, {"*": "/opt/tokenizers/piece_bpe_32k.model"})
    counters = jobs.mine(spark, config, docs, models)
    assert counters["dedup"]["docs"] == 24 and counters["pp_bucket"]["docs"] == 24 and counters["dedup"]["chars"] > 0
    assert jobs.mine(spark, config, docs, models) == {}
    mined = spark.read.json(config.folder("split"))
    assert mined.filter("perplexity is null or perplexity <= 1").count() == 0
    jobs.minify(spark, config.folder("split"), str(archive / "mini"))
    moved = sinks.move_segments(spark, str(archive / "mini"), str(archive / "moved"))
    assert len(moved) == 4 and all("part-" in f for f in moved) and sinks.move_segments(spark, str(archive / "mini"), str(archive / "moved")) == []
    jobs.fetch(spark, docs, str(archive / "moved"), str(archive / "fetched"))
    back = {r["url"]: r for r in spark.read.json(str(archive / "fetched")).collect()}
    for r in mined.collect():
        other = back[r["url"]]
        assert (other["raw_content"], other["bucket"], other["language"], other["nlines"]) == (r["raw_content"], r["bucket"], r["language"], r["nlines"])


def test_one_shard_and_paragraphs(spark, archive):
    config = Config.from_json(archive / "settings.json")
    jobs.export_shard(spark, config, str(archive / "wet.paths"), 1, str(archive / "shard"), str(archive))
    shard = spark.read.json(str(archive / "shard"))
    assert shard.count() == 12 and {r[0] for r in shard.select("cc_segment").distinct().collect()} == {"crawl/part-00002.warc.wet", "crawl/part-00003.warc.wet.gz"}
    one = shard.orderBy("url").first()
    meta = {"cc_segment": one["cc_segment"], "digest": one["digest"], "url": one["url"], "line_ids": [1, 99], "languages": ["fr_XX", "fr_XX"], "lm_scores": [0.5, 0.1]}
    (archive / "meta.json").write_text(json.dumps(meta) + "\n" + json.dumps(meta | {"languages": ["la_VA", "la_VA"]}))
    jobs.paragraphs(spark, shard, str(archive / "meta.json"), str(archive / "text"), "2018-05", "2018-51")
    found = spark.read.text(str(archive / "text"))
    assert [(r["value"], r["language"]) for r in found.collect()] == [(one["raw_content"].split("\n")[1], "la_VA")]
    with pytest.raises(ValueError):
        readers.read_shards(spark, ["a/x.wet", "b/x.wet"], 1)


def test_opening_texts(spark, tmp_path):
    (tmp_path / "dump.json").write_text("\n".join(json.dumps(x) for x in [{"opening_text": " Été 2019 "}, {"opening_text": ""}, {"title": "x"}]))
    jobs.opening(spark, str(tmp_path / "dump.json"), str(tmp_path / "out"), 5)
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["été 0000"]


def test_saved_hashes_merge(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", 0), (2, "b\nc", 0), (3, "c\nd", 1)], "doc_id bigint, text string, shard int")
    lines = dedup.documents_with_lines(df, keep=("shard",))
    for k in (0, 1):
        dedup.save_hashes(dedup.collect_hashes(lines.filter(F.col("shard") == k)), str(tmp_path / f"h{k}"))
    merged = dedup.load_hashes(spark, str(tmp_path / "h0"), str(tmp_path / "h1"))
    assert sorted(merged.collect()) == sorted(dedup.collect_hashes(lines).collect())


def test_numbered_files_and_dumps(spark, tmp_path):
    df = spark.range(1000).withColumn("text", F.lit("x" * 50))
    names = sinks.write_numbered(df, str(tmp_path / "a_???.json.gz"), "20K")
    assert names == [str(tmp_path / f"a_{i:03}.json.gz") for i in range(len(names))] and 3 <= len(names) <= 5
    assert sorted(d["id"] for d in lines_of(str(tmp_path / "a_*.json.gz"))) == list(range(1000))
    with pytest.raises(ValueError):
        sinks.write_numbered(df, str(tmp_path / "b.json"))
    sinks.dump_perplexities(spark.createDataFrame([(1.5,), (None,)], "perplexity double"), str(tmp_path / "pp"))
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "pp")).collect()] == [1.5]
    sinks.dump_line_hashes(spark.createDataFrame([("a\na",)], "raw_content string"), str(tmp_path / "h"))
    assert spark.read.parquet(str(tmp_path / "h")).count() == 2


def test_counted_reader(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"url": "a", "nlines": 2}\n\nnot json\n{"url": "b"}\n')
    df, seen = readers.read_jsonl_counted(spark, str(tmp_path / "x.json"))
    assert {(r["url"], r["nlines"]) for r in df.collect()} == {("a", 2), ("b", None)}
    assert seen.get == {"lines": 4, "empty": 1, "bad": 1}


def test_describe_verb(spark):
    rows = [("en", 1, [1.0, 5.0], {"a": 1}), ("en", 2, [2.0], {"a": 1, "b": 2}), ("de", 4, [], None), ("en", 8, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "lang string, n int, list array<double>, m map<string,int>")
    out = describe.describe(df, bins=[1.0, 3.0, 8.0], weights="n")
    got = {(r["field"], r["kind"], r["label"], r["low"], r["high"]): r["n"] for r in out.collect()}
    assert got["lang", "present", None, None, None] == 4 and got["lang", "length", None, None, None] == 2
    assert got["lang", "label", "en", None, None] == 3 and ("lang", "label", "de", None, None) not in got
    assert got["m", "label", "a", None, None] == 2 and got["m", "label", "b", None, None] == 1
    assert (got["n", "bin", None, 1.0, 3.0], got["n", "bin", None, 3.0, 8.0]) == (3, 12)
    assert (got["list", "bin", None, 1.0, 3.0], got["list", "bin", None, 3.0, 8.0]) == (3, 1)
    running = [r["n"] for r in describe.describe(df, ["n"], bins=2, running=True).filter("kind = 'bin'").orderBy("low").collect()]
    assert running == [3, 4]
    assert describe.describe(df, ["n"]).filter("kind = 'bin'").count() >= 2


def test_functions_streams_and_order(spark):
    df = spark.createDataFrame([(i, str(i * 7 % 10)) for i in range(10)], "id bigint, v string")
    doubled = verbs.map_documents(df, lambda x: {"id": x["id"] * 2} if x["id"] % 2 else None, "id bigint")
    assert sorted(r["id"] for r in doubled.collect()) == [2, 6, 10, 14, 18]

    def totals(docs):
        yield {"total": sum(x["id"] for x in docs)}

    assert verbs.map_stream(df.coalesce(1), totals, "total bigint").collect()[0]["total"] == 45
    assert [r["v"] for r in verbs.sorted_head(df, "v", 3).collect()] == ["0", "1", "2"]
    assert [r["v"] for r in verbs.sorted_head(df, "v", 1, descending=True).collect()] == ["9"]
    groups = {r["id"]: r["group"] for r in verbs.grouped(df.repartition(4), 3, "id").collect()}
    assert groups == {i: i // 3 for i in range(10)}
    assert verbs.grouped(df.limit(0), 3, "id").count() == 0


def test_merge_of_json_into_the_row(spark):
    df = spark.createDataFrame([('1\tx\t{"a": 5, "id": 9}',), ("2\ty\tbad",)], "line string")
    out = verbs.merge(df, ["id%i", "name", "_%a int, id bigint"]).collect()
    assert [r.asDict() for r in out] == [{"id": 9, "name": "x", "a": 5}, {"id": None, "name": "y", "a": None}]


def test_settings():
    assert PRESETS["augment"].wants_model("fr") and not PRESETS["augment"].wants_model("en")
    assert PRESETS["test"].wants_model("de") and not PRESETS["test"].wants_model("en") and PRESETS["base"].wants_model("en")
    assert PRESETS["test_segment"].pipeline[-1] == "split_by_segment" and PRESETS["test_reproduce"].metadata


def test_describe_on_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "x.json").write_text("\n".join(json.dumps({"lang": "en" if i % 3 else "de", "n": i}) for i in range(30)))
    cli.main(["-f", str(tmp_path / "x.json"), "where", "{n} >= 3", "--", "describe", "lang", "n", "--bins", "3"])
    out = capsys.readouterr().out
    assert "lang present 27 length 2" in out and "en\t18\t" in out and out.count("█") > 60


def test_classify_and_split(spark, tmp_path):
    rows = [(i, lang, "\n".join(text(lang, i))) for i in range(6) for lang in WORDS]
    df = spark.createDataFrame(rows, "doc_id bigint, stated string, raw_content string")
    jobs.classify_and_split(spark, df, lid.train(df, "raw_content", "stated"), str(tmp_path / "split"), threshold=0.5)
    found = spark.read.json(str(tmp_path / "split"))
    assert found.count() == 12 and found.filter("stated <> split").count() == 0


def test_expand_corpus(spark):
    seed = spark.createDataFrame([("the old house. the old garden.", "en")] * 3, "raw_content string, language string")
    docs = spark.createDataFrame([("The old house. Quarks confine! The old house.", "en"), ("Le chat.", "fr")], "raw_content string, language string")
    likely, sample = jobs.expand_corpus(seed, docs, 5.0, rounding=10.0, cut=100.0)
    assert [(r["lang"], r["sentence"]) for r in likely.collect()] == [("en", "The old house.")]
    assert {r["sentence"] for r in sample.collect()} == {"The old house.", "Quarks confine!"}


def test_tokenize_documents_by_language(spark):
    df = spark.createDataFrame([("Hé, l'été (2 5)!\nok", "fr"), ("Zé", "en"), ("汉字 x", "zh"), (None, "en")], "raw_content string, language string")
    got = [r["tokenized"] for r in tokenize_documents(df, ("en", "fr", "zh")).collect()]
    assert got[0].split("\n") == ["Hé , l'été ( 2 , 5 ) !", "ok"] and got[1] == "Ze" and got[2] == "汉字 x" and got[3] is None


def test_runs_by_segment_and_experiments(spark, archive):
    base = Config.from_json(archive / "settings.json")
    docs = jobs.documents(spark, base, str(archive / "wet.paths"), str(archive))
    models = jobs.train(spark, base, readers.read_jsonl(spark, str(archive / "train.json"), None))
    config = replace(base, pipeline=PRESETS["mine_segment"].pipeline, mined_dir="by_segment")
    jobs.mine(spark, config, docs, models)
    moved = jobs.regroup(spark, config)
    assert len(moved) == 4 and spark.read.json(config.folder()).count() == 24
    assert set(spark.read.json(config.folder()).columns) == {"url", "digest", "cc_segment", "language", "language_score", "perplexity", "bucket", "line_ids"}
    lid_exp = replace(base, pipeline=PRESETS["lid_exp"].pipeline, mined_dir="lid")
    jobs.mine(spark, lid_exp, docs, {"lid_model": models["lid_model"]})
    rows = spark.read.json(lid_exp.folder("parts"))
    assert rows.count() == 24 and {"lid_before_dedup", "lid_after_dedup"} <= set(rows.columns)
    again = replace(base, pipeline=PRESETS["test_reproduce"].pipeline, mined_dir="again", metadata=config.folder())
    jobs.mine(spark, again, docs)
    assert spark.read.json(again.folder("split")).count() == 24
