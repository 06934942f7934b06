"""Jobs: what a run does from archive files to regrouped output, each step on its own and able to be taken up again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import dedup, lid, lm, metadata
from siltworks.plans.config import Config
from siltworks.plans.pipeline import Pipeline
from siltworks.session import materialize
from siltworks.sources import readers, sinks


def documents(spark: SparkSession, config: Config, manifest: str, root: str = "", shards: list[int] | None = None) -> DataFrame:
    """Documents of the manifest's shards with ``doc_id``; written out, so that ids stay the same."""
    names = readers.read_manifest(spark, manifest)
    docs = readers.read_shards(spark, names, config.num_shards, shards, config.num_segments_per_shard, config.min_len, root)
    return materialize(docs.withColumn("doc_id", F.monotonically_increasing_id()), "documents")


def export_shard(spark: SparkSession, config: Config, manifest: str, shard: int, output: str, root: str = "") -> None:
    """One shard as JSON lines."""
    sinks.write_jsonl(documents(spark, config, manifest, root, [shard]).drop("doc_id", "shard"), output)


def hashes(spark: SparkSession, config: Config, docs: DataFrame) -> str:
    """Counts of line hashes by shard in the run's folder; shards that are there already are not read again."""
    path = config.folder("hashes")
    if sinks.exists(spark, f"{path}/_SUCCESS"):
        done = spark.read.parquet(path).select("shard").distinct()
        docs = docs.join(F.broadcast(done), "shard", "left_anti")  # a row a shard
    lines = dedup.documents_with_lines(docs, "doc_id", "raw_content", ("shard",))
    dedup.save_hashes(dedup.collect_hashes(lines, ("shard",)), path, ("shard",))
    return path


def train(spark: SparkSession, config: Config, labelled: DataFrame, order: int = 1, pieces: dict[str, str] | None = None) -> dict:
    """Models from documents with ``language`` and ``raw_content``, kept in the run's folder and read from there if they are there.

    Order 1 is a unigram model of words; higher ones go over pieces where ``pieces`` names models of them, else over words.
    """
    path = config.folder("models")
    if not sinks.exists(spark, f"{path}/_DONE"):
        lid.train(labelled, "raw_content", "language").write.mode("overwrite").parquet(f"{path}/lid")
        own = labelled.filter("language is not null")
        languages = [r[0] for r in own.select("language").distinct().collect()]
        own = own.filter(F.col("language").isin([x for x in languages if config.wants_model(x)]))
        if order == 1:
            lm.unigram_model(materialize(lm.vocabulary(own, "raw_content", "language"), "vocab")).write.mode("overwrite").parquet(f"{path}/unigrams")
        else:
            cut = Pipeline(config, piece_models=pieces)._sp(own.withColumn("doc_id", F.monotonically_increasing_id()))
            tokens = F.filter(F.split("tokenized", " "), lambda w: w != "")
            lm.NgramModel.train(materialize(lm.places(cut, tokens, "doc_id", "language", order), "lm-places"), order).save(f"{path}/ngrams")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/_DONE")
    model = spark.read.parquet(f"{path}/unigrams") if order == 1 else lm.NgramModel.load(spark, f"{path}/ngrams", order)
    return {"lid_model": spark.read.parquet(f"{path}/lid"), "model": model, "piece_models": pieces}


def mine(spark: SparkSession, config: Config, docs: DataFrame, models: dict | None = None) -> dict[str, dict[str, int]]:
    """The pipeline over documents, written in splits or by segment; counters of its steps. A finished run is left as it is."""
    split = "split_by_lang" in config.pipeline
    path = config.folder("split" if split else "parts")
    if sinks.exists(spark, f"{path}/_SUCCESS"):
        return {}
    given = dict(models or {})
    if "pp_bucket" in config.pipeline and config.cutoff:
        given["cutoffs"] = readers.read_cutoffs(spark, config.cutoff)
    if "dedup" in config.pipeline:
        given["hashes"] = spark.read.parquet(hashes(spark, config, docs))
    if "fetch_metadata" in config.pipeline:
        given["meta"] = spark.read.json(config.metadata)
    run = Pipeline(config, **given)
    run.write(docs, path)
    return run.counters()


def regroup(spark: SparkSession, config: Config) -> list[str] | DataFrame:
    """The result of ``mine`` in files of about the target size; segments are only moved."""
    if "split_by_lang" in config.pipeline:
        return sinks.regroup_splits(spark, config.folder("split"), config.folder(), config.target_size, config.cleanup_after_regroup)
    return sinks.move_segments(spark, config.folder("parts"), config.folder())


def minify(spark: SparkSession, inputs: str, output: str) -> None:
    """Compact metadata of mined documents, a file for each segment."""
    sinks.write_by_segment(metadata.minify(readers.read_jsonl(spark, inputs)), output)


def fetch(spark: SparkSession, docs: DataFrame, meta: str, output: str) -> None:
    """Documents with the metadata published for them, only the lines it names."""
    known = spark.read.json(meta)
    latest = [c for c in ("written_at", "line_ids", "perplexity", "bucket", "language") if c in known.columns]
    sinks.write_jsonl(metadata.fetch_metadata(docs, known, latest, order=["url"]), output)


def paragraphs(spark: SparkSession, docs: DataFrame, meta: str, output: str, snapshot: str, latest: str) -> None:
    """Paragraphs that published metadata names, as text by language; big languages from the latest snapshot only."""
    schema = "cc_segment string, digest string, url string, line_ids array<int>, languages array<string>, lm_scores array<double>"
    known = spark.read.schema(schema).json(meta)
    found = metadata.snapshot_filter(metadata.paragraphs(docs, known), snapshot, latest)
    sinks.write_text_by_language(found, output)


def opening(spark: SparkSession, articles: str, output: str, n_docs: int | None = None) -> None:
    """Opening texts of an encyclopedia dump as lines of text."""
    readers.opening_texts(spark.read.json(articles), n_docs).write.option("compression", "gzip").text(output)


def classify_and_split(spark: SparkSession, docs: DataFrame, lid_model: DataFrame, output: str, pattern: str = "{language}", threshold: float = 0.0) -> None:
    """Documents by the language found for them, in splits."""
    sinks.write_split(lid.with_language(docs, lid_model, threshold=threshold), output, pattern)


def expand_corpus(
    seed: DataFrame, docs: DataFrame, threshold: float, text: str = "raw_content", language: str = "language", rounding: float = 100.0, cut: float = 1000.0, samples: int = 20
) -> tuple[DataFrame, DataFrame]:
    """Sentences of ``docs`` that are likely under a model of ``seed`` (perplexity under ``threshold``), and a sample of all over steps of perplexity.

    Both have ``lang, sentence, perplexity``; sentences are distinct, of the languages of the seed.
    """
    model = lm.unigram_model(materialize(lm.vocabulary(seed, text, language), "vocab"))
    scored = materialize(lm.sentence_perplexity(lm.sentences(docs, text, language), model), "scored")
    likely = lm.mine_sentences(scored, threshold)
    return likely, lm.sample_by_perplexity(scored.filter("perplexity > 0"), "sentence", rounding, cut, samples)
