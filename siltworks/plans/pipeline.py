"""A mining run as one plan: named steps over a table of documents.

Documents have ``doc_id`` (order), ``shard``, ``raw_content`` and any other fields.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siltworks.functions import pieces
from siltworks.operators import buckets, dedup, lid, lm, metadata, verbs
from siltworks.plans.config import Config
from siltworks.session import materialize
from siltworks.sources import sinks

#: Steps whose result the next ones read several times: it is written out rather than computed again.
REUSED = {"dedup", "fetch_metadata"}
#: Of several metadata rows of a record the last by these counts, as far as there are such columns.
LATEST = ["written_at", "line_ids", "perplexity", "bucket", "language"]


class Pipeline:
    """Steps of ``config`` over documents; models are made beforehand.

    ``lid_model`` from ``lid.train``; ``model`` from ``lm.vocabulary`` (words, scored in the row) or an ``lm.NgramModel`` (over ``tokenized``);
    ``cutoffs`` a table of percentiles; ``meta`` metadata rows; ``piece_models`` files of pieces by language (``*`` for all others), without which the
    ``sp`` step cuts words; ``hashes`` (shard, hash, n_docs) saved before, without which ``dedup`` counts those of the documents given. Each step is ``DataFrame -> DataFrame``, so Catalyst sees one plan. ``counters`` are filled when the result
    is written: rows after each step.
    """

    def __init__(
        self,
        config: Config,
        lid_model: DataFrame | None = None,
        model: DataFrame | lm.NgramModel | None = None,
        cutoffs: DataFrame | None = None,
        meta: DataFrame | None = None,
        piece_models: dict[str, str] | None = None,
        hashes: DataFrame | None = None,
    ):
        self.config, self.lid_model, self.model, self.cutoffs, self.meta, self.piece_models = config, lid_model, model, cutoffs, meta, piece_models or {}
        self.hashes = hashes
        self.observed: dict[str, Observation] = {}

    def steps(self) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
        """The steps before the sink, in the order of the config; unknown names are an error."""
        known = {
            "lid_before_dedup": lambda df: lid.with_top_languages(df, self.lid_model, "lid_before_dedup"),
            "dedup": self._dedup,
            "lid": lambda df: lid.with_language(df, self.lid_model, threshold=self.config.lang_threshold),
            "lid_after_dedup": lambda df: lid.with_top_languages(df, self.lid_model, "lid_after_dedup"),
            "keep_lang": lambda df: verbs.keep_lang(df, "language", self.config.lang_whitelist, self.config.lang_blacklist),
            "sp": self._sp,
            "lm": self._lm,
            "pp_bucket": lambda df: buckets.perplexity_bucket(df, self.cutoffs),
            "drop": lambda df: df.drop("tokenized"),
            "keep_bucket": lambda df: verbs.keep_bucket(df, self.config.keep_bucket),
            "fetch_metadata": lambda df: metadata.fetch_metadata(df, self.meta, [c for c in LATEST if c in self.meta.columns] or ["digest"], order=["doc_id"]),
            "minify": metadata.minify,
        }
        return [(s, known[s]) for s in self.config.pipeline if s not in ("split_by_lang", "split_by_segment")]

    def run(self, docs: DataFrame) -> DataFrame:
        df = docs.filter(F.length("raw_content") >= self.config.min_len)
        for name, step in self.steps():
            df = df.transform(step)
            self.observed[name] = Observation(f"after_{name}")
            df = df.observe(self.observed[name], F.count("*").alias("docs"), *([F.sum(F.length("raw_content")).alias("chars")] if "raw_content" in df.columns else []))
            if name in REUSED:
                df = materialize(df, name)
        return df

    def counters(self) -> dict[str, dict[str, int]]:
        """After the result has been written: documents and characters behind each step that ran."""
        return {name: dict(o.get) for name, o in self.observed.items()}

    def write(self, docs: DataFrame, path: str | None = None) -> None:
        out, path = self.run(docs), path or self.config.folder()
        if "split_by_lang" in self.config.pipeline:
            has_bucket = "bucket" in out.columns
            sinks.write_split(out, path, "{language}_{bucket}" if has_bucket else "{language}")
        elif "split_by_segment" in self.config.pipeline:
            sinks.write_by_segment(out, path)
        else:
            sinks.write_jsonl(out, path)

    def _dedup(self, df: DataFrame) -> DataFrame:
        per = self.config.hash_in_mem
        scope = dedup.shard_scope(F.col("shard"), per) if per else F.lit(0)
        lines = dedup.documents_with_lines(df.withColumn("scope", scope), "doc_id", "raw_content", ("scope",))
        if self.hashes is None:
            kept = dedup.two_pass_lines(lines, ("scope",))
        else:
            known = self.hashes.withColumn("scope", dedup.shard_scope(F.col("shard"), per) if per else F.lit(0))
            twice = dedup.duplicate_hashes(dedup.merge_hashes(known, ("scope",)))
            kept = dedup.first_in_document(lines).join(twice, ["scope", "hash"], "left_anti")
        others = tuple(c for c in df.columns if c not in ("doc_id", "raw_content", "nlines", "length", "original_nlines", "original_length", "line_ids"))
        return dedup.rebuild(df, kept, "doc_id", "raw_content", columns=others)

    def _sp(self, df: DataFrame) -> DataFrame:
        if self.piece_models:
            return pieces.tokenize(df, self.piece_models)
        return df.withColumn("tokenized", F.array_join(lm.words(F.col("raw_content")), " "))

    def _lm(self, df: DataFrame) -> DataFrame:
        config = self.config
        wanted, not_wanted = config.lm_languages if config.lm_languages is not None else config.lang_whitelist, config.lang_blacklist
        allowed = F.lit(True)
        if config.lm_languages is not None or wanted:
            allowed = F.coalesce(F.col("language").isin(*wanted), F.lit(False))
        elif not_wanted:
            allowed = ~F.coalesce(F.col("language").isin(*not_wanted), F.lit(False))
        if isinstance(self.model, lm.NgramModel):
            df = materialize(df, "lm")
            tokens = F.filter(F.split("tokenized", " "), lambda w: w != "")
            scored = lm.ngram_perplexity(df.filter(allowed), self.model, tokens, "doc_id", "language")
            return df.join(scored.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
        pp = lm.unigram_column(self.model, F.col("raw_content"), F.col("language"))
        return df.withColumn("perplexity", F.when(allowed, pp))
