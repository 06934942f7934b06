"""N-gram language models per language, perplexity, and what is selected by it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.binding import let
from siltworks.functions.text import normalize_for_dedup
from siltworks.session import materialize

#: Words a language's model knows; the rest is one unknown word. Bounds every table that is broadcast.
VOCABULARY = 10_000
#: Discount of backing off from a bigram to a unigram.
BACKOFF = 0.4


def words(text: Column) -> Column:
    """Words of a normalized text: runs of letters and digits."""
    return F.filter(F.split(F.regexp_replace(normalize_for_dedup(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def perplexity(log10: Column, length: Column) -> Column:
    """``10 ** (-log10 / length)``."""
    return F.pow(F.lit(10.0), -log10 / length)


def most_frequent(counts: DataFrame, key: str, item: str, size: int, parts: int = 64) -> DataFrame:
    """The ``size`` rows of each ``key`` with the greatest ``n``, ties by ``item``; first in each of ``parts`` of a key, then among those."""
    order = (F.desc("n"), item)
    some = counts.withColumn("part", F.pmod(F.xxhash64(item), F.lit(parts)).cast("int"))
    some = some.withColumn("rn", F.row_number().over(W.partitionBy(key, "part").orderBy(*order))).filter(F.col("rn") <= size)
    return some.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter(F.col("rn") <= size).drop("rn", "part")


def vocabulary(df: DataFrame, text: str = "text", language: str = "lang", size: int = VOCABULARY) -> DataFrame:
    """``lang, word, n``: the most frequent words of each language, ties by the word."""
    rows = df.filter(df[language].isNotNull()).select(df[language].alias("lang"), F.explode(words(df[text])).alias("word"))
    return most_frequent(rows.groupBy("lang", "word").agg(F.count("*").alias("n")), "lang", "word", size)


def unigram_model(vocab: DataFrame) -> DataFrame:
    """``lang, word, logp``: add-one probabilities in log10; the word null stands for all others."""
    total = vocab.groupBy("lang").agg((F.sum("n") + F.count("*") + 1).alias("total"))
    known = vocab.join(total, "lang").select("lang", "word", F.log10((F.col("n") + 1) / F.col("total")).alias("logp"))
    return known.union(total.select("lang", F.lit(None).cast("string"), F.log10(1 / F.col("total"))))


def unigram_log10(model: DataFrame, words_: Column, language: Column) -> Column:
    """The sum of ``logp`` of an array of words, scored in the row; null for null, no words, and languages without a model.

    The model is bounded by ``VOCABULARY`` rows a language; a worker holds it as dictionaries.
    """
    known: dict[str, tuple[dict[str, float], float]] = {}
    for lang, rows in model.toPandas().groupby("lang"):
        inside = rows["word"].notna()
        known[lang] = (dict(zip(rows.loc[inside, "word"], rows.loc[inside, "logp"], strict=True)), float(rows.loc[~inside, "logp"].iloc[0]))
    shared = model.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("double")
    def total(found: pd.Series, lang: pd.Series) -> pd.Series:
        out = []
        for ws, x in zip(found, lang, strict=True):
            if ws is None or not len(ws) or x not in shared.value:
                out.append(None)
            else:
                table, other = shared.value[x]
                out.append(sum(table.get(w, other) for w in ws))
        return pd.Series(out, dtype="float64")

    return total(words_, language)


def unigram_perplexity(df: DataFrame, model: DataFrame, doc: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """``doc, perplexity``: per line the words and one end of sentence count as length; rounded to one decimal.

    Languages without a model and texts without words give null.
    """
    return df.select(df[doc].alias("doc"), unigram_column(model, df[text], df[language]).alias("perplexity"))


def unigram_column(model: DataFrame, text: Column, language: Column) -> Column:
    """The perplexity of ``unigram_perplexity`` as a column."""
    found = words(F.replace(text, F.lit("\n"), F.lit(" ")))
    score = let(found, lambda w: F.struct(w.alias("w"), F.size(w).alias("n")))
    return F.round(perplexity(unigram_log10(model, score["w"], language), score["n"] + F.size(F.split(text, "\n"))), 1)


def bigram_perplexity(df: DataFrame, vocab: DataFrame, doc: str = "doc_id", text: str = "text", language: str = "lang", least: int = 2) -> DataFrame:
    """As ``unigram_perplexity`` under bigrams that occur ``least`` times, backing off to unigrams (stupid backoff); null for texts of under two words."""
    model = unigram_model(vocab)
    base = df.select(df[doc].alias("doc"), df[language].alias("lang"), F.size(F.split(df[text], "\n")).alias("n_lines"), words(F.replace(df[text], F.lit("\n"), F.lit(" "))).alias("words"))
    first = F.slice("words", 1, F.size("words") - 1)
    rest = F.slice("words", 2, F.size("words"))
    pairs = base.filter((F.size("words") > 1) & F.col("lang").isNotNull()).select("doc", "lang", F.explode(F.arrays_zip(first.alias("a"), rest.alias("b"))).alias("x")).select("doc", "lang", "x.a", "x.b")
    counts = pairs.groupBy("lang", "a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    heads = vocab.select("lang", F.col("word").alias("a"), F.col("n").alias("n_a"))
    bigrams = counts.join(heads, ["lang", "a"]).select("lang", "a", "b", F.log10(F.col("n") / F.col("n_a")).alias("p2"))
    known = model.filter("word is not null").select("lang", F.col("word").alias("b"), F.col("logp").alias("p1"))
    unknown = model.filter("word is null").select("lang", F.col("logp").alias("p0"))
    # bigrams are as many as the corpus has: a shuffle join on counts made per document first
    own = pairs.groupBy("doc", "lang", "a", "b").agg(F.count("*").alias("times"))
    scored = own.join(bigrams, ["lang", "a", "b"], "left").join(F.broadcast(known), ["lang", "b"], "left").join(F.broadcast(unknown), "lang")
    one = F.coalesce("p2", F.coalesce("p1", "p0") + F.log10(F.lit(BACKOFF)))
    sums = scored.groupBy("doc").agg(F.sum(one * F.col("times")).alias("s"))
    return base.select("doc", "n_lines", F.size("words").alias("n_words")).join(sums, "doc", "left").select("doc", F.round(perplexity(F.col("s"), F.col("n_words") + F.col("n_lines")), 1).alias("perplexity"))


def sentences(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """``lang, sentence``: distinct sentences of the lines, cut after full stops, question and exclamation marks."""
    cut = F.split(F.regexp_replace(df[text], r"([.!?。！？])\s+", "$1\n"), "\n")
    rows = df.select(df[language].alias("lang"), F.explode(cut).alias("sentence"))
    return rows.select("lang", F.trim("sentence").alias("sentence")).filter("sentence <> ''").distinct()


def sentence_perplexity(found: DataFrame, model: DataFrame) -> DataFrame:
    """``lang, sentence, perplexity`` under the unigram model; -1 where a sentence has no words or its language no model."""
    rows = found.select("lang", "sentence", words(F.col("sentence")).alias("words"))
    pp = F.round(perplexity(unigram_log10(model, F.col("words"), F.col("lang")), F.size("words") + 1), 1)
    return rows.select("lang", "sentence", F.coalesce(pp, F.lit(-1.0)).alias("perplexity"))


def mine_sentences(scored: DataFrame, threshold: float) -> DataFrame:
    """Sentences with ``0 < perplexity < threshold``."""
    return scored.filter((F.col("perplexity") > 0) & (F.col("perplexity") < threshold))


def sample_by_perplexity(df: DataFrame, key: str, rounding: float = 100.0, cut: float = 1000.0, samples: int = 20) -> DataFrame:
    """Up to ``samples`` rows of each perplexity step of ``rounding`` (one more in all but step 0), lowest ``key`` first; none beyond ``cut``.

    At most ``cut / rounding * samples + 1`` rows come out.
    """
    step = (F.floor(F.col("perplexity") / rounding) * rounding).cast("double")
    ranked = df.withColumn("step", step).filter(F.col("step") <= cut)
    # there are few steps: first the least of each part of a step, then among those
    ranked = ranked.withColumn("part", F.pmod(F.xxhash64(key), F.lit(64)))
    ranked = ranked.withColumn("rn", F.row_number().over(W.partitionBy("step", "part").orderBy(key))).filter(F.col("rn") <= samples + 1).drop("part")
    ranked = ranked.withColumn("rn", F.row_number().over(W.partitionBy("step").orderBy(key))).filter(F.col("rn") <= samples + 1)
    kept = ranked.filter(F.col("rn") <= F.when(F.col("step") == 0, samples).otherwise(samples + 1)).drop("rn")
    return kept.orderBy("step", key).limit(int(cut / rounding * samples) + 1)


# --- n-grams of any order -------------------------------------------------------------------------------------

#: Order of the models, discount taken from every count, and the marks around a text.
ORDER, DISCOUNT, START, STOP = 5, 0.75, "<s>", "</s>"


def places(df: DataFrame, tokens: Column, doc: str = "doc_id", language: str = "lang", order: int = ORDER) -> DataFrame:
    """``doc, lang, at, t0`` to ``t4``: for every token and the end of a text the hashes of it and of those before it, null before the start.

    ``at`` counts from 2, as the start of a text is token 1. Rows without language or tokens drop out.
    """
    padded = F.concat(F.array(F.lit(START)), tokens, F.array(F.lit(STOP)))
    hashed = F.transform(padded, lambda w: F.xxhash64(w))

    def around(x: Column) -> Column:
        def one(i: Column) -> Column:
            back = [F.when(i > n, F.get(x, i - 1 - n)).alias(f"t{n}") for n in range(order)]
            return F.struct(i.alias("at"), *back)

        return F.transform(F.sequence(F.lit(2), F.size(x)), one)

    slim = df.select(df[doc].alias("doc"), df[language].alias("lang"), hashed.alias("x")).filter("lang is not null and x is not null")
    return slim.select("doc", "lang", F.inline(let(F.col("x"), around)))


def grams(found: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc, lang, k, gram, context, suffix, top``: the n-grams of order 1 to ``order`` that end at each of ``places``.

    N-grams are 64-bit hashes of language and tokens; ``context`` is the n-gram without its last token, ``suffix`` without its first; ``top``
    marks the longest one of a place.
    """
    t = [F.col(f"t{n}") for n in range(order)]

    def hashed(first: int, last: int) -> Column:
        return F.xxhash64("lang", *t[first : last - 1 : -1] if last else t[first::-1])

    rows = []
    for k in range(1, order + 1):
        context = hashed(k - 1, 1) if k > 1 else F.xxhash64("lang")
        suffix = hashed(k - 2, 0) if k > 1 else F.lit(0).cast("bigint")
        rows.append(F.struct(F.lit(k).alias("k"), hashed(k - 1, 0).alias("gram"), context.alias("context"), suffix.alias("suffix"), (F.least("at", F.lit(order)) == k).alias("top")))
    return found.select("doc", "lang", "at", F.inline(F.array(*rows))).filter("k <= at").drop("at")


class NgramModel:
    """An interpolated n-gram model with absolute discounting, as tables.

    ``discounted`` (k, gram, share): (n - D) / c(context); ``rest`` (k, context, weight): D t(context) / c(context), where c counts what follows a context
    and t what different tokens do; ``unigrams`` (lang, weight) the same for no context, whose rest is spread evenly over the vocabulary and one
    unknown token. The tables are as large as the corpus has n-grams: they are joined by shuffles, never broadcast but ``unigrams``.
    """

    def __init__(self, discounted: DataFrame, rest: DataFrame, unigrams: DataFrame, order: int):
        self.discounted, self.rest, self.unigrams, self.order = discounted, rest, unigrams, order

    @classmethod
    def train(cls, found: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> NgramModel:
        """From the ``places`` of a corpus."""
        counts = materialize(grams(found, order).groupBy("lang", "k", "gram", "context").agg(F.count("*").alias("n")), "lm-counts")
        first = counts.filter("k = 1").groupBy("lang").agg(F.sum("n").alias("c"), F.count("*").alias("t"))
        contexts = counts.filter("k > 1").groupBy("k", "context").agg(F.sum("n").alias("c"), F.count("*").alias("t"))
        less = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("c")
        one = counts.filter("k = 1").join(F.broadcast(first), "lang").select("k", "gram", less.alias("share"))  # a row a language
        more = counts.filter("k > 1").join(contexts, ["k", "context"]).select("k", "gram", less.alias("share"))
        rest = contexts.select("k", "context", (discount * F.col("t") / F.col("c")).alias("weight"))
        unigrams = first.select("lang", (discount * F.col("t") / F.col("c") / (F.col("t") + 1)).alias("even"))
        return cls(materialize(one.union(more), "lm-shares"), materialize(rest, "lm-rest"), materialize(unigrams, "lm-unigrams"), order)

    def save(self, path: str) -> None:
        for name in ("discounted", "rest", "unigrams"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, order: int = ORDER) -> NgramModel:
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ("discounted", "rest", "unigrams")], order)

    def log10(self, found: DataFrame) -> DataFrame:
        """``doc, log10, n``: the sum over a text's tokens and its end, and their number, from ``places`` of texts.

        Every different n-gram is looked up once: from unigrams upwards, each order adds its discounted share to its context's rest times what
        the order below gave. A language without a model gives no rows.
        """
        found = grams(found, self.order)
        needed = materialize(found.select("lang", "k", "gram", "context", "suffix").distinct(), "lm-needed")
        below = needed.filter("k = 1").join(F.broadcast(self.unigrams), "lang").join(self.discounted.filter("k = 1").drop("k"), "gram", "left")
        below = below.select("gram", (F.coalesce("share", F.lit(0.0)) + F.col("even")).alias("p"))
        every = [below.withColumn("k", F.lit(1))]
        for k in range(2, self.order + 1):
            rows = needed.filter(F.col("k") == k).join(self.discounted.filter(F.col("k") == k).drop("k"), "gram", "left")
            rows = rows.join(self.rest.filter(F.col("k") == k).drop("k"), "context", "left")
            rows = rows.join(below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
            p = F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("lower")
            below = materialize(rows.select("gram", p.alias("p")), "lm-level")
            every.append(below.withColumn("k", F.lit(k)))
        table = every[0]
        for rows in every[1:]:
            table = table.unionByName(rows)
        own = found.filter("top").groupBy("doc", "k", "gram").agg(F.count("*").alias("times"))
        scored = own.join(table, ["k", "gram"])
        return scored.groupBy("doc").agg(F.sum(F.log10("p") * F.col("times")).alias("log10"), F.sum("times").alias("n"))


def ngram_perplexity(df: DataFrame, model: NgramModel, tokens: Column, doc: str = "doc_id", language: str = "lang") -> DataFrame:
    """``doc, perplexity``, rounded to one decimal: a text is one line, its tokens and its end count as length.

    Only documents with tokens and a language that the model knows come out.
    """
    found = materialize(places(df, tokens, doc, language, model.order), "lm-places")
    return model.log10(found).select("doc", F.round(perplexity(F.col("log10"), F.col("n")), 1).alias("perplexity"))
