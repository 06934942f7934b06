"""Language identification by character trigrams.

A multinomial naive Bayes model over the most frequent trigrams of each language. It is trained with DataFrame operations and applied
inside the row: its tables are bounded by ``PROFILE`` trigrams a language, so a worker holds them as one matrix and a text is scored where it
lies, without a join or a shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.binding import let

PROFILE = 400


#: Languages with more rows than this are an error: a column of languages gone wrong would make a matrix of any size.
MOST_LANGUAGES = 1_000


def letters(text: Column) -> Column:
    """The lower-cased text in which every run without letters is one space. Line breaks are runs too."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """Trigrams of ``letters``."""
    clean = letters(text)

    def cut(chars: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(chars) - 2)
        three = F.transform(at, lambda i: F.concat(F.element_at(chars, i), F.element_at(chars, i + 1), F.element_at(chars, i + 2)))
        return F.when(F.size(chars) >= 3, three).otherwise(F.array().cast("array<string>"))

    return let(F.split(clean, ""), cut)


def train(df: DataFrame, text: str = "text", language: str = "lang", profile: int = PROFILE) -> DataFrame:
    """``lang, gram, logp``: for every language all trigrams of any profile, with add-one smoothed log probabilities."""
    rows = df.filter(df[language].isNotNull() & df[text].isNotNull()).select(df[language].alias("lang"), F.explode(trigrams(df[text])).alias("gram"))
    counts = rows.groupBy("lang", "gram").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rn", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    top = ranked.filter(F.col("rn") <= profile)
    grams = top.select("gram").distinct()
    langs = counts.select("lang").distinct()
    # bounded: (languages x profile) rows
    full = langs.join(F.broadcast(grams)).join(counts, ["lang", "gram"], "left").select("lang", "gram", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum(F.col("n") + 1).over(W.partitionBy("lang"))
    return full.select("lang", "gram", F.log((F.col("n") + 1) / total).alias("logp"))


class Matrix:
    """The model on one machine: codes of its trigrams in order, and a row of log probabilities for each."""

    def __init__(self, model: DataFrame):
        rows = model.toPandas()  # PROFILE rows at most for each pair of languages
        self.langs = sorted(rows["lang"].unique())
        if len(self.langs) > MOST_LANGUAGES:
            raise ValueError(f"{len(self.langs)} languages in the model")
        table = rows.pivot(index="gram", columns="lang", values="logp")[self.langs] if len(rows) else pd.DataFrame()
        codes = np.array([self.codes(g)[0] for g in table.index], np.int64)
        order = np.argsort(codes)
        self.grams, self.logp = codes[order], table.to_numpy(np.float64)[order] if len(rows) else np.empty((0, 0))

    @staticmethod
    def codes(text: str) -> np.ndarray:
        """One number per trigram, made of its three code points."""
        x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        return (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]

    def best(self, text: str | None, k: int) -> list[dict] | None:
        """The ``k`` likeliest languages of a text of ``letters``; None for null and where no trigram is known."""
        if text is None or not len(self.grams):
            return None
        codes = self.codes(text)
        at = np.searchsorted(self.grams, codes)
        at[at == len(self.grams)] = 0
        at = at[self.grams[at] == codes]
        if not len(at):
            return None
        logp = np.bincount(at, minlength=len(self.grams)) @ self.logp
        share = np.exp(logp - logp.max())
        share /= share.sum()
        order = np.lexsort((np.arange(len(logp)), -logp))[:k]
        return [{"lang": self.langs[i], "logp": float(logp[i]), "score": float(share[i])} for i in order]


def languages(model: DataFrame, text: Column, k: int | None = None) -> Column:
    """``array<struct<lang, logp, score>>``: the ``k`` best languages (all by default), best first, with the posterior rounded to two digits.

    Null for null texts and those without a known trigram.
    """
    matrix = Matrix(model)
    top = k or len(matrix.langs) or 1
    shared = model.sparkSession.sparkContext.broadcast(matrix)

    @F.pandas_udf("array<struct<lang string, logp double, score double>>")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shared.value.best(t, top))

    return F.transform(score(letters(text)), lambda x: F.struct(x["lang"].alias("lang"), x["logp"].alias("logp"), F.round(x["score"], 2).alias("score")))


def scores(df: DataFrame, model: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, lang, logp, score``: posterior of each language, rounded to two digits, for texts with any known trigram."""
    rows = df.select(df[doc].alias("doc"), languages(model, df[text]).alias("x"))
    return rows.select("doc", F.inline("x"))


def classify(df: DataFrame, model: DataFrame, doc: str = "doc_id", text: str = "text", k: int = 1, threshold: float = 0.0) -> DataFrame:
    """``doc, rank, lang, score`` of the ``k`` best; documents of which none reaches the threshold drop out."""
    rows = df.select(df[doc].alias("doc"), languages(model, df[text], k).alias("x"))
    rows = rows.filter(F.exists("x", lambda x: x["score"] >= threshold))
    return rows.select("doc", F.posexplode("x").alias("at", "x")).select("doc", (F.col("at") + 1).alias("rank"), "x.lang", "x.score")


def with_language(df: DataFrame, model: DataFrame, text: str = "raw_content", threshold: float = 0.0, only: str | None = None) -> DataFrame:
    """``df`` with ``language`` and ``language_score``; documents below the threshold or without a known trigram drop out.

    With ``only``, documents that state another ``language`` pass as they are, unscored.
    """
    found = F.get(languages(model, df[text], 1), F.lit(0))
    if only is None:
        out = df.withColumn("found", found).filter(F.col("found.score") >= threshold)
        return out.withColumn("language", F.col("found.lang")).withColumn("language_score", F.col("found.score")).drop("found")
    asked = F.coalesce(df["language"] == only, F.lit(True))
    out = df.withColumn("asked", asked).withColumn("found", F.when(F.col("asked"), found)).filter(~F.col("asked") | (F.col("found.score") >= threshold))
    score = F.col("language_score") if "language_score" in df.columns else F.lit(None).cast("double")
    out = out.withColumn("language_score", F.when(F.col("asked"), F.col("found.score")).otherwise(score))
    return out.withColumn("language", F.when(F.col("asked"), F.col("found.lang")).otherwise(F.col("language"))).drop("asked", "found")


def with_top_languages(df: DataFrame, model: DataFrame, out: str, text: str = "raw_content", k: int = 5) -> DataFrame:
    """``df`` with a map from the ``k`` best languages to their scores, null where none is known."""
    entries = F.transform(languages(model, df[text], k), lambda x: F.struct(x["lang"].alias("key"), x["score"].alias("value")))
    return df.withColumn(out, F.map_from_entries(entries))


def disagreement(before: DataFrame, after: DataFrame) -> DataFrame:
    """``before, after, docs``: how often two classifications of the same documents differ or agree."""
    a, b = before.select("doc", F.col("lang").alias("before")), after.select("doc", F.col("lang").alias("after"))
    return a.join(b, "doc", "full").groupBy("before", "after").agg(F.count("*").alias("docs"))


def length_weighted(lines: DataFrame) -> DataFrame:
    """``doc, lang``: the language with the greatest score summed over a document's lines, weighted by their lengths."""
    sums = lines.groupBy("doc", "lang").agg(F.sum(F.col("score") * F.col("length")).alias("vote"))
    return sums.groupBy("doc").agg(F.max(F.struct("vote", "lang")).alias("best")).select("doc", "best.lang")
