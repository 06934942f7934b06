"""Subword pieces under public models of pieces."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import normalize


@lru_cache(maxsize=16)
def _processor(path: str):
    """One loaded model a worker process and file."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def pieces(text: Column, model: str) -> Column:
    """Pieces of a text as an array; none for an empty one, null for null. Cut where the row lies, a batch at a time."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        out = texts.where(texts.notna(), None)
        some = texts[texts.notna()].tolist()
        found = iter(_processor(model).encode(some, out_type=str, num_threads=1) if some else [])
        return pd.Series([None if t is None else next(found) for t in out], index=texts.index, dtype=object)

    return cut(text)


def joined(found: Column) -> Column:
    """Pieces as one text, separated by spaces."""
    return F.array_join(found, " ")


def from_pieces(tokenized: Column, model: str) -> Column:
    """The text of pieces separated by spaces; bytes of characters outside the vocabulary are put together again."""

    @F.pandas_udf("string")
    def back(texts: pd.Series) -> pd.Series:
        decode = _processor(model).decode_pieces
        return texts.map(lambda t: decode(t.split(" ")) if t else t, na_action="ignore")

    return back(tokenized)


def tokenize(df: DataFrame, models: dict[str, str], text: str = "raw_content", out: str = "tokenized", language: str = "language", plain: bool = True) -> DataFrame:
    """``df`` with pieces of ``text`` under the model of each row's language (``models``; ``*`` is for all others), separated by spaces.

    With ``plain`` the text is normalized first, which takes out line breaks: it becomes one line. Where there is no model a row's
    ``out`` stays as it is.
    """
    source = normalize(df[text]) if plain else df[text]
    found = df[out] if out in df.columns else F.lit(None).cast("string")
    for lang, path in sorted(models.items(), reverse=True):  # the star sorts first and is tried last
        here = F.lit(True) if lang == "*" else F.coalesce(df[language] == lang, F.lit(False))
        others = [x for x in models if x != "*"]
        if lang == "*" and others:
            here = ~F.coalesce(df[language].isin(*others), F.lit(False))
        found = F.when(here, joined(pieces(F.when(here, source), path))).otherwise(found)
    return df.withColumn(out, found)
