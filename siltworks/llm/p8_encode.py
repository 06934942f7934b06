"""Problem 8: token ids of every document under byte_bpe_50k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltworks.llm.bpe import encoder, vocabulary
from siltworks.session import table


def encode_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizers: str | None = None
) -> DataFrame:
    """``(id_col, ids array<int>)`` for every row of ``df``.

    Null and empty texts get an empty list; null ids stay null; repeated rows come out as often as
    they go in; other columns, whatever their names, are not read. An empty table gives an empty
    one. Texts are encoded whole, at any length, without special tokens: their strings are
    ordinary text. No shuffle: each Arrow batch is encoded where it was read, and each worker
    keeps the codes of words it has seen.
    """
    path = vocabulary(tokenizers, "byte_bpe_50k.tiktoken")

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            codes = [enc.encode(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, codes)], dtype="int32")
            values = np.concatenate(codes) if codes else np.empty(0, "int32")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    kind = dict(df.dtypes)[id_col]
    out = df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))
