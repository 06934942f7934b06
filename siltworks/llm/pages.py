"""Page statistics as a table, and the vectors that the models of problems 2 and 5 work on."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.archetypes import examples
from siltworks.llm.page_stats import NAMES, page_stats
from siltworks.session import materialize, spread

#: Dimensions of a vector: transformed statistics of ``NAMES``.
LOGS, ROOTS = {"line_words", "marks", "word_length"}, {"digits", "symbols", "links", "top_word", "top_five"}
PLAIN = ["function", "sentences", "ended", "bullets", "distinct", "entropy", "packed", "pairs", "odd_words", "tabular"]
DIMS = [*PLAIN, *sorted(LOGS), *sorted(ROOTS)]
SENTENCES = NAMES.index("sentences")


def vectors(stats: np.ndarray) -> np.ndarray:
    """One row per page, one column per entry of ``DIMS``."""
    columns = []
    for name in DIMS:
        x = stats[:, NAMES.index(name)]
        columns.append(np.log1p(x) if name in LOGS else np.sqrt(np.clip(x, 0, 1)) if name in ROOTS else x)
    return np.column_stack(columns) if len(stats) else np.empty((0, len(DIMS)))


@lru_cache(maxsize=1)
def example_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, classes, language guesses and vectors of the inspected examples."""
    found = [(kind, label, page_stats(text)) for kind, label, text in examples(8)]
    found = [(k, c, s) for k, c, s in found if s]
    kinds, labels, langs = (np.array(x) for x in zip(*((k, c, s[0]) for k, c, s in found), strict=True))
    return kinds, labels, langs, vectors(np.array([s[1] for _, _, s in found]))


def page_table(pages: DataFrame) -> DataFrame:
    """``page_id, language, stats`` (array of ``NAMES``) of every page that has text; the step is written out."""

    def run(batches):
        for b in batches:
            found = [page_stats(t) for t in b.column(1).to_pylist()]
            keep = pa.array([x is not None for x in found])
            found = [x for x in found if x]
            stats = pa.array([x[1] for x in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), pa.array([x[0] for x in found], pa.string()), stats], ["page_id", "language", "stats"])

    slim = pages.select(pages["page_id"].alias("page_id"), pages["raw_content"].alias("text")).filter(F.col("text").isNotNull())
    return materialize(spread(slim).mapInArrow(run, "page_id bigint, language string, stats array<double>"), "pages")


def stats_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, len(NAMES))
