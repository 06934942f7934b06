"""Problem 5: text statistics per page, and a Gaussian mixture that tells prose, lists, tables and junk apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.archetypes import PROSE
from siltworks.llm.common import summed
from siltworks.llm.p2_spam import spam_pages
from siltworks.llm.page_stats import NAMES
from siltworks.llm.pages import DIMS, SENTENCES, example_vectors, page_table, stats_matrix, vectors
from siltworks.session import table

#: Rounds of expectation-maximization; smallest spread of a standardised dimension; pages the examples count for.
ROUNDS, FLOOR, PRIOR = 8, 0.15, 20.0
#: Share of words in sentences above which a page is prose, by the exact check.
OWN_TEXT = 0.65


class Mixture:
    """Gaussians with diagonal scatter over standardised vectors; component k bears the name of a kind of example."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray):
        kinds, labels, _, x = example_vectors()
        self.centre, self.spread = centre, spread
        self.kinds = sorted(set(kinds))
        self.classes = np.array([labels[kinds == k][0] for k in self.kinds])
        z = self.standard(x)
        first = [z[kinds == k] for k in self.kinds]
        self.prior = [(PRIOR, PRIOR * y.mean(axis=0), PRIOR * (y**2).mean(axis=0)) for y in first]
        self.update(np.zeros(len(first)), np.zeros((len(first), x.shape[1])), np.zeros((len(first), x.shape[1])))

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.spread

    def update(self, n: np.ndarray, s: np.ndarray, ss: np.ndarray) -> None:
        """Maximization; the examples stay in as a few pages, so that a component keeps its meaning."""
        n0, s0, ss0 = (np.array(x) for x in zip(*self.prior, strict=True))
        n, s, ss = n + n0, s + s0, ss + ss0
        self.mean = s / n[:, None]
        self.var = np.maximum(ss / n[:, None] - self.mean**2, FLOOR**2)
        self.log_weight = np.log(n / n.sum())

    def posterior(self, x: np.ndarray) -> np.ndarray:
        z = self.standard(x)
        inverse = 1 / self.var
        score = (z**2) @ inverse.T - 2 * z @ (self.mean * inverse).T + (self.mean**2 * inverse).sum(axis=1)
        score = self.log_weight - 0.5 * (score + np.log(self.var).sum(axis=1))
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        return p / p.sum(axis=1, keepdims=True)


def _sums(stats: DataFrame, shape: tuple[int, ...], of) -> np.ndarray:
    """Sum over all pages of an array that ``of`` makes from a batch of vectors; one array reaches the driver."""

    def total(b):
        x = vectors(stats_matrix(b.column(0)))
        return {"all": of(x).ravel()} if len(x) else {}

    found = summed(stats, ["stats"], total)
    return found["all"].reshape(shape) if found else np.zeros(shape)


def fit_mixture(stats: DataFrame) -> Mixture:
    """Expectation-maximization over all pages, from the inspected examples."""
    d = len(DIMS)
    moments = _sums(stats, (3, d), lambda x: np.array([np.full(d, len(x)), x.sum(axis=0), (x**2).sum(axis=0)]))
    n = np.maximum(moments[0], 1)
    centre = moments[1] / n
    spread = np.sqrt(np.maximum(moments[2] / n - centre**2, 0.05**2))
    model = Mixture(centre, spread)
    k = len(model.kinds)
    for _ in range(ROUNDS):
        shared = stats.sparkSession.sparkContext.broadcast(model)

        def expect(x, shared=shared):
            p, z = shared.value.posterior(x), shared.value.standard(x)
            return np.concatenate([p.sum(axis=0)[:, None], p.T @ z, p.T @ z**2], axis=1)

        total = _sums(stats, (k, 2 * d + 1), expect)
        model.update(total[:, 0], total[:, 1 : d + 1], total[:, d + 1 :])
    return model


def page_quality(pages: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Per page with text: ``page_id, language``, every statistic of ``NAMES``, ``class``, ``probability`` and ``natural``.

    ``class`` is that of the likeliest components (prose, list, table, junk or spam), ``probability`` its
    posterior. ``natural`` is false if the class is not prose and (the exact check) fewer than ``OWN_TEXT`` of the
    words stand in sentences. ``stats`` is the ``page_table`` if there is one already. Null and blank texts give no rows, repeated rows one each; an empty table gives no rows;
    other columns are not read; whole texts count.
    """
    stats = page_table(pages) if stats is None else stats
    shared = stats.sparkSession.sparkContext.broadcast(fit_mixture(stats))

    def run(batches):
        model = shared.value
        names = sorted(set(model.classes))
        member = np.array([model.classes == c for c in names], float).T
        for b in batches:
            raw = stats_matrix(b.column(2))
            if not len(raw):
                continue
            p = model.posterior(vectors(raw)) @ member
            best = p.argmax(axis=1)
            label = np.array(names)[best]
            natural = (label == PROSE) | (raw[:, SENTENCES] >= OWN_TEXT)
            values = [pa.array(raw[:, i]) for i in range(len(NAMES))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *values, pa.array(label.tolist()), pa.array(p.max(axis=1)), pa.array(natural)], ["page_id", "language", *NAMES, "class", "probability", "natural"])

    schema = "page_id bigint, language string, " + ", ".join(f"{n} double" for n in NAMES)
    return stats.mapInArrow(run, schema + ", class string, probability double, natural boolean")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are not natural by the mixture, and those that are spam as of problem 2, from one table of statistics."""
    stats = page_table(table(spark, sf_dir, "wet_pages"))
    poor = page_quality(stats, stats).filter("not natural").select("page_id")
    return poor.union(spam_pages(stats, stats).filter("spam").select("page_id")).distinct()


def p5_page_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All statistics, and whether ``nlines`` and ``length`` of the record agree with the text.

    ``length`` may be the text's characters or the bytes of the record, which are no fewer than the text's.
    """
    pages = table(spark, sf_dir, "wet_pages")
    stated = pages.select(
        "page_id",
        (F.col("nlines") == F.size(F.split("raw_content", "\n"))).alias("nlines_agree"),
        ((F.col("length") == F.length("raw_content")) | (F.col("length") >= F.octet_length("raw_content"))).alias("length_agrees"),
    )
    return page_quality(pages).join(stated, "page_id", "left")
