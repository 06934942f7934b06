"""Problem 2: pages of stuffed keywords, links or tags, as outliers in spam-directed directions."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltworks.llm.archetypes import SPAM
from siltworks.llm.common import summed
from siltworks.llm.pages import DIMS, SENTENCES, example_vectors, page_table, stats_matrix, vectors
from siltworks.session import table

#: Rounds of reweighting; pages a language needs for a location and scatter of its own; smallest spread of a dimension.
ROUNDS, OWN_PAGES, FLOOR = 4, 200, 0.04
#: Examples a page's direction is compared with, and the share of words in sentences above which a page has text of its own.
NEAREST, OWN_TEXT = 7, 0.65


def chi2_bound(d: int, z: float = 3.09) -> float:
    """Upper quantile of chi-squared with ``d`` degrees (Wilson and Hilferty); z = 3.09 is one in a thousand."""
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


class Scatter:
    """Location and inverse square root of scatter per language, with a pooled one under ``None``."""

    def __init__(self, moments: dict[str, tuple[float, np.ndarray, np.ndarray]]):
        d = len(DIMS)
        total = (sum(m[0] for m in moments.values()), sum(m[1] for m in moments.values()) + np.zeros(d), sum(m[2] for m in moments.values()) + np.zeros((d, d)))
        self.of = {lang: self._fit(*m) for lang, m in moments.items() if m[0] >= OWN_PAGES}
        self.of[None] = self._fit(*total)

    @staticmethod
    def _fit(n: float, s: np.ndarray, ss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = max(n, 1.0)
        mean = s / n
        cov = ss / n - np.outer(mean, mean)
        values, axes = np.linalg.eigh((cov + cov.T) / 2)
        return mean, axes @ np.diag(1 / np.sqrt(np.maximum(values, FLOOR**2))) @ axes.T

    def whiten(self, langs, x: np.ndarray) -> np.ndarray:
        """Deviations in units of the language's scatter; their squared length is the Mahalanobis distance."""
        out = np.empty_like(x)
        langs = np.asarray(langs, dtype=object)
        for lang in set(langs.tolist()):
            at = langs == lang
            mean, root = self.of.get(lang) or self.of[None]
            out[at] = (x[at] - mean) @ root
        return out


def robust_scatter(stats: DataFrame) -> Scatter:
    """Reweighted location and scatter per language.

    Prose must be the bulk of a language's pages, as for every robust scatter. It starts at the inspected prose and, round by round, takes the pages within the bound of the last fit, so that
    lists, noise and spam do not count. Each round adds up moments in every task and merges them per
    language on the executors; one row a language reaches the driver.
    """
    _, labels, langs, x = example_vectors()
    prose = labels == "prose"
    fit = Scatter({lang: (float(m.sum()), x[m].sum(0), x[m].T @ x[m]) for lang in set(langs) for m in [prose & (langs == lang)]})
    # at first all languages are measured from the pooled examples, with a wide bound
    fit.of = {None: fit.of[None]}
    d = len(DIMS)
    for k in range(ROUNDS):
        bound = chi2_bound(d) * (4 if k == 0 else 1.5)
        shared = stats.sparkSession.sparkContext.broadcast(fit)

        def moments_of(b, shared=shared, bound=bound):
            v, names = vectors(stats_matrix(b.column(1))), np.array(b.column(0).to_pylist(), dtype=object)
            near = (shared.value.whiten(names, v) ** 2).sum(axis=1) <= bound
            parts = {lang: v[near & (names == lang)] for lang in set(names[near].tolist())}
            return {lang: np.concatenate([[len(y)], y.sum(axis=0), (y.T @ y).ravel()]) for lang, y in parts.items()}

        moments = summed(stats, ["language", "stats"], moments_of)
        if not moments:
            break
        fit = Scatter({lang: (m[0], m[1 : d + 1], m[d + 1 :].reshape(d, d)) for lang, m in moments.items() if lang != "und"})
    return fit


def spam_pages(pages: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """``page_id, language, distance, spam_share, spam`` of every page with text.

    ``distance``: squared robust Mahalanobis distance from the prose of the page's likeliest language (of all where it
    has few pages or none is likely). ``spam_share``: share of spam among the inspected examples whose deviations point most nearly in
    the page's direction; both by ``raw_content`` alone. A page is spam if it is an outlier, that share is over one half, and (the exact check) under
    ``OWN_TEXT`` of its words stand in sentences. ``stats`` is the ``page_table`` if there is one already. Null and blank texts give no rows; copies and repeated rows count
    each; an empty table gives no rows; other columns are not read; whole texts count.
    """
    stats = page_table(pages) if stats is None else stats
    fit = robust_scatter(stats)
    _, labels, langs, x = example_vectors()
    toward = fit.whiten(langs, x)
    toward /= np.linalg.norm(toward, axis=1, keepdims=True) + 1e-9
    shared = stats.sparkSession.sparkContext.broadcast((fit, toward, labels == SPAM))
    bound = chi2_bound(len(DIMS))

    def run(batches):
        scatter, ways, is_spam = shared.value
        for b in batches:
            raw = stats_matrix(b.column(2))
            if not len(raw):
                continue
            y = scatter.whiten(b.column(1).to_pylist(), vectors(raw))
            distance = (y**2).sum(axis=1)
            nearest = np.argpartition(-(y @ ways.T), NEAREST, axis=1)[:, :NEAREST]
            share = is_spam[nearest].mean(axis=1)
            spam = (distance > bound) & (share > 0.5) & (raw[:, SENTENCES] < OWN_TEXT)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(distance), pa.array(share), pa.array(spam)], ["page_id", "language", "distance", "spam_share", "spam"])

    return stats.mapInArrow(run, "page_id bigint, language string, distance double, spam_share double, spam boolean")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_pages(table(spark, sf_dir, "wet_pages")).filter("spam").select("page_id").distinct()
