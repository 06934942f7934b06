"""Problem 9: passages of evaluation items in the corpus, by a distributed positional inverted index.

The index stores the postings of every term of the corpus: for each term the documents and positions where it stands. Each task packs the lists of
its own documents, which then go to the buckets of their terms; items are not known by then, so one index serves any items.
Of every run of 14 words of an item the two rarest terms are looked up. Their lists, shifted by the term's offset in the item, are
intersected: two terms must agree, up to a few words, on where the item starts in the document. Around such a place the document is
compared with the item: exactly for phrases, by an alignment with words replaced, left out or put in for altered copies.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.common import bucketed_table
from siltworks.llm.words import clean, codes_of
from siltworks.session import materialize, scratch, spread, table

#: Words in a row that count as a leak.
PHRASE = 14
#: An altered copy: share of words of passage and question left after the edits, of the question alone, and their least number.
NEAR, NEAR_QUESTION, NEAR_WORDS = 0.75, 0.7, 25
#: In an altered copy the looked-up terms agree on the start up to so many words; half of it is always allowed.
BAND = 16
#: So many of them must: this share of those in passage and question, but no fewer and no more than these.
AGREE, LEAST_AGREE, MOST_AGREE = 0.35, 3, 8
#: A list of one task above this length is frequent: such lists of a term are spread over so many buckets.
FREQUENT, WAYS = 2_000, 64
#: Documents up to which candidates are broadcast by id (8 bytes each) to pick their texts; beyond, texts are joined by a shuffle.
BROADCAST_IDS = 2_000_000

_POSTINGS = "slot BIGINT, n INT, docs BINARY, places BINARY"
_TERM = re.compile(r"[^\W_]+")
#: Options in brackets at the end of a question, as in "(a / b / c)".
_OPTIONS = re.compile(r"\([^()]* / [^()]*\)\s*$")
_ASKS = re.compile(r"[?？]")


def terms(text: str) -> list[str]:
    """Runs of letters and digits of the cleaned text."""
    return _TERM.findall(clean(text))


def parts(text: str) -> list[int]:
    """For each term of an item 1 in its passage (the longest line), 2 in a question, 0 elsewhere."""
    lines = text.split("\n")
    longest = max(lines, key=len)
    out: list[int] = []
    for line in lines:
        n = len(terms(line))
        if line is longest:
            out += [1] * n
        elif _ASKS.search(line):
            k = len(terms(_OPTIONS.sub("", line)))
            out += [2] * k + [0] * (n - k)
        else:
            out += [0] * n
    return out


# --- the index ------------------------------------------------------------------------------------------------


def packed_lists(docs: DataFrame) -> DataFrame:
    """``slot, n, docs, places``: per Arrow batch of documents and term its postings, as packed int64 and int32.

    ``slot`` is the term's 32-bit code. Lists longer than ``FREQUENT`` get one of ``WAYS`` slots above that range.
    """

    def run(batches):
        for at, b in enumerate(batches):
            coded = [codes_of(terms(t)) for t in b.column(1).to_pylist()]
            sizes = np.array([len(c) for c in coded])
            code = np.concatenate([np.empty(0, np.uint32), *coded])
            order = np.argsort(code, kind="stable")
            code = code[order]
            doc = np.repeat(b.column(0).to_numpy(), sizes)[order]
            place = (np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)[order]
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
            n = np.diff(np.append(starts, len(code)))
            way = 1 + (at * 7919 + int(doc[0] if len(doc) else 0)) % WAYS
            slot = code[starts].astype(np.int64) + np.where(n > FREQUENT, way, 0) * (1 << 32)
            for a in range(0, len(starts), 50_000):  # binary arrays are bounded
                z = min(a + 50_000, len(starts))
                lo, hi = starts[a], (starts[z] if z < len(starts) else len(code))
                ends = np.append(starts[a:z], hi) - lo
                lists = [
                    pa.Array.from_buffers(pa.binary(), z - a, [None, pa.py_buffer((ends * w).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x[lo:hi]))])
                    for x, w in ((doc, 8), (place, 4))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(slot[a:z]), pa.array(n[a:z].astype(np.int32)), *lists], ["slot", "n", "docs", "places"])

    return docs.mapInArrow(run, "slot bigint, n int, docs binary, places binary")


class PositionalIndex:
    """Postings of a corpus in a folder, bucketed by term; built once, searched for any items."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def build(self, docs: DataFrame) -> None:
        """Index ``doc_id, text`` of all documents."""
        docs = spread(docs)
        buckets = max(self.spark.sparkContext.defaultParallelism, docs.rdd.getNumPartitions())
        self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(f"{self.folder}/buckets")
        packed_lists(docs).repartition(buckets, "slot").write.insertInto(self._table(buckets))

    def _table(self, buckets: int | None = None) -> str:
        buckets = buckets or self.spark.read.json(f"{self.folder}/buckets").first()[0]
        return bucketed_table(self.spark, f"{self.folder}/postings", _POSTINGS, "slot", buckets)

    def lists(self, wanted: DataFrame, columns: list[str]) -> DataFrame:
        """``wanted`` (with ``term``, once or more) joined with ``columns`` of the postings.

        The terms travel to the buckets; common lists are not shuffled. Frequent lists, which lie anywhere, are joined apart.
        """
        stored = self.spark.table(self._table()).select("slot", *columns)
        near = stored.filter(F.col("slot") < 1 << 32)
        far = stored.filter(F.col("slot") >= 1 << 32).withColumn("term", F.col("slot").bitwiseAND((1 << 32) - 1)).drop("slot")
        at = wanted.withColumn("slot", F.col("term"))
        found = near.join(at.hint("shuffle_hash"), "slot").drop("slot")
        return found.unionByName(far.join(wanted, "term"))


# --- items ----------------------------------------------------------------------------------------------------


def item_words(items: DataFrame) -> DataFrame:
    """``item_id, codes, part``: the codes of an item's words and their parts, packed; items under 14 words left out."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found, part = codes_of(terms(t)), parts(t)
                if len(found) >= PHRASE:
                    rows.append((i, found.tobytes(), np.array(part if len(part) == len(found) else [1] * len(found), np.int8).tobytes()))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["item_id", "codes", "part"])

    return items.mapInArrow(run, "item_id bigint, codes binary, part binary")


def chosen_terms(words: DataFrame, index: PositionalIndex) -> DataFrame:
    """``term, item_id, place, need``: of every run of 14 words of an item the two that are rarest in the corpus, of those it has.

    ``need`` is how many of an item's must agree for an altered copy.
    """

    def every(batches):
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = np.frombuffer(data, np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(np.full(len(codes), i)), pa.array(np.arange(len(codes), dtype=np.int32))], ["term", "item_id", "place"])

    places = words.select("item_id", "codes").mapInArrow(every, "term bigint, item_id bigint, place int")
    vocabulary = places.select("term").distinct()
    often = index.lists(vocabulary, ["n"]).groupBy("term").agg(F.sum("n").alias("often"))
    rows = places.join(often, "term", "left").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("place", "term", F.coalesce("often", F.lit(0)).alias("often")))).alias("x"))
    rows = rows.join(words, "item_id").select("item_id", "x.term", "x.often", "part")

    def choose(batches):
        for b in batches:
            for i, term, often, part in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                term, often, part = np.array(term, np.int64), np.array(often, np.int64), np.frombuffer(part, np.int8)
                rank = np.where(often > 0, often, 1 << 60)
                windows = np.lib.stride_tricks.sliding_window_view(rank, PHRASE)
                at = np.unique(np.argsort(windows, axis=1, kind="stable")[:, :2] + np.arange(len(windows))[:, None])
                at = at[often[at] > 0]
                need = int(min(max(LEAST_AGREE, AGREE * (part[at] > 0).sum()), MOST_AGREE))
                cols = (pa.array(term[at]), pa.array(np.full(len(at), i)), pa.array(at.astype(np.int32)), pa.array(np.full(len(at), need, np.int32)))
                yield pa.RecordBatch.from_arrays(list(cols), ["term", "item_id", "place", "need"])

    return rows.mapInArrow(choose, "term bigint, item_id bigint, place int, need int")


# --- matches --------------------------------------------------------------------------------------------------


def agreeing_places(chosen: DataFrame, index: PositionalIndex) -> DataFrame:
    """``doc_id, item_id, low, high``: where looked-up terms agree on an item's start.

    Two that agree on the very word may lie in one run of 14; for an altered copy ``need`` of them must agree up to ``BAND`` words.
    """

    def unpack(batches):
        for b in batches:
            docs, places = ([np.frombuffer(x, k) for x in b.column(c).to_pylist()] for c, k in (("docs", np.int64), ("places", np.int32)))
            sizes = np.array([len(x) for x in docs], np.int64)
            item, place, need = (np.repeat(b.column(c).to_numpy(), sizes) for c in ("item_id", "place", "need"))
            at = np.concatenate([np.empty(0, np.int32), *places]).astype(np.int64)
            cols = (np.concatenate([np.empty(0, np.int64), *docs]), item, place, need, at - place)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "item_id", "place", "need", "start"])

    hits = index.lists(chosen, ["docs", "places"]).select("docs", "places", "item_id", "place", "need")
    hits = hits.mapInArrow(unpack, "doc_id bigint, item_id bigint, place int, need int, start bigint")
    # one exchange for both groupings
    hits = hits.repartition("doc_id", "item_id")
    span = F.max("place") - F.min("place")
    two = (span > 0) & ((span < PHRASE) | (F.count("*") > 2))
    aligned = hits.groupBy("doc_id", "item_id", "start").agg(F.count("*").alias("n"), two.alias("two"), F.max("need").alias("need"))
    # two grids of bands, half a band apart
    bands = F.array(F.floor(F.col("start") / BAND) * 2, F.floor((F.col("start") + BAND // 2) / BAND) * 2 + 1)
    met = aligned.withColumn("band", F.explode(bands)).groupBy("doc_id", "item_id", "band")
    met = met.agg(F.sum("n").alias("n"), F.max("two").alias("two"), F.max("need").alias("need"), F.min("start").alias("low"), F.max("start").alias("high"))
    return met.filter(F.col("two") | (F.col("n") >= F.col("need"))).select("doc_id", "item_id", "low", "high").distinct()


def longest_run(item: np.ndarray, text: np.ndarray) -> int:
    """The most consecutive words that both have."""
    best, run = 0, np.zeros(len(text) + 1, np.int64)
    for w in item:
        run[1:] = np.where(text == w, run[:-1] + 1, 0)
        best = max(best, int(run.max()))
    return best


def words_kept(item: np.ndarray, text: np.ndarray) -> int:
    """Words of ``item`` less the fewest words to replace, leave out or put in to find it inside ``text``."""
    step = np.arange(len(text) + 1)
    cost = np.zeros(len(text) + 1, np.int64)
    for w in item:
        take = np.minimum(cost + 1, np.concatenate([[1 << 40], cost[:-1] + (text != w)]))
        cost = np.minimum.accumulate(take - step) + step
    return len(item) - int(cost.min())


def compare(text: np.ndarray, item: np.ndarray, part: np.ndarray, low: int, high: int) -> tuple[int, bool]:
    """The longest common run, and whether it is an altered copy, where the item starts between ``low`` and ``high`` in the text."""
    slack = BAND + len(item) // 8
    text = text[max(0, low - slack) : high + len(item) + slack]
    # most places fall here: too few words of the item are there at all
    there = np.isin(item, text)
    gaps = np.flatnonzero(~np.concatenate([[False], there, [False]]))
    passage, question = item[part == 1], item[part == 2]
    core = len(passage) + len(question)
    likely = core >= NEAR_WORDS and there[part > 0].sum() >= NEAR * core and there[part == 2].sum() >= NEAR_QUESTION * len(question)
    if np.diff(gaps).max() <= PHRASE and not likely:
        return 0, False
    run = longest_run(item, text)
    if run >= PHRASE or not likely:
        return run, False
    asked = words_kept(question, text) if len(question) else 0
    return run, asked >= NEAR_QUESTION * len(question) and words_kept(passage, text) + asked >= NEAR * core


def leaked_items(docs: DataFrame, items: DataFrame, index: PositionalIndex | None = None) -> DataFrame:
    """Distinct ``(doc_id, item_id, longest)``: documents that hold an item's words, and the longest exact run.

    A document holds an item if 14 consecutive words of it occur, or if at one place its passage is found with at least
    three quarters of the words of passage and question left, and its question with seven tenths, after the fewest words are replaced, left
    out or put in (an altered copy). Words are runs of letters and digits; case, punctuation, spacing, line breaks, accent composition,
    entities and hidden characters do not matter. Items that hold the same words all count. Null ids or texts, empty texts
    and items under 14 words never match; repeated rows give one pair; other columns are not read; an empty table gives no rows;
    whole texts are searched. ``index`` is one built of ``docs`` before; without it one is built for this call.
    """
    spark = docs.sparkSession
    texts = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).filter("doc_id is not null and text <> ''")
    if index is None:
        index = PositionalIndex(spark, scratch(spark, "p9-index"))
        index.build(texts)
    slim = items.select(items["item_id"].alias("item_id"), items["item_text"].alias("text")).filter("item_id is not null and text is not null")
    words = materialize(item_words(slim.distinct()), "p9-items")
    chosen = materialize(chosen_terms(words, index).distinct(), "p9-terms")
    places = materialize(agreeing_places(chosen, index), "p9-places")

    ids = places.select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def code(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([codes_of(terms(t)).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["doc_id", "words"])

    held = texts.join(ids, "doc_id", "left_semi").mapInArrow(code, "doc_id bigint, words binary")
    joined = places.join(held, "doc_id").join(words, "item_id").select("doc_id", "item_id", "low", "high", "words", "codes", "part")

    def check(batches):
        for b in batches:
            rows = []
            for doc, item, low, high, text, codes, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                run, near = compare(np.frombuffer(text, np.uint32), np.frombuffer(codes, np.uint32), np.frombuffer(part, np.int8), low, high)
                if run >= PHRASE or near:
                    rows.append((doc, item, run))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "longest"])

    hits = joined.mapInArrow(check, "doc_id bigint, item_id bigint, longest bigint")
    return hits.groupBy("doc_id", "item_id").agg(F.max("longest").alias("longest"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item of ``eval_items``: how many documents hold it, and the longest run found; 0 where none does."""
    items = table(spark, sf_dir, "eval_items")
    hits = leaked_items(table(spark, sf_dir, "documents"), items)
    per = hits.groupBy("item_id").agg(F.count("*").alias("docs"), F.max("longest").alias("longest"))
    joined = items.select("item_id", "suite", "language").join(per, "item_id", "left")
    return joined.na.fill(0, ["docs", "longest"])
