"""Problem 10: texts that were cut off.

Two kinds of evidence meet. Lengths: in each source, the hazard of ending at a length (texts of that
length over texts at least as long) is tested against the hazards of the lengths around it, in characters and in
bytes; false discovery is controlled over all tests. Endings: a logistic model tells the last line of
a complete text from one that breaks off; it is trained here, on cuts made by ourselves in complete sentences
of a bounded sample, against last lines of texts whose length is not suspicious.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.common import discovery_limit, with_bin
from siltworks.session import materialize, table

FALSE_DISCOVERY = 0.01
#: Lengths on either side that a hazard is compared with, and the widths of hazard that are tested (cuts at words scatter).
NEIGHBOURS, WIDTHS = 60, (1, 12)
#: Texts the model of endings is trained on, and lines of each in which cuts are made; its features are hashed to so many weights.
TRAIN_TEXTS, TRAIN_LINES, WEIGHTS = 6_000, 6, 1 << 18
#: Lengths of a source that go through one task; the windows of its neighbours reach in from either side.
BLOCK = 1_024
#: Probability of a break above which an ending counts as cut: anywhere, and at a significant length or before a mark.
CUT_ANYWHERE, CUT_AT_LENGTH = 0.35, 0.25

_END = r"[.!?。！？؟][\"”»“’'«)\]]*"
_COMPLETE = re.compile(_END + r"$")
_MARK = re.compile(r"\s*(?:\.\.\.|…|\[(?:\.\.\.|…)\])$")
#: A sentence that ends inside a line, not an initial or a list number.
_INNER = re.compile(r"(?<=[^\W_]{2})" + _END + r"(?=\s|[^\s\x00-ɏ])\s*|(?<=[)\]»”])[.!?](?=\s)\s*")
_WORD = re.compile(r"[^\W_]+")


def ending(text: str) -> tuple[bool, bool, str, str]:
    """``complete`` (ends a sentence), ``marked`` (a mark of omission follows), last line, and the line before."""
    body = text.rstrip()
    mark = _MARK.search(body)
    if mark:
        body = body[: mark.start()].rstrip()
    head, _, last = body.rpartition("\n")
    return bool(_COMPLETE.search(body)), bool(mark), last.strip(), head.rstrip().rpartition("\n")[2].strip()


def features(last: str, before: str) -> list[int]:
    """Hashed features of a last line that does not end a sentence."""
    ends = [m.end() for m in _INNER.finditer(last)]
    piece = last[ends[-1] :] if ends else last
    words = _WORD.findall(piece)
    low = [w.lower() for w in words]
    n = len(words)
    out = [
        f"inner{bool(ends)}",
        f"n{min(n, 30)}",
        f"chars{min(len(piece) // 5, 30)}",
        f"end1{piece[-1:].lower()}",
        f"end2{piece[-2:].lower()}",
        f"end3{piece[-3:].lower()}",
        f"last{low[-1] if low else ''}",
        f"last2{' '.join(low[-2:])}",
        f"first{low[0] if low else ''}",
        f"first2{' '.join(low[:2])}",
        f"first3{' '.join(low[:3])}",
        f"begin{piece[:1].isupper()}{piece[:1].islower()}{piece[:1].isdigit()}{piece[:1] if not piece[:1].isalnum() else ''}",
        f"case{words[-1][:1].isupper() if words else ''}{piece[-1:].isalnum()}{bool(ends)}",
        f"colon{':' in piece or '：' in piece}{bool(ends)}",
        f"comma{piece.count(',') + piece.count('，') > 0}{n > 8}",
        f"before{before[-1:] if not before[-1:].isalnum() else 'x'}{piece[:1].islower()}",
    ]
    if re.search(r"https?:|www\.|\w\.\w+/", piece):
        out.append("url")
    out += [f"has{c}" for c in "/|=\t(){}<>@#–»“" if c in piece]
    out += [f"w{w}" for w in set(low)]
    if piece and not piece[-1].isascii():
        out += [f"g{piece[i : i + 2]}" for i in range(max(0, len(piece) - 6), len(piece) - 1)] + [f"b{piece[:2]}", f"b{piece[:3]}"]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & (WEIGHTS - 1) for x in out]


#: Rows a feature must occur in to get a weight; weight of a last line that follows a sentence in its line, many of which are cut.
MIN_ROWS, DOUBTFUL = 5, 0.15


def train(texts: list[tuple[str, bool, str | None]], seed: int = 7) -> np.ndarray:
    """Weights from ``(text, at a significant length, title)``.

    Breaks: our own cuts in the first ``TRAIN_LINES`` prose lines of a text, half of them in the first sentence. Complete: last lines of other texts, and titles.
    """
    rng = np.random.default_rng(seed)
    rows: dict[tuple[str, str], tuple[int, float]] = {}
    for text, suspicious, title in texts:
        complete, marked, last, before = ending(text)
        if not complete and not marked and not suspicious and last:
            doubtful = any(_WORD.search(last[m.end() :]) for m in list(_INNER.finditer(last))[-1:])
            rows.setdefault((last, before), (0, DOUBTFUL if doubtful else 1.0))
        if title and not _COMPLETE.search(title.strip()):
            rows.setdefault((title.strip(), "."), (0, 1.0))
        lines = [x.strip() for x in text.split("\n")]
        prose = [(i, x) for i, x in enumerate(lines[:-1] if not complete else lines) if _COMPLETE.search(x) and len(x) > 20]
        for i, line in prose[:TRAIN_LINES]:
            first = _INNER.search(line)
            stop = first.start() if first and first.start() > 4 and rng.random() < 0.5 else len(line) - 1
            at = int(rng.integers(2, stop))
            if rng.random() < 0.3 and " " in line[:at]:  # at a word
                at = line.rfind(" ", 0, at + 1)
            cut = line[:at].rstrip()
            if cut and not _COMPLETE.search(cut) and not _MARK.search(cut):
                rows.setdefault((cut, lines[i - 1] if i else ""), (1, 1.0))
    weights = np.zeros(WEIGHTS + 1)
    y = np.array([label for label, _ in rows.values()], float)
    if not rows or y.min() == y.max():
        return weights
    found = [features(*key) for key in rows]
    often = np.bincount(np.concatenate([np.unique(f) for f in found]), minlength=WEIGHTS + 1) >= MIN_ROWS
    width = max(map(len, found))
    x = np.full((len(rows), width + 1), WEIGHTS, np.int64)  # the last weight is the intercept
    mask = np.zeros((len(rows), width + 1))
    mask[:, -1] = 1
    for i, f in enumerate(found):
        x[i, : len(f)] = f
        mask[i, : len(f)] = often[f]
    balance = np.array([w for _, w in rows.values()]) * np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    squares = np.full(WEIGHTS + 1, 1e-3)
    for _ in range(5):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            z = (weights[x[part]] * mask[part]).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * balance[part]
            step = np.bincount(x[part].ravel(), (error[:, None] * mask[part]).ravel(), WEIGHTS + 1) / len(part)
            touched = np.flatnonzero(step)
            squares[touched] += step[touched] ** 2
            weights[touched] -= 0.3 * step[touched] / np.sqrt(squares[touched]) + 1e-4 * weights[touched]
    return weights


def probability(weights: np.ndarray, last: str, before: str) -> float:
    z = weights[-1] + weights[features(last, before)].sum()
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def significant_lengths(docs: DataFrame, fdr: float = FALSE_DISCOVERY, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``source, unit, length``: lengths (``chars`` or ``bytes``) at which too many texts of a source end.

    Copies of a text count once. Windows run over the distinct lengths of a source, never over its rows, and in blocks of
    ``BLOCK`` lengths with their neighbours on both sides, so that a source with many lengths is spread.
    """
    slim = docs.select(docs["source"].alias("source"), docs["text"].alias("text")).filter("text <> ''")
    sized = slim.select(
        "source",
        F.xxhash64("text").alias("copy"),
        F.explode(
            F.array(
                F.struct(F.lit("chars").alias("unit"), F.length("text").alias("length")),
                F.struct(F.lit("bytes").alias("unit"), F.octet_length("text").alias("length")),
            )
        ).alias("x"),
    ).select("source", "copy", "x.unit", "x.length")
    counts = sized.distinct().groupBy("source", "unit", "length").agg(F.count("*").alias("n"))
    counts = materialize(counts, "p10-lengths")
    counts = counts.withColumn("block", F.floor(F.col("length") / BLOCK))
    # texts at risk: those of later blocks, and those of the own block that are as long
    blocks = counts.groupBy("source", "unit", "block").agg(F.sum("n").alias("total"))
    later = F.sum("total").over(W.partitionBy("source", "unit").orderBy("block").rowsBetween(1, W.unboundedFollowing))
    blocks = blocks.select(F.col("source").alias("s"), F.col("unit").alias("u"), F.col("block").alias("b"), F.coalesce(later, F.lit(0)).alias("later"))
    same = counts["source"].eqNullSafe(blocks["s"]) & (counts["unit"] == blocks["u"]) & (counts["block"] == blocks["b"])
    inside = F.sum("n").over(W.partitionBy("source", "unit", "block").orderBy("length").rangeBetween(0, W.unboundedFollowing))
    base = counts.join(blocks, same).withColumn("risk", inside + F.col("later")).drop("s", "u", "b", "later")
    reach = neighbours + max(WIDTHS)
    first, last = F.floor((F.col("length") - reach) / BLOCK), F.floor((F.col("length") + reach) / BLOCK)
    base = base.withColumnRenamed("block", "own").withColumn("block", F.explode(F.sequence(first, last)))
    order = W.partitionBy("source", "unit", "block").orderBy("length")
    tests = None
    for width in WIDTHS:
        own = order.rangeBetween(1 - width, 0)
        around = order.rangeBetween(1 - width - neighbours, neighbours)
        k = F.sum("n").over(own)
        # expected at the hazard of the lengths around, per length and text at risk; half a text is added
        near = F.sum("n").over(around) - k + 0.5
        expected = near / (2 * neighbours) * width * F.col("risk") / F.max("risk").over(around)
        g = F.when(k > expected, 2 * (k * F.log(k / expected) - (k - expected))).otherwise(0.0)
        one = base.select("source", "unit", "length", "block", "own", F.lit(width).alias("width"), k.alias("k"), g.alias("g"))
        one = one.filter(F.col("block") == F.col("own")).drop("block", "own")
        tests = one if tests is None else tests.union(one)
    tests = materialize(with_bin(tests.filter("k > 1")), "p10-tests")
    limit = discovery_limit(tests, fdr)
    found = tests.filter((F.col("bin") >= limit) & (F.col("k") >= 3))
    spread = found.select("source", "unit", F.explode(F.sequence(F.col("length") - F.col("width") + 1, F.col("length"))).alias("length"))
    return spread.distinct()


def endings(docs: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """``doc_id, source, complete, marked, probability, at_length`` of every row of ``docs``.

    ``probability`` is null for complete or blank endings. ``at_length``: the text's length is significant in its source.
    """
    spark = docs.sparkSession
    slim = docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), docs["text"].alias("text"), docs["title"].alias("title"))
    lengths = materialize(significant_lengths(docs) if lengths is None else lengths, "p10-significant")
    marks = [lengths.filter(F.col("unit") == u).select(F.col("source").alias("s"), F.col("length").alias(u)) for u in ("chars", "bytes")]

    def flagged(df: DataFrame) -> DataFrame:
        """``df`` with chars and bytes, and ``at_length``; sources and lengths are joined null-safe."""
        for m, u in zip(marks, ("chars", "bytes"), strict=True):
            m = m.withColumn(f"at_{u}", F.lit(True)).withColumnRenamed(u, f"{u}_")
            df = df.join(m, df["source"].eqNullSafe(m["s"]) & (df[u] == m[f"{u}_"]), "left").drop("s", f"{u}_")
        return df.withColumn("at_length", F.coalesce("at_chars", "at_bytes", F.lit(False))).drop("at_chars", "at_bytes")

    sized = slim.filter("text <> ''").withColumns({"chars": F.length("text"), "bytes": F.octet_length("text")})
    # distinct texts with the least hashes, as copies would crowd out the others: first those below a bound that leaves about
    # 1.3 times as many as wanted, so that no task gets more than that to sort
    grain = 1_000_000
    bound = min(grain, 1 + int(1.3 * TRAIN_TEXTS * grain / max(1, sized.select(F.xxhash64("text")).distinct().count())))
    draw = F.pmod(F.xxhash64("text"), F.lit(grain))
    drawn = sized.withColumn("draw", draw).filter(F.col("draw") < bound)
    drawn = drawn.groupBy("draw", "text", "chars", "bytes").agg(F.min(F.struct("doc_id", "source", "title")).alias("x"))
    sample = drawn.select("draw", "text", "chars", "bytes", "x.*").orderBy("draw", "doc_id").limit(TRAIN_TEXTS)
    weights = spark.sparkContext.broadcast(train([tuple(r) for r in flagged(sample).select("text", "at_length", "title").collect()]))

    def run(batches):
        w = weights.value
        for b in batches:
            complete, marked, probs, chars, size = [], [], [], [], []
            for t in b.column(2).to_pylist():
                done, mark, last, before = ending(t or "")
                complete.append(done)
                marked.append(mark)
                probs.append(None if done or not last else probability(w, last, before))
                chars.append(len(t or ""))
                size.append(len((t or "").encode("utf-8", "surrogatepass")))
            cols = [pa.array(complete), pa.array(marked), pa.array(probs, pa.float64()), pa.array(chars, pa.int32()), pa.array(size, pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["doc_id", "source", "complete", "marked", "probability", "chars", "bytes"])

    scored = slim.drop("title").mapInArrow(run, "doc_id bigint, source string, complete boolean, marked boolean, probability double, chars int, bytes int")
    return flagged(scored)


def cut_texts(docs: DataFrame) -> DataFrame:
    """``endings`` and ``cut``: whether the text was cut off.

    A text is cut if it does not end a sentence and its ending is likely a break: more likely than ``CUT_ANYWHERE``, or
    than ``CUT_AT_LENGTH`` where its length is significant in its source or a mark of omission follows. Null, empty and blank
    texts are not cut; a null source is a source of its own; repeated rows each come out; whole texts are
    read, other columns not.
    """
    likely = F.when(F.col("at_length") | F.col("marked"), F.col("probability") > CUT_AT_LENGTH).otherwise(F.col("probability") > CUT_ANYWHERE)
    return endings(docs).withColumn("cut", F.coalesce(~F.col("complete") & likely, F.lit(False)))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_texts(table(spark, sf_dir, "documents")).filter("cut").select("doc_id").distinct()


def p10_cut_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, cut ones, their rate, and how many of these end at a significant length."""
    cut = cut_texts(table(spark, sf_dir, "documents"))
    return cut.groupBy("source").agg(
        F.count("*").alias("docs"),
        F.count_if("cut").alias("cut"),
        (F.count_if("cut") / F.count("*")).alias("rate"),
        F.count_if(F.col("cut") & F.col("at_length")).alias("cut_at_length"),
    )
