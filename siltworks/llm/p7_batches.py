"""Problem 7: duplicates of new batches against all history by an incremental inverted index of rare prefixes.

A text is the set of its distinct runs of five words (characters in Chinese). Two texts match if more
than half of all runs of both are in both. All runs are put in one order, rarest first, fixed when the index is
started; of n runs the first ceil(n / 2) are the *long* prefix and the first n - floor(2n / 3) the *short* one. Two matching
texts share a run that is in the long prefix of the larger and in the short prefix of the smaller.

The index holds the postings of the long prefixes, packed and bucketed by run, and the records, bucketed by text. A batch is
appended and its prefixes are probed: only the batch travels, to the buckets where the history lies; what was accepted before is
neither tokenised again nor shuffled.
"""

from __future__ import annotations

import re
import zlib
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.common import bucketed_table, count_parts, level_counts, merged_levels
from siltworks.llm.words import runs, word_codes
from siltworks.session import discard, folders, materialize, scratch, spread, table

MIN_CHARS = 200
#: Least and greatest number of counters of the frequency table, a byte each; between them it has COUNTERS_EACH a record. The
#: table is what is broadcast; its number is a power of two that the index keeps from its start on.
LEAST_COUNTERS, MOST_COUNTERS, COUNTERS_EACH = 1 << 21, 1 << 26, 32
#: Least bits of a sketch per run of the text.
SKETCH = 4
#: A list of postings is split above so many times the mean counter plus a constant, into at most so many parts.
LONG, LONG_LEAST, SPLITS = 4, 64, 64
#: The counters are brought up to date whenever this share of the records has been appended since.
RECOUNT = 0.2
#: Keys up to which a lookup names them one by one, so that other buckets, row groups and pages are not read; records of a batch in which that is tried.
FEW, SMALL = 2_000, 20
#: Postings in a bucket, records in a bucket, and records of one text above which they are spread when pairs are written.
BUCKET_POSTINGS, BUCKET_RECORDS, COPIES = 4_000_000, 200_000, 20_000
#: Bits of a run's place in the index; two that meet by chance only give candidates.
SLOT_BITS = 48

_READ = "rec_id bigint, text_key bigint, n int, sketch binary, words binary, at int, part binary"
_PACKED = "bucket int, m int, slots binary, at binary, pos binary, keys binary, sizes binary"
_TABLES = {
    "postings": ("bucket INT, m INT, slots BINARY, at BINARY, pos BINARY, keys BINARY, sizes BINARY", "bucket"),
    "records": ("text_key BIGINT, rec_id BIGINT, n INT, sketch BINARY, words BINARY", "text_key"),
}


def _signature(found: np.ndarray) -> int:
    """One 64-bit number per set of runs."""
    x = found.view(np.uint64)
    mixed = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return int(np.uint64(np.bitwise_xor.reduce(mixed) + np.uint64(len(x))).view(np.int64))


def _sketch(found: np.ndarray) -> bytes:
    """The number of runs, and a bitmap of SKETCH to twice as many bits a run, of which each run sets one."""
    size = max(64, 1 << (SKETCH * len(found) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(found >> 20) & (size - 1)] = 1
    return np.int64(len(found)).tobytes() + np.packbits(bits).tobytes()


def _counted(df: DataFrame, name: str, **of: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize``, and aggregates of its rows taken by the job that writes them; a query of its own costs the driver more."""
    seen = Observation()
    written = materialize(df.observe(seen, *[x.alias(k) for k, x in of.items()]), name)
    return written, {k: n or 0 for k, n in seen.get.items()}


def read_records(df: DataFrame, counters: int, min_chars: int = MIN_CHARS) -> tuple[DataFrame, dict[str, int]]:
    """The one pass over raw texts: rows of ``_READ``, and how many ``records`` and ``runs`` they have.

    Records: ``rec_id, text_key``, and once a task for each text its number of runs, sketch and word codes. Besides, every
    task adds its counts of all runs as rows of ``at, part``.
    """

    def run(batches):
        counts, seen = np.zeros(counters, np.uint32), set()
        for b in batches:
            rows: list[tuple] = []
            every = [np.empty(0, np.int64)]
            for rec, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = word_codes(text)
                if not len(codes):
                    continue
                found = runs(codes)
                every.append(found)
                key = _signature(found)
                first = key not in seen
                seen.add(key)
                rows.append((rec, key, *((len(found), _sketch(found), codes.tobytes()) if first else (None, None, None)), None, None))
            np.add.at(counts, np.concatenate(every) & (counters - 1), 1)
            yield _batch(rows)
        yield _batch([(None, None, None, None, None, at, part) for at, part in count_parts(counts)])

    def _batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
        names = [x.split(" ")[0] for x in _READ.split(", ")]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    slim = df.select(df["rec_id"].alias("rec_id"), df["raw_content"].alias("text"))
    slim = spread(slim.filter((F.length("text") >= min_chars) & F.col("rec_id").isNotNull()))
    return _counted(slim.mapInArrow(run, _READ), "p7-records", records=F.count("rec_id"), runs=F.sum("n"))


class Order:
    """The order of runs, fixed at the start, and the counts so far, by which long lists are split; a byte a counter each.

    The length from which a list is split is fixed at the start too, so that the number of its parts never falls.
    """

    def __init__(self, first: np.ndarray, now: np.ndarray):
        self.first, self.now = first, now
        self.bound = LONG * float(level_counts(np.arange(256)) @ np.bincount(first, minlength=256)) / len(first) + LONG_LEAST

    def prefix(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The long prefix of a text's runs in their order, and into how many parts the list of each is split."""
        cell = found & (len(self.first) - 1)
        order = np.lexsort((found, self.first[cell]))[: len(found) - len(found) // 2]
        parts = np.ceil(level_counts(self.now[cell[order]]) / self.bound)
        return found[order], np.clip(parts, 1, SPLITS).astype(np.int64)


def _slot(token: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The place of a part of a run's list; part 0 is the run's own."""
    mixed = token.view(np.uint64) ^ (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mixed >> np.uint64(64 - SLOT_BITS)


def _narrow(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the greatest needs, by planes of equal weight, which compress well."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _wide(data: bytes, m: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The numbers of ``_narrow``, or some of them."""
    planes = np.frombuffer(data, np.uint8).reshape(-1, m)
    out = planes[0][at].astype(np.int64)
    for k, plane in enumerate(planes[1:], 1):
        out |= plane[at].astype(np.int64) << (8 * k)
    return out


def packed_prefixes(texts: DataFrame, order, buckets: np.ndarray, every_part: bool) -> DataFrame:
    """Rows of ``_PACKED``: the long prefixes of ``texts`` (text_key, words), per Arrow batch and bucket in the order of their slots.

    A posting is a slot, a text (by its place in ``keys`` and ``sizes``) and a position. A text is stored in one part of each run's list,
    by its key, and asks for every part. Counters never fall and with them the number of parts, so whoever asks finds what was stored
    when there were fewer. ``buckets`` are the numbers that Spark's hash sends to bucket 0, 1, 2 and so on.
    """

    def run(batches):
        for b in batches:
            slots, ats, poss = [np.empty(0, np.uint64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
            keys, sizes = b.column(0).to_numpy(zero_copy_only=False), np.zeros(b.num_rows, np.int64)
            for i, (key, data) in enumerate(zip(keys.tolist(), b.column(1).to_pylist(), strict=True)):
                found = runs(np.frombuffer(data, np.uint32))
                sizes[i] = len(found)
                token, parts = order.value.prefix(found)
                pos = np.arange(len(token), dtype=np.int32)
                if every_part:
                    pos = np.repeat(pos, parts)
                    part = np.arange(len(pos)) - np.repeat(np.cumsum(parts) - parts, parts)
                else:
                    part = (key & 0x7FFFFFFF) % parts
                slots.append(_slot(token[pos], part))
                ats.append(np.full(len(pos), i, np.int32))
                poss.append(pos)
            slot, at, pos = (np.concatenate(x) for x in (slots, ats, poss))
            del slots, ats, poss
            bucket = (slot % np.uint64(len(buckets))).astype(np.int32)
            by = np.lexsort((slot, bucket)).astype(np.int32)
            slot, at, pos, bucket = slot[by].view(np.int64), at[by], pos[by], bucket[by]
            rows = []
            for lo, hi in _spans(bucket):
                own, local = np.unique(at[lo:hi], return_inverse=True)
                step = np.diff(slot[lo:hi], prepend=0)
                rows.append((buckets[bucket[lo]], hi - lo, *map(_narrow, (step, local, pos[lo:hi])), keys[own].tobytes(), _narrow(sizes[own])))
            kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split(" ")[0] for x in _PACKED.split(", ")])

    return texts.select("text_key", "words").mapInArrow(run, _PACKED)


def _spans(values: np.ndarray):
    """Start and end of each stretch of equal values."""
    edges = np.flatnonzero(np.diff(values)) + 1
    edges = [0, *edges.tolist(), len(values)] if len(values) else []
    return zip(edges[:-1], edges[1:], strict=True)


class _Packed:
    """A packed row, of which only the slots are unpacked until more is asked for."""

    def __init__(self, m: int, slots: bytes, at: bytes, pos: bytes, keys: bytes, sizes: bytes):
        self.m, self.at, self.pos = m, at, pos
        self.slots = np.cumsum(_wide(slots, m))
        self.keys = np.frombuffer(keys, np.int64)
        self.sizes = _wide(sizes, len(self.keys))

    def postings(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, size and position of some postings."""
        text = _wide(self.at, self.m, places)
        return self.keys[text], self.sizes[text], _wide(self.pos, self.m, places)


def _meet(asked: _Packed, stored: _Packed) -> np.ndarray:
    """Distinct pairs of keys, asked first, of postings that share a slot and leave room for a match."""
    lo = np.searchsorted(stored.slots, asked.slots, "left")
    count = np.searchsorted(stored.slots, asked.slots, "right") - lo
    met = np.flatnonzero(count)
    lo, count = lo[met], count[met]
    out = [np.empty((0, 2), np.int64)]
    ends = np.cumsum(count)
    # in blocks of a bounded number of pairs
    at = 0
    while at < len(count):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, "right")))
        c = count[at:stop]
        a = np.repeat(np.arange(at, stop), c)
        b = lo[a] + np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
        (key_a, x, pos_a), (key_b, y, pos_b) = asked.postings(met[a]), stored.postings(b)
        short_a, short_b = pos_a < x - 2 * x // 3, pos_b < y - 2 * y // 3
        ok = ((x <= y) & short_a) | ((y <= x) & short_b)
        ok &= (2 * np.minimum(x, y) > np.maximum(x, y)) & (np.minimum(x - pos_a, y - pos_b) >= (x + y) // 3 + 1) & (key_a != key_b)
        out.append(_distinct(np.column_stack([key_a[ok], key_b[ok]])))
        at = stop
    return _distinct(np.concatenate(out))


def _distinct(pairs: np.ndarray) -> np.ndarray:
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])] if len(pairs) else pairs


def _may_match(a: list[bytes], b: list[bytes]) -> list[bool]:
    """Whether the sketches leave room for a match: two texts of x and y runs share (x + y - differing bits) / 2 at most."""
    keep = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        total = int(x[0]) + int(y[0])
        x, y = x[1:], y[1:]
        while len(x) > len(y):
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        while len(y) > len(x):
            y = y[: len(y) // 2] | y[len(y) // 2 :]
        differing = int(np.bitwise_count(x ^ y).sum(dtype=np.int64))
        keep.append((total - differing) // 2 >= total // 3 + 1)
    return keep


def _match(a: list[bytes], b: list[bytes]) -> list[bool]:
    keep = []
    for x, y in zip(a, b, strict=True):
        x, y = runs(np.frombuffer(x, np.uint32)), runs(np.frombuffer(y, np.uint32))
        both = len(np.intersect1d(x, y, assume_unique=True))
        keep.append(2 * both > len(x) + len(y) - both)
    return keep


@contextmanager
def _small_batches(spark: SparkSession):
    """Packed rows are large, so few of them go to Python at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4m")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class BatchIndex:
    """The index kept between batches, in a folder: postings, records, and the frequency table.

    ``start`` takes the first records, which fix the order of runs. ``add`` appends a batch and gives the pairs of texts of it, and of it
    with everything accepted before. A text is indexed once, however many batches bring it.
    """

    def __init__(self, spark: SparkSession, folder: str, min_chars: int = MIN_CHARS):
        self.spark, self.folder, self.min_chars = spark, folder.rstrip("/"), min_chars
        self._order: Order | None = None
        self._sent_order: tuple[Order | None, object] = (None, None)
        self._steps: list[DataFrame] = []

    # state

    def _step(self, df: DataFrame, name: str) -> DataFrame:
        """``materialize``, to be deleted by ``forget``."""
        self._steps.append(materialize(df, name))
        return self._steps[-1]

    def forget(self) -> None:
        """Delete the steps written for the batches so far; what ``add`` gave must have been written by then, ``pairs`` and ``classes`` are."""
        while self._steps:
            discard(self._steps.pop())

    @cached_property
    def buckets(self) -> dict[str, int]:
        return self.spark.read.json(f"{self.folder}/buckets").first().asDict()

    @cached_property
    def bucket_ids(self) -> np.ndarray:
        """For every bucket of the postings the least number that Spark's hash sends there."""
        n = self.buckets["postings"]
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
        least = self.spark.range(n * (20 + n.bit_length())).groupBy(at.alias("at")).agg(F.min("id").alias("id")).collect()
        assert len(least) == n
        return np.array([r["id"] for r in sorted(least)], np.int64)

    def _table(self, kind: str) -> str:
        return bucketed_table(self.spark, f"{self.folder}/{kind}", *_TABLES[kind], self.buckets[kind])

    def _insert(self, kind: str, rows: DataFrame) -> None:
        self._sent(kind, rows).write.insertInto(self._table(kind))

    def _count_runs(self, records: DataFrame, own: int) -> Order:
        """Keep a batch's counts of runs; the order, with all counts once a share of the records has been added since the last time."""
        if self._order is None:
            self._read_order()
        parts = records.filter("part is not null").select("at", "part")
        parts.write.parquet(f"{self.folder}/counts/batch={self._batches}/records={own}")
        self._batches, self._records = self._batches + 1, self._records + own
        if self._order is None:  # the first records
            self._read_order()
        elif self._records > (1 + RECOUNT) * self._counted:
            every = self.spark.read.schema("at int, part binary").parquet(*folders(self.spark, f"{self.folder}/counts/*/*"))
            now = merged_levels(every, len(self._order.first))
            self._order, self._counted = Order(self._order.first, np.maximum(now, self._order.now)), self._records
        return self._order

    def _broadcast(self, order: Order):
        """The order as a broadcast, the same as long as the order is."""
        if self._sent_order[0] is not order:
            self._sent_order = order, self.spark.sparkContext.broadcast(order)
        return self._sent_order[1]

    def _read_order(self) -> None:
        """The order and the number of batches and records so far, as this or another session left them."""
        seen = dict(re.search(r"batch=(\d+)/records=(\d+)$", x).groups() for x in folders(self.spark, f"{self.folder}/counts/*/*"))
        seen = {int(k): int(n) for k, n in seen.items()}
        self._batches, self._records = len(seen), sum(seen.values())
        if seen:
            self._counted = seen[0]
            first = self.spark.read.schema("at int, part binary").parquet(f"{self.folder}/counts/batch=0")
            levels = merged_levels(first, self.buckets["counters"])
            self._order = Order(levels, levels)

    def _rows(self, kind: str, keys: DataFrame, small: bool) -> DataFrame:
        """The rows of a table for ``keys`` (of one column, its bucketing one).

        In a small batch few keys are named in the query, so that other buckets, row groups and pages are not read. Else the keys travel to the
        buckets; the table is scanned where it lies and never shuffled.
        """
        by = _TABLES[kind][1]
        stored = self.spark.table(self._table(kind))
        few = [r[0] for r in keys.distinct().limit(FEW + 1).collect()] if small else None
        if few is not None and len(few) <= FEW:
            return stored.filter(F.col(by).isin(few)) if few else stored.limit(0)
        # as many partitions as buckets, as Spark would else shuffle the table to the keys
        return stored.join(self._sent(kind, keys.toDF(by)).distinct().hint("shuffle_hash"), by, "left_semi")

    def _sent(self, kind: str, rows: DataFrame, key: str | None = None) -> DataFrame:
        """Rows sent to the buckets of a table: a join or grouping by ``key`` then needs no further exchange."""
        return rows.repartition(self.buckets[kind], key or _TABLES[kind][1])

    # steps

    def start(self, accepted: DataFrame) -> None:
        """Index the records from which the order of runs is taken."""
        counters = 1 << (COUNTERS_EACH * accepted.count()).bit_length()
        counters = min(max(counters, LEAST_COUNTERS), MOST_COUNTERS)
        records, seen = read_records(accepted, counters, self.min_chars)
        own = seen["records"]
        cores = self.spark.sparkContext.defaultParallelism
        sizes = (max(cores, seen["runs"] // 2 // BUCKET_POSTINGS), max(cores, own // BUCKET_RECORDS), counters)
        self.spark.createDataFrame([sizes], "postings int, records int, counters int").coalesce(1).write.mode("overwrite").json(f"{self.folder}/buckets")
        self.buckets = dict(zip(("postings", "records", "counters"), sizes, strict=True))
        shared = self._broadcast(self._count_runs(records, own))
        texts = records.filter("words is not null")
        self._insert("postings", packed_prefixes(texts, shared, self.bucket_ids, False))
        self._insert("records", records.filter("rec_id is not null").select("text_key", "rec_id", "n", "sketch", "words"))
        discard(records)

    def add(self, batch: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        """Append a batch; ``links`` (key_a, key_b) of its texts with other texts, its members (rec_id, text_key), and whether it is small."""
        records, seen = read_records(batch, self.buckets["counters"], self.min_chars)
        self._steps.append(records)
        own = records.filter("rec_id is not null").select("rec_id", "text_key")
        n = seen["records"]
        small = n <= SMALL
        shared = self._broadcast(self._count_runs(records, n))
        once = self._sent("records", records.filter("words is not null").select("text_key", "n", "sketch", "words")).dropDuplicates(["text_key"])
        known = self._rows("records", once.select("text_key"), small).select("text_key").distinct().withColumn("known", F.lit(True))
        texts = self._step(once.join(known.hint("shuffle_hash"), "text_key", "left"), "p7-texts")
        new = texts.filter("known is null").select("text_key", F.lit(None).cast("bigint").alias("rec_id"), "n", "sketch", "words")
        none = [F.lit(None).cast(k).alias(c) for c, k in (("n", "int"), ("sketch", "binary"), ("words", "binary"))]
        rows = {"postings": packed_prefixes(new, shared, self.bucket_ids, False), "records": own.select("text_key", "rec_id", *none).union(new)}
        with ThreadPoolExecutor(2) as jobs:  # neither waits for the other
            list(jobs.map(lambda kind: self._insert(kind, rows[kind]), rows))
        return self._links(texts, shared, small), own, small

    def _links(self, texts: DataFrame, order, small: bool) -> DataFrame:
        asked = packed_prefixes(texts, order, self.bucket_ids, True)
        stored = self.spark.table(self._table("postings"))
        if small:
            asked = self._step(asked, "p7-asked")
            stored = self._rows("postings", asked.select("bucket"), True)
        names = [x.split(" ")[0] for x in _PACKED.split(", ")][1:]
        asked = asked.select("bucket", *[F.col(c).alias(f"{c}_a") for c in names])

        def run(batches):
            last, have = None, None
            for x in batches:
                for i in range(x.num_rows):  # one row at a time, as each is large
                    a, b = ([x.column(f"{k}{end}")[i].as_py() for k in names] for end in ("_a", ""))
                    if a != last:
                        last, have = a, _Packed(*a)
                    both = _meet(have, _Packed(*b))
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["key_a", "key_b"])

        met = stored.join(asked.hint("shuffle_hash"), "bucket").drop("bucket").mapInArrow(run, "key_a bigint, key_b bigint")
        with _small_batches(self.spark):
            pairs = self._step(met.distinct(), "p7-pairs")
        likely = self._both(pairs, texts, "sketch", _may_match, small)
        if small:  # its keys are named, which reads it once more
            likely = self._step(likely, "p7-likely")
        return self._both(likely, texts, "words", _match, small).distinct()

    def _both(self, pairs: DataFrame, texts: DataFrame, column: str, keep, small: bool) -> DataFrame:
        """The pairs for whose two values of ``column`` ``keep`` holds; the batch's come from ``texts``, the others from the index."""
        a = texts.select(F.col("text_key").alias("key_a"), F.col(column).alias("of_a"))
        stored = self._rows("records", pairs.select("key_b"), True) if small else self.spark.table(self._table("records"))
        b = stored.filter(F.col(column).isNotNull()).select(F.col("text_key").alias("key_b"), F.col(column).alias("of_b"))

        def check(batches):
            for x in batches:
                mask = pa.array(keep(x.column("of_a").to_pylist(), x.column("of_b").to_pylist()), pa.bool_())
                yield pa.RecordBatch.from_arrays([x.column(c).filter(mask) for c in ("key_a", "key_b")], ["key_a", "key_b"])

        joined = b.join(self._sent("records", pairs.join(a, "key_a"), "key_b").hint("shuffle_hash"), "key_b").select("key_a", "key_b", "of_a", "of_b")
        return joined.mapInArrow(check, "key_a bigint, key_b bigint")

    def pairs(self, batch: DataFrame) -> DataFrame:
        """``add``, and the records behind it, written: ``rec_id_a, rec_id_b`` (smaller first), one of them in the batch."""
        links, own, small = self.add(batch)
        same = own.select(F.col("text_key").alias("key_a"), F.col("text_key").alias("key_b")).distinct()
        links = self._step(links.union(same), "p7-links")
        asked = own.select(F.col("text_key").alias("key_a"), F.col("rec_id").alias("x")).join(links, "key_a").select("key_b", "x")
        if self._records <= COPIES:  # no text has more copies than there are records
            stored = self._rows("records", links.select("key_b"), True) if small else self.spark.table(self._table("records"))
            members = stored.filter("rec_id is not null").select(F.col("text_key").alias("key_b"), F.col("rec_id").alias("y"))
            both = members.join(self._sent("records", asked, "key_b").hint("shuffle_hash"), "key_b")
        else:
            members = self._rows("records", links.select("key_b"), small).filter("rec_id is not null").select("text_key", "rec_id")
            members, seen = _counted(members.distinct(), "p7-members", records=F.count("rec_id"))
            self._steps.append(members)
            members = members.select(F.col("text_key").alias("key_b"), F.col("rec_id").alias("y"))
            by = ["key_b"]
            if seen["records"] > COPIES:
                asked, members, by = *self._spread_copies(asked, members), ["key_b", "way"]
            both = asked.join(members, by)
        both = both.filter("x <> y").select(F.least("x", "y").alias("rec_id_a"), F.greatest("x", "y").alias("rec_id_b"))
        return materialize(both.distinct(), "p7-batch")

    @staticmethod
    def _spread_copies(asked: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both with a column ``way``, by which the records of a text with very many copies are spread."""
        large = members.groupBy("key_b").agg(F.ceil(F.count("*") / COPIES).cast("int").alias("ways")).filter("ways > 1")
        ways = F.coalesce("ways", F.lit(1))
        members = members.join(large, "key_b", "left").select("key_b", "y", F.pmod(F.xxhash64("y"), ways).cast("int").alias("way"))
        asked = asked.join(large, "key_b", "left").select("key_b", "x", F.explode(F.sequence(F.lit(0), ways - 1)).alias("way"))
        return asked, members

    def classes(self, batch: DataFrame) -> DataFrame:
        """``add``, one row per record of the batch that counts, written: ``rec_id, class_id, copies, links``.

        ``class_id`` is the same for records of one text, ``copies`` how many other records have that text, ``links`` how many records
        have another text that matches.
        """
        links, own, small = self.add(batch)
        links = self._step(links, "p7-links")
        keys = own.select("text_key").union(links.select("key_b")).distinct()
        sizes = self._rows("records", keys, small).filter("rec_id is not null").select("text_key", "rec_id").distinct().groupBy("text_key").agg(F.count("*").alias("records"))
        sizes = self._step(sizes, "p7-sizes")
        linked = links.join(sizes.withColumnRenamed("text_key", "key_b"), "key_b").groupBy("key_a").agg(F.sum("records").alias("links"))
        mine = own.distinct().join(sizes, "text_key").join(linked.withColumnRenamed("key_a", "text_key"), "text_key", "left")
        mine = mine.select("rec_id", F.col("text_key").alias("class_id"), (F.col("records") - 1).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))
        return materialize(mine, "p7-batch")


def batches_of(incoming: DataFrame) -> list[DataFrame]:
    """The batches in their order; records without ``batch_no`` come last. One number a batch reaches the driver."""
    if "batch_no" not in incoming.columns:
        return [incoming]
    numbers = sorted((r[0] for r in incoming.select("batch_no").distinct().collect()), key=lambda x: (x is None, x))
    return [incoming.filter(F.col("batch_no").eqNullSafe(F.lit(n))) for n in numbers]


def batch_duplicates(accepted: DataFrame, incoming: DataFrame, min_chars: int = MIN_CHARS, how: str = "pairs") -> DataFrame:
    """Distinct ``(rec_id_a, rec_id_b)``, smaller first: matching records, at least one of them in ``incoming``.

    ``accepted`` is indexed once; then batch after batch (``batch_no``) is appended and probed, so a pair comes out with its later
    batch. With ``how="classes"`` the rows are those of ``BatchIndex.classes`` instead, as of each record's own batch. ``digest`` and all other
    columns are not read. Null ids, null texts, texts under ``min_chars`` characters and texts without words never match; a repeated row
    (same id) does not match itself; an empty table gives no rows. Whole texts are compared, at any length.
    """
    spark = incoming.sparkSession
    index = BatchIndex(spark, scratch(spark, "p7-index"), min_chars=min_chars)
    index.start(accepted)
    found = None
    for batch in batches_of(incoming):
        rows = getattr(index, how)(batch)
        index.forget()
        found = rows if found is None else found.union(rows)
    if found is None:
        kinds = "rec_id_a bigint, rec_id_b bigint" if how == "pairs" else "rec_id bigint, class_id bigint, copies bigint, links bigint"
        found = spark.createDataFrame([], kinds)
    return found.distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_duplicates(table(spark, sf_dir, "accepted_docs"), table(spark, sf_dir, "incoming_docs"))


def p7_record_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per incoming record that counts: its class, copies and linked records, without expanding groups into pairs."""
    return batch_duplicates(table(spark, sf_dir, "accepted_docs"), table(spark, sf_dir, "incoming_docs"), how="classes")
