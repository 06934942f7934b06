"""Problem 4: main content of pages by a style tree per site.

A page's text has lost its markup, so the tree is built from its lines. Below the site stand blocks (a heading and the lines it leads to), in
them presentation nodes (what a line looks like: its label, its tail, its mask, the parts between separators) and below those
content nodes (what it says). The pages of one host are merged into one tree, copies of a page once.

Importance is entropy, inherited down a branch. A content node that stands evenly on many pages says nothing about the page: its importance is what it
tells, the logarithm of the number of pages less the entropy of its lines over pages. That of a presentation node is the entropy of the contents
below it, as a share of the most that so many contents can have: bylines repeat their names, headlines of the same form do not. A label or
tail is text besides, and has low importance whatever varies around it where that text is spread over many pages. Lines on a
branch with an unimportant node are the template; so are teasers in a block whose heading mostly leads to teasers in the merged tree.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.urls import bare_host
from siltworks.llm.p6_repeated import drop_lines
from siltworks.session import materialize, spread, table

#: A node counts from so many distinct pages, and is unimportant where it tells no more about the page than being on this share of its
#: host's pages does (the logarithm of its inverse).
LEAST_PAGES, SHARE = 3, 0.03
#: A presentation node is important above this normalised entropy of its contents.
VARIED = 0.97
#: The fixed text of a label, and of a tail, makes its node unimportant from this share of its host's pages, whatever varies around it.
LABEL_SHARE, TAIL_SHARE = 0.1, 0.25
#: Kinds of nodes: what lines say; masks; labels; tails; last words after a break, which count by their fixed text alone.
CONTENT, MASK, LABEL, TAIL, WORD = range(5)
_KINDS = {"c": CONTENT, "p": CONTENT, "m": MASK, "l": LABEL, "t": TAIL, "w": WORD}
#: Share of teasers among the lines that follow a heading of teasers.
TEASERS = 0.55
#: Pages of a host that go through one task with a copy of its tree; a larger host has more copies.
PAGES = 2_000

#: Hosts of several copies up to which their list is broadcast (their names, some 100 bytes each); beyond, it is joined by a shuffle.
BROADCAST_HOSTS = 100_000

#: Characters above which a line that ends a sentence is a paragraph.
PROSE = 130

_DIGITS = re.compile(r"\d+")
_OTHERS = re.compile(r"[\W_]+")
#: The same for texts of ASCII only, which are looked up faster.
_ASCII = {i: None for i in range(128) if not chr(i).isalnum()}
_END = re.compile(r"[.!?。！？؟…][\"”»“’'«)\]]*$")
_LABEL = re.compile(r"^\W*((?:[^\W_]+[ '\-]?){1,3})\s?[:：]\s?\S")
_PARTS = re.compile(r"\s+[|»>›/·•–—-]\s+|\s{2,}|\s*[|»›·•]\s*|\t")
_MAY_PART = re.compile(r"[|»>›/·•–—\t-]|\s\s")
_WORDS = re.compile(r"[^\W_]+")
_CUT = re.compile(r"(?:\.\.\.|…|\[…\]|\[\.\.\.\])")
_HAN = re.compile(r"[㐀-鿿]")


def key(text: str) -> str:
    """A line in lower case, digit runs as 0, without all but letters and digits."""
    text = _DIGITS.sub("0", text.lower())
    return text.translate(_ASCII) if text.isascii() else _OTHERS.sub("", text)


class Line:
    """What the tree needs to know of a line."""

    __slots__ = ("cut", "ended", "key", "marks", "nodes", "parts", "size", "teaser")

    def __init__(self, line: str):
        text = line.strip()
        self.key = key(text)
        stop = bool(_END.search(text[-6:]))
        if len(text) > PROSE and stop and not _CUT.search(text[-6:]):
            # a paragraph: only what it says can make it part of the template
            self.cut, self.ended, self.teaser, self.size = False, True, False, 99
            self.nodes, self.parts = [], []
            return
        words = _WORDS.findall(text)
        han = 0 if text.isascii() else len(_HAN.findall(text))
        self.size = len(words) + han // 2
        cuts = "..." in text or "…" in text
        self.ended = stop and not (cuts and _CUT.search(text[-4:]))
        self.cut = cuts and not self.ended and bool(_CUT.search(text[len(text) // 3 :]))
        nodes = []
        label = _LABEL.match(text) if ":" in text or "：" in text else None
        if label:
            nodes.append("l:" + key(label.group(1)))
        if not self.ended and len(words) > 3:
            nodes.append("t:" + key(" ".join(words[-2:])) if not han else "t:" + key(text)[-4:])
            if not han and cuts:
                nodes.append("w:" + key(words[-1]))
        if len(words) <= 14 and not han:
            mask = [_mask(w) for w in words]
            # a word between numbers is a month
            mask = ["x" if 0 < i < len(mask) - 1 and mask[i - 1] == mask[i + 1] == "0" else m for i, m in enumerate(mask)]
            if sum(m not in ("x", "0") for m in mask) >= 1:
                nodes.append("m:" + " ".join(_squeeze(mask)))
        elif han and self.size <= 12:
            nodes.append("m:" + _DIGITS.sub("0", text)[:6])
        self.nodes = nodes
        parts = [key(p) for p in _PARTS.split(text)] if self.size <= 60 and _MAY_PART.search(text) else []
        self.parts = [p for p in parts if p] if len(parts) > 1 else []
        #: a heading or a text that breaks off
        self.teaser = self.cut or (not self.ended and 2 <= self.size <= 16)


def _mask(word: str) -> str:
    return "0" if word.isdigit() else "x" if word[:1].isupper() else word.lower()


def _squeeze(mask: list[str]) -> list[str]:
    return [m for i, m in enumerate(mask) if not i or m != mask[i - 1] or m not in ("x", "0")]


@lru_cache(maxsize=100_000)
def _short(text: str) -> Line:
    return Line(text)


def read_lines(text: str) -> list[Line | None]:
    """A ``Line`` per line, None for blank ones."""
    out = []
    for raw in text.split("\n"):
        raw = raw.strip()
        line = None if not raw else _short(raw) if len(raw) <= PROSE else Line(raw)
        out.append(line if line is not None and line.key else None)
    return out


def page_nodes(text: str, title: str | None) -> tuple[dict[str, tuple[int, int]], set[tuple[str, str]], Counter]:
    """Nodes of a page: for each, how many of its lines are followed by a line, and how many of those by a teaser; its presentation
    nodes, each with every content node below it; and how often each content node stands on it."""
    lines = [x for x in read_lines(text) if x]
    own = key(title) if title else ""
    out: dict[str, tuple[int, int]] = {}
    times: Counter = Counter()
    below = {(node, "c:" + line.key) for line in lines for node in line.nodes}
    for i, line in enumerate(lines):
        after = lines[i + 1] if i + 1 < len(lines) else None
        plain = after is not None and not (own and own in after.key)
        follows, teases = int(plain), int(plain and after.teaser)
        times["c:" + line.key] += 1
        for node in {"c:" + line.key, *line.nodes}:
            a, b = out.get(node, (0, 0))
            out[node] = (a + follows, b + teases)
        for part in set(line.parts):
            out.setdefault("p:" + part, (0, 0))
            times["p:" + part] += 1
    return out, below, times


def template_lines(text: str, title: str | None, known: dict[str, bool]) -> list[int]:
    """Positions of the template's lines; ``known`` holds the host's unimportant nodes, True for headings of teasers."""
    lines = read_lines(text)
    own = key(title) if title else ""
    out = []
    teasing = False
    for at, line in enumerate(lines):
        if line is None:
            continue
        content = "c:" + line.key
        hit = content in known
        if own and line.key == own and not hit:
            teasing = False
            continue
        parts = [("p:" + p) in known for p in line.parts]
        crumb = bool(own) and line.key != own and line.key.endswith(own) and len(line.parts) > 1
        style = any(n in known for n in line.nodes) and not (line.ended and line.size > 16)
        menu = bool(parts) and (sum(parts) >= 0.5 * len(parts) or (parts[0] and not line.ended))
        if hit or crumb or style or menu:
            out.append(at)
            teasing = known.get(content, False) or (teasing and not hit)
        elif teasing and line.teaser:
            out.append(at)
        else:
            teasing = False
    return out


def _seed(host: str) -> int:
    return xxhash.xxh64_intdigest(host)


def _hash(seed: int, node: str) -> int:
    return xxhash.xxh64_intdigest(node, seed) - (1 << 63)


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, pages, known array<struct<node, head>>``: of every host the different pages, the unimportant nodes, and which head a list of teasers.

    Nodes are counted by distinct contents of pages, so copies count once; a page sends its content nodes once, and a presentation
    node once for every content below it. From those partial counts come both entropies. A host's
    list is bounded: a node must be on ``SHARE`` of its pages, and a page has a bounded number.
    """

    def run(batches):
        for b in batches:
            hosts, copies, ends = [], [], [0]
            node, kind, content, times, first, follows, teases = flat = [[] for _ in range(7)]
            for host, title, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                hosts.append(host)
                copies.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63))
                found, below, often = page_nodes(text, title)
                seed = _seed(host)
                codes = {n: _hash(seed, n) for n in found}
                # a row is a node, its kind, the content below it, its lines, whether it is the node's first row of the page, and with that what follows
                for n, (a, z) in found.items():
                    if n[0] in "cp":
                        node.append(codes[n])
                        kind.append(CONTENT)
                        content.append(0)
                        times.append(often[n])
                        first.append(1)
                        follows.append(a)
                        teases.append(z)
                seen: set[str] = set()
                for n, c in below:
                    new = n not in seen
                    seen.add(n)
                    a, z = found[n] if new else (0, 0)
                    node.append(codes[n])
                    kind.append(_KINDS[n[0]])
                    # 32 bits of the content's code tell the contents of one node apart
                    content.append((codes[c] >> 32) or 1)
                    times.append(1)
                    first.append(int(new))
                    follows.append(a)
                    teases.append(z)
                ends.append(len(node))
            offsets = pa.array(ends, pa.int32())
            kinds = (pa.int64(), pa.int8(), pa.int32(), pa.int32(), pa.int8(), pa.int32(), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, k)) for x, k in zip(flat, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(copies, pa.int64()), *lists], ["host", "copy", "nodes", "kind", "content", "times", "first", "follows", "teases"])

    found = pages.select("host", "title", "text").mapInArrow(
        run,
        "host string, copy bigint, nodes array<bigint>, kind array<tinyint>, content array<int>, times array<int>, first array<tinyint>, follows array<int>, teases array<int>",
    )
    # one row per distinct content of a host
    found = materialize(found.dropDuplicates(["host", "copy"]), "p4-nodes")
    sizes = found.groupBy("host").agg(F.count("*").alias("pages"))
    names = ["nodes", "kind", "content", "times", "first", "follows", "teases"]
    nodes = found.select("host", F.explode(F.arrays_zip(*names)).alias("x")).select("host", "x.*")
    sums = [F.sum(x).alias(x) for x in ("first", "follows", "teases")]
    times = F.col("times").cast("double")
    over_pages = [F.sum("times").alias("n"), F.sum(times * F.log(times)).alias("page_logs")]
    parts = nodes.groupBy("host", "nodes", "kind", "content").agg(*over_pages, *sums)
    # content nodes are whole by now, presentation nodes still by content
    parts = parts.filter((F.col("kind") != CONTENT) | (F.col("first") >= LEAST_PAGES))
    n = F.col("n").cast("double")
    counts = parts.groupBy("host", "nodes", "kind").agg(*sums, F.sum("n").cast("double").alias("seen"), F.sum(n * F.log(n)).alias("logs"), F.sum("page_logs").alias("page_logs"))
    counts = counts.withColumnRenamed("first", "on")
    counts = counts.filter(F.col("on") >= LEAST_PAGES).join(sizes, "host")
    seen, pages_ = F.col("seen"), F.col("pages").cast("double")
    # entropies are -sum(p log p) with p = n / seen: of a content node over pages, of a presentation node over contents
    tells = F.log(pages_) - (F.log(seen) - F.col("page_logs") / seen)
    varied = 1 - F.col("logs") / (seen * F.log(seen))
    often = F.col("on") >= SHARE * pages_
    fixed = F.when(F.col("kind") == LABEL, LABEL_SHARE).when(F.col("kind").isin(TAIL, WORD), TAIL_SHARE)
    style = (varied <= VARIED) & (F.col("kind") != WORD) | (F.col("on") >= fixed * pages_)
    low = F.when(F.col("kind") == CONTENT, tells <= F.log(F.lit(1 / SHARE)) + 1e-9).otherwise(often & style)
    counts = counts.filter(low)
    heads = (F.col("follows") >= 3) & (F.col("teases") >= TEASERS * F.col("follows"))
    listed = counts.groupBy("host").agg(F.collect_list(F.struct(F.col("nodes").alias("node"), heads.alias("head"))).alias("known"))
    return materialize(sizes.join(listed, "host", "left"), "p4-tree")


def boilerplate(pages: DataFrame) -> DataFrame:
    """``page_id, line_no``: lines of ``raw_content`` that belong to the site's template.

    A host's pages pass by behind a copy of its tree, in one exchange; a host of more than ``PAGES`` pages is spread over
    as many copies as that takes. The host is ``source_domain`` in lower case without port, else that of ``url``; pages with neither form a site
    of their own. Null and blank contents give no rows, blank lines never come out, sites with under three different pages lose only breadcrumbs
    that repeat the title; repeated rows give the same lines once; an empty table gives no rows; other
    columns are not read. Whole pages count, at any length.
    """
    host = F.coalesce(bare_host(pages["source_domain"], pages["url"]), F.lit(""))
    slim = pages.select(
        pages["page_id"].alias("page_id"), host.alias("host"), pages["title"].alias("title"), pages["raw_content"].alias("text")
    ).filter("page_id is not null and trim(text) <> ''")
    slim = spread(slim)
    tree = style_tree(slim)
    # hosts of several copies are few: each has PAGES different pages
    rows = slim.groupBy("host").agg(F.count("*").alias("rows")).filter(F.col("rows") > PAGES).withColumn("ways", F.ceil(F.col("rows") / PAGES).cast("int")).drop("rows")
    rows = materialize(rows, "p4-hosts")
    ways = F.coalesce("ways", F.lit(1))
    copies = tree.join(rows, "host", "left").select("host", F.explode(F.sequence(F.lit(0), ways - 1)).alias("way"), "known")
    many = F.broadcast(rows) if rows.count() <= BROADCAST_HOSTS else rows
    spread_out = slim.join(many, "host", "left").withColumn("way", F.pmod(F.xxhash64("page_id"), ways).cast("int")).drop("ways")
    both = spread_out.unionByName(copies, allowMissingColumns=True)
    both = both.repartition("host", "way").sortWithinPartitions("host", "way", F.col("page_id").asc_nulls_first())

    def run(batches):
        known: _Known | None = None
        for b in batches:
            ids, at = [], []
            for page, host, title, text, row in zip(*(b.column(c) for c in ("page_id", "host", "title", "text", "known")), strict=True):
                if not page.is_valid:  # a host's tree comes before its pages
                    known = _Known(host.as_py(), {x["node"]: x["head"] for x in row.as_py() or []})
                    continue
                found = template_lines(text.as_py(), title.as_py(), known)
                ids += [page.as_py()] * len(found)
                at += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int64())], ["page_id", "line_no"])

    return both.mapInArrow(run, "page_id bigint, line_no bigint").distinct()


class _Known:
    """The unimportant nodes of a host, asked by name."""

    def __init__(self, host: str, nodes: dict[int, bool]):
        self.seed, self.nodes, self.asked = _seed(host), nodes, {}

    def _code(self, node: str) -> int:
        found = self.asked.get(node)
        if found is None:
            if len(self.asked) > 100_000:
                self.asked.clear()
            found = self.asked[node] = _hash(self.seed, node)
        return found

    def __contains__(self, node: str) -> bool:
        return self._code(node) in self.nodes

    def get(self, node: str, default: bool = False) -> bool:
        return self.nodes.get(self._code(node), default)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate(table(spark, sf_dir, "site_pages"))


def p4_main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, kept_lines, removed_lines, raw_content`` with only the lines of the page's own article."""
    pages = table(spark, sf_dir, "site_pages")
    return drop_lines(pages, boilerplate(pages))
