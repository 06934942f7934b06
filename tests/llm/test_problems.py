"""The ten operators against brute force, public libraries and hand-made cases."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import bpe
from siltworks.llm import p1_tokens as p1
from siltworks.llm import p2_spam as p2
from siltworks.llm import p3_cutoffs as p3
from siltworks.llm import p4_template as p4
from siltworks.llm import p5_quality as p5
from siltworks.llm import p6_repeated as p6
from siltworks.llm import p7_batches as p7
from siltworks.llm import p8_encode as p8
from siltworks.llm import p9_leaks as p9
from siltworks.llm import p10_truncated as p10
from siltworks.llm.archetypes import NOUNS, SYLLABLES, Maker, examples
from siltworks.llm.common import level_counts, to_levels
from siltworks.llm.page_stats import NAMES, page_stats
from siltworks.llm.words import runs, word_codes

from .prose import PROSE

TEXTS = ["", " ", "Hello  world\n\n  x", "日本語のテキスト 漢字", "don't we'll I'M", "\x1c\x1d a b", "<|endoftext|>", "naïve 🌿🚲 ok", "a" * 300, "x\ty\r\n", "été " * 50, "١٢٣ ⅷ"]

SITE = "page_id bigint, url string, source_domain string, title string, raw_content string"


def sentence(rng, lang="en"):
    return Maker(lang, rng).sentence()


# 1 and 8


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_equals_the_public_library(name):
    import tiktoken

    path = bpe.vocabulary(None, name)
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    public = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for t in TEXTS:
        expected = public.encode_ordinary(t)
        assert bpe.encoder(path).encode(t).tolist() == expected
        assert bpe.counter(path).count(t) == len(expected)


def test_bpe_of_long_words():
    import tiktoken

    path = bpe.vocabulary(None, "byte_bpe_50k.tiktoken")
    public = tiktoken.Encoding("own", pat_str=r"\p{L}+", mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rng = random.Random(3)
    for size in (bpe.SHORT - 1, bpe.SHORT, bpe.SHORT + 1, 700, 5_000):
        for letters in ("ab", "etaoinshrdlu", "éü漢"):
            word = "".join(rng.choice(letters) for _ in range(size))
            assert bpe.encoder(path).encode(word).tolist() == public.encode_ordinary(word)
    start = time.perf_counter()
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    ids = bpe.encoder(path).encode(word)
    assert time.perf_counter() - start < 60
    tokens = {v: k for k, v in bpe.load_ranks(path).items()}
    assert b"".join(tokens[i] for i in ids.tolist()) == word.encode() and len(ids) < 600_000


def test_p8_rows(spark):
    df = spark.createDataFrame([(1, "Hello"), (2, ""), (3, None), (1, "Hello"), (None, "x")], "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    rows = p8.encode_texts(df).collect()
    assert len(rows) == 5 and Counter(len(r["ids"]) for r in rows) == {1: 3, 0: 2}
    assert p8.encode_texts(df.limit(0)).collect() == []


MINED = "mined_id bigint, url string, cc_segment string, source_domain string, language string, bucket string, tokenized string, raw_content string, perplexity double"


def test_p1_counts_and_totals(spark):
    rows = [
        (1, "http://h.example/", "s", None, " EN", "Head", "▁a  b ▁c", "abc", 1.0),
        (2, "http://h.example/", "s", "H.example:80", "en-GB", None, None, "abc abc", 1.0),
        (3, "", None, None, None, "head", "", None, 1.0),
        (3, "", None, None, None, "head", "", None, 1.0),
    ]
    df = spark.createDataFrame(rows, MINED).withColumn("tokens", F.lit(5))
    counts = p1.token_counts(df)
    found = {r["mined_id"]: r for r in counts.collect()}
    n = bpe.counter(bpe.vocabulary(None, "byte_bpe_multi_50k.tiktoken")).count
    assert (found[1]["tokens"], found[1]["method"], found[1]["language"], found[1]["bucket"], found[1]["source_domain"]) == (3, "pieces", "en", "head", "h.example")
    assert (found[2]["tokens"], found[2]["method"], found[2]["bucket"]) == (round(n("abc abc") * 3 / n("abc")), "estimate", "other")
    assert (found[3]["tokens"], found[3]["method"], found[3]["language"]) == (0, "none", "und")
    totals = {(r["slice"], r["language"], r["source_domain"]): r for r in p1.token_budget(counts).collect()}
    assert totals["all", None, None]["docs"] == 4
    assert totals["language", "en", None]["tokens"] == found[1]["tokens"] + found[2]["tokens"]
    assert totals["source_domain", None, "h.example"]["estimated_tokens"] == found[2]["tokens"]
    assert p1.token_counts(df.limit(0)).count() == 0


# 3


def test_p3_against_sorting(spark):
    rng = random.Random(1)
    rows = [(k, None if rng.random() < 0.1 else float(rng.randint(1, 30))) for k in ["a", "b", None] for _ in range(200)]
    rows += [("a", float("nan")), ("a", float("inf")), ("c", None)]
    df = spark.createDataFrame([("k", k, s) for k, s in rows], "kind string, key string, score double")
    found = {(r["key"], r["fraction"]): r for r in p3.keep_cutoffs(df).collect()}
    assert set(found) == {(k, f) for k in ("a", "b", None) for f in p3.FRACTIONS}
    for (k, f), r in found.items():
        own = sorted((s for q, s in rows if q == k and s is not None and np.isfinite(s)), reverse=True)
        best = min(((abs(sum(x >= c for x in own) - f * len(own)), sum(x >= c for x in own), c) for c in set(own)))
        assert (r["kept"], r["cutoff"], r["scored"]) == (best[1], best[2], len(own))
    assert p3.keep_cutoffs(df.limit(0)).count() == 0


# 2 and 5


def pages(spark, texts):
    rows = [(i, f"http://h{i}.example/", None, None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SITE)


def test_p2_and_p5_on_unseen_examples(spark):
    made = examples(6, seed=99)
    prose = [x for seed in range(6) for x in examples(6, seed=seed + 500) if x[1] == "prose"]  # the bulk, as the method needs
    kinds = prose + [x for x in made if x[1] != "prose"]
    df = pages(spark, [t for _, _, t in kinds] + [None, "", "  \n"]).withColumn("spam", F.lit(1))
    spam = {r["page_id"] for r in p2.spam_pages(df).filter("spam").collect()}
    poor = {r["page_id"] for r in p5.page_quality(df).filter("not natural").collect()}
    truth = [c for _, c, _ in kinds]
    share = lambda found, c: np.mean([i in found for i, x in enumerate(truth) if x == c])
    assert share(spam, "spam") > 0.85 and share(spam, "prose") < 0.02 and share(spam, "table") < 0.15
    assert share(poor, "spam") > 0.9 and share(poor, "junk") > 0.9 and share(poor, "table") > 0.9 and share(poor, "prose") < 0.02
    assert not {i for i in spam | poor if i >= len(kinds)}


def test_p2_and_p5_keep_prose_of_languages_without_a_list(spark):
    bulk = [x[2] for seed in range(4) for x in examples(6, seed=seed + 500) if x[1] == "prose"]
    once, twice = list(PROSE.values()), [f"{t}\n{t}" for t in PROSE.values()]
    controls = ["I had not expected the shop to be open so late, but the lamp in the window was still on. The owner gave me a chair and asked about my journey. We drank tea until the rain stopped, and then he showed me the way to the station."]
    held = [*once, *twice, *controls, *(f"{t}\n{t}" for t in controls)]
    spam = [", ".join(f"{w} tanio" for w in "buty sukienki torebki zegarki płaszcze kurtki".split() * 12), " ".join(["comprare scarpe online"] * 40)]
    df = pages(spark, [*held, *spam, *bulk])
    flagged = {r["page_id"] for r in p2.spam_pages(df).filter("spam").collect()}
    poor = {r["page_id"] for r in p5.page_quality(df).filter("not natural").collect()}
    n = len(held)
    assert len(PROSE) >= 20 and len([i for i in flagged if i < n]) <= 0.05 * n and len([i for i in poor if i < n]) <= 0.05 * n
    assert {n, n + 1} <= poor and {n, n + 1} <= flagged


def test_p2_and_p5_on_empty_tables(spark):
    df = pages(spark, ["x"]).limit(0)
    assert p2.spam_pages(df).count() == 0 and p5.page_quality(df).count() == 0


def test_page_stats_of_odd_texts():
    assert page_stats(None) is None and page_stats(" \n　") is None
    for t in ["x", "…", "🌿", "http://a.example/", "a\n" * 5000, "\x00", "word " * 20000]:
        assert all(np.isfinite(page_stats(t)[1]))


def test_page_stats_of_stuffed_words_in_short_texts():
    text = "We sell shoes, fine shoes, red shoes, wool shoes, kids shoes and cheap shoes in the town for it."
    for t in [text, text.replace("the town", "the old town")]:  # 19 and 20 words
        assert dict(zip(NAMES, page_stats(t)[1], strict=True))["sentences"] == 0


def test_page_stats_of_long_prose_of_a_language_without_a_list():
    rare = "Příliš žluťoučký kůň úpěl ďábelské ódy, až se v noci vzbudila celá ves. Xénie z Gdaňska prý četla o wolframu a fyzice, ó jaká to byla nuda."
    for k in [70, 120]:  # 3,387 and 5,787 words
        language, found = page_stats("\n".join([PROSE["cs"]] * k + [rare]))
        assert language == "und" and dict(zip(NAMES, found, strict=True))["sentences"] == 1
    for a, b in [("fi", "id"), ("tr", "id"), ("pl", "ar")]:  # 80 to 85 words, few of them repeated
        language, found = page_stats(PROSE[a] + "\n" + PROSE[b])
        assert language == "und" and dict(zip(NAMES, found, strict=True))["sentences"] == 1


def test_page_stats_of_stuffed_words_in_a_short_text_of_a_language_without_a_list():
    text = "Kupuj buty: tanie buty, nowe buty, czarne buty, zimowe buty, letnie buty na co dzień i na."
    for t in [text, text.replace("i na.", "i na ślub od ręki.")]:  # 17 and 20 words
        language, found = page_stats(t)
        assert dict(zip(NAMES, found, strict=True))["sentences"] == 0


# 4 and 6


def site(rng, n=14):
    """Pages of one site: menu, article, tags, teasers, footer; and the lines that are not the article's."""
    maker = Maker("en", rng)
    out = []
    for k in range(n):
        title = maker.title()
        lines = [("Home | News | Contact | About us", 1), (title, 0)]
        lines += [(maker.sentence() + " " + maker.sentence(), 0) for _ in range(4)]
        lines += [("", 0), (f"{rng.randint(2, 900)} comments", 1), ("Tags: " + ", ".join(maker.word() for _ in range(5)), 1), ("You may also like", 1)]
        lines += [(maker.title(), 1), (maker.sentence()[:30] + "… Read more", 1), ("© 2020 The Site. All rights reserved.", 1)]
        out.append((k, title, "\n".join(x for x, _ in lines), {i for i, (_, b) in enumerate(lines) if b}))
    return out


def test_p4_finds_the_template(spark):
    made = site(random.Random(3))
    rows = [(k, f"http://s.example/{k}", "S.example:80" if k % 2 else None, t, x) for k, t, x, _ in made]
    rows += [(100, "http://s.example/0", None, made[0][1], made[0][2]), (101, None, None, None, "No site.\nAt all."), (102, "http://s.example/", None, None, None)]
    found = defaultdict(set)
    for r in p4.boilerplate(spark.createDataFrame(rows, SITE).withColumn("line_no", F.lit(0))).collect():
        found[r["page_id"]].add(r["line_no"])
    wrong = sum(len(found[k] ^ truth) for k, _, _, truth in made)
    assert wrong <= 2
    assert found[100] == found[0] and 101 not in found and 102 not in found
    assert p4.boilerplate(spark.createDataFrame(rows, SITE).limit(0)).count() == 0


def test_p4_keeps_headlines_of_one_form(spark):
    nouns = ["Haus", "Tor", "Lied", "Dach", "Feld", "Boot", "Glas", "Tuch", "Brot", "Salz", "Holz", "Buch"]
    names = ["Jana Berg", "Olaf Stern", "Rita Wolf"]
    rows, wanted = [], set()
    for k in range(24):
        lines = [f"Das stille {nouns[k]}: {nouns[-k]}{nouns[k]}, Ort {nouns[k]}ingen"] if k < 12 else []
        lines.append(" ".join(nouns[(k * j + j) % 12] for j in range(1, 6)) + f" {chr(97 + k)}.")
        lines += [f"Verfasst von {names[k % 3]} am {k + 1} {['Mai', 'Juni'][k // 3 % 2]} 2025", f"Previous: {nouns[k % 12]} {chr(97 + k)} {nouns[k // 2]}"]
        rows.append((k, "http://h.example/", None, None, "\n".join(lines)))
        wanted |= {(k, len(lines) - 2), (k, len(lines) - 1)}
    found = {tuple(r) for r in p4.boilerplate(spark.createDataFrame(rows, SITE)).collect()}
    assert found == wanted  # bylines repeat names and the label is fixed; the headlines share nothing but their mask


def test_p6_against_counting(spark):
    rng = random.Random(5)
    rows = []
    for h in range(4):
        for k in range(12):
            lines = [f"Line {h} number {rng.randint(1, 99)}!", "SHARE this", rng.choice(["x", "y", "—"]), sentence(rng)]
            rng.shuffle(lines)
            host = [f"H{h}.example", None, f"h{h}.example:81"][k % 3]
            rows.append((h * 100 + k, f"http://h{h}.example/{k}", host, None, "\r\n".join(lines)))
    rows += [(999, None, None, None, "SHARE this"), (998, "http://h1.example", None, None, None), rows[0]]
    df = spark.createDataFrame(rows, SITE).withColumn("host", F.lit("clash"))
    key = lambda x: "".join(c for c in __import__("re").sub(r"\d+", "0", x.lower()) if c.isalnum())
    at = defaultdict(set)
    for p, url, _, _, text in rows:
        for i, x in enumerate((text or "").split("\n")):
            if url and key(x):
                at[url.split("/")[2], key(x)].add((p, i))
    expected = {pos for v in at.values() if len({p for p, _ in v}) >= 8 for pos in v}
    found = p6.repeated_lines(df)
    assert {tuple(r) for r in found.collect()} == expected
    clean = {r["page_id"]: r for r in p6.drop_lines(df, found).collect()}
    assert clean[998]["raw_content"] is None and clean[999]["raw_content"] == "SHARE this"
    assert "SHARE" not in clean[0]["raw_content"]
    assert p6.repeated_lines(df.limit(0)).count() == 0


def test_p6_single_site(spark):
    rows = [(k, "http://a.example/", None, None, f"same\nown {chr(97 + k)}{chr(98 + k)}") for k in range(9)]
    assert p6.repeated_lines(spark.createDataFrame(rows, SITE)).count() == 9


def test_p6_counts_without_the_test_and_reports_it(spark, tmp_path, monkeypatch):
    # "spread" is on 8 of 200 pages of one host and on 3 pages each of 40 others; "five" on 5 of the 200
    rows = [(k, "http://a.example/", None, None, f"own {chr(97 + k % 26)}{chr(97 + k // 26)}" + "\nspread" * (k < 8) + "\nfive" * (k < 5)) for k in range(200)]
    rows += [(1000 + 3 * h + j, f"http://b{h}.example/", None, None, f"spread\nother {chr(97 + h % 26)}{chr(97 + h // 26)}{chr(97 + j)}") for h in range(40) for j in range(3)]
    spark.createDataFrame(rows, SITE).write.parquet(str(tmp_path / "site_pages.parquet"))
    report = {(r["host"], r["pages"]): (r["host_pages"], r["outside"], r["significant"], r["excess"]) for r in p6.p6_line_excess(spark, str(tmp_path)).collect()}
    assert report["a.example", 8] == (200, 120, False, True) and report["a.example", 5] == (200, 0, True, False)
    assert len(report) == 42

    def fail(*args):
        raise AssertionError("not needed for what is found")

    monkeypatch.setattr(p6, "discovery_limit", fail)
    assert {tuple(r) for r in p6.p6_found(spark, str(tmp_path)).collect()} == {(k, 1) for k in range(8)}


# 7


REC = "rec_id bigint, raw_content string"


def records(rng, n, base):
    texts = []
    for k in range(n):
        roll = rng.random()
        if texts and roll < 0.3:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, len(words) // 12)):
                words[rng.randrange(len(words))] = f"new{rng.randint(0, 99)}"
            texts.append(rng.choice([str, str.upper])(" ".join(words)))
        elif roll < 0.4:
            texts.append("形式" * 10 + "".join(rng.choice("天地玄黄宇宙洪荒日月盈昃") for _ in range(300)))
        else:
            texts.append(" ".join(sentence(rng) for _ in range(rng.randint(3, 9))))
    return [(base + k, t) for k, t in enumerate(texts)]


def brute_pairs(rows, first_new):
    sets = {i: runs(word_codes(t)) for i, t in rows if t and len(t) >= 200}
    out = set()
    for a in sets:
        for b in sets:
            if a < b and b >= first_new:
                both = len(np.intersect1d(sets[a], sets[b]))
                if 2 * both > len(sets[a]) + len(sets[b]) - both:
                    out.add((a, b))
    return out


def test_p7_against_brute_force_and_batch_by_batch(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    old = records(rng, 60, 0)
    new = records(random.Random(8), 25, 1000) + [(2000, old[0][1]), (2001, old[0][1]), (2002, None), (2003, "short"), (2004, "!" * 300)]
    old += [(90, old[1][1]), (91, None), (92, "")]
    a, b = spark.createDataFrame(old, REC).withColumn("token", F.lit(0)), spark.createDataFrame(new, REC).withColumn("digest", F.lit("same"))
    expected = brute_pairs(old + new, 1000)
    assert expected
    assert {tuple(r) for r in p7.batch_duplicates(a, b).collect()} == expected
    monkeypatch.setattr(p7, "LONG", 0)  # every list of postings is split
    monkeypatch.setattr(p7, "LONG_LEAST", 0.5)
    assert {tuple(r) for r in p7.batch_duplicates(a, b).collect()} == expected
    monkeypatch.setattr(p7, "RECOUNT", 0.01)  # and counted anew with every batch
    split = p7.BatchIndex(spark, str(tmp_path / "split"))
    split.start(a.filter("rec_id < 30"))
    split.add(a.filter("rec_id >= 30"))
    found = {tuple(r) for part in ("rec_id < 1012", "rec_id >= 1012") for r in p7.BatchIndex(spark, str(tmp_path / "split")).pairs(b.filter(part)).collect()}
    assert found == expected
    monkeypatch.undo()
    monkeypatch.setattr(p7, "COPIES", 1)  # every text with copies is spread
    index = p7.BatchIndex(spark, str(tmp_path / "index"))
    index.start(a)
    found = set()
    for part in (b.filter("rec_id < 1012"), b.filter("rec_id >= 1012")):
        found |= {tuple(r) for r in p7.BatchIndex(spark, str(tmp_path / "index")).pairs(part).collect()}
    assert found == expected
    numbered = b.withColumn("batch_no", F.when(F.col("rec_id") < 1012, 7).otherwise(F.lit(None)))
    assert {tuple(r) for r in p7.batch_duplicates(a, numbered).collect()} == expected
    monkeypatch.setattr(p7, "SMALL", 0)  # as for a large batch: nothing is named, the batch travels to the buckets
    assert {tuple(r) for r in p7.batch_duplicates(a, numbered).collect()} == expected
    classes = {r["rec_id"]: r for r in p7.batch_duplicates(a, b, how="classes").collect()}
    assert classes[2000]["class_id"] == classes[2001]["class_id"] and classes[2000]["copies"] >= 2
    for rec, r in classes.items():
        assert r["copies"] + r["links"] == len({x for p in expected if rec in p for x in p} - {rec})
    assert p7.batch_duplicates(a.limit(0), b.limit(0)).count() == 0 and p7.batch_duplicates(a, b.limit(0)).count() == 0


def test_p7_few_jobs_a_batch(spark, tmp_path, monkeypatch):
    rows = records(random.Random(8), 60, 0) + records(random.Random(8), 25, 1000)
    df = spark.createDataFrame(rows, REC).coalesce(1)
    expected = brute_pairs(rows, 1000)
    monkeypatch.setattr(p7, "SMALL", 0)
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    for copies in (20_000, 83):  # the bound above all records, and between them and those that are asked for
        monkeypatch.setattr(p7, "COPIES", copies)
        index = p7.BatchIndex(spark, str(tmp_path / f"index{copies}"))
        index.start(df.filter("rec_id < 1000"))
        found, jobs = set(), []
        for part in ("rec_id between 1000 and 1011", "rec_id >= 1012"):
            before = scheduler.numTotalJobs()
            found |= {tuple(r) for r in index.pairs(df.filter(part)).collect()}
            jobs.append(scheduler.numTotalJobs() - before)
        assert found == expected and expected
        assert max(jobs) <= 30, jobs  # each job costs the driver memory, however small it is


def test_p7_levels_never_undercount():
    counts = np.array([0, 1, 2, 3, 5, 100, 65_536, 10**12, 2**62])
    levels = to_levels(counts)
    assert (level_counts(levels) >= counts).all() and (level_counts(levels) <= counts * 1.2).all() and (np.diff(levels.astype(int)) > 0).all()


def test_p7_ignores_form_of_the_text():
    a = "<p>L'été &amp; la gare, c'est le soir et la nuit.</p>"
    b = "l ét".replace("l e", "L'e") + "É & LA­ gare — c'est\nle soir et la nuit"
    assert runs(word_codes(a)).tolist() == runs(word_codes(b)).tolist()


# 9


def test_p9_against_brute_force(spark):
    rng = random.Random(2)
    items = [(i, " ".join(sentence(rng) for _ in range(3)) + "\nWhy did they repair the old bridge near the river?\nA) one\nB) two") for i in range(12)]
    docs = []
    for k in range(80):
        words = " ".join(sentence(rng) for _ in range(6)).split()
        if k % 3 == 0:
            own = p9.terms(rng.choice(items)[1])
            start, size = rng.randrange(len(own) - 20), rng.randint(10, 20)
            words[20:20] = [w.upper() for w in own[start : start + size]]
        docs.append((k, "\n| ".join(" ".join(words[i : i + 7]) for i in range(0, len(words), 7))))
    changed = p9.terms(items[3][1])[: p9.parts(items[3][1]).count(1) + p9.parts(items[3][1]).count(2)]
    changed = ["altered" if i % 9 == 4 else w for i, w in enumerate(changed)]
    docs += [(500, "Before. " + " ".join(changed) + " After."), (501, None), (502, ""), (None, items[0][1])]
    found = {(r["doc_id"], r["item_id"]) for r in p9.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("terms", F.lit(1)), spark.createDataFrame(items + [(99, None), (98, "too short")], "item_id bigint, item_text string")).collect()}
    expected = {(500, 3)}
    for d, t in docs:
        if d is not None and t:
            w = p9.terms(t)
            grams = {tuple(w[i : i + 14]) for i in range(len(w) - 13)}
            for i, x in items:
                v = p9.terms(x)
                if any(tuple(v[j : j + 14]) in grams for j in range(len(v) - 13)):
                    expected.add((d, i))
    assert found == expected and len(expected) > 10
    assert p9.leaked_items(spark.createDataFrame(docs[:0], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")).count() == 0


def test_p9_altered_copies_and_one_index_for_any_items(spark, tmp_path):
    rng = random.Random(12)
    common, rare = "the of and to in it was that with as for on".split(), [f"{a}{b}" for a in NOUNS["en"] for b in SYLLABLES]

    def prose(n):
        return " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n))

    items = [(i, f"{prose(rng.randint(40, 140))}.\nWhat about {prose(10)}?") for i in range(40)]
    docs, expected = [], set()
    for i, text in items:
        for way in range(3):
            words = []
            for w in p9.terms(text):
                hit = rng.random() < 0.1
                words += [["altered"], [], [w, "extra"]][way] if hit else [w]
            docs.append((i * 10 + way, "Some words before. " + " ".join(words) + ". And after."))
            expected.add((i * 10 + way, i))
        docs.append((i * 10 + 5, prose(150)))
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = p9.PositionalIndex(spark, str(tmp_path / "index"))
    index.build(documents)
    found = set()
    for part in (items[:15], items[15:]):
        again = p9.PositionalIndex(spark, str(tmp_path / "index"))
        found |= {(r["doc_id"], r["item_id"]) for r in p9.leaked_items(documents, spark.createDataFrame(part, "item_id bigint, item_text string"), again).collect()}
    for way in range(3):  # words replaced, left out, put in
        wanted = {p for p in expected if p[0] % 10 == way}
        assert len(found & wanted) >= 0.95 * len(wanted)
    assert len(found - expected) <= 2


def test_p9_frequent_lists(spark, monkeypatch):
    monkeypatch.setattr(p9, "FREQUENT", 1)  # every list of two places or more is spread
    phrase = "one two three one two three four five six seven eight nine ten eleven twelve"
    docs = [(k, f"x{k} y{k} {phrase if k % 3 == 0 else 'four six one'} z{k}") for k in range(30)]
    found = p9.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, phrase)], "item_id bigint, item_text string"))
    assert {(r["doc_id"], r["longest"]) for r in found.collect()} == {(k, 15) for k in range(0, 30, 3)}


# 10


DOCS = "doc_id bigint, source string, title string, text string"


def test_p10_held_out_endings(spark):
    rng = random.Random(4)
    rows, truth = [], {}
    for k in range(900):
        maker = Maker(rng.choice(["en", "de", "fr"]), rng)
        text = maker.body()
        source = "limited" if k % 3 == 0 else "free"
        if source == "limited" and len(text) > 400:
            text = text[:400]
            truth[k] = not text.endswith(".")
        elif rng.random() < 0.3:
            text, truth[k] = text + "\n" + maker.title(), False
        elif rng.random() < 0.15:
            text = text[: -rng.randint(8, 40)]
            truth[k] = not text.rstrip().endswith(".")
        else:
            truth[k] = False
        rows.append((k, source, maker.title(), text))
    rows += [(9001, "free", None, None), (9002, None, None, ""), (9003, "free", None, " \n")]
    df = spark.createDataFrame(rows, DOCS).withColumn("length", F.lit(1))
    lengths = {(r["source"], r["unit"], r["length"]) for r in p10.significant_lengths(df).collect()}
    assert ("limited", "chars", 400) in lengths
    found = {r["doc_id"]: r["cut"] for r in p10.cut_texts(df).collect()}
    assert not any(found[k] for k in (9001, 9002, 9003))
    hits = sum(found[k] and truth[k] for k in truth)
    assert hits / sum(truth.values()) > 0.85 and hits / sum(found[k] for k in truth) > 0.85
    assert p10.cut_texts(df.limit(0)).count() == 0


def test_p10_trains_on_distinct_texts(spark, monkeypatch):
    texts = spark.createDataFrame([(f"Text number {k} goes on and",) for k in range(200)], "text string")
    hot = texts.orderBy(F.pmod(F.xxhash64("text"), F.lit(1_000_000))).first()["text"]
    rows = [(k, "s", None, r["text"]) for k, r in enumerate(texts.collect())] + [(1000 + k, "s", None, hot) for k in range(100)]
    trained = []
    monkeypatch.setattr(p10, "TRAIN_TEXTS", 50)
    monkeypatch.setattr(p10, "train", lambda rows: trained.extend(rows) or {})
    p10.endings(spark.createDataFrame(rows, DOCS))
    assert len(trained) >= 30 and len({t for t, _, _ in trained}) == len(trained)


def test_every_language_has_its_words():
    assert all(len(set(v)) == len(v) for v in NOUNS.values())
