import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltworks.functions import hashing, text, urls
from siltworks.functions.binding import let

MARKS = "，。、„”“«»１」「《》´∶：？！（）；–—．～’…━〈〉【】％"


def value(spark, column, x):
    return spark.createDataFrame([(x,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_punctuation(spark):
    assert value(spark, text.remove_unicode_punct, MARKS) == ""
    assert value(spark, text.replace_unicode_punct, MARKS) == ",.,\"\"\"\"\"\"\"\"\"\"'::?!();- - . ~'...-<>[]%"


def test_normalize(spark):
    assert value(spark, text.normalize, "０２３４５６７８９ | 0123456789") == "000000000 | 0000000000"
    assert value(spark, text.normalize_for_dedup, "０２３´∶：\x10 | ;012 hèllo") == "000 | ;000 hèllo"
    assert value(spark, text.normalize, " ÀB\t") == "ab"
    for f in (text.normalize, text.normalize_for_dedup, text.strip_accents, text.replace_unicode_punct):
        assert value(spark, f, None) is None
        assert value(spark, f, "") == ""


def dedup_by_definition(line):
    line = re.sub(r"\d", "0", line.strip().lower())
    line = "".join(c for c in line if c not in text.PUNCT)
    return "".join(c for c in line if not (ord(c) < 32 or 127 <= ord(c) < 160))


def test_dedup_equals_definition_on_many_lines(spark):
    samples = ["", " ", "Ａ１", "\x1cx\x85", "٣", "x ", "Straße…", "　中文，", "a\tb", "É", "1,5 %"]
    got = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, x string")
    rows = got.select("i", text.normalize_for_dedup(F.col("x")).alias("y")).collect()
    assert {r["i"]: r["y"] for r in rows} == {i: dedup_by_definition(s) for i, s in enumerate(samples)}


def test_two_forms_of_dedup_normalization_agree(spark):
    df = spark.createDataFrame([("Ｈèllo １２ „x“ \x07",), (None,), ("",)], "x string")
    slow = text.normalize(F.col("x"), accent=False, punct=2)
    assert df.filter(~slow.eqNullSafe(text.normalize_for_dedup(F.col("x")))).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs", "Cn"]), max_size=40))
def test_strip_accents_is_idempotent(s):
    once = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    assert once == "".join(c for c in unicodedata.normalize("NFD", once) if unicodedata.category(c) != "Mn")


@pytest.mark.parametrize(
    ("language", "given_", "expected"),
    [("en", 'He said "yes", twice', 'He said "yes," twice'), ("de", "1 000 %", "1,000%"), ("en", "5 %", "5%"), ("fr", "« oui »", '"oui"'), ("en", "a (b).", "a  (b).")],
)
def test_spacing(spark, language, given_, expected):
    assert value(spark, lambda c: text.spacing_for_tokens(c, language), given_) == expected


def test_spacing_compat_keeps_the_slip(spark):
    assert value(spark, lambda c: text.spacing_for_tokens(c, "en", True), 'x",') == 'x,\\"'


def test_newline_token_round_trip(spark):
    assert value(spark, lambda c: text.unescape_newlines(text.escape_newlines(c)), "a\nb\n") == "a\nb\n"


def test_netloc(spark):
    assert value(spark, urls.netloc, "http://sample_english.com/x?y") == "sample_english.com"
    assert value(spark, urls.netloc, "https://u@h.example:81/") == "u@h.example:81"
    assert value(spark, lambda c: urls.bare_host(c, F.lit("http://B.example/")), " ") == "b.example"
    assert value(spark, lambda c: urls.bare_host(c, F.lit(None)), "WWW.X.example:80") == "www.x.example"


@pytest.mark.parametrize(("ids", "packed"), [([0, 4], "AAAEAA=="), ([], ""), ([65535, 32768], "//8AgA=="), (None, None)])
def test_line_ids(spark, ids, packed):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    row = df.select(hashing.encode_line_ids(F.col("ids")).alias("p"), hashing.decode_line_ids(hashing.encode_line_ids(F.col("ids"))).alias("q")).first()
    assert row["p"] == packed
    assert row["q"] == ids


def test_long_packing_has_no_line_breaks(spark):
    df = spark.createDataFrame([(list(range(200)),)], "ids array<int>")
    row = df.select(hashing.encode_line_ids(F.col("ids")).alias("p"), hashing.decode_line_ids(hashing.encode_line_ids(F.col("ids"))).alias("q")).first()
    assert "\n" not in row["p"] and row["q"] == list(range(200))


def test_bad_line_ids_are_null(spark):
    assert value(spark, hashing.decode_line_ids, "!!") is None


def test_hashes_and_keys(spark):
    import base64
    import hashlib

    x = "Hello"
    assert value(spark, hashing.text_hash, x) == hashlib.sha1(x.encode()).hexdigest()[:16]
    packed = value(spark, lambda c: hashing.encode_hashes(F.array(hashing.text_hash_32(c), hashing.text_hash_32(c))), x)
    assert base64.b64decode(packed) == hashlib.sha1(x.encode()).digest()[:4] * 2
    assert value(spark, hashing.decode_hashes, packed) == [hashlib.sha1(x.encode()).hexdigest()[:8]] * 2
    digest = "sha1:S3DTWCONT2L6ORTGCY2KXEZ37LNBB7V2"
    assert value(spark, hashing.document_key, digest) == base64.b32decode(digest[5:])[:4].hex()
    assert value(spark, hashing.document_key, "md5:1") is None


def test_let_binds_once(spark):
    assert value(spark, lambda c: let(F.upper(c), lambda u: F.concat(u, u)), "ab") == "ABAB"
