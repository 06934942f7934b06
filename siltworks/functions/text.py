"""Text normalization as column expressions.

Every pattern is valid for Java, RE2 and Python, and spelled out where their shorthand classes differ: white space is
what Python strips, digits are the Unicode class.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode punctuation and its plain form (fixed values).
PUNCT = {
    "，": ",",
    "。": ".",
    "、": ",",
    "„": '"',
    "”": '"',
    "“": '"',
    "«": '"',
    "»": '"',
    "１": '"',
    "」": '"',
    "「": '"',
    "《": '"',
    "》": '"',
    "´": "'",
    "∶": ":",
    "：": ":",
    "？": "?",
    "！": "!",
    "（": "(",
    "）": ")",
    "；": ";",
    "–": "-",
    "—": " - ",
    "．": ". ",
    "～": "~",
    "’": "'",
    "…": "...",
    "━": "-",
    "〈": "<",
    "〉": ">",
    "【": "[",
    "】": "]",
    "％": "%",
    "►": "-",
}
_ONE = {k: v for k, v in PUNCT.items() if len(v) == 1}
_MANY = {k: v for k, v in PUNCT.items() if len(v) > 1}
ONE_FROM, ONE_TO = "".join(_ONE), "".join(_ONE.values())

SPACE_CLASS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIP = f"^{SPACE_CLASS}+|{SPACE_CLASS}+$"
CONTROL = r"[\x00-\x1f\x7f-\x{9f}]"
PUNCT_CLASS = "[" + "".join(PUNCT) + "]"
#: The same classes as strings of their characters, for ``btrim`` and ``translate``, which look a character up instead of trying a class's parts.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
CONTROLS = "".join(map(chr, [*range(0x20), *range(0x7F, 0xA0)]))
DEDUP_DROP = "[" + "".join(PUNCT) + r"\x00-\x1f\x7f-\x{9f}]"


def strip(col: Column) -> Column:
    """Without white space at both ends, by Python's notion of it."""
    return F.btrim(col, F.lit(SPACES))


def zero_digits(col: Column) -> Column:
    return F.regexp_replace(col, r"\p{Nd}", "0")


def replace_unicode_punct(col: Column) -> Column:
    out = F.translate(col, ONE_FROM, ONE_TO)
    for k, v in _MANY.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def remove_unicode_punct(col: Column) -> Column:
    return F.translate(col, "".join(PUNCT), "")


def remove_non_printing(col: Column) -> Column:
    """Without control characters; a tab or line feed vanishes, it does not become a space."""
    return F.translate(col, CONTROLS, "")


@F.pandas_udf(T.StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    """Decomposed, without combining marks. Spark has no such function, so this is the one that runs in Python."""

    def one(text):
        if text is None or text.isascii():
            return text
        return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")

    return texts.map(one, na_action="ignore")


def normalize(col: Column, accent: bool = True, case: bool = True, numbers: bool = True, punct: int = 1) -> Column:
    """Strip, lower case, accents, digits, punctuation (1 replaces, 2 removes, 0 keeps), control characters."""
    out = strip(col)
    if case:
        out = F.lower(out)
    if accent:
        out = strip_accents(out)
    if numbers:
        out = zero_digits(out)
    if punct:
        out = replace_unicode_punct(out) if punct == 1 else remove_unicode_punct(out)
    return remove_non_printing(out)


def normalize_for_dedup(col: Column) -> Column:
    """Equal to ``normalize`` without accents and with punctuation removed, in one pass less."""
    return F.translate(zero_digits(F.lower(strip(col))), "".join(PUNCT) + CONTROLS, "")


def _literal(col: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


#: Replacements of spacing and quotes in their order, and languages with a comma between digits (fixed values).
SPACING_FIRST = (("\r", ""), ("(", " ("), (")", ") "))
SPACING_INNER = (("( ", "("), (" )", ")"))
SPACING_MARKS = (
    (" :", ":"), (" ;", ";"), ("`", "'"), ("''", ' " '),
    ("„", '"'), ("“", '"'), ("”", '"'), ("–", "-"), ("—", " - "), ("´", "'"),
    ("‘", '"'), ("‚", '"'), ("’", '"'), ("''", '"'), ("…", "..."),
    (" « ", ' "'), ("« ", '"'), ("«", '"'), (" » ", '" '), (" »", '"'), ("»", '"'),
    (" %", "%"), (" :", ":"), (" ?", "?"), (" !", "!"), (" ;", ";"), ("．", ". "),
)
COMMA_LANGUAGES = ("de", "es", "cz", "cs", "fr")


def spacing_for_tokens(col: Column, language: str = "en", strict_compat: bool = False) -> Column:
    """Spacing and quotes as word tokenizers expect them, by language.

    ``strict_compat`` keeps three slips of the original: replacements that emit a literal backslash before the
    bracket, per cent sign or quote they move.
    """
    slip = "\\\\" if strict_compat else ""  # a doubled backslash is one in a Java replacement
    out = _literal(col, *SPACING_FIRST)
    out = F.regexp_replace(out, r"\) ([.!:?;,])", slip + r")$1")
    out = _literal(out, *SPACING_INNER)
    out = F.regexp_replace(out, r"(\p{Nd}) %", "$1" + slip + "%")
    out = _literal(out, *SPACING_MARKS)
    if language == "en":
        out = F.regexp_replace(out, r'"([,.]+)', "$1" + slip + '"')
    elif language not in ("cs", "cz"):
        out = _literal(out, (',"', '",'))
        out = F.regexp_replace(out, r'(\.+)"(' + SPACE_CLASS + r"*[^<])", slip + '"$1$2')
    between = "," if language in COMMA_LANGUAGES else "."
    return F.regexp_replace(out, r"(\p{Nd}) (\p{Nd})", "$1" + between + "$2")


#: Place holder of a line break inside a field (fixed value).
NEWLINE = " N3WL1N3 "


def escape_newlines(col: Column, token: str = NEWLINE) -> Column:
    return F.replace(col, F.lit("\n"), F.lit(token))


def unescape_newlines(col: Column, token: str = NEWLINE) -> Column:
    return F.replace(col, F.lit(token), F.lit("\n"))


#: Languages whose words lose their accents (fixed values).
PLAIN_LANGUAGES = ("en", "my")
#: A word with inner apostrophes and hyphens, or one other mark.
WORD_TOKEN = r"[\p{L}\p{M}\p{N}]+(?:['’-][\p{L}\p{M}\p{N}]+)*|[^\t\n\x0b\x0c\r \p{L}\p{M}\p{N}]"


def word_tokens(col: Column, language: str = "en", accents: bool = True) -> Column:
    """Words, numbers and single marks of a text, after normalization and spacing; languages without spaces pass as one token.

    Languages that lose their accents do so here unless ``accents`` is false, as where that has been done before.
    """
    if language in ("th", "zh", "ja"):
        return F.array(col)
    clean = spacing_for_tokens(normalize(col, accent=accents and language in PLAIN_LANGUAGES, case=False, numbers=False, punct=1), language)
    return F.regexp_extract_all(clean, F.lit(f"({WORD_TOKEN})"), 1)


def by_language(language: Column, languages: tuple[str, ...], of: Callable[[str], Column], other: str = "en") -> Column:
    """``of`` each row's language, of ``other`` for null and unlisted ones."""
    out = F.when(F.lit(False), None)
    for lang in languages:
        out = out.when(language == lang, of(lang))
    return out.otherwise(of(other))


def tokenize_documents(df: DataFrame, languages: tuple[str, ...], text: str = "raw_content", out: str = "tokenized", language: str = "language") -> DataFrame:
    """``df`` with the word tokens of each line of ``text`` by the rules of the row's language, separated by spaces, lines as they were."""
    # accents go for whole texts, as they are taken off in Python
    plain = by_language(df[language], languages, lambda lang: strip_accents(df[text]) if lang in PLAIN_LANGUAGES else df[text])
    found = F.transform(F.split(plain, "\n"), lambda x: by_language(df[language], languages, lambda lang: F.array_join(word_tokens(x, lang, False), " ")))
    return df.withColumn(out, F.array_join(found, "\n"))


# The same expressions for the SQL oracles; ``x`` is any SQL text expression.


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {_quoted(STRIP)}, '', 'g')"


def sql_dedup(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({sql_strip(x)}), '\p{{Nd}}', '0', 'g'), {_quoted(DEDUP_DROP)}, '', 'g')"


def sql_replace_punct(x: str) -> str:
    out = f"translate({x}, {_quoted(ONE_FROM)}, {_quoted(ONE_TO)})"
    for k, v in _MANY.items():
        out = f"replace({out}, {_quoted(k)}, {_quoted(v)})"
    return out


def sql_control(x: str) -> str:
    return f"regexp_replace({x}, {_quoted(CONTROL)}, '', 'g')"


def _sql_literal(x: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        x = f"replace({x}, {_quoted(old)}, {_quoted(new)})"
    return x


def sql_spacing(x: str, language: str = "en") -> str:
    out = _sql_literal(x, *SPACING_FIRST)
    out = rf"regexp_replace({out}, '\) ([.!:?;,])', ')\1', 'g')"
    out = _sql_literal(out, *SPACING_INNER)
    out = rf"regexp_replace({out}, '(\p{{Nd}}) %', '\1%', 'g')"
    out = _sql_literal(out, *SPACING_MARKS)
    if language == "en":
        out = rf"""regexp_replace({out}, '"([,.]+)', '\1"', 'g')"""
    elif language not in ("cs", "cz"):
        out = _sql_literal(out, (',"', '",'))
        out = rf"""regexp_replace({out}, {_quoted(r'(\.+)"(' + SPACE_CLASS + '*[^<])')}, '"\1\2', 'g')"""
    between = "," if language in COMMA_LANGUAGES else "."
    return rf"regexp_replace({out}, '(\p{{Nd}}) (\p{{Nd}})', '\1{between}\2', 'g')"


def sql_word_tokens(x: str, language: str = "en") -> str:
    if language in ("th", "zh", "ja"):
        return f"[{x}]"
    clean = sql_strip(x)
    if language in ("en", "my"):
        clean = f"strip_accents({clean})"
    clean = sql_spacing(sql_control(sql_replace_punct(clean)), language)
    return f"regexp_extract_all({clean}, {_quoted(WORD_TOKEN)})"
