"""Statistics of one text that tell prose, lists, tables, code, noise and spam apart."""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from functools import lru_cache
from operator import itemgetter

#: Frequent function words by language (fixed values); Chinese ones are characters.
FUNCTION_WORDS = {
    "en": "the of and a an to in is was were are be been that it for on with as by at from had have not but this which they she he we or if when because could would who there".split(),
    "de": "der die das und in den von zu mit ist war dem des ein eine einen nicht auf für als auch wurde hat haben im am wird sich bei nach aus wir weil obwohl wenn dass noch".split(),
    "fr": "le la les de des du et à un une en est dans que qui pour par sur avec ne pas au aux a ont été nous il elle mais sans plus puis ni se car".split(),
    "es": "el la los las de del y en un una que es por con para no se al lo su ha han había fue todos pero como más sin ni hay porque aunque cuando".split(),
    "ru": "и в не на что с по а но он она они к у за из от для это как бы до без был была было были его её их там так где если когда который который уже ещё".split(),
    "zh": list("的了在是和不有就被这个们我他她说没但因为所以后来而也还很与之"),
}
_LANGUAGE_OF: dict[str, tuple[str, ...]] = {}
for _lang, _ws in FUNCTION_WORDS.items():
    for _w in _ws:
        _LANGUAGE_OF[_w] = (*_LANGUAGE_OF.get(_w, ()), _lang)

#: Scripts written without spaces, in which every character counts as a word: Han; Thai, Lao, Burmese and Khmer with their marks.
_HAN, _UNSPACED = "㐀-鿿", "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff"
#: Marks that belong to the letter before them (Arabic, Hebrew, the scripts of India, combining accents).
_JOINED = r"\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0670\u0900-\u0903\u093a-\u094f\u0981-\u0983\u09bc-\u09d7\u0b82\u0bbe-\u0bcd\u0c3e-\u0c56\u0d3e-\u0d4d"
_WORD = re.compile(rf"[{_HAN}]|[{_UNSPACED}]|(?:[^\W_{_HAN}{_UNSPACED}]|[{_JOINED}])+")
#: The same for texts without characters of the last two kinds, and for texts of ASCII only, which are faster.
_FEWER, _PLAIN = re.compile(rf"[{_HAN}]|[^\W_{_HAN}]+"), re.compile(r"[a-zA-Z0-9]+")
_SPECIAL = re.compile(rf"[{_UNSPACED}{_JOINED}]")
_LINK = re.compile(r"<a\b[^>]*>|</a>|\[/?url[^\]]*\]|https?://\S+|www\.\S+|\b[\w-]+(?:\.[\w-]+)*\.(?:example|com|net|org|info|biz|[a-z]{2})\b(?:[/:?]\S*)?", re.I)
_MAY_LINK = re.compile(r"\w\.[a-z]|://|</?a\b|\[/?url", re.I)
_DIGIT = re.compile(r"\d")
_SYMBOL = re.compile(r"[^\w\s]|_")
_COLUMNS = re.compile(r"\s{2,}|\t|\s\|\s|;|,")
_END = re.compile(r"(?<!\.)(?:[.!?。！？؟۔।]{1,3}|\.{3}[!?])(?!\.)[\"”»“’'«)\]]*(?=\s|$|[^\x00-ɏ\s])")
_MARKS = re.compile(r"[|»«›‹•·;,/#~+*>、，]|\s[-–—]\s")
_BULLET = re.compile(r"\s*(?:[-–—*•·>+»]|\d{1,3}[.):]|[a-z][.)])\s+")

#: A content word is heavy above this share of all content words.
HEAVY = 0.08
#: Share of function words under which a text may be of a language that has no list, and the share that stands in for it then.
LISTED, UNLISTED_SHARE = 0.3, 0.4
#: Least share of words in sentences by rules that know no language for a text to count as prose of a language without a list.
FREE = 0.5
#: How much more of its words must be in sentences by those rules than by the likeliest list, and the share of links from which they say nothing.
GAIN, LINKED = 0.2, 0.15
#: Letters up to which a word of such a language may be a function word.
GLUE = 3
#: Share of the words of prose in such a language that are short and occur again, at least, and the standard deviations by which their number may fall short.
REPEATED, SHORT_BY = 0.03, 1.55

NAMES = [
    "words", "function", "sentences", "lines", "line_words", "ended", "bullets", "digits", "symbols", "links", "marks",
    "top_word", "top_five", "distinct", "entropy", "packed", "pairs", "word_length", "odd_words", "tabular",
]


def page_stats(text: str | None) -> tuple[str, list[float]] | None:
    """Language guess and the values of ``NAMES``; None for null or blank text.

    A text that no list of function words reads as prose, but rules that know no language do, is ``und``: its share of function words is unknown and set
    to that of prose, its words in sentences are those by these rules.

    words: count. function: share of function words of the likeliest language. sentences: share of words in well-formed
    sentences or long lines of prose. lines, line_words: non-blank lines and words per line. ended: share of lines that end a sentence. bullets: share of lines
    with a bullet or number. digits, symbols: shares of characters. links: share of characters in links. marks: separators per
    word. top_word, top_five: share of the commonest content words. distinct: distinct content words per content word.
    entropy: of content words, over its maximum. packed: compressed over plain size. pairs: distinct over all word pairs.
    word_length: mean. odd_words: share of words that mix cases, digits and letters or lack vowels. tabular: share of lines made of several columns.
    """
    if not text or not text.strip():
        return None
    bare = _LINK.sub(" ", text) if _MAY_LINK.search(text) else text
    lines = [x.strip() for x in bare.split("\n")]
    lines = [x for x in lines if x]
    # link-only lines count as lines too
    raw_lines = sum(1 for x in text.split("\n") if x.strip())
    find = (_PLAIN if bare.isascii() else _WORD if _SPECIAL.search(bare) else _FEWER).findall
    words = find(bare)
    low = _lower(words)
    n = len(low)
    size = len(text)
    by_language: Counter[str] = Counter()
    every = Counter(low)
    for w in every.keys() & _LANGUAGE_OF.keys():
        for lang in _LANGUAGE_OF[w]:
            by_language[lang] += every[w]
    language, hits = by_language.most_common(1)[0] if by_language else ("und", 0)
    own = set(FUNCTION_WORDS.get(language, ()))
    counts = {w: c for w, c in every.items() if w not in own}
    m = max(1, sum(counts.values()))
    top = heapq.nlargest(5, counts.items(), key=itemgetter(1))
    # -sum(c / m log(c / m)), over its most
    entropy = 1 - sum(map(_count_log, counts.values())) / m / math.log(m) if m > 1 else 0.0
    heavy = {w for w, c in top if c >= 6 and c > HEAVY * m}
    good = _prose_words(bare, find, lambda found, least, count: _reads(found, own, heavy, least, count))
    function = hits / max(1, n)
    links = 1 - len(bare.replace(" ", "")) / max(1, len(text.replace(" ", "")))
    if function < LISTED and good < 0.65 * n and links < LINKED:
        free = _unlisted_words(bare, find, every, n, m)
        if free >= max(FREE * n, good + GAIN * n):
            language, function, good = "und", UNLISTED_SHARE, free
    letters = sum(map(len, words))
    digits = len(_DIGIT.findall(text))
    symbols = len(_SYMBOL.findall(text))
    data = text.encode("utf-8", "surrogatepass")
    pairs = list(zip(low, low[1:], strict=False))
    return language, [
        float(n),
        function,
        good / max(1, n),
        float(raw_lines),
        n / max(1, raw_lines),
        sum(1 for x in lines if _END.search(x[-4:])) / max(1, raw_lines),
        sum(1 for x in lines if _BULLET.match(x)) / max(1, raw_lines),
        digits / size,
        symbols / size,
        links,
        len(_MARKS.findall(bare)) / max(1, n),
        (top[0][1] if top else 0) / m,
        sum(c for _, c in top) / m,
        len(counts) / m,
        entropy,
        len(zlib.compress(data, 3)) / len(data),
        len(set(pairs)) / max(1, len(pairs)),
        letters / max(1, n),
        sum(c for w, c in Counter(words).items() if _odd(w)) / max(1, n),
        sum(1 for x in lines if len(x) < 120 and len(_COLUMNS.split(x)) > 2 and len(find(x)) < 16) / max(1, raw_lines),
    ]


def _lower(words: list[str]) -> list[str]:
    return " ".join(words).lower().split(" ") if words else []


@lru_cache(maxsize=10_000)
def _count_log(c: int) -> float:
    return c * math.log(c)


@lru_cache(maxsize=200_000)
def _odd(word: str) -> bool:
    if len(word) < 2 or word.isdigit():
        return False
    digits = any(c.isdigit() for c in word)
    return (digits and any(c.isalpha() for c in word)) or (word.lower() != word.upper() and not word.islower() and not word.isupper() and not word[1:].islower()) or len(word) > 30


def _prose_words(text: str, find, reads) -> int:
    """Words, as ``find`` cuts them, in stretches that read as prose: ``reads(words, least number, lines)`` says whether one does."""
    good = 0
    at = 0
    stretches = []
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        stretches.append((text[at:end], end < len(text) or bool(_END.search(text[-4:]))))
        at = end
    for piece, ended in stretches:
        if ended:
            # a heading or list above a sentence is not part of it
            lines = [x for x in piece.split("\n") if x.strip()]
            found = find(" ".join(lines))
            if len(found) > 70 and len(lines) > 1:
                found = find(lines[-1])
            if reads(found, 5, len(lines)):
                good += len(found)
                continue
        for line in piece.split("\n"):
            found = find(line)
            if len(found) >= 20 and len(_MARKS.findall(line)) < 0.2 * len(found) and reads(found, 20, 1):
                good += len(found)
    return good


def _unlisted_words(text: str, find, every: Counter, n: int, m: int) -> int:
    """Words in sentences by rules that know no language: for texts whose language has no list of function words.

    Prose of any language has short words, repeats some of them, and does not use letters at random. Whether a
    stretch reads as prose is then told by its words alone: few numbers and odd words, no heavy content word, not all in capitals.
    """
    letters = Counter("".join(every.elements()))
    total = sum(letters.values())
    spread = -sum(c / total * math.log2(c / total) for c in letters.values()) if total else 0.0
    kana = sum(c for x, c in letters.items() if "\u3040" <= x <= "\u30ff")
    han = sum(c for x, c in letters.items() if "\u3400" <= x <= "\u9fff")
    if han > 9 * kana and han > 0.3 * total:
        return 0  # Chinese, which has a list
    spaced = not kana and not any("\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" for c in letters)
    if spaced:
        latin = sum(c for x, c in letters.items() if x < "\u0250")
        if latin > 0.9 * total and spread > 4.55:
            return 0
        again = sum(c for w, c in every.items() if c > 1 and len(w) <= GLUE)
        if again < REPEATED * n - SHORT_BY * math.sqrt(REPEATED * n):
            return 0
    heavy = {w for w, c in every.items() if c >= 6 and c > HEAVY * m and len(w) > GLUE} if spaced else set()

    def reads(found: list[str], least: int, lines: int) -> bool:
        k = len(found)
        if k < least or k < 3 * lines:
            return False
        low = _lower(found)
        if heavy and sum(w in heavy for w in low) > max(2, HEAVY * k):
            return False
        if sum(w.isdigit() or _odd(w) for w in found) > 0.2 * k:
            return False
        if spaced:
            short = sum(len(w) <= GLUE and w.isalpha() for w in low)
            capital = sum(w[:1].isupper() for w in found)
            if capital > 0.6 * k or not 2 <= sum(map(len, found)) / k <= 14 or (k >= 12 and short < 0.04 * k):
                return False
            if least >= 20 and (capital > 0.2 * k or short < 0.15 * k):  # a long line without an end
                return False
        return len(set(low)) >= 0.5 * k / (1 + k / 150) if spaced else len(set(low)) >= min(0.25 * k, 12)

    return _prose_words(text, find, reads)


def _reads(found: list[str], own: set[str], heavy: set[str], least: int, lines: int) -> bool:
    n = len(found)
    if n < least or n < 3 * lines:
        return False
    low = _lower(found)
    if heavy and sum(map(heavy.__contains__, low)) > max(2, HEAVY * n):
        return False
    rest = [w for w in low if w not in own]
    shared = 1 - len(rest) / n
    return 0.12 <= shared <= 0.75 and len(set(rest)) >= 0.55 * len(rest) / (1 + len(rest) / 150)
