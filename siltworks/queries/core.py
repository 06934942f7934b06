"""Queries over the test tables for the operators outside ``llm``, each with the SQL that must give the same rows."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import hashing, pieces, text, urls
from siltworks.operators import buckets, dedup, describe, lid, lm, metadata, tags, verbs
from siltworks.plans.config import BASE
from siltworks.plans.pipeline import Pipeline
from siltworks.queries.registry import query
from siltworks.session import materialize, spread, table
from siltworks.sources import readers, sinks

SHARDS = 8
#: Languages of the tables, and where the files of public tokenizers lie.
LANGUAGES = ("en", "de", "fr", "es", "ru", "zh")
TOKENIZERS = os.environ.get("SILTWORKS_TOKENIZERS", "/opt/tokenizers")
NETLOC_SQL = "regexp_extract({0}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def mined(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "mined_docs"))


def line_rows(spark: SparkSession, d: str) -> DataFrame:
    """``doc, pos, line`` of all documents with text."""
    df = documents(spark, d).filter(F.length("text") > 0)
    return df.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))


LINES = """
lines AS (SELECT doc_id AS doc, (i - 1)::INT AS pos, parts[i] AS line, len(parts) AS original_nlines, full_text
          FROM (SELECT doc_id, text AS full_text, string_split(text, chr(10)) AS parts FROM documents WHERE length(text) > 0),
               unnest(generate_series(1, len(parts))) AS t(i))"""
HASHED = f"{LINES},\nhashed AS (SELECT *, substr(sha1({text.sql_dedup('line')}), 1, 16) AS hash FROM lines)"


# --- text functions ---------------------------------------------------------------------------------------------


@query(f"WITH {LINES} SELECT doc, pos, {text.sql_dedup('line')} AS norm FROM lines")
def normalize_for_dedup_lines(spark, d):
    return line_rows(spark, d).select("doc", "pos", text.normalize_for_dedup(F.col("line")).alias("norm"))


@query(
    f"WITH {LINES} SELECT doc, pos, {text.sql_control(text.sql_replace_punct(f'regexp_replace(lower({text.sql_strip("line")}), {chr(39)}{chr(92)}p{{Nd}}{chr(39)}, {chr(39)}0{chr(39)}, {chr(39)}g{chr(39)})'))} AS norm FROM lines"
)
def normalize_keep_accents(spark, d):
    return line_rows(spark, d).select("doc", "pos", text.normalize(F.col("line"), accent=False).alias("norm"))


@query(f"SELECT doc_id, {text.sql_control('text')} AS clean FROM documents")
def remove_control_chars(spark, d):
    return documents(spark, d).select("doc_id", text.remove_non_printing(F.col("text")).alias("clean"))


@query(f"SELECT doc_id, {text.sql_replace_punct('text')} AS clean FROM documents")
def replace_unicode_punct(spark, d):
    return documents(spark, d).select("doc_id", text.replace_unicode_punct(F.col("text")).alias("clean"))


@query(f"SELECT doc_id, regexp_replace(text, '{text.PUNCT_CLASS}', '', 'g') AS clean FROM documents")
def remove_unicode_punct(spark, d):
    return documents(spark, d).select("doc_id", text.remove_unicode_punct(F.col("text")).alias("clean"))


@query("SELECT doc_id, strip_accents(text) AS clean FROM documents")
def strip_accents(spark, d):
    return documents(spark, d).select("doc_id", text.strip_accents(F.col("text")).alias("clean"))


def _by_language(of) -> Column:
    return text.by_language(F.col("lang"), LANGUAGES, of)


def _sql_by_language(of) -> str:
    return "CASE " + " ".join(f"WHEN lang = '{x}' THEN {of(x)}" for x in LANGUAGES) + f" ELSE {of('en')} END"


@query(f"SELECT doc_id, {_sql_by_language(lambda x: text.sql_spacing('text', x))} AS spaced FROM documents")
def spacing_for_tokens(spark, d):
    return documents(spark, d).select("doc_id", _by_language(lambda x: text.spacing_for_tokens(F.col("text"), x)).alias("spaced"))


@query(f"SELECT doc_id, array_to_string({_sql_by_language(lambda x: text.sql_word_tokens('text', x))}, ' ') AS tokens FROM documents")
def word_tokens(spark, d):
    return documents(spark, d).select("doc_id", F.array_join(_by_language(lambda x: text.word_tokens(F.col("text"), x)), " ").alias("tokens"))


@query("SELECT doc_id, ltrim(text, ' ') AS text FROM documents WHERE text <> ''")
def sp_pieces(spark, d):
    """Cuts texts into pieces and puts them together again; the oracle has the texts as they are, but for spaces before the first word."""
    model = os.path.join(TOKENIZERS, "piece_bpe_32k.model")
    found = documents(spark, d).filter("text <> ''").select("doc_id", pieces.joined(pieces.pieces(F.col("text"), model)).alias("tokenized"))
    return found.select("doc_id", F.ltrim(pieces.from_pieces(F.col("tokenized"), model)).alias("text"))


@query("SELECT doc_id, replace(text, chr(10), ' N3WL1N3 ') AS escaped FROM documents")
def escape_newlines(spark, d):
    return documents(spark, d).select("doc_id", text.escape_newlines(F.col("text")).alias("escaped"))


@query(f"SELECT page_id, {NETLOC_SQL.format('url')} AS netloc FROM wet_pages")
def url_netloc(spark, d):
    return table(spark, d, "wet_pages").select("page_id", urls.netloc(F.col("url")).alias("netloc"))


# --- hashes -----------------------------------------------------------------------------------------------------


@query(f"WITH {HASHED} SELECT doc, pos, hash FROM hashed")
def line_hashes(spark, d):
    return line_rows(spark, d).select("doc", "pos", hashing.line_hash(F.col("line")).alias("hash"))


@query(f"WITH {LINES} SELECT doc, pos, substr(sha1(line), 1, 8) AS hash FROM lines")
def line_hashes_32(spark, d):
    return line_rows(spark, d).select("doc", "pos", hashing.text_hash_32(F.col("line")).alias("hash"))


@query(f"WITH {LINES}, p AS (SELECT doc, string_agg(substr(sha1(line), 1, 8), '' ORDER BY pos) AS h FROM lines GROUP BY doc) SELECT doc, base64(unhex(h)) AS packed FROM p")
def packed_line_hashes(spark, d):
    df = documents(spark, d).filter(F.length("text") > 0)
    hashes = F.transform(F.split("text", "\n"), hashing.text_hash_32)
    return df.select(F.col("doc_id").alias("doc"), hashing.encode_hashes(hashes).alias("packed"))


@query(f"WITH {LINES} SELECT doc, string_agg(substr(sha1(line), 1, 8), ',' ORDER BY pos) AS hashes FROM lines GROUP BY doc")
def unpacked_line_hashes(spark, d):
    """Packs the hashes of a document's lines and unpacks them again."""
    df = documents(spark, d).filter(F.length("text") > 0)
    packed = hashing.encode_hashes(F.transform(F.split("text", "\n"), hashing.text_hash_32))
    return df.select(F.col("doc_id").alias("doc"), F.array_join(hashing.decode_hashes(packed), ",").alias("hashes"))


_PACKED = "CASE WHEN line_ids IS NOT NULL THEN base64(unhex(coalesce(list_aggregate(list_transform(line_ids, lambda i: printf('%02x%02x', i % 256, i // 256)), 'string_agg', ''), ''))) END"


@query(f"SELECT mined_id, {_PACKED} AS packed FROM mined_docs")
def minify_line_ids(spark, d):
    return mined(spark, d).select("mined_id", hashing.encode_line_ids(F.col("line_ids")).alias("packed"))


@query("SELECT mined_id, array_to_string(line_ids, ',') AS ids FROM mined_docs")
def line_ids_roundtrip(spark, d):
    """Packs and unpacks; the oracle has the ids as they are."""
    ids = hashing.decode_line_ids(hashing.encode_line_ids(F.col("line_ids")))
    return mined(spark, d).select("mined_id", F.array_join(ids.cast("array<string>"), ",").alias("ids"))


_KEY = "upper(regexp_replace(digest, '^sha1:', ''))"
_KEY_SQL = " + ".join(f"(instr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', substr({_KEY}, {i + 1}, 1)) - 1)::BIGINT * {32 ** (6 - i)}" for i in range(7))


@query(f"SELECT mined_id, CASE WHEN regexp_matches({_KEY}, '^[A-Z2-7]{{7}}') THEN printf('%08x', ({_KEY_SQL}) // 8) END AS key FROM mined_docs")
def document_keys(spark, d):
    return mined(spark, d).select("mined_id", hashing.document_key(F.col("digest")).alias("key"))


# --- deduplication ----------------------------------------------------------------------------------------------


def _lines(spark, d, keep=()):
    df = documents(spark, d).withColumn("shard", (F.col("doc_id") % SHARDS).cast("int"))
    return dedup.documents_with_lines(df, keep=keep)


REBUILT = """SELECT doc AS doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*)::INT AS nlines,
  length(string_agg(line, chr(10) ORDER BY pos))::INT AS length, any_value(original_nlines)::INT AS original_nlines,
  length(any_value(full_text))::INT AS original_length, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS line_ids
FROM {0} GROUP BY doc"""


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("line_ids", F.array_join(F.col("line_ids").cast("array<string>"), ","))


@query(f"WITH {HASHED} SELECT hash, count(DISTINCT doc) AS n_docs FROM hashed GROUP BY hash")
def hash_collector(spark, d):
    return dedup.collect_hashes(_lines(spark, d))


@query(f"WITH {HASHED} SELECT (doc % {SHARDS})::INT AS shard, hash, count(DISTINCT doc) AS n_docs FROM hashed GROUP BY ALL")
def hash_collector_by_shard(spark, d):
    return dedup.collect_hashes(_lines(spark, d, ("shard",)), ("shard",))


@query(f"WITH {HASHED} SELECT hash, count(DISTINCT doc) AS n_docs FROM hashed GROUP BY hash")
def hash_merge_shards(spark, d):
    """Final counts from the partial ones of shards, which have disjoint documents."""
    return dedup.merge_hashes(dedup.collect_hashes(_lines(spark, d, ("shard",)), ("shard",)))


_TWO_PASS = """kept AS (SELECT h.* FROM hashed h ANTI JOIN (SELECT {0} hash FROM hashed GROUP BY ALL HAVING count(DISTINCT doc) >= 2) x USING ({1} hash)
  QUALIFY row_number() OVER (PARTITION BY doc, hash ORDER BY pos) = 1)"""


@query(f"WITH {HASHED}, {_TWO_PASS.format('', '')} {REBUILT.format('kept')}")
def dedup_two_pass(spark, d):
    return _shown(dedup.rebuild(documents(spark, d), dedup.two_pass_lines(_lines(spark, d))))


@query(
    f"WITH {HASHED.replace('FROM lines)', f', ((doc % {SHARDS}) // 2)::INT AS scope FROM lines)')}, {_TWO_PASS.format('scope,', 'scope,')} {REBUILT.format('kept')}"
)
def dedup_grouped_scope(spark, d):
    """Hashes are shared by two shards at a time."""
    lines = _lines(spark, d, ("shard",)).withColumn("scope", dedup.shard_scope(F.col("shard"), 2)).drop("shard")
    return _shown(dedup.rebuild(documents(spark, d), dedup.two_pass_lines(lines, ("scope",))))


@query(f"WITH {HASHED}, kept AS (SELECT * FROM hashed QUALIFY row_number() OVER (PARTITION BY hash ORDER BY doc, pos) = 1) {REBUILT.format('kept')}")
def dedup_keep_first(spark, d):
    return _shown(dedup.rebuild(documents(spark, d), dedup.keep_first_lines(_lines(spark, d))))


@query(
    f"WITH {HASHED}, {_TWO_PASS.format('', '')}, n AS (SELECT doc, count(*) AS n FROM kept GROUP BY doc) "
    "SELECT doc_id, coalesce(n, 0)::INT AS nlines FROM (SELECT doc_id FROM documents WHERE length(text) > 0) LEFT JOIN n ON doc = doc_id"
)
def dedup_keep_empty_docs(spark, d):
    return dedup.rebuild(documents(spark, d), dedup.two_pass_lines(_lines(spark, d)), keep_empty=True).select("doc_id", "nlines")


@query(
    f"WITH {HASHED}, kept AS (SELECT * FROM hashed QUALIFY row_number() OVER (PARTITION BY doc, hash ORDER BY pos) = 1) "
    "SELECT doc AS doc_id, count(*)::INT AS nlines, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS line_ids FROM kept GROUP BY doc"
)
def dedup_intra_doc_only(spark, d):
    return _shown(dedup.intra_document(documents(spark, d)))


@query(
    f"WITH {HASHED}, known AS (SELECT DISTINCT hash FROM hashed WHERE doc % {SHARDS} = 0), kept AS (SELECT h.* FROM hashed h ANTI JOIN known USING (hash) "
    "QUALIFY row_number() OVER (PARTITION BY doc, hash ORDER BY pos) = 1) SELECT doc, pos, hash FROM kept"
)
def dedup_against_known(spark, d):
    """All documents against the hashes of one shard."""
    lines = _lines(spark, d)
    known = dedup.exploded(lines).filter(F.col("doc") % SHARDS == 0)
    return dedup.known_lines_removed(lines, known)


@query(
    f"WITH {HASHED}, dups AS (SELECT hash FROM hashed GROUP BY hash HAVING count(DISTINCT doc) >= 2) "
    "SELECT d.lang, count(*) AS n_lines, count(x.hash) AS n_duplicates FROM hashed h JOIN documents d ON d.doc_id = h.doc LEFT JOIN dups x ON x.hash = h.hash GROUP BY d.lang"
)
def dedup_stats_by_lang(spark, d):
    lines = dedup.documents_with_lines(documents(spark, d), keep=("lang",))
    dups = dedup.duplicate_hashes(dedup.collect_hashes(lines)).withColumn("dup", F.lit(True))
    rows = dedup.exploded(lines).join(dups, "hash", "left")
    return rows.groupBy("lang").agg(F.count("*").alias("n_lines"), F.count("dup").alias("n_duplicates"))


@query(
    f"WITH {HASHED}, firsts AS (SELECT DISTINCT hash, doc, (doc % {SHARDS})::INT AS shard FROM hashed), "
    "second AS (SELECT hash, shard AS since FROM firsts QUALIFY row_number() OVER (PARTITION BY hash ORDER BY shard, doc) = 2) "
    "SELECT k::INT AS shards, count(*) AS n_lines, count(*) FILTER (since < k) AS n_duplicates FROM hashed LEFT JOIN second USING (hash), (SELECT unnest([0, 1, 2, 4, 8]) AS k) GROUP BY k"
)
def dedup_rate_curve(spark, d):
    return dedup.duplicate_rate(_lines(spark, d, ("shard",)), "shard", [0, 1, 2, 4, 8])


# --- verbs ------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, n_chars FROM documents WHERE length(text) >= 300")
def remove_small(spark, d):
    return verbs.remove_small(documents(spark, d), "text", 300).select("doc_id", "n_chars")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')")
def keep_lang_whitelist(spark, d):
    return verbs.keep_lang(documents(spark, d), "lang", ("de", "fr")).select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE lang IS NULL OR lang NOT IN ('en', 'zh')")
def keep_lang_blacklist(spark, d):
    return verbs.keep_lang(documents(spark, d), "lang", ("en",), ("en", "zh")).select("doc_id", "lang")


@query("SELECT mined_id, bucket FROM mined_docs WHERE coalesce(bucket, 'all') IN ('head', 'all')")
def keep_bucket(spark, d):
    return verbs.keep_bucket(mined(spark, d), ("head", "all")).select("mined_id", "bucket")


@query("SELECT doc_id FROM documents WHERE length(text) > 500 AND lang = 'en' AND n_chars % 2 = 0")
def where_expr(spark, d):
    return verbs.where(documents(spark, d), ["length({text}) > 500", "{lang} = 'en' and {n_chars} % 2 = 0"]).select("doc_id")


@query("SELECT doc_id::VARCHAR || chr(9) || coalesce(lang, 'None') || chr(9) || coalesce(length(text)::VARCHAR, 'None') AS line FROM documents")
def select_tsv(spark, d):
    return verbs.select(documents(spark, d), ["doc_id", "lang", "length({text})"])


@query("SELECT doc_id::VARCHAR || chr(9) || lang || chr(9) || title AS line FROM documents WHERE lang IS NOT NULL AND title IS NOT NULL")
def select_skip_empty(spark, d):
    return verbs.select(documents(spark, d), ["doc_id", "lang", "title"], skip_empty=True)


@query("SELECT event_id, user_id, value, event_type FROM events")
def merge_typed(spark, d):
    """Prints events as tab-separated text and reads the fields back with their types."""
    printed = verbs.select(table(spark, d, "events"), ["event_id", "user_id", "value", "event_type"])
    return verbs.merge(printed, ["event_id%i", "user_id%i", "value%f", "event_type"])


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def drop_keys(spark, d):
    return verbs.drop_keys(documents(spark, d), "text", "url", "title", "crawled_at")


@query("SELECT language || '_' || bucket AS split, count(*) AS docs FROM mined_docs WHERE language <> '' AND bucket <> '' GROUP BY ALL")
def split_counts(spark, d):
    return verbs.split_counts(mined(spark, d), "{language}_{bucket}")


@query("SELECT regexp_replace(regexp_extract(cc_segment, '[^/]*$', 0), '\\.warc\\.wet(\\.gz)?$', '.json.gz') AS file, count(*) AS docs FROM mined_docs GROUP BY ALL")
def split_by_segment(spark, d):
    return mined(spark, d).groupBy(sinks.segment_file(F.col("cc_segment")).alias("file")).agg(F.count("*").alias("docs"))


# --- describe ---------------------------------------------------------------------------------------------------


@query(
    " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS total, count({c}) AS present, avg(length({c}::VARCHAR)) AS avg_length FROM documents" for c in ("text", "lang", "title", "source"))
)
def describe_presence(spark, d):
    return describe.presence(documents(spark, d), ["text", "lang", "title", "source"])


@query("SELECT title AS label, count(*) AS n FROM documents WHERE length(title) <= 100 GROUP BY title HAVING count(*) >= 2 ORDER BY n DESC, label LIMIT 100")
def describe_labels_topk(spark, d):
    return describe.label_counts(documents(spark, d), "title", least=2)


_HIST = """WITH v AS (SELECT {x}::DOUBLE AS x, {w}::DOUBLE AS w FROM {t} WHERE {x} IS NOT NULL AND NOT isnan({x})),
e AS (SELECT {lo} AS lo, {hi} AS hi{src}),
c AS (SELECT CASE WHEN x = hi THEN {n} - 1 ELSE least(floor((x - lo) / (hi - lo) * {n})::INT, {n} - 1) END AS bin, sum(w) AS n FROM v, e WHERE x BETWEEN lo AND hi GROUP BY ALL)
SELECT b::INT AS bin, lo + (hi - lo) / {n} * b AS low, lo + (hi - lo) / {n} * (b + 1) AS high, coalesce(c.n, 0.0)::DOUBLE AS n{more}
FROM e, unnest(generate_series(0, {n} - 1)) AS t(b) LEFT JOIN c ON c.bin = b"""


@query(_HIST.format(x="value", w="1", t="events", lo="0.0::DOUBLE", hi="100.0::DOUBLE", src="", n=20, more=""))
def histogram_fixed(spark, d):
    return describe.histogram(table(spark, d, "events"), "value", 20, low=0.0, high=100.0)


@query(_HIST.format(x="n_chars", w="doc_id", t="documents", lo="min(x)", hi="max(x)", src=" FROM v", n=12, more=""))
def histogram_weighted(spark, d):
    return describe.histogram(documents(spark, d), "n_chars", 12, weight="doc_id")


@query(_HIST.format(x="n_chars", w="1", t="documents", lo="min(x)", hi="max(x)", src=" FROM v", n=12, more=", sum(coalesce(c.n, 0.0)) OVER (ORDER BY b) AS upto"))
def histogram_cumulative(spark, d):
    return describe.cumulative(describe.histogram(documents(spark, d), "n_chars", 12))


_DESCRIBE_SQL = """WITH v AS (SELECT n_chars::DOUBLE AS x FROM documents WHERE n_chars IS NOT NULL), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
c AS (SELECT CASE WHEN x = hi THEN 7 ELSE least(floor((x - lo) / (hi - lo) * 8)::INT, 7) END AS bin, count(*) AS n FROM v, e GROUP BY ALL)
SELECT 'lang' AS field, 'present' AS kind, NULL::VARCHAR AS label, NULL::DOUBLE AS low, NULL::DOUBLE AS high, count(lang)::DOUBLE AS n FROM documents
UNION ALL SELECT 'lang', 'length', NULL, NULL, NULL, avg(length(lang)) FROM documents
UNION ALL (SELECT 'lang', 'label', lang, NULL, NULL, count(*)::DOUBLE FROM documents WHERE length(lang) <= 100 GROUP BY lang HAVING count(*) >= 2 ORDER BY count(*) DESC, lang LIMIT 100)
UNION ALL SELECT 'n_chars', 'present', NULL, NULL, NULL, count(n_chars)::DOUBLE FROM documents
UNION ALL SELECT 'n_chars', 'bin', NULL, lo + (hi - lo) / 8 * b, lo + (hi - lo) / 8 * (b + 1), coalesce(c.n, 0)::DOUBLE FROM e, unnest(generate_series(0, 7)) AS t(b) LEFT JOIN c ON c.bin = b"""


@query(_DESCRIBE_SQL)
def describe_fields(spark, d):
    return describe.describe(documents(spark, d), ["lang", "n_chars"], bins=8)


# --- metadata ---------------------------------------------------------------------------------------------------


@query(
    f"SELECT url, digest, cc_segment, language, round(language_score, 2) AS language_score, round(perplexity, 1) AS perplexity, bucket, {_PACKED} AS line_ids FROM mined_docs"
)
def minify_docs(spark, d):
    return metadata.minify(mined(spark, d))


_FETCH = r"""WITH docs AS (SELECT mined_id, cc_segment, digest, url, raw_content FROM mined_docs WHERE cc_segment IS NOT NULL AND digest IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY cc_segment, digest ORDER BY mined_id) = 1),
meta AS (SELECT * FROM mini_docs WHERE cc_segment IS NOT NULL AND digest IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cc_segment, digest
  ORDER BY written_at DESC NULLS LAST, line_ids DESC NULLS LAST, perplexity DESC NULLS LAST, bucket DESC NULLS LAST, language DESC NULLS LAST) = 1),
bin AS (SELECT cc_segment, digest, url, language, bucket, hex(CASE WHEN regexp_full_match(line_ids, '([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?') THEN from_base64(line_ids) END) AS h FROM meta),
ids AS (SELECT *, list_transform(range(len(h) // 4), lambda i: ('0x' || substr(h, (i * 4 + 3)::INT, 2) || substr(h, (i * 4 + 1)::INT, 2))::INT) AS ids FROM bin),
joined AS (SELECT mined_id, coalesce(m.url, d.url) AS url, m.language, m.bucket, string_split(raw_content, chr(10)) AS parts, ids FROM docs d JOIN ids m USING (cc_segment, digest)),
kept AS (SELECT *, list_transform(list_filter(ids, lambda i: i < len(parts)), lambda i: parts[i + 1]) AS own FROM joined)
SELECT mined_id, url, language, bucket, coalesce(array_to_string(own, chr(10)), '') AS raw_content, coalesce(len(own), 0)::INT AS nlines, length(coalesce(array_to_string(own, chr(10)), ''))::INT AS length FROM kept"""


@query(_FETCH)
def fetch_metadata(spark, d):
    """Metadata of the latest version joined back to documents, of which the lines it names stay."""
    docs = mined(spark, d).select("mined_id", "cc_segment", "digest", "url", "raw_content", "nlines")
    latest = ["written_at", "line_ids", "perplexity", "bucket", "language"]
    out = metadata.fetch_metadata(docs, table(spark, d, "mini_docs"), latest, order=["mined_id"])
    return out.select("mined_id", "url", "language", "bucket", "raw_content", "nlines", "length")


@query("""WITH d AS (SELECT mined_id, string_split(raw_content, chr(10)) AS parts, list_distinct(list_filter(line_ids, lambda i: i BETWEEN 0 AND 65535)) AS ids FROM mined_docs
  WHERE raw_content IS NOT NULL AND digest IS NOT NULL AND cc_segment IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cc_segment, digest ORDER BY mined_id) = 1),
k AS (SELECT mined_id, list_transform(list_sort(list_filter(ids, lambda i: i < len(parts))), lambda i: parts[i + 1]) AS own FROM d)
SELECT mined_id, coalesce(array_to_string(own, chr(10)), '') AS raw_content, coalesce(len(own), 0)::INT AS nlines FROM k""")
def fetch_metadata_roundtrip(spark, d):
    """Minify with the lines that ``line_ids`` names, then fetch: those lines come back, in their order."""
    docs = mined(spark, d).filter("raw_content is not null and digest is not null and cc_segment is not null")
    full = metadata.one_version(docs.withColumn("neg", -F.col("mined_id")), ["cc_segment", "digest"], ["neg"]).drop("neg")
    full = full.withColumn("line_ids", F.array_sort(F.array_distinct(F.filter("line_ids", lambda i: i.between(0, 65_535)))))
    meta = metadata.minify(full)
    back = metadata.fetch_metadata(full.drop("line_ids", "language", "language_score", "perplexity", "bucket"), meta, ["line_ids"], order=["mined_id"])
    return back.select("mined_id", "raw_content", "nlines")


@query(
    "WITH m AS (SELECT * FROM mined_docs QUALIFY row_number() OVER (PARTITION BY cc_segment, digest ORDER BY mined_id) = 1), "
    "p AS (SELECT cc_segment, digest, language, perplexity, string_split(raw_content, chr(10)) AS parts, unnest(line_ids) AS i FROM m WHERE cc_segment IS NOT NULL AND digest IS NOT NULL AND raw_content IS NOT NULL) "
    "SELECT cc_segment, digest, language, parts[i + 1] AS text, perplexity AS lm_score FROM p WHERE i >= 0 AND i < len(parts)"
)
def paragraph_explode_join(spark, d):
    docs = metadata.one_version(mined(spark, d).withColumn("neg", -F.col("mined_id")), ["cc_segment", "digest"], ["neg"])
    same = {c: F.array_repeat(c, F.size("line_ids")) for c in ("language", "perplexity")}
    meta = docs.filter("line_ids is not null").select("cc_segment", "digest", "line_ids", same["language"].alias("languages"), same["perplexity"].alias("lm_scores"))
    return metadata.paragraphs(docs, meta)


@query("SELECT mined_id, language, '2018-34' AS snapshot FROM mined_docs WHERE language IS NULL OR language NOT IN ('en', 'de', 'fr', 'es', 'ru', 'zh') UNION ALL SELECT mined_id, language, '2018-51' FROM mined_docs")
def snapshot_filter(spark, d):
    """An earlier snapshot, which loses its big languages, and the latest."""
    df = mined(spark, d)
    parts = [metadata.snapshot_filter(df, s, "2018-51", LANGUAGES).select("mined_id", "language", F.lit(s).alias("snapshot")) for s in ("2018-34", "2018-51")]
    return parts[0].union(parts[1])


# --- language identification ------------------------------------------------------------------------------------

_GRAMS = r"""
clean AS (SELECT doc_id AS doc, lang, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' AS c FROM documents WHERE text IS NOT NULL),
grams AS (SELECT doc, lang, substr(c, i::INT, 3) AS gram FROM clean, unnest(generate_series(1, length(c) - 2)) AS t(i)),
counts AS (SELECT lang, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY ALL),
top AS (SELECT DISTINCT gram FROM (SELECT gram FROM counts QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= 400)),
filled AS (SELECT l.lang, t.gram, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang FROM counts) l CROSS JOIN top t LEFT JOIN counts c ON c.lang = l.lang AND c.gram = t.gram),
model AS (SELECT lang, gram, ln((n + 1) / sum(n + 1) OVER (PARTITION BY lang)) AS logp FROM filled),
sums AS (SELECT g.doc, m.lang, sum(m.logp) AS s FROM grams g JOIN model m USING (gram) GROUP BY ALL),
scored AS (SELECT doc, lang, s, round(exp(s - max(s) OVER (PARTITION BY doc)) / sum(exp(s - mx)) OVER (PARTITION BY doc), 2) AS score
           FROM (SELECT *, max(s) OVER (PARTITION BY doc) AS mx FROM sums)),
ranked AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY s DESC, lang)::INT AS rank, lang, score FROM scored)
"""


def _classified(spark, d, k=1, threshold=0.0):
    df = documents(spark, d)
    return lid.classify(df, materialize(lid.train(df), "lid"), k=k, threshold=threshold)


@query(f"WITH {_GRAMS} SELECT doc, rank, lang, score FROM ranked WHERE rank = 1")
def lid_top1(spark, d):
    return _classified(spark, d)


@query(f"WITH {_GRAMS} SELECT doc, rank, lang, score FROM ranked WHERE rank <= 5")
def lid_top5(spark, d):
    return _classified(spark, d, 5)


@query(f"WITH {_GRAMS} SELECT doc, rank, lang, score FROM ranked WHERE rank = 1 AND score >= 0.99")
def lid_threshold(spark, d):
    return _classified(spark, d, 1, 0.99)


@query(f"WITH {_GRAMS} SELECT d.lang AS before, r.lang AS after, count(*) AS docs FROM (SELECT doc_id, lang FROM documents) d FULL JOIN (SELECT * FROM ranked WHERE rank = 1) r ON r.doc = d.doc_id GROUP BY ALL")
def lid_disagreement(spark, d):
    """Stated language against the found one."""
    stated = documents(spark, d).select(F.col("doc_id").alias("doc"), "lang")
    return lid.disagreement(stated, _classified(spark, d))


@query(f"WITH {_GRAMS} SELECT doc_id, CASE WHEN coalesce(d.lang, 'fr') = 'fr' THEN r.lang ELSE d.lang END AS language, CASE WHEN coalesce(d.lang, 'fr') = 'fr' THEN r.score END AS language_score "
       "FROM documents d LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r ON r.doc = doc_id WHERE coalesce(d.lang, 'fr') <> 'fr' OR r.score >= 0.5")
def lid_one_language(spark, d):
    """Only texts that are said to be French, or nothing, are scored; the others pass."""
    df = documents(spark, d)
    out = lid.with_language(df.withColumn("language", F.col("lang")), materialize(lid.train(df), "lid"), "text", 0.5, "fr")
    return out.select("doc_id", "language", "language_score")


@query(
    rf"WITH {_GRAMS}, {LINES.strip()}, lclean AS (SELECT doc, pos, length(line) AS size, ' ' || trim(regexp_replace(lower(line), '[^\p{{L}}]+', ' ', 'g')) || ' ' AS c FROM lines), "
    "lgrams AS (SELECT doc, pos, size, substr(c, i::INT, 3) AS gram FROM lclean, unnest(generate_series(1, length(c) - 2)) AS t(i)), "
    "lsums AS (SELECT doc, pos, size, m.lang, sum(logp) AS s FROM lgrams JOIN model m USING (gram) GROUP BY ALL), "
    "lbest AS (SELECT doc, size, lang, round(1 / sum(exp(s - mx)) OVER (PARTITION BY doc, pos), 2) AS score, row_number() OVER (PARTITION BY doc, pos ORDER BY s DESC, lang) AS rn "
    "FROM (SELECT *, max(s) OVER (PARTITION BY doc, pos) AS mx FROM lsums)), "
    "votes AS (SELECT doc, lang, sum(score * size) AS vote FROM lbest WHERE rn = 1 GROUP BY ALL) "
    "SELECT doc, lang FROM votes QUALIFY row_number() OVER (PARTITION BY doc ORDER BY vote DESC, lang DESC) = 1"
)
def lid_line_vote(spark, d):
    """Each line votes for its language with its score and length."""
    df = documents(spark, d)
    model = materialize(lid.train(df), "lid")
    lines = df.filter(F.length("text") > 0).select(F.col("doc_id").alias("doc"), F.explode(F.split("text", "\n")).alias("line"))
    best = lines.withColumn("x", F.get(lid.languages(model, F.col("line"), 1), F.lit(0))).filter("x is not null")
    return lid.length_weighted(best.select("doc", "x.lang", "x.score", F.length("line").alias("length")))


# --- language models --------------------------------------------------------------------------------------------


def _words_sql(x: str) -> str:
    return rf"list_filter(string_split(regexp_replace({text.sql_dedup(x)}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"


_VOCAB = f"""
tok AS (SELECT doc_id AS doc, lang, unnest({_words_sql('text')}) AS word FROM documents WHERE lang IS NOT NULL),
vocab AS (SELECT * FROM (SELECT lang, word, count(*) AS n FROM tok GROUP BY lang, word) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {lm.VOCABULARY})
"""
_UNI = f"""{_VOCAB},
total AS (SELECT lang, sum(n) + count(*) + 1 AS total FROM vocab GROUP BY lang),
model AS (SELECT lang, word, log10((n + 1) / total) AS logp FROM vocab JOIN total USING (lang)),
unk AS (SELECT lang, log10(1 / total) AS p0 FROM total)"""


@query(f"WITH {_VOCAB} SELECT lang, word, n FROM vocab")
def vocab_topk(spark, d):
    return lm.vocabulary(documents(spark, d))


_BASE = f"base AS (SELECT doc_id AS doc, lang, len(string_split(text, chr(10))) AS n_lines, {_words_sql('replace(text, chr(10), chr(32))')} AS words FROM documents)"


@query(
    f"WITH {_UNI}, {_BASE}, w AS (SELECT doc, lang, unnest(words) AS word FROM base), "
    "s AS (SELECT doc, sum(coalesce(m.logp, u.p0)) AS s FROM w LEFT JOIN model m USING (lang, word) JOIN unk u USING (lang) GROUP BY doc) "
    "SELECT doc, round(pow(10.0, -s / (len(words) + n_lines)), 1) AS perplexity FROM base LEFT JOIN s USING (doc)"
)
def lm_unigram_perplexity(spark, d):
    df = documents(spark, d)
    vocab = materialize(lm.vocabulary(df), "vocab")
    return lm.unigram_perplexity(df, lm.unigram_model(vocab))


@query(
    f"WITH {_UNI}, {_BASE}, "
    "pairs AS (SELECT doc, lang, words[i::INT] AS a, words[i::INT + 1] AS b FROM base, unnest(generate_series(1, len(words) - 1)) AS t(i) WHERE lang IS NOT NULL), "
    "bi AS (SELECT c.lang, c.a, c.b, log10(c.n / v.n) AS p2 FROM (SELECT lang, a, b, count(*) AS n FROM pairs GROUP BY ALL HAVING count(*) >= 2) c JOIN vocab v ON v.lang = c.lang AND v.word = c.a), "
    f"s AS (SELECT p.doc, sum(coalesce(bi.p2, coalesce(m.logp, u.p0) + log10({lm.BACKOFF}))) AS s FROM pairs p LEFT JOIN bi USING (lang, a, b) LEFT JOIN model m ON m.lang = p.lang AND m.word = p.b JOIN unk u ON u.lang = p.lang GROUP BY p.doc) "
    "SELECT doc, round(pow(10.0, -s / (len(words) + n_lines)), 1) AS perplexity FROM base LEFT JOIN s USING (doc)"
)
def lm_bigram_perplexity(spark, d):
    df = documents(spark, d)
    return lm.bigram_perplexity(df, materialize(lm.vocabulary(df), "vocab"))


def _order5() -> str:
    """Interpolated n-grams up to order 5 over the words of ``base``."""
    d = lm.DISCOUNT
    levels = [f"p1 AS (SELECT c.lang, c.gram, greatest(n - {d}, 0) / x.c + {d} * x.t / x.c / (x.t + 1) AS p FROM c JOIN x USING (lang, k, context) WHERE k = 1)"]
    for k in range(2, lm.ORDER + 1):
        levels.append(f"p{k} AS (SELECT c.lang, c.gram, greatest(n - {d}, 0) / x.c + {d} * x.t / x.c * b.p AS p FROM c JOIN x USING (lang, k, context) JOIN p{k - 1} b ON b.lang = c.lang AND b.gram = c.suffix WHERE k = {k})")

    def joined(first: int, last: int) -> str:
        return " || ' ' || ".join(f"t{n}" for n in range(first, last - 1, -1)) or "''"

    def one(k: int) -> str:
        return f"SELECT doc, lang, {k} AS k, {k} = least(i, {lm.ORDER}) AS top, {joined(k - 1, 0)} AS gram, {joined(k - 1, 1)} AS context, {joined(k - 2, 0)} AS suffix FROM back WHERE i >= greatest(2, {k})"

    every = " UNION ALL ".join(f"SELECT {k} AS k, * FROM p{k}" for k in range(1, lm.ORDER + 1))
    return f"""
tok AS (SELECT doc, lang, unnest(list_concat(['<s>'], words, ['</s>'])) AS t0, unnest(generate_series(1, len(words) + 2)) AS i FROM base WHERE lang IS NOT NULL AND words IS NOT NULL),
back AS (SELECT doc, lang, i, t0, {', '.join(f'lag(t0, {n}) OVER w AS t{n}' for n in range(1, lm.ORDER))} FROM tok WINDOW w AS (PARTITION BY doc ORDER BY i)),
g AS ({' UNION ALL '.join(one(k) for k in range(1, lm.ORDER + 1))}),
c AS (SELECT lang, k, gram, context, suffix, count(*) AS n FROM g GROUP BY ALL),
x AS (SELECT lang, k, context, sum(n) AS c, count(*) AS t FROM c GROUP BY ALL),
{', '.join(levels)}, p AS ({every})"""


@query(
    f"WITH {_BASE}, {_order5()} SELECT doc, round(pow(10.0, -sum(log10(p)) / count(*)), 1) AS perplexity FROM g JOIN p USING (lang, k, gram) WHERE top GROUP BY doc"
)
def lm_order5_perplexity(spark, d):
    """Documents under a model of order 5 of the documents themselves."""
    df = documents(spark, d)
    found = materialize(lm.places(df, lm.words(F.replace("text", F.lit("\n"), F.lit(" ")))), "lm-places")
    model = lm.NgramModel.train(found)
    return model.log10(found).select("doc", F.round(lm.perplexity(F.col("log10"), F.col("n")), 1).alias("perplexity"))


_SENT = r"""sent AS (SELECT DISTINCT lang, trim(s) AS sentence FROM (SELECT lang, unnest(string_split(regexp_replace(text, '([.!?。！？])[\x09-\x0d\x20]+', '\1' || chr(10), 'g'), chr(10))) AS s FROM documents) WHERE trim(s) <> '')"""


@query(f"WITH {_SENT} SELECT lang, sentence FROM sent")
def distinct_sentences(spark, d):
    return lm.sentences(documents(spark, d))


_SENT_PP = f"""WITH {_UNI}, {_SENT}, sw AS (SELECT lang, sentence, {_words_sql('sentence')} AS words FROM sent),
se AS (SELECT lang, sentence, len(words) AS n, unnest(words) AS word FROM sw),
ss AS (SELECT lang, sentence, n, sum(coalesce(m.logp, u.p0)) AS s FROM se LEFT JOIN model m USING (lang, word) JOIN unk u USING (lang) GROUP BY ALL),
spp AS (SELECT sw.lang, sw.sentence, coalesce(round(pow(10.0, -s / (n + 1)), 1), -1.0) AS perplexity FROM sw LEFT JOIN ss ON ss.lang = sw.lang AND ss.sentence = sw.sentence)"""


def _sentence_scores(spark, d):
    df = documents(spark, d)
    return lm.sentence_perplexity(lm.sentences(df), lm.unigram_model(materialize(lm.vocabulary(df), "vocab")))


@query(f"{_SENT_PP} SELECT lang, sentence, perplexity FROM spp")
def sentence_perplexity(spark, d):
    return _sentence_scores(spark, d)


@query(f"{_SENT_PP} SELECT lang, sentence, perplexity FROM spp WHERE perplexity > 0 AND perplexity < 300")
def mine_sentences(spark, d):
    return lm.mine_sentences(_sentence_scores(spark, d), 300)


@query(
    "WITH r AS (SELECT mined_id, perplexity, floor(perplexity / 100) * 100 AS step, row_number() OVER (PARTITION BY floor(perplexity / 100) * 100 ORDER BY mined_id) AS rn FROM mined_docs WHERE perplexity > 0 AND NOT isnan(perplexity) AND NOT isinf(perplexity)) "
    "SELECT mined_id, perplexity, step FROM r WHERE step <= 1000 AND rn <= CASE WHEN step = 0 THEN 20 ELSE 21 END ORDER BY step, mined_id LIMIT 201"
)
def uniform_sample_by_perplexity(spark, d):
    df = mined(spark, d).select("mined_id", "perplexity").filter("perplexity > 0 and not isnan(perplexity) and perplexity < double('Infinity')")
    return lm.sample_by_perplexity(df, "mined_id")


# --- buckets ----------------------------------------------------------------------------------------------------

_CUT = "cut AS (SELECT key AS lang, max(value) FILTER (pct = 30) AS h, max(value) FILTER (pct = 60) AS t FROM (UNPIVOT (SELECT * FROM cutoffs WHERE pct IN (30, 60)) ON COLUMNS(* EXCLUDE pct) INTO NAME key VALUE value) GROUP BY key)"
_BUCKET = f"""WITH {_CUT}, b AS (SELECT mined_id, language, CASE WHEN h IS NULL OR t IS NULL OR perplexity IS NULL OR isnan(perplexity) OR perplexity < 0 THEN 'all'
  WHEN perplexity < h THEN 'head' WHEN perplexity < t THEN 'middle' ELSE 'tail' END AS bucket FROM mined_docs LEFT JOIN cut ON lang = language)"""


@query(f"{_BUCKET} SELECT mined_id, bucket FROM b")
def perplexity_bucket(spark, d):
    return buckets.perplexity_bucket(mined(spark, d).drop("bucket"), table(spark, d, "cutoffs")).select("mined_id", "bucket")


@query(f"{_BUCKET} SELECT language, bucket, count(*) AS docs FROM b GROUP BY ALL")
def bucket_counts(spark, d):
    found = buckets.perplexity_bucket(mined(spark, d).drop("bucket"), table(spark, d, "cutoffs"))
    return found.groupBy("language", "bucket").agg(F.count("*").alias("docs"))


# --- tags -------------------------------------------------------------------------------------------------------

_HOST_TAGS = f"""rows AS (SELECT DISTINCT {NETLOC_SQL.format('url')} AS key, language AS tag, bucket AS source FROM mined_docs WHERE language IS NOT NULL AND bucket IS NOT NULL),
given AS (SELECT key, tag, count(*) AS n FROM rows GROUP BY key, tag), srcs AS (SELECT key, count(DISTINCT source) AS n FROM rows GROUP BY key),
found AS (SELECT key, tag FROM given JOIN srcs USING (key, n))"""


def _host_tags(spark, d):
    """Languages that every bucket of a host has."""
    rows = mined(spark, d).filter("language is not null and bucket is not null").withColumn("key", urls.netloc(F.col("url")))
    return tags.intersect_tags(rows, "key", "language", "bucket")


@query(f"WITH {_HOST_TAGS} SELECT key, tag FROM found")
def tag_intersection(spark, d):
    return _host_tags(spark, d)


@query(
    f"WITH {_HOST_TAGS}, m AS (SELECT key, list_sort(list(tag)) AS tags FROM found GROUP BY key) "
    f"SELECT url, list_aggregate(list_transform(tags, lambda t: '__label__' || t), 'string_agg', ' ') || ' ' || lower(replace(raw_content, chr(10), ' ')) AS line FROM mined_docs JOIN m ON m.key = {NETLOC_SQL.format('url')} WHERE length(raw_content) > 200"
)
def tag_corpus(spark, d):
    return tags.labelled_lines(mined(spark, d), tags.tag_map(_host_tags(spark, d)))


# --- shards and files -------------------------------------------------------------------------------------------


@query("WITH s AS (SELECT DISTINCT cc_segment FROM mined_docs WHERE cc_segment IS NOT NULL), r AS (SELECT cc_segment, row_number() OVER (ORDER BY cc_segment) - 1 AS i, count(*) OVER () AS n FROM s) SELECT cc_segment, (CASE WHEN i < n // 4 THEN 0 WHEN i < 2 * n // 4 THEN 1 WHEN i < 3 * n // 4 THEN 2 ELSE 3 END)::INT AS shard FROM r")
def shard_assignment(spark, d):
    """The manifest of segments, cut into four shards."""
    manifest = mined(spark, d).select("cc_segment").filter("cc_segment is not null").distinct()
    return readers.assign_shards(manifest, "cc_segment", 4)


_GROUPS = """WITH f AS (SELECT lang AS prefix, source AS name, sum(n_chars)::BIGINT AS size FROM documents WHERE lang IS NOT NULL GROUP BY ALL HAVING sum(n_chars) IS NOT NULL),
r AS (SELECT *, (row_number() OVER (PARTITION BY prefix ORDER BY name) - 1)::INT AS ordinal FROM f),
p AS (SELECT *, greatest(1, least(floor(20000 / avg(CASE WHEN ordinal < 10 THEN size END) OVER (PARTITION BY prefix)), count(*) OVER (PARTITION BY prefix))) AS per FROM r),
g AS (SELECT prefix, name, size, ordinal, floor(ordinal / per)::INT AS grp FROM p)
SELECT prefix, name, size, ordinal, grp, coalesce(sum(size) OVER (PARTITION BY prefix, grp ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM g"""


@query(_GROUPS)
def size_groups(spark, d):
    """Compaction groups of 20 kB and offsets, with each source of a language as a file."""
    files = documents(spark, d).filter("lang is not null").groupBy(F.col("lang").alias("prefix"), F.col("source").alias("name")).agg(F.sum("n_chars").alias("size")).filter("size is not null")
    return sinks.size_groups(files, 20_000)


@query("SELECT count(*) AS rows, sum(('0x' || substr(sha1(doc_id::VARCHAR || chr(31) || coalesce(lang, chr(0)) || chr(31) || coalesce(text, chr(0))), 1, 15))::BIGINT)::VARCHAR AS sum FROM documents")
def content_checksum(spark, d):
    found = sinks.checksum(documents(spark, d), ["doc_id", "text", "lang"])
    return found.select("rows", F.col("sum").cast("string").alias("sum"))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[ \t]*(\S+)', 1) AS url, strlen(raw_content) AS length,
  regexp_replace(replace(coalesce(title, '-') || chr(10) || raw_content || chr(10) || chr(10), chr(13), ''), '\n[ \t]*\n[ \t]*\n?$', '') AS body FROM wet_pages WHERE raw_content <> '' AND url IS NOT NULL),
l AS (SELECT *, list_transform(string_split(body, chr(10)), lambda x: trim(x, ' ')) AS lines FROM p)
SELECT page_id, url, lines[1] AS title, (len(lines) - 1)::INT AS nlines, length FROM l WHERE array_to_string(lines[2:], chr(10)) <> ''""")
def wet_archive_roundtrip(spark, d):
    """Prints pages as WET records and parses them again."""
    pages = table(spark, d, "wet_pages").filter("raw_content <> '' and url is not null")
    head = F.concat(
        F.lit("\nWARC-Type: conversion\nWARC-Target-URI: "), F.col("url"), F.lit("\nWARC-Date: "), F.coalesce("date_download", F.lit("-")),
        F.lit("\nWARC-Block-Digest: "), F.coalesce("digest", F.lit("-")), F.lit("\nContent-Length: "), F.octet_length("raw_content").cast("string"),
        F.lit("\n\n"), F.coalesce("title", F.lit("-")), F.lit("\n"), F.col("raw_content"), F.lit("\n\n"),
    )
    return readers.wet_documents(pages.select("page_id", head.alias("record")), 1).select("page_id", "url", "title", "nlines", "length")


# --- whole pipeline ---------------------------------------------------------------------------------------------

_MINED_SQL = f"""
WITH {HASHED.replace('WHERE length(text) > 0', 'WHERE length(text) >= 300')}, {_TWO_PASS.format('', '')},
docs AS ({REBUILT.format('kept')}),
stated AS (SELECT doc_id, lang AS language FROM documents WHERE lang IS NOT NULL)
SELECT language, count(*) AS docs, sum(nlines)::BIGINT AS nlines, sum(length)::BIGINT AS chars FROM docs JOIN stated USING (doc_id) GROUP BY language
"""


@query(_MINED_SQL)
def mine_counts(spark, d):
    """Length filter, global deduplication and stated language, in totals per language."""
    df = documents(spark, d).filter(F.length("text") >= 300)
    docs = dedup.rebuild(df, dedup.two_pass_lines(dedup.documents_with_lines(df)), columns=("lang",)).filter("lang is not null")
    return docs.groupBy(F.col("lang").alias("language")).agg(F.count("*").alias("docs"), F.sum("nlines").alias("nlines"), F.sum("length").alias("chars"))


_PIPELINE_SQL = f"""
WITH {HASHED.replace('WHERE length(text) > 0', 'WHERE length(text) >= 300')}, {_TWO_PASS.format('', '')},
mined AS ({REBUILT.format('kept')}), {_GRAMS.strip()},
clean2 AS (SELECT doc_id AS doc, ' ' || trim(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g')) || ' ' AS c FROM mined),
grams2 AS (SELECT doc, substr(c, i::INT, 3) AS gram FROM clean2, unnest(generate_series(1, length(c) - 2)) AS t(i)),
sums2 AS (SELECT g.doc, m.lang, sum(m.logp) AS s FROM grams2 g JOIN model m USING (gram) GROUP BY ALL),
scored2 AS (SELECT doc, lang, s, round(1 / sum(exp(s - mx)) OVER (PARTITION BY doc), 2) AS score, row_number() OVER (PARTITION BY doc ORDER BY s DESC, lang) AS rn
            FROM (SELECT *, max(s) OVER (PARTITION BY doc) AS mx FROM sums2)),
lid AS (SELECT doc, lang FROM scored2 WHERE rn = 1 AND score >= 0.5),
{_UNI.replace('model AS', 'words_model AS')},
w2 AS (SELECT doc_id AS doc, {_words_sql('replace(text, chr(10), chr(32))')} AS words, len(string_split(text, chr(10))) AS n_lines, nlines FROM mined),
w3 AS (SELECT w2.doc, lid.lang, unnest(words) AS word FROM w2 JOIN lid USING (doc)),
s2 AS (SELECT doc, sum(coalesce(m.logp, u.p0)) AS s FROM w3 LEFT JOIN words_model m ON m.lang = w3.lang AND m.word = w3.word JOIN unk u ON u.lang = w3.lang GROUP BY doc),
pp AS (SELECT w2.doc, lid.lang AS language, nlines, round(pow(10.0, -s / (len(words) + n_lines)), 1) AS perplexity FROM w2 JOIN lid USING (doc) LEFT JOIN s2 USING (doc)),
{_CUT}, b AS (SELECT language, nlines, CASE WHEN h IS NULL OR t IS NULL OR perplexity IS NULL THEN 'all' WHEN perplexity < h THEN 'head' WHEN perplexity < t THEN 'middle' ELSE 'tail' END AS bucket FROM pp LEFT JOIN cut ON cut.lang = language)
SELECT language, bucket, count(*) AS docs, sum(nlines)::BIGINT AS nlines FROM b GROUP BY ALL"""


def _to_mine(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("text").alias("raw_content"), (F.col("doc_id") % SHARDS).cast("int").alias("shard"), "source")


@query(_PIPELINE_SQL)
def full_mine_pipeline(spark, d):
    """All default steps but the sink: documents per language and bucket."""
    df = documents(spark, d)
    run = Pipeline(BASE, materialize(lid.train(df), "lid"), lm.unigram_model(materialize(lm.vocabulary(df), "vocab")), table(spark, d, "cutoffs"))
    return run.run(_to_mine(df)).groupBy("language", "bucket").agg(F.count("*").alias("docs"), F.sum("nlines").alias("nlines"))


@query()
def full_mine_pipeline_pieces(spark, d):
    """The same with subword pieces and a model of order 5 over them, trained on the pieces of the documents."""
    df = documents(spark, d)
    models = {"*": os.path.join(TOKENIZERS, "piece_bpe_32k.model")}
    cut = pieces.tokenize(df.filter("text <> ''"), models, "text", language="lang").select("doc_id", "lang", F.split("tokenized", " ").alias("tokens"))
    model = lm.NgramModel.train(materialize(lm.places(cut, F.col("tokens")), "lm-places"))
    run = Pipeline(BASE, materialize(lid.train(df), "lid"), model, table(spark, d, "cutoffs"), piece_models=models)
    return run.run(_to_mine(df)).groupBy("language", "bucket").agg(F.count("*").alias("docs"), F.sum("nlines").alias("nlines"))
