"""The registered queries of the training-data operators."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import (
    collocations, decontaminate, html_extraction, jaccard_join, license_scan, lm_scoring, packing, preference, quality_rules,
    secret_scan, substring_dedup, token_alignment, token_counts)
from tidewire.llm.common import table
from tidewire.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_bits")


#: Every measurement of every text, and the rules that fail by their bits.
LEDGER_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM documents),
tri AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
twice AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY 1),
m AS (
    SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
        len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters, len([x FOR x IN w IF suffix(x, '!')]) AS n_exclaimed,
        coalesce(list_max([strlen(x) FOR x IN w]), 0) AS longest_word
    FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
ledger AS (
    SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
        + 4 * (100 * n_symbols > 30 * n_words)::BIGINT + 8 * (word_chars > 20 * n_words)::BIGINT
        + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
        + 64 * (100 * n_upper > 60 * n_letters)::BIGINT + 128 * (100 * n_exclaimed > 40 * n_words)::BIGINT
        + 256 * (longest_word > 1000)::BIGINT AS failed_bits
    FROM m)
"""
ORACLES["op5_quality_rules"] = LEDGER_SQL + """
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
    failed_bits = 0 AS kept, failed_bits
FROM ledger
"""


@query
def quality_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """For every policy: what each of its rules drops, drops alone, and what stays without it."""
    judged = quality_rules.stored_ledger(table(spark, folder, "documents"))
    return quality_rules.ablations(judged)


ORACLES["quality_ablation"] = LEDGER_SQL + """,
rules AS (
    SELECT * FROM (VALUES ('few_words', 1), ('repeated_words', 2), ('many_symbols', 4), ('long_words', 8),
        ('short_words', 16), ('repeated_lines', 32), ('shouting', 64), ('exclaiming', 128), ('endless_word', 256)) r(rule, bit)),
policies AS (SELECT * FROM (VALUES ('base', 3), ('v1', 47), ('v2', 511)) p(policy, mask))
SELECT policy, rule, count_if(failed_bits & bit <> 0)::BIGINT AS n_failed,
    count_if(failed_bits & mask = bit)::BIGINT AS n_failed_alone,
    count_if(failed_bits & mask & ~bit = 0)::BIGINT AS n_kept_without
FROM ledger, policies, rules WHERE mask & bit <> 0 GROUP BY policy, rule
"""


@query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.secret_spans(
        table(spark, folder, "documents"), vocabulary=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_guess")


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("item_ids", 256).alias("items_sha256"), "contaminated")


ORACLES["op2_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, pos, pos + least(13, len(w)) - 1), ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS pos FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM g),
dw AS (
    SELECT doc_id, n, pos, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, lengths WHERE len(w) >= n)),
h AS (SELECT doc_id, pos, dw.n, item_id FROM dw JOIN g ON g.gram = dw.gram AND g.n = dw.n),
c AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT doc_id, pos, n FROM h)) GROUP BY 1),
i AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
"""


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents")).drop("text_key")


ORACLES["op9_jaccard_join"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS s FROM g GROUP BY 1),
class AS (SELECT s, min(doc_id) AS rep, count(*) AS copies, any_value(n) AS n FROM sets GROUP BY 1),
members AS (SELECT rep, n, copies, gram FROM class JOIN g ON g.doc_id = rep),
shared AS (
    SELECT a.rep AS a, b.rep AS b, any_value(b.copies) AS copies, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_have
    FROM members a JOIN members b ON a.gram = b.gram AND a.rep <> b.rep GROUP BY a.rep, b.rep),
links AS (SELECT a, b, copies FROM shared WHERE 5 * both_have >= 4 * (na + nb - both_have)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY 1),
counts AS (SELECT a, count(*) AS texts, sum(copies) AS documents FROM links GROUP BY 1)
SELECT d.doc_id, coalesce(least(least.b, class.rep), class.rep, d.doc_id) AS class_id,
    CAST(coalesce(counts.documents, 0) + coalesce(class.copies - 1, 0) AS BIGINT) AS n_links,
    CAST(coalesce(counts.texts, 0) AS BIGINT) AS n_linked_texts, CAST(coalesce(class.copies - 1, 0) AS BIGINT) AS n_copies,
    CAST(coalesce(sets.n, 0) AS BIGINT) AS n_grams
FROM d LEFT JOIN sets ON sets.doc_id = d.doc_id LEFT JOIN class ON class.s = sets.s
    LEFT JOIN least ON least.a = class.rep LEFT JOIN counts ON counts.a = class.rep
"""


@query
def op4_preference_quality(spark: SparkSession, folder: str) -> DataFrame:
    return preference.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, folder, "documents"))


ORACLES["op3_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
    FROM words WHERE (doc_id, p) NOT IN (SELECT (doc_id, p) FROM gone) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.words, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


@query
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents lie in folders by source and language; a licence text, or one that begins with a notice, is a licence file."""
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.license_scan(docs, path, F.col("text").rlike(license_scan.CUE), leading=10)


@query
def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract_articles(table(spark, folder, "pages"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = token_alignment.align_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op13_collocations"] = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY 1),
g AS (
    SELECT lang, s, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase
    FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM p, range(1, 6) t(s) WHERE len(w) >= s)),
f AS (SELECT lang, s, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, s, phrase, f AS a FROM f WHERE s > 1),
kept AS (
    SELECT * FROM c WHERE NOT EXISTS (
        SELECT 1 FROM c o WHERE o.lang = c.lang AND o.s > c.s AND 100 * o.a >= 100 * c.a
            AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
k AS (
    SELECT lang, phrase, a, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS x,
        array_to_string(list_slice(string_split(phrase, ' '), k + 1, s), ' ') AS y
    FROM (SELECT *, unnest(range(1, s)) AS k FROM kept)),
scored AS (
    SELECT k.lang, k.phrase, a, k, l.f AS l, r.f AS r, n,
        CAST(1000::HUGEINT * a * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM k JOIN f l ON l.lang = k.lang AND l.phrase = x JOIN f r ON r.lang = k.lang AND r.phrase = y
        JOIN n ON n.lang = k.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM best QUALIFY rank <= 2000
"""
