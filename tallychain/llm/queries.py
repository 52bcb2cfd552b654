"""The operators as registered queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.llm import (
    decontaminate,
    exact_dedup,
    fill_in_middle,
    language_id,
    line_dedup,
    mixing,
    pii,
    quality,
    resampling,
    sharding,
    simhash,
    token_counts,
    url_filter,
)
from tallychain.llm.tables import table


def source_mixing(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, max_repeats=mixing.MAX_REPEATS)
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "block", "position")


def line_dedup_query(spark: SparkSession, root: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, root, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def decontamination(spark: SparkSession, root: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, root, "documents"), table(spark, root, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )


def token_counts_query(spark: SparkSession, root: str) -> DataFrame:
    return token_counts.context_limits(table(spark, root, "documents"))


def url_filter_query(spark: SparkSession, root: str) -> DataFrame:
    return url_filter.judge(table(spark, root, "pages"), url_filter.rules_table(spark))


def language_id_query(spark: SparkSession, root: str) -> DataFrame:
    found = language_id.identify_languages(table(spark, root, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def simhash_query(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"))


def pii_query(spark: SparkSession, root: str) -> DataFrame:
    return pii.pseudonymise(table(spark, root, "documents"))


def sharding_query(spark: SparkSession, root: str) -> DataFrame:
    return sharding.shard_rows(table(spark, root, "documents")).drop("source")


def quality_query(spark: SparkSession, root: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, root, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def exact_dedup_query(spark: SparkSession, root: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, root, "documents"), digest=True)


def resampling_query(spark: SparkSession, root: str) -> DataFrame:
    drawn = resampling.resample(table(spark, root, "documents"), table(spark, root, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def fill_in_middle_query(spark: SparkSession, root: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, root, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": source_mixing,
    "op2_line_dedup": line_dedup_query,
    "op3_decontamination": decontamination,
    "op4_token_counts": token_counts_query,
    "op5_url_filter": url_filter_query,
    "op6_language_id": language_id_query,
    "op7_simhash": simhash_query,
    "op8_pii": pii_query,
    "op9_sharding": sharding_query,
    "op10_quality_rules": quality_query,
    "op11_exact_dedup": exact_dedup_query,
    "op12_importance_resampling": resampling_query,
    "op13_fill_in_middle": fill_in_middle_query,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL: dict[str, str] = {
    "op2_line_dedup": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM split
), keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), {_LOWER}) AS key
    FROM lines
), shared AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT keyed.*, coalesce(owner <> doc_id, false) AS dropped FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op3_decontamination": f"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), sized AS (
    SELECT item_id, words, least(10, len(words)) AS size FROM item WHERE len(words) > 0
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[start_word:start_word + size - 1], ' ') AS key
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS start_word FROM sized)
), doc_windows AS (
    SELECT doc_id, start_word, size, array_to_string(words[start_word:start_word + size - 1], ' ') AS key
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start_word
          FROM doc, (SELECT DISTINCT size FROM sized) WHERE len(words) >= size)
), hits AS (
    SELECT doc_id, start_word, size, item_id FROM doc_windows JOIN item_windows USING (size, key)
), hit_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start_word, start_word + size)) AS place FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
), places AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM doc
), terms AS (
    SELECT key, size, unnest(string_split(key, ' ')) AS term, unnest(range(size)) AS shift
    FROM (SELECT DISTINCT size, key FROM item_windows)
), rarest AS (
    SELECT key, size, term, shift FROM terms LEFT JOIN (SELECT word AS term, count(*) AS n FROM places GROUP BY 1) USING (term)
    QUALIFY row_number() OVER (PARTITION BY size, key ORDER BY coalesce(n, 0), shift) = 1
), starts AS (
    SELECT key, size, doc_id, place - shift AS start_word FROM rarest JOIN places ON word = term WHERE place > shift
), near AS (
    SELECT s.key, s.size, s.doc_id, s.start_word
    FROM starts s JOIN terms t ON t.key = s.key AND t.size = s.size
        JOIN places p ON p.doc_id = s.doc_id AND p.word = t.term
            AND p.place BETWEEN s.start_word + t.shift - 1 AND s.start_word + t.shift + 1
    GROUP BY ALL HAVING count(DISTINCT t.shift) = s.size
), near_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_near
    FROM (SELECT near.doc_id, unnest(range(start_word, least(start_word + size, len(words) + 1))) AS place
          FROM near JOIN doc USING (doc_id)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id) LEFT JOIN near_words USING (doc_id)
""",
    "op5_url_filter": f"""
WITH rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest
), rules(rule_host, rule_path, ruling) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
    SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(ruling, length(rule_host || rule_path)) AS ruling
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(ruling, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
""",
    "op11_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op13_fill_in_middle": """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS hex,
        regexp_extract_all(coalesce(text, ''),
            '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units FROM documents
), numbers AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
        ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4 FROM drawn
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
    SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
        array_to_string(units[high + 1:], '') AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
""",
}
