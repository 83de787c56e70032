"""One query per operator over the given tables, with the SQL that checks it where SQL can."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from tablewright.llm import (
    align,
    bpe,
    decontaminate,
    license_scan,
    line_dedup,
    merkle,
    ngram_join,
    substring_dedup,
    suffix_tree_lm,
    token_counts,
    token_files,
    url_filters,
)
from tablewright.llm import quality_rules as quality
from tablewright.llm.registry import CORPUS, corpus_query
from tablewright.sources.scratch import scratch_path

__all__ = ["CORPUS"]

_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)


@corpus_query(
    "op6_quality_rules",
    rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
        FROM documents
    ), word_rows AS (
        SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS pos FROM d
    ), grams AS (
        SELECT doc_id, pos, lead(w, 7) OVER o AS w8,
               concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o,
                         lead(w, 4) OVER o, lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) AS gram
        FROM word_rows WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
    ), windows AS (
        SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams WHERE w8 IS NOT NULL
    ), covered AS (
        SELECT doc_id, count(DISTINCT word) AS n
        FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS word FROM windows WHERE n >= 2) GROUP BY doc_id
    ), counts AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS BIGINT) AS n_shouts,
               CAST(len([w FOR w IN words IF w IN ({_STOP})]) AS BIGINT) AS n_stop_words,
               CAST(len(lines) AS BIGINT) AS n_text_lines,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
        FROM d LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_shouts, n_stop_words, n_text_lines, n_dup_lines, n_repeat_words,
           n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {quality.rules_sql()} AS kept
    FROM counts
    """,
)
def op6_quality_rules(spark, t):
    return quality.quality_rules(t.documents)


@corpus_query("op8_bpe_round_trip")
def op8_bpe_round_trip(spark, t):
    return bpe.round_trip(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@corpus_query("op9_token_files")
def op9_token_files(spark, t):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(t.documents, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(spark, path, digest=True)


_WINDOW = "w, " + ", ".join(f"lead(w, {k}) OVER o" for k in range(1, 10))


@corpus_query(
    "op10_benchmark_decontamination",
    rf"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), b AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ), patterns AS (
        SELECT DISTINCT item, n, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS gram
        FROM (SELECT item, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
              FROM b WHERE len(words) > 0)
    ), rows_of_words AS (
        SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS pos FROM d
    ), tens AS (
        SELECT doc_id, pos, 10 AS n, CASE WHEN lead(w, 9) OVER o IS NOT NULL THEN concat_ws(' ', {_WINDOW}) END AS gram
        FROM rows_of_words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
    ), shorter AS (
        SELECT doc_id, pos, n, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS gram
        FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos
              FROM d, (SELECT DISTINCT n FROM patterns WHERE n < 10) WHERE len(words) >= n)
    ), found AS (
        SELECT doc_id, pos, n, item FROM (SELECT * FROM tens UNION ALL SELECT * FROM shorter) JOIN patterns USING (n, gram)
    ), hit AS (
        SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op10_benchmark_decontamination(spark, t):
    return decontaminate.report(decontaminate.find_passages(t.documents, t.benchmark))


@corpus_query(
    "op1_line_dedup",
    rf"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, regexp_replace(translate(line, {_FOLD}), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k FROM lines
    ), shared AS (
        SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (top <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (top IS NULL OR top = doc_id), '')) AS kept_sha256
    FROM keyed LEFT JOIN shared USING (k) GROUP BY doc_id
    """,
)
def op1_line_dedup(spark, t):
    kept = line_dedup.dedupe_lines(t.documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@corpus_query("op3_token_counts")
def op3_token_counts(spark, t):
    """Every document gets three edits: a cut at a third, words put in at the middle, a new end."""
    n = F.length("text")
    edit = lambda start, stop, new: F.struct(
        F.floor(start).cast("long").alias("start"), F.floor(stop).cast("long").alias("stop"), F.lit(new).alias("new")
    )
    edits = F.array(edit(n / 3, n / 3 + 20, ""), edit(n / 2, n / 2, " a few new words"), edit(n - 5, n, ". The end"))
    counted = token_counts.count_edited(t.documents, public_tokenizers.path("byte_bpe_50k.json"), edits)
    return counted.withColumnRenamed("n_encoded", "n_pieces_encoded")


@corpus_query(
    "op5_url_filters",
    r"""
    WITH c AS (
        SELECT page_id, nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.'), '') AS host,
               DATE '2024-01-01' + CAST(page_id % 500 AS INTEGER) AS fetched_on
        FROM pages
    ), domains AS (
        SELECT DISTINCT regexp_replace(host, '^[^.]+\.((?:[^.]+\.){2,}[^.]+)$', '\1') AS domain FROM c WHERE host IS NOT NULL
    ), d AS (
        SELECT domain, CAST('0x' || substr(md5(domain), 1, 2) AS INTEGER) AS a, CAST('0x' || substr(md5(domain), 3, 2) AS INTEGER) AS b,
               CAST('0x' || substr(md5(domain), 5, 2) AS INTEGER) AS e, CAST('0x' || substr(md5(domain), 7, 2) AS INTEGER) AS f,
               CAST('0x' || substr(md5(domain), 9, 2) AS INTEGER) AS g, CAST('0x' || substr(md5(domain), 11, 2) AS INTEGER) AS h
        FROM domains
    ), entries AS (
        SELECT 'spam' AS list, domain, DATE '2024-01-01' + a AS listed_on, 'add' AS action FROM d WHERE g < 128
        UNION ALL SELECT 'spam', domain, DATE '2024-01-01' + (a + b), 'remove' FROM d WHERE g < 64
        UNION ALL SELECT 'spam', domain, DATE '2024-01-01' + (a + b + e), 'add' FROM d WHERE g < 32
        UNION ALL SELECT 'adult', domain, DATE '2024-01-01' + f, 'add' FROM d WHERE h < 64
    ), one AS (
        SELECT list, domain, listed_on, max(action) AS action FROM entries GROUP BY ALL
    ), newest AS (
        SELECT c.page_id, one.list, arg_max(one.action, one.listed_on) AS action
        FROM c JOIN one ON (c.host = one.domain OR ends_with(c.host, '.' || one.domain)) AND one.listed_on <= c.fetched_on
        GROUP BY c.page_id, one.list, one.domain
    ), hits AS (
        SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM newest WHERE action = 'add' GROUP BY page_id
    )
    SELECT c.page_id, c.host, CAST(c.fetched_on AS VARCHAR) AS fetched_on, coalesce(hits.lists, '') AS lists, hits.lists IS NOT NULL AS blocked
    FROM c LEFT JOIN hits USING (page_id)
    """,
)
def op5_url_filters(spark, t):
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 500).cast("int"))
    captures = t.pages.select("page_id", "url", fetched.alias("fetched_on"))
    judged = url_filters.judge_captures(captures, url_filters.entries_from_pages(t.pages))
    return judged.select("page_id", "host", F.col("fetched_on").cast("string").alias("fetched_on"), F.array_join("lists", ",").alias("lists"), "blocked")


@corpus_query("op7_license_scan")
def op7_license_scan(spark, t):
    found = license_scan.license_scan(t.documents)
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x.license)))
    return found.select(
        "doc_id", "n_blocks", F.size("licenses").cast("long").alias("n_confirmed"),
        F.array_join(names, ",").alias("licenses"),
        F.aggregate("licenses", F.lit(0).cast("long"), lambda n, x: n + x.n_differing).alias("n_differing"),
    )


@corpus_query(
    "op2_substring_dedup",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), w AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d
    ), windows AS (
        SELECT doc_id, pos, CASE WHEN count(*) OVER o = 20 THEN string_agg(word, ' ') OVER o END AS gram
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
    ), firsts AS (
        SELECT gram, min((doc_id, pos)) AS first FROM windows WHERE gram IS NOT NULL GROUP BY gram HAVING count(*) > 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos
        FROM windows JOIN firsts USING (gram) WHERE (doc_id, pos) > first
    ), kept AS (
        SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.pos) FILTER (gone.pos IS NULL) AS text, count(gone.pos) AS n_removed
        FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.pos = w.pos GROUP BY w.doc_id
    )
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
    """,
)
def op2_substring_dedup(spark, t):
    return substring_dedup.digest_of(substring_dedup.remove_repeats(t.documents))


@corpus_query("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark, t):
    return ngram_join.jaccard_groups(t.documents, words=4, percent=85).select("doc_id", "n_shingles", "component_id")


@corpus_query("op11_lm_scoring")
def op11_lm_scoring(spark, t):
    return suffix_tree_lm.score_texts(t.documents)


# crc32 of a decimal number, with its table from the polynomial; trees level by level in a recursion.
@corpus_query(
    "op13_merkle_manifest",
    r"""
    WITH RECURSIVE crc_table AS (
        SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
        FROM (SELECT unnest(range(256)) AS i)
    ), rows_of_docs AS (
        SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS id_text, CAST(n_chars AS VARCHAR) AS n0, CAST(n_chars + 1 AS VARCHAR) AS n1, source, text FROM documents
    ), coded AS (
        SELECT doc_id, lang, id_text,
               coalesce(strlen(id_text) || ':' || id_text, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
               coalesce(strlen(n0) || ':' || n0, '-') AS n0, coalesce(strlen(n1) || ':' || n1, '-') AS n1, coalesce(strlen(text) || ':' || text, '-') AS tail
        FROM rows_of_docs
    ), leaves AS (
        SELECT doc_id, lang, sha256(head || n0 || tail) AS leaf, sha256(head || n1 || tail) AS changed,
               xor(list_reduce(list_prepend(4294967295, list_transform(string_split(id_text, ''), lambda s: CAST(ord(s) AS BIGINT))),
                               lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 7 = 0 AS tampered
        FROM coded, crc_table
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size,
               dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
        FROM leaves
    ), nodes AS (
        SELECT tree, 0 AS level, place, leaf AS h, size FROM placed
        UNION ALL
        SELECT tree, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (size + 1) // 2
        FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2, size
    ), subroots AS (
        SELECT tree, h AS subroot, count(*) OVER () AS size FROM nodes WHERE size = 1
    ), top AS (
        SELECT 0 AS level, tree AS place, subroot AS h, size FROM subroots
        UNION ALL
        SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (size + 1) // 2
        FROM top WHERE size > 1 GROUP BY level, place // 2, size
    ), steps AS (
        SELECT p.tree, p.place AS leaf_place, n.level, n.size, p.place >> n.level AS at
        FROM placed p JOIN (SELECT DISTINCT tree, level, size FROM nodes WHERE size > 1) n USING (tree)
        UNION ALL
        SELECT p.tree, p.place, 100 + n.level, n.size, p.tree >> n.level
        FROM placed p, (SELECT DISTINCT level, size FROM top WHERE size > 1) n
    ), all_nodes AS (
        SELECT tree, level, place, h FROM nodes UNION ALL SELECT t.tree, 100 + level, place, h FROM top, (SELECT DISTINCT tree FROM placed) t
    ), proofs AS (
        SELECT s.tree, s.leaf_place, list({'at': s.at, 'h': n.h} ORDER BY s.level) AS path, coalesce(string_agg(n.h, '' ORDER BY s.level), '') AS proof
        FROM steps s LEFT JOIN all_nodes n ON n.tree = s.tree AND n.level = s.level AND n.place = xor(s.at, 1)
        GROUP BY s.tree, s.leaf_place
    ), folds AS (
        SELECT p.doc_id, p.leaf, p.tree, coalesce(q.proof, '') AS proof, coalesce(q.path, []) AS path, 1 AS step, CASE WHEN p.tampered THEN p.changed ELSE p.leaf END AS h
        FROM placed p LEFT JOIN proofs q ON q.tree = p.tree AND q.leaf_place = p.place
        UNION ALL
        SELECT doc_id, leaf, tree, proof, path, step + 1,
               sha256(CASE WHEN path[step].h IS NULL THEN h WHEN path[step].at % 2 = 0 THEN h || path[step].h ELSE path[step].h || h END)
        FROM folds WHERE step <= len(path)
    )
    SELECT f.doc_id, f.leaf, s.subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
    FROM folds f JOIN subroots s USING (tree), top t
    WHERE f.step > len(f.path) AND t.size = 1
    """,
)
def op13_merkle_manifest(spark, t):
    docs = t.documents
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    return merkle.audit(docs, tampered)


@corpus_query("op12_token_alignment")
def op12_token_alignment(spark, t):
    return align.align_tokens(t.documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
