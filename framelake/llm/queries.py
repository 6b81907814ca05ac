"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import (archive, decontaminate, divergence, embeddings, language, minhash, packing, quality, records,
                           secrets, substrings, token_counts, treap)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.remove_repeated(docs)
    return found.select("doc_id", *[f"repeats.{c}" for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred",
                        "language.score", "language.rejected")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive.round_trip(spark, _table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).select(
        "doc_id", *[f"found.{c}" for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans",
                                           "n_random")])


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *decontaminate.digest())


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return treap.search(docs, _table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_language_id": op2_language_id,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_warc_packages": op5_warc_packages,
    "op6_secret_scan": op6_secret_scan,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_decontamination": op10_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_ranked_search": op12_ranked_search,
    "op13_quality_rules": op13_quality_rules,
}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_WORD = "[^\\x20\\x09-\\x0D]+"


def _quoted(pattern: str) -> str:
    """A regular expression as the inside of an SQL string."""
    return pattern.replace("'", "''")


# Reachability over links l(a, b), given in both directions.
_REACHED = """r AS (SELECT id, id AS c FROM nodes UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.c),
        m AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)"""

ORACLES: dict[str, str] = {
    "op3_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding)
              AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
              AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
        l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
              ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9),
        nodes AS (SELECT vec_id AS id FROM embeddings),
        {_REACHED},
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT m.id AS vec_id, coalesce(n.n, 0) AS n_links, component_id, component_id = m.id AS kept
        FROM m LEFT JOIN n ON n.a = m.id""",
    "op4_minhash_near_dedup": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                END AS s FROM w),
        e AS (SELECT doc_id, unnest(s) AS g FROM s),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM e x JOIN e y
              ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
              WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
        nodes AS (SELECT doc_id AS id FROM documents),
        {_REACHED}
        SELECT doc_id, len(s) AS n_shingles, component_id, component_id = doc_id AS kept
        FROM s JOIN m ON m.id = doc_id""",
    "op10_decontamination": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        i AS (SELECT item_id, regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
              FROM benchmark),
        k AS (SELECT *, least(10, len(w)) AS size FROM i WHERE len(w) > 0),
        g AS (SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(w) - size + 2),
                lambda j: array_to_string(w[j:j + size - 1], ' '))) AS gram FROM k),
        c AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos
              FROM d JOIN (SELECT DISTINCT size FROM k) ON len(w) >= size),
        h AS (SELECT doc_id, pos, c.size, item_id FROM c JOIN g
              ON g.size = c.size AND g.gram = array_to_string(w[pos:pos + c.size - 1], ' ')),
        p AS (SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM h) GROUP BY doc_id),
        t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS names FROM h GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op5_warc_packages": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
                     sha256(body) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
    "op11_source_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({_FOLDED}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        g AS (SELECT DISTINCT lang, source FROM d),
        t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
        k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
        v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
        c AS (SELECT g.lang, g.source, k.term, count(t.id) AS n FROM g JOIN k ON k.lang = g.lang
              LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term GROUP BY ALL),
        m AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
        p AS (SELECT c.lang, c.source, c.term, c.n,
                     1 + (1000000000::HUGEINT * (c.n + 2)) // (m.n + 2 * v.v) AS p
              FROM c JOIN m USING (lang, source) JOIN v ON v.lang = c.lang),
        q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v) AS q
              FROM k JOIN v USING (lang)),
        pairs AS (SELECT g.lang, g.source, h.source AS item FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source),
        s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
        r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value
              FROM pairs LEFT JOIN s USING (lang, source, item)
              UNION ALL
              SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q)
              FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
        FROM o WHERE part = 'pair' OR rank <= 10""",
    "op12_ranked_search": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_TERM}') AS w FROM documents),
        c AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
        a AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM c),
        i AS (SELECT item_id, unnest(regexp_extract_all({_FOLDED}, '{_TERM}')) AS term FROM benchmark),
        q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
        t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d)
              WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
              FROM t, a GROUP BY term, n_docs),
        p AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)) AS impact
              FROM t JOIN c USING (doc_id), a),
        s AS (SELECT item_id, doc_id, sum(times * weight * impact)::BIGINT AS score
              FROM q JOIN f USING (term) JOIN p USING (term) GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20""",
    "op13_quality_rules": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
        l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
        x AS (SELECT doc_id, line, length(regexp_replace(line, '{quality.SPACE}', '', 'g')) AS chars,
                     len(regexp_extract_all(line, '{_WORD}')) AS n_words,
                     len(regexp_extract_all(line, '{_quoted(quality.PUNCTUATION)}')) AS signs,
                     len(regexp_extract_all(line, '{quality.SEPARATOR}')) AS breaks
              FROM l WHERE regexp_matches(line, '{_WORD}')),
        j AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(chars) FILTER (
                  NOT regexp_matches(line, '{_quoted(quality.SENTENCE_END)}') OR (breaks >= 2 AND 4 * breaks >= n_words)
                  OR signs >= 2 * n_words OR regexp_matches(line, '{quality.BOILERPLATE}')), 0) AS lost
              FROM x GROUP BY doc_id),
        g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS pos,
                     unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS gram
              FROM d),
        h AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
        r AS (SELECT doc_id, count(DISTINCT place) AS n FROM (
                  SELECT doc_id, unnest(range(pos, pos + 5)) AS place FROM h WHERE n > 1) GROUP BY doc_id),
        b AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{quality.SPACE}', '', 'g')) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                     coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
              FROM d LEFT JOIN j USING (doc_id) LEFT JOIN r USING (doc_id)),
        f AS (SELECT *, n_words < {quality.FEWEST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed
              FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND 100 * lost <= {quality.MOST_LOST} * word_chars AS kept
        FROM f""",
}
