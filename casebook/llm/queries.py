"""The corpus queries and, where SQL can express them, their answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.llm import (
    chunks, codes, decontaminate, graph, licenses, middle, minhash, mixing, pii, quality, sharding, suffixes, warc,
)
from casebook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_member_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.duplicate_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "low", "high", "first_doc_id", "other_doc_id"
    )


def op3_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Rule(shingle=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op5_tfidf_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(licenses.with_paths(table(spark, sf_dir, "documents")))


def op6_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bootstrapped_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_covariance_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op10_lookup_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = middle.restore(middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nearest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_member_warc": op1_member_warc,
    "op2_gear_chunks": op2_gear_chunks,
    "op3_bbit_minhash": op3_bbit_minhash,
    "op4_suffix_family": op4_suffix_family,
    "op5_tfidf_licences": op5_tfidf_licences,
    "op6_temperature_mix": op6_temperature_mix,
    "op7_positional_index": op7_positional_index,
    "op8_bootstrapped_contexts": op8_bootstrapped_contexts,
    "op9_covariance_outliers": op9_covariance_outliers,
    "op10_lookup_shards": op10_lookup_shards,
    "op11_block_rotation": op11_block_rotation,
    "op12_gnat_codes": op12_gnat_codes,
    "op13_pruned_graph": op13_pruned_graph,
}


def codebook_rounds(rounds: int) -> str:
    """CTEs b0, a0, b1, a1, …: codebooks, and the nearest entry of every part with its distance."""
    steps = []
    for r in range(rounds + 1):
        if r:
            steps.append(f"""b{r} AS MATERIALIZED (
                SELECT old.p, old.e, coalesce(new.v, old.v) AS v FROM b{r - 1} old LEFT JOIN (
                    SELECT p, e, list(CAST(m AS DOUBLE) ORDER BY i) AS v FROM (
                        SELECT a.p, a.e, i, floor(sum(v[i]) / count(*)) AS m
                        FROM a{r - 1} a JOIN parts USING (row, p), range(1, 1 + (SELECT max(len(v)) FROM parts)) t(i)
                        GROUP BY a.p, a.e, i
                    ) GROUP BY p, e
                ) new USING (p, e)
            )""")
        steps.append(f"""a{r} AS MATERIALIZED (
                SELECT row, p, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
                    SELECT row, parts.p, e, list_inner_product(parts.v, parts.v) + list_inner_product(b{r}.v, b{r}.v)
                        - 2 * list_inner_product(parts.v, b{r}.v) AS d
                    FROM parts JOIN b{r} USING (p)
                ) GROUP BY row, p
            )""")
    return ", ".join(steps)


ORACLES: dict[str, str] = {
    # Base32 by way of the bits of the hex digits.
    "op1_member_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
        ), bits AS (
            SELECT page_id, strlen(html) AS payload_bytes,
                   list_aggregate([substr('0000000100100011010001010110011110001001101010111100110111101111',
                                          strpos('0123456789abcdef', d) * 4 - 3, 4)
                                   FOR d IN string_split(hex, '')], 'string_agg', '') AS b
            FROM p
        ), digests AS (
            SELECT page_id, payload_bytes,
                   list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                          CAST('0b' || substr(b, CAST(i AS INT) * 5 + 1, 5) AS INT) + 1, 1)
                                   FOR i IN range(32)], 'string_agg', '') AS payload_digest
            FROM bits
        ), holders AS (
            SELECT payload_digest, max(page_id) AS response FROM digests GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> response THEN response END AS refers_to
        FROM digests JOIN holders USING (payload_digest)
    """,
    # All pairs that share a shingle, and the smallest id reachable over the links.
    "op3_bbit_minhash": """
        WITH RECURSIVE w AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+') IF x <> ''] AS words
            FROM documents
        ), s AS (
            SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                   ELSE list_distinct([array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)]) END) AS g
            FROM w
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
        ), reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
        ), c AS (
            SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN c USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
    # Every window of a document of the length of some benchmark window, looked up whole.
    "op7_positional_index": """
        WITH d AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS words
            FROM documents
        ), b AS (
            SELECT item_id, [x FOR x IN regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS words
            FROM benchmark
        ), w AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS n,
                   unnest([array_to_string(words[i:i + 9], ' ') FOR i IN range(1, greatest(2, len(words) - 8))]) AS g
            FROM b WHERE len(words) > 0
        ), lengths AS (
            SELECT DISTINCT n FROM w
        ), spots AS (
            SELECT doc_id, n, unnest(range(1, len(words) - n + 2)) AS i, words FROM d, lengths WHERE len(words) >= n
        ), hits AS (
            SELECT doc_id, i, spots.n, item_id
            FROM spots JOIN w ON w.n = spots.n AND w.g = array_to_string(words[i:i + spots.n - 1], ' ')
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
        ), listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op11_block_rotation": """
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
                   regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS tokens
            FROM documents
        ), g AS (
            SELECT *, [CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT) FOR i IN range(4)] AS g FROM t
        ), c AS (
            SELECT *, least(g[1] % (len(tokens) + 1), g[2] % (len(tokens) + 1)) AS low,
                   greatest(g[1] % (len(tokens) + 1), g[2] % (len(tokens) + 1)) AS high,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR g[3] % 100 >= 50 THEN 'plain'
                        WHEN g[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM g
        ), parts AS (
            SELECT *, array_to_string(tokens[1:low], '') AS prefix, array_to_string(tokens[low + 1:high], '') AS middle,
                   array_to_string(tokens[high + 1:], '') AS suffix
            FROM c
        )
        SELECT doc_id, len(tokens) AS n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                           WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                           ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    # Every part against every entry, round by round.
    "op12_gnat_codes": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
                   [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), parts AS MATERIALIZED (
            SELECT row, p, q[1 + p * (len(q) // 4):(p + 1) * (len(q) // 4)] AS v FROM kept, range(4) t(p)
        ), b0 AS MATERIALIZED (
            SELECT p, row - 1 AS e, v FROM parts WHERE row <= 256
        ), {codebook_rounds(4)}, codes AS (
            SELECT row, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a4 GROUP BY row
        ), sums AS (
            SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM codes JOIN kept USING (row) GROUP BY label
        )
        SELECT vec_id, code, error, label_error,
               (SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN v], ','), ',' ORDER BY p, e)) FROM b4)
                   AS codebooks_sha256
        FROM codes JOIN kept USING (row) JOIN sums ON sums.label IS NOT DISTINCT FROM kept.label
    """,
    # The exact answer: the graph finds all of it at the size of the SQL check; tests measure its recall at larger ones.
    "op13_pruned_graph": """
        WITH kept AS (
            SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
              AND len([1 FOR x IN embedding IF x <> 0]) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_reduce([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)], lambda x, y: x + y) AS score
            FROM kept q JOIN kept c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
