"""The registered queries of the subpackage and, where SQL can say it, their
DuckDB form. Each reads its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import pseudo_lm, quality, toxicity
from .bpe import round_trip_digests
from .common import staged, table, text_or_empty
from .embedding_join import cosine_join
from .exact_dedup import exact_dedup
from .importance import resample
from .ngram_join import jaccard_join
from .packing import pack, word_lengths
from .sharding import shard_documents
from .token_tree import EDITS, apply_edits, build_trees
from .url_filter import fit_url_model, judge_urls, labelled_urls
from .vector_codes import ENTRIES, PARTS, ROUNDS, compress

#: The rules of the URL query and its shard count.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SHARDS = 24


def ranks():
    """The rank file and split pattern that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_url_filter(spark, sf_dir):
    """The labelled URL table: pages of documents whose quality is labelled."""
    pages = table(spark, sf_dir, "pages")
    model = fit_url_model(labelled_urls(pages, table(spark, sf_dir, "labels")))
    return judge_urls(pages, model, URL_RULES)


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def edits_of(doc_id, text):
    """Two edits for every document, derived from it: one replaces up to 23
    characters by a stretch of the same text, one inserts such a stretch."""
    def draw(k, below):
        return F.pmod(F.xxhash64(doc_id, F.lit(k)), below).cast("int")

    size = F.length(text)

    def one(k, removed):
        return F.struct(draw(k, size + 1).alias("start"), removed.alias("removed"),
                        F.substr(text, draw(k + 1, size + 1) + 1, F.lit(24)).alias("inserted"))

    return F.array(one(1, draw(9, F.lit(24))), one(5, F.lit(0))).cast(EDITS)


def op3_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = build_trees(docs.withColumn("edits", edits_of(F.col("doc_id"), text_or_empty("text"))), *ranks())
    return (apply_edits(trees, *ranks())
            .select("doc_id", "n_tokens_before", "n_tokens", "n_encoded",
                    F.element_at("tree.pieces", 2).alias("n_pieces")))


def op4_sharding(spark, sf_dir):
    """Shards are written with their texts; the digests come from the written rows."""
    written = shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    text = text_or_empty("text")
    return written.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                          F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
                          "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_embedding_join(spark, sf_dir):
    found = cosine_join(table(spark, sf_dir, "embeddings"), 0.9)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, index).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted",
                                              "evidence")


def op7_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = staged(pseudo_lm.word_counts(docs), "lm_counts")
    codes = pseudo_lm.staged_codes(docs, pseudo_lm.own_words(counts), counts=counts)
    return pseudo_lm.score(docs, *pseudo_lm.fit(docs, counts=counts, codes=codes), counts=counts, codes=codes)


def op8_byte_bpe(spark, sf_dir):
    return round_trip_digests(table(spark, sf_dir, "documents"), *ranks())


def op9_packing(spark, sf_dir):
    return pack(word_lengths(table(spark, sf_dir, "documents")))


def op10_ngram_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op11_importance_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.classify(docs, labels.where(~quality.held_out()))
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op13_vector_codes(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def _vector_codes_sql() -> str:
    """Lloyd rounds written out: the assignment of every part, then the floor means."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
            a{r} AS MATERIALIZED (
              SELECT p.vec_id, p.pos, arg_min(c.entry, (d2(p.x, c.x), c.entry)) AS entry, min(d2(p.x, c.x)) AS d
              FROM parts p JOIN c{r} c USING (pos) GROUP BY p.vec_id, p.pos)""")
        if r < ROUNDS:
            steps.append(f"""
            u{r} AS (
              SELECT pos, entry, list(CAST(floor_div(s, n) AS BIGINT) ORDER BY i) AS x FROM (
                SELECT a.pos, a.entry, t.i, sum(p.x[t.i]) AS s, count(*) AS n
                FROM a{r} a JOIN parts p USING (vec_id, pos), unnest(range(1, len(p.x) + 1)) AS t(i)
                GROUP BY a.pos, a.entry, t.i) GROUP BY pos, entry),
            c{r + 1} AS MATERIALIZED (
              SELECT c.pos, c.entry, coalesce(u.x, c.x) AS x FROM c{r} c LEFT JOIN u{r} u USING (pos, entry))""")
    body = ",".join(steps).replace("d2(p.x, c.x)", "list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.x, c.x)])")
    body = body.replace("floor_div(s, n)", "((s - (((s % n) + n) % n)) // n)")
    return f"""
        WITH good AS MATERIALIZED (
              SELECT vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) FOR x IN embedding] AS v
              FROM embeddings
              WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
            parts AS MATERIALIZED (
              SELECT vec_id, pos, v[pos * (len(v) // {PARTS}) + 1:(pos + 1) * (len(v) // {PARTS})] AS x
              FROM good, unnest(range({PARTS})) AS t(pos)),
            c0 AS MATERIALIZED (
              SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry, x FROM parts
              QUALIFY row_number() OVER (PARTITION BY pos ORDER BY vec_id) <= {ENTRIES}),{body},
            codes AS MATERIALIZED (
              SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY pos) AS code,
                     CAST(sum(d) AS BIGINT) AS error
              FROM a{ROUNDS} GROUP BY vec_id),
            book AS (SELECT string_agg(CAST(x[i] AS VARCHAR), ',' ORDER BY pos, entry, i) AS all_x
                     FROM c{ROUNDS}, unnest(range(1, len(x) + 1)) AS t(i))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(all_x) FROM book) AS codebooks_sha256
        FROM codes JOIN good USING (vec_id)
    """


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_url_filter, op2_exact_dedup, op3_token_counts, op4_sharding, op5_embedding_join, op6_toxicity,
        op7_lm_scoring, op8_byte_bpe, op9_packing, op10_ngram_join, op11_importance_resampling,
        op12_quality_classifier, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {
        "op11_importance_resampling": r"""
            WITH steps AS (
                   SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                                         CAST(i AS BIGINT)) AS c
                   FROM range(256) AS t(i)),
                 crc AS (SELECT list(c ORDER BY i) AS tbl FROM steps),
                 w AS MATERIALIZED (
                   SELECT 0 AS kind, doc_id, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
                   UNION ALL
                   SELECT 1, item_id, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
                 f AS MATERIALIZED (SELECT kind, doc_id, unnest(words) AS word FROM w),
                 b AS MATERIALIZED (
                   SELECT word, xor(list_reduce(
                     [CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT) FOR i IN range(len(h) // 2)],
                     lambda c, x: xor(c >> 8, tbl[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
                   FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM f), crc),
                 n AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t
                       FROM f JOIN b USING (word) GROUP BY bucket),
                 every AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM n),
                 g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
                                / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
                       FROM n, every),
                 d AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
                       FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE kind = 0 GROUP BY doc_id),
                 scored AS MATERIALIZED (
                   SELECT w.doc_id, len(words) AS n_features, coalesce(d.weight, 0) AS weight,
                          coalesce(d.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || w.doc_id), 1, 8)
                            AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
                   FROM w LEFT JOIN d USING (doc_id) WHERE kind = 0),
                 able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
                          FROM scored WHERE n_features >= 20)
            SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
            FROM scored LEFT JOIN able USING (doc_id)
        """,
        "op13_vector_codes": _vector_codes_sql(),
        "op2_exact_dedup": """
            WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
                 g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
            SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
                   sha256(t.text) AS text_sha256
            FROM t JOIN g USING (text)
        """,
        "op5_embedding_join": """
            WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
                 good AS MATERIALIZED (
                   SELECT * FROM v WHERE len(e) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN e])
                                         AND list_bool_or([x <> 0 FOR x IN e])),
                 pairs AS MATERIALIZED (
                   SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id
                   WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
                 reach AS (SELECT vec_id AS x, vec_id AS y FROM v
                           UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x),
                 least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
            SELECT x AS vec_id, (SELECT count(*) FROM pairs WHERE pairs.x = least.x) AS n_links,
                   component_id, x = component_id AS kept
            FROM least
        """,
        "op10_ngram_join": """
            WITH RECURSIVE w AS (
                   SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS words
                   FROM documents),
                 s AS MATERIALIZED (
                   SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
                   FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0),
                 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
                 pairs AS MATERIALIZED (
                   SELECT a.doc_id AS x, b.doc_id AS y
                   FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                   JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
                   GROUP BY a.doc_id, b.doc_id, na.n, nb.n
                   HAVING count(*) * 5 >= 4 * (na.n + nb.n - count(*))),
                 reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
                           UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x),
                 least AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x)
            SELECT x AS doc_id, class_id, (SELECT count(*) FROM pairs WHERE pairs.x = least.x) AS n_links,
                   x = class_id AS kept
            FROM least
        """,
    }
