"""Each operator as a query over the whole of its table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.llm import (
    byte_bpe,
    chat,
    embeddings,
    exact_dedup,
    jaccard,
    lm_score,
    mixing,
    quality,
    secrets,
    spelling,
    suffixes,
    token_output,
    whitening,
)

# The turns of the added conversation.
CONTROL_ROLES = ("user", "assistant")


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark, sf_dir):
    """Write the corpus as token files and read their digests back."""
    written, ranks = token_output.write_tokens(_read(spark, sf_dir, "documents"))
    return token_output.token_digests(written, ranks)


def op2_lm_score(spark, sf_dir):
    """Log probabilities of every document."""
    return lm_score.score_documents(_read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark, sf_dir):
    """Classes of documents that share most of their shingles."""
    return jaccard.similar_documents(_read(spark, sf_dir, "documents"))


def op4_byte_bpe(spark, sf_dir):
    """Encode every text and decode its ids."""
    return byte_bpe.round_trip(_read(spark, sf_dir, "documents"))


def op5_exact_dedup(spark, sf_dir):
    """Groups of equal texts."""
    return exact_dedup.exact_duplicates(_read(spark, sf_dir, "documents")).drop("copies_of_id")


def op6_secret_scan(spark, sf_dir):
    """Secrets by pattern and by character model."""
    docs = _read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


def op7_source_mixing(spark, sf_dir):
    """How much the mix takes of every document, and when."""
    return mixing.mix(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", "positions"
    )


def op8_chat_format(spark, sf_dir):
    """All conversations, and one that consists of control strings, read back from their tree."""
    conversations = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(CONTROL_ROLES)]
    extra = spark.createDataFrame(control, "conv_id bigint, turn bigint, role string, text string")
    tree, paths = chat.format_conversations(conversations.unionByName(extra))
    return chat.read_conversations(tree, paths).drop("formatted_tokens")


def op9_quality(spark, sf_dir):
    """Scores of every document by a model of its labels."""
    docs = _read(spark, sf_dir, "documents")
    model = quality.train(docs, _read(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model)


def op10_embedding_dedup(spark, sf_dir):
    """Links and components of all vectors."""
    return embeddings.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark, sf_dir):
    """Words with the frequent words that they are variants of."""
    return spelling.spelling_variants(_read(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    """Coordinates of all vectors along the leading directions of their covariance."""
    whitened = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    # Null where the exact number is no long.
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_suffix_dedup(spark, sf_dir):
    """What stays of every text without passages of documents with smaller ids."""
    return suffixes.remove_repeats(_read(spark, sf_dir, "documents")).drop("spans")


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_lm_score": op2_lm_score,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_source_mixing": op7_source_mixing,
    "op8_chat_format": op8_chat_format,
    "op9_quality": op9_quality,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_suffix_dedup": op13_suffix_dedup,
}

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PLAIN_SQL = f"translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}')"
COMPONENTS_SQL = """
        reach AS (
          SELECT DISTINCT a AS node, a AS other FROM links
          UNION
          SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
        classes AS (SELECT node, min(other) AS class FROM reach GROUP BY node)"""

ORACLES = {
    "op3_jaccard_join": f"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(
            regexp_split_to_array({PLAIN_SQL}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(list_transform(
            range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
          FROM words WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
          FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        pairs AS (
          SELECT a, b, shared.n = p.n AND shared.n = q.n AS same
          FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 9 * shared.n >= 4 * (p.n + q.n)
          UNION ALL
          SELECT x.doc_id, y.doc_id, true FROM words x JOIN words y ON x.doc_id <> y.doc_id
          WHERE len(x.w) = 0 AND len(y.w) = 0),
        links AS (SELECT a, b FROM pairs), {COMPONENTS_SQL}
        SELECT w.doc_id, coalesce(class, w.doc_id) AS class_id,
          coalesce(links, 0) AS n_links, coalesce(class, w.doc_id) = w.doc_id AS kept,
          coalesce(n, 0) AS n_shingles, 1 + coalesce(same, 0) AS n_same
        FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN classes ON node = w.doc_id
        LEFT JOIN (SELECT a, count(*) AS links, count(*) FILTER (WHERE same) AS same
                   FROM pairs GROUP BY a) ON a = w.doc_id""",
    "op5_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
          doc_id = max(doc_id) OVER w AS kept, sha256(plain) AS text_sha256
        FROM (SELECT doc_id, {PLAIN_SQL} AS plain FROM documents)
        WINDOW w AS (PARTITION BY plain)""",
    "op8_chat_format": r"""
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        long AS (
          SELECT *, length(regexp_replace(role || text,
            '(\\|<\||\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)', '_\1', 'g')) + 8 AS n
          FROM turns)
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
            AS turns_sha256,
          CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
            AS loss_chars,
          sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
            ORDER BY turn, role, text)) AS loss_sha256,
          CAST(sum(n) AS BIGINT) AS formatted_chars
        FROM long GROUP BY conv_id""",
    "op10_embedding_dedup": f"""
        WITH RECURSIVE able AS (
          SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
            AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs AS (
          SELECT x.vec_id AS a, y.vec_id AS b, x.v = y.v AS same
          FROM able x JOIN able y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
          WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
        links AS (SELECT a, b FROM pairs), {COMPONENTS_SQL}
        SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(class, e.vec_id) AS component_id,
          coalesce(class, e.vec_id) = e.vec_id AS kept, 1 + coalesce(same, 0) AS n_same
        FROM embeddings e LEFT JOIN classes ON node = e.vec_id
        LEFT JOIN (SELECT a, count(*) AS n, count(*) FILTER (WHERE same) AS same
                   FROM pairs GROUP BY a) ON a = e.vec_id""",
    "op13_suffix_dedup": """
        WITH texts AS (
          SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (
          SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
          FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM texts)),
        gone AS (
          SELECT doc_id, i FROM windows
          JOIN (SELECT w, min(doc_id) AS least FROM windows GROUP BY w
                HAVING min(doc_id) < max(doc_id)) USING (w)
          WHERE least < doc_id),
        begun AS (
          SELECT doc_id, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true)
            AS starts FROM gone),
        runs AS (
          SELECT doc_id, min(i) AS a, max(i) + 50 AS b
          FROM (SELECT *, count_if(starts) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM begun)
          GROUP BY doc_id, run),
        kept AS (
          SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (coalesce(next, length(h) // 2) - b)),
                                    '' ORDER BY b) AS h
          FROM (SELECT doc_id, b, lead(a) OVER (PARTITION BY doc_id ORDER BY b) AS next
                FROM (SELECT * FROM runs UNION ALL SELECT doc_id, 0, 0 FROM texts))
          JOIN texts USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, length(t.h) // 2 AS n_bytes, (length(t.h) - length(k.h)) // 2 AS n_removed,
          coalesce(n, 0) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
        FROM texts t JOIN kept k USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id) USING (doc_id)""",
}
