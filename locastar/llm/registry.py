"""Queries of this subpackage: name -> callable(spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locastar.llm import (bpe, chat, exact_dedup, filter_audit, fingerprints, language_id, near_dup, packing, pii, quality,
                          resampling, token_counts, toxicity)
from locastar.llm.common import documents, small_batches, table
from locastar.session import ensure_checkpoint_dir

#: Folder of the public tokenizers' files; None: the installed package.
TOKENIZERS: str | None = None
#: Key of the pseudonyms in the registered queries; a deployment sets its own.
PII_KEY = "example key"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return f"{TOKENIZERS}/{name}" if TOKENIZERS else public_tokenizers.path(name)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat.as_tool_calls(table(spark, sf_dir, "conversations"))
    return chat.format_chat(messages, chat.schema_table(spark, chat.REPLY))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir), keep="max")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.pseudonymise(documents(spark, sf_dir), PII_KEY))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.lengths(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return token_counts.suffix_sums(token_counts.histogram(counted))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), 2048, 1)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.encode(documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, digests=True)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs.select("doc_id", "text"), language_id.train(docs.select("doc_id", "text", "lang")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprints": op3_fingerprints,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_pii": op6_pii,
    "op7_token_counts": op7_token_counts,
    "op8_near_dup": op8_near_dup,
    "op9_packing": op9_packing,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_filter_audit": op11_filter_audit,
    "op12_resampling": op12_resampling,
    "op13_language_id": op13_language_id,
}
ORACLES: dict[str, str] = {
    "op1_chat": """
        WITH RECURSIVE calls AS (SELECT conv_id, turn FROM conversations WHERE role = 'user'),
        circles AS (SELECT conv_id FROM calls WHERE conv_id % 13 = 6 AND turn IN (0, 2) GROUP BY conv_id HAVING count(DISTINCT turn) = 2),
        chain(conv_id, turn, depth) AS (
            SELECT c.conv_id, c.turn, CAST(CASE WHEN c.turn <> 0 AND EXISTS (SELECT 1 FROM calls z WHERE z.conv_id = c.conv_id AND z.turn = 0) THEN 1 ELSE 0 END AS BIGINT)
            FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
            UNION ALL SELECT c.conv_id, c.turn, k.depth + 1 FROM chain k JOIN calls c ON c.conv_id = k.conv_id AND c.turn = k.turn + 2),
        levels AS (SELECT k.conv_id, k.turn, CASE WHEN o.conv_id IS NULL THEN depth END AS depth FROM chain k LEFT JOIN circles o ON o.conv_id = k.conv_id),
        times(n) AS (VALUES (0), (1)),
        said AS (SELECT m.*, n,
                        CASE WHEN m.turn % 8 = 4 THEN 'type words integer string'
                             WHEN m.conv_id % 7 = 3 AND m.turn % 8 = 2 THEN 'missing words; unknown note' ELSE '' END AS broken,
                        len(string_split(m.text, ' ')) AS words
                 FROM conversations m JOIN times ON n = 0 OR (m.role = 'user' AND m.conv_id % 17 = 8))
        SELECT m.conv_id, m.turn, CAST(m.n AS INTEGER) AS "no",
               CASE m.role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'tool' ELSE m.role END AS role,
               CASE m.role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
               CASE m.role WHEN 'user' THEN 'c' || m.turn WHEN 'assistant' THEN 'c' || (m.turn - 1) END AS call_id,
               CASE m.role WHEN 'user' THEN 2 * k.depth WHEN 'assistant' THEN 2 * k.depth + 1 END AS level,
               CASE m.role WHEN 'user' THEN CASE WHEN m.n = 1 THEN 'repeated' WHEN k.depth IS NULL THEN 'cycle' WHEN r.turn IS NULL THEN 'unanswered'
                                                 WHEN broken <> '' THEN 'invalid' ELSE 'linked' END
                           WHEN 'assistant' THEN CASE WHEN k.turn IS NULL THEN 'orphan' ELSE 'linked' END ELSE 'message' END AS status,
               CASE m.role WHEN 'user' THEN broken ELSE '' END AS errors,
               CASE m.role WHEN 'user' THEN json_object('arguments',
                                   CASE WHEN m.turn % 8 = 4 THEN json_object('prompt', m.text, 'turn', m.turn, 'words', CAST(words AS VARCHAR))
                                        WHEN broken <> '' THEN json_object('note', true, 'prompt', m.text, 'turn', m.turn)
                                        ELSE json_object('prompt', m.text, 'turn', m.turn, 'words', words) END,
                                   'id', 'c' || m.turn, 'name', 'reply', 'type', 'call')
                           WHEN 'assistant' THEN json_object('content', m.text, 'tool_call_id', 'c' || (m.turn - 1), 'type', 'result')
                           ELSE json_object('content', m.text, 'role', m.role) END::VARCHAR AS canonical
        FROM said m
        LEFT JOIN levels k ON k.conv_id = m.conv_id AND k.turn = CASE m.role WHEN 'user' THEN m.turn WHEN 'assistant' THEN m.turn - 1 END
        LEFT JOIN conversations r ON r.conv_id = m.conv_id AND r.turn = m.turn + 1 AND r.role = 'assistant' AND m.role = 'user'""",
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op8_near_dup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other)
        SELECT d.doc_id, CAST(coalesce(max(z.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
        FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op11_filter_audit": r"""
        WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        c AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, length(t) AS n, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps,
                     min(doc_id) OVER (PARTITION BY t) AS first_id FROM t),
        f AS (SELECT c.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     list_filter([CASE WHEN len(w) < 200 THEN 'A' END,
                                  CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                                  CASE WHEN 100 * caps > 3 * n THEN 'C' END,
                                  CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                                  CASE WHEN first_id < c.doc_id THEN 'E' END], lambda x: x IS NOT NULL) AS failed
              FROM c LEFT JOIN l ON l.doc_id = c.doc_id),
        x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        o AS (SELECT [a.c, b.c, c.c, d.c, e.c] AS ord FROM x a, x b, x c, x d, x e
              WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
        s AS (SELECT ord, k AS step, ord[k] AS own, ord[1:k - 1] AS before FROM o, range(1, 6) r(k)),
        g AS (SELECT part, failed, good, toxic, count(*) AS n FROM f GROUP BY ALL),
        m AS (SELECT part, array_to_string(ord, '') AS filter_order, step,
                     list_contains(failed, own) AS fails, list_has_any(failed, before) AS gone, len(failed) AS k, good, toxic, n FROM g, s)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step,
               CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
               CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
               CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
               CAST(sum(CASE WHEN fails AND k = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
               CAST(sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
               CAST(sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
               CAST(sum(CASE WHEN fails THEN n * 120 // k ELSE 0 END) AS BIGINT) AS shapley
        FROM m GROUP BY part, filter_order, step""",
    "op12_resampling": r"""
        WITH crc AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) r(i))),
        texts AS (SELECT true AS corpus, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
        ws AS (SELECT corpus, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        fs AS (SELECT corpus, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM ws),
        kinds AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM fs)),
        b AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(length(h) // 2 AS BIGINT)),
                                  lambda i: CAST(16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT))),
                              lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM kinds, crc),
        n AS (SELECT bucket, CAST(count(*) FILTER (corpus) AS DOUBLE) AS s, CAST(count(*) FILTER (NOT corpus) AS DOUBLE) AS t FROM fs JOIN b USING (f) GROUP BY bucket),
        total AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
        gain AS (SELECT bucket, CAST(floor(1000 * ln((n.t + 1) * (total.s + 10000) / ((n.s + 1) * (total.t + 10000)))) AS BIGINT) AS g FROM n, total),
        wt AS (SELECT doc_id, count(*) AS k, sum(g) AS g FROM fs JOIN b USING (f) JOIN gain USING (bucket) WHERE corpus GROUP BY doc_id),
        d AS (SELECT doc_id, len(w) AS words, coalesce(k, 0) AS n_features,
                     CAST(coalesce(CASE WHEN g < 0 THEN -((-g + k - 1) // k) ELSE g // k END, 0) AS BIGINT) AS weight,
                     CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
              FROM ws LEFT JOIN wt USING (doc_id) WHERE corpus),
        sc AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM d),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM sc WHERE words >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM sc LEFT JOIN r USING (doc_id)""",
}


def _ready(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {name: _ready(fn) for name, fn in QUERIES.items()}
