"""One thin query per operator, over the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import charmarkov, html_paths, langcrf, ledger, packing, pieces, simhash, substrings, suffixes, token_files, turns, vectors, zones
from tidemark.llm.registry import QUERIES, SQL, folder, public_vocabulary, query, table
from tidemark.llm.scratch import Scratch

__all__ = ["QUERIES", "SQL"]

QUALITY_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(body) - length(regexp_replace(body, '[\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Hangul}\\p{Bopomofo}\\p{Thai}\\p{Lao}\\p{Khmer}\\p{Myanmar}]', '', 'g')) AS n_wide
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
f AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
         + 4 * (5 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
         + 16 * (2 * word_chars < 5 * n_words AND 2 * n_wide < word_chars)::BIGINT
         + 32 * (word_chars > 40 * n_words)::BIGINT AS failures FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, failures,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept
FROM f
"""


SECRETS_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
patterns AS (
  SELECT * FROM (VALUES
    (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
    (1, 'access', 'AKIA[A-Z0-9]{14,}'), (2, 'hex', '[0-9a-f]{16,}'),
    (3, 'random', '[A-Za-z0-9+/_=-]{16,}')) t(kind, name, pattern)),
parts AS (
  SELECT doc_id, kind, unnest(regexp_extract_all(body, pattern)) AS m,
         unnest(regexp_split_to_array(body, pattern)[:-2]) AS gap,
         unnest(range(len(regexp_extract_all(body, pattern)))) AS i
  FROM docs, patterns WHERE regexp_matches(body, pattern)),
located AS (
  SELECT doc_id, kind, m,
         sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
  FROM parts),
matches AS (
  SELECT doc_id, kind, (stop - length(m))::BIGINT AS start, stop::BIGINT AS stop, m FROM located),
base AS (
  SELECT * FROM matches JOIN patterns USING (kind)
  WHERE kind IN (1, 2) OR kind = 0 AND length(regexp_extract(m, pattern, 1)) >= 12),
words AS (
  SELECT true AS random, unnest(regexp_extract_all(CASE WHEN kind = 0 THEN regexp_extract(m, pattern, 1) ELSE m END,
                                                   '[A-Za-z0-9+/_=-]+')) AS w FROM base
  UNION ALL
  SELECT false, unnest(regexp_extract_all(CASE WHEN doc_id IN (SELECT doc_id FROM base) THEN regexp_replace(body,
    '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}',
    ' ', 'g') ELSE body END, '[A-Za-z0-9+/_=-]+')) FROM docs
  UNION ALL
  SELECT true, to_base64(unhex(sha256(i::VARCHAR))) FROM range(1000) t(i)),
marked AS (SELECT random, ' ' || w || ' ' AS w, count(*) AS n FROM words GROUP BY ALL),
pairs AS (
  SELECT random, n, ascii(w[i]) AS p, ascii(w[i + 1]) AS c
  FROM (SELECT *, unnest(range(1, length(w))) AS i FROM marked)),
seen AS (
  SELECT p, c, coalesce(sum(n) FILTER (random), 0) AS r, coalesce(sum(n) FILTER (NOT random), 0) AS o
  FROM pairs GROUP BY p, c),
letters AS (
  SELECT *, CASE WHEN p BETWEEN 97 AND 122 THEN p - 32 ELSE p END AS pu,
         CASE WHEN c BETWEEN 97 AND 122 THEN c - 32 ELSE c END AS cu,
         p BETWEEN 97 AND 122 OR p BETWEEN 65 AND 90 AS pl,
         c BETWEEN 97 AND 122 OR c BETWEEN 65 AND 90 AS cl FROM seen WHERE o > 0),
joints AS (SELECT unnest([45, 47, 95]) AS j),
made AS (
  SELECT p, c, 0 AS r, 8 * o AS o FROM letters
  UNION ALL SELECT pu, cu, 0, o FROM letters WHERE pl AND cl
  UNION ALL SELECT p, cu, 0, o FROM letters WHERE pl AND cl
  UNION ALL SELECT j, c, 0, o FROM letters, (FROM joints UNION ALL SELECT 32) WHERE p = 32 AND cl
  UNION ALL SELECT j, cu, 0, o FROM letters, (FROM joints UNION ALL SELECT 32) WHERE p = 32 AND cl
  UNION ALL SELECT p, j, 0, o FROM letters, joints WHERE pl AND c = 32
  UNION ALL SELECT pu, j, 0, o FROM letters, joints WHERE pl AND c = 32
  UNION ALL SELECT p, c, r, 0 FROM seen
  UNION ALL SELECT a.range, b.range, 0, 0 FROM range(128) a, range(128) b),
counts AS (SELECT p, c, sum(r)::DOUBLE AS r, sum(o)::DOUBLE AS o FROM made GROUP BY p, c),
totals AS (SELECT p, sum(r) AS rs, sum(o) AS os FROM counts GROUP BY p),
weights AS (
  SELECT p, c, round(1024 * (ln((r + 1) / (rs + 68)) - ln((o + 1) / (os + 68))))::BIGINT AS weight
  FROM counts JOIN totals USING (p)),
candidates AS (
  SELECT * FROM matches x WHERE kind = 3 AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.start < x.stop AND x.start < b.stop)),
scored AS (
  SELECT m, sum(weight) AS s
  FROM (SELECT m, w, unnest(range(1, length(w))) AS i FROM (SELECT DISTINCT m, ' ' || m || ' ' AS w FROM candidates)) x
  JOIN weights ON p = ascii(w[i]) AND c = ascii(w[i + 1]) GROUP BY m),
spans AS (
  SELECT doc_id, kind, start, name || ':' || start || ':' || stop AS span FROM base
  UNION ALL
  SELECT doc_id, 3, start, 'random:' || start || ':' || stop FROM candidates JOIN scored USING (m)
  WHERE s > 14147),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3), '') AS base,
         string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)
"""


@query("op8_quality_rules", QUALITY_SQL)
def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = ledger.apply_policy(ledger.ledger(docs), ledger.STANDARD)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "failures", (~ledger.passes(ledger.BASE)).alias("base_failed"), "kept",
    )


@query("op1_html")
def html_extraction(spark, sf_dir):
    return html_paths.extract(table(spark, sf_dir, "pages"))


@query("op2_vectors")
def embedding_near_dedup(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark))


@query("op3_token_files")
def token_output(spark, sf_dir):
    path = folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, path, public_vocabulary("word_bpe_49k.json"), "dropped")
    return token_files.read_tokens(spark, path)


@query("op4_substrings")
def substring_dedup(spark, sf_dir):
    rows = substrings.dedup_passages(table(spark, sf_dir, "documents"), Scratch(spark))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_simhash")
def simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), Scratch(spark))


@query("op6_pieces")
def sentence_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = pieces.encode_texts(docs, public_vocabulary("piece_bpe_32k.model"))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32",
        F.length("decoded").cast("long").alias("n_chars"), F.sha2("decoded", 256).alias("text_sha256"),
    )


@query("op7_packing")
def pack(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_vocabulary("byte_bpe_50k.json"))


@query("op9_language")
def language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = langcrf.label_documents(docs, langcrf.learn_from(docs))
    return rows.select("doc_id", langcrf.held_out().alias("held_out"), "lang_pred", "score")


@query("op10_suffix_dedup")
def suffix_array_dedup(spark, sf_dir):
    rows = suffixes.dedup_substrings(table(spark, sf_dir, "documents"), Scratch(spark))
    return rows.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op11_secrets", SECRETS_SQL)
def secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = charmarkov.find(docs, charmarkov.learn(charmarkov.labelled(docs)))
    counts = [charmarkov.count_of(F.col("base"), k).alias(f"n_{k}") for k in charmarkov.KINDS[:3]]
    return rows.select(
        "doc_id", *counts, F.sha2(charmarkov.told(F.col("base")), 256).alias("base_sha256"),
        charmarkov.told(F.col("spans")).alias("spans"),
    )


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


@query("op13_negatives", NEGATIVES_SQL)
def hard_negatives(spark, sf_dir):
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return zones.hard_negatives(table(spark, sf_dir, "embeddings"), Scratch(spark), F.col("vec_id") % 100 == 0, shifted)


def damaged(rows):
    """Conversations with faults put in by the checksum of conversation and turn: one row in twenty
    each is dropped, emptied, loses its stops, is repeated, or becomes the user's."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies.alias("copy")
    ).drop("copy")


@query("op12_conversations")
def conversations(spark, sf_dir):
    rows = damaged(table(spark, sf_dir, "conversations"))
    return turns.repair(rows, Scratch(spark), F.col("dropped"))
