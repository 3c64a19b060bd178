"""The queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm import byte_bpe, chat, class_lm, collocations, decontamination, filter_audit, lines, mixing, near_duplicates, passages, repetition, token_files, toxicity
from cohortloom.llm.common import SQL_WORDS, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = repetition.repetition_rules(table(spark, sf_dir, "documents"))
    return rules.drop("longest_repeat", "n_maximal_repeats")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "removed", F.md5("text").alias("text_md5"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.shard_folder(spark)
    token_files.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.read_documents(spark, path)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = chat.extra_conversation(spark, "</s>[INST] ok [/INST]", -7)
    return chat.read_back(chat.format_conversations(conversations.unionByName(control)))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.class_scores(table(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    codec = byte_bpe.ByteBpe(byte_bpe.read_ranks(tokenizer_path(RANKS)), public_tokenizers.PATTERN)
    decoded = codec.decode(codec.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_repetition": op2_repetition,
    "op3_decontamination": op3_decontamination,
    "op4_lines": op4_lines,
    "op5_mixing": op5_mixing,
    "op6_token_files": op6_token_files,
    "op7_chat": op7_chat,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_class_lm": op9_class_lm,
    "op10_passages": op10_passages,
    "pipeline": pipeline,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}

# A repeat of five words or more covers what its five-word windows cover, and a repeat of
# more than a hundred words is a window of 101 that occurs twice; so SQL needs no suffixes.
_REPETITION = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
n AS (SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n_words FROM d),
windows AS (
    SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS run
    FROM n, (VALUES (5), (8), (101)) AS s(size), unnest(generate_series(1, n_words - size + 1)) AS g(i)
),
repeated AS (
    SELECT doc_id, size, unnest(places) AS i
    FROM (SELECT doc_id, size, list(i) AS places FROM windows GROUP BY doc_id, size, run HAVING count(*) > 1)
),
spots AS (SELECT DISTINCT doc_id, size, i + k AS at FROM repeated, unnest(generate_series(0, size - 1)) AS g(k)),
covered AS (
    SELECT doc_id, count(*) FILTER (size = 5) AS covered_words, count(*) FILTER (size = 8) AS n_repeat_words,
        count(*) FILTER (size = 101) AS too_long
    FROM spots GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM n)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
base AS (
    SELECT doc_id, n_words,
        CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(covered_words, 0) AS covered_words, coalesce(too_long, 0) AS too_long
    FROM n LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND covered_words <= 0.3 * n_words AND too_long = 0 AS kept, covered_words
FROM judged
"""

_MIXING = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, CAST(len({SQL_WORDS}) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS key FROM documents
),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight
    FROM d GROUP BY source
),
-- sources by the level at which they are full: those below a level are taken whole
r AS (SELECT *, 3 * source_size / weight AS full_at FROM s),
f AS (
    SELECT a.full_at, (SELECT sum(source_size) FROM s) - coalesce(sum(b.source_size * 3) FILTER (b.full_at < a.full_at), 0) AS left_over,
        sum(b.weight) FILTER (b.full_at >= a.full_at) AS weights
    FROM (SELECT DISTINCT full_at FROM r) a, r b GROUP BY a.full_at
),
level AS (SELECT arg_min(left_over / weights, full_at) FILTER (left_over / weights <= full_at) AS level FROM f),
t AS (SELECT source, source_size, round(least(CAST(source_size * 3 AS DOUBLE), weight * level), 6) AS target FROM r, level),
o AS (
    SELECT d.*, source_size, target,
        CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS rounds,
        sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size + size / 2 AS middle
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
c AS (SELECT *, CAST(least(rounds + CASE WHEN middle <= target - rounds * source_size THEN 1 ELSE 0 END, 3) AS BIGINT) AS copies FROM o)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM c
"""

# Constant parts of the template around a user's turn: <s>[ROLE][/ROLE][INST][/INST], and
# around an assistant's: [ROLE][/ROLE]</s>.
_CHAT = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
    SELECT *, role = 'assistant' AS learned,
        length(text) + length(role) + length(regexp_replace(text || role, '[^\\<\[]', '', 'g')) AS escaped
    FROM c
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (learned), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (learned), '')) AS loss_sha256,
    CAST(sum(escaped + CASE WHEN learned THEN length('[ROLE][/ROLE]</s>') ELSE length('<s>[ROLE][/ROLE][INST][/INST]') END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_AUDIT = rf"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents
),
l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
        len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
        100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
        regexp_matches(text, '[#$%&*|]'),
        coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)
    ] AS fails FROM d LEFT JOIN l ON d.doc_id = l.doc_id
),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
r AS (
    SELECT m.*, o, list_position(list_transform(o, lambda i: fails[i]), true) AS gone FROM m, o
),
s AS (
    SELECT part, o, i AS step, o[i] AS f, sum(n) FILTER (gone IS NULL OR gone > i) AS kept,
        sum(n) FILTER (gone = i) AS removed, sum(n) FILTER (fails[o[i]] AND gone < i) AS redundant,
        sum(n) FILTER (fails[o[i]] AND len(list_filter(fails, lambda v: v)) = 1) AS unique_fails,
        sum(good) FILTER (gone = i) AS good_lost, sum(toxic) FILTER (gone = i) AS toxic_lost
    FROM r, x GROUP BY part, o, i
)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step,
    CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM s
"""

_COLLOCATIONS = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
p AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
w AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p),
four AS (
    SELECT lang, w1, lead(w1) OVER z AS w2, lead(w1, 2) OVER z AS w3, lead(w1, 3) OVER z AS w4
    FROM w WINDOW z AS (PARTITION BY piece ORDER BY i)
),
phrases AS (
    SELECT lang, 1 AS size, w1 AS phrase FROM four
    UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM four WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM four WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM four WHERE w4 IS NOT NULL
),
f AS (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 30),
cuts AS (
    SELECT lang, size, phrase, f AS a, k, array_to_string(w[:k], ' ') AS left_part, array_to_string(w[k + 1:], ' ') AS right_part
    FROM c, (VALUES (1), (2), (3)) AS v(k) WHERE k < size
),
s AS (
    SELECT cuts.*, l.f AS l, r.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (l.f + r.f) AS BIGINT) AS score
    FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = left_part JOIN f r ON r.lang = cuts.lang AND r.phrase = right_part
),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS around
    FROM c, (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) AS v(m, i) WHERE m < size AND i + m - 1 <= size GROUP BY ALL
),
kept AS (
    SELECT best.lang, best.phrase, a, l, r, score
    FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
    WHERE around IS NULL OR CAST(100 AS HUGEINT) * around < CAST(80 AS HUGEINT) * a
),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_repetition": _REPETITION, "op5_mixing": _MIXING, "op7_chat": _CHAT, "op12_filter_audit": _AUDIT,
    "op13_collocations": _COLLOCATIONS,
}
