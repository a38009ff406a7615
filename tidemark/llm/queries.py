"""One query per operator over the provided tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontamination,
    importance_resampling,
    jaccard_tiles,
    kd_sharding,
    license_scan,
    line_blocks,
    mixing,
    phrase_automata,
    posting_lists,
    quality_attention,
    token_alignment,
    token_store,
    toxicity_crf,
)
from tidemark.llm.common import table

SHARDS = 40
TOKENIZER = "word_bpe_49k.json"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_sharding.shard_table(table(spark, sf_dir, "documents"), SHARDS)


def op2_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.digests(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    file = public_tokenizers.path(TOKENIZER)
    return token_store.token_index(table(spark, sf_dir, "documents"), file)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op6_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_crf.score_table(*(table(spark, sf_dir, t) for t in ("documents", "labels")))


def op7_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extract_pages(table(spark, sf_dir, "pages"))


def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(table(spark, sf_dir, "embeddings"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(*(table(spark, sf_dir, t) for t in ("documents", "benchmark")))


def op10_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.component_table(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = map(public_tokenizers.path, (TOKENIZER_A, TOKENIZER_B))
    return token_alignment.alignment_table(table(spark, sf_dir, "documents"), *files)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.importance_table(*(table(spark, sf_dir, t) for t in ("documents", "benchmark")))


def op13_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_attention.score_table(*(table(spark, sf_dir, t) for t in ("documents", "labels")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_kd_sharding,
        op2_phrase_automata,
        op3_license_scan,
        op4_token_store,
        op5_source_mixing,
        op6_toxicity_crf,
        op7_line_blocks,
        op8_posting_lists,
        op9_decontamination,
        op10_jaccard_tiles,
        op11_token_alignment,
        op12_importance_resampling,
        op13_quality_attention,
    )
}

_SHIFTS = ", ".join(f"({j}, {j / mixing.SHIFTS!r}::DOUBLE)" for j in range(mixing.SHIFTS))

ORACLES: dict[str, str] = {
    "op5_source_mixing": f"""
WITH drawn AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')), 1, 13))::BIGINT
               / 4503599627370496.0::DOUBLE AS draw
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM drawn GROUP BY source
), weighted AS (
    SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sizes
), ordered AS (
    SELECT *, source_size / weight AS fullness,
           sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
    FROM weighted
), filled AS (
    SELECT *, coalesce(sum(3 * source_size) OVER before, 0) AS cap_before,
           coalesce(sum(weight) OVER before, 0) AS weight_before
    FROM ordered
    WINDOW before AS (ORDER BY fullness, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
    SELECT *, (total - cap_before) * weight > 3 * source_size * (weights - weight_before) AS capped FROM filled
), pooled AS (
    SELECT *, total - coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0) AS pool,
           sum(weight) FILTER (NOT capped) OVER () AS open
    FROM judged
), aimed AS (
    SELECT source, source_size,
           CASE WHEN capped OR source_size = 0 THEN (3 * source_size)::DOUBLE
                ELSE (pool * weight)::DOUBLE / open::DOUBLE END AS target
    FROM pooled
), rated AS (
    SELECT d.*, a.source_size, a.target,
           CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS rate
    FROM drawn d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
), tries AS (
    SELECT r.source, any_value(r.target) AS target, s.j, any_value(s.shift) AS shift,
           sum(size * (floor(rate) + ((draw + s.shift) - floor(draw + s.shift) < rate - floor(rate))::INT)) AS taken
    FROM rated r, (VALUES {_SHIFTS}) s(j, shift) GROUP BY r.source, s.j
), best AS (
    SELECT source, shift FROM tries
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(taken - target), j) = 1
)
SELECT doc_id, size, r.source_size, r.target,
       (size * (floor(rate) + ((draw + shift) - floor(draw + shift) < rate - floor(rate))::INT))::BIGINT AS taken
FROM rated r JOIN best b ON r.source IS NOT DISTINCT FROM b.source
""",
    "op2_phrase_automata": r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), words AS (
    SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos, len(w) AS n FROM docs
), windows AS (
    SELECT r, pos, word, n,
           md5(array_to_string(list(word) OVER (PARTITION BY r ORDER BY pos
               ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING), ' ')) AS name
    FROM words
), judged AS (
    SELECT r, pos, word, pos <= n - 35 AND count(*) FILTER (pos <= n - 35) OVER (PARTITION BY name, pos <= n - 35) > 1 AS again
    FROM windows
), covered AS (
    SELECT r, pos, word,
           bool_or(again) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM judged
), kept AS (
    SELECT r, count(*) FILTER (gone) AS n_removed,
           string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS text
    FROM covered GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
""",
    "op10_jaccard_tiles": r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM documents
), words AS (
    SELECT r, unnest(w) AS a, unnest(range(len(w))) AS pos, len(w) AS n FROM docs
), runs AS (
    SELECT r, pos, n, a, lead(a) OVER doc AS b, lead(a, 2) OVER doc AS c
    FROM words WINDOW doc AS (PARTITION BY r ORDER BY pos)
), shingles AS (
    SELECT DISTINCT r, concat_ws(' ', a, b, c) AS shingle FROM runs WHERE pos <= greatest(n - 3, 0)
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
    SELECT x.r AS a, y.r AS b
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.r <> y.r
    JOIN sizes p ON p.r = x.r JOIN sizes q ON q.r = y.r
    WHERE 100 * least(p.n, q.n) >= 90 * greatest(p.n, q.n)
    GROUP BY x.r, y.r, p.n, q.n
    HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
), reached AS (
    SELECT r AS a, r AS b FROM docs
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), smallest AS (
    SELECT reached.a, min(docs.doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.b GROUP BY 1
)
SELECT doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id
FROM docs JOIN smallest ON smallest.a = docs.r LEFT JOIN sizes ON sizes.r = docs.r
""",
    "op12_importance_resampling": r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, text FROM documents
    UNION ALL SELECT NULL, NULL, text FROM benchmark
), split AS (
    SELECT r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), counted AS (
    SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM split) GROUP BY r, word
), steps AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS step
    FROM (SELECT unnest(range(256)) AS i)
), codes AS (
    SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM counted)
), buckets AS (
    SELECT word, xor(list_reduce(
               [4294967295::BIGINT] || list_transform(range(1, len(code), 2), lambda k: ('0x' || substr(code, k, 2))::BIGINT),
               lambda c, b: xor(step[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 10000 AS bucket
    FROM codes, steps
), sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (r IS NOT NULL), 0) AS s, coalesce(sum(n) FILTER (r IS NULL), 0) AS t
    FROM counted JOIN buckets USING (word) GROUP BY bucket
), totals AS (
    SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE)
                                   / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM sums, totals
), weights AS (
    SELECT r, sum(n * gain)::BIGINT AS weight
    FROM counted JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
    SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
    FROM split LEFT JOIN weights USING (r) WHERE r IS NOT NULL
), ranked AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (r)
""",
}
