"""The training-data queries on the shared test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    decontamination,
    importance,
    jaccard_join,
    language,
    line_templates,
    metric_tree,
    near_duplicates,
    packing,
    personal_data,
    spelling,
    token_counts,
    toxicity,
    vector_codes,
)
from ledgerline.sources import read_parquet

PACKING_TOKENIZER = "word_bpe_49k.json"
COUNTING_MODEL = "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/benchmark.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        documents(spark, sf_dir), public_tokenizers.path(PACKING_TOKENIZER), with_ids=False
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_viterbi_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op3_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.drop_recurring_lines(documents(spark, sf_dir))
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


# One level of the tree: the vote of each group's lines, the lines that belong, and the children of the rest.
_LINE_LEVEL_SQL = """, sizes{t} AS (
    SELECT g, count(*) AS lines FROM open{t} GROUP BY g
), spread{t} AS (
    SELECT g, tokens, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM open{t}
), template{t} AS (
    SELECT g, i, token FROM (SELECT g, i, token, count(*) AS c FROM spread{t} GROUP BY ALL) JOIN sizes{t} USING (g)
    WHERE c * 2 > lines
), fits{t} AS (
    SELECT g, tokens FROM spread{t} JOIN template{t} USING (g, i, token)
    GROUP BY g, tokens HAVING count(*) >= len(tokens) * CAST(0.8 AS DOUBLE)
), rest{t} AS (
    SELECT g, tokens FROM open{t} ANTI JOIN fits{t} USING (g, tokens)
), probes{t} AS (
    SELECT g, tokens, unnest(list_distinct([4 + k * (len(tokens) - 3) // least(8, len(tokens) - 3)
        FOR k IN range(least(8, len(tokens) - 3))])) AS i FROM rest{t}
), weights{t} AS (
    SELECT g, i, sum(c) AS lines, sum(c * c) AS weight FROM (
        SELECT g, i, tokens[i] AS token, count(*) AS c FROM probes{t} GROUP BY ALL)
    GROUP BY g, i HAVING sum(c * c) < sum(c) * sum(c)
), chosen{t} AS (
    SELECT g, i FROM (
        SELECT g, i, row_number() OVER (PARTITION BY g ORDER BY lines * lines * 4 >= weight * 5 DESC,
            CASE WHEN lines * lines * 4 >= weight * 5 THEN weight ELSE -weight END DESC, i) AS k FROM weights{t})
    WHERE k = 1
), open{u} AS (
    SELECT * FROM (
        SELECT list_concat(g, [CAST(i AS VARCHAR), tokens[i]]) AS g, tokens FROM rest{t} JOIN chosen{t} USING (g))
    QUALIFY count(*) OVER (PARTITION BY g) > 1
)"""

LINE_TEMPLATES_SQL = (
    r"""
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
    FROM documents
), tokens AS (
    SELECT doc_id, text, place, line,
        [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END
         FOR t IN string_split_regex(line, '[ \t\r\f\x0b]+') IF t <> ''] AS tokens
    FROM lines
), parsed AS (
    SELECT *, len(tokens) AS n, tokens[1:3] AS lead FROM tokens
    WHERE len(tokens) >= 3 OR length(regexp_replace(line, '^[ \t\r\f\x0b]+|[ \t\r\f\x0b]+$', '', 'g')) >= 20
), distinct_lines AS (
    SELECT DISTINCT list_concat([CAST(n AS VARCHAR)], lead) AS g, tokens FROM parsed WHERE n >= 3
), open0 AS (
    SELECT * FROM distinct_lines QUALIFY count(*) OVER (PARTITION BY g) > 1
)"""
    + "".join(_LINE_LEVEL_SQL.format(t=t, u=t + 1) for t in range(line_templates.DEPTH + 1))
    + ", general AS ("
    + " UNION ALL ".join(f"SELECT g, tokens FROM fits{t}" for t in range(line_templates.DEPTH + 1))
    + r"""
), mapped AS (
    SELECT p.doc_id, p.text, p.place, p.n, p.lead,
        CASE WHEN g.g IS NOT NULL THEN list_concat(['<general>'], g.g) ELSE p.tokens END AS template
    FROM parsed p LEFT JOIN general g ON p.n >= 3 AND p.tokens = g.tokens
), recurring AS (
    SELECT n, lead, template FROM mapped GROUP BY n, lead, template HAVING count(DISTINCT text) >= 2
), ordered AS (
    SELECT m.doc_id, m.place, row_number() OVER (PARTITION BY m.n, m.lead, m.template ORDER BY m.doc_id, m.place) AS k
    FROM mapped m JOIN recurring r ON m.n = r.n AND m.lead = r.lead AND m.template = r.template
), dropped AS (
    SELECT doc_id, place FROM ordered WHERE k > 1
), rebuilt AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) FILTER (d.place IS NULL) AS text,
        count(*) AS n_lines, count(d.place) AS n_dropped
    FROM lines l LEFT JOIN dropped d ON l.doc_id = d.doc_id AND l.place = d.place GROUP BY l.doc_id
)
SELECT doc_id, coalesce(text, '') AS text, n_lines, n_dropped FROM rebuilt
"""
)


def op4_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(documents(spark, sf_dir))
    counts = [personal_data.kind_count(F.col("base"), kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    base = personal_data.span_text(F.col("base"))
    return found.select(
        "doc_id",
        *counts,
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2(base, 256).alias("base_sha256"),
        personal_data.span_text(F.col("spans")).alias("spans"),
    )


def op5_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(documents(spark, sf_dir), shingle_words=4, percent=80)


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''] AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) >= 4
        THEN list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)])
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
    FROM texts
), sized AS (
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM sets
), items AS (
    SELECT doc_id, unnest(shingles) AS shingle FROM sets
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
    SELECT shared.a, shared.b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
    WHERE 100 * n >= 80 * (p.n_shingles + q.n_shingles - n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sized
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN components USING (doc_id)
"""


def op6_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(COUNTING_MODEL))


def op7_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_sample(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_metric_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.top_inner_products(read_parquet(spark, f"{sf_dir}/embeddings.parquet"))


TOP_K_SQL = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
    SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM vectors
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0 GROUP BY 1, 2
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op11_pivotal_gram_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


SPELLING_SQL = r"""
WITH RECURSIVE found AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), runs AS (
    SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL
), steps AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)
        ORDER BY i) AS step
    FROM (SELECT unnest(range(256)) AS i)
), hashed AS (
    SELECT run, n, xor(list_reduce(
        flatten([CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END
            FOR c IN string_split(concat(doc_id, ':', run), '')]),
        lambda c, b: xor(step[xor(c & 255, b) + 1], c >> 8), 4294967295), 4294967295) AS h
    FROM runs, steps
), spelt AS (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed
), vocabulary AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary
), lacking AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less,
        substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS open FROM places
), pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM lacking a JOIN lacking b ON a.open = b.open AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM lacking a JOIN vocabulary b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM lacking a JOIN vocabulary b ON a.less = b.word
), ranked AS (
    SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM pairs
), words AS (
    SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near,
        CASE WHEN r.other_n >= 2 * v.n THEN r.other END AS form, CASE WHEN r.other_n >= 2 * v.n THEN r.other_n END AS form_n
    FROM vocabulary v LEFT JOIN ranked r ON v.word = r.word AND r.k = 1
), chains AS (
    SELECT word, word AS at, form AS up FROM words
    UNION ALL
    SELECT c.word, w.word, w.form FROM chains c JOIN words w ON c.up = w.word
)
SELECT w.word, w.form, c.at AS root, w.n, w.n_near, w.form_n FROM words w JOIN chains c ON w.word = c.word AND c.up IS NULL
"""


def op12_memoised_cell_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress_vectors(read_parquet(spark, f"{sf_dir}/embeddings.parquet"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


VECTOR_CODES_SQL = """
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pieces AS (
    SELECT r, vec_id, k AS part, v[k * len(v) // 16 + 1 : (k + 1) * len(v) // 16] AS s
    FROM kept, (SELECT unnest(range(16)) AS k)
), book0 AS (
    SELECT part, entry, s AS c FROM (
        SELECT part, s, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, s) - 1 AS entry FROM pieces)
    WHERE entry < 64
), near0 AS (
    SELECT r, p.part, any_value(s) AS s,
        min([list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(s, c)]), entry]) AS best
    FROM pieces p JOIN book0 b ON p.part = b.part GROUP BY r, p.part
), mean1 AS (
    SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS c FROM (
        SELECT part, best[2] AS entry, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM (
            SELECT part, best, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM near0) GROUP BY ALL) GROUP BY ALL
), book1 AS (
    SELECT part, entry, coalesce(m.c, b.c) AS c FROM book0 b LEFT JOIN mean1 m USING (part, entry)
), near1 AS (
    SELECT r, p.part, any_value(s) AS s,
        min([list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(s, c)]), entry]) AS best
    FROM pieces p JOIN book1 b ON p.part = b.part GROUP BY r, p.part
), mean2 AS (
    SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS c FROM (
        SELECT part, best[2] AS entry, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM (
            SELECT part, best, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM near1) GROUP BY ALL) GROUP BY ALL
), book2 AS (
    SELECT part, entry, coalesce(m.c, b.c) AS c FROM book1 b LEFT JOIN mean2 m USING (part, entry)
), near2 AS (
    SELECT r, p.part, min([list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(s, c)]), entry]) AS best
    FROM pieces p JOIN book2 b ON p.part = b.part GROUP BY r, p.part
), coded AS (
    SELECT r, string_agg(printf('%02x', CAST(best[2] AS INTEGER)), '' ORDER BY part) AS code,
        CAST(sum(best[1]) AS BIGINT) AS error
    FROM near2 GROUP BY r
), books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


def op13_t_occurrence_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir), shingle_words=3, percent=90)


JACCARD_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''] AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) >= 3
        THEN list_distinct([array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)])
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
    FROM texts
), sized AS (
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM sets
), items AS (
    SELECT doc_id, unnest(shingles) AS shingle FROM sets
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
    SELECT shared.a, shared.b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
    WHERE 100 * n >= 90 * (p.n_shingles + q.n_shingles - n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sized
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n_shingles, component_id FROM sized JOIN components USING (doc_id)
"""


def queries() -> dict:
    return {name: build for name, build in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_template_dedup": LINE_TEMPLATES_SQL,
        "op5_minhash_near_duplicates": NEAR_DUPLICATES_SQL,
        "op10_metric_tree_top_k": TOP_K_SQL,
        "op11_pivotal_gram_spelling": SPELLING_SQL,
        "op12_memoised_cell_codes": VECTOR_CODES_SQL,
        "op13_t_occurrence_jaccard": JACCARD_SQL,
    }
