"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm.decontaminate import op3_decontaminate
from tradeloom.llm.frames import prepare
from tradeloom.llm.language import op2_language_id
from tradeloom.llm.mixing import op5_mix_sources
from tradeloom.llm.negatives import op11_hard_negatives
from tradeloom.llm.parity import op9_ngram_jaccard
from tradeloom.llm.pii import op8_pii
from tradeloom.llm.quality import op1_quality
from tradeloom.llm.rules import op12_quality_rules
from tradeloom.llm.spelling import op13_spelling_variants
from tradeloom.llm.substrings import op7_suffix_dedup
from tradeloom.llm.tokens import op4_token_counts
from tradeloom.llm.toxicity import op10_toxicity
from tradeloom.llm.vectors import op6_embedding_dedup


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


OPERATORS = (
    op1_quality,
    op2_language_id,
    op3_decontaminate,
    op4_token_counts,
    op5_mix_sources,
    op6_embedding_dedup,
    op7_suffix_dedup,
    op8_pii,
    op9_ngram_jaccard,
    op10_toxicity,
    op11_hard_negatives,
    op12_quality_rules,
    op13_spelling_variants,
)
QUERIES = {query.__name__: _prepared(query) for query in OPERATORS}

MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST(CAST('0x' || substr(md5('5:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE)
               / 4503599627370496.0 AS known
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
           CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS weight
    FROM sources
), ordered AS (
    SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, source) AS place FROM weighted
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ordered
), final AS (
    SELECT coalesce((SELECT level FROM levels WHERE cap > level * weight ORDER BY place LIMIT 1),
                    (SELECT max(level) FROM levels)) AS level
), plan AS (
    SELECT source, source_size, least(cap, final.level * weight) AS target FROM weighted, final
), rated AS (
    SELECT doc_id, size, source_size, target, known,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
    FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN known < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CAST(floor(rate) + CASE WHEN known < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM rated
"""

VECTOR_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS x, vec_id AS y FROM v
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
), counted AS (
    SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON least.x = v.vec_id LEFT JOIN counted ON counted.x = v.vec_id
"""

NEAR_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + 4], ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM w
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM w JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = w.doc_id
LEFT JOIN sizes ON sizes.doc_id = w.doc_id
"""

NEGATIVE_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

# The checksum is made bit by bit: a byte is added, then eight steps of division follow.
SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
        FROM documents)
    WHERE len(run) >= 5 GROUP BY ALL
), hex AS (
    SELECT *, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS digits FROM runs
), summed AS (
    SELECT *, xor(4294967295, list_reduce(
        flatten(list_transform(range(0, len(digits), 2),
                               lambda i: [CAST('0x' || substr(digits, i + 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END,
        4294967295)) AS h
    FROM hex
), spelt AS (
    SELECT times, CASE WHEN h % 97 = 0
        THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word
    FROM summed
), w AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE len(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM w)
), pairs AS (
    SELECT DISTINCT cut.word AS a, w.word AS b FROM cut JOIN w ON w.word = cut.head || cut.tail
    UNION
    SELECT p.word, q.word FROM cut p JOIN cut q ON p.head = q.head AND p.tail = q.tail AND p.word < q.word
), links AS (
    SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), ranked AS (
    SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
    FROM links JOIN w ON w.word = b
), formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN r.b END AS form,
           CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
    FROM w LEFT JOIN ranked r ON r.a = w.word AND r.place = 1
), way AS (
    SELECT word, word AS root FROM formed
    UNION ALL
    SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL
), ends AS (
    SELECT way.word, way.root FROM way JOIN formed ON formed.word = way.root AND formed.form IS NULL
)
SELECT formed.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM formed JOIN ends ON ends.word = formed.word
"""

ORACLE_SQL = {
    "op5_mix_sources": MIX_SQL,
    "op6_embedding_dedup": VECTOR_SQL,
    "op9_ngram_jaccard": NEAR_SQL,
    "op11_hard_negatives": NEGATIVE_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
