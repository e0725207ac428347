"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

import corpus_pipeline
from riskflow.llm.conversation_repair import op12_conversation_repair
from riskflow.llm.language_id import op5_language_id
from riskflow.llm.learned_partitions import op2_learned_partitions
from riskflow.llm.metric_join import op9_metric_join
from riskflow.llm.ngram_jaccard import op1_ngram_jaccard
from riskflow.llm.packing import op3_best_fit_packing
from riskflow.llm.quality_classifier import op7_quality_classifier
from riskflow.llm.secret_scan import op10_secret_scan
from riskflow.llm.spelling_variants import op11_spelling_variants
from riskflow.llm.source_mixing import op4_source_mixing
from riskflow.llm.suffix_dedup import op6_suffix_dedup
from riskflow.llm.token_counts import op8_token_counts
from riskflow.llm.topk_search import op13_topk_search

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_learned_partitions": op2_learned_partitions,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_source_mixing": op4_source_mixing,
    "op5_language_id": op5_language_id,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_metric_join": op9_metric_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_topk_search": op13_topk_search,
    "pipeline": corpus_pipeline.run,
}

# Exact operators that SQL can express; the others are held against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM worded
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS h FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT l.a, r.other FROM reach r JOIN links l ON l.b = r.doc_id
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, r.component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = sets.doc_id""",

    "op9_metric_join": """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.a, r.other FROM reach r JOIN links l ON l.b = r.vec_id
)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = e.vec_id
JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) r ON r.vec_id = e.vec_id""",

    "op13_topk_search": """
WITH usable AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.w, c.w) AS BIGINT)) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
  GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10""",

    # crc32 byte by byte over distinct (document, run) pairs; near words by the word with one letter left out or masked
    "op11_spelling_variants": r"""
WITH RECURSIVE table_of AS (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, run, count(*) AS n, length(run) AS size FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY doc_id, run HAVING length(run) >= 6
), bytes AS (
  SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run, ''),
                                   lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS l
  FROM runs
), crc(doc_id, run, n, size, l, i, c) AS (
  SELECT doc_id, run, n, size, l, CAST(1 AS BIGINT), CAST(4294967295 AS BIGINT) FROM bytes
  UNION ALL
  SELECT doc_id, run, n, size, l, i + 1, xor(c >> 8, v) FROM crc JOIN table_of ON b = xor(c, CAST(l[i] AS BIGINT)) & 255 WHERE i <= len(l)
), hashed AS (
  SELECT run, n, size, xor(c, 4294967295) AS h FROM crc WHERE i > len(l)
), vocab AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocab
), pairs AS (
  SELECT a.word, b.word AS other
  FROM (SELECT word, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS m FROM places) a
  JOIN (SELECT word, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS m FROM places) b ON a.m = b.m AND a.word <> b.word
  UNION
  SELECT p.word, v.word FROM places p JOIN vocab v ON v.word = substr(p.word, 1, p.i - 1) || substr(p.word, p.i + 1)
  UNION
  SELECT v.word, p.word FROM places p JOIN vocab v ON v.word = substr(p.word, 1, p.i - 1) || substr(p.word, p.i + 1)
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS top, max(o.n) AS top_n
  FROM pairs JOIN (SELECT word AS other, n FROM vocab) o USING (other) GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * v.n THEN top END AS form,
         CASE WHEN top_n >= 5 * v.n THEN top_n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)
), follow(word, tip) AS (
  SELECT word, word FROM formed
  UNION ALL
  SELECT f.word, g.form FROM follow f JOIN formed g ON g.word = f.tip WHERE g.form IS NOT NULL
)
SELECT word, form, tip AS root, n, n_near, form_n
FROM formed JOIN (SELECT f.word, f.tip FROM follow f JOIN formed g ON g.word = f.tip WHERE g.form IS NULL) USING (word)""",
}
