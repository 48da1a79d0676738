"""Registered queries of the operators, each beside its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featherloom.llm.common import table
from featherloom.llm.decontaminate import contamination_digest
from featherloom.llm.html_text import page_texts
from featherloom.llm.jaccard_join import near_duplicate_digest
from featherloom.llm.mixing import mix_digest
from featherloom.llm.prefix_trie import trie_digest
from featherloom.llm.quality import quality_report
from featherloom.llm.simhash import simhash_digest
from featherloom.llm.spelling import spelling_digest
from featherloom.llm.suffix_array import dedup_digest
from featherloom.llm.suffix_tree import passage_digest
from featherloom.llm.top_k import top_k
from featherloom.llm.toxicity import toxicity_report
from featherloom.llm.url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rules of the URL query: host, path, verdict (fixed values).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


@query()
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


@query(r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
       max_by(rhost || rpath, length(rhost || rpath)) AS rule,
       coalesce(max_by(rverdict, length(rhost || rpath)), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
GROUP BY page_id, url, host, path""")
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query()
def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_digest(table(spark, folder, "documents"))


_LEADS = " || ' ' || ".join(f"lead(word, {i}) OVER d" for i in range(1, 13))


@query(rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT doc_id, i, word, word || ' ' || {_LEADS} AS gram FROM w
      WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT gram, min(doc_id) AS first_doc FROM g WHERE gram IS NOT NULL GROUP BY gram),
c AS (SELECT g.doc_id, g.i, g.word, coalesce(f.first_doc < g.doc_id, false) AS late
      FROM g LEFT JOIN f ON g.gram = f.gram),
k AS (SELECT doc_id, i, word, coalesce(bool_or(late) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
      FROM c),
a AS (SELECT doc_id, count_if(gone) AS n_removed,
             string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
      FROM k GROUP BY doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN a USING (doc_id)""")
def op9_suffix_tree_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passage_digest(table(spark, folder, "documents"))


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding,
                    lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                     AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NEXT = ", ".join(f"lead(word, {i}) OVER d AS w{i}" for i in range(1, 10))


@query(rf"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}')
                  AS words FROM benchmark WHERE text IS NOT NULL),
g AS (SELECT item_id, least(10, len(words)) AS n,
             unnest(list_transform(range(1, greatest(1, len(words) - 9) + 1),
                    lambda i: array_to_string(words[i:i + least(10, len(words)) - 1], ' '))) AS gram
      FROM b WHERE len(words) > 0),
t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                        '{_WORD}') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
s AS (SELECT doc_id, i, word, {_NEXT} FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
l AS (SELECT DISTINCT n FROM g),
h AS (SELECT s.doc_id, s.i, l.n, array_to_string([word, w1, w2, w3, w4, w5, w6, w7, w8, w9][1:n],
             ' ') AS gram
      FROM s, l WHERE [word, w1, w2, w3, w4, w5, w6, w7, w8, w9][n] IS NOT NULL),
m AS (SELECT DISTINCT h.doc_id, h.i, h.n, g.item_id FROM h JOIN g USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))
              AS names FROM m GROUP BY doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination_digest(table(spark, folder, "documents"),
                                table(spark, folder, "benchmark"))


@query()
def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_digest(table(spark, folder, "documents"))


@query(rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(1, len(words) - 2) + 1),
             lambda i: array_to_string(words[i:i + 2], ' '))) AS gram FROM t WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
      FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * common >= 90 * (p.size + q.size - common)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM t
                       UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT doc_id, CAST(coalesce(size, 0) AS BIGINT) AS n_shingles, min(reached) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id, size""")
def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_digest(table(spark, folder, "documents"))


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _crc32(text: str, table: str) -> str:
    """SQL of the unsigned crc32 of a string of ASCII and U+00C0 to U+00FF; ``table`` is its column
    of the 256 remainders."""
    bytes_of = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) "
                "< 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))")
    return (f"xor(list_reduce({bytes_of}, lambda r, b: xor(r >> 8, {table}[(xor(r, b) & 255) + 1]),"
            " 4294967295::BIGINT), 4294967295::BIGINT)")


_REMAINDERS = """(SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda r, i:
  CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END, n)) AS crc)"""


@query(rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')),
                           '{_UPPER}', '{_LOWER}') AS run FROM documents),
s AS (SELECT doc_id, run, count(*) AS k FROM t GROUP BY ALL),
h AS (SELECT run, k, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run", "crc")} AS h
      FROM s, {_REMAINDERS}),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run))
                  || substr(run, h % length(run) + 2) ELSE run END AS word,
             CAST(sum(k) AS BIGINT) AS n FROM h GROUP BY 1
      HAVING length(word) >= 6 AND sum(k) >= 5),
p AS (SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (SELECT x.word, y.word AS near FROM p x JOIN p y
        ON x.i = y.i AND x.size = y.size AND x.a = y.a AND x.b = y.b AND x.word <> y.word
      UNION SELECT p.word, w.word FROM p JOIN w ON p.a || p.b = w.word
      UNION SELECT w.word, p.word FROM p JOIN w ON p.a || p.b = w.word),
r AS (SELECT e.word, e.near, v.n AS near_n, row_number() OVER (
        PARTITION BY e.word ORDER BY v.n DESC, e.near) AS place,
        count(*) OVER (PARTITION BY e.word) AS n_near
      FROM e JOIN w v ON v.word = e.near),
f AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
             CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form,
             CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
      FROM w LEFT JOIN r ON r.word = w.word AND r.place = 1),
c(word, here, steps) AS (SELECT word, word, 0 FROM f
                       UNION ALL SELECT c.word, f.form, steps + 1 FROM c JOIN f ON f.word = c.here
                       WHERE f.form IS NOT NULL),
z AS (SELECT word, max_by(here, steps) AS root FROM c GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN z ON z.word = f.word""")
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_digest(table(spark, folder, "documents"))


@query(f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                     coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 100 AS first, h % 6 AS h
      FROM (SELECT c, {_crc32("CAST(c AS VARCHAR)", "crc")} AS h
            FROM (SELECT DISTINCT c FROM t), {_REMAINDERS})),
q AS (SELECT k.c, t.i, 0 AS own, role, text FROM k JOIN t ON t.c = k.first AND t.i <= k.h
      UNION ALL SELECT k.c, t.i, 1, role, text FROM k JOIN t ON t.c = k.c AND t.i > k.h),
o AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, role, text FROM q),
m AS (SELECT c, d, length(text) AS chars, md5(string_agg(concat(length(role), ':', role,
             length(text), ':', text), '') OVER (PARTITION BY c ORDER BY d)) AS node FROM o
      UNION ALL SELECT c, 0, 0, 'root' FROM k),
l AS (SELECT c, max(d) AS d FROM m GROUP BY c),
n AS (SELECT node, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
             any_value(chars) AS chars FROM m GROUP BY node),
u AS (SELECT DISTINCT x.node, y.node AS parent FROM m x JOIN m y ON x.c = y.c AND x.d = y.d + 1),
g AS (SELECT parent, count(*) AS n_children FROM u GROUP BY parent),
b AS (SELECT DISTINCT x.node, y.node AS below FROM m x JOIN m y ON x.c = y.c AND x.d <= y.d),
v AS (SELECT b.node, CAST(count_if(g.parent IS NULL) AS BIGINT) AS n_leaves,
             CAST(sum((n.n_convs - 1) * n.chars) AS BIGINT) AS saved_tokens
      FROM b JOIN n ON n.node = b.below LEFT JOIN g ON g.parent = b.below GROUP BY b.node),
e AS (SELECT m.node, string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) AS ids
      FROM m JOIN l ON l.c = m.c AND l.d = m.d GROUP BY m.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(g.n_children, 0) AS n_children, v.n_leaves, v.saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN v USING (node) LEFT JOIN u USING (node) LEFT JOIN n p ON p.node = u.parent
LEFT JOIN g ON g.parent = n.node LEFT JOIN e ON e.node = n.node""")
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie_digest(table(spark, folder, "conversations"))


@query()
def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_digest(table(spark, folder, "documents"))
