"""The numbered queries of this subpackage and the SQL that DuckDB can hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, cover, jaccard, lines, mtree, packing, pieces, quality, ranked, repeats, secrets, sharding, spelling, warc


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded. Null and empty texts have no pieces; repeated rows and rows without doc_id give a row each."""
    return pieces.encode_decode(common.table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text. A null text counts as empty; repeated rows and rows without doc_id give a row each."""
    return secrets.scan(common.table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every text. A null text has no words; texts of one doc_id come in the order of their digests, a row read twice is cut once."""
    return repeats.digests(common.table(spark, sf_dir, "documents"))


def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place for every row. A null text has no bytes; null doc_ids order first; repeated rows get a place each."""
    return sharding.shard_documents(common.table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of 3-word shingle sets. A row a doc_id, with the union of its texts' shingles; null and empty texts link with nothing, rows without doc_id get a row each."""
    return jaccard.join(common.table(spark, sf_dir, "documents"))


def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors. Null, zero and non-finite ones stand alone; a repeated vec_id is several vectors, a missing one is named by none."""
    return cover.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def op7_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every row, learnt outside the held-out third. Null and empty texts are scored; a row without doc_id is never learnt from, and its held_out is null."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(3)) == 1
    model = quality.fit(docs.where(~held("doc_id")), labels.where(~held("doc_id")))
    out = quality.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row packed. A null text is empty, which is one end token; repeated rows are packed each."""
    return packing.pack_documents(common.table(spark, sf_dir, "documents"))


def op9_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page row written and read back. A null html is empty; a page without id is a response; repeated page_ids get repeated records."""
    return warc.round_trip(common.table(spark, sf_dir, "pages"))


def op10_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best for each query vector. Vectors that are null or hold null or non-finite components, and rows without vec_id, take no part."""
    return mtree.top_k(common.table(spark, sf_dir, "embeddings"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key stands in 10 documents go. A row each; null texts are one empty line, rows without doc_id count for no line."""
    return lines.digests(common.table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a word of 6 code points and 5 occurrences. Null texts have no words, repeated rows count again, a null doc_id is empty text."""
    return spelling.variants(common.table(spark, sf_dir, "documents"))


def op13_blockmax_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item's 50 best documents. Null or empty texts have no terms; rows of one id are one item, but each row is a document."""
    return ranked.search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    own = (
        op1_sentencepiece, op2_secret_scan, op3_substring_dedup, op4_feistel_sharding, op5_ngram_jaccard, op6_cover_tree,
        op7_quality_qda, op8_best_fit_packing, op9_warc_salvage, op10_mtree_topk, op11_line_dedup, op12_spelling_variants, op13_blockmax_wand,
    )
    return {f.__name__: f for f in own}


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 5 * {i} + 1, 5))::INT) >> {s}) & 31) + 1, 1)"
_BASE32 = " || ".join(_DIGIT.format(i=i, s=s) for i in range(8) for s in (15, 10, 5, 0))

OP9_SQL = f"""
WITH b AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h FROM b),
e AS (SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM e
"""


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS k FROM w, unnest(range(1, len(ws) - 18)) AS t(i)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, range(20) AS t(j)),
one AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM one ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_CRC = """list_reduce(list_transform(range(strlen(body)), lambda i: ('0x' || substr(hexed, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)"""


def _feistel_sql(source: str, seed: int = 20) -> str:
    """source(rn, x, n, ...) with x permuted once, each step a column of a subquery."""
    sql = f"SELECT *, x & (a - 1) AS l, x >> k AS r FROM ({source})"
    for k in range(sharding.ROUNDS):
        own, other, size = ("l", "r", "a") if k % 2 == 0 else ("r", "l", "b")
        h = other
        for prime, times in sharding.STEPS:
            h = f"(({h} % {prime} * {times} + {sharding.offset(seed, k)}) % {prime})"
        sql = f"SELECT * REPLACE (({own} + {h} % {size}) % {size} AS {own}) FROM ({sql})"
    return f"SELECT rn, l + r * a AS x, n, k, a, b FROM ({sql})"


#: Rows are numbered in one order, as the query does for up to sharding.ROWS_PER_BUCKET rows.
OP4_SQL = f"""
WITH RECURSIVE rule AS (SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1
  THEN xor(3988292384, c >> 1) ELSE c >> 1 END, v::BIGINT)) AS crc_of),
d AS (SELECT doc_id, coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS hexed FROM documents),
s AS (SELECT doc_id, (strlen(body) + 1)::BIGINT AS size, xor({_CRC}, 4294967295) AS text_crc32 FROM d, rule),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS rn FROM s),
total AS (SELECT count(*) AS n, (SELECT min(e) FROM range(31) AS t(e) WHERE (1::BIGINT << (2 * e)) >= (SELECT count(*) FROM s)) AS k FROM s),
sizes AS (SELECT n, k, 1::BIGINT << k AS a, (n + (1::BIGINT << k) - 1) >> k AS b FROM total),
walk AS ({_feistel_sql("SELECT rn, rn AS x, n, k, a, b FROM numbered, sizes")} UNION ALL {_feistel_sql("SELECT * FROM walk WHERE x >= n")})
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 8)::INT AS shard, (x // 8)::BIGINT AS slot, NULL::INT AS grown_shard
FROM numbered JOIN (SELECT rn, x FROM walk WHERE x < n) USING (rn)
"""

_REACH = """both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT u, v FROM both_ways UNION SELECT reach.u, both_ways.v FROM reach JOIN both_ways ON reach.v = both_ways.u),
low AS (SELECT u, min(v) AS least FROM reach GROUP BY u)"""

OP5_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' ')))
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END AS sh FROM w),
t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS k FROM s),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM t a JOIN t b ON a.k = b.k AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
{_REACH}
SELECT doc_id, len(sh)::BIGINT AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id FROM s LEFT JOIN low ON doc_id = u
"""

OP6_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
w AS (SELECT vec_id, list_transform(e, lambda x: x / list_max(list_transform(e, lambda y: abs(y)))) AS e FROM v),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM w),
links AS (SELECT p.vec_id AS u, q.vec_id AS v FROM u p JOIN u q ON p.vec_id < q.vec_id AND len(p.e) = len(q.e)
  AND list_dot_product(p.e, q.e) / (p.size * q.size) >= 0.95::DOUBLE),
{_REACH},
degree AS (SELECT u, count(*) AS n FROM both_ways GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.u LEFT JOIN degree ON vec_id = degree.u
"""


OP11_SQL = """
WITH l AS (SELECT rn, doc_id, t.line, t.p, translate(trim(t.line, concat(chr(9), chr(10), chr(11), chr(12), chr(13), ' ')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS p) t),
shared AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, shared.k IS NOT NULL AS gone FROM l LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rn, doc_id
"""

OP12_SQL = f"""
WITH RECURSIVE rule AS (SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1
  THEN xor(3988292384, c >> 1) ELSE c >> 1 END, v::BIGINT)) AS crc_of),
runs AS (SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[a-z\\x{{C0}}-\\x{{FF}}]{{6,}}')) AS run FROM documents) GROUP BY ALL),
d AS (SELECT run, times, coalesce(doc_id::VARCHAR, '') || ':' || run AS body, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hexed FROM runs),
h AS (SELECT run, times, xor({_CRC}, 4294967295) AS h FROM d, rule),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
v AS (SELECT word, sum(times)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cut AS (SELECT word, i, substring(word, 1, i) AS head, substring(word, i + 2) AS tail FROM v, LATERAL (SELECT unnest(range(length(word))) AS i)),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT word, head || tail FROM cut WHERE head || tail IN (SELECT word FROM v)
  UNION SELECT head || tail, word FROM cut WHERE head || tail IN (SELECT word FROM v)),
best AS (SELECT near.word, count(*) AS n_near, max(v.n) AS most, min(struct_pack(o := -v.n, w := other)).w AS first FROM near JOIN v ON other = v.word GROUP BY near.word),
led AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN first END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM led UNION ALL SELECT walk.word, led.form FROM walk JOIN led ON walk.at = led.word WHERE led.form IS NOT NULL)
SELECT led.word, led.form, walk.at AS root, led.n, led.n_near, led.form_n FROM led JOIN walk ON led.word = walk.word JOIN led e ON e.word = walk.at AND e.form IS NULL
"""

OP13_SQL = r"""
WITH t AS (SELECT rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM (SELECT row_number() OVER () AS rn, * FROM documents)),
total AS (SELECT count(*)::BIGINT AS big_n, sum(len(ts))::BIGINT AS l FROM t WHERE len(ts) > 0),
p AS (SELECT rn, doc_id, len(ts)::BIGINT AS n, term, count(*)::BIGINT AS tf FROM t, LATERAL (SELECT unnest(ts) AS term) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, total GROUP BY term, big_n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, rn, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // l)))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN p USING (term), total GROUP BY item_id, rn, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_substring_dedup": OP3_SQL, "op4_feistel_sharding": OP4_SQL, "op5_ngram_jaccard": OP5_SQL, "op6_cover_tree": OP6_SQL,
        "op9_warc_salvage": OP9_SQL, "op10_mtree_topk": OP10_SQL, "op11_line_dedup": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_blockmax_wand": OP13_SQL,
    }
