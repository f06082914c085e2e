"""One query for each operator of this folder, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, embeddings, exact, fim, jaccard, line_dedup, mixing, quality, toxicity, unigram, url_filter, variants
from .common import read_table

RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]
#: A line on over one in fifty of a host's pages is the host's and not the page's; a line on a single page repeats nothing.
LINE_RATIO, LINE_PAGES = 0.02, 2
MIX_TEMPERATURE, MIX_SEED = 0.5, 17
#: One run in so many, by its checksum, is misspelt before words are counted.
TYPOS = 97


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary is on this machine; other queries do without."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, vocabulary(), decoded="decoded", keep_text=False)
    return both.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity.judge(docs, read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "p_low_quality", "p_toxic", "toxic")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its host, and its language the section of the site that it is in."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.judge(docs, read_table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), temperature=MIX_TEMPERATURE, seed=MIX_SEED)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_classes(docs, width=4, percent=85)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram.count_tokens(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "n_words", "n_tokens")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_lines(docs, ratio=LINE_RATIO, least=LINE_PAGES)


def op8_line_dedup_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op8_line_dedup; a host's pages of one language are a section of it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return line_dedup.drop_lines(docs, ratio=LINE_RATIO, least=LINE_PAGES, section="lang")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.copies(docs, digest=True)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embeddings.near_vectors(vectors)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    cut = fim.fill_in_middle(docs.withColumnRenamed("text", "given"), text="given").drop("given")
    return fim.restored(cut).select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, read_table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.variants(docs, typos=TYPOS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_toxicity, op3_url_filter, op4_quality, op5_mixing, op6_ngram_join, op7_token_counts, op8_line_dedup, op8_line_dedup_by_language, op9_exact_dedup, op10_embedding_dedup, op11_fill_in_middle, op12_decontaminate, op13_spelling_variants)}


_URLS = r"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                            ('net', '/es/', 'block'), ('net', '/fr/', 'block')) t(rh, rp, v)),
m AS (SELECT page_id, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
      FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, host, path, m.rule, coalesce(m.v, 'allow') AS verdict FROM p LEFT JOIN m ON p.page_id = m.page_id AND k = 1
"""

_MIX = f"""
WITH RECURSIVE s AS (SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), {MIX_TEMPERATURE}) AS w FROM documents GROUP BY source),
r AS (SELECT source, w * ((SELECT CAST(count(*) AS DOUBLE) FROM documents) / (SELECT sum(w) FROM s)) / n AS rate FROM s),
d(source, rate, k, p, c) AS (
    SELECT source, rate, 0, exp(-rate), exp(-rate) FROM r
    UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM d WHERE k < 300),
u AS (SELECT *, CAST(CAST('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS x FROM documents),
k AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, (SELECT count(*) FROM d WHERE d.source IS NOT DISTINCT FROM u.source AND d.c <= u.x) AS many FROM u)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy
FROM k, LATERAL (SELECT unnest(generate_series(1, many)) AS copy) t
"""

_LINES = f"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS body FROM l),
b AS (SELECT source, body FROM (SELECT source, body, count(DISTINCT doc_id) AS pages FROM k WHERE body <> '' GROUP BY source, body) c
      JOIN (SELECT source, count(*) AS total FROM documents GROUP BY source) t USING (source)
      WHERE pages >= {LINE_PAGES} AND pages > CAST(total AS DOUBLE) * CAST({LINE_RATIO} AS DOUBLE))
SELECT doc_id, any_value(k.source) AS source,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE b.body IS NULL), '') AS text,
       count(*) AS n_lines, count(b.body) AS n_dropped
FROM k LEFT JOIN b ON k.source = b.source AND k.body = b.body GROUP BY doc_id
"""

_LANGUAGE_LINES = f"""
WITH l AS (SELECT doc_id, source, lang, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS body FROM l),
b AS (SELECT source, body FROM (SELECT source, body, count(DISTINCT doc_id) AS pages FROM k WHERE body <> '' GROUP BY source, body) c
      JOIN (SELECT source, count(*) AS total FROM documents GROUP BY source) t USING (source)
      WHERE pages >= {LINE_PAGES} AND pages > CAST(total AS DOUBLE) * CAST({LINE_RATIO} AS DOUBLE)),
s AS (SELECT source, lang, body FROM (SELECT source, lang, body, count(DISTINCT doc_id) AS pages FROM k WHERE body <> '' GROUP BY source, lang, body) c
      JOIN (SELECT source, lang, count(*) AS total FROM documents GROUP BY source, lang) t USING (source, lang)
      WHERE pages >= {LINE_PAGES} AND pages > CAST(total AS DOUBLE) * CAST({LINE_RATIO} AS DOUBLE)),
m AS (SELECT k.*, b.body IS NOT NULL OR s.body IS NOT NULL AS known FROM k LEFT JOIN b ON k.source = b.source AND k.body = b.body
      LEFT JOIN s ON k.source = s.source AND k.lang = s.lang AND k.body = s.body)
SELECT doc_id, any_value(source) AS source, any_value(lang) AS lang,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT known), '') AS text,
       count(*) AS n_lines, count_if(known) AS n_dropped
FROM m GROUP BY doc_id
"""

_NEAR = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

_COPIES = """
WITH g AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM g WINDOW w AS (PARTITION BY t)
"""


_MIDDLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '(?s)[A-Za-z]+|[^A-Za-z]') AS ws,
             [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in range(4)] AS h FROM t),
c AS (SELECT doc_id, t, ws, len(ws) AS n, h[1] % (len(ws) + 1) AS x, h[2] % (len(ws) + 1) AS y,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT doc_id, t, n, form, array_to_string(ws[1:least(x, y)], '') AS p, array_to_string(ws[least(x, y) + 1:greatest(x, y)], '') AS m,
             array_to_string(ws[greatest(x, y) + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_LEAKS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
q AS (SELECT item_id, ws, least(len(ws), 10) AS l, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS g FROM q),
k AS (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM w) WHERE len(ws) >= l),
o AS (SELECT doc_id, i, k.l, item_id FROM k JOIN w ON k.l = w.l AND array_to_string(ws[i:i + k.l - 1], ' ') = g),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + l)) AS j FROM o) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

_SPELLINGS = f"""
WITH RECURSIVE p(i, k, c) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM p WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM p WHERE k = 8),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents),
g AS (SELECT doc_id, w, count(*) AS n, hex(encode(doc_id || ':' || w)) AS x FROM r GROUP BY doc_id, w),
h AS (SELECT w, n, xor(list_reduce([CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) for i in range(length(x) // 2)],
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM g, crc),
v AS (SELECT CASE WHEN h % {TYPOS} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
c AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
d AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS k FROM (SELECT word, n, unnest(range(length(word))) AS i FROM c)),
e AS (SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.k = b.k AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
      UNION SELECT d.word, c.word, c.n FROM d JOIN c ON d.k = c.word UNION SELECT c.word, d.word, d.n FROM d JOIN c ON d.k = c.word),
b AS (SELECT word, count(*) AS n_near, min_by(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM e GROUP BY word),
f AS (SELECT c.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM c LEFT JOIN b USING (word)),
z(word, root) AS (SELECT word, word FROM f UNION ALL SELECT z.word, f.form FROM z JOIN f ON z.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, z.root FROM f JOIN z ON f.word = z.word JOIN f AS l ON z.root = l.word AND l.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": _URLS, "op5_mixing": _MIX, "op6_ngram_join": _NEAR, "op8_line_dedup": _LINES, "op8_line_dedup_by_language": _LANGUAGE_LINES, "op9_exact_dedup": _COPIES, "op11_fill_in_middle": _MIDDLE, "op12_decontaminate": _LEAKS, "op13_spelling_variants": _SPELLINGS}
