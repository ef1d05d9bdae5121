"""The registered queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .ann import nearest
from .collocations import collocations
from .common import table
from .decontaminate import contamination
from . import htmltext
from .lexsearch import search
from .linededup import dedup_lines
from .mixing import mix
from .packing import pack_apart
from .sharding import assign_shards
from .simhash import near_duplicates
from .tokencount import count_tokens
from .toxicity import fit, held_out, score_toxicity
from .vecdedup import near_vectors


def op1_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_line_dedup(spark, sf_dir):
    docs = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_packing(spark, sf_dir):
    return pack_apart(table(spark, sf_dir, "documents"))


def op4_sharding(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"))


def shard_layout(spark, sf_dir):
    """op4 without its column that is always NULL under this law, for the SQL twin."""
    return op4_sharding(spark, sf_dir).drop("grown_shard")


def op5_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_token_counts(spark, sf_dir):
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
            .withColumn("over_limit", F.col("n_tokens") > 2048))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, weights).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract_text(pages, htmltext.fit(pages)).select("page_id", "url", "text", "n_chars")


def op9_vector_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op13_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"),
                          keep=["doc_id"])
    return found.drop("item_ids")


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_line_dedup, op3_packing, op4_sharding, op5_nearest, op6_token_counts, op7_toxicity,
    op8_html_text, op9_vector_dedup, op10_mixing, op11_lexical_search, op12_collocations,
    op13_decontaminate, shard_layout)}

_OP2 = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, frequent.k IS NOT NULL AS dropped FROM keyed LEFT JOIN frequent USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP10 = r"""
WITH rows AS (
  SELECT doc_id AS id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT, 0) AS shuffle FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0 * sum(size) AS most,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM rows GROUP BY source),
f AS (
  SELECT *, row_number() OVER o AS n,
         (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM s WINDOW o AS (ORDER BY most / w, source NULLS LAST)),
t AS (SELECT source, source_size, least(most, w * (SELECT arg_min(level, n) FROM f WHERE level <= most / w))::DOUBLE AS target FROM f),
q AS (
  SELECT r.id, r.size, t.source_size, t.target, r.shuffle, c.copy,
         (c.copy * t.source_size + sum(r.size) OVER (PARTITION BY r.source, c.copy ORDER BY r.shuffle, r.id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / t.target AS finish
  FROM rows r JOIN t ON r.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) AS c(copy)),
l AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY CASE WHEN size > 0 THEN finish ELSE 'inf'::DOUBLE END, shuffle, id, copy
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM q)
SELECT id AS doc_id, size, source_size, target,
       (sum(CASE WHEN 2 * line + size <= 2 * (SELECT sum(target) FROM t) THEN size ELSE 0 END))::BIGINT AS taken
FROM l GROUP BY id, size, source_size, target
"""

#: CRC-32 (polynomial 0xEDB88320, reflected) by a table made from its rule, folded over the bytes of each text.
_OP4 = """
WITH RECURSIVE bits(n, c, k) AS (
  SELECT n, n::UBIGINT, 0 FROM range(256) r(n)
  UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
  SELECT doc_id, (length(h) // 2 + 16)::BIGINT AS size,
         xor(list_reduce(list_prepend(4294967295::UBIGINT,
                                      [('0x' || substr(h, 2 * i + 1, 2))::UBIGINT FOR i IN range(length(h) // 2)]),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM hexed, crc_table),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER () AS total FROM sized),
sharded AS (SELECT *, least(39, (2 * before + size) * 40 // (2 * total))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot
FROM sharded
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_TERMS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM q)),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
found AS (SELECT rid, i, n, item_id FROM dw JOIN iw USING (n, g)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""

_OP11 = f"""
WITH tok AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM tok WHERE len(w) > 0),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL),
s AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM (SELECT DISTINCT rid, n FROM t)),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
q AS (SELECT item, item_id, term, count(*) AS c
      FROM (SELECT item, item_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS item, * FROM benchmark)) GROUP BY ALL),
scored AS (
  SELECT item, item_id, rid, doc_id,
         sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term), s GROUP BY ALL HAVING score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored)
WHERE rank <= 20
"""

_OP12 = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents)),
grams AS (
  SELECT lang, k.n, array_to_string(w[i:i + k.n - 1], ' ') AS phrase
  FROM (SELECT lang, w, k.n, unnest(range(1, len(w) - k.n + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS k(n) WHERE len(w) >= k.n) AS k),
f AS (SELECT lang, n, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cand AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE n >= 2),
cuts AS (SELECT *, unnest(range(1, len(w))) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE len(w) = 3)
  GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o USING (lang, phrase) WHERE o.a IS NULL OR 100 * o.a < 50 * b.a)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM (
  SELECT kept.*, total.n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept JOIN total USING (lang))
WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op12_collocations": _OP12, "op11_lexical_search": _OP11, "op13_decontaminate": _OP13, "shard_layout": _OP4, "op2_line_dedup": _OP2, "op10_mixing": _OP10}
