"""One query per operator, over the whole of its table, and the SQL of those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.byte_pairs import encode_through_words
from logbraid.llm.collisions import nearest_by_inner_product
from logbraid.llm.collocations import mine_collocations
from logbraid.llm.language import held_out, learn_profiles, predict_language
from logbraid.llm.line_dedup import drop_repeated_lines
from logbraid.llm.main_text import extract_main_text
from logbraid.llm.mixing import mix, with_sizes
from logbraid.llm.neighbours import link_near_duplicates
from logbraid.llm.pieces import encode_texts
from logbraid.llm.prefix_trie import prefix_trie, turns_of, with_borrowed_starts
from logbraid.llm.sharding import shuffle_into_shards
from logbraid.llm.simhash import near_duplicates
from logbraid.llm.url_rules import Rule, judge_urls

# The rules that the query judges urls by.
URL_RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def main_text_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = with_sizes(_table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    mixed = mix(materialize(sized.drop("text"), "sizes_of_documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def two_pass_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shuffle_into_shards(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def nn_descent_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_near_duplicates(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def collision_counting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest_by_inner_product(table, F.pmod("vec_id", F.lit(20)) == 0, 20)


def url_rule_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    profiles = learn_profiles(docs.where("NOT held_out"))
    return predict_language(docs.drop("lang"), profiles).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return grouped.select("doc_id", "fingerprint", "component_id")


def pieces_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def trie_of_rebuilt_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turns_of(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    turns = materialize(turns, "placed_turns")
    return prefix_trie(with_borrowed_starts(turns), turns.where("place = 1").select("conv"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def byte_pairs_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = encode_through_words(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_main_text": main_text_of_pages,
    "op2_budget_mix": budget_mix,
    "op3_two_pass_shards": two_pass_shards,
    "op4_nn_descent": nn_descent_links,
    "op5_line_dedup": line_dedup,
    "op6_collision_counting": collision_counting_search,
    "op7_url_rule_sweep": url_rule_sweep,
    "op8_rank_order_language": rank_order_language,
    "op9_simhash_bk_trees": simhash_bk_trees,
    "op10_pieces_round_trip": pieces_round_trip,
    "op11_prefix_trie": trie_of_rebuilt_conversations,
    "op12_collocations": phrase_collocations,
    "op13_byte_pairs": byte_pairs_round_trip,
}

_LINE_DEDUP_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owners AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT doc_id, line, place, (owner IS NOT NULL AND owner <> doc_id) AS dropped
  FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), ''))
    AS kept_sha256
FROM judged GROUP BY doc_id
"""

_URL_RULES_SQL = """
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END
    AS r FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fitting AS (
  SELECT page_id, host, path, h || p AS rule, v,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC NULLS LAST) AS n
  FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fitting WHERE n = 1
"""

# All pairs, so for small tables only; the operator finds them without.
_LINKS_SQL = """
WITH RECURSIVE good AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reached(v, r) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reached.v, links.b FROM reached JOIN links ON links.a = reached.r),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(r) AS component_id, min(r) = v AS kept
FROM reached LEFT JOIN counted ON a = v GROUP BY v
"""

# The CRC-32 of the id's digits is a fold over them with the usual table of 256 entries.
_PREFIX_TRIE_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(concat_ws(':', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, '')))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''),
    lambda s: ord(s)::BIGINT)), lambda x, y: xor(x >> 8, t[1 + (xor(x, y) & 255)])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM own), crc),
rebuilt AS (
  SELECT i.c, o.k, o.role, o.text FROM ids i JOIN own o ON o.c = i.c AND o.k > i.h
  UNION ALL
  SELECT i.c, o.k, o.role, o.text FROM ids i JOIN own o ON o.c = i.c - i.c % 20 AND o.k <= i.h),
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS depth,
    md5(concat_ws(':', length(role), role, text)) AS key,
    len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words
  FROM rebuilt),
paths AS (
  SELECT c, depth, words, string_agg(key, '') OVER (PARTITION BY c ORDER BY depth) AS node FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM ids),
nodes AS MATERIALIZED (
  SELECT node, any_value(depth) AS depth, any_value(words) AS words, min(c) AS least, count(*) AS n,
    left(node, greatest(length(node) - 32, 0)) AS parent
  FROM paths GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
valued AS (
  SELECT x.*, coalesce(n_children, 0) AS n_children, (n - 1) * words AS saved
  FROM nodes x LEFT JOIN children USING (node)),
sums AS (
  SELECT up.node, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved
  FROM valued v JOIN paths up ON up.c = v.least AND up.depth <= v.depth GROUP BY up.node),
ends AS (
  SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM (
    SELECT c, arg_max(node, depth) AS node FROM paths GROUP BY c) GROUP BY node)
SELECT v.least AS conv_id, v.depth::BIGINT AS depth, p.least AS parent_conv_id, v.n::BIGINT AS n_convs,
  v.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
  coalesce(ends, sha256('')) AS ends_sha256
FROM valued v JOIN sums s USING (node) LEFT JOIN ends e USING (node)
LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.parent
"""

_COLLOCATIONS_SQL = """
WITH lowered AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM lowered),
split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM split
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
    FROM split WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM split WHERE len(w) > 2),
f AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING size = 1 OR count(*) >= 10),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
cut AS (
  SELECT lang, size, phrase, a, k, array_to_string(s[:k], ' ') AS x, array_to_string(s[k + 1:], ' ') AS y
  FROM (SELECT *, string_split(phrase, ' ') AS s, unnest(range(1, size)) AS k FROM f WHERE size > 1)),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, l.a AS l, r.a AS r,
    ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase
      ORDER BY (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a), k) AS cut
  FROM cut c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y),
longer AS (
  SELECT lang, part AS phrase, max(a) AS held FROM (
    SELECT lang, a, unnest([s[1] || ' ' || s[2], s[2] || ' ' || s[3]]) AS part
    FROM (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE size = 3)) GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s LEFT JOIN longer USING (lang, phrase)
  WHERE cut = 1 AND (size = 3 OR held IS NULL OR 100 * held < 50 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op11_prefix_trie": _PREFIX_TRIE_SQL,
    "op12_collocations": _COLLOCATIONS_SQL,
    "op4_nn_descent": _LINKS_SQL,
    "op5_line_dedup": _LINE_DEDUP_SQL,
    "op7_url_rule_sweep": _URL_RULES_SQL,
}
