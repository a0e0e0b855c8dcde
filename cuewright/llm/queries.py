"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table
from .asof import clicks_with_orders
from .bpe import bpe_round_trip
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .jaccard_join import jaccard_groups
from .mixing import mix_sources
from .neighbours import nearest_neighbours
from .passages import repeated_passages
from .quality import quality
from .sharding import BITS, LIMIT, shard
from .token_counts import token_counts
from .token_files import token_file_digests
from .toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op10_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id) AS r FROM t)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""


@_query
def op3_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


ORACLES["op3_extendible_sharding"] = f"""
WITH t AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS size_bytes,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
nodes AS (SELECT place, size_bytes, d AS depth, place >> ({BITS} - d) AS prefix FROM t, range({BITS} + 1) r(d)),
total AS (SELECT depth, prefix, sum(size_bytes) AS total FROM nodes GROUP BY ALL),
best AS (SELECT n.place, min(n.depth) AS depth FROM nodes n JOIN total USING (depth, prefix) WHERE total <= {LIMIT} OR depth = {BITS} GROUP BY n.place)
SELECT t.doc_id, t.size_bytes, CASE WHEN b.depth = 0 THEN '' ELSE right(lpad(bin(t.place >> ({BITS} - b.depth)), 64, '0'), b.depth) END
    || CASE WHEN x.total > {LIMIT} THEN ':0.a1' ELSE '' END AS shard,  -- the tables repeat no key: what no bit parts is one document
  b.depth::INTEGER AS depth, x.total::BIGINT AS shard_bytes
FROM t JOIN best b USING (place) JOIN total x ON x.depth = b.depth AND x.prefix = t.place >> ({BITS} - b.depth)
"""


@_query
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op4_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@_query
def op8_line_field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op5_grammar_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op9_divide_skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), words=4, similar=85)


ORACLES["op9_divide_skip_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles FROM w),
classes AS (SELECT list_sort(shingles) AS key, min(doc_id) AS id, len(any_value(shingles)) AS n FROM s WHERE len(shingles) > 0 GROUP BY 1),
tokens AS (SELECT id, n, unnest(key) AS tok FROM classes),
pairs AS (SELECT a.id AS x, b.id AS y FROM tokens a JOIN tokens b ON a.tok = b.tok AND a.id < b.id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x AS u, y AS v FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT id AS u, id AS r FROM classes UNION SELECT e.v, reach.r FROM reach JOIN edges e ON e.u = reach.u),
comp AS (SELECT u AS id, min(r) AS component_id FROM reach GROUP BY u)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(comp.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN classes c ON c.key = list_sort(s.shingles) LEFT JOIN comp ON comp.id = c.id
"""


@_query
def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query
def op2_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op1_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@_query
def op11_blocked_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


ORACLES["op11_blocked_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@_query
def op12_tolerant_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_with_orders(spark, table(spark, sf_dir, "clicks"), table(spark, sf_dir, "sales"))


ORACLES["op12_tolerant_asof"] = """
WITH bytes AS (SELECT list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c, b FROM range(256) r(b)),
lut AS (SELECT list(c ORDER BY b) AS t FROM bytes),
ids AS (SELECT click_id AS id FROM clicks UNION SELECT sale_id FROM sales),
h AS (SELECT id, xor(list_reduce(list_transform(string_split(coalesce(id::VARCHAR, ''), ''), lambda s: ascii(s)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM ids, lut),
c AS (SELECT click_id, max(client_id) AS client_id, max(epoch_us(ts)) AS us FROM clicks GROUP BY 1),
cl AS (SELECT click_id, client_id, CASE WHEN h % 2 = 1 THEN us - us % 21600000000 ELSE us END AS ts_us FROM c JOIN h ON h.id IS NOT DISTINCT FROM click_id),
o AS (SELECT client_id, sale_id, priority, floor(100 * total + 0.5)::BIGINT AS total_cents, h, CASE WHEN h % 2 = 1 THEN epoch_us(sold_at) - epoch_us(sold_at) % 21600000000 ELSE epoch_us(sold_at) END AS us
  FROM sales JOIN h ON h.id IS NOT DISTINCT FROM sale_id),
orders AS (SELECT client_id, us, total_cents, sale_id, priority FROM o UNION ALL SELECT client_id, us, total_cents, -1 - sale_id, 6 - priority FROM o WHERE h % 3 <> 0),
ranked AS (SELECT *, count(*) OVER (PARTITION BY client_id, us) AS n FROM orders WHERE client_id IS NOT NULL AND us IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY client_id, us ORDER BY total_cents DESC NULLS LAST, sale_id DESC NULLS LAST, priority DESC NULLS LAST) = 1),
m AS (SELECT cl.*, r.us, r.total_cents, r.sale_id, r.priority, r.n FROM cl ASOF LEFT JOIN ranked r ON cl.client_id = r.client_id AND cl.ts_us >= r.us)
SELECT click_id, client_id, ts_us, CASE WHEN near THEN sale_id END AS sale_id, CASE WHEN near THEN ts_us - us END AS lag_us, CASE WHEN near THEN total_cents END AS total_cents,
  CASE WHEN near THEN n ELSE 0 END AS n_tied, CASE WHEN near THEN priority END::BIGINT AS priority FROM (SELECT *, coalesce(ts_us - us <= 2592000000000, false) AS near FROM m)
"""


@_query
def op13_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
