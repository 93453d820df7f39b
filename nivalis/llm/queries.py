"""The registered queries of the corpus operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.llm import decontam, exactdedup, langid, mixing, neardup, prefixes, search, sharding, suffix, tokens, toxicity, urls, warc
from nivalis.llm.common import held_out, read


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH own AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(text), '')), 1, 3))::INT AS block
  FROM documents),
blocks AS (SELECT source, block, sum(size)::BIGINT AS words FROM own GROUP BY ALL),
ranked AS (
  SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2.0::DOUBLE * source_size AS most
  FROM (SELECT source, sum(words)::BIGINT AS source_size FROM blocks GROUP BY source)),
levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT - coalesce(sum(most) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM ranked
  WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT *, (max_by(level, -most / w) FILTER (WHERE level <= most / w) OVER ()) AS water FROM levels),
targets AS (SELECT source, source_size, least(most, coalesce(water * w, most)) AS target FROM water),
b AS (
  SELECT blocks.source, block, words, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS passes,
         md5(coalesce(blocks.source, '') || ':' || block) AS perm
  FROM blocks JOIN targets ON blocks.source IS NOT DISTINCT FROM targets.source),
r AS (SELECT *, target - passes * source_size AS rest,
         sum(words) OVER (PARTITION BY source ORDER BY perm ROWS UNBOUNDED PRECEDING) <= target - passes * source_size AND target - passes * source_size > 0 AS in_run FROM b),
g AS (SELECT *, rest - coalesce(sum(words) FILTER (WHERE in_run) OVER (PARTITION BY source), 0) AS gap FROM r),
d AS (SELECT *, passes + (in_run OR (abs(words - gap) < gap
         AND row_number() OVER (PARTITION BY source, in_run ORDER BY abs(words - gap), perm) = 1))::INT AS draws FROM g)
SELECT doc_id, size, source_size, target, (size * draws)::BIGINT AS taken
FROM own JOIN d ON own.source IS NOT DISTINCT FROM d.source AND own.block = d.block
"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
             list_aggregate(w[s : s + least(10, len(w)) - 1], 'string_agg', ' ') AS gram
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
win AS (SELECT doc_id, n, s, list_aggregate(w[s : s + n - 1], 'string_agg', ' ') AS gram
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
              FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, s FROM win JOIN grams USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


OP6_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
dup AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS rn FROM w) WHERE rn > 1),
isl AS (SELECT doc_id, s, sum((s > coalesce(p, -1000) + 100)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g
        FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM dup)),
spans AS (SELECT doc_id, g, min(s) AS a, max(s) + 100 AS b FROM isl GROUP BY doc_id, g),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
kept AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
                string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS k
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN k IS NULL THEN h ELSE k || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, coalesce(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END), []) AS s FROM d),
sh AS (SELECT doc_id, unnest(s) AS x FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
links AS (
  SELECT p.a, p.b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS c FROM sh l JOIN sh r ON l.x = r.x AND l.doc_id <> r.doc_id GROUP BY ALL) p
  JOIN sizes l ON l.doc_id = p.a JOIN sizes r ON r.doc_id = p.b WHERE 100 * c >= 75 * (l.n + r.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT sizes.doc_id, n AS n_shingles, min(b) AS component_id, sizes.doc_id = min(b) AS kept
FROM sizes JOIN reach ON reach.a = sizes.doc_id GROUP BY sizes.doc_id, n
"""


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_dedup(read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder FROM pages)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM p
"""


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.rebuilt_trie(read(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, sha256(strlen(r) || ':' || r || x) AS d, strlen(x)::BIGINT AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (
  SELECT c, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda ch: ord(ch)::BIGINT), lambda crc, b:
           list_reduce(range(8), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, b)), 4294967295::BIGINT),
           4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
turns AS (
  SELECT ids.c, t.pos, 0 AS own, d, bytes FROM ids JOIN t ON t.c = ids.c - ids.c % 5 AND pos <= h
  UNION ALL SELECT ids.c, t.pos, 1, d, bytes FROM ids JOIN t ON t.c = ids.c AND pos > h),
seq AS (SELECT *, row_number() OVER w AS depth, sha256(string_agg(d, ',') OVER w) AS name FROM turns WINDOW w AS (PARTITION BY c ORDER BY own, pos)),
named AS (SELECT c, depth, name, lag(name, 1, 'root') OVER (PARTITION BY c ORDER BY depth) AS parent, bytes FROM seq
          UNION ALL SELECT c, 0, 'root', NULL, 0 FROM ids),
nodes AS (SELECT name, min(parent) AS parent, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM named GROUP BY name),
kids AS (SELECT parent AS name, count(*) AS n_children FROM nodes GROUP BY parent),
own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM nodes LEFT JOIN kids USING (name)),
sums AS (SELECT named.name, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
         FROM own JOIN named ON named.c = own.conv_id AND named.depth <= own.depth GROUP BY named.name),
ends AS (SELECT name, string_agg(c::VARCHAR, ',' ORDER BY c) AS x FROM (SELECT c, max_by(name, depth) AS name FROM named GROUP BY c) GROUP BY name)
SELECT own.conv_id, own.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens, sha256(coalesce(x, '')) AS ends_sha256
FROM own JOIN sums USING (name) LEFT JOIN own up ON up.name = own.parent LEFT JOIN ends ON ends.name = own.name
"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT item_id, t, count(*) AS q FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM i) GROUP BY ALL),
sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, totals GROUP BY t, docs),
impacts AS (SELECT r, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))) AS x
            FROM tf JOIN sizes USING (r) JOIN weights USING (t), totals),
scores AS (SELECT item_id, r, doc_id, sum(q * x)::BIGINT AS score FROM impacts JOIN q USING (t) GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.plan_shards(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_toxicity": op5_toxicity,
    "op6_repeats": op6_repeats,
    "op7_near_dedup": op7_near_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_language": op10_language,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_search": op12_search,
    "op13_shards": op13_shards,
}
SQL = {"op1_mix": OP1_SQL, "op2_decontaminate": OP2_SQL, "op3_warc": OP3_SQL, "op6_repeats": OP6_SQL, "op7_near_dedup": OP7_SQL, "op8_exact_dedup": OP8_SQL, "op11_prefix_trie": OP11_SQL, "op12_search": OP12_SQL}
