"""Registered queries of the operators here, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.llm import bpe, collocations, decontaminate, fingerprints, langid, minhash, repeats, rollup, sharding, topk, toxicity, trie, warc
from locusloom.llm.tables import Scratch, read_table, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


REPEATS_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, j, substr(h, 1000 * j + 1, 1198) AS part
      FROM d, LATERAL (SELECT unnest(range(0, length(h) // 1000 + 1)) AS j)),
s AS (SELECT doc_id, 500 * j + k AS i, substr(part, 2 * k + 1, 200) AS w
      FROM p, LATERAL (SELECT unnest(range(0, least(500, greatest(length(part) // 2 - 99, 0)))) AS k)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5(w) ORDER BY doc_id, i) AS k FROM s),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM f WHERE k > 1),
b AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
g AS (SELECT doc_id, run, min(i) AS low, max(i) + 100 AS high FROM b GROUP BY ALL),
k AS (SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS start FROM g),
t AS (SELECT k.doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS tail,
             string_agg(substr(h, 2 * start + 1, 2 * (low - start)), '' ORDER BY low) AS kept
      FROM k JOIN d USING (doc_id) GROUP BY k.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * tail + 1), h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


@query(REPEATS_SQL)
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that remain of each document without 100-byte strings that also start earlier."""
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"), width=100)


NEAR_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5_number_lower(array_to_string(ws[i:i + 4], ' ')) AS s
      FROM w, LATERAL (SELECT unnest(range(1, greatest(length(ws) - 3, 2))) AS i) WHERE length(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.id = w.doc_id
"""


@query(NEAR_SQL)
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingle sets have a similarity of at least 0.85."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=5, percent=85)


@query()
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    coded = bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


@query()
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    return langid.held_out_identification(read_table(spark, sf_dir, "documents"))


LEAKS_SQL = """
WITH t AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS ws FROM t),
s AS (SELECT DISTINCT kind, id, md5_number_lower(array_to_string(ws[i:i + 4], ' ')) AS s
      FROM w, LATERAL (SELECT unnest(range(1, greatest(length(ws) - 3, 2))) AS i) WHERE length(ws) > 0),
n AS (SELECT id AS item_id, count(*) AS n_item FROM s WHERE kind = 1 GROUP BY id),
p AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM s d JOIN s b ON d.s = b.s
      WHERE d.kind = 0 AND b.kind = 1 GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared FROM p JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""


@query(LEAKS_SQL)
def op7_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of which a document holds at least 0.8 of the five-word shingles."""
    return decontaminate.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query(WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records with revisits of equal payloads, and read back."""
    place = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.archive(read_table(spark, sf_dir, "pages"), place)
    return warc.page_summary(spark, place)


TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query(TOP_SQL)
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest inner products of every hundredth embedding with all others."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels outside the held-out third."""
    return toxicity.held_out_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


WORDS, LETTERS = r"[^\x20\x09-\x0D]+", r"[A-Za-z]+"

TOKENS_SQL = r"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text,
                  coalesce(quality, 1) = 0 AS withdrawn, coalesce(toxic, 0) = 1 AS recounted
           FROM documents LEFT JOIN labels USING (doc_id)),
c AS (SELECT source, lang, 'words-1' AS tokenizer, length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n
      FROM d WHERE NOT withdrawn AND NOT recounted
      UNION ALL SELECT source, lang, 'letters-2', length(regexp_extract_all(text, '[A-Za-z]+')) FROM d WHERE NOT withdrawn AND recounted)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM c GROUP BY ALL
"""


@query(TOKENS_SQL)
def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: all documents; toxic ones counted anew; poor ones withdrawn; the second batch once more."""
    labels = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    both = rollup.count_tokens(docs, WORDS, "words-1").withColumnsRenamed({"n_tokens": "n1", "tokenizer": "t1"})
    both = Scratch(spark).keep(rollup.count_tokens(both, LETTERS, "letters-2").drop("text"))
    toxic, poor = (labels.where(c).select("doc_id") for c in ("toxic = 1 and coalesce(quality, 1) <> 0", "quality = 0"))
    counted = both.selectExpr("doc_id", "source", "lang", "t1 as tokenizer", "n1 as n_tokens")
    again = both.join(toxic, "doc_id", "left_semi")
    totals = rollup.Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    totals.commit("load", rollup.inserts(counted))
    revised = rollup.revisions(counted.join(toxic, "doc_id", "left_semi"), again)
    totals.commit("recount", revised)
    totals.commit("withdraw", rollup.deletes(counted.join(poor, "doc_id", "left_semi")))
    totals.commit("recount", revised)
    return totals.totals()


SHARDS, SLOTS = [f"shard-{i:02d}" for i in range(64)], 6553

SHARDS_SQL = f"""
WITH RECURSIVE s AS (
  SELECT i, ('0x' || substr(md5('offset shard-' || lpad(i::VARCHAR, 2, '0')), 1, 15))::BIGINT % {SLOTS} AS place,
         ('0x' || substr(md5('stride shard-' || lpad(i::VARCHAR, 2, '0')), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS stride
  FROM range({len(SHARDS)}) t(i)),
p AS (SELECT list(place ORDER BY i) AS place, list(stride ORDER BY i) AS stride FROM s),
f AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda x: -1) AS slots, list_transform(place, lambda x: 0) AS done, -1::BIGINT AS slot FROM p
  UNION ALL
  SELECT turn + 1, slots[:slot] || [turn % {len(SHARDS)}] || slots[slot + 2:], done[:turn % {len(SHARDS)}] || [step + 1] || done[turn % {len(SHARDS)} + 2:], slot
  FROM (SELECT turn, slots, done, step, (place[turn % {len(SHARDS)} + 1] + step * stride[turn % {len(SHARDS)} + 1]) % {SLOTS} AS slot
        FROM (SELECT turn, slots, done, place, stride, list_filter(range(done[turn % {len(SHARDS)} + 1], {SLOTS}),
                lambda k: slots[(place[turn % {len(SHARDS)} + 1] + k * stride[turn % {len(SHARDS)} + 1]) % {SLOTS} + 1] < 0)[1] AS step
              FROM f, p WHERE turn < {SLOTS}))),
t AS (SELECT turn - 1 AS turn, slot FROM f WHERE turn > 0)
SELECT doc_id, source, d.slot, 'shard-' || lpad((turn % {len(SHARDS)})::VARCHAR, 2, '0') AS shard
FROM (SELECT doc_id, source, ('0x' || substr(md5(coalesce('=' || doc_id::VARCHAR, 'null')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents) d
JOIN t ON t.slot = d.slot
"""


@query(SHARDS_SQL)
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document among 64, by its id."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.place(docs, ["doc_id"], SHARDS, SLOTS)


@query()
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


TRIE_SQL = """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS whole, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, length(text) AS chars, md5(whole) AS m, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(whole)) AS place FROM t),
h AS (SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                lambda a, b: xor(a // 256, tab[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
      FROM (SELECT DISTINCT c FROM o), crc),
b AS (SELECT h.c, place, m, chars FROM h JOIN o ON o.c = h.c - h.c % 100 AND place <= h
      UNION ALL SELECT o.c, place - h + least(h, coalesce(n, 0)), m, chars FROM o JOIN h USING (c)
        LEFT JOIN (SELECT c, count(*) AS n FROM o GROUP BY c) s ON s.c = h.c - h.c % 100 WHERE place > h),
p AS (SELECT c, place AS depth, chars, string_agg(m, '') OVER (PARTITION BY c ORDER BY place) AS path FROM b
      UNION ALL SELECT c, 0, 0, '' FROM h),
e AS (SELECT c, max(depth) AS depth FROM p GROUP BY c),
n AS (SELECT path, any_value(p.depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE e.depth = p.depth), '')) AS ends_sha256
      FROM p JOIN e USING (c) GROUP BY path),
k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
u AS (SELECT left(n.path, 32 * d) AS path, sum((n_convs - 1) * chars) AS saved_tokens, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
      FROM (SELECT n.*, unnest(range(0, depth + 1)) AS d FROM n) n LEFT JOIN k USING (path) GROUP BY 1)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u USING (path) LEFT JOIN k USING (path) LEFT JOIN n q ON n.depth > 0 AND q.path = left(n.path, 32 * (n.depth - 1))
"""


@query(TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of conversations that share the openings of every hundredth."""
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"), rebuild=trie.with_shared_openings)


PHRASES_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM w, range(1, 5) t(k), LATERAL (SELECT unnest(range(1, length(ws) - k + 2)) AS i)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 30),
x AS MATERIALIZED (SELECT c.lang, c.k, c.phrase, c.a, ws, j, f.a AS l FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
      JOIN f ON f.lang || ' ' || f.phrase = c.lang || ' ' || array_to_string(ws[:j], ' ')),
u AS (SELECT x.*, f.a AS r, 2000000::HUGEINT * x.a // (l::HUGEINT + f.a) AS score,
             row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY 2000000::HUGEINT * x.a // (l::HUGEINT + f.a), j) AS cut
      FROM x JOIN f ON f.lang || ' ' || f.phrase = x.lang || ' ' || array_to_string(ws[j + 1:], ' ')),
b AS (SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
        FROM c, range(2, 4) t(m), LATERAL (SELECT unnest(range(1, k - m + 2)) AS i) WHERE m < k) GROUP BY ALL),
s AS (SELECT u.* FROM u LEFT JOIN b USING (lang, phrase) WHERE cut = 1 AND 100::HUGEINT * coalesce(longer, 0) < 80::HUGEINT * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


@query(PHRASES_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two to four words in each language."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"), least=30, percent=80, top=2000)
