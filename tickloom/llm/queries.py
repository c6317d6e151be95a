"""Registered queries of the text operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (alignment, ann, decontaminate, language, line_dedup, near_dedup, packing, pieces,
                          prefix_trie, sharding, training_order, url_filter, warc)
from tickloom.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return add


def tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_line_dedup", r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT l.*, (r.k IS NOT NULL AND l.doc_id <> r.keeper) AS gone
  FROM lines l LEFT JOIN repeated r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(
        F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op2_training_order")
def op2_training_order(spark: SparkSession, sf: str) -> DataFrame:
    """Per slot what its shard holds, as read back, with the documents that the manifest names."""
    folder = shared_folder(spark)
    manifest = training_order.write_training_order(
        table(spark, sf, "documents"), tokenizer(), folder=folder)
    return training_order.read_slots(spark, folder).drop("ids").join(manifest, "slot")


@query("op3_decontaminate", r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS size FROM (SELECT item_id, regexp_extract_all(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT size FROM items),
places AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS p
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM low, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, item_id, size, i FROM places JOIN windows USING (size, p)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found)
  GROUP BY doc_id),
held AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(len(ids), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)""")
def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    out = decontaminate.find_leaks(table(spark, sf, "documents").select("doc_id", "text"),
                                   table(spark, sf, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated")


@query("op4_url_filter", r"""
WITH parts AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS behind FROM pages),
places AS (SELECT page_id, translate(regexp_extract(behind, '^([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(behind, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
    arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM places JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath)
  GROUP BY page_id)
SELECT p.page_id, host, path, rule, pattern, coalesce(f.verdict,
    CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM (SELECT page_id, host, path, CASE
    WHEN regexp_matches(host || path, '(?i)(^|[./-])spam[.-]farm([^a-z0-9]|$)') THEN 'spam_farm'
    WHEN regexp_matches(host || path, '(?i)/(?:wp-)?login(\.php)?([^a-z0-9]|$)') THEN 'login_form'
    WHEN regexp_matches(host || path, '(?i)(^|[^a-z0-9])casino([^a-z0-9]|$)') THEN 'casino'
    WHEN regexp_matches(host || path, '(?i)/cart/checkout([^a-z0-9]|$)') THEN 'cart'
    WHEN regexp_matches(host || path, '(?i)(^|[^a-z0-9])xxx([^a-z0-9]|$)') THEN 'adult_host'
  END AS found FROM places) p LEFT JOIN fits f USING (page_id)
  , LATERAL (SELECT CASE WHEN f.rule IS NULL THEN found END AS pattern)""")
def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark)).drop("url")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer())


@query("op6_near_dedup", r"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n, sum(hash(s)::HUGEINT) AS h FROM shingles GROUP BY doc_id),
classes AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n, h) AS head FROM sizes),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id < b.doc_id AND a.doc_id IN (SELECT head FROM classes)
    AND b.doc_id IN (SELECT head FROM classes) GROUP BY ALL),
near AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
links AS (SELECT a AS u, b AS v FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT DISTINCT head AS u, head AS c FROM classes
  UNION SELECT links.v, reach.c FROM reach JOIN links USING (u) WHERE reach.c < links.v),
least_ AS (SELECT u, min(c) AS c FROM reach GROUP BY u)
SELECT w.doc_id, coalesce(k.n, 0)::BIGINT AS n_shingles, coalesce(least_.c, w.doc_id) AS component_id,
  w.doc_id = coalesce(least_.c, w.doc_id) AS kept
FROM words w LEFT JOIN classes k USING (doc_id) LEFT JOIN least_ ON least_.u = k.head""")
def op6_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(
        table(spark, sf, "documents").select("doc_id", "text"), percent=85)


@query("op7_language")
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language.learn(docs.where(~held))
    out = docs.select("doc_id", "text").withColumn("held_out", held)
    return language.detect(out, model).drop("text")


@query("op8_warc", """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest,
    min(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS first FROM pages)""")
def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = warc.write_archive(table(spark, sf, "pages"))
    whole = warc.read_archive(spark, folder).where("record_type = 'response'").select(
        "record_id", "refers_to", "record_type", F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"))
    again = warc.read_archive(spark, folder, payload=False).where("record_type = 'revisit'").select(
        "record_id", "refers_to", "record_type", F.col("http_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"))
    return whole.union(again).select(
        warc.record_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc.record_number(F.col("refers_to")).alias("refers_to"))


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    shards = sharding.shuffle_into_shards(docs, shards=24)
    text = F.coalesce("text", F.lit(""))
    return shards.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op10_neighbours")
def op10_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query("op11_pieces")
def op11_pieces(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = pieces.with_piece_ids(docs, piece_model()).drop("text")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    digests = coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                           F.sha2(ids.cast("binary"), 256).alias("ids_sha256"))
    return pieces.with_piece_text(digests, piece_model()).select(
        "doc_id", "n_tokens", "ids_sha256",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf, "documents"), tokenizer(), piece_model())


@query("op13_prefix_trie", """
WITH t AS (SELECT conv_id, turn, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS m
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id AS c, list(m ORDER BY turn NULLS FIRST,
    sha256(strlen(m.r)::VARCHAR || ':' || m.r || m.x)) AS s FROM t GROUP BY 1),
checks AS (SELECT c, s, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda p, z: xor(p >> 1, 3988292384::UBIGINT * (p & 1))))) % 9 AS h FROM own),
rebuilt AS (SELECT a.c, list_concat(coalesce(list_slice(b.s, 1, a.h), []),
    list_slice(a.s, a.h + 1, len(a.s))) AS q
  FROM checks a LEFT JOIN own b ON b.c = a.c - a.c % 5),
nodes AS (SELECT d, list_slice(q, 1, d) AS p, min(c) AS c, count(*) AS n, max(len(q)) = d AS leaf,
    list(c ORDER BY c) FILTER (len(q) = d) AS ends
  FROM (SELECT *, unnest(range(0, len(q) + 1)) AS d FROM rebuilt) GROUP BY 1, 2),
spread AS (SELECT i, list_slice(p, 1, i) AS p, sum(leaf::INT) AS leaves, sum(saved) AS saved
  FROM (SELECT *, CASE WHEN d > 0 THEN (n - 1) * strlen(p[d].x) ELSE 0 END AS saved,
      unnest(range(0, d + 1)) AS i FROM nodes) GROUP BY 1, 2),
born AS (SELECT d - 1 AS d, list_slice(p, 1, d - 1) AS p, count(*) AS k
  FROM nodes WHERE d > 0 GROUP BY 1, 2)
SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.n AS n_convs,
  coalesce(k, 0) AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(array_to_string(n.ends, ','), '')) AS ends_sha256
FROM nodes n JOIN spread s ON s.i = n.d AND s.p = n.p
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = list_slice(n.p, 1, n.d - 1)
LEFT JOIN born ON born.d = n.d AND born.p = n.p""")
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.share_heads(turns))
