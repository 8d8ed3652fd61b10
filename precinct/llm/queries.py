"""One query for each operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm import (
    bpe_prefix,
    conversations,
    fingerprint,
    language,
    minhash,
    mixing,
    quality,
    sharding,
    substrings,
    suffix_tree,
    token_files,
    vectors,
    whitening,
)
from precinct.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_fingerprints(spark, folder):
    return fingerprint.edited_copies(read_table(spark, folder, "documents"))


@query
def op2_near_duplicates(spark, folder):
    return minhash.near_duplicates(read_table(spark, folder, "documents")).drop("text_key", "group_key")


ORACLE["op2_near_duplicates"] = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (
  SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN least ON node = doc_id
"""


@query
def op3_source_mix(spark, folder):
    docs = read_table(spark, folder, "documents")
    return mixing.Mix(docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))).taken()


@query
def op4_quality(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    held_out = language.held_out(F.col("doc_id"))
    model = quality.learn(docs.filter(~held_out), read_table(spark, folder, "labels"))
    return quality.score(docs, model, "doc_id", held_out.alias("held_out"))


@query
def op5_repeated_strings(spark, folder):
    return substrings.remove_repeats(read_table(spark, folder, "documents"))


ORACLE["op5_repeated_strings"] = """
WITH docs AS (
  SELECT doc_id, b, octet_length(b) AS n FROM (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents)),
windows AS (
  SELECT doc_id, i, md5(array_slice(b, i + 1, i + 100)) AS w
  FROM (SELECT doc_id, b, unnest(range(n - 99)) AS i FROM docs WHERE n >= 100)),
later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM later),
numbered AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (
  SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS z FROM spans
  UNION ALL
  SELECT doc_id, coalesce(max(hi), 0), any_value(n) FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, unhex(string_agg(CASE WHEN z > a THEN hex(array_slice(b, a + 1, z)) ELSE '' END, '' ORDER BY a)) AS k
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(hi - lo) AS removed, count(*) AS runs FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans,
  sha256(k) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""


@query
def op6_resharding(spark, folder):
    docs = sharding.old_layout(read_table(spark, folder, "documents"))
    files = sharding.Resharding(docs, sharding.OLD_SHARDS).rewrite()
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return files.select(
        "doc_id",
        (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_near_vectors(spark, folder):
    return vectors.near_vectors(read_table(spark, folder, "embeddings"))


ORACLE["op7_near_vectors"] = """
WITH RECURSIVE
good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id LEFT JOIN counts ON a = vec_id
"""


@query
def op8_language_id(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out(F.col("doc_id"))
    references = language.learn(docs.filter(~held_out))
    out = language.identify(docs, references, "doc_id", held_out.alias("held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query
def op9_bpe_roundtrip(spark, folder):
    return bpe_prefix.encode(read_table(spark, folder, "documents"), with_ids=False)


@query
def op10_token_files(spark, folder):
    return token_files.token_table(read_table(spark, folder, "documents"), added=True)


@query
def op11_whitening(spark, folder):
    vectors_table = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    model, fit_list = whitening.fit(vectors_table)
    error = whitening.identity_error(fit_list, model) if model else 0.0
    return whitening.whiten(vectors_table, model, "vec_id").withColumn("identity_error", F.lit(error))


@query
def op13_suffix_tree_scores(spark, folder):
    return suffix_tree.score_documents(read_table(spark, folder, "documents"), suffix_tree.held_out(F.col("doc_id")))


@query
def op12_conversation_repair(spark, folder):
    rows = conversations.damaged(read_table(spark, folder, "conversations"))
    return conversations.digests(conversations.repair_conversations(rows))


ORACLE["op12_conversation_repair"] = r"""
WITH RECURSIVE
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS draw
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE draw WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn),
placed AS (
  SELECT *, rtrim(text, E' \t\n\x0b\x0c\r') AS body, sha256(text) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i
  FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
every AS (
  SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON c.conv_id IS NOT DISTINCT FROM counts.conv_id),
-- For each state (z nothing, s system, u user, a assistant) the least [cost, audit, lines] that ends in it.
steps AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'e': '', 't': ''} AS z, NULL::STRUCT(c BIGINT, e VARCHAR, t VARCHAR) AS s,
    NULL::STRUCT(c BIGINT, e VARCHAR, t VARCHAR) AS u, NULL::STRUCT(c BIGINT, e VARCHAR, t VARCHAR) AS a FROM every
  UNION ALL
  SELECT conv_id, i,
    list_min([z_d]) AS z,
    list_min([s_d, CASE WHEN k = 's' THEN {'c': z.c + w, 'e': z.e || 'K', 't': z.t || line} END]) AS s,
    list_min([u_d, CASE WHEN k <> '-' THEN {'c': open.c + w + (k <> 'u')::BIGINT, 'e': open.e || CASE k WHEN 'u' THEN 'K' ELSE 'R' END,
      't': open.t || CASE k WHEN 'u' THEN line ELSE E'\nuser:' || text END} END]) AS u,
    list_min([a_d, CASE WHEN k <> '-' THEN {'c': u2.c + w + (k <> 'a')::BIGINT, 'e': u2.e || CASE k WHEN 'a' THEN 'K' ELSE 'R' END,
      't': u2.t || CASE k WHEN 'a' THEN line ELSE E'\nassistant:' || text END} END]) AS a
  FROM (
    SELECT *,
      CASE WHEN z.c IS NOT NULL THEN {'c': z.c + 2, 'e': z.e || 'D', 't': z.t} END AS z_d,
      CASE WHEN s.c IS NOT NULL THEN {'c': s.c + 2, 'e': s.e || 'D', 't': s.t} END AS s_d,
      CASE WHEN u2.c IS NOT NULL THEN {'c': u2.c + 2, 'e': u2.e || 'D', 't': u2.t} END AS u_d,
      CASE WHEN a2.c IS NOT NULL THEN {'c': a2.c + 2, 'e': a2.e || 'D', 't': a2.t} END AS a_d,
      list_min([z, s, a2]) AS open
    FROM (
      SELECT *, list_min([a, CASE WHEN u1.c IS NOT NULL THEN {'c': u1.c + 5, 'e': u1.e || 'I', 't': u1.t || E'\nassistant:'} END]) AS a2,
        list_min([u1, CASE WHEN a1.c IS NOT NULL THEN {'c': a1.c + 5, 'e': a1.e || 'I', 't': a1.t || E'\nuser:'} END]) AS u2
      FROM (
        SELECT *, list_min([u, CASE WHEN list_min([z, s, a]).c IS NOT NULL
            THEN {'c': list_min([z, s, a]).c + 5, 'e': list_min([z, s, a]).e || 'I', 't': list_min([z, s, a]).t || E'\nuser:'} END]) AS u1,
          list_min([a, CASE WHEN u.c IS NOT NULL THEN {'c': u.c + 5, 'e': u.e || 'I', 't': u.t || E'\nassistant:'} END]) AS a1
        FROM (
          SELECT f.conv_id, f.i, z, s, u, a, f.text, E'\n' || f.role || ':' || f.text AS line,
            CASE WHEN f.fault IN ('blank', 'duplicate') THEN '-' ELSE f.initial END AS k,
            CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS w
          FROM steps JOIN faults f ON f.conv_id IS NOT DISTINCT FROM steps.conv_id AND f.i = steps.i + 1))))),
ends AS (
  SELECT steps.conv_id, list_min([z, a, CASE WHEN u.c IS NOT NULL THEN {'c': u.c + 5, 'e': u.e || 'I', 't': u.t || E'\nassistant:'} END,
    CASE WHEN s.c IS NOT NULL THEN {'c': s.c + 10, 'e': s.e || 'II', 't': s.t || E'\nuser:\nassistant:'} END]) AS best
  FROM steps JOIN every ON steps.conv_id IS NOT DISTINCT FROM every.conv_id AND steps.i = every.n)
SELECT every.conv_id, gaps, blank, duplicate, truncated, illegal, best.c AS cost, best.e AS audit, sha256(best.t[2:]) AS repaired_sha256
FROM every JOIN ends ON every.conv_id IS NOT DISTINCT FROM ends.conv_id
"""
