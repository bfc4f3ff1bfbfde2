"""Queries on deduplication. Documents stand for conversations whose lines are assistant replies; events for sightings of hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as X
from chatloom.operators import dedup as D
from chatloom.queries.base import read
from chatloom.sources.scratch import stored

NORM = "regexp_replace(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '\\s+', ' ', 'g')"


def _docs(spark, d):
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S"))
    turns = F.transform(lines, lambda x: F.struct(F.lit("assistant").alias("role"), x.alias("text")))
    return read(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").alias("conv_id"), "text", turns.alias("turns"))


#: The reference memory: newest signatures and openings that a row is compared with.
RECENT = {"signature": 5000, "opening": 500}


def _keyed(spark, d):
    return D.keyed(_docs(spark, d)).select("seq", "conv_id", "hash", "signature", "opening")


def _written(spark, d):
    """_keyed for queries that read it from several sides."""
    return stored(_keyed(spark, d), "keyed")


#: Oracle: k(seq, hash, signature, opening) and sets of distinct words.
K = f"""r AS (SELECT doc_id AS seq, {NORM.format('text')} AS norm, [{NORM.format('x')} FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '\\S')] AS ls FROM documents),
k AS (SELECT seq, sha256(norm) AS hash, CASE WHEN len(ls) > 0 THEN array_to_string(string_split(ls[1], ' ')[1:30], ' ') || ' ||| ' || array_to_string(string_split(ls[-1], ' ')[greatest(len(string_split(ls[-1], ' ')) - 19, 1):], ' ') ELSE substr(norm, 1, 200) END AS signature,
  CASE WHEN len(ls) > 0 THEN ls[1] ELSE '' END AS opening FROM r)"""


def _sets(column: str, name: str) -> str:
    """Pairs of different strings with their common words, by a join on words."""
    return f"""{name}f AS (SELECT {column} AS v, min(seq) AS id FROM k GROUP BY 1), {name}w AS (SELECT DISTINCT id, unnest([x FOR x IN string_split(v, ' ') IF x <> '']) AS w FROM {name}f),
{name}n AS (SELECT id, count(*) AS n FROM {name}w GROUP BY id),
{name}c AS (SELECT x.id AS a, y.id AS b, count(*) AS common FROM {name}w x JOIN {name}w y ON x.w = y.w AND x.id < y.id GROUP BY ALL),
{name}p AS (SELECT a, b, common, p.n + q.n - common AS either FROM {name}c JOIN {name}n p ON p.id = a JOIN {name}n q ON q.id = b)"""


def content_hash(spark, d):
    return _keyed(spark, d).select("conv_id", "hash")


def exact_dups(spark, d):
    return D.exact_dups(_keyed(spark, d)).select("conv_id", F.col("dup_rank").cast("long"))


def exact_against(spark, d):
    own = stored(_keyed(spark, d).select("seq", "conv_id", "hash"), "hashes")
    return D.exact_against(own.where("seq % 2 = 1"), own.where("seq % 2 = 0")).select("conv_id")


def signature(spark, d):
    return _keyed(spark, d).select("conv_id", "signature")


def opening(spark, d):
    return _keyed(spark, d).select("conv_id", "opening")


def jaccard_neighbours(spark, d):
    """Similarity of each document's opening to its signature."""
    own = _keyed(spark, d)
    return own.select("conv_id", F.round(X.jaccard(X.tokens(F.col("opening")), X.tokens(F.col("signature"))), 6).alias("sim"))


def similar_pairs(spark, d):
    return D.similar_pairs(_written(spark, d), "signature", 9, 10)


def opening_dups(spark, d):
    own = _written(spark, d)
    equal = D.repeats(own, "opening").select("seq", F.lit("exact_opening_duplicate").alias("reason"))
    near = D.similar_to_earlier(own, "opening", 19, 20).select("seq", F.lit("opening_similarity>0.95").alias("reason"))
    return equal.unionByName(near.join(equal, "seq", "left_anti"))


def recent_band(spark, d):
    """Rows that one of the newest signatures or openings before them repeats."""
    own = stored(_keyed(spark, d).select("seq", "signature", "opening"), "keyed")
    signatures = D.similar_within(own, "signature", 9, 10, RECENT["signature"]).select("seq", F.lit("signature").alias("memory"))
    return signatures.unionByName(D.similar_within(own, "opening", 19, 20, RECENT["opening"], blank_equal=True).select("seq", F.lit("opening").alias("memory")))


def dup_reason(spark, d):
    return D.dup_reason(_keyed(spark, d)).select("conv_id", "dup_reason")


def resolve_drop(spark, d):
    return D.resolve(D.dup_reason(_keyed(spark, d)), "drop").select("conv_id")


def resolve_marked(spark, d):
    return D.resolve(D.dup_reason(_keyed(spark, d)), "keep_marked").groupBy("dup_reason").agg(F.count("*").alias("n"))


def _sightings(spark, d):
    """Each user's events of a type are sightings of one content, spread over a year and a half."""
    e = read(spark, d, "events")
    stretched = F.timestamp_seconds(F.lit(1704067200) + (F.unix_seconds(F.col("ts").cast("timestamp")) - 1704067200) * 18)
    return e.select("event_id", F.concat_ws(":", "user_id", "event_type").alias("hash"), stretched.alias("created_at"))


SIGHT = "s AS (SELECT event_id, user_id || ':' || event_type AS hash, to_timestamp(1704067200 + (floor(epoch(ts))::BIGINT - 1704067200) * 18)::TIMESTAMP AS created_at FROM events)"


def ttl_dups(spark, d):
    own = D.ttl_anchor(_sightings(spark, d))
    return own.groupBy("hash").agg(F.count_if("duplicate").alias("repeats"), F.count_if(~F.col("duplicate")).alias("anchors"))


TTL = f"""WITH RECURSIVE {SIGHT}, a(hash, anchor) AS (SELECT hash, min(created_at) FROM s GROUP BY hash
 UNION ALL SELECT * FROM (SELECT a.hash, min(s.created_at) AS n FROM a JOIN s ON s.hash = a.hash AND s.created_at >= a.anchor + INTERVAL 90 DAYS GROUP BY a.hash))
SELECT s.hash, count(*) - any_value(n) AS repeats, any_value(n) AS anchors FROM s JOIN (SELECT hash, count(*) AS n FROM a GROUP BY hash) USING (hash) GROUP BY s.hash"""


def against_history(spark, d):
    own = _sightings(spark, d)
    early = own.where("created_at < TIMESTAMP '2024-07-01 00:00:00'").groupBy("hash").agg(F.min("created_at").alias("created_at"))
    return D.against_history(own.where("created_at >= TIMESTAMP '2024-07-01 00:00:00'"), early).select("event_id")


def distinct_hashes(spark, d):
    from chatloom.operators.reporting import distinct_hashes as count

    return count(_keyed(spark, d))


def update_state(spark, d):
    own = _written(spark, d).select("seq", "hash", "signature", "opening", F.timestamp_seconds(F.col("seq") + 1704067200).alias("created_at"))
    rows = own.select("seq", "created_at", F.expr("stack(3, 'hash', hash, 'signature', signature, 'opening', opening) AS (kind, value)"))
    state, new = rows.where("seq % 3 <> 0"), rows.where("seq % 3 = 0")
    out = D.update_state(state.drop("seq"), new.drop("seq"), RECENT)
    return out.groupBy("kind").agg(F.count("*").alias("n"), F.min("created_at").alias("oldest"))


def greedy(spark, d):
    """Every document, kept unless a kept earlier one's signature is equal or similar."""
    own = _written(spark, d)
    return D.resolve_greedy(own, D.similar_pairs(own, "signature", 9, 10), "signature")


#: Oracle: dr(conv_id, dup_reason) of k.
MARKED = f"""{_sets('signature', 's')}, {_sets('opening', 'u')},
h1 AS (SELECT seq, row_number() OVER (PARTITION BY hash ORDER BY seq) > 1 AS eh, row_number() OVER (PARTITION BY signature ORDER BY seq) > 1 AND signature <> '' AS es, row_number() OVER (PARTITION BY opening ORDER BY seq) > 1 AS eo, signature, opening FROM k),
sb AS (SELECT id, min(m) AS m FROM (SELECT b AS id, a AS m FROM sp WHERE common * 10 > either * 9 UNION ALL SELECT a, b FROM sp WHERE common * 10 > either * 9) GROUP BY id),
ob AS (SELECT id, min(m) AS m FROM (SELECT b AS id, a AS m FROM up WHERE common * 20 > either * 19 UNION ALL SELECT a, b FROM up WHERE common * 20 > either * 19) GROUP BY id),
dr AS (SELECT h1.seq AS conv_id, CASE WHEN eh THEN 'exact_hash_duplicate' WHEN es OR h1.seq > sb.m THEN 'signature_similarity>0.90' WHEN eo THEN 'exact_opening_duplicate' WHEN h1.seq > ob.m THEN 'opening_similarity>0.95' ELSE 'unique' END AS dup_reason
 FROM h1 JOIN sf ON sf.v = h1.signature LEFT JOIN sb ON sb.id = sf.id JOIN uf ON uf.v = h1.opening LEFT JOIN ob ON ob.id = uf.id)"""
DUP = f"WITH {K}, {MARKED}"
PAIRED = f"""{K}, {_sets('signature', 's')},
g AS (SELECT a, b, round(common / either, 6) AS sim FROM sp WHERE common * 10 > either * 9
 UNION ALL SELECT sf.id, k.seq, 1.0 FROM k JOIN sf ON sf.v = k.signature WHERE k.seq > sf.id AND regexp_matches(k.signature, '\\S'))"""
PAIR = f"WITH {PAIRED} SELECT a, b, sim FROM g"
GREEDY = f"""WITH RECURSIVE {PAIRED}, again AS (SELECT k.seq FROM k JOIN sf ON sf.v = k.signature WHERE k.seq > sf.id AND regexp_matches(k.signature, '\\S')),
nb AS (SELECT b, list(a) AS blockers, row_number() OVER (ORDER BY b) AS i FROM g WHERE b NOT IN (SELECT seq FROM again) GROUP BY b),
w(i, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
 SELECT w.i + 1, CASE WHEN len([x FOR x IN blockers IF NOT list_contains(gone, x)]) > 0 THEN list_append(gone, b) ELSE gone END FROM w JOIN nb ON nb.i = w.i + 1)
SELECT seq, NOT list_contains((SELECT arg_max(gone, i) FROM w), seq) AND seq NOT IN (SELECT seq FROM again) AS kept FROM k"""
BAND = f"""WITH {K}, {_sets('signature', 's')}, {_sets('opening', 'u')},
o AS (SELECT seq, row_number() OVER (ORDER BY seq) AS i, signature, opening, sf.id AS s, uf.id AS u FROM k JOIN sf ON sf.v = k.signature JOIN uf ON uf.v = k.opening),
ss AS (SELECT a, b FROM sp WHERE common * 10 > either * 9 UNION ALL SELECT b, a FROM sp WHERE common * 10 > either * 9),
uu AS (SELECT a, b FROM up WHERE common * 20 > either * 19 UNION ALL SELECT b, a FROM up WHERE common * 20 > either * 19)
SELECT DISTINCT x.seq, 'signature' AS memory FROM o x JOIN o y ON x.i - y.i BETWEEN 1 AND {RECENT['signature']} WHERE (x.s = y.s AND regexp_matches(x.signature, '\\S')) OR (x.s, y.s) IN (SELECT (a, b) FROM ss)
UNION ALL SELECT DISTINCT x.seq, 'opening' FROM o x JOIN o y ON x.i - y.i BETWEEN 1 AND {RECENT['opening']} WHERE x.u = y.u OR (x.u, y.u) IN (SELECT (a, b) FROM uu)"""
OPEN = f"""WITH {K}, {_sets('opening', 'u')}, e AS (SELECT seq, opening, row_number() OVER (PARTITION BY opening ORDER BY seq) > 1 AS eo FROM k),
ob AS (SELECT id, min(m) AS m FROM (SELECT b AS id, a AS m FROM up WHERE common * 20 > either * 19 UNION ALL SELECT a, b FROM up WHERE common * 20 > either * 19) GROUP BY id)
SELECT e.seq, CASE WHEN eo THEN 'exact_opening_duplicate' ELSE 'opening_similarity>0.95' END AS reason FROM e JOIN uf ON uf.v = e.opening LEFT JOIN ob ON ob.id = uf.id WHERE eo OR e.seq > ob.m"""
STATE = f"""WITH {K}, x AS (SELECT seq, to_timestamp(seq + 1704067200)::TIMESTAMP AS created_at, hash, signature, opening FROM k),
h AS (SELECT 'hash' AS kind, hash AS value, min(created_at) AS created_at FROM x GROUP BY hash),
s AS (SELECT 'signature' AS kind, signature AS value, created_at FROM x ORDER BY created_at DESC LIMIT 5000), o AS (SELECT 'opening' AS kind, opening AS value, created_at FROM x ORDER BY created_at DESC LIMIT 500)
SELECT kind, count(*) AS n, min(created_at) AS oldest FROM (SELECT * FROM h UNION ALL SELECT * FROM s UNION ALL SELECT * FROM o) GROUP BY kind"""

QUERIES = {
    "content_hash": (content_hash, f"WITH {K} SELECT seq AS conv_id, hash FROM k"),
    "exact_dups": (exact_dups, f"WITH {K} SELECT seq AS conv_id, row_number() OVER (PARTITION BY hash ORDER BY seq) AS dup_rank FROM k"),
    "exact_against": (exact_against, f"WITH {K} SELECT seq AS conv_id FROM k WHERE seq % 2 = 1 AND hash IN (SELECT hash FROM k WHERE seq % 2 = 0)"),
    "signature": (signature, f"WITH {K} SELECT seq AS conv_id, signature FROM k"),
    "opening": (opening, f"WITH {K} SELECT seq AS conv_id, opening FROM k"),
    "jaccard": (jaccard_neighbours, f"WITH {K}, x AS (SELECT seq, list_distinct([x FOR x IN string_split(opening, ' ') IF x <> '']) AS a, list_distinct([x FOR x IN string_split(signature, ' ') IF x <> '']) AS b FROM k) SELECT seq AS conv_id, CASE WHEN len(a) > 0 AND len(b) > 0 THEN round(len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))), 6) ELSE 0.0 END AS sim FROM x"),
    "similar_pairs": (similar_pairs, PAIR),
    "opening_dups": (opening_dups, OPEN),
    "recent_band": (recent_band, BAND),
    "dup_reason": (dup_reason, f"{DUP} SELECT * FROM dr"),
    "resolve_drop": (resolve_drop, f"{DUP} SELECT conv_id FROM dr WHERE dup_reason = 'unique'"),
    "resolve_marked": (resolve_marked, f"{DUP} SELECT CASE WHEN dup_reason = 'unique' THEN dup_reason ELSE 'accepted_after_dedup_retries_exhausted' END AS dup_reason, count(*) AS n FROM dr GROUP BY 1"),
    "ttl_dups": (ttl_dups, TTL),
    "against_history": (against_history, f"WITH {SIGHT}, h AS (SELECT hash, min(created_at) AS created_at FROM s WHERE created_at < TIMESTAMP '2024-07-01 00:00:00' GROUP BY hash) SELECT event_id FROM s WHERE created_at >= TIMESTAMP '2024-07-01 00:00:00' AND EXISTS (SELECT 1 FROM h WHERE h.hash = s.hash AND s.created_at < h.created_at + INTERVAL 90 DAYS)"),
    "distinct_hashes": (distinct_hashes, f"WITH {K} SELECT count(*) AS n_rows, count(DISTINCT hash) AS n_hashes FROM k"),
    "update_state": (update_state, STATE),
    "greedy_dedup": (greedy, GREEDY),
}
