"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, jaccard, lines, merkle, negatives, packing, secrets, substring, tokenfiles, tokens, toxicity, warc
from .common import shared_folder, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = f"{shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}"
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents"), ledger))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"), text_out=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("line_count").alias("n_lines"), F.col("lines_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_classes(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), F.col("tox_score").alias("score"), F.col("tox_predicted").alias("predicted"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    is_altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), F.translate("text", upper, upper.lower()), is_altered)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    tokenfiles.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return tokenfiles.read_ids(spark, path, with_ids=False)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    """The others can't be put in SQL (search by sample, SimHash, a tokenizer, packing, a fitted model); tests hold them against plain versions."""
    return {"op1_secret_scan": OP1, "op2_substring_dedup": OP2, "op6_jaccard_join": OP6, "op9_warc_archive": OP9, "op11_merkle_manifest": OP11, "op13_hard_negatives": OP13}


#: Matches are put between two marks, so their places follow from the lengths of what lies between.
OP1 = r"""
WITH k(kind, rank, pat, least) AS (VALUES
  ('assign', 0, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
  ('access', 1, 'AKIA[A-Z0-9]+', 18), ('hex', 2, '[0-9a-f]+', 16)),
m AS (SELECT doc_id, kind, rank, pat, least, string_split(regexp_replace(coalesce(text, ''), pat, chr(1) || '\0' || chr(2), 'g'), chr(1)) AS parts FROM documents, k),
u AS (SELECT doc_id, kind, rank, pat, least, unnest(range(len(parts))) AS i, unnest(parts) AS p FROM m),
s AS (SELECT *, sum(length(p) - CASE WHEN i > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS start FROM u),
f AS (SELECT doc_id, kind, rank, least, CAST(start AS BIGINT) AS start, split_part(p, chr(2), 1) AS hit, CASE WHEN rank = 0 THEN regexp_extract(split_part(p, chr(2), 1), pat, 2) ELSE split_part(p, chr(2), 1) END AS own FROM s WHERE i > 0),
g AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex, string_agg(kind || ':' || start || ':' || (start + length(hit)), ',' ORDER BY start, rank) AS spans FROM f WHERE length(own) >= least GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN g USING (doc_id)
"""

_WORDS = r"""w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos, len(ws) AS n FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents))"""

OP2 = f"""
WITH {_WORDS},
g AS (SELECT doc_id, pos, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win, n FROM w),
f AS (SELECT win, min(doc_id) AS d FROM g WHERE pos + 13 <= n GROUP BY win),
r AS (SELECT DISTINCT doc_id, pos + k.k AS pos FROM g JOIN f USING (win), (SELECT unnest(range(13)) AS k) k WHERE g.pos + 13 <= g.n AND f.d < g.doc_id),
x AS (SELECT w.doc_id, count(*) AS n_words, count(r.pos) AS n_removed, string_agg(CASE WHEN r.pos IS NULL THEN word END, ' ' ORDER BY w.pos) AS kept FROM w LEFT JOIN r USING (doc_id, pos) GROUP BY w.doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN x USING (doc_id)
"""

OP6 = f"""
WITH RECURSIVE {_WORDS},
g AS (SELECT doc_id, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS sh, pos, n FROM w),
s AS (SELECT DISTINCT doc_id, sh FROM g WHERE pos + 5 <= n OR (n < 5 AND pos = 0)),
c AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id JOIN c ca ON ca.doc_id = a.doc_id JOIN c cb ON cb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, ca.c, cb.c HAVING count(*) >= 0.8e0*(ca.c + cb.c - count(*)) - 1e-9),
bo AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(node, root) AS (SELECT DISTINCT a, a FROM bo UNION SELECT bo.b, r.root FROM r JOIN bo ON bo.a = r.node),
l AS (SELECT a, count(*) AS n FROM bo GROUP BY a), m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT doc_id, coalesce(root, doc_id) AS class_id, coalesce(n, 0) AS n_links FROM documents LEFT JOIN m ON node = doc_id LEFT JOIN l ON a = doc_id
"""

OP9 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def _tree(name: str, leaves: str, levels: int) -> str:
    """Runs r and nodes l of each level over leaves (own, i, h), the last nodes top(own, h); 16**levels leaves at most."""
    out = f"{name}l0 AS (SELECT own, i, h FROM {leaves})"
    for k in range(levels):
        out += f""", {name}r{k} AS (SELECT own, i // 16 AS j, list(h ORDER BY i) AS s FROM (SELECT *, count(*) OVER (PARTITION BY own) AS c FROM {name}l{k}) WHERE c > 1 GROUP BY own, i // 16),
{name}l{k + 1} AS (SELECT own, j AS i, sha256(array_to_string(s, '')) AS h FROM {name}r{k})"""
    tops = " UNION ALL ".join(f"SELECT own, any_value(h) AS h FROM {name}l{k} GROUP BY own HAVING count(*) = 1" for k in range(levels + 1))
    return f"{out}, {name}top AS ({tops})"


def _ways(name: str, start: str, levels: int, own: str) -> str:
    """start (own, i, t, sib, ...) folded through the levels of _tree."""
    out, last = "", start
    for k in range(levels):
        out += f""", {name}f{k} AS (SELECT f.* REPLACE (coalesce(sha256(array_to_string(s[1:i % 16] || [t] || s[i % 16 + 2:], '')), t) AS t,
  sib || coalesce(array_to_string(s[1:i % 16] || s[i % 16 + 2:], ''), '') AS sib, i // 16 AS i) FROM {last} f LEFT JOIN {name}r{k} r ON r.own = f.{own} AND r.j = f.i // 16)"""
        last = f"{name}f{k}"
    return out


def _field(x: str) -> str:
    return f"coalesce(octet_length(encode(CAST({x} AS VARCHAR))) || ':' || {x}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: Up to 16**5 documents of a source and 16**3 sources.
OP11 = f"""
WITH d AS (SELECT doc_id, coalesce('+' || source, '') AS own, {_leaf('text')} AS leaf,
  CASE WHEN xor(list_reduce(string_split(CAST(doc_id AS VARCHAR), ''), lambda a, x: list_reduce(range(8), lambda b, k: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384::BIGINT) ELSE b >> 1 END, xor(a, ascii(x)::BIGINT)), 4294967295::BIGINT), 4294967295::BIGINT) % 5 = 0
       THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM d),
{_tree('a', 'p', 5)},
q AS (SELECT '' AS own, own AS source, h, row_number() OVER (ORDER BY own) - 1 AS i FROM atop),
{_tree('b', 'q', 3)},
s AS (SELECT doc_id, own, leaf, i, coalesce(altered, leaf) AS t, '' AS sib FROM p){_ways('a', 's', 5, 'own')},
u AS (SELECT f.* REPLACE (q.i AS i), '' AS none, q.h AS subroot FROM af4 f JOIN q ON q.source = f.own){_ways('b', 'u', 3, 'none')}
SELECT doc_id, leaf, subroot, b.h AS root, sha256(sib) AS proof_sha256, t AS folded_root, t = b.h AS verified FROM bf2, btop b
"""

OP13 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), n AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, other) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
