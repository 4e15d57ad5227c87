"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chunk_bpe, decision_list, decontaminate, fim, merkle, ngram_join, page_diff, preference, simhash,
               token_index, toxicity, url_filter, warc)
from .common import table, tokenizer_path


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation that has an answer, paired with one whose last answer is stale."""
    rows = preference.in_rows(table(spark, sf_dir, "conversations"))
    pairs = preference.format_pairs(preference.stale_answers(rows))

    def spans(mask: str):
        return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")

    return pairs.select("conv_id", "n_prefix", "prompt", "chosen", "rejected",
                        spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"))


def op3_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts and the learned decision list's verdict on every document."""
    judged, _ = decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "rule")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that stands in it within the error budget."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components of every document."""
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding, as digests."""
    return chunk_bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document read back from the token shards through the key index."""
    return token_index.index_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document against the manifest's root, some with line breaks deleted since."""
    docs = table(spark, sf_dir, "documents")
    altered, where = merkle.without_breaks(docs)
    return merkle.verify(docs, altered=altered, where=where)


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, and the text restored from it, as digests."""
    return fim.round_trip(table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents whose five-word shingles are alike to 80 percent."""
    found = ngram_join.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_preference, op3_page_diff, op4_quality_rules, op5_toxicity, op6_warc, op7_decontaminate,
    op8_simhash, op9_chunk_bpe, op10_token_index, op11_merkle, op12_fim, op13_ngram_join)}

ORACLES = {
    # turns in order, the place of the last answer, and the answer before it
    "op2_preference": r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS pos,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations),
ans AS (
  SELECT conv_id, pos, text, lag(text) OVER w AS stale, row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) AS back
  FROM t WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
both_ AS (
  SELECT t.conv_id, t.pos, t.role, t.text, a.pos AS last_at, a.stale,
         CASE WHEN t.pos = a.pos THEN a.stale ELSE t.text END AS rtext
  FROM t JOIN ans a ON t.conv_id IS NOT DISTINCT FROM a.conv_id AND a.back = 1 AND t.pos <= a.pos),
f AS (
  SELECT *, CASE WHEN rtext IS NULL OR rtext <> text THEN last_at ELSE last_at + 1 END AS first_
  FROM both_ WHERE pos = last_at),
m AS (
  SELECT b.conv_id, b.pos, b.role, f.first_,
         '<|' || b.role || '|>' || chr(10) || b.text || chr(10) || '<|end|>' || chr(10) AS c,
         '<|' || b.role || '|>' || chr(10) || b.rtext || chr(10) || '<|end|>' || chr(10) AS r
  FROM both_ b JOIN f ON b.conv_id IS NOT DISTINCT FROM f.conv_id)
SELECT conv_id, first_ - 1 AS n_prefix,
       coalesce(string_agg(c, '' ORDER BY pos) FILTER (pos < first_), '') AS prompt,
       coalesce(string_agg(c, '' ORDER BY pos) FILTER (pos >= first_), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY pos) FILTER (pos >= first_), '') AS rejected,
       coalesce(max('14-' || length(c)) FILTER (pos >= first_), '') AS chosen_mask,
       coalesce(max('14-' || length(r)) FILTER (pos >= first_ AND r IS NOT NULL), '') AS rejected_mask
FROM m GROUP BY conv_id, first_""",
    # leaves, then both trees level by level; a document's path is walked with what stands beside it
    "op11_merkle": r"""
WITH RECURSIVE raw AS (
  SELECT doc_id, source, lang, n_chars, text,
         xor(list_reduce(list_transform(string_split(cast(doc_id AS varchar), ''), lambda ch: cast(ascii(ch) AS bigint)), lambda c, b:
             list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
             4294967295), 4294967295) AS crc
  FROM documents),
leaf AS (
  SELECT *, coalesce(strlen(cast(doc_id AS varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars AS varchar)) || ':' || n_chars, '-') AS head,
         CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now
  FROM raw),
doc AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS changed FROM leaf),
src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM doc GROUP BY source),
placed AS (
  SELECT d.*, s.tree, s.n, row_number() OVER (PARTITION BY s.tree ORDER BY d.doc_id, d.leaf) - 1 AS idx
  FROM doc d JOIN src s ON d.source IS NOT DISTINCT FROM s.source),
low(tree, level, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1
  GROUP BY tree, level, idx // 3, n),
top(level, idx, n, h) AS (
  SELECT 0, tree, (SELECT count(*) FROM src), h FROM low WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1
  GROUP BY level, idx // 3, n),
both_ AS (
  SELECT tree, level, idx, n, h FROM low WHERE n > 1
  UNION ALL SELECT -1, level, idx, n, h FROM top WHERE n > 1),
run AS (   -- what stands before and after a node among its siblings
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM both_ a JOIN both_ b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3 GROUP BY ALL),
path(doc_no, tree, level, idx, source_tree, folded, proof) AS (
  SELECT tree || ':' || idx, CASE WHEN n > 1 THEN tree ELSE -1 END, 0, CASE WHEN n > 1 THEN idx ELSE tree END, tree, changed, ''
  FROM placed
  UNION ALL
  SELECT p.doc_no, CASE WHEN r.tree >= 0 AND up.idx IS NULL THEN -1 ELSE r.tree END,
         CASE WHEN r.tree >= 0 AND up.idx IS NULL THEN 0 ELSE r.level + 1 END,
         CASE WHEN r.tree >= 0 AND up.idx IS NULL THEN p.source_tree ELSE r.idx // 3 END, p.source_tree,
         sha256(r.before || p.folded || r.after), p.proof || r.before || r.after
  FROM path p JOIN run r ON r.tree = p.tree AND r.level = p.level AND r.idx = p.idx
  LEFT JOIN run up ON up.tree = r.tree AND up.level = r.level + 1 AND up.idx = r.idx // 3),
done AS (
  SELECT doc_no, arg_max(folded, length(proof) * 1000 + (tree = -1)::int * 100 + level) AS folded,
         arg_max(proof, length(proof) * 1000 + (tree = -1)::int * 100 + level) AS proof
  FROM path GROUP BY doc_no),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, root.root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root,
       d.folded = root.root AS verified
FROM placed p JOIN done d ON d.doc_no = p.tree || ':' || p.idx JOIN low s ON s.tree = p.tree AND s.n = 1, root""",
    "op12_fim": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS h
  FROM documents),
n AS (
  SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(h, i, 8) AS bigint)) AS r FROM d),
c AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90
              THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
         array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, cast(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN cast(length(prefix) AS bigint) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN cast(length(middle) AS bigint) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p""",
    # every pair of documents that share a shingle
    "op13_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS common
  FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM both_ WHERE 100 * common >= 80 * (n - common)),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, g.b FROM reach r JOIN g ON g.a = r.other)
SELECT s.doc_id, cast(len(any_value(s.s)) AS bigint) AS n_shingles, min(r.other) AS component_id
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id""",
}
