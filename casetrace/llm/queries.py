"""Registered queries of the text operators, and their DuckDB twins.

Each query applies one operator with production parameters to its whole table
and derives narrow digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrace.llm import classifier, collocations, decontamination, divergence, exact_dedup, near_dedup
from casetrace.llm import packing, ppm, preference, sharding, token_files, url_rules, whitening
from casetrace.llm.common import frozen, held_out, table
from casetrace.session import scratch_path

SHARDS = 24


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 24 shards of near equal bytes."""
    text = F.coalesce("text", F.lit(""))
    digests = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64("text").alias("group"))
    placed = sharding.shard_records(digests, F.col("group"), F.col("doc_id"), F.col("size"),
                                    SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the Jensen-Shannon verdict of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return divergence.judge(docs, robust=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"))


def op3_fourier_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality of all documents, learnt from labels that are not held out."""
    features = frozen(classifier.with_features(
        table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
        .withColumn("held_out", held_out(F.col("doc_id"), 5, 0)))
    model = classifier.fit(classifier.with_label(
        features.where(~F.col("held_out")), table(spark, sf_dir, "labels"), "quality"))
    return classifier.classify(features, model).select("doc_id", "held_out", "score", "predicted")


def op4_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into power-of-two pieces of at most 1024 tokens."""
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                            "doc_tokens")
    return packing.bucket_sequences(digests)


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents checked against every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.flag(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op7_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of all documents, learnt from those not held out."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "text")
    return ppm.train(docs.where(~F.col("held_out")), order=4).score(docs)


def op8_perfect_hash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as id files, then every one fetched by its key
    through the index."""
    path = scratch_path(spark, "ids")
    docs = table(spark, sf_dir, "documents")
    placed = token_files.write_token_files(
        docs, public_tokenizers.path("word_bpe_49k.json"), path, end_id=1,
        shards=int(spark.conf.get("spark.sql.shuffle.partitions")), id_width=2)
    totals = token_files.shard_totals(placed)
    files = token_files.build_index(placed, path)
    found = token_files.find_documents(docs.select("doc_id"), path, files)
    rows = token_files.fetch(found, path, totals)
    return token_files.with_start(spark, rows.select(
        "doc_id", "shard", "first_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32")), totals).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op9_rarest_token_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages).drop("url")


def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last reply."""
    turns = table(spark, sf_dir, "conversations")
    return preference.format_pairs(turns, preference.swap_last_reply(turns), "conv_id")


def op11_misra_gries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language, from all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"), threshold=30, longest=4,
                                     inside_percent=80, top=2000)


def op12_progressive_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents, with every text's hash."""
    found = exact_dedup.duplicates(table(spark, sf_dir, "documents"), hash_all=True)
    return found.withColumnRenamed("full_hash", "text_sha256")


def op13_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings projected on the 16 whitened leading components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def _op2_sql() -> str:
    """The base counts and both distances from plain regular expressions and
    joins, without the operator's stripping, sorting or filtering steps."""
    limits = divergence.Limits()
    listed = ", ".join(f"('{lang}', '{w}')" for lang, ws in limits.words.items() for w in ws)
    classes = " UNION ALL ".join(
        f"SELECT doc_id, k, '{name}' AS bin, len(regexp_extract_all(t, '{pattern}')) AS n FROM d"
        for name, pattern in (
            ("lower", "[a-z]"), ("space", r"[\x20\x09-\x0D]"), ("script", r"[^\x00-\x7F]"),
            ("upper", "[A-Z]"), ("sentence", r"[.,;:!?''\"()\-]"), ("symbol", r"[#*$%&|<>]"),
            ("digit", "[0-9]"),
            ("rest", r"[\x00-\x08\x0E-\x1F+/=@\[\\\]^_`{}~\x7F]")))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k, lang AS own,
         CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang ELSE '*' END AS lang
  FROM documents
), w AS (
  SELECT k, lang, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), places AS (
  SELECT k, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3
), windows AS (
  SELECT k, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM places JOIN w USING (k)
), again AS (
  SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM windows)
  WHERE n > 1
), repeats AS (
  SELECT k, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) o(j) GROUP BY k
), lines AS (
  SELECT k, count(*) - count(DISTINCT line) AS n
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), listed(lang, word) AS (VALUES {listed}
), each AS (SELECT k, lang, unnest(ws) AS raw FROM w
), tallied AS (
  SELECT e.k, l.word AS bin, count(*) AS n FROM each e JOIN listed l
    ON e.lang = l.lang AND lower(e.raw) = l.word
   AND (e.raw = l.word OR e.raw = upper(l.word)
        OR e.raw = upper(l.word[1]) || l.word[2:])
  GROUP BY e.k, l.word
), word_bins AS (
  SELECT w.k, w.lang, l.word AS bin, coalesce(t.n, 0) AS n
  FROM w JOIN listed l USING (lang) LEFT JOIN tallied t ON t.k = w.k AND t.bin = l.word
  UNION ALL
  SELECT w.k, w.lang, NULL, len(w.ws) - coalesce((SELECT sum(n) FROM tallied t WHERE t.k = w.k), 0)
  FROM w
), class_bins AS (SELECT c.k, d.lang, c.bin, c.n FROM ({classes}) c JOIN d USING (k)
), bins AS (
  SELECT 'word' AS kind, k, lang, coalesce(bin, '') AS bin, n FROM word_bins
  UNION ALL SELECT 'class', k, lang, bin, n FROM class_bins
), counted AS (
  SELECT d.k, d.own, d.t, len(w.ws) AS n_words, coalesce(l.n, 0) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words,
         len(w.ws) < {limits.min_words}
         OR 100 * coalesce(r.n, 0) > {limits.max_repeat_percent} * len(w.ws) AS base_failed
  FROM d JOIN w USING (k) LEFT JOIN lines l USING (k) LEFT JOIN repeats r USING (k)
), once AS (
  SELECT min(k) AS k FROM counted WHERE NOT base_failed AND own IS NOT NULL GROUP BY own, t
), shares AS (
  SELECT kind, k, bin, coalesce(n / nullif(sum(n) OVER (PARTITION BY kind, k), 0), 0) AS p
  FROM bins
), reference AS (
  SELECT kind, own, bin, avg(p) AS q FROM shares JOIN once USING (k) JOIN d USING (k) GROUP BY ALL
), pq AS (
  SELECT s.kind, s.k, s.p, coalesce(r.q, 0) AS q
  FROM shares s JOIN d USING (k)
  LEFT JOIN reference r ON r.kind = s.kind AND r.bin = s.bin AND r.own = d.own
), js AS (
  SELECT kind, k, sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS v
  FROM pq GROUP BY kind, k
), facts AS (
  SELECT d.doc_id, d.lang, d.own, length(d.t) AS chars, n_words, n_dup_lines, n_repeat_words,
         base_failed, length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_extract_all(d.t, '[#*$%&|<>]')) AS n_symbols, c.v AS class_v, x.v AS word_v
  FROM d JOIN counted USING (k)
  JOIN js c ON c.k = d.k AND c.kind = 'class' JOIN js x ON x.k = d.k AND x.kind = 'word'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR (own IS NOT NULL AND chars >= {limits.class_min_chars}
                AND class_v > {limits.class_distance})
            OR (n_words >= {limits.word_min_words} AND lang <> '*'
                AND word_v > {limits.word_distance})) AS kept,
       round(class_v, 6) AS class_distance, round(word_v, 6) AS word_distance
FROM facts
"""


OP9_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut
), named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM parts
), rules(name, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
         ('com/fr/', 'allow'), ('com/de/', 'block')
), split AS (
  SELECT name, verdict, split_part(name, '/', 1) AS rhost,
         substr(name, strpos(name, '/')) AS rpath
  FROM rules
), fits AS (
  SELECT page_id, host, path, name, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(name) DESC) AS rn
  FROM named JOIN split
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), best AS (SELECT DISTINCT host, path, name, verdict FROM fits WHERE rn = 1),
general(name, n, ex) AS (
  VALUES ('login', 28, '\n/([^\n]*/)?login(/|$)'), ('cheap-pills', 21, '(^|\.)cheap-pills\.'),
         ('casino', 20, '(^|[.-])casino[.-]'), ('spam-farm', 19, '(^|\.)spam-farm\.'),
         ('ads', 17, '(^|[.-])ads[.-]')
), hosts AS (SELECT DISTINCT host, path FROM named),
worst AS (
  SELECT host, path, arg_min(name, (-n, name)) AS name
  FROM hosts JOIN general ON regexp_matches(host || chr(10) || path, ex)
  GROUP BY host, path
)
SELECT n.page_id, n.host, n.path, b.name AS rule, coalesce(b.name, w.name) AS matched,
       CASE WHEN b.name IS NOT NULL THEN b.verdict WHEN w.name IS NOT NULL THEN 'block'
            ELSE 'allow' END AS verdict
FROM named n LEFT JOIN best b ON n.host = b.host AND n.path = b.path
LEFT JOIN worst w ON n.host = w.host AND n.path = w.path
"""

OP10_SQL = r"""
WITH known AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), last AS (
  SELECT conv_id, max(turn) AS last_turn FROM known WHERE role = 'assistant' GROUP BY conv_id
), reply AS (
  SELECT k.conv_id, min(k.text) AS text FROM known k JOIN last l
    ON k.conv_id = l.conv_id AND k.turn = l.last_turn AND k.role = 'assistant'
  GROUP BY k.conv_id
), rejected AS (
  SELECT k.* FROM known k LEFT JOIN last l ON k.conv_id = l.conv_id
  WHERE l.last_turn IS NULL OR k.turn < l.last_turn
  UNION
  SELECT l.conv_id, l.last_turn, 'assistant', r.text
  FROM last l JOIN reply r ON r.conv_id = xor(l.conv_id, 1)
), c AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS nth FROM known
), r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS nth FROM rejected
), sides AS (
  SELECT conv_id, turn, nth, role, text, 'chosen' AS part FROM c
  UNION ALL SELECT conv_id, turn, nth, role, text, 'rejected' FROM r
), agree AS (
  SELECT conv_id, turn, nth FROM sides GROUP BY conv_id, turn, nth
  HAVING count(*) = 2 AND min(role) = max(role) AND min(text) = max(text)
), split AS (
  SELECT s.conv_id, min(CASE WHEN a.turn IS NULL THEN s.turn END) AS at_turn
  FROM sides s LEFT JOIN agree a USING (conv_id, turn, nth) GROUP BY s.conv_id
), marked AS (
  SELECT DISTINCT s.conv_id, s.turn, s.nth, s.role, s.text,
         CASE WHEN p.at_turn IS NULL OR s.turn < p.at_turn THEN 'prompt' ELSE s.part END AS part
  FROM sides s JOIN split p USING (conv_id)
)
SELECT conv_id AS pair_id, part, turn, CAST(nth AS INTEGER) AS nth, role,
       '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered,
       part <> 'prompt' AND role = 'assistant' AS trained,
       CAST(count(*) FILTER (WHERE part = 'prompt') OVER (PARTITION BY conv_id) AS BIGINT)
         AS prompt_turns
FROM marked
"""


# Every n-gram of every text counted, no summary and no filter.
OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), places AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM worded, (VALUES (1), (2), (3), (4)) s(m) WHERE len(w) >= m
), f AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM places GROUP BY ALL HAVING count(*) >= 30
), phrases AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1
), cuts AS (
  SELECT lang, phrase, a, w, m, unnest(range(1, m)) AS k FROM phrases
), measured AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         CAST(c.a AS HUGEINT) * 2000000 // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), weakest AS (
  SELECT * FROM measured
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), dropped AS (
  SELECT DISTINCT s.lang, s.phrase FROM phrases s JOIN phrases t
    ON s.lang = t.lang AND t.m > s.m AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ')
   AND 100 * CAST(t.a AS HUGEINT) >= 80 * CAST(s.a AS HUGEINT)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM weakest ANTI JOIN dropped USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), ranked AS (
  SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
         row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id
  FROM d WINDOW best AS (PARTITION BY bare ORDER BY length(t) DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM ranked
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sampled_splitters, op2_divergence_rules,
                                    op3_fourier_classifier, op4_super_minhash,
                                    op5_power_of_two_packing, op6_spaced_seeds,
                                    op7_partial_matching, op8_perfect_hash_index, op9_rarest_token_rules,
                                    op10_preference_pairs, op11_misra_gries, op12_progressive_refinement,
                                    op13_jacobi_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op2_divergence_rules": _op2_sql(), "op9_rarest_token_rules": OP9_SQL,
            "op10_preference_pairs": OP10_SQL, "op11_misra_gries": OP11_SQL,
            "op12_progressive_refinement": OP12_SQL}
