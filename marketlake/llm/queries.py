"""Registered queries of the training-data operators, each over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (
    ann, hardneg, langid, linededup, mixing, packing, piecewise, prefixtrie, pseudonyms, quality, simhash, substrings, warc,
)
from marketlake.llm.common import find_library

ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_library(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


# The largest source is a web crawl; the others are reference works (up to 9) and forums.
DOMAIN_SQL = """CASE WHEN source = 'src0' THEN 'web'
     WHEN source IN ('src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9') THEN 'reference'
     ELSE 'forum' END"""

MIX = mixing.Mix(
    weights={
        "web": 3, "reference": 4, "forum": 3,
        "web/en": 4, "web/de": 2, "web/fr": 2, "web/es": 2,
        "reference/en": 3, "reference/de": 3, "reference/fr": 2, "reference/es": 2,
        "forum/en": 4, "forum/de": 2, "forum/fr": 2, "forum/es": 2,
    },
    default_weight=1, share=1.0, epochs=3, seed=20240,
)


def op2_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of a document in the mix, with its leaf and epoch."""
    return mixing.mix_table(_table(spark, sf_dir, "documents"), F.expr(DOMAIN_SQL), MIX)


def _dealt_sql(name: str, nodes: str, parent: list[str], child: str) -> str:
    """Common table expressions that deal the parents' budgets (``nodes``: parent, child, cap, budget)."""
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    path = " || '/' || ".join([*parent, child])
    weight = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX.weights.items())
    return f"""
{name}_w AS (SELECT *, CASE {path} {weight} ELSE {MIX.default_weight} END::HUGEINT AS w FROM ({nodes})),
{name}_s AS (
  SELECT *, cap * sum(w) OVER ({part} ORDER BY cap / w::DOUBLE, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= w * (budget - sum(cap) OVER ({part} ORDER BY cap / w::DOUBLE, {child} ROWS UNBOUNDED PRECEDING) + cap) AS full_
  FROM {name}_w
),
{name}_f AS (
  SELECT *, coalesce(sum(cap) FILTER (WHERE full_) OVER ({part}), 0) AS taken,
         sum(w) FILTER (WHERE NOT full_) OVER ({part}) AS others FROM {name}_s
),
{name} AS (
  SELECT * EXCLUDE (budget), CASE WHEN full_ THEN cap ELSE w * (budget - taken) // others END AS budget FROM {name}_f
)"""


ORACLE["op2_mixing_sources"] = f"""
WITH sized AS (
  SELECT doc_id, {DOMAIN_SQL} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents
), leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {MIX.epochs} AS cap
  FROM sized GROUP BY ALL
),{_dealt_sql("d", f"""SELECT domain, sum(cap)::HUGEINT AS cap, (SELECT floor(sum(tokens) * {MIX.share})::HUGEINT FROM leaf)
  AS budget FROM leaf GROUP BY domain""", [], "domain")},{_dealt_sql("l", """SELECT domain, lang, sum(leaf.cap)::HUGEINT AS cap,
  any_value(d.budget) AS budget FROM leaf JOIN d USING (domain) GROUP BY domain, lang""", ["domain"], "lang")},{_dealt_sql("s", """
  SELECT domain, lang, source, leaf.cap, l.budget FROM leaf JOIN l USING (domain, lang)""", ["domain", "lang"], "source")},
plan AS (
  SELECT domain, lang, source, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM s JOIN leaf USING (domain, lang, source)
), ordered AS (
  SELECT z.*, whole, rest, sum(n_tokens) OVER (
      PARTITION BY domain, lang, source
      ORDER BY md5('{MIX.seed}:' || whole || ':' || doc_id), doc_id::VARCHAR ROWS UNBOUNDED PRECEDING) - n_tokens AS begin_
  FROM sized z JOIN plan USING (domain, lang, source)
), used AS (
  SELECT *, (whole + CASE WHEN begin_ < rest THEN 1 ELSE 0 END)::BIGINT AS uses FROM ordered
)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(uses))::INTEGER AS epoch FROM used
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and the digest of the kept text of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs, min_chars=20, min_docs=3))
    return kept.select(
        "doc_id", F.col("__llm_n_lines").alias("n_lines"), F.col("__llm_n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE["op3_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.line, k.pos, s.key IS NOT NULL AND k.doc_id <> s.largest AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


# The queries' own key; a real one belongs into a secret store and comes as the parameter.
PSEUDONYM_KEY = "key of the registered query"


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for personal data, their number and kinds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    kinds = F.coalesce("__llm_kinds", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "text", F.size(kinds).cast("long").alias("n_replaced"),
        F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"),
    )


def tokenizer_files() -> dict[str, str]:
    """Files of the public byte-level BPE, as parameters of ``packing``."""
    import public_tokenizers

    return {
        "json_path": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), **tokenizer_files(), capacity=1024, end_id=2)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness."""
    return piecewise.with_successors(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the texts and languages outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs, folds=4, fold=2), folds=4, fold=2)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), folds=5)
    return quality.classify(docs, model, threshold=0.3, folds=5)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found of every twentieth embedding."""
    return ann.search(_table(spark, sf_dir, "embeddings"), every=20, keep=20)


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and plain-text records of every page."""
    pages = _table(spark, sf_dir, "pages")
    return warc.derivatives(warc.responses_of_pages(pages, "2024-01-01T00:00:00Z"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations: the first turns of every twentieth, then a conversation's own."""
    digests = prefixtrie.turn_digests(_table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    turns = prefixtrie.rebuilt(digests, F.crc32(conv.cast("string").cast("binary")) % 4, conv - conv % 20)
    return prefixtrie.prefix_trie(turns, digests.select("conv_id"))


ORACLE["op11_conversation_trie"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, [ord(c)::UBIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                                    lambda x, z: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))) % 4 AS shared
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT conv_id, place, role, text FROM turns JOIN convs USING (conv_id) WHERE place > shared
  UNION ALL
  SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND place <= shared
), uses AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(role) || md5(text), '') OVER w AS path,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
         left(path, greatest(len(path) - 64, 0)) AS above
  FROM uses GROUP BY path, depth
), children AS (
  SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above
), sums AS (
  SELECT u.path, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.path = n.path JOIN uses u ON u.conv_id = n.conv_id AND u.depth <= n.depth
  GROUP BY u.path
), ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM uses GROUP BY conv_id) GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.above
"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and the digest of the kept words of every document."""
    kept = substrings.drop_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), words=20)
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select(
        "doc_id", F.col("__llm_n_words").alias("n_words"), F.col("__llm_n_removed").alias("n_removed"),
        F.sha2(joined.cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE["op12_substring_dedup"] = """
WITH cut AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, words, unnest(range(len(words) - 19)) AS pos FROM cut
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY md5(array_to_string(words[pos + 1:pos + 20], ' ')) ORDER BY doc_id, pos)
      AS turn FROM windows
  ) WHERE turn > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM cut
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three hard negatives for each of an anchor's five positives; every seventh label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(_table(spark, sf_dir, "embeddings").withColumn("label", label), every=50, positives=5, keep=3)


ORACLE["op13_hard_negatives"] = """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len([x FOR x IN embedding IF isfinite(x)])
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_mixing_sources": op2_mixing_sources,
    "op3_line_dedup": op3_line_dedup,
    "op4_pii_pseudonyms": op4_pii_pseudonyms,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_language_id": op7_language_id,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_warc_derivatives": op10_warc_derivatives,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
