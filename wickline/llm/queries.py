"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wickline.llm.base import read
from wickline.llm.byte_bpe import byte_bpe_digests
from wickline.llm.chat_format import canonical_turns, chat_digests, format_turns, turn_rows
from wickline.llm.decontamination import contaminated
from wickline.llm.lexical_search import search
from wickline.llm.line_dedup import line_digests
from wickline.llm import lm_scoring
from wickline.llm.ngram_jaccard import jaccard_components
from wickline.llm.sentencepieces import piece_digests
from wickline.llm.token_counts import token_counts
from wickline.llm.token_files import new_folder, read_tokens, token_digests, write_tokens
from wickline.llm.topk_search import top_k
from wickline.llm.toxicity import toxicity_scores
from wickline.llm.whitening import whiten


def tokenizer_path(name: str) -> str:
    """Where this machine keeps a public vocabulary file; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    return chat_digests(format_turns(canonical_turns(turn_rows(rows.unionByName(extra)))))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = lm_scoring.held_out()
    scores = lm_scoring.lm_scores(read(spark, sf_dir, "documents", "doc_id", "text"), ~held)
    return scores.withColumn("held_out", held)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    write_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), folder, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return token_digests(read_tokens(spark, folder))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts(docs, tokenizer_path("word_bpe_49k.json"), budget=2048).drop("prefix")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"), k=10)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the ranks of a public vocabulary, decoded again, as digests."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe_digests(docs, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding, fitted to the distinct integer vectors."""
    return whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_chat_format": op4_chat_format,
    "op5_topk_search": op5_topk_search,
    "op6_decontamination": op6_decontamination,
    "op7_sentencepieces": op7_sentencepieces,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_files": op9_token_files,
    "op10_token_counts": op10_token_counts,
    "op11_lexical_search": op11_lexical_search,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_whitening": op13_whitening,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": rf"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM word
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.b) AS component_id,
       min(coalesce(c.doc_id, d.doc_id)) AS class_id
FROM documents d LEFT JOIN size USING (doc_id) JOIN reach r ON r.a = d.doc_id
LEFT JOIN (SELECT a, b AS doc_id FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
           WHERE shared = x.n AND shared = y.n AND b < a) c ON c.a = d.doc_id
GROUP BY d.doc_id
""",
    "op2_line_dedup": f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_BLANK}), '{_UPPER}', '{_LOWER}') AS k FROM line
), firsts AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k
), marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> first_doc, false) AS dropped
  FROM keyed LEFT JOIN firsts USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op4_chat_format": rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), named AS (
  SELECT conv_id, turn, text, role,
         length(text) + length(text) - length(replace(text, chr(92), ''))
         + len(regexp_extract_all(text, '\[/?INST\]|</?s>|<</?SYS>>|<\|')) AS written
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(written + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                                    ELSE 11 + length(hex(role)) END) AS BIGINT) AS formatted_chars
FROM named GROUP BY conv_id
""",
    "op5_topk_search": """
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vec q JOIN vec c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
""",
    "op11_lexical_search": rf"""
WITH occurrence AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM occurrence GROUP BY doc_id, term
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), doc AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS own FROM tf GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, CAST(sum(own) AS BIGINT) AS terms FROM doc
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark
), item AS (
  SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term
), weighted AS (
  SELECT item_id, term, times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM item JOIN df USING (term), total
), sized AS (
  SELECT doc_id, 100 - 75 + ((75 * own * docs) // terms) AS m FROM doc, total
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM weighted JOIN tf USING (term) JOIN sized USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
""",
}
