"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import (
    bbit_minhash, block_anchors, block_max_votes, line_alignment, pivot_topk, prefix_bpe, query_dag, refined_whitening, secret_markov,
    text_density, url_ratio, weak_rules, window_packing,
)
from tabularium.session import written

RULES = (
    url_ratio.Rule("org", "/", "allow"), url_ratio.Rule("example.org", "/es/", "block"),
    url_ratio.Rule("example.org", "/en/1", "block"), url_ratio.Rule("com", "/fr/", "allow"),
    url_ratio.Rule("com", "/de/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_ratio.judge(table(spark, sf_dir, "pages"), RULES)


def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = prefix_bpe.decode(prefix_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("digits", 256).alias("ids_sha256"), F.sha2("text_bytes", 256).alias("decoded_sha256"))


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.groups(table(spark, sf_dir, "documents"), words=2)


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text_density.extract(table(spark, sf_dir, "pages"), keep=("url",))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_alignment.remove(table(spark, sf_dir, "documents"))
    return done.select("_row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op7_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_markov.scan(table(spark, sf_dir, "documents"))
    base = secret_markov.written_out(F.col("base"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"),
                        secret_markov.written_out(F.col("spans")).alias("spans"))


def op8_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # neighbouring rows of a file are a source
    source = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / block_anchors.SOURCE_ROWS))
    done = block_anchors.remove(docs.select("doc_id", "text", source.alias("source")), F.col("source"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents"), store=written)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "posterior")


def op10_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    pieces = window_packing.pack(table(spark, sf_dir, "documents"), definition, public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op11_query_dag(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = query_dag.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = refined_whitening.whiten(table(spark, sf_dir, "embeddings"), 8)
    return done.withColumn("deviation", F.col("deviation").try_cast("long")).withColumnRenamed("id", "vec_id")


def op13_block_max_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = block_max_votes.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~block_max_votes.held_out())
    return done.select(F.col("id").alias("doc_id"), block_max_votes.held_out("id").alias("held_out"), "score", "predicted", "evidence")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_ratio, op2_pivot_topk, op3_prefix_bpe, op4_bbit_minhash, op5_text_density, op6_line_alignment,
                              op7_secret_markov, op8_block_anchors, op9_weak_rules,
                              op10_window_packing, op11_query_dag, op12_refined_whitening, op13_block_max_votes)
}
# A word, a term, and the letters that terms fold
WORDS = r"'[^\x20\x09-\x0D]+'"
TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL: dict[str, str] = {
    "op2_pivot_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.w) = len(q.w) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op4_bbit_minhash": f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS items FROM d),
    x AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, p.b FROM reach JOIN p ON p.a = reach.b), c AS (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)""",
    "op8_block_anchors": f"""WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), {WORDS}) AS w FROM documents),
    i AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS pos FROM d WHERE len(w) >= 35), h AS (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 34], ' ')) AS m FROM i),
    twice AS (SELECT doc_id, pos FROM h WHERE m IN (SELECT m FROM h GROUP BY m HAVING COUNT(*) > 1)), gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(pos, pos + 35)) AS k FROM twice) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(len(ks), 0) AS BIGINT) AS n_removed,
    sha256(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(ks, k)) END, ' ')) AS kept_sha256 FROM d LEFT JOIN gone g ON g.doc_id = d.doc_id""",
    "op11_query_dag": f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all({FOLDED}, {TERMS})) AS term FROM documents),
    f AS (SELECT doc_id, term, COUNT(*) AS tf FROM t GROUP BY doc_id, term), d AS (SELECT doc_id, CAST(SUM(tf) AS BIGINT) AS size FROM f GROUP BY doc_id),
    c AS (SELECT COUNT(*) AS docs, CAST(SUM(size) AS BIGINT) AS total FROM d), i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({FOLDED}, {TERMS})) AS term FROM benchmark),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight FROM f, c WHERE term IN (SELECT term FROM i) GROUP BY term, docs),
    v AS (SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * size * docs) // total))) AS value FROM f JOIN w USING (term) JOIN d USING (doc_id), c),
    s AS (SELECT item_id, doc_id, CAST(SUM(value) AS BIGINT) AS score FROM i JOIN v USING (term) GROUP BY item_id, doc_id HAVING SUM(value) > 0),
    r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s)
    SELECT * FROM r WHERE rank <= 50""",
}
