"""One query per operator, with production parameters, over the whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitymart.llm import common, decontaminate, fingerprint, jaccard_join, language, lexical_search, packing, periodic_runs, quality, repeated_spans, sharding, token_counts, url_filter, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's url ends in the number of its document; urls of labelled documents train the trees."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    document = F.regexp_extract("url", r"://[^?#]*/([0-9]{1,18})(?:[.]html|/)?(?:[?#]|$)", 1).try_cast("long")
    block = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = pages.select("url", document.alias("doc_id")).join(labels, "doc_id").select("url", block.alias("block"))
    return url_filter.judge(pages, RULES, labelled)


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=24)


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=5, least=0.8)
    best = F.max_by(F.struct("similarity", "start", "n_words"), F.struct("similarity", -F.col("start"), "n_words")).alias("_best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "_best.*")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out(F.col("doc_id"))
    names, chances = language.learn(docs.where(~held_out), "text", "lang")
    found = language.identify(docs, names, chances)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages", "shares")


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, threshold=85)


@query
def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


@query
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_folder(spark, "token-ids")
    wavelet.write_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), folder, end_id=1)
    return wavelet.read_documents(spark, folder)


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by its id's crc32, repeats some of its words from a place on to its end."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), []
            for k, text in token_counts.texts_of(batch, 1):
                h = zlib.crc32(str(ids[k]).encode()) if ids[k] is not None else 1
                words = text.encode().split() if h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = b" ".join([*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]).decode()
                texts.append(text)
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    common.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(change, "doc_id long, text string")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_periods(table(spark, sf_dir, "documents")))
    found = found.withColumn("_best", F.expr("array_max(transform(runs, r -> struct(r.length / r.period as exponent, -r.start as start, -r.period as period, r.length as length)))"))
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || chr(10)), '')")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.expr("cast(-_best.start as bigint)").alias("start"),
        F.expr("cast(_best.length as bigint)").alias("length"),
        F.expr("cast(-_best.period as bigint)").alias("period"),
        F.expr("1000L * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op12_ranked_search"] = r"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
     words AS (SELECT d, doc_id, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
     total AS (SELECT count(DISTINCT d) AS n_docs, count(*) AS n_terms FROM words),
     factors AS (SELECT d, doc_id, 50 + (50 * count(*) * any_value(n_docs)) // any_value(n_terms) AS m FROM words, total GROUP BY d, doc_id),
     wanted AS (SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark),
     tfs AS (SELECT d, term, count(*) AS tf FROM words SEMI JOIN wanted USING (term) GROUP BY d, term),
     weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY term),
     scores AS (SELECT item_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
                FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN factors USING (d) GROUP BY item_id, d)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores JOIN factors USING (d) WHERE score > 0 QUALIFY rank <= 50"""

ORACLES["op13_substring_dedup"] = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     windows AS (SELECT doc_id, k, array_to_string(words[k : k + 19], ' ') AS window_text
                 FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS k FROM docs)),
     gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS k
              FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY window_text ORDER BY doc_id, k) AS place FROM windows) WHERE place > 1),
     each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM docs),
     kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k) AS text FROM each ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""
