"""Token counts without token ids: every distinct pre-token is counted once.

A text's number of tokens is the sum, over its pre-tokens, of how often each occurs times the pieces it
has. The pieces of a pre-token depend on nothing else, so they are counted once per distinct pre-token
of the corpus and joined to the frequencies in each document.

The join is skewed by nature: a few pre-tokens are in every document. Those that make up at least
``1 / HEAD`` of all occurrences (so there are at most ``HEAD`` of them, whatever the corpus) are sent to
the tasks and joined where the document is; the others, each rare, meet their documents in a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import small_batches, stored
from qualitymart.llm.tokens import load

#: At most this many pre-tokens of at most this many characters are sent to the tasks.
HEAD, HEAD_CHARS = 1 << 20, 64
#: Distinct pre-tokens a task holds before it passes their counts on.
HELD = 200_000


def texts_of(batch: pa.RecordBatch, column: int, rows: int = 256) -> Iterator[tuple[int, str]]:
    """Row numbers and texts of a batch, a few rows as Python strings at a time; null is empty."""
    for start in range(0, batch.num_rows, rows):
        for k, text in enumerate(batch.column(column).slice(start, rows).to_pylist()):
            yield start + k, text or ""


def corpus_pretokens(texts: DataFrame, path: str) -> DataFrame:
    """``pretoken, occurrences`` over all texts (column ``_text``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = load(path), Counter()

        def told() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["pretoken", "n"])
            seen.clear()
            return out

        for batch in batches:
            for _, text in texts_of(batch, 0):
                seen.update(encoder.pretokens(text))
                if len(seen) > HELD:
                    yield told()
        yield told()

    rows = texts.select("_text").mapInArrow(count, "pretoken string, n long")
    return rows.groupBy("pretoken").agg(F.sum("n").alias("occurrences"))


def pretoken_pieces(pretokens: DataFrame, path: str) -> DataFrame:
    """``pretokens`` with the number of pieces of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for batch in batches:
            pieces = encoder.pieces(batch.column(0).to_pylist())
            yield pa.record_batch([*batch.columns, pa.array(pieces, pa.int32())], ["pretoken", "occurrences", "pieces"])

    return pretokens.mapInArrow(count, "pretoken string, occurrences long, pieces int")


def count_tokens(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``path`` is a tokenizers file. A null text counts as empty: 0 bytes, 0 tokens. Rows that repeat an id
    are told apart by their text; a row that occurs several times is returned as often. A null id is
    returned as null. No other column of ``docs`` is read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_column).alias("_id"), F.coalesce(text_column, F.lit("")).alias("_text"))
    id_type = texts.schema["_id"].dataType.simpleString()

    pieces = stored(pretoken_pieces(corpus_pretokens(texts, path), path), "pretokens")
    total = pieces.agg(F.sum("occurrences")).first()[0] or 0
    frequent = (F.col("occurrences") * F.lit(HEAD) >= F.lit(total)) & (F.length("pretoken") <= HEAD_CHARS)
    head = {r[0]: r[1] for r in pieces.where(frequent).select("pretoken", "pieces").toLocalIterator()}
    sent = spark.sparkContext.broadcast(head)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens of the head's pre-tokens; the others with their frequencies."""
        encoder, known = load(path), sent.value
        for batch in batches:
            tokens, rest, counts = [], [], []
            for _, text in texts_of(batch, 1):
                found = Counter(encoder.pretokens(text))
                others = {p: n for p, n in found.items() if p not in known}
                tokens.append(sum(n * known[p] for p, n in found.items() if p in known))
                rest.append(list(others))
                counts.append(list(others.values()))
            out = [batch.column(0), batch.column(2), batch.column(3), pa.array(tokens, pa.int64()), pa.array(rest, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.record_batch(out, ["_id", "_key", "n_bytes", "tokens", "rest", "counts"])

    keyed = texts.withColumns({"_key": F.xxhash64("_text"), "n_bytes": F.octet_length("_text").cast("long")})
    schema = f"_id {id_type}, _key long, n_bytes long, tokens long, rest array<string>, counts array<int>"
    found = stored(keyed.mapInArrow(look_up, schema), "pretoken-frequencies")
    rare = found.select("_id", "_key", F.explode(F.arrays_zip("rest", "counts")).alias("_p"))
    rare = rare.select("_id", "_key", F.col("_p.rest").alias("pretoken"), F.col("_p.counts").alias("_n"))
    summed = rare.join(pieces.where(~frequent).select("pretoken", "pieces"), "pretoken").select(
        "_id", "_key", (F.col("_n").cast("long") * F.col("pieces")).alias("tokens"), F.lit(None).cast("long").alias("n_bytes"), F.lit(0).alias("_row")
    )
    both = found.select("_id", "_key", "tokens", "n_bytes", F.lit(1).alias("_row")).unionByName(summed)
    per_text = both.groupBy("_id", "_key").agg(F.sum("tokens").alias("_tokens"), F.max("n_bytes").alias("n_bytes"), F.sum("_row").alias("_rows"))
    rows = per_text.select(
        F.col("_id").alias("doc_id"),
        "n_bytes",
        F.expr("_tokens div _rows").alias("n_tokens"),
        F.explode(F.expr("array_repeat(0, cast(_rows as int))")).alias("_copy"),
    )
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
