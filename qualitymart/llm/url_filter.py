"""URL verdicts: allow and block rules first, boosted trees on lexical features for what no rule fits.

The trees learn from labelled urls. DataFrame functions and MLlib only, no Python in tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import stored

#: At most this many distinct labelled urls train the trees, taken by a hash of the url.
TRAINED = 200_000
#: Statistics of at most this many last labels are sent to all tasks (32 MB).
SENT = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, where the url's path starts with ``path``."""

    host: str
    path: str
    verdict: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up
    to ``?``, ``#`` or the end. Both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.expr("substring({0}, locate('://', {0}) + 3)".format("_url")))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits (struct of length, rule, verdict), or null."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    fits = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits))


FEATURES = {
    "f_length": "length(_url)",
    "f_host_length": "length(_host)",
    "f_labels": "size(split(_host, '[.]'))",
    "f_depth": "length(_path) - length(replace(_path, '/', ''))",
    "f_last_segment": "length(regexp_extract(_path, '([^/]*)$', 1))",
    "f_digits": "length(regexp_replace(_url, '[^0-9]', '')) / greatest(length(_url), 1)",
    "f_path_digits": "length(regexp_replace(_path, '[^0-9]', ''))",
    "f_parameters": "length(_url) - length(replace(replace(_url, '&', ''), '?', ''))",
    "f_marks": "length(regexp_replace(_url, '[A-Za-z0-9]', '')) / greatest(length(_url), 1)",
    "f_fragment": "cast(locate('#', _url) > 0 as int)",
    "f_secure": "cast(startswith(_url, 'https:') as int)",
    "f_capitals": "length(regexp_replace(_url, '[^A-Z]', ''))",
    # Shannon entropy of the characters in bits: each distinct one by how much shorter the url is without it
    "f_entropy": """aggregate(
        transform(array_distinct(filter(split(_url, ''), c -> c != '')), c -> (length(_url) - length(replace(_url, c, ''))) / length(_url)),
        cast(0 as double), (s, p) -> s - if(p > 0, p * log2(p), 0d))""",
}


def with_features(urls: DataFrame, suffixes: DataFrame, prior: float) -> DataFrame:
    """Lexical features of ``_url``, with the smoothed statistics of the host's last label.

    A few last labels hold nearly all urls, so their statistics go to the urls, unless they are too many for that.
    """
    rates = suffixes.select("_suffix", F.log1p("_n").alias("f_suffix_urls"), ((F.col("_bad") + 10 * prior) / (F.col("_n") + 10)).alias("f_suffix_blocked"))
    rates = F.broadcast(rates) if rates.limit(SENT + 1).count() <= SENT else rates
    rows = urls.withColumns({k: F.expr(v).cast("double") for k, v in FEATURES.items()}).join(rates, "_suffix", "left")
    rows = rows.fillna({"f_suffix_urls": 0.0, "f_suffix_blocked": prior})
    return VectorAssembler(inputCols=[*FEATURES, "f_suffix_urls", "f_suffix_blocked"], outputCol="_features").transform(rows)


def parsed(urls: DataFrame) -> DataFrame:
    """``urls`` (column ``_url``) with ``_host``, ``_path`` and ``_suffix``."""
    host, path = host_and_path(F.col("_url"))
    urls = urls.withColumns({"_host": host, "_path": path})
    return urls.withColumn("_suffix", F.substring_index("_host", ".", -1))


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame, id_column: str = "page_id", url_column: str = "url", trees: int = 20, trained: int = TRAINED) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of every row.

    The longest fitting rule decides; otherwise the trees do, with ``block_score`` their probability of
    block. ``labelled`` has ``url, block`` (boolean); rows with a null label don't count. Statistics of the
    host's last label cover all labelled urls, the trees see ``trained`` distinct ones of them at most. If all
    labels are the same, the verdict is that label; without any label it is allow, with score 0. A null url
    has empty host and path and is judged like an empty one. Repeated rows are returned as often as they
    occur; other columns aren't read. An empty table gives no rows.
    """
    urls = parsed(pages.select(F.col(id_column).alias("_id"), F.coalesce(url_column, F.lit("")).alias("_url")))
    urls = urls.withColumn("_rule", fitting_rule(rules, F.col("_host"), F.col("_path")))
    known = labelled.where(F.col("block").isNotNull()).select(F.coalesce("url", F.lit("")).alias("_url"), F.col("block").cast("double").alias("_block"))
    known = parsed(known)

    suffixes = stored(known.groupBy("_suffix").agg(F.count("_block").alias("_n"), F.sum("_block").alias("_bad")), "suffixes")
    seen = suffixes.agg(F.sum("_n"), F.sum("_bad")).first()
    count, blocked = int(seen[0] or 0), float(seen[1] or 0)
    result = [F.col("_id").alias("page_id"), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule")]
    if blocked in (0, count):
        verdict = F.coalesce("_rule.verdict", F.lit("block" if blocked else "allow"))
        return urls.select(*result, verdict.alias("verdict"), F.lit(1.0 if blocked else 0.0).alias("block_score"))

    # every distinct url and label once, with its rows as the weight; of each label at most half of those the trees see
    distinct = stored(known.groupBy("_url", "_block").agg(F.count(F.lit(1)).cast("double").alias("_weight")), "labelled-urls")
    training = parsed(distinct)
    if distinct.count() > trained:
        half = [distinct.where(F.col("_block") == label).orderBy(F.xxhash64("_url"), "_url").limit(max(1, trained // 2)) for label in (0.0, 1.0)]
        training = parsed(half[0].unionByName(half[1]))
    boosting = GBTClassifier(featuresCol="_features", labelCol="_block", weightCol="_weight", predictionCol="_predicted", maxIter=trees, maxDepth=4, maxBins=64, minInstancesPerNode=10, stepSize=0.1, seed=7)
    model = boosting.setProbabilityCol("_probability").setRawPredictionCol("_raw").fit(with_features(training, suffixes, blocked / count))
    judged = model.transform(with_features(urls, suffixes, blocked / count)).withColumn("_score", vector_to_array("_probability")[1])
    verdict = F.coalesce("_rule.verdict", F.when(F.col("_score") > 0.5, "block").otherwise("allow"))
    return judged.select(*result, verdict.alias("verdict"), F.col("_score").alias("block_score"))
