"""URL filters: rules first, else a logistic regression on hashed character n-grams (operator 2).

Only DataFrame functions and Spark's own logistic regression are used. A labelled URL table of at most
``MAX_LABELLED`` rows trains the model; scoring is a projection over the pages, without a shuffle.

``weak_labels`` makes such a table from pages that rules judge: URLs that a rule blocks count as block, all others as
allow, a bounded sample of each (positive and unlabelled examples), so the model blocks what looks like blocked URLs.

Edge cases: a null URL, or one without ``://``, has empty host and path and is judged by the model like any other
pair; equal URLs get equal verdicts; a labelled table that is empty or knows one verdict only allows everything; other
columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 4_000
CELLS = 1 << 13
SIZES = (3, 4)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith("host", F.lit("." + self.host))
        return host & F.startswith("path", F.lit(self.path))


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    cut = pages.select("page_id", "url", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), UPPER, LOWER)
    return cut.select("page_id", "url", host.alias("host"), F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))


def first_fit(rules: list[Rule], what: str) -> Column:
    """``what`` (text or verdict) of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(), F.lit(getattr(r, what))) for r in ordered])


def grams() -> Column:
    """Character n-grams of host and path, each marked with its part; ends are marked with a blank."""

    def of(part: str) -> list[Column]:
        padded = F.concat(F.lit(f"{part[0]}: "), F.col(part), F.lit(" "))
        shifted = lambda n: F.transform(F.sequence(F.lit(3), F.greatest(F.length(padded) - n + 1, F.lit(3))), lambda i: F.concat(F.lit(part[0]), F.substring(padded, i, F.lit(n))))
        return [shifted(n) for n in SIZES]

    return F.array_distinct(F.concat(*of("host"), *of("path")))


def features(parts: DataFrame) -> DataFrame:
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=CELLS, binary=True)
    return hashed.transform(parts.withColumn("grams", grams())).drop("grams")


def weak_labels(parts: DataFrame, rules: list[Rule], most: int = MAX_LABELLED) -> DataFrame:
    """host, path and verdict of at most ``most`` different URLs: half of them blocked by a rule and half others, each
    those of the smallest hashes, so that blocked URLs are found however rare they are."""
    verdict = F.when(first_fit(rules, "verdict") == "block", "block").otherwise("allow")
    known = parts.select("host", "path").groupBy("host", "path").agg(F.xxhash64("host", "path").alias("place"))
    known = known.withColumn("verdict", verdict)
    chosen = [known.filter(F.col("verdict") == v).orderBy("place", "host", "path").limit(most // 2) for v in ("block", "allow")]
    return chosen[0].union(chosen[1]).select("host", "path", "verdict")


def train(labelled: DataFrame) -> LogisticRegressionModel | None:
    """A model of P(block) from host, path and verdict; verdicts weigh alike whatever their numbers."""
    counts = {r["verdict"]: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    block, allow = counts.get("block", 0), counts.get("allow", 0)
    if not block or not allow:
        return None
    is_block = F.col("verdict") == "block"
    rows = features(labelled.filter(F.col("verdict").isin("block", "allow")))
    rows = rows.select("features", is_block.cast("double").alias("label"), F.when(is_block, 0.5 / block).otherwise(0.5 / allow).alias("weight"))
    return LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60).fit(rows.coalesce(1))


def judge(pages: DataFrame, rules: list[Rule], model: LogisticRegressionModel | None) -> DataFrame:
    """page_id, host, path, rule, verdict and score (P(block), null where a rule decides)."""
    parts = with_parts(pages).withColumn("rule", first_fit(rules, "text")).withColumn("ruled", first_fit(rules, "verdict"))
    if model is None:
        scored = parts.withColumn("p", F.lit(0.0))
    else:
        scored = model.transform(features(parts)).withColumn("p", vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias("verdict")
    return scored.select("page_id", "host", "path", "rule", verdict, F.when(F.col("ruled").isNull(), F.col("p")).alias("score"))
