"""Document quality by hierarchical empirical Bayes: a text classifier's evidence over host and path priors."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Words, chunks_of, lookup, salts, slices
from barflow.session import staged

#: What an unlabelled document's classifier score counts against a label, in its site's sums.
SOFT = 0.1
#: A probability is kept this far from 0 and 1.
EDGE = 1e-4
#: Bounds of the correlation of labels within a site, which decides how far sparse sites shrink.
LEAST_ALIKE, MOST_ALIKE = 1e-3, 0.9

_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_STOP = np.array([chr(b) in ".,;:?!'\"-" for b in range(256)])
FEATURES = ("log_bytes", "letters", "upper", "digits", "stops", "symbols", "word_length", "distinct_words",
            "top_word", "repeated_lines", "log_line_words", "stops_per_word")


def features(texts: list[str | None]) -> np.ndarray:
    """One row of FEATURES for each text; zeros for null and empty texts."""
    out = np.zeros((len(texts), len(FEATURES)))
    for first, last in chunks_of(texts):
        words = Words(texts[first:last])
        for i in range(last - first):
            raw = words.blobs[i]
            if not raw:
                continue
            text = texts[first + i]
            cased = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            n = len(cased)
            counts = np.bincount(cased, minlength=256)
            letters, upper, digits, space, stops = (int(counts[k].sum()) for k in (_LETTER, _UPPER, _DIGIT, _SPACE, _STOP))
            mine = words.hashes[words.bounds[i]: words.bounds[i + 1]]
            n_words = max(len(mine), 1)
            _, repeats = np.unique(mine, return_counts=True)
            lines = Counter(x for x in text.split("\n") if x.strip())
            n_lines = max(sum(lines.values()), 1)
            out[first + i] = (
                np.log1p(n), letters / n, upper / max(letters, 1), digits / n, stops / n,
                (n - letters - digits - space - stops) / n, min(len(raw) / n_words, 50) / 10, len(repeats) / n_words,
                max(repeats, default=0) / n_words, 1 - len(lines) / n_lines, np.log1p(n_words / n_lines),
                min(stops / n_words, 5))
    return out


def _measured(batches):
    for batch in slices(batches):
        flat = features(batch.column("text").to_pylist())
        ends = pa.array(np.arange(len(flat) + 1) * len(FEATURES), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "host", "path")), pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))],
            names=["doc_id", "host", "path", "features"])


def _logit(p: Column) -> Column:
    kept = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), p))
    return F.log(kept / (1 - kept))


def _strength(alike: float | None) -> float:
    """Labels that a prior is worth, from the correlation of labels within a site."""
    alike = min(MOST_ALIKE, max(LEAST_ALIKE, alike or 0.0))
    return 1 / alike - 1


def document_evidence(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """``doc_id, host, path, label, p_text``: labels (null: none) and the text classifier's probability of a good document.

    The classifier is fitted on all labelled documents. With labels of one kind only, every probability is
    that kind's; without labels it is one half. Several labels of a document count as their mean, rounded up.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    measured = base.mapInArrow(_measured, "doc_id bigint, host string, path string, features array<double>")
    known = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("label") >= 0.5).cast("double").alias("label"))
    rows = staged(measured.join(known, "doc_id", "left"), "quality-features")
    kinds = {r[0] for r in rows.filter("label IS NOT NULL").select("label").distinct().collect()}
    if len(kinds) < 2:
        return rows.select("doc_id", "host", "path", "label", F.lit(next(iter(kinds), 0.5)).alias("p_text"))
    vectors = rows.withColumn("vector", array_to_vector("features"))
    model = LogisticRegression(featuresCol="vector", labelCol="label", regParam=1e-3, maxIter=60).fit(
        vectors.filter("label IS NOT NULL").select("vector", "label"))
    return model.transform(vectors).select(
        "doc_id", "host", "path", "label", vector_to_array("probability")[1].alias("p_text"))


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, soft: float = SOFT) -> DataFrame:
    """Probability that each document is good: ``doc_id, p_text, p_host, p_path, p_good, keep``.

    ``labels`` has ``doc_id`` and ``label`` (1: good). A host's share of good documents is shrunk toward the
    share of all, a path's toward its host's; how far comes from how alike the labels within hosts, and within
    paths of a host, are (method of moments). Unlabelled documents add ``soft`` of their classifier score. The
    path's odds against the odds of all then move the classifier's odds. A labelled document's own label is
    taken out of its site's sums. ``keep``: at least one half.

    Null hosts and paths are the empty site. Null and empty texts have all features 0. Repeated rows are scored each; a
    null ``doc_id`` has no label; extra columns are ignored; an empty table gives no rows. Sums are map-side
    combined, and return to rows by salted keys, so a host with a third of all rows is many tasks' work.
    """
    rows = staged(document_evidence(docs, labels, host, path).withColumn(
        "weight", F.when(F.col("label").isNotNull(), 1.0).otherwise(soft)).withColumn(
        "good", F.when(F.col("label").isNotNull(), F.col("label")).otherwise(soft * F.col("p_text"))), "quality-evidence")
    sums = [F.sum("good").alias("good"), F.sum("weight").alias("weight"),
            F.coalesce(F.sum("label"), F.lit(0.0)).alias("k"), F.count("label").alias("n")]
    paths = staged(rows.groupBy("host", "path").agg(*sums), "quality-paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("good", "weight", "k", "n")])
    whole = paths.agg(F.sum("good"), F.sum("weight"), F.sum("k"), F.sum("n")).first()
    mean = whole[0] / whole[1] if whole[1] else 0.5
    share = min(1 - EDGE, max(EDGE, whole[2] / whole[3])) if whole[3] else 0.5
    spread = hosts.filter("n > 0").agg(
        F.sum(F.col("n") * (F.col("k") / F.col("n") - share) ** 2) / (share * (1 - share)),
        F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n").cast("double") ** 2)).first()
    free = (spread[1] or 0) - 1
    room = (spread[2] - spread[3] / spread[2] - free) if spread[2] else 0
    strength = _strength((spread[0] - free) / room if room > 0 else None)
    shrunk = hosts.select("host", F.col("good").alias("host_good"), F.col("weight").alias("host_weight"),
                          ((F.col("good") + strength * mean) / (F.col("weight") + strength)).alias("m"))
    inside = paths.join(shrunk, "host")
    kept = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), F.col("m")))
    within = inside.filter("n > 1").agg(
        F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("m")) ** 2 / (kept * (1 - kept)) - 1) / F.sum(F.col("n") - 1)).first()[0]
    path_strength = _strength(within)
    table = inside.select("host", "path", "host_good", "host_weight", F.col("good").alias("path_good"),
                          F.col("weight").alias("path_weight"))
    met = lookup(rows, table, ["host", "path"], F.struct("doc_id", "p_text"), salts(rows.count(), 64))
    own = lambda c: F.col(f"host_{c}") - F.col(c)
    p_host = (own("good") + strength * mean) / (own("weight") + strength)
    p_path = (F.col("path_good") - F.col("good") + path_strength * F.col("p_host")) / (
        F.col("path_weight") - F.col("weight") + path_strength)
    odds = _logit(F.col("p_text")) + _logit(F.col("p_path")) - _logit(F.lit(mean))
    return met.withColumn("p_host", p_host).withColumn("p_path", p_path).withColumn(
        "p_good", 1 / (1 + F.exp(-odds))).select(
        "doc_id", "p_text", "p_host", "p_path", "p_good", (F.col("p_good") >= 0.5).alias("keep"))
