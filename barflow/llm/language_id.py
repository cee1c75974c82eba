"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from barflow.llm.common import slices

#: Most frequent n-grams of a profile.
PROFILE = 400
#: Profile rows that may be sent to every task: 2,500 languages at PROFILE n-grams.
MOST_ROWS = 1_000_000
#: Distinct n-grams of a language that a task holds before it passes them on.
HELD = 1_000_000
#: Stands for the edge of a word in an n-gram; no letter has this code.
EDGE = 1
UNKNOWN = "und"


def ngrams(text: str) -> np.ndarray:
    """All n-grams of one to three characters of the text's words (runs of letters, lower case) as numbers.

    A number holds up to three code points of 21 bits. Words have an edge on both sides; an edge is part of
    n-grams of two and three characters, at their ends.
    """
    cp = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kinds = np.unique(cp)
    letter = kinds[[chr(c).isalpha() for c in kinds]]
    cp = np.where(np.isin(cp, letter), cp, EDGE)
    cp = cp[np.concatenate(([True], (cp[1:] != EDGE) | (cp[:-1] != EDGE)))]  # one edge between words
    one = cp[cp != EDGE]
    two = (cp[:-1] << 21) | cp[1:]
    middle = cp[1:-1] != EDGE
    three = ((two[:-1] << 21) | cp[2:])[middle]
    return np.concatenate((one, two, three))


def ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by number."""
    grams = np.sort(grams)
    at = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    counts = np.diff(np.append(at, len(grams)))
    return grams[at[np.argsort(-counts, kind="stable")[:size]]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts by language, summed in the task."""
    held: dict[str, list] = {}

    def summed(parts):
        keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)

    def out(lang, part):
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(part[0]), pa.string()), pa.array(part[0]), pa.array(part[1])], names=["lang", "gram", "n"])

    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            keys, counts = np.unique(ngrams(text), return_counts=True)
            parts = held.setdefault(lang, [])
            parts.append((keys, counts))
            if len(parts) >= 200:
                parts[:] = [summed(parts)]
                if len(parts[0][0]) > HELD:
                    yield out(lang, held.pop(lang)[0])
    for lang, parts in held.items():
        yield out(lang, summed(parts))


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The ranked profile of each language in ``lang`` (rows with a null text or language teach nothing).

    Counts are of all rows; only the profiles themselves, of a checked size, come to the driver.
    """
    counts = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(
        _counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    rows = top.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"profiles of over {MOST_ROWS} rows: take fewer languages or smaller profiles")
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Classifier:
    """Out-of-place distances of texts to profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.languages, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([np.array(p, np.int64) for p in profiles.values()] or [np.empty(0, np.int64)]))
        # The last row stands for n-grams that no profile has; a rank below 0 marks a missing one.
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int64)
        for j, lang in enumerate(self.languages):
            self.ranks[np.searchsorted(self.grams, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: first by name), and 1 less its share of the largest distance."""
        grams = ngrams(text) if text else ()
        if len(grams) < 2 or not self.languages:
            return UNKNOWN, 0.0
        mine = ranked(grams, self.size)
        at = np.searchsorted(self.grams, mine)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == mine, at, len(self.grams))
        known = self.ranks[at]
        far = np.where(known < 0, self.size, np.abs(known - np.arange(len(mine))[:, None])).sum(axis=0)
        best = int(np.argmin(far))
        return self.languages[best], 1.0 - float(far[best]) / (self.size * len(mine))


def _sent(docs: DataFrame, profiles: dict[str, list[int]], size: int):
    return docs.sparkSession.sparkContext.broadcast(Classifier(profiles, size))


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone; columns of these names are replaced.

    Texts that are null or have no letter are ``und`` with score 0, as is everything without profiles.
    """
    classifier = _sent(docs, profiles, size)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches):
        for batch in slices(batches):
            found = [classifier.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], names=[*names, "lang_pred", "score"])

    base = docs.select(*names)
    return base.mapInArrow(run, StructType([
        *base.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def keep_identified(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE, min_score: float = 0.0) -> DataFrame:
    """The documents, with their columns, whose text is in a known language with a score over ``min_score``."""
    classifier = _sent(docs, profiles, size)

    def run(batches):
        for batch in slices(batches):
            found = [classifier.value.predict(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([x != UNKNOWN and s > min_score for x, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, held_out: Column, size: int = PROFILE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; documents held out teach nothing.

    A null ``held_out`` (a row without an id) counts as false in the result and teaches nothing either. Repeated
    rows are answered (and counted) each; extra columns are ignored.
    """
    marked = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    profiles = learn_profiles(marked.filter(~F.col("held_out")), size)
    flags = marked.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    return predict(flags, profiles, size).drop("text")
