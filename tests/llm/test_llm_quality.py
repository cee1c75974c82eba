import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from barflow.llm import queries
from barflow.llm.site_quality import document_evidence, features, site_quality

LABELS = "doc_id bigint, label int"


def junk(rng):
    return " ".join(rng.choice(["###", "$$$", "!!", "|"]) + str(rng.randrange(99)) for _ in range(rng.randrange(5, 60)))


@pytest.fixture
def corpus(words):
    """(doc_id, text, host), and which are good: host h0 has a third of the rows, some hosts only a few."""
    rng = random.Random(2)
    rows, good = [], {}
    for i in range(300):
        host = "h0" if i % 3 == 0 else f"h{i % 40}"
        good[i] = rng.random() < (0.9 if host in ("h0", "h4") else 0.4)
        rows.append((i, " ".join(words(rng.randrange(10, 80), i)) + "." if good[i] else junk(rng), host))
    return rows, good


def test_held_out_documents_are_told_apart(docs, spark, corpus):
    rows, good = corpus
    df = docs(rows)  # the host comes in the column lang
    trained = [d for d in good if zlib.crc32(str(d).encode()) % 5]
    labels = spark.createDataFrame([(d, int(good[d])) for d in trained], LABELS)
    out = {r.doc_id: r for r in site_quality(df, labels, F.col("lang"), F.col("source")).collect()}
    held = [d for d in good if d not in set(trained)]
    assert sum(out[d].keep == good[d] for d in held) >= 0.95 * len(held)


def test_sites_shrink_to_what_is_above_them(docs, spark, corpus):
    rows, good = corpus
    df = docs(rows).withColumn("path", F.concat("lang", F.lit("/"), F.pmod("doc_id", F.lit(2))))
    labels = spark.createDataFrame([(d, int(g)) for d, g in good.items() if d % 4], LABELS)
    evidence = document_evidence(df, labels, F.col("lang"), F.col("path")).collect()
    weigh = lambda r: (1.0, r.label) if r.label is not None else (0.1, 0.1 * r.p_text)
    sums = {}
    for r in evidence:
        w, g = weigh(r)
        for key in ((), r.host, r.path):
            a = sums.setdefault(key, [0, 0, 0, 0])
            for i, x in enumerate((w, g, r.label is not None, r.label or 0)):
                a[i] += x
    mean, share = sums[()][1] / sums[()][0], sums[()][3] / sums[()][2]
    hosts = [a for k, a in sums.items() if k and "/" not in k and a[2]]
    spread = sum(a[2] * (a[3] / a[2] - share) ** 2 for a in hosts) / (share * (1 - share))
    n = sum(a[2] for a in hosts)
    alike = (spread - (len(hosts) - 1)) / (n - sum(a[2] ** 2 for a in hosts) / n - (len(hosts) - 1))
    strength = 1 / min(0.9, max(1e-3, alike)) - 1
    of = {k: (sums[k][1] + strength * mean) / (sums[k][0] + strength) for k in sums if k and "/" not in k}
    paths = [(a, min(1 - 1e-4, max(1e-4, of[k.split("/")[0]])), of[k.split("/")[0]]) for k, a in sums.items() if "/" in k and a[2] > 1]
    within = sum(a[2] * (a[3] / a[2] - m) ** 2 / (c * (1 - c)) - 1 for a, c, m in paths) / sum(a[2] - 1 for a, *_ in paths)
    path_strength = 1 / min(0.9, max(1e-3, within)) - 1
    out = {r.doc_id: r for r in site_quality(df, labels, F.col("lang"), F.col("path")).collect()}
    logit = lambda p: math.log(min(1 - 1e-4, max(1e-4, p)) / (1 - min(1 - 1e-4, max(1e-4, p))))
    for r in evidence:
        w, g = weigh(r)
        host, path = sums[r.host], sums[r.path]
        p_host = (host[1] - g + strength * mean) / (host[0] - w + strength)
        p_path = (path[1] - g + path_strength * p_host) / (path[0] - w + path_strength)
        odds = logit(r.p_text) + logit(p_path) - logit(mean)
        got = out[r.doc_id]
        assert (got.p_text, got.p_host, got.p_path, got.p_good) == pytest.approx(
            (r.p_text, p_host, p_path, 1 / (1 + math.exp(-odds))), abs=1e-6)


def test_odd_rows(docs, spark):
    rows = [(1, None, "a"), (2, "", None), (None, "text", "a"), (3, "same same", "b"), (3, "same same", "b"), (4, "x" * 50_000, "b")]
    none = spark.createDataFrame([], LABELS)
    assert [r.p_text for r in site_quality(docs(rows), none, F.col("lang"), F.col("lang")).collect()] == [0.5] * 6
    one = spark.createDataFrame([(3, 1), (3, 1), (None, 0), (4, None)], LABELS)
    out = site_quality(docs(rows), one, F.col("lang"), F.col("lang")).collect()
    assert len(out) == 6 and all(0 <= r.p_good <= 1 and r.keep for r in out)
    mixed = spark.createDataFrame([(3, 1), (4, 0), (1, 0)], LABELS)
    assert all(0 < r.p_good < 1 for r in site_quality(docs(rows), mixed, F.col("lang"), F.col("lang")).collect())
    assert site_quality(docs([]), mixed, F.col("lang"), F.col("lang")).count() == 0
    assert features([None, "", " "])[:2].sum() == 0


def test_the_query_uses_every_label(docs, spark, corpus, tmp_path):
    rows, good = corpus
    df = docs(rows).withColumn("source", F.col("lang")).withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(d, int(g)) for d, g in good.items()], LABELS)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    labels.withColumnRenamed("label", "quality").write.parquet(str(tmp_path / "labels.parquet"))
    found = lambda frame: {r.doc_id: tuple(r)[1:5] for r in frame.collect()}
    out = found(queries.op4_hierarchical_bayes_quality(spark, str(tmp_path)))
    want = found(site_quality(df, labels, F.col("source"), F.concat_ws("/", "source", "lang")))
    assert out.keys() == want.keys() == good.keys()
    for d in good:
        assert out[d] == pytest.approx(want[d], abs=1e-6)
