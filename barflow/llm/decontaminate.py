"""Benchmark decontamination: a BM25 index of test items, asked with every passage by block-max WAND."""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Words, chunks_of, slices
from barflow.session import staged, work_dir

#: BM25's term saturation and length normalization.
K1, B = 1.2, 0.75
#: An item is retrieved if a passage has this share of the score that the item gives itself.
SHARE = 0.6
#: Shares of the question's shingles and of the answer's words that a passage must have.
QUESTION, ANSWER = 0.6, 0.6
#: Words of a shingle.
SHINGLE = 5
#: Items of an index block, whose largest weights bound what a block can score.
BLOCK = 4
#: Passages have twice these words and begin at every multiple of them; for longer items 2, 4, 8 ... times as many.
STRIDE = 64
#: Item text that is indexed together. A larger benchmark is asked part by part, one after the other.
INDEX_BYTES = 8 << 20
#: Bounds of passages and blocks that are added up at a time.
CELLS = 1 << 21

#: Words are runs of ASCII letters and digits and of other than ASCII characters.
_APART = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])
_SENTENCE = re.compile(r"(?<=[.?!])\s+")
_HIT = "doc_id bigint, item_id bigint, bm25_share double, question_overlap double, answer_overlap double"


def _words(texts: list[str | None]) -> Words:
    return Words([t if t is None else t.lower() for t in texts], _APART)


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence of an item is its answer; an item of one sentence is cut in the middle of its words."""
    parts = _SENTENCE.split(text.strip())
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    return " ".join(words[: -(-len(words) // 2)]), " ".join(words[-(-len(words) // 2):])


def _shingles(words: np.ndarray) -> set[tuple]:
    n = min(SHINGLE, len(words))
    w = words.tolist()
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if n else set()


def stride_of(n_words: int) -> int:
    """Words between the passages that an item is looked for in: the least class a quarter longer than the item."""
    stride = STRIDE
    while 4 * stride < 5 * n_words:
        stride *= 2
    return stride


class Corpus(NamedTuple):
    """What the weights take from the whole benchmark, however many indexes it has; ``terms`` are sorted."""

    n_items: int
    n_words: int
    terms: np.ndarray
    df: np.ndarray


def _split(texts: list[str | None]) -> tuple[list[tuple[str, str]], Words]:
    """Question and answer of each item, and the words of both."""
    split = [question_and_answer(t) if t else ("", "") for t in texts]
    return split, _words([f"{q} {a}" for q, a in split])


class Index:
    """Postings of test items of one length class, with block maxima, in arrays that grow with the items' words.

    The weight of a word in an item is its BM25 contribution over the sum that the item gives itself, so that a
    passage's score is the share of the item it covers, and one threshold holds for all items. Without
    ``corpus`` the items are the whole benchmark.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], corpus: Corpus | None = None):
        split, words = _split([t for _, t in items])
        filled = np.flatnonzero(words.counts())
        self.ids = [items[i][0] for i in filled]
        sequences = [words.hashes[words.bounds[i]: words.bounds[i + 1]] for i in filled]
        #: The items' words, one after the other, and the words of each one's question.
        self.words = np.concatenate(sequences) if sequences else np.empty(0, np.uint64)
        self.bounds = np.concatenate(([0], np.cumsum([len(s) for s in sequences], dtype=np.int64)))
        self.asked = _words([split[i][0] for i in filled]).counts()
        self.terms = np.unique(self.words)
        self.n_blocks = -(-len(sequences) // BLOCK)
        counted = [np.unique(np.searchsorted(self.terms, s), return_counts=True) for s in sequences]
        empty = [np.empty(0, np.int64)]
        term = np.concatenate([t for t, _ in counted] or empty)
        if corpus is None:
            corpus = Corpus(len(sequences), len(self.words), self.terms, np.bincount(term, minlength=len(self.terms)))
        self.stride = stride_of(max(map(len, sequences), default=0))
        df = corpus.df[np.searchsorted(corpus.terms, self.terms)]
        idf = np.log1p((corpus.n_items - df + 0.5) / (df + 0.5))
        mean = corpus.n_words / max(corpus.n_items, 1)
        weights = []
        for s, (terms, counts) in zip(sequences, counted):
            weight = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(s) / mean))
            weights.append(weight / math.fsum(weight))
        item = np.repeat(np.arange(len(sequences)), [len(t) for t, _ in counted])
        order = np.lexsort((item, term, item // BLOCK))
        #: The postings by block, term and item, and where each block's begin.
        self.term, self.item = term[order], item[order]
        self.weight = np.concatenate(weights or [np.empty(0)])[order]
        self.block = np.searchsorted(self.item // BLOCK, np.arange(self.n_blocks + 1))
        first = np.flatnonzero(np.diff(self.item // BLOCK * len(self.terms) + self.term, prepend=-1))
        most = np.maximum.reduceat(self.weight, first) * (1 + 1e-6) if len(first) else np.empty(0)
        by_term = np.argsort(self.term[first], kind="stable")
        #: Of each term, the blocks that hold it and its largest weight there, and where each term's begin.
        self.held, self.most = (self.item[first] // BLOCK)[by_term], most[by_term]
        self.starts = np.searchsorted(self.term[first][by_term], np.arange(len(self.terms) + 1))

    def question(self, item: int) -> np.ndarray:
        return self.words[self.bounds[item]: self.bounds[item] + self.asked[item]]

    def answer(self, item: int) -> np.ndarray:
        return self.words[self.bounds[item] + self.asked[item]: self.bounds[item + 1]]

    def search(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """WAND over one block: the items that reach the threshold with these terms.

        Cursors stand at the terms' next items, in item order. The first items at which the terms' bounds add
        up to the threshold is the pivot; cursors before it move there unscored.
        """
        a, b = self.block[block], self.block[block + 1]
        first, last = (a + np.searchsorted(self.term[a:b], terms, side) for side in ("left", "right"))
        lists = []
        for x, y in zip(first.tolist(), last.tolist()):
            if x < y:
                weights = self.weight[x:y].tolist()
                lists.append((list(zip(self.item[x:y].tolist(), weights)), max(weights) * (1 + 1e-6)))
        at = [0] * len(lists)
        live = list(range(len(lists)))
        found = []
        while True:
            live = sorted((i for i in live if at[i] < len(lists[i][0])), key=lambda i: lists[i][0][at[i]][0])
            bound, pivot = 0.0, None
            for i in live:
                bound += lists[i][1]
                if bound >= threshold:
                    pivot = lists[i][0][at[i]][0]
                    break
            if pivot is None:
                return found
            if lists[live[0]][0][at[live[0]]][0] == pivot:
                met = []
                for i in live:
                    item, weight = lists[i][0][at[i]]
                    if item != pivot:
                        break
                    met.append(weight)
                    at[i] += 1
                score = math.fsum(met)  # in whatever order the block's other items leave the cursors
                if score >= threshold:
                    found.append((pivot, score))
            else:
                for i in live:
                    postings = lists[i][0]
                    if postings[at[i]][0] >= pivot:
                        break
                    while at[i] < len(postings) and postings[at[i]][0] < pivot:
                        at[i] += 1

    def hits(self, words: Words) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap): the verified items of each text's passages."""
        stride = self.stride
        if self.n_blocks:
            at = np.searchsorted(self.terms, words.hashes)
            at[at == len(self.terms)] = 0
            term = np.where(self.terms[at] == words.hashes, at, -1)
            # A word lies in the passage that begins at its multiple of the stride, and in the one before.
            size = words.counts()
            place = np.arange(len(term)) - np.repeat(words.bounds[:-1], size)
            n_cells = size // stride + 1
            start = np.concatenate(([0], np.cumsum(n_cells)))
            cell = np.repeat(start[:-1], size) + place // stride
            known = np.flatnonzero(term >= 0)
            passage = np.concatenate((cell[known], cell[known][place[known] >= stride] - 1))
            terms = np.concatenate((term[known], term[known][place[known] >= stride]))
            keys = np.unique(passage * len(self.terms) + terms)
            passage, terms = keys // len(self.terms), keys % len(self.terms)
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            for x, y, block in self._candidates(passage, terms):
                p = int(passage[x])
                text = int(np.searchsorted(start, p, side="right")) - 1
                found = self.search(terms[x:y].tolist(), block, SHARE)
                if found:
                    begin = words.bounds[text] + (p - start[text]) * stride
                    inside = words.hashes[begin: min(begin + 2 * stride, words.bounds[text + 1])]
                    self._verify(best, text, found, inside)
            for (text, item), scores in best.items():
                yield text, item, *scores

    def _candidates(self, passage: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first row, end, block): the blocks whose bounds for a passage's terms reach the threshold.

        Only the blocks that hold a term are added up, for as many whole passages at a time as CELLS allows.
        """
        first = np.flatnonzero(np.diff(passage, prepend=-1))
        end = np.append(first[1:], len(passage))
        spread = np.diff(self.starts)[terms]
        cost = np.concatenate(([0], np.cumsum(spread)))
        i = 0
        while i < len(first):
            j = int(np.searchsorted(cost[end], cost[first[i]] + CELLS, side="right"))
            j = max(i + 1, min(j, i + CELLS // self.n_blocks))
            a, b = first[i], end[min(j, len(first)) - 1]
            n = spread[a:b]
            at = np.arange(n.sum()) + np.repeat(self.starts[terms[a:b]] - cost[a:b] + cost[a], n)
            row = np.repeat(np.searchsorted(first, np.arange(a, b), side="right") - 1 - i, n)
            bounds = np.bincount(row * self.n_blocks + self.held[at], self.most[at])
            for cell in np.flatnonzero(bounds >= SHARE).tolist():
                row_, block = divmod(cell, self.n_blocks)
                yield int(first[i + row_]), int(end[i + row_]), block
            i = j

    def _verify(self, best, text: int, found, inside: np.ndarray) -> None:
        have: dict[int, set] = {}
        bag = set(inside.tolist())
        for item, score in found:
            question = _shingles(self.question(item))
            q = 1.0  # of an item without a question the answer alone decides
            if question:
                n = len(next(iter(question)))
                if n not in have:
                    w = inside.tolist()
                    have[n] = {tuple(w[i: i + n]) for i in range(len(w) - n + 1)}
                q = len(question & have[n]) / len(question)
            answer = set(self.answer(item).tolist())
            a = len(answer & bag) / len(answer) if answer else 1.0
            if q >= QUESTION and a >= ANSWER:
                known = best.get((text, item))
                if known is None or (score, q, a) > known:
                    best[text, item] = (score, q, a)


def _with_words(batches):
    for batch in slices(batches):
        _, words = _split(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("part", "item_id", "text")),
             pa.ListArray.from_arrays(pa.array(words.bounds, pa.int32()), pa.array(words.hashes.view(np.int64)))],
            names=["part", "item_id", "text", "words"])


class Part(list):
    """The indexes of a part of the benchmark, one for each length class of its items."""

    def hits(self, texts: list[str | None]) -> list[tuple]:
        """(text, item id, score, question overlap, answer overlap) of each item found."""
        found = []
        for first, last in chunks_of(texts):
            words = _words(texts[first:last])
            found += [(first + t, index.ids[i], *scores) for index in self for t, i, *scores in index.hits(words)]
        return found


def parts(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> tuple[int, Iterator[Part]]:
    """How many parts a benchmark has, and these, each of about ``index_bytes`` of items; items without text are left out.

    Document frequencies, mean length and number of items are those of the whole benchmark, and an item's passages
    depend on its own length, so its figures do not depend on the items it shares a part with. Indexes are
    built in tasks; the driver passes them on one by one.
    """
    items = benchmark.selectExpr("CAST(item_id AS bigint) AS item_id", "text").filter("octet_length(text) > 0")
    n = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // index_bytes)
    if not n:
        return 0, iter(())
    items = staged(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")).mapInArrow(
        _with_words, "part int, item_id bigint, text string, words array<bigint>").filter("size(words) > 0"), "test-items")
    n_items, n_words = items.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    terms = items.select("part", F.explode(F.array_distinct("words")).alias("term")).groupBy("part", "term").count()
    df = terms.groupBy("term").agg(F.sum("count").alias("df"))

    def build(mine: pa.Table, known: pa.Table) -> pa.Table:
        term = known.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term)
        corpus = Corpus(n_items, n_words, term[order], known.column("df").to_numpy()[order])
        classes: dict[int, list] = {}
        for item, text, size in zip(*(mine.column(c).to_pylist() for c in ("item_id", "text", "size"))):
            classes.setdefault(stride_of(size), []).append((item, text))
        built = Part(Index(sorted(rows, key=lambda r: (r[0] is None, r)), corpus) for _, rows in sorted(classes.items()))
        return pa.table({"part": pa.array([mine.column("part")[0].as_py()], pa.int32()),
                         "index": pa.array([pickle.dumps(built)], pa.binary())})

    built = staged(items.select("part", "item_id", "text", F.size("words").alias("size")).groupBy("part").cogroup(
        terms.select(F.col("part").alias("of"), "term").join(df, "term").groupBy("of")).applyInArrow(build, "part int, index binary"),
        "test-indexes")

    def each() -> Iterator[Part]:
        for part in range(n):
            for row in built.filter(F.col("part") == part).select("index").collect():  # one row, of index_bytes of items
                yield pickle.loads(row[0])

    return n, each()


def _found(docs: DataFrame, benchmark: DataFrame, index_bytes: int, text_key: bool = False) -> DataFrame:
    """A row for each document and item found, part of the benchmark by part: one part is in the tasks at a time."""
    spark = docs.sparkSession
    base = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    names = ["doc_id", "item_id", "bm25_share", "question_overlap", "answer_overlap"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    path = work_dir(spark, "leaks")
    schema = _HIT + (", sha binary" if text_key else "")
    spark.createDataFrame([], schema).write.parquet(path)
    for part in parts(benchmark, index_bytes)[1]:
        sent = spark.sparkContext.broadcast(part)  # bounded by index_bytes

        def run(batches, sent=sent):
            for batch in slices(batches):
                ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
                rows = [(t, (ids[t], *scores)) for t, *scores in sent.value.hits(texts)]
                columns = [pa.array([r[i] for _, r in rows], kind) for i, kind in enumerate(kinds)]
                if text_key:
                    columns.append(pa.array([hashlib.sha256(texts[t].encode("utf-8", "surrogatepass")).digest() for t, _ in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *["sha"] * text_key])

        base.mapInArrow(run, schema).write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)


def contaminated(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``doc_id, item_id, bm25_share, question_overlap, answer_overlap``: one row for each document and item found.

    Every passage of every document is a query: windows of twice the stride, which is at least a quarter longer than
    the item (64 words, or 2, 4, 8 ... times as many), so each place where an item may stand lies in one whole
    window. Retrieval is exact above the threshold. A document's figures are those of its best passage by score. Case
    and punctuation do not matter. Null and empty texts have no passage; items without a word are never found;
    of an item whose question has no word, the answer alone decides. Repeated rows are answered each; rows
    without an id are answered under a null id, and ids must be whole numbers; extra columns are ignored; an empty
    table on either side gives no rows.
    """
    return _found(docs, benchmark, index_bytes)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The documents in which no item is found, with all their columns.

    Where one part holds the whole benchmark the tasks decide on the documents as they read them. Beyond that the
    documents found are noted part by part, by id and text, and taken out at the end.
    """
    n, each = parts(benchmark, index_bytes)
    if n > 1:
        bad = _found(docs, benchmark, index_bytes, text_key=True).select(F.col("doc_id").alias("_id"), F.col("sha").alias("_of")).distinct()
        marked = docs.withColumn("_sha", F.unhex(F.sha2("text", 256)))
        return marked.join(bad, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_of")), "left_anti").select(
            *docs.columns)
    for part in each:
        sent = docs.sparkSession.sparkContext.broadcast(part)  # bounded by index_bytes

        def run(batches, sent=sent):
            for batch in slices(batches):
                bad = {t for t, *_ in sent.value.hits(batch.column("text").to_pylist())}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
