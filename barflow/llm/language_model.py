"""Scores of a word language model: a weighted backoff automaton over counts of the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import (
    ANSWER, ASK, ASKED, CLASSES, Words, ask_dense, chunks_of, count_bucket, in_blocks, mixed, totals_of, unpacked_docs,
)

#: Text bytes for each bucket of counts.
BUCKET_BYTES = 8 << 20
#: Bytes of a sequence's key that travel; the bucket number stands for higher bits.
GRAM_BYTES = 5
#: Sequences longer than two are counted where both of their shorter parts were seen this often in training.
LEAST_SEEN = 2
#: The class that contexts are asked with, which no count reaches.
_CONTEXT = CLASSES - 1
#: Stand for the end of a text, and for what is before its first word.
END, START = mixed(np.array([0x7E57E4D, 0x57A27], np.uint64))

_KEY = np.uint64(0xD6E8FEB86659FD93)

_SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


class Sequences:
    """The tokens of a block's texts: hashes with an end behind each text, the token before each, their text."""

    def __init__(self, table: pa.Table):
        texts = table.column("text").to_pylist()
        train = np.asarray(table.column("train").to_pylist(), bool)
        tokens, sizes = [], []
        for a, b in chunks_of(texts):
            words = Words(texts[a:b])
            tokens.append(np.insert(words.hashes, words.bounds[1:], END))
            sizes.append(words.counts() + 1)
        self.tokens, self.sizes = np.concatenate(tokens), np.concatenate(sizes)
        self.ends = np.cumsum(self.sizes)
        self.before = np.concatenate(([START], self.tokens[:-1]))
        self.before[self.ends[:-1]] = START
        self.train = np.repeat(train, self.sizes)
        self.place = np.arange(len(self.tokens)) - np.repeat(self.ends - self.sizes, self.sizes)  # in its text
        self.pairs = mixed(self.before * _KEY + self.tokens)

    def grams(self, n: int) -> np.ndarray:
        """Hashes of the ``n`` tokens up to each place, the start being one; they are those of one text from place n - 2 on."""
        out = self.pairs
        for _ in range(n - 2):
            out = mixed(np.concatenate((out[:1], out[:-1])) * _KEY + self.tokens)
        return out


def _words_of_block(n_buckets: int):
    def run(packed: pa.Table) -> pa.Table:
        docs = unpacked_docs(packed)
        seen = Sequences(docs)
        keys, inverse = np.unique(seen.tokens, return_inverse=True)
        counts = np.bincount(inverse, weights=seen.train, minlength=len(keys))
        return ask_dense(docs.column("block")[0].as_py(), keys, counts, np.zeros(0, np.uint8), n_buckets, 8)

    return run


def _class_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.uint8)


class Known:
    """The words of a block with their counts in the training texts."""

    def __init__(self, seen: Sequences, totals: np.ndarray):
        self.keys, self.word = np.unique(seen.tokens, return_inverse=True)
        self.count = totals
        trained = int(totals[np.searchsorted(self.keys, END)])  # texts, as each has one end
        self.state = np.concatenate(([len(self.keys)], self.word[:-1]))  # the token before; a start has the last number
        self.state[seen.ends[:-1]] = len(self.keys)
        self.state_count = np.append(totals, trained)


def _pairs_of_block(n_buckets: int):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return ASKED.empty_table()
        docs = unpacked_docs(packed)
        seen = Sequences(docs)
        known = Known(seen, _told(answers, 1))
        keys, first, inverse = np.unique(seen.pairs, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=seen.train, minlength=len(keys))
        classes = _class_of(known.state_count[known.state[first]])
        return ask_dense(docs.column("block")[0].as_py(), keys, counts, classes, n_buckets, GRAM_BYTES)

    return run


class Longer:
    """Sequences of ``n`` > 2 tokens at the places of a block, and the contexts before their last tokens.

    ``shorter`` has the count of the sequence of n - 1 tokens up to each place. A context is a sequence of n - 1
    tokens that was seen twice; the sequences counted are those that end in such a one as well. A context's own
    count is of the places where that holds, so the counts after it add up to it.
    """

    def __init__(self, seen: Sequences, n: int, shorter: np.ndarray):
        before = np.concatenate((np.zeros(1, shorter.dtype), shorter[:-1]))
        self.at = np.flatnonzero((seen.place >= n - 2) & (before >= LEAST_SEEN))
        counted = shorter[self.at] >= LEAST_SEEN
        self.ends = self.at[counted]
        self.contexts, self.grams = seen.grams(n - 1)[self.at - 1], seen.grams(n)[self.ends]
        self.classes = _class_of(before[self.at])
        self._keys = np.concatenate((mixed(self.contexts + np.uint64(n)), self.grams))
        self._weights = np.concatenate((seen.train[self.at] & counted, seen.train[self.ends]))
        self._classes = np.concatenate((np.full(len(self.at), _CONTEXT, np.uint8), self.classes[counted]))

    def ask(self, block: int, n_buckets: int) -> pa.Table:
        keys, first, inverse = np.unique(self._keys, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=self._weights, minlength=len(keys))
        return ask_dense(block, keys, counts, self._classes[first], n_buckets, GRAM_BYTES)

    def told(self, totals: np.ndarray, n_places: int) -> Longer:
        """Take the answers in: counts at each place, of the context before it (``among``) and of the sequence."""
        each = totals[np.unique(self._keys, return_inverse=True)[1]]
        self.among, self.count = np.zeros(n_places, np.int64), np.zeros(n_places, np.int64)
        self.among[self.at], self.count[self.ends] = each[: len(self.at)], each[len(self.at):]
        return self


def _counts_by_order(seen: Sequences, answers: pa.Table, order: int) -> tuple[list[np.ndarray], list[Longer]]:
    """What a block was told of its pairs by place, and of sequences of three to ``order`` tokens."""
    counts = _told(answers, 2)[np.unique(seen.pairs, return_inverse=True)[1]]
    by_order, longer = [counts], []
    for n in range(3, order + 1):
        longer.append(Longer(seen, n, by_order[-1]).told(_told(answers, n), len(seen.tokens)))
        by_order.append(longer[-1].count)
    return by_order, longer


def _told(answers: pa.Table, n: int) -> np.ndarray:
    """The answers about sequences of ``n`` tokens."""
    return totals_of(answers.filter(pc.equal(answers.column("length"), n)), dense=True)


def _longer_of_block(n: int, n_buckets: int):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return ASKED.empty_table()
        docs = unpacked_docs(packed)
        seen = Sequences(docs)
        by_order, _ = _counts_by_order(seen, answers, n - 1)
        return Longer(seen, n, by_order[-1]).ask(docs.column("block")[0].as_py(), n_buckets)

    return run


class Automaton:
    """States are the contexts of a block's texts: sequences of tokens, single words, a text's start, and the root.

    An arc of a state reads a word that followed it in training, with the log10 probability of the word there,
    and leads to the longest state that the context ends in then. For any other word the state's failure arc,
    with its backoff weight, leads to the state of the context without its first token, a word's to the root.
    The root has an arc for every word; those of unknown words lead back to it.

    ``carried`` is the state that the arcs lead to before each place of the block, left to right.
    """

    def __init__(self, seen: Sequences, known: Known, by_order: list[np.ndarray], longer: list[Longer], model: dict):
        n, types = max(model["tokens"], 1), model["types"]
        discount = model["once"] / (model["once"] + 2 * model["twice"]) if model["twice"] else 0.5
        share = np.where(known.count > 0, (known.count - discount) / n, discount * types / n if types else 1.0)
        backoffs = [np.asarray(b) for b in model["backoffs"]]
        self.root = len(known.keys) + 1
        self.root_arcs = np.log10(share)
        following = np.where(known.count > 0, np.arange(len(known.keys)), self.root)
        # By places of the block: the longest state before it and after it, and the word's probability there.
        context = known.state_count[known.state]
        lives, word = context > 0, known.word
        before, after, p = np.where(lives, known.state, self.root), following[word], share[word]
        b = backoffs[0][_class_of(context)]
        p = np.where(lives, (1 - b) * by_order[0] / np.maximum(context, 1) + b * p, p)
        failures, fall = [np.log10(backoffs[0][_class_of(known.state_count)]), [0.0]], [np.full(self.root, self.root), [self.root]]
        arcs, n_states, n_arcs = [], self.root + 1, 0
        #: By length of context: the least state of that length, and at each place the arc there (-1: none).
        self.levels = []

        def arcs_of(count: np.ndarray, least: int) -> None:
            nonlocal n_arcs
            at = np.flatnonzero(count > 0)
            keys = before[at] * (self.root + 1) + word[at]
            order = np.argsort(keys)
            at, keys = at[order], keys[order]
            new = np.diff(keys, prepend=-1) > 0
            arc = np.full(len(count), -1)
            arc[at] = np.cumsum(new) - 1 + n_arcs
            self.levels.append((least, arc))
            arcs.append((keys[new], np.log10(p[at[new]]), after[at[new]]))
            n_arcs += len(arcs[-1][0])

        least = 0
        for count, level, backoff in zip(by_order, longer, backoffs[1:]):
            lives = level.among[level.at] > 0
            at = level.at[lives]
            _, first, number = np.unique(level.contexts[lives], return_index=True, return_inverse=True)
            after[at - 1] = n_states + number
            arcs_of(count, least)
            least = n_states
            b = backoff[level.classes[lives]]
            failures.append(np.log10(b[first]))
            fall.append(before[at[first]])
            before[at] = n_states + number
            p[at] = (1 - b) * level.count[at] / level.among[at] + b * p[at]
            n_states += len(first)
        arcs_of(by_order[-1], least)
        self.failures, self.fall = np.concatenate(failures), np.concatenate(fall)
        # Sorted, as longer contexts have higher numbers.
        self.arcs, self.weights, self.targets = (np.concatenate(c) for c in zip(*arcs))
        self.carried, self.word = before, word

    def scores(self, starts: np.ndarray) -> np.ndarray:
        """One pass over the places of all texts: the carried state's arc, or its failures down to one that has it."""
        total, state, waits = np.zeros(len(self.word)), self.carried.copy(), np.ones(len(self.word), bool)
        for least, arcs in reversed(self.levels):
            here = np.flatnonzero(waits & (state >= least) & (state != self.root))
            arc = arcs[here]
            taken = arc >= 0
            total[here[taken]] += self.weights[arc[taken]]
            waits[here[taken]] = False
            falls = here[~taken]
            total[falls] += self.failures[state[falls]]
            state[falls] = self.fall[state[falls]]
        total[waits] += self.root_arcs[self.word[waits]]
        return np.add.reduceat(total, starts)


def _score_block(order: int):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        docs = unpacked_docs(packed)
        if not docs.num_rows:
            return pa.table({c: [] for c in (
                "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})
        seen = Sequences(docs)
        known = Known(seen, _told(answers, 1))
        by_order, longer = _counts_by_order(seen, answers, order)
        model = {c: answers.column(c)[0].as_py() for c in ("types", "tokens", "once", "twice", "backoffs")}
        automaton = Automaton(seen, known, by_order, longer, model)
        del by_order, longer
        starts = seen.ends - seen.sizes
        scores = automaton.scores(starts)
        count = known.count[known.word]
        base = np.add.reduceat(np.log10(count + 1.0), starts) - seen.sizes * np.log10(
            model["tokens"] + model["types"] + 1.0)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": pa.array(~np.asarray(docs.column("train").to_pylist(), bool)),
            "n_tokens": seen.sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
            "train_tokens": np.full(len(starts), model["tokens"], np.int64), "base_score": base, "score": scores})

    return run


def _backoffs(sequences: DataFrame) -> DataFrame:
    """One row: by class of a context's count, the share of sequences seen once there, the chance of a new one (Good and Turing)."""
    classes = sequences.filter("class_once IS NOT NULL").select(
        F.posexplode(F.arrays_zip("class_once", "class_tokens"))).groupBy("pos").agg(
        F.sum("col.class_once").alias("once"), F.sum("col.class_tokens").alias("tokens"))
    share = F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.col("once") / F.col("tokens")))
    rows = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("tokens") > 0, share).otherwise(F.lit(0.99)).alias("share"))))
    return classes.agg(rows.alias("rows")).select(F.when(F.size("rows") > 0, F.col("rows.share")).otherwise(
        F.array_repeat(F.lit(0.99), CLASSES)).alias("backoff"))


def lm_scores(docs: DataFrame, train: Column, bucket_bytes: int = BUCKET_BYTES, order: int = 3) -> DataFrame:
    """Log10 probabilities of all texts: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` marks the documents to count (null: not). Tokens are the words, A-Z in lower case, and one end for
    each text, so null and empty texts have the end alone. ``base_score`` adds one to each word's count.
    ``score`` is that of an interpolated model of sequences of up to ``order`` tokens (2 or more): a word's own
    probability is its count less an absolute discount, whose mass is for unknown words; after a context it is
    mixed with the share of the word among those that followed the context, and the weight of the mix is the
    share of sequences seen once among contexts as frequent. Contexts of two tokens and more are those seen
    twice or more in training, and of the words after them those count whose last n - 1 tokens were seen twice as
    well; that is part of the model, the same for every text and at every size. Without training texts every
    score is 0. Repeated rows are scored (and counted) each; a null ``doc_id`` is kept; extra columns are ignored;
    an empty table gives no rows.

    Counts are of the whole corpus and never in one place: blocks of documents send their distinct words, then
    pairs, then longer sequences to buckets of key ranges, which sum them and answer each block. A block has the
    arcs that its texts can take. Frequent words arrive once for each block. Words are told apart by 64-bit
    hashes, sequences by 40 bits within their bucket.
    """
    if order < 2:
        raise ValueError(f"order must be at least 2, got {order}")
    with_flag = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("train", F.coalesce(train, F.lit(False)))
    blocks, total = in_blocks(with_flag, keep=("train",))
    n_buckets = max(1, -(-total // bucket_bytes))
    by_block = blocks.groupBy("block")
    words = by_block.applyInArrow(_words_of_block(n_buckets), ASK).groupBy("bucket").applyInArrow(
        count_bucket(8, dense=True), ANSWER)
    model = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "tokens", "once", "twice")]).select(
        "*", F.lit(1).alias("one"), F.array().cast("array<array<double>>").alias("backoffs"))
    answers = words.select("block", "bucket", "totals", F.lit(1).alias("length"))
    for n in range(2, order + 1):
        asking = _pairs_of_block(n_buckets) if n == 2 else _longer_of_block(n, n_buckets)
        told = answers if n == 2 else answers.filter(F.col("length") > 1)  # pairs show what to ask from then on
        counted = by_block.cogroup(told.groupBy("block")).applyInArrow(asking, ASK).groupBy("bucket").applyInArrow(
            count_bucket(GRAM_BYTES, dense=True), ANSWER)
        answers = answers.unionAll(counted.select("block", "bucket", "totals", F.lit(n).alias("length")))
        model = model.join(_backoffs(counted).withColumn("one", F.lit(1)), "one").withColumn(
            "backoffs", F.concat("backoffs", F.array("backoff"))).drop("backoff")  # one row
    told = answers.withColumn("one", F.lit(1)).join(F.broadcast(model), "one").drop("one")
    return by_block.cogroup(told.groupBy("block")).applyInArrow(_score_block(order), _SCORE)
