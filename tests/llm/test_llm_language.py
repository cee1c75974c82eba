import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barflow.llm.language_id import Classifier, identify, keep_identified, learn_profiles, ngrams, predict, ranked
from barflow.llm.language_model import END, START, lm_scores
from barflow.llm.queries import fold

TONGUES = {"aa": "ba na ta lo mi ka", "bb": "schr ung keit ver ein", "cc": "ción ñue ado llo esa"}


def speech(lang, n, seed):
    rng = random.Random(seed)
    parts = TONGUES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def grams(text):
    """N-grams as strings, by the definition."""
    out = []
    word = ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            edged = f"_{word}_"
            out += list(word)
            out += [edged[i: i + 2] for i in range(len(edged) - 1)]
            out += [edged[i: i + 3] for i in range(len(edged) - 2)]
            word = ""
    return out


def test_ngrams_are_those_of_the_words():
    for text in ["Ab c", "é1é  x", "...", "", "İstanbul ǅ", "a" * 50, "中文 字"]:
        name = lambda g: "".join("_" if c == 1 else chr(c) for c in (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF) if c)
        assert Counter(map(name, ngrams(text).tolist())) == Counter(grams(text)), text


def test_distances_are_out_of_place():
    profiles = {lang: ranked(ngrams(speech(lang, 400, 1)), 50).tolist() for lang in TONGUES}
    classifier = Classifier(profiles, 50)
    for seed in range(30):
        text = speech(random.Random(seed).choice(list(TONGUES)), 1 + seed % 7, seed)
        mine = ranked(ngrams(text), 50).tolist()
        far = {lang: sum(abs(r - p.index(g)) if g in p else 50 for r, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert classifier.predict(text) == (best, pytest.approx(1 - far[best] / (50 * len(mine))))


def test_languages_of_documents_held_out(docs):
    rows = [(i, speech(lang, 3 + i % 40, i), lang) for i, lang in enumerate(list(TONGUES) * 60)]
    rows += [(500, None, "aa"), (501, "", "aa"), (502, "12 ... !", "bb"), (503, speech("cc", 20, 3), None), (None, speech("bb", 9, 4), "bb"),
             (504, speech("aa", 5000, 7), "aa"), (0, rows[0][1], "aa")]
    out = identify(docs(rows), fold(5) == 0).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    for d, text, lang in rows:
        assert by[d].held_out == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= by[d].score <= 1
    for d in (500, 501, 502):
        assert (by[d].lang_pred, by[d].score) == ("und", 0.0)
    assert by[503].lang_pred == "cc" and by[None].lang_pred == "bb" and by[504].lang_pred == "aa"
    held = [(by[d].lang_pred, lang) for d, _, lang in rows[:180] if by[d].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_profiles_hold_whole_counts(docs):
    rows = [(i, speech("aa", 50, i), "aa") for i in range(30)] + [(99, None, "aa"), (98, "Q", None)]
    want = Counter(g for _, t, lang in rows if t and lang for g in ngrams(t).tolist())
    order = sorted(want, key=lambda g: (-want[g], g))
    assert learn_profiles(docs(rows), 20) == {"aa": order[:20]}


def test_predictions_replace_columns_and_the_filter_keeps_them(docs):
    df = docs([(1, "na lo", "aa"), (2, "77", "aa"), (3, None, "aa")])
    profiles = learn_profiles(df)
    assert predict(df, profiles).columns == [c for c in df.columns if c != "score"] + ["lang_pred", "score"]
    kept = keep_identified(df, profiles)
    assert kept.schema == df.schema and [r.doc_id for r in kept.collect()] == [1]
    assert [r.lang_pred for r in predict(df, {}).collect()] == ["und"] * 3
    assert identify(docs([]), fold(5) == 0).count() == 0


def model(rows, trained, order):
    """The model of sequences by its definition."""
    texts = [[w.lower() for w in (t or "").encode().split()] + ["$"] for _, t in rows]
    taught = [t for t, k in zip(texts, trained) if k]
    ones = Counter(w for t in taught for w in t)
    n, types = sum(ones.values()), len(ones)
    n1, n2 = (sum(c == k for c in ones.values()) for k in (1, 2))
    discount = n1 / (n1 + 2 * n2) if n2 else 0.5
    share = lambda w: (ones[w] - discount) / n if ones[w] else discount * types / n
    count, among, size = {}, {}, {}  # by order: sequences, contexts by counted followers, and by all
    for k in range(2, order + 1):
        count[k], among[k] = Counter(), Counter()
        size[k] = {(w,): c for w, c in {**ones, "^": ones["$"]}.items()} if k == 2 else count[k - 1]
        for t in taught:
            line = ("^", *t)
            for i in range(len(line) - k + 1):
                g = line[i: i + k]
                if k == 2 or (count[k - 1][g[:-1]] >= 2 and count[k - 1][g[1:]] >= 2):
                    count[k][g] += 1
                    among[k][g[:-1]] += 1
    once, each = Counter(), Counter()
    for k in count:
        for g, c in count[k].items():
            once[k, size[k][g[:-1]].bit_length()] += c == 1
            each[k, size[k][g[:-1]].bit_length()] += c

    def p(context, w):
        k = len(context) + 1
        if k == 1:
            return share(w)
        if not among[k][context]:
            return p(context[1:], w)
        c = k, size[k][context].bit_length()
        b = min(0.99, max(0.01, once[c] / each[c]))
        return (1 - b) * count[k][(*context, w)] / among[k][context] + b * p(context[1:], w)

    out = []
    for (d, _), t, k in zip(rows, texts, trained):
        base = sum(math.log10((ones[w] + 1) / (n + types + 1)) for w in t)
        line = ("^", *t)
        score = sum(math.log10(p(line[max(0, i - order + 1): i], line[i])) for i in range(1, len(line)))
        out.append((d, not k, len(t), sum(ones[w] > 0 for w in t), n, base, score))
    return out, ones, among, p


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_are_those_of_the_model(docs, words, order):
    rows = [(i, " ".join(words(3 + i % 90, i))) for i in range(150)]
    rows += [(i, " ".join(words(40, i // 3)) + " " + " ".join(words(5, i))) for i in range(300, 330)]  # passages that repeat
    rows += [(i, "a b a b a c a b a b " * (i % 5)) for i in range(340, 350)]
    rows += [(200, None), (201, ""), (202, "Never seen words"), (203, " ".join(words(4000, 1))), (204, "A a\x0bA\x85 \xa0a")]
    trained = [zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows]
    want, ones, among, p = model(rows, trained, order)
    out = {r.doc_id: tuple(r) for r in lm_scores(docs(rows), fold(7) != 2, bucket_bytes=1 << 12, order=order).collect()}
    assert len(out) == len(rows)
    for row in want:
        assert out[row[0]][:5] == row[:5]
        assert out[row[0]][5:] == pytest.approx(row[5:], abs=1e-8)
    held = [out[d] for d, *_ in rows if out[d][1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
    # After a context, the known words and the unknown ones have probability 1 together.
    assert len(among[order]) > 10 or order == 2
    for k in among:
        for context in sorted(among[k], key=among[k].get)[-3:]:
            assert sum(p(context, w) for w in ones) + p(context, "?") == pytest.approx(1)


def test_arcs_lead_to_the_states_that_are_carried(words):
    """Following the arcs one by one, text by text, meets the carried states and the scores."""
    import numpy as np
    import pyarrow as pa

    from barflow.llm import language_model as lm

    texts = [" ".join(words(60, i // 3)) for i in range(90)] + ["", "new words only", "a b a b a b a c"] * 2
    seen = lm.Sequences(pa.table({"text": texts, "train": [i % 7 != 2 for i in range(len(texts))]}))

    def counts(keys, weights):
        found, at = np.unique(keys, return_inverse=True)
        return np.bincount(at, weights=weights, minlength=len(found)).astype(np.int64)

    known = lm.Known(seen, counts(seen.tokens, seen.train))
    by_order, longer = [counts(seen.pairs, seen.train)[np.unique(seen.pairs, return_inverse=True)[1]]], []
    for n in (3, 4):
        level = lm.Longer(seen, n, by_order[-1])
        longer.append(level.told(counts(level._keys, level._weights), len(seen.tokens)))
        by_order.append(level.count)
    model = {"tokens": int(seen.train.sum()), "types": 50, "once": 5, "twice": 5, "backoffs": [[0.3] * 64] * 3}
    automaton = lm.Automaton(seen, known, by_order, longer, model)
    assert (automaton.carried > automaton.root).any()
    arcs = dict(zip(automaton.arcs.tolist(), zip(automaton.weights.tolist(), automaton.targets.tolist())))
    scores = []
    for a, b in zip((seen.ends - seen.sizes).tolist(), seen.ends.tolist()):
        state, total = len(known.keys), 0.0
        for place in range(a, b):
            assert state == automaton.carried[place]
            word = known.word[place]
            while state != automaton.root and state * (automaton.root + 1) + word not in arcs:
                total, state = total + automaton.failures[state], automaton.fall[state]
            weight, state = (automaton.root_arcs[word], word if known.count[word] else automaton.root) if (
                state == automaton.root) else arcs[state * (automaton.root + 1) + word]
            total += weight
        scores.append(total)
    assert automaton.scores(seen.ends - seen.sizes) == pytest.approx(scores)


def test_order_must_hold_a_context(docs):
    with pytest.raises(ValueError, match="at least 2"):
        lm_scores(docs([(1, "a")]), F.lit(True), order=1)


def test_scores_without_training_or_id(docs):
    assert [tuple(r)[4:] for r in lm_scores(docs([(1, "a b"), (2, None)]), F.lit(False)).collect()] == [(0, 0.0, 0.0)] * 2
    twice = lm_scores(docs([(1, "a b"), (1, "a b"), (None, "a")]), F.lit(None).cast("boolean") | (F.col("doc_id") == 1))
    assert sorted(((r.doc_id, r.held_out, r.train_tokens) for r in twice.collect()), key=str) == [
        (1, False, 6), (1, False, 6), (None, True, 6)]
    assert lm_scores(docs([]), F.lit(True)).count() == 0
    assert END != START
