import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from barflow.llm import byte_bpe
from barflow.llm.byte_bpe import PreTokens, cut, decode, encode, encode_and_decode, encode_word, read_ranks
from barflow.llm.common import Words
from barflow.llm.piece_counts import LongestMatch, count_pieces

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(n, seed=1):
    rng = random.Random(seed)
    alphabet = [*"abst'relvmd  '\n\t 12é中\x1c\x1f\x85.,! 　İ½²٣\U0001F600", "'s", "'ll", "'re", " '", "ll "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_character_classes_are_made_without_a_string_for_each_character(monkeypatch):
    import tracemalloc

    import regex

    kinds = byte_bpe.character_classes()
    for c in (*range(0x3000), *range(0xD7F0, 0xE010), 0x10FFFF):
        one = chr(c) if not 0xD800 <= c < 0xE000 else "\0"
        want = next((k for k, p in ((byte_bpe.LETTER, r"\p{L}"), (byte_bpe.NUMBER, r"\p{N}"), (byte_bpe.SPACE, r"\p{White_Space}"))
                     if regex.match(p, one)), byte_bpe.OTHER)
        assert kinds[c] == want, hex(c)
    monkeypatch.setattr(byte_bpe, "_classes", None)
    tracemalloc.start()
    try:
        byte_bpe.character_classes()
        assert tracemalloc.get_traced_memory()[1] < 32 << 20
    finally:
        tracemalloc.stop()


def test_words_are_those_of_the_pattern(library):
    ranks = read_ranks(PATH)
    texts = strings(3000)
    words = PreTokens(texts)
    raw = words.data.tobytes()
    for i, text in enumerate(texts):
        at = slice(words.bounds[i], words.bounds[i + 1])
        ids = [t for a, b in zip(words.starts[at], words.ends[at]) for t in encode_word(raw[a:b], ranks)]
        assert ids == library.encode_ordinary(text), text


def test_long_words_and_long_texts(library):
    rng = random.Random(5)
    ranks = read_ranks(PATH)
    word = "".join(rng.choice("abcé") for _ in range(2000))
    assert encode_word(word.encode(), ranks) == library.encode_ordinary(word)
    text = " ".join(strings(3000, 8))
    pieces = cut(text, 500)
    assert "".join(pieces) == text and len(pieces) > 5
    assert [t for p in pieces for t in library.encode_ordinary(p)] == library.encode_ordinary(text)


def test_encoding_and_decoding(docs, library):
    rows = [(i, t) for i, t in enumerate(strings(400, 3))]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "twice"), (502, "twice"), (503, "long text " * 60_000),
             (504, "x" * 30_000), (505, "<|endoftext|>")]
    out = decode(encode(docs(rows), PATH, bucket_bytes=1 << 18), PATH).collect()
    text = {d: t for d, t in rows}
    assert len(out) == len(rows)
    for r in out:
        want = library.encode_ordinary(text[r.doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == (text[r.doc_id] or "").encode()
    assert encode(docs([]), PATH).count() == 0


def greedy(word, vocabulary, longest):
    n = at = 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at: at + k] in vocabulary), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


def test_automaton_is_greedy_longest_match():
    rng = random.Random(3)
    for _ in range(300):
        vocabulary = {bytes(rng.choice(b"abc ") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))}
        automaton = LongestMatch(vocabulary)
        for _ in range(40):
            word = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(12)))
            assert automaton.count(word) == greedy(word, vocabulary, 5), (vocabulary, word)
    assert LongestMatch([]).count(b"a") == 1


def test_piece_counts(docs):
    vocabulary = set(read_ranks(PATH))
    longest = max(map(len, vocabulary))
    rows = [(i, t) for i, t in enumerate(strings(200, 9))] + [
        (300, None), (301, ""), (None, "no id"), (302, "twice"), (302, "twice"), (303, "y" * 100_000)]
    out = count_pieces(docs(rows), PATH).collect()
    text = {d: t for d, t in rows}
    assert len(out) == len(rows)
    for r in out:
        words = (text[r.doc_id] or "").encode().split()
        assert r.n_words == len(words)
        assert r.n_tokens == sum(greedy(b" " + w, vocabulary, longest) for w in words)
    assert count_pieces(docs([]), PATH).count() == 0


def thue_morse(n):
    """Two different words of n letters that a polynomial of any base cannot tell apart modulo 2 ** 64 (n of 1,024 or more)."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_words_built_to_collide_are_told_apart(docs):
    one, two = thue_morse(2048)
    rows = [(1, f"{one} {two} {one}"), (2, two), (3, one)]
    out = {r.doc_id: r for r in encode_and_decode(docs(rows), PATH).collect()}
    assert all(bytes(out[d].decoded).decode() == t for d, t in rows)
    plain = {r.doc_id: r for r in decode(encode(docs(rows), PATH), PATH).collect()}
    assert all(plain[d] == out[d] for d, _ in rows)
    assert len(set(Words([one, two]).hashes.tolist())) == 2
