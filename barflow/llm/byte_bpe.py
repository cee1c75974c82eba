"""Byte-level BPE: every distinct word of the corpus is encoded once, and its ids return to where it stands."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from barflow.llm.common import byte_hashes, distinct_segments, in_blocks, pieces_by_bucket, ragged, slices, unpacked_docs

#: Text bytes for each bucket of words.
BUCKET_BYTES = 16 << 20
#: Characters cut into words at a time.
PIECE = 1 << 18

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
_classes: np.ndarray | None = None
_vocabularies: dict[str, dict] = {}


def character_classes() -> np.ndarray:
    """Class of each code point: letter, number, white space, other."""
    global _classes
    if _classes is None:
        import regex

        points = np.arange(0x110000, dtype="<u4")
        points[0xD800:0xE000] = 0
        every = points.tobytes().decode("utf-32-le")  # a million strings of one character would be held at a time
        out = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                out[m.start():m.end()] = kind
        _classes = out
    return _classes


def cut(text: str, size: int = PIECE) -> list[str]:
    """Pieces of a long text whose words are the words of the text: cut before a single space between words."""
    out = []
    while len(text) > size:
        at = text.find(" ", size)
        while at > 0 and (text[at - 1].isspace() or text[at + 1: at + 2].isspace() or at + 1 == len(text)):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[:at])
        text = text[at:]
    return [*out, text]


class PreTokens:
    """The words that the tokenizer's pattern cuts texts into, as byte segments.

    The pattern takes, at each place, the first that fits of: an apostrophe with s, t, re, ve, m, ll or d; a run
    of letters, of numbers or of other signs, each with one space before it; white space up to the last one
    before a word; white space. In arrays: runs of one class are words; white space gives its last character to
    what follows, joined to it if it is a space; a lone apostrophe takes its ending from the letters after it.
    """

    def __init__(self, texts: list[str]):
        blobs = [t.encode("utf-32-le", "surrogatepass") for t in texts]
        cp = np.frombuffer(b"".join(blobs), "<u4")
        sizes = np.fromiter((len(b) // 4 for b in blobs), np.int64, len(blobs))
        begin = np.concatenate(([0], np.cumsum(sizes)))
        kind = character_classes()[cp]
        n = len(cp)
        starts = np.zeros(n + 4, bool)  # of words; the tail spares bound checks
        first = np.zeros(n + 4, bool)  # of texts, and what lies behind the last
        first[begin] = True
        first[n:] = True
        if n:
            starts[0] = True
            starts[1:n] = kind[1:] != kind[:-1]
            starts[:n] |= first[:n]
            self._white_space(cp, kind, starts, first)
            self._apostrophes(cp, kind, starts, first)
        at = np.flatnonzero(starts[:n])
        width = (cp >= 0x80).astype(np.uint8) + (cp >= 0x800) + (cp >= 0x10000) + np.uint8(1)
        offset = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
        self.data = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
        self.starts = offset[at]
        self.ends = np.append(self.starts[1:], offset[-1]) if len(at) else self.starts
        self.bounds = np.searchsorted(at, begin)

    @staticmethod
    def _white_space(cp, kind, starts, first) -> None:
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1: len(cp)])
        starts[last] = True
        starts[last[cp[last] == 0x20] + 1] = False

    @staticmethod
    def _apostrophes(cp, kind, starts, first) -> None:
        n = len(cp)
        at = np.flatnonzero((cp == 0x27) & starts[:n])
        padded = np.concatenate((cp, np.zeros(3, cp.dtype)))
        one, two = padded[at + 1], padded[at + 2]
        alone = ~first[at + 1]
        short = alone & np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), "<u4"))
        pairs = [tuple(map(ord, x)) for x in ("re", "ve", "ll")]
        long = alone & ~first[at + 2] & np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])
        for found, size in ((at[short], 2), (at[long], 3)):
            starts[found + 1] = False
            starts[found + size] = True


def _texts(table: pa.Table) -> list[list[str]]:
    """The texts of a block, each in pieces that can be cut into words one by one."""
    return [cut(t) if t else [] for t in table.column("text").to_pylist()]


def _groups(texts: list[list[str]]) -> Iterator[tuple[int, int, list[str]]]:
    """Pieces in order, some PIECE characters at a time, with the texts they belong to (first, last + 1)."""
    held: list[tuple[int, str]] = []
    size = 0
    for i, pieces in enumerate(texts):
        for p in pieces:
            held.append((i, p))
            size += len(p)
            if size >= PIECE:
                yield held[0][0], held[-1][0] + 1, held
                held, size = [], 0
    if held:
        yield held[0][0], held[-1][0] + 1, held


def _pack(sizes: np.ndarray, values: np.ndarray) -> bytes:
    head = np.array([len(sizes)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + sizes.astype("<u4").tobytes() + values.tobytes())


def _unpack(blob: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    return np.frombuffer(raw, "<u4", n, 4).astype(np.int64), np.frombuffer(raw, kind, offset=4 + 4 * n)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, which is their id: lines of base64 bytes and a number."""
    if path not in _vocabularies:
        with open(path, "rb") as lines:
            _vocabularies[path] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return _vocabularies[path]


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank is joined, leftmost first, until none is a token."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 400:
        return _encode_long(word, ranks)
    none = 1 << 62
    parts = [word[i: i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        parts[i: i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words, with a heap of pairs over linked parts."""
    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0: joined to an earlier one
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i: i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not end[i] or end[i] >= n or end[end[i]] != stop:
            continue
        end[end[i]], end[i] = 0, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i: end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if before[i] >= 0 and (r := ranks.get(word[before[i]: stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    return [ranks[word[i: end[i]]] for i in range(n) if end[i]]


class BlockWords:
    """The distinct words of a block, told apart by their bytes and ordered by their hashes, and where they stand.

    The order is the same whenever the block is read, so answers can be given by place.
    """

    def __init__(self, texts: list[list[str]]):
        parts, self.groups, n = [], [], 0
        for _, _, pieces in _groups(texts):
            words = PreTokens([p for _, p in pieces])
            number, distinct = distinct_segments(words.data, words.starts, words.ends)
            parts.append(distinct)
            self.groups.append(([i for i, _ in pieces], words.bounds, number, n))
            n += len(distinct)
        every = pa.concat_arrays(parts or [pa.array([], pa.binary())]).dictionary_encode()
        hashes = byte_hashes(every.dictionary)
        order = np.argsort(hashes, kind="stable")
        self.keys, self.words = hashes[order], every.dictionary.take(pa.array(order))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.place = place[np.asarray(every.indices)]

    def standing(self) -> Iterator[tuple[int, np.ndarray]]:
        """(text, the places of its words in order), piece by piece."""
        for texts, bounds, number, first in self.groups:
            for i, a, b in zip(texts, bounds[:-1], bounds[1:]):
                yield i, self.place[number[a:b] + first]


def _words_of_block(n_buckets: int):
    """Distinct words of a block, one row for each bucket: sizes and bytes in their order."""

    def run(packed: pa.Table) -> pa.Table:
        block = BlockWords(_texts(unpacked_docs(packed)))
        if not len(block.keys):
            return _WORDS.empty_table()
        offset = np.frombuffer(block.words.buffers()[1], np.int32 if block.words.type == pa.binary() else np.int64)[: len(block.words) + 1]
        data = np.frombuffer(block.words.buffers()[2] or b"", np.uint8)
        found, begin, end = pieces_by_bucket(block.keys, n_buckets)
        words_of = [_pack(np.diff(offset[a: b + 1]), data[offset[a]: offset[b]]) for a, b in zip(begin, end)]
        number = packed.column("block")[0].as_py()
        return pa.table({"block": [number] * len(found), "bucket": found, "words": words_of}, schema=_WORDS)

    return run


_WORDS = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("words", pa.binary())])
_IDS = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("ids", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _encode_bucket(ranks):
    """Encode a bucket's words, each distinct one once, and answer every block that asked."""

    def run(table: pa.Table) -> pa.Table:
        vocabulary, known, out = ranks.value, {}, []
        for blob in table.column("words").to_pylist():
            sizes, data = _unpack(blob, "u1")
            raw, ends = data.tobytes(), np.cumsum(sizes).tolist()
            ids, start = [], 0
            for end in ends:
                word = raw[start:end]
                got = known.get(word)
                if got is None:
                    got = known[word] = encode_word(word, vocabulary)
                ids.append(got)
                start = end
            flat = np.fromiter((i for x in ids for i in x), "<u4")
            out.append(_pack(np.fromiter(map(len, ids), np.int64, len(ids)), flat))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "ids": out}, schema=_IDS)

    return run


class TokenBytes:
    """The token-byte table: the bytes of all ids, one after the other."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks.items(), key=lambda x: x[1])
        ids = np.array([i for _, i in tokens], np.int64)
        self.sizes = np.zeros(ids[-1] + 1 if len(ids) else 1, np.int64)
        self.sizes[ids] = [len(t) for t, _ in tokens]
        self.data = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]

    def of(self, ids: np.ndarray) -> bytes:
        return ragged(self.data, self.starts[ids], self.sizes[ids]).tobytes()


def _ids_of_block(table=None):
    """Put the words' ids back in text order; with a token-byte table, also decode them."""

    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        schema = _OUT if table is None else _OUT.append(pa.field("decoded", pa.binary()))
        if not packed.num_rows:
            return schema.empty_table()
        docs = unpacked_docs(packed)
        texts = _texts(docs)
        told = [_unpack(b, "<u4") for _, b in sorted(zip(answers.column("bucket").to_pylist(), answers.column("ids").to_pylist()))]
        sizes = np.concatenate([s for s, _ in told] or [np.empty(0, np.int64)])
        ids = np.concatenate([v for _, v in told] or [np.empty(0, "<u4")])
        del told
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        parts: list[list[bytes]] = [[] for _ in texts]
        for i, words in BlockWords(texts).standing():
            parts[i].append(ragged(ids, starts[words], sizes[words]).tobytes())
        blobs = [b"".join(p) for p in parts]
        columns = [docs.column("doc_id"), pa.array([len(b) // 4 for b in blobs], pa.int64()), pa.array(blobs, pa.binary())]
        if table is not None:
            columns.append(pa.array([table.value.of(np.frombuffer(b, "<u4")) for b in blobs], pa.binary()))
        return pa.table(columns, schema=schema)

    return run


def _encoded(docs: DataFrame, ranks_path: str, bucket_bytes: int, decoded: bool) -> DataFrame:
    context = docs.sparkSession.sparkContext
    ranks = context.broadcast(read_ranks(ranks_path))  # both are bounded by the vocabulary
    table = context.broadcast(TokenBytes(read_ranks(ranks_path))) if decoded else None
    blocks, total = in_blocks(docs)
    n_buckets = max(1, -(-total // bucket_bytes))
    asked = blocks.groupBy("block").applyInArrow(
        _words_of_block(n_buckets), "block int, bucket int, words binary")
    answers = asked.groupBy("bucket").applyInArrow(
        _encode_bucket(ranks), "block int, bucket int, ids binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _ids_of_block(table), "doc_id bigint, n_tokens bigint, ids binary" + (", decoded binary" if decoded else ""))


def encode(docs: DataFrame, ranks_path: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit), without special tokens.

    Null and empty texts have no tokens. Repeated rows, and rows without an id, are encoded each; ids must be
    whole numbers. Extra columns are ignored. Blocks of documents list their distinct words; buckets of words, in
    which a frequent word comes once for each block, encode them; blocks take the ids back and lay them out by
    position. The text is moved once (both uses read the same exchange). Words are told apart by their bytes.
    """
    return _encoded(docs, ranks_path, bucket_bytes, decoded=False)


def encode_and_decode(docs: DataFrame, ranks_path: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``encode`` with ``decoded``: the bytes of the ids by the token-byte table, as each block lays its ids out."""
    return _encoded(docs, ranks_path, bucket_bytes, decoded=True)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with the column ``decoded``: the bytes of its ids, looked up in the token-byte table."""
    table = encoded.sparkSession.sparkContext.broadcast(TokenBytes(read_ranks(ranks_path)))  # bounded by the vocabulary

    def run(batches):
        for batch in slices(batches):
            out = [table.value.of(np.frombuffer(b.as_buffer() or b"", "<u4") if b.is_valid else np.empty(0, "<u4"))
                   for b in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))
