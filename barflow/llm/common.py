"""What several operators share: block and bucket keys, skew-safe lookups, word hashing in arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

#: Text bytes of a block: what one Python call holds at a time.
BLOCK_BYTES = 4 << 20
#: Rows that one salted piece of a hot key should hold.
SALT_ROWS = 1_000_000


def salts(n_rows: int, least: int = 8) -> int:
    """Pieces to deal one key's rows to, if that key might hold all rows."""
    return max(least, -(-n_rows // SALT_ROWS))


def attach_totals(rows: DataFrame, keys: Sequence[str], spread: Column, n: int, partial: dict[str, Column],
                  total: dict[str, Column]) -> DataFrame:
    """Rows with aggregates of their group, without ever holding a group in one task.

    A group's rows are dealt to ``n`` salted pieces. ``partial`` aggregates a piece, ``total`` combines the
    pieces' aggregates (by their names); the totals return to the pieces that exist, and from there to rows.
    Keys are compared null-safely only if they hold no nulls: give columns without nulls.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int"))
    pieces = salted.groupBy(*keys, "_salt").agg(*[c.alias(name) for name, c in partial.items()])
    totals = pieces.groupBy(*keys).agg(*[c.alias(f"_{name}") for name, c in total.items()])
    known = pieces.select(*keys, "_salt").join(totals, list(keys)).withColumnsRenamed({f"_{k}": k for k in total})
    return salted.join(known, [*keys, "_salt"]).drop("_salt")


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: Column, n: int, how: str = "inner") -> DataFrame:
    """Join a table with one row a key to rows in which a key may be hot: each key is met once for each salt."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int"))
    known = salted.select(*keys, "_salt").distinct().join(table, list(keys))
    return salted.join(known, [*keys, "_salt"], how).drop("_salt")


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, keep: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """Documents packed by a block number dealt by hash; blocks hold about ``block_bytes`` of text each.

    A row holds what one batch has of a block: ids, the columns to keep, and compressed text; ``unpacked_docs``
    gives a block's documents back. Returns the frame and the text bytes of all rows. Nulls in ``doc_id`` are
    dealt by their text.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = block_number(F.col("doc_id").cast("bigint"), F.when(F.col("doc_id").isNull(), F.col("text")), max(1, -(-total // block_bytes)))
    names = ["doc_id", *keep]
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep, "text", block.alias("block"))
    fields = [StructField("block", IntegerType()), StructField("packed", BinaryType()),
              StructField("sizes", ArrayType(IntegerType()))]
    fields += [StructField(f.name, ArrayType(f.dataType)) for f in base.schema.fields if f.name in names]

    def pack(batches):
        for batch in batches:
            number = np.asarray(batch.column("block"))
            order = np.argsort(number, kind="stable")
            at = np.flatnonzero(np.diff(np.concatenate(([-1], number[order]))))
            ends = np.append(at, len(order))
            texts = batch.column("text").cast(pa.large_binary()).take(pa.array(order))
            offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
            data = memoryview(texts.buffers()[2] or b"")
            squeeze = zstandard.ZstdCompressor(level=1).compress
            sizes = np.where(np.asarray(texts.is_null()), -1, np.diff(offset)).astype(np.int32)
            columns = [pa.array(number[order][at], pa.int32()),
                       pa.array([squeeze(data[offset[a]: offset[b]]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sizes))]
            columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column(c).take(pa.array(order))) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return base.mapInArrow(pack, StructType(fields)), total


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that a task holds few texts as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def unpacked_docs(packed: pa.Table) -> pa.Table:
    """The documents of a block: ``block``, ``text`` and the columns that were kept."""
    texts: list[str | None] = []
    for blob, sizes in zip(packed.column("packed").to_pylist(), packed.column("sizes").to_pylist()):
        raw, start = zstandard.ZstdDecompressor().decompress(blob), 0
        for size in sizes:
            texts.append(None if size < 0 else raw[start: start + size].decode("utf-8", "surrogatepass"))
            start += max(size, 0)
    rest = [c for c in packed.schema.names if c not in ("block", "packed", "sizes")]
    columns = {c: pa.chunked_array([x.flatten() for x in packed.column(c).chunks], packed.schema.field(c).type.value_type)
               for c in rest}
    block = packed.column("block")[0].as_py() if packed.num_rows else 0
    return pa.table({"block": pa.array([block] * len(texts), pa.int32()), "text": pa.array(texts, pa.string()), **columns})


def block_number(doc_id: str | Column, text: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, text), F.lit(n)).cast("int")


# ---------------------------------------------------------------- words as arrays

def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] of all segments, one after the other."""
    out = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return values[np.repeat(starts - out, sizes) + np.arange(int(sizes.sum()))]


#: The six ASCII characters that part words: space and \x09 to \x0d.
SPACES = b" \t\n\x0b\x0c\r"


#: An odd constant of the hashes.
_KEY = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct_segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each byte segment [start, end) among the distinct ones, and these. Segments do not overlap."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1  # of a segment that ends where the next begins, both cancel out
    sizes = np.concatenate(([0], np.cumsum(ends - starts)))
    kind, width = (pa.binary(), np.int32) if sizes[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    inside = np.ascontiguousarray(data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)])
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(sizes.astype(width)), pa.py_buffer(inside)])
    found = words.dictionary_encode()
    return np.asarray(found.indices), found.dictionary


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte segments [start, end): eight bytes after the other are mixed into the state.

    The mixing is not linear in the bytes, so unlike sums of powers it has no words that meet whatever the constants.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    left = (ends - starts).astype(np.int64)
    out = mixed(left.astype(np.uint64) + _KEY)
    live, at = np.arange(len(starts)), np.asarray(starts, np.int64)
    while len(live):
        lane = lanes[at].astype(np.uint64)
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live] = mixed(out[live] ^ lane) + lane * _KEY
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return mixed(out)


def byte_hashes(words: pa.Array) -> np.ndarray:
    """The same hashes of the byte strings of an array."""
    offset = np.frombuffer(words.buffers()[1], np.int32 if words.type == pa.binary() else np.int64)
    offset = offset[words.offset: words.offset + len(words) + 1].astype(np.int64)
    return segment_hashes(np.frombuffer(words.buffers()[2] or b"", np.uint8), offset[:-1], offset[1:])


def separators(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_WHITE = separators(SPACES)


class Words:
    """Words of several texts: their 64-bit hashes in text order, and where each text's words begin and end."""

    def __init__(self, texts: Sequence[str | None], apart: np.ndarray = _WHITE):
        blobs = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
        data = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))[: len(blobs) + 1]
        gap = apart[data]
        inside = ~gap
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        self.hashes = segment_hashes(data, starts, ends)
        self.data, self.starts, self.ends, self.blobs = data, starts, ends, blobs
        self.bounds = np.searchsorted(starts, begin)  # text i has the words bounds[i] to bounds[i + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def chunks_of(texts: Sequence[str | None], size: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Index ranges of texts with about ``size`` characters each (a longer text stands alone)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if held and held + n > size:
            yield start, i
            start, held = i, 0
        held += n + 1
    if start < len(texts):
        yield start, len(texts)


def windows(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words inside each text, and the text each window lies in."""
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if len(h) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    step = 1
    for j in range(n):
        total += h[j: len(h) - n + 1 + j] * np.uint64(step)
        step = step * 0xD6E8FEB86659FD93 % (1 << 64)
    same = text_of[: len(h) - n + 1] == text_of[n - 1:]
    return mixed(total[same] + np.uint64(n)), text_of[: len(h) - n + 1][same]


def pieces_by_bucket(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of sorted unique ``keys`` by bucket (the high bits dealt evenly), the buckets present, their bounds.

    Keys are sorted, and a bucket is a range of them, so a bucket's keys are one slice.
    """
    bucket = bucket_of(keys, n_buckets)
    at = np.flatnonzero(np.diff(np.concatenate(([-1], bucket))))
    return bucket[at], at, np.append(at[1:], len(keys))


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of 64-bit keys: ranges of the upper 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------- counts of keys, by buckets of key ranges

ASK = "block int, bucket int, keys binary, counts binary, classes binary"
ASKED = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                   ("classes", pa.binary())])
ANSWER = ("block int, bucket int, totals binary, types bigint, tokens bigint, once bigint, twice bigint, "
          "class_once array<bigint>, class_tokens array<bigint>")
ANSWERED = pa.schema([
    ("block", pa.int32()), ("bucket", pa.int32()), ("totals", pa.binary()), ("types", pa.int64()),
    ("tokens", pa.int64()), ("once", pa.int64()), ("twice", pa.int64()),
    ("class_once", pa.list_(pa.int64())), ("class_tokens", pa.list_(pa.int64()))])
#: Classes that keys may carry, for sums by class.
CLASSES = 64


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4").astype(np.int64)


def _dense(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys as their differences, byte by byte: the high bytes of these are small and compress well."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.T))


def _from_dense(blob: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(width, -1)
    wide = np.zeros((raw.shape[1], 8), np.uint8)
    wide[:, :width] = raw.T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def _packed_dense(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def _unpacked_dense(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel().astype(np.int64)


def ask_dense(block: int, keys: np.ndarray, counts: np.ndarray, classes: np.ndarray, n_buckets: int, width: int) -> pa.Table:
    """As ``ask``, in fewer bytes: of a key, the first ``width`` bytes of its distance from the bucket's least key travel."""
    found, begin, end = pieces_by_bucket(keys, n_buckets)
    least = np.array([-(-(int(b) << 32) // n_buckets) << 32 for b in found], np.uint64)
    shift = np.uint64(max(0, 65 - n_buckets.bit_length() - 8 * width))
    near = (keys - np.repeat(least, end - begin)) >> shift
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pa.table({
        "block": [block] * len(found), "bucket": found,
        "keys": [_dense(near[a:b], width) for a, b in zip(begin, end)],
        "counts": [packed(counts[a:b]) for a, b in zip(begin, end)],
        "classes": [squeeze(classes[a:b].tobytes()) if len(classes) else b"" for a, b in zip(begin, end)]}, schema=ASKED)


def ask(block: int, keys: np.ndarray, counts: np.ndarray, classes: np.ndarray, n_buckets: int, width: int) -> pa.Table:
    """A block's sorted distinct keys with their counts there, one row a bucket; ``width`` low bytes of a key travel."""
    found, begin, end = pieces_by_bucket(keys, n_buckets)
    raw = np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return pa.table({
        "block": [block] * len(found), "bucket": found,
        "keys": [raw[a:b].tobytes() for a, b in zip(begin, end)],
        "counts": [packed(counts[a:b]) for a, b in zip(begin, end)],
        "classes": [classes[a:b].tobytes() for a, b in zip(begin, end)]}, schema=ASKED)


def _wide(raw: bytes, width: int) -> np.ndarray:
    """Keys of ``width`` bytes as numbers."""
    if width in (4, 8):
        return np.frombuffer(raw, f"<u{width}")
    wide = np.zeros((len(raw) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel()


def count_bucket(width: int, dense: bool = False):
    """Sum the counts of a bucket's keys over all blocks, and answer each block in the order it asked.

    ``dense``: the blocks asked by ``ask_dense``.
    """

    def run(asked: pa.Table) -> pa.Table:
        raws = asked.column("keys").to_pylist()
        if dense:
            parts = [_from_dense(r, width) for r in raws]
            sizes, keys = [len(k) for k in parts], np.concatenate(parts)
            del parts
        else:
            sizes = [len(r) // width for r in raws]
            keys = _wide(b"".join(raws), width)
        del raws
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        at = np.flatnonzero(new)
        number = np.empty(len(keys), np.int32)  # of each key asked for, among the distinct ones
        number[order] = np.cumsum(new, dtype=np.int32) - 1
        del keys, new
        counts = np.concatenate([unpacked(c) for c in asked.column("counts").to_pylist()])
        totals = np.bincount(number, weights=counts, minlength=len(at)).astype(np.int64)
        rest = [None] * (len(sizes) - 1)
        blobs = asked.column("classes").to_pylist()
        if dense:
            blobs = [zstandard.ZstdDecompressor().decompress(b) if b else b for b in blobs]
        classes = np.frombuffer(b"".join(blobs), np.uint8)
        once = each = None
        if len(classes):
            of = classes[order[at]]
            once = np.bincount(of[totals == 1], minlength=CLASSES).tolist()
            each = np.bincount(of, weights=totals, minlength=CLASSES).astype(np.int64).tolist()
        ends = np.concatenate(([0], np.cumsum(sizes))).tolist()
        return pa.table({
            "block": asked.column("block"), "bucket": asked.column("bucket"),
            "totals": [(_packed_dense if dense else packed)(totals[number[a:b]]) for a, b in zip(ends[:-1], ends[1:])],
            "types": [int((totals > 0).sum()), *rest], "tokens": [int(totals.sum()), *rest],
            "once": [int((totals == 1).sum()), *rest], "twice": [int((totals == 2).sum()), *rest],
            "class_once": [once, *rest], "class_tokens": [each, *rest]}, schema=ANSWERED)

    return run


def totals_of(answers: pa.Table, dense: bool = False) -> np.ndarray:
    """A block's answers, in the order of its sorted keys; ``dense`` as the buckets were told."""
    rows = sorted((k, b) for k, b in zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()))
    read = _unpacked_dense if dense else unpacked
    return np.concatenate([read(b) for _, b in rows]) if rows else np.empty(0, np.int64)
