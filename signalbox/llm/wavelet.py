"""Token-ID output as one wavelet matrix per shard.

Documents are dealt by ranges of doc_id, encoded, an end id appended to each,
and the ids cut at document ends into shards of about ``SHARD_TOKENS``. A
shard is one file: a Parquet row with the shard's document ids and lengths and
its ids as a compressed wavelet matrix (``WaveletMatrix``). The matrix keeps
one bit-plane per bit of the largest id, with rank directories, and answers
token access, counts and occurrence lookups without decoding the whole.

Parquet is the container because only Spark may reach the store. Rows are in
(doc_id, text) order, null ids first; null or empty text is just the end id;
repeated rows are encoded each. A text is never cut: a shard exceeds its size
by its last document at most. An empty table writes no shard.
"""

from __future__ import annotations

import array
import functools
import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import work_root

SHARD_TOKENS = 1 << 20
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"

SHARD_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("n_tokens", T.LongType()), T.StructField("matrix", T.BinaryType())])


class WaveletMatrix:
    """Ids as bit-planes, highest bit first; each plane is in the order left by
    a stable partition on the planes above (zeros first).

    File format, little-endian: magic, u64 ids, u8 planes; per plane u64 zeros,
    u32 bytes of the packed directory, u32 bytes of the packed plane, then both
    (zstd). The directory has the ones before every 512th position (u32).
    """

    MAGIC = b"WMX1"
    BLOCK = 9

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], dirs: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.dirs = n, zeros, planes, dirs

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        n, bits = len(ids), max(1, int(ids.max()).bit_length() if len(ids) else 1)
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes, dirs = [], [], []
        for level in range(bits - 1, -1, -1):
            one = (cur & cur.dtype.type(1 << level)) != 0
            packed = np.packbits(one, bitorder="little")
            ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % (1 << cls.BLOCK - 3))))
            per = ones.reshape(-1, 1 << cls.BLOCK - 3).sum(1, dtype=np.uint32)
            dirs.append(np.concatenate([[0], np.cumsum(per)]).astype("<u4"))
            planes.append(packed)
            low = np.compress(~one, cur)
            zeros.append(len(low))
            cur = np.concatenate([low, np.compress(one, cur)])
        return cls(n, zeros, planes, dirs)

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1).compress
        out = [self.MAGIC, struct.pack("<QB", self.n, len(self.planes))]
        for z, plane, d in zip(self.zeros, self.planes, self.dirs, strict=True):
            a, b = pack(d.tobytes()), pack(plane.tobytes())
            out += [struct.pack("<QII", z, len(a), len(b)), a, b]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != cls.MAGIC:
            raise ValueError("not a wavelet matrix")
        unpack = zstandard.ZstdDecompressor().decompress
        n, bits = struct.unpack_from("<QB", data, 4)
        at, zeros, planes, dirs = 13, [], [], []
        for _ in range(bits):
            z, a, b = struct.unpack_from("<QII", data, at)
            at += 16
            zeros.append(z)
            dirs.append(np.frombuffer(unpack(data[at:at + a]), "<u4"))
            planes.append(np.frombuffer(unpack(data[at + a:at + a + b]), np.uint8))
            at += a + b
        return cls(n, zeros, planes, dirs)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position i of a plane."""
        block, plane = i >> self.BLOCK, self.planes[level]
        whole = plane[block << self.BLOCK - 3:i >> 3]
        rest = int(plane[i >> 3]) & ((1 << (i & 7)) - 1) if i & 7 else 0
        return int(self.dirs[level][block]) + int(np.bitwise_count(whole).sum()) + rest.bit_count()

    def _nth(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(level, mid + 1)
            lo, hi = (lo, mid) if (ones if bit else mid + 1 - ones) > k else (mid + 1, hi)
        return lo

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            out = out << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's occurrences among the first i ids end up."""
        if token < 0 or token.bit_length() > len(self.planes):
            return 0, 0
        a, b = 0, i
        for level in range(len(self.planes)):
            bit = token >> (len(self.planes) - 1 - level) & 1
            p, q = self._ones(level, a), self._ones(level, b)
            a, b = (self.zeros[level] + p, self.zeros[level] + q) if bit else (a - p, b - q)
        return a, b

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token among the first i ids."""
        a, b = self._range(token, min(max(i, 0), self.n))
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the token's k-th occurrence, from 0; -1 if there are fewer."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            return -1
        i = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._nth(level, bit, i - self.zeros[level] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids, by undoing the partitions from the lowest plane up."""
        cur = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            low, high = np.split(cur, [self.zeros[level]])
            up = np.empty_like(cur)
            if len(high):
                np.place(up, one, high | cur.dtype.type(1 << len(self.planes) - 1 - level))
            if len(low):
                np.place(up, ~one, low)
            cur = up
        return cur


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each first


class TextEncoder:
    """Ids of texts as little-endian u32 bytes, by the tokenizers library.

    The vocabulary's pre-tokenizer always cuts before a space that a
    non-space follows, so a text of single spaces is encoded piece by piece.
    Arrow cuts the texts of a call and finds their distinct pieces. Those that
    are not known yet are encoded together as one text; only the first id of
    each begins with a space, which tells them apart again. Short pieces are
    kept, up to a bound: the frequent ones come early. Other texts, such as
    those that hold one of the vocabulary's added tokens, are encoded whole.
    """

    KEPT, LONGEST, JOINED = 400_000, 16, 256
    #: A space that no piece follows.
    LOOSE = re.compile(r" (?:\s|\Z)")

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.known: dict[str, bytes] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        words = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(words.values()) + 1, bool)
        self.spaced[[i for w, i in words.items() if w.startswith("\u0120")]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array.array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, pieces: list[str]) -> bytes:
        """Ids of the pieces, each after a space; a few hundred make a text."""
        return b"".join(self._whole([" " + " ".join(pieces[i:i + self.JOINED]) for i in range(0, len(pieces), self.JOINED)]))

    def _odd(self, text: str) -> bool:
        return self.LOOSE.search(text) is not None or any(t in text for t in self.added)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, each after a space."""
        out = list(map(self.known.get, pieces))
        places = [i for i, ids in enumerate(out) if ids is None]
        if places:
            new = [pieces[i] for i in places]
            data = self._together(new)
            cuts = [*np.flatnonzero(self.spaced[np.frombuffer(data, "<u4")]).tolist(), len(data) // 4]
            if len(cuts) != len(new) + 1:
                raise ValueError("the vocabulary does not cut its pieces before spaces")
            for i, (a, z) in zip(places, itertools.pairwise(cuts), strict=True):
                out[i] = data[4 * a:4 * z]
            short = ((p, out[i]) for i, p in zip(places, new, strict=True) if len(p) <= self.LONGEST)
            self.known.update(itertools.islice(short, max(0, self.KEPT - len(self.known))))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [self._odd(t) for t in texts]
        cut = pc.split_pattern(pa.array([t for t, o in zip(texts, odd, strict=True) if not o], pa.large_string()), " ")
        starts = cut.offsets.to_numpy()
        begins = np.zeros(len(cut.values), bool)
        begins[starts[:-1]] = True  # no space before a text's first piece
        first = iter(self._whole(_strings(cut.values.filter(pa.array(begins)))))
        rest = cut.values.filter(pa.array(~begins)).dictionary_encode()
        ids = self._pieces(_strings(rest.dictionary))
        # the ids of each piece in turn, out of those of the distinct pieces
        data, size = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        code = rest.indices.to_numpy()
        each = size[code]
        to = np.cumsum(each)
        at = np.repeat((np.cumsum(size) - size)[code] - (to - each), each)
        at += np.arange(len(at))
        held = data[at].tobytes()
        ends = np.concatenate([[0], to])[starts - np.arange(len(starts))].tolist()
        spans = itertools.pairwise(ends)
        whole = iter(self._whole([t for t, o in zip(texts, odd, strict=True) if o]))
        return [next(whole) if o else next(first) + held[4 * (x := next(spans))[0]:4 * x[1]] for o in odd]


@functools.cache
def _encoder(path: str | None) -> TextEncoder:
    """One per Python worker, for all its tasks."""
    return TextEncoder(path)


def _groups(rows: Iterator[tuple], most: int = 1 << 18) -> Iterator[list[tuple]]:
    """Successive (doc_id, text) rows of together about ``most`` characters."""
    out, chars = [], 0
    for row in rows:
        out.append(row)
        chars += len(row[1])
        if chars >= most:
            yield out
            out, chars = [], 0
    if out:
        yield out


def _write_shards(batches: Iterator[pa.RecordBatch], path: str | None, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, encoder = TaskContext.get().partitionId(), _encoder(path)
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("matrix", pa.binary())])
    end = np.array([END_ID], "<u4").tobytes()
    docs: list = []
    lengths: list[int] = []
    held: list[bytes] = []
    seq = total = 0

    def shard() -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(held), "<u4")
        row = [part, seq, list(docs), list(lengths), len(ids), WaveletMatrix.of(ids).to_bytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    rows = ((d.as_py(), t.as_py() or "") for b in batches for d, t in zip(b.column(0), b.column(1), strict=True))
    for group in _groups(rows):
        for (doc_id, _), ids in zip(group, encoder.encode([t for _, t in group]), strict=True):
            docs.append(doc_id)
            held += [ids, end]
            lengths.append(len(ids) // 4 + 1)
            total += lengths[-1]
            if total >= shard_tokens:
                yield shard()
                docs, lengths, held, seq, total = [], [], [], seq + 1, 0
    if docs:
        yield shard()


def write_shards(df: DataFrame, out: str, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``df`` (doc_id, text) and write its shard files, one per shard."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = rows.mapInArrow(lambda it: _write_shards(it, vocabulary, shard_tokens), SHARD_SCHEMA)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(out)


def read_shards(spark, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    """One shard at a time."""
    for i in range(b.num_rows):
        yield {name: b.column(name)[i].as_py() for name in b.schema.names}


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in _rows(b):
            ids = WaveletMatrix.from_bytes(row["matrix"]).ids().astype("<u4")
            starts = np.cumsum([0, *row["lengths"]])
            n = len(row["lengths"])
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([row["part"]] * n, pa.int32()), "seq": pa.array([row["seq"]] * n, pa.int32()),
                "place": pa.array(range(n), pa.int32()),
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "local": pa.array(starts[:-1], pa.int64()),
                "n_tokens": pa.array(row["lengths"], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts[:-1], starts[1:], strict=True)], pa.int64())})


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, before): ids before each shard. Parts are a few per core, so
    the window over all of them is small; shards are numbered within parts."""
    heads = shards.select("part", "seq", "n_tokens")
    parts = heads.groupBy("part").agg(F.sum("n_tokens").alias("_t"))
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    every = past(Window.partitionBy(F.lit(0)).orderBy("part"))
    parts = parts.select("part", F.coalesce(F.sum("_t").over(every), F.lit(0)).alias("_p"))
    own = past(Window.partitionBy("part").orderBy("seq"))
    return (heads.withColumn("_s", F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).join(parts, "part")
            .select("part", "seq", (F.col("_s") + F.col("_p")).alias("before")))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(part, seq, doc_id, position in the shard) of every occurrence of a
    token, by select on the matrices."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                m = WaveletMatrix.from_bytes(row["matrix"])
                at = [m.select(token, k) for k in range(m.count(token))]
                doc = np.searchsorted(np.cumsum(row["lengths"]), at, side="right")
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * len(at), pa.int32()), "seq": pa.array([row["seq"]] * len(at), pa.int32()),
                    "doc_id": pa.array([row["doc_ids"][i] for i in doc], pa.int64()), "position": pa.array(at, pa.int64())})
    return shards.mapInArrow(find, "part int, seq int, doc_id long, position long")


def token_report(df: DataFrame, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shard files of ``df`` and reads them back: per document
    doc_id, start (ids of all documents before it), n_tokens (with the end id)
    and ids_crc32 (of the ids as little-endian u32)."""
    spark = df.sparkSession
    out = f"{work_root(spark)}/token-shards-{uuid.uuid4().hex}"
    write_shards(df, out, vocabulary, shard_tokens)
    shards = read_shards(spark, out)
    docs = shards.mapInArrow(_decode, "part int, seq int, place int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
