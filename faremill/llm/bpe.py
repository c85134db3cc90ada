"""Byte-level BPE by rank tables: whole pre-tokens by a minimal perfect hash, the rest by merging over linked bytes.

A rank table maps byte strings to ids; the smaller id merges first. Text is cut by a pattern and each match is encoded on its own:
tier one asks a minimal perfect hash of the vocabulary for the whole match, tier two merges neighbours from a heap of (rank,
place) over a doubly linked list of bytes, in n log n steps for a match of n bytes. Decoding joins the ids' byte strings. Both are done in
one Python worker where both are wanted: a second one per task would remember the same pieces again.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from faremill.llm.common import arrow_parts, enter, free_names, keep_cache, sized

# What a worker remembers of pieces, in bytes as Python holds them.
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 190
# Texts are encoded and decoded this many bytes at a time: some sixty bytes are held meanwhile for each id, by a rough count.
PART_BYTES = 1_000_000
BUCKET_KEYS = 2
# Ids decoded at a time.
IDS = 1_000_000
_ENCODERS: dict[str, "RankEncoder"] = {}
_BUILT: dict[str, "PerfectHash"] = {}
keep_cache("bpe", _ENCODERS.clear)


def read_ranks(text: str) -> dict[bytes, int]:
    """A rank file: a line per entry, base64 of the bytes and the id."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in text.splitlines() if line)}


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots, one displacement per bucket of about two keys.

    Keys are dealt to buckets by one half of a 64-bit hash. From the fullest bucket down, a displacement is sought that sends a
    bucket's keys to free slots; buckets of one key store their slot directly as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        self.n = max(1, len(keys))
        self.buckets = self.n // BUCKET_KEYS + 1
        for self.seed in range(100):
            if self._build(keys):
                break
        else:
            raise ValueError("no perfect hash found; are the keys distinct?")

    def _place(self, h: int, d: int) -> int:
        return ((h >> 32) + d * ((h & 0xFFFFFFFF) | 1) + (d * d * 0x9E3779B1 >> 7)) % self.n

    def _build(self, keys: list[bytes]) -> bool:
        groups: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k, self.seed) for k in keys]
        for k, h in enumerate(hashes):
            groups.setdefault(h % self.buckets, []).append(k)
        self.displace = [0] * self.buckets
        self.slots = [-1] * self.n
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:
                continue
            for d in range(1, 1 << 20):
                places = [self._place(hashes[k], d) for k in members]
                if len(set(places)) == len(places) and all(self.slots[p] < 0 for p in places):
                    break
            else:
                return False
            self.displace[bucket] = d
            for k, p in zip(members, places):
                self.slots[p] = k
        free = iter([p for p in range(self.n) if self.slots[p] < 0])
        for bucket, members in groups.items():
            if len(members) == 1:
                place = next(free)
                self.displace[bucket] = -place - 1
                self.slots[place] = members[0]
        return True

    def slot_of(self, key: bytes) -> int:
        """The only slot the key can be in; the caller compares what is stored there."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        d = self.displace[h % self.buckets]
        return -d - 1 if d < 0 else self._place(h, d)


def merge(piece: bytes, rank_of, single: list[int], pairs: list[int | None]) -> list[int]:
    """Merge neighbouring parts, lowest rank first and leftmost among equals, until no pair has a rank; the ids of the parts that are left.

    `single` has the id of each byte, `pairs` that of each two bytes that have one. `ends` and `before` link the parts; the heap holds
    (rank, start, middle, end) of every pair that had a rank when it arose, and entries whose parts have changed since are passed over.
    """
    n = len(piece)
    ids = [single[x] for x in piece]  # of the part that starts here, -1 once it was merged away
    ends = list(range(1, n + 1))  # the end of the part that starts here, 0 once it was merged away
    before = list(range(-1, n - 1))
    first = [pairs[x << 8 | y] for x, y in zip(piece, piece[1:])]
    heap = [(rank, a, a + 1, a + 2) for a, rank in enumerate(first) if rank is not None]
    heapify(heap)
    while heap:
        rank, a, b, end = heappop(heap)
        if ends[a] != b or ends[b] != end:
            continue
        ends[a], ends[b] = end, 0
        ids[a], ids[b] = rank, -1
        if end < n:
            before[end] = a
            after = ends[end]
            if (rank := rank_of(piece[a:after])) is not None:
                heappush(heap, (rank, a, end, after))
        left = before[a]
        if left >= 0 and (rank := rank_of(piece[left:end])) is not None:
            heappush(heap, (rank, left, a, end))
    return [i for i in ids if i >= 0]


class _Pieces(dict):
    """Ids of pieces met before; an unknown one is encoded and remembered. When they take half of CACHE_BYTES they become the older half,
    which goes when the next one is full; of it what is met again stays. So pieces that come often are never encoded anew, however many
    come once. A piece that alone would take a hundredth of CACHE_BYTES is not remembered."""

    def __init__(self, encode):
        self.encode = encode
        self.older: dict[str, bytes] = {}
        self.bytes = 0

    def clear(self) -> None:
        super().clear()
        self.older = {}
        self.bytes = 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.pop(piece, None)
        if ids is None:
            ids = array("i", self.encode(piece.encode())).tobytes()
        size = ENTRY_BYTES + 4 * len(piece) + len(ids)
        if size * 100 < CACHE_BYTES:
            if 2 * (self.bytes + size) > CACHE_BYTES:
                self.older = {}  # gone before the copy is made
                self.older = dict(self)
                super().clear()
                self.bytes = 0
            self.bytes += size
            self[piece] = ids
        return ids


class RankEncoder:
    """Encodes text by a rank table. Every single byte must be in the table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, perfect: PerfectHash | None = None):
        self.ranks = ranks
        self.keys = sorted(ranks, key=ranks.get)
        self.ids = [ranks[k] for k in self.keys]
        self.perfect = perfect or PerfectHash(self.keys)
        self.find = regex.compile(pattern).findall
        self.longest = max(map(len, self.keys))
        self.single = [ranks.get(bytes([x])) for x in range(256)]
        self.pairs = [ranks.get(bytes([x, y])) for x in range(256) for y in range(256)]
        self.known = _Pieces(self.encode_piece)

    def whole(self, piece: bytes) -> int | None:
        """The id of a piece that is in the vocabulary as it stands."""
        if len(piece) > self.longest:
            return None
        k = self.perfect.slots[self.perfect.slot_of(piece)]
        return self.ids[k] if self.keys[k] == piece else None

    def encode_piece(self, piece: bytes) -> list[int]:
        found = self.whole(piece)
        return [found] if found is not None else merge(piece, self.ranks.get, self.single, self.pairs)

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.find(text))), "<i4")


class RankDecoder:
    """The bytes of ids: the table's byte strings by place, and the place of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.words = pa.array(ranks.keys(), pa.binary())
        ids = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.order = np.argsort(ids)
        self.ids = ids[self.order]

    def decode(self, flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """A binary per row, whose ids are flat[offsets[k] : offsets[k + 1]]. An unknown id is an error."""
        at = np.minimum(np.searchsorted(self.ids, flat), len(self.ids) - 1)
        if (wrong := self.ids[at] != flat).any():
            raise KeyError(int(flat[wrong][0]))
        joined = self.words.take(pa.array(self.order[at]))
        # the strings lie one behind the other, so a row is what lies between its first and its last
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(joined).to_numpy(), dtype=np.int64)])[offsets]
        parts = pa.concat_arrays([pa.array([b""], pa.binary()), joined])  # never without a buffer
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends.astype(np.int32)), parts.buffers()[2]])


def _perfect(key: str, ranks: dict[bytes, int]) -> PerfectHash:
    """The hash of a vocabulary, built once per driver."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = PerfectHash(sorted(ranks, key=ranks.get))
    return _BUILT[key]


def _encoder(key: str, shared, pattern: str) -> RankEncoder:
    """One encoder per worker process and vocabulary."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        ranks, perfect = shared.value
        _ENCODERS[key] = RankEncoder(ranks, pattern, perfect)
    return _ENCODERS[key]


def encode_column(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", into: str = "ids", decoded: str | None = None, keep_text: bool = True
) -> DataFrame:
    """docs with a column `into` (array of int): the ids of each whole text, without special tokens. A null or empty text has none.
    With `decoded` a column of that name has the bytes that those ids decode to.

    All other input columns stay as they are, the text too unless `keep_text` is False; a column already named `into` is replaced. The
    table and its perfect hash are built once and broadcast: their size is the vocabulary's, not the corpus's. A text that is kept
    crosses to the worker once, not a second time to be encoded.
    """
    new = [T.StructField(into, T.ArrayType(T.IntegerType(), False))] + ([T.StructField(decoded, T.BinaryType())] if decoded else [])
    work, = free_names(docs, "text_to_encode")
    frame = docs.withColumn(work, F.col(f"`{text_col}`").cast("string")).drop(*[f.name for f in new], *([] if keep_text else [text_col]))
    rest = frame.drop(work).schema.fields
    kept = [f.name for f in rest if f.name.lower() == text_col.lower() and f.dataType == T.StringType()]
    if len(kept) == 1:
        frame, (work,) = frame.drop(work), kept
    stamp = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((ranks, _perfect(stamp, ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("bpe")
        encoder = _encoder(stamp, shared, pattern)
        decoder = RankDecoder(encoder.ranks) if decoded else None
        for batch in batches:
            text = batch.schema.get_field_index(work)
            places = [k for k in range(len(rest) + 1) if k != text] if len(kept) != 1 else range(len(rest))
            for part in arrow_parts(batch, work, PART_BYTES):
                found = [encoder.encode(t or "") for t in part.column(text).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                flat = np.concatenate([*found, np.zeros(0, "<i4")])
                made = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))]
                if decoder:
                    made.append(decoder.decode(flat, offsets))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), *made], names=[f.name for f in [*rest, *new]])

    return frame.mapInArrow(run, T.StructType([*rest, *new]))


def decode_column(frame: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """frame with a binary column `into`: the bytes of each row's ids. No ids, or null, give no bytes; an unknown id is an error."""
    frame = frame.drop(into)
    shared = frame.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = RankDecoder(shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in sized(sizes, IDS):
                flat = column.slice(a, b - a).flatten()
                if flat.null_count:
                    raise KeyError(None)
                offsets = np.concatenate([[0], np.cumsum(sizes[a:b], dtype=np.int64)])
                texts = decoder.decode(flat.to_numpy(), offsets)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, texts], names=[*batch.schema.names, into])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField(into, T.BinaryType())]))


def bpe_digest(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, the number of ids, the sha256 of the decimal ids and of the bytes they decode to."""
    both = encode_column(docs.select("doc_id", "text"), ranks, pattern, decoded="decoded", keep_text=False)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
