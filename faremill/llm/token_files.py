"""Token files: documents as frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

A token id is replaced by its rank among all ids by frequency, so that common tokens take one byte. Four ranks share a control
byte of two bits each (length less one), kept in a stream of its own next to the data bytes; numpy decodes both with one
256-row table lookup. Blocks hold whole documents in ascending doc_id order and are rows of a Parquet table, so any store Spark
writes to will do and a lost task is simply run again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from faremill.llm.common import Written, enter, keep_cache, text_batches
from faremill.session import fresh_path

BLOCK_TOKENS = 1 << 16
CHUNK_ENTRIES = 1_000_000
PIECE_ENTRIES = 400_000
_PIECE = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_TOKENIZERS: dict[int, "ChunkTokenizer"] = {}
keep_cache("token files", _TOKENIZERS.clear)


def _byte_letters() -> dict[int, str]:
    """The visible letter byte-level vocabularies write for each byte: itself if printable Latin-1, else the next letter from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class _Chunks(dict):
    """Ids of chunks; an unknown one is worked out and remembered, up to CHUNK_ENTRIES of them."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CHUNK_ENTRIES:
            self.clear()
        ids = self[chunk] = self.learn(chunk)
        return ids


class ChunkTokenizer:
    """encode() of the tokenizers library over whole texts, with what was encoded before remembered per blank-separated chunk.

    The vocabulary's normalizer maps white space to blanks and its pre-tokenizer drops them, so no token or merge crosses a blank and
    a text's ids are those of its chunks in order. Chunks of printable ASCII and Latin letters without an apostrophe are cut into the
    pre-tokenizer's own pieces and go to the library's BPE model directly; all others go through the library's full encode. Both short
    cuts are tried on probes when a vocabulary is loaded, and left out for one they don't hold for. Memory is bounded: the caches
    are emptied when full.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.special = [t["content"] for t in json.loads(spec).get("added_tokens", [])]
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.chunks = _Chunks(self._learn)
        self.plain = False
        self.blank_safe, self.plain = self._short_cuts()

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _short_cuts(self) -> tuple[bool, bool]:
        words = ["Don't", "x9y10", "naïve,", "#$%", "a.b", "I'LL", "--", "Été.", "ß9ÿ!", "ÀÞx%%%"]
        lowers = '"Lowercase"' in json.dumps(json.loads(self.tok.to_str()).get("normalizer"))
        blank = self._whole("  ".join(words) + "\n" + "\n ".join(words)) == b"".join(map(self._whole, words * 2)) and self._whole(" \n ") == b""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        return blank, blank and lowers and all(b"".join(map(self._piece, _PIECE.findall(w.lower()))) == self._whole(w) for w in plain)

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= PIECE_ENTRIES:
                self.pieces.clear()
            letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            found = self.pieces[piece] = np.asarray([t.id for t in self.tok.model.tokenize(letters)], "<u4").tobytes()
        return found

    def _learn(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        # an apostrophe may start a contraction; an added token is cut out before anything else
        if self.plain and _PLAIN.fullmatch(chunk) and not any(s in chunk for s in self.special):
            return b"".join([self._piece(p) for p in _PIECE.findall(chunk.lower())])
        return self._whole(chunk)

    def _folded(self, text: str) -> str:
        """The text in lower case where that can't change its ids: Latin-1 only (nothing composes, no letter depends on its neighbours)
        and free of added tokens; so that fewer chunks differ."""
        if not self.plain:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        lower = text.lower()
        return text if any(s.lower() in lower for s in self.special) else lower

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        look = self.chunks.__getitem__
        if not self.blank_safe:
            return [self._whole(t or "") for t in texts]
        return [b"".join(map(look, self._folded(t or "").replace("\n", " ").split(" "))) for t in texts]


def tokenizer(spec: str) -> ChunkTokenizer:
    """One tokenizer per worker process and vocabulary."""
    key = hash(spec)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = ChunkTokenizer(spec)
    return _TOKENIZERS[key]


_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    keep = np.arange(4) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The first `count` numbers of a packed pair: lengths by table lookup, places by a running sum, bytes gathered column by column."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    if count and ends[-1] != len(data):
        raise ValueError("control bytes and data bytes of a token block disagree")
    out = raw[starts].astype(np.uint32) if count else np.zeros(0, np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        out[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def vocabulary_size(spec: str, end_id: int) -> int:
    parsed = json.loads(spec)
    return max([end_id, *parsed["model"]["vocab"].values(), *(t["id"] for t in parsed.get("added_tokens", []))]) + 1


def id_type(vocabulary: int) -> str:
    """Two bytes hold every id of a vocabulary of up to 65,536; they are used between the passes, not in the files."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encode_documents(docs: DataFrame, spec: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text with `end_id` appended, little-endian and as wide as `id_type` says. A null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    end = np.asarray([end_id], "<u4").tobytes()
    narrow = id_type(vocabulary_size(spec, end_id))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("token files")
        tok = tokenizer(shared.value)
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in text_batches(texts):
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b], "ids": [np.frombuffer(x + end, "<u4").astype(narrow).tobytes() for x in tok.encode(texts[a:b])]})

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInPandas(_nullable(run), "doc_id bigint, ids binary")


def _nullable(run):
    """Hand doc_id over as a nullable integer, never as a float with NaN."""

    def inner(batches):
        yield from run(b.assign(doc_id=b["doc_id"].astype("Int64")) for b in batches)

    return inner


def id_ranks(encoded: DataFrame, vocabulary: int) -> np.ndarray:
    """The rank of every id by falling frequency, ties to the smaller id. Counts are summed up per task before the shuffle; what comes
    to the driver has a row per id of the vocabulary at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                total += np.bincount(np.frombuffer(ids, id_type(vocabulary)), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    total = np.zeros(vocabulary, np.int64)
    for row in encoded.select("ids").mapInPandas(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        total[row["id"]] = row["n"]
    order = np.lexsort((np.arange(vocabulary), -total))
    ranks = np.empty(vocabulary, np.int64)
    ranks[order] = np.arange(vocabulary)
    return ranks


BLOCKS = "part int, block int, first bigint, doc_ids array<bigint>, counts array<bigint>, control binary, data binary"


def write_token_files(docs: DataFrame, path: str, spec: str, end_id: int = 1, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write them below `path` in ascending doc_id order.

    `path/blocks` has the packed blocks (part, block: place in the order; first: tokens before it within its part), `path/ranks` the id
    of each rank. Null ids come first; rows with equal ids are ordered by a hash of their tokens and then the tokens, so one id with a
    third of the rows still spreads over the parts. A document is never cut, so a block holds one document at least. An empty table
    writes empty files.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary_size(spec, end_id)
    encoded = Written(encode_documents(docs, spec, end_id, id_col, text_col), "encoded")
    ranks = id_ranks(encoded.df, vocabulary)
    shared = spark.sparkContext.broadcast(ranks.astype("<u4"))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, arrays, size = [], [], 0

        def block() -> pd.DataFrame:
            ids = np.concatenate(arrays)
            control, data = pack(shared.value[ids])
            return pd.DataFrame({"part": [part], "block": [number], "first": [first], "doc_ids": [doc_ids], "counts": [[len(a) for a in arrays]], "control": [control], "data": [data]})

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], batch["ids"]):
                doc_ids.append(None if doc_id is pd.NA else int(doc_id))
                arrays.append(np.frombuffer(ids, id_type(vocabulary)))
                size += len(arrays[-1])
                if size >= block_tokens:
                    yield block()
                    number, first = number + 1, first + size
                    doc_ids, arrays, size = [], [], 0
        if arrays:
            yield block()

    ordered = encoded.df.withColumn("salt", F.xxhash64("ids")).repartitionByRange("doc_id", "salt").sortWithinPartitions("doc_id", "salt", "ids")
    ordered.select("doc_id", "ids").mapInPandas(_nullable(blocks), BLOCKS).write.parquet(f"{path}/blocks")
    encoded.drop()
    by_rank = np.empty(vocabulary, np.int64)
    by_rank[ranks] = np.arange(vocabulary)
    spark.createDataFrame(pd.DataFrame({"rank": np.arange(vocabulary), "id": by_rank})).coalesce(1).write.parquet(f"{path}/ranks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of a token file set; start counts the tokens of all documents before it."""
    blocks = spark.read.parquet(f"{path}/blocks")
    # a row per part, so as many as the writer had tasks
    parts = sorted((r["part"], r["n"]) for r in blocks.select("part", F.expr("aggregate(counts, 0L, (a, x) -> a + x)").alias("n")).groupBy("part").agg(F.sum("n").alias("n")).collect())
    offsets, total = {}, 0
    for part, n in parts:
        offsets[part] = total
        total += n
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy("<u4")
    shared = spark.sparkContext.broadcast((offsets, table))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        offsets, by_rank = shared.value
        for batch in batches:
            for row in batch.itertuples(index=False):
                counts = np.asarray(row.counts, np.int64)
                ends = np.cumsum(counts)
                ids = by_rank[unpack(row.control, row.data, int(ends[-1]))]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None if x is None or x != x else int(x) for x in row.doc_ids], "Int64"),
                        "start": offsets[row.part] + row.first + ends - counts,
                        "ids": [ids[e - c : e].tobytes() for e, c in zip(ends, counts)],
                    }
                )

    return blocks.mapInPandas(run, "doc_id bigint, start bigint, ids binary")


def token_file_digest(docs: DataFrame, spec: str, end_id: int = 1) -> DataFrame:
    """Write the documents' token files to the shared folder, read them back and describe each document by what was read."""
    path = fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, spec, end_id)
    back = read_token_files(docs.sparkSession, path)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
