"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of tokens; the tokens at its open places are ignored, so a hash still agrees where words were
replaced there. Test and training hashes are joined, each joint hash gives an item, a document and a diagonal (the offset of one
against the other), and the overlap along the diagonal is verified token by token, substitutions allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import Written, enter, free_names, keep_cache, side, text_batches
from faremill.llm.hashing import mix

MASKS = ("111111", "1101100101", "1011010011", "1110001101")
# Items of SHORT tokens at most also have a light mask: of six to eleven tokens of which four fifths agree, three in a row do.
LIGHT, SHORT = "111", 11
LEAST = 6
FILTER_BITS = 24
MIN_MATCHED = 12
MIN_SHARE = 0.8
# What a worker remembers of chunks, in bytes as Python holds them.
CACHE_BYTES = 80 << 20
ENTRY_BYTES = 180


# Scripts written without blanks between words: kana, Han, Thai, Lao, Burmese and Khmer. Each of their characters is a token.
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
CUT = 2


class _Tokens(dict):
    """The hash of a blank-separated chunk's letters and digits in lower case, an odd number; 0 if it has none, CUT if it is several tokens."""

    def __init__(self):
        self.bytes = 0

    def clear(self) -> None:
        super().clear()
        self.bytes = 0

    def __missing__(self, chunk: str) -> int:
        several = not chunk.isascii() and len(chunk) > 1 and UNSPACED.search(chunk)
        plain = chunk.lower()
        plain = plain if plain.isalnum() else "".join([c for c in plain if c.isalnum()])
        value = CUT if several else xxhash.xxh3_64_intdigest(plain) | 1 if plain else 0
        size = ENTRY_BYTES + 4 * len(chunk)
        # a chunk that alone would take a hundredth is not remembered
        if size * 100 < CACHE_BYTES:
            if self.bytes + size > CACHE_BYTES:
                self.clear()
            self.bytes += size
            self[chunk] = value
        return value


_TOKENS = _Tokens()
keep_cache("benchmark", _TOKENS.clear)


def tokens(text: str | None) -> np.ndarray:
    chunks = (text or "").split()
    found = np.fromiter(map(_TOKENS.__getitem__, chunks), np.uint64, len(chunks))
    if (found == CUT).any():
        chunks = UNSPACED.sub(r" \1 ", " ".join(chunks)).split()
        found = np.fromiter(map(_TOKENS.__getitem__, chunks), np.uint64, len(chunks))
    return found[found != 0]


def masks_for(length: int) -> tuple[str, ...]:
    """The masks an item of so many tokens is looked for with."""
    return () if length < LEAST else MASKS + (LIGHT,) if length <= SHORT else MASKS


def seed_hashes(found: np.ndarray, masks: tuple[str, ...] = MASKS) -> Iterator[np.ndarray]:
    """For each mask the hashes of all windows, by start."""
    for number, mask in enumerate(masks):
        n = len(found) - len(mask) + 1
        out = np.full(max(0, n), number + 1, np.uint64)
        if n > 0:
            for k, kept in enumerate(mask):
                if kept == "1":
                    out = (out ^ found[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                    out ^= out >> np.uint64(29)
        yield out


def overlap(item: np.ndarray, doc: np.ndarray, diagonal: int, share: Fraction) -> tuple[int, int, int]:
    """The stretch of item along a diagonal (item place + diagonal = document place) with most matches of those of which `share` agree,
    the shortest and then the first of several: its start and end in the item and its matches.

    A match counts 1 - share and a substitution -share, in whole numbers; a stretch is good if its sum is not negative. The more a
    stretch takes in, the more matches it has, so each end goes with the first start whose sum before it is not larger.
    """
    a, b = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if b <= a:
        return 0, 0, 0
    same = item[a:b] == doc[a + diagonal : b + diagonal]
    matches = np.concatenate([[0], np.cumsum(same)])
    sums = share.denominator * matches - share.numerator * np.arange(len(matches))
    first = np.searchsorted(-np.minimum.accumulate(sums), -sums)
    matched = matches - matches[first]
    best = int(matched.max())
    if not best:
        return 0, 0, 0
    ends = np.flatnonzero(matched == best)
    starts = np.flatnonzero(same)[matches[first[ends]]]
    k = int(np.argmin(ends - starts))
    return a + int(starts[k]), a + int(ends[k]), best


def contaminated(docs: DataFrame, benchmark: DataFrame, min_matched: int = MIN_MATCHED, min_share: float = MIN_SHARE, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(text_key, item_id, item_tokens, matched, substituted, doc_start, doc_end): the overlaps of document texts and benchmark items.

    Tokens are a text's blank-separated words reduced to lower-case letters and digits. An overlap counts with `min_matched` equal
    tokens, or `min_share` of a shorter item, of which `min_share` agree; per text and item the one with most matches is returned,
    in token places of the document. In scripts without blanks each character is a token. Items of six to eleven tokens are found
    wherever the default rule holds; longer ones where a mask fits. Items of fewer than six tokens can't be told from chance and are never found, nor are null or
    empty texts on either side. text_key is the text's md5; items that repeat an id or a text are reported each.

    Training windows pass a filter of 2**FILTER_BITS bits with the test hashes (its size is fixed; with more test hashes than it can
    tell apart, more windows go on to the join, which decides) so that only windows of contaminated texts are shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("item_text")).where("item_text is not null")
    items = items.withColumn("item_key", F.unhex(F.md5("item_text")))
    shift = np.uint64(64 - FILTER_BITS)
    share = Fraction(min_share).limit_denominator(1_000_000)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["item_key"], batch["item_text"]):
                found = tokens(text)
                for hashes in seed_hashes(found, masks_for(len(found))):
                    if len(hashes):
                        yield pd.DataFrame({"hash": hashes.view(np.int64), "item_key": [key] * len(hashes), "item_pos": np.arange(len(hashes), dtype=np.int32)})

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [len(tokens(text)) for text in batch["item_text"]]})

    # documents are cut by the light mask only if some item asks for it
    short = not items.select("item_text").mapInPandas(lengths, "n int").where(F.col("n").between(LEAST, SHORT)).isEmpty()
    masks = MASKS + (LIGHT,) if short else MASKS
    tests = Written(items.select("item_key", "item_text").dropDuplicates(["item_key"]).mapInPandas(index, "hash bigint, item_key binary, item_pos int"), "test-hashes")

    def bitmap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[batch["hash"].to_numpy().view(np.uint64) >> shift] = True
        yield pd.DataFrame({"bits": [np.packbits(bits, bitorder="little").tobytes()]})

    merged = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in tests.df.select("hash").mapInPandas(bitmap, "bits binary").toLocalIterator():
        merged |= np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(merged.tobytes())
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null").withColumn("text_key", F.unhex(F.md5("text")))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("benchmark")
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rows = batch["text"].tolist()
            for a, b in text_batches(rows, 1_000_000):
                found = [tokens(t) for t in rows[a:b]]
                ends = np.cumsum([len(f) for f in found])
                every = np.concatenate(found)
                for mask, hashes in zip(masks, seed_hashes(every, masks)):
                    place = hashes >> shift
                    at = np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    owner = np.searchsorted(ends, at, side="right")
                    inside = at + len(mask) <= ends[owner] if len(at) else np.zeros(0, bool)
                    at, owner = at[inside], owner[inside]
                    if len(at):
                        starts = np.concatenate([[0], ends[:-1]])
                        yield pd.DataFrame({"text_key": batch["text_key"].to_numpy()[a + owner], "hash": hashes[at].view(np.int64), "pos": (at - starts[owner]).astype(np.int32)})

    hits = texts.mapInPandas(probe, "text_key binary, hash bigint, pos int")
    paired = hits.join(side(tests), "hash").groupBy("text_key", "item_key").agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("diagonals"))
    pairs = Written(paired, "seed-pairs", shuffled=True)
    tests.drop()
    wanted = Written(pairs.df.select("text_key").distinct(), "seed-texts", shuffled=True)
    suspects = texts.join(side(wanted), "text_key").dropDuplicates(["text_key"])
    candidates = pairs.df.join(suspects, "text_key").join(items.select("item_key", "item_text").dropDuplicates(["item_key"]), "item_key")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                item, doc = tokens(row.item_text), tokens(row.text)
                best = (0, 0, 0, 0)
                for diagonal in sorted(row.diagonals):
                    start, end, matched = overlap(item, doc, diagonal, share)
                    if matched > best[0] and matched >= min(min_matched, share * len(item)):
                        best = (matched, end - start - matched, start + diagonal, end + diagonal)
                if best[0]:
                    out.append((row.text_key, row.item_key, len(item), *best))
            yield pd.DataFrame(out, columns=["text_key", "item_key", "item_tokens", "matched", "substituted", "doc_start", "doc_end"])

    found = candidates.select("text_key", "item_key", "diagonals", "text", "item_text").mapInPandas(
        verify, "text_key binary, item_key binary, item_tokens int, matched int, substituted int, doc_start int, doc_end int"
    )
    out = Written(found.join(items.select("item_key", "item_id"), "item_key").drop("item_key"), "overlaps", shuffled=True)
    pairs.drop()
    wanted.drop()
    return out.df.select("text_key", "item_id", "item_tokens", "matched", "substituted", "doc_start", "doc_end")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document and benchmark item that overlap; clean documents have none. Documents are known by id and text."""
    found = contaminated(docs, benchmark, text_col=text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text_col}`").cast("string"))).alias("text_key"))
    return rows.join(found, "text_key").drop("text_key")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows whose text overlaps a benchmark item; rows with null or empty texts stay, columns stay as they are."""
    key, = free_names(docs, "text_key")
    going = Written(contaminated(docs, benchmark).select(F.col("text_key").alias(key)).distinct(), "contaminated", shuffled=True)
    marked = docs.withColumn(key, F.unhex(F.md5(F.col("text").cast("string"))))
    return marked.join(side(going), key, "left_anti").drop(key)
