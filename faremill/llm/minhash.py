"""Near duplicates by fast similarity sketching.

A sketch has T coordinates. In round i every shingle is hashed to one bin, where the smallest value of the earliest round stays; from
round T on it goes to bin i - T, so all coordinates are filled after 2T rounds at most and after one or two for longer texts. The number
of equal coordinates of two sketches estimates their Jaccard similarity with the concentration of independent samples. Bands of
coordinates give candidate buckets and every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import Written, enter, free_names, side, text_batches
from faremill.llm.components import components
from faremill.llm.hashing import mix, word_hashes

T = 128
MISS = 1e-6
# Texts are described this many characters at a time.
PART_CHARS = 1_000_000
# one group of set comparisons holds at most about twice so many shingles and rows
GROUP_SHINGLES = 1_000_000
GROUP_ROWS = 1500


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles. A-Z are lower-cased and words end at ASCII white space; with fewer than
    `size` words the whole sequence is one shingle; no words, none."""
    hashes, _, _ = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    out = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out ^ hashes[k : len(hashes) - width + 1 + k]) + np.uint64(0x9E3779B97F4A7C15)
    return np.unique(out)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """A row of T coordinates per non-empty set; a coordinate is the round it was filled in and the smallest hash there."""
    counts = np.array([len(s) for s in sets])
    out = np.full((len(sets), T), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), counts)
    for turn in range(2 * T):
        hashed = mix(elements ^ mix(np.array([turn + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        bins = (hashed >> np.uint64(57)).astype(np.int64) if turn < T else np.full(len(hashed), turn - T)
        np.minimum.at(flat, owner * T + bins, np.uint64(turn) << np.uint64(40) | hashed & np.uint64((1 << 40) - 1))
        unfilled = (out == np.iinfo(np.uint64).max).any(1)
        if not unfilled.any():
            break
        keep = unfilled[owner]
        elements, owner = elements[keep], owner[keep]
    return out


def rows_per_band(threshold: float) -> int:
    """The most rows per band with which a pair at the threshold is missed with a chance of at most MISS."""
    return max(r for r in range(1, 9) if (1 - threshold**r) ** (T // r) <= MISS or r == 1)


def bands(coordinates: np.ndarray, rows: int) -> np.ndarray:
    count = T // rows
    out = np.tile(np.arange(count, dtype=np.uint64), (len(coordinates), 1))
    for k in range(rows):
        out = mix(out ^ coordinates[:, k : count * rows : rows]) + np.uint64(0x9E3779B97F4A7C15)
    return out.view(np.int64)


def similar(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Which sets have den * intersection >= num * union: the places of sets that may link with any, and a matrix over those."""
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        link = den * both >= num * (len(sets[0]) + len(sets[1]) - both)
        return np.arange(2), np.array([[False, link], [link, False]])
    rows = np.arange(len(sets))
    while len(rows) > 1:
        # a set with too many members that no other has can't link with any
        size = np.array([len(sets[k]) for k in rows])
        values, inverse, freq = np.unique(np.concatenate([sets[k] for k in rows]), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(rows)), size)
        shared = np.bincount(owner, freq[inverse] > 1, minlength=len(rows))
        keep = den * shared >= num * size
        if keep.all():
            break
        rows = rows[keep]
    if len(rows) < 2:
        return rows[:0], np.zeros((0, 0), bool)
    column = np.cumsum(freq > 1) - 1
    used = freq[inverse] > 1
    owner, column = owner[used], column[inverse[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(rows), len(rows)), np.float32)
    width = 4096
    for first in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, (first, first + width))
        block = np.zeros((len(rows), width), np.float32)
        block[owner[a:b], column[a:b] - first] = 1
        both += block @ block.T
    links = den * both.astype(np.float64) >= num * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(links, False)
    return rows, links


def _linked(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect all sets that are similar, no more than are needed to connect them."""
    rows, links = similar(sets, num, den)
    out, left = [], np.ones(len(rows), bool)
    for root in range(len(rows)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            k = todo.pop()
            new = np.flatnonzero(links[k] & left)
            left[new] = False
            todo += new.tolist()
            out += [(int(rows[k]), int(rows[x])) for x in new]
    return out


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, root) for every row; documents link if den * intersection >= num * union.

    Texts with equal shingle sets are one class from the start, so copies cost one row of work. Classes meet in the buckets of their
    bands (a pair at the threshold shares none with a chance of MISS at most); buckets of the same members are taken once; the sets of
    classes in a bucket are compared in groups of bounded size, a large bucket in blocks of block pairs, and the links found that
    connect them are joined to components. component_id is the smallest id of the component.

    Null or wordless texts have no shingles and link with nothing, each its own component (its id). Null ids take part; a component
    of null ids alone has a null component_id. Rows that repeat an id count as they are. Other columns are not looked at. text_key
    is the text's md5 (null for a null text): with the id it tells which row is meant; root names the component, also one of null ids. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = rows_per_band(num / den)
    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).withColumn("text_key", F.unhex(F.md5("text")))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("minhash")
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in text_batches(texts, PART_CHARS):
                sets = [shingles(t, size) for t in texts[a:b]]
                full = [k for k, s in enumerate(sets) if len(s)]
                names, signs = [None] * len(sets), [None] * len(sets)
                if full:
                    found = bands(sketch([sets[k] for k in full]), rows)
                    for k, row in zip(full, found):
                        names[k], signs[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest(), row
                yield pd.DataFrame(
                    {"doc_id": batch["doc_id"].iloc[a:b].astype("Int64"), "text_key": batch["text_key"].iloc[a:b], "class": names, "n": [len(s) for s in sets], "bands": signs}
                )

    sketched = Written(plain.mapInPandas(describe, "doc_id bigint, text_key binary, class binary, n bigint, bands array<bigint>"), "sketches")
    classes = Written(sketched.df.where("class is not null").select("class", "n", "text_key", "bands").dropDuplicates(["class"]), "classes", shuffled=True)
    placed = classes.df.select("class", "n", "text_key", F.posexplode("bands").alias("band", "sign"))
    buckets = placed.groupBy("band", "sign").agg(
        F.count("*").alias("members"), F.sum("n").alias("elements"), F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64("class", F.lit(7))).alias("y")
    )
    # buckets of the same members are one
    alike = buckets.where("members > 1").groupBy("members", "elements", "x", "y").agg(F.min(F.struct("band", "sign")).alias("first"))
    blocks = F.greatest(F.ceil(F.col("elements") / GROUP_SHINGLES), F.ceil(F.col("members") / GROUP_ROWS)).cast("int")
    kept = Written(alike.select("first.band", "first.sign", blocks.alias("blocks")), "buckets", shuffled=True)
    members = Written(placed.join(side(kept), ["band", "sign"]).select("band", "sign", "blocks", "class", "text_key"), "members", shuffled=True)
    kept.drop()
    wanted = Written(members.df.select("class", "text_key").distinct(), "wanted", shuffled=True)
    texts = plain.select("text", "text_key").join(side(wanted), "text_key").dropDuplicates(["text_key"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"class": batch["class"], "shingles": [shingles(t, size).tobytes() for t in batch["text"]]})

    sets = Written(texts.select("class", "text").mapInPandas(gather, "class binary, shingles binary"), "sets", shuffled=True)
    wanted.drop()
    classes.drop()
    # a bucket of k blocks is compared as k (k + 1) / 2 pairs of blocks
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))
    dealt = members.df.drop("text_key").withColumn("block", block).withColumn("pair", F.explode(others)).select("band", "sign", "pair.i", "pair.j", "class")
    grouped = dealt.join(sets.df, "class").repartition("band", "sign", "i", "j").sortWithinPartitions("band", "sign", "i", "j", "class")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, names, held, out = None, [], [], []

        def links() -> None:
            out.extend((names[a], names[b]) for a, b in _linked(held, num, den))

        for batch in batches:
            for band, sign, i, j, name, packed in zip(*(batch[c].tolist() for c in ("band", "sign", "i", "j", "class", "shingles"))):
                if (band, sign, i, j) != key:
                    if len(held) > 1:
                        links()
                    key, names, held = (band, sign, i, j), [], []
                names.append(name)
                held.append(np.frombuffer(packed, np.uint64))
            yield pd.DataFrame(out, columns=["a", "b"])
            out.clear()
        if len(held) > 1:
            links()
        yield pd.DataFrame(out, columns=["a", "b"])

    links = Written(grouped.select("band", "sign", "i", "j", "class", "shingles").mapInPandas(compare, "a binary, b binary").distinct(), "links", shuffled=True)
    sets.drop()
    members.drop()
    roots = components(links.df)
    links.drop()
    ids = sketched.df.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least_id"))
    named = ids.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    heads = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = Written(named.join(heads, "root").select("class", "root", "component_id"), "class-components", shuffled=True)
    out = sketched.df.drop("bands").join(by_class.df, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), "root")


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one document of each component, the one of the smallest id, nulls last, then of the smallest text hash; all columns stay.

    Rows that share an id and a text are one document and stay or go together, rows without an id too; rows without words stay.
    """
    key, gone, least = free_names(docs, "text_key", "gone_id", "kept")
    found = Written(near_duplicates(docs, size, num, den).where("root is not null").select("root", "doc_id", "text_key"), "members")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    firsts = found.df.groupBy("root").agg(F.min(rank).alias(least), F.count("*").alias("n")).where("n > 1")
    others = found.df.join(firsts.select("root", least), "root").where(rank != F.col(least))
    going = Written(others.select(F.col("doc_id").alias(gone), F.col("text_key").alias(key)).distinct(), "removed", shuffled=True)
    found.drop()
    marked = docs.withColumn(key, F.unhex(F.md5(F.col("text").cast("string"))))
    drop = side(going)
    return marked.join(drop, (marked[key] == drop[key]) & marked["doc_id"].cast("bigint").eqNullSafe(drop[gone]), "left_anti").drop(key)
