"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. Each sentence gets a probability from a logistic model over its words
and word beginnings; a document is toxic if any of its sentences is: P = 1 - product(1 - p) (noisy-or). The model is fitted through that
product from document labels alone, and then says which sentences carry the blame.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import free_names, held_out, side, text_batches, Written
from faremill.llm.langid import _letters

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6)
SEGMENT = 1 << 20
_ENDS = np.zeros(0x110000, bool)
_ENDS[[ord(c) for c in ".!?\n。！？"]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


@dataclass
class Bag:
    """Features of one text: bucket and sentence of each, and the sentences' places in code points."""

    buckets: np.ndarray
    sentence: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def features(text: str) -> Bag:
    """Hashed whole words and word beginnings of the lower-cased text. A sentence ends after . ! ? or a line break, and at a cut of
    SEGMENT characters; stretches without a letter are no sentences."""
    parts, count = [], 0
    for base in range(0, len(text), SEGMENT):
        piece = text[base : base + SEGMENT]
        low = piece.lower()
        codes = np.frombuffer((low if len(low) == len(piece) else "".join([c.lower()[0] for c in piece])).encode("utf-32-le", "surrogatepass"), "<u4")
        inside = _letters()[codes]
        padded = np.concatenate([[False], inside, [False]])
        begin = np.flatnonzero(padded[1:-1] & ~padded[:-2])
        if not len(begin):
            continue
        length = np.flatnonzero(padded[1:-1] & ~padded[2:]) + 1 - begin
        stops = np.cumsum(_ENDS[codes])
        raw = stops[begin]
        first = np.concatenate([[True], raw[1:] != raw[:-1]])
        sentence = np.cumsum(first) - 1
        lead = np.flatnonzero(first)
        last = np.concatenate([lead[1:] - 1, [len(begin) - 1]])
        letters = np.flatnonzero(inside)
        offset = np.cumsum(length) - length
        place = np.arange(len(letters), dtype=np.uint32) - np.repeat(offset, length).astype(np.uint32)
        whole = _mix(np.add.reduceat(_mix(codes[letters] * np.uint32(0x9E3779B1) + place * np.uint32(0x85EBCA6B)), offset, dtype=np.uint32))
        found, owner = [whole], [sentence]
        rolling = np.zeros(len(begin), np.uint32)
        limit = np.append(codes, np.zeros(PREFIXES[-1], np.uint32))
        for k in range(PREFIXES[-1]):
            rolling = _mix(rolling + limit[begin + k] + np.uint32(0x27D4EB2F))
            if k + 1 in PREFIXES:
                longer = np.flatnonzero(length > k + 1)
                found.append(rolling[longer] + np.uint32(k))
                owner.append(sentence[longer])
        parts.append(Bag((np.concatenate(found) & np.uint32(BUCKETS - 1)).astype(np.int32), np.concatenate(owner) + count, base + begin[lead], base + begin[last] + length[last]))
        count += len(lead)
    empty = np.zeros(0, np.int32)
    if not parts:
        return Bag(empty, empty, empty, empty)
    return Bag(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("buckets", "sentence", "starts", "ends")))


@dataclass
class ToxicityModel:
    """A weight per bucket (0 where a bucket wasn't chosen) and the sentences' bias; `fitted` is False if there was nothing to learn."""

    weights: np.ndarray
    bias: float
    fitted: bool = True

    def sentence_scores(self, bag: Bag) -> np.ndarray:
        z = self.bias + np.bincount(bag.sentence, self.weights[bag.buckets], minlength=len(bag.starts))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def score(self, bag: Bag) -> tuple[float, np.ndarray]:
        if not len(bag.starts):
            return 0.0, np.zeros(0)
        each = self.sentence_scores(bag)
        return float(-np.expm1(np.log1p(-np.minimum(each, 1 - 1e-12)).sum())), each


def _fit(rows: np.ndarray, columns: np.ndarray, doc_of: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int, rounds: int, ridge: float) -> tuple[np.ndarray, float]:
    """Gradient descent with per-weight steps on the noisy-or likelihood. rows, columns: sentence and feature of each entry; doc_of:
    the document of each sentence."""
    n = len(doc_of)
    bags = np.maximum(np.bincount(doc_of, minlength=len(y)), 1)
    rate = np.clip((weight * y).sum() / weight.sum(), 1e-4, 0.5)
    w, b = np.zeros(width), float(np.log(rate / np.mean(bags)))
    fast_w, slow_w, fast_b, slow_b = np.zeros(width), np.zeros(width), 0.0, 0.0
    scale = weight.sum()
    for turn in range(1, rounds + 1):
        z = b + np.bincount(rows, w[columns], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        total = np.bincount(doc_of, np.logaddexp(0, z), minlength=len(y))
        push = np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0) * weight / scale
        g = push[doc_of] * p
        gw = np.bincount(columns, g[rows], minlength=width) + ridge * w
        gb = g.sum()
        fast_w, slow_w = 0.9 * fast_w + 0.1 * gw, 0.999 * slow_w + 0.001 * gw * gw
        fast_b, slow_b = 0.9 * fast_b + 0.1 * gb, 0.999 * slow_b + 0.001 * gb * gb
        up, down = 1 - 0.9**turn, 1 - 0.999**turn
        w -= 0.1 * (fast_w / up) / (np.sqrt(slow_w / down) + 1e-9)
        b -= 0.02 * (fast_b / up) / (np.sqrt(slow_b / down) + 1e-9)
    return w, b


def learn(
    docs: DataFrame, labels: DataFrame, docs_per_label: int = 8000, chosen: int = 1 << 11, rounds: int = 300, ridge: float = 1e-5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """Fit on labelled rows that aren't held out, at most about `docs_per_label` of each label (taken by a hash of the id; the loss
    weighs the labels as they are in the whole table).

    Labels of one id are merged: it is toxic if one of its rows says so; null labels and ids are left out. Spark counts in how many
    documents of each label a bucket occurs, the `chosen` buckets that tell the labels apart best are kept, and the kept features
    of the bounded sample are fitted. Without both labels the model scores everything by the bias alone.
    """
    marked = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    marked = marked.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return ToxicityModel(np.zeros(BUCKETS), -12.0 if 1 not in sizes else 0.0, False)
    share = {k: min(1.0, docs_per_label / n) for k, n in sizes.items()}
    drawn = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.when(F.col("toxic") == 1, share[1] * (1 << 20)).otherwise(share[0] * (1 << 20)))
    picked = Written(drawn, "drawn-labels", shuffled=True)
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    sample = Written(texts.join(side(picked), "doc_id").select("toxic", "text"), "drawn-texts")
    picked.drop()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for label, text in zip(batch["toxic"], batch["text"]):
                totals[label, np.unique(features(text).buckets)] += 1
        seen = np.flatnonzero(totals.any(0))
        yield pd.DataFrame({"bucket": seen, "clean": totals[0, seen], "bad": totals[1, seen]})

    counted = sample.df.mapInPandas(count, "bucket int, clean bigint, bad bigint").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where("clean + bad >= 3").toArrow()
    bucket, clean, bad = (counted[c].to_numpy() for c in ("bucket", "clean", "bad"))
    n_bad, n_clean = max(1.0, sizes[1] * share[1]), max(1.0, sizes[0] * share[0])
    lift = np.log((bad + 0.5) / (n_bad + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    strength = np.abs(lift) / np.sqrt(1 / (bad + 0.5) + 1 / (clean + 0.5))
    kept = bucket[np.lexsort((bucket, -strength))[:chosen]]
    column = np.full(BUCKETS, -1, np.int32)
    column[kept] = np.arange(len(kept))
    shared = docs.sparkSession.sparkContext.broadcast(column)

    def compact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for label, text in zip(batch["toxic"], batch["text"]):
                bag = features(text)
                found = shared.value[bag.buckets]
                mine = found >= 0
                pairs = np.unique(bag.sentence[mine].astype(np.int64) << 32 | found[mine])
                out.append((label, len(bag.starts), (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32)))
            yield pd.DataFrame(out, columns=["toxic", "sentences", "row", "col"])

    bags = sample.df.mapInPandas(compact, "toxic int, sentences int, row array<int>, col array<int>").where("sentences > 0").toArrow()
    sample.drop()
    if not len(bags) or not len(kept):
        return ToxicityModel(np.zeros(BUCKETS), -12.0, False)
    y, sentences = bags["toxic"].to_numpy(), bags["sentences"].to_numpy().astype(np.int64)
    first = np.cumsum(sentences) - sentences
    entries = np.array([len(x) for x in bags["row"]])
    rows = np.concatenate([x.values.to_numpy() for x in bags["row"]]) + np.repeat(first, entries)
    columns = np.concatenate([x.values.to_numpy() for x in bags["col"]])
    weight = np.where(y > 0, 1 / share[1], 1 / share[0])
    w, b = _fit(rows, columns, np.repeat(np.arange(len(y)), sentences), y, weight, len(kept), rounds, ridge)
    weights = np.zeros(BUCKETS)
    weights[kept] = w
    return ToxicityModel(weights, b)


def score_documents(docs: DataFrame, model: ToxicityModel, blame: float = 0.5, text_col: str = "text", into: tuple[str, str] = ("score", "offending")) -> DataFrame:
    """docs with the score of each whole text and its offending sentences: (start, end, p) in code points for p >= `blame`.

    A null or empty text, or one without letters, scores 0 and has none. Input columns of these names are replaced.
    """
    docs = docs.drop(*into)
    key, = free_names(docs, "toxicity_found")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, offending array<struct<start:int,end:int,p:double>>")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in parts:
            scores, blamed = [], []
            for text in texts:
                bag = features(text or "")
                total, each = model.score(bag)
                scores.append(total)
                blamed.append([{"start": int(bag.starts[k]), "end": int(bag.ends[k]), "p": float(each[k])} for k in np.flatnonzero(each >= blame)])
            yield pd.DataFrame({"score": scores, "offending": blamed})

    return docs.withColumn(key, found(F.col(f"`{text_col}`").cast("string"))).withColumns({into[0]: F.col(key)["score"], into[1]: F.col(key)["offending"]}).drop(key)
