"""Language identification as mixture inference.

A document is taken as a mixture of languages: each word comes from one of them and its likelihood there is the product of its
letters' trigram probabilities. Expectation-maximisation estimates the document's language proportions; the set of languages is
chosen by likelihood less a penalty per language, and the proportions are those of the chosen set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import enter, free_names, held_out, text_batches

BUCKETS = 1 << 16
SEGMENT = 1 << 20
UNDETERMINED = "und"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed trigram centred on each letter of the lower-cased text, and where words begin among them.

    Whatever is no letter ends a word and is seen by the letters beside it as one and the same mark.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _letters()[codes]
    marks = np.zeros(len(codes) + 2, np.uint32)
    marks[1:-1] = np.where(inside, codes, 0)
    at = np.flatnonzero(marks)
    mixed = marks[at - 1] * np.uint32(0x9E3779B1) + marks[at] * np.uint32(0x85EBCA6B) + marks[at + 1] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(16)).astype(np.int32), np.flatnonzero(marks[at - 1] == 0)


def _segments(text: str) -> Iterator[str]:
    """Long texts in pieces of bounded size; a word that crosses a cut counts as two."""
    for a in range(0, len(text), SEGMENT):
        yield text[a : a + SEGMENT]


@dataclass
class LanguageModel:
    """Languages and, per trigram bucket, the log probability in each; no languages if nothing was learned."""

    languages: list[str]
    table: np.ndarray
    penalty: float = 2.0
    rounds: int = 40

    def word_scores(self, text: str) -> np.ndarray:
        """Log likelihood of each word in each language."""
        found = []
        for part in _segments(text):
            grams, starts = trigrams(part)
            if len(starts):
                found.append(np.add.reduceat(self.table[grams], starts, axis=0))
        return np.concatenate(found) if found else np.zeros((0, len(self.languages)), np.float32)

    def _fit(self, likely: np.ndarray, starts: np.ndarray, counts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log likelihood (less the words' own maxima) per document, with the allowed languages alone."""
        share = allowed / allowed.sum(1, keepdims=True)
        total = np.zeros(len(counts))
        for turn in range(self.rounds):
            weighted = likely * np.repeat(share, counts, axis=0).astype(np.float32)
            sums = np.maximum(weighted.sum(1, keepdims=True), 1e-30)
            total = np.add.reduceat(np.log(sums[:, 0]), starts, dtype=np.float64)
            fresh = np.add.reduceat(weighted / sums, starts, axis=0, dtype=np.float64) / counts[:, None]
            fresh /= np.maximum(fresh.sum(1, keepdims=True), 1e-30)
            moved, share = np.abs(fresh - share).max(), fresh
            if moved < 1e-3:
                break
        return share, total

    def mixtures(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Per text the proportions over the chosen languages (zeros if undetermined) and the number of words."""
        shares = np.zeros((len(texts), len(self.languages)))
        scores = [self.word_scores(t) if t else np.zeros((0, len(self.languages)), np.float32) for t in texts]
        words = np.array([len(s) for s in scores])
        rows = np.flatnonzero(words)
        if not len(rows) or not self.languages:
            return shares, words
        counts = words[rows]
        starts = np.cumsum(counts) - counts
        logs = np.concatenate([scores[k] for k in rows])
        likely = np.exp(logs - logs.max(1, keepdims=True))
        full, top = self._fit(likely, starts, counts, np.ones((len(rows), len(self.languages))))
        order = np.argsort(-full, axis=1, kind="stable")
        charge = self.penalty * np.log(counts + 1.0)
        # one language: its likelihood as it stands, with no word impossible
        best = np.add.reduceat(np.log(np.maximum(likely, 1e-30)), starts, axis=0, dtype=np.float64)[np.arange(len(rows)), order[:, 0]]
        chosen = np.zeros_like(full)
        chosen[np.arange(len(rows)), order[:, 0]] = 1.0
        # no set can beat the full one's likelihood, so documents it doesn't lift by one charge are settled
        open_rows = np.flatnonzero(top - charge > best)
        for size in range(2, len(self.languages) + 1):
            if not len(open_rows):
                break
            allowed = np.zeros((len(open_rows), len(self.languages)))
            np.put_along_axis(allowed, order[open_rows, :size], 1.0, axis=1)
            taken = np.concatenate([np.arange(starts[k], starts[k] + counts[k]) for k in open_rows])
            part = counts[open_rows]
            share, value = self._fit(likely[taken], np.cumsum(part) - part, part, allowed)
            value = value - (size - 1) * charge[open_rows]
            better = value > best[open_rows]
            chosen[open_rows[better]] = share[better]
            best[open_rows[better]] = value[better]
            open_rows = open_rows[top[open_rows] - size * charge[open_rows] > best[open_rows]]
        shares[rows] = chosen
        return shares, words


def learn(docs: DataFrame, docs_per_language: int = 4000, smoothing: float = 0.3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Trigram counts per language from labelled rows that aren't held out.

    At most about `docs_per_language` rows of each language are used (all, if there are fewer): rows are taken by a hash of id and
    text, so the choice doesn't depend on the layout. Null or empty texts and null labels teach nothing. What comes to the driver is
    a row per language and trigram bucket at most.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null and text != ''").where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    place = {lang: k for k, lang in enumerate(languages)}
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, docs_per_language / sizes[lang]))])
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("language")
        total = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                sums = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for part in _segments(text):
                    sums += np.bincount(trigrams(part)[0], minlength=BUCKETS)
        for lang, sums in total.items():
            seen = np.flatnonzero(sums)
            yield pd.DataFrame({"lang": place[lang], "gram": seen, "n": sums[seen]})

    counted = rows.where(drawn).select("lang", "text").mapInPandas(count, "lang int, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((BUCKETS, len(languages)))
    table[counted["gram"].to_numpy(), counted["lang"].to_numpy()] = counted["n"].to_numpy()
    table += smoothing
    return LanguageModel(languages, np.log(table / table.sum(0)).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language of each whole text and its share of the words, and nothing else changed.

    A null text, or one without a letter, is `und` with score 0, as is everything when no language was learned. Only the text is
    looked at. Input columns named like the two results are replaced.
    """
    docs = docs.drop(*into)
    key, = free_names(docs, "language_found")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, share double")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enter("language")
        model = shared.value
        for texts in parts:
            texts = texts.tolist()
            langs, scores = [], []
            for a, b in text_batches(texts, 2_000_000):
                shares, words = model.mixtures(texts[a:b])
                best = shares.argmax(1) if shares.shape[1] else np.zeros(len(shares), int)
                known = shares.max(1, initial=0.0) > 0
                langs += [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, known)]
                scores += shares.max(1, initial=0.0).tolist()
            yield pd.DataFrame({"lang": langs, "share": scores})

    return docs.withColumn(key, found(F.col(f"`{text_col}`").cast("string"))).withColumns({into[0]: F.col(key)["lang"], into[1]: F.col(key)["share"]}).drop(key)
