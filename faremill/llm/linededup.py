"""Line deduplication by an exact set-similarity join.

A line's tokens are its distinct five-word shingles; if wanted, a line of fewer words has one token, all its words. They are ordered by rarity in the whole corpus; two lines of the wanted Jaccard
similarity must share one of their first few (the prefix), have similar lengths, and leave enough tokens behind the shared place. What
passes those filters is verified on the full sets, and a line goes if an earlier one matches it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from faremill.llm.common import Written, enter, free_names, side, text_batches
from faremill.llm.hashing import mix, word_hashes
from faremill.llm.minhash import GROUP_ROWS, GROUP_SHINGLES, similar

WORDS = 5
COUNTERS = 1 << 16
SEEN_CLASSES = 300_000
# Texts are split this many characters at a time: a handful of arrays of eight bytes a word each.
PART_CHARS = 1_000_000
LOW = np.uint64((1 << 48) - 1)


def split_lines(texts: list, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of all lines of five words or more, the line each belongs to, and the text and the number of each line. With `short`
    a line of one to four words is there too, with the hash of its word sequence as its only token."""
    hashes, start, breaks = word_hashes("\n".join(texts).lower().encode("utf-8", "surrogatepass"))
    n = max(0, len(hashes) - WORDS + 1)
    token = np.zeros(n, np.uint64)
    for k in range(WORDS):
        token *= np.uint64(0x9E3779B97F4A7C15)
        token += hashes[k : k + n]
    row = np.searchsorted(breaks, start)
    whole = row[:n] == row[WORDS - 1 :]
    token, place = mix(token[whole]), row[:n][whole]
    if short and len(row):
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        words = np.diff(head, append=len(row))
        head, words = head[words < WORDS], words[words < WORDS]
        alone = words.astype(np.uint64)
        for k in range(WORDS - 1):
            longer = words > k
            alone[longer] = mix(alone[longer] ^ hashes[head[longer] + k]) + np.uint64(0x9E3779B97F4A7C15)
        token, place = np.concatenate([token, alone]), np.concatenate([place, row[head]])
        order = np.argsort(place, kind="stable")
        token, place = token[order], place[order]
    row = place
    fresh = np.ones(len(row), bool)
    fresh[1:] = row[1:] != row[:-1]
    parts = np.array([t.count("\n") + 1 for t in texts])
    first = np.cumsum(parts) - parts
    owner = np.searchsorted(first, row[fresh], side="right") - 1
    return token, np.cumsum(fresh) - 1, owner, row[fresh] - first[owner] if len(owner) else owner


def rarity(texts: DataFrame, short: bool = False) -> np.ndarray:
    """The rank of each of COUNTERS hash slots by how often its tokens occur in the corpus.

    A row per task and slot is shuffled at most, and the table has the same size for any corpus. Any order of tokens that is the same
    for all lines gives the same matches.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("lines")
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            rows = batch["text"].tolist()
            for a, b in text_batches(rows, PART_CHARS):
                total += np.bincount((split_lines(rows[a:b], short)[0] >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"slot": seen, "n": total[seen]})

    counted = texts.select("text").mapInPandas(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(COUNTERS, np.int64)
    total[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    ranks = np.empty(COUNTERS, np.uint64)
    ranks[np.argsort(total, kind="stable")] = np.arange(COUNTERS, dtype=np.uint64)
    return ranks


def ordered(token: np.ndarray, line: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each line, rarest first. A token is rewritten with its slot's rank in front, so that its value is its place
    in the order; equal tokens stay equal and different ones different."""
    value = ranks[(token >> np.uint64(48)).astype(np.int64)] << np.uint64(48) | token & LOW
    bits = max(1, int(line[-1]).bit_length()) if len(line) else 1
    order = np.argsort(line.astype(np.uint64) << np.uint64(64 - bits) | value >> np.uint64(bits))
    token, line = value[order], line[order]
    wrong = (token[1:] < token[:-1]) & (line[1:] == line[:-1])
    if wrong.any():  # told apart only by the bits that the line number took
        order = np.lexsort((token, line))
        token, line = token[order], line[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (line[1:] != line[:-1])
    return token[fresh], line[fresh]


def _place(id_col: str, key: str, line: str) -> Column:
    """The order of lines: by id (nulls last), text and number."""
    return F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.col(key).alias("key"), F.col(line).alias("line"))


def repeated_lines(docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", short: bool = False) -> DataFrame:
    """(doc_id, text_key, lines): the numbers (from 0, ascending) of each document's lines that match an earlier one.

    Lines are ordered by doc_id (nulls last), the text's md5 and their number; a line goes if any earlier line of any document has
    den * intersection >= num * union of their tokens, be that one kept or not. Letters are compared in lower case, words end at
    ASCII white space. Lines of one to four words are only touched with `short`: then they match lines of the same words. Null and empty texts have no lines to remove. Rows that
    repeat both id and text are one document. Documents that keep all lines have no row here.

    Lines with the same tokens are one class. A class is dealt out by its prefix tokens; of tokens that the same classes share only the
    first in the order is used; a token of many classes is compared in pairs of blocks of bounded size. Per class and token only
    the earliest match comes out, never all pairs.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    shared = docs.sparkSession.sparkContext.broadcast(rarity(texts, short))
    keyed = texts.withColumn("text_key", F.unhex(F.md5("text")))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("lines")
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows = batch.column("text").to_pylist()
            for a, b in text_batches(rows, PART_CHARS):
                token, line, owner, number = split_lines(rows[a:b], short)
                if not len(owner):
                    continue
                token, line = ordered(token, line, shared.value)
                size = np.bincount(line, minlength=len(owner))
                start = np.cumsum(size) - size
                one, two = (np.add.reduceat(mix(token ^ np.uint64(s)), start) for s in (0x51ED270B, 0xA24BAED4))
                # with at least ceil(t n) tokens in common, one is among the first n - ceil(t n) + 1
                prefix = size - -(-num * size // den) + 1
                if len(seen) > SEEN_CLASSES:
                    seen.clear()
                # a task deals out a class once; copies in other tasks fall together behind the shuffle
                for k, pair in enumerate(zip(one.tolist(), two.tolist())):
                    if pair in seen:
                        prefix[k] = 0
                    else:
                        seen.add(pair)
                ends = np.cumsum(prefix)
                taken = np.repeat(start - ends + prefix, prefix) + np.arange(ends[-1])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(token[taken].view(np.int64)))
                whose = pa.array(a + owner)
                numbers = [pa.array(x) for x in (number, one.view(np.int64), two.view(np.int64), size.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(whose), batch.column("text_key").take(whose), *numbers, lists], names=["doc_id", "text_key", "line", "c1", "c2", "n", "prefix"])

    schema = "doc_id bigint, text_key binary, line bigint, c1 bigint, c2 bigint, n bigint, prefix array<bigint>"
    lines = Written(keyed.mapInArrow(describe, schema), "lines")
    name = ["c1", "c2"]
    # never null, so that no filter tells the two uses of this shuffle apart and Spark runs it once
    dealt_out = lines.df.select("c1", "c2", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    spread = dealt_out.withColumn("token", F.coalesce("token", F.lit(0))).repartition("token")
    me, too = F.xxhash64("c1", "c2"), F.xxhash64("c2", "c1")
    # a class comes once from every task that holds its line
    buckets = spread.distinct().groupBy("token").agg(
        F.count("*").alias("members"), F.sum("n").alias("elements"), F.sum("pos").alias("places"), F.bit_xor(me).alias("x"), F.bit_xor(too).alias("y"),
        F.min("n").alias("shortest"), F.max("n").alias("longest"), F.min(F.col("n") - F.col("pos")).alias("left"),
    )
    alike = buckets.where("members > 1").groupBy("members", "elements", "x", "y", "shortest", "longest").agg(F.min(F.struct("places", "token", "left")).alias("first"))
    # two lines alone under a token: length filter, and what can still follow the first shared place (positional filter)
    left = F.col("first.left")
    hopeful = (den * F.col("shortest") >= num * F.col("longest")) & (den * left >= num * (F.col("elements") - left))
    blocks = F.greatest(F.ceil(F.col("elements") / GROUP_SHINGLES), F.ceil(F.col("members") / GROUP_ROWS)).cast("int")
    kept = alike.where((F.col("members") > 2) | hopeful).select(F.col("first.token").alias("token"), blocks.alias("blocks"))
    members = Written(spread.join(kept, "token").select("token", "blocks", "pos", "c1", "c2", "n").distinct(), "line-members", shuffled=True)
    firsts = Written(lines.df.groupBy(name).agg(F.min(_place("doc_id", "text_key", "line")).alias("first"), F.count("*").alias("copies")), "line-firsts", shuffled=True)
    wanted = Written(firsts.df.join(members.df.select(name).distinct(), name).select("c1", "c2", "first"), "wanted-lines", shuffled=True)
    asks = F.collect_list(F.struct("c1", "c2", "first.line", "first")).alias("asked")
    needed = Written(wanted.df.groupBy(F.col("first.id").alias("id"), F.col("first.key").alias("key")).agg(asks), "wanted-texts", shuffled=True)
    asking = side(needed)
    sources = keyed.join(asking, (keyed["text_key"] == asking["key"]) & keyed["doc_id"].eqNullSafe(asking["id"]))
    asked = sources.select(F.split("text", "\n").alias("parts"), F.explode("asked").alias("ask")).select("ask.c1", "ask.c2", "ask.first", F.col("parts")[F.col("ask.line").cast("int")].alias("content"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("lines")
        for batch in batches:
            rows = batch.column("content").to_pylist()
            for a, b in text_batches(rows, PART_CHARS):
                token, line, owner, _ = split_lines([t.replace("\n", " ") for t in rows[a:b]], short)
                token, line = ordered(token, line, shared.value)
                ends = np.searchsorted(line, np.arange(len(owner)), side="right")
                packed = [token[s:e].tobytes() for s, e in zip([0, *ends], ends)]
                part = batch.slice(a, b - a).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([part.column("c1"), part.column("c2"), part.column("first"), pa.array(packed, pa.binary())], names=["c1", "c2", "first", "tokens"])

    # a row that repeats id and text asks for its lines again; a class that meets itself changes nothing below
    fields = T.StructType([*asked.select("c1", "c2", "first").schema.fields, T.StructField("tokens", T.BinaryType())])
    known = Written(asked.select("c1", "c2", "first", "content").mapInArrow(gather, fields), "line-sets").df
    block = F.pmod(F.xxhash64("c1", "c2"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))
    dealt = members.df.withColumn("block", block).withColumn("pair", F.explode(others)).select("token", "pos", "pair.i", "pair.j", "c1", "c2")
    grouped = dealt.join(known, name).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "first", "c1", "c2").select("token", "i", "j", "pos", "c1", "c2", "tokens")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("lines")
        key, held, out = None, [], []

        def matches() -> None:
            if len(held) == 2:
                (p, *one, x), (q, *two, y) = held
                left = min(len(x) - p, len(y) - q)
                # length filter, then what can still follow the shared place (positional filter), then the sets
                if den * min(len(x), len(y)) < num * max(len(x), len(y)) or den * left < num * (len(x) + len(y) - left):
                    return
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                if den * both >= num * (len(x) + len(y) - both):
                    out.append((*two, *one))
                return
            rows, links = similar([h[3] for h in held], num, den)
            for k in range(1, len(rows)):
                first = int(np.argmax(links[k]))
                if links[k, first] and first < k:
                    out.append((*held[rows[k]][1:3], *held[rows[first]][1:3]))

        for batch in batches:
            for token, i, j, pos, c1, c2, packed in zip(*(batch[c].tolist() for c in ("token", "i", "j", "pos", "c1", "c2", "tokens"))):
                if (token, i, j) != key:
                    if len(held) > 1:
                        matches()
                    key, held = (token, i, j), []
                held.append((pos, c1, c2, np.frombuffer(packed, np.uint64)))
            yield pd.DataFrame(out, columns=["c1", "c2", "e1", "e2"])
            out.clear()
        if len(held) > 1:
            matches()
        yield pd.DataFrame(out, columns=["c1", "c2", "e1", "e2"])

    links = grouped.mapInPandas(compare, "c1 bigint, c2 bigint, e1 bigint, e2 bigint").distinct()
    earlier = links.join(wanted.df.select(F.col("c1").alias("e1"), F.col("c2").alias("e2"), F.col("first").alias("earlier")), ["e1", "e2"])
    matched = earlier.groupBy(name).agg(F.min("earlier").alias("earlier"))
    limits = firsts.df.join(matched, name, "left").where("copies > 1 or earlier is not null").select("c1", "c2", F.least("first", F.coalesce("earlier", "first")).alias("limit"))
    doomed = Written(limits, "line-limits", shuffled=True)
    going = lines.df.select("doc_id", "text_key", "line", "c1", "c2").join(side(doomed), name).where(_place("doc_id", "text_key", "line") > F.col("limit"))
    return going.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def remove_lines(docs: DataFrame, num: int = 80, den: int = 100, drop_emptied: bool = True, count_into: tuple[str, str] | None = None, short: bool = False) -> DataFrame:
    """docs without the lines that match an earlier one; n_chars, if there, is counted anew for texts that change.

    With `short` lines of one to four words that repeat an earlier one go too. A document whose lines with words all go is dropped unless `drop_emptied` is False; one that had none to begin with stays. With `count_into`,
    two columns tell how many lines a text had and how many went (0 for null texts).
    """
    key, gone_key, gone_id, gone, had = free_names(docs, "text_key", "gone_key", "gone_id", "gone_lines", "line_count")
    found = repeated_lines(docs, num, den, short=short).select(F.col("text_key").alias(gone_key), F.col("doc_id").alias(gone_id), F.col("lines").alias(gone))
    going = Written(found, "repeated-lines", shuffled=True)
    marked = docs.withColumn(key, F.unhex(F.md5(F.col("text").cast("string"))))
    table = side(going)
    joined = marked.join(table, (marked[key] == table[gone_key]) & marked["doc_id"].cast("bigint").eqNullSafe(table[gone_id]), "left")
    parts = F.split(F.col("text").cast("string"), "\n")
    rest = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col(gone), i.cast("bigint"))), "\n")
    joined = joined.withColumn(had, F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)))
    out = joined.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    if drop_emptied:
        out = out.where(F.col(gone).isNull() | F.col("text").rlike(r"\S"))
    if count_into:
        out = out.withColumns({count_into[0]: F.col(had).cast("bigint"), count_into[1]: F.coalesce(F.size(gone), F.lit(0)).cast("bigint")})
    return out.drop(key, gone_key, gone_id, gone, had)
