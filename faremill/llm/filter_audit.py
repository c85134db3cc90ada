"""How quality filters interact: what each removes, in any order, and its fair share by exact constrained least squares.

All that an audit can ask follows from one small table per part of the corpus: how many documents a coalition of filters removes together,
for each of the 32 coalitions. The step counts of any order are differences of neighbouring coalitions. The Shapley value of a filter
is the solution of a weighted least squares problem over the coalitions, with the constraint that all shares add up to what all filters
remove; its normal equations are solved in rationals, so the answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

LETTERS = "ABCDE"
SPACE = r"[ \t-\r]+"
COUNTS = ("all", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions A to D over a text that is never null, as columns that say whether it fails."""
    words = F.array_remove(F.split(text, SPACE), "")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": upper * 100 > F.length(text) * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by language, the filters they fail (bit k: the k-th letter) and their labels.

    Texts leave the scan as a hash and a mask. Equal rows are counted before anything is shuffled; labels meet one row per id, text and
    language, and what is compared per text afterwards is one row per language and label, however many copies the text has.
    """
    text = F.col("text")
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    fails = text_failures(text)
    mask = sum((fails[c].cast("int") * (1 << k) for k, c in enumerate("ABCD")), F.lit(0))
    seen = rows.select("id", "part", F.unhex(F.sha2(text, 256)).alias("key"), mask.alias("mask")).groupBy("id", "part", "key", "mask").agg(F.count("*").alias("n"))

    marks = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("id_"), F.lit(0).alias("spread_"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    # rows without an id have no label; spread by their text's hash they are no single task
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("key"), F.lit(1 << 20)).cast("int") + 1).otherwise(0)
    placed = seen.withColumns({"id_": F.coalesce("id", F.lit(0)), "spread_": spread}).join(marks, ["id_", "spread_"], "left")
    marked = placed.select("id", "part", "key", "mask", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))

    one = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    groups = marked.groupBy("key", "part", "good", "toxic", "mask").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"), F.min(one).alias("first"))
    # a row per language and label of a text
    firsts = groups.groupBy("key").agg(F.min("first.id").alias("least"))
    known = groups.join(firsts, "key").withColumn("fresh", F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0))
    sides = F.array(F.struct("mask", F.col("fresh").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))
    return known.select("part", "good", "toxic", F.inline(sides)).where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def coalitions(rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, documents, all, good, toxic): per part arrays with, for every coalition of filters, the number of documents it removes."""
    table = []
    for name, taken in zip(COUNTS, (F.lit(True), F.col("good"), F.col("toxic"))):
        removed = [F.sum(F.when(taken & (F.col("mask").bitwiseAND(s) != 0), F.col("n")).otherwise(0)) for s in range(1 << len(letters))]
        table.append(F.array(*removed).cast("array<bigint>").alias(name))
    return rows.groupBy("part").agg(F.sum("n").alias("documents"), *table)


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, in rationals."""
    rows = [[*row, r] for row, r in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(j for j in range(k, len(rows)) if rows[j][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for j in range(len(rows)):
            if j != k and rows[j][k]:
                rows[j] = [x - rows[j][k] * y for x, y in zip(rows[j], rows[k])]
    return [row[-1] for row in rows]


def fair_shares(removed: list[int], players: int = len(LETTERS)) -> list[Fraction]:
    """Each filter's Shapley value from the coalitions' removals.

    Shares phi minimise the sum of w(S) * (removed(S) - sum of phi over S)^2 over the coalitions between none and all, with the Shapley
    kernel w(S) = (m - 1) / (C(m, s) s (m - s)), under the constraint that they add up to what all remove. The normal equations, with a
    multiplier for the constraint, have one more row and column.
    """
    whole = (1 << players) - 1
    matrix = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [Fraction(0)] * (players + 1)
    for s in range(1, whole):
        inside = [k for k in range(players) if s >> k & 1]
        weight = Fraction(players - 1, comb(players, len(inside)) * len(inside) * (players - len(inside)))
        for i in inside:
            right[i] += weight * removed[s]
            for j in inside:
                matrix[i][j] += weight
    for k in range(players):
        matrix[k][players] = matrix[players][k] = Fraction(1)
    right[players] = Fraction(removed[whole])
    return solve(matrix, right)[:players]


RESULT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def order_rows(part: str, documents: int, every: list[int], good: list[int], toxic: list[int], letters: str = LETTERS) -> Iterator[tuple]:
    """A row per order of the filters and step, all of it differences of coalitions."""
    whole, orders = (1 << len(letters)) - 1, factorial(len(letters))
    shares = [int(x * orders) for x in fair_shares(every, len(letters))]
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[k] for k in order), 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            removed = every[after] - every[before]
            yield (
                part, name, step, documents - every[after], removed, every[1 << k] - removed, every[whole] - every[whole ^ 1 << k],
                good[after] - good[before], toxic[after] - toxic[before], shares[k],
            )
            before = after


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per language, order of the five filters and step, with counts of documents (see RESULT) and the filter's Shapley value
    times 120, which is its removals summed over all orders.

    A: under 200 words; B: fewer than half the words distinct; C: over 3 % of the characters in A-Z; D: any of #$%&*|; E: the text equals
    that of a row with a smaller doc_id. Needs doc_id, lang and text of docs and doc_id, quality and toxic of labels; others are ignored.

    Edge cases: a null text is empty, a null language is the part ''; a row without a doc_id has no smaller one and never fails E, nor does it
    make another fail, and it has no label; rows that repeat an id and a text are documents of their own, none smaller than the other;
    several labels of an id count as good or toxic if any is; an empty table gives no rows. Parts of any number: each is a row of sums.
    """
    names = RESULT.replace(",", "").split()[::2]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                table = [[int(x) for x in r[c]] for c in COUNTS]
                yield pd.DataFrame(list(order_rows(r["part"], int(r["documents"]), *table)), columns=names)

    return coalitions(judged(docs, labels)).mapInPandas(run, RESULT)


def audit_sql() -> str:
    """The same in DuckDB's SQL, by walking every order step by step."""
    fails = """select d.part, d.good, d.toxic, (d.n_words < 200)::int + 2 * (100 * d.n_distinct < 50 * d.n_words)::int + 4 * (100 * d.upper > 3 * d.points)::int + 8 * d.marked::int
  + 16 * coalesce(d.doc_id > min(d.doc_id) over (partition by d.text), false)::int as mask"""
    docs = r"""select doc_id, text, part, len(words) as n_words, len(list_distinct(words)) as n_distinct, length(regexp_replace(text, '[^A-Z]', '', 'g')) as upper, length(text) as points,
  regexp_matches(text, '[#$%&*|]') as marked, coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from (select *, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda w: w <> '') as words from (select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents))
  left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1) using (doc_id)"""
    orders = ", ".join("('" + "".join(p) + "')" for p in permutations(LETTERS))
    return f"""with d as ({docs}), f as ({fails} from d), g as (select part, mask, good, toxic, count(*) as n from f group by all),
o as (select o, s.step::int as step, 1 << (ascii(substr(o, s.step::int, 1)) - 65) as bit, coalesce(list_sum(list_transform(range(1, s.step), lambda i: 1 << (ascii(substr(o, i::int, 1)) - 65))), 0)::int as before
  from (values {orders}) t(o), (select unnest(range(1, 6)) as step) s),
r as (select part, o as filter_order, step, bit, sum(n) filter ((mask & (before + bit)) = 0) as kept, sum(n) filter ((mask & before) = 0 and (mask & bit) <> 0) as removed,
  sum(n) filter ((mask & before) <> 0 and (mask & bit) <> 0) as redundant, sum(n) filter (mask = bit) as unique_fails,
  sum(n) filter ((mask & before) = 0 and (mask & bit) <> 0 and good) as good_lost, sum(n) filter ((mask & before) = 0 and (mask & bit) <> 0 and toxic) as toxic_lost from g, o group by 1, 2, 3, 4)
select part, filter_order, step, {", ".join(f"coalesce({c}, 0)::bigint as {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
(sum(coalesce(removed, 0)) over (partition by part, bit))::bigint as shapley from r"""
