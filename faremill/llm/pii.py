"""Personal data by fixed patterns and by bootstrapped context.

What the fixed patterns find are the seeds. The words around them are lexical patterns: one or two words before, one after, one on both
sides, or one before and the shape of what stands there. A pattern extracts whatever token stands in its place, of any shape. Patterns
and instances form a graph: a pattern is worth the share of the distinct tokens in its place that are known to be of its kind, an instance
is believed by noisy-or over the patterns it stands in, and both are scored in turn until no instance is added. Believed ones are
new spans. Everything is column expressions, joins and grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.llm.common import Written, side

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. Possessive loops and a look back to the start of a run give the same leftmost matches in linear time:
# a run that fails from its start fails from every later place in it. A card is a whole chain of digits, so shorter chains than
# 13 digits need not be matched to be dropped.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CONTEXT, WORD = 120, 40
# A base span is masked by as many of its kind's character (private use), so that places stay and no token takes part of it.
MASKS = dict(zip(KINDS, "\ue001\ue002\ue003\ue004"))
# Identifier-like tokens, after a blank or a label glued to them ("tel:"): groups of digits with single blanks between them, or anything
# without blanks that holds a digit, an @ or a sign between letters. A token of letters alone is a plain word: never an identifier of these
# kinds, it counts against the patterns around it. Most words are ASCII letters alone and are told first, in one pass over each.
NOT_PLAIN = r"[0-9@]|\p{L}[^\p{L}\s'’-]+\p{L}"
LOOSE = (
    r"(?:(?<!\S)|(?<=\p{L}[:=]))(?=\S)(?![A-Za-z]++[.,;:!?]?+(?!\S))(?!\p{L}[\p{L}_-]*+[:=]\S)"
    r"(?:[+(]?[0-9][0-9().+/-]*+(?:\x20[(]?[0-9][0-9().+/-]*+)++|(?=\S*?(?:" + NOT_PLAIN + r"))\S++)"
)
CHUNK = 256
# Set around tokens, so that one pass finds them and what stands between them; a text that has it itself is matched twice.
MARK = "\ue005"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check: from the right, every second digit doubled, digit sums adding up to a multiple of 10."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * (i % 2 + 1))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    digits = _digits(x)
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _word(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), "[0-9]+", "0")


def _shape(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, r"\p{L}+", "a"), "[0-9]+", "0")


def _instance(x: Column) -> Column:
    return F.lower(F.regexp_replace(x, r"\s+", " "))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that what is built on them does not work them out again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_starts(df: DataFrame) -> DataFrame:
    """Add `starts`: where each of `hits` starts, given the text before each in `parts`. Running sums within chunks are moved by running
    sums over chunks, so that a text of a million hits is no square of work."""
    df = _once(df, pairs=F.transform("hits", lambda h, i: F.struct(F.length(F.get("parts", i)).alias("gap"), F.length(h).alias("size"))))
    none = F.array().cast("array<int>")

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["gap"]
        return F.struct((at + x["size"]).alias("at"), F.concat(acc["starts"], F.array(at)).alias("starts"))

    def chunk(c: Column) -> Column:
        return F.aggregate(F.slice("pairs", c * CHUNK + 1, F.lit(CHUNK)), F.struct(F.lit(0).alias("at"), none.alias("starts")), step)

    count = F.size("pairs")
    local = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.floor((count - 1) / CHUNK).cast("int")), chunk)).otherwise(F.array().cast("array<struct<at:int,starts:array<int>>>"))
    df = _once(df, local=local)

    def shift(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all"))

    base = F.aggregate(F.transform("local", lambda m: m["at"]), F.struct(F.lit(0).alias("at"), none.alias("all")), shift, lambda acc: acc["all"])
    df = _once(df, base_=base)
    return _once(df, starts=F.flatten(F.transform("local", lambda m, i: F.transform(m["starts"], lambda v: v + F.get("base_", i))))).drop("pairs", "local", "base_")


SPAN = "kind string, start int, end int, found string, l1 string, l2 string, r1 string"
SPANS = f"array<struct<{', '.join(':'.join(f.split()) for f in SPAN.split(', '))}>>"


def _spans(kind: str | None) -> Column:
    """Matches in order, from columns `parts`, `hits` and `starts`: places in code points, two words before and one after."""
    def one(h: Column, i: Column) -> Column:
        start, before = F.get("starts", i), F.substring(F.get("parts", i), -CONTEXT, CONTEXT)
        after = F.substring(F.get("parts", i + 1), 1, CONTEXT)
        word = lambda x, p: _word(F.regexp_extract(x, p, 1))
        return F.struct(
            F.lit(kind).cast("string").alias("kind"), start.alias("start"), (start + F.length(h)).alias("end"), h.alias("found"),
            word(before, r"(\S{1,40})\s*$").alias("l1"), word(before, r"(\S{1,40})\s+\S+\s*$").alias("l2"), word(after, r"^\s*(\S{1,40})").alias("r1"),
        )

    return F.transform("hits", one)


def _masked(kind: str) -> Column:
    """The text of columns `parts` and `hits` with every valid hit masked."""
    mask = lambda h: F.when(_valid(kind, h), F.repeat(F.lit(MASKS[kind]), F.length(h))).otherwise(h)
    return F.concat(F.array_join(F.transform("hits", lambda h, i: F.concat(F.get("parts", i), mask(h))), ""), F.element_at("parts", -1))


def _scanned(docs: DataFrame, id_col: str, text_col: str, spans: bool) -> DataFrame:
    """(doc_id, text_key, masked, and with `spans` base): base spans are found in the text as it is, masks follow one after the other."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"text_key": F.unhex(F.md5("text")), "masked": F.col("text"), "base": F.array().cast(SPANS)})
    text = F.col("text")
    has = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), "phone": F.contains(text, F.lit("+"))}
    rows = _once(rows, **{f"has_{k}": c for k, c in has.items()})
    nothing = F.array().cast("array<string>")
    for kind in KINDS:
        hits = lambda x: F.when(F.col(f"has_{kind}"), F.regexp_extract_all(x, F.lit(BASE[kind]), 0)).otherwise(nothing)
        parts = lambda x: F.when(F.col(f"has_{kind}"), F.split(x, BASE[kind], -1)).otherwise(nothing)
        if spans:
            found = with_starts(_once(rows, hits=hits(text), parts=parts(text)))
            rows = found.withColumn("base", F.concat("base", F.filter(_spans(kind), lambda m: _valid(kind, m["found"])))).drop("hits", "parts", "starts")
        masked = _once(rows, hits=hits(F.col("masked")), parts=parts(F.col("masked")))
        rows = _once(masked.withColumnRenamed("masked", "old"), masked=F.when(F.size("hits") > 0, _masked(kind)).otherwise(F.col("old"))).drop("old", "hits", "parts")
    return rows.select("doc_id", "text_key", "masked", *(["base"] if spans else []))


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, base, loose): the fixed patterns' spans by kind and place, and all other tokens that are not plain words.

    A token is told without quotes and brackets before it and punctuation after it.
    """
    rows = _scanned(docs, id_col, text_col, True)
    has = F.contains("masked", F.lit(MARK))
    rows = _once(rows, cut=F.when(~has, F.split(F.regexp_replace("masked", LOOSE, f"{MARK}$0{MARK}"), MARK, -1)))
    every = lambda rest, plain: F.when(F.col("cut").isNull(), plain).otherwise(F.filter("cut", lambda _, i: i % 2 == rest))
    rows = with_starts(_once(rows, hits=every(1, F.regexp_extract_all("masked", F.lit(LOOSE), 0)), parts=every(0, F.split("masked", LOOSE, -1))).drop("cut"))

    def bare(m: Column) -> Column:
        tail = F.regexp_replace(m["found"], r"""^["'(\[<{]+""", "")
        core = F.rtrim(tail, F.lit(".,;:!?)\"'\\]>}"))
        start = m["start"] + F.length(m["found"]) - F.length(tail)
        return F.struct(m["kind"].alias("kind"), start.alias("start"), (start + F.length(core)).alias("end"), core.alias("found"), *[m[c].alias(c) for c in ("l1", "l2", "r1")])

    loose = F.filter(F.transform(_spans(None), bare), lambda m: m["found"].rlike(NOT_PLAIN) & ~m["found"].rlike("[\ue001-\ue004]"))
    return rows.select("doc_id", "text_key", "base", loose.alias("loose"))


def _patterns(m, shape: Column | None) -> Column:
    """Patterns of a place; a pattern whose words are missing there is null."""
    said = lambda *words: F.concat_ws("\t", *words)
    l1, l2, r1 = m("l1"), m("l2"), m("r1")
    some = [
        F.when(l1 != "", said(F.lit("1"), l1)), F.when((l1 != "") & (l2 != ""), said(F.lit("2"), l2, l1)),
        F.when(r1 != "", said(F.lit("r"), r1)), F.when((l1 != "") & (r1 != ""), said(F.lit("b"), l1, r1)),
    ]
    if shape is not None:
        some.append(F.when(l1 != "", said(F.lit("s"), l1, shape)))
    return F.array(*some)


def _edges(rows: DataFrame) -> DataFrame:
    """Distinct (pattern, instance, kind): kind is null for what no fixed pattern takes. Repeats go before the shuffle."""
    flat = rows.select(F.explode(F.concat("base", "loose")).alias("m")).select("m.*").select("kind", "found", "l1", "l2", "r1").distinct()
    return flat.select("kind", _instance(F.col("found")).alias("instance"), F.explode(_patterns(F.col, _shape(F.col("found")))).alias("pattern")).where("pattern is not null").distinct()


def _plain(docs: DataFrame, wanted: Written, id_col: str, text_col: str) -> DataFrame:
    """(pattern, plain), how many distinct plain words stand in the place of each wanted pattern. Every place has four patterns at most;
    only those that are wanted go on, so that a common word beside which a rare pair is wanted does not bring all its places along."""
    rows = _scanned(docs, id_col, text_col, False)
    rows = _once(rows, said=F.split(_word(F.col("masked")), r"\s+"))
    rows = rows.select(F.concat(F.array(F.lit(""), F.lit("")), "said", F.array(F.lit(""))).alias("w"))
    n = F.greatest(F.size("w") - 3, F.lit(0))
    places = F.arrays_zip(*[F.slice("w", k + 1, n).alias(name) for k, name in enumerate(("l2", "l1", "word", "r1"))])
    flat = rows.select(F.inline(places)).where(F.col("word") != "")
    cut = flat.select("word", F.substring("l1", -WORD, WORD).alias("l1"), F.substring("l2", -WORD, WORD).alias("l2"), F.substring("r1", 1, WORD).alias("r1"))
    l1, l2, r1 = F.col("l1"), F.col("l2"), F.col("r1")
    # hashes are told apart before any pattern is put together
    keys = F.array(
        F.when(l1 != "", F.xxhash64(F.lit("1"), l1)), F.when((l1 != "") & (l2 != ""), F.xxhash64(F.lit("2"), l2, l1)),
        F.when(r1 != "", F.xxhash64(F.lit("r"), r1)), F.when((l1 != "") & (r1 != ""), F.xxhash64(F.lit("b"), l1, r1)),
    )
    said = F.split("pattern", "\t")
    hashed = F.when(F.size(said) > 2, F.xxhash64(said[0], said[1], F.get(said, F.lit(2)))).otherwise(F.xxhash64(said[0], said[1]))
    near = cut.select("*", F.posexplode(keys).alias("which", "key")).join(side(wanted).select(hashed.alias("key")), "key", "left_semi")
    # the test of the word stands within a generator, or it would be made before the join, for every word
    own = F.when(~F.col("word").rlike(NOT_PLAIN + "|[\ue001-\ue004]"), F.array(F.get(_patterns(F.col, None), F.col("which"))))
    found = near.select("word", F.explode(own).alias("pattern")).join(side(wanted).select("pattern"), "pattern", "left_semi")
    return found.distinct().groupBy("pattern").agg(F.count("*").alias("plain"))


def _totals(docs: DataFrame, counts: DataFrame, id_col: str, text_col: str, pattern_at_least: float, parts: int) -> Written:
    """(pattern, all): the distinct tokens in the place of each pattern of `counts` (pattern, others) that may reach `pattern_at_least`.

    Plain words are counted in one of `parts` parts of the texts first: a pattern with so many there that its score would stay below
    the wanted one even if all other tokens were believed is out, whatever the rest holds. The patterns left are counted in all texts.
    The result is the same for any number of parts.
    """
    wanted = Written(counts, "patterns", shuffled=True)
    may = F.col("others") / (F.col("others") + F.coalesce("plain", F.lit(0)) + 1) >= pattern_at_least
    if parts > 1:
        some = docs.where(F.pmod(F.xxhash64(F.col(f"`{text_col}`").cast("string")), F.lit(parts)) == 0)
        plain = _plain(some, wanted, id_col, text_col)
        fewer = Written(wanted.df.join(plain, "pattern", "left").where(may).select("pattern", "others"), "patterns", shuffled=True)
        wanted.drop()
        wanted = fewer
    plain = _plain(docs, wanted, id_col, text_col)
    counted = wanted.df.join(plain, "pattern", "left").where(may)
    totals = Written(counted.select("pattern", (F.col("others") + F.coalesce("plain", F.lit(0))).alias("all")), "totals", shuffled=True)
    wanted.drop()
    return totals


def bootstrap(edges: DataFrame, totals: DataFrame, min_seeds: int = 3, pattern_at_least: float = 0.5, believed: float = 0.8) -> tuple[DataFrame, Written | None]:
    """(instance, kind, belief) of the tokens that context makes believable, and the table they are written to.

    Per round: a pattern's score for a kind is the belief in that kind's distinct instances in it, over all distinct tokens in it and one
    more; it counts with `min_seeds` believed instances and a score of `pattern_at_least`. A token's belief in a kind is
    1 - product(1 - score) over its patterns; its best kind counts (the first one listed on a tie), and from `believed` on it is added with
    that belief, which it keeps. Rounds end when one adds nothing: each adds an instance, so they end.
    """
    order = F.array(*map(F.lit, KINDS))
    seeds = edges.where("kind is not null").select("pattern", "instance", "kind", F.lit(1.0).alias("belief"))
    loose = edges.where("kind is null").select("pattern", "instance")
    now: Written | None = None
    while True:
        known = seeds if now is None else seeds.unionByName(loose.join(now.df, "instance").select("pattern", "instance", "kind", "belief"))
        held = known.groupBy("pattern", "kind").agg(F.sum("belief").alias("held"), F.count("*").alias("known")).where(F.col("known") >= min_seeds)
        scores = held.join(totals, "pattern").select("pattern", "kind", (F.col("held") / (F.col("all") + 1)).alias("score")).where(F.col("score") >= pattern_at_least)
        asked = loose if now is None else loose.join(now.df, "instance", "left_anti")
        doubt = asked.join(scores, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("belief"))
        best = F.max_by(F.struct("kind", "belief"), F.struct("belief", -F.array_position(order, F.col("kind"))))
        fresh = doubt.where(F.col("belief") >= believed).groupBy("instance").agg(best.alias("b")).select("instance", "b.kind", "b.belief")
        added = Written(fresh, "beliefs", shuffled=True)
        if added.df.isEmpty():
            added.drop()
            empty = edges.sparkSession.createDataFrame([], "instance string, kind string, belief double")
            return (empty, None) if now is None else (now.df, now)
        if now is None:
            now = added
        else:
            both = Written(now.df.unionByName(added.df), "beliefs", shuffled=True)
            now.drop()
            added.drop()
            now = both


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _place(kind: Column) -> Column:
    return (F.array_position(F.array(*map(F.lit, KINDS)), kind) - 1).cast("int")


def _apart(taken: DataFrame, base: DataFrame) -> DataFrame:
    """Taken spans that touch no base span of their text, by one ordered pass over a text's spans (masks of two kinds may leave pieces)."""
    both = taken.withColumn("old", F.lit(False)).unionByName(base.withColumn("old", F.lit(True)))
    before = Window.partitionBy("text_key").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("text_key").orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    sided = both.withColumns({"until": F.max(F.when(F.col("old"), F.col("end"))).over(before), "next": F.min(F.when(F.col("old"), F.col("start"))).over(after)})
    return sided.where(~F.col("old") & (F.coalesce("until", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))).drop("old", "until", "next")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_seeds: int = 3, pattern_at_least: float = 0.5, believed: float = 0.8, parts: int = 16) -> DataFrame:
    """(doc_id, base, added, spans) per row: (kind, start, end) arrays by kind and place; added ones are what context found.

    Null texts are empty and have none; an empty table gives no rows; rows that repeat an id or a text are each answered; other columns
    are not looked at. Added spans never touch a base span. Equal texts get equal spans.
    """
    rows = Written(described(docs, id_col, text_col), "described")
    edges = Written(_edges(rows.df), "edges", shuffled=True)
    counts = edges.df.groupBy("pattern").agg(F.countDistinct("instance").alias("others"), F.max(F.col("kind").isNull()).alias("asks"))
    counts = counts.where(F.col("asks") & (F.col("others") >= min_seeds)).select("pattern", "others")
    totals = _totals(docs, counts, id_col, text_col, pattern_at_least, parts)
    used = edges.df.join(side(totals).select("pattern"), "pattern", "left_semi")
    beliefs, kept = bootstrap(used, totals.df, min_seeds, pattern_at_least, believed)
    spans = rows.df.where(F.size("loose") > 0).select("text_key", F.explode("loose").alias("m"))
    taken = spans.select("text_key", "m.start", "m.end", _instance(F.col("m.found")).alias("instance")).join(beliefs.select("instance", "kind"), "instance").select("text_key", "start", "end", "kind").distinct()
    known = rows.df.select("text_key", F.explode("base").alias("m")).select("text_key", "m.start", "m.end", "m.kind").distinct()
    known = known.join(taken.select("text_key").distinct(), "text_key", "left_semi")
    entry = F.struct(_place(F.col("kind")).alias("place"), "start", "end", "kind")
    added = Written(_apart(taken, known).groupBy("text_key").agg(F.array_sort(F.collect_set(entry)).alias("added")), "added", shuffled=True)
    for done in (edges, totals, *([kept] if kept else [])):
        done.drop()
    plain_type = "array<struct<place:int,start:int,end:int,kind:string>>"
    ordered = F.transform("base", lambda m: F.struct(_place(m["kind"]).alias("place"), m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind")))
    out = rows.df.join(side(added), "text_key", "left").select("doc_id", ordered.alias("base"), F.coalesce("added", F.array().cast(plain_type)).alias("added"))
    return out.withColumn("spans", F.array_sort(F.concat("base", "added")))


def digest(docs: DataFrame, **scoring) -> DataFrame:
    """The spans as counts, text and hash."""
    found = find(docs, **scoring)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.size("added").alias("n_added"))
