"""Every operator against a plain version of its contract on a small awkward table, and on empty and clashing tables."""

import collections
import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faremill.llm import bpe, components, decontaminate, langid, linededup, minhash, neighbours, pii, sharding, token_files, toxicity
from faremill.llm.common import held_out
from faremill.llm.queries import QUERIES, vocabulary

EN = "the cat and the dog went over the hill because they wanted to see what was behind it and nobody had told them"
ODD = "It's I'LL x<|endoftext|>y z\x1cq ̈a é ΑΣ. ΑΣ Été, don't,.. 9.9.9 a\tb\r\nc İı ǅ ﬁ ½ ٣ 中文 😀 a​b  \n\n  "
ROWS = [
    (None, None), (None, ODD), (1, ""), (2, "one"), (3, "one"), (3, "one"), (4, EN), (5, EN + " once"), (6, EN.upper() + "\n" + EN), (7, "   \n\t "),
    (8, "é" * 3000 + "x" * 2000), (9, "mail a@b.com_x@c.de or 1.2.3.4.5.6.7.8 or 256.1.1.1, +1 (212) 555-0100 and 4111 1111 1111 1111, 4111-1111-1111-1112"), (10, None), (11, "12 34 !!"),
] + [(20 + k, f"call tel: +1 (212) 555-{1000 + k} now") for k in range(8)] + [(40, "call tel: 212 555 7788 now or 333 444 5555 then")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumns({"score": F.lit("mine"), "ids": F.lit(7), "band": F.lit(None).cast("int"), "n": F.lit(1), "shard": F.lit("s"), "text_key": F.lit("k")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def bag(rows):
    return collections.Counter(map(repr, rows))


# --- sharding


def test_sharding(docs, empty):
    rows = sharding.shard_documents(docs, 5).collect()
    assert len(rows) == len(ROWS) and sharding.shard_documents(empty, 5).count() == 0
    want = bag((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_sharding_weights(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("x"))
    n = {r["shard"]: r["count"] for r in sharding.shard_documents(rows, 3, [1.0, 3.0, 0.0]).groupBy("shard").count().collect()}
    assert set(n) == {0, 1} and 2.7 < n[1] / n[0] < 3.3


# --- token files


def test_token_files(docs, empty):
    from tokenizers import Tokenizer

    spec = vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_str(spec)
    rows = sorted(token_files.token_file_digest(docs, spec).collect(), key=lambda r: r["start"])
    want = [(i, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in ROWS]
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == bag((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    assert [r["doc_id"] or 0 for r in rows] == sorted(r["doc_id"] or 0 for r in rows)
    assert token_files.token_file_digest(empty, spec).count() == 0


@pytest.mark.parametrize("numbers", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], list(range(1000))])
def test_packed_numbers(numbers):
    control, data = token_files.pack(np.array(numbers, "<u4"))
    assert len(control) == -(-len(numbers) // 4)
    assert token_files.unpack(control, data, len(numbers)).tolist() == numbers
    if numbers:
        with pytest.raises(ValueError):
            token_files.unpack(control, data + b"x", len(numbers))


# --- byte-level BPE


def test_bpe(docs, empty):
    import tiktoken

    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.bpe_digest(docs, ranks, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = [(i, t or "", plain.encode_ordinary(t or "")) for i, t in ROWS]
    assert bag(tuple(r) for r in rows) == bag((i, len(x), sha(" ".join(map(str, x)).encode()), sha(t.encode())) for i, t, x in ids)
    assert bpe.bpe_digest(empty, ranks, public_tokenizers.PATTERN).count() == 0
    kept = bpe.encode_column(docs, ranks, public_tokenizers.PATTERN)
    assert kept.columns == [c for c in docs.columns if c != "ids"] + ["ids"] and kept.where("score = 'mine'").count() == len(ROWS)


def test_bpe_decodes_where_it_encodes(spark, docs, empty, capsys):
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    # one Python worker per task: a second one would remember the same pieces again
    bpe.bpe_digest(docs, ranks, public_tokenizers.PATTERN).explain()
    assert len(re.findall("MapInArrow", capsys.readouterr().out)) == 1
    both = bpe.encode_column(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    again = bpe.decode_column(both.drop("decoded"), ranks)
    assert bag(map(tuple, both.collect())) == bag(map(tuple, again.collect()))
    assert bag(bytes(r["decoded"]) for r in both.collect()) == bag((t or "").encode() for _, t in ROWS)
    assert bpe.encode_column(empty, ranks, public_tokenizers.PATTERN, decoded="decoded").count() == 0
    few = spark.createDataFrame([(1, None), (2, []), (3, [256, 257])], "k int, ids array<int>")
    words = {i: b for b, i in ranks.items()}
    assert {r["k"]: bytes(r["decoded"]) for r in bpe.decode_column(few, ranks).collect()} == {1: b"", 2: b"", 3: words[256] + words[257]}
    for unknown in ([-1], [len(ranks) + 999], [256, None]):
        with pytest.raises(Exception, match="KeyError"):
            bpe.decode_column(spark.createDataFrame([(unknown,)], "ids array<int>"), ranks).collect()


def test_bpe_sends_a_kept_text_once(spark, docs, capsys):
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    encoded = lambda df, **how: bpe.encode_column(df, ranks, public_tokenizers.PATTERN, **how)

    def sent(df):
        capsys.readouterr()
        df.explain()
        return "text_to_encode" in capsys.readouterr().out

    ids = lambda df, name="ids": bag((r["doc_id"], tuple(r[name])) for r in df.collect())
    kept, dropped = encoded(docs), encoded(docs, keep_text=False)
    assert not sent(kept) and sent(dropped) and ids(kept) == ids(dropped)
    assert bag(r["text"] for r in kept.collect()) == bag(t for _, t in ROWS)
    # other spellings, types and places of the text column
    assert not sent(encoded(docs.withColumnRenamed("text", "Text"))) and ids(encoded(docs.withColumnRenamed("text", "Text"))) == ids(kept)
    raw = docs.withColumn("text", F.encode("text", "utf-8"))
    assert sent(encoded(raw)) and ids(encoded(raw)) == ids(kept) and encoded(raw).schema["text"].dataType.simpleString() == "binary"
    assert encoded(docs, into="text").columns == [c for c in docs.columns if c != "text"] + ["text"] and ids(encoded(docs, into="text"), "text") == ids(kept)


def test_pieces_that_come_often_stay_known(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 100_000)
    asked = []
    known = bpe._Pieces(lambda raw: asked.append(raw) or list(raw))
    for k in range(5_000):
        for piece in ("often", f"once {k}"):
            assert known[piece] == np.array(list(piece.encode()), "<i4").tobytes()
        held = [*known.items(), *known.older.items()]
        assert sum(bpe.ENTRY_BYTES + 4 * len(p) + len(i) for p, i in held) <= 100_000
    assert asked.count(b"often") == 1 and len(asked) == 5_001
    known["x" * 1_000]
    assert "x" * 1_000 not in known
    known.clear()
    assert not known and not known.older and known["often"] and asked.count(b"often") == 2


def test_merge_goes_by_rank_then_place():
    ranks = {bytes([x]): x for x in range(256)} | {b"aa": 300, b"ab": 299, b"aaa": 301, b"ba": 298, b"aba": 302}
    single, pairs = list(range(256)), [ranks.get(bytes([x, y])) for x in range(256) for y in range(256)]

    def plain(piece):
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while found := [(ranks[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]:
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [ranks[p] for p in parts]

    for n in range(1 << 9):
        piece = bytes(b"ab"[n >> k & 1] for k in range(9))
        assert bpe.merge(piece, ranks.get, single, pairs) == plain(piece)


def test_perfect_hash():
    keys = [str(k).encode() for k in range(3000)]
    made = bpe.PerfectHash(keys)
    assert sorted(made.slots) == list(range(3000)) and all(made.slots[made.slot_of(k)] == n for n, k in enumerate(keys))


# --- language identification

LANGUAGES = {"en": EN, "de": "der hund und die katze gingen über den hügel weil sie sehen wollten was dahinter lag", "fr": "le chien et le chat sont allés derrière la colline parce qu'ils voulaient voir"}


def labelled(spark, copies=12):
    rows = [(100 * n + k, f"{text} {text[::2]} {k}", lang) for n, (lang, text) in enumerate(LANGUAGES.items()) for k in range(copies)]
    return spark.createDataFrame(rows + [(None, EN, "xx"), (900, None, "en"), (901, "", "en"), (902, EN, None)], "doc_id bigint, text string, lang string")


def test_languages(spark, docs, empty):
    rows = labelled(spark)
    model = langid.learn(rows)
    assert model.languages == ["de", "en", "fr"]
    found = langid.predict(rows.withColumn("score", F.lit(1)), model).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found if r["text"] and r["lang"] in LANGUAGES)
    assert all(0 <= r["score"] <= 1 for r in found)
    odd = {r["text"]: r for r in langid.predict(docs, model).collect()}
    assert odd[None]["lang_pred"] == odd[""]["lang_pred"] == odd["12 34 !!"]["lang_pred"] == "und" and odd[EN]["lang_pred"] == "en"
    mixed = spark.createDataFrame([(" ".join([LANGUAGES["en"]] * 2 + [LANGUAGES["de"]]),)], "text string")
    share = langid.predict(mixed, model).first()
    assert share["lang_pred"] == "en" and 0.5 < share["score"] < 0.8
    nobody = langid.learn(rows.limit(0))
    assert nobody.languages == [] and langid.predict(docs, nobody).where("lang_pred != 'und'").count() == 0
    assert langid.predict(empty, model).count() == 0


def test_mixture_shares_match_plain_em():
    rng = np.random.default_rng(3)
    model = langid.LanguageModel(["a", "b"], np.log(rng.dirichlet(np.ones(langid.BUCKETS), 2).T).astype(np.float32), penalty=0.0, rounds=500)
    text = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(60))
    likely = np.exp(model.word_scores(text).astype(float) - model.word_scores(text).max(1, keepdims=True))
    share = np.array([0.5, 0.5])
    for _ in range(3000):
        share = (likely * share / (likely * share).sum(1, keepdims=True)).mean(0)
    assert np.allclose(model.mixtures([text])[0][0], share, atol=0.02)


# --- near duplicates


def plain_components(rows, size, num, den):
    def shingle_set(text):
        words = re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        words = [w for w in words if w]
        return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()

    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]].append(i)
    return [(i, len(s), i if not s else min(least[root[k]], default=None)) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates(spark, docs, empty):
    found = minhash.near_duplicates(docs, 3, 85, 100).collect()
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == bag(plain_components(ROWS, 3, 85, 100))
    assert minhash.near_duplicates(empty, 3, 85, 100).count() == 0
    kept = minhash.keep_one(docs, 3, 85, 100)
    assert kept.columns == docs.columns and minhash.keep_one(empty).count() == 0
    ids = [r["doc_id"] for r in kept.collect()]
    assert 3 not in ids and 5 not in ids and {1, 2, 4, 7, 10} <= set(ids) and ids.count(None) == 2


def test_near_duplicate_chains_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows, words = [], [f"w{k}" for k in range(90)]
    for k in range(70):
        words[int(rng.integers(90))] = f"n{k}"
        rows.append((200 - k, " ".join(words)))
    want = bag(plain_components(rows, 3, 85, 100))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert bag((r[0], r[2], r[3]) for r in minhash.near_duplicates(table, 3, 85, 100).collect()) == want
    monkeypatch.setattr(minhash, "GROUP_ROWS", 10)  # large buckets are compared in block pairs
    assert bag((r[0], r[2], r[3]) for r in minhash.near_duplicates(table, 3, 85, 100).collect()) == want


def test_one_document_stays_where_ids_are_missing_or_repeat(spark):
    base = [f"w{k}" for k in range(60)]
    near = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in (2, 57)]
    rows = [(None, " ".join(base)), (9, near[0]), (9, near[1]), (None, near[0]), (4, "alone here with a few words"), (None, "also alone and with some words"), (None, None), (None, None), (5, "")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, 80, 100).collect()
    assert len(kept) == 6 and sum(r["text"] in near for r in kept) == 1 and sum(r["doc_id"] == 9 for r in kept) == 1
    nameless = [(None, " ".join(base)), (None, near[0]), (None, near[1])]
    assert minhash.keep_one(spark.createDataFrame(nameless, "doc_id bigint, text string"), 5, 80, 100).count() == 1


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    b = np.concatenate([a[:1500], np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64))])
    rows = minhash.sketch([a, b, a[:1], a[:0:-1]])
    assert (rows != np.iinfo(np.uint64).max).all()
    assert abs((rows[0] == rows[1]).mean() - 1500 / 2500) < 0.15 and (rows[0] == rows[3]).mean() > 0.95


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (102, 101), (7, 7), (100, 101), (200, 200)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {k: 0 for k in range(61)} | {100: 100, 101: 100, 102: 100}


# --- lines


def test_lines(spark, empty):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega one two three four five six seven eight nine ten"
    rows = [
        (2, base + "\nshort line\n\n" + "a b c d e"), (1, base.upper() + "\nshort line"), (3, base + " eleven\nkeep this line of words\nkeep this line of words"), (None, "a b c d e\nnew words in this line"),
        (4, base), (4, base), (5, None), (6, ""), (7, " \n "), (8, "short line"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n_chars": F.length("text"), "lines": F.lit(1), "c1": F.lit("x")})
    left = linededup.remove_lines(docs, count_into=("had", "went"))
    assert left.columns == [*docs.columns, "had", "went"]
    got = {(r["doc_id"], r["text"], r["had"], r["went"]) for r in left.collect()}
    assert got == {
        (2, "short line\n\na b c d e", 4, 1), (1, base.upper() + "\nshort line", 2, 0), (3, "keep this line of words", 3, 2), (None, "new words in this line", 2, 1), (5, None, 0, 0), (6, "", 1, 0), (7, " \n ", 2, 0), (8, "short line", 1, 0),
    }
    assert left.where("n_chars != length(text)").count() == 0
    assert linededup.remove_lines(docs, drop_emptied=False).where("doc_id = 4 and text = ''").count() == 2
    assert linededup.remove_lines(docs.limit(0)).count() == 0 and linededup.repeated_lines(empty).count() == 0


@pytest.mark.parametrize("group_rows", [1500, 4])
def test_lines_match_brute_force(spark, monkeypatch, group_rows):
    monkeypatch.setattr(linededup, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(2)
    pool = [" ".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 60)) for _ in range(4)]
    rows = []
    for k in range(60):
        words = pool[k % 4].split()
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(60)] = f"x{rng.integers(6)}"
        rows.append((k, " ".join(words[: rng.integers(50, 61)])))
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)) for _, t in rows]
    want = {a for a in range(60) if any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in range(a))}
    found = linededup.repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] for r in found} == want and len(want) > 10


def test_short_lines(spark, tmp_path):
    rows = [(1, "All rights reserved.\n中文文本\na b c d"), (2, " all  RIGHTS reserved. \nrights all reserved.\na b c\na b c d e"), (3, "中文文本\nall rights reserved. x\nx\n\nx\na b c d e"), (4, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {(1, rows[0][1], 0), (2, "rights all reserved.\na b c\na b c d e", 1), (3, "all rights reserved. x\nx\n", 3), (4, "", 1)}
    left = linededup.remove_lines(docs, drop_emptied=False, count_into=("had", "went"), short=True)
    assert {(r["doc_id"], r["text"], r["went"]) for r in left.collect()} == want
    assert {r["doc_id"] for r in corpus_pipeline.lines(spark, docs, None).collect()} == {1, 2, 3}
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {(r["doc_id"], r["n_removed"]) for r in QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()} == {(i, went) for i, _, went in want}


# --- benchmark


def test_decontamination(spark, docs, empty):
    item = "a quick brown fox jumps over one lazy dog while seven wizards brew potent magic drinks in their dark towers tonight"
    swapped = item.replace("lazy", "sleepy").replace("potent", "weak")
    rows = [(1, f"start here {item.upper()}! and go on"), (2, f"x y z {swapped} end"), (3, EN), (4, None), (5, ""), (6, item[:40]), (7, f"{item}"), (7, f"{item}"), (None, item)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(10, item), (11, item), (12, "too short"), (13, None), (None, "")], "item_id bigint, text string")
    found = decontaminate.report(table, bench).collect()
    assert bag((r["doc_id"], r["item_id"]) for r in found) == bag((d, i) for d in (1, 2, 7, 7, None) for i in (10, 11))
    two = next(r for r in found if r["doc_id"] == 2)
    assert (two["matched"], two["substituted"], two["doc_start"], two["doc_end"]) == (19, 2, 3, 24)
    kept = decontaminate.keep_clean(table, bench)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]
    assert decontaminate.report(empty, bench).count() == 0 and decontaminate.report(table, bench.limit(0)).count() == 0


def test_overlap_matches_brute_force():
    rng = np.random.default_rng(8)
    share = Fraction(4, 5)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        item, doc = np.arange(n, dtype=np.uint64), np.arange(n, dtype=np.uint64)
        doc[rng.random(n) < rng.choice([0.1, 0.25, 0.5])] = 1000
        before = int(rng.integers(-5, 6))
        doc = doc[-before:] if before < 0 else np.concatenate([np.full(before, 2000, np.uint64), doc])
        same = [0 <= k + before < len(doc) and item[k] == doc[k + before] for k in range(n)]
        good = [(sum(same[a:b]), a - b, -a) for a in range(n) for b in range(a + 1, n + 1) if sum(same[a:b]) >= share * (b - a)]
        matched, length, start = max(good, default=(0, 0, 0))
        assert decontaminate.overlap(item, doc, before, share) == (-start, -start - length, matched)


def test_decontamination_near_the_ends(spark):
    words = [f"word{k}" for k in range(40)]
    ends = ["other" if k in (1, 13) else w for k, w in enumerate(words[:15])]
    tail = ["other" if k in (3, 7, 11, 15) else w for k, w in enumerate(words[20:39])]
    table = spark.createDataFrame([(1, "x y z " + " ".join(ends) + " z"), (2, "x " + " ".join(tail) + " y z")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(10, " ".join(words[:15])), (11, " ".join(words[20:39]))], "item_id bigint, text string")
    found = decontaminate.report(table, bench).collect()
    assert bag(tuple(r) for r in found) == bag([(1, 10, 15, 13, 2, 3, 18), (2, 11, 19, 12, 3, 1, 16)])
    assert decontaminate.keep_clean(table, bench).count() == 0


def test_decontamination_of_short_and_unspaced_items_matches_a_plain_version(spark):
    rng = np.random.default_rng(21)
    han = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    items = [[f"i{k}t{j}" for j in range(6 + k % 6)] for k in range(24)]
    spoken = [" ".join(x) for x in items] + [han, "ป่าไม้สีเขียวชอุ่มตลอดปี", "one two three four five", "中文字"]
    texts = []
    for k in range(240):
        words = [w if rng.random() > 0.2 else "other" for w in items[k % 24]]
        texts.append(" ".join([*rng.choice(["a", "b", "c"], rng.integers(0, 5)), *words, *rng.choice(["a", "b", "c"], rng.integers(0, 5))]))
    texts += [f"看{han[:9]}他{han[10:]}了", han[:8], f"x {spoken[25]} y", "one two three four five", "中文字", " ".join(EN.split() + items[3][1:] + items[4][:3])]
    share, want = Fraction(4, 5), set()
    for d, text in enumerate(texts):
        doc = decontaminate.tokens(text)
        for i, name in enumerate(spoken):
            item = decontaminate.tokens(name)
            best = max((decontaminate.overlap(item, doc, at, share)[2] for at in range(-len(item) + 1, len(doc))), default=0)
            if len(item) >= 6 and best >= min(12, share * len(item)):
                want.add((d, i, best))
    bench = spark.createDataFrame(list(enumerate(spoken)), "item_id bigint, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r["doc_id"], r["item_id"], r["matched"]) for r in decontaminate.report(docs, bench).collect()} == want
    assert {d for d, _, _ in want} >= {240, 242, 245} and {241, 243, 244}.isdisjoint({d for d, _, _ in want}) and 60 < len(want) < 240


# --- toxicity


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in "bdfgklm" for b in ("oro", "ana", "ilu", "eke")]
    rows, marks = [], []
    for k in range(600):
        sentences = [" ".join(rng.choice(words, 6)) for _ in range(5)]
        if k % 4 == 0:
            sentences[k % 5] += " vileword"
        rows.append((k, ". ".join(sentences)))
        marks.append((k, int(k % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks + [(None, 1), (3, None), (0, 0)], "doc_id bigint, toxic int")
    model = toxicity.learn(table, labels)
    found = toxicity.score_documents(table.withColumn("hold", held_out(F.col("doc_id"))), model).collect()
    right = [(r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in found if r["hold"]]
    assert np.mean(right) > 0.97
    bad = next(r for r in found if r["doc_id"] == 8)
    assert [bad["text"][o["start"] : o["end"]].endswith("vileword") for o in bad["offending"]] == [True]
    scored = toxicity.score_documents(docs, model)
    assert scored.where("score between 0 and 1").count() == len(ROWS) and scored.where("text is null and score = 0").count() == 2
    assert toxicity.score_documents(empty, model).count() == 0
    flat = toxicity.learn(table, labels.limit(0))
    assert not flat.fitted and toxicity.score_documents(table, flat).where("score >= 0.7").count() == 0


# --- neighbours


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 16))
    x[100:1100] = x[100]  # a third of the rows are one vector
    rows = [(k, [float(v) for v in r]) for k, r in enumerate(x)]
    odd = [(None, rows[0][1]), (5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0]), (5080, [None] * 16), (5100, [])]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("leaf", F.lit("clash"))
    found = collections.defaultdict(list)
    for r in neighbours.search(table, 20, 20, leaf_rows=100).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 3000, 20))
    hits = 0
    for q, got in found.items():
        score = x @ x[q]
        assert [g[0] for g in got] == list(range(1, 21)) and all(abs(score[i] - s) < 1e-9 and i != q for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        other = np.delete(np.arange(3000), q)
        best = other[np.lexsort((other, -np.round(score[other], 9)))[:20]]
        hits += len(set(best.tolist()) & {g[1] for g in got})
    assert hits / (20 * len(found)) >= 0.9
    assert neighbours.search(table.limit(0)).count() == 0
    few = neighbours.search(table.where("vec_id < 5"), 20).collect()
    assert [r["rank"] for r in few] == [1, 2, 3, 4] and {r["query_id"] for r in few} == {0}


def test_neighbours_in_bounded_groups(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 8))
    x[100:1100] = x[100]
    table = spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "vec_id bigint, embedding array<double>")
    want = bag(tuple(r) for r in neighbours.search(table, 5, 10, leaf_rows=100, trial_queries=10).collect())
    real = neighbours.Block._open

    def bounded(self):
        assert sum(map(len, self.asked)) <= 60
        real(self)

    monkeypatch.setattr(neighbours, "SHELF_ROWS", 150)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 20)
    monkeypatch.setattr(neighbours.Block, "MOST", 30)
    monkeypatch.setattr(neighbours.Block, "_open", bounded)
    assert bag(tuple(r) for r in neighbours.search(table, 5, 10, leaf_rows=100, trial_queries=10).collect()) == want


def test_shelves_hold_bounded_rows():
    counts = {0: 30, 1: 5, 2: 250, 4: 60, 5: 50, 6: 1}
    shelves = neighbours.Shelves.of(counts, 8, 100)
    held = collections.Counter()
    for leaf, n in counts.items():
        for piece in range(shelves.pieces[leaf]):
            held[shelves.first[leaf] + piece] += -(-n // shelves.pieces[leaf])
    assert max(held.values()) <= 100 and shelves.pieces[2] == 3 and len(held) == 6


def test_neighbours_of_extreme_vectors(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(200, 8))
    plain = neighbours.search(spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "vec_id bigint, embedding array<double>"), 5, 10, leaf_rows=50).collect()
    for size in (2.0**660, 2.0**-300):
        large = neighbours.search(spark.createDataFrame([(k, (r * size).tolist()) for k, r in enumerate(x)], "vec_id bigint, embedding array<double>"), 5, 10, leaf_rows=50).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"]) for r in large} == {(r["query_id"], r["rank"], r["vec_id"]) for r in plain} and len(large) == 100


def test_clustered_neighbours_visit_few_leaves(spark, monkeypatch):
    rng = np.random.default_rng(13)
    middles = rng.normal(size=(60, 16))
    x = middles[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 16)) * 0.05
    table = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x / np.linalg.norm(x, axis=1)[:, None])], "vec_id bigint, embedding array<double>")
    seen = {}
    fit, real = neighbours.fit, neighbours._answer
    monkeypatch.setattr(neighbours, "fit", lambda *a, **k: seen.setdefault("tree", fit(*a, **k)))

    def counted(*a):
        out = real(*a)
        seen.setdefault("rows", []).append(out.count())
        return out

    monkeypatch.setattr(neighbours, "_answer", counted)
    assert neighbours.search(table, 10, 20, leaf_rows=50).count() == 3000
    assert seen["tree"].visits < seen["tree"].leaves / 2
    # what is passed on grows with queries and k, not with the leaves visited
    assert seen["rows"][0] <= 300 * 10 * 2 and seen["rows"][1] <= 300 * 10 * 4


# --- personal data


def test_personal_data(docs, empty):
    patterns = {  # the fixed patterns as the contract words them
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def passes(kind, found):
        digits = [int(c) for c in found if c.isdigit()]
        luhn = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits[::-1])) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in found.split(".")), "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]

    want = []
    for i, t in ROWS:
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, t or "") if passes(k, m.group())]
        want.append((i, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    rows = pii.digest(docs).collect()
    assert bag((r["doc_id"], r["base_sha256"]) for r in rows) == bag(want)
    added = {r["doc_id"]: r["spans"] for r in rows if r["n_added"]}
    assert added == {40: "phone:10:22"}  # after "tel:", but not after "or"
    assert pii.digest(empty).count() == 0


def test_context_extracts_what_no_pattern_takes(spark):
    noise = ["we met at noon", "we met at 12", "he was born in 1999 there"]
    texts = [f"Say hello, reach me {k} via mail: user{k}@host{k}.org today" for k in range(5)] + noise
    texts += ["Also reach me via mail: jane(at)corp now", "so write via mail: bob#example, thanks", "jane(at)corp wrote from desk 12345678 again", "mail: plain words", "at noon"]
    # "mail:" has 5 known of 8 distinct tokens: 5/9; "via mail:" 5 of 7: 5/8; together 1 - 4/9 * 3/8 = 0.83. "from desk" holds nothing known.
    got = {r["doc_id"]: r["spans"] for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect() if r["n_added"]}
    expected = {}
    for i, want in ((8, "jane(at)corp"), (9, "bob#example"), (10, "jane(at)corp")):
        at = texts[i].index(want)
        expected[i] = f"email:{at}:{at + len(want)}"
    assert got == expected


def test_context_goes_on_until_nothing_is_added(spark):
    seeds = [f"tel: +49 30 1234{k}67" for k in range(30)]
    first = [f"tel: 030/77{k}" for k in range(5)] + [f"Durchwahl 030/77{k} ok" for k in range(5)]
    texts = seeds + first + ["Durchwahl 99-x ok"]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect() if r["n_added"]}
    # "tel:" (30/36) teaches what stands after "Durchwahl" too, and three patterns around that (5 * 30/36 of 7) teach the last one
    assert set(got) == set(range(30, 41)) and got[40] == "phone:10:14"


def test_counting_a_part_first_changes_nothing(spark):
    # "a" stands before seeds, plain words and loose tokens; "b" before seeds and loose tokens only, 8 / 11, as "y" does after them, 8 / 10;
    # some texts hold the mark itself
    texts = [f"x a u{k}@h{k}.org y b v{k}@g{k}.net z" for k in range(8)] + [f"x a word{'klm'[k % 3]}{chr(97 + k % 26)} then a other{chr(97 + k // 2 % 26)} " for k in range(60)]
    texts += ["x a one(at)two", f"so b three(at)four {pii.MARK} y", f"{pii.MARK}b five(at)six y b seven(at)eight"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [sorted(map(repr, pii.digest(docs, believed=0.6, parts=parts).collect())) for parts in (1, 2, 16)]
    assert got[0] == got[1] == got[2]
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(docs, believed=0.6).collect() if r["n_added"]}
    assert {i: [texts[i][int(a) : int(b)] for _, a, b in (x.split(":") for x in s.split(","))] for i, s in spans.items()} == {69: ["three(at)four"], 70: ["five(at)six", "seven(at)eight"]}


def generated(df):
    """The rows each generator of df's plan makes from word places, as its run counts them."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        plan = todo.pop()
        name = plan.nodeName()
        if name == "Generate" and "word" in plan.toString().split("\n")[0]:
            out.append(plan.metrics().apply("numOutputRows").value())
        if name == "AdaptiveSparkPlan":
            todo.append(plan.executedPlan())
        elif "QueryStage" in name:
            todo.append(plan.plan())
        else:
            todo += [plan.children().apply(k) for k in range(plan.children().size())]
    return out


def test_a_rare_pair_does_not_bring_all_places_of_its_common_word(spark):
    # a pair with "the" is wanted, alone among all that stands beside "the"
    texts = [f"the {chr(97 + k % 26)}{chr(97 + k // 26)} the" for k in range(500)] + ["via the desk today", "via the desk", "via the line", "via the 12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    wanted = pii.Written(spark.createDataFrame([("2\tvia\tthe", 3), ("b\tthe\ttoday", 3)], "pattern string, others bigint"), "wanted")
    counted = pii._plain(docs, wanted, "doc_id", "text")
    counted = counted if hasattr(counted, "collect") else counted[0]
    assert {r["pattern"]: r["plain"] for r in counted.collect()} == {"2\tvia\tthe": 2, "b\tthe\ttoday": 1}
    assert min(generated(counted)) <= 10


def test_many_hits_in_one_text(spark):
    count = 30_000
    one = spark.createDataFrame([(1, " ".join(f"a{k}@b.cc" for k in range(count)))], "doc_id bigint, text string")
    row = pii.digest(one).first()
    last = row["spans"].rsplit(",", 1)[1]
    size = len(" ".join(f"a{k}@b.cc" for k in range(count)))
    assert row["n_email"] == count and last == f"email:{size - len(f'a{count - 1}@b.cc')}:{size}"


# --- pipeline and registration


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
        assert stage(spark, docs.limit(0), sf).count() == 0
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert final.count() == before and final.where("not round_trip").count() == 0


def test_stage_rejections(spark, sf):
    odd = [(1, None), (2, "12 !!"), (3, EN), (3, EN), (4, EN + " once"), (None, EN)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in odd] + [(k, f"{EN} {k}", "en", "s", 1) for k in range(50, 60)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, sf).collect()}
    assert {1, 2}.isdisjoint(kept) and {3, 4, None} <= kept


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
