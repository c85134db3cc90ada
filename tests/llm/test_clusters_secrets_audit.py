"""Centroid clustering, secrets and the filter audit: against plain versions, on awkward rows and against their SQL."""

import collections
import hashlib
import itertools
import math
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import centroids, filter_audit, secrets

# --- clusters


def plain_clusters(rows, clusters=40, rounds=5, length=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == length and all(x is not None and abs(x) <= 262144 for x in v)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    middle = [q for _, q in named[:clusters]]
    if not middle:
        return []

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, q in kept:
            groups[near(q)[1]].append(q)
        middle = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if groups[k] else c for k, c in enumerate(middle)]
    hits = [(i, *near(q)) for i, q in kept]
    inertia = collections.Counter()
    for _, d, k in hits:
        inertia[k] += d
    return [(i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, middle[k])).encode()).hexdigest()) for i, d, k in hits]


def bag(rows):
    return collections.Counter(map(repr, map(tuple, rows)))


def clumped(n, seed=3, length=64):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, length))
    return [(i, [float(x) for x in middles[i % 12] + rng.normal(size=length) * 0.2]) for i in range(n)]


def awkward():
    rows = clumped(150)
    same = [0.25, -0.3] * 32
    rows += [(1000 + k, same) for k in range(60)] + [(7, same), (7, [0.0] * 64), (None, same), (None, [1.0] * 64)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65), (2004, [None] + [1.0] * 63), (2005, [math.nan] + [1.0] * 63), (2006, [math.inf] + [0.0] * 63), (2007, [1e200] * 64)]
    rows += [(2008, [262144.0] * 64), (2009, [-262144.0] * 64), (2010, [-0.0] * 64)]
    return rows


SCHEMA = "vec_id bigint, embedding array<double>"


def test_clusters_match_plain_version(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"cluster": F.lit("x"), "q": F.lit(1), "distance": F.lit(None).cast("int")}).repartition(5)
    want = plain_clusters(rows)
    assert len(want) == len(rows) - 8
    assert bag(centroids.cluster(df).collect()) == bag(want)
    assert bag(centroids.cluster(df, clusters=3, rounds=2).collect()) == bag(plain_clusters(rows, 3, 2))


def test_clusters_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)], SCHEMA)
    assert bag(centroids.cluster(few).collect()) == bag(plain_clusters([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)]))
    for rows in ([], [(None, [1.0] * 64)], [(1, None)]):
        assert centroids.cluster(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_clusters_match_sql(spark, tmp_path):
    df = spark.createDataFrame([r for r in awkward() if r[0] != 7], SCHEMA)
    got = centroids.cluster(df).toPandas()
    con = duckdb.connect()
    con.register("arrow", df.toArrow())
    con.sql("create view embeddings as select * from arrow")
    theirs = con.sql(centroids.cluster_sql()).df()
    key = ["vec_id", "cluster", "distance"]
    assert bag(got[theirs.columns].sort_values(key).fillna(-1).astype(str).values.tolist()) == bag(theirs.sort_values(key).fillna(-1).astype({"vec_id": float}).astype(str).values.tolist())


def test_orchard_is_exact_and_measures_less():
    rng = np.random.default_rng(5)
    middles = rng.integers(-2000, 2000, (40, 64))
    x = middles[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 64))
    x[:40] = middles
    x[40:80] = (middles + np.roll(middles, 1, 0)) // 2
    far = ((x[:, None] - middles[None]) ** 2).sum(2)
    for start in (np.zeros(3000, int), rng.integers(0, 40, 3000), far.argmin(1)):
        near, distance, measured = centroids.Lists.of(middles).nearest(x, start)
        assert (near == far.argmin(1)).all() and (distance == far.min(1)).all()
    # begun at the right centroid, next to nothing else is measured in clumped data
    assert measured < 3000 * 3
    twice = np.repeat(middles[:3], 4, 0)
    near, _, _ = centroids.Lists.of(twice).nearest(x, np.full(3000, 11))
    assert (near == ((x[:, None] - twice[None]) ** 2).sum(2).argmin(1)).all()


# --- secrets


def plain_base(text):
    out = []
    for kind, pattern, flags, group, least in (
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 16), ("hex", r"[0-9a-f]+", 0, 0, 32),
    ):
        for m in re.finditer(pattern, text, flags):
            if len(m.group(group)) >= least:
                out.append((m.start(), ("assign", "access", "hex").index(kind), kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


# the text, and what lexing adds to the fixed patterns
READ = [
    ('db_pwd = "zX9kQ2mm71"', ["zX9kQ2mm71"]),
    ('const dbPwd: string = "Tr0ub4dor&3";', ["Tr0ub4dor&3"]),
    ("<passphrase>s3cr3tVal</passphrase>", ["s3cr3tVal"]),
    ("mysql --pwd hunter22x -u root", ["hunter22x"]),
    ('put("signing_key", "q1w2e3r4t5")', ["q1w2e3r4t5"]),
    ('os.environ["AUTH_PASSCODE"] = "zz11yy22xx"', ["zz11yy22xx"]),
    ('pwd = os.getenv("DB_PW", "fallb4ck99")', ["fallb4ck99"]),
    ('pwd = base64("c2VjcmV0MTIz")', ["c2VjcmV0MTIz"]),
    ('<add key="DbPwd" value="abcd1234"/>', ["abcd1234"]),
    ('url = "jdbc:x://h?user=a&pwd=k1k2k3k4"', ["k1k2k3k4"]),
    ('A = "zX9kQ2mm71"\nB = A\nconn.pwd = B', ["zX9kQ2mm71"]),
    ("auth_pwd = tok\nother = 1\ntok = 'abcabc123'", ["abcabc123"]),
    ('base: &x "q9q9w8w8"\npwd: "${seed}"\nseed = "r7r7t6t6"', ["r7r7t6t6"]),
    ('x := "abc123def"\nsigningKey := x + "tail99"', ["abc123def", "tail99"]),
    ('pwd = "${DB_PWD}"', []), ('pwd = "changeme"', []), ('pwd_length = "12345678"', []), ("pwd_file: /etc/x/y12345", []), ("The key: something nice", []),
    ("don't say 'secret' it's ok", []), ('greeting = "zX9kQ2mm71"', []), ("pwd: ********", []), ('public_key = "zX9kQ2mm71"', []), ("", []), (None, []),
    ('A = B\nB = A\nC = "zX9kQ2mm71"', []), ('A = B\nB = A\nB = "zX9kQ2mm71"\npwd = A', ["zX9kQ2mm71"]),
    ('password = "zX9kQ2mm71"', []), ("é😀 pwd = 'zX9kQ2mm71'", ["zX9kQ2mm71"]),
]


def test_literals_read_from_assignments(spark):
    rows = [(k, t) for k, (t, _) in enumerate(READ)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"secrets": F.lit(3), "secrets_found": F.lit("mine"), "kind": F.lit(None).cast("string")})
    found = secrets.find(df).collect()
    assert len(found) == len(rows) and set(found[0].asDict()) == set(df.columns)
    for r in found:
        assert [s["found"] for s in r["secrets"] if s["kind"] == "literal"] == READ[r["doc_id"]][1], r["text"]
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secrets"] if s["kind"] != "literal"] == plain_base(r["text"] or "")
        assert all((r["text"] or "")[s["start"] : s["end"]] == s["found"] for s in r["secrets"])
    assert secrets.find(df.limit(0)).collect() == []


def test_digest_of_secrets(spark):
    key, long = "AKIA" + "Q" * 12, "0123456789abcdef" * 2
    texts = [f"token={key}zz {long} pass\nPaSsWoRd' : \"{long}\" api-key: x apikey=12345678 AKIA123 {long}g{long[:31]}", "ſecret=12345678 toKen=12345678", f"é pwd = 'zX9kQ2mm71' {key}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None)], "doc_id bigint, text string")
    for r in secrets.digest(df).collect():
        text = texts[r["doc_id"]] if r["doc_id"] is not None else ""
        want = plain_base(text)
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("literal")] == want
        counts = collections.Counter(x.split(":")[0] for x in want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (counts["assign"], counts["access"], counts["hex"])
    assert r["n_literal"] == 0 and secrets.digest(df).where("doc_id = 2").first()["n_literal"] == 1


def test_base_spans_against_plain_version_on_random_texts():
    rng = random.Random(4)
    bits = ["password", "PASSWD", "secret", "token", "api_key", "apikey", '"', "'", " ", ":", "=", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "\n", "é", "😀", "x", "-", "+/_"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        base, added = secrets.scan(text)
        assert [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base] == plain_base(text)
        assert all(e <= s2 or e2 <= s for s, e, *_ in added for s2, _, e2 in base)


@pytest.mark.parametrize("unit", ['pwd="\\"', "token=(", 'a="b', "<key>", "secret [(", "a=b+", '"pass" : ', "k='", "a=b\nb=a\npwd=a ", "password "])
def test_long_texts_take_linear_time(unit):
    def seconds(n):
        started = time.perf_counter()
        secrets.scan(unit * n + " pwd")
        return time.perf_counter() - started

    short = min(seconds(4000) for _ in range(2))
    assert seconds(32000) < 40 * short + 0.5


# --- filter audit


def plain_audit(docs, labels):
    good, toxic = collections.defaultdict(bool), collections.defaultdict(bool)
    for i, q, t in labels:
        if i is not None:
            good[i] |= q == 1
            toxic[i] |= t == 1
    ids = collections.defaultdict(list)
    for i, t, _ in docs:
        if i is not None:
            ids[t or ""].append(i)
    rows = []
    for i, t, lang in docs:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and any(j < i for j in ids[text]),
        }
        rows.append((lang or "", fails, i is not None and good[i], i is not None and toxic[i]))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = collections.Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                total[f] += len(gone)
                failing = [r for r in mine if r[1][f]]
                lines.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(sum(r[1].values()) == 1 for r in failing), sum(r[2] for r in gone), sum(r[3] for r in gone), f])
        out += [(*x[:-1], total[x[-1]]) for x in lines]
    return out


def audit_rows():
    rng = random.Random(8)
    long = " ".join(f"w{k}" for k in range(260))
    texts = [long, long + " #", " ".join(["a b"] * 150), "SHOUT " * 300, "", None, " \t\x0b ", "x" * 5000 + " ä", long.upper(), "  lead " + long, long + "\n", " nbsp　wide " * 120]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(260)]
    docs += [docs[0]] * 3 + [(5, long, "en"), (5, long, "de"), (None, long, None)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    return docs, labels


DOCS, LABELS = "doc_id bigint, text string, lang string", "doc_id bigint, quality int, toxic int"


def test_audit_matches_plain_version_and_sql(spark):
    docs, labels = audit_rows()
    extra = {"part": F.lit(9), "mask": F.lit("m"), "key": F.lit(1), "n": F.lit(2), "good": F.lit("g"), "id_": F.lit(1)}
    d, lab = spark.createDataFrame(docs, DOCS).withColumns(extra).repartition(4), spark.createDataFrame(labels, LABELS).withColumns({"text": F.lit("t"), "n": F.lit(1)})
    got = filter_audit.audit(d, lab)
    rows = bag(got.collect())
    assert got.columns == filter_audit.RESULT.replace(",", "").split()[::2]
    assert rows == bag(plain_audit(docs, labels))
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(docs, DOCS).toArrow())
    con.register("labels", spark.createDataFrame(labels, LABELS).toArrow())
    assert bag(con.sql(filter_audit.audit_sql()).fetchall()) == rows


def test_audit_of_empty_tables(spark):
    docs, labels = audit_rows()
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    assert filter_audit.audit(d.limit(0), lab).collect() == []
    assert bag(filter_audit.audit(d, lab.limit(0)).collect()) == bag(plain_audit(docs, []))


def test_copies_by_the_thousand(spark):
    d = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.lit("en").alias("lang"))
    r = filter_audit.audit(d, spark.createDataFrame([], LABELS)).where("filter_order = 'EABCD' and step = 1").first()
    assert (r["removed"], r["kept"]) == (6666, 13334)


def test_shares_are_shapley_values():
    rng = random.Random(2)
    for _ in range(50):
        counts = [rng.randint(0, 40) for _ in range(32)]
        removed = [sum(n for m, n in enumerate(counts) if m & s) for s in range(32)]
        want = [0] * 5
        for order in itertools.permutations(range(5)):
            before = 0
            for k in order:
                want[k] += removed[before | 1 << k] - removed[before]
                before |= 1 << k
        assert [x * 120 for x in filter_audit.fair_shares(removed)] == want
