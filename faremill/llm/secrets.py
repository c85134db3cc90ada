"""Secrets in text: fixed patterns, and literals found by reading assignments.

The fixed patterns see one shape at a time. Beside them every text is lexed as the source and configuration it may hold: names, quoted and
bare literals and assigning operators become (name, literal) pairs, whether written `password = "..."`, `"password": "..."`,
`<password>...</password>`, `--password ...`, `put("password", "...")` or `config["password"] = ...`. A literal may reach a sensitive name by
way of others (`a = "..."`, `db_password = a`): constants are propagated along such copies. A literal's score is that of the most sensitive name
it reaches, times how much it looks like a value someone chose rather than a placeholder or prose.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import enter, free_names

KINDS = ("assign", "access", "hex")
ADDED = "literal"
# Fixed patterns, with the least length of the part that counts.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}
# Every place of 32 hex digits holds one of these places; texts without are not searched further.
_HEX_RUN = re.compile(r"[0-9a-f]{32}")

# --- names

# Words that make a name sensitive, alone or as neighbours, and words that make a name tell about a secret, not hold it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "secrets": 0.8, "token": 1.0, "apikey": 1.0, "apitoken": 1.0,
    "credential": 0.9, "credentials": 0.9, "creds": 0.9, "secretkey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "authtoken": 1.0, "accesstoken": 1.0, "pass": 0.8, "pw": 0.7, "bearer": 0.8,
    "authorization": 0.7, "auth": 0.6, "pin": 0.5, "otp": 0.6, "signature": 0.5, "passkey": 0.9, "connectionstring": 0.7,
}
BEFORE_KEY = frozenset("api access private secret auth encryption encrypt signing sign account master service storage client shared session crypto cipher aes hmac jwt ssh license".split())
TELLING = frozenset(
    "count length len max min size limit type name names id ids url uri path file dir field label hint placeholder prompt policy regex pattern expiry expires expiration ttl timeout format header public "
    "column param params enabled required reset error message text title description prefix suffix index version algorithm hash status state endpoint host port user username email".split()
)
_STEM = re.compile(r"pass|pw|secret|token|key|cred|auth|bearer|pin|otp|signature|connectionstring", re.I | re.A)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", re.A)


def name_score(name: str) -> float:
    """How surely a name holds a secret: 0 to 1. The last sensitive word counts, less if the name goes on with words like `length`."""
    words = [w.lower() for w in _WORDS.findall(name)]
    best, place = 0.0, -1
    for k, word in enumerate(words):
        score = SENSITIVE.get(word, 0.0)
        if k and word in ("key", "keys") and words[k - 1] in BEFORE_KEY:
            score = 1.0
        elif k and words[k - 1] + word in SENSITIVE:
            score = max(score, SENSITIVE[words[k - 1] + word])
        if score and score >= best:
            best, place = score, k
    told = any(w in TELLING for w in words[place + 1 :]) or "public" in words[:place]
    return best * 0.3 if told else best


# --- literals

_PLACEHOLDER = re.compile(
    r"(?:your|my|the|some|any|change|replace|insert|enter|put|add|example|sample|dummy|fake|mock|test|todo|fixme|redacted|removed|hidden|masked|none|null|nil|true|false|undefined|empty|default|required|optional|string|unknown|n/?a)(?:me|this|it|here)?(?![a-z])",
    re.I | re.A,
)
_TEMPLATE = re.compile(r"\$\{|\{\{|%\(|<[A-Za-z_ -]+>\Z|\A\$[A-Za-z_]|\A%[sd]\Z|\A\{[A-Za-z_]*\}\Z")
LEAST = 6


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a chosen value: 0 to 1. Short ones, templates, one repeated character and placeholders are none."""
    if len(value) < LEAST or _TEMPLATE.search(value) or len(set(value)) < 3:
        return 0.0
    if _PLACEHOLDER.match(value):
        return 0.2
    if any(c.isspace() for c in value):
        # a phrase may be a passphrase only where it is quoted
        return 0.55 if quoted and len(value) <= 64 and value.count(" ") <= 8 else 0.1
    kinds = (any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value), any(not c.isalnum() for c in value))
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    varied = min(1.0, bits / 3.0)
    base = 1.0 if kinds[2] or sum(kinds) >= 3 else 0.75 if sum(kinds) == 2 else 0.65
    return base * (0.4 + 0.6 * varied) * (1.0 if quoted or kinds[2] else 0.6)


# --- lexing

# One pass over a line. A quote opens a literal only where no word ends before it, so that apostrophes in prose do not; a backslash takes the
# next character with it, in and out of literals, so a quote that never closes is looked for once a line and the lexing stays linear.
_TOKEN = re.compile(
    r"""(?P<str>(?<![A-Za-z0-9])(?:"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|`[^`\\\n]*+(?:\\.[^`\\\n]*+)*+`))
|(?P<end></[A-Za-z_][\w.:-]*+>)
|(?P<tag><[A-Za-z_][\w.:-]*+>)
|(?P<ref>\$\{[A-Za-z_][\w.]*+\}|\$\([A-Za-z_][\w.]*+\)|%[A-Za-z_]\w*+%|\{\{\s?[A-Za-z_][\w.]*+\s?\}\})
|(?P<flag>(?<!\S)--?[A-Za-z][\w-]*+)
|(?P<name>[$@]?[A-Za-z_]\w*+(?:(?:\.|->|::|-)[A-Za-z_]\w*+)*+)
|(?P<op>:=|=>|\?=|\+=|==|!=|<=|>=|[=:])
|(?P<punct>\\.|[^\s])""",
    re.X | re.A,
)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>|&]+""")
_MAY = re.compile(r"""[=:<]|(?<!\S)--\w|\(\s*["'`]""", re.A)
ASSIGNS = frozenset((":=", "=>", "?=", "+=", "=", ":"))
_LOOK_UP = re.compile(r"get|env|config|fetch|lookup|param|find|read|load", re.I | re.A)
JOINTS = frozenset(("+", ".", "|", "?", "or"))


@dataclass
class Read:
    """What lexing a text gives: literals (start, end, value, quoted, names they go to) and copies from one name to another."""

    literals: list = field(default_factory=list)
    copies: list = field(default_factory=list)


def _plain(name: str) -> str:
    """A name as it is looked up: without its sigil, and of a dotted chain the last member."""
    return re.split(r"\.|->|::", name.lstrip("$@-"))[-1]


def _value(line: str, base: int, tokens: list, k: int, name: str, out: Read) -> int:
    """Read what stands at token k as the value assigned to name; returns the first token behind it. Joined parts all belong to it."""
    target = _plain(name)
    while k < len(tokens):
        kind, a, b = tokens[k]
        if kind == "str":
            out.literals.append((base + a + 1, base + b - 1, line[a + 1 : b - 1], True, target, name))
            for ref in re.finditer(r"\$\{([A-Za-z_][\w.]*)\}|\{([A-Za-z_]\w*)\}", line[a + 1 : b - 1]):
                out.copies.append((_plain(ref.group(1) or ref.group(2)), target))
            k += 1
        elif kind == "ref":
            out.copies.append((_plain(line[a:b].strip("${}()% ")), target))
            k += 1
        elif kind == "name" and k + 1 < len(tokens) and line[tokens[k + 1][1]] in "([" and tokens[k + 1][0] == "punct":
            # a call or an index: what stands inside is read by its own rules, and its literals also go to this name
            looked_up = bool(_LOOK_UP.search(line[a:b])) or line[tokens[k + 1][1]] == "["
            depth, k = 0, k + 1
            while k < len(tokens):
                kind, a, b = tokens[k]
                mark = line[a:b] if kind == "punct" else ""
                depth += (mark in ("(", "[")) - (mark in (")", "]"))
                # the first argument of a look-up is a name, those behind it are defaults
                if kind == "str" and looked_up and line[tokens[k - 1][1] : tokens[k - 1][2]] in ("[", "("):
                    out.copies.append((line[a + 1 : b - 1], target))
                elif kind == "str":
                    out.literals.append((base + a + 1, base + b - 1, line[a + 1 : b - 1], True, target, name))
                k += 1
                if depth <= 0:
                    break
        elif kind in ("name", "punct", "flag", "op"):
            bare = _BARE.match(line, a)
            if not bare:
                return k
            word = bare.group().rstrip(".:")
            if kind == "name" and word == line[a:b]:
                out.copies.append((_plain(word), target))
            if word:
                out.literals.append((base + a, base + a + len(word), word, False, target, name))
            while k < len(tokens) and tokens[k][1] < bare.end():
                k += 1
        else:
            return k
        joint = line[tokens[k][1] : tokens[k][2]] if k < len(tokens) else ""
        if joint not in JOINTS:
            return k
        while k < len(tokens) and line[tokens[k][1] : tokens[k][2]] in JOINTS:
            k += 1
    return k


def lex_line(line: str, base: int, out: Read) -> None:
    """The pairs of one line, whose first character is the text's `base`-th."""
    tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(line)]
    spell = lambda k: line[tokens[k][1] : tokens[k][2]]
    k, key = 0, None
    while k < len(tokens):
        kind, a, b = tokens[k]
        if kind == "op" and line[a:b] in ASSIGNS and k:
            j = k - 1
            if spell(j) in ("]", ")") and j and tokens[j - 1][0] == "str":
                j -= 1
            name = None
            if tokens[j][0] == "str":
                name = line[tokens[j][1] + 1 : tokens[j][2] - 1]
            elif tokens[j][0] in ("name", "flag"):
                name = spell(j)
                # name: type = value
                if line[a:b] == "=" and j >= 2 and spell(j - 1) == ":" and tokens[j - 2][0] == "name":
                    name = spell(j - 2)
            if name and k + 1 < len(tokens):
                if name.lower() in ("key", "name") and tokens[k + 1][0] == "str":
                    key = line[tokens[k + 1][1] + 1 : tokens[k + 1][2] - 1]
                elif name.lower() == "value" and key:
                    name, key = key, None
                follow = k + 1
                # the value of an annotated name stands behind its type
                typed = line[a:b] == ":" and follow + 1 < len(tokens) and tokens[follow][0] == "name" and spell(follow + 1) == "="
                if typed:
                    k += 1
                else:
                    at = _value(line, base, tokens, follow, name, out)
                    # what a value's own text holds is read again below, as nested pairs
                    k = max(at, k + 1)
                continue
        elif kind == "tag":
            stop = line.find("<", b)
            value = line[b : stop if stop >= 0 else len(line)]
            lead = len(value) - len(value.lstrip())
            if value.strip():
                out.literals.append((base + b + lead, base + b + lead + len(value.strip()), value.strip(), True, _plain(line[a + 1 : b - 1]), line[a + 1 : b - 1]))
                while k + 1 < len(tokens) and tokens[k + 1][1] < b + len(value):
                    k += 1
        elif kind == "flag" and k + 1 < len(tokens) and tokens[k + 1][0] not in ("op", "flag") and line[a : a + 2] == "--":
            k = max(_value(line, base, tokens, k + 1, line[a:b].lstrip("-"), out), k + 1)
            continue
        elif kind == "str" and k and spell(k - 1) == "(":
            if k + 2 < len(tokens) and spell(k + 1) == "," and tokens[k + 2][0] == "str":
                _value(line, base, tokens, k + 2, line[a + 1 : b - 1], out)
            elif k >= 2 and tokens[k - 2][0] == "name" and re.match(r"set|with|use", _plain(spell(k - 2)), re.I):
                out.literals.append((base + a + 1, base + b - 1, line[a + 1 : b - 1], True, _plain(spell(k - 2))[3:], spell(k - 2)))
        k += 1


def _nested(out: Read) -> None:
    """Pairs written inside quoted literals (connection strings, queries, embedded JSON): one level, the literal's own text lexed again."""
    for start, _, value, quoted, _, _ in list(out.literals):
        if quoted and _MAY.search(value) and _STEM.search(value):
            lex_line(value.replace("&", " ").replace(";", " ").replace("?", " "), start, out)


def read(text: str) -> Read:
    """All pairs of a text, line by line; lines without an assigning character hold none."""
    out = Read()
    start = 0
    for line in text.split("\n"):
        if _MAY.search(line):
            lex_line(line, start, out)
        start += len(line) + 1
    _nested(out)
    return out


def reach(out: Read) -> dict[str, tuple[float, str]]:
    """For every name the score of the most sensitive name its value is copied to, over any number of copies, and that name."""
    back, own = {}, {}
    for source, target in out.copies:
        back.setdefault(target, []).append(source)
        for n in (source, target):
            own.setdefault(n, name_score(n))
    for *_, target, name in out.literals:
        own[target] = max(own.get(target, 0.0), name_score(target), name_score(name) if name != target else 0.0)
    best = {}
    for name in sorted(own, key=lambda n: (-own[n], n)):
        todo = [name]
        while todo:
            n = todo.pop()
            if n not in best:
                best[n] = (own[name], name)
                todo += back.get(n, ())
    return best


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the fixed patterns' matches, leftmost and non-overlapping per kind; those that are too short go."""
    found = []
    for k, kind in enumerate(KINDS):
        pattern, group, least = BASE[kind]
        if kind == "hex" and not _HEX_RUN.search(text):
            continue
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def scan(text: str, threshold: float = 0.5) -> tuple[list, list]:
    """(base, added): base as base_spans gives it, added as (start, end, score, name) in order; added ones touch no base span."""
    base = base_spans(text)
    # a sensitive name holds one of these stems
    if not _STEM.search(text):
        return base, []
    out = read(text)
    best = reach(out)
    scored = {}
    for start, end, value, quoted, target, _ in out.literals:
        score, name = best[target]
        if score:
            score *= literal_score(value, quoted)
            if score >= threshold and score > scored.get((start, end), (0.0, ""))[0]:
                scored[start, end] = (score, name)
    added, at, reached = [], 0, 0
    spans = sorted((s, e) for s, _, e in base)
    last = -1
    for (start, end), (score, name) in sorted(scored.items()):
        # base spans are passed in order; `reached` is how far those that began before this literal's end go
        while at < len(spans) and spans[at][0] < end:
            reached = max(reached, spans[at][1])
            at += 1
        if reached <= start and start >= last:
            added.append((start, end, score, name))
            last = end
    return base, added


SPANS = "array<struct<kind:string,start:int,end:int,name:string,score:double,found:string>>"


def find(docs: DataFrame, text_col: str = "text", into: str = "secrets", threshold: float = 0.5) -> DataFrame:
    """docs with a column `into`: per secret its kind, place in code points (end exclusive), the sensitive name and score if it was found by
    lexing (kind `literal`; null and 1 for the fixed patterns), and what was found. Sorted by start, then kind.

    Null texts are empty and hold none; rows are answered one by one, so repeated rows and ties get equal answers; an empty table stays
    empty; all other columns are kept, and one already named `into` is replaced. Texts are read whole, at a cost linear in their length.
    Names are looked up in one text, without regard to scopes; of a dotted name the last member counts.
    """
    docs = docs.drop(into)
    work, = free_names(docs, "secrets_found")

    @F.pandas_udf(SPANS)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enter("secrets")
        for texts in parts:
            out = []
            for text in texts:
                text = text or ""
                base, added = scan(text, threshold)
                spans = [(s, k, e, None, 1.0) for s, k, e in base] + [(s, len(KINDS), e, name, score) for s, e, score, name in added]
                out.append([{"kind": (*KINDS, ADDED)[k], "start": s, "end": e, "name": name, "score": score, "found": text[s:e]} for s, k, e, name, score in sorted(spans, key=lambda x: x[:3])])
            yield pd.Series(out)

    return docs.withColumn(work, found(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))).withColumnRenamed(work, into)


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal) of every row."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    rows = find(docs.select("doc_id", "text")).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != ADDED)
    return rows.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"), count(ADDED))
