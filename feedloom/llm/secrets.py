"""Secrets in texts, found through a trigram inverted index and verified by the rules' expressions.

Each rule is a regular expression. From its parse tree follows a Boolean query: alternatives of
trigrams, all of which every match has. A batch of texts is indexed (byte trigrams of the text in
lower case, only those that some rule's query names, each with the sorted rows that hold it), the
postings of an alternative are intersected, the alternatives united, and the expression runs on the
candidate rows alone. A rule without a mandatory trigram scans every row. An index covers one batch of
bounded size, so it stays in the memory of the task that made it and no text is shuffled.

A very long text is a batch of its own, indexed and searched whole. Spans that begin alike stand in the
order of their kinds.

Nulls: a null text counts as empty and has no span. Repeated rows give repeated results; an empty
table gives no rows. A column of the input that has the name of a result column is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from re import _constants as ops  # the parse tree of the standard library's expressions
from re import _parser as parser
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import map_texts, table

# Strings that are followed side by side while a query is derived, and alternatives of a query.
_STRINGS, _ALTERNATIVES = 64, 64

Query = list[frozenset[bytes]]
EVERYTHING: Query = [frozenset()]


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose `group` has `least` code points or more."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    regex: re.Pattern = field(init=False, repr=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "regex", re.compile(self.pattern, re.ASCII))

    def spans(self, text: str) -> Iterable[tuple[int, int]]:
        for m in self.regex.finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.span()


# Fixed: the base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # a maximal run of 24 or more is what the plain run gives once shorter ones are dropped
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Kinds beyond the base ones: token formats that providers document.
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,255}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^/\s:@]{1,256}:[^/\s:@]{1,256}@"),
)
RULES = BASE + FURTHER


def trigrams(text: str) -> frozenset[bytes]:
    raw = text.encode().lower()
    return frozenset(raw[i : i + 3] for i in range(len(raw) - 2))


def absorbed(query: Iterable[frozenset[bytes]]) -> Query:
    """Without alternatives that another one implies."""
    out: Query = []
    for one in sorted(set(query), key=len):
        if not any(held <= one for held in out):
            out.append(one)
    return out


def both(a: Query, b: Query) -> Query:
    """Matches both; if that has too many alternatives, the one with fewer stands for both."""
    if len(a) * len(b) > _ALTERNATIVES:
        return min(a, b, key=lambda q: (q == EVERYTHING, len(q)))
    return absorbed(x | y for x in a for y in b)


def _literals(item: tuple) -> set[str] | None:
    """The strings that one element of a parse tree matches, if they are few."""
    op, arg = item
    if op is ops.LITERAL:
        return {chr(arg)}
    if op is ops.IN:
        found: set[str] = set()
        for kind, value in arg:
            if kind is ops.LITERAL:
                found.add(chr(value))
            elif kind is ops.RANGE and value[1] - value[0] < 8:
                found |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is ops.AT:
        return {""}
    if op is ops.SUBPATTERN:
        return _strings(arg[3])
    if op is ops.BRANCH:
        parts = [_strings(p) for p in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[1] <= 8 and arg[1] != ops.MAXREPEAT:
        one, out = _strings(arg[2]), {""} if arg[0] == 0 else set()
        if one is None:
            return None
        grown = {""}
        for n in range(1, arg[1] + 1):
            grown = {a + b for a in grown for b in one}
            if len(grown) > _STRINGS:
                return None
            if n >= arg[0]:
                out |= grown
        return out
    return None


def _strings(tree: Iterable[tuple]) -> set[str] | None:
    out = {""}
    for item in tree:
        one = _literals(item)
        if one is None or len(out) * len(one) > _STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _derived(tree: Iterable[tuple]) -> Query:
    """What every match of a sequence has: the trigrams of its stretches of known strings."""
    query, held = EVERYTHING, {""}

    def close(query: Query) -> Query:
        return both(query, absorbed(trigrams(s) for s in held))

    for item in tree:
        one = _literals(item)
        if one is not None and len(held) * len(one) <= _STRINGS:
            held = {a + b for a in held for b in one}
            continue
        query, held = close(query), {""}
        if one is not None:
            held = one
            continue
        op, arg = item
        if op is ops.SUBPATTERN:
            query = both(query, _derived(arg[3]))
        elif op is ops.BRANCH:
            query = both(query, absorbed(q for p in arg[1] for q in _derived(p)))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[0] > 0:
            query = both(query, _derived(arg[2]))
    return close(query)


def trigram_query(pattern: str) -> Query:
    """Alternatives of mandatory trigrams, in lower case; EVERYTHING if there is none."""
    return _derived(parser.parse(pattern))


class Index:
    """Postings of the wanted trigrams over a batch of texts."""

    def __init__(self, texts: list[str], wanted: Iterable[bytes]) -> None:
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        self.rows = len(raw)
        joined = np.frombuffer(b"\0\0".join(raw), np.uint8).astype(np.uint32)
        starts = np.cumsum([0] + [len(r) + 2 for r in raw[:-1]]) if raw else np.zeros(1, np.int64)
        codes = np.array(sorted(int.from_bytes(w, "big") for w in wanted), np.uint32)
        self.postings: dict[bytes, np.ndarray] = {}
        if len(joined) < 3 or not len(codes):
            return
        at = (joined[:-2] << np.uint32(16)) | (joined[1:-1] << np.uint32(8)) | joined[2:]
        slots = np.zeros(1 << 18, bool)
        slots[(codes * np.uint32(2654435761)) >> np.uint32(14)] = True
        places = np.flatnonzero(slots[(at * np.uint32(2654435761)) >> np.uint32(14)])
        which = np.searchsorted(codes, at[places])
        which[which == len(codes)] = 0
        real = codes[which] == at[places]
        rows = np.searchsorted(starts, places[real], side="right") - 1
        pairs = np.unique(which[real] * self.rows + rows)
        for i, code in enumerate(codes.tolist()):
            lo, hi = np.searchsorted(pairs, [i * self.rows, (i + 1) * self.rows])
            self.postings[code.to_bytes(3, "big")] = pairs[lo:hi] - i * self.rows

    def candidates(self, query: Query) -> np.ndarray:
        """Rows that satisfy an alternative: its postings intersected, the alternatives united."""
        none = np.zeros(0, np.int64)
        out = none
        for one in query:
            if not one:
                return np.arange(self.rows)
            lists = sorted((self.postings.get(t, none) for t in one), key=len)
            out = np.union1d(out, reduce(np.intersect1d, lists))
        return out


def find_spans(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """For each text its (start, end, rule number), by start, then rule, in code points."""
    queries = [trigram_query(r.pattern) for r in rules]
    present = [t or "" for t in texts]
    index = Index(present, {t for q in queries for one in q for t in one if b"\0" not in t})
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        for row in index.candidates(absorbed(frozenset(t for t in one if b"\0" not in t) for one in query)).tolist():
            found[row] += [(a, b, number) for a, b in rule.spans(present[row])]
    return [sorted(f, key=lambda s: (s[0], s[2])) for f in found]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with `secrets`, an array of (kind, start, end) in code points, end exclusive."""

    def compute(texts: list[str | None]) -> dict[str, Any]:
        return {
            "secrets": [
                [{"kind": rules[n].kind, "start": a, "end": b} for a, b, n in spans] for spans in find_spans(texts, rules)
            ]
        }

    return map_texts(docs, compute, "secrets array<struct<kind:string,start:bigint,end:bigint>>", keep, text)


def redacted(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...] = RULES) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b, n in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, n])
    for a, b, n in merged:
        out += [text[at:a], f"[{rules[n].kind}]"]
        at = b
    return "".join(out) + text[at:]


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`docs` with its own columns; secrets in `text` are replaced by their kind, all else stays."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    own = inner[docs.columns.index(text)]

    def compute(texts: list[str | None]) -> dict[str, Any]:
        spans = find_spans(texts, rules)
        return {"cleared": [redacted(t, s, rules) if s else t for t, s in zip(texts, spans, strict=True)]}

    out = map_texts(docs.toDF(*inner), compute, "cleared string", [c for c in inner if c != own], own)
    return out.select(*["cleared" if c == own else c for c in inner]).toDF(*docs.columns)


def secrets_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans of every document."""

    def compute(texts: list[str | None]) -> dict[str, Any]:
        out: dict[str, list] = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for spans in find_spans(texts):
            base = [s for s in spans if s[2] < len(BASE)]
            for i, rule in enumerate(BASE):
                out[f"n_{rule.kind}"].append(sum(s[2] == i for s in base))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(spans))
        return out

    fields = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_texts(table(spark, sf_dir, "documents"), compute, fields, ["doc_id"])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[n].kind}:{a}:{b}" for a, b, n in spans)
