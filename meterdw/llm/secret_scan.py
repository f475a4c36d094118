"""Finds secrets in texts through a trigram index.

From every rule a Boolean query of trigrams is derived that each of its matches must meet. Texts are read in segments;
a segment gets an inverted index (trigram to the texts that hold it) of the trigrams that the queries ask for, the
queries intersect and unite its postings, and the rules run over the remaining texts alone. A rule whose matches need
not hold any trigram runs over all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from meterdw.llm.common import mapped, text_slices, texts, utf8

# strings that a part of a rule may be are listed up to this number; beyond it, only what is known so far is kept
LISTED = 24


@dataclass(frozen=True)
class Rule:
    """A pattern, the least length of what it finds, and the group that is the secret (and the one that is measured)."""

    kind: str
    pattern: str
    least: int
    measured: int = 0
    secret: int = 0
    flags: int = re.ASCII


# fixed values: the base kinds and their limits, in the order in which spans of one start are listed
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, 2,
         re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # whole runs of 16 and more: the runs that [0-9a-f]+ finds, without the short ones
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
# a key of PEM from its BEGIN to its END; without an END, its headers and base64 lines as far as they run. Line ends may
# be escaped (keys in JSON) or blanks, lines quoted or indented
_BREAK = r"""(?:[\x20\t"',>|#*]*(?:[\r\n]|\\[nr])[\s"',>|#*]*(?:\\[nrt][\s"',>|#*]*)*)"""
_LINE, _MARK = r"[A-Za-z0-9+/]", r"(?:[A-Z]+\x20)*PRIVATE\x20KEY-----"
PEM = (
    rf"""-----BEGIN\x20{_MARK}(?:"""
    rf"""(?:[A-Za-z0-9+/=\s\\"',:<>|#*]|-(?!----))*+-----END\x20{_MARK}"""
    rf"""|(?:(?:{_BREAK}|\s+)(?:Proc-Type:\x20?\d,[A-Z]+|DEK-Info:\x20?[A-Z0-9-]+(?:,[0-9A-Fa-f]+)?))*"""
    rf"""(?:(?:{_BREAK}{_LINE}{{16,}}={{0,2}}|\x20+{_LINE}{{40,}}={{0,2}})+"""
    rf"""(?:{_BREAK}{_LINE}+={{0,2}}(?=\s*(?:[\r\n"']|\\[nr]|\Z))|\x20+(?=[A-Za-z]*[0-9+/=]){_LINE}+={{0,2}})?"""
    rf"""|{_BREAK}{_LINE}+={{0,2}}\s*\Z)?)""")
# fixed values: forms of keys that their issuers publish
MORE = (
    Rule("private_key", PEM, 0),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("url_password", r"://[^\s:/@]+:[^\s:/@]+@", 6),
)
RULES = BASE + MORE

# a query is ("all", parts) or ("any", parts) of queries and trigrams; True stands for every text
Query = tuple | str | bool


def _both(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return b if a is True else a
    return a if a == b else ("all", (a, b))


def _either(parts: list[Query]) -> Query:
    return True if any(p is True for p in parts) else parts[0] if len(set(parts)) == 1 else ("any", tuple(dict.fromkeys(parts)))


def _of_string(text: str) -> Query:
    query: Query = True
    for i in range(len(text) - 2):
        query = _both(query, text[i:i + 3])
    return query


def _chars(members: list) -> list[str] | None:
    out: list[str] = []
    for kind, value in members:
        if kind is op.LITERAL:
            out.append(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < LISTED:
            out += map(chr, range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= LISTED else None


def _walk(items) -> tuple[Query, set[str] | None, list[str]]:
    """Query, all strings the items may be (None: too many), and the strings they may end with."""
    query: Query = True
    tails: set[str] = {""}
    whole: set[str] | None = {""}

    def settle(strings: set[str]) -> Query:
        return _either([_of_string(s) for s in sorted(strings)]) if strings else True

    for kind, value in items:
        inner: Query = True
        if kind is op.LITERAL:
            strings: set[str] | None = {chr(value)}
        elif kind is op.IN:
            listed = _chars(value)
            strings = set(listed) if listed and not any(k is op.NEGATE for k, _ in value) else None
        elif kind is op.SUBPATTERN:
            inner, strings, _ = _walk(value[3])
        elif kind is op.BRANCH:
            parts = [_walk(branch) for branch in value[1]]
            strings = set().union(*(p[1] for p in parts)) if all(p[1] is not None for p in parts) else None
            inner = True if strings is not None else _either(
                [_both(p[0], settle(p[1]) if p[1] is not None else True) for p in parts])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, body = value
            inner, strings, _ = _walk(body)
            if low == 0:
                inner = True
                strings = strings | {""} if strings is not None and high == 1 else None
            elif (low, high) != (1, 1):
                query = _both(query, settle({"".join(p) for p in product(tails, strings)})
                              if strings and len(strings) * len(tails) <= LISTED else True)
                strings = None
        elif kind is op.AT:
            strings = {""}
        else:
            strings = None
        query = _both(query, inner)
        joined = {a + b for a, b in product(tails, strings)} if strings is not None and len(strings) * len(
            tails) <= LISTED else None
        if joined is None:
            query = _both(query, settle(tails))
            tails, whole = {""}, None
        else:
            tails = joined
            whole = tails if whole is not None else None
    query = _both(query, settle(tails))
    return query, whole, sorted(tails)


def _lower(query: Query) -> Query:
    if isinstance(query, str):
        return query.lower()
    return query if query is True else (query[0], tuple(dict.fromkeys(_lower(p) for p in query[1])))


def trigram_query(rule: Rule) -> Query:
    """The trigrams (in lower case) that every match of the rule must hold; True if it must hold none."""
    query = _lower(_walk(parser.parse(rule.pattern, rule.flags & ~re.IGNORECASE))[0])
    return True if _any_unusable(query) else query


def _any_unusable(query: Query) -> bool:
    return query is not True and any(not t.isascii() for t in trigrams(query))


def trigrams(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


class Scanner:
    """The rules, their queries, and the index they ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.patterns = [re.compile(r.pattern, r.flags) for r in rules]
        self.queries = [trigram_query(r) for r in rules]
        self.wanted = sorted(set().union(*map(trigrams, self.queries)))
        letters = sorted(set("".join(self.wanted)))
        # bytes by number among the letters that queries use, upper case as lower; all others are 0
        self.number = np.zeros(256, np.int32)
        for i, letter in enumerate(letters, 1):
            self.number[[ord(letter), ord(letter.upper())]] = i
        self.base = len(letters) + 1
        self.slot = np.full(self.base ** 3, -1, np.int32)
        for i, trigram in enumerate(self.wanted):
            a, b, c = self.number[list(trigram.encode())].tolist()
            self.slot[(a * self.base + b) * self.base + c] = i

    def postings(self, array: pa.Array) -> dict[str, np.ndarray]:
        """Per trigram the texts that hold it, ascending."""
        data, offsets = utf8(array)
        if len(data) < 3 or not self.wanted:
            return {}
        number = self.number[data]
        slots = self.slot[(number[:-2] * self.base + number[1:-1]) * self.base + number[2:]]
        where = np.flatnonzero(slots >= 0)
        text = np.searchsorted(offsets, where, "right") - 1
        inside = where + 3 <= offsets[text + 1]
        pairs = np.unique(slots[where[inside]].astype(np.int64) * len(offsets) + text[inside])
        slot, text = np.divmod(pairs, len(offsets))
        cuts = np.searchsorted(slot, np.arange(len(self.wanted) + 1))
        return {t: text[cuts[i]:cuts[i + 1]] for i, t in enumerate(self.wanted)}

    def chosen(self, query: Query, postings: dict[str, np.ndarray], count: int) -> np.ndarray:
        if query is True:
            return np.arange(count)
        if isinstance(query, str):
            return postings.get(query, np.empty(0, np.int64))
        parts = [self.chosen(p, postings, count) for p in query[1]]
        out = parts[0]
        for part in parts[1:]:
            out = np.intersect1d(out, part) if query[0] == "all" else np.union1d(out, part)
        return out

    def spans(self, array: pa.Array, values: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
        """Per text (start, rule, end, start and end of the secret itself), by start and then rule."""
        found: list[list[tuple]] = [[] for _ in values]
        postings = self.postings(array)
        for number, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries)):
            for i in self.chosen(query, postings, len(values)).tolist():
                for match in pattern.finditer(values[i]):
                    if len(match[rule.measured]) >= rule.least:
                        found[i].append((match.start(), number, match.end(), *match.span(rule.secret)))
        return [sorted(spans) for spans in found]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key and spans (kind, start, end, secret) of every row, spans by start and then in the order of the rules.

    Places are code points, ends exclusive. Spans of one rule do not overlap, those of different rules may. Null and
    empty texts have no spans; every row is scanned whole and by itself, also where ids or texts repeat. An empty table
    gives no rows. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("secret", pa.string())]))

    def run(batches):
        scanner = Scanner(rules)
        for batch in text_slices(batches, "text"):
            values = texts(batch, "text")
            rows = [[{"kind": rules[r].kind, "start": a, "end": b, "secret": value[c:d]} for a, r, b, c, d in spans]
                    for value, spans in zip(values, scanner.spans(batch.column("text"), values))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, shape)], ["key", "spans"])

    return mapped(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                  f"key {kind}, spans array<struct<kind:string,start:bigint,end:bigint,secret:string>>"
                  ).withColumnRenamed("key", key)


def _merged(places: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    begin, end = places[0]
    for a, b in places[1:]:
        if a > end:
            yield begin, end
            begin, end = a, b
        end = max(end, b)
    yield begin, end


def redacted(docs: DataFrame, text: str = "text", length: str | None = "n_chars", mark: str = "[REDACTED]",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with every secret replaced by `mark` (overlapping ones by one), and the length column brought up to date.

    The word that a secret is assigned to stays. Texts without secrets, nulls included, are left as they are, and so is
    a length column that does not hold whole numbers.
    """
    names, schema = docs.columns, docs.schema
    if length in names and not isinstance(schema[length].dataType, IntegralType):
        length = None

    def run(batches):
        scanner = Scanner(rules)
        for batch in text_slices(batches, text):
            values = texts(batch, text)
            changed = {}
            for i, spans in enumerate(scanner.spans(batch.column(text), values)):
                if spans:
                    out, at = [], 0
                    for a, b in _merged(sorted((c, d) for *_, c, d in spans)):
                        out += [values[i][at:a], mark]
                        at = b
                    changed[i] = "".join(out) + values[i][at:]
            columns = [batch.column(n) for n in names]
            if changed:
                for n, value in ((text, lambda v: v), (length, len)):
                    if n in names:
                        j = names.index(n)
                        old = columns[j].to_pylist()
                        columns[j] = pa.array([value(changed[i]) if i in changed else v for i, v in enumerate(old)],
                                              columns[j].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return mapped(docs, run, schema)
