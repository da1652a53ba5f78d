"""Secret scans: which texts can hold a match is asked of a trigram index, the rest is never searched."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adspindle.llm.text import in_task, slices

FLAGS = re.ASCII


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long a match (or one of its groups) must be to count."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: str = ""  # the part of the pattern whose letters count in either case
    base: bool = False

    def compiled(self) -> re.Pattern:
        pattern = self.pattern
        if self.any_case:
            pattern = pattern.replace(self.any_case, f"(?i:{self.any_case})", 1)
        return re.compile(pattern, FLAGS)


# The contract's fixed values.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        any_case="(password|passwd|secret|token|api_?key)",
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20, base=True),
    Rule("hex", r"[0-9a-f]+", 24, base=True),
)
# A private key's header, and the key: to its END line, or, where there is none, all base64 lines that follow.
_KEY_HEADER = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_KEY_BODY = r"(?:[A-Za-z0-9+/=\\\x20\x09-\x0D]|(?:Proc-Type|DEK-Info):[^\n]*\n)*-----END [A-Z ]*PRIVATE KEY-----"
_KEY_LINES = r"(?:[\x20\x09-\x0D]*[A-Za-z0-9+/=]{16,}(?![^\x20\x09-\x0D]))*"
# What this scan adds to them.
MORE_RULES = (
    Rule("private_key", f"{_KEY_HEADER}(?:{_KEY_BODY}|{_KEY_LINES})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES

# A Boolean query is None (nothing can be said: scan), a trigram, or ("and" | "or", [queries]).
Query = None | bytes | tuple
MOST_STRINGS = 32


def _grams(text: bytes) -> list[bytes]:
    return [text[i : i + 3] for i in range(len(text) - 2)]


def _and(parts: list) -> Query:
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _or(parts: list) -> Query:
    return None if None in parts or not parts else parts[0] if len(parts) == 1 else ("or", parts)


def _strings(texts: set[bytes]) -> Query:
    """One of these texts occurs."""
    return _or([_and(list(_grams(t))) for t in sorted(texts)])


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, of which every match of the regular expression has the stated ones."""
    exact, query = _derive(list(_parser.parse(pattern, FLAGS)))
    return _and([query, _strings(exact)]) if exact else query


def _derive(items: list) -> tuple[set[bytes] | None, Query]:
    """Of a sequence: the texts it can be, if they are few, and what must occur if it's not."""
    run: set[bytes] = {b""}
    whole, found = True, []
    for op, arg in items:
        exact, query = _derive_one(op, arg)
        if exact is not None and len(exact) * len(run) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, exact)}
            continue
        found += [_strings(run), query] if run else [query]
        if exact is not None:
            run = exact
        else:
            run = {b""}
        whole = False
    if whole:
        return run, None
    return None, _and([*found, _strings(run)])


def _derive_one(op, arg) -> tuple[set[bytes] | None, Query]:
    if op is C.LITERAL:
        return {chr(arg).lower().encode()}, None
    if op is C.SUBPATTERN:
        return _derive(list(arg[-1]))
    if op is C.BRANCH:
        parts = [_derive(list(p)) for p in arg[1]]
        if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= MOST_STRINGS:
            return set().union(*[e for e, _ in parts]), None
        return None, _or([_and([q, _strings(e) if e else None]) for e, q in parts])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = arg
        exact, query = _derive(list(inner))
        if (least, most) == (0, 1) and exact is not None:
            return exact | {b""}, None
        if least == 0:
            return None, None
        if exact is not None:
            repeated = {b"".join(t) for t in product(exact, repeat=min(least, 3))} if len(exact) == 1 else exact
            return (repeated, None) if least == most <= 3 and len(exact) == 1 else (None, _strings(repeated))
        return None, query
    if op is C.IN and len(arg) <= 8 and all(o is C.LITERAL for o, _ in arg):
        return {chr(c).lower().encode() for _, c in arg}, None
    if op is C.AT:
        return {b""}, None
    return None, None


def _trigrams(query: Query) -> set[bytes]:
    if query is None:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(_trigrams, query[1]))


_lower = np.arange(256, dtype=np.uint32)
_lower[ord("A") : ord("Z") + 1] += 32


class TrigramIndex:
    """Postings of a segment of texts, kept as rows of bits, for the trigrams that the rules ask for."""

    def __init__(self, wanted: Sequence[bytes], offsets: np.ndarray, data: np.ndarray, slots: np.ndarray):
        self.texts = len(offsets) - 1
        self.slot = {g: i for i, g in enumerate(wanted)}
        self.postings = np.zeros((len(wanted), self.texts), dtype=bool)
        if len(data) >= 3:
            low = _lower[data]
            codes = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
            slot = slots[codes]
            at = np.flatnonzero(slot >= 0)
            owner = np.searchsorted(offsets, at, side="right") - 1
            whole = at + 3 <= offsets[owner + 1]
            self.postings[slot[at[whole]], owner[whole]] = True

    def ask(self, query: Query) -> np.ndarray:
        if query is None:
            return np.ones(self.texts, dtype=bool)
        if isinstance(query, bytes):
            return self.postings[self.slot[query]]
        answers = [self.ask(q) for q in query[1]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(answers)


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        self.wanted = sorted(set().union(*[_trigrams(q) for _, _, q in self.rules]))
        self.slots = np.full(1 << 24, -1, dtype=np.int16)
        for i, g in enumerate(self.wanted):
            self.slots[int.from_bytes(g, "big")] = i

    def spans(self, texts: pa.Array) -> Iterator[list[tuple[int, int, int]]]:
        """Of each text its ``(start, rule number, end)`` in code points, in this order."""
        for first, offsets, data in slices(texts):
            index = TrigramIndex(self.wanted, offsets, data, self.slots)
            n = len(offsets) - 1
            found: list[list] = [[] for _ in range(n)]
            raw = data.tobytes()
            for number, (rule, pattern, query) in enumerate(self.rules):
                for i in np.flatnonzero(index.ask(query)):
                    text = raw[offsets[i] : offsets[i + 1]].decode()
                    for match in pattern.finditer(text):
                        if len(match[rule.group]) >= rule.least:
                            found[i].append((match.start(), number, match.end()))
            yield from (sorted(f) for f in found)


def _text_of(rules: Sequence[Rule], spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{rules[k].kind}:{start}:{end}" for start, k, end in spans)


def _scan(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(rules)
    base = [r.base for r in rules]
    for batch in batches:
        spans = list(scanner.spans(batch.column("__text")))
        counts = [[sum(k == j for _, k, _ in s) for s in spans] for j in range(len(rules)) if base[j]]
        own = [_text_of(rules, [x for x in s if base[x[1]]]) for s in spans]
        made = [pa.array(c, pa.int64()) for c in counts]
        made.append(pa.array([hashlib.sha256(o.encode()).hexdigest() for o in own], pa.string()))
        made.append(pa.array([_text_of(rules, s) for s in spans], pa.string()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), *made],
            names=["key", *[f"n_{r.kind}" for r in rules if r.base], "base_sha256", "spans"],
        )


def scan_secrets(docs: DataFrame, key: str = "doc_id", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``key``, a count per base rule, ``base_sha256`` and ``spans`` of every row of ``docs``.

    Each segment of texts gets an inverted index of its trigrams, restricted to those that the rules
    can ask for. From each rule's regular expression comes a Boolean query over trigrams; its postings
    are intersected and united, and only the texts left are searched with the expression. A rule
    without a mandatory trigram (``hex``) is searched for in all texts. Spans are leftmost and
    non-overlapping within a kind; those of different kinds may overlap.

    A null text is empty and has no spans; texts of any length are scanned whole; equal rows have
    equal results; an empty table gives no rows. Only ``key`` and ``text`` are read.
    """
    rules = tuple(rules)
    kind = docs.schema[key].dataType.simpleString()
    counts = "".join(f"n_{r.kind} bigint, " for r in rules if r.base)
    narrow = docs.selectExpr(f"`{key}` AS key", "text AS __text")
    found = narrow.mapInArrow(in_task(_scan, rules), f"key {kind}, {counts}base_sha256 string, spans string")
    return found.withColumnRenamed("key", key)


MASK = "[secret]"


def _mask(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule], text: str, length: str | None):
    scanner = Scanner(rules)
    for batch in batches:
        at, masked = batch.schema.get_field_index(text), []
        for spans, whole in zip(scanner.spans(batch.column(text)), batch.column(text)):
            whole = whole.as_py()
            if spans:
                pieces, done = [], 0
                for start, _, end in spans:
                    if end > done:
                        pieces += [whole[done:start], MASK] if start >= done else []
                        done = end
                whole = "".join(pieces) + whole[done:]
            masked.append(whole)
        made = batch.set_column(at, batch.schema.field(at), pa.array(masked, batch.schema.field(at).type))
        if length:
            at = batch.schema.get_field_index(length)
            sizes = [None if m is None else len(m) for m in masked]
            made = made.set_column(at, batch.schema.field(at), pa.array(sizes, batch.schema.field(at).type))
        yield made


def mask_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every found span replaced by ``[secret]``, and ``n_chars``, if there, brought up to date.

    Overlapping spans become one. No row is dropped; a null text stays null.
    """
    rules = tuple(rules)
    length = "n_chars" if "n_chars" in docs.columns else None
    return docs.mapInArrow(in_task(_mask, rules, "text", length), docs.schema)
