"""URL rules as globs, all matched at once by a bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspindle.llm.text import in_task, raw_texts

# The contract's fixed rules, (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# What happens to a url that no rule fits: blocked if one of these globs fits host and path.
BLOCKED_GLOBS = (
    "*spam-*",
    "*.cheap-pills.*",
    "*casino*",
    "*/wp-login.php*",
    "*/phishing/*",
)
# Host and path are joined by a byte that no UTF-8 text holds, so that a host can't be found in a path.
EDGE = b"\xff"
BLOCK_ROWS = 8192


def rule_glob(host: str, path: str) -> bytes:
    """A rule on a host, its subdomains and the paths below one, over ``.host<edge>path``."""
    return b"*." + host.encode() + EDGE + path.encode() + b"*"


def free_glob(glob: str) -> bytes:
    """A glob over host and path; its first slash, if any, is where the path begins."""
    return glob.encode().replace(b"/", EDGE + b"/", 1)


@dataclass(frozen=True)
class Automaton:
    """Shift-And masks of all globs, one bit per literal or ``?``, packed into 64-bit words one after another."""

    step: np.ndarray  # [256, words]: positions that a byte may fill
    stay: np.ndarray  # positions followed by *
    first: np.ndarray  # first positions
    floating: np.ndarray  # first positions of globs that begin with *
    final: np.ndarray  # of each glob, its last position; -1 without any
    only_star: np.ndarray  # globs of stars alone, which fit everything
    globs: int

    @staticmethod
    def of(globs: Sequence[bytes]) -> Automaton:
        places = sum(len(g.replace(b"*", b"")) for g in globs)
        words = max(1, -(-places // 64))
        step = np.zeros((256, words), dtype=np.uint64)
        stay, first, floating = (np.zeros(words, dtype=np.uint64) for _ in range(3))
        final, only_star, at = [], [], 0
        for glob in globs:
            begin = at
            for i, byte in enumerate(glob):
                if byte == ord("*"):
                    continue
                word, bit = at // 64, np.uint64(1 << at % 64)
                step[slice(None) if byte == ord("?") else byte, word] |= bit
                if i + 1 < len(glob) and glob[i + 1] == ord("*"):
                    stay[word] |= bit
                at += 1
            final.append(at - 1 if at > begin else -1)
            only_star.append(at == begin and len(glob) > 0)
            if at > begin:
                first[begin // 64] |= np.uint64(1 << begin % 64)
                if glob[0] == ord("*"):
                    floating[begin // 64] |= np.uint64(1 << begin % 64)
        return Automaton(step, stay, first, floating, np.array(final, int), np.array(only_star, bool), len(globs))

    def fits(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """[texts, globs]: which globs fit each whole text.

        All texts advance together, the longest first, so those that have ended drop off the end;
        each step moves all patterns of all texts by one byte.
        """
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, sizes = offsets[:-1][order], lengths[order]
        words = len(self.stay)
        state = np.zeros((len(order), words), dtype=np.uint64)
        running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right") if len(sizes) else []
        for t, n in enumerate(running):
            byte = data[starts[:n] + t]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            # What is shifted out of one glob must not begin the next.
            moved = (moved & ~self.first) | (self.first if t == 0 else self.floating)
            state[:n] = (moved & self.step[byte]) | (now & self.stay)
        found = np.zeros((len(order), self.globs), dtype=bool)
        for g, last in enumerate(self.final):
            if last >= 0:
                hit = (state[:, last // 64] >> np.uint64(last % 64)) & np.uint64(1)
                found[order, g] = hit.astype(bool)
            else:
                found[:, g] = True if self.only_star[g] else lengths == 0
        return found


def _judge(batches: Iterator[pa.RecordBatch], rules, globs) -> Iterator[pa.RecordBatch]:
    compiled = Automaton.of([rule_glob(h, p) for _, h, p in rules] + [free_glob(g) for g in globs])
    # The longest rule wins; of two as long, the one with the longer host, then the earlier one.
    ranked = sorted(range(len(rules)), key=lambda r: (-len(rules[r][1] + rules[r][2]), -len(rules[r][1]), r))
    names = [h + p for _, h, p in rules] + [None]
    verdicts = [v for v, _, _ in rules] + [None]
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            fits = compiled.fits(*raw_texts(batch.column("__key").cast(pa.binary())))
            chosen = np.full(batch.num_rows, len(rules))
            for r in reversed(ranked):
                chosen[fits[:, r]] = r
            bad = fits[:, len(rules) :]
            glob = [globs[int(b.argmax())] if b.any() else None for b in bad]
            verdict = [verdicts[r] or ("block" if g else "allow") for r, g in zip(chosen, glob)]
            kept = [batch.column(n) for n in batch.schema.names if n != "__key"]
            made = [
                pa.array([names[r] for r in chosen], pa.string()),
                pa.array(verdict, pa.string()),
                pa.array([g if names[r] is None else None for r, g in zip(chosen, glob)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(kept + made, names=["key", "host", "path", "rule", "verdict", "glob"])


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    rules: Sequence[tuple[str, str, str]] = RULES,
    globs: Sequence[str] = BLOCKED_GLOBS,
) -> DataFrame:
    """``key, host, path, rule, verdict, glob`` of every row of ``pages``.

    ``rules`` (verdict, host, path) fit a host and its subdomains where the path begins with theirs;
    the longest wins. A url without a fitting rule is blocked if one of ``globs`` (``*`` any text,
    ``?`` any byte, over the whole host and path) fits it; the first that does is in ``glob``. Hosts
    are compared in lower case, rules are given so.

    A null url, or one without ``://``, has an empty host and path, which no rule fits. Urls of any
    length are matched whole; equal rows are judged alike; an empty table gives no rows. Of ``pages``
    only ``key`` and ``url`` are read.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.char_length(url))).otherwise("")
    split = pages.select(F.col(key).alias("key"), rest.alias("__rest")).select(
        "key",
        F.translate(
            F.regexp_extract("__rest", r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        ).alias("host"),
        F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    edge = F.lit(bytearray(EDGE))
    dotted = F.concat(F.lit(bytearray(b".")), F.col("host").cast("binary"), edge, F.col("path").cast("binary"))
    keyed = split.withColumn("__key", dotted)
    kind = pages.schema[key].dataType.simpleString()
    schema = f"key {kind}, host string, path string, rule string, verdict string, glob string"
    rules, globs = tuple(rules), tuple(globs)
    judged = keyed.mapInArrow(in_task(_judge, rules, globs), schema)
    return judged.withColumnRenamed("key", key)
