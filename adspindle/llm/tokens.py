"""Token counts and token ids of whole texts by public vocabularies."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adspindle.llm.text import compact, in_task, names_of, raw_texts

# Spark runs as many tasks as there are cores; a task's library needs no threads of its own.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

# Known chunks are kept up to this many; then the table starts anew, so a task's memory is bounded.
CACHE = 600_000
# A single space before a character that is certainly no white space begins a new pre-token in every
# byte-level vocabulary, whatever stands before it. Texts are cut there, so equal chunks are met again.
_ODD = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_CUT = re.compile(r" (?=[^\s\x1c-\x1f\x85])")
# Texts in which some space stands before white space or at the end; most have none.
_HARD = rf" (?:[{_ODD}]|$)"
LONGEST = 64  # longer chunks are not remembered
BATCH_BYTES = 2 * 1024 * 1024
LIMIT = 512


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def single_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that, as a pre-token, encode as themselves alone.

    Proved offline: a string counts if the merges, run on it, end in that one token. Some don't,
    because an earlier merge takes their parts elsewhere.
    """
    model = tokenizer(path).model
    return frozenset(s for s in tokenizer(path).get_vocab(False) if _merged(model, s) == 1)


def _merged(model, pre_token: str) -> int:
    """Tokens left when the vocabulary's merges have been applied to a pre-token."""
    return len(model.tokenize(pre_token))


def special_pattern(path: str) -> re.Pattern | None:
    """The strings that the tokenizer takes for special tokens wherever they stand in a text."""
    names = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True)))) if names else None


def _numbered(pieces: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct strings and, for each entry, which of them it is."""
    coded = pieces.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Counter:
    """Counts tokens chunk by chunk: pre-tokens that are tokens by themselves count one, the rest are merged."""

    def __init__(self, path: str):
        known = tokenizer(path)
        self.model, self.pre = known.model, known.pre_tokenizer
        self.single = single_tokens(path)
        self.special = special_pattern(path)
        self.hard = _HARD + ("|" + self.special.pattern if self.special else "")
        self.chunks: dict[str, int] = {}
        self.rest: dict[str, int] = {}

    def _of_chunk(self, chunk: str) -> int:
        count = self.chunks.get(chunk)
        if count is not None:
            return count
        total = 0
        for pre_token, _ in self.pre.pre_tokenize_str(chunk):
            if pre_token in self.single:
                total += 1
            else:
                count = self.rest.get(pre_token)
                if count is None:
                    if len(self.rest) > CACHE:
                        self.rest.clear()
                    count = self.rest[pre_token] = _merged(self.model, pre_token)
                total += count
        if len(chunk) <= LONGEST:
            if len(self.chunks) > CACHE:
                self.chunks.clear()
            self.chunks[chunk] = total
        return total

    def _plain(self, text: str) -> int:
        first, *rest = _CUT.split(text)
        # The cut takes the space away; a text's first chunk has none.
        return self._of_chunk(first) + sum(self._of_chunk(" " + piece) for piece in rest)

    def count_one(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return sum(map(self._plain, parts)) + len(parts) - 1

    def count(self, texts: pa.Array) -> np.ndarray:
        """Token counts; each distinct chunk of the texts is looked at once."""
        texts = compact(texts)
        hard = pc.match_substring_regex(texts, self.hard).to_numpy(zero_copy_only=False)
        totals = np.zeros(len(texts), dtype=np.int64)
        for i in np.flatnonzero(hard):
            totals[i] = self.count_one(texts[int(i)].as_py())
        # In the others every single space begins a chunk.
        easy = np.flatnonzero(~hard)
        pieces = pc.split_pattern(texts.take(pa.array(easy)), " ")
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        names, which = _numbered(pieces.flatten())
        later = np.ones(len(which), dtype=bool)
        later[ends - sizes] = False
        used = np.bincount(which[later], minlength=len(names)) > 0
        counts = np.array([self._of_chunk(" " + n) if u else 0 for n, u in zip(names, used)], dtype=np.int64)
        own = np.where(later, counts[which], 0) if len(names) else np.zeros(0, dtype=np.int64)
        sums = np.concatenate([[0], np.cumsum(own)])
        first = np.array([self._of_chunk(names[k]) for k in which[ends - sizes]], dtype=np.int64)
        totals[easy] = sums[ends] - sums[ends - sizes] + first
        return totals


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """Kept by a worker process from task to task, with the chunks that it has seen."""
    return Counter(path)


def parts(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """The texts in parts of about ``most`` bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        begun = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, begun + most, side="right")))
        yield texts.slice(first, last - first)
        first = last


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [counter(path).count(part) for part in parts(batch.column("__text"))]
        made = pa.array(np.concatenate(counts) if counts else [], pa.int64())
        kept = [batch.column("key"), batch.column("n_bytes")]
        yield pa.RecordBatch.from_arrays([*kept, made], names=["key", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row by the byte-level vocabulary file at ``path``.

    Counts are those of the tokenizers library without added special tokens; special strings that
    stand in a text count one each, as the library takes them by default. A null text is empty (0
    bytes, 0 tokens); texts of any length are counted whole; equal rows have equal counts; an empty
    table gives no rows. Only ``key`` and ``text`` are read.
    """
    kind = docs.schema[key].dataType.simpleString()
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    narrow = docs.select(F.col(key).alias("key"), size.alias("n_bytes"), F.col("text").alias("__text"))
    counted = narrow.mapInArrow(in_task(_count, path), f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("key", key)


class WordEncoder:
    """Ids of whole texts by a vocabulary that works on white-space separated words one by one.

    Its normalizer turns runs of white space into one space, which its pre-tokenizer then removes, so
    a text's ids are those of its words in a row, and a word met before need not be encoded again. It
    lowers case, and a letter never shares a pre-token with the mark after it, so ``Thing`` and
    ``thing.`` are the word ``thing``, with and without a point. Special strings may span words and are
    cut out first.
    """

    def __init__(self, path: str):
        self.known = tokenizer(path)
        self.special = special_pattern(path)
        suffix = self.known.model.end_of_word_suffix
        names = self.known.get_vocab(True)
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for n, i in names.items() if n.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        # Known words by their first number, sorted; the second number; where in the lists below they are.
        self.first, self.second = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.place = np.zeros(0, dtype=np.int32)
        self.sizes, self.ids = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint32)

    def _encoded(self, words: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Sizes and ids of words that are not known yet, and the order in which they come."""
        # Words of letters alone are one pre-token each, whose last id says that it ends there; so many
        # are encoded as one text and told apart afterwards.
        plain = [i for i, w in enumerate(words) if _PLAIN.fullmatch(w)] if self.ends.any() else []
        rows = [" ".join(words[i] for i in plain[at : at + 500]) for at in range(0, len(plain), 500)]
        ids = [
            np.array(e.ids, dtype=np.uint32)
            for at in range(0, len(rows), 20)
            for e in self.known.encode_batch_fast(rows[at : at + 20], add_special_tokens=False)
        ]
        ids = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
        sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(sizes) != len(plain):
            plain, ids, sizes = [], ids[:0], sizes[:0]
        alone = set(plain)
        others = [i for i in range(len(words)) if i not in alone]
        found = [e.ids for e in self.known.encode_batch_fast([words[i] for i in others], add_special_tokens=False)]
        more = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        more_ids = np.fromiter(chain.from_iterable(found), dtype=np.uint32)
        return plain + others, np.concatenate([sizes, more]), np.concatenate([ids, more_ids])

    def _places(self, names: pa.Array) -> np.ndarray:
        """Where each distinct word's size and ids are; new words are encoded and remembered."""
        first, second = names_of(*raw_texts(names))
        at = np.searchsorted(self.first, first)
        there = np.minimum(at, max(len(self.first) - 1, 0))
        known = np.zeros(len(first), dtype=bool)
        if len(self.first):
            known = (self.first[there] == first) & (self.second[there] == second)
        places = np.zeros(len(first), dtype=np.int64)
        places[known] = self.place[there[known]]
        new = np.flatnonzero(~known)
        if len(new):
            order, sizes, ids = self._encoded(names.take(pa.array(new)).to_pylist())
            places[new[order]] = len(self.sizes) + np.arange(len(new))
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            new = new[np.argsort(first[new], kind="stable")]
            for name, values in (("second", second), ("place", places.astype(np.int32)), ("first", first)):
                setattr(self, name, np.insert(getattr(self, name), at[new], values[new]))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row as unsigned 32-bit numbers, and where each text's begin; one entry more than texts."""
        texts = compact(texts)
        if len(self.first) > CACHE:
            self._forget()
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _BEFORE_MARK, r"\1 \2")
        split = pc.ascii_split_whitespace(spaced)
        if self.special is not None:
            special = pc.match_substring_regex(texts, self.special.pattern, ignore_case=True).to_numpy(zero_copy_only=False)
            if special.any():
                split = pa.array(
                    [self._words(t) if s else w for t, s, w in zip(texts.to_pylist(), special, split.to_pylist())],
                    pa.list_(pa.large_string()),
                )
        words = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        coded = split.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        numbers = self._places(coded.dictionary)[which] if len(which) else which
        begins = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        own = self.sizes[numbers].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(own)]).astype(np.int64)
        at = np.repeat(begins[numbers] - ends[:-1], own) + np.arange(ends[-1])
        return self.ids[at], ends[np.concatenate([[0], words]).astype(np.int64)]

    def _words(self, text: str) -> list[str]:
        words, done = [], 0
        for match in self.special.finditer(text):
            words += [*_SPACE.split(text[done : match.start()]), match[0]]
            done = match.end()
        return words + _SPACE.split(text[done:])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """Kept by a worker process from task to task, with the words that it has seen."""
    return WordEncoder(path)


_SPACE = re.compile(r"[ \t-\r]+")
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
# A letter and an ASCII mark after it, other than the apostrophe of a contraction.
_BEFORE_MARK = r"([a-z])([!-&(-/:-@\[-`{-~])"
