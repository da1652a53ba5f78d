"""Plain versions of the operators, for small inputs."""

import collections
import re

import duckdb

from adspindle.llm.queries import ORACLES

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(WORD, text or "")


def shingles(text, size):
    w = words(lower(text))
    runs = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    return runs or ({tuple(w)} if w else set())


def components(rows, size=3, percent=90):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    groups = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            groups[top(i)].append(doc_id)
    return [(rows[i][0], len(sets[i]), min(groups[top(i)], default=None)) for i in range(len(rows))]


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    windows = collections.defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def same_as_oracle(found, name, sf_dir):
    """Whether a query's rows are those of its SQL."""
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, answer.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in found.collect())


def runs(w):
    """All runs of a list of words, (start, length, period), straight from the definition."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        start = 0
        while start + q < len(w):
            end = start + q
            while end < len(w) and w[end] == w[end - q]:
                end += 1
            if end - start >= max(6, 4 * q):
                found.setdefault((start, end - start), q)
            start = max(end - q, start) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def best_segments(scores):
    """The segments with the greatest sum, each between those found before; only those above zero."""
    best, at = 0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            if sum(scores[a:b]) > best + 1e-12:
                best, at = sum(scores[a:b]), (a, b)
    if at is None:
        return []
    a, b = at
    right = [(x + b, y + b, s) for x, y, s in best_segments(scores[b:])]
    return [*best_segments(scores[:a]), (a, b, best), *right]


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) and all final entries of rows (vec_id, vector, label)."""
    import math

    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = []
    for _, v, _ in kept:
        whole = [math.floor(4096 * x) for x in v]
        size = len(whole) // parts
        cut.append([whole[p * size : (p + 1) * size] for p in range(parts)])
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def away(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(p, v):
        return min(range(len(books[p])), key=lambda e: (away(books[p][e], v), e))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for c in cut:
                groups[nearest(p, c[p])].append(c[p])
            for e, own in groups.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    coded = []
    for c in cut:
        near = [nearest(p, c[p]) for p in range(parts)]
        coded.append(("".join(f"{e:02x}" for e in near), sum(away(books[p][e], c[p]) for p, e in enumerate(near))))
    labels = collections.Counter()
    for (_, _, label), (_, error) in zip(kept, coded):
        labels[label] += error
    return [(r[0], code, error, labels[r[2]]) for r, (code, error) in zip(kept, coded)], books
