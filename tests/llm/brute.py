"""What the operators must find, by plain means."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from larderlens.llm import line_dedup, queries

WHITE = str.maketrans("", "", " \t\n\x0b\x0c\r")


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


def shingled(text):
    words = (text or "").encode().split()
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_classes(rows):
    held = {k: shingled(t) for k, t in rows.items()}
    where = defaultdict(list)
    for k, own in held.items():
        for x in own:
            where[x].append(k)
    union = Union()
    for a, b in {p for own in where.values() for p in combinations(sorted(own), 2)}:
        both = sum((held[a] & held[b]).values())
        if both >= 0.8 * (held[a].total() + held[b].total() - both):
            union.join(a, b)
    same = {}
    for k in sorted(rows):
        union.join(k, same.setdefault(rows[k] or "", k))
    return {k: union.find(k) for k in rows}


def normal_line(line):
    line = "".join("0" if c in "0123456789" else c if ord(c) > 127 or c.isalnum() else " " for c in line.lower())
    return " ".join(p for p in re.split("[\x00-\x20]+", line) if p)


def line_places(rows):
    where = defaultdict(list)
    for k, text in rows.items():
        for n, line in enumerate((text or "").split("\n")):
            if normal_line(line):
                where[normal_line(line)].append((k, n))
    return where


def later_lines(rows, groups):
    gone = defaultdict(list)
    for places in groups:
        for k, n in sorted(places)[1:]:
            gone[k].append(n)
    return {k: sorted(gone[k]) for k in rows}


def brute_lines(rows, compared=None):
    """Dropped lines by comparing all pairs, or those that `compared` names. Pairs that cannot be near are told by their shared
    three-grams first: an edit takes three at most."""
    where = line_places(rows)
    lines = sorted(where, key=len)
    sizes = np.array([len(x) for x in lines])
    grams = np.zeros((len(lines), 2048), dtype=np.uint8)
    for i, x in enumerate(lines):
        for gram, n in Counter(x[j : j + 3] for j in range(len(x) - 2)).items():
            at = zlib.crc32(gram.encode()) % 2048
            grams[i, at] = min(255, int(grams[i, at]) + n)
    union = Union()
    for i, x in enumerate(lines):
        end = int(np.searchsorted(sizes, sizes[i] / 0.8 + 1e-9, side="right"))
        shared = np.minimum(grams[i + 1 : end], grams[i]).sum(axis=1, dtype=np.int64)
        clipped = (grams[i] == 255).any()
        wanted = sizes[i + 1 : end] - 2 - 3 * np.floor(sizes[i + 1 : end] * 0.2 + 1e-9)
        for j in (np.flatnonzero((shared >= wanted) | clipped) + i + 1).tolist():
            if compared and not compared(x, lines[j]) or union.find(i) == union.find(j):
                continue
            if line_dedup.edit_distance(x, lines[j]) <= 0.2 * len(lines[j]) + 1e-9:
                union.join(i, j)
    held = defaultdict(list)
    for i, x in enumerate(lines):
        held[union.find(i)] += where[x]
    return later_lines(rows, held.values())


def digest(words):
    return hashlib.sha256(b" ".join(words)).hexdigest()


def brute_substrings(rows):
    first, out = {}, {}
    for k in sorted(rows):
        words = (rows[k] or "").encode().split()
        windows = [b" ".join(words[i : i + 50]) for i in range(len(words) - 49)]
        gone = [False] * len(words)
        for i, w in enumerate(windows):
            if first.get(w, k) < k:
                gone[i : i + 50] = [True] * 50
        for w in windows:
            first.setdefault(w, k)
        left = [w for w, g in zip(words, gone, strict=True) if not g]
        out[k] = (len(words), sum(gone), left)
    return out


def brute_pipeline(rows):
    """Pieces (doc_id, piece, length, checksum of the ids) after the five stages."""
    from tokenizers import Tokenizer

    words = Tokenizer.from_file(queries.vocabulary_path("word_bpe_49k.json"))
    rows = {k: t for k, t in rows.items() if any(c.isalpha() for c in t or "")}
    same = defaultdict(list)
    for k, t in rows.items():
        same[t.translate(WHITE)].append((-len(t), k))
    rows = {k: rows[k] for _, k in map(min, same.values())}
    rows = {k: rows[k] for k, top in brute_classes(rows).items() if k == top}
    out = Counter()
    for k, (_, _, left) in brute_substrings(rows).items():
        ids = [*words.encode(b" ".join(left).decode(), add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4")
            out[k, piece, len(part), zlib.crc32(part.tobytes())] += 1
    return out
