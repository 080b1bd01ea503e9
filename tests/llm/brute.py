"""Plain Python versions of the operators, and tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string, row string, key string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def awkward(seed=1, passage=60):
    """Documents with copies, near copies, one common passage, ties, nulls, long and odd texts."""
    random.seed(seed)
    vocabulary = [f"w{i}é" if i % 9 == 0 else f"Word{i}" for i in range(1500)]
    common = [random.choice(vocabulary) for _ in range(passage)]
    texts = []
    for _ in range(25):
        texts.append(" ".join(random.choice(vocabulary) for _ in range(random.randrange(20, 200))))
    base = [random.choice(vocabulary) for _ in range(120)]
    for _ in range(40):
        near = list(base)
        for _ in range(random.randrange(6)):
            near[random.randrange(len(near))] = random.choice(vocabulary)
        texts.append("\n".join([" ".join(near[:50]), " ".join(near[50:])]))
    texts += [texts[0]] * 12 + [texts[1].upper(), texts[2].replace(" ", " \t\n ")]
    texts += [" ".join([random.choice(vocabulary) for _ in range(5)] + common + [random.choice(vocabulary)]) for _ in range(20)]
    texts += ["", " ", "\n\t", "a", "A b", "a  b", "a b c d", "a b c d e", "a b c d e", "x" * 5000, "the the the " * 300]
    texts += ["<|endoftext|> it's '' ...\r\n\u00a0\u2003 x\x1cy\x85 z\x00 中文 Ωж ١٢ e\u0301!", "MIT License and the mit licence, apache  license"]
    texts.append(" ".join(random.choice(vocabulary) for _ in range(20_000)))
    ids = list(range(len(texts)))
    random.shuffle(ids)
    rows = [(i * 3, t) for i, t in zip(ids, texts)]
    rows += [(7, None), (8, None), (8, None), (None, None), (None, texts[0]), (None, "a b"), (10**12, texts[1])]
    rows += [rows[0], rows[0], rows[30], (rows[3][0], rows[4][1])]
    random.shuffle(rows)
    return rows


def frame(spark, rows):
    """The documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", "k") for i, t in rows], SCHEMA).repartition(3)


def shingles(text, k=5):
    words = BLANK.findall(lower(text))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def groups(rows):
    """For each row the number of its first linked row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))], sets


def components(rows):
    roots, sets = groups(rows)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return [(i, len(s), least.get(root) if s else i) for (i, _), root, s in zip(rows, roots, sets)]


def without_repeats(rows, window=50):
    """doc_id, n_words, n_removed, kept words' hash."""
    big = 1 << 62
    first = {}
    split = [(i, BLANK.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            first[run] = min(big if i is None else i, first.get(run, big))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < (big if i is None else i):
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def contamination(rows, items, window=10):
    """doc_id, n_words, n_hit, n_items, items' hash, contaminated."""
    runs = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall(lower(text))
        n = min(window, len(words))
        if item is not None:
            for k in range(len(words) - n + 1 if n else 0):
                runs[tuple(words[k : k + n])].add(str(item))
    out = []
    for i, text in rows:
        words, found = PLAIN.findall(lower(text)), set()
        hit = [False] * len(words)
        for n in {len(r) for r in runs}:
            for k in range(len(words) - n + 1):
                if own := runs.get(tuple(words[k : k + n])):
                    hit[k : k + n] = [True] * n
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), sum(hit), len(found), digest, any(hit)))
    return out


def same(found, wanted):
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def statistics(text):
    """A text's transformed statistics, counted byte by byte."""
    data, own = (text or "").encode(), [w.encode() for w in BLANK.findall(text or "")]
    if not own:
        return [0.0] * 15
    kinds = [
        lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57, lambda b: chr(b) in ".,;:'\"-()?!",
        lambda b: 32 < b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?!", lambda b: b > 127, lambda b: b == 10,
    ]
    n, sizes, small = len(own), [len(w) for w in own], [w.lower() for w in own]
    mean = sum(sizes) / n
    spread = math.sqrt(sum((x - mean) ** 2 for x in sizes) / n)
    letterless = sum(not any(chr(b).isalpha() and b < 128 or b > 127 for b in w) for w in own)
    again = sum(a == b for a, b in zip(small, small[1:]))
    return [
        math.log1p(len(data)), math.log1p(n), math.log1p(mean), math.log1p(spread), *(math.sqrt(sum(map(k, data)) / len(data)) for k in kinds),
        math.sqrt(data.count(b"!") / n), math.sqrt(letterless / n), math.sqrt(again / n),
        math.log1p(len(set(small))) / math.log1p(n), math.sqrt(sum(65 <= w[0] <= 90 for w in own) / n),
    ]


def quality_scores(rows, labels, shrinkage, floor):
    """Scores of (doc_id, text) rows by two Gaussian classes, each with its density written out; labels: (doc_id, 0 or 1)."""
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    known = {}
    for i, label in labels:
        if i is not None and label is not None and i not in held:
            known[i] = max(label, known.get(i, 0))
    x = np.array([statistics(t) for _, t in rows])
    which = np.array([known.get(i, -1) for i, _ in rows])
    used = x[which >= 0]
    deviation = used.std(axis=0)
    z = (x - used.mean(axis=0)) / np.where(deviation > 1e-9, deviation, 1)
    logs = []
    for k in (0, 1):
        own = z[which == k]
        covariance = np.cov(own.T, bias=True)
        covariance = (1 - shrinkage) * covariance + shrinkage * np.diag(np.diag(covariance)) + floor * np.eye(len(covariance))
        apart = z - own.mean(axis=0)
        far = (apart * np.linalg.solve(covariance, apart.T).T).sum(axis=1)
        logs.append(math.log(len(own)) - 0.5 * far - 0.5 * np.linalg.slogdet(covariance)[1])
    return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -60, 60)))
