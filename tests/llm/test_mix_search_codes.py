"""Mixing, ranked search and vector codes against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from shopmill.llm import mixing, ranked_search, vector_codes  # noqa: E402
from shopmill.llm.ordered import running  # noqa: E402

ROWS = brute.awkward(3)


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), i, rng.randrange(9)) for i in range(500)]
    table = spark.createDataFrame(rows, "a long, b long, n long").repartition(7)
    found = running(table, [F.col("a"), F.col("b")], before=F.col("n"), number=F.lit(1)).collect()
    total, wanted = 0, []
    for number, row in enumerate(sorted(rows)):
        wanted.append((*row, total, number))
        total += row[2]
    assert sorted(map(tuple, found)) == wanted
    assert running(table.limit(0), [F.col("a")], before=F.col("n")).count() == 0


def targets(sizes):
    """By sharing what is over again, until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, rest = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        share = {s: rest * weights[s] / sum(weights[t] for t in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] or not sizes[s]]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = 2 * sizes[s]
            rest -= full[s]


def mixed_rows():
    rng, sources = random.Random(2), ["a", "B", "é", "z", "", None, "\U0001f600", "none"]
    rows = [(i, t, "x" if t is None else rng.choice(sources[:1] * 6 + sources[:7])) for i, t in ROWS]
    return rows + [(10**6 + i, None, "none") for i in range(3)]


@pytest.mark.parametrize("block", [1024, 37])
def test_mixing(spark, block):
    rows = mixed_rows()
    table = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, size int, taken int")
    mix = mixing.mix(table.repartition(5), block)
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.BLANK.findall(t or ""))
    wanted = targets(size)
    found = mixing.taken(mix).collect()
    assert [(r.doc_id, r.size) for r in sorted(found, key=repr)] and len(found) == len(rows)
    own = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
    for r in mix.sources.collect():
        assert r.source_size == size[r.source] and r.target == pytest.approx(wanted[r.source]) and r.take == math.floor(r.target)
    # Every slot takes one run of its source's stream, whole but at its end; each word is taken once or twice.
    source = {r.number: r.source for r in mix.documents.collect()}
    slots, words = defaultdict(list), Counter()
    for r in mix.pieces.collect():
        slots[r.slot].append((r.at, r.end - r.begin, source[r.number]))
        own[source[r.number]] += r.end - r.begin
        words.update((r.number, w) for w in range(r.begin, r.end))
    assert set(words.values()) <= {1, 2}
    assert dict(own) == {s: math.floor(t) for s, t in wanted.items() if t >= 1}
    assert sorted(slots) == list(range(len(slots)))
    order = []
    for slot in range(len(slots)):
        at = 0
        for begin, n, s in sorted(slots[slot]):
            assert begin == at
            at += n
        assert at <= block and len({s for *_, s in slots[slot]}) == 1
        order.append(slots[slot][0][2])
    # Low discrepancy: in each prefix each source has nearly its share.
    needed, seen = Counter(order), Counter()
    for i, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[t] - needed[t] * i / len(order)) <= 5 for t in needed)
    assert sorted(map(tuple, mixing.taken(mixing.mix(table, block)).collect()), key=repr) == sorted(map(tuple, found), key=repr)


def test_points_are_evenly_spread():
    assert mixing.STEP % 2 and abs(mixing.STEP / mixing.POINTS * (1 + 5**0.5) / 2 - 1) < 1e-12


def test_empty_mix(spark):
    empty = spark.createDataFrame([], brute.SCHEMA)
    assert mixing.taken(mixing.mix(empty)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    brute.same(mixing.taken(mixing.mix(blank)).collect(), [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])


TERM = brute.PLAIN


def ranked(rows, items, k=20):
    texts = [(i, Counter(TERM.findall(brute.lower(t)))) for i, t in rows]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    docs, words = len(texts), sum(n for *_, n in texts)
    held = Counter(t for _, c, _ in texts for t in c)
    wanted = defaultdict(Counter)
    for item, text in {(i, t) for i, t in items if i is not None and t}:
        wanted[item] += Counter(TERM.findall(brute.lower(text)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c, n in texts:
            m, score = 100 - 25 + (25 * n * docs) // words, 0
            for t, often in terms.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * docs + 2) / (2 * held[t] + 1)))
                    score += often * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score:
                scored.append((-score, i is None, i, score))
        out += [(item, r, i, s) for r, (*_, i, s) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def asked():
    rng = random.Random(5)
    words = sorted({w for _, t in ROWS[:40] for w in TERM.findall(brute.lower(t))})
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(30)]
    items += [(100, ROWS[0][1]), (101, "the THE the"), (102, None), (103, ""), (104, "nosuchword"), (None, "a b"), (105, "a"), items[0], (1, "a b c d")]
    return items + [(106, next(t for _, t in ROWS if t and len(t.split()) > 1000))]


@pytest.mark.parametrize("shard, short, part, section", [(4 << 20, 1024, 8 << 20, 1 << 20), (3000, 0, 600, 50), (3000, 10**9, 8 << 20, 7), (20_000, 40, 3000, 999)])
def test_ranked_search(spark, monkeypatch, shard, short, part, section):
    for name, value in (("SHARD", shard), ("SHORT", short), ("PART", part), ("SECTION", section), ("RANGE", 4)):
        monkeypatch.setattr(ranked_search, name, value)
    items, rows = asked(), ROWS + [(-i, "the a") for i in range(40)] + [(None, "the a")] * 3
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id long, score long")
    found = ranked_search.search(brute.frame(spark, rows), table)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    brute.same(found.collect(), ranked(rows, items))


def test_ranked_search_of_nothing(spark):
    empty, none = spark.createDataFrame([], brute.SCHEMA), spark.createDataFrame([], "item_id string, text string")
    items = spark.createDataFrame([("i", "a b")], "item_id string, text string")
    docs = brute.frame(spark, ROWS)
    assert ranked_search.search(empty, items).count() == 0 and ranked_search.search(docs, none).count() == 0
    assert ranked_search.search(docs, items).schema["item_id"].dataType.simpleString() == "string"


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for width, most in ((8, 1 << 14), (8, 1 << 29), (1, 1 << 30), (100, 1 << 27), (3, 0)):
        left, right = rng.integers(-most, most + 1, (2, 9, width)), rng.integers(-most, most + 1, (2, width, 5))
        left[0, 0], right[0, :, 0] = -most, most
        wanted = np.matmul(left.astype(object), right.astype(object)) if width else 0
        assert (vector_codes.products(left, right) == wanted).all()


def codes(rows, rounds=6):
    kept = [(i, label, [math.floor(4096 * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in {len(v) for *_, v in kept}:
        own = [(i, label, v) for i, label, v in kept if len(v) == dim]
        p = -(-dim // 8)
        cut = [[(v + [0] * 8 * p)[j * p : j * p + p] for j in range(8)] for *_, v in own]
        least = {}
        for (i, _, v), parts in zip(own, cut):
            key, raw = (i is None, i or 0), np.array(v, "<i4").tobytes()
            if key not in least or raw < least[key][0]:
                least[key] = (raw, parts)
        books = [[least[key][1][j] for key in sorted(least)[:16]] for j in range(8)]

        def near(part, book):
            return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

        for _ in range(rounds):
            for j in range(8):
                held = defaultdict(list)
                for parts in cut:
                    held[near(parts[j], books[j])[1]].append(parts[j])
                books[j] = [[sum(c) // len(held[n]) for c in zip(*held[n])] if held[n] else e for n, e in enumerate(books[j])]
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for (i, label, _), parts in zip(own, cut):
            best = [near(part, book) for part, book in zip(parts, books)]
            out.append((i, dim, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best), digest, label))
    return out


def test_vector_codes(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 16))
    points = centres[rng.integers(0, 9, 300)] + 0.2 * rng.normal(size=(300, 16))
    points[100:200] = points[100]
    rows = [(int(i), [float(x) for x in p.astype(np.float32)], [None, 1, 2][i % 3]) for i, p in enumerate(points)]
    rows += [(3, rows[8][1], 1), rows[5], rows[5], (None, rows[9][1], 2), (7, None, 1), (8, [float("nan")] * 16, 1), (9, [None] + [1.0] * 15, 1), (10, [float("inf")] * 16, 1)]
    rows += [(20 + i, [0.5 * i, -3.0, 1e4 * i], None) for i in range(5)] + [(40, [], 1), (41, [0.0] * 16, 1), (42, [131071.0, -131071.0] + [0.0] * 14, 1)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, code string, error string").repartition(3)
    found, _ = vector_codes.compress(table, carry=("label",))
    brute.same(found.select("vec_id", "dim", "code", "error", "codebooks_sha256", "label").collect(), codes(rows))


def test_vector_codes_of_nothing_and_of_huge_components(spark, path):
    kind = "vec_id long, embedding array<double>, label int"
    assert vector_codes.compress(spark.createDataFrame([], kind))[0].count() == 0
    rows = [(i, [10.0 ** (40 * i % 300)] * 8, None) for i in range(20)] + [(99, [-1e308] * 8, None)]
    spark.createDataFrame(rows, kind).write.parquet(f"{path}/embeddings.parquet")
    found = vector_codes.op13_vector_codes(spark, path).collect()
    assert len(found) == 21 and all(0 <= r.error <= r.label_error < 1 << 63 for r in found)
