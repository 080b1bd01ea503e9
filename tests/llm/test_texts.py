"""Duplicates, repeats, contamination, licenses and quality against brute force."""

from __future__ import annotations

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from shopmill.llm import decontaminate, graph, licenses, quality, repeats, shingle_join, store, words  # noqa: E402
from shopmill.llm.occurrence import Search  # noqa: E402

ROWS = brute.awkward()


@pytest.fixture(scope="module")
def docs(spark):
    return brute.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def test_words_and_windows_hash_alike():
    texts = ["a b A\tb\x0bc", " ", "", None, "é\x0c é É", "ab", "a b"]
    found = words.Texts(pa.array(texts), lower=True)
    seen = {}
    for i, text in enumerate(texts):
        own = brute.BLANK.findall(brute.lower(text))
        hashes = found.hashes[found.first[i] : found.first[i + 1]]
        assert len(own) == len(hashes)
        assert all(seen.setdefault(w, h) == h for w, h in zip(own, hashes))
    assert len(set(seen.values())) == len(seen)
    values = np.random.default_rng(1).integers(0, 3, 400).astype(np.uint64)
    for k in (1, 2, 5, 7, 50):
        runs = {}
        for i, h in enumerate(words.windows(values, k)):
            assert runs.setdefault(tuple(values[i : i + k]), h) == h
        assert len(set(runs.values())) == len(runs)


@pytest.mark.parametrize("block, common, bucket, partitions", [(1 << 20, 32, 8 << 20, 9), (6000, 1, 20_000, 3), (3000, 0, 5000, 400)])
def test_shingle_join(docs, monkeypatch, block, common, bucket, partitions):
    monkeypatch.setattr(shingle_join, "BUCKET", bucket)
    monkeypatch.setattr(store, "PARTITIONS", partitions)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "COMMON", common)
    found = shingle_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
    brute.same(found.collect(), brute.components(ROWS))


@pytest.mark.parametrize("piece", [2 << 20, 700])
def test_a_hot_shingle_is_one_entry_per_slice(spark, monkeypatch, piece):
    """One passage in most documents, among copies, near copies, and rows that share or lack an id."""
    monkeypatch.setattr(shingle_join, "SLICE", piece)
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(i * 7 % 61, f"{base} own{i} tail{i}" if i % 3 else f"x{i} y{i} one two three four five z{i}") for i in range(60)]
    rows += [(None, base), (70, base), (70, base), (71, f"{base} {base}"), (72, "one two three four five"), (73, "one"), (74, ""), (75, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sent = docs.selectExpr("doc_id", "xxhash64(doc_id, text) AS key", "cast(text AS binary) AS text")
    sent = sent.mapInArrow(shingle_join._sender(5, 3), shingle_join.SENT).where("sets IS NULL").collect()
    own = [(r.slice, h) for r in sent for c in (r.hashes, r.many) for h in np.frombuffer(c, np.uint64).tolist()]
    assert len(own) == len(set(own)) and sum(len(r.many) for r in sent)
    found = shingle_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
    brute.same(found.collect(), brute.components(rows))


def test_totals_of_hashes_order_them_alike(spark, monkeypatch):
    """Each document's shared hashes come rarest first by their number of documents, whichever slice holds it."""
    monkeypatch.setattr(shingle_join, "SLICE", 300)
    rows = [(i, " ".join([*"abcdefg"[: 1 + i % 7], *"hijklmnopqr"])) for i in range(40)]
    sets = shingle_join._sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 5, 75).collect()
    places = {}
    for row in sets:
        hashes = np.frombuffer(row.shared, np.int64).tolist()
        assert len(hashes) == len(set(hashes)) == row.n_shingles
        places[row.doc_id] = hashes
    number = {h: sum(h in own for own in places.values()) for own in places.values() for h in own}
    assert all(own == sorted(own, key=lambda h: (number[h], h)) for own in places.values())


def test_one_of_each_group_stays(docs):
    kept = shingle_join.keep_one(docs)
    assert kept.columns == docs.columns
    roots, sets = brute.groups(ROWS)
    wanted = []
    for root in set(roots):
        own = [r for r, g in zip(ROWS, roots) if g == root]
        if not sets[root]:
            wanted += [i for i, _ in own]
        else:
            wanted.append(min((i for i, _ in own if i is not None), default=None))
    brute.same(kept.select("doc_id").collect(), [(i,) for i in wanted])


def test_search_equals_all_pairs():
    rng = random.Random(4)
    for _ in range(30):
        base = [rng.randrange(400) for _ in range(30)]
        sets = [set(rng.sample(base, rng.randrange(18, 28))) | {rng.randrange(400) for _ in range(rng.randrange(6))} for _ in range(40)]
        arrays = [np.array(sorted(s), np.int64) for s in sets]
        found = Search(np.array([len(s) for s in sets]), arrays, np.arange(40)).run()
        label = list(range(40))
        for a in range(40):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label = [label[b] if x == label[a] else x for x in label]
        pairs = set(zip(found.tolist(), label))
        assert len(pairs) == len(set(label)) == len(set(found.tolist()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    by = {}
    for row in found:
        by.setdefault(row.root, set()).add(row.id)
    assert sorted(map(len, by.values())) == [1, 30, 61]
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bucket, partitions", [(8 << 20, 9), (20_000, 3), (5000, 400)])
def test_repeats(docs, monkeypatch, bucket, partitions):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    monkeypatch.setattr(store, "PARTITIONS", partitions)
    found = repeats.remove_repeats(docs, carry=["lang"])
    brute.same(found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), brute.without_repeats(ROWS))
    for row in found.collect():
        assert row.lang == "en" and (row.text is None or len(brute.BLANK.findall(row.text)) == row.n_words - row.n_removed)
    untouched = {(r.doc_id, r.text) for r in found.where("n_removed = 0").collect()}
    assert untouched <= set(ROWS)


@pytest.mark.parametrize("piece, remembered", [(2 << 20, 1 << 18), (4000, 1 << 18), (900, 1 << 18), (900, 7), (900, 0)])
def test_a_hot_passage_is_few_entries_per_task(spark, monkeypatch, piece, remembered):
    """A common passage and one repeated word, in several documents and with repeated and null ids."""
    monkeypatch.setattr(repeats, "SLICE", piece)
    monkeypatch.setattr(repeats, "REMEMBERED", remembered)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i * 7 % 31, f"a{i} {passage} {passage} b{i}") for i in range(40)] + [(50 + i, "the " * (60 + 30 * i)) for i in range(9)]
    rows += [(None, passage), (None, "the " * 70), rows[3], (rows[4][0], passage), (90, f"{passage} x " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sent = docs.selectExpr("doc_id", "cast(text AS binary) AS text", "xxhash64(text) AS key").mapInArrow(repeats._sender(50, 3), repeats.SENT)
    sent = [(r.slice, np.frombuffer(r.hashes, np.uint64)) for r in sent.where("hashes IS NOT NULL").collect()]
    own = [(n, h) for n, hashes in sent for h in hashes.tolist()]
    assert len(own) == len(set(own))
    hot = max(np.unique([h for _, h in own], return_counts=True)[1])
    if piece == 900 and remembered > 1000:  # sent where the least doc_id so far stands, or stands again
        assert max(n for n, _ in sent) >= 20 and hot < 12
    found = repeats.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    brute.same(found.collect(), brute.without_repeats(rows))


ITEMS = [
    (1, " ".join(ROWS[0][1].split()[:30]) if ROWS[0][1] else "a b c d"), (2, "The THE the"), (3, None), (4, ""), (None, "a b"),
    (5, next(t for _, t in ROWS if t and len(t.split()) > 1000)[200:900]), (5, "word1, word2!"), (12, "a b c d"),
]


@pytest.mark.parametrize("part", [1 << 25, 300])
def test_contamination(spark, docs, monkeypatch, part):
    monkeypatch.setattr(decontaminate, "PART", part)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, items string")
    found = decontaminate.find(docs, items, carry=["lang"])
    brute.same(decontaminate.digest(found).collect(), brute.contamination(ROWS, ITEMS))


def test_benchmark_pieces():
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice(["a", "Bc", "déf", " ", "  ", ", ", "-" * 20, "x" * 30]) for _ in range(rng.randrange(80))).encode()
        window, size = rng.randrange(1, 12), rng.randrange(60)
        own = decontaminate.words_of(text)
        runs = [tuple(own[i : i + window]) for i in range(max(1, len(own) - window + 1))] if own else []
        cut = [p.split() for p in decontaminate.pieces(text, window, size)]
        assert [tuple(p[i : i + window]) for p in cut for i in range(max(1, len(p) - window + 1))] == runs
        assert all(len(p) <= 2 * window or len(b" ".join(p[:-1])) <= size for p in cut)


def test_parts_are_bounded_whatever_item_holds_the_text(spark, docs, monkeypatch):
    """One item holds nearly all of the benchmark, half of it in one row."""
    monkeypatch.setattr(decontaminate, "PART", 2000)
    long = next(t for _, t in ROWS if t and len(t.split()) > 1000)
    items = [(5, long[:20_000]), *((5, long[a : a + 500]) for a in range(20_000, 40_000, 500)), (6, "a b c d"), (7, None)]
    sizes, plain = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, value: (sizes.append(sum(len(i) + len(t) for i, t in value)), plain(self, value))[1]
    )
    found = decontaminate.find(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert max(sizes) < 2000 + 500 + 10 and len(sizes) < 40
    brute.same(decontaminate.digest(found).collect(), brute.contamination(ROWS, items))


def test_short_item_inside_a_long_passage(spark):
    """The short item is searched later; the passage keeps all its words."""
    passage = [f"p{i}" for i in range(30)]
    items = [(1, " ".join(passage)), (2, " ".join(passage[5:9])), (3, " ".join(passage[26:]) + " after")]
    rows = [(1, " ".join(["before"] * 50 + passage + ["after"] * 9)), (2, " ".join(passage[3:12])), (3, " ".join(passage * 2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.find(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert [[*zip(r.begins, r.ends)] for r in found.orderBy("doc_id").collect()] == [[(50, 81)], [(2, 6)], [(0, 60)]]
    brute.same(decontaminate.digest(found).collect(), brute.contamination(rows, items))


def test_licenses(spark, docs):
    own = [(1, "The MIT-License. mit license MIT LICENSE"), (2, "Apache Licence, or gnu general publik license"), (3, "submit license"), (4, None)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(own, "doc_id long, text string")).collect()}
    assert (found[1].n_base, found[1].first_word, found[1].last_word, found[1].base_labels, found[1].score) == (3, 1, 5, "mit", 1.0)
    assert (found[2].base_labels, found[2].labels, found[2].n_base, found[2].first_word) == ("", "apache,gpl", 0, None)
    assert list(found[2].span_begins) == [0, 4] and 0 < found[2].score < 1
    assert found[3].labels == "" and (found[4].n_words, found[4].labels, found[4].score) == (0, "", 0.0)
    wanted = []
    for i, text in ROWS:
        own = brute.PLAIN.findall(brute.lower(text))
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(own)) if own[k : k + len(phrase.split())] == phrase.split()]
        places = [k for k, _ in at]
        wanted.append((i, len(own), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    brute.same(licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect(), wanted)


def test_every_fuzzy_notice_is_found():
    rng, scanner = random.Random(2), licenses.Scanner()
    for notice in licenses.notices():
        for _ in range(20):
            text = bytearray(notice.phrase)
            for _ in range(notice.edits):
                at = rng.choice([i for i, c in enumerate(text) if c != 32])
                text[at : at + 1] = rng.choice([b"", b"q", b"zz"])[:1]
            _, _, spans = scanner.scan(b"before it " + bytes(text) + b" after")
            assert notice.label in {s[0] for s in spans}, (notice, bytes(text))


def test_notices_side_by_side_are_all_found():
    """Worse matches beside better ones count, and long texts full of them take no quadratic time."""
    scanner = licenses.Scanner()
    _, base, spans = scanner.scan(b"mit licence mit license x licensed under the apache license mit licens")
    assert base == [("mit", 2), ("apache", 8)]
    assert spans == [("apache", 5, 10, 0), ("apache", 8, 10, 0), ("mit", 0, 2, 1), ("mit", 2, 4, 0), ("mit", 10, 12, 1)]
    _, base, spans = scanner.scan(b"mit licence mit license " * 20_000)
    assert len(base) == 20_000 and len(spans) == 40_000
    assert [e for *_, e in spans[:4]] == [1, 0, 1, 0]


def test_quality(spark, docs):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit,", "amet."]) + str(rng.randrange(50)) for _ in range(rng.randrange(20, 90)))) for i in range(300)]
    bad = [(1000 + i, " ".join(rng.choice(["BUY!!", "NOW$$$", "x", "x"]) for _ in range(rng.randrange(20, 90)))) for i in range(100)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(None, 1), (5, None), (6, 1)], "doc_id long, quality int")
    model = quality.fit(table, labels)
    found = quality.score(table, model).select("doc_id", "score", "predicted", quality.held_out().alias("held_out")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == (r.doc_id < 1000) for r in held]) > 0.97
    odd = quality.score(docs, model, carry=["lang", "n_words"])
    assert odd.count() == len(ROWS) and odd.where("score BETWEEN 0 AND 1 AND predicted IN (0, 1)").count() == len(ROWS)
    assert quality.fit(table, labels.where("quality = 1")).scores(np.zeros((2, 3))).tolist() == [1.0, 1.0]


def test_statistics_equal_counted_ones():
    texts = [t for _, t in ROWS] + ["A!B c 1 ... Cc cc CC\n\n(x) $#@ _ ~ É É 中", "!", "aa bb"]
    found = quality.statistics(pa.array(texts, pa.string()))
    assert np.allclose(found, [brute.statistics(t) for t in texts], rtol=0, atol=1e-6)


def test_scores_equal_written_out_densities(spark, docs):
    """The whole query's scores: repeated rows and doc_ids, null ids, several labels, labels of unknown documents."""
    rng = random.Random(5)
    labels = [(i, int(len(t or "") % 3 > 0)) for i, t in ROWS] + [(i, rng.choice([0, 1, None])) for i, _ in ROWS[:40]] + [(99991, 1), (None, 0)]
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    found = quality.score(docs, model, carry=["text"]).collect()
    wanted = brute.quality_scores(ROWS, labels, quality.SHRINKAGE, quality.FLOOR)
    by_row = {(i, t): float(p) for (i, t), p in zip(ROWS, wanted)}
    assert len(found) == len(ROWS) and 5 < sum(p < 0.3 for p in wanted) < len(ROWS) - 5
    for r in found:
        score = by_row[(r.doc_id, r.text)]
        assert abs(r.score - score) < 1e-5
        assert r.predicted == int(r.score >= 0.3) and (abs(score - 0.3) < 1e-5 or r.predicted == int(score >= 0.3))


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert shingle_join.near_duplicates(empty).count() == 0 and shingle_join.keep_one(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0
    assert decontaminate.find(empty, items).count() == 0 and licenses.scan(empty).count() == 0
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0


def test_no_benchmark_hits_nothing(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.find(docs, items)).where("contaminated").count() == 0


def mirrored(letters):
    """Two words that are equal to any polynomial hash modulo 2^64 (the Thue-Morse word and its mirror)."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(letters))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("letters", [8, 32, 33, 1024, 4096])
def test_long_words_are_told_apart(spark, letters):
    one, other = mirrored(letters)
    tail = " ".join(f"t{i}" for i in range(49))
    rows = [(1, f"{one} {tail}"), (2, f"{other} {tail}"), (3, one), (4, other), (5, f"{other} {tail} more"), (6, f"x {one.upper()} {tail}"), (7, one.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    brute.same(found.collect(), brute.without_repeats(rows))
    near = shingle_join.near_duplicates(spark.createDataFrame([(1, one), (2, other), (3, f"{one} a b c"), (4, f"{other} a b c"), (5, one.upper())], "doc_id long, text string"))
    brute.same(near.select("doc_id", "component_id").collect(), [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1)])


def test_hashes_are_polynomials_over_the_prime():
    values = np.random.default_rng(2).integers(0, 1 << 64, 90, np.uint64)
    values[:3] = [words.PRIME, (1 << 64) - 1, 0]
    for base in words.BASES:
        for k in (1, 2, 5, 50):
            plain = [sum(int(v) * pow(base, k - 1 - j, words.PRIME) for j, v in enumerate(values[i : i + k])) % words.PRIME for i in range(90 - k + 1)]
            assert (words.windows(values, k, base) == words.mix(np.array(plain, np.uint64))).all()


def test_windows_of_mirrored_words():
    one, other = ([(3 if c == "a" else 5) for c in w] for w in mirrored(2048))
    a, b = (np.array(w, np.uint64) for w in (one, other))
    assert (words.windows(a, 2048) != words.windows(b, 2048)).all()


def test_one_stays_of_rows_that_share_ids_and_hashes(spark, monkeypatch):
    """Were the hash of two documents the same, both would stay."""
    monkeypatch.setattr(shingle_join.F, "xxhash64", lambda *c: shingle_join.F.lit(7).cast("long"))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "q r s t u"), (None, "z"), (None, "z"), (3, "")], "doc_id long, text string")
    found = spark.createDataFrame([(1, 7, 2, 1, 1), (2, 7, 1, 2, 2), (None, 7, 1, None, 3), (3, 7, 0, 3, None)], "doc_id long, key long, n_shingles long, component_id long, root long")
    monkeypatch.setattr(shingle_join, "near_duplicates", lambda *a: found)
    kept = shingle_join.keep_one(docs).select("doc_id").collect()
    brute.same(kept, [(1,), (2,), (3,), (None,)])


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def labels_by_distance(text):
    """Labels of all runs of words within a notice's edits."""
    split, found = text.split(" "), set()
    for notice in licenses.notices():
        for a in range(len(split)):
            for b in range(a + 1, len(split) + 1):
                run = " ".join(split[a:b])
                if abs(len(run) - len(notice.phrase)) <= notice.edits and edit_distance(run, notice.phrase.decode()) <= notice.edits:
                    found.add(notice.label)
    return found


def test_every_single_insertion_is_found():
    scanner = licenses.Scanner()
    for notice in licenses.notices():
        phrase = notice.phrase.decode()
        for at in range(len(phrase) + 1):
            for letter in "zq":
                text = f"x {phrase[:at]}{letter}{phrase[at:]} y"
                assert notice.label in {s[0] for s in scanner.scan(text.encode())[2]}, text


def test_fuzzy_labels_equal_a_plain_edit_distance():
    rng, scanner = random.Random(8), licenses.Scanner()
    known = licenses.notices()
    for _ in range(250):
        parts = []
        for _ in range(rng.randrange(1, 3)):
            notice = rng.choice(known)
            text = list(notice.phrase.decode())
            for _ in range(rng.randrange(notice.edits + 2)):
                at = rng.choice([0, 0, len(text), rng.randrange(len(text) + 1), rng.randrange(len(text) + 1)])
                kind = rng.randrange(3)
                if kind == 0:
                    text.insert(at, rng.choice("zqe"))
                elif at < len(text) and text[at] != " ":
                    text[at : at + 1] = [] if kind == 1 else [rng.choice("zqe")]
            parts.append("".join(text).strip())
        text = " ".join(" ".join([rng.choice(["and", "the", "mit"]), *parts, rng.choice(["of", "license"])]).split())
        wanted = labels_by_distance(text)
        spans = scanner.scan(text.encode())[2]
        assert {s[0] for s in spans} == wanted, text
        for label, begin, end, edits in spans:
            run = " ".join(text.split(" ")[begin:end])
            assert min(edit_distance(run, n.phrase.decode()) for n in known if n.label == label) <= edits
