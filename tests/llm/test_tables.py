"""Token files, packing, rules, counts, neighbours and the pipeline."""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from shopmill.llm import huffman, neighbours, packing, quality, queries, store, token_counts, token_files, tokens, url_rules  # noqa: E402
from shopmill.llm.ordered import latest  # noqa: E402

ROWS = brute.awkward(2)


@pytest.fixture(scope="module")
def docs(spark):
    return brute.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def ids_of(text):
    encoder = tokens.encoder(tokens.vocabulary())
    ids = np.frombuffer(encoder.whole([text or ""])[0], encoder.dtype)
    return np.append(ids, 0).astype("<u4")


def test_parts_give_the_ids_of_the_whole(monkeypatch):
    encoder, rng = tokens.encoder(tokens.vocabulary()), random.Random(1)
    marks = [*"aBéßΩж中7 \n\t.,'!|$-_", "  ", "\r\n", " \n", "\u00a0", "\x1c", "'s", "’", "…", "́", "😀", "<|endoftext|>"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(14))) for _ in range(5000)] + [t or "" for _, t in ROWS]
    for section in (1 << 20, 7):
        monkeypatch.setattr(tokens, "SECTION", section)
        assert [encoder.encode(t) for t in texts] == encoder.whole(texts)


def test_added_tokens_as_by_the_library(monkeypatch):
    """Against a tokenizer straight from the vocabulary's file, with its switches as they are."""
    from tokenizers import Tokenizer

    plain, encoder, rng = Tokenizer.from_file(tokens.vocabulary()), tokens.encoder(tokens.vocabulary()), random.Random(2)
    marks = ["<|endoftext|>", "<|endoftext|", "|>", "<", " ", "  ", "\n", "\t", "a", "Bé", "中", "7", ",", "'s", "\u00a0"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(14))) for _ in range(5000)] + [t or "" for _, t in ROWS]
    for section in (1 << 20, 7):
        monkeypatch.setattr(tokens, "SECTION", section)
        found = [np.frombuffer(encoder.encode(t), encoder.dtype).tolist() for t in texts]
        assert found == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert any(50256 in ids for ids in found)


def test_huffman_round_trip():
    rng = np.random.default_rng(1)
    for values in (np.zeros(5, int), rng.integers(0, 2, 9), rng.zipf(1.3, 70_000) % 5000, np.zeros(0, int)):
        counts = np.bincount(values, minlength=1)
        lengths = huffman.code_lengths(counts)
        assert lengths.max(initial=0) <= huffman.MAX_BITS and sum(2.0 ** -int(n) for n in lengths if n) <= 1
        if len(values):
            code = huffman.Code(lengths)
            parts = [values[:7], values[7:]] if len(values) > 7 else [values]
            packed = [code.encode(p, 16) for p in parts]
            found = code.decode([p for p, _ in packed], [o for _, o in packed], [len(p) for p in parts], 16)
            assert all((a == b).all() for a, b in zip(found, parts))
    # Where lengths are not bounded, package-merge gives the least total, that of Huffman's own method.
    counts = rng.integers(1, 1000, 60)
    import heapq

    heap, total = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert int((counts * huffman.code_lengths(counts)).sum()) == total


def test_token_files(spark, docs, path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 700)
    token_files.write(docs, path + "/t")
    found = token_files.digest(token_files.read(spark, path + "/t")).collect()
    brute.same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], [(i, len(x := ids_of(t)), zlib.crc32(x.tobytes())) for i, t in ROWS])
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: -1 if i is None else i)


def test_best_fit_equals_a_plain_one():
    rng = random.Random(1)
    for _ in range(50):
        lengths = [rng.randrange(1, 100) for _ in range(rng.randrange(80))]
        room, plain = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [s for s in range(len(room)) if room[s] >= lengths[i]]
            s = min(fits, key=lambda s: room[s]) if fits else len(room)
            if not fits:
                room.append(100)
            room[s] -= lengths[i]
            plain[i] = s
        found = packing.best_fit(lengths, 100)
        assert sorted(i for s in found for i in s) == list(range(len(lengths)))
        assert sorted(sum(lengths[i] for i in s) for s in found) == sorted(100 - r for r in room)


def test_packing(docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 30)
    packed = packing.pack(docs).cache()
    found = packing.digest(packed).collect()
    whole = defaultdict(Counter)
    for i, t in ROWS:
        x = ids_of(t)
        for start in range(0, len(x), 1024):
            whole[i][(start, len(x[start : start + 1024]), zlib.crc32(x[start : start + 1024].tobytes()), len(x))] += 1
    for r in found:
        whole[r.doc_id][(r.start, r.length, r.ids_crc32, r.doc_tokens)] -= 1
    assert not any(v for c in whole.values() for v in c.values())
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0, *(n for _, n in pieces)])[:-1]) and sum(n for _, n in pieces) <= 1024
    assert all(r.padded == (r.length if r.length & (r.length - 1) == 0 else 1024) for r in packed.collect())


def test_url_rules(spark):
    rng = random.Random(5)
    last = "\U0010ffff"
    hosts = ["com", "a.com", "b.a.com", "net", "a", "aa.com", "-.com", "a b", f"{last}.net"]
    paths = ["/", "/a", "/a/", "/a/b", "", "/ab", "/a!", "/é", f"/{last}", f"/a{last}x", "b/"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(40)]
    ends = ["", "?q=/a/", "#f"]
    urls = [
        rng.choice(["http://", "", "X://"]) + rng.choice([*hosts, "z.b.a.com", "Q.NET"]) + rng.choice([*(p for p in paths if p != "b/"), "/a/b/d", f"/a/{last}x", f"/{last}{last}"]) + rng.choice(ends)
        for _ in range(900)
    ] + [None, "", "://", "http://", "x://?/a", "http://a.com/a", "http://a.com/a"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame([*rules, ("block", None, "/"), (None, "a", "/")], "verdict string, host string, path string")
    best = {}
    for verdict, host, path in rules:
        best[(host, path)] = max(verdict, best.get((host, path), ""))
    wanted = []
    for i, url in enumerate(urls):
        host = path = ""
        if "://" in (url or ""):
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = brute.lower(host)
        fit = [(len(h) + len(p), h + p, v) for (h, p), v in best.items() if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        wanted.append((i, host, path, *(max(fit)[1:] if fit else (None, "allow"))))
    brute.same(url_rules.judge(pages, table).collect(), wanted)
    assert url_rules.judge(pages.limit(0), table).count() == 0
    odd = spark.createDataFrame([(1, f"http://example.net/en/{last}x"), (2, f"http://a.net/{last}"), (3, "http://a b/x")], "page_id long, url string")
    own = spark.createDataFrame([*url_rules.RULES, ("block", "a", "b/x"), ("block", "a/b", "/")], "verdict string, host string, path string")
    found = url_rules.judge(odd, own).select("page_id", "rule", "verdict").collect()
    brute.same(found, [(1, "example.net/en/", "allow"), (2, "net/", "block"), (3, None, "allow")])
    assert {r.verdict for r in url_rules.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_url_rules_stay_in_the_jvm(spark):
    frame = queries.QUERIES["op3_url_rules"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|Cartesian|NestedLoop", plan)


def test_latest_by_depth(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(4), rng.choice([None, f"v{i}"])) for i in range(300)]
    found = latest(spark.createDataFrame(rows, "n long, depth long, value string").repartition(7), [F.col("n")], "value", "top", by=["depth"])
    seen, wanted = {}, []
    for n, depth, value in rows:
        seen[depth] = value or seen.get(depth)
        wanted.append((n, depth, value, seen[depth]))
    brute.same(found.collect(), wanted)


CHANGES = "doc_id long, change string, source string, lang string, tokenizer string, tokens long, batch string"


def test_token_counts_follow_changes(spark, path):
    rng, rollup, state, done = random.Random(6), token_counts.Rollup(spark, path + "/r"), {}, {}
    assert rollup.totals().count() == 0
    for number in range(4):
        rows = {}
        for i in rng.sample(range(30), 15):
            rows[i] = (i, rng.choice(["insert", "revise", "delete"]), rng.choice(["a", None]), "en", f"t{number % 2}", rng.choice([None, 5, 9]), "x")
        batch = [*rows.values(), *list(rows.values())[:3], (99, "odd", "a", "en", "t", 3, "x")]
        done[f"b{number}"] = spark.createDataFrame(batch, CHANGES)
        assert rollup.commit(f"b{number}", done[f"b{number}"])
        for i, change, *values, _ in rows.values():
            state.pop(i, None)
            if change != "delete":
                state[i] = values
        assert not rollup.commit("b0", done["b0"])
        wanted = defaultdict(lambda: [0, 0])
        for source, lang, tokenizer, n in state.values():
            wanted[(source, lang, tokenizer)][0] += 1
            wanted[(source, lang, tokenizer)][1] += n or 0
        brute.same(rollup.totals().collect(), [(*k, *v) for k, v in wanted.items()])
    assert rollup.commit("none", spark.createDataFrame([], CHANGES))


def test_a_commit_without_its_mark_is_written_anew(spark, path):
    rollup = token_counts.Rollup(spark, path + "/r")
    rollup.commit("a", spark.createDataFrame([(1, "insert", "s", "en", "t", 4, "")], CHANGES))
    rollup.commit("b", spark.createDataFrame([(2, "insert", "s", "en", "t", 5, "")], CHANGES))
    store.remove(spark, f"{path}/r/marks/1")
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 1, 4)]
    assert rollup.commit("b", spark.createDataFrame([(2, "insert", "s", "en", "t", 6, "")], CHANGES))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 2, 10)]


@pytest.mark.parametrize("together", [2, 3])
def test_states_written_together(spark, path, monkeypatch, together):
    monkeypatch.setattr(token_counts, "TOGETHER", together)
    rng, rollup, state = random.Random(9), token_counts.Rollup(spark, path + "/r"), {}
    for number in range(6):
        rows = [(i, rng.choice(["insert", "delete"]), "a", "en", "t", rng.randrange(9), "x") for i in rng.sample(range(8), 4)]
        assert rollup.commit(f"b{number}", spark.createDataFrame(rows, CHANGES))
        for i, change, *_, n, _ in rows:
            state.pop(i, None)
            if change == "insert":
                state[i] = n
        wanted = [("a", "en", "t", len(state), sum(state.values()))] if state else []
        brute.same(rollup.totals().collect(), wanted)
    assert len([m for m in rollup._marks() if m.base]) == 5 // together


def test_rows_without_unique_doc_id_count(spark, path):
    """Copies, rows that share a doc_id and rows without one; a delete takes one of them away."""
    kind = "doc_id long, part long, copies long, change string, source string, lang string, tokenizer string, tokens long"
    rows = [(None, 1, 3, "insert", "s", "en", "t", 5), (None, 2, None, "insert", "s", "en", "t", 7), (4, 1, 1, "insert", "s", "en", "t", 1), (4, 2, 2, "insert", "s", "en", "t", 10)]
    rollup = token_counts.Rollup(spark, path + "/r")
    rollup.commit("a", spark.createDataFrame(rows, kind))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 7, 43)]
    rollup.commit("b", spark.createDataFrame([(None, 1, None, "delete", None, None, None, None), (4, 2, 1, "revise", "s", "en", "t", 2)], kind))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 3, 10)]
    plain = [(None, "insert", "s", "en", "t", 3, ""), (None, "insert", "s", "en", "t", 4, ""), (None, "insert", "s", "en", "t", 4, "")]
    other = token_counts.Rollup(spark, path + "/o")
    other.commit("a", spark.createDataFrame(plain, CHANGES))
    assert [tuple(r) for r in other.totals().collect()] == [("s", "en", "t", 2, 7)]


def test_concurrent_commits(spark, path):
    """Each counts once, on the states of the one before it; nothing of a lost attempt is read."""
    rollup = token_counts.Rollup(spark, path + "/r")
    batches = [spark.createDataFrame([(1, "insert", "s", "en", "t", n, ""), (10 + n, "insert", "s", "en", "t", 100, "")], CHANGES) for n in range(4)]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda n: rollup.commit(f"b{n % 3}", batches[n % 3]), range(4)))
    assert sorted(done) == [False, True, True, True]
    last = int(max(rollup._marks(), key=lambda m: m.batch).batch_id[1:])
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 4, 300 + last)]
    assert len(list(Path(path, "r", "batches").iterdir())) == 3


def test_token_counts_of_a_vocabulary(docs):
    found = token_counts.count_tokens(docs).select("doc_id", "tokens").collect()
    brute.same(found, [(i, len(ids_of(t)) - 1) for i, t in ROWS])


@pytest.mark.parametrize("factor", [1.0, neighbours.FACTOR])
def test_neighbours(spark, monkeypatch, factor):
    monkeypatch.setattr(neighbours, "SHARD", 300)
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 8))
    points = centres[rng.integers(0, 12, 900)] + 0.1 * rng.normal(size=(900, 8))
    points[300:600] = points[300]
    rows = [(i, p.astype(np.float32).tolist(), "x") for i, p in enumerate(points)]
    odd = [(1000, None, ""), (1020, [0.0] * 8, ""), (1040, [float("nan")] * 8, ""), (1060, [None, 1.0], ""), (None, [1.0] * 8, ""), (1080, [1.0, 2.0], ""), (1100, [], "")]
    table = spark.createDataFrame([*rows, rows[0], rows[5], *odd], "vec_id long, embedding array<float>, score string")
    known = neighbours.vectors(table)
    found = neighbours.search(known.where("vec_id % 20 = 0"), known, 20, factor).collect()
    exact = {i: np.array(v) for i, v, _ in rows}
    by = defaultdict(list)
    for r in found:
        by[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(by) == {i for i in exact if i % 20 == 0}
    hits = 0
    for q, own in by.items():
        scores = sorted((-float(np.cumsum(exact[q] * v)[-1]), i) for i, v in exact.items() if i != q)[:20]
        wanted = [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
        hits += len({i for _, i, _ in own} & {i for _, i, _ in wanted})
        assert factor < 1 or sorted(own) == wanted
    assert hits >= 0.9 * 20 * len(by)
    assert neighbours.search(known.limit(0), known.limit(0)).count() == 0


def test_empty_tables(spark, empty, path):
    token_files.write(empty, path + "/t")
    assert token_files.read(spark, path + "/t").count() == 0
    assert packing.pack(empty).count() == 0 and token_counts.count_tokens(empty).count() == 0


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    items = [(1, " ".join(ROWS[1][1].split()[5:25]) if ROWS[1][1] else "q"), (2, "zz yy")]
    folder = str(tmp_path)
    brute.frame(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(n % 5 > 0), 0) for n, (i, _) in enumerate(ROWS)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        found = store.settle(stage(spark, docs, folder), "test-stage")
        if stage is not corpus_pipeline.packing_stage:
            assert found.columns == corpus_pipeline.COLUMNS
            after = [(r.doc_id, r.text) for r in found.collect()]
        if name == "quality classifier":
            scores = brute.quality_scores(before, [label[:2] for label in labels], quality.SHRINKAGE, quality.FLOOR)
            assert min(abs(p - quality.THRESHOLD) for p in scores) > 1e-5
            brute.same(after, [row for row, p in zip(before, scores) if p >= quality.THRESHOLD])
        elif name == "n-gram Jaccard join":
            roots, sets = brute.groups(before)
            assert len(after) == len({r for r in roots if sets[r]}) + sum(not s for s in sets)
        elif name == "substring dedup":
            brute.same([(i, len(brute.BLANK.findall(t or ""))) for i, t in after], [(i, n - g) for i, n, g, _ in brute.without_repeats(before)])
        elif name == "benchmark decontamination":
            clean = [not hit for *_, hit in brute.contamination(before, items)]
            brute.same(after, [row for row, c in zip(before, clean) if c])
        elif name == "packing":
            held = Counter()
            for r in found.collect():
                for i, n in zip(r.doc_ids, r.lengths):
                    held[i] += n
            wanted = Counter()
            for i, t in before:
                wanted[i] += len(ids_of(t))
            assert held == wanted
        docs = found


@pytest.mark.parametrize("name", sorted(queries.STATEMENTS))
def test_queries_equal_their_statements(spark, name):
    import check

    assert check.compare(spark, check.oracle("/root/testdata/sf0.001"), name, "/root/testdata/sf0.001").startswith("ok")
