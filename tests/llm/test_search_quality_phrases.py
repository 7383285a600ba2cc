"""Ranked search, compression quality and phrases against plain versions."""

import math
import re
import zlib
from collections import Counter

import pytest

from gaitmill.llm import compression_quality, lemp_search, phrases
from gaitmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, length int, k int, n long"


def frame(spark, rows, partitions=3):
    """Rows of (doc_id, text, lang) with columns whose names the operators use too."""
    return spark.createDataFrame([(*r, 7, 7, 7) for r in rows], DOCS).repartition(partitions)


# -- ranked search ---------------------------------------------------------------------------


def brute_search(docs, items, keep=10):
    bags = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t, _ in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        wanted = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in wanted & set(bag)
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        best = sorted(scores, key=lambda r: r[:3])[:keep]
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(best)]
    return out


def search_rows():
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[(i * j + j) % 60] for j in range(1, 3 + i % 17)), "en") for i in range(300)]
    docs += [(1000 + i, "Common line, the same everywhere! w1 w2", "en") for i in range(200)]
    docs += [(5, "w3 w4 again", "en"), (5, "w3 w4 again", "en"), (None, "w3 w4", "en")]
    docs += [(2000, None, "en"), (2001, "", "en"), (2002, " \t!?", "en"), (2003, "w7 " * 30_000 + "w8", "en")]
    items = [("a", "W1 w2 common"), ("b", "w3, w4"), ("c", "w7 w8 w9 Ünï"), ("d", None), ("e", "!"), ("f", "none")]
    return docs, [*items, ("a", "w1")]


@pytest.mark.parametrize("first, bucket, block", [(16_384, 2_048, 4 << 20), (40, 16, 4 << 20), (40, 16, 20)])
def test_search_equals_brute_force(spark, monkeypatch, first, bucket, block):
    monkeypatch.setattr(lemp_search, "FIRST", first)
    monkeypatch.setattr(lemp_search, "BUCKET", bucket)
    monkeypatch.setattr(lemp_search, "BLOCK_BYTES", block)
    docs, items = search_rows()
    told = spark.createDataFrame([(*i, 1.0) for i in items], "item_id string, text string, score double")
    got = lemp_search.ranked_search(frame(spark, docs), told).collect()
    key = lambda r: (r[0], r[1], r[3], str(r[2]))
    assert sorted(map(tuple, got), key=key) == sorted(brute_search(docs, items), key=key)


def test_search_of_nothing(spark):
    none = frame(spark, [(1, None, "en")])
    items = spark.createDataFrame([("a", "w1")], "item_id string, text string")
    assert lemp_search.ranked_search(none.limit(0), items).collect() == []
    assert lemp_search.ranked_search(none, items).collect() == []
    assert lemp_search.ranked_search(none, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


# -- quality ---------------------------------------------------------------------------------


def test_quality_of_held_out_rows(spark):
    """Ranks held-out rows right nearly always, and says of each row what it must."""
    got = {r["doc_id"]: r for r in QUERIES["op12_compression_quality"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == n
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    unseen = [(got[r["doc_id"]]["score"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    good, bad = ([s for s, q in unseen if q == k] for k in (1, 0))
    right = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert right >= 0.9


def quality_rows():
    good = "The committee published its findings after a careful review of the evidence. "
    bad = "click here buy now $$$ free free win win >>> "
    docs = [(i, (good if i % 2 else bad) * (1 + i % 7) + str(i), "en") for i in range(120)]
    docs += [(500, None, "en"), (501, "", "en"), (None, good, "en"), (3, good, "en"), (503, good * 20_000, "en")]
    return docs, [(i, i % 2) for i in range(120)] + [(0, 1), (7, None), (None, 1), (9_999, 1)]


def test_quality_of_odd_rows(spark):
    docs, labels = quality_rows()
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    got = compression_quality.score_documents(frame(spark, docs), told).collect()
    assert sorted(r["doc_id"] or -1 for r in got) == sorted(d or -1 for d, *_ in docs)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 3}
    assert all(by_id[d]["predicted"] == d % 2 for d in range(4, 120))
    assert by_id[503]["predicted"] == 1 and by_id[500]["score"] == by_id[501]["score"]
    assert by_id[None]["held_out"] is False


def test_quality_ignores_held_out_labels(spark):
    docs, labels = quality_rows()
    turned = [(d, 1 - q if q is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 1 else q) for d, q in labels]
    scores = [
        sorted((r["doc_id"] or -1, r["score"]) for r in compression_quality.score_documents(
            frame(spark, docs), spark.createDataFrame(rows, "doc_id long, quality int")).collect())
        for rows in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_quality_without_labels_or_rows(spark):
    docs, labels = quality_rows()
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    assert compression_quality.score_documents(frame(spark, docs).limit(0), told).collect() == []
    none = compression_quality.score_documents(frame(spark, docs), told.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5}
    one = compression_quality.score_documents(frame(spark, docs), told.where("quality = 1"))
    assert all(r["score"] > 0.9 and r["predicted"] == 1 for r in one.collect())


# -- phrases ---------------------------------------------------------------------------------


def brute_phrases(docs, support=30, keep=2000):
    f, n = {}, Counter()
    for _, text, lang in docs:
        counts = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                counts.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        covered = {
            q[i : i + len(p)]: True
            for q, b in frequent.items()
            for size in range(2, len(q))
            for i in range(len(q) - size + 1)
            for p in [q[i : i + size]]
            if 100 * b >= 80 * frequent[p]
        }
        rows = []
        for p, a in frequent.items():
            if p not in covered:
                cut = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-cut[0], -a, " ".join(p).encode(), counts[p[: cut[1]]], counts[p[cut[1] :]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:keep]):  # noqa: E741
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def phrase_rows():
    docs = [(i, f"Alpha beta gamma delta {i % 5}; alpha  beta\tx{i}\nBeta gamma, delta", "en") for i in range(90)]
    docs += [(i, "beta gamma omega. " * (i % 4) + "tail \x00nul É é", None) for i in range(60)]
    docs += [(i, "same same same same same same", "und") for i in range(12)]
    docs += [(900, None, "en"), (901, "", "xx"), (902, " ,.\t", "en"), (None, "alpha beta", "en")]
    return [*docs, (903, "one two three four five " * 9_000, "de"), (903, "one two three four five", "de")]


@pytest.mark.parametrize("shard", [10**6, 200])
@pytest.mark.parametrize("partitions", [1, 7])
def test_phrases_equal_brute_force(spark, monkeypatch, shard, partitions):
    monkeypatch.setattr(phrases, "SHARD", shard)
    docs = phrase_rows()
    got = phrases.collocations(frame(spark, docs, partitions)).collect()
    assert sorted(map(tuple, got)) == brute_phrases(docs) != []


def test_phrases_do_not_depend_on_hashes(spark, monkeypatch):
    """A bitmap of 64 bits lets nearly everything through; counts stay."""
    monkeypatch.setattr(phrases, "BITS", 6)
    docs = phrase_rows()
    got = phrases.collocations(frame(spark, docs), keep=3).collect()
    assert sorted(map(tuple, got)) == brute_phrases(docs, keep=3)


def test_phrases_of_nothing(spark):
    docs = frame(spark, [(1, "a b", "en"), (2, None, None)])
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(docs.limit(0)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_shard_keeps_no_object_for_a_word():
    """Words of a shard are arrays and one run of bytes, and are read back as they were."""
    import tracemalloc

    text = b"Ab,  cd\tef gh ij. " * 20_000
    shard = phrases.Shard("en", 1)
    tracemalloc.start()
    shard.add(text)
    shard.add(b"last one")
    shard.close()
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 30 * len(shard.hashes)
    assert shard.name(1, 1) == b"\xff" and shard.name(2, 3) == b"cd ef gh"
    assert shard.name(len(shard.hashes) - 3, 2) == b"last one"
    assert shard.left[:7].tolist() == [1, 0, 4, 3, 2, 1, 0] and shard.left[-3:].tolist() == [2, 1, 0]


def test_reports_travel_packed():
    """A reported phrase takes about three bytes, no row, and is read back as it was."""
    import numpy as np

    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 1 << 32, 500_000, dtype=np.uint32))
    counts = draw.integers(1, 90, len(keys))
    rows = list(phrases.packed(keys, counts, 64, 30))
    assert len(rows) == 64 and sum(len(b) for r in rows for b in r[1:]) < 4 * len(keys)
    read = [(r, *phrases.unpacked(*parts, 30)) for r, *parts in rows]
    assert (np.concatenate([r * (1 << 26) + k.astype(np.int64) for r, k, _ in read]) == keys).all()
    assert (np.concatenate([n for *_, n in read]) == np.minimum(counts, 30)).all()
    (last,) = phrases.packed(np.array([2**32 - 1], np.uint32), np.array([70_000]), 1_024, 100_000)
    assert last[0] == 1_023
    assert [x.tolist() for x in phrases.unpacked(*last[1:], 100_000)] == [[(1 << 22) - 1], [70_000]]
    assert list(phrases.packed(keys[:0], counts[:0], 64, 30)) == []


def test_candidates_are_those_with_support(spark, monkeypatch):
    """However many shards a task has, a phrase below the support is no candidate."""
    import numpy as np

    monkeypatch.setattr(phrases, "SHARD", 48)
    told = [("en", f"often n{i // 6} seldom{i % 9}") for i in range(240)] + [("de", "often")] * 29
    texts = spark.createDataFrame(told, "lang string, text string").coalesce(1)
    bitmap = phrases.mined(spark, texts, 1, None, 25, 16)
    assert int(np.bitwise_count(bitmap).sum()) == 1 + 9 + 1


def shards_of(text, n, lang="en"):
    for _ in range(n):
        shard = phrases.Shard(lang)
        shard.add(text.encode())
        shard.close()
        yield shard


def test_task_tells_a_phrase_once(monkeypatch):
    """What a task sends does not grow with its shards while they say the same."""
    import numpy as np

    text = " ".join(f"word{i} É{i % 7}." for i in range(3_000))
    every = [np.full(1, 2**64 - 1, np.uint64)] * 4
    seen = []
    for n in (1, 9):
        told = list(phrases.reported(shards_of(text, n), 2, None, 16, 30))
        rows = list(phrases.listed(shards_of(text, n), every, 16))
        assert len(told) == len({r for _, r, *_ in told}) and len(rows) == len({r for _, r, *_ in rows}) == 16
        assert sum(phrases.unpacked(*r, 30)[1].sum() for _, _, *r in told) == 3_000 * n
        found = {p: f for *_, a, b in rows for p, f in zip(*phrases.unlisted(a, b).to_pydict().values())}
        assert found[""] == 6_000 * n and found["word17 É3"] == n and found["É1"] == 429 * n
        assert len(found) == 1 + 3_000 + 7 + 3_000
        seen.append(sum(len(b) for row in [*told, *rows] for b in row[2:]))
        assert sum(len(a) for *_, a, _ in rows) < 8 * len(found)
    assert seen[1] <= 1.2 * seen[0]
    # A large task sends some at a time: nothing is lost, and the largest language goes first.
    monkeypatch.setattr(phrases, "MOST_PHRASES", 7_000)
    mixed = [x for pair in zip(shards_of(text, 3), shards_of("a b. a", 3, "xx")) for x in pair]
    rows = list(phrases.listed(iter(mixed), every, 16))
    found = [(lang, p, f) for lang, _, a, b in rows for p, f in zip(*phrases.unlisted(a, b).to_pydict().values())]
    assert [f for lang, p, f in found if (lang, p) == ("en", "")] == [12_000, 6_000]
    assert [(p, f) for lang, p, f in sorted(found) if lang == "xx"] == [("", 9), ("a", 6), ("a b", 3), ("b", 3)]
