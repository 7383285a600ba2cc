"""Personal data, licences, toxicity, nearest neighbours and the pipeline."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaitmill.llm import licenses, pii, toxicity, vp_trees
from gaitmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
    return sum(sum(map(int, str(n))) for n in doubled) % 10 == 0


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(found)


def test_strict_spans_against_the_patterns():
    draw = random.Random(1)
    for _ in range(60_000):
        text = "".join(draw.choice("12 a.@+-()45.") for _ in range(draw.randint(0, 40)))
        assert [(s.start, s.kind, s.end) for s in pii.strict_spans(text)] == brute_spans(text)


@pytest.mark.parametrize("text", ["1" * 400_000, "a" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "1 " * 200_000])
def test_very_long_texts_are_linear(text):
    pii.candidate_spans(text)


DOC = "doc_id long, text string, spans string, _r int, n_email int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOC)


PERSONAL = [
    (1, "write to ann.b@mail.example.com or call +1 (212) 555-0123 today"),
    (2, "server 10.20.30.40 and version 1.2.3.4 of it"),
    (3, "card 4111111111111111 was used"), (4, None), (5, ""), (None, "x@y.org"),
    (6, "phone 212-555-0123 please"), (7, "mail ann (at) example (dot) com"), (8, "é 999.1.1.1 4111111111111112"),
    (1, "write to ann.b@mail.example.com or call +1 (212) 555-0123 today"),
]


def test_personal_data_rows(spark):
    got = pii.find_personal_data(docs_of(spark, PERSONAL)).collect()
    assert len(got) == len(PERSONAL)
    for r in got:
        text = next(t for i, t in PERSONAL if i == r["doc_id"]) or ""
        base = brute_spans(text)
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(filter(None, listed.split(","))) <= set(filter(None, r["spans"].split(",")))
    assert pii.find_personal_data(docs_of(spark, PERSONAL).limit(0)).count() == 0


def test_reliabilities_and_classifier():
    draw, counts = random.Random(3), Counter()
    truth = {}
    for _ in range(20_000):
        real = draw.random() < 0.6
        said = tuple(
            (1 if (draw.random() < p) == real else -1) if draw.random() < 0.8 else 0 for p in (0.95, 0.9, 0.7, 0.85, 0.6)
        )
        key = (3, *said, 3, 2)
        counts[key] += 1
        truth.setdefault(key, Counter())[real] += 1
    posterior, rates = pii.estimate({k: float(n) for k, n in counts.items()})
    assert abs(rates[3, 0][0] - 0.95) < 0.05 and abs(rates[3, 2][0] - 0.7) < 0.05
    weights = pii.train({k: float(n) for k, n in counts.items()}, posterior)
    right = sum(truth[k][bool(pii.features(k) @ weights > 0)] for k in counts)
    best = sum(max(t.values()) for t in truth.values())
    assert right > 0.98 * best


def test_redaction(spark):
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs_of(spark, PERSONAL)).collect()}
    assert got[1] == "write to [EMAIL] or call [PHONE] today" and got[4] is None and got[5] == ""
    assert got[3] == "card [CARD] was used"


def test_personal_data_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op9_personal_data"](spark, SF).collect():
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(texts[r["doc_id"]] or ""))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


# -- licences ----------------------------------------------------------------


def brute_cosines(texts):
    split = lambda t: [w for w in re.split(r"[^a-zà-ÿ0-9.]+|\.(?![0-9])", t.lower()) if w]
    templates = [(name, Counter(split(t))) for name, t in licenses.TEMPLATES]
    words = {w for _, t in templates for w in t}
    df = Counter(w for t in texts for w in set(split(t)) & words)
    idf = lambda w: math.log((1 + len(texts)) / (1 + df[w])) + 1 if w in words else math.log(1 + len(texts)) + 1

    def cosine(a, b):
        norm = lambda v: math.sqrt(sum((n * idf(w)) ** 2 for w, n in v.items()))
        return sum(n * b[w] * idf(w) ** 2 for w, n in a.items() if w in b) / (norm(a) * norm(b))

    def best(text):
        lines = [s for s in re.split(r"\r?\n", text) if any(a in s.lower() for a in licenses.ANCHORS)]
        scored = [(round(cosine(Counter(split(s)), t), 9), -i) for s in lines for i, (_, t) in enumerate(templates)]
        top = max(scored, default=(0, 0))
        return licenses.TEMPLATES[-top[1]][0] if top[0] >= licenses.THRESHOLD else None

    return [best(t) for t in texts]


FILES = [
    (0, "a/LICENSE", "Released under the MIT License."), (1, "a/b/x.txt", "nothing here"),
    (2, "a/b/c/y.txt", None), (3, "/a/b/c/LICENSE.md/", "text\nLicensed under the Apache License, Version 2.0.\nmore"),
    (4, "z.txt", "no"), (5, "q/own.py", "# licensed under the GNU General Public License version 3"),
    (6, None, ""), (7, "a/bb/COPYING", "a licence of our own making, unlike all others"),
    (1, "a/b/x.txt", "nothing here"), (None, "a/b/n.txt", "text"), (8, "ab/x", "y"),
]


def files_of(spark, rows):
    return spark.createDataFrame([(i, p, t, "z", "z", 1) for i, p, t in rows], "doc_id long, path string, text string, license string, file string, line int")


def test_license_inheritance(spark):
    got = {(r["doc_id"], r["path"]): (r["own_license"], r["license"], r["inherited_from"]) for r in licenses.scan_licenses(files_of(spark, FILES)).collect()}
    assert got[0, "a/LICENSE"] == ("MIT", "MIT", None)
    assert got[1, "a/b/x.txt"] == (None, "MIT", "a")
    assert got[2, "a/b/c/y.txt"] == (None, "Apache-2.0", "a/b/c")
    assert got[3, "a/b/c/LICENSE.md"][0] == "Apache-2.0"
    assert got[5, "q/own.py"][0] == "GPL-3.0"
    assert got[7, "a/bb/COPYING"] == (None, "MIT", "a")
    assert got[None, "a/b/n.txt"] == (None, "MIT", "a")
    for key in ((4, "z.txt"), (6, ""), (8, "ab/x")):
        assert got[key] == (None, None, None)
    assert licenses.scan_licenses(files_of(spark, FILES)).count() == len(FILES)
    assert licenses.scan_licenses(files_of(spark, FILES).limit(0)).count() == 0


def test_licenses_of_documents_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_cosines([r["text"] or "" for r in rows])
    got = {r["doc_id"]: r["own_license"] for r in QUERIES["op8_license_scan"](spark, SF).collect()}
    assert {r["doc_id"]: e for r, e in zip(rows, expected)} == got


def test_scores_do_not_depend_on_the_number_of_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("doc_id as file", "'' as path", "text")
    said = rows.where(r"text rlike '(?m)^All rights reserved\\.$'").select("file")
    got = licenses.own_licenses(rows).join(said, "file").groupBy("license").count().collect()
    assert [(r["license"], r["count"]) for r in got] == [("proprietary", said.count())]
    mixed = [(i, "", t) for i, t in enumerate(["all of it", "Copyright is what we say", "Copyright. No license is granted.", *["x"] * 60])]
    once, often = (
        {r["file"] % 100: (r["license"], r["cosine"]) for r in licenses.own_licenses(
            spark.createDataFrame([(100 * k + i, p, t) for k in range(n) for i, p, t in mixed], "file long, path string, text string")
        ).collect()} for n in (1, 50)
    )
    assert once == often and once[2][0] == "proprietary"


PERMISSION = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"


def test_headers_without_the_word_licence(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id as file", "'' as path", "text").collect()
    more = [(-1, "", f"x\n{PERMISSION}\ny"), (-2, "", "# Distributed under CC BY-SA 4.0"), (-3, "a/LICENSE", PERMISSION.replace(" ", "\n"))]
    listed = [(r["file"], r["path"], r["text"] or "") for r in rows] + more
    got = {r["file"]: r["license"] for r in licenses.own_licenses(spark.createDataFrame(listed, "file long, path string, text string")).collect()}
    assert (got[-1], got[-2], got[-3]) == ("MIT", "CC-BY-SA-4.0", "MIT")


def test_every_line_is_scored(spark):
    """Random lines of template words and others, against scores of all lines."""
    draw = random.Random(6)
    words = [*licenses.ANCHORS, "haus", "tree", "blue", "runs", "1.5"]
    said = [t for _, t in licenses.TEMPLATES]
    texts = []
    for _ in range(600):
        line = draw.choice(said).split()
        for _ in range(draw.randrange(8)):
            line[draw.randrange(len(line))] = draw.choice(words)
        texts.append(" ".join(line))
    texts += [" ".join(draw.choice(words) for _ in range(9)) for _ in range(400)]
    split = lambda t: [w for w in re.split(r"[^a-z0-9.]+|\.(?![0-9])", t.lower()) if w]
    seen = Counter(w for t in texts for w in set(split(t)) & set(licenses.ANCHORS))
    idf = lambda w: 1 - math.log(seen[w] / len(texts) + licenses.RARE)

    def cosine(a, b):
        norm = lambda v: math.sqrt(sum((n * idf(w)) ** 2 for w, n in v.items()))
        return sum(n * b[w] * idf(w) ** 2 for w, n in a.items()) / (norm(a) * norm(b))

    expected = {}
    for i, t in enumerate(texts):
        best = max((round(cosine(Counter(split(t)), Counter(split(s))), 12), -k) for k, s in enumerate(said))
        if best[0] >= licenses.THRESHOLD:
            expected[i] = licenses.TEMPLATES[-best[1]][0]
    df = spark.createDataFrame([(i, "", t) for i, t in enumerate(texts)], "file long, path string, text string")
    assert {r["file"]: r["license"] for r in licenses.own_licenses(df).collect()} == expected


# -- toxicity ----------------------------------------------------------------


def labelled_corpus(spark, n=900, with_bad=True):
    draw = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(["haus", "tree", "blue", "runs", "of", "you"]) for _ in range(draw.randint(8, 60))]
        bad = with_bad and draw.random() < 0.2
        if bad:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["awful", "rottenish", "rottenly", "rottener"]))
        rows.append((i, " ".join(words), 1.0, 2, "x"))
        labels.append((i, int(bad)))
    rows += [(n, "You are AWFUL!!", 0.0, 0, "x"), (n + 1, None, 0.0, 0, "x"), (n + 2, "", 0.0, 0, "x"), (None, "tree", 0.0, 0, "x"), (0, rows[0][1], 1.0, 2, "x")]
    labels += [(0, None), (None, 1), (1, labels[1][1]), (10**9, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic int, _features string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels[:n])


def test_toxicity_of_held_out_rows(spark):
    docs, labels, truth = labelled_corpus(spark)
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_toxicity_without_both_classes_and_without_rows(spark):
    docs, labels, _ = labelled_corpus(spark, 40, with_bad=False)
    assert {r["predicted"] for r in toxicity.score_documents(docs, labels.where("doc_id < 40")).collect()} == {0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    none = toxicity.score_documents(docs, labels.limit(0))
    assert none.count() == docs.count()
    kept = toxicity.without_toxic(docs, labels.where("doc_id < 40"))
    assert kept.columns == docs.columns and kept.count() == docs.count()


# -- nearest neighbours ------------------------------------------------------


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int, block int")


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in rows:
        if q in queries:
            found = sorted((math.dist(v, w), i) for i, w in rows if i != q)
            out[q] = [(i, d) for d, i in found[:k]]
    return out


def test_factor_one_is_exact_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(700)]
    good += [(1000 + i, good[3][1]) for i in range(300)]  # a third alike
    bad = [(5000, None), (5001, [0.0] * 6), (5002, [1.0, None] + [0.0] * 4), (5003, [float("nan")] * 6), (5004, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    df = vectors_of(spark, good + bad)
    for shard, block in ((16_384, 4096), (150, 3)):
        got = vp_trees.nearest(df, F.col("vec_id") % 100 == 0, relax=1.0, shard=shard, block=block)
        found = {}
        for r in got.orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
            assert r["rank"] == len(found[r["query_id"]])
        expected = brute_nearest(good, {i for i, _ in good if i % 100 == 0}, 10)
        assert found.keys() == expected.keys()
        for q, near in expected.items():
            assert [i for i, _ in found[q]] == [i for i, _ in near]
            assert np.allclose([d for _, d in found[q]], [d for _, d in near], rtol=0, atol=1e-12)


def test_queries_far_from_all_others_find_their_nearest(spark):
    """Where distances hardly differ beside their size, a raised bound skips the nearest."""
    rng = np.random.default_rng(8)
    places = rng.normal(size=(3000, 8))
    places[::100] *= 40
    places[1::2] += 1e4  # a second cluster, where rounding is coarser
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(places)]
    found = {}
    for r in vp_trees.nearest(vectors_of(spark, rows), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    expected = brute_nearest(rows, set(range(0, 3000, 100)), 10)
    assert found == {q: [i for i, _ in near] for q, near in expected.items()}


def test_few_candidates_and_no_rows(spark):
    df = vectors_of(spark, [(0, [1.0]), (100, [3.0]), (7, [2.0])])
    got = vp_trees.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 7), (0, 100), (100, 7), (100, 0)]
    assert vp_trees.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_recall_with_production_parameters(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows])
    found = {}
    for r in QUERIES["op3_vp_nearest"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        away = np.sqrt(((points - points[q]) ** 2).sum(1))
        away[q] = np.inf
        hits += len(found[ids[q]] & set(ids[np.lexsort((ids, away))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(found) and len(found) == (ids % 100 == 0).sum()
