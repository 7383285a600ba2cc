"""Near duplicates, components and decontamination against brute force."""

import random
from collections import defaultdict

import pytest

from gaitmill.llm import components as comp
from gaitmill.llm import decontaminate, omh_dedup

SCHEMA = "doc_id long, text string, _node string, u int, root long, class_id int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)


def classes(spark, rows):
    got = omh_dedup.near_duplicate_classes(docs_of(spark, rows)).collect()
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["class_id"], r["class_size"]) for r in got)


def edited(draw, words, edits):
    out = list(words)
    for _ in range(edits):
        at, what = draw.randrange(len(out)), draw.randrange(3)
        if what == 0:
            out[at] = f"new{draw.randrange(10**6)}"
        elif what == 1:
            out.insert(at, f"new{draw.randrange(10**6)}")
        else:
            del out[at]
    return out


@pytest.fixture(scope="module")
def corpus():
    """Copies with few and many edits, a passage in most texts, one large group."""
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(60):
        base = [word() for _ in range(draw.randint(20, 300))]
        rows.append(base)
        for _ in range(draw.randrange(3)):
            rows.append(edited(draw, base, draw.randint(0, len(base) // 12)))
    for _ in range(120):
        rows.append(passage + [word() for _ in range(draw.randint(10, 80))])
    base = [word() for _ in range(200)]
    rows += [edited(draw, base, draw.randint(1, 2)) for _ in range(80)]
    texts = [" ".join(r) for r in rows]
    texts += texts[:5] + ["", "", None, "one two", "One  two", "one two three"]
    draw.shuffle(texts)
    return list(enumerate(texts))


def brute_classes(rows):
    kmers = {i: omh_dedup.labelled_kmers(t or "") for i, t in rows}
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    texts = dict(rows)
    for i, _ in rows:
        for j, _ in rows[:i]:
            same = (texts[i] or "") == (texts[j] or "")
            if same or omh_dedup.aligned_similarity(kmers[i], kmers[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    root = {i: find(i) for i, _ in rows}
    size = defaultdict(int)
    for r in root.values():
        size[r] += 1
    return [(i, root[i], size[root[i]]) for i, _ in rows]


def test_classes_are_those_of_brute_force(spark, corpus):
    assert classes(spark, corpus) == brute_classes(corpus)


def test_large_buckets_lose_no_class(spark, corpus, monkeypatch):
    monkeypatch.setattr(omh_dedup, "SMALL", 4)
    assert classes(spark, corpus) == brute_classes(corpus)


def test_near_copies_inside_a_large_family(spark):
    """Pairs of similarity 0.81 in a family of 0.78: none is lost, nothing else is linked."""
    draw = random.Random(12)
    word = lambda: f"w{draw.randrange(10**9)}"
    base, rows = [word() for _ in range(90)], []
    for i in range(1500):
        own = [word() for _ in range(12)]
        rows.append((2 * i, " ".join(base + own)))
        if i % 15 == 0:
            rows.append((2 * i + 1, " ".join(base + own[:2] + [word() for _ in range(10)])))
    assert classes(spark, rows) == [(i, i - i % 2, 1 + (i % 30 < 2)) for i, _ in rows]


def test_a_large_family_is_not_joined_pair_by_pair(spark, monkeypatch):
    """Copies of one text, edited a little: those near it link the rest, so few pairs are left."""
    draw = random.Random(6)
    base = [f"w{draw.randrange(10**9)}" for _ in range(170)]
    texts = [" ".join(edited(draw, base, draw.randint(0, 5))) for _ in range(400)]
    rows, judged, verified = list(enumerate(texts)), [], omh_dedup.verified

    def counting(pairs, texts):
        judged.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(omh_dedup, "SMALL", 4)
    monkeypatch.setattr(omh_dedup, "verified", counting)
    assert classes(spark, rows) == brute_classes(rows)
    assert sum(judged[1:]) < 8 * len(rows)


def test_one_shared_bucket_is_enough(spark):
    keys = [list(range(i * 1000, i * 1000 + omh_dedup.TABLES)) for i in range(2)]
    keys[1][0] = keys[0][0]
    sketched = spark.createDataFrame([(bytearray([i]), k) for i, k in enumerate(keys)], "node binary, keys array<long>")
    pairs, _ = omh_dedup.candidates(sketched)
    assert [(bytes(r["u"]), bytes(r["v"])) for r in pairs.collect()] == [(b"\0", b"\1")]


def test_occurrences_are_labelled(spark):
    """All labelled k-mers of a text differ, and a line three times is not fifty times."""
    line = "this very line is said over again "
    few, many = (omh_dedup.labelled_kmers(line * n) for n in (3, 50))
    assert len(set(many.tolist())) == len(many) == 50 * 7 - 4
    assert (many[: len(few)] == few).all()
    rows = [(0, line * 3), (1, line * 50), (2, line * 49 + "and an end"), (3, line * 3000)]
    assert [c for _, c, _ in classes(spark, rows)] == [0, 1, 1, 3]


def test_one_of_each_class_stays(spark, corpus):
    left = omh_dedup.without_near_duplicates(docs_of(spark, corpus))
    assert left.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    roots = {c for _, c, _ in brute_classes(corpus)}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(roots)


def test_null_keys_repeated_rows_and_no_rows(spark):
    text = "a b c d e f g h"
    assert classes(spark, [(None, text), (4, text), (4, text), (5, "x")]) == [
        (-1, 4, 3), (4, 4, 3), (4, 4, 3), (5, 5, 1)
    ]
    left = omh_dedup.without_near_duplicates(docs_of(spark, [(None, text), (4, text), (4, text), (None, "x")]))
    assert sorted(map(str, (r["doc_id"] for r in left.collect()))) == ["4", "None"]
    assert classes(spark, [(1, "x")][:0] or [(1, "x")]) == [(1, 1, 1)]
    assert omh_dedup.near_duplicate_classes(docs_of(spark, [(1, "x")]).limit(0)).count() == 0


def test_a_repeated_line_counts_as_often_as_it_comes(spark):
    """60 lines in common and 40 own words: alike. Ten lines and 60 own words: not."""
    draw = random.Random(1)
    line = "this very line is said over and over again\n"
    own = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    rows = [(i, line * 60 + own(40)) for i in range(4)] + [(i, line * 10 + own(60)) for i in range(4, 8)]
    assert [c for _, c, _ in classes(spark, rows)] == [0, 0, 0, 0, 4, 5, 6, 7]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_banded_alignment_is_the_full_one_above_the_threshold():
    draw = random.Random(8)
    for _ in range(300):
        base = [str(draw.randrange(60)) for _ in range(draw.randint(5, 60))]
        other = edited(draw, base, draw.randint(0, 4))
        a, b = (omh_dedup.labelled_kmers(" ".join(x)) for x in (base, other))
        m = longest_common(a.tolist(), b.tolist())
        full = m / max(1, len(a) + len(b) - m)
        got = omh_dedup.aligned_similarity(a, b)
        assert got == (pytest.approx(full) if full >= 0.8 else 0)


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)] + [(None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    got = comp.components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, find(x)) for x in parent)
    assert comp.components(spark.createDataFrame([], "u long, v long")).count() == 0


# -- decontamination ---------------------------------------------------------


def distance_in(item, text):
    """Smallest edit distance of ``item`` to a part of ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_contaminated_against_brute_force(spark):
    draw = random.Random(2)
    letters = "abcdefg  "
    text = lambda n: "".join(draw.choice(letters) for _ in range(n))
    items = [(i, text(draw.randint(20, 160))) for i in range(25)] + [(30, ""), (31, None), (32, "   ")]
    items += [(None, items[0][1]), (33, items[0][1]), (34, "tiny")]
    docs = []
    for i in range(120):
        said = text(draw.randint(0, 300))
        if i % 3 == 0:
            item = list(draw.choice(items[:25])[1])
            for _ in range(draw.randrange(10)):
                item[draw.randrange(len(item))] = draw.choice(["", "x", "yz"])
            said += "".join(item).upper() + "\n" + text(20)
        docs.append((i, said))
    docs += [(200, None), (201, ""), (None, items[3][1]), (202, "a TINY one")]
    df = docs_of(spark, docs)
    listed = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(str, ((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.contaminated(df, listed).collect())))
    expected = []
    for d, t in docs:
        for i, said in items:
            item = decontaminate.normalised(said)
            if item:
                found = distance_in(item, decontaminate.normalised(t))
                if found <= decontaminate.budget(len(item)):
                    expected.append(str((d, i, found)))
    assert got == sorted(expected) and len(got) > 15
    clean = decontaminate.without_contaminated(df, listed)
    bad = {e.split(",")[0][1:] for e in expected}
    assert {str(r["doc_id"]) for r in clean.collect()} == {str(d) for d, _ in docs} - bad
    assert clean.columns == df.columns
    assert decontaminate.contaminated(df, listed.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), listed).count() == 0


def test_blocks_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"item number {i} of a long list of items") for i in range(40)], "item_id long, text string")
    df = docs_of(spark, [(i, f"so item number {i} of a long list of items it is") for i in range(40)])
    once = sorted(map(tuple, decontaminate.contaminated(df, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    assert len(decontaminate.item_blocks(items)) > 2
    assert sorted(map(tuple, decontaminate.contaminated(df, items).collect())) == once


def test_spans_of_matches():
    item = decontaminate.normalised("the quick brown fox jumps over the lazy dog")
    search = decontaminate.Searcher((decontaminate.Item(1, item, 3),))
    text = "well, the quick brwn fox jumps over the lazzy dog!"
    (match,) = search.find(text)
    assert match["distance"] == 2
    assert text[match["start"] : match["end"]] == "the quick brwn fox jumps over the lazzy dog"
