"""Token ids, counts with the digest cache, and packing, against the libraries."""

import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaitmill.llm import bpe, packing, token_counts
from gaitmill.llm.tables import BPE_JSON, BPE_RANKS, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, _text string, digest int, n_tokens int"
TEXTS = [
    "a plain text of words", "", None, "two  spaces and\ttab", "\n\nbreaks \n mixed\n", " led",
    "don't they'll we're 123 4,5!", "say <|endoftext|> now", "日本語 und Straße ñandú", "x" * 70_000,
    "a plain text of words", "trail ", " wide space", "emoji 🙂 ok",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path(BPE_JSON))


@pytest.fixture(scope="module")
def fast():
    return bpe.wordwise(tokenizer_path(BPE_JSON), tokenizer_path(BPE_RANKS))


def ids(whole, text):
    return whole.encode(text, add_special_tokens=False).ids


PARTS = st.sampled_from(
    ["a", "the", " ", "  ", "\n", "\t", "ß", "é", "'s", "9", ".", "!", "<|endoftext|>", "日", "\xa0", "_"]
)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(PARTS, max_size=30).map("".join)))
def test_ids_are_those_of_the_tokenizer(text):
    fast = bpe.wordwise(tokenizer_path(BPE_JSON), tokenizer_path(BPE_RANKS))
    assert array("I", fast.packed(text)).tolist() == ids(fast.whole, text)


def test_store_starts_anew(fast, whole, monkeypatch):
    monkeypatch.setattr(bpe, "STORE", 5)
    text = "one two three four five six seven eight nine ten one two"
    assert array("I", fast.packed(text)).tolist() == ids(whole, text)
    assert len(fast) <= 5


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "other", 1, 2) for i, t in enumerate(texts)], SCHEMA)


def counts(spark, docs, cache, **more):
    return token_counts.count_tokens(docs, tokenizer_path(BPE_JSON), cache, ranks=tokenizer_path(BPE_RANKS), **more)


def test_counts_and_cache(spark, whole):
    cache = token_counts.new_cache(spark)
    docs = docs_of(spark, TEXTS)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in counts(spark, docs, cache).collect()}
    assert got == {i: (len((t or "").encode()), len(ids(whole, t or ""))) for i, t in enumerate(TEXTS)}
    stored = token_counts.read_cache(spark, cache).count()
    assert stored == len({t or "" for t in TEXTS})
    more = docs_of(spark, ["trail ", "a new one"])
    assert [r["n_tokens"] for r in counts(spark, more, cache).orderBy("doc_id").collect()] == [
        len(ids(whole, "trail ")), len(ids(whole, "a new one"))
    ]
    assert token_counts.read_cache(spark, cache).count() == stored + 1


def test_stored_counts_are_used(spark):
    cache = token_counts.new_cache(spark)
    docs = docs_of(spark, ["known"])
    version = token_counts.tokenizer_version(tokenizer_path(BPE_JSON))
    known = docs.selectExpr(f"'{version}' version", "unhex(md5(text)) digest", "77L n_tokens")
    known.write.parquet(cache)
    assert counts(spark, docs, cache).first()["n_tokens"] == 77


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(None, "x y", "", "", 0, 0)] * 3 + [(1, None, "", "", 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = counts(spark, docs, token_counts.new_cache(spark))
    assert sorted(r["n_tokens"] for r in got.collect()) == [0, 2, 2, 2]
    assert counts(spark, docs.limit(0), token_counts.new_cache(spark)).count() == 0


def test_other_libraries(spark):
    import sentencepiece

    docs, path = docs_of(spark, ["some words here", None]), tokenizer_path("piece_bpe_32k.model")
    got = token_counts.count_tokens(docs, path, token_counts.new_cache(spark)).orderBy("doc_id").collect()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [r["n_tokens"] for r in got] == [len(model.encode("some words here")), 0]


# -- packing -----------------------------------------------------------------


def check_packed(rows, texts, whole, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(range(len(texts)))
    for doc, text in enumerate(texts):
        full, at = array("I", [*ids(whole, text or ""), 0]), 0
        for number, r in enumerate(sorted(by_doc[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (number, at)
            assert r["ids_crc32"] == zlib.crc32(full[at : at + r["length"]].tobytes())
            assert number == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(full)
        assert len(by_doc[doc]) == -(-len(full) // capacity)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_documents(spark, whole):
    texts = TEXTS + ["same words"] * 40
    packed = packing.pack_documents(docs_of(spark, texts), tokenizer_path(BPE_JSON), tokenizer_path(BPE_RANKS), 16)
    check_packed(packed.collect(), texts, whole, 16)


def test_packing_of_nothing_and_of_repeated_rows(spark):
    docs = docs_of(spark, ["word"])
    args = (tokenizer_path(BPE_JSON), tokenizer_path(BPE_RANKS), 8)
    assert packing.pack_documents(docs.limit(0), *args).count() == 0
    rows = packing.pack_documents(docs.union(docs).union(docs), *args).collect()
    assert sorted(r["offset"] for r in rows) == [0, 2, 4]


def fewest(lengths, capacity):
    """Fewest bins by trying everything."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[k] >= lengths[i]:
                place(i + 1, [r - lengths[i] if j == k else r for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_dominance_keeps_the_optimum():
    draw = random.Random(5)
    for _ in range(300):
        capacity = draw.randint(5, 30)
        lengths = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 9))), reverse=True)
        counts = {s: lengths.count(s) for s in set(lengths)}
        sizes = packing.Sizes(dict(counts))
        fixed = packing.reduce_by_dominance(sizes, capacity)
        rest = [s for s in sorted(sizes.left, reverse=True) for _ in range(sizes.count[s])]
        bins = sum(n for _, n in fixed)
        assert bins + (fewest(rest, capacity) if rest else 0) == fewest(lengths, capacity)
        assert all(sum(items) <= capacity for items, _ in fixed)
        packed = bins + sum(n for _, n in packing.best_fit(sizes, capacity))
        assert packed <= 11 / 9 * fewest(lengths, capacity) + 1


def test_plan_places_every_rank_once():
    draw = random.Random(6)
    for _ in range(50):
        counts = {draw.randint(1, 40): draw.randint(1, 60) for _ in range(draw.randint(1, 20))}
        plan = packing.packing_plan(counts, 40)
        used, fill = defaultdict(int), defaultdict(int)
        for size, first, copies, sequence, _offset in plan.tolist():
            assert first == used[size]
            later = [f for s, f, *_ in plan.tolist() if s == size and f > first]
            n = min(later, default=counts[size]) - first
            used[size] += n
            for r in range(n):
                fill[sequence + r // copies] += size
        assert used == counts and max(fill.values()) <= 40
