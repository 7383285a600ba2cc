"""Ring sharding and chat formatting against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaitmill.llm import chat, ring_sharding
from gaitmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, shard int, slot long, _arc int, size string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in rows], SCHEMA)


def by_shard(rows):
    found = defaultdict(list)
    for r in rows:
        found[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in found.values())
    return {s: len(v) for s, v in found.items()}


def test_counts_slots_and_digests(spark):
    rows = [(i, "ä" * (i % 7) if i % 5 else None) for i in range(1003)]
    got = ring_sharding.shard_documents(docs_of(spark, rows), 16).collect()
    sizes = by_shard(got)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) == 1
    texts = dict(rows)
    assert len({r["doc_id"] for r in got}) == 1003
    for r in got:
        content = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(content) + 1, zlib.crc32(content))


def test_one_key_with_a_third_of_the_rows(spark):
    rows = [(7, "same")] * 400 + [(None, "a")] * 50 + [(i, str(i)) for i in range(800)]
    sizes = by_shard(ring_sharding.shard_documents(docs_of(spark, rows), 4).collect())
    assert sorted(sizes.values()) == [312, 312, 313, 313]


def test_no_rows_and_fewer_rows_than_shards(spark):
    assert ring_sharding.shard_documents(docs_of(spark, [(1, "a")]).limit(0), 16).count() == 0
    assert by_shard(ring_sharding.shard_documents(docs_of(spark, [(1, "a"), (2, "b")]), 16).collect()).keys() <= set(range(16))


def test_arcs_and_bounded_walk_are_those_of_a_sequential_ring(spark):
    points = ring_sharding.ring(spark, 5, 8)
    docs = docs_of(spark, [(i, "t") for i in range(500)])
    arcs = ring_sharding.with_arc(docs.select("doc_id"), "doc_id", points)
    hashed = arcs.select("_arc", F.xxhash64("doc_id").alias("h")).collect()
    for r in hashed:
        expected = next((i for i, p in enumerate(points) if p.place >= r["h"]), 0)
        assert r["_arc"] == expected
    counts = Counter(r["_arc"] for r in hashed)
    for slack in (0.0, 0.25):
        bounds = ring_sharding.load_bounds(500, 5, slack)
        rows = ring_sharding.walk(points, counts, bounds)
        load = Counter()
        for arc, lo, hi, shard, slot in rows:
            assert slot == load[shard]
            load[shard] += hi - lo
        assert sum(load.values()) == 500 and all(load[s] <= b for s, b in enumerate(bounds))
        for arc, n in counts.items():
            spans = sorted((lo, hi) for a, lo, hi, *_ in rows if a == arc)
            assert spans[0][0] == 0 and spans[-1][1] == n
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_limited_movement(spark):
    docs = docs_of(spark, [(i, "t") for i in range(4000)])
    before, after = (
        {r["doc_id"]: r["shard"] for r in ring_sharding.shard_documents(docs, n, slack=0.25).collect()} for n in (8, 9)
    )
    moved = sum(before[d] != after[d] for d in before)
    assert moved < 0.45 * len(before)  # a hash modulo the count moves 8 in 9
    assert max(Counter(after.values()).values()) <= -(-4000 * 1.25 // 9)


# -- chat --------------------------------------------------------------------

SNIPPETS = st.lists(
    st.sampled_from([*chat.CONTROL, "\\", "\\\\", "<", "[", "|", "s>", "/s>", "a", "\n", "é", "<\\s>"]), max_size=12
).map("".join)


def events(spark, rows):
    return spark.createDataFrame(
        rows, "conv_id long, seq long, msg long, kind string, role string, text string, rank int, turns int"
        if len(rows[0]) == 8 else "conv_id long, seq long, msg long, kind string, role string, text string"
    )


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(SNIPPETS, SNIPPETS), min_size=1, max_size=30))
def test_escape_is_reversible(pairs):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    e = chat.escape(F.col("a"))
    got = df.select("a", e.alias("e"), chat.unescape(e).alias("back")).collect()
    for r in got:
        assert r["back"] == r["a"]
        assert not any(c in r["e"] for c in chat.CONTROL)


def test_folding(spark):
    log = [
        (1, 0, 10, "message", "user", "old question"),
        (1, 1, 11, "message", "assistant", ""),
        (1, 2, 11, "delta", None, "first "),
        (1, 3, 11, "delta", None, "answer"),
        (1, 4, 11, "regenerate", None, "ignored"),
        (1, 5, 11, "delta", None, "second"),
        (1, 7, 11, "delta", None, "!"),
        (1, 6, 11, "delta", None, " answer"),
        (1, 8, 10, "edit", None, "new question"),
        (1, 9, 99, "delta", None, "never opened"),
        (1, 9, 11, "unknown", None, "x"),
        (2, 5, 1, "message", None, None),
        (None, 1, 1, "message", "user", "no conversation"),
    ]
    messages = chat.fold_events(events(spark, log))
    got = {(r["conv_id"], r["msg"]): (r["seq"], r["role"], r["text"]) for r in messages.collect()}
    assert got == {
        (1, 10): (0, "user", "new question"),
        (1, 11): (1, "assistant", "second answer!"),
        (2, 1): (5, None, ""),
        (None, 1): (1, "user", "no conversation"),
    }
    shown = {r["conv_id"]: r for r in chat.read_back(chat.render(messages)).collect()}
    assert [(t["role"], t["text"], t["loss"]) for t in shown[1]["turns"]] == [
        ("user", "new question", False), ("assistant", "second answer!", True)
    ]
    assert [(t["role"], t["text"]) for t in shown[2]["turns"]] == [("", "")]


def test_control_strings_in_roles_texts_and_ties(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\\<|im_sep|>", "a\\", "<", "<|im_start|", ""]
    rows = [(1, 0, i, "message", f"<|im_sep|>{i}", t) for i, t in enumerate(nasty)]
    read = chat.read_back(chat.render(chat.fold_events(events(spark, rows)))).first()
    assert sorted((t["role"], t["text"]) for t in read["turns"]) == sorted((r[4], r[5]) for r in rows)


def test_empty_log(spark):
    none = events(spark, [(1, 0, 1, "message", "user", "x")]).limit(0)
    assert chat.render(chat.fold_events(none)).count() == 0


def test_query(spark):
    told = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        told[r["conv_id"]].append((r["role"], r["text"] or ""))
    told[-1] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    got = QUERIES["op10_chat_format"](spark, SF).collect()
    assert len(got) == len(told)
    for r in got:
        turns = told[r["conv_id"]]
        said = "".join(f"{a}\n{b}\n" for a, b in turns)
        learned = "".join(b for a, b in turns if a == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
