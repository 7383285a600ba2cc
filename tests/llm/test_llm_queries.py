"""The registered queries of the training-data operators on the smallest tables."""

import zlib

import duckdb
import pytest
from compare import TABLES, compare
from test_dedup_leaks import brute_classes
from test_tokens_packing import check_packed
from tokenizers import Tokenizer

import __spark_entry__ as entry
from gaitmill.llm import decontaminate
from gaitmill.llm.queries import QUERIES, SQL
from gaitmill.llm.tables import BPE_JSON, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path(BPE_JSON))


def test_names():
    numbers = sorted(int(n.split("_")[0][2:]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    text, good = compare(spark, con, SF, name)
    assert good, text


def test_near_duplicates(spark, texts):
    got = QUERIES["op1_omh_near_duplicates"](spark, SF).collect()
    assert sorted(map(tuple, got)) == brute_classes(sorted(texts.items()))


def test_token_counts(spark, texts, whole):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    n = {d: len(whole.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    assert got == {d: (len(t.encode()), n[d], n[d] > 1024) for d, t in texts.items()}


def test_decontamination(spark, texts):
    rows = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    items = {r["item_id"]: decontaminate.normalised(r["text"]) for r in rows}
    exact = {(d, i) for d, t in texts.items() for i, s in items.items() if s in decontaminate.normalised(t)}
    got = QUERIES["op4_decontamination"](spark, SF).collect()
    assert exact <= {(r["doc_id"], r["item_id"]) for r in got}
    for r in got:
        part = decontaminate.normalised(texts[r["doc_id"]])[r["start"] : r["end"]]
        assert decontaminate.Myers(items[r["item_id"]]).best(part)[0] == r["distance"]


def test_packing(spark, texts, whole):
    rows = QUERIES["op5_best_fit_packing"](spark, SF).collect()
    ordered = [texts[d] for d in range(len(texts))]
    sequences = check_packed(rows, ordered, whole, 2048)
    assert sequences <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_sharding(spark, texts):
    rows = QUERIES["op7_ring_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and {r["law"] for r in rows} == {"rows"}
    counts = {}
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]].encode()) + 1, zlib.crc32(texts[r["doc_id"]].encode()))
        counts.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(v) for v in counts.values()]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in counts.values())
