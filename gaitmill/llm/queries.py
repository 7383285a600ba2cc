"""The operators on the given tables: ``QUERIES`` by name, ``SQL`` where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaitmill.llm import (
    chat,
    compression_quality,
    decontaminate,
    lemp_search,
    licenses,
    omh_dedup,
    packing,
    phrases,
    pii,
    ring_sharding,
    token_counts,
    toxicity,
    vp_trees,
)
from gaitmill.llm.tables import BPE_JSON, BPE_RANKS, CAPACITY, table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with a cache of its own, which is empty at first and filled by this run."""
    counts = token_counts.count_tokens(
        table(spark, sf_dir, "documents"),
        tokenizer_path(BPE_JSON),
        token_counts.new_cache(spark),
        ranks=tokenizer_path(BPE_RANKS),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"),
        tokenizer_path(BPE_JSON),
        tokenizer_path(BPE_RANKS),
        CAPACITY,
    )


@query
def op7_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds without slack: counts of the 16 shards are at most one apart."""
    return ring_sharding.shard_documents(table(spark, sf_dir, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of the table opens a message; conversation -1 is added to them."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    # A row without a turn comes first; the log needs a number.
    events = told.unionByName(added).select(
        "conv_id",
        F.coalesce("turn", F.lit(-(2**63)).cast("long")).alias("seq"),
        F.monotonically_increasing_id().alias("msg"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )
    read = chat.read_back(chat.render(chat.fold_events(events)))
    every = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(every, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CONTROL_SQL = "|".join(re.escape(c) for c in chat.CONTROL)
SQL["op10_chat_format"] = rf"""WITH t AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, length(role) + length(text)
    + length(role) - length(replace(role, '\', '')) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(role, '{CONTROL_SQL}')) + len(regexp_extract_all(text, '{CONTROL_SQL}'))
    + {sum(map(len, (chat.OPEN, chat.BETWEEN, chat.CLOSE)))} AS size FROM t),
g AS (SELECT conv_id, COUNT(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
    COALESCE(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS learned,
    CAST(SUM(size) AS BIGINT) AS formatted_chars FROM l GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars FROM g"""


@query
def op1_omh_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class (smallest doc_id) and class size of every document."""
    classes = omh_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it, within the edits allowed."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op3_vp_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of every hundredth vector among all others."""
    return vp_trees.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder for each source, language and 1024 numbers with
    folders of 64 in it. Documents that speak of a licence are licence files where their
    number is even, in the upper folder where it is a multiple of four."""
    upper = F.concat_ws("/", "source", "lang", F.expr("doc_id div 1024"))
    lower = F.concat_ws("/", upper, F.expr("doc_id div 64"))
    notice = F.lower("text").contains("licen")
    path = (
        F.when(notice & (F.col("doc_id") % 4 == 0), F.concat_ws("/", upper, F.expr("'LICENSE-' || doc_id")))
        .when(notice & (F.col("doc_id") % 2 == 0), F.concat_ws("/", lower, F.expr("'LICENSE-' || doc_id")))
        .otherwise(F.concat_ws("/", lower, F.expr("doc_id || '.txt'")))
    )
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), path=path)


@query
def op11_lemp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents of every benchmark item."""
    return lemp_search.ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).select("item_id", "rank", "doc_id", "score")


SQL["op11_lemp_search"] = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, len(w) AS n,
    unnest(list_transform(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term FROM d),
g AS (SELECT COUNT(*) AS docs, CAST(SUM(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
f AS (SELECT doc_id, n, term, COUNT(*) AS tf FROM t GROUP BY ALL),
i AS (SELECT DISTINCT item_id, unnest(list_transform(
    regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term FROM benchmark),
v AS (SELECT term, CAST(floor(1000 * ln((2 * g.docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
  FROM f, g WHERE term IN (SELECT term FROM i) GROUP BY term, g.docs),
s AS (SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf)
      // (1000 * tf + 8 * (10 + (90 * n * g.docs) // g.words)))) AS BIGINT) AS score
  FROM i JOIN v USING (term) JOIN f USING (term), g GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
    doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10""".replace(r"\\", "\\")


@query
def op12_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


SQL["op13_collocations"] = r"""WITH p AS (
  SELECT row_number() OVER () AS id, lang, piece FROM (SELECT COALESCE(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
k AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM w),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM k WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, COUNT(*) AS f FROM g GROUP BY ALL HAVING COUNT(*) >= 30),
n AS (SELECT lang, SUM(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
u AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
b AS (SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, cut,
    CAST((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score FROM u
  JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:cut], ' ')
  JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[cut + 1:u.k], ' ')),
o AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
m AS (SELECT lang, w, k, a, s, unnest(range(1, k - s + 2)) AS i FROM (
  SELECT *, unnest(range(2, k)) AS s FROM c WHERE k >= 3)),
h AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, MAX(a) AS cover FROM m GROUP BY ALL),
e AS (SELECT o.* FROM o LEFT JOIN h USING (lang, phrase)
  WHERE cover IS NULL OR 100 * cover::HUGEINT < 80 * a::HUGEINT),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT lang, rank, phrase, a, l, r.r, CAST(n AS BIGINT) AS n, score FROM r JOIN n USING (lang) WHERE rank <= 2000"""
