import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaitmill.functions.text import stable_hash
from gaitmill.operators import metrics as m
from gaitmill.operators.shared import must_be_empty, salted_join
from gaitmill.sources import captures as cap
from tests.conftest import rows


def test_salted_join_equals_join(spark):
    many = spark.range(500).select(F.col("id"), F.when(F.col("id") % 9 > 0, F.col("id") % 3).alias("k"))
    few = spark.createDataFrame([(0, "a"), (1, "b"), (None, "n")], "k long, v string")
    got = rows(salted_join(many, few, ["k"], "id").select("id", "v"), "id")
    want = [(r.id, "n" if r.k is None else "ab"[r.k]) for r in many.orderBy("id").collect() if r.k != 2]
    assert got == want


def test_stable_hash_matches_hashlib(spark):
    import hashlib

    got = spark.range(1).select(stable_hash(7, F.lit("motion"), F.lit(None), F.lit(-3))).first()[0]
    assert got == hashlib.sha256("\x1f".join(("7", "motion", "None", "-3")).encode()).hexdigest()


def test_must_be_empty(spark):
    must_be_empty(spark.range(0), "none", ["id"])
    with pytest.raises(ValueError, match="some"):
        must_be_empty(spark.range(3), "some", ["id"])


def test_first_rows_of_a_long_sequence(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    assert [r[1] for r in rows(m.first_rows(df, ["k"], "at", 5, pages=7).select("k", "at"), "at")] == list(range(5))


def test_alignment_config(spark, tmp_path):
    path = tmp_path / "align.json"
    path.write_text(
        json.dumps(
            {"global": {"rotation_quat_wxyz": [0.0, 0.0, 0.0, 2.0], "translation_xyz": [1, 2, 3]},
             "per_bone_delta_quat_wxyz": {"head": [1, 0, 0, 0]}},
            indent=1,
        )
    )
    align, delta, _ = cap.read_alignment(spark, str(path))
    np.testing.assert_allclose(align.rotation, np.diag([-1.0, -1.0, 1.0]), atol=1e-12)
    assert align.translation == (1.0, 2.0, 3.0) and delta == {"head": [1, 0, 0, 0]}


def test_fingerprint_depends_on_order_and_content(spark):
    df = spark.range(50).select(F.lit("t").alias("k"), "id")

    def digest(frame, **options):
        return m.fingerprint(frame, ["k"], ["id"], F.col("id").cast("string"), **options).first()[1]

    same = digest(df.repartition(7))
    assert digest(df) == same == digest(df, max_rows=10)
    assert digest(df.where("id <> 3")) != same
