import numpy as np
import pytest
from pyspark.sql import functions as F

from gaitmill.operators.quantiles import exact_quantiles
from gaitmill.operators.track import Track, attach, halo
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    """One sequence holds most rows; order values are shuffled and unevenly spaced."""
    rng = np.random.default_rng(3)
    out = []
    for key, n in ((1, 400), (2, 7), (3, 1), (None, 60)):
        at = rng.choice(10_000, size=n, replace=False)
        out += [(key, int(a), float(rng.normal()), bool(rng.random() < 0.3)) for a in at]
    return spark.createDataFrame(out, "k int, at int, v double, flag boolean").cache()


def scan(data, max_rows):
    track = Track.of(data, ["k"], ["at"], max_rows=max_rows)
    track = track.neighbours({"pv": F.col("v"), "pa": F.col("at")}, {"nv": F.col("v")})
    track = track.pause().running(
        sums={"s": F.col("flag").cast("int")},
        maxima={"m": F.when(F.col("flag"), F.col("at"))},
        totals={"n": F.lit(1)},
    )
    return track.chunked, rows(track.pause().numbered("i").result(), "k", "at")


def test_chunked_scan_equals_plain_scan(data):
    plain_chunked, plain = scan(data, 10_000)
    chunked, cut = scan(data, 50)
    assert not plain_chunked and chunked
    assert plain == cut


def test_chunked_running_with_nulls_at_the_borders(spark):
    values = [None, None, 10, 5, None, None, 7, None, 1, None, None, None, float("nan"), None, 2]
    at = [(k, i, v if v is None else float(v)) for k in (1, 2) for i, v in enumerate(values)]
    df = spark.createDataFrame([(k, i, v) for k, i, v in at] + [(3, i, None) for i in range(7)], "k int, at int, v double")

    def scanned(max_rows):
        track = Track.of(df, ["k"], ["at"], max_rows=max_rows).neighbours({"p": F.col("v")}, {"x": F.col("v")})
        track = track.running(sums={"s": F.col("v")}, maxima={"m": F.col("v")}, totals={"t": F.col("v")})
        return track.chunked, str(rows(track.result(), "k", "at"))

    plain = scanned(100)
    for limit in (1, 2, 3, 4):
        assert scanned(limit) == (True, plain[1])


def test_chunks_by_position(data):
    numbered = Track.of(data, ["k"], ["at"]).numbered("i").result()
    by_page = Track.of(numbered, ["k"], ["i"], max_rows=33, position="i")
    got = rows(by_page.neighbours({"pv": F.col("v")}).result(), "k", "i")
    want = rows(Track.of(numbered, ["k"], ["i"]).neighbours({"pv": F.col("v")}).result(), "k", "i")
    assert by_page.chunked and got == want


def test_no_keys(data):
    plain = Track.of(data.select("at", "v"), [], ["at", "v"]).numbered("i").result()
    cut = Track.of(data.select("at", "v"), [], ["at", "v"], max_rows=60).numbered("i").result()
    assert rows(plain, "i") == rows(cut, "i")


@pytest.mark.parametrize("by", [["k"], []])
def test_ranked_quantiles_equal_builtin(data, by):
    ps = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    some = data.withColumn("v", F.round("v", 1))
    small = rows(exact_quantiles(some, by, "v", ps), *by)
    large = rows(exact_quantiles(some, by, "v", ps, max_values=30), *by)
    assert len(small) == len(large)
    for a, b in zip(small, large):
        assert a[:-1] == b[:-1]
        np.testing.assert_allclose(a[-1], b[-1])


def test_ranked_quantiles_with_nulls_and_infinities(spark):
    values = [None, 1.0, float("inf"), None, -3.0, 2.5, 2.5, float("-inf"), float("inf"), 0.0, None]
    df = spark.createDataFrame([(k, v) for k in (1, 2) for v in values] + [(3, None)], "k int, v double")
    ps = [0.0, 0.2, 0.5, 0.75, 1.0]
    plain = str(rows(exact_quantiles(df, ["k"], "v", ps), "k"))
    assert str(rows(exact_quantiles(df, ["k"], "v", ps, max_values=2), "k")) == plain


def test_scan_is_the_same_at_every_size(spark):
    from gaitmill.operators import stats
    from gaitmill.plans.tables import EVENTS_AT, events

    frames = events(spark, "/root/testdata/sf0.001")
    plain = stats.scan_recordings(frames, EVENTS_AT)
    cut = stats.scan_recordings(frames, EVENTS_AT, max_rows=7)
    keys = list(EVENTS_AT.keys)
    for a, b in zip(rows(plain.select(*sorted(plain.columns)), *keys), rows(cut.select(*sorted(plain.columns)), *keys), strict=True):
        assert [x if not isinstance(x, float) else round(x, 9) for x in a] == [
            x if not isinstance(x, float) else round(x, 9) for x in b
        ]


def test_halo_and_attach(data):
    numbered = Track.of(data.where("k is not null"), ["k"], ["at"]).numbered("i").result()
    paged, w, own = halo(numbered, ["k"], "i", 2, page_rows=10)
    got = paged.withColumns({"a": F.lag("v", 2).over(w), "b": F.lead("v", 1).over(w)}).where(own)
    plain = Track.of(numbered, ["k"], ["i"])
    want = numbered.withColumns(
        {"a": F.lag("v", 2).over(plain.window()), "b": F.lead("v", 1).over(plain.window())}
    )
    assert rows(got.select(*want.columns), "k", "i") == rows(want, "k", "i")

    sizes = numbered.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = attach(numbered, sizes, ["k"], "i", "n", page_rows=9)
    assert joined.count() == numbered.count()
    assert joined.select("k", "n").distinct().count() == 3
