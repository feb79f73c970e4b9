"""Property tests (hypothesis): load strategies are idempotent and agree where they should."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterstar.operators import load

SCHEMA = "k int, ts timestamp_ntz, v int"
KEYS = st.one_of(st.none(), st.integers(0, 4))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 5), st.integers(0, 3)), max_size=8)
PROP = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    day = lambda d: dt.datetime(2020, 1, 1 + d)
    return spark.createDataFrame([(k, day(d), v) for k, d, v in rows], SCHEMA)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@PROP
@given(ROWS, ROWS)
def test_insert_new_is_idempotent(spark, t, s):
    tgt, src = frame(spark, t), frame(spark, s)
    once = load.insert_new(tgt, src, ["k"])
    twice = load.insert_new(once, src, ["k"])
    non_null_src = src.where("k IS NOT NULL")
    # re-running adds only rows with NULL keys again (NULL never matches, as in MERGE)
    assert bag(load.insert_new(once, non_null_src, ["k"])) == bag(once)
    assert twice.count() == once.count() + src.where("k IS NULL").count()


@PROP
@given(ROWS, ROWS)
def test_upsert_and_delete_insert_are_idempotent(spark, t, s):
    tgt, src = frame(spark, t), frame(spark, s)
    order = ["ts", "v"]
    keyed = src.where("k IS NOT NULL")
    up = load.upsert(tgt, keyed, ["k"], order=order)
    assert bag(load.upsert(up, keyed, ["k"], order=order)) == bag(up)
    # a NULL key never matches (as in MERGE): each run inserts the NULL-key source row again
    with_null = load.upsert(tgt, src, ["k"], order=order)
    rerun = load.upsert(with_null, src, ["k"], order=order)
    assert rerun.count() == with_null.count() + src.where("k IS NULL").count()
    src_unique = src.dropDuplicates(["k"]).where("k IS NOT NULL")
    di = load.delete_insert(tgt, src_unique, ["k"])
    assert bag(load.delete_insert(di, src_unique, ["k"])) == bag(di)
    assert bag(load.upsert(tgt, src_unique, ["k"], order=order)) == bag(di)


@PROP
@given(ROWS, ROWS, st.integers(0, 5), st.integers(0, 5))
def test_replace_interval_is_idempotent_and_confined(spark, t, s, a, b):
    lo, hi = sorted((a, b))
    start, end = f"2020-01-{1 + lo:02d}", f"2020-01-{1 + hi:02d}"
    tgt, src = frame(spark, t), frame(spark, s)
    once = load.replace_interval(tgt, src, "ts", start, end)
    assert bag(load.replace_interval(once, src, "ts", start, end)) == bag(once)
    outside = "NOT (ts >= '{0}' AND ts < '{1}')".format(start, end)
    assert bag(once.where(outside)) == bag(tgt.where(outside))
