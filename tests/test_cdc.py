import random

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart.operators import cdc

LOG = "order_number string, order_line_item bigint, q bigint, op int, lsn string, seqval string"
KEYS = ["order_number", "order_line_item"]


def latest(spark, events):
    out = cdc.latest_state(spark.createDataFrame(events, LOG), KEYS)
    return rows(out, "order_number", "order_line_item", "q", "lsn", "is_deleted")


def test_last_event_wins_and_delete_is_marked(spark):
    events = [("SO-101", 1, 5, 2, "001", "01"), ("SO-101", 1, 5, 1, "002", "01")]
    assert latest(spark, events) == [("SO-101", 1, 5, "002", True)]


def test_sequence_breaks_ties_of_position(spark):
    events = [("a", 1, 1, 2, "01", "02"), ("a", 1, 2, 4, "01", "10"), ("a", 1, 3, 4, "01", "03")]
    assert latest(spark, events) == [("a", 1, 2, "01", False)]


def test_after_image_wins_over_before_image(spark):
    events = [("a", 1, 9, 4, "01", "01"), ("a", 1, 1, 3, "01", "01")]
    assert latest(spark, events) == [("a", 1, 9, "01", False)]
    assert latest(spark, [("a", 1, 1, 3, "01", "01")]) == []


def test_insert_after_delete_at_the_same_position_wins(spark):
    events = [("a", 1, 1, 1, "01", "01"), ("a", 1, 2, 2, "01", "01")]
    assert latest(spark, events) == [("a", 1, 2, "01", False)]


def test_empty_log(spark):
    assert latest(spark, []) == []


def test_latest_state_against_brute_force(spark):
    rng = random.Random(3)
    events = [
        ("hot" if rng.random() < 0.4 else f"o{rng.randrange(20)}", rng.randrange(2), i,
         rng.choice([1, 2, 4]), f"{rng.randrange(50):04x}", f"{i:06x}")
        for i in range(400)
    ]
    best = {}
    for o, line, q, op, lsn, seq in events:
        if (o, line) not in best or (lsn, seq, op) > best[o, line][0]:
            best[o, line] = ((lsn, seq, op), q)
    expected = sorted((o, n, q, k[0], k[2] == 1) for (o, n), (k, q) in best.items())
    assert latest(spark, events) == expected


snapshot = st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 2)), max_size=7)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(snapshot, snapshot)
def test_applying_the_difference_gives_the_new_snapshot(spark, old, new):
    a = spark.createDataFrame(list(old.items()), "k bigint, v bigint")
    b = spark.createDataFrame(list(new.items()), "k bigint, v bigint")
    changes = cdc.snapshot_diff(a, b, ["k"])
    assert rows(cdc.apply_changes(a, changes, ["k"])) == rows(b)
    codes = {}
    for r in changes.collect():
        codes.setdefault(r["k"], []).append(r["op"])
    for k in old.keys() | new.keys():
        if k not in new:
            expected = [cdc.DELETE]
        elif k not in old:
            expected = [cdc.INSERT]
        else:
            expected = [] if old[k] == new[k] else [cdc.BEFORE, cdc.AFTER]
        assert sorted(codes.get(k, [])) == expected


def test_cursor_starts_at_the_beginning_and_follows_the_checkpoints(spark):
    log = spark.createDataFrame([("0a",), ("ff",), ("80",)], "lsn string")
    state = cdc.no_state(spark)
    assert cdc.cursor(state, "sales") == cdc.FIRST_LSN
    state = state.unionByName(cdc.checkpoint(log.where("lsn < 'f'"), "sales", "1"))
    state = state.unionByName(cdc.checkpoint(log, "other", "1"))
    assert cdc.cursor(state, "sales") == "80"
    assert rows(cdc.read_since(log, "80")) == [("ff",)]
    nothing = cdc.checkpoint(log.where(F.lit(False)), "sales", "2")
    assert cdc.cursor(state.unionByName(nothing), "sales") == "80"


def test_binary_positions_sort_like_their_text(spark):
    lsns = [bytes([0x7F] * 10), bytes([0x80] + [0] * 9), bytes(10)]
    df = spark.createDataFrame([(b,) for b in lsns], "lsn binary")
    text = [r[0] for r in df.select(cdc.hex_lsn(F.col("lsn")).alias("l")).orderBy("l").collect()]
    assert text == [b.hex() for b in sorted(lsns)] and text[0] == cdc.FIRST_LSN
