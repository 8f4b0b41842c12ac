"""Hexadecimal text travels through a shuffle as bytes and comes back as it was."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.packing import PACKED, pack_hex, unpack_hex
from sparkmart.operators.merge import KeyedTable, hash_bucket

SCHEMA = "id bigint, lsn string, seqval string, is_deleted boolean"
WIDTHS = (("lsn", 4), ("seqval", 6))
ODD = [
    (1, "00ff", "0a0b0c", False), (2, "00FF", "0a0b0c", False), (3, "0ff", "0a0b0c0", False),
    (4, "00ff\n", "0a0b0", True), (5, None, "0a0b0c", False), (6, "00ff", None, True),
    (7, "", "", None), (8, "zzzz", "0a0b0c", False), (9, "00ff0a", "0b0c", False), (None, None, None, None),
]


def test_packed_text_comes_back_as_it_was(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    packed = pack_hex(df, WIDTHS)
    assert [r["id"] for r in packed.where(F.col(PACKED).isNotNull()).collect()] == [1]
    assert packed.where("id = 1").select("lsn", "seqval", F.length(PACKED)).first() == (None, None, 5)
    back = unpack_hex(packed, WIDTHS)
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(ODD, key=repr)


def test_tables_shuffle_versions_and_positions_as_bytes(spark, table):
    keyed = KeyedTable(
        table(), T.StructType.fromDDL(SCHEMA), ("id",), hash_bucket(["id"], 4), rows_per_file=2, hex_widths=WIDTHS
    )
    rows = spark.createDataFrame([r for r in ODD if r[0] is not None], SCHEMA)
    keyed.replace(rows)
    assert sorted(map(tuple, keyed.read(spark).drop("bucket").collect())) == sorted(r for r in ODD if r[0])
    # The newest text wins, whether it was packed or not.
    newer = [(1, "00fe", "ffffff", False), (2, "00fg", "000000", False), (8, "00ff", "0a0b0c", False)]
    keyed.upsert(spark.createDataFrame(newer, SCHEMA))
    stored = {r["id"]: (r["lsn"], r["seqval"]) for r in keyed.read(spark).collect()}
    assert stored[1] == ("00ff", "0a0b0c") and stored[2] == ("00fg", "000000")
    assert stored[8] == ("zzzz", "0a0b0c") and len(stored) == 9

    bucketed = keyed._bucketed(rows)
    plan = keyed._clustered(bucketed, keyed._sizes(rows))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionById" if "RepartitionById" in plan else "Repartition"):]
    assert re.search(rf"{PACKED}#\d+", below)
