"""Collated e-mail identity, deletes over foreign keys, published versions."""
import datetime as dt
import graphlib

import duckdb
import pytest
from pyspark.sql import functions as F

from reelhouse.operators.cascade import cascade
from reelhouse.oracle.helpers import same_text as duck_same_text
from reelhouse.plans.warehouse import Warehouse
from reelhouse.sources.adapters import RawTables
from reelhouse.sources.schemas import RAW_USERS
from reelhouse.sources.versions import publish, published

EMAILS = ["Zoë@x.com", "zoe@X.com", "zoe@x.com  ", " zoe@x.com", "ZOÉ@x.com", "zo@x.com", "", "  ", "ß@x.com", "ss@x.com"]


def test_emails_differ_by_letters_only(spark):
    users = [(f"u{i}", e, "n", "USA", dt.datetime(2024, 1, 10 - i), 1980) for i, e in enumerate(EMAILS)]
    raw = RawTables(users=spark.createDataFrame(users, RAW_USERS), subscriptions=None, content=None, viewing_events=None)
    kept = {r.user_id: r.email for r in Warehouse(spark, raw=raw).deduplicated_users.collect()}
    # earliest of Zoë, zoe, padded zoe and ZOÉ is u4, in its own spelling; a leading space is another address
    assert kept["u4"] == "ZOÉ@x.com" and kept["u3"] == " zoe@x.com" and kept["u5"] == "zo@x.com"
    assert not {"u0", "u1", "u2"} & set(kept) and kept["u7"] == "  " and "u6" not in kept
    con = duckdb.connect()
    con.execute("CREATE TABLE e AS SELECT unnest(?) AS email", [EMAILS[:8]])
    groups = con.execute(f"SELECT count(DISTINCT {duck_same_text('email')}) FROM e").fetchone()[0]
    assert len(set(kept) & {f"u{i}" for i in range(8)}) == groups == 4


KEYS = [("b", "a_id", "a", "id"), ("c", "b_id", "b", "id"), ("c", "a_id", "a", "id")]


def _tables(spark):
    return {"a": spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "id int, v string"),
            "b": spark.createDataFrame([(10, 1), (11, 2), (12, None), (13, 99), (10, 1)], "id int, a_id int"),
            "c": spark.createDataFrame([(10, None), (11, 1), (12, 3), (None, 2), (None, None)], "b_id int, a_id int")}


def test_cascade_over_levels(spark):
    got = cascade(_tables(spark), KEYS, {"a": F.col("id") == 1})
    assert sorted(r.id for r in got["a"].collect()) == [2, 3]
    assert sorted(r.id for r in got["b"].collect()) == [11, 12, 13]           # both rows of key 10 are gone
    assert {(r.b_id, r.a_id) for r in got["c"].collect()} == {(12, 3), (None, 2), (None, None)}
    # a NULL condition deletes nothing; nothing marked leaves the tables as they are
    assert cascade(_tables(spark), KEYS, {"a": F.col("v") == "y"})["c"].count() == 5
    assert [df.count() for df in cascade(_tables(spark), KEYS, {}).values()] == [3, 5, 5]
    empty = {k: df.limit(0) for k, df in _tables(spark).items()}
    assert [df.count() for df in cascade(empty, KEYS, {"a": F.lit(True)}).values()] == [0, 0, 0]
    with pytest.raises(graphlib.CycleError):
        cascade(_tables(spark), [*KEYS, ("a", "id", "c", "b_id")], {})


def test_versions_change_together(spark, tmp_path):
    root, tables = str(tmp_path / "w"), _tables(spark)
    assert published(spark, root) == {}
    assert publish(spark, tables, root) == 1
    after = cascade(published(spark, root), KEYS, {"a": F.col("id") == 1})
    broken = after | {"c": after["c"].withColumn("x", F.raise_error(F.lit("lost")))}
    with pytest.raises(Exception, match="lost"):
        publish(spark, broken, root)
    assert [published(spark, root)[t].count() for t in "abc"] == [3, 5, 5]     # the old version, whole
    assert publish(spark, {"a": after["a"], "b": after["b"]}, root) == 2       # c keeps its place
    assert [published(spark, root)[t].count() for t in "abc"] == [2, 3, 5]
