"""Longest common prefixes and masked completions."""

import duckdb

from gridcat.llm import preference as P
from gridcat.llm import queries

from .conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def show(turns):
    return "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in turns)


def pairs(spark, chosen, rejected):
    a, b = (P.in_rows(spark.createDataFrame(x, SCHEMA)) for x in (chosen, rejected))
    return {r.conv_id: r for r in P.format_pairs(P.pair(a, b)).collect()}


def test_prefix_and_masks(spark):
    chosen = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "good"), (1, 3, "user", "more"),
              (1, 4, "assistant", "é🎉"), (2, 0, "user", "same"), (2, 1, "assistant", "x"), (3, 0, "user", "only here")]
    rejected = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"), (2, 0, "user", "same"),
                (2, 1, "assistant", "x"), (4, 0, "assistant", "only there")]
    got = pairs(spark, chosen, rejected)
    assert got[1].n_prefix == 2 and got[1].prompt == show([("system", "s"), ("user", "q")])
    assert got[1].chosen == show([("assistant", "good"), ("user", "more"), ("assistant", "é🎉")])
    assert [got[1].chosen[m.start:m.end] for m in got[1].chosen_mask] == ["good\n<|end|>\n", "é🎉\n<|end|>\n"]
    assert [got[1].rejected[m.start:m.end] for m in got[1].rejected_mask] == ["bad\n<|end|>\n"]
    assert (got[2].n_prefix, got[2].chosen, got[2].rejected, got[2].chosen_mask) == (2, "", "", [])
    assert (got[3].prompt, got[3].rejected, got[4].chosen) == ("", "", "")


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, None), (1, 5, "assistant", "b"), (1, 5, "assistant", "a"), (None, 1, "user", "u"),
            (None, 2, "assistant", "v"), (1, 5, "assistant", "a")]
    turns = P.in_rows(spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", turns string"))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in turns.collect()}
    assert got == {1: [("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")],
                   None: [("user", "u"), ("assistant", "v")]}
    both = {r.conv_id: r for r in P.format_pairs(P.stale_answers(turns)).collect()}
    assert both[1].n_prefix == 3 and both[1].rejected == show([("assistant", "a")])
    assert both[None].rejected == "" and both[None].chosen == show([("assistant", "v")])
    empty = spark.createDataFrame([], SCHEMA)
    assert P.format_pairs(P.stale_answers(P.in_rows(empty))).count() == 0
    assert P.format_pairs(P.pair(P.in_rows(empty), P.in_rows(empty))).count() == 0
    paired = pairs(spark, [(None, 1, "user", "u"), (None, 2, "assistant", "v")], [(None, 1, "user", "u")])
    assert paired[None].n_prefix == 1 and paired[None].rejected == ""


def test_op2_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF_SMALL}/conversations.parquet'")
    want = con.sql(queries.ORACLES["op2_preference"])
    got = queries.op2_preference(spark, SF_SMALL)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
