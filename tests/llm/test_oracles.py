"""The SQL of op8, op9 and op10 against plain restatements, on odd rows and on the smallest driver tables."""

import random

import brute
import duckdb
import pytest

from boxwright.llm import oracles

BASE = " ".join(f"tok{i * 7919 % 1009}" for i in range(120))
ODD = [(0, None), (1, ""), (2, " \n\t "), (3, BASE), (3, BASE + " more"), (4, BASE), (5, "x" * 700), (6, "é👍 ñ　— " * 40), (7, "a " * 300), (None, "no id " + BASE), (8, "Tail " + BASE[60:500])]
ITEMS = [(1, " ".join(BASE.split()[10:40]).upper()), (2, "no ID"), (3, None), (4, ""), (5, "é👍 ñ")]


def tables(docs, items):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark(item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    return con


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("odd", [True, False])
def test_sql_says_what_the_contract_says(sf_dir, odd):
    if odd:
        docs, items = list(ODD), ITEMS
        random.Random(1).shuffle(docs)
    else:
        docs, items = (duckdb.sql(f"SELECT {c}, text FROM '{sf_dir}/{t}.parquet'").fetchall() for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    con = tables(docs, items)
    assert ordered(con.execute(oracles.BYTE_REPEATS).fetchall()) == ordered(brute.op8(docs))
    assert ordered(con.execute(oracles.WORD_REPEATS).fetchall()) == ordered(brute.op9(brute.order(docs)))
    assert ordered(con.execute(oracles.DECONTAMINATION).fetchall()) == ordered(brute.op10(docs, items))
