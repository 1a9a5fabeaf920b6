"""Results known for the small inline inputs."""

from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldo.operators import balance, chains, dedup, keys, lookup, pricing
from saldo.sources.tables import inline_rows


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def test_daily_balance(spark):
    schema = "point short, date date, amount decimal(10,4)"
    income = inline_rows(spark, [
        (1, day("2019-07-08"), 100), (1, day("2019-07-09"), 200), (2, day("2019-07-08"), 500),
        (2, day("2019-07-10"), 1000), (3, day("2019-07-10"), 5000), (3, day("2019-07-10"), 7000),
    ], "point int, date date, amount int").selectExpr(
        "cast(point as short) point", "date", "cast(amount as decimal(10,4)) amount")
    outcome = inline_rows(spark, [
        (1, day("2019-07-08"), 50), (1, day("2019-07-09"), 100), (2, day("2019-07-08"), 250),
        (2, day("2019-07-10"), 500), (3, day("2019-07-10"), 4000), (3, day("2019-07-10"), 5000),
    ], "point int, date date, amount int").selectExpr(
        "cast(point as short) point", "date", "cast(amount as decimal(10,4)) amount")
    assert income.schema.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',').replace('short', 'smallint')}>"
    got = rows(balance.daily_balance(income, outcome, "point", "date", "amount"))
    assert [(p, d.isoformat(), int(b)) for p, d, b in got] == [
        (1, "2019-07-08", 50), (1, "2019-07-09", 150), (2, "2019-07-08", 250),
        (2, "2019-07-10", 750), (3, "2019-07-10", 3000),
    ]


def test_signed_stats(spark):
    amounts = inline_rows(
        spark, [(500,), (300,), (100,), (-200,), (100,), (300,), (-200,), (-100,)], "amount int"
    ).selectExpr("cast(amount as decimal(3,0)) amount")
    got = balance.signed_stats(amounts, "amount").first()
    assert [int(v) for v in got] == [-200, 500, 800, 1300, -500, 5]


def test_dated_duplicates_keep_the_newest(spark):
    data = inline_rows(spark, [
        (1, day("2019-07-08"), 1), (1, day("2019-07-09"), 2), (2, day("2019-07-08"), 3),
        (2, day("2019-07-10"), 4), (3, day("2019-07-10"), 5), (3, day("2019-07-10"), 6),
    ], "n int, dt date, id int")
    want = [(1, day("2019-07-09"), 2), (2, day("2019-07-10"), 4), (3, day("2019-07-10"), 6)]
    assert rows(dedup.keep_latest(data, ["n"], ["dt", "id"])) == want
    assert rows(dedup.drop_superseded(data, ["n"], ["dt", "id"])) == want
    assert [r[2] for r in rows(dedup.superseded(data, ["n"], ["dt", "id"]))] == [1, 3, 5]


def test_null_keys_and_dates_are_one_group(spark):
    data = inline_rows(spark, [(None, None, 1), (None, day("2019-07-09"), 2), (1, None, 3)],
                       "n int, dt date, id int")
    want = {2, 3}
    assert {r[2] for r in dedup.keep_latest(data, ["n"], ["dt", "id"]).collect()} == want
    assert {r[2] for r in dedup.drop_superseded(data, ["n"], ["dt", "id"]).collect()} == want


def test_exact_duplicates(spark):
    data = inline_rows(spark, [
        (1, "AAA", 2, day("2020-10-11")), (2, "BBB", 0, day("2020-10-10")),
        (2, "BBB", 0, day("2020-10-10")), (3, "CCC", 3, day("2020-10-12")),
        (4, "DDD", 1, day("2020-10-12")), (4, "DDD", 1, day("2020-10-12")),
        (4, "DDD", 1, day("2020-10-12")), (5, "EEE", 2, day("2020-10-11")),
        (6, "FFF", 1, day("2020-10-13")),
    ], "ID int, name string, property int, date date")
    assert [r[0] for r in rows(dedup.drop_exact_duplicates(data))] == [1, 2, 3, 4, 5, 6]
    copies = dedup.exact_duplicates(data).filter("copies > 1")
    assert [(r[0], r[-1]) for r in rows(copies)] == [(2, 2), (4, 3)]


def test_lookup_rules(spark):
    names = inline_rows(spark, [(1, "AAA", 1), (2, "BBB", 2), (2, "CCC", 3)],
                        "id int, name string, seq int")
    asked = inline_rows(spark, [(0,), (1,), (2,)], "id int")
    kept = lookup.lookup(asked, names, "id", "name", on_empty="keep", default="XXXX",
                         on_many="last", order=["seq"])
    assert rows(kept) == [(0, "XXXX"), (1, "AAA"), (2, "CCC")]
    scalar = lambda ids: lookup.lookup(asked.filter(F.col("id").isin(ids)), names, "id", "name",
                                       on_empty="null", on_many="error")
    assert [tuple(r) for r in scalar([0, 1]).orderBy("id").collect()] == [(0, None), (1, "AAA")]
    with pytest.raises(PySparkException, match="several rows for key 2"):
        scalar([2]).collect()


EDGES = [
    (111, 555, "2020-01-09"), (222, 223, "2020-02-10"), (333, 334, "2020-03-11"),
    (444, 222, "2020-04-12"), (555, 666, "2020-05-12"), (666, 777, "2020-06-13"),
    (777, 888, "2020-07-14"), (888, 0, "2020-08-15"), (999, 333, "2020-09-16"),
    (223, 111, "2020-10-16"),
]


def edges(spark, data=EDGES):
    return inline_rows(spark, [(a, b, day(d)) for a, b, d in data],
                       "old_card int, new_card int, dt date")


def test_card_change(spark):
    cards = inline_rows(spark, [(e[0],) for e in EDGES] + [(12345,)], "card int")
    got = {r["card"]: r for r in chains.change_decision(cards, edges(spark)).collect()}
    held = {c: r["next_date"].isoformat() for c, r in got.items() if not r["allowed"]}
    assert held == {111: "2021-01-09", 222: "2021-02-10", 223: "2021-10-16", 444: "2021-04-12"}
    assert all(r["next_date"] is None for r in got.values() if r["allowed"])
    assert got[12345]["allowed"]


def test_card_change_with_two_chains(spark):
    two = edges(spark, EDGES + [(111, 555, "2020-03-03")])
    cards = inline_rows(spark, [(111,)], "card int")
    with pytest.raises(PySparkException, match="several chains from card 111"):
        chains.change_decision(cards, two).collect()
    first = chains.change_decision(cards, two, on_many="first").first()
    assert first["next_date"].isoformat() == "2021-01-09"


def test_chain_closure_and_cycles(spark):
    got = {r["card"]: (r["length"], r["last_card"], r["cyclic"])
           for r in chains.chain_closure(edges(spark)).collect()}
    assert got[444] == (8, 0, False) and got[888] == (1, 0, False) and got[999] == (2, 334, False)
    ring = [(1, 2, "2020-01-01"), (2, 3, "2020-01-02"), (3, 1, "2020-01-03"),
            (9, 1, "2020-01-04"), (7, 8, "2020-01-05")]
    got = {r["card"]: (r["length"], r["last_card"], r["cyclic"])
           for r in chains.chain_closure(edges(spark, ring)).collect()}
    assert got == {1: (None, None, True), 2: (None, None, True), 3: (None, None, True),
                   9: (None, None, True), 7: (1, 8, False)}


def test_closure_rounds_follow_the_longest_chain(spark, monkeypatch):
    """Rings, tails into rings, single loops and chains among many cards: log2(longest chain) + 2 rounds."""
    links = {i: i + 1 for i in range(100, 113)} | {200: 200} | {300 + i: 300 + (i + 1) % 12 for i in range(12)}
    links |= {400: 401, 401: 402, 402: 305, 500: 501, 501: 500, 1: 300, 2: 1, 3: 500, 4: 200}
    links |= {i: -1 for i in range(1000, 6000)}
    rounds = []
    fresh = chains.scratch_path
    monkeypatch.setattr(chains, "scratch_path", lambda spark, name: (rounds.append(name), fresh(spark, name))[1])
    rows = spark.createDataFrame(list(links.items()), "old_card long, new_card long")
    got = {r["card"]: (r["length"], r["last_card"], r["cyclic"]) for r in chains.chain_closure(rows).collect()}
    want = {}
    for card in links:
        at, seen = card, []
        while at in links and at not in seen:
            seen.append(at)
            at = links[at]
        want[card] = (None, None, True) if at in links else (len(seen), at, False)
    assert got == want
    assert len(rounds) - 1 <= math.ceil(math.log2(15)) + 2  # the first is the links as given


def test_every_row_gets_the_price_of_its_own_moment(spark):
    changes = [("a", 5, "2024-01-31 23:59:59", 1), ("a", 6, "2024-02-01 00:00:00", 2), ("a", 7, "2024-02-01 10:00:30", 3),
               ("a", 8, "2024-02-01 10:00:30", 4), ("a", 9, "2024-04-02 09:00:00", 5), ("b", 1, "2024-02-01 10:00:00", 6),
               (None, 3, "2024-01-01 00:00:00", 7), ("c", 3, None, 8)]
    prices = spark.createDataFrame(changes, "kodtov string, cena int, data string, id int").withColumn(
        "data", F.col("data").cast("timestamp_ntz"))
    moments = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-01 10:00:30", "2024-02-01 10:00:31", "2024-02-02 00:00:00",
               "2024-03-15 12:00:00", "2024-04-02 09:00:00", "2024-12-31 00:00:00", None]
    lines = spark.createDataFrame([(p, m, "keep") for p in ("a", "b", "c", None) for m in moments] * 2,
                                  "kodtov string, at string, note string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    known = sorted(((k, d, i, c) for k, c, d, i in changes if k and d), key=lambda x: (x[1], x[2]))

    def at(product, rule):
        now = [x for x in known if x[0] == product and rule(x[1])]
        before = [x for x in now if x[1][:10] < now[-1][1][:10]] if now else []
        return (now[-1][3] if now else None, before[-1][3] if before else None)

    for function, rule in ((pricing.prices_before, lambda m: lambda d: d < m), (pricing.prices_effective, lambda m: lambda d: d[:10] < m[:10])):
        got = function(lines, prices, "at").select("kodtov", F.col("at").cast("string"), "price", "previous_price", "note").collect()
        want = [(p, m, *(at(p, rule(m)) if p and m else (None, None)), "keep") for p in ("a", "b", "c", None) for m in moments] * 2
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_new_ids_go_on(spark):
    old = inline_rows(spark, [(1,), (2,)], "id int")
    new = inline_rows(spark, [("CCC",), ("DDD",), ("BBB",)], "name string")
    assert rows(keys.assign_ids(old, new, ["name"])) == [("BBB", 3), ("CCC", 4), ("DDD", 5)]
    none = spark.createDataFrame([], "id int")
    assert [r[1] for r in rows(keys.assign_ids(none, new, ["name"]))] == [1, 2, 3]
