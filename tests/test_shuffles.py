"""What is shuffled and written: narrow keys before wide rows, one shuffle where two were, nothing for empty targets."""
import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from saleswh.operators import commit, merge, sizing, windows
from saleswh.plans import analytics, dq_batch, learned, silver
from saleswh.sources import bridge
from test_silver import AT, HDR, ITM, header, item

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def classified(spark, items, headers):
    i, h, d0 = spark.createDataFrame(items, ITM), spark.createDataFrame(headers, HDR), silver.initial_dims(spark)
    return silver.classify_fact(i, h, silver.customer_batch(h, d0["customer"], AT).target, silver.product_batch(i, d0["product"], AT).target,
                                silver.org_batch(h, d0["organization"], AT).target, AT)


def test_a_merge_into_an_empty_table_has_no_join(spark):
    src = spark.createDataFrame([("a", 1), (None, 2), ("a", 1)], "k string, v int")
    out = merge.merge_upsert(commit.empty(spark, src.schema), src, ["k"])
    assert "Join" not in plan(out)
    assert sorted(map(str, out.collect())) == sorted(map(str, src.collect()))
    for empty in (silver.empty_fact(spark), silver.empty_quarantine(spark)):
        assert "LocalRelation <empty>" in plan(empty)


def test_written_tables_are_compressed_by_the_codec(spark, scratch):
    df = commit.materialize(spark.range(1000), "codec")
    commit.commit(spark.range(1000), f"{scratch}/t", 0)
    keyed = commit.Keyed(spark, f"{scratch}/k", "id long", ["id"], buckets=2)
    keyed.append("b0", spark.range(1000))
    for frame in (df, commit.read_table(spark, f"{scratch}/t"), keyed.read()):
        assert frame.count() == 1000 and all(f.endswith(f".{commit.CODEC}.parquet") for f in frame.inputFiles())


def test_an_append_writes_its_rows_into_the_table_only(spark, scratch, monkeypatch):
    monkeypatch.setattr(commit, "materialize", lambda *_: (_ for _ in ()).throw(AssertionError("written twice")))
    log = commit.Keyed(spark, f"{scratch}/log", "id long", ["id"], buckets=4)
    assert log.append("b0", spark.range(10)) and log.append("b1", spark.range(5)) and not log.append("b1", spark.range(5))
    assert sorted(r.id for r in log.read().collect()) == sorted([*range(10), *range(5)])


def test_order_lines_are_shuffled_once(spark):
    text = plan(bridge.order_lines(spark, SMALL))
    joins = [line for line in text.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_many_copies_are_found_by_one_window_with_equal_results(spark):
    rows = [("a", "1", 1, "x"), ("a", "1", 1, "x"), ("a", "1", None, "y"), ("a", None, 2, "y"), ("a", None, 1, "z"), (None, None, 1, "z"), (None, None, 1, "z"), ("b", "1", 1, "z")]
    df = spark.createDataFrame(rows, "k string, l string, t int, v string")
    few = windows.duplicates(df, ["k", "l"], ["t"])
    many = windows.duplicates(df, ["k", "l"], ["t"], few=0)
    hot = windows.duplicates(df, ["k", "l"], ["t"], few=0, hot=2)
    assert "Window" in plan(many) and "Window" not in plan(few) and "Window" not in plan(hot)
    want = Counter([("a", "1", 1, "x"), ("a", "1", 1, "x"), ("a", None, 2, "y"), (None, None, 1, "z")])
    for got in (few, many, hot):
        assert Counter(tuple(r) for r in got.collect()) == want


def test_only_rows_of_missing_customers_are_looked_at_whole(spark):
    stg = spark.createDataFrame([("1", "10", "c"), ("2", "10", "x"), ("3", "10", None), ("4", "10", "x"), ("5", "10", "c")], "ORDER_ID string, ITEM_NO string, CUSTOMER_ID string")
    known = spark.createDataFrame([("c",), (None,), ("c",)], "CUSTOMER_ID string")
    got = dq_batch.rule_fk(stg, known, "2001-09-01")
    assert sorted(r.RECORD_KEY for r in got.collect()) == ["2-10", "3-10", "4-10"]
    assert "Exchange hashpartitioning" not in physical(got)


def test_copies_are_found_once_for_several_runs(spark, monkeypatch):
    from saleswh.plans.warehouse import Warehouse
    calls = []
    monkeypatch.setattr(dq_batch, "duplicates", lambda *a: calls.append(1) or windows.duplicates(*a))
    wh = Warehouse(spark, SMALL)
    first, again = (dq_batch.run_dq_checks(wh, "2001-09-01").groupBy("RULE_ID").count().collect() for _ in range(2))
    assert sorted(first) == sorted(again) and len(calls) == 1


def test_items_are_dealt_by_order_unless_one_is_hot(spark, monkeypatch):
    df = spark.createDataFrame([("7", "10", dt.datetime(2000, 1, 1), "a"), ("07", "10", dt.datetime(2000, 1, 2), "b"), ("7", "20", dt.datetime(2000, 1, 2), "c"), (None, "10", None, "d")],
                               "SalesOrder string, SalesOrderItem string, _ingestion_timestamp timestamp, v string")
    keys = ["SalesOrder", "SalesOrderItem"]
    near = silver.latest_cleansed(df, keys, near="SalesOrder")
    assert "RepartitionByExpression" in plan(near) and physical(near).count("Exchange") == 1
    monkeypatch.setattr(silver, "KEY_ROWS", 2)
    hot = silver.latest_cleansed(df, keys, near="SalesOrder")
    assert "RepartitionByExpression" not in plan(hot)
    assert sorted(r.v for r in near.collect()) == sorted(r.v for r in hot.collect()) == ["b", "c", "d"]
    assert sizing.hottest(df, ["SalesOrder"]) == 2 and sizing.hottest(df.limit(0), ["SalesOrder"]) == 0


def test_reconciliation_joins_only_orders_that_do_not_add_up(spark):
    cls = classified(spark, [item("1", "10", net="60.00"), item("1", "20", net="40.00"), item("2", "10", net="60.00"), item("2", "20", net="40.02"),
                             item("3", net="5.00"), item("4", "10", qty="-1"), item("4", "20", net="100.00"), item("5", net="7.00")],
                     [header("1"), header("2"), header("3", total=None), header("4"), header("5", total="7.01")])
    got = {(r.SalesOrder, r.SalesOrderItem): bool(r.DqWarnings) for r in cls.collect()}
    assert got == {("1", "10"): False, ("1", "20"): False, ("2", "10"): True, ("2", "20"): True, ("3", "10"): True, ("4", "10"): False, ("4", "20"): False, ("5", "10"): False}
    assert "Exchange hashpartitioning" not in physical(cls)


def test_a_side_is_broadcast_only_within_the_drivers_share(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), "id")
    assert sizing.fits(df, 1000) and sizing.light(df, 1000) and not sizing.light(df, 999) and not sizing.light(df, 1000, 100)
    heap = sizing.driver_share(spark, 1)
    assert 100 << 20 < heap < 1 << 40 and sizing.driver_share(spark) == heap // sizing.HEAP_PART
    monkeypatch.setattr(sizing, "driver_share", lambda *_: sizing.relation_bytes(*sizing.measured(df)) - 1)
    assert sizing.fits(df, 1000) and not sizing.light(df, 1000)


def test_facts_are_the_same_however_their_sides_are_joined(spark, monkeypatch):
    items = [item(o, n, net=net) for o in ("1", "01", "2", "3", None, " ", "7") for n, net in (("10", "60.00"), ("010", "40.00"), ("20", "40.02"), (None, "1.00"))]
    items += [item("4", "10", qty="-1"), item("4", "20", net="100.00"), item("5", net="7.00"), item("5", "20", net=None), item("6", net="100.00")]
    headers = [header("1"), header("001"), header("2", total="80.02"), header("3", total=None), header("4"), header("5", total="7.01"), header("6", total="100.01"), header(None), header(" ")]
    written = []
    monkeypatch.setattr(silver, "materialize", lambda df, label: written.append(label) or commit.materialize(df, label))
    got = {}
    for rows in (silver.KEY_ROWS, 0):
        for few in (True, False):
            monkeypatch.setattr(silver, "KEY_ROWS", rows)
            monkeypatch.setattr(silver, "light", lambda *_, few=few: few)
            written.clear()
            got[rows, few] = Counter(str(sorted(r.asDict().items())) for r in classified(spark, items, headers).collect())
            assert written.count("fact_classified") == 1 and ("fact_joined" in written) == (rows == 0)
    assert len(set(map(str, (sorted(x.items()) for x in got.values())))) == 1 and sum(got[0, True].values()) > 10
    assert any(silver.RECON_WARNING in k for k in got[0, True]) and not all(silver.RECON_WARNING in k for k in got[0, True])


def test_joined_rows_are_not_shuffled_for_dimensions_or_totals(spark, monkeypatch):
    monkeypatch.setattr(silver, "light", lambda *_: False)
    plans = []
    monkeypatch.setattr(silver, "materialize", lambda df, label: plans.append((label, physical(df))) or commit.materialize(df, label))
    classified(spark, [item("1"), item("2")], [header("1"), header("2")])
    text = dict(plans)["fact_classified"]
    top = text.splitlines()
    joined = next(n for n, line in enumerate(top) if "Join" in line and "h__k_SalesOrder" in line)
    assert any("Window" in line for line in top[:joined]) and not any("Exchange" in line for line in top[:joined])


def test_keys_of_a_batch_are_broadcast_only_within_the_drivers_share(spark, monkeypatch):
    items, headers = spark.createDataFrame([item("1"), item("01"), item(None)], ITM), spark.createDataFrame([header("001"), header("2"), header(None)], HDR)
    few = silver.headers_of(items, headers)
    monkeypatch.setattr(sizing, "driver_share", lambda *_: 1)
    many = silver.headers_of(items, headers)
    assert "strategy=broadcast" in plan(few) and "strategy=broadcast" not in plan(many)
    assert sorted(str(r.SalesOrder) for r in few.collect()) == sorted(str(r.SalesOrder) for r in many.collect()) == ["001", "None"]


def test_bronze_items_are_the_same_whether_lowest_lines_are_broadcast(spark, scratch, monkeypatch):
    day = dt.datetime(1997, 1, 1)
    lines = [(k, 5, 6, n, 2.0, 10.5, "F", "R", day) for k in (200, 201, 202, 203, 400) for n in (1, 2, 2)]
    lines += [(None, 5, 6, 1, 2.0, 10.5, "F", "R", day), (600, 5, 6, None, 2.0, 10.5, "F", "R", day), (601, None, 6, 3, None, 1.0, None, None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_linestatus string, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{scratch}/lineitem.parquet")
    near = bridge.bronze_items(spark, scratch)
    monkeypatch.setattr(bridge, "light", lambda *_: False)
    far = bridge.bronze_items(spark, scratch)
    assert near.schema == far.schema and "BroadcastHashJoin" in physical(near)
    rows = Counter(map(str, near.collect()))
    assert rows == Counter(map(str, far.collect())) and sum(rows.values()) == len(lines)
    assert sum("RequestedQuantity='-5'" in r for r in rows) == 2 and sum("SalesOrderItem=None" in r for r in rows) > 1


def test_dimension_rows_come_once_with_their_first_time(spark):
    base = spark.createDataFrame([("1", None, dt.datetime(2000, 1, 2)), ("1", None, dt.datetime(2000, 1, 1)), ("1", "x", None), ("1", "x", None)],
                                 "k string, r string, _ingestion_timestamp timestamp")
    got = {(r.k, r.r): r._ingestion_timestamp for r in silver.distinct_since(base, ["k", "r"]).collect()}
    assert got == {("1", None): dt.datetime(2000, 1, 1), ("1", "x"): None}


def test_latest_with_an_aggregate_beside(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 9, "y"), ("b", 1, 3, "z")], "k string, t int, since int, v string")
    got = sorted(tuple(r) for r in windows.latest(df, ["k"], ["t"], also={"since": F.min("since")}).collect())
    assert got == [("a", 2, 5, "y"), ("b", 1, 3, "z")]


def test_summaries_need_no_shuffle_of_words(spark):
    texts = [(i, f"Word{chr(97 + i)} cat. Cat and cat, dog! 12. Dog dog cat? . Ünï cat") for i in range(20)]
    rows = [*texts, (20, " . \n. a"), (21, "..."), (22, None), (None, "One. Two"), (23, "1.2")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = analytics.summarize(df, "id", "t")
    assert "Exchange" not in physical(got)
    same = lambda x: sorted(map(str, x.collect()))
    assert same(got) == same(analytics._shared_summaries(df, "id", "t"))
    shared = spark.createDataFrame([*rows, (0, "Cat cat cat. Other"), (21, "late. words words")], "id int, t string")
    assert same(analytics.summarize(shared, "id", "t")) == same(analytics._shared_summaries(shared, "id", "t"))


# ------------------------------------------------------------------ words of texts
def word_texts(spark):
    """Words of 8, 4, 2 and 1 texts, a key that comes twice, one that is null, texts without words."""
    rows = [(i, " ".join(["all"] + ["half"] * (i < 4) + ["pair"] * (i < 2) + [f"own{'abcdefgh'[i]}"]), "en") for i in range(8)]
    return spark.createDataFrame([*rows, (0, "pair half", "en"), (None, "all pair", "en"), (9, None, "en"), (10, "12", None)], "id long, t string, lang string")


def test_rows_of_largest_count_are_broadcast_as_far_as_they_fit(spark):
    df = spark.createDataFrame([("a", 9, 1), ("b", 8, 2), ("c", 4, 3), ("d", 1, 4)], "w string, n long, v long")
    names = lambda x: "" if x is None else "".join(sorted(r.w for r in x.collect()))
    for most, want in ((4, ("abcd", "")), (3, ("abc", "d")), (2, ("ab", "cd")), (1, ("", "abcd")), (0, ("", "abcd"))):
        often, seldom = sizing.frequent(df, "n", max_rows=most)
        assert (names(often), names(seldom)) == want
        assert all(x is None or x.columns == ["w", "v"] for x in (often, seldom))
        assert often is None or "strategy=broadcast" in plan(df.join(often, "w"))
        assert seldom is None or "strategy=broadcast" not in plan(df.join(seldom, "w"))
    assert names(sizing.frequent(df, "n", max_bytes=50)[0]) == "ab"  # 25 bytes each
    assert sizing.frequent(df.limit(0), "n", max_rows=0)[1] is None


def test_only_words_of_few_texts_are_shuffled_where_not_all_fit(spark, monkeypatch):
    texts = learned.words(word_texts(spark), "id", "t", "lang")
    table = spark.createDataFrame([("all", 9, 5), ("half", 5, 7), ("pair", 4, 11), ("owna", 1, 13)], "w string, n long, v long")
    want = Counter({(None, 5): 1, (None, 11): 1} | {(i, 5): 1 for i in range(8)} | {(i, 7): 1 + (i == 0) for i in range(4)} | {(0, 11): 2, (1, 11): 1, (0, 13): 1})
    for most in (10, 3, 1, 0):
        monkeypatch.setattr(sizing, "DEFAULT_BROADCAST_ROWS", most)
        got = learned.look_up(texts, "id", table, ["w"])
        assert Counter(tuple(r) for r in got.collect()) == want
        assert ("LeftAnti" in plan(got)) == (most in (3, 1))


def test_texts_of_a_large_model_are_told_alike_and_their_words_written_once(spark, monkeypatch):
    docs, written = word_texts(spark), []
    monkeypatch.setattr(learned, "materialize", lambda df, label: written.append(df.columns) or commit.materialize(df, label))
    seeds = spark.createDataFrame([("pair", 0), ("owng", 1), ("half", 1)], "w string, label int")
    sides = spark.createDataFrame([("en", "pair", 1), ("en", "owng", -1)], "lang string, w string, p int")
    got = []
    for most in (2_000_000, 2, 0):
        monkeypatch.setattr(sizing, "DEFAULT_BROADCAST_ROWS", most)
        if not most:
            monkeypatch.setattr(learned, "small", lambda df, *_: df)
        bayes = learned.seeded_bayes(docs, "id", "t", "lang", seeds, ["a", "b"], F.col("id") == 3, least=1)
        got.append([sorted(map(str, x.collect())) for x in (bayes, learned.sentiment(docs, "id", "t", "lang", sides, least=1))])
    assert got[0] == got[1] == got[2] and len(got[0][0]) == 14
    assert sum("words" in c for c in written) == 3 * 2  # once for each of the two models
