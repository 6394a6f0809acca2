import duckdb
import llm_data as D

from saleswh.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [(1, 0, "system", "Be kind"), (1, 1, "ann", "Hi <|end|> é"), (1, 2, "bob", "Hello"), (1, 3, "ann", None), (1, 2, "bob", "Hello"), (1, 2, "cy", "Me too"),
        (2, 0, "system", "alone"), (3, None, None, "no turn"), (3, 0, "x", ""), (None, 0, "u", "lost"), (None, 1, "v", "found"), (4, -1, "u", "before"), (4, 0, "u", "x" * 20000)]
ROWS += [(5, i, ("a", "b")[i % 2], f"m{i}") for i in range(200)]


def test_masks_cover_the_speaker_only(spark):
    got = chat.rotated(spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' as participant")).collect()
    for r in got:
        said = "".join(r.text[s.start:s.start + s.length] for s in r["mask"])
        mine = sorted({(t if t is not None else 0, x or "") for c, t, w, x in ROWS if c == r.conv_id and (w or "unknown") == r.participant
                       and (None if t is None else t // 64) == r.part})
        assert said == "".join(x.replace("<|", "< |") + "<|end|>" for _, x in mine)
    one = {(r.participant): r for r in got if r.conv_id == 1}
    assert set(one) == {"ann", "bob", "cy"} and all(r.n_messages == 5 for r in one.values())
    assert one["bob"].text.startswith("<|system|>\nBe kind<|end|>\n<|user name=ann|>\nHi < |end|> é<|end|>\n<|assistant|>\nHello<|end|>\n<|user name=cy|>\n")
    assert not [r for r in got if r.conv_id == 2]
    assert {(r.part, r.n_messages) for r in got if r.conv_id == 5} == {(0, 64), (1, 64), (2, 64), (3, 8)}
    assert chat.rotated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_overfull_part_is_dealt_whole(spark, monkeypatch):
    monkeypatch.setattr(chat, "MOST", 10)
    rows = [(1, 0, "a", f"same turn {i}") for i in range(95)]
    got = chat.rotated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_messages for r in got) == 95 and len(got) > 1 and len({r["sub"] for r in got}) == len(got)


def test_oracle(spark):
    for table in (spark.read.parquet(f"{D.SMALL}/conversations.parquet"), spark.createDataFrame(ROWS, SCHEMA)):
        con = duckdb.connect()
        con.register("conversations", table.toArrow())
        want = con.sql(queries.ORACLE_SQL["op2_chat_formatting"]).df()
        table.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/chat/conversations.parquet")
        got = queries.QUERIES["op2_chat_formatting"](spark, path.rsplit("/", 1)[0]).toPandas()
        order = ["conv_id", "participant", "part"]
        got, want = (f.sort_values(order).reset_index(drop=True).fillna(-9) for f in (got, want))
        assert got.astype(str).equals(want[got.columns].astype(got.dtypes.to_dict()).astype(str))


def test_overfull_parts_keep_the_order(spark):
    rows = [(6, i % 9, ("a", "b")[i // 9 % 2], f"q{i}") for i in range(900)] + [(6, 70, ("a", "b", "system")[i % 3], f"same {i} é") for i in range(700)] + [(6, 71, "b", "last")]
    rows += [(None, None, "a", f"{'lost ' * 80}{i}") for i in range(300)] + [(6, i, "a", "few") for i in range(128, 192)]
    table = spark.createDataFrame(rows, SCHEMA)
    table.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/chat-hot/conversations.parquet")
    con = duckdb.connect()
    con.register("conversations", table.toArrow())
    want = {tuple(r[:4]): tuple(r[4:]) for r in con.sql(queries.ORACLE_SQL["op2_chat_formatting"]).fetchall()}
    assert len({k[3] for k in want}) > 3
    for n in (4, 13):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = queries.QUERIES["op2_chat_formatting"](spark, path.rsplit("/", 1)[0]).collect()
        assert {(r.conv_id, r.participant, r.part, r["sub"]): (r.n_messages, r.text, r["mask"]) for r in got} == want and len(got) == len(want)
        assert all(r.n_messages <= chat.MOST for r in got)
        views = {p: [r.n_messages for r in sorted(got, key=lambda r: r["sub"]) if (r.conv_id, r.participant, r.part) == (6, "a", p)] for p in (0, 1)}
        assert views == {0: [200, 200, 200, 200, 100], 1: [256, 256, 188, 1]}
    spark.conf.set("spark.sql.shuffle.partitions", 4)
