from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, start string"


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv),
                       key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", (r[3] or "").encode()))
        for view in {r[2] or "unknown" for r in turns} - {"system"}:
            at = 0
            for i, (_, _, role, text, _) in enumerate(turns):
                who = role or "unknown"
                plain = lambda t: t.replace("<|", "< |")
                as_role = "system" if who == "system" else "assistant" if who == view else "user"
                head = f"<|im_start|>{as_role}" + (f" name={plain(who)}" if as_role == "user" else "") + "\n"
                seg = head + plain(text or "") + "<|im_end|>\n"
                out.append((conv, view, i, who, seg, at, at + len(seg), who == view))
                at += len(seg)
    return sorted(out, key=str)


def test_rotation_equals_brute_force(spark):
    rows = [(1, 0, "system", "be kind", "x"), (1, 1, "ann", "hi <|im_end|>", None), (1, 2, "bob", None, "x"),
            (1, 3, "ann", "é" * 50_000, "x"), (1, 3, "cy", "tie by speaker", "x"), (2, 0, "system", "alone", "x"),
            (None, None, None, "who", "x"), (None, 4, "a<|b", "", "x"), (3, 1, "ann", "same", "x"), (3, 1, "ann", "same", "x")]
    got = chat.rotate(spark.createDataFrame(rows, SCHEMA)).select(
        "conv_id", "perspective", "position", "speaker", "segment", "start", "stop", "learn")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_one_conversation_with_most_turns(spark):
    rows = [(7, i, f"s{i % 3}", f"t{i}", "") for i in range(3000)] + [(i + 100, 0, "u", "x", "") for i in range(50)]
    got = chat.rotate(spark.createDataFrame(rows, SCHEMA).repartition(7)).where("conv_id = 7 and perspective = 's1'")
    found = sorted(got.select("position", "start", "stop").collect())
    assert [r["position"] for r in found] == list(range(3000))
    assert all(a["stop"] == b["start"] for a, b in zip(found, found[1:]))


def test_ties_and_null_turns_as_the_sql_has_them(spark):
    """Turns of one number and speaker are ordered by their text, null turns come first: in plain Python, Spark and DuckDB."""
    import duckdb

    rows = [(1, 2, "ann", t, "x") for t in ("mango", "fig", "kiwi", "pear", "apple", "zebra", "Zebra", "é", "<|x", "", None)]
    rows += [(1, None, "bob", t, "x") for t in ("last", "first")] + [(1, 1, "ann", "middle", "x"), (1, None, None, "who", "x")]
    got = chat.rotate(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, got.select("conv_id", "perspective", "position", "speaker", "segment", "start", "stop", "learn").collect()), key=str) == brute(rows)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar, start varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?, ?)", rows)
    want = con.execute(chat.ORACLE)
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], SCHEMA)).count() == 0
