"""Raw exports written to a folder and parsed."""

import json

from pyspark.sql import functions as F

from lettermill.sources import chat_text, files, mailbox, social


def test_chat_text(spark, tmp_path):
    (tmp_path / "chat.txt").write_text(
        "[2/13/23, 8:46:17 PM] Ana Lopez: first line\ncontinuation line\n\n13/02/2023, 20:47 - Bob: text\n[2/13/23, 8:48 PM] Messages and calls are end-to-end encrypted\n"
        "‎[2/13/23, 8:49:00 PM] Bob: image omitted\nmilk - two litres\nlost line\n[2/13/23, 8:50:00 PM] Ana Lopez: 😀\n[2/13/23, 8:51:00 PM] Ana Lopez: bye\n", encoding="utf-8"
    )
    rows = {r["thread_index"]: r for r in chat_text.parse(spark, str(tmp_path), ["bob"]).collect()}
    assert [rows[i]["body_raw"] for i in sorted(rows)] == ["first line\ncontinuation line\n", "text", "Messages and calls are end-to-end encrypted\n [2/13/23, 8:49:00 PM] Bob: image omitted\nmilk - two litres", "bye"]
    assert rows[1]["direction"] == "outbound" and rows[2]["from"] == "system" and rows[0]["participants"] == ["ana_lopez", "bob"] and rows[4]["thread_len"] == 5
    assert rows[0]["date"] == "2023-02-13T20:46:17Z"


def test_social(spark, tmp_path):
    folder = tmp_path / "inbox" / "alice_1"
    folder.mkdir(parents=True)
    first = {"participants": [{"name": "Alice"}, {"name": "Bob"}], "thread_path": "inbox/alice_1", "messages": [{"sender_name": "Bob", "timestamp_ms": 2000, "content": "see a@b.org"}, {"sender_name": "Alice", "timestamp_ms": 1000, "content": "hi"}]}
    second = {"participants": [{"name": "Alice"}], "messages": [{"sender_name": "Alice", "timestamp_ms": 3000, "photos": [{"uri": "x"}, {"uri": "y"}]}, {"sender_name": "Alice", "timestamp_ms": 4000, "content": "😀"}]}
    (folder / "message_1.json").write_text(json.dumps(first))
    (folder / "message_2.json").write_text(json.dumps(second))
    (folder / "message_3.json").write_text("{broken")
    rows = sorted(social.parse(spark, str(tmp_path), ["bob"]).collect(), key=lambda r: r["thread_index"])
    assert [(r["body_text"], r["content_type"], r["turn_role"], r["thread_len"]) for r in rows] == [("hi", "text", "partner", 4), ("see [EMAIL]", "text", "you", 4), ("", "photo", "partner", 4)]
    assert rows[2]["attachments"]["count"] == 2 and rows[0]["to"] == ["bob"] and rows[0]["conversation_id"].startswith("ig-")


def test_mailbox(spark, tmp_path):
    box = (
        "From a@x Mon\nFrom: Me <me@x.org>\nTo: You <you@y.org>\nSubject: Re: Plan\nDate: Tue, 14 Nov 2023 22:13:20 +0200\nMessage-ID: <1@x>\n\nHello you.\n\n"
        "From b@y Mon\nFrom: you@y.org\nTo: me@x.org\nSubject: =?utf-8?q?Plan?=\nIn-Reply-To: <1@x>\nX-GM-THRID: 77\nContent-Type: text/html\n\n<p>fine &eacute;</p>\n\n"
        "From c@z Mon\nFrom: other@z.org\nTo: me@x.org\nSubject: Spam\n\nBuy.\n"
    )
    (tmp_path / "a.mbox").write_text(box)
    rows = mailbox.parse(spark, str(tmp_path / "a.mbox"), ["ME@x.org"]).collect()
    assert len(rows) == 1
    (r,) = rows
    assert (r["date"], r["subject_norm"], r["account"], r["sender_domain"], r["to"], r["body_text"], r["thread_index"]) == ("2023-11-14T20:13:20+00:00", "Plan", "me@x.org", "x.org", ["you@y.org"], "Hello you.", 0)
    every = {m["subject"]: m for m in mailbox.read_messages(spark, str(tmp_path / "a.mbox")).collect()}
    assert set(every) == {"Re: Plan", "Plan", "Spam"} and every["Plan"]["thread"] == "77" and every["Plan"]["content_type"] == "text/html"


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a", "hi <Edited>", [("you", "x <Edited>")], "en", "pairs", "train"), ("b", "plain", [], "unknown", "pairs", "val")], f"id string, target_text string, context array<{files.TURN}>, lang_part string, kind string, split string")
    files.write_partitioned(files.edits_cleaned(rows), str(tmp_path / "out"))
    (got,) = files.read_partitioned(spark, str(tmp_path / "out"), "en").collect()
    assert (got["target_text"], got["context"][0]["text"], got["changed"]) == ("hi", "x", 2)
    (tmp_path / "in.jsonl").write_text('{"id": "1", "text": "a"}\nnonsense\n\n{"id": "2", "text": "b"}\n')
    loose = files.read_jsonl(spark, str(tmp_path / "in.jsonl"), files.MONO_SCHEMA, strict=False)
    assert [r["id"] for r in loose.orderBy("input_order").collect()] == ["1", "2"]
    files.write_json_array(spark.range(2), str(tmp_path / "arr"))
    assert sorted(r["id"] for r in files.read_json_array(spark, str(tmp_path / "arr"), "id long").collect()) == [0, 1]
    files.write_dataset(spark.range(3), spark.range(1), str(tmp_path / "set"))
    assert files.read_dataset(spark, str(tmp_path / "set"), "train").count() == 3
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "exp1_raters_packet_A.csv").write_text("prompt_id,answer,key,guess,confidence_1to5\np1,hello,Human,AI,4\n")
    (tmp_path / "r" / "other.csv").write_text("x\n")
    (rated,) = files.read_ratings(spark, str(tmp_path / "r")).collect()
    assert (rated["experiment_id"], rated["rater_id"], rated["confidence_1to5"]) == ("exp1", "A", 4)


def test_streaming(spark, tmp_path):
    from lettermill.streaming import messages as S

    spark.createDataFrame([(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:00:05"), (2, "b", "2024-01-01 02:00:00")], "k int, p string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema("k int, p string, ts timestamp").parquet(str(tmp_path / "s"))
    for name, df in (("d", S.without_late_repeats(stream, ["k"])), ("e", S.sessions(stream, "p"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination()
    assert spark.table("d").count() == 2 and [r["n"] for r in spark.table("e").collect()] == [2]


def test_social_participants_may_be_plain_strings(spark, tmp_path):
    folder = tmp_path / "inbox" / "x"
    folder.mkdir(parents=True)
    said = [{"sender_name": "Bob", "timestamp_ms": 1, "content": "hi", "zeta": 1, "reactions": [{"reaction": "👍", "actor": "Al B"}]}]
    (folder / "message_1.json").write_text(json.dumps({"participants": ["Alice", {"name": "Carol"}], "messages": said}))
    (r,) = social.parse(spark, str(tmp_path), ["bob"]).collect()
    assert r["participants"] == ["alice", "bob", "carol"] and r["source_keys"] == ["content", "reactions", "sender_name", "timestamp_ms", "zeta"] and r["reactions"][0]["actor"] == "al_b"


def test_generation_frame(spark):
    from lettermill.operators import generation

    rows = spark.createDataFrame([(1, "abc"), (2, "x"), (3, None)], "id int, p string")

    def call(t):
        if t == "x":
            raise ValueError("no")
        return t * 2

    got = {r["id"]: r["o"] for r in generation.generated(rows, "p", "o", call, retries=1, least=4).collect()}
    assert got == {1: "abcabc", 2: "ERROR: no", 3: None}
    short = {r["id"]: r["o"] for r in generation.generated(rows, "p", "o", call, retries=1, least=9).collect()}
    assert short == {1: "ERROR: too short", 2: "ERROR: no", 3: None}


def test_tokenized_with_a_file(spark):
    from lettermill.operators import dataset

    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not __import__("os").path.exists(path):
        return
    (r, e) = dataset.tokenized(spark.createDataFrame([("hello world again",), (None,)], "t string").coalesce(1), "t", path, most=2).collect()
    assert len(r["tokens"]) == 2 and r["n_tokens"] == 3 and (e["tokens"], e["n_tokens"]) == ([], 0)
