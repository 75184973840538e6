"""Small fixtures for curation, datasets, style and ratings."""

import math

from pyspark.sql import functions as F

from lettermill.functions.ids import conversation_key
from lettermill.operators import curate, dataset, messages, ratings, stylometry
from lettermill.operators.ranking import hash_key, keep_first, with_rank


def _thread(spark, turns, platform="chat"):
    rows = [(platform, "c1", f"m{i}", f"{i:03}", i, role, text) for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "platform string, conversation_id string, message_id string, date string, thread_index long, turn_role string, body_text string")
    return df.withColumn("direction", F.when(F.col("turn_role") == "you", "outbound").otherwise("inbound")).withColumn("conversation_key", conversation_key(F.col("platform"), F.col("conversation_id"))).withColumn("lang", F.lit("en"))


def test_context_holds_five_turns_before(spark):
    rows = _thread(spark, [("partner", f"question number {i}") for i in range(8)] + [("you", "my answer")])
    (pair,) = curate.context_pairs(rows).collect()
    assert [t["text"] for t in pair["context"]] == [f"question number {i}" for i in range(3, 8)] and pair["target_text"] == "my answer" and pair["id"] == "pair-m8-8"


def test_context_falls_back_to_the_last_partner_turn(spark):
    rows = _thread(spark, [("partner", "x"), ("you", "an answer to it"), ("partner", "subject: a"), ("you", "thanks"), ("you", "ok then")])
    got = {r["target_text"]: [t["text"] for t in r["context"]] for r in curate.context_pairs(rows, k=2).collect()}
    assert got == {"an answer to it": ["x"], "ok then": ["thanks"]}


def test_standalone_length_rule(spark):
    rows = _thread(spark, [("you", "one two three four five"), ("you", "short one"), ("you", "x" * 30), ("partner", "y" * 50)])
    assert sorted(r["text"] for r in curate.standalone(rows).collect()) == ["one two three four five", "x" * 30]


def test_exact_split_sizes(spark):
    for n, want in ((1, (0, 0, 1)), (3, (2, 0, 1)), (10, (8, 1, 1)), (101, (80, 10, 11))):
        got = {r["split"]: r["count"] for r in curate.exact_split(spark.range(n), "id").groupBy("split").count().collect()}
        assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == want


def test_rank_is_whole_and_stable(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 3)
    ranked = with_rank(df, hash_key(F.col("id")), ["id"], ["g"])
    for g in range(3):
        rows = sorted((r["rank"], r["id"]) for r in ranked.where(F.col("g") == g).collect())
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    assert set(map(tuple, ranked.repartition(7).collect())) == set(map(tuple, ranked.collect()))


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 5)], "k string, o int")
    assert sorted(tuple(r) for r in keep_first(df, [F.col("k")], ["o"]).fillna("-").collect()) == [("-", 4), ("a", 1), ("b", 3)]


def test_weighted_mix(spark):
    def side(kind, n):
        return spark.range(n).select(F.concat(F.lit(kind), "id").alias("id"), F.array(F.struct(F.lit("user").alias("role"), F.lit("x").alias("content"))).alias("messages"), F.lit("x").alias("labels"))

    for p, m, pw, mw, limit, want in ((100, 100, 3, 1, None, (100, 50)), (300, 20, 3, 1, None, (240, 20)), (10, 500, 3, 1, None, (10, 128)), (100, 100, 3, 1, 40, (30, 10)), (5, 5, 0, 0, None, (5, 5))):
        got = {r["kind"]: r["count"] for r in dataset.weighted_mix(side("p", p), side("m", m), pw, mw, limit).groupBy("kind").count().collect()}
        assert (got.get("pair", 0), got.get("mono", 0)) == want


def test_chat_mapping(spark):
    rows = _thread(spark, [("partner", "hello there"), ("you", "good morning"), ("partner", "how is it"), ("you", "sent from my desk"), ("you", "all is well")])
    got = {r["labels"]: [(m["role"], m["content"]) for m in r["messages"]] for r in dataset.chat_from_pairs(curate.context_pairs(rows)).collect()}
    assert set(got) == {"good morning", "all is well"} and got["good morning"] == [("user", "hello there"), ("assistant", "good morning")]
    text = dataset.rendered(dataset.chat_from_pairs(curate.context_pairs(rows))).where("labels = 'good morning'").first()["text"]
    assert text == "<|user|>\nhello there<|end|>\n<|assistant|>\ngood morning<|end|>\n"


def test_threads(spark):
    rows = spark.createDataFrame([("t", "b", "2"), ("t", None, "1"), ("t", "a", "3"), ("u", "a", "9")], "conversation_id string, date string, message_id string")
    assert sorted((r["message_id"], r["thread_index"], r["thread_len"]) for r in messages.thread_index(rows).collect()) == [("1", 0, 3), ("2", 2, 3), ("3", 1, 3), ("9", 0, 1)]
    langs = spark.createDataFrame([("g", "en", 1), ("g", "fr", 2), ("g", "unknown", 3), ("h", None, 4)], "g string, lang string, o int")
    assert sorted((r["o"], r["lang"]) for r in messages.language_backfill(langs, "g", "lang", "o").collect()) == [(1, "en"), (2, "fr"), (3, "en"), (4, "unknown")]
    some = spark.createDataFrame([("f", 1, "inbound"), ("f", 1, "outbound"), ("f", 2, "inbound")], "source_file string, c int, direction string")
    assert messages.participated(some, ["source_file", "c"]).count() == 2
    assert messages.first_n(some, ["c"], 0).count() == 0


def test_cleaned_drops_empty_and_repeats(spark):
    rows = _thread(spark, [("you", "Hello there!"), ("you", "hello, THERE"), ("partner", "hello there"), ("you", "  ")])
    kept = messages.without_repeats(messages.cleaned(rows.drop("lang")), ["date", "thread_index"])
    assert sorted((r["thread_index"], r["body_text"]) for r in kept.collect()) == [(0, "Hello there!"), (2, "hello there")]


def test_lexical_values(spark):
    df = spark.createDataFrame([("red blue red green sun moon sun sun",), ("the of and",), (None,)], "text string")
    got, none, null = stylometry.lexical_features(df).collect()
    want = {"type_token_ratio": 0.625, "hapax_legomena_ratio": 0.375, "dis_legomena_ratio": 0.125, "yule_k": 2500, "simpson_d": 0.142857, "brunet_w": 4.838518, "honore_statistic": 519.860385}
    for k, v in want.items():
        assert math.isclose(got[k], v, abs_tol=1e-5) and none[k] == 0 and null[k] == 0


def test_character_ngrams(spark):
    got, short = stylometry.char_ngram_features(spark.createDataFrame([("Banana",), ("a",)], "text string"), 3).collect()
    assert math.isclose(got["char_3gram_ttr"], 0.75) and math.isclose(got["char_3gram_entropy"], 1.5) and math.isclose(got["char_3gram_avg_freq"], 4 / 3)
    assert (short["char_3gram_ttr"], short["char_3gram_entropy"]) == (0, 0)


def test_similarity(spark):
    df = spark.createDataFrame([(1, "red blue sun", "red green sun"), (2, "the", "of"), (3, "red sun", "red sun")], "id int, a string, b string")
    got = {r["id"]: r["cosine"] for r in stylometry.tfidf_cosine(df, ["id"], "a", "b").collect()}
    assert math.isclose(got[1], 0.252334, abs_tol=1e-6) and got[2] == 0 and math.isclose(got[3], 1)
    assert {r["id"]: round(r["delta"], 9) for r in stylometry.burrows_delta(df, ["id"], "a", "b").collect()}[3] == 0


def test_ratings(spark):
    rows = [("p", "Human", "me", 5, "r"), ("p", "Human", "AI", 3, "r"), ("q", "Base", "AI", 4, "s"), ("q", "LoRA", "me", 2, "s"), ("q", "LoRA", "AI", 1, "s")]
    df = spark.createDataFrame(rows, "prompt_id string, key string, guess string, confidence_1to5 int, rater_id string").withColumn("answer", F.lit("text"))
    acc = {r["key"]: (r["accuracy"], r["correct"], r["total"]) for r in ratings.accuracy_by_type(df, "me").collect()}
    assert acc == {"Human": (0.5, 1, 2), "Base": (1.0, 1, 1), "LoRA": (0.5, 1, 2)}
    assert ratings.detection_accuracy(df).first()[0] == 0.4 and ratings.detection_accuracy(df, normalise_labels=True).first()[0] == 0.6
    r = ratings.lora_vs_base(df, "me").first()
    assert (r["lora_advantage"], r["human_likeness_ratio"]) == (0.5, 1.0)
    assert "strong advantage" in ratings.report(df, "me").first()[0]


def test_length_buckets_are_bounded_in_bytes(spark, monkeypatch):
    """Long texts and many of one length are dealt to more partitions than asked for."""
    from pyspark.sql import functions as F

    from lettermill.operators import dataset

    monkeypatch.setattr(dataset, "BUCKET_BYTES", 50_000)
    rows = spark.createDataFrame([(i, None if i == 7 else "x" * (1000 if i < 500 else i)) for i in range(1000)], "i long, t string")
    found = dataset.length_buckets(rows, "t", 2).withColumn("p", F.spark_partition_id()).collect()
    held = {}
    for r in found:
        held.setdefault(r["p"], []).append(len(r["t"] or ""))
    assert sorted(r["i"] for r in found) == list(range(1000)) and max(map(sum, held.values())) < 150_000
    assert all(v == sorted(v) for v in held.values())
    assert dataset.length_buckets(rows.where("false"), "t", 2).count() == 0


def test_style_features_sort_without_an_interpreted_comparison(spark):
    from lettermill.operators import stylometry

    out = stylometry.all_features(spark.createDataFrame([("b a b, a c. abab",)], "text string"))
    assert "array_sort(" not in out._jdf.queryExecution().optimizedPlan().toString()
    (r,) = out.collect()
    assert (r["type_token_ratio"], round(r["char_3gram_avg_freq"], 9)) == (0.75, round(14 / 13, 9))
