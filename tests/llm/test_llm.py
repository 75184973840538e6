"""Small fixtures with nulls, empty and long texts, ties, repeats and clashing columns, against plain Python."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.llm import chat, components, embeddings, exact_dedup, language, lm_scoring, minhash, mixing, packing, pii, substrings

from . import brute

CLASH = "doc_id long, text string, lang string, source string, n_chars long, part string, node string, __s string"


def _docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the other columns bear names that operators use inside."""
    full = [(r + (None,) * 4)[:4] + (len(r[1] or ""), "p", "n", "s") for r in rows]
    return spark.createDataFrame(full, CLASH)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, base = text(60), text(120)
    rows = [(i, text(r.randint(1, 150)), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, text(30) + " " + passage + "\n" + text(10), "en", "s0") for i in range(12)]
    for i in range(20):
        words = base.split()
        for _ in range(i % 7):
            words[r.randrange(len(words))] = r.choice(vocab)
        rows.append((200 + i, " ".join(words), "en", None))
    rows += [(300, None, "en", "s1"), (301, "", None, "s1"), (302, "  \n ", "en", "s2"), (303, base.upper(), "en", "s2"), (304, base.replace(" ", "\t\n"), "en", "s9"), (305, "x" * 50_000, "en", "s9"), (306, passage + " " + passage, "fr", "é")]
    return rows


def test_exact(spark, corpus):
    rows = corpus + [(5, "twice", "en", "s0"), (5, "twice", "en", "s0"), (None, "twice", "en", "s0")]
    docs = _docs(spark, rows)
    import re

    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    want = sorted((repr(r[0]), repr(low(groups[norm(r[1])])), len(groups[norm(r[1])]), r[0] == low(groups[norm(r[1])]), brute.sha(norm(r[1]))) for r in rows)
    got = sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_groups(docs).collect())
    assert got == want
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.where("text = 'twice'").collect()) == [5, 5]


def test_mixing(spark, corpus):
    docs = _docs(spark, corpus)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(corpus) and sum(r["taken"] for r in rows) == pytest.approx(sum(r["size"] for r in rows), abs=4)
    by = {}
    for r in rows:
        assert r["size"] == len(brute.words(dict((c[0], c[1]) for c in corpus)[r["doc_id"]])) and r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(abs(taken - target) <= 1 for taken, target in by.values())
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    words = {}
    for r in copies.collect():
        words[r["source"]] = words.get(r["source"], 0) + len(brute.words(r["text"]))
    assert all(abs(words.get(s, 0) - target) <= 1 for s, (_, target) in by.items())


def test_pii(spark):
    rows = [
        (1, "a@b.com_d@e.f x 300.1.1.1 1.2.3.4.5.6.7.8 +1 (988) 555-2485 é😀 4337166598464399 4337-1665 98464399"), (2, None), (3, ""), (4, "1" * 100_000), (5, "a" * 50_000 + " x@y"),
        (6, "a.b@c-d.e-.f..g 001.02.3.0255"), (7, "+1234567890123456 +12-34-5678- "), (8, "x@y.zz"), (8, "x@y.zz"),
    ]
    for r, text in zip(sorted(pii.find_personal_data(_docs(spark, rows)).collect(), key=lambda r: r["doc_id"]), [t for _, t in sorted(rows, key=lambda r: r[0])], strict=True):
        assert [(k, s["start"], s["end"]) for k in pii.KINDS for s in r[k]] == brute.base_pii(text)


def test_pii_discovers_by_context(spark):
    known = [(i, f"Text before. reach me at person{i}@mail{i}.org please") for i in range(8)]
    (r,) = [r for r in pii.find_personal_data(_docs(spark, known + [(50, "and reach me at handle_98765 now"), (51, "in room 98765 now")])).collect() if r["doc_id"] == 50]
    assert [(s["start"], s["end"]) for s in r["identifier"]] == [(16, 28)]


def test_pii_counts_whole_spans_of_several_tokens(spark):
    known = [(i, f"Text. the clinic answers +1 (017) 555-77{i:02} by day") for i in range(8)]
    said = [
        (50, "😀 x clinic answers 0171 555 98 76 now"),
        (51, "clinic answers 12 - 3456 a@b.org, +1 (017) 555-7700 77 88 99 by day"),
        (52, "clinic answers\n5551234\n5554321"),
        (53, "in room 0171 555 98 76 now"),
    ]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["identifier"]] for r in pii.find_personal_data(_docs(spark, known + said)).collect()}
    assert {k: [t[a:b] for a, b in got[k]] for k, t in said} == {50: ["0171 555 98 76"], 51: ["12 - 3456"], 52: ["5551234"], 53: []}
    assert all(got[i] == [] for i, _ in known)


def test_pii_lets_the_pattern_decide_on_every_candidate(spark):
    known = [(i, f"Text. reach me at person{i}@mail{i}.org or come to room person{i}@mail{i}.org") for i in range(8)]
    said = [(50, "and reach me at @handle now"), *[(100 + i, f"come to room {i}") for i in range(30)], (51, "come to room 98765 now")]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["identifier"]] for r in pii.find_personal_data(_docs(spark, known + said)).collect()}
    assert {k for k in got if got[k]} == {50} and got[50] == [(16, 23)]


def test_pii_shapes_and_single_words(spark):
    full = lambda head: next(head + d for d in "0123456789" if brute.luhn(head + d))
    cards = [full(str(433716659846439 + 7919 * i)) for i in range(6)]
    known = [(i, f"word{chr(97 + i)} {c} x{chr(97 + i)}") for i, c in enumerate(cards)] + [(10 + i, f"{w} token = \"{'0a1b2c3d' * 4}{i}\" end") for i, w in enumerate(["ab", "cd", "ef", "gh", "ij", "kl"])]
    said = [(50, "elsewhere 1234567890123456 there"), (51, "a token = Q7-zz now"), (52, "in 1999 and 4.0. or 12")]
    got = {r["doc_id"]: r for r in pii.find_personal_data(_docs(spark, known + said)).collect()}
    ids = {k: [t[s["start"] : s["end"]] for s in got[k]["identifier"]] for k, t in said}
    assert ids == {50: ["1234567890123456"], 51: ["Q7-zz"], 52: []}
    assert all(len(got[10 + i]["secret"]) == 1 and not got[10 + i]["identifier"] for i in range(6))


def test_pii_of_many_matches_in_one_text(spark):
    """Time isn't the square of a text's matches."""
    import time

    texts = [" ".join(f"a{i}@b.org" for i in range(30_000)), ",".join(f"1.2.3.{i % 300}" for i in range(30_000)), "\n".join(f"{i} is" for i in range(100_000))]
    docs = _docs(spark, list(enumerate(texts)))
    began = time.perf_counter()
    rows = sorted(pii.find_personal_data(docs).collect(), key=lambda r: r["doc_id"])
    assert time.perf_counter() - began < 90
    for r, text in zip(rows, texts, strict=True):
        assert [(k, s["start"], s["end"]) for k in pii.KINDS for s in r[k]] == brute.base_pii(text)


def test_pii_runs_of_many_seeds_and_tokens(spark):
    """However many seeds or tokens a run has, what stands between its seeds is found, and it isn't cut."""
    full = lambda head: next(head + d for d in "0123456789" if brute.luhn(head + d))
    cards = [full(str(433716659846439 + 7919 * i)) for i in range(12)]
    known = [(i, f"word{chr(97 + i)} {c} x{chr(97 + i)}") for i, c in enumerate(cards)] + [(20 + i, f"Text. the clinic answers +1 (017) 555-77{i:02} by day") for i in range(12)]
    pairs = [f"é{i}@b.org,d{i}@b.org" for i in range(2000)]
    wrong, row = "1234567890123456", " ".join(str(7 + 13 * i) for i in range(200))
    said = [(50, "in " + " ".join(pairs[:40] + [wrong] + pairs[40:80]) + " out"), (51, "x " + " ".join(pairs[:1500] + [wrong] + pairs[1500:] + [wrong])), (52, f"😀 x clinic answers {row} now")]
    got = {r["doc_id"]: r for r in pii.find_personal_data(_docs(spark, known + said)).collect()}
    ids = {k: [t[s["start"] : s["end"]] for s in got[k]["identifier"]] for k, t in said}
    assert ids == {50: [wrong], 51: [wrong, wrong], 52: [row]}
    assert [len(got[k]["email"]) for k in (50, 51, 52)] == [160, 4000, 0]


def test_pii_redacted(spark):
    rows = [(1, "é a@b.com 300.1.1.1 and 1.2.3.4, +1 (988) 555-2485 or 4337166598464399 not 4337166598464398"), (2, None), (3, ""), (4, "plain"), (5, "+1.2.3.4567890 x@y.zz")]
    got = {r["doc_id"]: r["text"] for r in pii.redacted(_docs(spark, rows)).collect()}
    assert got == {1: "é [EMAIL] 300.1.1.1 and [IP], [PHONE] or [CARD] not 4337166598464398", 2: None, 3: "", 4: "plain", 5: "[PHONE] [EMAIL]"}


def test_substrings(spark, corpus):
    rows = sorted(corpus, key=lambda r: r[0])
    seen, want = set(), {}
    for r in rows:
        w = brute.words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            gone[i : i + 20] = [True] * 20 if k in seen else gone[i : i + 20]
            seen.add(k)
        want[r[0]] = (len(w), sum(gone), brute.sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.without_repeats(_docs(spark, corpus)).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 500


def test_substring_paths(spark):
    """A chain of 40, a fork into it, a circle of 3, one by itself: heads and distances."""
    chain = [(i, 1 + i % 3, i + 1 if i < 40 else 0, i - 1) for i in range(1, 41)]
    rows = [(1, 2, 2, 0), *chain[1:], (50, 7, 20, 0), (60, 1, 61, 62), (61, 1, 62, 60), (62, 1, 60, 61), (70, 5, 0, 0)]
    got = {r["m"]: (r["head"], r["distance"]) for r in substrings.paths(spark.createDataFrame(rows, "m long, windows long, after long, before long")).collect()}
    want, at = {}, 0
    for i, windows, *_ in [(1, 2), *[r[:2] for r in chain[1:]]]:
        want[i] = (1, at)
        at += windows
    assert {k: v for k, v in got.items() if k <= 40} == want
    assert got[50] == (50, 0) and got[70] == (70, 0) and len(got) == len(rows)


@pytest.mark.parametrize("threshold", [80, 85])
def test_minhash(spark, corpus, threshold):
    sets = {}
    for r in corpus:
        w = brute.words((r[1] or "").lower() if (r[1] or "").isascii() else r[1])
        sets[r[0]] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    low = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if low[a] < low[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                    low[b], changed = low[a], True
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(_docs(spark, corpus), threshold=threshold).collect()}
    assert got == {k: (len(s), low[k], low[k] == k) for k, s in sets.items()}


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5), (300, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(41), 100], 0), 200: 200, 201: 200}


def test_embeddings(spark):
    rng = np.random.RandomState(3)
    center = rng.normal(size=(4, 64))
    rows = [(i, [float(x) for x in np.float32(center[i % 4] + rng.normal(size=64) * 0.2 * (i % 3))], i % 2) for i in range(120)]
    rows += [(200, rows[0][1], rows[0][2]), (201, [0.0] * 64, 0), (202, None, 1), (203, [math.nan] + [1.0] * 63, 0), (204, rows[1][1], None), (205, [None] + [1.0] * 63, 0), (206, [1.0, 2.0], 0), (207, [2.0, 4.0], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    good = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float)), lab) for i, v, lab in rows if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: {j for j, w, b in good if j != i and a == b and len(v) == len(w) and v @ w >= 0.93} for i, v, a in good}
    low = {i: i for i, _, _ in rows}
    for _ in range(len(rows)):
        for i, own in links.items():
            low[i] = min([low[i], *(low[j] for j in own)])
    assert got == {i: (len(links.get(i, ())), low[i], low[i] == i) for i, _, _ in rows} and sum(map(len, links.values())) > 100


def test_embeddings_compare_labels_as_they_are(spark):
    rows = [(1, [1.0, 0.0], "1.2"), (2, [2.0, 0.0], "1.7"), (3, [3.0, 0.0], "1.2"), (4, [1.0, 0.0], "x"), (5, [1.0, 0.01], "x"), (None, [1.0, 0.0], "x"), (4, [1.0, 0.0], "x")]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False), (4, 3, 4, True), (4, 3, 4, True), (5, 3, 4, False), (None, 3, 4, False)], key=repr)
    tiles = [(0, [{"name": "a", "raw": b"1234", "n": 1}, {"name": "b", "raw": b"1234", "n": 2}], [{"name": "a", "raw": b"1234", "n": 3}, {"name": "a", "raw": b"12345678", "n": 4}])]
    assert [[[r["n"] for r in side] for side in t[1:]] for t in embeddings._alike(iter(tiles))] == [[[1], [3]]]


def test_chat(spark):
    said = [(1, 0, "user", "hi ### x"), (1, 1, "assistant", "\\### Assistant: </turn> ok"), (1, 2, "assistant", None), (1, 3, "assistant", " é😀\n"), (2, 5, None, "a"), (2, 5, "a:b", ""), (3, None, "assistant", "y" * 30_000)]
    rows = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(rows)).collect()}
    for conv in (1, 2, 3):
        turns = sorted(((t if t is not None else -1, ro or "", x or "") for c, t, ro, x in said if c == conv))
        own = "".join(x for _, ro, x in turns if ro == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(turns), brute.sha("".join(f"{ro}\n{x}\n" for _, ro, x in turns)))
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(own), brute.sha(own))


def test_chat_mask_is_exact():
    """Every masked token lies inside an assistant text, whatever the text begins and ends with."""
    from lettermill.llm.tokens import tokenizer, vocabulary

    ends = ["Sure", "x.", ".", "<", "</turn>", "###", " lead", "trail \n", "\n\n", " ", "\u00a0é", "😀", "'s", "12", "\\", "\\u20;", "<|endoftext|>", "a\r\n\r\nb", "", "\x1c", "日本\u3000", "#"]
    encoder = tokenizer(vocabulary("byte_bpe_50k.json"), plain=True)
    for a in ends:
        for b in ends:
            turns = [("user", b), ("assistant", a + b), ("assistant", a), ("as:sistant", b + a), ("assistant", b)]
            text, spans = chat.render(turns)
            offsets = np.array(encoder.encode(text, add_special_tokens=False).offsets)
            mask = chat.loss_mask(offsets, spans)
            inside = [any(s <= x and y <= e for s, e in spans) for x, y in offsets]
            assert mask.tolist() == inside and chat.read_back(text) == turns
            under = "".join(text[s:e] for s, e in chat.covered(offsets, mask))
            assert chat.unescaped(under) == "".join(t for r, t in turns if r == "assistant")


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    from lettermill.llm.tokens import vocabulary

    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    odd = [(900, "Σ ΑΣ, a.b,c.. don't, DON'S. <|endoftext|> é. 1,2. İx. a b, 　z."), (901, "word " * 5000)]
    rows = {}
    for r in packing.packed(_docs(spark, corpus + odd)).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    for doc, text, *_ in corpus + odd:
        ids, at = tk.encode(text or "", add_special_tokens=False).ids + [1], 0
        for p in sorted(rows[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    seqs = {}
    for p in (p for own in rows.values() for p in own):
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_word_ids_without_the_whole_tokenizer(monkeypatch):
    """Words of letters, with or without punctuation behind them, go to the model alone, and those seen before a full store are
    kept; all ids are the tokenizer's own."""
    from lettermill.llm import tokens

    path = tokens.vocabulary("word_bpe_49k.json")
    r = random.Random(3)
    plain = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzßäéñøÿ") for _ in range(r.randint(1, 12))) + r.choice(["", ",", ".", "%%%", "...", "')", "&&&"]) for _ in range(3000)]
    odd = ["don't,", "x's", "x's.", "x'", "'s,", "a'll'", "<|endoftext|>", "a<|endoftext|>.", "A<|b|>,", "e\u0301,", "é.", "É!", "×,", "÷%", "a×,", "ﬁ.", "İ.", "ΑΣ,", "a=\u0338", "1,", "a1.", "\u00a0a,", "a\u00a0b", "ⅷ.", "ª,", "\x1c,a", "日本,", "a.b,c..", "...", "A" * 70 + "?", "\U0001d400x!"]
    monkeypatch.setattr(tokens.WordEncoder, "MOST_WORDS", 500)
    encoder, whole = tokens.WordEncoder(path), tokens.tokenizer(path).encode
    for text in odd + [w + " " + o for w, o in zip(plain, odd, strict=False)] + [" ".join(odd)]:
        assert encoder.ids(text).tolist() == whole(text, add_special_tokens=False).ids, text
    asked = []
    monkeypatch.setattr(encoder, "encode", lambda w, **kw: asked.append(w) or whole(w, **kw))
    for i in range(0, 3000, 50):
        text = " ".join(plain[i : i + 50] + ["1st"])
        assert encoder.ids(text).tolist() == whole(text, add_special_tokens=False).ids
    assert not any(w[0].isalpha() for w in asked) and asked.count("1st") == 1


def test_word_store_is_bounded_within_a_text(monkeypatch):
    """A text of more distinct words than the store may hold: what is kept stays bounded while it is read."""
    import tracemalloc

    from lettermill.llm import tokens

    encoder = tokens.WordEncoder(tokens.vocabulary("word_bpe_49k.json"))
    monkeypatch.setattr(encoder, "_encoded", lambda word: word[-8:])
    text = " ".join(f"w{i:07d}" for i in range(900_000))
    tracemalloc.start()
    try:
        found = encoder.ids(text)
        kept, most = tracemalloc.get_traced_memory()[0], encoder.MOST_WORDS
    finally:
        tracemalloc.stop()
    assert found.tobytes() == text.replace(" ", "").encode()
    assert len(encoder) <= most and len(encoder.old) <= most and kept < 120_000_000


def test_packing_reads_short_batches(spark, monkeypatch):
    """Python gets at most BATCH_ROWS texts at once, and the session's own setting comes back."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    plain = packing.written
    monkeypatch.setattr(packing, "written", lambda df, label: seen.update({label: int(spark.conf.get(key))}) or plain(df, label))
    before = spark.conf.get(key)
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('word ', id) AS text").coalesce(1)
    rows = packing.packed(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    assert seen["pack-pieces"] <= 1000 < int(before) and spark.conf.get(key) == before


def test_first_fit():
    rng = np.random.RandomState(1)
    sizes = rng.randint(1, 100, 500)
    bins, _ = packing.first_fit_decreasing(sizes, 100)
    room, want = [], np.zeros(500, int)
    for i in np.argsort(-sizes, kind="stable"):
        want[i] = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if want[i] == len(room):
            room.append(100)
        room[want[i]] -= sizes[i]
    assert (bins == want).all()


def test_language(spark):
    r = random.Random(2)
    parts = {"aa": ["bla", "kor", "tum", "esh"], "bb": ["ñiva", "zuol", "pre", "éch"]}
    rows = [(i, " ".join(r.choice(parts[k]) + r.choice(parts[k]) for _ in range(r.randint(3, 40))), k) for i in range(200) for k in [("aa", "bb")[i % 2]]]
    extra = [(900, None, "aa"), (901, "12 ! 3", "aa"), (902, "", None), (903, "x", None)]
    docs = _docs(spark, rows + extra)
    found = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in language.identify(docs, language.fit(docs.where("doc_id < 100"))).collect()}
    assert sum(found[i][0] == k for i, _, k in rows) >= 198 and all(0 <= s <= 1 for _, s in found.values())
    assert [found[i] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    none = language.identify(docs, language.fit(docs.where("false")))
    assert {x["lang_pred"] for x in none.collect()} == {"und"}


def test_language_against_plain_python(spark):
    """Counts, false-positive correction and ties against sets of n-grams, one text after another."""
    from collections import Counter

    r = random.Random(8)
    parts = {"aa": ["bla", "kor", "tum", "esh", "ane"], "bb": ["ñiva", "zuol", "pre", "éch", "ane"], "cc": ["xyx", "wuw", "tum", "ane"]}
    rows = [(i, " ".join(r.choice(parts[k]) + r.choice(parts[k]) for _ in range(r.randint(1, 30))) + r.choice(["", " 12", "!\n", "  É"]), k) for i in range(150) for k in [("aa", "bb", "cc")[i % 3]]]
    rows += [(200, "Ane  ane-ANE", None), (201, "q", None), (202, "ane", None), (203, "", "aa"), (204, None, "bb"), (205, "x" * 70_000, None), (None, "tum tum", None), (5, rows[5][1], "cc")]

    def plain(text):
        marked = "".join(c.lower()[0] if c.isalpha() else " " for c in f" {text or ''} ")
        while "  " in marked:
            marked = marked.replace("  ", " ")
        return [marked[i : i + 3] for i in range(len(marked) - 2)]

    counts = {k: Counter(g for _, t, lang in rows if lang == k and t is not None for g in plain(t)) for k in parts}
    members = {k: {g for g, n in c.items() if n / c.total() >= language.MIN_SHARE} for k, c in counts.items()}
    docs = _docs(spark, rows)
    got = Counter((x["doc_id"], x["text"], x["lang_pred"], round(x["score"], 3)) for x in language.identify(docs, language.fit(docs)).collect())
    want = Counter()
    for i, t, _ in rows:
        own = plain(t)
        hits = [sum(g in members[k] for g in own) for k in sorted(parts)]
        some = bool(own) and any(map(str.isalpha, t or ""))
        want[i, t, sorted(parts)[hits.index(max(hits))] if some else "und", round(max(hits) / len(own), 3) if some else 0.0] += 1
    assert got == want


def test_language_filter_counts():
    import pandas as pd

    keys = np.arange(1, 2001, dtype=np.int64) * 7919
    f = language.Filters(["a", "b"], pd.DataFrame({"gram": keys, "language": np.arange(2000) % 2}))
    assert f.slices.shape == (1, language.SLOTS) and (f.false < 1e-6).all()


def test_lm_scoring(spark, corpus):
    from collections import Counter

    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in corpus}
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2
    tokens = {r[0]: brute.words((r[1] or "").lower()) + [""] for r in corpus}
    c = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    rows = {r["doc_id"]: r for r in lm_scoring.scored(_docs(spark, corpus), learn=learn).collect()}
    for k, ws in tokens.items():
        r = rows[k]
        assert (r["learn"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not held[k], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert rows[300]["bits_per_byte"] is None


def _start(rng=None):
    flat = {n: np.full((bits, len(sizes)), 0.3) for n, (bits, sizes) in lm_scoring.STREAMS.items()}
    return flat if rng is None else {n: w + rng.normal(size=w.shape) * 0.1 for n, w in flat.items()}


def test_mixer_is_a_probability():
    """All values of one decision chain share probability 1."""
    table = np.random.RandomState(0).normal(size=lm_scoring.SLOTS).astype(np.float32)
    total = 0.0
    for value in range(256):
        one = np.array([value]), np.array([0]), np.array([0])
        total += 10 ** lm_scoring.mix([("class", one[2], one[1], one[0], tuple(np.array([x]) for x in (0, 5, 9)))], table, _start(), 1)[0]
    assert total == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("name", ["repeat", "class", "place", "byte"])
def test_mixer_against_plain_python(name):
    """One decision after another, weights stepped at the ends of chunks."""
    rng = np.random.RandomState(4)
    table, start = rng.normal(size=lm_scoring.SLOTS).astype(np.float32), _start(rng)
    bits, sizes = lm_scoring.STREAMS[name]
    sizes_of_docs = (1, 7, 40, 90)
    doc, pos = np.repeat(range(4), sizes_of_docs), np.concatenate([np.arange(n) for n in sizes_of_docs])
    value, contexts = rng.randint(0, 1 << bits, len(doc)), [rng.randint(0, min(s, 500), len(doc)) for s in sizes]
    want = []
    for k in range(4):
        w, total, at = start[name].astype(float).copy(), 0.0, 0
        own = np.flatnonzero(doc == k)
        while at < len(own):
            size = lm_scoring.FIRST_CHUNK * (at // lm_scoring.FIRST_CHUNK + 1)
            step, chunk = np.zeros_like(w), own[at : at + size]
            for t in chunk:
                for d, (bit,), slots in [(d, b, sl) for d, b, sl in lm_scoring._decisions(name, value[t : t + 1], [c[t : t + 1] for c in contexts])]:
                    x = np.array([table[s[0]] for s in slots], float)
                    p = 1 / (1 + math.exp(-w[d] @ x))
                    total += math.log10(p if bit else 1 - p)
                    step[d] += (bit - p) * x
            w += lm_scoring.RATES[name] * step / (len(chunk) + 8)
            at += size
        want.append(total)
    assert lm_scoring.mix([(name, doc, pos, value, tuple(contexts))], table, start, 4) == pytest.approx(want, rel=1e-4)


def test_streams_look_two_tokens_back_and_at_the_last_byte():
    """Of two documents, class streams tell the class two tokens before; byte streams see the last byte alone too."""
    n = np.array([3, 3])
    flags = np.zeros(6, bool)
    run = lambda cls: {s[0]: s[4] for s in lm_scoring._streams(np.array(cls, np.uint8), np.zeros(6, np.uint8), ~flags, flags, np.zeros(6, np.uint8), np.zeros(6, np.uint8), np.concatenate([[0], np.cumsum(n)]), [b"", b""])}
    for name in ("known", "class"):
        one, other = run([7, 8, 9, 1, 8, 9])[name], run([7, 8, 9, 7, 8, 9])[name]
        assert any(c[2] != c[5] for c in one) and all(c[2] == c[5] for c in other)
    new = np.array([True, False])
    mark = np.array([5, 0], np.uint8)  # the second token stands behind a marked one
    streams = {s[0]: s for s in lm_scoring._streams(np.zeros(2, np.uint8), np.zeros(1, np.uint8), new, ~new & False, np.zeros(2, np.uint8), mark, np.array([0, 2]), [b"aba "])}
    assert any(c.tolist() == [32, 97, 98, 97] for c in streams["byte"][4]) and len(streams["byte"][4]) == len(lm_scoring.STREAMS["byte"][1]) == 5


def test_lm_tokens_against_plain_python():
    """Places, hashes, classes and groups of the tokens of odd texts are those of their words."""
    texts = ["", "A b\tB  a", "x" * 600_000 + " y", " \x85é\u3000É \ud800 ", "one\x0btwo\x0c\r\nOne", "", "z" * 3]
    raw, first, stop, h, counts, sizes = lm_scoring._tokens(texts)
    words = [w for t in texts for w in [*t.encode("utf-8", "surrogatepass").lower().split(), b""]]
    assert [raw[a:b].tobytes() for a, b in zip(first, stop)] == words and counts.tolist() == [len(t.encode("utf-8", "surrogatepass").split()) + 1 for t in texts]
    assert sizes.tolist() == [len(t.encode("utf-8", "surrogatepass")) for t in texts]
    cls = lm_scoring._classes(raw, first, stop)
    assert len(set(zip(words, h.tolist(), cls.tolist()))) == len(set(words)) == len(set(h.tolist()))
    close = np.array([1 << 40, (1 << 40) + 1, 1 << 40, 5, (1 << 40) + 1], np.uint64)  # alike in their first bits
    for keys in (h, close, np.zeros(0, np.uint64)):
        order, heads = lm_scoring._grouped(keys)
        assert keys[order].tolist() == sorted(keys.tolist()) and keys[order][heads].tolist() == sorted(set(keys.tolist()))


def test_choices_against_plain_python():
    """The last choice of each token, one token after another."""
    rng = np.random.RandomState(6)
    docs = [rng.randint(0, 12, n) for n in (1, 5, 60)]
    k_of, leaf_of = rng.randint(0, 5, 12), rng.randint(0, 3, 12)
    totals = np.zeros((2, 1 << 16), np.int64)
    for w in range(12):
        totals[:, leaf_of[w]] += k_of[w] * np.array([1, 2])
    learn, word = np.array([False, True, True]), np.concatenate(docs)
    again, _, got = lm_scoring._choices(word, leaf_of[word], k_of[word], np.cumsum([0, *map(len, docs)]), totals, learn)
    want, flags = [], []
    for i, d in enumerate(docs):
        held = []
        for w in d:
            flags.append(w in held)
            if w in held:
                mass = sum(k_of[v] for v in set(held))
                share = held.count(w) / len(held)
                want.append(math.log10((share + k_of[w] / mass) / 2 if mass else share))
            else:
                rest = totals[int(learn[i]), leaf_of[w]] - sum(k_of[v] for v in set(held) if leaf_of[v] == leaf_of[w])
                want.append(math.log10(k_of[w] / rest) if k_of[w] else 0.0)
            held.append(w)
    assert again.tolist() == flags and got == pytest.approx(want)


def test_fit_recovers_what_the_counts_say(spark, corpus):
    """Fitted weights code the training documents in fewer bits than the start's."""
    docs = lm_scoring._blocked(_docs(spark, corpus), "doc_id", "text", F.lit(True))
    rows = lm_scoring.written(lm_scoring._word_rows(docs), "t")
    counts = rows.groupBy("word").agg(F.sum("n").alias("c"))
    encoded = lm_scoring.written(lm_scoring._encoded(docs, rows.select("block", "word").join(counts, "word"), 1000, 100, np.full((2, 1 << 16), 10_000)), "t")
    gathered = lm_scoring._gathered(encoded)
    table, own = lm_scoring.logits(gathered), encoded.select(*lm_scoring.ENCODED).toPandas()
    run = lambda start: lm_scoring.mix(lm_scoring._streams(*lm_scoring._unpacked(own)), table, start, len(own)).sum()
    assert run(lm_scoring.fitted(encoded, gathered)) > run(_start())


def test_fit_is_over_all_training_documents(spark):
    """Weights code about as well as those of a plain regression over the decisions of every training document, of which there
    are many more than 512."""
    r = random.Random(9)
    vocab = [["".join(r.choice(letters) for _ in range(r.randint(1, 6))) for _ in range(200)] for letters in ("abcde", "vwxyz")]
    rows = [(i, " ".join(r.choice(vocab[i % 2]) if r.random() < 0.9 else f"{r.randrange(10**6)}" for _ in range(r.randint(1, 30)))) for i in range(1600)]
    docs = lm_scoring._blocked(_docs(spark, rows), "doc_id", "text", F.col("doc_id") % 5 > 0)
    words = lm_scoring.written(lm_scoring._word_rows(docs), "t")
    counts = words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0")
    encoded = lm_scoring.written(lm_scoring._encoded(docs, words.select("block", "word").join(counts, "word"), 1000, 100, np.full((2, 1 << 16), 10_000)), "t")
    gathered = lm_scoring._gathered(encoded)
    found, own = lm_scoring.fitted(encoded, gathered), encoded.where("learn").select(*lm_scoring.ENCODED).toPandas()
    assert len(own) == 1280
    for name, _, _, value, contexts in lm_scoring._streams(*lm_scoring._unpacked(own)):
        for d, bit, slots in lm_scoring._decisions(name, value, contexts):
            x = np.stack([lm_scoring._logit(np.maximum(gathered[2 * s] - (bit == 0), 0), np.maximum(gathered[2 * s + 1] - bit, 0)) for s in slots], axis=1).astype(float)
            cost = lambda w: np.logaddexp(0, np.where(bit == 1, -1, 1) * (x @ w)).sum() + lm_scoring.RIDGE / 2 * ((w - lm_scoring.START_WEIGHT) ** 2).sum()
            w = np.full(len(slots), lm_scoring.START_WEIGHT)
            for _ in range(12):
                p = 1 / (1 + np.exp(-(x @ w)))
                w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + lm_scoring.RIDGE * np.eye(len(w)), x.T @ (p - bit) + lm_scoring.RIDGE * (w - lm_scoring.START_WEIGHT))
            assert cost(found[name][d]) < 1.006 * cost(w), (name, d)  # logits are sorted into levels


def test_empty_tables(spark):
    none = _docs(spark, []) if False else spark.createDataFrame([], CLASH)
    for out in (
        exact_dedup.exact_groups(none), mixing.mix(none), mixing.mixed_documents(none), pii.find_personal_data(none), substrings.without_repeats(none), minhash.near_duplicates(none), packing.packed(none), lm_scoring.scored(none),
        language.identify(none, language.fit(none)), embeddings.linked_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")), chat.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ):
        assert out.count() == 0


def test_null_ids_and_repeated_rows(spark):
    """Rows without an id and rows alike are rows: none is lost and none is made."""
    text = " ".join(f"word{i % 11}" for i in range(60))
    rows = [(None, text, "en", "s"), (1, text, "en", "s"), (1, text, "en", "s"), (None, None, None, None), (2, "", None, "s"), (2, "other words", "en", None)]
    docs, ids = _docs(spark, rows), sorted((r[0] for r in rows), key=repr)
    for out in (
        exact_dedup.exact_groups(docs), mixing.mix(docs), pii.find_personal_data(docs), substrings.without_repeats(docs), minhash.near_duplicates(docs), lm_scoring.scored(docs), language.identify(docs, language.fit(docs)),
        packing.packed(docs).where("start = 0"),
    ):
        assert sorted((r["doc_id"] for r in out.select("doc_id").collect()), key=repr) == ids
    said = spark.createDataFrame([(None, 1, "user", "a"), (None, 1, "user", "a"), (3, None, None, None)], "conv_id long, turn long, role string, text string")
    assert sorted(((r["conv_id"], r["n_turns"]) for r in chat.digests(chat.formatted(said)).collect()), key=repr) == [(3, 1), (None, 2)]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    _docs(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages(spark, corpus, tmp_path):
    import corpus_pipeline

    words = "the cat sat on a mat while dogs ran over green hills and rivers".split()
    r = random.Random(9)
    more = [(400 + i, " ".join(r.choice(words) for _ in range(60)), "en", f"s{i % 3}") for i in range(40)] + [(500, "12345 !!", "en", "s0")]
    _docs(spark, corpus + more).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    first = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    ids = {x["doc_id"] for x in first.collect()}
    assert first.columns == docs.columns and not ids & {300, 301, 302, 500} and {400, 0, 100} <= ids
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {p["doc_id"] for p in pieces}
    assert kept <= ids and 304 not in kept and pieces
