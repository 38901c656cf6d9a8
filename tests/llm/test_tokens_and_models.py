"""Shards, packing, language model, classifiers and wrappers."""

import json
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import gru_lm, langid, packing, repair_store, text, token_ids, wrappers, zstd_quality
from cohortloom.llm.token_ids import Encoder

ODD = ["", " ", "\n", "\n\n", " \n b", "a\n b", "a\n\n\nb c\n", "a\t\nb", "a\x1c b\x1c\nc \x1cd", "a.\nB. c\n'sd\n.x", "  a b", "a  b ", " x", "x \n y", "a\xa0 b", "<|endoftext|> a <|endoftext|>b", "don't 's  're", "\0a b", "tab\t x", "ünï cödé 漢字 かな", "a.b, c! d?", "x" * 3000, "word. Word.  word,\n\nword"]


def direct(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("remembered", [700_000, 3])
def test_encoder_is_the_tokenizer(remembered):
    encoder = Encoder(remembered=remembered)
    rng = random.Random(1)
    alphabet = ["a", "word", ".", ",", " ", " ", "\n", "'s", "é", "12", "\t", "x", "\u2028", "\xa0", "&", "(", "\u0301"]
    for turn in range(40):
        texts = ODD if turn == 0 else ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(20)]
        ids, counts = encoder.encode(texts)
        expected = [direct(encoder, t) for t in texts]
        assert list(counts) == [len(e) for e in expected]
        assert ids.tolist() == sum(expected, [])


def test_encoder_remembers_words_not_words_with_marks():
    words = [a + b + c for a in ("ber", "lón", "ДаШ", "Q") for b in ("", "xe", "ß") for c in ("ta", "rÿ")]
    texts = ["first " + " ".join(w + m for w in words for m in ("", ",", ".", "!")), "", None, "odd  " + words[0], words[1] + "."]
    encoder = Encoder()
    for column in (pa.array(texts), pa.array(["cut off", *texts])[1:], pa.array(texts, pa.large_string())):
        ids, counts = encoder.encode(column)
        expected = [direct(encoder, t or "") for t in texts]
        assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == sum(expected, [])
    # beside the words: the line end, three marks, the texts' first pieces, the parts of an odd text
    assert encoder.size <= len(words) + 12


def test_plain_words_are_letters_and_one_mark():
    strings = [chr(k) for k in range(1, 0x900) if not 0xD800 <= k < 0xE000] + ["", "ab", "a.", "a..", ".a", ".", "é,", "漢", "漢.", "a漢", "a1", "1.", "a\u0301", "\U0001f600"]
    strings += ["x" + s + m for s in strings for m in ("", ".")]
    is_word = [s.isalpha() and max(s) < token_ids._PLAIN for s in strings]
    marked = [s[-1:] in token_ids._MARKS and s[:-1].isalpha() and max(s[:-1]) < token_ids._PLAIN for s in strings]
    for column in (pa.array(strings), pa.array(["é", *strings], pa.large_string())[1:]):
        plain, last = token_ids._words(column)
        assert plain.tolist() == [a or b for a, b in zip(is_word, marked)]
        assert last.tolist() == [ord(s[-1]) if b else 0 for s, b in zip(strings, marked)]


def test_shards_decode_to_the_same_ids():
    rng = np.random.default_rng(1)
    words = [rng.integers(3, 300, rng.integers(1, 6)) for _ in range(40)]
    documents = [np.concatenate([*(words[i] for i in rng.integers(0, 40, rng.integers(0, 400))), [2]]).astype(np.uint32) for _ in range(60)]
    documents[5] = np.array([7] * 999 + [2], np.uint32)
    payload = repair_store.compress(documents)
    shard = repair_store.Shard(payload)
    assert (shard.ids(0, 60) == np.concatenate(documents)).all()
    assert len(payload) < 2 * sum(map(len, documents))
    for k in (0, 5, 17, 59):
        assert (shard.ids(k, k + 1) == documents[k]).all()
        for a, b in ((0, 1), (0, len(documents[k])), (len(documents[k]) // 3, len(documents[k]) // 2 + 1)):
            assert (shard.slice(k, a, b) == documents[k][a:b]).all()
    with pytest.raises(ValueError):
        repair_store.Shard(b"XXXX" + payload[4:])


def test_pairs_are_replaced_to_the_end():
    run, period = np.full(20_000, 7), np.tile(np.arange(100, 132), 2000)
    for ids, most in ((run, 40), (period, 80)):
        document = np.append(ids, 2).astype(np.uint32)
        shard = repair_store.Shard(repair_store.compress([document, document]))
        assert len(shard.symbols) + len(shard.rules) < 2 * most
        assert (shard.ids(1, 2) == document).all() and (shard.slice(0, 777, 5001) == document[777:5001]).all()
    rng = np.random.default_rng(4)
    document = np.append(np.repeat(rng.integers(3, 6, 9000), rng.integers(1, 9, 9000)), 2).astype(np.uint32)
    shard = repair_store.Shard(repair_store.compress([document]))
    assert (shard.ids(0, 1) == document).all()
    pairs, counts = np.unique(np.stack([shard.symbols[:-2], shard.symbols[1:-1]]), axis=1, return_counts=True)
    # equal pairs overlap, so a pair of equals may be counted twice as often as it can be replaced
    assert counts[pairs[0] != pairs[1]].max() < repair_store.LEAST_COUNT


def test_wide_symbols_come_back():
    ids = np.arange(1 << 17, dtype=np.uint32) + 3
    shard = repair_store.Shard(repair_store.compress([np.append(ids, 2).astype(np.uint32)]))
    assert (shard.ids(0, 1)[:-1] == ids).all()


def test_shards_of_a_table(spark):
    texts = ODD + [None, "again", "again"]
    docs = spark.createDataFrame([(100 - i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, payload string")
    shards = repair_store.write_shards(docs, shard_ids=50)
    assert shards.count() > 1
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in repair_store.read_documents(shards).collect()))
    encoder, at = Encoder(), 0
    by_id = sorted(((100 - i if i else -1, t) for i, t in enumerate(texts)))
    for (start, doc, n, crc), (want, text) in zip(got, by_id, strict=True):
        ids = [*direct(encoder, text or ""), 2]
        assert (start, -1 if doc is None else doc, n, crc) == (at, want, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert repair_store.read_documents(repair_store.write_shards(docs.limit(0))).count() == 0


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["alpha", "be", "c", "delta"], k=rng.choice([0, 3, 50, 400, 900, 3000]))) for _ in range(120)] + [None, ""]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    rows = packing.packed(docs).toPandas()
    encoder = Encoder()
    for i, text in enumerate(texts):
        ids = np.array([*direct(encoder, text or ""), 0], "<u4")
        own = rows[rows.doc_id == i].sort_values("start")
        assert own.start.tolist() == (own.length.cumsum() - own.length).tolist() and own.length.sum() == len(ids)
        assert (own.doc_tokens == len(ids)).all()
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in zip(own.start, own.length, own.ids_crc32))
    by = rows.sort_values(["sequence_id", "offset"])
    assert (by.offset == by.groupby("sequence_id").length.cumsum() - by.length).all()
    used = by.groupby("sequence_id").length.sum()
    assert used.max() <= 1024 and used.sum() >= 0.95 * 1024 * len(used) - 1024
    assert packing.packed(docs.limit(0)).count() == 0


def test_column_generation_reaches_the_bound():
    sizes = np.array([3, 5, 6, 9])
    demand = np.array([40.0, 30.0, 25.0, 12.0])
    patterns, amount = packing.column_generation(sizes, demand, 10)
    assert (patterns @ sizes <= 10).all() and np.allclose(patterns.T @ amount, demand)
    assert amount.sum() < 63.6  # (40 + 30 + 25 + 12 pieces) cannot do with less than 59.8
    plan = packing.rounded(sizes, demand, 10)
    assert sum(n * p for p, n in plan).tolist() == demand.tolist()
    value, counts = packing.price(np.array([0.3, 0.5, 0.7, 0.95]), sizes, 10)
    assert value == pytest.approx(1.0) and counts @ sizes <= 10


def words_of(text):
    return [*gru_lm.lower_words((text or "").encode()), gru_lm.END]


def test_model_scores(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the", "cat", "sat", "on", f"w{rng.randint(0, 500)}"], k=rng.randint(0, 80))) for _ in range(150)]
    texts += [None, "", "Unseen WORDS here", "The CAT"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in gru_lm.likelihood(docs).collect()}
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    counts: dict = {}
    for t, h in zip(texts, held):
        for w in [] if h else words_of(t):
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    for i, t in enumerate(texts):
        words = words_of(t)
        base = sum(np.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in words)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(words), sum(w in counts for w in words), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert sum(got[i]["score"] for i in got) > sum(got[i]["base_score"] for i in got)
    assert gru_lm.score(docs.limit(0), docs.limit(0)).count() == 0
    assert gru_lm.score(docs, docs.limit(0)).where("n_known > 0 OR train_tokens > 0").count() == 0


def lexicon():
    words = [b"", b"a", b"b", *[b"word%d" % k for k in range(3000)]]
    counts = [300, 200, 100, *[3000 - k for k in range(3000)]]
    order = sorted(range(len(words)), key=lambda k: -counts[k])
    words, counts = [words[k] for k in order], [counts[k] for k in order]
    n, v = np.zeros(gru_lm.TAILS), np.zeros(gru_lm.TAILS)
    for w, c in zip(words[gru_lm.CLASS_WORDS * gru_lm.WORD_CLASSES :], counts[gru_lm.CLASS_WORDS * gru_lm.WORD_CLASSES :]):
        n[gru_lm.tail_class(w)] += c
        v[gru_lm.tail_class(w)] += 1
    return gru_lm.Lexicon(words, counts, sum(counts), len(words), n, v)


def test_model_is_a_distribution_and_carries_state(monkeypatch):
    own = lexicon()
    p = gru_lm.initial(own)
    h = np.random.default_rng(1).standard_normal((1, gru_lm.HIDDEN)).astype(np.float32)
    every = len(own.words)
    logp = gru_lm.output(p, np.repeat(h, every, axis=0), own.kind, own.slot) + own.inside
    unseen = np.exp(gru_lm.output(p, np.repeat(h, gru_lm.TAILS, axis=0), gru_lm.WORD_CLASSES + np.arange(gru_lm.TAILS), np.zeros(gru_lm.TAILS, int)) + np.log(0.5) - own.log_tail)
    assert np.exp(logp).sum() + unseen.sum() == pytest.approx(1, abs=1e-4)
    encode = gru_lm._encoder(own)
    texts = [b"a b word1 word7 unseen", b"", b"b " * 200, b"word2999 a", b"word5"]
    made = [encode(t)[3:] for t in texts]
    together = gru_lm.score_texts(p, *(list(x) for x in zip(*made)))
    alone = [gru_lm.score_texts(p, *([x] for x in one))[0] for one in made]
    monkeypatch.setattr(gru_lm, "SCORE_LANES", 2)
    monkeypatch.setattr(gru_lm, "SCORE_STEPS", 3)
    assert np.allclose(together, alone, rtol=1e-4) and np.allclose(gru_lm.score_texts(p, *(list(x) for x in zip(*made))), alone, rtol=1e-4)


def test_gradients_are_slopes():
    own = lexicon()
    rng = np.random.default_rng(2)
    p = {k: x.astype(np.float64) for k, x in gru_lm.initial(own).items()}
    p["class_w"], p["word_w"] = p["class_w"] * 30, p["word_w"] * 30
    rows = [rng.integers(0, 2016, 7) for _ in range(2)]
    kind, slot = np.concatenate(rows) // gru_lm.CLASS_WORDS, np.concatenate(rows) % gru_lm.CLASS_WORDS

    def window(p):
        h, saved, at = np.zeros((2, gru_lm.HIDDEN)), [], []
        for t in range(7):
            now = np.array([t, 7 + t])
            x = np.full(2, gru_lm.ROWS - 1) if t == 0 else np.concatenate(rows)[now - 1]
            nxt, gates = gru_lm.step(p["input"][x], h, p["state"])
            saved.append((x, h, gates, nxt, np.full(2, t == 0)))
            at.append(now)
            h = nxt
        return saved, np.concatenate(at)

    def loss(p):
        saved, at = window(p)
        return -gru_lm.output(p, np.concatenate([s[3] for s in saved]), kind[at], slot[at]).mean()

    saved, at = window(p)
    g = gru_lm.gradients(p, saved, at, np.ones(14, bool), kind, slot)
    for name, place in (("state", (1, 2)), ("state", (3, 40)), ("class_w", (2, 5)), ("input", (gru_lm.ROWS - 1, 9)), ("word_w", (int(kind[3]), 4, int(slot[3])))):
        up, down = ({k: x.copy() for k, x in p.items()} for _ in range(2))
        up[name][place] += 1e-5
        down[name][place] -= 1e-5
        slope = (loss(up) - loss(down)) / 2e-5
        assert g[name][place] == pytest.approx(slope, rel=2e-2, abs=1e-5)


def test_model_is_trained_on_every_text(spark, monkeypatch):
    def counted(p, rows, kinds, slots, passes, rate):
        p["class_b"][0] += sum(map(len, rows))
        return p

    monkeypatch.setattr(gru_lm, "train", counted)
    monkeypatch.setattr(gru_lm, "LEAST_TOKENS", 1)
    docs = spark.createDataFrame([(None if i % 50 == 0 else f"a w{i} " * (i % 7),) for i in range(400)], "text string")
    own = gru_lm._lexicon(gru_lm.word_counts(docs))
    p = gru_lm.unflat(gru_lm.fit(docs, own, spark.sparkContext.broadcast(own.given)))
    assert p["class_b"][0] - gru_lm.initial(own)["class_b"][0] == pytest.approx(own.total, abs=0.01)


def test_training_has_no_ragged_end():
    own = lexicon()
    before = gru_lm.initial(own)
    rows = [np.zeros(10, int) for _ in range(9)] + [np.r_[np.zeros(400, int), 1000]]
    p = gru_lm.train({k: x.copy() for k, x in before.items()}, rows, [x // gru_lm.CLASS_WORDS for x in rows], [x % gru_lm.CLASS_WORDS for x in rows], 1)
    late = 1000 // gru_lm.CLASS_WORDS  # the class of the last word of the longest text
    changed = [k for k in range(gru_lm.WORD_CLASSES) if (p["word_w"][k] != before["word_w"][k]).any()]
    assert changed == [0, late]


def test_texts_are_encoded_side_by_side(monkeypatch):
    own = lexicon()
    texts = ["".join(map(chr, range(128))), None, "", " a B\x0bword1 ", "x y  zz\u00e9 x", "\t\n", "\x1ca\x1fb WORD2999", "a " * 50, "b"]
    column = pa.array(["left out", *texts]).slice(1)
    plain = [words_of(t) for t in texts]
    words, counts = gru_lm.split_words(column)
    assert words.to_pylist() == [w for t in plain for w in t[:-1]] and counts.tolist() == [len(t) - 1 for t in plain]
    number = {w: i for i, w in enumerate(own.words)}
    encode = gru_lm._batch_encoder(own)
    lengths, ids, rare, rare_words, row, kind, slot = encode(column)
    flat = [w for t in plain for w in t]
    assert lengths.tolist() == [len(t) for t in plain] and ids.tolist() == [number.get(w, -1) for w in flat]
    assert rare_words.to_pylist() == [flat[i] for i in rare] == [w for w in flat if w not in number]
    assert kind[rare].tolist() == [gru_lm.WORD_CLASSES + gru_lm.tail_class(w) for w in rare_words.to_pylist()]
    lists = gru_lm.rare_lists(lengths, rare, rare_words).to_pylist()
    assert [{x["word"]: x["times"] for x in t} for t in lists] == [{w: t.count(w) for w in t if w not in number} for t in plain]
    monkeypatch.setattr(gru_lm, "TEXT_BYTES", 40)
    slices = list(gru_lm.text_slices(column))
    assert [len(s) for s in slices] != [len(texts)] and [t for s in slices for t in s.to_pylist()] == texts


def test_no_softmax_of_the_model_is_wide():
    """Tail classes beside the classes of words made the first softmax 106 columns wide."""
    shapes = gru_lm.SHAPES
    assert shapes["class_w"][1] + shapes["word_w"][2] < 100


SF = "/root/testdata/sf0.01"


def test_quality_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = zstd_quality.quality(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() >= 0.9 and held[held.quality == 1].predicted.mean() >= 0.97
    rows = zstd_quality.labelled_sample(docs, labels, lambda c: zstd_quality.fold(c, 4) != 2)
    score = zstd_quality.Model(rows).scorer()
    texts = {r["doc_id"]: r["text"] for r in docs.limit(40).collect()}
    scores = {r["doc_id"]: r["score"] for r in zstd_quality.quality(docs, labels).collect()}
    assert all(scores[i] == pytest.approx(score((t or "").encode())) for i, t in texts.items())


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, None), (None, ""), (1, "good text")], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    got = zstd_quality.quality(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    assert zstd_quality.quality(docs.limit(0), labels).count() == 0
    assert zstd_quality.quality(docs, labels.limit(0)).count() == 4


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.languages_of(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.97 and got.score.between(0, 1).all()


def test_language_edge_rows(spark):
    rows = [(i, "der hund und die katze " * 3 if i % 2 else "the dog and the cat " * 3, "de" if i % 2 else "en") for i in range(60)]
    rows += [(70, None, "de"), (71, "", "de"), (72, "123 !?", "en"), (73, "und die katze", None), (None, "the dog", None), (74, "the dog", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("x"))
    got = {r["doc_id"]: r for r in langid.languages_of(docs).collect()}
    assert [got[i]["lang_pred"] for i in (70, 71, 72)] == ["und"] * 3 and got[71]["score"] == 0
    assert got[73]["lang_pred"] == "de" and got[None]["lang_pred"] == "en" and got[74]["lang_pred"] == "en"
    assert langid.languages_of(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.languages_of(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_long_texts_do_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(zstd_quality, "SAMPLE_BYTES", 40_000)
    words = {1: "clear plain sentence about the garden ", 0: "buy cheap pills now click here "}
    docs = spark.createDataFrame([(i, words[i % 2] * (1500 if i % 10 < 2 else 4) + str(i)) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    rows = zstd_quality.labelled_sample(docs, labels, lambda _: F.lit(True))
    for q in (0, 1):
        own = [t for k, t in rows if k == q]
        assert len(own) == 50 and 20_000 < sum(map(len, own)) <= 40_000 and min(map(len, own)) > 100
    got = zstd_quality.quality(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.9


def test_language_of_long_texts_only(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 60_000)
    rows = [(i, f"{i} " + ("das Mädchen hört die Vögel über dem Fluß " * 900 if i % 2 else "the dog and the cat "), "de" if i % 2 else "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(r["lang_pred"] == ("de" if r["doc_id"] % 2 else "en") for r in langid.languages_of(docs).collect())


def test_excerpts():
    long = "".join(chr(0x100 + k % 900) for k in range(20_000)).encode()
    made = text.excerpt(long, 5000)
    assert 3900 < len(made) <= 5000 and made.decode() and made[-1024:] in long and text.excerpt(long, len(long)) == long
    assert text.level([5, 50, 7, 90], 52) == 20 and text.level([5, 7], 12) == 7 and text.level([], 9) == 0


def test_weights_are_sparse():
    samples = langid.shares([b"the dog and the cat", b"der hund und die katze"] * 20)
    w, _ = langid.train(samples, np.array([0, 1] * 20), 2, np.ones(1 << langid.BITS))
    assert 0 < np.count_nonzero(w) < 400


def page(body, extra=""):
    return f"<html><head><title>t</title><script>if (a < b) x = '</p>';</script></head><body><nav><a href=x>Menu</a></nav><header>Top</header>{body}<aside>Side</aside><div class='cookie-notice'>Cookies</div>{extra}<form>Name <input></form><footer>End</footer></body></html>"


CASES = [
    (page("<article><h1>A &amp; B</h1><p>One\n  two<b>!</b><p>Three&nbsp;four<br>five<div class='ad'>Buy</div><ul><li>x<li>y</ul></article>"), "A & B\nOne two!\nThree four\nfive\nx\ny"),
    (page("<article><p>Only</p><section id='comments'><p>Nice!</p></section></article>"), "Only"),
    (page("<main><p>A</p><style>p{}</style><!-- no --><p>B &lt;tag&gt; &#233;</p></main>"), "A\nB <tag> é"),
    (None, ""),
    ("", ""),
    ("just < text", "just < text"),
    ("<p>unclosed <i>tag", "unclosed tag"),
]


def test_main_texts(spark):
    rows = [(i, f"http://h{i % 3}.example/{i}", h) for i, (h, _) in enumerate(CASES)] + [(90, None, CASES[0][0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in wrappers.main_texts(pages).collect()}
    for i, (_, expected) in enumerate(CASES):
        assert got[i]["text"] == expected and got[i]["n_chars"] == len(expected)
    assert got[90]["text"] == CASES[0][1]
    assert wrappers.main_texts(pages.limit(0)).count() == 0


def test_wrapper_finds_the_varying_part():
    pages = [f"<body><div class='menu'>Home</div><div class='x'><h2>Fixed</h2></div><div class='content'>{''.join(f'<p>text {k} {j} of some length</p>' for j in range(k + 1))}</div></body>" for k in range(4)]
    expression, path, fixed = wrappers.infer(pages)
    assert "(<p>#</p>)+" in expression and path == ["body", "div.content"]
    assert wrappers.main_text(pages[2], path, set(fixed)) == "\n".join(f"text 2 {j} of some length" for j in range(3))
    expression, _, _ = wrappers.infer(["<ul><li>a</li></ul>", "<ul><li>a</li><li>b</li></ul><hr>"])
    assert expression == "<page><ul>(<li>#</li>)+</ul>(<hr></hr>)?</page>"


def test_texts_of_few_pages_are_not_fixed():
    plain = [f"<body><p>first of page {k}</p><p>second of page {k}</p></body>" for k in range(4)]
    quoted = "<body><p>opening</p><blockquote>A quote</blockquote><p>closing</p></body>"
    _, path, fixed = wrappers.infer([*plain, quoted])
    assert wrappers.main_text(quoted, path, set(fixed)) == "opening\nA quote\nclosing"
    assert wrappers.main_text(plain[1], path, set(fixed)) == "first of page 1\nsecond of page 1"


def test_fixed_texts_go_at_their_place_only():
    made = [f"<body><h3>Our journal</h3><p>text {k} a</p><p>text {k} b</p><ul><li>Follow us</li></ul></body>" for k in range(4)]
    _, path, fixed = wrappers.infer(made)
    quoting = "<body><h3>Our journal</h3><p>Follow us</p><p>Our journal</p><ul><li>Follow us</li></ul></body>"
    assert wrappers.main_text(made[0], path, set(fixed)) == "text 0 a\ntext 0 b"
    assert wrappers.main_text(quoting, path, set(fixed)) == "Follow us\nOur journal"


WORDED = [
    "<body class='single has-sidebar comments-open'><article class='post tag-social'><p>text {k}</p><div class='ad'>Buy</div></article></body>",
    "<body><div id='article-with-sidebar'><article><p>text {k}</p></article></div></body>",
    "<body><div class='page'><div class='content has-sidebar'><p>text {k}</p></div></div><div class='ad'>Buy</div></body>",
    "<body><div class='related'><article>See</article></div><article><p>text {k}</p></article></body>",
]


@pytest.mark.parametrize("form", WORDED)
def test_words_do_not_make_the_article_frame(form):
    pages = [form.replace("{k}", f"{k} of this page") for k in "abcd"]
    _, path, fixed = wrappers.infer(pages)
    assert [wrappers.main_text(p, path, set(fixed)) for p in pages] == [f"{k} of this page".join(["text ", ""]) for k in "abcd"]


def test_deep_nesting():
    assert wrappers.main_text("<div>" * 5000 + "deep" + "</div>" * 5000, [], set()) == "deep"
    assert wrappers.infer(["<div>" * 5000 + "deep"])[0]


BROKEN = [
    ("İ" * 30 + "<script>x</script><p>kept</p>", "İ" * 30 + "\nkept"),
    ("<p title=it's>one</p><p>two</p><p>that's it</p>", "one\ntwo\nthat's it"),
    ('<p title="a > b" id=x\'y"z>one</p><p>"two"</p>', 'one\n"two"'),
    ('<p data-x="never closed>one</p><p>two</p>', "one\ntwo"),
    ("<p a = 'x' b= y c =z>one<br/>two</p>", "one\ntwo"),
    ("<SCRIPT>if (a</scripts>b) x()</ScRiPt >after", "after"),
    ("one<p>two <b", "one\ntwo"),
]


@pytest.mark.parametrize("page, text", BROKEN)
def test_broken_marks_lose_no_text(page, text):
    assert wrappers.main_text(page, [], set()) == text


@pytest.mark.parametrize("piece", ['<a "', "<a '", '<a x="', "<!", "<a <b ", "<p>x", "<script>"])
def test_broken_pages_take_time_in_proportion(piece):
    def seconds(n):
        start = time.perf_counter()
        wrappers.parse(piece * n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(160_000) < 100 * max(seconds(10_000), 0.003)


def _two_templates(n):
    """Pages of one host without marked articles, in two templates, with the text that each should give."""
    made = []
    for k in range(n):
        body = [f"paragraph {k} {j} says something" for j in range(1 + k % 3)]
        blocks = "".join(f"<p>{b}</p>" for b in body)
        if k % 2:
            made.append((f"<html><body><div class='top'><b>Our paper</b></div><div class='story'>{blocks}</div><div class='end'><i>Imprint</i></div></body></html>", "\n".join(body)))
        else:
            made.append((f"<html><body><table class='bar'><tr><td>Home</td></tr></table><section class='text'>{blocks}</section></body></html>", "\n".join(body)))
    return made


def test_wrappers_come_from_all_pages_of_a_template(spark):
    made = _two_templates(40)
    made += [(made[0][0], made[0][1])] * 5
    pages = spark.createDataFrame([(k, "https://one.example/x", h, "clash", 1) for k, (h, _) in enumerate(made)], "page_id long, url string, html string, template string, host int").repartition(7)
    got = {r["row"]["page_id"]: r for r in wrappers.extract(pages).collect()}
    assert len(got) == len(made) and {r["row"]["template"] for r in got.values()} == {"clash"}
    assert [got[k]["text"] for k in range(len(made))] == [text for _, text in made]
    found = wrappers.infer_wrappers(pages).collect()
    assert len(found) == 2 and sorted(r["path"][-1] for r in found) == ["div.story", "section.text"]


def test_a_text_that_varies_on_a_late_page_is_no_frame(spark):
    made = [f"<html><body><h3>Series</h3><p>text {k}</p></body></html>" for k in range(30)] + ["<html><body><h3>Another head</h3><p>text x</p></body></html>"]
    pages = spark.createDataFrame([(k, "https://one.example/x", h) for k, h in enumerate(made)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages).collect()}
    assert got[0] == "Series\ntext 0" and got[30] == "Another head\ntext x"


def test_large_wrappers_become_loose():
    kinds = ("h2", "p", "ul", "pre")
    long = "<html><body>" + "".join(f"<{kinds[j * 7 % 4]}>part {j}</{kinds[j * 7 % 4]}>" for j in range(5000)) + "</body></html>"
    short = "<html><body><p>a</p><h2>b</h2></body></html>"
    expression, path, fixed = wrappers.infer([long, short])
    assert expression == "<page><html><body>((<h2>#</h2>)+?(<p>#</p>)+?(<pre>#</pre>)+?(<ul>#</ul>)+?)+</body></html></page>"
    assert wrappers.main_text(long, path, set(fixed)).count("\n") == 4999
    odd = [f"<html><body>{''.join(f'<x{k}-{j}>t</x{k}-{j}>' for j in range(300))}</body></html>" for k in range(300)]
    bounded = wrappers.reduce(wrappers.together, (wrappers.page_pattern(p)[1] for p in odd))
    assert bounded.size <= 2 * wrappers.MOST_KIDS + 10


def test_wrappers_are_handed_on_whole():
    kept = wrappers.Wrappers()
    for page, _ in _two_templates(9):
        kept.add("h", page)
    rows = list(kept.take())
    assert [form == "" for _, form, _ in rows] == [False, False, True] and not kept.own and not kept.nodes
    back = wrappers.loaded(json.loads(rows[0][2]))
    assert json.dumps(back.dump()) == rows[0][2]
    assert len(wrappers.loaded(json.loads(rows[2][2])).pages) == wrappers.FIXED_PAGES
