"""Sentence pieces with spans, spelling variants and source divergence, each against the library or brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cohortloom.llm import divergence, permuterm, piece_spans
from cohortloom.llm.piece_spans import Pieces
from conftest import rows

spm = pytest.importorskip("sentencepiece")

ALPHABET = [*"ab cd  ", "é", "ﬃ", "①", "㍿", "漢", "▁", "\U0001f600", "\t", "\n", "\xa0", "​", "ｶﾞ", "Å", "́", "¨", "½", "\0", "İ", "the ", "lation"]
RULES = [None, *[(r, s) for r in ("nmt_nfkc", "nfkc_cf") for s in (False, True)]]


def proto_with(rule):
    with open(piece_spans.default_model(), "rb") as file:
        base = file.read()
    if rule is None:
        return base
    name, squeeze = rule  # a later normaliser in the file stands for the earlier one
    return base + spm.SentencePieceNormalizer(
        rule_name=name, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze
    ).serialized_model_proto()


@pytest.mark.parametrize("rule", RULES)
def test_pieces_and_spans_are_the_library_s(rule):
    proto = proto_with(rule)
    own, library = Pieces(proto=proto, generation=40), spm.SentencePieceProcessor(model_proto=proto)
    rng = random.Random(1)
    texts = ["", " ", "  ", " a  b ", "▁▁ x", "  x  ", "éé", "́", *("".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(400))]
    for k in range(0, len(texts), 50):
        part = texts[k : k + 50]
        for text, (ids, first, past, decimal) in zip(part, own.encode([t.encode() for t in part]), strict=True):
            assert own.normalise(text.encode())[0].decode() == library.normalize(text)
            want = library.encode(text, return_type="proto").pieces
            assert ids.tolist() == [*(p.id for p in want), 2]
            size = len(text.encode())
            assert list(zip(first.tolist(), past.tolist()))[:-1] == [(p.begin, p.end) for p in want]
            assert (first[-1], past[-1]) == ((size, size) if rule is None or not rule[1] else (past[-1], past[-1]))
            assert decimal == " ".join(map(str, ids.tolist()))
            assert own.decode(ids) == library.decode(ids.tolist())


def test_bytes_that_are_no_text_are_replaced_singly():
    own = Pieces()
    text = b"a \xff\xfeb\xc3"
    made, place = own.normalise(text)
    assert made.decode() == "▁a▁��b�" and place[-1] == len(text)
    assert sorted(set(place.tolist())) == [0, 1, 2, 3, 4, 5, 6]


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(proto_with(None))
    model.pieces.add(piece="a▁b", score=0)
    with pytest.raises(ValueError):
        Pieces(proto=model.SerializeToString())
    model.pieces[-1].piece = "<user>"
    model.pieces[-1].type = 4
    with pytest.raises(ValueError):
        Pieces(proto=model.SerializeToString())


def test_documents_round_trip(spark):
    texts = ["Grüße, 漢字 \U0001f600!", None, "", "  two  spaces ", "again", "again", "wort " * 60_000 + "end"]
    docs = spark.createDataFrame([(i, t, [i], f"r{i}") for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>, row string")
    encoded = piece_spans.encode_documents(docs)
    library = spm.SentencePieceProcessor(model_file=piece_spans.default_model())
    for r in encoded.collect():
        text = texts[r.row.doc_id] or ""
        assert r.ids == [*library.encode(text), 2] and r.row.ids == [r.row.doc_id]
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends)) == raw
    assert {r.row.doc_id: r.text for r in piece_spans.decode_documents(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}
    got = {r.doc_id: r for r in piece_spans.digests(docs).collect()}
    for i, t in enumerate(texts):
        ids = [*library.encode(t or ""), 2]
        want = [len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()]
        assert [got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256] == want
    assert got[4][1:] == got[5][1:] and got[1][1:] == got[2][1:]
    assert piece_spans.digests(docs.limit(0)).count() == 0


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_force(counts, times=5):
    form, near = {}, {}
    for w in counts:
        others = sorted((v for v in counts if one_apart(v, w)), key=lambda v: (-counts[v], v))
        near[w] = len(others)
        if others and counts[others[0]] >= times * counts[w]:
            form[w] = others[0]
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], near[w], counts[form[w]] if w in form else None))
    return sorted(out, key=repr)


def test_variants_are_those_of_brute_force(spark):
    rng = random.Random(3)
    counts = {}
    for _ in range(250):
        counts["".join(rng.choices("aabé", k=rng.randint(1, 7)))] = rng.choice([1, 5, 5, 25, 125, 700, 4000])
    long = "".join(rng.choices("abc", k=70))
    for i, word in enumerate([long, long[:30] + "d" + long[31:], long[:40] + long[41:], "q" + long, long[:65], long[:64], long[:63] + "x", "z" * 66, "z" * 65, "z" * 64, "y" * 3000, "y" * 2999]):
        counts[word] = 10 * 6**i
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 3, ""), ("", 9, ""), ("nocount", None, "")], "word string, n long, rank string")
    got = sorted((tuple(r) for r in permuterm.group_variants(words).collect()), key=repr)
    assert got == by_force(counts)
    assert permuterm.group_variants(words.limit(0)).count() == 0


def test_words_of_documents(spark):
    texts = ["Straße STRASSE strasse×x a÷b don't", None, "", "word1word straße " * 3, "straße", "straße", "langwort" * 4000, "abcdef " * 30_000]
    docs = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, word int")
    want = Counter()
    for i, t in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{i or ''}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                want[run] += 1
    assert rows(permuterm.count_words(docs, every=3)) == sorted(want.items(), key=repr)
    frequent = {w: n for w, n in want.items() if n >= 5}
    assert rows(permuterm.spelling_groups(docs, every=3)) == by_force(frequent)


def audit_by_force(docs, least, listed):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        words = ["".join(c.lower() if c < "\x80" else c for c in w) for w in term.findall(text or "")]
        count[lang, source].update(words)
        seen[lang].update(set(words))
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = {s: count[g, s] for g, s in groups if g == lang}
        whole = sum(own.values(), Counter())

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        shares, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(-sum((p[t] - r[t]) ** 2 // (p[t] + r[t]) for t in kept), o) for o, r in shares.items() if o != s]
            terms = [(-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t) for t in kept if own[s][t] and p[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:listed])):
                out += [(lang, s, part, item, -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out, key=repr)


def test_divergence_is_that_of_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)] + ["naïve", "漢字", "LİL"]
    docs = []
    for i in range(300):
        lang = rng.choice(["en", "en", "de", None, "xx"])
        source = rng.choice(["a", "a", "a", "b", "c", None])
        bias = ord((source or "z")[0]) % 5
        text = " ".join(rng.choices(vocabulary[bias * 10 :], weights=[1 / (k + 1) for k in range(len(vocabulary) - bias * 10)], k=rng.randint(0, 80)))
        docs.append((lang, source, rng.choice([text, text.upper(), text.replace(" ", "3'")])))
    docs += [("en", "empty", None), ("en", "none", ""), ("solo", "only", "one two"), ("none", "x", "rare"), ("none", "y", None)] + [docs[0]] * 5
    docs += [("en", "b", "long " * 30_000)]
    table = spark.createDataFrame([(*d, 7, "t") for d in docs], "lang string, source string, text string, n int, term string")
    got = sorted((tuple(r) for r in divergence.audit(table, documents=4).collect()), key=repr)
    assert got == audit_by_force(docs, 4, 10)
    assert {r[2] for r in got if r[0] == "none"} == {"pair"}
    assert divergence.audit(table.limit(0)).count() == 0
