"""Language of whole texts: sparse multinomial logistic regression on TF-IDF of character n-grams.

One, two and three characters of the lower-case text are hashed to a fixed number of features.  A
text's term frequencies are shares of its n-grams; the inverse document frequencies come from all
texts that may be learned from.  Weights are trained with follow-the-regularised-leader (proximal,
elastic net) on a bounded sample, and a temperature fitted on held-back rows calibrates the scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_rows, map_texts, mix, parts, pieces, share_by_hash, small_batches, utf8
from cohortloom.llm.zstd_quality import fold

BITS, ORDERS = 15, (1, 2, 3)
#: Weights are fitted on so many bytes of text at most, shared equally by the languages, in the order of a hash of the id;
#: the longest texts of a language that has more give excerpts.
SAMPLE_BYTES, SAMPLE_ROWS = 12_000_000, 8000
EPOCHS, BATCH, ALPHA, BETA, L1, L2 = 4, 32, 0.5, 1.0, 0.02, 0.1
#: Shares are small numbers; this brings a feature that fills a hundredth of a text to one.
SCALE = 100.0
UNKNOWN = "und"
PART_BYTES = 1 << 18


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all n-grams of all texts, and the number of each text's n-grams.

    A text is framed by line ends, so every text has n-grams and none spans two texts.
    """
    framed = [("\n" + t.decode("utf-8", "replace").lower() + "\n") for t in texts]
    length = np.fromiter(map(len, framed), np.int64, len(framed))
    code = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(framed)), length)
    ends = np.repeat(np.cumsum(length), length)
    place = np.arange(len(code))
    features, owners, key = [], [], np.zeros(len(code), np.uint64)
    for n in ORDERS:
        key = key[: len(code) - n + 1] * np.uint64(0x10FFFF + 2) + code[n - 1 :] + np.uint64(1)
        inside = place[: len(key)] + n <= ends[: len(key)]
        features.append((mix(key[inside] + np.uint64(n << 60)) >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(owner[: len(key)][inside])
    owners_, features_ = np.concatenate(owners), np.concatenate(features)
    order = np.argsort(owners_, kind="stable")
    return features_[order], np.bincount(owners_, minlength=len(framed))


def shares(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct features of each text with their scaled shares."""
    features, counts = ngrams(texts)
    out = []
    for own in np.split(features, np.cumsum(counts)[:-1]):
        f, n = np.unique(own, return_counts=True)
        out.append((f, n * (SCALE / len(own))))
    return out


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts, over all rows of `text`."""

    def run(batches):
        total = np.zeros(1 << BITS, np.int64)
        rows = 0
        for batch in parts(batches):
            known = [t or b"" for t in utf8(batch.column(0))]
            rows += len(known)
            for piece in pieces(known, PART_BYTES):
                features, counts = ngrams(known[piece])
                owner = np.repeat(np.arange(len(counts)), counts)
                seen = np.unique(owner << BITS | features)
                total += np.bincount(seen & ((1 << BITS) - 1), minlength=1 << BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], rows), pa.int64())], names=["feature", "n"])

    counted = texts.mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequency, rows = np.zeros(1 << BITS), 0
    for feature, n in counted.collect():  # one row for each feature, whatever the corpus
        if feature < 0:
            rows = n
        else:
            frequency[feature] = n
    return frequency, rows


def train(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights (features x classes) and intercepts by FTRL-proximal with an elastic net."""
    size = len(idf)
    z, n = np.zeros((size, classes)), np.zeros((size, classes))
    z0, n0 = np.zeros(classes), np.zeros(classes)

    def weights(z, n, l1):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(len(samples))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            used = np.unique(np.concatenate([samples[i][0] for i in own]))
            x = np.zeros((len(own), len(used)))
            for k, i in enumerate(own):
                x[k, np.searchsorted(used, samples[i][0])] = samples[i][1] * idf[samples[i][0]]
            w, w0 = weights(z[used], n[used], L1), weights(z0, n0, 0.0)
            p = softmax(np.einsum("ij,jk->ik", x, w) + w0)
            p[np.arange(len(own)), labels[own]] -= 1
            g, g0 = np.einsum("ij,ik->jk", x, p) / len(own), p.mean(axis=0)
            z[used] += g - (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / ALPHA * w
            n[used] += g * g
            z0 += g0 - (np.sqrt(n0 + g0 * g0) - np.sqrt(n0)) / ALPHA * w0
            n0 += g0 * g0
    return weights(z, n, L1), weights(z0, n0, 0.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes held-back labels likeliest, from a fixed grid."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 120))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(known: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, weights (with idf and temperature inside) and intercepts from rows id, text, lang."""
    small_batches(known.sparkSession)
    frequency, rows = document_frequencies(known.select("text"))
    there = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row for each language
    languages = sorted(there)
    if not languages:
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros(0)
    known = known.withColumn("place", F.xxhash64("id", "text"))
    first = Window.partitionBy("lang").orderBy("place")
    wanted = SAMPLE_ROWS // len(languages) + 1
    enough = F.lit(False)
    for lang in languages:
        enough = enough | ((F.col("lang") == lang) & share_by_hash(F.col("place"), wanted, there[lang]))
    picked = known.where(enough).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= wanted)
    sample = bounded_rows(picked, "lang", SAMPLE_BYTES // len(languages), ["place"])
    idf = np.where(frequency > 0, np.log((1 + rows) / (1 + frequency)) + 1, 0.0)
    labels = np.array([languages.index(lang) for lang, _ in sample], np.int64)
    features = [s for k in range(0, len(sample), 64) for s in shares([text for _, text in sample[k : k + 64]])]
    held = np.arange(len(sample)) % 5 == 4
    fitted = np.flatnonzero(~held) if held.any() else np.arange(len(sample))
    if len(fitted) == 0:
        return languages, np.zeros((1 << BITS, len(languages)), np.float32), np.zeros(len(languages))
    w, w0 = train([features[i] for i in fitted], labels[fitted], len(languages), idf)
    t = 1.0
    if held.any():
        logits = np.array([(w[features[i][0]] * (features[i][1] * idf[features[i][0]])[:, None]).sum(axis=0) + w0 for i in np.flatnonzero(held)])
        t = temperature(logits, labels[held])
    return languages, (w * (idf * SCALE / t)[:, None]).astype(np.float32), w0 / t


def identify(docs: DataFrame, known: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`row` (the carried columns), lang_pred and score of each whole text.

    `known` has the rows to learn from: id, text, lang, none of them null.  A null text, and one
    without a letter, is `und` with score 0; so is every text where no language is known.  Equally
    likely languages: the first in order of name.  Repeated rows are predicted each.
    """
    languages, weights, intercept = fit(known)
    model = docs.sparkSession.sparkContext.broadcast((weights, intercept))

    def start():
        w, w0 = model.value

        def predict(texts):
            names, scores = [], []
            whole = [t or b"" for t in texts]
            for piece in pieces(whole, PART_BYTES):
                own = whole[piece]
                letters = [any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in own]
                if not languages:
                    names += [UNKNOWN] * len(own)
                    scores += [0.0] * len(own)
                    continue
                features, counts = ngrams(own)
                first = np.cumsum(counts) - counts
                logits = np.stack([np.add.reduceat(w[:, k][features], first, dtype=np.float64) / counts for k in range(len(languages))], axis=1)
                p = softmax(logits + w0)
                best = p.argmax(axis=1)
                names += [languages[b] if known else UNKNOWN for b, known in zip(best, letters)]
                scores += np.where(letters, p[np.arange(len(own)), best], 0.0).tolist()
            return [names, scores]

        return predict

    return map_texts(docs, [("lang_pred", T.StringType()), ("score", T.DoubleType())], start, text, carry)


def languages_of(docs: DataFrame) -> DataFrame:
    known = docs.where(fold("doc_id", 5) != 0).where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("doc_id").alias("id"), "text", "lang")
    doc = F.col("row").getField("doc_id")
    held = F.crc32(F.coalesce(doc.cast("string"), F.lit(""))) % 5 == 0
    return identify(docs, known, carry=["doc_id"]).select(doc.alias("doc_id"), held.alias("held_out"), "lang_pred", "score")
