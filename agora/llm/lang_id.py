"""Language identification: averaged hashed subword embeddings and a
linear softmax, trained by stochastic gradient descent in numpy.

A text's features are its 1- to 4-byte grams (UTF-8, lower-cased A-Z),
hashed to a fixed number of rows of an embedding table; their average goes
through a linear softmax.  The table times the output weights is one
vector of scores per row, which is all that prediction reads.

Training takes a bounded sample: about ``TRAIN_ROWS`` labelled documents,
shared out evenly over the languages (a hot language or source weighs no
more), each as hashed counts of its whole text, packed into a few bytes on its
way to the driver.  Every second one also gives
a text in no language, made from it: its letters shuffled, random words,
another script, runs of one letter, symbols, random strings.  These teach one
more output, ``none``, which is never predicted.  A part of the sample is
held back to calibrate: one temperature for the probabilities, and the
probability of ``none`` above which a text is rejected: a half at least, and
as high as leaves ``REJECT`` of the clean texts held back above it.  The shares of both kinds
that it rejects stay with the model.

Defined results: null text and text without a letter are ``und`` with
score 0 and rejected; an empty ``lang`` is a value like any other, a null
one is no label; without any label all is ``und`` with score 0, and only
text without a letter is rejected; rows that repeat a ``doc_id`` each get their own result; an empty table gives an empty
result; columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.llm.common import binary_list, own_names, read_with

TRAIN_ROWS, REJECT = 1600, 0.002
ROWS_BITS, DIM, GRAMS = 14, 16, (1, 2, 3, 4)
EPOCHS, RATE, BATCH, SEED = 20, 0.5, 16, 42
PIECE = 1 << 20
UNKNOWN = "und"


def hashed(data: np.ndarray, n: int) -> np.ndarray:
    """Row of the ``n``-gram that starts at each byte; ``data`` ends in
    max(GRAMS) - 1 zeros that no gram starts at."""
    size = len(data) - max(GRAMS) + 1
    h = np.full(size, n, np.uint64)
    for i in range(n):
        h = (h ^ data[i:size + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - ROWS_BITS)).astype(np.int32)


def _bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text.lower() + b"\0" * (max(GRAMS) - 1), np.uint8)


def counts_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows that a whole text uses, and how often."""
    total = np.zeros(1 << ROWS_BITS, np.int64)
    data = _bytes(text)
    for n in GRAMS:
        total += np.bincount(hashed(data, n), minlength=len(total))
    used = np.flatnonzero(total)
    return used.astype(np.int32), total[used]


def shares_of(counts: np.ndarray) -> np.ndarray:
    return (counts / max(1, counts.sum())).astype(np.float32)


def pack_counts(used: np.ndarray, counts: np.ndarray) -> bytes:
    """``counts_of`` as a few bytes: a sampled text reaches the driver, whose
    JVM holds several copies of all that is on its way, in a tenth of the room."""
    steps, counts = np.diff(used, prepend=0).astype("<u2"), counts.astype("<i8")
    planes = [x.view(np.uint8).reshape(len(x), x.itemsize).T for x in (steps, counts)]  # the high bytes, zeros as a rule, together
    return zlib.compress(b"".join(x.tobytes() for x in planes), 6)


def unpack_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``pack_counts`` was given."""
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(10, -1)
    steps, counts = (np.ascontiguousarray(x.T).view(kind).ravel() for x, kind in ((planes[:2], "<u2"), (planes[2:], "<i8")))
    return np.cumsum(steps, dtype=np.int64).astype(np.int32), counts


#: First letter and number of letters of some scripts.
SCRIPTS = [(0x61, 26), (0x430, 32), (0x3B1, 25), (0x5D0, 27), (0x627, 36), (0x905, 53), (0x3041, 83), (0x30A1, 83), (0x4E00, 20000), (0xAC00, 11000)]
SYMBOLS = list("(){}[];:=<>+-*/%&|!?#$@^~_.,\"'0123456789")


def no_language(text: str, kind: int, rng: np.random.Generator) -> str:
    """A text in no language, of the words' number and lengths, 400 at most."""
    words = text.split()[:400] or ["x"]
    sizes = [len(w) for w in words]
    if kind == 0:
        letters = np.array(list("".join(words)))
        rng.shuffle(letters)
        cuts = np.cumsum(sizes)
        return " ".join("".join(letters[b - n:b]) for b, n in zip(cuts, sizes))
    if kind in (1, 2):
        first, n = SCRIPTS[0 if kind == 1 else int(rng.integers(1, len(SCRIPTS)))]
        return " ".join("".join(map(chr, first + rng.integers(0, n, min(k, 30)))) for k in sizes)
    if kind == 3:
        return " ".join(str(rng.choice(list("ABCXYZabcxyz"))) * int(rng.integers(3, 12)) for _ in sizes)
    if kind == 4:
        return " ".join("".join(rng.choice(SYMBOLS, int(rng.integers(1, 6)))) + w[:int(rng.integers(0, 5))] + "".join(rng.choice(SYMBOLS, 2)) for w in words)
    return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), int(rng.integers(20, 80))))
                    for _ in sizes[:20])


KINDS_OF_NONE = 6


@dataclass
class LanguageModel:
    langs: list[str]
    scores: np.ndarray  # [rows, langs and none]
    bias: np.ndarray
    temperature: float
    threshold: float  # of none's probability
    rejected: tuple[float, float]  # shares of clean texts and of those in no language, as held back

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Averages over whole texts, long ones piece by piece."""
        out = np.zeros((len(texts), len(self.bias)))
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= PIECE):
                size, to = size + len(texts[to]), to + 1
            if to == at + 1 and size > PIECE:
                out[at] = self._long(texts[at])
            else:
                out[at:to] = self._many(texts[at:to])
            at = to
        return out / self.temperature

    def _many(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.array([len(t) + max(GRAMS) - 1 for t in texts])
        data = _bytes((b"\0" * (max(GRAMS) - 1)).join(texts))
        starts = np.cumsum(sizes) - sizes
        total = np.zeros((len(texts), len(self.bias)))
        for n in GRAMS:
            rows = self.scores[hashed(data, n)]
            cut = np.minimum(starts + sizes - (max(GRAMS) - 1), len(rows))
            bounds = np.stack([starts, cut], axis=1).ravel()
            sums = np.add.reduceat(np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)]), bounds, axis=0,
                                   dtype=np.float64)[::2]
            sums[starts == cut] = 0
            total += sums
        grams = len(GRAMS) * np.maximum(sizes - (max(GRAMS) - 1), 1)
        return total / grams[:, None] + self.bias

    def _long(self, text: bytes) -> np.ndarray:
        data, total = _bytes(text), np.zeros(len(self.bias))
        for a in range(0, len(text), PIECE):
            part = data[a:a + PIECE + max(GRAMS) - 1]
            for n in GRAMS:
                total += self.scores[hashed(part, n)].sum(axis=0, dtype=np.float64)
        return total / (len(GRAMS) * len(text)) + self.bias

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The likeliest language, its probability, and whether it is rejected."""
        p = softmax(self.logits(texts))
        best = p[:, :-1].argmax(axis=1)
        return best, p[np.arange(len(p)), best], p[:, -1] > self.threshold


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str | None, np.ndarray, np.ndarray]], seed: int = SEED) -> LanguageModel:
    """``samples``: language (``None``: in none), rows used, shares.  Every
    fourth one (of each language) calibrates, the others train."""
    langs = sorted({s[0] for s in samples if s[0] is not None})
    number, order = {None: len(langs)} | {x: i for i, x in enumerate(langs)}, {}
    learn, check = [], []
    for s in samples:
        order[s[0]] = order.get(s[0], 0) + 1
        (check if order[s[0]] % 4 == 0 else learn).append(s)
    check = check or learn
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (1 << ROWS_BITS, DIM))
    weights, bias = rng.normal(0, 0.1, (DIM, len(langs) + 1)), np.zeros(len(langs) + 1)
    scale = 50.0  # averages over hundreds of grams are small; part of the input layer
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(rng.permutation(len(learn)), -(-len(learn) // BATCH)):
            x = np.stack([scale * (learn[i][2] @ embed[learn[i][1]]) for i in batch])
            p = softmax(x @ weights + bias)
            p[np.arange(len(batch)), [number[learn[i][0]] for i in batch]] -= 1
            p /= len(batch)
            back = p @ weights.T
            weights -= rate * (x.T @ p)
            bias -= rate * p.sum(axis=0)
            for i, g in zip(batch, back):
                np.add.at(embed, learn[i][1], -rate * scale / 10 * learn[i][2][:, None] * g)
    scores = scale * (embed @ weights)
    raw = np.stack([share @ scores[rows] for _, rows, share in check]) + bias
    truth = np.array([number[s[0]] for s in check])
    loss = lambda t: -np.log(np.maximum(softmax(raw / t)[np.arange(len(truth)), truth], 1e-300)).mean()
    temperature = min(np.geomspace(0.2, 20, 61).tolist(), key=loss)
    none = softmax(raw / temperature)[:, -1]
    clean, made = none[truth < len(langs)], none[truth == len(langs)]
    # none must be likelier than all languages together, however small the sample
    threshold = max(0.5, float(np.quantile(clean, 1 - REJECT, method="higher"))) if len(clean) else 1.0
    shares = tuple(float((x > threshold).mean()) if len(x) else 0.0 for x in (clean, made))
    return LanguageModel(langs, scores.astype(np.float32), bias, temperature, threshold, shares)


def train_language_model(docs: DataFrame, learn_from: Column, rows: int = TRAIN_ROWS) -> LanguageModel | None:
    """Fits on about ``rows`` of the documents where ``learn_from`` holds and
    ``lang`` is not null; ``None`` if there are none."""
    pick = F.coalesce(F.xxhash64(F.col("doc_id").cast("long")), F.lit(0))
    labelled = docs.where(learn_from & F.col("lang").isNotNull()) \
        .select(F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"), pick.alias("pick"))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    langs = counts.count()
    if not langs:
        return None
    share = F.pmod("pick", F.lit(1_000_003)) / 1_000_003
    picks = labelled.select("lang", "pick").join(counts, "lang").where(share * F.col("n") * langs < rows) \
        .select("pick").distinct().orderBy("pick").limit(2 * rows)
    sample = labelled.join(F.broadcast(picks), "pick", "left_semi")  # 2 * rows numbers at most

    def features(batches):
        for batch in batches:
            texts, langs, picks = binary_list(batch, "text"), batch["lang"].to_pylist(), batch["pick"].to_pylist()
            made = [(no_language(t.decode(), p // 2 % KINDS_OF_NONE, np.random.default_rng(p % (1 << 32))), p) for t, p in zip(texts, picks) if p % 2 == 0]
            found = [pack_counts(*counts_of(t)) for t in [*texts, *(t.encode() for t, _ in made)]]
            yield pa.RecordBatch.from_arrays([
                pa.array(langs + [None] * len(made), pa.string()), pa.array(picks + [p for _, p in made], pa.int64()),
                pa.array(found, pa.binary())], ["lang", "pick", "counts"])

    got = sample.select("lang", "text", "pick") \
        .mapInArrow(features, "lang string, pick long, counts binary") \
        .orderBy("pick").limit(3 * rows).toArrow().combine_chunks()
    if not got.num_rows:
        return None
    order = sorted(range(got.num_rows), key=lambda i: (got["pick"][i].as_py(), got["lang"][i].as_py() or "", got["lang"][i].is_valid))
    samples = []
    for i in order:
        used, counts = unpack_counts(got["counts"][i].as_py())
        samples.append((got["lang"][i].as_py(), used, shares_of(counts)))
    return train(samples)


def identify_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred, lang_score`` (calibrated probability) and
    ``lang_rejected``."""
    added = T.StructType.fromDDL("lang_pred string, lang_score double, lang_rejected boolean")
    docs = read_with(docs, added.names)
    letters = docs.withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of rows for each language of the sample

    def run(batches):
        model = sent.value
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            letter = rows["__letter"].to_numpy()
            spoken = letter & (model is not None)
            pred, score, rejected = np.full(len(spoken), UNKNOWN, object), np.zeros(len(spoken)), ~letter
            if spoken.any():
                best, score[spoken], rejected[spoken] = model.predict(binary_list(rows.filter(pa.array(spoken)), "text"))
                pred[spoken] = np.array(model.langs, object)[best]
            rows = rows.drop_columns(["__letter"])
            for f, values, kind in zip(added, (pred, score, rejected), (pa.string(), pa.float64(), pa.bool_())):
                rows = rows.append_column(f.name, pa.array(values, kind))
            yield from rows.to_batches()

    return letters.mapInArrow(run, T.StructType(docs.schema.fields + added.fields))


def drop_rejected(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The documents whose language is accepted, with their own columns."""
    plain, back = own_names(docs)
    return back(identify_language(plain, model).where(~F.col("lang_rejected")))
