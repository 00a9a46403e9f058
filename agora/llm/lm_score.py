"""Language-model scoring: the marginal probability of a text over all its
segmentations into subwords.

An existing subword vocabulary (its file is a parameter, nothing of it is
kept here) gives the pieces and their starting weights; the weights are
then fitted to the word counts of the training documents by a few rounds
of expectation maximisation.  A text is its words, lower-cased A-Z, each
opened by the vocabulary's word mark, then one end.  Pieces never cross a
word mark, so a text's probability is the product over its words of the
forward sum over the word's lattice, in log space; each distinct word of a
block is summed once.

Words are counted per block of documents, summed over the corpus by one
shuffle on the word (a frequent word is one row per block, never one per
token), and go back to the blocks with their totals.  Only the counts per
piece, bounded by the vocabulary, meet on the driver.

Defined results: null text counts as empty and scores as its end alone; a
null ``doc_id`` is a training document; rows that repeat a ``doc_id`` each
get their own result; without training documents ``train_tokens`` is 0 and
the starting weights score; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import store, text_blocks

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
END = " "  # no word
BLOCK_BYTES, ROUNDS, SMOOTHING = 8 << 20, 4, 0.1
CHUNK, FEW, LONG = 8192, 100, 128
_MUL = 0xD6E8FEB86659FD93
_BITS = 20


def read_vocabulary(path: str) -> dict[bytes, float]:
    """Pieces as bytes, with log weights.  A unigram vocabulary has them; a
    merge-ranked one scores a piece by minus its rank, taken as 1 / rank.
    Pieces of the same bytes add up; marks inside a piece match no word."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i))]
    scores = [sp.get_score(i) for i in ids]
    ranked = min(scores) < -1000
    weights: dict[bytes, float] = {}
    for i, s in zip(ids, scores):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            key, w = bytes([int(piece[3:5], 16)]), 1 / (2 + len(ids))
        else:
            key, w = piece.encode(), 1 / (2 - s) if ranked else math.exp(s)
        if key and MARK.encode() not in key[1:]:
            weights[key] = weights.get(key, 0.0) + w
    for b in range(256):  # every word has a segmentation
        weights.setdefault(bytes([b]), 1 / (2 + len(ids)))
    total = sum(weights.values())
    return {k: math.log(w / total) for k, w in sorted(weights.items())}


class Lattice:
    """Forward and backward sums over the segmentations of words."""

    def __init__(self, log_p: dict[bytes, float]):
        self.index = {k: i for i, k in enumerate(log_p)}
        self.log_p = np.array(list(log_p.values()))
        self.longest = max(map(len, log_p))
        self.power = [pow(_MUL, n, 1 << 64) for n in range(self.longest + 1)]
        keys = np.array([self._hash(k) for k in log_p], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self._slot(keys)] = True

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * _MUL + b + 1) & ((1 << 64) - 1)
        return h

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)

    def _arcs(self, words: np.ndarray):
        """For words of one length, [n, length] bytes: lists by end place of
        (length of the piece, rows, piece numbers)."""
        n, length = words.shape
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * np.uint64(_MUL) + words[:, j].astype(np.uint64) + np.uint64(1)
        arcs = []
        for j in range(1, length + 1):
            own = []
            for size in range(1, min(j, self.longest) + 1):
                h = prefix[j] - prefix[j - size] * np.uint64(self.power[size])
                rows = np.flatnonzero(self.maybe[self._slot(h)])
                if len(rows):
                    found = h[rows]
                    at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
                    ok = self.keys[at] == found
                    if ok.any():
                        own.append((size, rows[ok], self.order[at[ok]]))
            arcs.append(own)
        return arcs

    def _forward(self, words: np.ndarray, arcs) -> np.ndarray:
        alpha = np.full((words.shape[1] + 1, len(words)), -np.inf)
        alpha[0] = 0.0
        for j, own in enumerate(arcs, 1):
            for size, rows, piece in own:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[j - size, rows] + self.log_p[piece])
        return alpha

    def _one(self, word: bytes, counts: np.ndarray | None = None, times: float = 0.0) -> float:
        """The same for a single word."""
        get, log_p, n = self.index.get, self.log_p, len(word)
        arcs, alpha = [[] for _ in range(n + 1)], [0.0] + [-math.inf] * n
        for j in range(1, n + 1):
            terms = []
            for i in range(max(0, j - self.longest), j):
                p = get(word[i:j])
                if p is not None:
                    arcs[j].append((i, p))
                    terms.append(alpha[i] + log_p[p])
            top = max(terms)
            alpha[j] = top + math.log(sum(math.exp(t - top) for t in terms))
        if counts is not None:
            beta = [-math.inf] * n + [0.0]
            for j in range(n, 0, -1):
                for i, p in arcs[j]:
                    counts[p] += times * math.exp(alpha[i] + log_p[p] + beta[j] - alpha[n])
                    a, b = beta[i], log_p[p] + beta[j]
                    top = max(a, b)
                    beta[i] = top + math.log(math.exp(a - top) + math.exp(b - top))
        return float(alpha[n])

    def _by_length(self, words: pa.Array):
        """Index arrays of words of one length, with their bytes; singles as
        ``None``.  ``words`` have no mark yet."""
        marked = pc.binary_join_element_wise(pa.scalar(MARK), words, "") if len(words) else words
        marked = marked.cast(pa.binary())
        size = pc.binary_length(marked).to_numpy(zero_copy_only=False)
        offsets = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset:marked.offset + len(marked) + 1]
        data = np.frombuffer(marked.buffers()[2], np.uint8)
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            n = int(size[order[a]])
            for c in range(a, b, CHUNK):
                own = order[c:min(b, c + CHUNK)]
                if len(own) < FEW or n > LONG:
                    for k in own.tolist():
                        yield np.array([k]), None, data[offsets[k]:offsets[k] + n].tobytes()
                else:
                    yield own, data[offsets[own].astype(np.int64)[:, None] + np.arange(n)], None

    def log_marginals(self, words: pa.Array) -> np.ndarray:
        """Natural log of each word's probability, word mark included."""
        out = np.zeros(len(words))
        for own, many, one in self._by_length(words):
            out[own] = self._one(one) if many is None else self._forward(many, self._arcs(many))[-1]
        return out

    def expected(self, words: pa.Array, times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over words that occur ``times``."""
        counts = np.zeros(len(self.log_p))
        for own, many, one in self._by_length(words):
            if many is None:
                self._one(one, counts, float(times[own[0]]))
                continue
            arcs = self._arcs(many)
            alpha = self._forward(many, arcs)
            beta = np.full_like(alpha, -np.inf)
            beta[-1] = 0.0
            for j in range(len(arcs), 0, -1):
                for size, rows, piece in arcs[j - 1]:
                    step = self.log_p[piece] + beta[j, rows]
                    counts += np.bincount(piece, np.exp(alpha[j - size, rows] + step - alpha[-1, rows])
                                          * times[own[rows]], len(counts))
                    beta[j - size, rows] = np.logaddexp(beta[j - size, rows], step)
        return counts


def tokens(text: pa.ChunkedArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Document number and word of each token, end tokens left out."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text.combine_chunks()))
    words, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    return pc.filter(doc, full).to_numpy().astype(np.int64), pc.filter(words, full).dictionary_encode()


def _fitted(vocabulary: DataFrame, ends: int, log_p: dict[bytes, float], rounds: int) -> tuple[dict, float]:
    """Weights after ``rounds`` of expectation maximisation, and the end's."""
    spark = vocabulary.sparkSession
    pieces, log_end = list(log_p), math.log(0.01)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(log_p)  # bounded: one number for each piece of the vocabulary file

        def expect(batches, sent=sent):
            lattice, counts = Lattice(sent.value), None
            for batch in batches:
                new = lattice.expected(batch["word"], batch["total"].to_numpy().astype(float))
                counts = new if counts is None else counts + new
            if counts is not None:
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])],
                                                 ["piece", "uses"])

        uses = np.zeros(len(pieces))
        for r in vocabulary.mapInArrow(expect, "piece int, uses double") \
                .groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[r["piece"]] = r["uses"]
        if not uses.any():
            break
        total = uses.sum() + SMOOTHING * (len(pieces) + 1) + ends
        log_p = dict(zip(pieces, np.log((uses + SMOOTHING) / total).tolist()))
        log_end = math.log((ends + SMOOTHING) / total)
    return log_p, log_end


def held_out(modulus: int, remainder: int) -> Column:
    """crc32 of ``doc_id`` as text; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def lm_scores(docs: DataFrame, held: Column, vocabulary: str = VOCABULARY, rounds: int = ROUNDS,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``.  Documents where ``held`` (of ``doc_id``) is true are not
    learnt from.  Scores are log10: ``base_score`` of add-one word counts,
    ``score`` of the subword model."""
    spark = docs.sparkSession
    blocks = text_blocks(docs, block_bytes).withColumn("held", held)

    def count(block):
        doc, words = tokens(block["text"])
        train = ~block["held"].to_numpy()
        n = np.bincount(words.indices.to_numpy(), train[doc], len(words.dictionary)).astype(np.int64)
        every = pa.concat_arrays([words.dictionary, pa.array([END])])
        return pa.table({"word": every, "block": pa.array(np.full(len(every), block["block"][0].as_py(), np.int32)),
                         "n": pa.array(np.append(n, train.sum()))})

    by_word = Window.partitionBy("word")
    counted = store(blocks.groupBy("block").applyInArrow(count, "word string, block int, n long")
                    .withColumn("total", F.sum("n").over(by_word))
                    .withColumn("first", F.col("block") == F.min("block").over(by_word)).drop("n"), "words")
    learnt = counted.where("first and total > 0")
    sums = learnt.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count("*"),
                      F.coalesce(F.sum(F.when(F.col("word") == END, F.col("total"))), F.lit(0))).first()
    n_train, n_words, ends = (int(x) for x in sums)
    log_p, log_end = _fitted(learnt.where(F.col("word") != END).select("word", "total"), ends,
                             read_vocabulary(vocabulary), rounds)
    sent = spark.sparkContext.broadcast(log_p)
    unit = math.log(10)

    def score(block, totals):
        if not block.num_rows:
            return _SCORES.empty_table()
        doc, words = tokens(block["text"])
        at = pc.index_in(pa.chunked_array([words.dictionary]), totals["word"].combine_chunks())
        known = totals["total"].to_numpy()
        c = known[at.to_numpy()] if len(at) else np.zeros(0, np.int64)
        c_end = int(known[pc.index(totals["word"], END).as_py()])
        base = np.log10((c + 1.0) / (n_train + n_words + 1))
        model = Lattice(sent.value).log_marginals(words.dictionary) / unit
        index, rows = words.indices.to_numpy(), block.num_rows
        total = lambda x: np.bincount(doc, x[index], rows)
        return pa.Table.from_arrays([
            block["doc_id"].combine_chunks(), block["held"].combine_chunks(),
            pa.array(np.bincount(doc, minlength=rows).astype(np.int64) + 1),
            pa.array(total((c > 0).astype(float)).astype(np.int64) + (c_end > 0)),
            pa.array(np.full(rows, n_train, np.int64)),
            pa.array(total(base) + math.log10((c_end + 1) / (n_train + n_words + 1))),
            pa.array(total(model) + log_end / unit)], schema=_SCORES)

    return blocks.groupBy("block").cogroup(counted.select("block", "word", "total").groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])
