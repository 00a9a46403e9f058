"""Personal data with a semi-Markov conditional random field.

Plain patterns give the base spans (e-mail, IP address, payment card,
phone).  Around them, and around looser traces of the same four kinds
(digit groups without a plus sign, spelled-out at and dot), a semi-Markov
CRF scores whole candidate segments: features see the span as a whole
(digits, groups, separators, checksum, parts, neighbours), segments are
bounded to ``MAX_PARTS`` parts, and dynamic programming chooses boundaries
and types jointly.  What it finds beside the base spans is added; base
spans stay.

The weights are fitted in numpy, by gradient ascent on the conditional
likelihood, on the regions of a bounded sample: at most ``SAMPLE_DOCS``
documents with ``SAMPLE_REGIONS`` regions each.  Their labels are the base
spans, and the same spans rewritten in looser forms; all other regions
are labelled empty.  The weights, a fixed number, go to the executors.
Every whole text is then read once, without a shuffle.

All scans are linear in the text.  Defined results: null text counts as
empty and has no spans; rows that repeat a ``doc_id`` each get their own
result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_REGIONS = 1500, 20
MAX_PARTS, EPOCHS, RATE, PENALTY, SEED = 9, 8, 0.2, 1e-3, 42
#: Log odds that a segment the patterns don't know must have over none.
CAUTION = 1.0
FEATURE_BITS = 12

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A text without any of these has neither base spans nor regions.
_ANY = re.compile(r"[0-9@]|[\[({]\x20?at\x20?[\])}]|\x20at\x20", re.I)
#: Regions: digit groups at most three separators apart; a spelled-out e-mail.
_DIGITS = re.compile(r"[+(]{0,2}[0-9]++(?:[\x20().-]{1,3}+[0-9]++)*+")
_AT = re.compile(r"\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20", re.I)
_LOOSE = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63})+", re.I)
_DOT = re.compile(r"\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\.", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind, start, end`` (code points) by kind, then start.  Leftmost and
    non-overlapping per kind; a match that fails its check is dropped."""
    out = []
    at, free, last = text.find("@"), 0, 0
    while at >= 0:  # an address has one @: look back from it, then forward
        seg = text[max(free, last):at]
        local = len(seg) - len(seg.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if local else None
        if m:
            out.append((0, at - local, m.end()))
            free = m.end()
        last = at + 1
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in ((x.lstrip("0") or "0") for x in m[0].split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


class Region:
    """A stretch of text cut into parts, with its candidate segments:
    ``(first part, last part, kind)`` with a start and an end."""

    def __init__(self, text: str, start: int, end: int, kinds: tuple[int, ...], parts: list[tuple[int, int]]):
        self.text, self.start, self.end, self.kinds, self.parts = text, start, end, kinds, parts

    def segments(self):
        """An address has four groups; digits are 13 to 19 of a card, 7 to
        15 of a phone; an e-mail may stop at any label."""
        if self.kinds == (0,):
            yield from ((0, j, 0) for j in range(min(len(self.parts), MAX_PARTS)))
            return
        for j in range(len(self.parts)):
            digits = 0
            for i in range(j, max(-1, j - MAX_PARTS), -1):
                a, b = self.parts[i]
                digits += b - a - (self.text[a] in "+(") - (self.text[a + 1:a + 2] in ("+", "("))
                if j - i == 3:
                    yield i, j, 1
                if 13 <= digits <= 19:
                    yield i, j, 2
                if 7 <= digits <= 15:
                    yield i, j, 3


def regions(text: str):
    """In text order; a region of digit groups, or an address around a mark."""
    for m in _DIGITS.finditer(text):
        if sum(map(str.isdigit, m[0])) >= 7:
            parts = [p.span() for p in re.finditer(r"(?:\+?\(?|\(?\+?)[0-9]++", m[0])]
            yield Region(m[0], m.start(), m.end(), (1, 2, 3), parts)
    last = 0
    for m in _AT.finditer(text):
        tail = _LOOSE.match(text, m.end())
        seg = text[last:m.start()]  # these pieces don't overlap, so all of them are one pass
        local = len(seg) - len(seg.rstrip(_LOCAL))
        if tail and local:
            start = m.start() - local
            whole = text[start:tail.end()]
            cuts = [d.start() + m.end() - start for d in _DOT.finditer(tail[0])][1:]  # the address may end before a dot
            ends = [*cuts, len(whole)]
            yield Region(whole, start, tail.end(), (0,), [(0, ends[0]), *zip(ends, ends[1:])])
        last = m.end()


_SLOTS: dict[str, int] = {}


def _slot(name: str) -> int:
    import zlib

    if name not in _SLOTS:
        if len(_SLOTS) > 1 << 16:
            _SLOTS.clear()
        _SLOTS[name] = zlib.crc32(name.encode()) >> (32 - FEATURE_BITS)
    return _SLOTS[name]


def features(r: Region, i: int, j: int, kind: int) -> list[int]:
    """Of a whole span under one kind."""
    a, b = r.parts[i][0], r.parts[j][1]
    span, k = r.text[a:b], KINDS[kind]
    before, after = r.text[a - 1:a], r.text[b:b + 1]
    edge = f"{'part' if a and i else 'open'}{'part' if j + 1 < len(r.parts) else 'open'}"
    names = [f"{k}:bias", f"{k}:edge:{edge}", f"{k}:sides:{before.isalnum()}{after.isalnum()}"]
    if kind == 0:
        pieces = _DOT.split(_AT.split(span, maxsplit=1)[-1])
        names += [f"email:labels:{min(len(pieces), 6)}", f"email:top:{pieces[-1].isalpha()}{min(len(pieces[-1]), 7)}",
                  f"email:plain at:{' at ' in span.lower()}", f"email:dots:{sorted({d[0].strip().lower() for d in _DOT.finditer(span)})}"]
        return [_slot(n) for n in names]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    between = [re.sub("[0-9]", "", x) for x in re.findall(r"[^0-9]+(?=[0-9])", span[span.find(groups[0]):])]
    shape = "-".join(str(min(len(g), 9)) for g in groups)
    names += [f"{k}:digits:{min(len(digits), 20)}", f"{k}:groups:{len(groups)}", f"{k}:shape:{shape}",
              f"{k}:between:{'|'.join(sorted(set(between)))}", f"{k}:opens:{span[0] if not span[0].isdigit() else '9'}"]
    if kind == 1:
        names.append(f"ip:parts:{len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if kind == 2:
        names.append(f"card:check:{13 <= len(digits) <= 19 and luhn(digits)}")
    return [_slot(n) for n in names]


def lattice(r: Region, weights: np.ndarray):
    """Segments that end at each part: ``(first, kind, score, features)``."""
    ends: list[list] = [[] for _ in r.parts]
    for i, j, k in r.segments():
        f = features(r, i, j, k)
        ends[j].append((i, k, float(weights[f].sum()), f))
    return ends


def best_segments(r: Region, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The segmentation with the highest score; empty parts score 0, a
    segment its features less ``CAUTION``."""
    ends = lattice(r, weights)
    score, back = [0.0], []
    for j, segs in enumerate(ends):
        top, how = score[j], None
        for i, k, s, _ in segs:
            if score[i] + s - CAUTION > top:
                top, how = score[i] + s - CAUTION, (i, k)
        score.append(top)
        back.append(how)
    out, j = [], len(ends)
    while j:
        how = back[j - 1]
        if how:
            out.append((how[1], r.start + r.parts[how[0]][0], r.start + r.parts[j - 1][1]))
        j = how[0] if how else j - 1
    return out[::-1]


def _log_add(a: float, b: float) -> float:
    top = max(a, b)
    return top if top == -math.inf else top + math.log(math.exp(a - top) + math.exp(b - top))


def fit(samples: list[tuple[Region, set[tuple[int, int, int]]]]) -> np.ndarray:
    """Weights from regions with their true ``(first part, last part, kind)``."""
    weights = np.zeros(1 << FEATURE_BITS)
    rng = np.random.default_rng(SEED)
    squares = np.full(len(weights), 1e-6)
    for _ in range(EPOCHS):
        for n in rng.permutation(len(samples)):
            r, truth = samples[n]
            ends = lattice(r, weights)
            size = len(ends)
            fore, aft = [0.0] + [-math.inf] * size, [-math.inf] * size + [0.0]
            for j in range(size):
                fore[j + 1] = fore[j]
                for i, _, s, _f in ends[j]:
                    fore[j + 1] = _log_add(fore[j + 1], fore[i] + s)
            for j in range(size - 1, -1, -1):
                aft[j] = _log_add(aft[j], aft[j + 1])
                for i, _, s, _f in ends[j]:
                    aft[i] = _log_add(aft[i], s + aft[j + 1])
            slots, steps = [], []
            for j in range(size):
                for i, k, s, f in ends[j]:
                    g = ((i, j, k) in truth) - math.exp(min(0.0, fore[i] + s + aft[j + 1] - fore[size]))
                    if abs(g) > 1e-4:
                        slots += f
                        steps += [g] * len(f)
            if slots:
                grad = np.bincount(slots, steps, len(weights)) - PENALTY * weights
                squares += grad * grad
                weights += RATE * grad / np.sqrt(squares)
    return weights


def _labelled(text: str, spans: list[tuple[int, int, int]], limit: int):
    """Regions of a text with the segments that are base spans of it."""
    out = []
    for r in regions(text):
        first = {r.start + a: i for i, (a, _) in enumerate(r.parts)}
        last = {r.start + b: i for i, (_, b) in enumerate(r.parts)}
        free, truth = -1, set()
        for k, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
            if k in r.kinds and a in first and b in last and first[a] > free:
                truth.add((first[a], last[b], k))
                free = last[b]
        out.append((r, truth))
        if len(out) == limit:
            break
    return out


def _rewritten(text: str, kind: int) -> list[str]:
    """Looser forms of a base span."""
    if kind == 0:
        local, domain = text.split("@")
        return [f"{local} [at] {domain.replace('.', ' [dot] ')}", f"{local} at {domain.replace('.', ' dot ')}",
                f"{local}(at){domain.replace('.', '(dot)')}", f"{local} [at] {domain}", f"{local}(at){domain}"]
    if kind == 3:
        bare = text[1:]
        cut = re.sub(r"^[0-9]{1,3}[\x20.-]+", "", bare)
        return [bare] + [cut] * (cut != bare)
    return []


def train_pii_model(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Weights from at most ``sample_docs`` documents that have digits or an @."""
    traced = docs.where(F.col("text").rlike("[0-9]{3}|@")) \
        .select(F.xxhash64("doc_id", "text").alias("pick"), "text")

    def read(batches):
        for batch in batches:
            picks, texts, kinds, starts, ends = [], [], [], [], []
            for pick, text in zip(batch["pick"].to_pylist(), batch["text"].to_pylist()):
                spans = base_spans(text)
                own = [(r.start, r.end, r.text, truth) for r, truth in _labelled(text, spans, SAMPLE_REGIONS)]
                own += [(a, b, None, {(k,)}) for k, a, b in spans[:SAMPLE_REGIONS] if k == 0]
                for a, b, _, truth in own:
                    left, right = max(0, a - 3), min(len(text), b + 3)
                    if right - left <= 400:
                        picks.append(pick)
                        texts.append(text[left:right])
                        kinds.append(0 if truth == {(0,)} else -1)
                        starts.append(a - left)
                        ends.append(b - left)
            yield pa.RecordBatch.from_arrays([pa.array(picks, pa.int64()), pa.array(texts, pa.string()),
                                              pa.array(kinds, pa.int32()), pa.array(starts, pa.int32()),
                                              pa.array(ends, pa.int32())], ["pick", "region", "kind", "a", "b"])

    # the sample is a range of a hash: its size follows from the count
    n = traced.count()
    chosen = traced.where(F.pmod("pick", F.lit(1_000_003)) / 1_000_003 * n < sample_docs / 2)
    got = chosen.mapInArrow(read, "pick long, region string, kind int, a int, b int") \
        .orderBy("pick", "a", "b", "region").limit(sample_docs * SAMPLE_REGIONS).collect()
    samples = []
    for row in got:
        if row["kind"] == 0:
            forms = [row["region"][:row["a"]] + f + row["region"][row["b"]:]
                     for f in _rewritten(row["region"][row["a"]:row["b"]], 0)]
            samples += [(r, {(0, len(r.parts) - 1, 0)}) for f in forms for r in regions(f) if r.kinds == (0,)]
            continue
        spans = base_spans(row["region"])
        samples += _labelled(row["region"], spans, SAMPLE_REGIONS)
        for k, a, b in spans:
            for f in _rewritten(row["region"][a:b], k) if k == 3 else []:
                for r in regions(f):
                    samples.append((r, {(0, len(r.parts) - 1, 3)}))
    return fit(samples)


def find_spans(text: str, weights: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """``kind, start, end, base``: base spans and what the model adds to
    them, by kind, then start."""
    if not _ANY.search(text):
        return []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    out = [(*s, True) for s in base]
    for r in regions(text):
        lo = [(a, b) for a, b in _near(taken, r.start, r.end)]
        out += [(k, a, b, False) for k, a, b in best_segments(r, weights)
                if all(b <= x or y <= a for x, y in lo)]
    return sorted(out)


def _near(spans: list[tuple[int, int]], start: int, end: int):
    """Spans that may touch start .. end; ``spans`` are sorted, and those of
    one kind don't overlap."""
    from bisect import bisect_left

    at = bisect_left(spans, (start, 0))
    yield from spans[max(0, at - 2 * len(KINDS)):bisect_left(spans, (end, 0))]


SPAN = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def find_pii(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, spans``: kind, start and end (code points, end exclusive),
    and whether the plain patterns find it; by kind as listed, then start."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in find_spans(t, sent.value)]
                     for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, kind)], ["doc_id", "spans"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(run, f"doc_id long, spans {SPAN}")


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in brackets."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                made, at = [], 0
                for a, b, k in sorted((a, b, k) for k, a, b, _ in find_spans(text, sent.value)):
                    if a >= at:
                        made += [text[at:a], f"[{KINDS[k]}]"]
                    at = max(at, b)
                out.append("".join(made) + text[at:])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(run, "doc_id long, text string")
