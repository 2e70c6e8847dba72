"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

A text is cut into sentences (at line ends, after . ! ? and after ``LONGEST`` pieces) and these into units: words, lower-cased and without all that
isn't a letter or digit, and runs of spelled-out letters; both ends of a unit count as letters, and long ones are cut into
overlapping units. The kernel of two units counts common three-letter subsequences that span at most ``SPAN`` letters, each
weighted by LAMBDA to the power of both spans, so gaps and inserted characters cost a little instead of the match. Landmark
units give the kernel a finite feature map (Nyström); the machine (squared hinge loss, Newton steps) learns in it. As the
map is linear in a unit's subsequences, the machine is applied as one weight for each subsequence. What one unit leaves
open others can settle, so a text has three margins: that of its highest unit, the highest that a second unit reaches beside
another in one sentence, and the highest that a second unit of a sentence or a third one of ``NEAR`` sentences reaches; a logistic curve of these over texts kept aside in training, weighted to
the share of toxic ones among all labelled, makes them a probability.

Training sentences have their text's label. All sentences of a clean text are clean, but a toxic text needs only one toxic
sentence, so witnesses are found in turns: first the units that toxic texts have far more often than clean ones (smoothed log
odds over different contexts, as copies of one text say little), then in each text that they leave unexplained the highest
unit of its highest sentence, and in clean texts the highest units as counter-examples. The sample is bounded:
``PER_CLASS`` texts of each class, and of a text over ``MAX_BYTES`` bytes sentences drawn by hash up to that size.

Letters of the Latin, Greek and Cyrillic scripts have a code each; those of other scripts share some codes.

Defined cases: null and empty texts have no units and score as low as a text can; repeated rows give repeated results;
without labelled texts of both classes the score is the share of toxic ones (0 if there are none), and likewise if no unit at
all tells the classes apart; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import bounded_sample, doc_texts, in_order, learnable, mapped

PER_CLASS, MAX_BYTES = 4000, 16_384
SPAN, LAMBDA = 6, 0.6
#: Letter codes; letters of a unit, its ends included, and the step between the units of a long word.
CODES, WIDE, SLIDE = 160, 16, 8
PREDICT = 0.3
#: Rows that training gets, and the one row of a fitted machine.
SAMPLE = pa.schema([("text", pa.string()), ("y", pa.int32())])
FITTED = pa.schema([("weights", pa.binary()), ("bias", pa.float64()), ("curve", pa.list_(pa.float64())), ("constant", pa.float64())])
#: Landmarks of each class, training units of each class, rounds of finding witnesses.
LANDMARKS, UNITS, ROUNDS = 256, 6000, 3
#: Units that one step of training works on.
BLOCK = 500
#: A unit is a first witness if so many toxic texts have it, as a count and a share, after different words, the log odds are so
#: high, and about so many such units or fewer are to be expected by chance.
LEAST, LEAST_SHARE, ODDS, CHANCE = 3, 0.01, 2.5, 0.1
LONGEST, NEAR = 32, 24
SENTENCE = re.compile(r"(?<=[.!?])\s+|[\r\n]+")
SPELLED = re.compile(r"(?<!\S)\S(?:[ .*_-]\S){2,}(?!\S)")
PUNCTUATION, END = ".,;:!?\"'()[]", "\1"
#: (offsets of the second and third letter, weight) of every subsequence within the span.
GAPS = [(j, k, LAMBDA ** (k + 1)) for k in range(2, SPAN) for j in range(1, k)]


def sentences(text: str) -> list[list[str]]:
    """The pieces (what stands between spaces) of each sentence, then its spelled-out runs without what separates their letters."""
    out, spelled = [], SPELLED.search(text)
    for s in SENTENCE.split(text):
        row = s.split()
        if len(row) > LONGEST:
            out += [row[i : i + LONGEST] for i in range(0, len(row), LONGEST)]
        else:
            out.append(row)
        if spelled:
            out[-1] = out[-1] + [re.sub(r"[ .*_-]", "", m[0]) for m in SPELLED.finditer(s)]
    return [row for row in out if row]


def units(piece: str) -> list[str]:
    """The units of a piece: its letters and digits between two ends, in overlapping parts if they are many."""
    w = piece if piece.isalnum() else piece.strip(PUNCTUATION)
    if not w.isalnum():
        w = "".join(filter(str.isalnum, w))
        if not w:
            return []
    w = END + w + END
    return [w] if len(w) <= WIDE else [w[i : i + WIDE] for i in range(0, len(w) - WIDE + SLIDE, SLIDE)]


class Letters(dict):
    """Code point -> letter of a code: 1 an end, 2 to 27 a to z, 28 a digit, then letters of three scripts; the last 16 are shared."""

    def __init__(self) -> None:
        super().__init__({1: "\1"} | {ord(c): chr(i + 2) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")})
        own = [c for a, b in ((0xDF, 0x180), (0x3AC, 0x3D0), (0x430, 0x460)) for c in map(chr, range(a, b)) if c.islower()]
        self.update({ord(c): chr(29 + i) for i, c in enumerate(own[: CODES - 16 - 29])})

    def __missing__(self, point: int) -> str:
        letter = chr(point)
        self[point] = "\x1c" if letter.isdigit() else chr(CODES - 16 + zlib.crc32(unicodedata.normalize("NFKD", letter)[:1].encode()) % 16)
        return self[point]


LETTERS = Letters()


def coded(words: list[str]) -> np.ndarray:
    """Letter codes of units, a row each, 0 for padding."""
    rows = "".join([w.translate(LETTERS).ljust(WIDE + SPAN, "\0") for w in words])
    return np.frombuffer(rows.encode("latin-1"), np.uint8).reshape(-1, WIDE + SPAN).astype(np.int64)


def subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each gap pattern the subsequence numbers that start at each letter; a multiple of CODES where there is none."""
    a = codes[:, :WIDE] * (CODES * CODES)
    for j, k, weight in GAPS:
        yield a + codes[:, j : WIDE + j] * CODES + codes[:, k : WIDE + k], weight


def norms(codes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(codes))
    for j, k, weight in GAPS:
        total += weight**2 * (codes[:, k : WIDE + k] > 0).sum(axis=1)
    return np.sqrt(np.maximum(total, LAMBDA**6))


class Machine:
    def __init__(self) -> None:
        self.weights = np.zeros(CODES**3, np.float32)
        self.bias, self.curve = 0.0, np.array([1.0, 0.0, 0.0, 0.0])
        self.constant: float | None = None

    def scores(self, words: list[str]) -> np.ndarray:
        """The machine's margin of each unit."""
        out = np.empty(len(words))
        for i in range(0, len(words), 20_000):
            codes = coded(words[i : i + 20_000])
            total = np.zeros(len(codes), np.float32)
            for places, weight in subsequences(codes):
                total += np.float32(weight) * self.weights[places].sum(axis=1)
            out[i : i + len(codes)] = total / norms(codes) + self.bias
        return out

    def piece_scores(self, found: list[str]) -> np.ndarray:
        """The highest margin among the units of each piece; -inf without units."""
        own = [units(p) for p in found]
        size = np.fromiter(map(len, own), np.int64, len(own))
        margins = self.scores([u for x in own for u in x])
        out = np.full(len(found), -np.inf)
        if len(margins):
            at = np.cumsum(size) - size
            out[size > 0] = np.maximum.reduceat(margins, at[size > 0])
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        """margins: three of each text."""
        return 1 / (1 + np.exp(-np.clip(margins @ self.curve[:3] + self.curve[3], -30, 30)))

    def learn(self, positive: list[str], negative: list[str]) -> None:
        """Landmarks, Nyström map and squared-hinge machine for units of both classes."""
        marks = norms_and_map(positive[:LANDMARKS] + negative[:LANDMARKS])
        gram = (marks.rows.T @ marks.rows).astype(np.float64)
        value, vector = np.linalg.eigh(gram)
        good = value > 1e-6 * value.max()
        white = vector[:, good] / np.sqrt(value[good])
        words = positive + negative
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        x = np.ones((len(words), white.shape[1] + 1), np.float32)
        for i in range(0, len(words), BLOCK):
            x[i : i + BLOCK, :-1] = kernel(marks, *unit_map(words[i : i + BLOCK])) @ white
        cost = np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(negative)))
        w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 0.5
        ridge[-1, -1] = 1e-6
        for _ in range(20):
            left, right = ridge.copy(), np.zeros(len(w))
            for i in range(0, len(words), BLOCK):
                own, side = x[i : i + BLOCK].astype(np.float64), y[i : i + BLOCK]
                active = side * (own @ w) < 1
                own = own[active]
                weighted = own * cost[i : i + BLOCK][active, None]
                left += weighted.T @ own
                right += weighted.T @ side[active]
            new = np.linalg.solve(left, right)
            if np.allclose(new, w, atol=1e-6):
                break
            w = new
        self.bias = float(w[-1])
        self.weights = (marks.rows @ (white @ w[:-1])).astype(np.float32)[marks.row]

    def fit(self, texts: list[str], labels: np.ndarray, share: float | None = None) -> Machine:
        """share: that of toxic texts among all labelled ones; the sample's, if not given. A third of the texts sets the curve only."""
        self.constant = None
        if not 0 < labels.sum() < len(labels):
            self.constant = float(labels.mean()) if len(labels) else 0.0
            return self
        aside = np.zeros(len(labels), bool)
        if min(labels.sum(), len(labels) - labels.sum()) >= 60:
            aside[::3] = True
        self.separate([t for t, x in zip(texts, aside, strict=True) if not x], labels[~aside])
        if self.constant is not None:
            return self
        if not aside.any():
            aside[:] = True
        y, scorer = labels[aside], Scorer(self)
        best = scorer.margins([t for t, x in zip(texts, aside, strict=True) if x])
        share = min(max(labels.mean() if share is None else share, 0.01), 0.99)
        weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
        x, w = np.append(best, np.ones((len(best), 1)), axis=1), np.zeros(4)
        ridge = np.diag([0.1, 0.1, 0.1, 0.01])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        self.curve = np.append(np.maximum(w[:3], 0), w[3])  # a higher margin never makes a text less toxic
        return self

    def separate(self, texts: list[str], labels: np.ndarray) -> None:
        """Learns from the sentences of labelled texts."""
        ids: dict[str, int] = {}
        unit, size, of_text = array("i"), array("i"), array("i")  # units of all sentences; of each sentence how many, and its text
        after = array("q")  # in toxic texts a unit and the piece before it, as one number
        for i, (t, y) in enumerate(zip(texts, labels, strict=True)):
            for row in sentences(t.lower()):
                bag, last = set(), ""
                for p in row:
                    own = [ids.setdefault(u, len(ids)) for u in units(p)]
                    bag.update(own)
                    if y == 1:
                        after.extend([u << 32 | hash_of(last) for u in own])
                    last = p
                unit.extend(bag)
                size.append(len(bag))
                of_text.append(i)
        words = list(ids)
        unit, size, of_text = (np.frombuffer(x, np.int32) if len(x) else np.zeros(0, np.int32) for x in (unit, size, of_text))
        pairs = np.unique(np.repeat(of_text, size).astype(np.int64) << 32 | unit)  # a text has a unit once
        is_toxic = labels[pairs >> 32] == 1
        toxic, clean = (np.bincount(pairs[x] & 0xFFFFFFFF, minlength=len(words)) for x in (is_toxic, ~is_toxic))
        contexts = np.minimum(toxic, np.bincount(np.unique(np.frombuffer(after, np.int64)) >> 32, minlength=len(words)) if len(after) else 0)
        del pairs, after
        n_toxic, n_clean = labels.sum(), len(labels) - labels.sum()
        odds = np.log((contexts + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
        # how unlikely so uneven counts are by chance, over all units that could have had them
        fair = contexts + clean
        excess = contexts * np.log(np.maximum(contexts, 1) * len(labels) / np.maximum(fair * n_toxic, 1)) + clean * np.log(np.maximum(clean, 1) * len(labels) / np.maximum(fair * n_clean, 1))
        often = contexts >= max(LEAST, LEAST_SHARE * n_toxic)
        sure = often & (odds >= ODDS) & (excess >= np.log(max(1, often.sum()) / CHANCE))
        if not sure.any():
            sure = (odds > 0) & (odds >= odds.max(initial=0))
        known = np.flatnonzero(clean)
        positive = set(np.flatnonzero(sure).tolist())
        negative = set(sorted((known[~sure[known]]).tolist(), key=lambda i: (hash_of(words[i]), words[i]))[:UNITS])
        if not positive or not negative:
            self.constant = float(labels.mean())
            return
        for _ in range(ROUNDS):
            self.learn([words[i] for i in sorted(positive, key=lambda i: (-contexts[i], words[i]))[:UNITS]], [words[i] for i in sorted(negative, key=lambda i: (hash_of(words[i]), words[i]))])
            margin = self.scores(words)
            close = np.flatnonzero((clean > 0) & ~sure & (margin > -0.7))
            negative |= set(sorted(close.tolist(), key=lambda i: (-margin[i], words[i]))[:UNITS])
            found = np.zeros(len(words), bool)
            found[[i for i in positive if margin[i] > 0]] = True
            start = np.cumsum(size) - size
            full = np.flatnonzero((size > 0) & (labels[of_text] == 1))
            if len(full):
                # the highest unit and whether a known one is there, of each toxic sentence, then of each toxic text
                explained, high = np.zeros(len(labels), bool), np.full(len(labels), -np.inf)
                inside = np.repeat(labels[of_text] == 1, size)
                edges = np.cumsum(size[full]) - size[full]
                np.logical_or.at(explained, of_text[full], np.logical_or.reduceat(found[unit[inside]], edges))
                top = np.maximum.reduceat(margin[unit[inside]], edges)
                np.maximum.at(high, of_text[full], top)
                for k in full[(top == high[of_text[full]]) & ~explained[of_text[full]]].tolist():
                    own = unit[start[k] : start[k] + size[k]]
                    best = min(own[margin[own] == margin[own].max()].tolist(), key=words.__getitem__)
                    if margin[best] > -0.3 and odds[best] > 0 and best not in negative:
                        positive.add(best)


def hash_of(word: str) -> int:
    return zlib.crc32(word.encode())


def unit_map(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subsequence numbers, their weights, and the norm of each unit."""
    codes = coded(words)
    parts = list(subsequences(codes))
    return np.concatenate([p for p, _ in parts], axis=1), np.repeat([w for _, w in parts], WIDE), norms(codes)


class Marks:
    """Explicit, normalised maps of landmark units: ``rows`` of the subsequences that any has, ``row`` of each subsequence (0: none has it)."""

    def __init__(self, rows: np.ndarray, row: np.ndarray):
        self.rows, self.row = rows, row


def norms_and_map(words: list[str]) -> Marks:
    places, weight, norm = unit_map(words)
    met = np.zeros(CODES**3, bool)
    met[places] = True
    met[::CODES] = False
    row = np.cumsum(met) * met
    rows = np.zeros((int(met.sum()) + 1, len(words)), np.float32)
    np.add.at(rows, (row[places], np.arange(len(words))[:, None]), (weight / norm[:, None]).astype(np.float32))
    rows[0] = 0
    return Marks(rows, row)


def kernel(marks: Marks, places: np.ndarray, weight: np.ndarray, norm: np.ndarray) -> np.ndarray:
    out = np.zeros((len(places), marks.rows.shape[1]), np.float32)
    for k in range(places.shape[1]):
        out += np.float32(weight[k]) * marks.rows[marks.row[places[:, k]]]
    return (out / norm[:, None]).astype(np.float64)


class Scorer:
    """Scores texts; keeps the pieces that it has met, up to a bound."""

    def __init__(self, machine: Machine, most: int = 120_000):
        self.machine, self.most, self.known = machine, most, {}

    def __call__(self, texts: Iterable[str]) -> np.ndarray:
        if self.machine.constant is not None:
            return np.full(len(list(texts)), self.machine.constant)
        return self.machine.probability(self.margins(texts))

    def margins(self, texts: Iterable[str]) -> np.ndarray:
        """Three margins of each text, within -1 and 1: the highest unit's, the best second one of a sentence, and the best of these and
        of the third ones of NEAR sentences."""
        out = [np.zeros((0, 3))]
        for part in slices(texts):
            rows = [sentences(t.lower()) for t in part]
            found = [p for own in rows for row in own for p in row]
            new = list(set(found).difference(self.known))
            if len(self.known) + len(new) > self.most:
                self.known.clear()
                new = list(set(found))
            self.known.update(zip(new, self.machine.piece_scores(new).tolist(), strict=True))
            margin = np.fromiter(map(self.known.__getitem__, found), np.float64, len(found))
            per_sentence = np.fromiter((len(row) for own in rows for row in own), np.int64)
            of_text = np.repeat(np.repeat(np.arange(len(rows)), [len(own) for own in rows]), per_sentence)
            near = [sum(map(len, own[i : i + NEAR])) for own in rows for i in range(0, len(own), NEAR)]
            tops = np.full((3, len(rows)), -1.0)
            if len(margin):
                left = margin.copy()
                drop_highest(left, per_sentence)
                np.maximum.at(tops[1], of_text, left)
                np.maximum.at(tops[0], of_text, margin)
                drop_highest(margin, np.array(near))
                drop_highest(margin, np.array(near))
                np.maximum.at(tops[2], of_text, margin)
            out.append(np.stack([tops[0], tops[1], np.maximum(tops[1], tops[2])], axis=1))
        return np.clip(np.concatenate(out), -1, 1)


def drop_highest(values: np.ndarray, sizes: np.ndarray) -> None:
    """Sets the first highest value of each group of neighbours to -inf."""
    sizes = sizes[sizes > 0]
    at = np.cumsum(sizes) - sizes
    places = np.flatnonzero(values == np.repeat(np.maximum.reduceat(values, at), sizes))
    group = np.searchsorted(at, places, "right")
    values[places[np.append(True, group[1:] != group[:-1])]] = -np.inf


def slices(texts: Iterable[str], size: int = 1 << 21) -> Iterator[list[str]]:
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Machine:
    """Fitted by a task on the bounded sample; the driver gets the machine only, neither its texts nor what training takes of memory."""
    known = labels.where(learnable(F.col("doc_id")) & F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine().fit(*in_order(pa.Table.from_batches(batches, SAMPLE)), known)
        yield pa.RecordBatch.from_pylist([{"weights": zlib.compress(machine.weights.tobytes(), 1), "bias": machine.bias, "curve": machine.curve.tolist(), "constant": machine.constant}], FITTED)

    sample = bounded_sample(docs, labels, label, PER_CLASS, drawn).repartition(1)
    found = mapped(sample, run, "weights binary, bias double, curve array<double>, constant double").collect()
    if not found:  # Spark knows an empty sample without a task
        return Machine().fit([], np.zeros(0), known)
    weights, bias, curve, constant = found[0]
    return unpacked((np.frombuffer(zlib.decompress(weights), np.float32), bias, np.array(curve), constant))


def drawn(text: str) -> str:
    """The text, or sentences of a long one, drawn by hash up to MAX_BYTES."""
    if len(text) * 4 <= MAX_BYTES or len(text.encode()) <= MAX_BYTES:
        return text
    out, size = [], 0
    for i, row in sorted(enumerate(sentences(text)), key=lambda x: (hash_of(" ".join(x[1])), x[0])):
        s = " ".join(row)[:MAX_BYTES]
        size += len(s.encode()) + 1
        if size > MAX_BYTES and out:
            break
        out.append((i, s))
    return "\n".join(s for _, s in sorted(out))


def packed(machine: Machine) -> tuple:
    return machine.weights, machine.bias, machine.curve, machine.constant


def unpacked(values: tuple) -> Machine:
    machine = Machine()
    machine.weights, machine.bias, machine.curve, machine.constant = values
    return machine


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(packed(machine))
    own = doc_texts(docs).withColumn("held_out", ~learnable(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(unpacked(shared.value))
        for batch in batches:
            p = score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= PREDICT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return mapped(own.select("doc_id", "text", "held_out"), run, "doc_id long, held_out boolean, score double, predicted int")


def clean_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """docs without those that are predicted toxic; all columns, one pass and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(packed(machine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(unpacked(shared.value))
        for batch in batches:
            p = score([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(p < PREDICT))

    return mapped(docs, run, docs.schema)
