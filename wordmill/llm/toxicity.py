"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear SVM.

The kernel of two strings sums, over all common subsequences of 2, 3 and 4
characters, a decay per character that each string spends on it, gaps included;
each order is normalised and the three are averaged. An insult with inserted or
gapped characters thus stays near the plain one. With m landmark strings, a
string becomes the m numbers K(x, Z) K(Z, Z)^(-1/2), and the SVM is linear in
those.

Training is by multiple instances. The bags are sentences of labelled documents:
a sentence of a clean document has clean words only; a sentence of a toxic one
that holds a suspicious word (far more frequent among toxic documents) has at
least one toxic word, its witness. Witnesses, the same with random inserted
characters, and clean words (some drawn, and in rounds those that come nearest
to the toxic side) train the SVM. The landmarks are witnesses that are far from
each other, and some clean words.

A document's evidence is the largest margins of its words, so one insult in a
very long text counts, and the log number of its words. A logistic curve fitted on the sampled documents turns it into a score.
Punctuation and digits inside words are dropped first, and runs of three or more
single characters are also read as one word.

Fitting takes a bounded sample: about ``sample`` documents of each label, drawn
by a hash of the row, none over ``max_chars`` characters. Scoring is a narrow map
over whole texts. The SVM's margin is linear in a word's normalised subsequence
counts, so the weights are folded into one weight per subsequence of a landmark
(``Folded``, a trie): a word is read once, not once per landmark. Margins are
computed once per distinct word and batch, with a bounded cache across batches.

Defined cases: a text without words (null, empty) has score 0; with no labelled
toxic or no clean rows all scores are 0; several labels of one document all count; repeated rows are scored alike; an
empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, documents, map_text, read_table, register

DECAY = 0.5
ORDERS = (2, 3, 4)
WIDEST = 24  # longer words are read in overlapping pieces
SAMPLE = 1000
MAX_CHARS = 200_000
LANDMARKS = 40
MIN_SUPPORT = 5  # toxic documents of the sample that a suspicious word is in
MIN_ODDS = 3.0  # its log odds of toxic against clean documents
POOL = 20_000  # clean words that are searched for hard ones
CACHE = 1_000_000
THRESHOLD = 0.7

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_DROP = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalpha())
_SPELLED = re.compile(rb"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
_SENTENCE = re.compile(rb"[.!?\n]+")


def words_of(text: bytes | None) -> set[bytes]:
    if not text:
        return set()
    plain = text.translate(_LOWER, _DROP)
    out = set(plain.split())
    out.update(b"".join(m.group().split()) for m in _SPELLED.finditer(plain))
    for w in [w for w in out if len(w) > WIDEST]:
        out.discard(w)
        out.update(w[i : i + WIDEST] for i in range(0, len(w) - WIDEST // 2, WIDEST // 2))
    return out


def _bound(word: bytes) -> bytes:
    """word between marks for its start and end, which take part as characters."""
    return b"^" + word + b"$"


def _matrix(strings: list[bytes], width: int, pad: int) -> np.ndarray:
    out = np.full((len(strings), width), pad, np.int16)
    for i, s in enumerate(strings):
        out[i, : len(s)] = np.frombuffer(s, np.uint8)
    return out


def _raw(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Unnormalised kernels, one row per order, of s and t with shapes that
    broadcast in front of the positions (last axis)."""
    top = max(ORDERS)
    shape = np.broadcast_shapes(s.shape[:-1], t.shape[:-1])
    n = t.shape[-1]
    out = np.zeros((len(ORDERS), *shape), np.float32)
    d = np.float32(DECAY)
    # before[i][k]: decayed sum over the part of s read so far and the first k
    # positions of t, of common subsequences of length i.
    before = [np.ones((n + 1, *shape), np.float32)] + [np.zeros((n + 1, *shape), np.float32) for _ in range(top - 1)]
    grown, part = np.empty(shape, np.float32), np.empty(shape, np.float32)
    for j in range(s.shape[-1]):
        equal = [np.broadcast_to(s[..., j] == t[..., k], shape) * (d * d) for k in range(n)]
        for x, order in enumerate(ORDERS):
            for k in range(n):
                out[x] += np.multiply(equal[k], before[order - 1][k], out=part)
        for i in range(top - 1, 0, -1):  # longer ones first: they read the shorter as they were
            before[i] *= d
            grown[...] = 0
            for k in range(n):
                grown *= d
                grown += np.multiply(equal[k], before[i - 1][k], out=part)
                before[i][k + 1] += grown
    return out


def _own(s: np.ndarray) -> np.ndarray:
    """Unnormalised kernels, one row per order, of strings of one length with
    themselves (positions first): the recurrence of ``_raw``, with the inner loop
    over positions as a product with a triangle of decays."""
    n, count = s.shape
    gap = np.subtract.outer(np.arange(n), np.arange(n))
    fade = np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0).astype(np.float32)
    top = max(ORDERS)
    before = [np.ones((n, count), np.float32)] + [np.zeros((n, count), np.float32) for _ in range(top - 1)]
    out = np.zeros((len(ORDERS), count), np.float32)
    for j in range(n):
        equal = (s == s[j]) * np.float32(DECAY * DECAY)
        ends = [equal * b for b in before]
        for x, order in enumerate(ORDERS):
            out[x] += ends[order - 1].sum(0)
        for i in range(1, top):
            before[i] *= np.float32(DECAY)
            before[i][1:] += fade[:-1, :-1] @ ends[i - 1][:-1]
    return out


def kernel(strings: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """K(string, landmark), 0 to 1."""
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    if not strings:
        return out
    strings, landmarks = [*map(_bound, strings)], [*map(_bound, landmarks)]
    z = _matrix(landmarks, max(map(len, landmarks)), -2)
    own_z = np.array([_raw(np.array([x]), np.array([x]))[:, 0] for x in (_matrix([w], len(w), -2)[0] for w in landmarks)]).T
    order = sorted(range(len(strings)), key=lambda i: len(strings[i]))
    for at in range(0, len(order), 256):
        part = order[at : at + 256]
        width = max(1, len(strings[part[-1]]))
        s = _matrix([strings[i] for i in part], width, -1)
        own_s = _raw(s, np.where(s < 0, np.int16(-3), s))
        cross = _raw(s[:, None, :], z[None, :, :])
        norm = np.sqrt(own_s[:, :, None] * own_z[:, None, :])
        out[part] = np.where(norm > 0, cross / np.maximum(norm, 1e-20), 0).mean(0)
    return out


class Folded:
    """sum over landmarks z of weights[z] K(x, z), as a trie of the landmarks'
    subsequences of 2, 3 and 4 characters. State 0 is that of no landmark."""

    def __init__(self, landmarks: list[bytes], weights: np.ndarray):
        marks = [*map(_bound, landmarks)]
        symbols = sorted(set().union(*marks))
        self.code = np.zeros(256, np.int32)  # 0: in no landmark
        self.code[symbols] = np.arange(1, len(symbols) + 1)
        self.size = len(symbols) + 1
        states: list[dict[tuple[int, ...], int]] = [{}, {}]
        sums: dict[tuple[int, ...], float] = {}
        for z, weight in zip(marks, weights.tolist(), strict=True):
            chars = np.frombuffer(z, np.uint8)
            own = _own(chars[:, None])[:, 0]
            coded = self.code[chars].tolist()
            for x, order in enumerate(ORDERS):
                if own[x] <= 0:
                    continue
                share = weight / (len(ORDERS) * float(own[x]) ** 0.5)
                for at in combinations(range(len(z)), order):
                    u = tuple(coded[i] for i in at)
                    sums[u] = sums.get(u, 0.0) + share * DECAY ** (at[-1] - at[0] + 1)
        for u in sums:
            if len(u) > 2:
                states[len(u) - 3].setdefault(u[:-1], len(states[len(u) - 3]) + 1)
        rows = [self.size, len(states[0]) + 1, len(states[1]) + 1]
        self.value = [np.zeros(n * self.size, np.float32) for n in rows]
        self.step = [np.zeros(n * self.size, np.int32) for n in rows[:2]]
        state = [{}, *states]

        def place(u: tuple[int, ...]) -> int:
            return (u[0] if len(u) == 2 else state[len(u) - 2][u[:-1]]) * self.size + u[-1]

        for u, v in sums.items():
            self.value[len(u) - 2][place(u)] = v
        for depth in (0, 1):
            for u, n in states[depth].items():
                self.step[depth][place(u)] = n

    def __call__(self, strings: list[bytes]) -> np.ndarray:
        out = np.zeros(len(strings))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(strings):
            by_length.setdefault(len(w) + 2, []).append(i)
        for n, found in by_length.items():
            paths = _paths(n)
            room = max(32, 300_000 // max(n, len(paths[-1][0])))
            for at in range(0, len(found), room):
                part = found[at : at + room]
                raw = np.frombuffer(b"".join(_bound(strings[i]) for i in part), np.uint8)
                # Positions first, so that a tuple's states for all words lie together.
                raw = np.ascontiguousarray(raw.reshape(-1, n).T)
                own = _own(raw)
                before = coded = self.code[raw]
                for x, (head, last, decay) in enumerate(paths):
                    here = before[head]
                    here *= self.size
                    here += coded[last]
                    total = decay @ self.value[x].take(here)
                    out[part] += np.where(own[x] > 0, total / np.sqrt(np.maximum(own[x], 1e-20)), 0)
                    if x < 2:
                        before = self.step[x].take(here)
        return out


@lru_cache(64)
def _paths(n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For pairs, triples and quadruples of rising positions below n: the number
    of the shorter tuple they extend, the last position, and the decay."""
    out, shorter = [], [(i,) for i in range(n)]
    for _ in ORDERS:
        longer = [(k, (*u, j)) for k, u in enumerate(shorter) for j in range(u[-1] + 1, n)]
        shorter = [u for _, u in longer]
        out.append(
            (
                np.array([k for k, _ in longer], np.intp),
                np.array([u[-1] for u in shorter], np.intp),
                np.array([DECAY ** (u[-1] - u[0] + 1) for u in shorter], np.float32),
            )
        )
    return out


@dataclass
class Model:
    landmarks: list[bytes]
    weights: np.ndarray  # of K(x, Z), with the Nystroem matrix multiplied in
    bias: float
    slope: np.ndarray  # score = 1 / (1 + exp(-(slope . evidence + shift)))
    shift: float
    cache: dict[bytes, float] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.folded = Folded(self.landmarks, self.weights)

    def margins(self, words: list[bytes]) -> np.ndarray:
        """kernel(words, landmarks) @ weights + bias."""
        return self.folded(words) + self.bias

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        sets = [words_of(t) for t in texts]
        if not self.landmarks:
            return np.zeros(len(texts))
        new = list(set().union(*sets).difference(self.cache))
        for i in range(0, len(new), 16384):
            part = new[i : i + 16384]
            self.cache.update(zip(part, self.margins(part).tolist(), strict=True))
        found = np.array([_evidence([*map(self.cache.__getitem__, s)], self.bias) for s in sets]).reshape(-1, TOP + 1)
        if len(self.cache) > CACHE:
            self.cache.clear()
        out = 1 / (1 + np.exp(-np.clip(found @ self.slope + self.shift, -30, 30)))
        return np.where([bool(s) for s in sets], out, 0.0)


TOP = 3
FEW = 10  # fewer words count as so many


def _evidence(margins: list[float], bias: float) -> list[float]:
    """Of a document: its largest margins, and the log number of its words, of
    which some may reach the toxic side by chance."""
    m = np.full(max(TOP, len(margins)), -1.5)
    m[: len(margins)] = margins
    best = -np.partition(-m, TOP - 1)[:TOP]
    return [*np.clip(np.sort(best)[::-1], -1.5, 1.5).tolist(), float(np.log1p(max(len(margins), FEW)))]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; classes weigh alike,
    examples within a class by ``weight``."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = weight * np.where(y > 0, 0.5 / weight[y > 0].sum(), 0.5 / weight[y < 0].sum())
    ridge = penalty * np.eye(x1.shape[1])
    ridge[-1, -1] *= 0.01
    w = np.zeros(x1.shape[1])
    for _ in range(rounds):
        inside = y * (x1 @ w) < 1
        part, scaled = x1[inside], (share * inside)[inside, None] * x1[inside]
        new = np.linalg.solve(scaled.T @ part + ridge, scaled.T @ y[inside])
        if np.allclose(new, w, rtol=0, atol=1e-7):
            break
        w = 0.5 * (w + new) if _ > 10 else new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and shift of a logistic curve, by Newton steps with a small
    penalty and softened labels."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(b))
        b = b - np.clip(np.linalg.solve(h, a.T @ (p - target) + 1e-2 * b), -2, 2)
    return b[:-1], float(b[-1])


def _variants(word: bytes, rnd: random.Random) -> list[bytes]:
    """word with one or two inserted or doubled characters."""
    out = []
    for extra in (1, 1, 2):
        w = bytearray(word)
        for _ in range(extra):
            at = rnd.randrange(1, len(w)) if len(w) > 1 else 1
            w.insert(at, rnd.choice([rnd.randrange(0x61, 0x7B), w[at - 1]]))
        out.append(bytes(w))
    return out


def _spread(words: list[bytes], k: int) -> list[bytes]:
    """k of words, each the farthest in the kernel from those before it."""
    near = kernel(words, words)
    picked = [0]
    while len(picked) < min(k, len(words)):
        picked.append(int(near[:, picked].max(1).argmin()))
    return [words[i] for i in picked]


def train(bags: list[tuple[list[list[bytes]], int]]) -> Model:
    """bags: the sentences (word lists) and the label of each document."""
    toxic = [b for b, y in bags if y]
    clean = [b for b, y in bags if not y]
    if not toxic or not clean:
        return Model([], np.zeros(0), 0.0, np.zeros(TOP + 1), 0.0)
    df = [Counter(w for doc in side for w in {w for s in doc for w in s}) for side in (toxic, clean)]
    least = min(MIN_SUPPORT, len(toxic))
    odds = {
        w: np.log((n + 0.5) / (len(toxic) + 1)) - np.log((df[1][w] + 0.5) / (len(clean) + 1))
        for w, n in df[0].items()
        if n >= least
    }
    suspicious = {w for w, x in odds.items() if x > MIN_ODDS} or {max(odds, key=lambda w: (odds[w], w))}
    # The witness of a sentence of a toxic document is its most suspicious word.
    witnesses = Counter(
        max((w for w in s if w in suspicious), key=lambda w: (odds[w], w))
        for doc in toxic
        for s in doc
        if not suspicious.isdisjoint(s)
    )
    ranked = [w for w, _ in sorted(witnesses.items(), key=lambda x: (-x[1], x[0]))][:400]
    common = [w for w, _ in sorted(df[1].items(), key=lambda x: (-x[1], x[0])) if w and w not in suspicious][:300]
    landmarks = _spread(ranked, LANDMARKS - 8) + common[:8]
    value, vector = np.linalg.eigh(kernel(landmarks, landmarks).astype(float))
    nystroem = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    rnd = random.Random(0)
    pairs = [(w, witnesses[w]) for w in ranked]
    pairs += [(v, witnesses[w] / 6) for w in ranked if len(w) > 3 for v in _variants(w, rnd)]
    positives = [w for w, _ in pairs]
    usual = sorted(w for w in df[1] if w not in suspicious)
    negatives = {*rnd.sample(usual, min(2000, len(usual))), *common, b""}
    # Clean words near the toxic side join the training set, round by round.
    pool = usual if len(usual) <= POOL else sorted(rnd.sample(usual, POOL))
    features = kernel(pool, landmarks) @ nystroem
    at = {w: i for i, w in enumerate(pool)}
    x_pos = kernel(positives, landmarks) @ nystroem
    x_other = kernel(sorted(negatives - at.keys()), landmarks) @ nystroem
    chosen = sorted(at[w] for w in negatives if w in at)
    for _ in range(3):
        x = np.vstack([x_pos, x_other, features[chosen]])
        y = np.where(np.arange(len(x)) < len(x_pos), 1.0, -1.0)
        weight = np.concatenate([[n for _, n in pairs], np.ones(len(x) - len(pairs))])
        w, b = _svm(x, y, weight)
        hard = np.argsort(-(features @ w), kind="stable")[:1500].tolist()
        chosen = sorted({*chosen, *hard})
    model = Model(landmarks, nystroem @ w, b, np.zeros(TOP + 1), 0.0)
    docs = [({w for s in d for w in s}, y) for d, y in bags]
    vocabulary = sorted(set().union(*(d for d, _ in docs)))
    margin = dict(zip(vocabulary, model.margins(vocabulary).tolist(), strict=True))
    found = np.array([_evidence([margin[w] for w in d], b) for d, _ in docs])
    model.slope, model.shift = _logistic(found, np.array([float(y) for _, y in docs]))
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_chars: int = MAX_CHARS) -> Model:
    """docs(doc_id, text), labels(doc_id, toxic) -> Model.

    At most ``sample`` ids of each label are drawn by a hash of doc_id before
    the join, however often their rows repeat, and one text of each id is taken
    (the least of several), so what is broadcast and what reaches the driver is
    bounded: 2 ``sample`` ids, and as many texts of ``max_chars`` characters."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").alias("__id"), "toxic").distinct()
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    u = F.pmod(F.xxhash64("__id", F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A little more than asked passes the rate; the least hashes of these are taken.
    share = lambda n: min(1.0, 1.2 * (sample + 20) / max(n, 1))
    rate = F.when(F.col("toxic") == 1, share(sizes.get(1, 1))).otherwise(share(sizes.get(0, 1)))
    order = Window.partitionBy("toxic").orderBy("__u", "__id")
    few = rows.withColumn("__u", u).where(F.col("__u") < rate).withColumn("__r", F.row_number().over(order))
    few = few.where(F.col("__r") <= sample).select("__id", "toxic")
    texts = docs.where(F.length("text") <= max_chars).select("doc_id", "text")
    drawn = texts.join(F.broadcast(few), F.col("doc_id") == F.col("__id"))
    drawn = drawn.groupBy("__id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")

    def bags(texts: list[bytes | None]) -> dict[str, pa.Array]:
        docs = [[sorted(w) for s in _SENTENCE.split(t or b"") if (w := words_of(s))] for t in texts]
        return {"bag": pa.array(docs, pa.list_(pa.list_(pa.binary())))}

    picked = map_text(drawn, bags, "bag array<array<binary>>").drop("text").collect()
    return train(sorted(([[bytes(w) for w in s] for s in r.bag], r.toxic) for r in picked))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs(text, ...) plus ``toxicity``, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_text(docs, lambda texts: {"toxicity": pa.array(shared.value.scores(texts))}, "toxicity double")


@register("op8_toxicity")
def q_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(crc_mod("doc_id", 3) != 1)
    model = fit(docs, labels)
    return score(docs, model).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
