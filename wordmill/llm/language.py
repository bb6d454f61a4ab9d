"""Language identification by nearest centroids.

A text becomes a vector of byte 2-grams and 3-grams (of the lower-cased letters,
everything else a space), hashed into a fixed number of places, as log counts
times inverse document frequencies, with length one. Each language has several
centroids from spherical k-means over its sample; a text gets the language of the
centroid with the largest cosine. Every centroid keeps the cosine that nearly all
its own members reach; a text below it by a margin is rejected as far from all
learned languages.

Fitting takes a bounded sample: at most ``sample`` distinct texts per language
and ``total`` in all (but one per language), drawn by a hash of text and language,
so copies neither raise a text's chance nor its weight, and the centroids are fitted on the
driver (languages x sample sparse vectors of at most DIMS numbers). Predicting is
a narrow map over whole texts with the centroids (languages x k x DIMS floats).

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and
so is everything when nothing can be learned; rows with a null language or
doc_id are not learned from; repeated rows are predicted alike; equal cosines go
to the language first in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, documents, map_text, register

BITS2, BITS3 = 11, 13
DIMS = (1 << BITS2) + (1 << BITS3)
SAMPLE = 400
TOTAL = 8000
CENTROIDS = 4
ROUNDS = 12
MARGIN = 0.15

# Bytes of ASCII characters that are no letters become a space.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def counts(text: bytes) -> np.ndarray:
    """n-gram counts of a whole text, a piece at a time."""
    out = np.zeros(DIMS, np.int64)
    clean = b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().translate(_LETTERS).split()) + b" "
    for at in range(0, len(clean), 1 << 20):
        a = np.frombuffer(clean[at : at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        if len(a) < 3:
            continue
        two = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] + a[2:] * np.uint32(0xC2B2AE3D)
        two = (two ^ (two >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        three = (three ^ (three >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        # A later piece starts with the two bytes that the one before ended on.
        out[: 1 << BITS2] += np.bincount(two[: 1 << 20] >> np.uint32(32 - BITS2), minlength=1 << BITS2)
        out[1 << BITS2 :] += np.bincount(three >> np.uint32(32 - BITS3), minlength=1 << BITS3)
    return out


@dataclass
class Model:
    languages: list[str]
    of: np.ndarray  # language number of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    reach: np.ndarray  # cosine that members of the centroid have

    def vectors(self, texts: list[bytes]) -> np.ndarray:
        return _unit(np.log1p(np.array([counts(t) for t in texts], np.float32)) * self.idf)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine, and whether the nearest centroid is near enough."""
        lang = ["und"] * len(texts)
        score, near = np.zeros(len(texts)), np.zeros(len(texts), bool)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for s in range(0, len(known), 128):
            at = known[s : s + 128]
            cosine = self.vectors([texts[i] for i in at]) @ self.centroids.T
            best = cosine.argmax(1)
            for i, c, x in zip(at, best.tolist(), cosine.max(1).tolist(), strict=True):
                lang[i], score[i] = self.languages[self.of[c]], min(1.0, max(0.0, x))
                near[i] = x >= self.reach[c] - MARGIN
        return lang, score, near


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: centroids and members."""
    seeds = [int((x @ x.mean(0)).argmax())]
    while len(seeds) < min(k, len(x)):
        seeds.append(int((x @ x[seeds].T).max(1).argmin()))
    c = x[seeds]
    for _ in range(ROUNDS):
        member = (x @ c.T).argmax(1)
        c = _unit(np.array([x[member == j].sum(0) if (member == j).any() else c[j] for j in range(len(c))]))
    return c, (x @ c.T).argmax(1)


def fit(labelled: DataFrame, sample: int = SAMPLE, total: int = TOTAL, k: int = CENTROIDS) -> Model:
    """labelled(text, lang) -> Model from a hash sample of the distinct texts,
    never more than ``sample`` of a language."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    rows = rows.withColumn("__h", F.xxhash64("text", "lang"))
    sizes = {r.lang: r.n for r in rows.select("lang", "__h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    each = min(sample, max(1, total // max(1, len(languages))))
    u = F.pmod("__h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate: Column = F.lit(0.0)
    for lang in languages:
        rate = F.when(F.col("lang") == lang, min(1.0, each / sizes[lang])).otherwise(rate)

    def sparse(texts: list[bytes | None]) -> dict[str, pa.Array]:
        at, n = [], []
        for t in texts:
            c = counts(t) if has_letter(t) else np.zeros(0, np.int64)
            at.append(np.flatnonzero(c).astype(np.int32))
            n.append(c[at[-1]].astype(np.int32))
        kind = pa.list_(pa.int32())
        return {"at": pa.array(at, kind), "n": pa.array(n, kind)}

    # Hashes are drawn first, so only the texts of drawn ones move, one of each.
    drawn = rows.where(u < rate).select("lang", "__h").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod("__h", F.lit(1 << 30)), "__h")
    drawn = [r["__h"] for r in drawn.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= each).collect()]
    once = rows.where(F.col("__h").isin(drawn)).groupBy("lang", "__h").agg(F.first("text").alias("text"))
    picked = map_text(once.select("text", "lang"), sparse, "at array<int>, n array<int>").drop("text").collect()
    picked = sorted((r for r in picked if r.at), key=lambda r: (r.lang, r.at, r.n))
    x = np.zeros((len(picked), DIMS), np.float32)
    for i, r in enumerate(picked):
        x[i, r.at] = r.n
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x = _unit(np.log1p(x) * idf)
    of, centroids, reach = [], [], []
    learned = sorted({r.lang for r in picked})
    for j, lang in enumerate(learned):
        own = x[[i for i, r in enumerate(picked) if r.lang == lang]]
        c, member = _cluster(own, k)
        for m in range(len(c)):
            cosines = own[member == m] @ c[m]
            if len(cosines):
                of.append(j)
                centroids.append(c[m])
                reach.append(np.quantile(cosines, 0.005))
    return Model(learned, np.array(of, int), np.array(centroids, np.float32).reshape(-1, DIMS), idf, np.array(reach))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs(text, ...) plus lang_pred, lang_score (cosine) and lang_near (false:
    rejected, too far from what was learned)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        lang, score, near = shared.value.predict(texts)
        return {"lang_pred": pa.array(lang), "lang_score": pa.array(score), "lang_near": pa.array(near)}

    return map_text(docs, run, "lang_pred string, lang_score double, lang_near boolean")


@register("op4_language_id")
def q_language(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = fit(docs.where(crc_mod("doc_id", 4) != 2).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_near").alias("near"),
    )
