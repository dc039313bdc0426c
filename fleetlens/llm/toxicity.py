"""Toxicity: gradient-boosted trees over dense features, isotonically calibrated.

Features of a whole text: densities of a given and of a learned lexicon (words
and word stems, also behind look-alike characters), second-person words and
their closeness to lexicon words, capitals, punctuation, and obfuscation rates.
Language, source, id and labels are no features.

Learning uses labelled rows whose crc32(id) mod 5 is not 0, at most
``MAX_ROWS`` of them, the smallest by a hash of the id. The other four
remainders are folds. The learned lexicon holds the terms with the largest
lower bounds of the log-odds of label 1; the features of a training
document use a lexicon learned without its fold, so terms that are there by
chance do not look as good in training as they are. Folds 1-3 train Spark's
GBTClassifier, fold 4 its IsotonicRegression on the trees' margin. The score is
the calibrated probability with a small share of the margin's logistic, which
orders the texts that calibration ties.

Defined results: a null text is scored as an empty one; a null id counts as
held out; labels that are null are ignored, an id labelled twice takes the
larger label; repeated rows get equal scores; without both labels in training,
every score is the share of label 1 (0 without any); an empty table gives no
rows; other columns are kept by :func:`score` and ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.caches import worker_cache
from fleetlens.llm.common import crc_mod, load, staged

MAX_ROWS = 16_000
MAX_TERMS = 3_000
#: Terms in the lexicon: in so many documents of label 1, with so large a lower
#: bound (95 %) of the log-odds of label 1.
MIN_DOCS, MIN_BOUND, SIDE = 3, 1.6, 1.64
STEMS = (4, 5)
TREES, DEPTH = 20, 3
CACHE_WORDS = 400_000

#: Common insults, and second-person words, of a few languages.
INSULTS = frozenset("""
ass asshole bastard bitch clown coward creep crap cretin damn disgusting dumb dumbass fool freak garbage hate idiot
idiotic imbecile jerk kill liar loser lousy moron nasty pathetic pig psycho rat retard scum scumbag shit shut sick slut
stupid suck sucks trash ugly useless vermin worthless
arschloch blöd blödmann depp drecksack dumm dummkopf hurensohn idiotin scheiße schwachkopf trottel wichser
abruti batard con connard connasse crétin débile imbécile merde ordure pute salaud salope
cabron cabrón estúpido estupido gilipollas idiota imbécil mierda pendejo puta tonto
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself u ur ya youre you're
du dich dir dein deine euch euer ihr
tu te toi ton ta tes vous votre vos
tú ti usted ustedes vosotros vuestro
""".split())
#: Characters written for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

FEATURES = ("learned", "learned_weight", "learned_log", "learned_kinds", "learned_top", "insults", "hidden", "near_you",
            "you", "caps", "caps_words", "exclaim", "punctuation", "punct_runs", "obfuscated", "stretched", "size")
_LETTERS = re.compile(r"[^\W\d_]+")
_STRETCH = re.compile(r"(.)\1\1")
_RUNS = re.compile(r"[!?.*#$%&]{2,}")


def terms(word: str) -> list[str]:
    """A lower-cased word and its stems as lexicon terms."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _strip(token: str) -> str:
    return token.strip(".,;:!?\"'()[]{}*#$%&|")


class Features:
    """Feature rows of texts for some lexicons (``name -> term -> weight``).

    What a token adds is computed once and kept while there is room; tokens
    that come later are computed again in each text."""

    #: Numbers per token that no lexicon changes.
    BASE = 9

    def __init__(self, lexicons: dict):
        self.lexicons = lexicons
        self.column = {name: self.BASE + 2 * i for i, name in enumerate(lexicons)}
        self.width = self.BASE + 2 * len(lexicons)
        self.ids: dict[str, int] = {}
        self.flat = array("f")

    def _token(self, token: str) -> list[float]:
        low = token.lower()
        if token.isalpha():
            core, letters, mixed = low, len(token), False
            caps = 0 if token.islower() else sum(map(str.isupper, token))
            exclaim = 0
        else:
            core, letters = _strip(low), sum(map(str.isalpha, token))
            caps = sum(map(str.isupper, token))
            exclaim = token.count("!") + token.count("?")
            inner = core.replace("'", "").replace("-", "")
            mixed = bool(inner) and letters > 0 and not inner.isalpha()
        stretched = core.isalpha() and _STRETCH.search(core) is not None
        plain = core
        if mixed or stretched:
            plain = _STRETCH.sub(r"\1", "".join(_LETTERS.findall(core.translate(LOOKALIKES))))
        insult = core in INSULTS
        out = [insult, core in SECOND_PERSON, letters, caps, letters > 1 and caps == letters, exclaim,
               len(token) - letters, mixed, stretched]
        for lexicon in self.lexicons.values():
            weight = _weight(lexicon, core)
            hidden = plain != core and not weight and not insult and (plain in INSULTS or _weight(lexicon, plain) > 0)
            out += (weight, hidden)
        return out

    def row(self, text: str | None, name=None) -> np.ndarray:
        tokens = (text or "").split()
        ids, known = self.ids, len(self.ids)
        found, new = list(map(ids.get, tokens)), []
        if None in found:
            for i, at in enumerate(found):
                if at is None:
                    at = ids.get(tokens[i])
                    if at is None:
                        at = ids[tokens[i]] = len(ids)
                        new.append(tokens[i])
                        self.flat.extend(self._token(tokens[i]))
                    found[i] = at
        at = np.array(found, dtype=np.int64)
        v = np.frombuffer(self.flat, "f4").reshape(-1, self.width)[at].astype(float) if len(at) else np.zeros((0, self.width))
        if known >= CACHE_WORDS:  # no room: forget what this text added
            for t in new:
                del ids[t]
            del self.flat[known * self.width:]
        insult, you, letters, caps, shout, exclaim, punct, mixed, stretched = v[:, : self.BASE].sum(axis=0)
        weight, hidden = v[:, self.column[name]], v[:, self.column[name] + 1]
        n, hits = max(1, len(at)), (weight > 0).sum()
        where, yous = np.flatnonzero((weight > 0) | (v[:, 0] > 0) | (hidden > 0)), np.flatnonzero(v[:, 1])
        near = 0
        if len(where) and len(yous):
            i = np.searchsorted(yous, where)
            gap = np.minimum(np.abs(yous[np.minimum(i, len(yous) - 1)] - where), np.abs(yous[np.maximum(i - 1, 0)] - where))
            near = (gap <= 5).sum()
        letters = max(1.0, letters)
        return np.array([hits / n, weight.sum() / n, math.log1p(hits), len(np.unique(at[weight > 0])), weight.max(initial=0.0),
                         insult / n, hidden.sum() / n, near / n, you / n, caps / letters, shout / n, exclaim / n,
                         punct / n, len(_RUNS.findall(text or "")) / n, mixed / n, stretched / n, math.log1p(n)])


def _weight(lexicon: dict[str, float], word: str) -> float:
    """The largest weight of a word's terms."""
    out = lexicon.get(word, 0.0)
    for n in STEMS:
        if len(word) > n:
            out = max(out, lexicon.get(word[:n] + "*", 0.0))
    return out


def _features(lexicons: dict) -> Features:
    """The worker's features for these lexicons; only the last ones are kept."""
    key = hash(tuple((name, frozenset(lexicon.items())) for name, lexicon in lexicons.items()))
    return worker_cache(("features", key), lambda: Features(lexicons))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_ROWS) -> DataFrame:
    """``text, toxic, fold`` of the labelled rows to learn from."""
    known = (labels.filter(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max("toxic").cast("double").alias("label"))
             .withColumn("fold", crc_mod(F.col("id"), 5)).filter("fold <> 0 AND id IS NOT NULL"))
    some = known.orderBy(F.xxhash64("id"), "id").limit(limit)
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    # at most ``limit`` rows of three numbers are broadcast
    return staged(text.join(F.broadcast(some), "id").select("text", "label", "fold"), "toxic-training")


def _count_terms(batches):
    """Documents with each term, per fold and label, summed within the task."""
    counts: Counter = Counter()

    def out():
        rows = [(t, f, y, n) for (t, f, y), n in counts.items()]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64()))], ["term", "fold", "y", "n"])
    for b in batches:
        for text, y, fold in zip(*(b.column(c).to_pylist() for c in ("text", "label", "fold"))):
            words = {_strip(t) for t in (text or "").lower().split()}
            found = {t for w in words if w for t in terms(w)}
            counts.update((t, int(fold), int(y)) for t in found)
            if len(counts) > 1_000_000:
                yield out()
                counts.clear()
    yield out()


def _weights(rows, without: int | None, totals: dict) -> dict[str, float]:
    """Lexicon from counts per fold, leaving one fold out."""
    folds = [f for f in range(1, 5) if f != without]
    pos, neg = (sum(totals.get((f, y), 0) for f in folds) for y in (1, 0))
    out = {}
    for r in rows:
        a, b = sum(r[f"a{f}"] for f in folds), sum(r[f"b{f}"] for f in folds)
        if a >= MIN_DOCS:
            odds = math.log((a + 0.5) / (pos + 1)) - math.log((b + 0.5) / (neg + 1))
            bound = odds - SIDE * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if bound >= MIN_BOUND:
                out[r["term"]] = bound
    return out


def learn_lexicons(training: DataFrame, totals: dict) -> dict[int | None, dict[str, float]]:
    """The lexicon of all folds (key None) and those without each fold; at most
    ``MAX_TERMS`` candidate terms come to the driver."""
    counts = training.mapInArrow(_count_terms, "term string, fold int, y int, n long")
    agg = [F.sum(F.when((F.col("fold") == f) & (F.col("y") == y), F.col("n")).otherwise(0)).alias(f"{c}{f}")
           for f in range(1, 5) for c, y in (("a", 1), ("b", 0))]
    per = counts.groupBy("term").agg(*agg)
    a = F.col("a1") + F.col("a2") + F.col("a3") + F.col("a4")
    b = F.col("b1") + F.col("b2") + F.col("b3") + F.col("b4")
    pos, neg = (sum(totals.get((f, y), 0) for f in range(1, 5)) for y in (1, 0))
    odds = F.log((a + 0.5) / (pos + 1)) - F.log((b + 0.5) / (neg + 1))
    bound = odds - SIDE * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    rows = (per.filter(a >= MIN_DOCS).withColumn("bound", bound).filter(F.col("bound") >= MIN_BOUND)
            .orderBy(F.desc("bound"), "term").limit(MAX_TERMS).collect())
    return {f: _weights(rows, f, totals) for f in (None, 1, 2, 3, 4)}


def _feature_udf(lexicons: dict):
    """Feature arrays of ``(text, fold)``; fold 0 means the lexicon of all folds."""
    @F.pandas_udf("array<double>")
    def run(text: pd.Series, fold: pd.Series) -> pd.Series:
        features = _features(lexicons)
        return pd.Series([features.row(t, f or None).tolist() for t, f in zip(text, fold)])
    return run


class ToxicityModel:
    """Lexicons, trees and calibration; ``share`` stands in without both labels."""

    def __init__(self, lexicons, trees, calibration, share: float):
        self.lexicons, self.trees, self.calibration, self.share = lexicons, trees, calibration, share

    def margin(self, rows: DataFrame) -> DataFrame:
        return (self.trees.transform(rows.withColumn("__vec", array_to_vector("__f")))
                .withColumn("__margin", vector_to_array("rawPrediction")[1])
                .drop("rawPrediction", "probability", "prediction", "__vec"))

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with its columns and ``__score``."""
        if self.trees is None:
            return docs.withColumn("__score", F.lit(float(self.share)))
        # columns of the caller are kept apart from the names that Spark's models write
        kept = docs.select(F.struct(*docs.columns).alias("__row"), F.col("text").cast("string").alias("__text"))
        rows = kept.withColumn("__f", _feature_udf({None: self.lexicons[None]})("__text", F.lit(0))).drop("__text")
        rows = self.calibration.transform(self.margin(rows)) if self.calibration else self.margin(rows).withColumn("__p", F.lit(0.5))
        logistic = 1 / (1 + F.exp(-2 * F.col("__margin")))
        return rows.select("__row.*", (0.98 * F.least(F.greatest("__p", F.lit(0.0)), F.lit(1.0)) + 0.02 * logistic).alias("__score"))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    training = training_rows(docs, labels)
    totals = {(r["fold"], int(r["label"])): r["n"] for r in training.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    by_label = {y: sum(n for (_, v), n in totals.items() if v == y) for y in (0, 1)}
    share = by_label[1] / max(1, sum(by_label.values()))
    trained = {y for (f, y), n in totals.items() if f < 4 and n}
    if trained != {0, 1}:
        return ToxicityModel({None: {}}, None, None, share)
    lexicons = learn_lexicons(training, totals)
    rows = staged(training.withColumn("__f", _feature_udf(lexicons)("text", F.col("fold").cast("int")))
                  .select("__f", "label", "fold"), "toxic-features").coalesce(4)
    trees = GBTClassifier(featuresCol="__vec", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1).fit(
        rows.filter("fold < 4").withColumn("__vec", array_to_vector("__f")))
    model = ToxicityModel(lexicons, trees, None, share)
    held = model.margin(rows.filter("fold = 4" if any(f == 4 for f, _ in totals) else "true"))
    model.calibration = IsotonicRegression(featuresCol="__margin", labelCol="label", predictionCol="__p").fit(held)
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with all its columns and ``__score`` (0 to 1)."""
    return fit(docs, labels).score(docs)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, load(spark, sf_dir, "labels"))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
                         F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
