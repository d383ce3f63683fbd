"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features are densities of a written and a learned lexicon, nearness of lexicon words to the second person, and rates of capitals,
punctuation and obfuscated spellings. Labelled training rows fall by hash into three folds: one gives the learned lexicon (words
and word beginnings that go with the label), one fits the trees and one fits the calibration, so no step is judged on its own rows.

Training reads at most ``max_labelled`` labelled rows (an even share by hash of all of them); every document is scored.

Defined cases: a null text counts as empty and is scored; null labels and labels of unknown documents are left out; of repeated
labels of a document the largest counts; repeated documents score alike; without both classes among the training rows every score
is the share of toxic ones; without rows to calibrate on the trees' own probability is the score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import many_rows, materialise, per_row

# Insults, and second-person words, of the four languages.
INSULTS = """
idiot idiots moron morons stupid dumb fool fools loser losers clown clowns trash garbage scum filth vermin worthless pathetic disgusting
imbecile cretin jerk bastard bitch asshole shit shitty fuck fucking fucker damn dickhead dumbass retard freak creep pig pigs rat rats slut
whore coward liar liars ugly useless hate hateful disgrace despicable vile
idiotin trottel depp arschloch dumm blöd blödmann vollidiot versager abschaum dreck drecksack wertlos erbärmlich widerlich schwein scheiße
idiote imbécile crétin connard connasse salaud salope ordure débile abruti minable dégoûtant nul merde stupide
idiota imbécil estúpido estúpida tonto tonta basura escoria inútil asqueroso asquerosa patético patética mierda cabrón gilipollas
""".split()
SECOND_PERSON = "you your yours yourself u ur ya du dich dir dein deine deiner euch euer ihr sie tu te toi ton ta tes vous votre vos tú ti tu tus usted ustedes vosotros".split()

#: letters that digits and signs stand for
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
WORD = re.compile(r"[^\W\d_]+")
ODD = re.compile(r"[^\W\d_]+[0-9@$!|*+._-]+[^\W\d_][\w@$!|*+.-]*")


@dataclass(frozen=True)
class Settings:
    max_labelled: int = 60_000
    #: percent of the training rows for the lexicon and, of the rest, for the trees; what is left calibrates
    lexicon_percent: int = 40
    trees_percent: int = 40
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8)
    min_toxic: int = 3
    min_odds: float = 1.5
    lexicon: int = 2000
    trees: int = 20
    depth: int = 4
    step: float = 0.25
    threshold: float = 0.3
    near: int = 5


FEATURES = ("log_words", "insults", "insult_density", "learned", "learned_density", "weight_density", "max_weight", "distinct", "strong", "strong_density", "second_person", "near_second_person", "capitals", "shouted", "punctuation", "marks", "obfuscated", "obfuscated_hits", "repeats")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def entries(word: str, settings: Settings) -> list[str]:
    """What the learned lexicon may hold of a word: itself and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in settings.beginnings if n < len(word))]


class Featurer:
    def __init__(self, learned: dict[str, float], settings: Settings):
        self.learned, self.settings = learned, settings
        self.insults, self.second = frozenset(INSULTS), frozenset(SECOND_PERSON)
        self.weights: dict[str, float] = {}

    def weight(self, word: str) -> float:
        got = self.weights.get(word)
        if got is None:
            if len(self.weights) > 200_000:
                self.weights.clear()
            got = self.weights[word] = max((self.learned.get(e, 0.0) for e in entries(word, self.settings)), default=0.0)
        return got

    def __call__(self, raw: bytes | None) -> list[float]:
        text = (raw or b"").decode("utf-8", "replace")
        words = words_of(text)
        n = max(1, len(words))
        times = Counter(words)
        weights = {w: x for w in times if (x := self.weight(w)) > 0}
        insults = times.keys() & self.insults
        strong = [w for w, x in weights.items() if x >= 3.0]
        n_insults, n_learned, n_strong = (sum(times[w] for w in s) for s in (insults, weights, strong))
        second = times.keys() & self.second
        n_second = sum(times[w] for w in second)
        near = 0
        if second and (hot := insults.union(strong)):
            you = [i for i, w in enumerate(words) if w in second]
            at, last = 0, len(you)
            for i, w in enumerate(words):
                if w in hot:
                    while at < last and you[at] < i - self.settings.near:
                        at += 1
                    near += at < last and you[at] <= i + self.settings.near
        chars = max(1, len(text))
        upper = sum(map(str.isupper, text)) if not text.islower() else 0
        odd = ODD.findall(text)
        spelled = sum(1 for w in odd if (p := "".join(WORD.findall(w.lower().translate(LEET)))) in self.insults or self.weight(p) >= 3.0)
        return [
            math.log1p(len(words)), n_insults, n_insults / n, n_learned, n_learned / n, sum(times[w] * x for w, x in weights.items()) / n, max(weights.values(), default=0.0),
            len(weights), n_strong, n_strong / n, n_second / n, near, upper / chars, float(upper > 0.5 * chars), (text.count("!") + text.count("?")) / chars,
            sum(text.count(c) for c in "*#$%&@") / chars, len(odd) / n, spelled, max(times.values(), default=0) / n,
        ]


def labelled(labels: DataFrame, train, settings: Settings) -> DataFrame:
    """(key, toxic, fold) of at most max_labelled training rows; train is a condition on doc_id."""
    all_rows = materialise(labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(train).groupBy(F.col("doc_id").alias("key")).agg(F.max("toxic").cast("double").alias("toxic")), "toxicity-labels")
    n = all_rows.count()
    draw = F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # two percent below the bound, so that the draw stays under it
    share = min(1.0, 0.98 * settings.max_labelled / n) if n > settings.max_labelled else 1.0
    fold = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(100))
    fold = F.when(fold < settings.lexicon_percent, 0).when(fold < settings.lexicon_percent + settings.trees_percent, 1).otherwise(2)
    return all_rows.where(draw < share).withColumn("fold", fold)


def learn_lexicon(docs: DataFrame, rows: DataFrame, settings: Settings) -> dict[str, float]:
    """Log odds of words and beginnings that go with toxic, over the lexicon fold."""
    fold = rows.where("fold = 0")
    totals = fold.agg(F.coalesce(F.sum("toxic"), F.lit(0.0)), F.count("*")).first()
    toxic, clean = totals[0], totals[1] - totals[0]
    if not toxic or not clean:
        return {}
    # at most max_labelled small rows
    held = docs.join(F.broadcast(fold), docs.doc_id == fold.key).select(F.col("text").cast("binary").alias("text"), "toxic")

    def make():
        def run(it):
            counts: dict[str, list[int]] = {}
            for text, is_toxic in it:
                side = int(is_toxic)
                seen = {e for w in set(words_of((text or b"").decode("utf-8", "replace"))) for e in entries(w, settings)}
                for e in seen:
                    counts.setdefault(e, [0, 0])[side] += 1
                if len(counts) > 300_000:
                    yield from ((e, c, t) for e, (c, t) in counts.items())
                    counts = {}
            yield from ((e, c, t) for e, (c, t) in counts.items())

        return run

    counted = many_rows(held, make, "entry string, clean long, toxic long").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.25) / F.lit(toxic + 0.5)) - F.log((F.col("clean") + 0.25) / F.lit(clean + 0.5))
    # chance finds: an entry needs more toxic documents than its share of all would give, by three deviations
    expected = (F.col("toxic") + F.col("clean")) * F.lit(toxic / (toxic + clean))
    best = counted.where(F.col("toxic") >= settings.min_toxic).withColumn("odds", odds).where(F.col("odds") >= settings.min_odds).where(F.col("toxic") - expected >= 3 * F.sqrt(expected))
    top = best.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry").limit(settings.lexicon)
    return {r.entry: r.odds for r in top.collect()}


def score(docs: DataFrame, labels: DataFrame, held_out, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of docs; held_out is a condition on doc_id."""
    rows = materialise(labelled(labels, ~held_out, settings), "toxicity-rows")
    lexicon = docs.sparkSession.sparkContext.broadcast(learn_lexicon(docs, rows, settings))

    def make():
        f = Featurer(lexicon.value, settings)
        return lambda key, text: (key, f(text))

    schema = T.StructType([docs.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    made = materialise(per_row(docs.select("doc_id", F.col("text").cast("binary")), make, schema), "toxicity-features")
    ready = made.select("doc_id", held_out.alias("held_out"), array_to_vector("x").alias("features"))
    known = made.join(F.broadcast(rows), made.doc_id == rows.key)
    train = materialise(known.select("x", "toxic", "fold"), "toxicity-train").coalesce(8).withColumn("features", array_to_vector("x"))
    counts = {r.toxic: r.n for r in train.where("fold = 1").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    final = lambda s: ready.withColumn("score", s).select("doc_id", "held_out", "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"))
    if len(counts) < 2:
        return final(F.lit(float(sum(k * v for k, v in counts.items()) / max(1, sum(counts.values())))))
    trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.step, minInstancesPerNode=3, seed=1, checkpointInterval=-1)
    model = trees.fit(train.where("fold = 1").select("features", "toxic"))
    raw = lambda df: model.transform(df).withColumn("raw", vector_to_array("probability")[1])
    if train.where("fold = 2").isEmpty():
        ready = raw(ready)
        return final(F.col("raw"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="toxic").fit(raw(train.where("fold = 2")).select("raw", "toxic"))
    ready = curve.setPredictionCol("calibrated").transform(raw(ready).select("doc_id", "held_out", "raw"))
    return final(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated"))))
