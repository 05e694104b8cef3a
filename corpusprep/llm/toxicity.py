"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a whole text: density, number and strength of lexicon words, how many of them
stand near a second-person word, shares of capitals, exclamation marks and other punctuation,
and the share of obfuscated words (letters mixed with marks or digits).  Words are compared
after folding case, undoing digit-for-letter writing and dropping marks inside them.

The lexicon (words and word beginnings, as sorted hashes with weights) and the trees are
fitted on a bounded sample of labelled rows (``TRAIN_TOXIC`` and ``TRAIN_CLEAN``, chosen by a
hash of the id).  The sample has three parts: the lexicon of part A measures part B and the
other way round, the trees learn from both, and part C calibrates them.  Different texts of a class are
dealt to the parts in turn; where a class has fewer than three, all rows serve lexicon and trees, uncalibrated.

Defined cases: null and empty texts have all-zero features and get the score of such a text;
rows are scored one by one, so repeats, ties and null ids change nothing; an empty table gives
no rows; only where the learning labels lack one of the classes is every score 0; of repeated ids
one text is learned from (the smallest).  Labels that are null or
without a document are not used.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import stage

TRAIN_TOXIC, TRAIN_CLEAN = 6000, 12000
#: A word's beginnings count as entries too: so many letters' bytes.
BEGINNINGS = (3, 4, 5, 6)
NEAR = 5

FEATURES = ("hits", "hit_density", "strongest", "strength", "strength_density", "near_second_person", "capitals", "capital_words",
            "exclamations", "punctuation", "obfuscated", "log_words")

#: Second-person words of the languages at hand.
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer eure sie "
                 "tu te toi ton ta tes vous votre vos tú ti tus contigo usted ustedes vosotros os vuestro vuestra").split()

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
for _a, _b in zip(b"0134578@$", b"oieastbas", strict=True):  # digits and signs written for letters
    _FOLD[_a] = _b
_KEEP = np.zeros(256, bool)
_KEEP[97:123] = True
_KEEP[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _folded(block: tokens.Block):
    """Words in folded form: raw bounds, first word of each text, folded bytes and the words' bounds in them."""
    starts, ends, first = block.words()
    data = block.data
    folded = _FOLD[data]
    # À-Þ to à-þ in UTF-8
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[accented] += 32
    keep = _KEEP[folded]
    at = np.concatenate([[0], np.cumsum(keep)])
    return starts, ends, first, folded[keep], at[starts], at[ends]


def _entries(text: np.ndarray, ws: np.ndarray, we: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of all words, then of their beginnings of each length (0 where a word is not longer)."""
    yield np.where(we > ws, tokens.hashes(text, ws, we), np.uint64(0))
    for k in BEGINNINGS:
        longer = we - ws > k
        out = np.zeros(len(ws), np.uint64)
        out[longer] = tokens.mix(tokens.hashes(text, ws[longer], ws[longer] + k) + np.uint64(k))
        yield out


def _word_hash(word: str) -> int:
    _, _, _, text, ws, we = _folded(tokens.Block(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())])))
    return int(tokens.hashes(text, ws, we)[0])


def measure(block: tokens.Block, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Features of each text.  ``lexicon``: sorted hashes and their weights."""
    starts, ends, first, text, ws, we = _folded(block)
    data = block.data
    keys, weights = lexicon
    n_words = np.diff(first)
    weight = np.zeros(len(ws))
    second = np.zeros(len(ws), bool)
    person = np.sort(np.array([_word_hash(w) for w in SECOND_PERSON], np.uint64))
    for i, h in enumerate(_entries(text, ws, we)):
        if i == 0:
            second = person[np.minimum(np.searchsorted(person, h), len(person) - 1)] == h
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            weight = np.maximum(weight, np.where((keys[at] == h) & (h != 0), weights[at], 0.0))
    hit = weight > 0
    owner = np.repeat(np.arange(block.n), n_words)
    # second-person words within NEAR words on either side, in the same text
    seen = np.concatenate([[0], np.cumsum(second)])
    place = np.flatnonzero(hit)
    low = np.maximum(place - NEAR, first[owner[place]])
    high = np.minimum(place + NEAR + 1, first[owner[place] + 1])
    near = np.bincount(owner[place], weights=seen[high] > seen[low], minlength=block.n)
    strongest = np.zeros(block.n)
    np.maximum.at(strongest, owner[place], weight[place])

    def count(mask):
        return tokens.per_text(mask, block.offsets)

    def per_word(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends] - total[starts]

    letters, capitals, inside = count(_LETTER[data]), count(_UPPER[data]), count(~tokens.SEPARATOR[data])
    word_letters, word_bytes = per_word(_LETTER[data]), ends - starts
    shouted = (per_word(_UPPER[data]) == word_bytes) & (word_bytes > 1)
    # marks or digits between the first and the last byte of a word that has letters
    rim = (~_LETTER[data[starts]]).astype(int) + (~_LETTER[data[ends - 1]]).astype(int) if len(starts) else np.zeros(0, int)
    obfuscated = (word_letters >= 2) & (word_bytes - word_letters - rim > 0)
    hits = tokens.per_text(hit, first)
    strength = tokens.per_text(weight, first)
    words = np.maximum(n_words, 1)
    return np.stack([
        hits, hits / words, strongest, strength, strength / words, near / np.maximum(hits, 1), capitals / np.maximum(letters, 1),
        tokens.per_text(shouted, first) / words, count(data == 33) / np.maximum(inside, 1), count(_PUNCT[data]) / np.maximum(inside, 1),
        tokens.per_text(obfuscated, first) / words, np.log1p(n_words),
    ], axis=1).astype(np.float64)


def _features(rows: DataFrame, lexicons: dict[int, tuple[np.ndarray, np.ndarray]], carried: list[str]) -> DataFrame:
    """Adds ``x`` to the ``carried`` columns; a row's ``part`` (if carried) names its lexicon, else it is lexicon -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in tokens.blocks(batches, "text"):
            out = {c: batch.column(c) for c in carried}
            part = np.asarray(out["part"]) if "part" in out else np.full(block.n, -1)
            x = np.zeros((block.n, len(FEATURES)))
            for p in np.unique(part):
                x[part == p] = measure(block, lexicons[int(p)])[part == p]
            out["x"] = pa.ListArray.from_arrays(pa.array(np.arange(block.n + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_pydict(out)

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in carried] + ["x array<double>"])
    return rows.select(*carried, "text").mapInArrow(run, schema)


def _lexicons(sample: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Lexicons by the part they are used on: 0 and 1 get the other's, 2 and -1 that of both."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in tokens.blocks(batches, "text"):
            _, _, first, text, ws, we = _folded(block)
            owner = np.repeat(np.arange(block.n), np.diff(first))
            group = np.asarray(batch.column("part")) * 2 + np.asarray(batch.column("toxic"))
            found = []
            for h in _entries(text, ws, we):
                pair = np.unique(np.stack([h[h != 0], owner[h != 0].astype(np.uint64)]), axis=1)  # once a document
                found.append(np.stack([pair[0], group[pair[1].astype(np.int64)].astype(np.uint64)]))
            kinds, n = np.unique(np.concatenate(found, axis=1), axis=1, return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": kinds[0].view(np.int64), "g": kinds[1].astype(np.int32), "n": n.astype(np.int64)})

    in_group = lambda g: F.coalesce(F.sum(F.when(F.col("g") == g, F.col("n"))), F.lit(0))
    counts = (sample.filter(F.col("part") < 2).select("part", "toxic", "text").mapInArrow(entries, "h long, g int, n long")
              .groupBy("h").agg(*[in_group(g).alias(f"n{g}") for g in range(4)]))
    sizes = {(r["part"], r["toxic"]): r["n"] for r in sample.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = stage(counts.filter(F.col("n1") + F.col("n3") >= 2), "toxic_entries")
    out = {}
    for used_on, parts in ((0, (1,)), (1, (0,)), (2, (0, 1))):
        bad = sum(F.col(f"n{2 * p + 1}") for p in parts).cast("double") if len(parts) == 2 else F.col(f"n{2 * parts[0] + 1}").cast("double")
        good = F.col("n0") + F.col("n2") if len(parts) == 2 else F.col(f"n{2 * parts[0]}")
        n_bad = sum(sizes.get((p, 1), 0) for p in parts)
        n_good = sum(sizes.get((p, 0), 0) for p in parts)
        odds = F.log((bad + 0.5) / F.lit(n_bad + 1.0)) - F.log((good + 0.5) / F.lit(n_good + 1.0))
        sure = odds / F.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
        # words of the bounded sample only
        top = counts.filter(bad >= 2).select("h", odds.alias("w"), sure.alias("z")).filter("w >= 1 and z >= 3").toPandas()
        keys = top["h"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        out[used_on] = keys[order], top["w"].to_numpy(float)[order]
    out[-1] = out[2]
    return out


class Model:
    """A lexicon, trees and the calibration (``None``: the raw probability); ``None`` trees stand for no model."""

    def __init__(self, lexicon, trees: GBTClassificationModel | None, calibration):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, score, predicted, features): score in 0..1, higher is more toxic."""
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        if self.trees is None:
            return rows.select("id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                               F.lit(None).cast("array<double>").alias("features"))
        scored = _with_probability(self.trees, _features(rows, {-1: self.lexicon}, ["id"]))
        if self.calibration is None:
            return scored.select("id", F.col("p").alias("score"), (F.col("p") >= 0.5).cast("int").alias("predicted"), F.col("x").alias("features"))
        scored = self.calibration.transform(scored)
        # the calibration is a step function; a hundredth of the raw probability orders rows on a step
        return (scored.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.99 * F.col("calibrated") + 0.01 * F.col("p"))))
                .select("id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("x").alias("features")))


def _with_probability(trees: GBTClassificationModel, frame: DataFrame) -> DataFrame:
    vectors = frame.withColumn("features", array_to_vector("x"))
    return trees.transform(vectors).withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic", n_toxic: int = TRAIN_TOXIC, n_clean: int = TRAIN_CLEAN,
          trees: int = 20, depth: int = 3) -> Model:
    """Fits a model on labelled rows for whose id (column ``id``) ``learn`` is true."""
    usable = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & learn)
    some = lambda k, n: usable.filter(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(n)
    # a table of n_toxic + n_clean ids at most
    chosen = some(1, n_toxic).unionByName(some(0, n_clean)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = stage(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
        .groupBy("id", "toxic").agg(F.min("text").alias("text"))
        .withColumn("name", F.xxhash64("text")), "toxic_texts")
    # the sample's size bounds both windows: a row for each different text of a class
    turn = Window.partitionBy("toxic").orderBy(F.xxhash64(F.lit("part"), "name"), "name")
    parts = texts.select("toxic", "name").distinct().withColumn("part", (F.row_number().over(turn) - 1) % 3)
    sample = stage(texts.join(F.broadcast(parts), ["toxic", "name"]).drop("name"), "toxic_sample")
    found = {(r["part"], r["toxic"]) for r in sample.select("part", "toxic").distinct().collect()}
    if {toxic for _, toxic in found} != {0, 1}:
        return Model((np.zeros(0, np.uint64), np.zeros(0)), None, None)
    calibrated = len(found) == 6
    if not calibrated:  # too few texts to hold any back
        sample = sample.withColumn("part", F.lit(0))
    lexicons = _lexicons(sample)
    if not calibrated:
        lexicons[0] = lexicons[2]
    measured = stage(_features(sample.withColumn("label", F.col("toxic").cast("double")), lexicons, ["id", "part", "label"]), "toxic_features")
    learn_rows = measured.filter("part < 2").withColumn("features", array_to_vector("x"))
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=5, minInstancesPerNode=5, cacheNodeIds=False).fit(
        learn_rows.select("features", "label"))
    if not calibrated:
        return Model(lexicons[2], fitted, None)
    held = _with_probability(fitted, measured.filter("part = 2"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="calibrated").fit(held.select("p", "label"))
    return Model(lexicons[2], fitted, calibration)
