"""Quality rules by line labelling: a linear-chain CRF marks lines as content or boilerplate.

Each line of a text gets a small feature vector; the CRF scores label sequences by
line weights and transition weights, Viterbi decoding finds the best one, and the share of
words in content lines decides whether the document stays.  Before that, two fixed rules
apply (too few words, too many repeated ones).

The weights are fitted on a bounded sample (``TRAIN_DOCS`` labelled documents of either
quality, chosen by a hash of the id); scoring reads every text as a whole.

Defined cases: null text = empty text, which has no words and fails the rules; texts with
one endless line or very many lines are decoded as a whole; rows are independent, so repeated
rows, null ids and ties change nothing; an empty table gives no rows; when the sample lacks
one of the two qualities there is nothing to learn and every text that passes the rules stays.
Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

#: Labelled documents of each quality that the weights are fitted on, at most.
TRAIN_DOCS = 2000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Content lines must hold this share of the words.
MIN_CONTENT = 0.5

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?#*$%&|<>{}[]()=+~^_\\/@")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_END = np.zeros(256, bool)
_END[list(b".!?\"')")] = True

BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("bias", "few_words", "log_words", "marks", "capitals", "digits", "repeated_words", "repeated_line",
            "long_words", "no_end", "first_line", "last_line")


def measure(block: tokens.Block) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts of each text; features (lines x features), words and first line of each text for its lines with a word."""
    data = block.data
    starts, ends, first = block.words()
    word_hash = tokens.hashes(data, starts, ends)
    n_words = np.diff(first)
    inside = ~tokens.SEPARATOR[data]
    heads = inside & ((data & 0xC0) != 0x80)  # first bytes of code points
    counts = {
        "n_words": n_words,
        "word_chars": tokens.per_text(heads, block.offsets),
        "n_symbols": tokens.per_text(_SYMBOLS[data], block.offsets),
    }
    owner = np.repeat(np.arange(block.n), n_words)
    gram, place = tokens.ngrams(word_hash, first, 3)
    own = tokens.mix(gram ^ tokens.mix(owner[place].astype(np.uint64)))
    _, back, seen = np.unique(own, return_inverse=True, return_counts=True)
    twice = place[seen[back] > 1]
    repeated = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        repeated[twice + k] = True
    repeated = repeated[:len(starts)]
    counts["n_repeat_words"] = tokens.per_text(repeated, first)

    ls, le, _ = block.lines()
    lo = np.searchsorted(starts, ls)
    words = np.searchsorted(starts, le) - lo
    full = words > 0
    ls, le, lo, words = ls[full], le[full], lo[full], words[full]
    line_owner = np.searchsorted(block.offsets, ls, "right") - 1
    line_first = np.searchsorted(line_owner, np.arange(block.n + 1))
    key = tokens.mix(tokens.hashes(data, ls, le) ^ tokens.mix(line_owner.astype(np.uint64)))
    _, first_at, back = np.unique(key, return_index=True, return_inverse=True)
    again = first_at[back] != np.arange(len(key))
    counts["n_dup_lines"] = tokens.per_text(again, line_first)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[le] - total[ls]) / np.maximum(of, 1)

    size = share(inside, np.ones(len(ls)))
    letters = share(_LETTER[data], np.ones(len(ls)))
    rep = np.concatenate([[0], np.cumsum(repeated, dtype=np.int64)])
    last_byte = data[ends[lo + words - 1] - 1] if len(ls) else np.zeros(0, np.uint8)
    is_first = np.zeros(len(ls), bool)
    is_last = np.zeros(len(ls), bool)
    some = line_first[:-1] < line_first[1:]
    is_first[line_first[:-1][some]] = True
    is_last[line_first[1:][some] - 1] = True
    x = np.stack([
        np.ones(len(ls)), words < 5, np.log1p(words) / 5, share(_MARKS[data], size) * 4, share(_UPPER[data], letters) * 2,
        share(_DIGIT[data], size) * 2, (rep[lo + words] - rep[lo]) / np.maximum(words, 1), again,
        np.minimum(size / np.maximum(words, 1) / 10, 3), ~_END[last_byte], is_first, is_last,
    ], axis=1).astype(np.float64) if len(ls) else np.zeros((0, len(FEATURES)))
    return counts, x, words, line_first


class Chain:
    """Sequences of all texts of a block, step by step: text i has rows first[i]:first[i + 1]."""

    def __init__(self, first: np.ndarray):
        self.length = np.diff(first)
        self.order = np.argsort(-self.length, kind="stable")
        self.start = first[:-1][self.order]
        self.longest = int(self.length.max(initial=0))
        self.active = np.searchsorted(np.sort(-self.length), -np.arange(self.longest), "left")

    def rows(self, t: int) -> np.ndarray:
        """Row t of each text that has one, the longest texts first."""
        return self.start[:self.active[t]] + t


def viterbi(scores: np.ndarray, change: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best label (0 content, 1 boilerplate) of each row; ties go to content."""
    chain = Chain(first)
    best = scores.copy()
    back = np.zeros(scores.shape, np.int8)
    for t in range(1, chain.longest):
        now = chain.rows(t)
        through = best[now - 1][:, :, None] + change[None]
        back[now] = through.argmax(axis=1)
        best[now] += through.max(axis=1)
    labels = np.zeros(len(scores), np.int8)
    for t in range(chain.longest - 1, -1, -1):
        now = chain.rows(t)
        final = chain.active[t + 1] if t + 1 < chain.longest else 0
        labels[now[final:]] = best[now[final:]].argmax(axis=1)
        labels[now[:final]] = back[now[:final] + 1, labels[now[:final] + 1]]
    return labels


def fit(x: np.ndarray, y: np.ndarray, first: np.ndarray, steps: int = 150, rate: float = 0.1,
        ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Line weights (features x 2) and transitions (2 x 2) by gradient steps on the penalised mean log-likelihood."""
    chain = Chain(first)
    theta = [np.zeros((x.shape[1], 2)), np.zeros((2, 2))]
    m = [np.zeros_like(p) for p in theta]
    v = [np.zeros_like(p) for p in theta]
    onehot = np.eye(2)[y]
    inner = np.ones(len(x), bool)
    inner[first[:-1][chain.length > 0] if len(chain.length) else []] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1], y[at]), 1)
    n = max(1, len(x))
    log_sum = lambda a, axis: (top := a.max(axis=axis)) + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))
    for step in range(1, steps + 1):
        scores = x @ theta[0]
        alpha, beta = scores.copy(), np.zeros_like(scores)
        for t in range(1, chain.longest):
            now = chain.rows(t)
            alpha[now] += log_sum(alpha[now - 1][:, :, None] + theta[1][None], 1)
        for t in range(chain.longest - 1, 0, -1):
            now = chain.rows(t)
            beta[now - 1] = log_sum(theta[1][None] + (scores[now] + beta[now])[:, None, :], 2)
        z = log_sum(alpha + beta, 1)
        marginal = np.exp(alpha + beta - z[:, None])
        pair = np.exp(alpha[at - 1][:, :, None] + theta[1][None] + (scores[at] + beta[at])[:, None, :] - z[at][:, None, None])
        grads = [x.T @ (onehot - marginal) / n - ridge * theta[0], (seen - pair.sum(axis=0)) / n - ridge * theta[1]]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            theta[i] = theta[i] + rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return theta[0], theta[1]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "quality", per_class: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray] | None:
    """CRF weights from at most ``per_class`` labelled documents of each quality; a line takes its document's label."""
    chosen = None
    for quality in (0, 1):
        some = (labels.filter((F.col(label_col) == quality) & F.col(label_id).isNotNull())
                .select(F.col(label_id).alias("id"), F.lit(quality).alias("good"))
                .orderBy(F.xxhash64("id"), "id").limit(per_class))
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 * per_class ids, so the table can go to every task
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .join(F.broadcast(chosen.dropDuplicates(["id"])), "id"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in tokens.blocks(batches, "text"):
            _, x, _, first = measure(block)
            yield pa.RecordBatch.from_pydict({
                "id": rows.column("id"), "good": rows.column("good"),
                "x": [x[a:b].ravel().tolist() for a, b in zip(first[:-1], first[1:], strict=True)]},
                schema=pa.schema([("id", pa.int64()), ("good", pa.int32()), ("x", pa.list_(pa.float64()))]))

    got = (sample.select(F.col("id").cast("long").alias("id"), "good", "text").mapInArrow(lines, "id long, good int, x array<double>")
           .toPandas().sort_values("id", kind="stable"))
    if got["good"].nunique() < 2:
        return None
    xs = [np.asarray(v, float).reshape(-1, len(FEATURES)) for v in got["x"]]
    sizes = np.array([len(v) for v in xs])
    y = np.repeat(1 - got["good"].to_numpy(), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    if len(np.unique(y)) < 2:
        return None
    return fit(np.concatenate(xs), y, first)


def verdict(block: tokens.Block, weights: tuple[np.ndarray, np.ndarray] | None, min_content: float):
    """Base counts, first line of each text, whether a line is content, base_failed, content_share and kept."""
    counts, x, words, first = measure(block)
    bad = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
    content = np.ones(len(x), bool) if weights is None else viterbi(x @ weights[0], weights[1], first) == 0
    share = tokens.per_text(words * content, first) / np.maximum(counts["n_words"], 1)
    return counts, first, content, bad, share, ~bad & (share >= min_content)


def assess(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray] | None, id_col: str = "doc_id", text_col: str = "text",
           min_content: float = MIN_CONTENT) -> DataFrame:
    """(id, base counts, base_failed, n_lines, n_content_lines, content_share, kept), one row per document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in tokens.blocks(batches, "text"):
            counts, first, content, bad, share, kept = verdict(block, weights, min_content)
            out = {"id": batch.column("id")} | {k: counts[k].astype(np.int64) for k in BASE_COUNTS} | {
                "base_failed": bad, "n_lines": np.diff(first).astype(np.int64),
                "n_content_lines": tokens.per_text(content, first).astype(np.int64), "content_share": share, "kept": kept}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in out.items()})

    schema = ("id long, " + ", ".join(f"{c} long" for c in BASE_COUNTS)
              + ", base_failed boolean, n_lines long, n_content_lines long, content_share double, kept boolean")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(score, schema)


def keep_good(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray] | None, text_col: str = "text",
              min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they were."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in tokens.blocks(batches, text_col):
            yield batch.filter(pa.array(verdict(block, weights, min_content)[-1]))

    return docs.mapInArrow(keep, docs.schema)
