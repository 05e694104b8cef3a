"""Language identification by interpolated Kneser-Ney character models.

One model per language, over letters (lower case) with every run of other characters as
one border.  Texts are cut into n-grams of ``ORDER`` characters; the highest order uses
counts, the lower ones the number of different characters before them, and each order is
interpolated with the next by absolute discounting.  A model is a set of sorted hash arrays:
n-grams with their log probability and contexts with the log weight that goes to the next
lower order.  The language with the lowest cross-entropy per character wins.

All rows of the learning fold are counted, and every n-gram is stored.  Counts, continuation
counts, counts of counts, discounts, context totals and probabilities are Spark aggregates and
joins; the model lies in the shared folder, from where each Python worker reads it once.  A
worker's memory therefore grows with the number of different n-grams (16 bytes for each n-gram
and context), the driver's with the number of languages only.

Rejection is calibrated per language: over all learning rows the cross-entropy that all but ``REJECT`` of a
language's own texts stay under is its limit; a text above the limit of its best language is marked as rejected.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows with a null
language are not learned from; equal cross-entropies go to the first language in order; without any
learned language every text is ``und``; an empty table gives no rows; very long texts are read whole, in
blocks.  Only id, text and (for learning) language are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from ..session import scratch_path
from .common import stage, write_back

ORDER = 4
ALPHABET = 1 << 17
REJECT = 0.005
UNDETERMINED = "und"

_SALT = np.uint64(0xA0761D6478BD642F)
_tables: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0; built once per process from Unicode categories."""
    if not _tables:
        table = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha() or unicodedata.category(ch)[0] == "M":
                low = ch.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _tables.append(table)
    return _tables[0]


def characters(block: tokens.Block) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, borders as 0 (one for each run, one before and one after a text), and each text's first place."""
    data = block.data
    heads = (data & 0xC0) != 0x80
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum(heads)])[block.offsets]  # each text's first code point
    letters = _letter_table()[np.minimum(points, 0x10FFFF)]
    # a border in front of every text and after the last
    spread = np.insert(letters, at, 0)
    first = at + np.arange(block.n + 1)
    keep = np.ones(len(spread), bool)
    keep[1:] = (spread[1:] != 0) | (spread[:-1] != 0)
    keep[first] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return spread[keep], kept[first]


def grams(letters: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n letters that end at each place (places before the n-th wrap round and are not used)."""
    out = np.full(len(letters), n, np.uint64)
    for k in range(n - 1, -1, -1):
        out = tokens.mix(out * _SALT + np.roll(letters, k).astype(np.uint64) + np.uint64(1))
    return out


def _gram_of(columns: list[np.ndarray]) -> np.ndarray:
    """The hash that ``grams`` gives to these letters, first letter first."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        out = tokens.mix(out * _SALT + c.astype(np.uint64) + np.uint64(1))
    return out


def _padded(letters: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """With ORDER - 2 more borders in front of each text, so that every letter has a full context; a text's range of places to score."""
    extra = ORDER - 2
    wide = np.insert(letters, np.repeat(first[:-1], extra), 0)
    begin = first[:-1] + extra * np.arange(1, len(first))
    end = first[1:] + extra * np.arange(1, len(first))
    return wide, begin, end


def _places(wide: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place to predict (all but a text's first border; its last letter is followed by a border that counts) and its text."""
    owner = np.full(len(wide), -1)
    size = end - begin
    at = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    owner[at] = np.repeat(np.arange(len(begin)), size)
    owner[begin[size > 0]] = -1
    place = np.flatnonzero(owner >= 0)
    return place, owner[place]


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, c1..cORDER, n): how often each n-gram of the highest order occurs in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in tokens.blocks(batches, "text"):
            langs = batch.column("lang").to_pylist()
            letters, first = characters(block)
            wide, begin, end = _padded(letters, first)
            place, owner = _places(wide, begin, end)
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])[owner]
            h = tokens.mix(grams(wide, ORDER)[place] ^ tokens.mix(code.astype(np.uint64)))
            _, at, n = np.unique(h, return_index=True, return_counts=True)
            out = {"lang": [names[c] for c in code[at]], "n": n.astype(np.int64)}
            out |= {f"c{k + 1}": wide[place[at] - (ORDER - 1 - k)].astype(np.int32) for k in range(ORDER)}
            yield pa.RecordBatch.from_pydict({"lang": pa.array(out["lang"], pa.string())} | {k: v for k, v in out.items() if k != "lang"})

    cols = [f"c{k + 1}" for k in range(ORDER)]
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counted = rows.mapInArrow(run, "lang string, n long, " + ", ".join(f"{c} int" for c in cols))
    return counted.groupBy("lang", *cols).agg(F.sum("n").alias("n"))


_Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_read: dict[str, list[list[_Table]]] = {}


class Models:
    """Per language and order: sorted n-gram hashes with log probabilities, sorted context hashes with log weights.

    Pickled without its tables: each process reads them once from the shared folder.
    """

    def __init__(self, languages: list[str], path: str | None, floor: float):
        self.languages, self.path, self.floor = languages, path, floor

    @property
    def tables(self) -> list[list[_Table]]:
        if self.path not in _read:
            _read.clear()  # a process holds one model at a time
            _read[self.path] = _read_tables(self.path, len(self.languages))
        return _read[self.path]

    def log_prob(self, lang: int, columns: list[np.ndarray]) -> np.ndarray:
        """log P(last column | the columns before it)."""
        out = np.zeros(len(columns[0]))
        todo = np.arange(len(columns[0]))
        for order in range(ORDER, 0, -1):
            if not len(todo):
                break
            keys, logs, contexts, weights = self.tables[lang][order - 1]
            cols = [c[todo] for c in columns[ORDER - order:]]
            at, found = _look_up(keys, _gram_of(cols))
            out[todo[found]] += logs[at[found]]
            todo, cols = todo[~found], [c[~found] for c in cols]
            if order > 1:  # unseen: what the context leaves to the next lower order; an unseen context leaves all
                at, found = _look_up(contexts, _gram_of(cols[:-1]))
                out[todo[found]] += weights[at[found]]
            else:
                out[todo] += self.floor
        return out


def _look_up(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


def _read_tables(path: str, n_languages: int) -> list[list[_Table]]:
    """The tables that ``_write_tables`` wrote."""
    scheme, _, rest = path.partition(":/")  # Hadoop writes file:/x for file:///x
    files, root = pyarrow.fs.FileSystem.from_uri(path if rest[:1] == "/" or not rest else f"{scheme}:///{rest}")
    got = pyarrow.dataset.dataset(root, filesystem=files, format="parquet").to_table()
    part, key, value = (got.column(c).to_numpy() for c in ("part", "key", "value"))
    key = key.view(np.uint64)
    order = np.lexsort((key, part))
    part, key, value = part[order], key[order], value[order]
    at = np.searchsorted(part, np.arange(n_languages * ORDER * 2 + 1))
    pieces = [(key[a:b], value[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return [[pieces[k] + pieces[k + 1] for k in range(i * ORDER * 2, (i + 1) * ORDER * 2, 2)] for i in range(n_languages)]


def _write_tables(entries: DataFrame, languages: list[str]) -> str:
    """Hashes the letters of all entries and writes (part, key, value); a part is a language's n-grams or contexts of one order."""
    cols = [f"c{k + 1}" for k in range(ORDER)]
    names = pa.array(languages, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = pc.index_in(batch.column("lang"), names).to_numpy(zero_copy_only=False)
            order, context = (batch.column(c).to_numpy() for c in ("order", "context"))
            letters = [batch.column(c).to_numpy() for c in cols]
            key = np.zeros(len(code), np.uint64)
            for n in range(1, ORDER + 1):
                mine = np.flatnonzero(order == n)
                for which, used in ((mine[context[mine] == 0], letters[ORDER - n:]), (mine[context[mine] == 1], letters[ORDER - n:-1])):
                    if len(which):
                        key[which] = _gram_of([c[which] for c in used])
            part = (code * ORDER + order - 1) * 2 + context
            yield pa.RecordBatch.from_pydict({"part": part.astype(np.int32), "key": key.view(np.int64), "value": batch.column("value")})

    path = scratch_path(entries.sparkSession, "lang_model")
    entries.mapInArrow(run, "part int, key long, value double").write.parquet(path)
    return path


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Models:
    """Models of all languages of ``docs`` (rows of the learning fold)."""
    cols = [f"c{k + 1}" for k in range(ORDER)]
    # an n-gram of a lower order has the last letters, and as its count how many different letters stand before it
    grams_of = {ORDER: stage(count_grams(docs.filter(F.col(lang_col).isNotNull()), text_col, lang_col), "lang_grams")}
    for order in range(ORDER - 1, 0, -1):
        grams_of[order] = stage(grams_of[order + 1].groupBy("lang", *cols[ORDER - order:]).agg(F.count(F.lit(1)).alias("n")), f"lang_grams_{order}")

    lower, found, parts = None, [], []
    for order in range(1, ORDER + 1):
        kept, g = cols[ORDER - order:], grams_of[order]
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = g.groupBy("lang").agg(
            F.when(once + twice > 0, F.least(F.lit(0.95), F.greatest(F.lit(0.1), once / F.greatest(once + 2 * twice, F.lit(1))))).otherwise(0.5).alias("discount"))
        contexts = stage(
            g.groupBy("lang", *kept[:-1]).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).join(F.broadcast(discounts), "lang")
            .withColumn("left", F.col("discount") * F.col("kinds") / F.col("total")), f"lang_contexts_{order}")
        if order == 1:
            found = contexts.select("lang", "left").collect()  # a row per language
        p = g.join(contexts, ["lang", *kept[:-1]])
        p = p.withColumn("below", F.lit(1.0 / ALPHABET)) if order == 1 else p.join(lower.withColumnRenamed("p", "below"), ["lang", *kept[1:]])
        lower = stage(p.select("lang", *kept, (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
                                               + F.col("left") * F.col("below")).alias("p")), f"lang_p_{order}")
        for frame, have, value, context in ((lower, kept, "p", 0), (contexts, kept[:-1], "left", 1)):
            if have:
                parts.append(frame.select("lang", F.lit(order).alias("order"), F.lit(context).alias("context"),
                                          *[(F.col(c) if c in have else F.lit(0)).alias(c) for c in cols], F.log(value).alias("value")))
    languages = sorted(r["lang"] for r in found)
    if not languages:
        return Models([], None, 0.0)
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    return Models(languages, _write_tables(entries, languages), min(0.0, *(float(np.log(r["left"] / ALPHABET)) for r in found)))


def cross_entropies(block: tokens.Block, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Nats per predicted character (texts x languages), and the letters of each text."""
    letters, first = characters(block)
    wide, begin, end = _padded(letters, first)
    place, owner = _places(wide, begin, end)
    n_letters = np.bincount(owner, weights=wide[place] != 0, minlength=block.n)
    # each different n-gram of the block is looked up once
    _, at, back = np.unique(grams(wide, ORDER)[place], return_index=True, return_inverse=True)
    columns = [wide[place[at] - (ORDER - 1 - k)] for k in range(ORDER)]
    total = np.maximum(np.bincount(owner, minlength=block.n), 1)
    out = [np.bincount(owner, weights=-models.log_prob(i, columns)[back], minlength=block.n) / total for i in range(len(models.languages))]
    return np.stack(out, axis=1) if out else np.zeros((block.n, 0)), n_letters


def identify(docs: DataFrame, models: Models, limits: dict[str, float], sharpness: float = 20.0, id_col: str = "doc_id",
             text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(id, lang, score, cross_entropy, rejected).  The score is the winner's share of exp(-sharpness * cross-entropy).

    The columns ``carry`` of ``docs`` follow as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)  # names and a path: the tables stay in the shared folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        limit = np.array([limits.get(x, np.inf) for x in m.languages] or [np.inf])
        for batch, block in tokens.blocks(batches, "text"):
            ce, letters = cross_entropies(block, m)
            known = (letters > 0) & (len(m.languages) > 0)
            ce = ce if ce.shape[1] else np.zeros((block.n, 1))
            best = ce.argmin(axis=1)
            low = ce[np.arange(block.n), best]
            share = 1 / np.exp(-sharpness * (ce - low[:, None])).sum(axis=1)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"),
                "lang": pa.array([m.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)], pa.string()),
                "score": np.where(known, share, 0.0), "cross_entropy": np.where(known, low, 0.0),
                "rejected": ~known | (low > limit[best])} | {c: batch.column(c) for c in carry})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *carry)
    kinds = "".join(f", `{c}` {kind}" for c, kind in rows.dtypes[2:])
    return rows.mapInArrow(run, "id long, lang string, score double, cross_entropy double, rejected boolean" + kinds)


def calibrate(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """Each language's cross-entropy limit, from all learning rows that have a language."""
    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("true_lang"))
    found = identify(rows, models, {}, id_col="id", carry=["true_lang"]).filter(F.col("lang") == F.col("true_lang"))
    return _quantiles(found.select("lang", "cross_entropy"), 1 - REJECT)


def identify_calibrated(docs: DataFrame, models: Models, learned: Column, id_col: str = "doc_id", text_col: str = "text",
                        lang_col: str = "lang") -> DataFrame:
    """``identify`` under the limits that ``calibrate`` takes from the ``learned`` rows of ``docs``, each text scored once."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.when(learned, F.col(lang_col)).alias("own_lang"))
    found = stage(identify(rows, models, {}, id_col="id", carry=["own_lang"]), "lang_scores")
    limits = _quantiles(found.filter(F.col("lang") == F.col("own_lang")).select("lang", "cross_entropy"), 1 - REJECT)
    over = F.lit(False)
    for lang, limit in limits.items():
        over = over | ((F.col("lang") == lang) & (F.col("cross_entropy") > limit))
    return found.withColumn("rejected", F.col("rejected") | over).drop("own_lang")


def _quantiles(rows: DataFrame, q: float) -> dict[str, float]:
    """The exact ``q`` quantile of ``cross_entropy`` in each ``lang``, interpolated between neighbours as ``percentile`` does.

    Equal values are one row with their count.  Running sums over the parts of a range partition find the parts that hold a
    language's two neighbours; only there values are numbered.
    """
    keys = ["lang", "cross_entropy"]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    lined = write_back(counted.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()),
                       scratch_path(rows.sparkSession, "lang_limits"))
    whole = Window.partitionBy("lang")
    parts = lined.groupBy("lang", "part").agg(F.sum("n").alias("here"))
    parts = parts.select("lang", "part", "here", (F.sum("here").over(whole.orderBy("part")) - F.col("here")).alias("before"),
                         (q * (F.sum("here").over(whole) - 1)).alias("at"))
    low, high = F.floor("at"), F.ceil("at")
    holds = lambda place: (F.col("before") <= place) & (place < F.col("before") + F.col("here"))
    near = lined.join(parts.filter(holds(low) | holds(high)).drop("here"), ["lang", "part"])
    near = near.withColumn("here", F.col("n")).withColumn(
        "before", F.col("before") + F.sum("n").over(Window.partitionBy("lang", "part").orderBy("cross_entropy")) - F.col("n"))
    value = lambda place: F.max(F.when(holds(place), F.col("cross_entropy")))
    ends = near.groupBy("lang", "at").agg(value(low).alias("low"), value(high).alias("high"))
    limit = F.when(low == high, F.col("low")).otherwise((high - F.col("at")) * F.col("low") + (F.col("at") - low) * F.col("high"))
    return {r["lang"]: r["limit"] for r in ends.select("lang", limit.alias("limit")).collect()}
