"""Language identification by nearest centroid over TF-IDF vectors of byte n-grams.

A text is the L2-normalised vector of log-scaled counts of its hashed byte bigrams and
trigrams (letters only, A-Z folded), weighted by inverse document frequency.  Each language
has several centroids, found by spherical k-means, so that registers of one language need
not share a mean.  The nearest centroid by cosine decides.  A text is rejected if it is further
from it than labelled texts that the centroids were not fitted to, cut down to its length:
below a low quantile of their similarities, times a slack.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, quoted
from .words import LOWER, slices, text_buffers

BITS = 11
WIDTH = 2 << BITS
SLICE_TEXTS = 256
SPARE = 8
LENGTHS = np.array([8, 16, 32, 64, 128, 256, 512, 1024])
_LETTER = LOWER.copy()
_LETTER[:65] = _LETTER[91:97] = _LETTER[123:128] = 32
_IS_ASCII_LETTER = np.zeros(256, bool)
_IS_ASCII_LETTER[65:91] = _IS_ASCII_LETTER[97:123] = True


def gram_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed byte bigrams (first half) and trigrams (second half) of each text."""
    n = len(offsets) - 1
    out = np.zeros(n * WIDTH, np.float32)
    if len(buf) > 1:
        b = _LETTER[buf].astype(np.uint32)
        doc = np.repeat(np.arange(n, dtype=np.int64) * WIDTH, np.diff(offsets))
        two = b[:-1] * np.uint32(257) + b[1:]
        for k, code in ((2, two), (3, two[:-1] * np.uint32(263) + b[2:])):
            if len(code):
                cell = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64) + ((k - 2) << BITS)
                whole = doc[: len(code)] == doc[k - 1 :]
                blank = (b[: len(code)] == 32) & (b[1 : len(code) + 1] == 32)
                cell = (cell + doc[: len(code)])[whole & ~blank]
                out += np.bincount(cell, minlength=n * WIDTH).astype(np.float32)
    return out.reshape(n, WIDTH)


def has_letters(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    seen = np.r_[0, np.cumsum(_IS_ASCII_LETTER[buf])]
    found = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~found).tolist():
        found[i] = any(c.isalpha() for c in buf[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


@dataclass
class LanguageModel:
    """idf: weight of each feature; centroids: unit rows; langs: language of each; floor: its rejection similarity by length class."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    floor: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.idf)

    def predict(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        letters = has_letters(buf, offsets)
        if not self.langs:
            return ["und"] * n, np.zeros(n), np.ones(n, bool)
        counts = gram_counts(buf, offsets)
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(n), best], 0, 1).astype(np.float64)
        score[~letters] = 0
        return [self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())], score, ~letters | (score < self.floor[best, length_class(counts.sum(axis=1))])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def length_class(n_grams: np.ndarray) -> np.ndarray:
    """Index in LENGTHS of the greatest length that n_grams reach, 0 below all."""
    return np.maximum(np.searchsorted(LENGTHS, n_grams, "right") - 1, 0)


def k_means(x: np.ndarray, k: int, steps: int = 12, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit rows, each of a twentieth of the rows at least; starts are drawn by their distance from those before (k-means++)."""
    rng = np.random.default_rng(seed)
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    far = 1 - x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)) and far.max() > 1e-6:
        weight = np.maximum(far, 0).astype(np.float64)
        chosen.append(int(rng.choice(len(x), p=weight / weight.sum())))
        far = np.minimum(far, 1 - x @ x[chosen[-1]])
    c = x[chosen]
    while True:
        for _ in range(steps):
            own = (x @ c.T).argmax(axis=1)
            c = unit(np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))]))
        size = np.bincount((x @ c.T).argmax(axis=1), minlength=len(c))
        if len(c) == 1 or 20 * size.min() >= len(x):
            return c
        c = np.delete(c, size.argmin(), axis=0)


def floors_of(counts: np.ndarray, idf: np.ndarray, centroids: np.ndarray, quantile: float, slack: float, seed: int = 5) -> np.ndarray:
    """Rejection similarity of one language by length class: a low quantile over texts cut down to each length, times slack.

    A text is cut down by drawing so many of its n-grams.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros(len(LENGTHS))
    total = counts.sum(axis=1)
    for k, n in enumerate(LENGTHS.tolist()):
        some = counts[total >= n].astype(np.int64)
        if len(some):
            cut = np.stack([rng.multivariate_hypergeometric(row, n, method="marginals") for row in some])
            out[k] = slack * float(np.quantile((unit(np.log1p(cut.astype(np.float32)) * idf) @ centroids.T).max(axis=1), quantile))
        elif k:
            out[k] = out[k - 1]
    return out


def sample_cuts(rows: DataFrame, sample_per_lang: int, sample_total: int) -> dict[str, int]:
    """For each language the hash up to which rows (lang, h) are its sample; at most sample_per_lang distinct hashes are.

    Many languages share sample_total.  Equal rows have equal hashes and are one vector of the sample; every language
    has one at least.  Only hashes below a bound that about SPARE samples pass are ranked, so that no task ranks
    more; languages with fewer there (of many equal rows) are ranked whole, as many rows a task as the sample has.
    """
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    most = max(1, min(sample_per_lang, sample_total // len(counts)))

    def ranked(some: DataFrame) -> dict[str, tuple[int, int]]:
        place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
        first = some.select("lang", "h", place.alias("k")).filter(F.col("k") <= most)
        return {r["lang"]: (r["cut"], r["n"]) for r in first.groupBy("lang").agg(F.max("h").alias("cut"), F.count("*").alias("n")).collect()}

    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 63, int(SPARE * most / n * (1 << 64)) - (1 << 63)) - 1)])
    found = ranked(rows.filter(F.col("h") <= bound[F.col("lang")]))
    short = [lang for lang, n in counts.items() if found.get(lang, (0, 0))[1] < min(most, n)]
    if short:
        found |= ranked(rows.filter(F.col("lang").isin(short)))
    return {lang: cut for lang, (cut, _) in found.items()}


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", n_centroids: int = 4, sample_per_lang: int = 400, quantile: float = 0.02, slack: float = 0.7, sample_total: int = 20_000) -> LanguageModel:
    """Learn from rows with a language and a letter; others are ignored.

    Document frequencies cover all these rows.  Centroids are clustered from a sample of each language: its
    sample_per_lang first rows by a hash of id and text (fewer, if there are more than sample_total / sample_per_lang
    languages).  So null and repeated ids change nothing, and equal rows are one vector.  These samples are the
    vectors that reach the driver, 8 kB each; every fourth of them is left out of the fit and sets the
    floors (all of them do both where they are fewer than 8).  No such rows: a model that rejects everything.
    """
    text, lang = F.col(quoted(text_col)).cast("string"), F.col(quoted(lang_col)).cast("string")
    letter = text.rlike(r"\p{L}")
    rows = df.select(text.alias("text"), lang.alias("lang"), F.xxhash64(F.col(quoted(id_col)).cast("string"), text).alias("h")).filter(text.isNotNull() & lang.isNotNull() & letter)
    cut = sample_cuts(rows, sample_per_lang, sample_total)
    if not cut:
        return LanguageModel(np.zeros(WIDTH, np.float32), np.zeros((0, WIDTH), np.float32), [], np.zeros((0, len(LENGTHS))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(WIDTH, np.int64), 0
        taken: set[tuple[str, int]] = set()
        for batch in batches:
            buf, offsets, _ = text_buffers(batch.column(0))
            langs, hashes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            sampled = np.zeros(len(langs), bool)
            for i, key in enumerate(zip(langs, hashes)):
                if key[1] <= cut[key[0]] and key not in taken:
                    sampled[i] = True
                    taken.add(key)
            for i, j in slices(offsets, texts=SLICE_TEXTS):
                own = offsets[i : j + 1] - offsets[i]
                part = buf[offsets[i] : offsets[j]]
                counts = gram_counts(part, own)
                letters = has_letters(part, own)
                seen += (counts[letters] > 0).sum(axis=0)
                n += int(letters.sum())
                pick = np.flatnonzero(letters & sampled[i:j])
                if len(pick):
                    yield pa.record_batch([pa.array([0] * len(pick), pa.int32()), pa.array([langs[i + p] for p in pick]), pa.array([hashes[i + p] for p in pick], pa.int64()), pa.array([np.minimum(counts[p], 65535).astype(np.uint16).tobytes() for p in pick], pa.binary())], names=_FIT)
        yield pa.record_batch([pa.array([1 + TaskContext.get().partitionId() % 64], pa.int32()), pa.array([None], pa.string()), pa.array([n]), pa.array([seen.tobytes()], pa.binary())], names=_FIT)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        """Document frequencies of many tasks as one row."""
        seen = np.sum([np.frombuffer(x, np.int64) for x in pdf["vec"]], axis=0)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "lang": [None], "n": [int(pdf["n"].sum())], "vec": [seen.tobytes()]})

    schema = "part int, lang string, n long, vec binary"
    table = materialize(rows.mapInArrow(count, schema), "language")
    sums = table.filter("part > 0").groupBy("part").applyInPandas(total, schema).collect()
    n = sum(r["n"] for r in sums)
    seen = np.sum([np.frombuffer(r["vec"], np.int64) for r in sums], axis=0)
    idf = np.log((1 + n) / (1 + seen)).astype(np.float32) + np.float32(1)
    by_lang: dict[str, list] = {}
    for r in table.filter("part = 0").dropDuplicates(["lang", "n"]).orderBy("lang", "vec").collect():
        by_lang.setdefault(r["lang"], []).append(np.frombuffer(r["vec"], np.uint16))
    centroids, langs, floors = [np.zeros((0, WIDTH), np.float32)], [], []
    for lang in sorted(by_lang):
        counts = np.stack(by_lang[lang])
        outside = np.arange(len(counts)) % 4 == 3 if len(counts) >= 8 else np.ones(len(counts), bool)
        c = k_means(unit(np.log1p(counts[~outside if len(counts) >= 8 else outside].astype(np.float32)) * idf), n_centroids)
        centroids.append(c.astype(np.float32))
        langs += [lang] * len(c)
        floors += [floors_of(counts[outside], idf, c, quantile, slack)] * len(c)
    return LanguageModel(idf, np.concatenate(centroids), langs, np.array(floors).reshape(len(langs), len(LENGTHS)))


_FIT = ["part", "lang", "n", "vec"]


def _scored(df: DataFrame, model: LanguageModel, text_col: str, keep: list[str]) -> DataFrame:
    """Rows (row: struct of the columns keep, lang_pred, score, rejected); columns of df may have any names."""
    told = df.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*(F.col(quoted(c)).alias(c) for c in keep)).alias("row")
    # a text that is kept anyway crosses to Python once
    once = text_col in keep and dict(df.dtypes)[text_col] == "string"
    at = keep.index(text_col) if once else 0
    source = df.select(row) if once else df.select(row, F.col(quoted(text_col)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets, _ = text_buffers(batch.column(0).field(at) if once else batch.column(1))
            for i, j in slices(offsets, texts=SLICE_TEXTS):
                langs, score, rejected = told.value.predict(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(langs), pa.array(score), pa.array(rejected)], names=["row", "lang_pred", "score", "rejected"])

    schema = df.select(row).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return source.mapInArrow(run, schema)


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns keep (default: all) of df, then lang_pred, score and rejected.

    Null text or a text without letters: `und`, score 0, rejected.  A rejected text with
    letters still names its nearest language.  Kept columns called like a result are replaced.
    """
    new = ["lang_pred", "score", "rejected"]
    return _scored(df, model, text_col, [c for c in (df.columns if keep is None else keep) if c not in new]).select("row.*", *new)


def held_out(id_col: str = "doc_id", modulus: int = 4, remainder: int = 2):
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def language_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score, rejected), one an input row, learned from rows that are not held out.

    Null ids are never held out; rows that share an id are held out together and predicted each.
    """
    model = fit(df.filter(~held_out(id_col)), id_col, text_col, lang_col)
    out = predict(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, "text", ["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def in_known_language(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """df without the rows that language identification rejects."""
    model = fit(df, id_col, text_col, lang_col)
    return _scored(df, model, text_col, df.columns).filter("not rejected").select("row.*")
