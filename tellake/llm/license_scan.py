"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Windows of a width start every stride words in documents and at every word in templates, so
a passage is met by a template window at most half a stride away.  Templates shorter than
the wide windows are looked up with narrow ones, of which they fill a quarter at least.
With BANDS bands of one row, windows of Jaccard similarity s share a band with probability
1 - (1 - s) ** BANDS: 0.9999 at s = 0.25.  A retrieved template counts only if at least
`containment` of its distinct five-word shingles occur in the words around the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import id_array
from .license_texts import TEMPLATES, default_templates  # noqa: F401
from .words import ALNUM, LOWER, U, mix, slices, split_words, text_buffers, windows

#: (width, stride) of windows in words, for templates of few and of many words
WINDOWS, BANDS, SHINGLE = ((8, 4), (32, 8)), 32, 5
#: a table of templates may hold so many bytes of text: they are broadcast, with about 100 bytes a byte of text
TEMPLATE_BYTES = 4 << 20
_SALTS = np.random.default_rng(99).integers(1, 1 << 63, BANDS, dtype=np.uint64) | U(1)


def shingles(words: np.ndarray) -> np.ndarray:
    return windows(words, SHINGLE) if len(words) >= SHINGLE else windows(words, len(words)) if len(words) else words


def signatures(grams: np.ndarray, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Band values [len(starts), BANDS]: smallest salted hash of grams[s:s+width] in each band; one width for all, or one each."""
    out = np.empty((len(starts), BANDS), U)
    edges = np.minimum(np.stack([starts, starts + width], axis=1), len(grams)).ravel()
    padded = np.append(grams, ~U(0))
    for k in range(BANDS):
        out[:, k] = np.minimum.reduceat(mix(padded * _SALTS[k]), edges)[::2] ^ _SALTS[k]
    return out


class Template:
    def __init__(self, name: str, text: str):
        buf, offsets, _ = text_buffers(pa.array([text]))
        w = split_words(buf, offsets, ALNUM, LOWER).hash
        self.name, self.n_words, self.grams = name, len(w), np.unique(shingles(w))
        self.skip = max(1, len(w) // 4)
        own = shingles(w)
        self.width = max([n for n, _ in WINDOWS if n <= len(w)], default=WINDOWS[0][0])
        starts = np.arange(max(1, len(w) - self.width + 1)) if len(own) else np.zeros(0, np.int64)
        self.bands = np.unique(signatures(own, starts, self.width - SHINGLE + 1)) if len(own) else own


def text_shingles(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several texts, none across a border, and the bounds of each text's; a short text is one shingle."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    bounds = np.r_[0, np.cumsum(count)]
    every = windows(words, SHINGLE)
    long = np.flatnonzero(n >= SHINGLE)
    out = np.zeros(int(bounds[-1]), U)
    inside = np.arange(int(count[long].sum())) - np.repeat(np.cumsum(count[long]) - count[long], count[long])
    out[np.repeat(bounds[long], count[long]) + inside] = every[np.repeat(first[long], count[long]) + inside]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)).tolist():
        out[bounds[i]] = shingles(words[first[i] : first[i + 1]])[0]
    return out, bounds


def template_texts(templates: DataFrame | dict[str, str] | None) -> list[tuple[str, str]]:
    """(name, text) of a table (name, text), a dictionary or, if None, the texts of license_texts, by name.

    Rows without a name or a text are left out.  Tables of more than TEMPLATE_BYTES are an error: split them.
    """
    if templates is None or isinstance(templates, dict):
        return sorted((default_templates() if templates is None else templates).items())
    rows = templates.select(F.col("name").cast("string"), F.col("text").cast("string")).dropna()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates hold {size} bytes of text; at most {TEMPLATE_BYTES} are scanned for at once")
    return sorted(tuple(r) for r in rows.collect())


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: DataFrame | dict[str, str] | None = None, containment: float = 0.8) -> DataFrame:
    """Rows (doc_id, n_words, licenses, spans), one per input row.

    templates: a table (name, text), a dictionary, or the texts of license_texts; several may share a name.
    licenses: sorted names of contained templates; spans: (name, from, to), the word range of each place in which one
    was verified: a place begins where the one before ended.  Words are [0-9a-z and non-ASCII]+ after A-Z became
    a-z.  Null or wordless text: nothing found.  A template of fewer than five words is found
    where its words stand in a row; a text of fewer than five words is its own one shingle.
    Templates without words match nothing.  Null and repeated ids are kept; ids are integers,
    or strings of them.  Other columns are not read.
    """
    known = [Template(n, x) for n, x in template_texts(templates)]
    told = df.sparkSession.sparkContext.broadcast([x for x in known if len(x.grams)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for width, stride in WINDOWS:
            own = [(k, x) for k, x in enumerate(told.value) if x.width == width]
            values = np.concatenate([np.zeros(0, U), *(x.bands for _, x in own)])
            owner = np.concatenate([np.zeros(0, np.int64), *(np.full(len(x.bands), k) for k, x in own)])
            order = np.argsort(values, kind="stable")
            tables.append((width, stride, values[order], owner[order]))
        short = [x for x in told.value if x.n_words < SHINGLE]
        for batch in batches:
            ids, no_id = id_array(batch.column(0))
            buf, offsets, _ = text_buffers(batch.column(1))
            for i, j in slices(offsets):
                w = split_words(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM, LOWER)
                n_words = np.diff(w.first)
                found: list[dict] = [{} for _ in range(j - i)]
                grams, bounds = text_shingles(w.hash, w.first)
                last = bounds[1:] - 1
                for width, stride, values, owner in tables:
                    count = np.where(n_words > 0, np.maximum(n_words - width + stride - 1, 0) // stride + 1, 0)
                    doc = np.repeat(np.arange(j - i), count)
                    at = stride * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
                    if not len(values) or not len(at):
                        continue
                    start = np.minimum(bounds[doc] + at, last[doc])
                    sign = signatures(grams, start, np.minimum(width - SHINGLE + 1, bounds[doc + 1] - start))
                    hit = np.minimum(np.searchsorted(values, sign), len(values) - 1)
                    rows, bands = np.nonzero(values[hit] == sign)
                    tried: set[tuple[int, int]] = set()
                    lost: dict[tuple[int, int], int] = {}  # up to where a template cannot be
                    for r, b in zip(rows.tolist(), bands.tolist()):
                        for k in owner[hit[r, b] : np.searchsorted(values, sign[r, b], "right")].tolist():
                            x, d, here = told.value[k], int(doc[r]), int(at[r])
                            before = found[d].get(x.name)
                            if (r, k) in tried or here < lost.get((d, k), 0) or (before and here < before[-1][1]):
                                continue
                            tried.add((r, k))

                            def held(end: int) -> tuple[int, int, float]:
                                """Share of the template's shingles in the words that an occurrence around a window from here to end can take."""
                                lo, hi = max(0, here - x.n_words), min(int(n_words[d]), end + width + x.n_words)
                                own = grams[bounds[d] + min(lo, int(last[d] - bounds[d])) : max(bounds[d] + hi - SHINGLE + 1, bounds[d] + 1)]
                                return lo, hi, np.isin(x.grams, own).mean()

                            if x.skip > width and held(here + x.skip)[2] < containment:
                                lost[d, k] = here + x.skip  # nor at any window up to there
                                continue
                            lo, hi, share = held(here)
                            if share >= containment:
                                found[d].setdefault(x.name, []).append((lo, hi))
                for x in short:  # fewer words than a shingle: looked for as a row of words
                    for p in np.flatnonzero(windows(w.hash, x.n_words) == x.grams[0]).tolist():
                        d = int(w.doc[p])
                        if p + x.n_words <= w.first[d + 1]:
                            found[d].setdefault(x.name, []).append((p - int(w.first[d]), p - int(w.first[d]) + x.n_words))
                yield pa.record_batch(
                    [pa.array(ids[i:j], mask=no_id[i:j]), pa.array(n_words), pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                     pa.array([[{"name": n, "from": a, "to": b} for n, places in sorted(f.items()) for a, b in sorted(places)] for f in found], pa.list_(pa.struct([("name", pa.string()), ("from", pa.int32()), ("to", pa.int32())])))],
                    names=["doc_id", "n_words", "licenses", "spans"])

    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(scan, "doc_id long, n_words long, licenses array<string>, spans array<struct<name:string,from:int,to:int>>")
