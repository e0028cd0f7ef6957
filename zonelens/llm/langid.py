"""Language identification by hierarchical discrimination.

Two decisions per text.  First the language *family*: a multinomial model over
hashed byte n-grams picks the family with the highest posterior.  Then, inside
that family, one linear support vector machine per pair of languages votes
(one-versus-one); ties go to the larger summed margin.

Training.  Features are counts of hashed 3- and 4-byte n-grams of the
lower-cased text with everything but letters blanked.  Each language gives at
most `per_lang` training texts (default 800, chosen by a hash of the id), a
documented bound: the fit needs a fixed number of texts, prediction covers
every text.  Counts are summed per language by Spark; each family's machines
are fitted in one task from that family's bounded sample (squared hinge loss,
accelerated gradient steps).  The model that reaches the driver has one weight
row per language and per pair.

Families.  `FAMILIES` names the usual ones; a label that is not listed joins
the family whose summed profile is closest (cosine) or, when none reaches
`join_at`, stands alone.  A family of one language needs no machine.

Defined results: a NULL text, an empty one or one without any letter is `und`
with score 0; NULL labels never train; without training rows every text is
`und`.  Duplicate rows give duplicate results.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonelens.llm.common import LOWER, flat_text, slices

# Language code -> family.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "ca": "romance", "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic",
}
DIMS = 1 << 12
LETTER = re.compile(r"[^\W\d_]")


def _letters_table() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    t[97:123] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


_LETTERS = _letters_table()


def ngram_ids(buf: np.ndarray, offs: np.ndarray):
    """Feature ids of every position (one 3-gram and one 4-gram each; DIMS marks a window
    that would cross into the next text or that holds blanks only)."""
    b = LOWER[buf]
    up = np.flatnonzero((b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97) & (b[:-1] == 0xC3)) + 1
    b[up] += 0x20                                     # upper-case Latin-1 letters
    b = _LETTERS[b].astype(np.uint32)
    n = len(b)
    out = np.full((2, n), DIMS, np.int64)
    left = np.repeat(offs[1:], np.diff(offs)) - np.arange(n)     # bytes left in this text
    for row, width in enumerate((3, 4)):
        if n < width:
            continue
        g = np.zeros(n - width + 1, np.uint32)
        for k in range(width):
            g |= b[k:n - width + 1 + k] << np.uint32(8 * k)
        h = ((g * np.uint32(2654435761) + np.uint32(row * 0x9E37)) ^ (g >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        ids = (h >> np.uint32(20)).astype(np.int64)
        blank = np.uint32(int.from_bytes(b" " * width, "little"))
        ids[(left[:len(ids)] < width) | (g == blank)] = DIMS
        out[row, :len(ids)] = ids
    return out


def _has_letter(col: pa.Array) -> np.ndarray:
    return np.array([t is not None and LETTER.search(t) is not None for t in col.to_pylist()], bool)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, doc counts as uint16 pairs packed in binary) of each training text."""
    for batch in batches:
        buf, offs = flat_text(batch.column("text"))
        langs, out = batch.column("lang").to_pylist(), []
        for i, j in slices(offs):
            o = offs[i:j + 1] - offs[i]
            ids = ngram_ids(buf[offs[i]:offs[j]], o)
            for k in range(j - i):
                c = np.bincount(ids[:, o[k]:o[k + 1]].ravel(), minlength=DIMS + 1)[:DIMS]
                out.append(c.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                         names=["lang", "counts"])


def training_sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """At most `per_lang` texts of each language, chosen by a hash of the id."""
    by = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rate = (by.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
            .select(F.col("lang").alias("_lang"), (F.lit(2.0 * per_lang) / F.col("_n")).alias("_rate")))
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid"))
    near = (by.withColumn("_key", key).join(F.broadcast(rate), F.col("lang") == F.col("_lang"))
            .filter((F.shiftrightunsigned("_key", 11) / F.lit(float(1 << 53))) < F.col("_rate")))
    w = Window.partitionBy("lang").orderBy("_key", "doc_id")
    return near.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_lang).select("lang", "text")


def fit_svm(x: np.ndarray, y: np.ndarray, reg: float = 1e-3, steps: int = 120) -> np.ndarray:
    """Weights (last one: bias) of a linear machine with squared hinge loss; y is +1 / -1,
    classes weigh alike."""
    n, d = x.shape
    c = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(d + 1, np.float32)
    v, t = w.copy(), 1.0
    step = 1.0 / (2 * float((c * ((x ** 2).sum(1) + 1)).sum()) + reg)
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ v[:-1] + v[-1])) * y * c
        grad = np.append(-2 * (gap @ x), -2 * gap.sum()).astype(np.float32)
        grad[:-1] += reg * v[:-1]
        new = v - step * grad
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def scaling(total: np.ndarray) -> np.ndarray:
    """Per-feature factor that evens out the spread of relative frequencies."""
    f = (total + 1.0) / (total.sum() + len(total))
    return (1.0 / np.sqrt(f)).astype(np.float32)


def _fit_family(scale: np.ndarray):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        langs = sorted(pdf["lang"].unique())
        x = np.stack([np.frombuffer(c, np.float32) for c in pdf["counts"]])
        x = x / np.maximum(1, x.sum(1, keepdims=True)) * scale
        norm = float(np.sqrt((x ** 2).sum(1)).mean()) or 1.0
        x /= norm
        lab, rows = pdf["lang"].to_numpy(), []
        for i, a in enumerate(langs):
            for b in langs[i + 1:]:
                pick = (lab == a) | (lab == b)
                w = fit_svm(x[pick], np.where(lab[pick] == a, 1, -1).astype(np.float32))
                w[:-1] *= scale / norm               # so that plain frequencies can be used
                rows.append((pdf["family"].iloc[0], a, b, w.astype(np.float32).tobytes()))
        return pd.DataFrame(rows, columns=["family", "a", "b", "w"])
    return fit


def assign_families(profiles: dict[str, np.ndarray], families: dict[str, str], join_at: float) -> dict[str, str]:
    """Family of every label: the listed one, else the closest profile's, else its own."""
    out = {lang: families[lang] for lang in profiles if lang in families}
    unit = {k: np.sqrt(v / max(1.0, v.sum())) for k, v in profiles.items()}
    for lang in sorted(set(profiles) - set(out)):
        near = max(((float(unit[lang] @ unit[o]), f) for o, f in out.items()), default=(0.0, lang))
        out[lang] = near[1] if near[0] >= join_at else lang
    return out


def fit(docs: DataFrame, per_lang: int = 800, families: dict[str, str] | None = None,
        join_at: float = 0.8) -> dict:
    """Model from labelled texts (columns doc_id, text, lang)."""
    counts = (training_sample(docs, per_lang)
              .mapInArrow(_count_rows, "lang string, counts binary"))

    def add(batches):
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, c in zip(b.column("lang").to_pylist(), b.column("counts").to_pylist()):
                x = np.frombuffer(c, np.float32).astype(np.float64)
                acc[lang] = acc[lang] + x if lang in acc else x
        yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.string()),
                                          pa.array([v.tobytes() for v in acc.values()], pa.binary())],
                                         names=["lang", "sums"])
    profiles: dict[str, np.ndarray] = {}
    for r in counts.repartition(8).mapInArrow(add, "lang string, sums binary").toLocalIterator():
        v = np.frombuffer(bytes(r["sums"]), np.float64)
        profiles[r["lang"]] = profiles.get(r["lang"], 0) + v
    fam = assign_families(profiles, FAMILIES if families is None else families, join_at)
    names = sorted(set(fam.values()))
    model = {"families": names, "members": {f: sorted(k for k, v in fam.items() if v == f) for f in names}, "pairs": {}}
    if not names:
        return model
    total = sum(profiles.values())
    sums = {f: sum(profiles[k] for k in model["members"][f]) for f in names}
    model["log"] = np.stack([np.log((sums[f] + 0.5) / (sums[f].sum() + 0.5 * DIMS)) for f in names]).astype(np.float32)
    if any(len(m) > 1 for m in model["members"].values()):
        spark = docs.sparkSession
        fams = spark.createDataFrame([(k, f) for k, f in fam.items() if len(model["members"][f]) > 1],
                                     "_k string, family string")
        fitted = (counts.join(F.broadcast(fams), F.col("lang") == F.col("_k")).select("family", "lang", "counts")
                  .groupBy("family").applyInPandas(_fit_family(scaling(total)), "family string, a string, b string, w binary"))
        for r in fitted.collect():       # one row per pair of languages of a family
            model["pairs"].setdefault(r["family"], []).append((r["a"], r["b"], np.frombuffer(bytes(r["w"]), np.float32)))
        for v in model["pairs"].values():
            v.sort(key=lambda p: p[:2])
    return model


def predict_slice(model: dict, buf: np.ndarray, offs: np.ndarray):
    """(language, score) of each text of a slice; texts without n-grams give None."""
    n, names = len(offs) - 1, model["families"]
    ids = ngram_ids(buf, offs)
    tables = [model["log"][i] for i in range(len(names))]
    pairs = [(f, a, b, w) for f in names for a, b, w in model["pairs"].get(f, [])]
    cols = np.stack([np.append(t, 0) for t in tables] + [np.append(w[:-1], 0) for _, _, _, w in pairs]
                    + [np.append(np.ones(DIMS), 0)], axis=1).astype(np.float32)
    cuts = np.minimum(offs[:-1], max(0, ids.shape[1] - 1))
    sums = np.zeros((n, cols.shape[1]))
    if ids.shape[1]:
        for c in range(cols.shape[1]):
            col = np.ascontiguousarray(cols[:, c])
            each = col[ids[0]] + col[ids[1]]
            sums[:, c] = np.add.reduceat(each, cuts, dtype=np.float64)
        sums[offs[1:] == offs[:-1]] = 0
    m = np.maximum(1, sums[:, -1])
    logp = sums[:, :len(names)] / m[:, None] * np.minimum(m, 50)[:, None]      # tempered: n-grams overlap
    logp -= logp.max(1, keepdims=True)
    post = np.exp(logp)
    post /= post.sum(1, keepdims=True)
    family = post.argmax(1)
    margins = {(f, a, b): sums[:, len(names) + i] / m + w[-1] for i, (f, a, b, w) in enumerate(pairs)}
    langs, scores = [], []
    for k in range(n):
        f = names[family[k]]
        members = model["members"][f]
        votes = {lang: [0, 0.0] for lang in members}
        for a, b, _ in model["pairs"].get(f, []):
            v = float(margins[(f, a, b)][k])
            votes[a if v >= 0 else b][0] += 1
            votes[a][1] += v
            votes[b][1] -= v
        best = max(members, key=lambda x: (votes[x][0], votes[x][1]))
        conf = 1.0
        for a, b, _ in model["pairs"].get(f, []):
            if best in (a, b):
                v = float(margins[(f, a, b)][k]) * (1 if best == a else -1)
                conf = min(conf, 1.0 / (1.0 + np.exp(-4.0 * np.clip(v, -50, 50))))
        langs.append(best)
        scores.append(float(min(1.0, max(0.0, post[k, family[k]] * conf))))
    return langs, scores, m


def predict(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """`keep` columns of every row plus lang_pred, score and lang_family.  Only `text` is read
    for the decision.  The model (bounded by languages, not by rows) travels with the task."""
    fam_of = {lang: f for f, m in model["members"].items() for lang in m}

    def run(batches):
        for batch in batches:
            has = _has_letter(batch.column("text"))
            buf, offs = flat_text(batch.column("text"))
            langs, scores = [], []
            if model["families"]:
                for i, j in slices(offs):
                    a, b, _ = predict_slice(model, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                    langs += a
                    scores += b
            else:
                langs, scores, has = ["und"] * len(has), [0.0] * len(has), np.zeros(len(has), bool)
            langs = [x if h else "und" for x, h in zip(langs, has)]
            scores = [x if h else 0.0 for x, h in zip(scores, has)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                   pa.array([fam_of.get(x) for x in langs], pa.string())],
                names=[*keep, "lang_pred", "score", "lang_family"])
    src = docs.select(*keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep)
    return src.mapInArrow(run, f"{fields}, lang_pred string, score double, lang_family string")
