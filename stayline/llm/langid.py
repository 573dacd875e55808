"""Language identification in two steps: the family first, then one-versus-one linear SVMs within it.

Features are byte 1- to 4-grams of the whole text, hashed to ``DIMS`` columns. A-Z are lower-cased, other
ASCII characters, and runs of them, count as one space, so that digits, marks and layout say nothing. The classifiers are
fitted on at most ``PER_LANGUAGE`` labelled texts per language (a documented bound, chosen by a hash
of the id); prediction covers every text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import hashed_sample, small_batches
from stayline.llm.words import LOWER, Piece, pieces

DIMS = 4096
GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 300
ROWS_AT_ONCE = 256
UNKNOWN = "und"

# Families of common ISO 639-1 codes; a language not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fy", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa"),
    "semitic": ("ar", "he", "mt"),
}

_KEPT = LOWER.copy()
_KEPT[:128][[not chr(b).isalpha() for b in range(128)]] = 0x20


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), lang)


def features(piece: Piece) -> np.ndarray:
    """[texts, DIMS] unit vectors of the square roots of hashed n-gram counts."""
    data, n = _KEPT[piece.data], len(piece)
    out = np.zeros((n, DIMS), dtype=np.float32)
    text = np.repeat(np.arange(n), np.diff(piece.offsets))
    letter = data != 0x20
    use = letter.copy()
    use[1:] |= letter[:-1] & (text[1:] == text[:-1])  # of a run of spaces, the first
    data, text, letter = data[use].astype(np.uint64), text[use], letter[use]
    run = np.zeros(len(data), dtype=np.uint64)
    for k in range(1, max(GRAMS) + 1):
        if len(data) < k:
            break
        run = run[: len(data) - k + 1] * np.uint64(257) + data[k - 1 :] + np.uint64(1)
        if k not in GRAMS:
            continue
        same = text[: len(run)] == text[k - 1 :]
        # n-grams of spaces alone say nothing
        some = letter[: len(run)].copy()
        for j in range(1, k):
            some |= letter[j : len(run) + j]
        use = same & some
        column = (run[use] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) >> np.uint64(64 - 12)
        out += np.bincount(text[: len(run)][use] * DIMS + column.astype(np.int64), minlength=n * DIMS).reshape(n, DIMS)
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def linear_svm(rows: np.ndarray, signs: np.ndarray, penalty: float = 1e-4, steps: int = 100) -> np.ndarray:
    """Weights and bias of a linear support vector machine: squared hinge loss, accelerated gradient.

    Both classes weigh the same, whatever their sizes.
    """
    x = np.ones((len(rows), rows.shape[1] + 1), np.float32)
    x[:, :-1] = rows
    share = np.where(signs > 0, 0.5 / max(1, (signs > 0).sum()), 0.5 / max(1, (signs < 0).sum())).astype(np.float32)
    signs = signs.astype(np.float32)
    rate = 1 / (2 * 2.0 + penalty)  # rows and bias have norm 2 together, the shares add up to 1
    w, ahead = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for step in range(steps):
        slack = np.maximum(0, 1 - signs * (x @ ahead))
        new = ahead - rate * (penalty * ahead - 2 * x.T @ (share * signs * slack))
        ahead = new + np.float32(step / (step + 3)) * (new - w)
        w = new
    return w


@dataclass
class LanguageModel:
    """Plain arrays and strings, so that workers need nothing but NumPy."""

    families: list[str]
    languages: list[list[str]]  # by family
    family_weights: np.ndarray  # [families, DIMS + 1], one against the rest
    pairs: list[list[tuple[int, int, np.ndarray]]]  # by family: (language, language, weights)

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of every row and a confidence in [0, 1]."""
        n = len(rows)
        if not self.families:
            return np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        margin = rows @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
        family = margin.argmax(axis=1)
        score = np.ones(n) if len(self.families) == 1 else _probability(margin.max(axis=1))
        lang = np.empty(n, dtype=object)
        for f, names in enumerate(self.languages):
            mine = np.flatnonzero(family == f)
            votes = np.zeros((len(mine), len(names)))
            sums = np.zeros((len(mine), len(names)))
            for a, b, w in self.pairs[f]:
                m = rows[mine] @ w[:-1] + w[-1]
                p = _probability(m)
                votes[:, a] += m >= 0
                votes[:, b] += m < 0
                sums[:, a] += p
                sums[:, b] += 1 - p
            best = (votes + sums / (2 * max(1, len(names)))).argmax(axis=1)
            lang[mine] = np.array(names, dtype=object)[best]
            if len(names) > 1:
                score[mine] *= sums[np.arange(len(mine)), best] / (len(names) - 1)
        return lang, score


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -50, 50)))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """A model from rows with doc_id, text and lang.

    Rows without a language or without a letter are left out. Of each language the ``per_language``
    rows that come first by a hash of the id are used, whole.
    """
    rows = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    rows = rows.select("doc_id", "lang", "text")
    sample = hashed_sample(rows, per_language, ["doc_id", "text"], by="lang").select("lang", "text")
    fitted = small_batches(sample).repartition(1).mapInArrow(_train, "model binary").collect()
    return LanguageModel(*pickle.loads(fitted[0][0])) if fitted else LanguageModel([], [], np.zeros((0, DIMS + 1)), [])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bounded sample in, the model's plain parts out; runs in one task, so the driver stays small."""
    sample = pa.Table.from_batches(list(batches), pa.schema([("lang", pa.string()), ("text", pa.string())]))
    langs = np.array(sample.column("lang").to_pylist(), dtype=object)
    if not len(langs):
        return
    x = np.vstack([features(p) for p in pieces(sample.column("text"), rows=ROWS_AT_ONCE)])
    # In the order of the rows' contents, not of their arrival: reruns give the same weights.
    order = np.lexsort((x.sum(axis=1), langs.astype(str)))
    x, langs = x[order], langs[order]
    known = sorted(set(langs))
    families = sorted({family_of(x) for x in known})
    members = [[x for x in known if family_of(x) == f] for f in families]
    own = np.array([families.index(family_of(x)) for x in langs], dtype=int)
    weights = [linear_svm(x, np.where(own == f, 1.0, -1.0)) if len(families) > 1 else np.zeros(DIMS + 1) for f in range(len(families))]
    pairs = []
    for names in members:
        found = []
        for a in range(len(names)):
            for b in range(a + 1, len(names)):
                mine = (langs == names[a]) | (langs == names[b])
                found.append((a, b, linear_svm(x[mine], np.where(langs[mine] == names[a], 1.0, -1.0))))
        pairs.append(found)
    model = (families, members, np.array(weights).reshape(len(families), DIMS + 1), pairs)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The columns of ``docs`` with lang_pred and score (0 to 1) added.

    A null text and a text without a letter are ``und`` with score 0, and so is everything if the
    model has seen no label. Columns of the input called lang_pred or score are replaced.
    """
    def predict(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts in batches:
            lang, score = [], []
            for piece in pieces(texts):
                a, b = model.predict(features(piece))
                lang.append(a)
                score.append(b)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate(lang) if lang else [], pa.string()),
                    pa.array(np.concatenate(score) if score else [], pa.float64()),
                ],
                names=["lang", "score"],
            )

    known = has_letter(F.col("text"))
    udf = F.arrow_udf(predict, "lang string, score double")
    found = small_batches(docs).withColumn("_found", udf(F.col("text")))
    return found.withColumns(
        {
            "lang_pred": F.when(known, F.coalesce("_found.lang", F.lit(UNKNOWN))).otherwise(UNKNOWN),
            "score": F.when(known, F.col("_found.score")).otherwise(F.lit(0.0)),
        }
    ).drop("_found")


def held_out() -> Column:
    """Whether a row must not be learnt from: one id in four, by checksum; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
