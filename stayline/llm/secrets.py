"""Secret scans: exact patterns, and character Markov models that tell random strings from identifiers.

Two first-order Markov models over the characters of tokens, one of random strings and one of
ordinary words, are fitted on labelled samples. A run of token characters is reported when the
log-likelihood ratio of the two is high enough, also if it has letters only; of a run that overlaps a
pattern's span, what lies outside is judged by itself. Runs of fewer than ``SHORTEST`` characters are not.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import hashed_sample, small_batches
from stayline.llm.words import pieces

# The patterns and least lengths. Only the key words match in either case.
_KEYS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched whole, so the least length can stand here
KINDS = ("assign", "access", "hex", "markov")

SAMPLE_DOCS = 4000
RANDOM_STRINGS = 4000
SHORTEST = 16
LEAST_RATIO = 12.0  # natural log of the likelihood ratio
LETTERS_RATIO = 2.6  # by character, where a run has no digit or no letter: identifiers come near it

_SYMBOLS = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
_CODE = np.full(256, -1, dtype=np.int64)
_CODE[[ord(c) for c in _SYMBOLS]] = np.arange(len(_SYMBOLS))
_WORDS = re.compile(r"[A-Za-z0-9+/_=-]{4,}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(kind's place, start, end) of the patterns, leftmost and non-overlapping for each kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(kind, start, end) for start, kind, end in sorted(found)]


def random_samples(count: int = RANDOM_STRINGS, seed: int = 7) -> list[str]:
    """Labelled random strings: hexadecimal in either case, letters and digits, base 64."""
    draw = random.Random(seed)
    alphabets = ("0123456789abcdef", "0123456789ABCDEF", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits, string.ascii_letters + string.digits + "_-")
    return ["".join(draw.choices(draw.choice(alphabets), k=draw.randint(16, 64))) for _ in range(count)]


def transitions(strings: list[str]) -> np.ndarray:
    """[symbols, symbols] counts of adjacent characters."""
    n = len(_SYMBOLS)
    code = _CODE[np.frombuffer("\n".join(strings).encode("ascii", "replace"), dtype=np.uint8)]
    a, b = code[:-1], code[1:]
    use = (a >= 0) & (b >= 0)
    return np.bincount(a[use] * n + b[use], minlength=n * n).reshape(n, n)


def log_ratio(random_counts: np.ndarray, ordinary_counts: np.ndarray, smoothing: float = 0.5) -> np.ndarray:
    """Per transition: the log-probability as random minus that as ordinary."""
    logs = []
    for counts in (random_counts, ordinary_counts):
        smooth = counts + smoothing
        logs.append(np.log(smooth / smooth.sum(axis=1, keepdims=True)))
    return logs[0] - logs[1]


def fit(samples: DataFrame) -> np.ndarray:
    """The log ratio of every transition, from rows (text, label): label 1 random, 0 ordinary.

    Null texts and labels are left out. Only sums of counts reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(_SYMBOLS), len(_SYMBOLS)), dtype=np.int64)
        for batch in batches:
            label = np.asarray(batch.column(1))
            texts = batch.column(0).to_pylist()
            for k in (0, 1):
                sums[k] += transitions([t for t, which in zip(texts, label, strict=True) if which == k])
        at = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel()[at])], names=["at", "n"])

    rows = samples.where(F.col("text").isNotNull() & F.col("label").isin(0, 1)).select("text", F.col("label").cast("long"))
    sums = np.zeros(2 * len(_SYMBOLS) ** 2)
    for at, n in rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n")).collect():  # at most 2 * 67**2 rows
        sums[at] = n
    ordinary, rand = sums.reshape(2, len(_SYMBOLS), len(_SYMBOLS))
    return log_ratio(rand, ordinary)


def corpus_samples(docs: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """(text, label) from the ``most`` documents that come first by a hash of the id.

    Ordinary: their words outside the patterns' spans, as written, in lower case and in upper case.
    Random: the patterns' secrets, and as many generated strings as ``RANDOM_STRINGS``.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = [], []
            for text in batch.column(0).to_pylist():
                text, at, plain, found = text or "", 0, [], []
                for _, start, end in base_spans(text):
                    found += _WORDS.findall(text[start:end])[-1:]
                    plain.append(text[at:start])
                    at = max(at, end)
                words = _WORDS.findall(" ".join([*plain, text[at:]]))
                for form in (words, map(str.lower, words), map(str.upper, words)):
                    texts.append("\n".join(form))
                    labels.append(0)
                texts += found
                labels += [1] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.int64())], names=["text", "label"])

    first = hashed_sample(docs.select("doc_id", "text"), most, ["doc_id", "text"]).select("text")
    rows = small_batches(first).mapInArrow(label, "text string, label long")
    made = docs.sparkSession.createDataFrame([(s, 1) for s in random_samples()], "text string, label long")
    return rows.unionByName(made)


def scored_runs(piece, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the runs of token characters that look random; bytes of the piece."""
    none = np.empty(0, np.int64)
    if not len(piece.data):
        return none, none, none
    code = _CODE[piece.data]
    edge = np.zeros(len(code) + 1, dtype=bool)
    edge[piece.offsets] = True
    inside = code >= 0
    starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
    use = ends - starts >= SHORTEST
    starts, ends = starts[use], ends[use]
    if not len(starts):
        return none, none, none
    digit = np.concatenate([[0], np.cumsum((piece.data >= 48) & (piece.data <= 57))])
    letter = np.concatenate([[0], np.cumsum(inside & (_CODE[piece.data] < 52))])
    step = np.zeros(len(code))
    both = inside[1:] & inside[:-1]
    step[1:][both] = ratio[code[:-1][both], code[1:][both]]
    total = np.concatenate([[0.0], np.cumsum(step)])
    # The first character of a run has no predecessor in it.
    score = total[ends] - total[starts + 1]
    mixed = (digit[ends] > digit[starts]) & (letter[ends] > letter[starts])
    high = (score >= LEAST_RATIO) & (letter[ends] > letter[starts]) & (mixed | (score >= LETTERS_RATIO * (ends - starts)))
    starts, ends = starts[high], ends[high]
    return starts, ends, np.searchsorted(piece.offsets, starts, side="right") - 1


def looks_random(run: str, ratio: np.ndarray) -> bool:
    """Whether a run of token characters would be reported if it stood alone."""
    return any(len(scored_runs(piece, ratio)[0]) for piece in pieces(pa.array([run])))


def all_spans(text: str, runs: list[tuple[int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """The patterns' spans, the runs that overlap none of them, and what is left of the others if it looks
    random by itself; by start and kind."""
    base = base_spans(text)
    extra = []
    for a, b in runs:
        over = [(start, end) for _, start, end in base if a < end and start < b]
        if not over:
            extra.append((3, a, b))
            continue
        at = a
        for start, end in [*sorted(over), (b, b)]:
            if start - at >= SHORTEST and looks_random(text[at:start], ratio):
                extra.append((3, at, start))
            at = max(at, end)
    return sorted(base + extra, key=lambda s: (s[1], s[0]))


def _scan(ratio: np.ndarray, consume):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for piece in pieces(texts):
                rows = []
                starts, ends, which = scored_runs(piece, ratio)
                runs: dict[int, list[tuple[int, int]]] = {}
                for a, b, i in zip(starts.tolist(), ends.tolist(), which.tolist(), strict=True):
                    begin = int(piece.offsets[i])
                    before = piece.data[begin:a]
                    at = a - begin - int(((before & 0xC0) == 0x80).sum())  # bytes to code points
                    runs.setdefault(i, []).append((at, at + b - a))
                for i, text in enumerate(texts.slice(piece.first, len(piece)).to_pylist()):
                    rows.append(consume(text, all_spans(text or "", runs.get(i, []), ratio)))
                yield consume.batch(batch.slice(piece.first, len(piece)), rows)

    return scan


class _Spans:
    """The spans of every text, beside the columns that came with it."""

    names = ("n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans")

    def __call__(self, text, spans):
        written = [f"{KINDS[k]}:{a}:{b}" for k, a, b in spans]
        base = ",".join(w for w, s in zip(written, spans, strict=True) if s[0] < 3)
        return (*(sum(s[0] == k for s in spans) for k in range(4)), hashlib.sha256(base.encode()).hexdigest(), ",".join(written))

    def batch(self, batch, rows):
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *self.names])


class _Redacted:
    """Every text with its spans replaced; of spans that overlap, the union is replaced once."""

    def __call__(self, text, spans):
        if text is None or not spans:
            return text
        out, at = [], 0
        for kind, start, end in spans:
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def batch(self, batch, rows):
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, batch.column(batch.num_columns - 1).type)], names=batch.schema.names)


def scan(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans: one row per document.

    Spans are kind:start:end in code points, end exclusive, sorted by start and then kind; the digest
    is over the patterns' spans alone. A null text counts as empty. Other columns are ignored.
    """
    kinds = ", ".join(f"{n} {'long' if n.startswith('n_') else 'string'}" for n in _Spans.names)
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_scan(ratio, _Spans()), f"doc_id long, {kinds}")


def redact(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """The documents with every secret replaced by its kind in brackets; rows and columns stay.

    An assignment is replaced whole, its key word included. A null text stays null.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = small_batches(docs).select(*others, "text")
    return rows.mapInArrow(_scan(ratio, _Redacted()), rows.schema).select(docs.columns)
