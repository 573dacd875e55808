"""Token counts by a two-tier look-up of pre-token lengths, without moving a pre-token.

A text's tokens are the sum over its pre-tokens, for no token crosses from one to the next. The lengths of the
``FREQUENT`` commonest pre-tokens of a bounded sample are broadcast as one compact table, from which
each worker builds a hash table. A pre-token it lacks is encoded by the tokenizer's own library, and
its length stays in the worker's cache of at most ``CACHED`` entries, which lives as long as the
process. Both tiers only save time: every count is the library's.

Pre-tokens are cut by the file's own pattern after lower-casing, where that is sure to give what the
library gives: in words of ``PLAIN`` characters, which neither normal form C nor the library's
lower-casing treats otherwise. Any other word (run of characters other than ASCII white space), and
one that may hold a special string, goes to the library whole and is cached in the same way.
"""

from __future__ import annotations

import json
import sys
import types
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import hashed_sample

LIMIT = 2048
SAMPLE_DOCS = 1000  # documents the frequent pre-tokens are taken from; any sample gives the same counts
FREQUENT = 16_384
CACHED = 200_000
CACHED_CHARS = 64  # longer pre-tokens are encoded each time
SLICE_CHARS = 1 << 20  # of a long text, what is cut into pre-tokens at once

# Ranges of characters that are their own normal form C and lower-cased one by one.
PLAIN = (
    (0x0000, 0x024F),  # Latin
    (0x0400, 0x052F),  # Cyrillic
    (0x2010, 0x2027),  # dashes and quotation marks
    (0x2030, 0x205E),  # more punctuation
    (0x3001, 0x3011),  # ideographic punctuation
    (0x3041, 0x3096),  # hiragana
    (0x30A1, 0x30FA),  # katakana
    (0x4E00, 0x9FA5),  # ideographs
    (0xAC00, 0xD7A3),  # hangul syllables
)
_SPACE = regex.compile(r"[\x20\x09-\x0D]+")


class _Cache(dict):
    """Piece -> length; a missing one is encoded, and kept while there is room."""

    def __init__(self, frequent: dict[str, int], encode: Callable[[str], int]):
        super().__init__(frequent)
        self.frequent, self.encode = frequent, encode

    def __missing__(self, piece: str) -> int:
        length = self.encode(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[piece] = length
        return length


class TokenCounter:
    """The two tiers of one worker process for one tokenizer file."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern, self.odd = split_pattern(path), odd_pattern(path)
        self.cache = _Cache(frequent, lambda s: len(self.tokenizer.encode(s, add_special_tokens=False).ids))

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens, and the odd words whole, of a text, slice by slice."""
        at = 0
        while at < len(text):
            cut = _SPACE.search(text, at + SLICE_CHARS) if len(text) - at > SLICE_CHARS else None
            to = cut.start() if cut else len(text)
            part, at = text[at:to] if to - at < len(text) else text, to
            if self.odd.search(part):
                words = _SPACE.split(part)
                odd = [w for w in words if self.odd.search(w)]
                yield odd
                part = " ".join([w for w in words if not self.odd.search(w)])
            yield self.pattern.findall(part.lower())

    def count(self, text: str | None) -> int:
        return sum(sum(map(self.cache.__getitem__, found)) for found in self.pieces(text or ""))


def split_pattern(path: str):
    """The pre-token pattern of a tokenizer file that normalises and splits as this module assumes."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    steps = [s["type"] for s in (rules["normalizer"] or {}).get("normalizers", [])]
    cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    cut = cuts[0]
    if steps != ["NFC", "Replace", "Lowercase"] or cut.get("type") != "Split" or cut.get("behavior") != "Removed" or not cut.get("invert"):
        raise ValueError(f"{path}: not a tokenizer of lower-cased, separately encoded pre-tokens")
    return regex.compile(cut["pattern"]["Regex"])


def odd_pattern(path: str):
    """Finds what makes a word odd: a character beyond ``PLAIN`` or the beginning of a special string."""
    with open(path, encoding="utf-8") as file:
        special = sorted({t["content"][:2] for t in json.load(file)["added_tokens"]})
    plain = "".join(f"{regex.escape(chr(a))}-{regex.escape(chr(b))}" if a else f"\\x00-{chr(b)}" for a, b in PLAIN)
    return regex.compile("|".join([f"[^{plain}]", *map(regex.escape, special)]))


def _worker(path: str, name: str, frequent: Callable[[], dict[str, int]]) -> TokenCounter:
    """The counter of this process. This package travels by value, so its own globals last one task only."""
    kept = sys.modules.setdefault("_stayline_worker", types.ModuleType("_stayline_worker")).__dict__
    if kept.get("counter", (None,))[0] != (path, name):
        kept["counter"] = ((path, name), TokenCounter(path, frequent()))
    return kept["counter"][1]


def frequent_lengths(docs: DataFrame, path: str, sample: int = SAMPLE_DOCS, most: int = FREQUENT) -> dict[str, int]:
    """The commonest pre-tokens of at most ``sample`` documents and their lengths, counted in one task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = _worker(path, "", dict), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for found in counter.pieces(text or ""):
                    seen.update(found)
        common = [p for p, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most] if len(p) <= CACHED_CHARS]
        yield pa.RecordBatch.from_pydict({"piece": pa.array(common, pa.string()), "length": pa.array([counter.cache[p] for p in common], pa.int32())})

    rows = hashed_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")), sample, ["doc_id"])
    return dict(rows.coalesce(1).mapInArrow(count, "piece string, length int").collect())


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens): one row per document.

    ``path`` names a tokenizer file, which every worker can read. Tokens are the library's, without
    begin, end or added special tokens; a special string inside a text is one token, as by its
    default. A null text counts as empty. Rows that share a doc_id, or have none, are counted each;
    other columns are ignored.
    """
    lengths = frequent_lengths(docs, path)
    # One string and one array: smaller on the wire than a table of objects. No pre-token holds a line end.
    packed = docs.sparkSession.sparkContext.broadcast(("\n".join(lengths).encode(), list(lengths.values())))
    name = uuid.uuid4().hex

    def unpacked() -> dict[str, int]:
        text, values = packed.value
        return dict(zip(text.decode().split("\n"), values)) if values else {}

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _worker(path, name, unpacked)
        for batch in batches:
            yield pa.array([counter.count(text) for text in batch.to_pylist()], pa.int64())

    text = F.col("text").cast("string")
    found = docs.select(
        "doc_id",
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.arrow_udf(count, "long")(text).alias("n_tokens"),
    )
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
