"""Language-model scores by a weighted backoff automaton over n-grams of the whole training corpus.

Model: hierarchical Dirichlet smoothing. With c the training counts and h' the context h without its
first word, p(w | h) = (c(hw) + K p(w | h')) / (c(h) + K), down to the unigram (c(w) + 0.5) / (N + 0.5 (V + 1)).
As an automaton: a state is a context that was seen; a seen n-gram is an arc with that weight; the
failure arc of a state leads to its shorter context with weight K / (c(h) + K). Reading a text from left
to right the state is the longest seen context, and the log weights of arcs and failure arcs add up.
States and arcs are never objects: ``automaton_paths`` works out the weights for all tokens of a block
as arrays, one order after the other, which gives the same sums as the walk.

The corpus's n-grams do not fit into one process, so every block of documents gets its own part:
1. A block's distinct n-gram hashes go, with their training counts in the block, to the shards of the
   hash range, as one binary message per block and shard.
2. A shard adds up the counts of equal hashes over all blocks and answers every message with the
   totals, in the same order, and with the training words and types it holds.
3. A block reads its texts again, has the automaton's weights for all of its n-grams, and scores.
A frequent n-gram is one entry per block, and a shard or block has a fixed size, so no task grows.

All of that is one query, in which the texts are moved to their blocks once, compressed: both readings of a block
are of the same shuffle. The hashes of a message are sorted: five bytes of each are sent as they are, and of the
other three the steps from one hash to the next, compressed, which are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.words import mix, pieces, word_hashes

ORDER = 3  # words in the longest n-gram
CONCENTRATION = 4.0  # K
BLOCK_BYTES = 8 << 20
LOW_BYTES = 5  # of a hash, sent as they are

START, END = np.uint64(0x51A27), np.uint64(0xE4D)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every text, each followed by the end token, and the index of the text."""
    words, which = [], []
    for piece in pieces(texts):
        hashes, text = word_hashes(piece)
        words.append(hashes)
        which.append(text + piece.first)
    words.append(np.full(len(texts), END))
    which.append(np.arange(len(texts)))
    words, which = np.concatenate(words), np.concatenate(which)
    order = np.argsort(which, kind="stable")  # the ends come last of each text
    return words[order], which[order]


def _tagged(hashes: np.ndarray, tag: int) -> np.ndarray:
    """The lowest bit tells words (1) from longer n-grams (0)."""
    return (mix(hashes) & ~np.uint64(1)) | np.uint64(tag)


def entries(words: np.ndarray, text: np.ndarray, order: int) -> list[np.ndarray]:
    """The model's entries at every token: for n = 1 .. order the n-gram that ends there.

    Before the first token stands one start. An n-gram that would reach beyond it is marked by 0.
    Contexts need no entries: a token follows every word, so a context was seen as often as the
    n-gram of its words, which ends one token earlier.
    """
    n, place = len(words), places(text)
    out, total = [_tagged(words, 1)], np.zeros(n, dtype=np.uint64)
    for back in range(1, order):
        earlier = np.zeros(n, dtype=np.uint64)
        earlier[back:] = words[: max(0, n - back)]
        total = total * np.uint64(0x9E3779B97F4A7C15) + np.where(place >= back, earlier, START) + np.uint64(back)
        hashes = _tagged(total * np.uint64(0xD6E8FEB86659FD93) + words, 0)
        out.append(np.where(place >= back - 1, hashes, np.uint64(0)))
    return out


def places(text: np.ndarray) -> np.ndarray:
    """The place of every token in its text, from 0."""
    return np.arange(len(text)) - np.searchsorted(text, text)


def _zipped(data: bytes) -> bytes:
    """Compressed, behind its length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _zip_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([_zipped(text) for text in batch.cast(pa.large_binary()).to_pylist()], pa.binary())


def _texts(group: pa.Table) -> pa.Array:
    return pa.array([_unzipped(data) for data in group.column("text").to_pylist()], pa.large_binary())


def _messages(order: int, shard_bits: int):
    def send(key: tuple, group: pa.Table) -> pa.Table:
        """A block in; shard, block, hashes and counts out, for every shard, since each answers with its words and types."""
        block = key[0].as_py()
        words, text = tokens(_texts(group))
        parts = entries(words, text, order)
        learn = ~np.asarray(group.column("held_out"))[text]
        learnt, times = np.unique(np.concatenate([p[learn] for p in parts]), return_counts=True)
        every = _without_mark(_distinct(np.concatenate([learnt, *(p[~learn] for p in parts)])))
        times, learnt = times[len(learnt) - len(_without_mark(learnt)) :], _without_mark(learnt)
        counts = np.zeros(len(every), dtype=np.int64)
        counts[np.searchsorted(every, learnt)] = times
        edges = np.arange(1 << shard_bits, dtype=np.uint64) << np.uint64(64 - shard_bits) if shard_bits else np.zeros(1, np.uint64)
        cuts = np.append(np.searchsorted(every, edges), len(every))
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        sent = [_sorted_packed(every[a:b]) for a, b in spans]
        return pa.table(
            {
                "shard": pa.array(range(len(spans)), pa.int64()),
                "block": pa.array([block] * len(spans), pa.int64()),
                "low": pa.array([low for low, _ in sent], pa.binary()),
                "high": pa.array([high for _, high in sent], pa.binary()),
                "counts": pa.array([_zipped(_packed(counts[a:b])) for a, b in spans], pa.binary()),
            }
        )

    return send


def _sorted_packed(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending hashes as their five lowest bytes each, and the steps between the numbers above these."""
    low = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES]
    high = (hashes >> np.uint64(8 * LOW_BYTES)).astype(np.int64)
    return low.tobytes(), _zipped(_packed(np.diff(high, prepend=0)))


def _sorted_unpacked(low: bytes, high: bytes) -> np.ndarray:
    out = np.zeros((len(low) // LOW_BYTES, 8), np.uint8)
    out[:, :LOW_BYTES] = np.frombuffer(low, np.uint8).reshape(-1, LOW_BYTES)
    steps = _unpacked(_unzipped(high), len(out))
    return out.view("<u8").ravel().astype(np.uint64) | np.cumsum(steps).astype(np.uint64) << np.uint64(8 * LOW_BYTES)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """The different hashes, ascending; sorting takes a tenth of the time of the table behind ``np.unique``."""
    ordered = np.sort(hashes)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


def _without_mark(every: np.ndarray) -> np.ndarray:
    return every[1:] if len(every) and every[0] == 0 else every


def _packed(counts: np.ndarray) -> bytes:
    """One byte for counts under 255; the others follow as eight bytes each, in order."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, dtype=np.uint8, count=n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, dtype=np.int64, offset=n)
    return counts


def _answer(key: tuple, group: pa.Table) -> pa.Table:
    """All messages of a shard in; block, shard, totals, and the shard's training words and types out."""
    hashes = [_sorted_unpacked(*parts) for parts in zip(group.column("low").to_pylist(), group.column("high").to_pylist(), strict=True)]
    counts = [_unpacked(_unzipped(b), len(h)) for b, h in zip(group.column("counts").to_pylist(), hashes, strict=True)]
    every, which = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(which, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)
    of_words = totals[(every & np.uint64(1)) == 1]
    ends = np.cumsum([len(h) for h in hashes])
    replies = [_zipped(_packed(totals[which[e - len(h) : e]])) for e, h in zip(ends, hashes, strict=True)]
    return pa.table(
        {
            "block": group.column("block"),
            "shard": group.column("shard"),
            "n": pa.array([len(h) for h in hashes], pa.int64()),
            "totals": pa.array(replies, pa.binary()),
            "words": pa.array([int(of_words.sum())] * len(hashes), pa.int64()),
            "types": pa.array([int((of_words > 0).sum())] * len(hashes), pa.int64()),
        }
    )


def automaton_paths(
    counts: list[np.ndarray], place: np.ndarray, size: int, vocabulary: int, concentration: float
) -> np.ndarray:
    """log10 weight of the path that reads each token, from the training counts of its entries.

    Tokens stand in the order of reading, so the state at a token is what was read before it. The path
    takes failure arcs from the state, the longest seen context, down to the first context that has
    an arc for the token. An unseen context is no state: its failure arc weighs 1. The start was
    seen once in every training text, as often as the end, which is the last token here.
    """
    path = np.log10((counts[0] + 0.5) / (size + 0.5 * (vocabulary + 1)))
    for n, seen in enumerate(counts[1:]):
        through = np.empty(len(seen))
        through[1:] = counts[n][:-1]
        through[place == 0] = counts[0][-1] if n == 0 and len(seen) else 0
        failure = np.log10(concentration / (through + concentration))
        arc = np.log10(seen + concentration * 10.0**path) - np.log10(through + concentration)
        path = np.where(seen > 0, arc, failure + path)
    return path


def _score(order: int, concentration: float):
    def score(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        # Every shard has answered, so these are the words and types of all training texts.
        size, vocabulary = (sum(replies.column(name).to_pylist()) for name in ("words", "types"))
        words, text = tokens(_texts(docs))
        parts = entries(words, text, order)
        every, where = np.unique(np.concatenate(parts), return_inverse=True)
        sizes, packed = replies.column("n").to_pylist(), replies.column("totals").to_pylist()
        by_shard = np.argsort(np.asarray(replies.column("shard")), kind="stable")
        mark = len(every) - len(_without_mark(every))
        totals = np.concatenate([np.zeros(mark, np.int64), *(_unpacked(_unzipped(packed[i]), sizes[i]) for i in by_shard)])
        counts = np.split(totals[where].astype(np.float64), len(parts))
        path = automaton_paths(counts, places(text), size, vocabulary, concentration)
        base = np.log10((counts[0] + 0.5) / (size + 0.5 * (vocabulary + 1)))
        n = len(docs)
        add = lambda w: np.bincount(text, weights=w, minlength=n)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                "n_known": pa.array(add(counts[0] > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(n, size, np.int64)),
                "base_score": pa.array(add(base)),
                "score": pa.array(add(path)),
            }
        )

    return score


def held_out(part: int = 5, which: int = 1) -> Column:
    """Whether a document is kept from training, by checksum of its id; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % part == which


def score_documents(docs: DataFrame, order: int = ORDER, concentration: float = CONCENTRATION, test: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    Tokens are the words, A-Z lower-cased, and one end token, which counts as a token; a null text is
    empty and has the end alone. Documents for which ``test`` holds are scored and not learnt from.
    Rows that share a doc_id are separate documents. Other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), (held_out() if test is None else test).alias("held_out")
    )
    about = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    blocks = max(1, -(-((about["bytes"] or 0) + 8 * about["n"]) // BLOCK_BYTES))
    shard_bits = max(0, (2 * blocks - 1).bit_length())
    block = F.expr(f"pmod(xxhash64(doc_id, text), {blocks}L)")
    dealt = rows.select("doc_id", "held_out", block.alias("block"), F.arrow_udf(_zip_texts, "binary")("text").alias("text"))
    sent = dealt.groupBy("block").applyInArrow(_messages(order, shard_bits), "shard long, block long, low binary, high binary, counts binary")
    kinds = "block long, shard long, n long, totals binary, words long, types long"
    replies = sent.groupBy("shard").applyInArrow(_answer, kinds)
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_score(order, concentration), result)
