"""Benchmark decontamination by template windows: questions are found with other numbers, names or units.

A text becomes a sequence of typed tokens. Marks around a word are dropped; what starts with a digit
becomes a number, a unit after a number a unit, a capitalised word inside a sentence a name; any other
word is itself, lower-cased. Windows of ``WINDOW`` tokens of benchmark items and documents are joined
by hash. Along one alignment of a document with an item every value of the item must have become one
and the same value of the document; windows with a value that breaks this do not count.

A window with few plain words says too little without its values: it is joined on the hash of its
tokens as they are, so exact copies are found and other values are not. A capitalised word is a name
only inside a sentence, and where a text is cut or quoted its first word may be either; so the first
token of every window, if capitalised, stands both as the word and as a name, on both sides.

Documents first pass a bitmap of the benchmark's window hashes, of fixed size however large the
benchmark: what it lets through by chance the join drops.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import keep, small_batches
from stayline.llm.words import LOWER, Piece, mix, pieces, span_hashes, word_spans

WINDOW = 8
LITERALS = 4  # least plain words in a window; with fewer its tokens are compared as they are
SHORTEST = 5  # an item of fewer tokens is compared as it is, if it has a value and another token
NEEDED = 3  # windows that make a leak, or all of a shorter item
BITMAP_BITS = 22

# Units that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce ounces ml l "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years percent % usd eur gbp dollar dollars cent cents euro euros mph kmh w kw kwh v a hz j c f k"
).split()

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_UNIT_HASHES = np.sort(
    np.concatenate([span_hashes(b, np.array([0]), np.array([len(b)])) for b in (np.frombuffer(u.encode(), np.uint8) for u in UNITS)])
)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_EXACT = np.uint64(0x5A5A5A5A5A5A5A5A)  # tells hashes of tokens as they are from hashes of templates
NUMBER, NAME, UNIT = (np.uint64(0x1111), np.uint64(0x2222), np.uint64(0x3333))


def tokens(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word that holds a letter or digit: template hash, value hash, whether a slot, text."""
    return _typed(piece)[:4]


def _typed(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same, and whether a word would be a name inside a sentence."""
    none = np.empty(0, np.uint64)
    starts, ends, text = word_spans(piece)
    if not len(starts):
        return none, none, np.empty(0, bool), np.empty(0, np.int64), np.empty(0, bool)
    data = piece.data
    where = np.arange(len(data))
    alnum = _ALNUM[data]
    following = np.minimum.accumulate(np.where(alnum, where, len(data))[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(alnum, where, -1))
    first, last = following[starts], preceding[ends - 1] + 1
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(starts), dtype=bool)  # first of a text, a line or a sentence
    opens[1:] = (text[1:] != text[:-1]) | _STOP[data[ends[:-1] - 1]] | (lines[starts[1:]] != lines[starts[:-1]])
    use = first < last
    first, last, text, opens = first[use], last[use], text[use], opens[use]
    if not len(first):
        return none, none, np.empty(0, bool), np.empty(0, np.int64), np.empty(0, bool)
    low = LOWER[data]
    accented = np.zeros(len(data), dtype=bool)  # the second byte of an upper-case Latin-1 letter
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[accented] += 0x20
    value = span_hashes(low, first, last)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data] | accented)])
    head = _UPPER[data[first]] | ((data[first] == 0xC3) & accented[np.minimum(first + 1, len(data) - 1)])
    number = (data[first] >= 48) & (data[first] <= 57)
    after_number = np.concatenate([[False], number[:-1] & (text[1:] == text[:-1])])
    unit = after_number & np.isin(value, _UNIT_HASHES)
    capital = head & (upper[last] - upper[first] == 1) & (last - first > 1 + (data[first] == 0xC3))
    name = capital & ~opens
    slot = number | unit | name
    template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    return template, value, slot, text, capital & ~number & ~unit


_ODD = np.uint64(0xD6E8FEB86659FD93)


def windows(piece: Piece, lengths: list[int], every: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every length: length, first token, form, window hash, text, and all tokens' values and slots.

    The forms: 0 the template, 1 the template with its capitalised first token taken the other way, 2
    the tokens as they are. Items have form 2 where the plain words are too few in form 0 or 1, which
    depends on the words around; documents have it for every window.
    """
    template, value, slot, text, capital = _typed(piece)
    before = np.concatenate([[0], np.cumsum(slot)])
    for size in lengths:
        n = len(template) - size + 1
        if n <= 0:
            continue
        total, same = np.full(n, size, dtype=np.uint64), np.full(n, size, dtype=np.uint64)
        for k in range(size):
            total = total * _ODD + template[k : n + k]
            same = same * _ODD + value[k : n + k]
        inside = text[size - 1 :] == text[:n]
        literals = size - (before[size:] - before[:n])
        least = min(LITERALS, size) if size >= SHORTEST else size + 1
        own = np.flatnonzero(inside & (literals >= least))
        other = np.flatnonzero(inside & capital[:n] & (literals + np.where(slot[:n], 1, -1) >= least))
        turned = np.where(slot[other], value[other], NAME) - template[other]
        turned = total[other] + turned * np.uint64(pow(int(_ODD), size - 1, 1 << 64))
        few = literals - (capital[:n] & ~slot[:n]) < least if size >= SHORTEST else (literals < size) & (size > 1)
        exact = np.flatnonzero(inside & (every | few))
        at = np.concatenate([own, other, exact])
        form = np.repeat([0, 1, 2], [len(own), len(other), len(exact)])
        yield size, at, form, np.concatenate([mix(total[own]), mix(turned), mix(same[exact] ^ _EXACT)]), text[at], value, slot


_ROW = "row_id long, row_key long, pos long, size int, window long, slots array<long>"


def _find(lengths: list[int], bitmap: np.ndarray | None):
    """Rows id, key, text in; windows out: all of them, or those whose bit is set."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("row_id", pa.int64()), ("row_key", pa.int64()), ("pos", pa.int64()), ("size", pa.int32()), ("window", pa.int64()), ("slots", pa.list_(pa.int64()))]
        )
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for piece in pieces(batch.column(2)):
                for size, at, form, window, text, value, slot in windows(piece, lengths, bitmap is not None):
                    if bitmap is not None:
                        bit = window >> np.uint64(64 - BITMAP_BITS)
                        hit = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                        at, form, window, text = at[hit], form[hit], window[hit], text[hit]
                    if not len(at):
                        continue
                    grid = at[:, None] + np.arange(size)
                    is_slot = slot[grid] | (form == 2)[:, None]
                    is_slot[form == 1, 0] ^= True
                    edges = np.concatenate([[0], np.cumsum(is_slot.sum(axis=1))])
                    lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(value[grid][is_slot].view(np.int64)))
                    which = pa.array(piece.first + text)
                    columns = [ids.take(which).cast(pa.int64()), keys.take(which), pa.array(at), pa.array(np.full(len(at), size, np.int32)), pa.array(window.view(np.int64)), lists]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return find


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1)):
            _, _, _, text = tokens(piece)
            n = np.bincount(text, minlength=len(piece)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.first, len(piece)).cast(pa.int64()), pa.array(n)], names=["item_id", "n_tokens"])


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """item_id, item_pos, size, window, item_slots, item_windows; and the sizes there are.

    An item of fewer tokens than a window is one window as a whole; below ``SHORTEST`` it is compared as it
    is if it has a value and another token, and left out if not. ``item_windows`` counts places with a
    template, or all places of an item that has none.
    """
    named = items.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    counts = named.mapInArrow(_token_counts, "item_id long, n_tokens long").groupBy("item_id").agg(F.max("n_tokens").alias("n"))
    short = [r[0] for r in counts.where(f"n >= 2 and n < {window}").select(F.col("n").cast("int")).distinct().collect()]
    lengths = sorted({*short, window})
    rows = named.select("item_id", F.lit(0).cast("long").alias("key"), "text")
    found = rows.mapInArrow(_find(lengths, None), _ROW).withColumnRenamed("row_id", "item_id")
    found = found.join(counts, "item_id").where(f"size = {window} or (size = n and pos >= 0)")
    found = found.select("item_id", F.col("pos").alias("item_pos"), "size", "window", F.col("slots").alias("item_slots")).distinct()
    # Of a window that is compared as it is every token is a slot; a template has plain words.
    places = F.countDistinct(F.when(F.size("item_slots") < F.col("size"), F.col("item_pos")))
    total = found.groupBy("item_id").agg(places.alias("places"), F.countDistinct("item_pos").alias("every"))
    total = total.select("item_id", F.when(F.col("places") > 0, F.col("places")).otherwise(F.col("every")).alias("item_windows"))
    return found.join(total, "item_id"), lengths


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, needed: int = NEEDED) -> DataFrame:
    """doc_id, doc_key, item_id, n_windows, item_windows, reparameterised: one row per leak.

    ``doc_key`` is xxhash64 of the text, which tells rows without an id apart. Null and blank texts,
    and items that are null, blank or left out by ``benchmark_windows``, match nothing. Rows that share id and text count as one document. Other columns are ignored.
    """
    found, lengths = benchmark_windows(items, window)
    found = keep(found, "benchmark")
    word = F.expr(f"shiftrightunsigned(window, {64 - BITMAP_BITS + 6})")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(window, {64 - BITMAP_BITS}) & 63 as int))")
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    words = found.groupBy(word.alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()  # at most 65,536 rows
    bitmap[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    hits = rows.mapInArrow(_find(lengths, bitmap.view(np.uint64)), _ROW)
    hits = hits.withColumnsRenamed({"row_id": "doc_id", "row_key": "doc_key", "slots": "doc_slots"})
    matched = hits.join(found, ["size", "window"]).withColumn("shift", F.col("pos") - F.col("item_pos"))
    run = ["doc_id", "doc_key", "item_id", "shift"]
    pairs = F.arrays_zip("item_slots", "doc_slots")
    values = matched.where(F.size("item_slots") > 0).select(*run, F.explode(pairs).alias("p"))
    values = values.groupBy(*run, F.col("p.item_slots").alias("from")).agg(F.min("p.doc_slots").alias("a"), F.max("p.doc_slots").alias("b"))
    judged = values.groupBy(*run).agg(
        F.collect_set(F.when(F.col("a") != F.col("b"), F.col("from"))).alias("broken"),
        F.max((F.col("a") != F.col("from")) | (F.col("b") != F.col("from"))).alias("changed"),
    )
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"j.{c}")) for c in run]
    checked = matched.alias("m").join(judged.alias("j"), same, "left")
    sound = ~F.coalesce(F.arrays_overlap(F.col("m.item_slots"), F.col("j.broken")), F.lit(False))
    checked = checked.where(sound)
    return (
        checked.groupBy(*[F.col(f"m.{c}") for c in run[:3]])
        .agg(
            F.countDistinct("m.item_pos").alias("n_windows"),
            F.max("m.item_windows").alias("item_windows"),
            F.max(F.coalesce(F.col("j.changed"), F.lit(False))).alias("reparameterised"),
        )
        .where(F.col("n_windows") >= F.least(F.lit(needed), F.col("item_windows")))
    )


def decontaminate(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents without those that leak a benchmark item; columns and other rows stay as they are."""
    found = leaks(docs, items, **settings).select(F.col("doc_id").alias("_leak_id"), F.col("doc_key").alias("_leak_key")).distinct()
    on = docs["doc_id"].cast("long").eqNullSafe(F.col("_leak_id")) & (F.xxhash64(docs["text"]) == F.col("_leak_key"))
    return docs.join(found, on, "left_anti")
