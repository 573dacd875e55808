"""Ranked lexical search with MaxScore over pairs of terms.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are
lower-cased. A document's score for a query is a sum of integer impacts, one per term they share.

The index is a stored table with a row for every block of ``BLOCK`` documents. A block holds, for every term of
the vocabulary, the list of its documents with their impacts and the list's largest impact, and, for chosen pairs
of terms, the list of the documents that hold both and the largest sum of two impacts in it. A
document earns from a pair at most the largest of that joint maximum and the two single ones, which is
less than the sum of the single ones wherever the terms' best documents differ.

A query sorts its terms by their own bounds. What the weakest of them add together is bounded with the pairs
among them; as long as that stays below the score that the query's k-th best document is known to
reach, they cannot lift a document over it by themselves, and their lists are not read for candidates. A
stronger term that suffices only together with its weaker partner gives the documents of their intersection
list, any other its whole list. The candidates are then scored term by term, best bound first, and
after each the documents fall away whose score plus the bound of the rest, again with its pairs, is too low.
All bounds hold for every document, so nothing is lost.

Queries come in blocks of a bounded number of terms; each block of queries passes over the documents
once. The scores to beat are first taken from a few blocks of documents and then rise as a task goes on.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.store import keep, small_batches

K = 20
BLOCK = 4096  # documents of an index block
QUERY_TERMS = 1 << 17  # term occurrences in a block of queries, about; a longer query has a block to itself
PAIRS = 1 << 13  # pairs of a block of queries that have lists; the terms of further ones are bounded singly
FIRST_BLOCKS = 4  # the first scores to beat are taken from the first block of so many tasks
SLICE_BYTES = 1 << 22  # of a long text, what is cut into terms at once

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERM)
    at = 0
    while at < len(data):
        to = data.find(b" ", at + SLICE_BYTES) if len(data) - at > SLICE_BYTES else -1
        to = len(data) if to < 0 else to
        yield data[at:to].split()
        at = to


def term_counts(text: str | None) -> Counter:
    found: Counter = Counter()
    for some in terms(text):
        found.update(some)
    return found


# --- scores ----------------------------------------------------------------------------------


def weight(n_docs: int, df: int) -> int:
    """Rarer terms weigh more: 1000 times a logarithm, rounded down."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score, in whole numbers: long documents count for less."""
    m = 75 + (25 * length * n_docs) // max(n_terms, 1)
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


# --- queries ---------------------------------------------------------------------------------


@dataclass
class Queries:
    """Some queries over one vocabulary; plain lists and arrays, so that workers need nothing else."""

    vocabulary: dict[bytes, int]
    #: per query, in the order of the terms' numbers: (numbers, how often each occurs)
    wanted: list[tuple[np.ndarray, np.ndarray]]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    #: per query: the numbers of its pairs; no term is in two of them
    plans: list[list[int]] = field(default_factory=list)

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        counts = [term_counts(text) for text in texts]
        names = sorted(set().union(*counts)) if counts else []
        number = {name: i for i, name in enumerate(names)}
        wanted = []
        for found in counts:
            ids = sorted((number[t], n) for t, n in found.items())
            wanted.append((np.array([i for i, _ in ids], np.int64), np.array([n for _, n in ids], np.int64)))
        return cls(number, wanted)

    def pair_up(self, df: np.ndarray) -> None:
        """Pairs each query's terms by their frequency, the two commonest first: their lists are the longest
        and overlap the most, so a joint maximum says most about them. Queries share their pairs."""
        chosen = []
        for ids, _ in self.wanted:
            order = sorted((int(t) for t in ids if df[t]), key=lambda t: (-df[t], t))
            chosen.append([(min(p), max(p)) for p in zip(order[::2], order[1::2])])
        every = {pair for pairs in chosen for pair in pairs}
        self.pairs = sorted(every, key=lambda p: (-min(df[p[0]], df[p[1]]), p))[:PAIRS]
        number = {pair: i for i, pair in enumerate(self.pairs)}
        self.plans = [[number[p] for p in pairs if p in number] for pairs in chosen]


# --- the index -------------------------------------------------------------------------------

_INDEX = (
    "part int, nth int, docs array<long>, begin array<int>, doc array<int>, impact array<long>, most array<long>,"
    " pair_begin array<int>, pair_doc array<int>, joint array<long>"
)


@dataclass
class Block:
    """A row of the index. Documents are numbered within the block."""

    docs: pa.Array  # their ids
    begin: np.ndarray  # where each term's list begins, and the end of the last
    doc: np.ndarray
    impact: np.ndarray
    most: np.ndarray  # per term
    pair_begin: np.ndarray
    pair_doc: np.ndarray
    joint: np.ndarray  # per pair

    @classmethod
    def of(cls, docs: pa.Array, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int, pairs: list[tuple[int, int]]) -> Block:
        order = np.lexsort((doc, term))
        most = np.zeros(n_terms, np.int64)
        np.maximum.at(most, term, impact)
        begin = np.searchsorted(term[order], np.arange(n_terms + 1))
        none = np.zeros(1, np.int64)
        block = cls(docs, begin, doc[order], impact[order], most, none, none[:0], none[:0])
        both = [block._intersect(a, b) for a, b in pairs]
        block.pair_begin = np.cumsum([0] + [len(found) for found, _ in both])
        block.pair_doc = np.concatenate([found for found, _ in both]) if both else none[:0]
        block.joint = np.array([joint for _, joint in both], np.int64)
        return block

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.begin[term], self.begin[term + 1])
        return self.doc[part], self.impact[part]

    def both(self, pair: int) -> np.ndarray:
        return self.pair_doc[self.pair_begin[pair] : self.pair_begin[pair + 1]]

    def look_up(self, term: int, docs: np.ndarray) -> np.ndarray:
        """The term's impact in each of these documents, 0 where it does not occur."""
        mine, impact = self.list_of(term)
        if not len(mine):
            return np.zeros(len(docs), np.int64)
        at = np.searchsorted(mine, docs)
        at[at == len(mine)] = 0
        return np.where(mine[at] == docs, impact[at], 0)

    def _intersect(self, a: int, b: int) -> tuple[np.ndarray, int]:
        """The documents that hold both terms, and the largest sum of the two impacts."""
        short, other = (a, b) if self.begin[a + 1] - self.begin[a] <= self.begin[b + 1] - self.begin[b] else (b, a)
        docs, impact = self.list_of(short)
        beside = self.look_up(other, docs)
        held = beside > 0
        return docs[held], int((impact[held] + beside[held]).max(initial=0))


@dataclass
class Work:
    """How many list entries were read, of how many the queries' lists hold."""

    read: int = 0
    of: int = 0


class _Bounds:
    """What a document can earn from some of a query's terms, weakest first: at most ``most[i]`` from the first i."""

    def __init__(self, block: Block, often: dict[int, int], partner: dict[int, tuple[int, int]], chosen: list[int]):
        self.terms, self.most, self.apart = chosen, [0], []
        single, seen = {t: int(block.most[t]) * often[t] for t in chosen}, set()
        for t in chosen:
            other, pair = partner.get(t, (None, -1))
            #: bound of the documents that hold this term and some before it, but not its partner
            self.apart.append(self.most[-1] - single.get(other, 0) * (other in seen) + single[t])
            if other in seen:
                # Terms that the query repeats: what the two share of the repeats goes by the joint maximum.
                shared = min(often[t], often[other])
                both = shared * int(block.joint[pair]) + (often[t] - shared) * int(block.most[t]) + (often[other] - shared) * int(block.most[other])
                bound = max(single[t], single[other], min(both, single[t] + single[other]) if len(block.both(pair)) else 0)
                self.most.append(self.most[-1] - single[other] + bound)
            else:
                self.most.append(self.apart[-1])
            seen.add(t)


def search_block(
    block: Block, query: tuple[np.ndarray, np.ndarray], plan: list[int], pairs: list[tuple[int, int]], least: int, work: Work | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the block that score ``least`` or more, and at least 1, with their whole scores."""
    often = dict(zip(query[0].tolist(), query[1].tolist(), strict=True))
    partner = {t: (other, pair) for pair in plan for t, other in (pairs[pair], pairs[pair][::-1])}
    order = sorted((t for t in often if block.most[t]), key=lambda t: (int(block.most[t]) * often[t], t))
    bounds = _Bounds(block, often, partner, order)
    least = max(least, 1)
    score = np.zeros(len(block.docs), np.int64)
    candidate = np.zeros(len(block.docs), bool)
    read = 0
    rest = list(order)
    for i in range(len(order) - 1, -1, -1):
        if bounds.most[i + 1] < least:
            break
        docs, impact = block.list_of(order[i])
        # An intersection list names candidates only, whose impacts are looked up later: that has to pay.
        both = block.both(partner[order[i]][1]) if bounds.apart[i] < least else docs
        if 2 * len(both) >= len(docs):
            score[docs] += impact * often[order[i]]
            rest.remove(order[i])
        else:
            docs = both
        candidate[docs] = True
        read += len(docs)
    left = np.flatnonzero(candidate)
    mine = score[left]
    bounds = _Bounds(block, often, partner, rest)
    for i in range(len(rest), -1, -1):
        kept = mine + bounds.most[i] >= least
        left, mine = left[kept], mine[kept]
        if not len(left) or not i:
            break
        mine = mine + block.look_up(rest[i - 1], left) * often[rest[i - 1]]
        read += min(len(left), int(block.begin[rest[i - 1] + 1] - block.begin[rest[i - 1]]))
    if work:
        work.read += read
        work.of += sum(int(block.begin[t + 1] - block.begin[t]) for t in often)
    return left, mine


# --- jobs ------------------------------------------------------------------------------------


def occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """n, terms, tfs of every document with its identity: terms of the vocabulary by number."""
    names = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = names.value
        for batch in batches:
            n, found, tfs, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                total, mine = 0, Counter()
                for some in terms(text):
                    total += len(some)
                    mine.update(filter(lambda i: i is not None, map(known.get, some)))
                n.append(total)
                found.append(list(mine))
                tfs.append(list(mine.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return small_batches(rows).mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``BLOCK`` rows; the last is shorter."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = BLOCK - sum(b.num_rows for b in waiting)
            waiting.append(batch.slice(0, room))
            batch = batch.slice(min(room, batch.num_rows))
            if sum(b.num_rows for b in waiting) == BLOCK:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def build_block(rows: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int, pairs: list[tuple[int, int]]) -> Block:
    term = rows.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = rows.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = rows.column("terms").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(rows.num_rows), sizes)
    length = rows.column("n").to_numpy(zero_copy_only=False)[doc]
    return Block.of(rows.column("doc_id"), term, doc, impacts(weights[term], tf, length, n_docs, n_terms), len(weights), pairs)


def build_index(rows: DataFrame, shared) -> DataFrame:
    """A row per block of documents: its lists, intersection lists and maxima."""
    names = [part.split()[0] for part in _INDEX.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, n_docs, n_terms = shared.value
        part = TaskContext.get().partitionId()
        for nth, some in enumerate(_blocks(batches)):
            block = build_block(some, weights, n_docs, n_terms, queries.pairs)
            kinds = dict.fromkeys(("begin", "doc", "pair_begin", "pair_doc"), pa.int32())
            lists = [pa.array(getattr(block, n)).cast(kinds.get(n, pa.int64())) for n in names[2:]]
            place = [pa.array([part], pa.int32()), pa.array([nth], pa.int32())]
            yield pa.RecordBatch.from_arrays(place + [pa.ListArray.from_arrays([0, len(v)], v) for v in lists], names=names)

    return rows.mapInArrow(build, _INDEX)


def _read_blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for i in range(batch.num_rows):
        found = [c[i].values for c in batch.columns[2:]]
        yield Block(found[0], *(v.to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for v in found[1:]))


class _Best:
    """The k best documents of a query so far, by score and then id; ids that are missing come last."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.score, self.missing, self.doc = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def add(self, score: np.ndarray, missing: np.ndarray, doc: np.ndarray) -> None:
        self.score = np.concatenate([self.score, score])
        self.missing, self.doc = np.concatenate([self.missing, missing]), np.concatenate([self.doc, doc])
        if len(self.score) > self.k:
            first = np.lexsort((self.doc, self.missing, -self.score))[: self.k]
            self.score, self.missing, self.doc = self.score[first], self.missing[first], self.doc[first]
        if len(self.score) == self.k:
            self.least = max(self.least, int(self.score.min()))


_HITS = "query int, doc_id long, score long"


def _search(index: DataFrame, shared, least: list[int], k: int) -> DataFrame:
    """The best documents of every query in each task: query, doc_id, score."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value[0]
        best = [_Best(k, at) for at in least]
        for block in (b for batch in batches for b in _read_blocks(batch)):
            missing, doc = block.docs.is_null().to_numpy(zero_copy_only=False), block.docs.fill_null(0).to_numpy(zero_copy_only=False)
            for query, plan, top in zip(queries.wanted, queries.plans, best, strict=True):
                found, score = search_block(block, query, plan, queries.pairs, top.least)
                if len(found):
                    top.add(score, missing[found], doc[found])
        query = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.score) for b in best])
        if len(query):
            doc = pa.array(np.concatenate([b.doc for b in best]), mask=np.concatenate([b.missing for b in best]))
            yield pa.RecordBatch.from_arrays([pa.array(query), doc, pa.array(np.concatenate([b.score for b in best]))], names=["query", "doc_id", "score"])

    return index.mapInArrow(search, _HITS)


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_all(docs: DataFrame, texts: list[str | None], k: int) -> DataFrame:
    """query (place in ``texts``), rank, doc_id, score."""
    spark = docs.sparkSession
    queries = Queries.of(texts)
    rows = keep(occurrences(docs, queries.vocabulary), "lexical")
    totals = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    n_docs, n_terms = totals[0], totals[1] or 0
    df = np.zeros(len(queries.vocabulary), np.int64)
    # One line per term of the queries.
    for term, count in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = count
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    queries.pair_up(df)
    shared = spark.sparkContext.broadcast((queries, weights, n_docs, n_terms))
    least = [0] * len(texts)
    index = keep(build_index(rows.where("size(terms) > 0"), shared), "lexical-index")
    # k documents that reach a score show that the k-th best of all reaches it too.
    some = index.where((F.col("part") < FIRST_BLOCKS) & (F.col("nth") == 0))
    first = _top(_search(some, shared, least, k), k)
    for r in first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k).collect():
        least[r["query"]] = r["least"]
    return _top(_search(index, shared, least, k), k)


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of every item, best first.

    Only documents with a score above 0 are returned; equal scores go by doc_id, a missing one last.
    A null text has no terms. Rows that share a doc_id are documents of their own. Equal rows of items are one
    item; rows that share an item_id but not the text are answered each. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    size = F.sum(F.length("text") / 4)
    n = max(1, math.ceil((items.agg(size).first()[0] or 0) / QUERY_TERMS))
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    dealt = keep(dealt, "queries") if n > 1 else dealt
    found = None
    kind = items.schema["item_id"].dataType.simpleString()
    for part in range(n):
        # One bounded block of queries at a time is held by the driver.
        mine = dealt.where(F.col("_part") == part).orderBy("item_id", "text").collect()
        hits = _search_all(docs, [r["text"] for r in mine], k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], f"query int, item_id {kind}")
        hits = hits.join(names, "query").select("item_id", "rank", "doc_id", "score")
        found = hits if found is None else found.unionByName(hits)
    return found
