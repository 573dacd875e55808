"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped candidates.

1. Every text gives its set of word shingles as 64-bit hashes. One permutation splits the hash range
   into ``bands * rows`` bins; a bin's least hash is its signature value. Empty bins borrow from a
   full bin chosen by a hash of the bin alone (optimal densification).
2. Equal sets are one class, represented by its smallest doc_id; only classes go further.
3. Every bucket (band, values) sends its members to its smallest member, the centre of a star:
   at most ``bands`` candidate edges per class, however large the bucket.
4. The members of one star are confirmed against each other on their full sets, so no link between
   two texts that share a bucket is lost. A star of more than ``BLOCK`` members is dealt out as
   pairs of blocks; each task holds two blocks and returns a spanning forest of its links.
5. Connected components of the links, by label propagation with pointer jumping over stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import keep, small_batches
from stayline.llm.words import mix, pieces, shingle_hashes, word_hashes

BANDS = 36
ROWS = 6
BLOCK = 512
SIMILARITY = 80  # per cent
HASH_BITS = 52  # above them, a sort key has room for 4,096 texts
TEXTS = 1 << (64 - HASH_BITS)


def text_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some texts each: index of the first, sorted distinct shingle hashes, offsets by text."""
    for piece in pieces(texts):
        words, text = word_hashes(piece)
        hashes, text = shingle_hashes(words, text, size)
        for at in range(0, len(piece), TEXTS):
            n = min(TEXTS, len(piece) - at)
            mine = (text >= at) & (text < at + n) if len(piece) > TEXTS else slice(None)
            key = (text[mine] - at).astype(np.uint64) << np.uint64(HASH_BITS)
            key |= hashes[mine] >> np.uint64(64 - HASH_BITS)
            key.sort()
            if len(key):
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
            edges = np.arange(n, dtype=np.uint64) << np.uint64(HASH_BITS)
            offsets = np.append(np.searchsorted(key, edges), len(key))
            yield piece.first + at, key & np.uint64((1 << HASH_BITS) - 1), offsets


def signatures(values: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """[texts, bins] least hash per bin; texts without shingles keep the largest number."""
    n = len(offsets) - 1
    empty = np.uint64(_EMPTY)
    out = np.full((n, bins), empty, dtype=np.uint64)
    text = np.repeat(np.arange(n), np.diff(offsets))
    # The bin is taken from bits that the sort order does not use up: a second hash would do as well.
    where = ((values >> np.uint64(HASH_BITS - 32)) * np.uint64(bins)) >> np.uint64(32)
    slot = text * bins + where.astype(np.int64)
    if len(slot):
        first = np.concatenate([[True], slot[1:] != slot[:-1]])  # sorted, so the first is the least
        out.ravel()[slot[first]] = values[first]
    full = out != empty
    some = full.any(axis=1)
    rows, cols = np.nonzero(~full & some[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        donor = (mix(cols.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        found = full[rows, donor]
        out[rows[found], cols[found]] = out[rows[found], donor[found]]
        rows, cols = rows[~found], cols[~found]
    return out


_EMPTY = (1 << 64) - 1
_SIGNED = "doc_id long, n long, class_key binary, buckets array<long>"


def signed(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n (set size), class_key (equal for equal sets), buckets (one key per band)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("class_key", pa.binary()), ("buckets", pa.list_(pa.int64()))]
        )
        for batch in batches:
            ids = batch.column(0)
            for first, values, offsets in text_sets(batch.column(1), size):
                n = len(offsets) - 1
                count = np.diff(offsets)
                sums = np.zeros((2, len(values) + 1), dtype=np.uint64)
                np.cumsum(mix(values), out=sums[0, 1:])
                np.cumsum(mix(values + np.uint64(0x632BE59BD9B4E019)), out=sums[1, 1:])
                key = np.stack(
                    [sums[0, offsets[1:]] - sums[0, offsets[:-1]], sums[1, offsets[1:]] - sums[1, offsets[:-1]], count.astype(np.uint64)],
                    axis=1,
                )
                flat = np.ascontiguousarray(key).tobytes()
                least = signatures(values, offsets, bands * rows).reshape(n, bands, rows)
                bucket = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
                for k in range(rows):
                    bucket = mix(bucket * np.uint64(0x9E3779B97F4A7C15) + least[:, :, k])
                has = count > 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]), pa.int32()),
                    pa.array(bucket[has].ravel().view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, n).cast(pa.int64()),
                        pa.array(count.astype(np.int64)),
                        pa.array([flat[24 * i : 24 * i + 24] for i in range(n)], pa.binary()),
                        lists,
                    ],
                    schema=schema,
                )

    return small_batches(docs).select("doc_id", "text").mapInArrow(sign, _SIGNED)


def linked_pairs(values: np.ndarray, offsets: np.ndarray, similarity: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every text, the later texts whose sets are similar enough, exactly.

    Shingles that only one of the texts has count for the sizes alone; the others become bits.
    """
    n, size = len(offsets) - 1, np.diff(offsets)
    if n == 2:
        both = np.sort(values)
        common = int((both[1:] == both[:-1]).sum())
        if common and 100 * common >= similarity * (len(values) - common):
            yield 0, np.array([1])
        return
    _, code, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[code]
    use = shared[code]
    text = np.repeat(np.arange(n), size)[use]
    column = column[use]
    words = max(1, -(-int(shared.sum()) // 64))
    bits = np.zeros((n, words), dtype=np.uint64)
    np.bitwise_or.at(bits, (text, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    for i in range(n - 1):
        common = np.bitwise_count(bits[i + 1 :] & bits[i]).sum(axis=1, dtype=np.int64)
        hit = 100 * common >= similarity * (size[i + 1 :] + size[i] - common)
        yield i, i + 1 + np.flatnonzero(hit & (common > 0))


def _forest(ids: np.ndarray, links: Iterator[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Edges from the first member of every component of the links to its others; ids ascend."""
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, others in links:
        for j in others:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = [root(i) for i in range(len(ids))]
    return [(int(ids[r]), int(ids[i])) for i, r in enumerate(roots) if ids[r] != ids[i]]


def _runs(cuts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cells that lie together and have at most ``most`` rows, or a single one that has more."""
    first = 0
    while first < len(cuts) - 1:
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + most, side="right")) - 1)
        yield first, last
        first = last


def _confirm(size: int, similarity: int):
    def solve(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        """The edges of every cell; cell k holds the rows from cuts[k] to cuts[k + 1]."""
        edges = []
        if len(table):
            ids = np.asarray(table.column("doc_id"))
            found = list(text_sets(table.column("text"), size))
            values = np.concatenate([v for _, v, _ in found])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(o) for _, _, o in found]))])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1:
                    own = values[offsets[a] : offsets[b]]
                    edges += _forest(ids[a:b], linked_pairs(own, offsets[a : b + 1] - offsets[a], similarity))
        src, dst = zip(*edges, strict=True) if edges else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows star, cell, doc_id, text, sorted by the first three; a cell may span batches."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            star, cell = np.asarray(table.column("star")), np.asarray(table.column("cell"))
            cuts = np.flatnonzero((star[1:] != star[:-1]) | (cell[1:] != cell[:-1])) + 1
            cuts = np.concatenate([[0], cuts])
            rest = table.slice(cuts[-1])  # may go on in the next batch
            for first, last in _runs(cuts, 2 * BLOCK):
                own = cuts[first : last + 1]
                yield solve(table.slice(own[0], own[-1] - own[0]), own - own[0])
        if rest is not None:
            yield solve(rest, np.array([0, len(rest)]))

    return confirm


def candidate_stars(classes: DataFrame, bands: int = BANDS) -> DataFrame:
    """star, doc_id: every class with the centre of each of its buckets, once; centres included."""
    buckets = classes.select("doc_id", F.explode("buckets").alias("bucket"))
    centred = buckets.groupBy("bucket").agg(F.min("doc_id").alias("star"), F.count("*").alias("n")).where("n > 1")
    edges = buckets.join(centred, "bucket").where("doc_id != star").select("star", "doc_id").distinct()
    return edges.unionByName(edges.select("star", F.col("star").alias("doc_id")).distinct())


def links(docs: DataFrame, stars: DataFrame, size: int, similarity: int = SIMILARITY) -> DataFrame:
    """src, dst: edges that join all documents of each star that true links connect."""
    sizes = stars.groupBy("star").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = stars.join(sizes, "star").withColumn("block", F.expr("int(pmod(xxhash64(doc_id), blocks))"))
    cells = dealt.select(
        "star",
        "doc_id",
        F.explode(
            F.expr("transform(sequence(0, blocks - 1), b -> least(b, block) * blocks + greatest(b, block))")
        ).alias("cell"),
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    # The candidates grow with the corpus, so they are never broadcast, however few they are here.
    rows = cells.hint("shuffle_merge").join(texts, "doc_id").select("star", "cell", "doc_id", "text")
    spread = rows.repartition(F.col("star"), F.col("cell")).sortWithinPartitions("star", "cell", "doc_id")
    return small_batches(spread).mapInArrow(_confirm(size, similarity), "src long, dst long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node reachable, for every node that has an edge.

    Every round takes the least label among the neighbours and then the label of that label.
    """
    both = keep(edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), "edges")
    labels = keep(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least")).select("node", F.least("node", "least").alias("component")),
        "labels",
    )
    for _ in range(most_rounds):
        near = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
        jumped = keep(
            hooked.join(jump, "to", "left").select("node", "old", F.least("to", F.coalesce("further", "to")).alias("component")),
            "labels",
        )
        labels = jumped.select("node", "component")
        if jumped.where("component != old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are lower-cased (A-Z); a text of fewer than ``size`` words is one shingle; a null or blank
    text has none and is linked with nothing. Documents are linked when 100 * intersection >=
    similarity * union. Rows that share a doc_id count as one document and each return a row; a null
    doc_id is linked with nothing, has no component and is kept. Other columns are ignored.
    """
    signed_rows = keep(signed(docs, size, bands, rows), "signed")
    classes = signed_rows.where("n > 0 and doc_id is not null").groupBy("class_key").agg(
        F.min("doc_id").alias("rep"), F.min_by("buckets", "doc_id").alias("buckets")
    )
    reps = keep(classes, "classes")
    stars = keep(candidate_stars(reps.select(F.col("rep").alias("doc_id"), "buckets"), bands), "stars")
    labels = components(links(docs, stars, size, similarity))
    named = reps.select("class_key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("class_key", F.coalesce("component", "rep").alias("component_id"))
    found = signed_rows.select("doc_id", "n", "class_key").join(named, "class_key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The documents, one of every group of near duplicates: the one with the smallest doc_id, a missing one last.

    Rows are told apart by their place in a stored copy, not by doc_id: rows that share a doc_id, or have
    none, are documents of their own and are dropped only for a near duplicate. Of equal rows one stays.
    """
    place = "_neardup_place"
    rows = keep(docs.withColumn(place, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col(place).alias("doc_id"), "text"), size, similarity)
    found = found.select(F.col("doc_id").alias(place), F.col("component_id").alias("_neardup_group"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(place))
    first = rows.select(place, "doc_id").join(found, place).groupBy("_neardup_group").agg(F.min(order)[place].alias(place))
    return rows.join(first.select(place), place, "left_semi").select(docs.columns)
