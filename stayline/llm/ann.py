"""Nearest neighbours by multi-index hashing over learned rotated binary codes.

Fit, on a bounded sample: principal axes, then the rotation that brings the sample closest to the corners
of a cube (iterative quantisation); the Hamming radius within which the sample's true neighbours lie.
Index, every row: a code of ``BITS`` bits, cut into substrings; rows lie in blocks, and every substring
of a block has a table from its value to the block's rows.
Search: if two codes differ in at most r bits, then in some substring by few; probing all values that
close in every substring retrieves every code within the radius. Their Hamming distance is checked, and
what remains is ranked by the exact inner product of the floats. A query with too few codes in a
block takes the block's nearest codes besides.

The stated queries meet all rows, block by block: a task holds one block of each, of fixed sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.store import hashed_sample

BITS = 64
SUBSTRING_BITS = 8
SAMPLE = 4096
SAMPLE_QUERIES = 256
COVERED = 0.97  # share of the sample's true neighbours within the radius
INDEX_BLOCK = 8192
QUERY_BLOCK = 4096
QUERIES_AT_ONCE = 64


@dataclass
class Codes:
    """The fitted code: plain arrays."""

    mean: np.ndarray
    rotation: np.ndarray  # [dimensions, bits]
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """One 64-bit number per row."""
        sign = (rows.astype(np.float64) - self.mean) @ self.rotation > 0
        return (sign.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fit(rows: np.ndarray, neighbours: int, bits: int = BITS, covered: float = COVERED, seed: int = 11) -> Codes:
    """Codes from sample rows [n, dimensions]; the radius holds ``covered`` of the sample's neighbours.

    Neighbours in a sample are farther than in the whole table, so the radius errs on the wide side.
    """
    draw = np.random.default_rng(seed)
    rows = rows.astype(np.float64)
    n, dims = rows.shape
    bits = min(bits, 64, dims)
    # Inner products rank by angle among rows of one length: codes come from directions.
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    mean = np.zeros(dims)
    _, axes = np.linalg.eigh(unit.T @ unit)
    axes = axes[:, ::-1][:, :bits]
    flat = unit @ axes
    rotation, _ = np.linalg.qr(draw.standard_normal((bits, bits)))
    for _ in range(40):
        u, _, v = np.linalg.svd(np.sign(flat @ rotation).T @ flat)
        rotation = (u @ v).T
    codes = Codes(mean, axes @ rotation, bits)
    code = codes.encode(rows)
    some = draw.permutation(n)[:SAMPLE_QUERIES]
    score = rows[some] @ rows.T
    score[np.arange(len(some)), some] = -np.inf
    k = min(neighbours, n - 1)
    if k > 0:
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        distance = np.bitwise_count(code[some][:, None] ^ code[near])
        codes.radius = int(np.quantile(distance, covered, method="higher"))
    return codes


def probes(radius: int, parts: int) -> list[int]:
    """Per substring, within how many bits it is probed, so that no code within the radius is missed.

    If every substring differed by more than that, the codes would differ by more than the radius.
    """
    each, more = divmod(radius, parts)
    return [each] * (more + 1) + [each - 1] * (parts - more - 1)


def substrings(code: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << SUBSTRING_BITS) - 1)
    return [(code >> np.uint64(at)) & mask for at in range(0, bits, SUBSTRING_BITS)]


def retrieve(query_codes: np.ndarray, codes: np.ndarray, bits: int, radius: int) -> np.ndarray:
    """[queries, rows] whether the row's code was retrieved and lies within the radius."""
    found = np.zeros((len(query_codes), len(codes)), dtype=bool)
    pairs = list(zip(substrings(query_codes, bits), substrings(codes, bits), strict=True))
    for reach, (mine, theirs) in zip(probes(radius, len(pairs)), pairs, strict=True):
        if reach < 0:
            continue
        order = np.argsort(theirs, kind="stable")  # the table of this substring
        values, starts = np.unique(theirs[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        close = np.bitwise_count(mine[:, None] ^ values[None, :]) <= reach
        for v, (a, b) in enumerate(zip(starts, ends, strict=True)):
            hit = np.flatnonzero(close[:, v])
            if len(hit):
                found[np.ix_(hit, order[a:b])] = True
    for i in range(len(query_codes)):
        at = np.flatnonzero(found[i])
        found[i, at] = np.bitwise_count(codes[at] ^ query_codes[i]) <= radius
    return found


def _search(codes: Codes, neighbours: int):
    def search(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        """One block of queries against one block of the index: the best of each query."""
        out: list[list[np.ndarray]] = [[], [], []]
        if len(queries) and len(rows):
            query_ids, ids = np.asarray(queries.column("id")), np.asarray(rows.column("id"))
            x, y = _matrix(queries.column("vec")), _matrix(rows.column("vec"))
            query_codes, row_codes = np.asarray(queries.column("code")).view(np.uint64), np.asarray(rows.column("code")).view(np.uint64)
            enough = min(neighbours + 1, len(ids))
            for at in range(0, len(x), QUERIES_AT_ONCE):
                part = slice(at, at + QUERIES_AT_ONCE)
                found = retrieve(query_codes[part], row_codes, codes.bits, codes.radius)
                for i in np.flatnonzero(found.sum(axis=1) < enough):
                    distance = np.bitwise_count(row_codes ^ query_codes[at + i])
                    found[i] |= distance <= np.partition(distance, enough - 1)[enough - 1]
                for i in range(len(found)):
                    mine = np.flatnonzero(found[i] & (ids != query_ids[at + i]))
                    score = np.einsum("ij,j->i", y[mine], x[at + i])
                    if len(mine) > neighbours:
                        least = np.partition(score, -neighbours)[-neighbours]
                        mine, score = mine[score >= least], score[score >= least]
                    best = np.lexsort((ids[mine], -score))[:neighbours]
                    for store, values in zip(out, (np.full(len(best), query_ids[at + i]), ids[mine][best], score[best]), strict=True):
                        store.append(values)
        columns = [np.concatenate(c) if c else np.empty(0) for c in out]
        return pa.table(
            {
                "query_id": pa.array(columns[0].astype(np.int64)),
                "vec_id": pa.array(columns[1].astype(np.int64)),
                "score": pa.array(columns[2].astype(np.float64)),
            }
        )

    return search


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """id, vec: distinct rows with an id and a finite vector other than zero."""
    vec = F.col(vector)
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.where(F.col(id_column).isNotNull() & vec.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vec, lambda x: x != 0))
        .select(F.col(id_column).cast("long").alias("id"), vec.cast("array<double>").alias("vec"))
        .distinct()
    )


def _encoder(codes: Codes):
    def encode(batches):
        for batch in batches:
            code = codes.encode(_matrix(batch.column(1))) if len(batch) else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.view(np.int64))], names=["id", "vec", "code"])

    return encode


def index(rows: DataFrame, codes: Codes) -> DataFrame:
    """id, vec, code of every usable row."""
    return rows.mapInArrow(_encoder(codes), "id long, vec array<double>, code long")


def nearest(
    table: DataFrame, every_nth: int = 20, neighbours: int = 20, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``neighbours`` rows of largest inner product found.

    Queries are the rows whose id is divisible by ``every_nth``; candidates are all rows but those with
    the query's id. Vectors that are null, empty, zero or hold null or non-finite components take no
    part, nor do rows without an id or, where lengths differ, vectors of any but the commonest length
    (the longer one of two). Repeated rows count once. Ties go to the smaller id.
    """
    rows = usable(table, id_column, vector)
    lengths = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    result = "query_id long, vec_id long, score double"
    if lengths is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vec") == lengths["size"])
    sample = hashed_sample(rows.select("vec"), SAMPLE * 3, ["vec"]).distinct().orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).toArrow()
    codes = fit(_matrix(sample.column("vec")), neighbours)
    n_rows = lengths["count"]
    row_blocks, query_blocks = -(-n_rows // INDEX_BLOCK), -(-n_rows // (QUERY_BLOCK * every_nth))
    coded = index(rows, codes)
    place = lambda blocks: F.expr(f"pmod(xxhash64(id), {blocks}L)")
    beside = lambda blocks: F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))
    queries = coded.where(F.col("id") % every_nth == 0).withColumn("q", place(query_blocks)).withColumn("r", beside(row_blocks))
    blocks = coded.withColumn("r", place(row_blocks)).withColumn("q", beside(query_blocks))
    found = queries.groupBy("q", "r").cogroup(blocks.groupBy("q", "r")).applyInArrow(_search(codes, neighbours), result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
