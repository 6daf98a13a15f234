"""SimHash near-duplicates: fingerprints, and links by the generalised pigeonhole principle.

If two fingerprints differ in at most t bits, then for any partition of the bits into m groups
and any thresholds adding up to t - m + 1, they differ in at most the threshold within at
least one group. Correlated bits go into one group; thresholds are chosen by dynamic
programming on candidate counts estimated from statistics of all fingerprints. Candidates are
probed group by group and verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from suarakit.llm import arrays
from suarakit.llm.common import column, small_batches, text_key, written
from suarakit.llm.components import components

BITS = 64
# Each byte value as eight counters of one byte, one for each of its bits.
_SPREAD = np.zeros(256, np.uint64)
for _bit in range(8):
    _SPREAD |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_bit)) & np.uint64(1)) << np.uint64(8 * _bit)


def _votes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each row from its shingle hashes: bits set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # Counters of one byte hold up to 255, so rows are summed in blocks of at most that.
    blocks = -(-counts[full] // 255)
    block_row = np.repeat(np.arange(len(full)), blocks)
    nth = np.arange(len(block_row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    row_first = np.cumsum(counts[full]) - counts[full]
    block_first = row_first[block_row] + 255 * nth
    half = counts[full] / 2
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for octet in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, octet]], block_first).view(np.uint8).reshape(-1, 8)
        per_row = np.add.reduceat(sums.astype(np.int64), np.cumsum(blocks) - blocks, axis=0)
        for bit in range(8):
            out[full] |= (per_row[:, bit] > half).astype(np.uint64) << np.uint64(8 * octet + bit)
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            made = np.zeros(batch.num_rows, np.uint64)
            for piece in arrays.pieces(batch.column(batch.num_columns - 1)):
                words = arrays.runs(piece, arrays.NOT_SPACE)
                # The words of the piece, one blank after each: a shingle is a slice of this.
                kept = arrays.NOT_SPACE[piece.data]
                lengths = words.ends - words.starts
                at = np.cumsum(lengths + 1) - lengths - 1
                joined = np.full(int((lengths + 1).sum()), 32, np.uint8)
                inside = np.ones(len(joined), bool)
                inside[at + lengths] = False
                joined[inside] = arrays.LOWER[piece.data[kept]]
                text = joined.tobytes()
                n_words = np.diff(words.first)
                counts = np.where(n_words == 0, 0, np.maximum(1, n_words - shingle + 1))
                row = np.repeat(np.arange(len(counts)), counts)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = words.first[row] + nth
                last = np.minimum(first + shingle, words.first[row + 1]) - 1
                lows, highs = at[first].tolist(), (at + lengths)[last].tolist()
                hashes = np.array([digest(text[a:b], 42) for a, b in zip(lows, highs)], np.uint64)
                made[piece.first : piece.first + len(counts)] = _votes(hashes, counts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(made.view(np.int64))], names=[*batch.schema.names[:-1], "fingerprint"]
            )

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4) -> DataFrame:
    """id, key, fingerprint (bigint). A text without words, or null, has fingerprint 0."""
    small_batches(docs.sparkSession)
    text = column(docs, text_column).cast("string")
    keyed = docs.select(column(docs, id_column).alias("id"), text_key(text).alias("key"), text.alias("text"))
    schema = StructType([*keyed.schema.fields[:-1], *StructType.fromDDL("fingerprint bigint")])
    return keyed.mapInArrow(_fingerprint_batches(shingle), schema)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many fingerprints have bits i and j both set, for all i and j: one small matrix a task."""
    total = np.zeros((BITS, BITS), np.int64)
    rows = 0
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        bits = ((values[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
        total += (bits.T @ bits).astype(np.int64)
        rows += len(values)
    yield pa.RecordBatch.from_pydict({"n": [rows], "both": [total.ravel().tolist()]})


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the matrix of joint counts, summed over all of them."""
    parts = prints.select("fingerprint").mapInArrow(_pair_counts, "n bigint, both array<bigint>")
    cells = (
        parts.select("n", F.posexplode("both").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas()
    )
    both = np.zeros(BITS * BITS)
    both[cells["at"].to_numpy()] = cells["v"].to_numpy()
    return int(cells["n"].max()) if len(cells) else 0, both.reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """Deal the bits into groups of equal size, correlated ones together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    linked = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, dealt = set(range(BITS)), []
    for g in range(groups):
        size = len(left) // (groups - g)
        seed = min(left, key=lambda i: (-sum(linked[i, j] for j in left if j != i), i))
        group = [seed]
        left.discard(seed)
        while len(group) < size:
            best = max(left, key=lambda i: (sum(linked[i, j] for j in group), -i))
            group.append(best)
            left.discard(best)
        dealt.append(sorted(group))
    return dealt


def close_chances(both: np.ndarray, n: int, group: list[int], upto: int) -> list[float]:
    """Chance that two fingerprints drawn at random differ in at most 0, 1, .. bits of the group.

    The mean and variance of the number of differing bits follow exactly from the joint counts;
    a beta-binomial distribution of that mean and variance gives the tail.
    """
    size, n = len(group), max(n, 1)
    p = np.diag(both)[group] / n
    p11 = both[np.ix_(group, group)] / n
    p10 = p[:, None] - p11
    p00 = 1 - p[:, None] - p[None, :] + p11
    differ = 2 * (p11 * p00 + p10 * p10.T)
    np.fill_diagonal(differ, 2 * p * (1 - p))
    mean = float(np.diag(differ).sum())
    variance = max(float(differ.sum()) - mean * mean, 1e-9)
    q = min(max(mean / size, 1e-6), 1 - 1e-6)
    rho = min(max((variance / (size * q * (1 - q)) - 1) / max(size - 1, 1), 1e-6), 0.999)
    a, b = q * (1 - rho) / rho, (1 - q) * (1 - rho) / rho
    chances, chance = [], 1.0
    for i in range(size):  # P(0) = prod (b + i) / (a + b + i)
        chance *= (b + i) / (a + b + i)
    total = 0.0
    for k in range(upto + 1):
        total += chance
        chances.append(min(1.0, total))
        chance *= (size - k) / (k + 1) * (a + k) / max(b + size - k - 1, 1e-9)
    return chances


def plan_probes(both: np.ndarray, n: int, most: int, probe_cost: float = 20.0) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and their thresholds (-1: the group is not probed) at the least estimated cost.

    Cost: estimated candidate pairs to verify, and ``probe_cost`` for each probe row. For every
    number of groups the thresholds come from a dynamic programme over groups and their sum.
    """
    best = (np.inf, [], [])
    for m in range(1, most + 2):
        groups = group_bits(both, n, m)
        budget = most - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for i, group in enumerate(groups):
            chances = close_chances(both, n, group, most)
            step: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in table.items():
                for e in range(-1, most + 1):
                    probes = sum(len(list(combinations(range(min(len(group), 40)), d))) for d in range(e + 1)) if e < 3 else 1e9
                    more = 0.0 if e < 0 else n * (n / 2) * chances[e] * (1 if e == 0 else 2) + n * probes * probe_cost
                    # Sums are kept with one added to every threshold, so that they never fall.
                    total = spent + e + 1
                    if total <= budget + m and (total not in step or cost + more < step[total][0]):
                        step[total] = (cost + more, [*chosen, e])
            table = step
        cost, chosen = table.get(budget + m, (np.inf, []))
        if cost < best[0]:
            best = (cost, groups, chosen)
    return best[1], best[2]


def _signatures(groups: list[list[int]], thresholds: list[int]):
    """Rows (signature, fingerprint, own) of a fingerprint: its own value in each group, and its neighbours'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for g, (group, most) in enumerate(zip(groups, thresholds)):
                if most < 0:
                    continue
                mask = np.uint64(sum(1 << b for b in group))
                flips = [0] + [sum(1 << b for b in c) for d in range(1, most + 1) for c in combinations(group, d)]
                for i, flip in enumerate(flips):
                    value = (prints & mask) ^ np.uint64(flip)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(prints), g, np.int32)),
                            pa.array(value.view(np.int64)),
                            pa.array(prints.view(np.int64)),
                            pa.array(np.full(len(prints), i == 0)),
                        ],
                        names=["part", "value", "fingerprint", "own"],
                    )

    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(own: np.ndarray, probes: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that link what is linked within a bucket: one for each fingerprint reached, not one for each pair.

    A probe is linked to one member of each group of linked fingerprints it is near to.
    """
    edges, members, groups = [], [], []
    left = own
    while len(left):
        frontier, left = left[:1], left[1:]
        group = [frontier]
        while len(frontier) and len(left):
            head, frontier = frontier[0], frontier[1:]
            near = _popcount(left ^ head) <= most
            if near.any():
                reached = left[near]
                edges.append((np.full(len(reached), head), reached))
                group.append(reached)
                frontier = np.concatenate([frontier, reached])
                left = left[~near]
        members.append(np.concatenate(group))
        groups.append(np.full(len(members[-1]), len(groups)))
    if members:
        own, of = np.concatenate(members), np.concatenate(groups)
    for probe in probes:
        near = np.flatnonzero((_popcount(own ^ probe) <= most) & (own != probe))
        if len(near):
            near = near[np.unique(of[near], return_index=True)[1]]
            edges.append((np.full(len(near), probe), own[near]))
    return edges


def _buckets(most: int, small: int = 48):
    """mapInArrow function over rows sorted by bucket: verified edges of every bucket.

    Buckets of few rows are compared all at once, by distance in the sorted order; larger ones
    one by one. Only the bucket that a batch ends in is carried over to the next batch.
    """

    def flush(keys: np.ndarray, prints: np.ndarray, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        edges = []
        first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        sizes = np.diff(np.append(first, len(keys)))
        for i in np.flatnonzero(sizes > small):
            a, b = first[i], first[i] + sizes[i]
            mine = own[a:b]
            edges += _forest(np.unique(prints[a:b][mine]), prints[a:b][~mine], most)
        bucket = np.repeat(np.arange(len(first)), sizes)
        light = np.flatnonzero((sizes <= small)[bucket] & (sizes > 1)[bucket])
        bucket, prints, own = bucket[light], prints[light], own[light]
        for step in range(1, small):
            if len(bucket) <= step:
                break
            same = bucket[step:] == bucket[:-step]
            if not same.any():
                break
            a, b = prints[:-step], prints[step:]
            hit = same & (own[:-step] | own[step:]) & (a != b)
            hit[hit] = _popcount(a[hit] ^ b[hit]) <= most
            if hit.any():
                edges.append((a[hit], b[hit]))
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: tuple | None = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            keys = np.stack([now[0].astype(np.int64), now[1], now[2].astype(np.int64)], axis=1)
            rows = (keys, now[3].view(np.uint64), now[4].astype(bool))
            if carried is not None:
                rows = tuple(np.concatenate([a, b]) for a, b in zip(carried, rows))
            if not len(rows[0]):
                continue
            same = (rows[0] == rows[0][-1]).all(axis=1)
            open_from = 0 if same.all() else len(same) - int(same[::-1].argmin())
            carried = tuple(x[open_from:] for x in rows)
            if open_from:
                yield _edge_batch(flush(*(x[:open_from] for x in rows)))
        if carried is not None and len(carried[0]):
            yield _edge_batch(flush(*carried))

    return run


def _edge_batch(edges: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([e[0] for e in edges]) if edges else np.zeros(0, np.uint64)
    b = np.concatenate([e[1] for e in edges]) if edges else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def links(prints: DataFrame, most: int = 4, bucket_rows: int = 1024) -> DataFrame:
    """Edges (``a``, ``b``) among distinct fingerprints that join all that differ in ``most`` bits or fewer.

    Within a bucket only a spanning forest is returned, so a group of n near copies gives about
    n edges, not n * n. A bucket of more than ``bucket_rows`` fingerprints is cut into blocks by
    hash; every pair of blocks meets in one task, so none grows with the bucket and no pair is lost.
    """
    spark = small_batches(prints.sparkSession)
    n, both = bit_statistics(prints)
    if n < 2:
        return spark.createDataFrame([], "a bigint, b bigint")
    groups, thresholds = plan_probes(both, n, most)
    rows = prints.select("fingerprint").mapInArrow(_signatures(groups, thresholds), "part int, value bigint, fingerprint bigint, own boolean")
    rows = written(rows, "signatures")
    heavy = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > bucket_rows)
    heavy = written(heavy.withColumn("blocks", F.ceil(F.col("rows") / bucket_rows).cast("int")), "heavy")
    marked = rows.join(heavy.drop("rows"), ["part", "value"], "left")
    block = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    # Blocks i <= j meet at cell j * (j + 1) / 2 + i.
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: (F.greatest(other, block) * (F.greatest(other, block) + 1) / 2 + F.least(other, block)).cast("int"),
    )
    cell = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(cells)).alias("cell")
    dealt = marked.select("part", "value", cell, "fingerprint", "own").repartition("part", "value", "cell")
    return dealt.sortWithinPartitions("part", "value", "cell").mapInArrow(_buckets(most), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, most: int = 4
) -> DataFrame:
    """id, key, fingerprint, component_id, keeper for every row of ``docs``.

    ``component_id`` is the smallest id among all documents reached over links, links joining
    fingerprints that differ in at most ``most`` bits; ``keeper`` says that the row has the
    smallest (id, key) of its component. Rows without words share fingerprint 0. Null ids take
    part and sort last: a component of null ids alone has component_id null. Equal rows are
    alike in all columns. No rows give no rows.
    """
    prints = written(fingerprints(docs, id_column, text_column, shingle), "prints")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))
    classes = written(prints.groupBy("fingerprint").agg(F.min(order).alias("least")), "classes")
    roots = components(links(classes, most))
    joined = classes.join(roots, classes["fingerprint"] == roots["node"], "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    joined = written(joined.select("fingerprint", "root", "least"), "joined")
    by_root = joined.groupBy("root").agg(F.min("least").alias("least"))
    labels = joined.select(F.col("fingerprint").alias("print"), "root").join(by_root, "root").select("print", "least")
    return prints.join(labels, F.col("fingerprint") == F.col("print")).select(
        "id",
        "key",
        "fingerprint",
        F.col("least")["id"].alias("component_id"),
        ((F.col("id").eqNullSafe(F.col("least")["id"])) & (F.col("key") == F.col("least")["key"])).alias("keeper"),
    )
