"""Near-duplicate vectors: binary codes by iterative quantisation, multi-index Hamming tables, exact cosine last."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.components import LocalGroups, components
from lettermill.plans.joins import checked_join
from lettermill.session import staged

MIN_COSINE = 0.95
SAMPLE_ROWS = 10_000  # vectors that the rotations are fitted on, about
ROTATION_STEPS = 50
TABLE_BITS = 16  # bits of a table's key at least; log2 of the number of vectors where that is more
MISS = 0.05  # tables are added until a pair at the threshold misses all of them no more often than this
RADIUS = 1  # differing bits of a key within which a table finds a pair
MAX_DIFFERENT = 0.3  # share of differing code bits beyond which a candidate is not reranked
SHARD_VECTORS = 4_096  # members of one part of a table, on average
HOT_PART = 16_384  # members of a part that one task compares; a fuller part is dealt to several
CHUNK_PAIRS = 1 << 20
PROBE_BITS = 64  # code bits, at least, that the rate of differing bits is measured with
MAX_TABLES = 64  # with more, codes are about the origin instead of the mean; both are planned for the same recall


def fit_rotations(sample: np.ndarray, bits: int, seed: int = 0, centre: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Mean (zero without ``centre``), and a matrix whose columns give one code bit each, learned on unit vectors.

    Principal directions first, then a rotation that alternates between the
    nearest signs and the orthogonal matrix closest to them, so that bits are
    balanced and quantisation loses little. As many rotations, from different
    starts, as the bits need.
    """
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0) * centre
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        projected = centred @ axes.T
        rotation, _ = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))
        for _ in range(ROTATION_STEPS):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ signs)
            rotation = left @ right
        parts.append(axes.T @ rotation)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def plan_tables(n: int, cosine: float = MIN_COSINE, rates: np.ndarray | None = None) -> tuple[int, int]:
    """Bits of a key and number of tables for ``n`` vectors.

    Keys have about log2(n) bits, so buckets of unrelated vectors keep their
    size. About the origin a bit of two vectors differs with probability
    angle / pi; ``rates`` are those measured on threshold pairs, one a pair.
    Pairs differ in how hard they are to find, so the misses are averaged.
    """
    bits = min(60, max(TABLE_BITS, int(np.ceil(np.log2(max(2, n))))))
    least = np.arccos(cosine) / np.pi
    tables = 1
    for differ in (np.array([least]), np.array([least]) if rates is None else np.clip(rates, 0.0, 0.5)):
        missed = 1 - ((1 - differ) ** bits + bits * differ * (1 - differ) ** (bits - 1))
        low, high = 0, tables  # misses only fall as tables are added
        while (missed**high).mean() > MISS:
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if (missed**middle).mean() > MISS else (low, middle)
        tables = max(tables, high)
    return bits, tables


def threshold_rates(sample: np.ndarray, mean: np.ndarray, columns: np.ndarray, cosine: float) -> np.ndarray:
    """Share of differing code bits of every vector of ``sample`` and another at the threshold, in a random direction."""
    away = np.random.default_rng(1).standard_normal(sample.shape)
    away -= (away * sample).sum(axis=1, keepdims=True) * sample
    length = np.sqrt((away * away).sum(axis=1, keepdims=True))
    other = cosine * sample + np.sqrt(max(0.0, 1 - cosine**2)) * away / np.where(length > 0, length, 1.0)
    return (((sample - mean) @ columns >= 0) != ((other - mean) @ columns >= 0)).mean(axis=1)


def fit_codes(sample: np.ndarray, n: int, cosine: float) -> tuple[int, int, np.ndarray, np.ndarray, float]:
    """Bits of a key, tables, mean, columns, and the share of differing bits beyond which no candidate is reranked.

    Vectors with a common direction are further apart about their mean than
    about the origin, so tables are planned from threshold pairs about the mean.
    """
    for centre in (True, False):
        rates = threshold_rates(sample, *fit_rotations(sample, max(PROBE_BITS, sample.shape[1]), centre=centre), cosine)
        bits, tables = plan_tables(n, cosine, rates)
        if tables <= MAX_TABLES:
            break
    mean, columns = fit_rotations(sample, bits * tables, centre=centre)
    return bits, tables, mean, columns, max(MAX_DIFFERENT, float(threshold_rates(sample, mean, columns, cosine).max()))


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors padded with zeros, in double precision, and which of them can be compared."""
    lists = column.cast(pa.list_(pa.float64()))
    good = lists.is_valid().to_numpy(zero_copy_only=False).copy()
    out = np.zeros((len(column), width))
    offsets = lists.offsets.to_numpy()
    size = np.where(good, np.diff(offsets), 0)
    values = lists.values
    filled = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = filled[np.repeat(offsets[:-1], size) + at]
    with np.errstate(over="ignore", invalid="ignore"):
        good &= np.isfinite(out).all(axis=1) & (np.abs(out).max(axis=1, initial=0) > 0)
    return out, good


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def coded_vectors(vectors: DataFrame, width: int, mean: np.ndarray, columns: np.ndarray, tables: int) -> DataFrame:
    """``(vec_id, key, code, v)`` of vectors that can be compared; ``key`` is a digest of the vector, ``code`` one key a table."""
    bits = columns.shape[1] // tables

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (np.uint64(1) << np.arange(bits, dtype=np.uint64))[::-1]
        for batch in batches:
            matrix, good = _matrix(batch.column("v"), width)
            matrix, ids = matrix[good], batch.column("vec_id").filter(pa.array(good))
            if not len(ids):
                continue
            signs = ((unit(matrix) - mean) @ columns >= 0).reshape(len(matrix), tables, bits)
            code = (signs * weights).sum(axis=2, dtype=np.uint64).astype(np.int64)
            keys = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in matrix + 0.0]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]).astype(np.int32)), pa.array(x.ravel()))
                for x in (code, matrix)
            ]
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), *lists], ["vec_id", "key", "code", "v"])

    return vectors.mapInArrow(encode, "vec_id long, key binary, code array<long>, v array<double>")


def link_shard(
    table: int, bits: int, low_bits: int, codes: np.ndarray, vectors: np.ndarray, weights: np.ndarray,
    probe: np.ndarray, cosine: float, blocks: np.ndarray | None = None, inside: bool = True,
    max_different: float = MAX_DIFFERENT,
) -> tuple[np.ndarray, LocalGroups]:
    """Links of one part of a table: weight of linked items for every item, and the groups they form.

    Items with ``probe`` 0 are members; others only ask for the members whose
    key differs from theirs in that bit. A pair counts in the first table only
    that finds it, so no pair counts twice. With ``blocks`` only members of
    different blocks are compared; without ``inside`` members are not compared at all.
    """
    keys = codes[:, table]
    linked = np.zeros(len(keys), np.int64)
    groups = LocalGroups(len(keys))
    members = np.flatnonzero(probe == 0)
    members = members[np.argsort(keys[members], kind="stable")]
    sorted_keys = keys[members]
    units = unit(vectors)

    def visit(left: np.ndarray, wanted: np.ndarray, first: np.ndarray | None = None) -> None:
        low = np.searchsorted(sorted_keys, wanted) if first is None else first
        high = np.searchsorted(sorted_keys, wanted, "right")
        size = high - low
        bounds = np.append(0, np.cumsum(size))
        at = 0
        while at < len(left):
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_PAIRS, "right")) - 1)
            rows = np.arange(at, upto)
            for begin in range(0, int(size[at]) if upto == at + 1 else 1, CHUNK_PAIRS):  # one item with very many
                n = np.minimum(size[rows] - begin, CHUNK_PAIRS) if upto == at + 1 else size[rows]
                start = low[rows] + begin
                i = np.repeat(left[rows], n)
                j = members[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)]
                compare(i, j)
            at = upto

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        different = np.bitwise_count(codes[i] ^ codes[j])
        keep = (different[:, :table] > RADIUS).all(axis=1)
        keep &= different.sum(axis=1) <= max_different * bits * codes.shape[1]
        if blocks is not None:
            keep &= blocks[i] != blocks[j]
        i, j = i[keep], j[keep]
        close = np.einsum("ij,ij->i", units[i], units[j]) >= cosine
        i, j = i[close], j[close]
        np.add.at(linked, i, weights[j])
        np.add.at(linked, j, weights[i])
        groups.unite(i, j)

    place = np.arange(len(members))
    if inside:
        visit(members, sorted_keys, place + 1)  # equal keys: those behind it
    for bit in range(low_bits if inside else 0):
        flag = np.int64(1) << bit
        asks = members[(sorted_keys & flag) != 0]
        visit(asks, keys[asks] ^ flag)
    guests = np.flatnonzero(probe != 0)
    visit(guests, keys[guests] ^ probe[guests])
    return linked, groups


def shard_links(classes: DataFrame, n: int, bits: int, tables: int, cosine: float, max_different: float = MAX_DIFFERENT) -> DataFrame:
    """``(cid, linked, label)``: links found in each part of each table, and the smallest member of the local group.

    A table is cut by the leading bits of its keys into parts of
    ``SHARD_VECTORS`` members on average, whatever ``n``. A vector is a member
    of one part a table, and asks the parts whose leading bits differ in one
    place; of two parts only the one with the bit set asks. A part with more
    than ``HOT_PART`` members or asking vectors, such as a large group of near
    copies or the small neighbour of one, is dealt into blocks, members and
    asking vectors each by their own number: every pair of member blocks, and every
    block of asking vectors with every block of members, is a task of its own.
    """
    low_bits = bits - _lead(n, bits)
    dealt = deal_parts(classes, n, bits, tables)

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid", kind="stable")  # the smallest place is the smallest id
        ids = group["cid"].to_numpy()
        first = group.iloc[0]
        linked, groups = link_shard(
            int(first["table"]), bits, low_bits, np.stack(group["code"].to_numpy()), np.stack(group["v"].to_numpy()),
            group["w"].to_numpy(), group["probe"].to_numpy(), cosine,
            group["block"].to_numpy() if 0 <= first["a"] < first["b"] else None, bool(first["a"] >= 0),
            max_different,
        )
        found = np.flatnonzero(linked)
        return pd.DataFrame({"cid": ids[found], "linked": linked[found], "label": ids[groups.roots(found)]})

    return dealt.groupBy("table", "part", "a", "b").applyInPandas(link, "cid long, linked long, label long")


def _lead(n: int, bits: int) -> int:
    """Leading bits of a key that name its part."""
    return min(bits, max(0, int(np.ceil(np.log2(max(1, n) / SHARD_VECTORS)))))


def deal_parts(classes: DataFrame, n: int, bits: int, tables: int) -> DataFrame:
    """Every vector in all tasks that compare it: ``(cid, w, code, v, table, part, probe, block, a, b)``."""
    low_bits = bits - _lead(n, bits)
    targets = []
    for table in range(tables):
        key = F.col("code")[table]
        part = F.shiftright(key, low_bits)
        targets.append(F.struct(F.lit(table).alias("table"), part.alias("part"), F.lit(0).cast("long").alias("probe")))
        for bit in range(low_bits, bits):
            flag = 1 << bit
            targets.append(F.when(key.bitwiseAND(F.lit(flag)) != 0, F.struct(
                F.lit(table).alias("table"), F.shiftright(key.bitwiseXOR(F.lit(flag)), low_bits).alias("part"), F.lit(flag).cast("long").alias("probe")
            )))
    routed = classes.select("cid", "w", "code", "v", F.inline(F.filter(F.array(*targets), lambda t: t.isNotNull())))

    sizes = routed.groupBy("table", "part").agg(
        F.count_if(F.col("probe") == 0).alias("members"), F.count_if(F.col("probe") != 0).alias("guests")
    )
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / HOT_PART)).cast("int")
    hot = sizes.filter((F.col("members") > HOT_PART) | (F.col("guests") > HOT_PART))
    hot = staged(hot.select("table", "part", blocks("members").alias("blocks"), blocks("guests").alias("guest_blocks")), "hot-parts")
    routed = checked_join(routed, hot, ["table", "part"], "left")
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("probe") == 0, F.col("blocks")).otherwise(F.col("guest_blocks"))).cast("int")
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    task = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    with_members = F.transform(numbers("blocks"), lambda j: task(F.least(F.col("block"), j), F.greatest(F.col("block"), j)))
    with_guests = F.transform(numbers("guest_blocks"), lambda j: task(-1 - j, F.col("block")))
    as_guest = F.transform(numbers("blocks"), lambda j: task(-1 - F.col("block"), j))
    tasks = F.when(F.col("blocks").isNull(), F.array(task(F.lit(0), F.lit(0)))).when(
        F.col("probe") == 0, F.concat(with_members, with_guests)
    ).otherwise(as_guest)
    return routed.withColumn("block", own).select("cid", "w", "code", "v", "table", "part", "probe", "block", F.inline(tasks))


def near_vectors(vectors: DataFrame, cosine: float = MIN_COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors``.

    Two vectors link if their cosine in double precision is at least ``cosine``
    and a table finds them; no pair below it links. Equal vectors always link
    and are one entry of the index, with their number as weight. Vectors that
    are null, empty, zero or hold null or non-finite components, and rows
    without an id, link with nothing; the component of a row without an id is
    null and it is not kept. A shorter vector counts as padded with zeros. Repeated rows
    of an id count as one vector; an id with several vectors has the links of
    all of them. Other columns are not read; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    known = rows.filter("vec_id is not null and v is not null")
    size = known.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    ids = rows.select("vec_id")
    alone = ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if not size["width"]:
        return alone
    width, n = size["width"], size["n"]
    chosen = known.filter(F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1_000_000)) < int(1e6 * min(1.0, SAMPLE_ROWS / n)) + 1)
    matrix, good = _matrix(chosen.select("v").toArrow().column("v").combine_chunks(), width)  # about SAMPLE_ROWS rows
    bits, tables, mean, columns, most = fit_codes(unit(matrix[good]) if good.any() else np.eye(width), n, cosine)
    coded = staged(coded_vectors(known, width, mean, columns, tables), "codes")
    classes = staged(
        coded.groupBy("key").agg(
            F.min("vec_id").alias("cid"), F.countDistinct("vec_id").alias("w"),
            F.first("code").alias("code"), F.first("v").alias("v"),
        ),
        "vector-classes",
    )
    found = staged(shard_links(classes, classes.count(), bits, tables, cosine, most), "vector-links")
    linked = found.groupBy(F.col("cid").alias("c1")).agg(F.sum("linked").alias("linked"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("label").alias("b")))
    named = (
        classes.select("key", "cid", "w")
        .join(linked, F.col("cid") == F.col("c1"), "left")
        .join(groups, F.col("cid") == F.col("node"), "left")
        .select("key", (F.coalesce("linked", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    )
    members = coded.select("vec_id", "key").join(named, "key").groupBy("vec_id").agg(
        F.max("n_links").alias("n"), F.min("component_id").alias("c")
    )
    return ids.join(members, "vec_id", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("c", "vec_id"), F.lit(False)).alias("kept"),
    )
