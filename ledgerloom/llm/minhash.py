"""Near-duplicate documents by b-bit MinHash.

Every text gets 128 minima over its distinct five-word shingles. Bands of four minima give candidates; of each minimum
only the low ``BITS`` bits are kept, packed into a signature of eight longs, and the share of equal fields, corrected
for chance equality, estimates the similarity of a candidate pair before its full sets are compared.

Texts with equal shingle sets are one class, and only classes take part. In each band bucket all members meet two
centres, so pairs grow with the members, not with their square. Buckets whose members are then still apart are
compared completely, by signature, in blocks of bounded size, and surviving pairs on full sets; only links that join
two components leave a block. Nothing is capped: a bucket of any size is cut into pairs of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import groups, mix, runs, shingle_sets, stretches
from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import bounded_parts, durable, lookup_side, parts_needed

MINIMA, ROWS, BITS = 128, 4, 4
BANDS = MINIMA // ROWS
LONGS = MINIMA * BITS // 64
# Signature estimates below this are dropped; a pair at 0.75 falls there about once in three million.
ESTIMATE = 0.55
# Members of a centre checked in one task; members of a block and their shingles together.
CENTRE_ROWS, BLOCK_ROWS, BLOCK_SHINGLES = 2000, 800, 4_000_000
# Classes stored in a file, with their keys and signatures.
CLASS_ROWS = 10_000
# Shingle hashes taken at once when the minima are computed.
_SLICE = 4096
_FACTORS = mix(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_NIBBLE = 0x1111111111111111

SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, digest string, keys array<bigint>, signature array<bigint>"


def _equal_needed() -> int:
    chance = 2.0**-BITS
    return int(np.ceil(MINIMA * (chance + (1 - chance) * ESTIMATE)))


def minima(shingles: np.ndarray) -> np.ndarray:
    best = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _SLICE):
        part = _FACTORS[:, None] * shingles[None, start : start + _SLICE]
        np.minimum(best, part.min(axis=1), out=best)
    return best


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shift = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))[None, :]
    band = np.arange(BANDS, dtype=np.uint64)
    for batch in batches:
        for part in stretches(batch, "text"):
            sets = shingle_sets(part.column("text").to_pylist())
            best = np.stack([minima(s) for s in sets])
            low = (mix(best) & np.uint64((1 << BITS) - 1)).reshape(len(sets) * LONGS, 64 // BITS)
            packed = np.bitwise_or.reduce(low << shift, axis=1)
            keys = np.broadcast_to(band, (len(sets), BANDS)).copy()
            for k in range(ROWS):
                keys = mix(keys + best[:, k::ROWS])
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets]

            def lists(values: np.ndarray, width: int) -> pa.Array:
                flat = pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64))
                return pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * width), flat)

            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests),
                    lists(keys, BANDS), lists(packed, LONGS),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "keys", "signature"],
            )


def _fields_equal(a: Column, b: Column) -> Column:
    """Number of equal signature fields."""
    total = F.lit(MINIMA)
    for k in range(LONGS):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        total -= F.bit_count(x.bitwiseAND(F.lit(_NIBBLE)))
    return total


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a similarity of at least 0.75."""
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= 75 * (len(a) + len(b) - shared)


def _check_centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members against the centre that precedes them; only the centre's sets are held."""
    centres: list[np.ndarray] = []
    for opens, run in runs(batches, ["centre", "salt"]):
        if opens:
            centres = []
        for part in stretches(run, "text"):
            sets = shingle_sets(part.column("text").to_pylist())
            found = []
            for i, (own, member) in enumerate(zip(part.column("own").to_pylist(), sets)):
                if own:
                    if not any(np.array_equal(c, member) for c in centres):
                        centres.append(member)
                elif any(linked(c, member) for c in centres):
                    found.append(i)
            if found:
                rows = part.take(pa.array(found))
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("centre")], names=["a", "b"])


def _apart(signatures: np.ndarray, labels: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(equal fields, i, j) of pairs with different labels and a high estimate; ``left`` marks the first block of two,
    and then only pairs across the two blocks count."""
    needed = _equal_needed()
    both = left.any() and not left.all()
    for i in range(len(labels)):
        others = np.flatnonzero(~left) if both else np.arange(i + 1, len(labels))
        if both and not left[i]:
            continue
        others = others[labels[others] != labels[i]]
        if not len(others):
            continue
        x = signatures[others] ^ signatures[i]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        equal = MINIMA - np.bitwise_count(x & np.uint64(_NIBBLE)).sum(axis=1)
        for j in np.flatnonzero(equal >= needed).tolist():
            yield int(equal[j]), i, int(others[j])


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    signatures = table.column("signature").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), LONGS)
    left = table.column("block").to_numpy() == table.column("i").to_numpy()
    return ids, signatures, table.column("label").to_numpy(), left


def _involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block pair that have a candidate in another component."""
    for table in groups(batches, ["key", "i", "j"]):
        _, signatures, labels, left = _columns(table)
        met = np.zeros(len(labels), bool)
        for _, i, j in _apart(signatures, labels, left):
            met[[i, j]] = True
        if met.any():
            yield from table.filter(pa.array(met)).to_batches()


def _with_sets(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    """Whole groups without their texts, and the shingle set of each row. Texts are read in stretches and let go."""
    held: list[pa.RecordBatch] = []
    sets: list[np.ndarray] = []
    for opens, run in runs(batches, keys):
        if opens and held:
            yield pa.Table.from_batches(held), sets
            held, sets = [], []
        for part in stretches(run, "text"):
            sets += shingle_sets(part.column("text").to_pylist())
            # Copied, since columns of a received batch share one buffer with its texts.
            held.append(part.drop_columns(["text"]).take(pa.array(range(part.num_rows), pa.int64())))
    if held:
        yield pa.Table.from_batches(held), sets


def _check_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links on full sets that join two components of a block pair, best estimates first."""
    for table, sets in _with_sets(batches, ["key", "i", "j"]):
        ids, signatures, labels, left = _columns(table)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for _, i, j in sorted(_apart(signatures, labels, left), reverse=True):
            a, b = root(int(labels[i])), root(int(labels[j]))
            if a != b and linked(sets[i], sets[j]):
                parent[a] = b
                found.append((int(ids[i]), int(ids[j])))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` of every row of ``docs``; other columns are left out.

    Texts without words have no shingles and are linked with nothing; texts of fewer than five words have one. Rows
    with equal sets are linked, whatever their ids, and each text of a ``doc_id`` with several is judged by itself. A row
    with null id is linked by its text like others, but cannot name a component: where no linked row has an id, the
    component is null and its rows are kept. An empty table gives no rows. Texts of any length are read whole.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = durable(arrow_map(rows.withColumn("text_hash", F.xxhash64("text")), _signed, SIGNED))
    # Equal digests have equal keys and signatures; a class stands for itself under a number, not under an id of its rows.
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min(F.struct("text_hash", "keys", "signature", "n_shingles")).alias("r"), F.min("doc_id").alias("least_id"))
    )
    classes = bounded_parts(classes, signed.count(), CLASS_ROWS)
    classes = durable(classes.select(F.monotonically_increasing_id().alias("id"), "digest", "r.*", "least_id"))
    bands = classes.select("id", F.explode("keys").alias("key"))
    order = F.struct(F.xxhash64("id").alias("h"), "id")
    shared = bands.groupBy("key").agg(
        F.min(order)["id"].alias("low"), F.max(order)["id"].alias("high"), F.count("*").alias("members")
    )
    n_bands = BANDS * classes.count()
    shared = durable(bounded_parts(shared.where("members > 1"), n_bands))
    met = shared.agg(F.sum("members").alias("n")).first()["n"] or 0
    pairs = bands.join(shared, "key").select("id", F.explode(F.array("low", "high")).alias("centre"))
    pairs = pairs.where("id <> centre").distinct()
    signatures = classes.select("id", "signature")
    pairs = pairs.join(signatures, "id").join(
        signatures.select(F.col("id").alias("centre"), F.col("signature").alias("other")), "centre"
    )
    pairs = pairs.where(_fields_equal(F.col("signature"), F.col("other")) >= _equal_needed()).select("id", "centre")
    pairs = durable(bounded_parts(pairs, 2 * met))
    shown = rows.withColumn("text_hash", F.xxhash64("text"))
    representatives = classes.select("id", "text_hash")
    tested = pairs.count()
    # Dealt anew, since the comparisons before it need all their tasks.
    first = _centre_links(shown, representatives, pairs, tested)
    first = durable(first.repartition(parts_needed(tested)))
    links = first.count()
    found = components(first, links)
    apart, most = _apart_links(shown, representatives, classes, shared, found, n_bands)
    named = components(first.select("a", "b").union(apart), links + most).withColumnRenamed("id", "own")
    digests = classes.select("id", "digest", "least_id").join(named, F.col("own") == F.col("id"), "left")
    digests = digests.select("digest", "least_id", F.coalesce("component", "id").alias("component"))
    names = digests.groupBy("component").agg(F.min("least_id").alias("name"))
    digests = digests.join(names, "component").select("digest", "name")
    joined = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(digests, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("name")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
        "text_hash",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with only the document of least id of each component. Rows that repeat an id and its text are one
    document and stay together; rows of null id go when a row with an id is linked with them."""
    gone = near_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    gone = lookup_side(gone.distinct())
    own = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(gone, F.col(id_col).cast("bigint").eqNullSafe(F.col("_id")) & (own == F.col("_hash")), "left_anti")


def _texts(rows: DataFrame, representatives: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, text`` of the wanted classes: copies of a text are made one before anything is shuffled."""
    hashes = representatives.join(wanted.select("id").distinct(), "id")
    hashes = lookup_side(bounded_parts(hashes, wanted.count()))
    held = rows.select("text_hash", "text").join(hashes.select("text_hash").distinct(), "text_hash", "left_semi")
    return held.groupBy("text_hash").agg(F.min("text").alias("text")).join(hashes, "text_hash").select("id", "text")


def _centre_links(rows: DataFrame, representatives: DataFrame, pairs: DataFrame, tested: int) -> DataFrame:
    """Those of the ``tested`` pairs of member and centre that are similar on full sets. Members of a large centre spread
    over salts."""
    salts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / CENTRE_ROWS).cast("int").alias("salts"))
    members = pairs.join(salts, "centre").select(
        "id", "centre", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("own")
    )
    owners = salts.select(
        F.col("centre").alias("id"), "centre", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("own")
    )
    # No centre has more salts than members, so there are no more owners than pairs.
    needed = durable(bounded_parts(members.unionByName(owners), 2 * tested))
    grouped = (
        _texts(rows, representatives, needed)
        .join(needed, "id")
        .select("id", "centre", "salt", "own", "text")
        .repartition("centre", "salt")
        .sortWithinPartitions("centre", "salt", F.desc("own"))
    )
    return arrow_map(grouped, _check_centres, "a bigint, b bigint")


def _apart_links(
    rows: DataFrame, representatives: DataFrame, classes: DataFrame, shared: DataFrame, found: DataFrame, n_bands: int
) -> tuple[DataFrame, int]:
    """Links between components within buckets of three and more members, found by comparing blocks completely, and a
    bound of their number. All classes together have ``n_bands`` bands.

    A bucket has as many blocks as its members or their shingles need, so a few texts of many shingles fill a block.
    """
    bands = classes.select("id", "n_shingles", F.explode("keys").alias("key"))
    crowded = bands.join(shared.where("members > 2").select("key", "members"), "key")
    label = F.coalesce("component", "id").alias("label")
    crowded = crowded.join(found, "id", "left").select("key", "members", "id", "n_shingles", label)
    # Parts for the rows that the join reads, not only for those it keeps.
    crowded = durable(bounded_parts(crowded, n_bands))
    split = crowded.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.sum("n_shingles").alias("volume"))
    split = split.where("a <> b").select("key", "volume")
    open_rows = crowded.join(split, "key").join(classes.select("id", "signature"), "id")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("volume") / BLOCK_SHINGLES)).cast("int")
    open_rows = open_rows.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    paired = open_rows.select(
        "key", "id", "label", "signature", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    # A block meets itself only when the bucket is one block or as the pair (i, i).
    paired = paired.select(
        "key", "id", "label", "signature", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    schema = "key bigint, id bigint, label bigint, signature array<bigint>, block int, i int, j int"
    keys = ["key", "i", "j"]
    met = durable(arrow_map(paired.repartition(*keys).sortWithinPartitions(*keys), _involved, schema))
    whole = met.join(_texts(rows, representatives, met), "id").select(*met.columns, "text")
    whole = whole.repartition(*keys).sortWithinPartitions(*keys)
    # Links that join components of a block pair are fewer than its rows.
    return arrow_map(whole, _check_blocks, "a bigint, b bigint"), met.count()
