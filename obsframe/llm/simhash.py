"""Near duplicates by SimHash: every pair of fingerprints within ``distance`` bits, and their components.

Candidates come from a generalised pigeonhole. The 64 bits are dealt into m parts; with thresholds that add
up to distance - m + 1 (-1 leaves a part out), two fingerprints within ``distance`` bits differ by at most its
threshold in some part. Bits that go together are put into one part, so that the parts are as independent as
the corpus allows; a dynamic programme gives each part its threshold so that the candidates to be verified and
the rows to be shuffled cost least, estimated from counts over all fingerprints.

Fingerprints are made distinct first, so copies meet no one. A part's key with more than ``crowd`` members is
not compared pair by pair: it is dealt again by the bits outside the key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import keep_rows, mark_of, stored, table, tasks, text_of
from obsframe.llm.components import labels

BITS = 64
SHINGLE = 3
SEED = 42
#: Members of one key that are compared pair by pair; above it the key is dealt again.
CROWD = 2048
#: Rows that one comparison of two members costs as much as: shuffling one row is far dearer.
COMPARISON = 0.01


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text in UTF-8: words between ASCII white space, A-Z lower-cased, XXH64 of each shingle."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8")
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes + 1) - 1
        starts = (stops - sizes)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[b:e], SEED) for b, e in zip(starts, stops[shingle - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 4096):  # bit i of the fingerprint is bit i of the hashes, from the lowest
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, mark, fp (the fingerprint's 64 bits as a signed long) for each row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], dtype="<u8")
            columns = [batch.column("doc_id"), batch.column("mark"), pa.array(marks.view("<i8"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "fp"])

    kept = docs.select("doc_id", mark_of().alias("mark"), text_of().cast("binary").alias("text"))
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields[:2], T.StructField("fp", T.LongType())]))


def _joint_counts(marks: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, of those that have both: sums over all of them."""

    def run(batches):
        total = np.zeros(BITS * BITS)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1 << 15):
                fp = np.ascontiguousarray(batch.column("fp").slice(begin, 1 << 15).to_numpy())
                bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).ravel()
        yield pa.RecordBatch.from_pydict({"pair": np.arange(BITS * BITS), "n": total.astype(np.int64)})

    sums = marks.select("fp").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(BITS * BITS)
    for row in sums.collect():  # 4,096 rows, whatever the input
        counts[row["pair"]] = row["n"]
    return marks.count(), counts.reshape(BITS, BITS)


def correlated_parts(n: int, joint: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits into m parts of equal size, bits that go together into one part."""
    p = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs(joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, parts = set(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        part = [max(free, key=lambda b: (max((tie[b, c] for c in free if c != b), default=0), -b))]
        free.discard(part[0])
        while len(part) < size:
            b = max(free, key=lambda b: (tie[b, part].mean(), -b))
            free.discard(b)
            part.append(b)
        parts.append(sorted(part))
    return parts


def _mask(part: list[int]) -> int:
    value = sum(1 << b for b in part)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _collisions(marks: DataFrame, masks: list[int]) -> list[float]:
    """For each mask the pairs of fingerprints that agree on it, counted over all of them."""
    keys = marks.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(k)) for k in masks])).alias("i", "key"))
    sizes = keys.groupBy("i", "key").agg(F.count("*").alias("c"))
    pairs = sizes.groupBy("i").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs"))
    found = {r["i"]: r["pairs"] for r in pairs.collect()}  # a row per mask
    return [found.get(i, 0.0) for i in range(len(masks))]


def _flips(part: list[int], threshold: int) -> list[tuple[int, int]]:
    """(lowest bit, all bits) of every way to differ in 1 to ``threshold`` bits of a part."""
    return [(_mask(c[:1]), _mask(list(c))) for k in range(1, threshold + 1) for c in combinations(part, k)]


def part_costs(n: int, p: np.ndarray, part: list[int], pairs: float, distance: int) -> dict[int, float]:
    """Cost of a part by threshold: rows to be shuffled plus comparisons.

    ``pairs`` agree on the part; with odds q/(1-q) that a bit differs, the elementary symmetric sums of the
    odds give how many more differ in one, two or more bits.
    """
    q = 2 * p[part] * (1 - p[part])
    odds = q / np.maximum(1 - q, 1e-9)
    sums = np.zeros(distance + 1)
    sums[0] = 1
    for o in odds:
        sums[1:] += sums[:-1] * o
    costs = {-1: 0.0}
    for t in range(distance + 1):
        rows = n * (1 + len(_flips(part, t)) / 2)
        costs[t] = rows + COMPARISON * pairs * sums[: t + 1].sum()
    return costs


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one a part, that add up to ``total`` at the least cost."""
    best = {0: (0.0, [])}
    for part in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in part.items():
                if used + t not in following or cost + more < following[used + t][0]:
                    following[used + t] = (cost + more, [*chosen, t])
        best = following
    return best[total]


def plan(marks: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that takes part in the search."""
    n, joint = _joint_counts(marks)
    p = np.diag(joint) / max(n, 1)
    dealt = {m: correlated_parts(n, joint, m) for m in range(2, distance + 2)} or {1: [list(range(BITS))]}
    pairs = iter(_collisions(marks, [_mask(part) for parts in dealt.values() for part in parts]))
    options = []
    for m, parts in dealt.items():
        costs = [part_costs(n, p, part, next(pairs), distance) for part in parts]
        options.append((*allocate(costs, distance - m + 1), parts))
    _, thresholds, parts = min(options, key=lambda o: o[0])
    return [(part, t) for part, t in zip(parts, thresholds) if t >= 0]


def _probes(marks: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """group, part, fp, base: each fingerprint under its own key of each part and, where the threshold allows
    differences, under the keys it may differ to. Of two keys only one probes the other."""

    def keys(i: int, part: list[int], threshold: int):
        def entry(key, base: bool):
            return F.struct(F.xxhash64(F.lit(i), key).alias("group"), F.lit(i).alias("part"), F.lit(base).alias("base"))

        own = F.col("fp").bitwiseAND(F.lit(_mask(part)))
        if not threshold:
            return F.array(entry(own, True))
        flips = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("all")) for a, b in _flips(part, threshold)])
        free = F.filter(flips, lambda f: F.col("fp").bitwiseAND(f["low"]) == 0)
        return F.concat(F.array(entry(own, True)), F.transform(free, lambda f: entry(own.bitwiseXOR(f["all"]), False)))

    arrays = [keys(i, part, threshold) for i, (part, threshold) in enumerate(parts)]
    return marks.select("fp", F.explode(F.concat(*arrays)).alias("e")).select("e.group", "e.part", "fp", "e.base")


def _redeal(crowded: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Deal crowded groups again by four parts of the bits outside their key."""
    subkeys = F.lit(None)
    for i, four in masks.items():
        keys = F.array(*[F.xxhash64("group", F.lit(j), F.col("fp").bitwiseAND(F.lit(k))) for j, k in enumerate(four)])
        subkeys = F.when(F.col("part") == i, keys).otherwise(subkeys)
    return crowded.select(F.explode(subkeys).alias("group"), "part", "fp", "base")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node to the smallest node of its component."""
    nodes, both = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = both[: len(a)], both[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        following = label.copy()
        np.minimum.at(following, left, least)
        np.minimum.at(following, right, least)
        np.minimum.at(following, label[left], least)
        np.minimum.at(following, label[right], least)
        following = following[following]
        if (following == label).all():
            break
        label = following
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def _compare(distance: int):
    """Function for mapInArrow over (group, fp, base) sorted by group: the links found, without those that
    others imply within a batch."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(group, fp, base):
        found_a, found_b, size = [], [], 0
        active, step = np.arange(len(group)), 0
        while len(active):
            step += 1
            active = active[active + step < len(group)]
            active = active[group[active] == group[active + step]]
            other = active + step
            near = np.bitwise_count((fp[active] ^ fp[other]).view(np.uint64)) <= distance  # unsigned: no sign to drop
            near &= (base[active] | base[other]) & (fp[active] != fp[other])
            found_a.append(fp[active[near]])
            found_b.append(fp[other[near]])
            size += int(near.sum())
            if size > 1 << 20:
                a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b, size = [a], [b], len(a)
        return forest(np.concatenate(found_a), np.concatenate(found_b)) if size else None

    def run(batches):
        held = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "fp", "base")]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last group may go on
            found = links(*[x[:whole] for x in held])
            held = [x[whole:] for x in held]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)
        if held is not None and len(held[0]):
            found = links(*held)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    return run


def near_links(marks: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """u, v: links that connect whatever fingerprints within ``distance`` bits connect. ``marks`` has one row
    per distinct fingerprint (fp)."""
    parts = plan(marks, distance)
    rows, found = _probes(marks, parts), None
    inside = {i: list(part) for i, (part, _) in enumerate(parts)}
    while True:
        rows = stored(rows, "probes")
        sizes = rows.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
        big = stored(sizes.select("group"), "crowds")
        outside = {i: [b for b in range(BITS) if b not in used] for i, used in inside.items()}
        last = min(map(len, outside.values())) < distance + 1 or big.isEmpty()
        calm = rows if last else rows.join(big, "group", "left_anti")
        n = tasks(marks.sparkSession)
        dealt = calm.select("group", "fp", "base").repartition(n, "group").sortWithinPartitions("group")
        links = dealt.mapInArrow(_compare(distance), "u long, v long")
        found = links if found is None else found.union(links)
        if last:
            return found
        masks = {}
        for i, bits in outside.items():
            four = [bits[j :: distance + 1] for j in range(distance + 1)]
            masks[i] = [_mask(x) for x in four]
        rows = _redeal(rows.join(big, "group", "left_semi"), masks)
        inside = {i: used + outside[i][0 :: distance + 1] for i, used in inside.items()}


def near_duplicates(docs: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """doc_id, mark, fp, component_id, component for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links of at most ``distance`` differing bits reach, the row's own
    included; component is the smallest fingerprint of it. Null and empty texts have fingerprint 0 and link like others; equal fingerprints always link;
    rows with a null doc_id take part, and component_id is null only where no row of the component has one.
    An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    marks = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "marks")
    found = labels(near_links(marks.select("fp"), distance, crowd)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = marks.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_mark = stored(rooted.join(least.hint("merge"), "root").select("fp", "component_id", F.col("root").alias("component")), "components")
    # Plain shuffles on both sides: adaptive execution splits a fingerprint that fills a partition.
    return rows.join(by_mark.hint("merge"), "fp").select("doc_id", "mark", "fp", "component_id", "component")


def without_near_copies(docs: DataFrame, distance: int = 3) -> DataFrame:
    """Of each component the row with the smallest doc_id (then mark), with all its columns."""
    rows = stored(near_duplicates(docs, distance).withColumn("row", F.monotonically_increasing_id()), "components")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "row")
    stays = rows.groupBy("component").agg(F.min(order).alias("stays")).select(F.col("stays.row").alias("row"), F.lit(True).alias("kept"))
    decided = rows.join(stays.hint("merge"), "row", "left")
    return keep_rows(docs, decided.select("doc_id", "mark", F.coalesce("kept", F.lit(False)).alias("kept")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
