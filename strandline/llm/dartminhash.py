"""Near-duplicate classes by DartMinHash.

A text is a weighted set: its shingles of five words with their counts. Every element has
a region, its weight wide and without end in time, cut into strips of unit width; hashed
darts fall into each strip as a Poisson process in time that depends on the element alone.
A text throws the darts of its regions up to a time at which about K (ln K + 4) of them
have fallen in all, whatever its length, deals them to K coordinates by hash and keeps
the earliest of each. Two texts agree in a coordinate with the probability of their weighted
Jaccard similarity. If a coordinate stays empty, the time is doubled.

Signatures are joined by bands. The members of a band's bucket are not paired with each
other: each is compared with the bucket's earliest text. Every candidate pair is checked
on its whole shingle sets. Connected components of the checked pairs are then refined:
where a bucket still holds several components, its members outside of the largest are
compared with all members of other components whose signatures agree with theirs in
LEAST_AGREEMENT coordinates or more. Small buckets give such pairs to the join; the members
of a bucket of more than SMALL are dealt into chunks with their sets, compared within the
chunk's task, and leave it as links that join components, one for each join at most. Where such a bucket
still holds several components after that, those of its members that are outside
of the largest are compared with all others, chunk by chunk, so that no pair of a bucket is left out.
Equal texts (by their words) are one node from the start.

Elements are compared by 32-bit fingerprints, which shifts a similarity by less than 1e-4.

Cases: null counts as empty; texts without a word form a class only with equal texts;
texts of one to four words have one shingle of all their words; repeated rows and repeated
ids are all returned, each with the class of its own text; an empty table gives no row;
other columns are ignored. A class's id is the least doc_id in it.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import Codes, blocks, discard, materialize, strings, texts

WORDS = re.compile(r"\w+")
SHINGLE = 5
BANDS, ROWS = 16, 4
K = BANDS * ROWS
SIMILARITY = 0.8
#: Signatures that agree in fewer coordinates are not tried again; at 0.8 that's 3.5 standard deviations off.
LEAST_AGREEMENT = 40
SMALL, CHUNK = 64, 512

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def strips(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A seed for each strip of each element's region, and the strip's width: 1, but for the last of a weight that is not whole."""
    counts = np.ceil(weights).astype(np.int64)
    ends = np.cumsum(counts)
    number = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)
    return mix(np.repeat(elements, counts) ^ mix(number.astype(np.uint64) * _A)), np.minimum(1.0, np.repeat(weights, counts) - number)


def throw(seeds: np.ndarray, widths: np.ndarray, until: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and times of the darts that fall into the strips before ``until``."""
    ids, times = [], []
    at, turn = np.zeros(len(seeds)), 0
    while len(seeds):
        h = mix(seeds + np.uint64((2 * turn + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log(unit(h))
        keep = at < until
        seeds, widths, at, h = seeds[keep], widths[keep], at[keep], h[keep]
        dart = mix(h ^ _B)
        if len(widths) and widths.min() < 1:
            inside = unit(mix(dart ^ _C)) < widths
            ids.append(dart[inside])
            times.append(at[inside])
        else:
            ids.append(dart)
            times.append(at)
        turn += 1
    return (np.concatenate(ids), np.concatenate(times)) if ids else (np.empty(0, np.uint64), np.empty(0))


def signature(elements: np.ndarray, weights: np.ndarray, k: int = K) -> np.ndarray:
    """The ids of the earliest dart of each of k coordinates. Needs a positive total weight."""
    seeds, widths = strips(elements, weights)
    until = k * (math.log(k) + 4) / float(weights.sum())
    out = np.zeros(k, np.uint64)
    while True:
        ids, times = throw(seeds, widths, until)
        order = np.argsort(-times, kind="stable")
        coordinate = (ids % np.uint64(k)).astype(np.int64)[order]
        filled = np.zeros(k, bool)
        filled[coordinate] = True
        if filled.all():
            out[coordinate] = ids[order]  # the earliest is written last
            return out
        until *= 2


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of each run of SHINGLE words; of all words if there are fewer."""
    n = len(words)
    if not n:
        return words
    size = min(SHINGLE, n)
    h = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        h = h * np.uint64(0x100000001B3) + words[j : j + len(h)]
    return mix(h + np.uint64(size))


def word_hashes(values: list[str]) -> list[np.ndarray]:
    codes = Codes()
    which = [np.fromiter(map(codes.__getitem__, WORDS.findall(v.lower())), np.int64) for v in values]
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in codes), np.uint64, len(codes))
    return [table[w] for w in which]


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A key for each band of each signature."""
    s = signatures.reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _A, (len(s), BANDS))
    for r in range(ROWS):
        key = mix(key + s[:, :, r])
    return key.astype(np.int64)


SIGNED_SCHEMA = "doc_id long, text_hash long, key binary, bands array<bigint>, sketch binary, cells binary"


def sign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: a 128-bit key of its words, its band keys, a byte per coordinate, and its sorted cell fingerprints."""

    def run(batches):
        for block in blocks(batches):
            values = strings(block)
            keys, found, sketches, cells = [], [], [], []
            for text, words in zip(values, word_hashes(values), strict=True):
                keys.append(hashlib.blake2b(words.tobytes() if len(words) else b"text" + text.encode(), digest_size=16).digest())
                if not len(words):
                    found.append([])
                    sketches.append(b"")
                    cells.append(b"")
                    continue
                elements, counts = np.unique(shingles(words), return_counts=True)
                weights = counts.astype(float)
                s = signature(elements, weights)
                found.append(s)
                sketches.append((s >> np.uint64(40)).astype(np.uint8).tobytes())
                cells.append(np.unique(strips(elements, weights)[0].astype(np.uint32)).tobytes())
            some = [i for i, f in enumerate(found) if len(f)]
            bands: list = [[]] * len(found)
            if some:
                for i, row in zip(some, band_keys(np.stack([found[i] for i in some])).tolist(), strict=True):
                    bands[i] = row
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").cast(pa.int64()), block.column("text_hash"), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(cells, pa.binary())],
                ["doc_id", "text_hash", "key", "bands", "sketch", "cells"],
            )

    plain = texts(df, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return plain.mapInArrow(run, SIGNED_SCHEMA)


def jaccard(a: bytes, b: bytes) -> float:
    both = np.concatenate([np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)])
    n = len(both)
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (n - common) if n else 0.0


def similar(pairs: DataFrame, cells: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose cells have a similarity of ``least`` or more. cells: key, cells; each key once."""

    def run(batches):
        for batch in batches:
            a, b = batch.column("cells_a"), batch.column("cells_b")
            keep = [jaccard(x.as_py(), y.as_py()) >= least for x, y in zip(a, b, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = cells.select(F.col("key").alias("a"), F.col("cells").alias("cells_a"))
    two = cells.select(F.col("key").alias("b"), F.col("cells").alias("cells_b"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "cells_a", "cells_b").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its connected component), for every node of an edge (a, b). Labels spread to neighbours and then jump to their label's label."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        spread = materialize(spread, "spread")
        jumped = spread.alias("x").join(spread.alias("y"), F.col("x.new") == F.col("y.node")).select("x.node", "x.old", F.col("y.new").alias("label"))
        jumped = materialize(jumped, "labels")
        changed = jumped.where("old <> label").limit(1).count()
        discard(spread)
        discard(labels)
        labels = jumped.select("node", "label")
        if not changed:
            discard(both)
            return labels


def _across(group: pa.Table, agreement: int) -> Iterator[tuple[int, np.ndarray]]:
    """A row outside of the group's largest component, and the rows of other components that may be similar, best first; each pair once."""
    sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, K)
    codes = Codes()
    number = np.array([codes[x] for x in group.column("label").to_pylist()])
    outside = number != np.bincount(number).argmax()
    rows = np.arange(len(number))
    for i in np.flatnonzero(outside).tolist():
        agree = np.count_nonzero(sketches == sketches[i], axis=1)
        maybe = np.flatnonzero((agree >= agreement) & (number != number[i]) & (~outside | (rows < i)))
        if len(maybe):
            yield i, maybe[np.argsort(-agree[maybe], kind="stable")]


def _pairs(a: list[bytes], b: list[bytes]) -> pa.Table:
    return pa.table({"a": pa.array(map(min, a, b), pa.binary()), "b": pa.array(map(max, a, b), pa.binary())})


def proposals(members: DataFrame, agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """Pairs of small buckets that are worth a check. members: band, key, label, sketch."""

    def run(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_pylist()
        found = [(keys[i], keys[j]) for i, others in _across(group, agreement) for j in others.tolist()]
        return _pairs([x for x, _ in found], [y for _, y in found])

    return members.groupBy("band").applyInArrow(run, "a binary, b binary").distinct()


def _joined(group: pa.Table, pairs: Iterator[tuple[int, np.ndarray]], least: float) -> pa.Table:
    """Those of the pairs that are similar, as far as they join components of the group."""
    keys, cells, labels = (group.column(c).to_pylist() for c in ("key", "cells", "label"))
    parent = {x: x for x in labels}

    def root(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for i, others in pairs:
        for j in others.tolist():
            x, y = root(labels[i]), root(labels[j])
            if x != y and jaccard(cells[i], cells[j]) >= least:
                parent[x] = y
                found.append((keys[i], keys[j]))
    return _pairs([x for x, _ in found], [y for _, y in found])


def resolved(members: DataFrame, least: float, agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """Links between components within chunks of large buckets. members: band, chunk, key, label, sketch, cells."""

    def run(group: pa.Table) -> pa.Table:
        return _joined(group, _across(group, agreement), least)

    return members.groupBy("band", "chunk").applyInArrow(run, "a binary, b binary")


def _between(group: pa.Table, agreement: int) -> Iterator[tuple[int, np.ndarray]]:
    """As ``_across``, of the rows that ask with those that are asked."""
    sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, K)
    codes = Codes()
    number = np.array([codes[x] for x in group.column("label").to_pylist()])
    keys = group.column("key").to_pylist()
    places = {x: n for n, x in enumerate(sorted(set(keys)))}
    place = np.array([places[x] for x in keys])
    asks, outside = (group.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "outside"))
    asked = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks).tolist():
        agree = np.count_nonzero(sketches[asked] == sketches[i], axis=1)
        maybe = np.flatnonzero((agree >= agreement) & (number[asked] != number[i]) & (~outside[asked] | (place[asked] < place[i])))
        if len(maybe):
            yield i, asked[maybe[np.argsort(-agree[maybe], kind="stable")]]


def finished(members: DataFrame, cells: DataFrame, least: float, agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """Links between components of buckets of several chunks, across all pairs of chunks. members: band, key, label, sketch."""

    def run(group: pa.Table) -> pa.Table:
        return _joined(group, _between(group, agreement), least)

    by_label = members.groupBy("band", "label").count()
    tops = by_label.groupBy("band").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("size"))
    tops = tops.select("band", F.col("top.label").alias("top"), (F.col("size") - F.col("top.count")).alias("others"), "size").where("others > 0")
    marked = members.join(tops, "band").withColumn("outside", F.col("label") != F.col("top")).join(cells, "key")
    rows, columns = (F.ceil(F.col(c) / CHUNK).cast("long") for c in ("others", "size"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    cols = ["band", "key", "label", "sketch", "cells", "outside"]
    asking = marked.where("outside").select(*cols, F.lit(True).alias("asks"), F.pmod(F.xxhash64("key"), rows).alias("row"), each(columns).alias("column"))
    asked = marked.select(*cols, F.lit(False).alias("asks"), F.pmod(F.xxhash64("key"), columns).alias("column"), each(rows).alias("row"))
    return asking.unionByName(asked).groupBy("band", "row", "column").applyInArrow(run, "a binary, b binary")


def classify(signed: DataFrame, least: float = SIMILARITY, agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """key and class_key of every text that is alike to a different one. ``signed`` must be materialized. ``agreement`` 0 checks every pair that shares a band."""
    nodes = materialize(signed.groupBy("key").agg(F.min("doc_id").alias("first"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")), "nodes")
    spread = nodes.select("key", "first", "sketch", F.posexplode("bands").alias("at", "band"), "bands")
    member = spread.select("band", "key", "first", "sketch", F.get("bands", F.pmod(F.col("at") + 1, F.lit(BANDS))).alias("other"))
    buckets = (
        member.groupBy("band")
        .agg(F.min(F.struct("first", "key")).alias("c"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("size"))
        .where("lo <> hi")
        .select("band", F.col("c.key").alias("center"), "size")
    )
    shared = materialize(member.join(buckets, "band").select("band", "key", "first", "sketch", "other", "center", "size"), "shared")
    order = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    pairs = materialize(shared.where("key <> center").select(*order("key", "center")).distinct(), "pairs")
    # One copy of a text stands for all; joined by its id too, so that a text of many copies is no hot key.
    wanted = shared.select(F.col("key").alias("wanted_key"), "first").distinct()
    one = (F.col("key") == F.col("wanted_key")) & F.col("doc_id").eqNullSafe(F.col("first"))
    cells = signed.select("key", "doc_id", "cells").join(wanted, one, "left_semi").groupBy("key", "doc_id").agg(F.any_value("cells").alias("cells"))
    cells = materialize(cells.select("key", "cells"), "cells")
    edges = materialize(similar(pairs, cells, least), "links")
    labels = components(edges)
    known = shared.join(labels.withColumnRenamed("node", "key"), "key", "left").select("band", "key", "sketch", "other", "size", F.coalesce("label", "key").alias("label"))
    open_ = known.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band")
    members = materialize(known.join(open_, "band"), "members")
    more = similar(proposals(members.where(F.col("size") <= SMALL), agreement), cells, least)
    # Members that share their next band too meet in a chunk; more than CHUNK of these are dealt out further, as the last step looks across chunks.
    big = members.where(F.col("size") > SMALL)
    same = big.groupBy("band", "other").agg(F.ceil(F.count("*") / CHUNK).alias("parts")).where("parts > 1")
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("key"), F.col("parts"))).otherwise(-1)
    chunk = F.xxhash64(F.when(part < 0, F.pmod(F.xxhash64("other"), F.ceil(F.col("size") / CHUNK))).otherwise(F.col("other")), part)
    dealt = big.join(same, ["band", "other"], "left").select("band", chunk.alias("chunk"), "key", "label", "sketch")
    large = dealt.join(cells, "key").select("band", "chunk", "key", "label", "sketch", "cells")
    found = materialize(more.union(resolved(large, least, agreement)), "links")
    discard(labels)
    labels = components(edges.union(found))
    several = members.where(F.col("size") > SMALL).drop("label").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    last = materialize(finished(several.select("band", "key", "label", "sketch"), cells, least, agreement), "links")
    if last.limit(1).count():
        discard(labels)
        labels = components(edges.union(found).union(last))
    discard(nodes, shared, pairs, cells, edges, found, members, last)
    return labels.select(F.col("node").alias("key"), F.col("label").alias("class_key"))


def _classes(signed: DataFrame, least: float, agreement: int) -> DataFrame:
    """key, class_id and the kept (doc_id, text_hash) of its class, for every key. Materialized."""
    first = signed.groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    labels = classify(signed, least, agreement)
    joined = materialize(first.join(labels, "key", "left").select("key", "kept", F.coalesce("class_key", "key").alias("class_key")), "classes")
    best = joined.groupBy("class_key").agg(F.min("kept").alias("kept"))
    out = materialize(joined.select("key", "class_key").join(best, "class_key").select("key", "kept"), "classes")
    discard(labels, joined)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """doc_id and class_id of every row. Runs jobs; intermediate tables lie below spark.checkpoint.dir, of which the result's stays."""
    signed = materialize(sign(df, id_col, text_col), "signed")
    classes = _classes(signed, least, agreement)
    out = materialize(signed.select("doc_id", "key").join(classes, "key").select("doc_id", F.col("kept.doc_id").alias("class_id")), "near")
    discard(signed, classes)
    return out


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """The rows of ``df``, all columns, one of each class: that of the least id. Of rows that are equal in id and text, but not in other columns, any one stays."""
    signed = materialize(sign(df, id_col, text_col), "signed")
    kept_id, kept_hash, row_hash = (f"_{uuid.uuid4().hex}" for _ in range(3))  # no column of ``df`` has such a name
    classes = _classes(signed, least, agreement)
    kept = materialize(classes.select("kept.doc_id", "kept.text_hash").distinct(), "kept").toDF(kept_id, kept_hash)
    discard(signed, classes)
    marked = df.withColumn(row_hash, F.xxhash64(F.col(f"`{text_col}`")))
    rows = marked.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(kept_id)) & (F.col(row_hash) == F.col(kept_hash)))
    return rows.dropDuplicates([id_col, row_hash]).select(*(F.col(f"`{c}`") for c in df.columns))
