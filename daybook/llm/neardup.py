"""Near-duplicate classes with DartMinHash signatures.

A text is the weighted set of its five-word shingles (weight: how often the
shingle occurs; a text of one to four words is one shingle).  DartMinHash
throws darts into the region of every element, its weight times the rank axis:
each unit cell gets a Poisson(1) number of darts from a hash of (element,
weight cell, rank cell), a dart lies at a hashed weight and rank, and counts if
it is under the element's weight.  Each dart belongs to one of ``k``
coordinates; the earliest dart of a coordinate is its signature value.  Two
texts agree on a coordinate with the probability of their weighted Jaccard
similarity, sum of minima over sum of maxima.

``classes`` then works on distinct word sequences (exact copies fold first, by
a partial aggregate):

1. signatures are cut into bands; a band's key names a bucket;
2. each bucket's members are compared with one leader (a star, not all pairs)
   by the exact similarity of the whole shingle sets;
3. classes are the connected components of the verified links;
4. buckets whose other members still belong to different classes are cut into
   blocks of bounded size; a task takes two blocks, finds pairs of different
   classes whose signatures are close, each pair in the first band it shares,
   and verifies them exactly; one link per pair of classes is enough;
5. components again, over all links.

Every link between texts that share a bucket is thus found up to the signature
margin of step 4; with 32 bands of 6 a pair at 0.8 shares none with probability
6e-5.

Defined results: null texts and texts without words stand alone unless equal
(equal empty texts are copies; null texts only those of one id); rows that repeat
an id and text, null or not, are copies of each other; a null id is kept as null and sorts first as a class
id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, mix, steps, table, text_hash, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
MARGIN = 4  # standard deviations below the threshold that step 4 still verifies
BLOCK = 256

@dataclass
class Same:
    """Decides whether two payloads are near: a function of two values, or a
    native condition on two columns."""

    python: Callable | None = None
    native: Callable | None = None


_GOLD = np.uint64(0x9E3779B97F4A7C15)
# Cumulative probabilities of Poisson(1), to the precision of a 64-bit hash.
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800, 39916800, 479001600)])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def shingles(words: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (ascending) and their counts."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = min(n, size)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h = mix(h ^ words[j : n - width + 1 + j]) + _GOLD
    return np.unique(h, return_counts=True)


def dart_minhash(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` signature values (dart hashes) of a weighted set."""
    weights = np.asarray(weights, np.float64)
    if not len(elements):
        return np.zeros(k, np.uint64)
    # Darts wanted: enough that an empty coordinate is rare (then doubled).
    top = k * (np.log(k) + 3) / weights.sum()
    n_weight = np.ceil(weights).astype(np.int64)
    while True:
        n_rank = int(np.ceil(top))
        # Unit cells: element x weight cell x rank cell.
        element = np.repeat(elements, n_weight)
        cell_w = np.arange(len(element)) - np.repeat(np.cumsum(n_weight) - n_weight, n_weight)
        limit = np.repeat(weights, n_weight) - cell_w
        base = mix(element ^ mix(cell_w.astype(np.uint64) + _GOLD))
        rank0 = np.tile(np.arange(n_rank), len(base))
        cell = mix(np.repeat(base, n_rank) + (rank0.astype(np.uint64) + np.uint64(1)) * _GOLD)
        n_darts = np.searchsorted(_POISSON, _unit(cell), "right")
        owner = np.repeat(np.arange(len(cell)), n_darts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_darts) - n_darts, n_darts)
        dart = mix(cell[owner] ^ mix(nth.astype(np.uint64) + np.uint64(7)))
        rank = rank0[owner] + _unit(mix(dart + np.uint64(1)))
        under = (rank < top) & (_unit(mix(dart + np.uint64(2))) < limit[owner // n_rank])
        dart, rank = dart[under], rank[under]
        coordinate = (mix(dart + np.uint64(3)) % np.uint64(k)).astype(np.int64)
        last_first = np.lexsort((dart, rank))[::-1]
        out, seen = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[coordinate[last_first]] = dart[last_first]
        seen[coordinate] = True
        if seen.all():
            return out
        top *= 2


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = mix(np.arange(bands, dtype=np.uint64) + _GOLD)
    for column in signature.reshape(bands, rows).T:
        key = mix(key ^ column) + _GOLD
    return key


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed shingle sets."""
    (ka, wa), (kb, wb) = _unpack(a), _unpack(b)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    shared = int(np.minimum(wa[ia], wb[ib]).sum())
    total = int(wa.sum()) + int(wb.sum()) - shared
    return shared / total if total else 1.0


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind, body = blob[-1], blob[:-1]
    n = len(body) // (12 if kind else 8)
    keys = np.frombuffer(body, "<u8", n)
    return keys, np.frombuffer(body, "<u4", n, 8 * n).astype(np.int64) if kind else np.ones(n, np.int64)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """64-bit hashes, then 32-bit counts unless all are 1, then which of both."""
    counted = not (counts == 1).all()
    return keys.astype("<u8").tobytes() + (counts.astype("<u4").tobytes() if counted else b"") + bytes([counted])


def _word_lists(texts: list[bytes | None]):
    hasher = WordHasher()
    for a, b in steps(texts):
        words, counts = hasher(texts[a:b])
        ends = np.cumsum(counts)
        for i in range(b - a):
            yield words[ends[i] - counts[i] : ends[i]]


def sketches(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """Per row: ``id``, ``hash``, ``node`` (its word sequence, 16 bytes; null
    for a null text), ``weight``, ``signature`` (16-bit values) and ``bands``."""
    source = docs.select(docs[id_col].alias("id"), text_hash(docs[text_col]).alias("hash"), docs[text_col].alias("text"))
    k = bands * rows

    def task(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            out: dict[str, list] = {"node": [], "weight": [], "signature": [], "bands": []}
            for text, words in zip(texts, _word_lists(texts), strict=True):
                n = len(words)
                if not n:  # texts without words are equal only as whole texts
                    out["node"].append(None if text is None else hashlib.blake2b(text, digest_size=16).digest())
                    for c in ("weight", "signature", "bands"):
                        out[c].append(None)
                    continue
                place = np.arange(1, n + 1, dtype=np.uint64)
                out["node"].append(b"".join(int(mix(words ^ mix(place * p)).sum(dtype=np.uint64) + n & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big") for p in (_GOLD, np.uint64(0xD1B54A32D192ED03))))
                signature = dart_minhash(*shingles(words), k)
                out["weight"].append(max(1, n - SHINGLE + 1))
                out["signature"].append((signature & np.uint64(0xFFFF)).astype("<u2").tobytes())
                out["bands"].append(band_keys(signature, bands, rows).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out["node"], pa.binary()), pa.array(out["weight"], pa.int64()), pa.array(out["signature"], pa.binary()), pa.array(out["bands"], pa.list_(pa.int64()))],
                names=["id", "hash", "node", "weight", "signature", "bands"],
            )

    schema = T.StructType([source.schema["id"], source.schema["hash"]] + [T.StructField("node", T.BinaryType()), T.StructField("weight", T.LongType()), T.StructField("signature", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return source.mapInArrow(task, schema)


def _judged(pairs: DataFrame, payload: DataFrame, same: Same) -> DataFrame:
    """The pairs (a, b) of nodes whose payloads ``same`` accepts."""
    both = (
        pairs.join(payload.withColumnsRenamed({"node": "a", "payload": "left"}), "a")
        .join(payload.withColumnsRenamed({"node": "b", "payload": "right"}), "b")
        .select("a", "b", "left", "right")
    )
    if same.native:
        return both.where(same.native(F.col("left"), F.col("right"))).select("a", "b")
    decide = same.python

    def task(batches):
        for batch in batches:
            keep = [decide(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(task, "a bigint, b bigint")


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(node, payload): packed shingle sets of the rows ``wanted`` (node, id,
    hash), which stand for their texts."""
    wanted = wanted.withColumnsRenamed({"id": "want_id", "hash": "want_hash"})
    source = docs.select(docs[id_col].alias("id"), text_hash(docs[text_col]).alias("hash"), docs[text_col].alias("text"))
    found = source.join(wanted, F.col("id").eqNullSafe(F.col("want_id")) & (F.col("hash") == F.col("want_hash"))).select("node", "text")

    def task(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(*shingles(w)) for w in _word_lists(texts)], pa.binary())], names=["node", "payload"])

    # Rows that repeat an id and text give the same set.
    return found.mapInArrow(task, "node bigint, payload binary").dropDuplicates(["node"])


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a, b): comp is the least node
    of its component.  Large-star and small-star steps until nothing changes;
    each round is a few aggregates and joins, written out."""
    edges = written(_star_input(links), "links")
    while True:
        # Large star: a node's greater neighbours go to its least neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        # Small star: a node and its smaller neighbours go to the least one.
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        after = written(small.where(F.col("a") != F.col("b")).distinct(), "links")
        same = _digest(after) == _digest(edges)
        edges = after
        if same:
            break
    stars = after.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return stars.unionByName(stars.select(F.col("comp").alias("node"), "comp").distinct())


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.xxhash64(F.lit(1), "a", "b").cast("decimal(38,0)"))).first())


def _star_input(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def _block_links(members: DataFrame, rows: int, floor: float, decide: Callable | None) -> DataFrame:
    """Pairs (a, b) of different classes inside a bucket, in the first band
    they share, whose signatures agree on a share of ``floor`` or more and that
    ``decide`` accepts (None: all of them).  ``members``: key, band, size,
    major, node, comp, signature, payload; nodes of the bucket's ``major``
    class are compared with the others only.

    Both kinds are cut into blocks by a hash of the node.  A block of others
    goes to every block of its bucket, a block of the major class to every
    block of others, so tasks hold two blocks and most rows are sent once."""
    other = F.col("comp") != F.col("major")
    sized = members.withColumns({"other": other, "n_other": F.ceil(F.col("others") / BLOCK).cast("int"), "n_major": F.ceil((F.col("size") - F.col("others")) / BLOCK).cast("int")})
    block = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.when(F.col("other"), F.col("n_other")).otherwise(F.col("n_major")))).cast("int")
    packed = sized.withColumn("block", block).groupBy("key", "other", "block").agg(
        F.first("band").alias("band"), F.first("n_other").alias("n_other"), F.first("n_major").alias("n_major"),
        F.collect_list(F.struct("node", "comp", "signature", "payload")).alias("rows"),
    )
    # Meetings: (others i, others j >= i) and (others i, major j).
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    none = F.array().cast("array<struct<kind:int,i:int,j:int>>")
    meet = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    mine = F.col("block")
    with_others = F.transform(upto(F.col("n_other")), lambda x: meet(0, F.least(x, mine), F.greatest(x, mine)))
    with_major = F.when(F.col("n_major") > 0, F.transform(upto(F.col("n_major")), lambda x: meet(1, mine, x))).otherwise(none)
    as_major = F.transform(upto(F.col("n_other")), lambda x: meet(1, x, mine))
    sent = packed.select("key", "band", "rows", F.explode(F.when(F.col("other"), F.concat(with_others, with_major)).otherwise(as_major)).alias("meeting"))
    met = sent.groupBy("key", "meeting").agg(F.first("band").alias("band"), F.collect_list("rows").alias("sides"))

    def task(batches):
        for batch in batches:
            for band, sides in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sides = [[(x["node"], x["comp"], np.frombuffer(x["signature"], "<u2"), x["payload"]) for x in side] for side in sides.as_py()]
                left, right = sides[0], sides[-1]
                signatures = np.array([s for _, _, s, _ in right])
                comps = np.array([c for _, c, _, _ in right])
                joined: dict[int, int] = {}

                def root(c, joined=joined):
                    while c in joined:
                        c = joined[c]
                    return c

                a, b = [], []
                for node, comp, signature, payload in left:
                    agree = signatures == signature
                    first = agree.reshape(len(right), -1, rows).all(2).argmax(1) == band
                    for j in np.flatnonzero((agree.mean(1) >= floor) & (comps != comp) & first):
                        x, y = root(comp), root(int(comps[j]))
                        if decide is not None and (x == y or not decide(payload, right[j][3])):
                            continue
                        if decide is not None:
                            joined[x] = y
                        a.append(max(node, right[j][0]))
                        b.append(min(node, right[j][0]))
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.select("band", "sides").mapInArrow(task, "a bigint, b bigint").distinct()


def linked(nodes: DataFrame, payload_of: Callable[[DataFrame], DataFrame], same: Same, *, rows: int, threshold: float, floor: float) -> DataFrame:
    """(node, comp) of the nodes that are linked to others, steps 2 to 5 above.
    ``nodes``: node (a number), id, hash, weight, copies, signature (16-bit
    values) and bands; ``payload_of`` gives (node, payload) of the nodes that
    share a bucket; texts whose weights differ by more than ``threshold``
    allows are not compared."""
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = written(buckets.join(shared, "key").select("key", "band", "size", "node"), "buckets")
    facts = nodes.select("node", "id", "hash", "weight", "copies")
    payload = written(payload_of(buckets.select("node").distinct().join(facts.select("node", "id", "hash"), "node")), "payload")
    known = buckets.join(facts.select("node", "weight", "copies"), "node")
    leaders = known.groupBy("key").agg(F.max(F.struct("copies", F.xxhash64("node").alias("order"), F.col("node").alias("leader"), F.col("weight").alias("leader_weight"))).alias("top"))
    known = written(known.join(leaders.select("key", "top.leader", "top.leader_weight"), "key"), "led")
    stars = (
        known.where(F.col("node") != F.col("leader"))
        .where(F.least("weight", "leader_weight") >= threshold * F.greatest("weight", "leader_weight"))
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    links = written(_judged(stars, payload, same), "star-links")
    first = written(components(links), "components")
    # What the leader has met is done: the others of a bucket of three or more.
    rest = known.where("size > 2 AND node != leader").join(first, "node", "left").select("key", "band", "node", F.coalesce("comp", "node").alias("comp"))
    rest = written(rest, "members")
    per_comp = rest.groupBy("key", "comp").agg(F.count("*").alias("n"))
    open_keys = per_comp.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("size"), F.count("*").alias("comps")).where("comps > 1")
    open_keys = open_keys.select("key", "size", F.col("top.comp").alias("major"), (F.col("size") - F.col("top.n")).alias("others"))
    members = rest.join(open_keys, "key").join(nodes.select("node", "signature"), "node")
    if same.python:
        more = _block_links(members.join(payload, "node"), rows, floor, same.python)
    else:
        more = _judged(_block_links(members.withColumn("payload", F.lit(None).cast("binary")), rows, floor, None), payload, same)
    return components(links.unionByName(written(more, "block-links")))


def classes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document row: ``id``, ``hash`` (of its text), ``class_id``
    (least id of the class), ``class_size`` (rows) and ``kept`` (true for one
    row of each class: least id, then least hash, then one of the rows that repeat
    both)."""
    rowwise = written(sketches(docs, id_col, text_col, bands, rows), "sketches")
    # Distinct texts; the row that stands for a text is the one of least id.
    # They are numbered as they are written, so the numbers stay.
    nodes = written(
        rowwise.where("weight IS NOT NULL").groupBy("node")
        .agg(F.min(F.struct("id", "hash")).alias("row"), F.count("*").alias("copies"), F.first("weight").alias("weight"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("number"), "node", "row.id", "row.hash", "copies", "weight", "signature", "bands"),
        "texts",
    )
    floor = threshold - MARGIN * (threshold * (1 - threshold) / (bands * rows)) ** 0.5
    same = Same(python=lambda a, b: similarity(a, b) >= threshold)
    numbered = nodes.drop("node").withColumnRenamed("number", "node")
    comps = linked(numbered, lambda wanted: _shingle_sets(docs, id_col, text_col, wanted), same, rows=rows, threshold=threshold, floor=floor)
    named = written(nodes.select("number", "node").join(comps.withColumnRenamed("node", "number"), "number").select("node", "comp"), "components")
    # A null text has no node to share: it is a class with those of the same id.
    alone = F.concat(F.lit("null "), F.coalesce(F.concat(F.lit("of "), F.col("id").cast("string")), F.lit("")))
    label = F.when(F.col("comp").isNotNull(), F.col("comp").cast("string")).when(F.col("node").isNotNull(), F.hex("node")).otherwise(alone)
    labelled = rowwise.select("id", "hash", "node").join(named, "node", "left").select("id", "hash", label.alias("class"))
    # Rows are numbered as they are written, so one of several rows with the same
    # id and text can be named, and AQE sees two plain sides and can split a large class.
    labelled = written(labelled.withColumn("number", F.monotonically_increasing_id()), "labelled")
    groups = written(labelled.groupBy("class").agg(F.min(F.struct("id", "hash", "number")).alias("least"), F.count("*").alias("class_size")), "classes")
    return labelled.join(groups, "class").select("id", "hash", F.col("least.id").alias("class_id"), "class_size", (F.col("number") == F.col("least.number")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each class.  (Of rows that repeat the kept row's
    id and text one stays; their other columns are those of any of them.)"""
    judged = written(classes(docs, id_col=id_col, text_col=text_col, **kw), "near-duplicates")
    fates = judged.groupBy("id", "hash").agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    gone = fates.where("NOT stays").select(F.col("id").alias("gone_id"), F.col("hash").alias("gone_hash"))
    rest = docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]) & (text_hash(docs[text_col]) == gone["gone_hash"]), "left_anti")
    # Equal ids and texts are one class, so this changes nothing where none repeats.
    return rest if fates.where("stays AND n > 1").isEmpty() else _one_per_row(rest, id_col, text_col)


def _one_per_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    tagged = docs.withColumn("__hash", text_hash(docs[text_col]))
    return tagged.dropDuplicates([id_col, "__hash"]).drop("__hash")


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")
