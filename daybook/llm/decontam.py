"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the documents into shards (one task's consecutive
documents, about ``SHARD_WORDS`` words) and stores for each shard the postings
of every term that the benchmark uses: term -> ascending word positions in the
shard.  The index is partitioned by documents, as search engines do, so
postings never cross the network and a frequent term is a longer list in every
shard rather than one hot key.  The documents are read and indexed once,
however long the benchmark is: its terms are sent to the tasks while they are
at most ``VOCABULARY``, and beyond that every word is indexed.

``phrase_matches`` intersects the offset-adjusted position lists of all windows
of a block together, each from its rarest term (by counts over all documents)
on; a shard visits only windows whose rarest term it holds.
``proximity_matches`` finds places where all terms of a query stand within a
few words.

Benchmarks are searched in blocks of bounded size; a block (not the benchmark)
is held by the driver and sent to the tasks, as arrays of less than eight bytes per
byte of its text.

Defined results: a null or empty text has no words and is never hit; a null or
empty item has no window; equal ids are one item and a null id is the item ``""``; repeated document
rows are judged one by one; an empty benchmark leaves every document clean;
other columns are ignored by the search and kept by ``drop_contaminated``.
Words are compared as 64-bit hashes (chance of one wrong word in 10^13 words
against 10^4 terms: about 0.005; of a wrong window of 13: nil).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, mix, steps, table, text_hash, written

WINDOW = 13
ONE_IN = 20
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20  # benchmark text held by the driver at once
VOCABULARY = 1 << 22  # terms sent to the tasks; with more, every word is indexed
PAIRS = 1 << 20  # candidate places compared at once inside a task

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode().lower())


class Phrases:
    """The distinct windows of a block of benchmark items.  ``words`` holds the
    items' words as hashes; a window is where it starts and its length."""

    def __init__(self, items: list[tuple], size: int) -> None:
        self.names = ["" if i is None else str(i) for i, _ in items]
        self.size = size
        words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        hasher, texts = WordHasher(), [(t or "").encode() for _, t in items]
        for a, b in steps(texts):
            w, n = hasher(texts[a:b])
            words.append(w)
            counts.append(n)
        self.words, n = np.concatenate(words), np.concatenate(counts)
        windows = np.where(n > 0, np.maximum(1, n - size + 1), 0)
        item = np.repeat(np.arange(len(n), dtype=np.int32), windows)
        first = np.cumsum(n) - n
        at = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows) + first[item]
        length = np.minimum(n, size)[item]
        key = mix(length.astype(np.uint64))
        for o in range(int(length.max(initial=0))):
            inside = o < length
            key[inside] = mix(key[inside] ^ self.words[at[inside] + o])
        _, one, which = np.unique(key, return_index=True, return_inverse=True)
        self.starts, self.lengths = at[one].astype(np.int64), length[one].astype(np.int64)
        owned = np.unique(which.astype(np.int64) * max(1, len(n)) + item)
        window, self.owners = np.divmod(owned, max(1, len(n)))
        self.owner_ends = np.cumsum(np.bincount(window, minlength=len(one)))

    def terms(self) -> np.ndarray:
        return np.unique(self.words)

    def rarest_first(self, terms: np.ndarray, counts: np.ndarray) -> Plans:
        """The windows all of whose terms occur, with their offsets from the
        rarest term on; ``counts`` are those of the sorted ``terms``."""
        often = counts[np.searchsorted(terms, self.words)] if len(terms) else np.zeros(0, np.int64)
        wide = int(self.lengths.max(initial=0))
        order = np.zeros((len(self.starts), wide), np.min_scalar_type(max(1, wide)))
        absent = np.zeros(len(self.starts), bool)
        never = np.iinfo(np.int64).max
        for a in range(0, len(order), 1 << 16):
            start, length = self.starts[a : a + (1 << 16), None], self.lengths[a : a + (1 << 16), None]
            offset = np.arange(wide)
            n = np.where(offset < length, often[np.minimum(start + offset, len(often) - 1)], never)
            by = np.argsort(n, axis=1, kind="stable")
            absent[a : a + len(n)] = n.min(axis=1) == 0
            # Places beyond a short window repeat its rarest term.
            order[a : a + len(n)] = np.where(offset < length, by, by[:, :1])
        alive = np.flatnonzero(~absent)
        rare = self.words[self.starts[alive] + order[alive, 0]] if wide else np.zeros(0, np.uint64)
        by = np.argsort(rare, kind="stable")
        return Plans(self, alive[by], order[alive[by]], rare[by])


class Plans:
    """Windows sorted by their rarest term, as arrays that are sent to the tasks."""

    def __init__(self, phrases: Phrases, windows: np.ndarray, order: np.ndarray, rare: np.ndarray) -> None:
        self.names, self.words, self.order, self.pairs = phrases.names, phrases.words, order, PAIRS
        self.starts, self.lengths = phrases.starts[windows], phrases.lengths[windows]
        n = np.diff(phrases.owner_ends, prepend=0)[windows]
        self.owner_ends = np.cumsum(n)
        within = np.arange(n.sum()) - np.repeat(self.owner_ends - n, n)
        self.owners = phrases.owners[within + np.repeat(phrases.owner_ends[windows] - n, n)].astype(np.int32)
        self.rare, self.firsts = np.unique(rare, return_index=True)
        self.sizes = np.diff(np.append(self.firsts, len(rare)))


def blocks(bench: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The benchmark as lists of (item, text), each of about ``block_bytes``."""
    rows = bench.select(bench[item_col].alias("item"), bench[text_col].alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        yield sorted(((r["item"], r["text"]) for r in part.collect()), key=str)


def _as(batch: pa.RecordBatch, schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in kinds], schema=kinds)


def _bytes(a: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


INDEX = [("shard", pa.int64()), ("n_words", pa.binary()), ("terms", pa.binary()), ("ends", pa.binary()), ("postings", pa.binary())]


def build_index(docs: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray | None, window: int = WINDOW) -> DataFrame:
    """One row per shard: its documents (``ids``, ``hashes``, ``n_words``) and,
    per term of ``vocabulary`` (word hashes; none: every word), the positions
    in the shard."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), text_hash(docs[text_col]).alias("hash"))
    schema = T.StructType(
        [T.StructField("shard", T.LongType())]
        + [T.StructField(n, T.BinaryType()) for n, _ in INDEX[1:]]
        + [T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("hashes", T.ArrayType(T.LongType()))]
    )
    sent = docs.sparkSession.sparkContext.broadcast(None if vocabulary is None else np.unique(vocabulary))
    gap = window  # words between documents, so that no window spans two

    def task(batches):
        hasher = WordHasher()
        known = sent.value
        if known is not None:
            slots = 1 << max(10, int(4 * max(1, len(known))).bit_length())
            slot = np.full(slots, -1, np.int32)
            at = (known & np.uint64(slots - 1)).astype(np.int64)
            slot[at[::-1]] = np.arange(len(known))[::-1]
            clash = np.zeros(slots, bool)
            clash[np.flatnonzero(np.bincount(at, minlength=slots) > 1)] = True

        def places(words):
            """Which words are terms."""
            if known is None:
                return np.arange(len(words))
            where = (words & np.uint64(slots - 1)).astype(np.int64)
            found = slot[where]
            good = found >= 0
            good[good] = known[found[good]] == words[good]
            many = np.flatnonzero(clash[where] & ~good)
            if len(many):
                p = np.searchsorted(known, words[many])
                p[p == len(known)] = 0
                good[many[known[p] == words[many]]] = True
            return np.flatnonzero(good)

        part, serial = TaskContext.get().partitionId(), 0
        held: dict = {"ids": [], "hashes": [], "n": [], "t": [], "p": []}
        size = 0

        def flush():
            nonlocal serial, size
            t, p = np.concatenate(held["t"] or [np.zeros(0, np.uint64)]), np.concatenate(held["p"] or [np.zeros(0, np.int64)])
            by = np.argsort(t, kind="stable")
            t, p = t[by], p[by]
            terms, starts = np.unique(t, return_index=True)
            ends = np.append(starts[1:], len(t)) if len(terms) else starts
            out = {
                "shard": pa.array([(part << 32) | serial], pa.int64()),
                "n_words": pa.array([_bytes(np.concatenate(held["n"]), "<i8")], pa.binary()),
                "terms": pa.array([_bytes(terms, "<u8")], pa.binary()),
                "ends": pa.array([_bytes(ends, "<i8")], pa.binary()),
                "postings": pa.array([_bytes(p, "<i8" if size > 1 << 31 else "<i4")], pa.binary()),
                "ids": pa.array([held["ids"]]),
                "hashes": pa.array([held["hashes"]], pa.list_(pa.int64())),
            }
            serial, size = serial + 1, 0
            for v in held.values():
                v.clear()
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2)
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in steps(texts):
                words, counts = hasher(texts[a:b])
                hit = places(words)
                doc = np.repeat(np.arange(b - a), counts)
                held["ids"] += ids.slice(a, b - a).to_pylist()
                held["hashes"] += hashes.slice(a, b - a).to_pylist()
                held["n"].append(counts)
                held["t"].append(words[hit])
                held["p"].append(size + hit + gap * doc[hit])
                size += len(words) + gap * (b - a)
                if size >= SHARD_WORDS:
                    yield cast(flush())
        if held["n"]:
            yield cast(flush())

    def cast(batch):
        return _as(batch, schema)

    return rows.mapInArrow(task, schema)


class Shard:
    """Postings of one index row."""

    def __init__(self, row: dict, gap: int) -> None:
        self.n_words = np.frombuffer(row["n_words"], "<i8")
        self.starts = np.cumsum(self.n_words + gap) - (self.n_words + gap)
        self.terms, self.ends = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["ends"], "<i8")
        wide = len(self.ends) and len(row["postings"]) == 8 * self.ends[-1]
        self.postings = np.frombuffer(row["postings"], "<i8" if wide else "<i4").astype(np.int64)
        self.span = int(np.sum(self.n_words + gap)) + 1

    def number(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each term's number in this shard, and whether it has one."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), bool)
        n = np.searchsorted(self.terms, terms)
        n[n == len(self.terms)] = 0
        return n, self.terms[n] == terms

    def list_of(self, term: int) -> np.ndarray:
        n, there = self.number(np.array([term], np.uint64))
        return self.postings[(self.ends[n[0] - 1] if n[0] else 0) : self.ends[n[0]]] if there[0] else self.postings[:0]

    def occurrences(self, plans: Plans) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of all windows that occur: the lists of their rarest
        terms, each further list shifted by its offset and intersected.  All
        lists lie in one ascending array of (term number, position)."""
        number, there = self.number(plans.rare)
        rare = np.flatnonzero(there)
        if not len(rare):
            return
        number = number[rare]
        begin = np.where(number > 0, self.ends[number - 1], 0)
        size, held = plans.sizes[rare], self.ends[number] - begin
        keys = np.repeat(np.arange(len(self.terms)), np.diff(self.ends, prepend=0)) * self.span + self.postings
        # Every window of a rarest term with every place of that term.
        window = np.repeat(plans.firsts[rare], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        begin, held = np.repeat(begin, size), np.repeat(held, size)
        upto, a = np.cumsum(held), 0
        while a < len(window):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + plans.pairs, "right")))
            n = held[a:b]
            w = np.repeat(window[a:b], n)
            p = self.postings[np.repeat(begin[a:b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] - plans.order[w, 0]
            w, p, a = w[p >= 0], p[p >= 0], b
            for j in range(1, plans.order.shape[1]):
                if not len(w):
                    break
                offset = plans.order[w, j].astype(np.int64)
                number, there = self.number(plans.words[plans.starts[w] + offset])
                key = number * self.span + p + offset
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                there &= (keys[at] == key) & (p + offset < self.span)
                w, p = w[there], p[there]
            if len(w):
                yield w, p

    def near(self, plan: list[int], within: int) -> np.ndarray:
        """Positions of the rarest term from which every term of the plan is
        found inside one stretch of ``within`` words."""
        lists = [self.list_of(t) for t in plan]
        if not all(map(len, lists)):
            return np.zeros(0, np.int64)
        good = []
        for p in lists[0]:
            events = []
            for n, there in enumerate(lists):
                lo, hi = np.searchsorted(there, (p - within + 1, p + within))
                if lo == hi:
                    break
                events += [(int(x), n) for x in there[lo:hi]]
            else:
                events.sort()
                seen: dict[int, int] = {}
                for x, n in events:
                    seen[n] = x
                    if len(seen) == len(plan) and x - min(seen.values()) < within:
                        good.append(p)
                        break
        return np.array(good, np.int64)

    def split(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc = np.searchsorted(self.starts, at, "right") - 1
        return doc, at - self.starts[doc]


def term_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Occurrences of each of the sorted ``terms`` over all documents."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def task(batches):
        for batch in batches:
            for t, e in zip(batch.column(0), batch.column(1), strict=True):
                t, n = np.frombuffer(t.as_py(), "<u8"), np.diff(np.frombuffer(e.as_py(), "<i8"), prepend=0)
                keep = np.isin(t, sent.value)
                yield pa.RecordBatch.from_pydict({"term": pa.array(t[keep].view(np.int64), pa.int64()), "n": pa.array(n[keep], pa.int64())})

    summed = index.select("terms", "ends").mapInArrow(task, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(terms), np.int64)
    if summed.num_rows:
        found = summed.column("term").to_numpy().astype(np.int64).view(np.uint64)
        counts[np.searchsorted(terms, found)] = summed.column("n").to_numpy()
    sent.destroy()
    return counts


def vocabulary_of(bench: DataFrame, text_col: str, most: int) -> np.ndarray | None:
    """The benchmark's distinct words as hashes, or None if more than ``most``."""

    def task(batches):
        hasher = WordHasher()
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for a, b in steps(texts):
                yield pa.RecordBatch.from_pydict({"term": pa.array(np.unique(hasher(texts[a:b])[0]).view(np.int64), pa.int64())})

    terms = bench.select(bench[text_col].alias("text")).mapInArrow(task, "term bigint").distinct().limit(most + 1).toArrow()
    return None if terms.num_rows > most else np.sort(terms.column("term").to_numpy().astype(np.int64).view(np.uint64))


def _spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching stretches joined."""
    by = np.argsort(starts, kind="stable")
    starts, upto = starts[by], np.maximum.accumulate(stops[by])
    new = np.flatnonzero(np.append(True, starts[1:] > upto[:-1]))
    return starts[new], upto[np.append(new[1:], len(upto)) - 1]


def phrase_matches(index: DataFrame, plans: Plans, gap: int = WINDOW) -> DataFrame:
    """Stretches of words (``start`` up to ``stop``) of a document that
    occurrences of an item's windows cover, as a written table."""
    sent = index.sparkSession.sparkContext.broadcast(plans)
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType(
        [T.StructField("id", id_type), T.StructField("hash", T.LongType()), T.StructField("name", T.StringType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "stop")]
    )

    def task(batches):
        plans = sent.value
        names, lengths = pa.array(plans.names, pa.string()), np.diff(plans.owner_ends, prepend=0)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(i)[r].as_py() for i, n in enumerate(batch.schema.names) if n not in ("ids", "hashes")}
                shard = Shard(row, gap)
                ids, hashes = (batch.column(batch.schema.names.index(n))[r].values for n in ("ids", "hashes"))
                starts, stops, wide = [], [], shard.span + 1
                for w, p in shard.occurrences(plans):
                    n = lengths[w]
                    item = plans.owners[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(plans.owner_ends[w] - n, n)]
                    base = item.astype(np.int64) * wide
                    a, b = _spans(base + np.repeat(p, n), base + np.repeat(p + plans.lengths[w], n))
                    starts.append(a)
                    stops.append(b)
                if not starts:
                    continue
                a, b = _spans(np.concatenate(starts), np.concatenate(stops))
                item, a = np.divmod(a, wide)
                doc, at = shard.split(a)
                size = b - item * wide - a
                columns = [ids.take(pa.array(doc)), hashes.take(pa.array(doc)), names.take(pa.array(item)), pa.array(at, pa.int64()), pa.array(at + size, pa.int64())]
                yield _as(pa.RecordBatch.from_arrays(columns, names=schema.names), schema)

    found = written(index.mapInArrow(task, schema), "decontam-found")
    sent.destroy()
    return found


def proximity_matches(spark: SparkSession, docs: DataFrame, queries: list[str], within: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, query, position): every query's distinct words inside one stretch
    of ``within`` words, in any order; the position is that of its rarest word."""
    hashes, n = WordHasher()([q.encode() for q in queries])
    terms = np.unique(hashes)
    index = written(build_index(docs, id_col, text_col, terms, within), "proximity-index")
    counts = dict(zip(terms.tolist(), term_counts(index, terms).tolist(), strict=True))
    plans = [(q, sorted(set(w.tolist()), key=lambda t: (counts[t], t))) for q, w in enumerate(np.split(hashes, np.cumsum(n)[:-1])) if len(w)]
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("query", T.IntegerType()), T.StructField("position", T.LongType())])

    def task(frames):
        import pandas as pd

        for frame in frames:
            for row in frame.to_dict("records"):
                shard, out = Shard(row, within), []
                for q, plan in plans:
                    doc, at = shard.split(shard.near(plan, within))
                    out += [(row["ids"][d], q, int(p)) for d, p in zip(doc, at, strict=True)]
                yield pd.DataFrame(out, columns=["id", "query", "position"])

    return index.mapInPandas(task, schema)


def contamination(
    spark: SparkSession, docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW, one_in: int = ONE_IN, block_bytes: int = BLOCK_BYTES, vocabulary: int = VOCABULARY,
) -> DataFrame:
    """One row per document row: ``id``, ``hash`` (of its text), ``n_words``,
    ``n_hit`` (words inside a matching window), ``items`` (ids as sorted
    strings) and ``contaminated`` (at least one word in ``one_in`` is hit)."""
    index = written(build_index(docs, id_col, text_col, vocabulary_of(bench, bench_text_col, vocabulary), window), "decontam-index")
    result = None
    for items in blocks(bench, item_col, bench_text_col, block_bytes):
        phrases = Phrases(items, window)
        terms = phrases.terms()
        found = phrase_matches(index, phrases.rarest_first(terms, term_counts(index, terms)), window)
        result = found if result is None else result.unionByName(found)
    merged = F.aggregate(
        F.sort_array("spans"),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["stop"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], s["stop"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )
    hits = (
        result.groupBy(F.col("id").alias("hit_id"), F.col("hash").alias("hit_hash"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"), F.array_sort(F.collect_set("name")).alias("items"))
        .select("hit_id", "hit_hash", merged.alias("n_hit"), "items")
    )
    id_type = index.schema["ids"].dataType.elementType
    listed = T.StructType([T.StructField("id", id_type), T.StructField("hash", T.LongType()), T.StructField("n_words", T.LongType())])
    per_doc = index.select("ids", "hashes", "n_words").mapInArrow(_documents, listed)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("hit_hash"))
    return per_doc.join(hits, same, "left").select(
        "id", "hash", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )


def _documents(batches):
    for batch in batches:
        for ids, hashes, n in zip(*batch.columns, strict=True):
            n = np.frombuffer(n.as_py(), "<i8")
            yield pa.RecordBatch.from_arrays([ids.values, hashes.values, pa.array(n, pa.int64())], names=["id", "hash", "n_words"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without its contaminated rows."""
    judged = contamination(spark, docs, bench, id_col=id_col, text_col=text_col, **kw)
    bad = written(judged.where("contaminated").select(F.col("id").alias("bad_id"), F.col("hash").alias("bad_hash")).distinct(), "contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad_id"]) & (text_hash(docs[text_col]) == bad["bad_hash"]), "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
