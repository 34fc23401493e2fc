"""Removal of byte strings that an earlier document holds, by bucket-pointer
refinement.

The suffixes of all texts are put into buckets of equal beginnings, and buckets
are refined by the bucket identifiers of later offsets: the identifier of the
2l bytes at i comes from those of the l bytes at i and at i + l, and is used
again for the next length.  Identifiers are hashes of the bytes alone, so any
task knows the identifier at any later offset of its texts, and only identifiers
cross the network; sorting brings a bucket together.  Texts stay where they
were written: a bucketed table of chunks, read without a shuffle in each step.

1. *Initial buckets.*  Of the windows of ``length`` bytes, neighbours that share
   their least q-gram (by a hash; the leftmost of equals) form a run, with that
   gram as its pointer: about one in fourteen bytes.  Equal windows have equal
   pointers at equal offsets, so a window can only occur elsewhere in the same
   bucket.  A run's refined identifier is made of the identifiers of its first
   and last window, which cover all its bytes.
2. *Runs.*  Every chunk sends one entry per distinct run (pointer, refined
   identifier, least document) to the pointer's part.  A bucket of one document
   is settled; a run that an earlier document holds is removed whole; other
   runs of a shared bucket are still open.
3. *Windows.*  Only open runs are refined to single windows: one entry per
   distinct window and chunk goes to the window's part, and every window that an
   earlier document holds is removed.
4. Chunks apply the answers, one or two bits per entry, to their texts.

No group can be large: a chunk sends a run or window once, however often it
holds it, and a pointer with more than ``Sizes.hot`` distinct runs in one chunk sends
two markers only and has all its runs refined to windows.  Entries are packed in
blocks, one per chunk and part.  Identifiers have 64 bits besides the pointer's
40 (runs) or 16 (windows) and the part: different strings are taken for equal
with a chance of about 2^-64 for each pair that shares a pointer.

Defined results: a text that is null counts as empty; documents are ordered by
id, a whole number; rows of equal id remove nothing from each other and come
out each, with null ids nothing is removed and they remove nothing; matches
never cross documents; texts shorter than ``length`` bytes stay; very long texts
are worked through in overlapping stretches; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import mix, table, written

LENGTH = 50
GRAM = 22


class Sizes(NamedTuple):
    """What a task holds at once; results do not depend on it."""

    chunk: int = 8 << 20  # bytes of text in a row of the chunk table
    stretch: int = 1 << 20  # bytes worked on at once
    part: int = 32 << 20  # bytes of text for each part of the entries
    hot: int = 64  # runs of a pointer in a chunk beyond which it sends markers


_P = 0x9E3779B97F4A7C15
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def initial(data: np.ndarray, q: int) -> np.ndarray:
    """Identifiers of the q bytes at every offset (len - q + 1 of them)."""
    one = data.astype(np.uint64) + np.uint64(1)
    ids, l = one, 1
    for bit in bin(q)[3:]:
        ids = ids[: len(ids) - l] * np.uint64(pow(_P, l, 1 << 64)) + ids[l:]
        l *= 2
        if bit == "1":
            ids = ids[:-1] * np.uint64(_P) + one[l : l + len(ids) - 1]
            l += 1
    return mix(ids)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of two identifiers in order."""
    return mix(a * _A ^ (b * _B + (a >> np.uint64(29))))


def refined(ids: np.ndarray, l: int, length: int) -> np.ndarray:
    """Identifiers of ``length`` bytes from those of ``l``, each step using the
    one before."""
    while l < length:
        new = min(2 * l, length)
        ids = pair(ids[: len(ids) - (new - l)], ids[new - l :])
        l = new
    return ids


class Runs:
    """The runs of a chunk of texts: ``start`` (of the first window), ``count``
    (windows), ``doc`` (index of the text), ``pointer``, ``run`` (identifiers)."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, length: int, q: int, stretch: int) -> None:
        self._data, self._length, self._q = data, length, q
        ends = np.cumsum(sizes)
        self._ranges, found = [], []
        for first, last, i, j in _stretches(ends - sizes, ends, length, stretch):
            if last - first >= length:
                # Of each place the text it lies in, as far as this stretch goes.
                texts = np.repeat(np.arange(i, j), np.minimum(ends[i:j], last) - np.maximum((ends - sizes)[i:j], first))
                found.append(self._of(data[first:last], texts, first))
                self._ranges.append((first, last, len(found[-1][0])))
        columns = list(zip(*found, strict=True)) or [[np.zeros(0, t)] for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)]
        self.start, self.count, self.doc, self.pointer, self.run = map(np.concatenate, columns)

    def _of(self, data: np.ndarray, texts: np.ndarray, first: int):
        length, q = self._length, self._q
        grams = initial(data, q)
        # Hash order in the upper, place in the lower half.
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        w, l = length - q + 1, 1
        while 2 * l <= w:
            least = np.minimum(least[: len(least) - l], least[l:])
            l *= 2
        if l < w:
            least = np.minimum(least[: len(least) - (w - l)], least[w - l :])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        text, valid = texts[: len(at)], texts[: len(at)] == texts[length - 1 :]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
        start = np.flatnonzero(new)
        count = np.diff(start, append=len(at))
        start, count = start[valid[start]], count[valid[start]]
        ids = refined(grams, q, length)
        pointer = mix(grams[at[start]] ^ _B)
        run = pair(pair(ids[start], ids[start + count - 1]), ((at[start] - start) << 32 | count).astype(np.uint64))
        return start + first, count, text[start], pointer, run

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """Identifier, pointer, document and place of the chosen runs' windows."""
        out, seen = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        for first, last, n in self._ranges:
            here = np.flatnonzero(chosen[seen : seen + n]) + seen
            seen += n
            if len(here):
                count = self.count[here]
                at = np.repeat(self.start[here], count) + _within(count)
                ids = refined(initial(self._data[first:last], self._q), self._q, self._length)
                out.append((ids[at - first], np.repeat(self.pointer[here], count), np.repeat(self.doc[here], count), at))
        return tuple(map(np.concatenate, zip(*out, strict=True)))


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _stretches(starts: np.ndarray, ends: np.ndarray, length: int, stretch: int):
    """Byte ranges of about ``stretch`` with whole texts; a longer text alone gives
    several that overlap by a window less a byte.  With them the indexes of
    their texts."""
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + stretch, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        for at in range(a, max(a + 1, b - length + 1), stretch if b - a > stretch else b - a + 1):
            yield at, min(b, at + stretch + length - 1), i, j
        i = j


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by keys (the first leads) and where groups of equal keys but
    the last begin in it."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys[:-1]:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


class _Asked:
    """The entries of a chunk, in order: one per distinct run or window, with
    the least document; ``entry`` maps each row to its entry, ``later`` marks
    rows of later documents than the entry's."""

    def __init__(self, parts: int, pointer: np.ndarray, key: np.ndarray, number: np.ndarray, part_of: np.ndarray) -> None:
        order, new = _groups(part_of, pointer, key, number)
        group = np.cumsum(new) - 1
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = group
        head = order[new]
        self.part, self.pointer, self.key, self.number = part_of[head], pointer[head], key[head], number[head]
        self.later = number > self.number[self.entry] if len(head) else np.zeros(len(order), bool)
        self.bounds = np.searchsorted(self.part, np.arange(parts + 1))


def _pack(pointer: np.ndarray, bits: int, key: np.ndarray, number: np.ndarray) -> list[bytes]:
    base = int(number.min())
    span = int(number.max()) - base
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if span <= np.iinfo(t).max)
    short = (pointer >> np.uint64(64 - bits)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : bits // 8]
    offset = (number.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)).astype(kind)
    return [short.tobytes(), key.tobytes(), np.int64(base).tobytes() + offset.tobytes()]


def _unpack(pointer: bytes, bits: int, key: bytes, number: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(key) // 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, : bits // 8] = np.frombuffer(pointer, np.uint8).reshape(n, -1)
    offset = np.frombuffer(number, f"<u{(len(number) - 8) // n}", offset=8).astype(np.uint64)
    return wide.view("<u8").ravel(), np.frombuffer(key, np.uint64), (offset + np.frombuffer(number, np.int64, 1).view(np.uint64)).view(np.int64)


_BLOCK = "part int, chunk long, pointer binary, key binary, number binary"
_ANSWER = "chunk long, part int, bits binary"


def _blocks(schema: pa.Schema, chunk: int, asked: _Asked, bits: int, extra: dict | None = None):
    rows = []
    for part in range(len(asked.bounds) - 1):
        a, b = asked.bounds[part], asked.bounds[part + 1]
        columns = [x[a:b] for x in (asked.pointer, asked.key, asked.number)]
        if extra and part in extra:
            columns = [np.concatenate([x, y]) for x, y in zip(columns, extra[part], strict=True)]
        if len(columns[0]):
            rows.append((part, chunk, *_pack(columns[0], bits, *columns[1:])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else None


def _answers(blocks: DataFrame, parts: int, bits: int, judge) -> DataFrame:
    """Per block the bits of ``judge(pointer, key, number)`` for its entries."""
    kinds = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("bits", pa.binary())])

    def task(batches):
        held = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if not held:
            return
        held.sort(key=lambda r: r[1])
        columns = list(zip(*(_unpack(r[2], bits, r[3], r[4]) for r in held), strict=True))
        said = judge(*map(np.concatenate, columns))
        cuts = np.cumsum([len(k) for k in columns[1]])[:-1]
        out = [(r[1], r[0], np.packbits(s).tobytes()) for r, s in zip(held, np.split(said, cuts), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    return blocks.repartitionById(parts, "part").mapInArrow(task, _ANSWER)


def _judge_runs(pointer: np.ndarray, run: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Two bits per entry: held by an earlier document; still open."""
    order, new = _groups(pointer, run, number)
    p, d = pointer[order], number[order]
    head = np.flatnonzero(new)
    owner = d[head][np.cumsum(new) - 1]
    bucket = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    number_of = np.cumsum(np.append(True, p[1:] != p[:-1])) - 1
    shared = (np.minimum.reduceat(d, bucket) != np.maximum.reduceat(d, bucket))[number_of]
    several = (np.add.reduceat(new.astype(np.int64), bucket) > 1)[number_of]
    out = np.zeros((len(order), 2), bool)
    out[order, 0] = d > owner
    out[order, 1] = (d == owner) & shared & several
    return out


def _judge_windows(pointer: np.ndarray, window: np.ndarray, number: np.ndarray) -> np.ndarray:
    order, new = _groups(pointer, window, number)
    d = number[order]
    out = np.zeros((len(order), 1), bool)
    out[order, 0] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


def _told(asked: _Asked, answers: list | None, width: int) -> np.ndarray:
    """The answers of all entries of a chunk."""
    out = np.zeros((len(asked.key), width), bool)
    for r in answers or []:
        a, b = asked.bounds[r["part"]], asked.bounds[r["part"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=(b - a) * width).reshape(-1, width)
    return out


class _Chunk:
    """What a chunk asks and how it reads the answers; made anew in each step."""

    def __init__(self, row: dict, parts: int, length: int, q: int, sizes: Sizes) -> None:
        self.parts, self.length, self.q, self.chunk = parts, length, q, row["chunk"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)
        self.runs = r = Runs(self.data, self.sizes, length, q, sizes.stretch)
        # A pointer with many runs here has all of them refined.
        order, new = _groups(r.pointer, r.run, r.doc)
        first = np.append(True, r.pointer[order][1:] != r.pointer[order][:-1])[: len(order)]
        distinct = np.add.reduceat(new.astype(np.int64), np.flatnonzero(first)) if len(order) else np.zeros(0, np.int64)
        self.hot = np.zeros(len(order), bool)
        self.hot[order] = (distinct > sizes.hot)[np.cumsum(first) - 1]
        self.cool = np.flatnonzero(~self.hot)
        number = self.ids[r.doc]
        self.asked = _Asked(parts, r.pointer[self.cool], r.run[self.cool], number[self.cool], self._part(r.pointer[self.cool]))

    def _part(self, pointer: np.ndarray) -> np.ndarray:
        return ((pointer & np.uint64(0xFFFFFF)) % np.uint64(self.parts)).astype(np.int64)

    def markers(self) -> dict:
        """For hot pointers, entries (in addition) of their first and last document."""
        out: dict = {}
        r = self.runs
        if self.hot.any():
            order, new = _groups(r.pointer[self.hot], self.ids[r.doc[self.hot]])
            p, d = r.pointer[self.hot][order], self.ids[r.doc[self.hot]][order]
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(p)) - 1
            part = self._part(p[head])
            for k in np.unique(part):
                here = part == k
                ends = [p[head][here], p[tail][here]]
                keys = [np.full(here.sum(), x, np.uint64) for x in (0, 1)]
                out[int(k)] = [np.concatenate(ends), np.concatenate(keys), np.concatenate([d[head][here], d[tail][here]])]
        return out

    def refine(self, answers: list | None) -> None:
        """Reads the answers about runs, and asks about the open ones' windows."""
        told = _told(self.asked, answers, 2)
        gone, open_ = np.zeros(len(self.hot), bool), self.hot.copy()
        gone[self.cool] = told[self.asked.entry, 0] | self.asked.later
        open_[self.cool] = told[self.asked.entry, 1] & ~self.asked.later
        self.gone = gone
        window, pointer, doc, self.place = self.runs.windows(open_)
        number = self.ids[doc]
        self.wanted = _Asked(self.parts, pointer & ~np.uint64((1 << 48) - 1), window, number, self._part(window))

    def removed(self, answers: list | None) -> np.ndarray:
        """Which bytes of the chunk go."""
        told = _told(self.wanted, answers, 1)[:, 0]
        window = told[self.wanted.entry] | self.wanted.later if len(self.place) else np.zeros(0, bool)
        change = np.zeros(len(self.data) + 1, np.int64)
        r = self.runs
        np.add.at(change, r.start[self.gone], 1)
        np.add.at(change, r.start[self.gone] + r.count[self.gone] - 1 + self.length, -1)
        np.add.at(change, self.place[window], 1)
        np.add.at(change, self.place[window] + self.length, -1)
        return np.cumsum(change[:-1]) > 0


def _chunks(docs: DataFrame, id_col: str, text_col: str, total: int, chunk: int) -> DataFrame:
    """The texts with an id in rows of about ``chunk`` bytes, as a table bucketed by
    ``chunk``: every later step joins on it without moving the texts."""
    spark = docs.sparkSession
    rows = docs.where(docs[id_col].isNotNull()).select(docs[id_col].cast("bigint").alias("id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("data"))

    def task(batches):
        held, size = [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and size + len(t) > chunk:
                    yield packed(held)
                    held, size = [], 0
                held.append((i, t))
                size += len(t)
        if held:
            yield packed(held)

    def packed(held) -> pa.RecordBatch:
        ids, sizes = np.array([i for i, _ in held], np.int64), np.array([len(t) for _, t in held], np.int64)
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (ids.tobytes(), sizes.tobytes(), b"".join(t for _, t in held))], names=["ids", "sizes", "data"])

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (2 * chunk))
    name = f"text_chunks_{uuid.uuid4().hex[:12]}"
    made = rows.mapInArrow(task, "ids binary, sizes binary, data binary").withColumn("chunk", F.monotonically_increasing_id())
    made.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "chunks")).bucketBy(n, "chunk").saveAsTable(name)
    return spark.table(name)


def _with(chunks: DataFrame, **answers: DataFrame) -> DataFrame:
    for name, told in answers.items():
        by_chunk = told.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(name))
        chunks = chunks.join(by_chunk, "chunk", "left")
    return chunks


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, q: int = GRAM, sizes: Sizes | None = None) -> DataFrame:
    """One row per document: ``id``, ``n_bytes``, ``spans`` (start, end of the
    maximal removed runs of bytes) and ``kept`` (the remaining bytes)."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError("ids must be whole numbers: their order decides what stays")
    if not 0 < q <= length:
        raise ValueError("the gram must fit into the length")
    total = docs.agg(F.sum(F.octet_length(docs[text_col]).cast("bigint")).alias("n")).head()["n"] or 0
    sizes = sizes or Sizes()
    parts = max(1, -(-total // sizes.part))
    chunks = _chunks(docs, id_col, text_col, total, sizes.chunk)
    from pyspark.sql.pandas.types import to_arrow_schema

    block = to_arrow_schema(T._parse_datatype_string(_BLOCK))

    def ask_runs(batches):
        for row in _rows(batches):
            c = _Chunk(row, parts, length, q, sizes)
            out = _blocks(block, c.chunk, c.asked, 40, c.markers())
            if out is not None:
                yield out

    def ask_windows(batches):
        for row in _rows(batches):
            c = _Chunk(row, parts, length, q, sizes)
            c.refine(row["runs"])
            out = _blocks(block, c.chunk, c.wanted, 16)
            if out is not None:
                yield out

    result = T.StructType([
        T.StructField("id", kind), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType()),
    ])
    out_schema = to_arrow_schema(result)

    def cut(batches):
        for row in _rows(batches):
            c = _Chunk(row, parts, length, q, sizes)
            c.refine(row["runs"])
            gone = c.removed(row["windows"])
            out, first, keep = [], 0, ~gone
            for i, n in zip(c.ids.tolist(), c.sizes.tolist(), strict=True):
                here = gone[first : first + n]
                if here.any():
                    edge = np.flatnonzero(np.diff(here, prepend=False, append=False)).reshape(-1, 2)
                    out.append((i, n, [{"start": a, "end": b} for a, b in edge.tolist()], c.data[first : first + n][keep[first : first + n]].tobytes()))
                else:
                    out.append((i, n, [], c.data[first : first + n].tobytes()))
                first += n
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), out_schema, strict=True)], schema=out_schema)

    runs = written(_answers(chunks.mapInArrow(ask_runs, _BLOCK), parts, 40, _judge_runs), "run-answers")
    windows = written(_answers(_with(chunks, runs=runs).mapInArrow(ask_windows, _BLOCK), parts, 16, _judge_windows), "window-answers")
    done = _with(chunks, runs=runs, windows=windows).mapInArrow(cut, result)
    nameless = docs.where(docs[id_col].isNull()).select(
        docs[id_col].alias("id"), F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.array().cast(result["spans"].dataType).alias("spans"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("kept"),
    )
    return done.unionByName(nameless)


def op12_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
