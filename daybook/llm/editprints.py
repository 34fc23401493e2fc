"""Document fingerprints by randomised edit embedding.

Characters are walked at random: at every step the walk writes the character it
stands on and moves on or stays by a random bit that depends on the step and
the character, the same bits for all texts.  Where two texts differ by an edit,
their walks meet again after a few steps, so texts at a small edit distance
have embeddings at a small Hamming distance.

A text is walked in windows that begin where its content says: at characters
whose ``GRAM`` characters have the least hash within ``REACH`` characters on
both sides (and at the start; a window ends after ``4 * REACH`` characters).  So
windows line up again after an inserted or deleted passage, which disturbs the
windows it touches and no others.  A walk takes nine steps to four characters
(it needs two a character on average, the rest is for slow ones).  The
fingerprint has ``SLOTS`` digits of four bits.  A slot samples the window whose
beginning has the least hash for that slot, and in it a step that depends on the
walk's length only and is sampled consistently: it moves between lengths t and
t' with probability 1 - t / t', as if it were the step of least hash.  The digit
is a hash of the character there.  ``likeness`` is the share of equal digits,
corrected for chance; of two texts that share some windows it is about the
share of shared windows among all windows of either.

``edit_classes`` joins texts: bands of sampled digits name buckets, close
fingerprints are verified by the edit distance itself.

Defined results: a null text counts as empty; the fingerprint of the empty text
is all zeros; the text after the last row (descending id) is the first row's, a
single row follows itself; rows of equal id are ordered by a hash of the text
and the text; null ids come after all others; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, table, text_hash, written
from .neardup import Same, linked

REACH = 64
GRAM = 8
SLOTS = 256
CLASSES = 512  # characters are told apart by this many classes
STEP_CHARS = 1 << 20
_PAD = CLASSES - 1


def sample_places(slots: int = SLOTS) -> list[np.ndarray]:
    """Per slot the ascending record places: the sample of an embedding of
    length t is the last place below t.  After place p the next record lies
    beyond q with probability (p + 1) / (q + 1)."""
    rng = np.random.default_rng(6)
    out = []
    for _ in range(slots):
        at, p = [], 0
        while p < 16 * REACH:
            at.append(p)
            p = max(p + 1, int((p + 1) / rng.random()))
        out.append(np.array(at, np.int64))
    return out


class Embedder:
    """Fingerprints of batches of texts."""

    def __init__(self, reach: int = REACH, slots: int = SLOTS) -> None:
        self.reach, self.slots, self.longest = reach, slots, 4 * reach
        rng = np.random.default_rng(60)
        self.moves = rng.integers(0, 2, (self.walk(self.longest), CLASSES), dtype=np.int64)
        self.moves[:, _PAD] = 0
        self.digit = rng.integers(0, 16, (slots, CLASSES), dtype=np.uint8)
        self.seed = rng.integers(0, 1 << 63, slots, dtype=np.int64).astype(np.uint64)
        # The sampled step of each slot for every possible walk.
        lengths = self.walk(np.arange(1, self.longest + 1))
        self.step = np.stack([p[np.searchsorted(p, lengths) - 1] for p in sample_places(slots)], 1)

    @staticmethod
    def walk(chars):
        """Steps of the walk over so many characters."""
        return 9 * chars // 4

    def classes(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        wide = code >= 256
        if wide.any():
            code = code.copy()
            code[wide] = 256 + mix(code[wide].astype(np.uint64)) % np.uint64(_PAD - 256)
        return code.astype(np.int64)

    def windows(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of a text begin, and the hashes that name them."""
        n = len(code)
        starts, names = np.zeros(1, np.int64), np.zeros(1, np.uint64)
        if n >= GRAM:
            grams, l = mix(code.astype(np.uint64) + np.uint64(1)), 1
            while l < GRAM:
                grams, l = mix(grams[:-l] * np.uint64(3) + grams[l:]), 2 * l
            # Hash order in the upper, place in the lower half: the leftmost of equals.
            order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            pad = np.full(self.reach, np.iinfo(np.uint64).max)
            least, l = np.concatenate([pad, order, pad]), 1
            while 2 * l <= 2 * self.reach + 1:
                least, l = np.minimum(least[:-l], least[l:]), 2 * l
            rest = 2 * self.reach + 1 - l
            least = np.minimum(least[: len(order)], least[rest : rest + len(order)])
            cuts = np.flatnonzero(least == order)
            cuts = cuts[cuts > 0]
            starts, names = np.append(0, cuts), np.append(np.uint64(0), grams[cuts])
        size = np.diff(starts, append=n)
        if size.max() > self.longest:  # long windows go on in pieces
            pieces = -(-size // self.longest)
            k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts, names = np.repeat(starts, pieces) + k * self.longest, np.repeat(names, pieces)
            names = np.where(k > 0, mix(names + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), names)
        return starts, names

    def sampled(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every slot the start and size of its window and the step."""
        starts, names = self.windows(code)
        size = np.diff(starts, append=len(code))
        at = mix(names[:, None] ^ self.seed).argmin(0)
        return starts[at], size[at], self.step[size[at] - 1, np.arange(self.slots)]

    def __call__(self, texts: list[str]) -> np.ndarray:
        """One row of ``slots`` digits per text."""
        out = np.zeros((len(texts), self.slots), np.uint8)
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out
        codes = [self.classes(texts[i]) for i in some]
        begin, size, step = (np.concatenate(x) for x in zip(*map(self.sampled, codes), strict=True))
        lengths = np.array([len(c) for c in codes])
        begin += np.repeat(np.cumsum(lengths) - lengths, self.slots)
        # Every sampled window is walked once, as far as a slot needs it; those
        # that are walked furthest come first.
        first, of = np.unique(begin, return_inverse=True)
        need, chars = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        np.maximum.at(need, of, step)
        chars[of] = size
        rank = np.argsort(-need, kind="stable")
        place = np.empty_like(rank)
        place[rank] = np.arange(len(rank))
        first, chars, row = first[rank], chars[rank], place[of]
        alive = np.searchsorted(-need[rank], -np.arange(need.max() + 1), side="right")
        flat = np.append(np.concatenate(codes), _PAD)
        order = np.argsort(step, kind="stable")
        by_step = np.searchsorted(step[order], np.arange(need.max() + 2))
        here, end, seen = first.copy(), first + chars, np.empty(len(step), np.int64)
        for j in range(int(need.max()) + 1):
            n = alive[j]
            at = here[:n]
            symbol = np.where(at < end[:n], flat[np.minimum(at, len(flat) - 1)], _PAD)
            now = order[by_step[j] : by_step[j + 1]]
            seen[now] = symbol[row[now]]
            at += self.moves[j][symbol]
        out[some] = self.digit[np.tile(np.arange(self.slots), len(some)), seen].reshape(len(some), self.slots)
        return out


def hex_of(digits: np.ndarray) -> str:
    return np.array(list("0123456789abcdef"))[digits].tobytes().decode("utf-32-le") if len(digits) else ""


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal digits beyond the sixteenth that chance gives; 0 to 1."""
    return max(0.0, (float((a == b).mean()) - 1 / 16) / (15 / 16))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``hash`` (of its text), ``fingerprint``."""
    rows = docs.select(docs[id_col].alias("id"), text_hash(docs[text_col]).alias("hash"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def task(batches):
        embed = Embedder()
        for batch in batches:
            texts, done = batch.column(2).to_pylist(), []
            for a, b in _ranges(texts):
                done += [hex_of(d) for d in embed(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(done, pa.string())], names=["id", "hash", "fingerprint"])

    return rows.mapInArrow(task, T.StructType([rows.schema["id"], rows.schema["hash"], T.StructField("fingerprint", T.StringType())]))


def _ranges(texts: list[str]):
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= STEP_CHARS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (``place``, ``halo``, ``id``, ``hash``, ``text``) dealt out so that
    each task can read its documents in descending id, each followed by the
    next one: ids are cut at quantiles, and the first row of a stretch is also
    sent, as a halo, to the end of the stretch before (the first of all to the
    last stretch)."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), text_hash(docs[text_col]).alias("hash"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    if isinstance(rows.schema["id"].dataType, T.IntegralType):
        rows = rows.withColumn("rank", F.col("id").cast("bigint"))
    else:  # any other type is ranked first: numbers that rise with the ids
        ranks = written(rows.select(F.col("id").alias("of")).where("of IS NOT NULL").distinct().orderBy("of").withColumn("rank", F.monotonically_increasing_id()), "id-ranks")
        rows = rows.join(ranks, F.col("id") == F.col("of"), "left").drop("of")
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select(F.col("rank").alias("id"))
    cuts = sorted({int(x) for x in ids.where("id IS NOT NULL").approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n))})

    def stretch(x) -> int:
        return -1 if x is None else bisect.bisect_left(cuts, x)

    number = F.arrow_udf(lambda a: pa.array([stretch(x) for x in a.to_pylist()], pa.int32()), "int")
    # At most one row per stretch reaches the driver.
    tops = sorted((r["s"], r["top"]) for r in ids.groupBy(number("id").alias("s")).agg(F.max("id").alias("top")).collect())
    halo = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}

    def targets(a: pa.Array) -> pa.Array:
        return pa.array([[stretch(x)] + ([halo[x]] if x in halo else []) for x in a.to_pylist()], pa.list_(pa.int32()))

    sent = rows.select("id", "hash", "text", F.posexplode(F.arrow_udf(targets, "array<int>")("rank")).alias("halo", "place"))
    return sent.repartition("place").sortWithinPartitions("place", "halo", F.desc_nulls_last("id"), "hash", "text")


def edited(text: str, after: str) -> str:
    """The last half of the characters replaced by the next text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compare_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint and its edited text's, and how
    alike its own is to that and to the next document's."""
    rows = with_next(docs, id_col, text_col)
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)] + [T.StructField(n, t) for n, t in (
        ("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()), ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType()))])

    def followed(batches):
        """(id, text, next text) of every document, in order."""
        place = before = None
        ended = False
        for batch in batches:
            for halo, at, i, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("halo", "place", "id", "text")), strict=True):
                if at != place:
                    place, before, ended = at, None, False
                if before is not None and not ended:
                    yield *before, text
                ended = ended or halo == 1
                if not halo:
                    before = (i, text)

    def judged(embed, held):
        texts = [t for _, t, _ in held]
        changed = [edited(t, after) for _, t, after in held]
        # A document's next is the one after it but at the end of a stretch.
        own, new = embed(texts), embed(changed)
        last = [k for k, (_, _, after) in enumerate(held) if k + 1 == len(held) or texts[k + 1] is not after]
        following = np.empty_like(own)
        following[:-1] = own[1:]
        following[last] = embed([held[k][2] for k in last])
        out = {
            "id": [i for i, _, _ in held],
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [hex_of(d) for d in own],
            "edited_fingerprint": [hex_of(d) for d in new],
            "near_edited": [likeness(a, b) for a, b in zip(own, new, strict=True)],
            "near_next": [likeness(a, b) for a, b in zip(own, following, strict=True)],
        }
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in kinds], schema=kinds)

    def task(batches):
        embed, held, size = Embedder(), [], 0
        for row in followed(batches):
            held.append(row)
            size += len(row[1])
            if size >= STEP_CHARS:
                yield judged(embed, held)
                held, size = [], 0
        if held:
            yield judged(embed, held)

    return rows.select("halo", "place", "id", "text").mapInArrow(task, schema)


def edit_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_edits: float = 0.1, bands: int = 64, rows: int = 4, floor: float = 0.2) -> DataFrame:
    """One row per document: ``id``, ``hash``, ``class_id`` (least id): texts
    linked by edit distances of at most ``max_edits`` times the longer length.
    Digits are sampled into bands; a pair of fingerprints that agree on a share
    s of digits meets in one with probability 1 - (1 - s^rows)^bands.  Pairs as
    alike as ``floor`` are verified by the edit distance, which stops at its
    bound.  Unlike texts meet by chance in 16^-rows of a band: take more rows for
    many more texts.  A pair whose fingerprints differ too much is missed."""
    prints = written(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    pick = np.random.default_rng(61).permutation(SLOTS)
    bands = min(bands, SLOTS // rows)
    keys = [F.xxhash64(F.lit(b), *[F.substring("fingerprint", int(p) + 1, 1) for p in pick[b * rows : (b + 1) * rows]]) for b in range(bands)]
    # A text stands for its copies; numbers are given as they are written.
    nodes = written(
        prints.groupBy("hash").agg(F.first("fingerprint").alias("fingerprint"), F.count("*").alias("copies"), F.min("id").alias("id"))
        .select(F.monotonically_increasing_id().alias("node"), "id", "hash", F.lit(1).cast("bigint").alias("weight"), "copies", "fingerprint", F.array(*keys).alias("bands")),
        "prints",
    )
    # Digits in band order, two bytes each, as the block step reads them.
    wide = F.array_join(F.transform(F.array(*[F.lit(int(p) + 1) for p in pick[: bands * rows]]), lambda p: F.concat(F.lit("0"), F.substr("fingerprint", p, F.lit(1)), F.lit("00"))), "")
    texts = docs.select(text_hash(docs[text_col]).alias("hash"), F.coalesce(docs[text_col], F.lit("")).alias("payload"))

    def payload_of(wanted: DataFrame) -> DataFrame:
        return texts.join(wanted.select("node", "hash"), "hash").select("node", "payload").dropDuplicates(["node"])

    def near(a: Column, b: Column) -> Column:
        most = F.floor(F.greatest(F.length(a), F.length(b)) * max_edits).cast("int")
        return (F.abs(F.length(a) - F.length(b)) <= most) & (F.call_function("levenshtein", a, b, most) >= 0)

    signed = nodes.withColumn("signature", F.unhex(wide)).drop("fingerprint")
    comps = written(linked(signed, payload_of, Same(native=near), rows=rows, threshold=0.0, floor=floor), "edit-components")
    tagged = prints.join(nodes.select("node", "hash"), "hash")
    labelled = tagged.join(comps, "node", "left").select("id", "hash", F.coalesce("comp", "node").alias("comp"))
    least = labelled.groupBy("comp").agg(F.min("id").alias("class_id"))
    return labelled.join(least, "comp").select("id", "hash", "class_id")


def op6_editprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
