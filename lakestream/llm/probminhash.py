"""MinHash near-duplicates of weighted shingles: ProbMinHash sketches, banding, exact verification.

The shingles of a text (five words) weigh as often as they occur. Each shingle
is a Poisson process of that rate: its points fall on random registers, and a
register keeps the shingle whose point comes first. A shingle stops as soon as
its next point comes after all registers of its text. Two texts agree in a
register with the probability Jaccard similarity
``sum over shared d of 1 / sum over e of max(p_e/p_d, q_e/q_d)``, which equals
set Jaccard where no shingle repeats.

Texts of equal words are one representative (the least id). Registers go into
bands; representatives with an equal band meet in its bucket. First every member
is compared exactly with its bucket's leader, the one that shares most buckets
with others (of near copies of one text, most likely that text); similar ones
are linked, and linked ones make up classes. Buckets whose members are of one
class are done. Members of the others get a second, longer sketch; those of
different classes are compared by it, in blocks of bounded size inside tasks. A
pair leaves its task only if the sketches agree in a share of registers that is
at most four standard errors below the threshold, and only from the first band
that it shares. These pairs are compared exactly, and the classes are the
connected components of all similar pairs.

Results on odd rows: a null text, or one without words, is a class of its own;
where ids repeat, rows are compared by a key of id and text, and an id with texts
in several classes has the least of their ids (its texts are judged one by one in
``kept_documents``); rows without an id have no class; an empty table gives an empty result; other
columns aren't carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakestream.llm import _batches as B
from lakestream.llm._hashing import mix
from lakestream.llm._shingles import WORDS, bags, shingles, word_hashes
from lakestream.llm._tables import components, free_name, near, plain_ids, written

SIMILARITY = 0.8
#: Registers of a sketch, and those of a band: 24 bands of 5 find all but 7 of 100,000 pairs of similarity 0.8.
REGISTERS, BAND = 120, 5
#: Registers of the second sketch (a byte of each is kept: unequal ones look equal once in 256 times).
FINE = 640
#: Members of a bucket that are compared with as many others at a time.
BLOCK = 512
SLICE = 1 << 20
#: Pairs (two ids each) up to this number are broadcast to the texts; more are joined by a shuffle.
BROADCAST_PAIRS = 500_000


def sketches(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """The sketch (n rows of m shingles) of each text, from its distinct shingles and their weights."""
    first = np.full(n * m, np.inf)
    winner = np.zeros(n * m, np.uint64)
    latest = np.full(n, np.inf)
    time, step = np.zeros(len(doc)), 0
    while len(doc):
        step += 1
        bits = mix(key + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log1p(-((bits >> np.uint64(11)).astype(float) * 2.0**-53)) / weight
        register = ((mix(bits) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        soon = time < latest[doc]
        doc, key, weight, time, register = doc[soon], key[soon], weight[soon], time[soon], register[soon]
        at = doc * m + register
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = key[won]
        latest[np.unique(doc)] = first.reshape(n, m)[np.unique(doc)].max(1)
        go = time < latest[doc]
        doc, key, weight, time = doc[go], key[go], weight[go], time[go]
    return winner.reshape(n, m)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two bags (sorted distinct shingles, counts)."""
    (ka, wa), (kb, wb) = a, b
    if not len(ka) or not len(kb):
        return 0.0
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    if wa.max() == wb.max() == 1:
        return len(ia) / (len(ka) + len(kb) - len(ia))
    p, q = wa / wa.sum(), wb / wb.sum()
    ratio = p[ia] / q[ib]
    order = np.argsort(ratio)
    ratio, ps, qs = ratio[order], p[ia][order], q[ib][order]
    only_p, only_q = 1 - ps.sum(), 1 - qs.sum()
    above = only_p + np.cumsum(ps[::-1])[::-1] - ps  # of shingles with a larger ratio
    below = only_q + np.cumsum(qs)
    return float((1 / (above / ps + below / qs)).sum())


def _signatures(docs: DataFrame, size: int, m: int, band: int) -> DataFrame:
    def run(batches):
        for part in B.slices(batches, "text", SLICE):
            n = part.num_rows
            doc, word = word_hashes(B.column(part, "text"))
            of, shingle = shingles(doc, word, size)
            of, key, count = bags(of, shingle)
            sketch = sketches(of, key, count.astype(float), n, m).reshape(n, m // band, band)
            keys = np.broadcast_to(np.arange(m // band, dtype=np.uint64), (n, m // band))
            for k in range(band):
                keys = mix(keys + sketch[:, :, k])
            # equal words in equal order: two independent sums over them
            place = np.arange(len(doc)) - np.searchsorted(doc, doc)
            odd = np.uint64(0xC2B2AE3D27D4EB4F)
            one, two = (np.zeros(n, np.uint64) for _ in range(2))
            np.add.at(one, doc, mix(word + place.astype(np.uint64)))
            np.add.at(two, doc, mix(word * odd + mix(place.astype(np.uint64))))
            words = np.bincount(doc, minlength=n)
            full = words > 0
            ends = np.arange(full.sum() + 1) * (m // band)
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id").filter(pa.array(full)), pa.array(one[full].view(np.int64)),
                 pa.array((two[full] + words[full].astype(np.uint64)).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys[full].reshape(-1).view(np.int64)))],
                names=["id", "h1", "h2", "bands"])

    return docs.mapInArrow(B.task(run), f"id {_kind(docs)}, h1 long, h2 long, bands array<long>")


def _fine(docs: DataFrame, size: int, m: int = FINE) -> DataFrame:
    def run(batches):
        for part in B.slices(batches, "text", SLICE):
            of, key, count = bags(*shingles(*word_hashes(B.column(part, "text")), size))
            sketch = (mix(sketches(of, key, count.astype(float), part.num_rows, m)) & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([B.column(part, "id"), pa.array([x.tobytes() for x in sketch], pa.binary())],
                                             names=["id", "sketch"])

    return docs.select("id", "text").mapInArrow(B.task(run), f"id {_kind(docs)}, sketch binary")


def _close(members: DataFrame, floor: float) -> DataFrame:
    """Pairs ``a`` < ``b`` of different ``label`` in a bucket whose sketches agree in a share ``floor`` of the registers.

    Pairs that share several buckets come from that of the first band.

    A bucket is dealt into blocks by a hash; each pair of blocks is one group of
    at most about ``2 * BLOCK`` rows.
    """
    size = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(size, "bucket").withColumn("own", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                         "own", "id", "label", "bands", "sketch")

    def pairs(group: pa.RecordBatch):
        ids, label = B.column(group, "id").to_pylist(), np.unique(B.column(group, "label").to_pylist(), return_inverse=True)[1]
        own, sketch = B.ints(group, "own"), B.column(group, "sketch")
        matrix = np.stack([np.frombuffer(x.as_py(), np.uint8) for x in sketch])
        across = B.ints(group, "x")[0] != B.ints(group, "y")[0]
        bands = np.stack(B.column(group, "bands").to_numpy(zero_copy_only=False))
        need, here = floor * matrix.shape[1], B.ints(group, "bucket")[0]
        for i in range(len(ids) - 1):
            fit = label[i + 1:] != label[i]
            if across:
                fit &= own[i + 1:] != own[i]
            at = np.flatnonzero(fit) + i + 1
            at = at[(matrix[at] == matrix[i]).sum(1) >= need]
            first = bands[i][(bands[at] == bands[i]).argmax(1)] if len(at) else at
            for j in at[first == here]:
                yield min(ids[i], ids[j]), max(ids[i], ids[j])

    def run(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch.select(held.schema.names)])
            keys = np.stack([B.ints(held, c) for c in ("bucket", "x", "y")], 1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            begin = 0
            for end in ends:
                found = list(pairs(held.slice(begin, end - begin)))
                if found:
                    yield _pairs(found, kind)
                begin = end
            held = held.slice(begin)
        if held is not None and held.num_rows:
            yield _pairs(list(pairs(held)), kind)

    kind = members.schema["id"].dataType
    name = kind.simpleString()
    return dealt.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y").mapInArrow(
        B.task(run), f"a {name}, b {name}")


def _pairs(found: list, kind) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(x, to_arrow_type(kind)) for x in (a, b)], names=["a", "b"])


def _kind(docs: DataFrame) -> str:
    return docs.schema["id"].dataType.simpleString()


def _compared(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``a``, ``b``, ``far``: 1 - similarity of the texts of each pair, exactly. ``b`` may be in very many pairs."""
    left = docs.join(near(pairs, BROADCAST_PAIRS), docs["id"] == pairs["a"]).select("a", "b", F.col("text").alias("text_a"))
    ends = pairs.select(F.col("b").alias("id")).distinct()
    right = docs.join(near(ends, BROADCAST_PAIRS), "id").select(F.col("id").alias("end"), F.col("text").alias("text_b"))

    def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
        return bags(*shingles(*word_hashes(pa.array([text], pa.large_string())), size))[1:]

    def run(batches):
        last, own = None, None
        for part in B.slices(batches, "text_a", SLICE):
            far, ends, texts = [], B.column(part, "b").to_pylist(), B.column(part, "text_b")
            for i, text in enumerate(B.column(part, "text_a").to_pylist()):
                if ends[i] != last:
                    last, own = ends[i], bag(texts[i].as_py())
                far.append(1 - similarity(bag(text), own))
            yield pa.RecordBatch.from_arrays([B.column(part, "a"), B.column(part, "b"), pa.array(far, pa.float64())],
                                             names=["a", "b", "far"])

    kind = _kind(docs)
    return left.join(right, left["b"] == right["end"]).select("a", "b", "text_a", "text_b").mapInArrow(
        B.task(run), f"a {kind}, b {kind}, far double")


def _labels(docs: DataFrame, threshold: float, size: int, registers: int, band: int) -> DataFrame:
    """``id``, ``label`` (the least id of the class) of documents (``id``, ``text``) with different ids and words in the text."""
    signed = written(_signatures(docs, size, registers, band), "signatures")
    reps = signed.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    reps = written(reps, "representatives")
    entries = reps.select("id", F.explode("bands").alias("bucket")).distinct()
    crowd = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    entries = written(entries.join(crowd, "bucket"), "entries")
    fame = entries.groupBy("id").agg(F.sum("n").alias("fame"))
    chief = entries.join(fame, "id").groupBy("bucket").agg(F.max(F.struct("fame", "id")).alias("top"))
    stars = entries.join(chief, "bucket").where("id <> top.id").select(F.col("id").alias("a"), F.col("top.id").alias("b"))
    judged = written(_compared(written(stars.distinct(), "pairs"), docs, size), "judged")
    alike = F.col("far") <= 1 - threshold + 1e-9
    links = judged.where(alike)
    label = components(links)
    members = entries.select("id", "bucket").join(label, "id", "left").select(
        "id", "bucket", F.coalesce("label", "id").alias("label"))
    mixed = members.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    members = written(members.join(mixed.select("bucket"), "bucket"), "mixed")
    few = members.select("id").distinct()
    fine = _fine(docs.join(near(few, BROADCAST_PAIRS), "id"), size).groupBy("id").agg(F.first("sketch").alias("sketch"))
    bands = reps.groupBy("id").agg(F.first("bands").alias("bands"))
    members = members.join(bands, "id").join(fine, "id")
    floor = threshold - 4 * (threshold * (1 - threshold) / FINE) ** 0.5
    known = judged.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _close(members, floor).distinct().join(known, ["a", "b"], "left_anti")
    more = written(_compared(written(more, "pairs"), docs, size), "judged").where(alike)
    labels = label if more.isEmpty() else components(links.unionAll(more))
    member = signed.select("id", "h1", "h2").join(reps.select("h1", "h2", F.col("id").alias("rep")), ["h1", "h2"])
    return member.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").select(
        "id", F.coalesce("label", "rep").alias("label"))


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, size: int = WORDS, registers: int = REGISTERS,
             band: int = BAND) -> tuple[DataFrame, F.Column, bool]:
    """``key`` (of each different row), ``id``, ``class_id`` and ``first``, the class's least id and the least key with
    it; the expression of the key; whether the keys are the ids."""
    docs = docs.where(F.col(id_col).isNotNull())
    plain = plain_ids(docs, id_col)
    key = F.col(id_col).cast("long") if plain else F.xxhash64(id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    if not plain:
        # rows of one key are copies
        rows = written(rows.dropDuplicates(["key"]), "texts")
    label = _labels(rows.select(F.col("key").alias("id"), "text"), threshold, size, registers, band)
    every = rows.select("key", "id").join(label.withColumnRenamed("id", "key"), "key", "left").select(
        "key", "id", F.coalesce("label", "key").alias("label"))
    if plain:
        return every.select("key", "id", F.col("label").cast(dict(rows.dtypes)["id"]).alias("class_id"), F.col("label").alias("first")), key, True
    every = written(every, "labels")
    least = every.groupBy("label").agg(F.min(F.struct("id", "key")).alias("least"))
    return every.join(least, "label").select(
        "key", "id", F.col("least.id").alias("class_id"), F.col("least.key").alias("first")), key, False


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY,
                    size: int = WORDS, registers: int = REGISTERS, band: int = BAND) -> DataFrame:
    """``id_col``, ``class_id`` (the least id of the class), ``kept`` (it is that id); a row for each id."""
    found, _, plain = _classes(docs, id_col, text_col, threshold, size, registers, band)
    if not plain:
        found = found.groupBy("id").agg(F.min("class_id").alias("class_id"))
    return found.select(F.col("id").alias(id_col), "class_id", (F.col("id") == F.col("class_id")).alias("kept"))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row of each class of near-duplicates, one with the least id, with all columns; rows without an id stay.

    Rows of one id with different texts are judged one by one; of rows with the same id and text the least one stays.
    """
    found, key, plain = _classes(docs, id_col, text_col, threshold)
    gone_key = free_name(docs, "gone key")
    gone = written(found.where("key <> first").select(F.col("key").alias(gone_key)), "copies")
    gone = near(gone, BROADCAST_PAIRS)
    if plain:
        return docs.join(gone, key == F.col(f"`{gone_key}`"), "left_anti")
    names = docs.columns
    kept = docs.where(F.col(id_col).isNotNull()).join(gone, key == F.col(f"`{gone_key}`"), "left_anti")
    one = kept.groupBy(key.alias("row key")).agg(F.min(F.struct(*names)).alias("row"))
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in names]).union(docs.where(F.col(id_col).isNull()))
