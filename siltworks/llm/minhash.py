"""Near-duplicate groups: SuperMinHash, banding, verification, components.

1.  Each document becomes the set of its distinct word shingles.  Documents
    with the same set form a class (128-bit digest); thousands of copies are
    one node from here on.
2.  A class gets a SuperMinHash signature: every element draws a permutation
    of the slots step by step, so ranks of one element are correlated and the
    signature varies less than with independent hashes.  A document stops as
    soon as its slots are full (early stopping).
3.  ``BANDS`` bands of ``ROWS`` slots make buckets.  A pair at 0.8 shares no
    bucket with probability (1 - 0.8**5)**32 = 3e-6.
4.  In a bucket every class is first compared with the least one.  Buckets
    that then still hold several components are worked through whole, each a
    group of rows with the texts: a pair of two components is compared in the
    first bucket it shares, so in one place only, and only links leave the
    task.  A bucket of more than ``CHUNK`` classes, or ``CHUNK_BYTES`` of packed
    texts, is dealt out as pairs of its chunks.  Nothing is capped, and no table of pairs arises.
    Before texts are read, sizes and signatures must allow the link: signatures
    are compared by four bits a slot; a pair at 0.8 differs in 30 of 160 and in
    more than ``DIFFERENT`` with probability 1e-7.  Links are confirmed on
    whole shingle sets, rebuilt from the texts.
5.  Components come from the verified links by large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .graph import components, join_hot
from .workspace import documents, Workspace

BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: Classes of a bucket that a task holds at a time, twice, and bytes of their packed texts.
CHUNK, CHUNK_BYTES = 4096, 8 << 20
#: Candidate pairs that a task holds before it confirms them.
PAIRS = 1 << 18
DIFFERENT = 57
U = np.uint64
_STEPS = np.arange(1 << 12, dtype=U) * U(K.BASE)
_WEIGHTS = [U(pow(K.BASE, 7 * k + 3, 1 << 64)) for k in range(64)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row of fewer words has one shingle, one of none has none."""
    words, at = K.word_hashes(data, offsets)
    n = len(words) - width + 1
    whole = np.zeros(max(n, 0), U)
    for k in range(width):
        if n > 0:
            whole += words[k : k + n] * _WEIGHTS[k]
    whole = K.mix(whole)
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
        if j - i >= width:
            out.append(np.unique(whole[i : j - width + 1]))
        elif j > i:
            own = np.zeros(1, U)
            for k in range(j - i):
                own += words[i + k : i + k + 1] * _WEIGHTS[k]
            out.append(K.mix(own + U(j - i)))
        else:
            out.append(np.zeros(0, U))
    return out


def superminhash(sets: list[np.ndarray], slots: int = SLOTS, seed: int = 1) -> np.ndarray:
    """Signatures, one row a set; an empty set has all bits set.

    Step j of an element exchanges slot j of its permutation with a later one
    and offers j plus a fraction there.  All elements take step j together;
    sets whose slots are full leave, as later steps could not lower a slot.
    """
    counts = np.array([len(s) for s in sets])
    sig = np.full((len(sets), slots), ~U(0))
    if not counts.sum():
        return sig
    flat = sig.reshape(-1)
    x = K.mix(np.concatenate(sets) + _STEPS[seed])
    doc = np.repeat(np.arange(len(sets)), counts)
    perm = None
    for j in range(slots):
        z = K.mix(x + _STEPS[j + 1])
        pick = (((z >> U(32)) * U(slots - j)) >> U(32)).astype(np.int64) + j
        value = (z & U(0xFFFFFFFF)) | (U(j) << U(32))
        if perm is None:
            slot, to = pick, None
        else:
            rows = np.arange(len(pick))
            slot = perm[rows, pick].astype(np.int64)
            to = perm[:, j].copy()
        np.minimum.at(flat, doc * slots + slot, value)
        open_sets = (sig.max(axis=1) == ~U(0)) & (counts > 0)
        live = open_sets[doc]
        if not live.any():
            break
        if perm is None:
            doc, x, pick = doc[live], x[live], pick[live]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(doc), 1))
            perm[np.arange(len(doc)), pick] = 0
            perm[:, 0] = pick
        else:
            perm[rows, pick] = to
            perm[:, j] = slot
            if not live.all():
                doc, x, perm = doc[live], x[live], perm[live]
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket for each band of each signature."""
    s = sig.reshape(len(sig), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=U) * U(K.BASE), (len(sig), 1))
    for r in range(rows):
        key = K.mix(key + s[:, :, r])
    return key


def sketches(sig: np.ndarray) -> np.ndarray:
    """Four bits of every slot, 16 slots in a 64-bit number."""
    nibbles = (K.mix(sig.copy()) & U(15)).reshape(len(sig), -1, 16)
    return (nibbles << (np.arange(16, dtype=U) * U(4))).sum(axis=2, dtype=U)


def different(a: Column, b: Column, slots: int = SLOTS) -> Column:
    """In how many slots two sketches differ."""
    out = F.lit(0)
    for k in range(slots // 16):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        out = out + F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    return out


def _digests(sets: list[np.ndarray]) -> list[bytes]:
    out = []
    for s in sets:
        with np.errstate(over="ignore"):
            a, b = K.mix(s + U(1)).sum(dtype=U), K.mix(s ^ U(0xA5A5A5A5DEADBEEF)).sum(dtype=U)
        out.append(int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big"))
    return out


def signatures(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(key, node binary, n_shingles, bands, sketch, body): body is the zstd text; sets of no shingle have null bands."""
    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            data, offsets = K.utf8(b.column(1))
            for i, j in K.slices(offsets):
                own = offsets[i : j + 1] - offsets[i]
                part = data[offsets[i] : offsets[j]]
                sets = shingle_sets(part, own, width)
                n = np.array([len(s) for s in sets])
                sig = superminhash(sets)
                keys, low = band_keys(sig).view(np.int64), sketches(sig).view(np.int64)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(0, low.size + 1, SLOTS // 16, dtype=np.int32)), pa.array(low.reshape(-1)))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1)), mask=pa.array(n == 0))
                body = [pack.compress(part[p:q].tobytes()) for p, q in zip(own[:-1], own[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(_digests(sets), pa.binary()), pa.array(n), bands, sketch, pa.array(body, pa.binary())], ["key", "node", "n_shingles", "bands", "sketch", "body"])

    return picked.mapInArrow(run, f"key {kind}, node binary, n_shingles bigint, bands array<bigint>, sketch array<bigint>, body binary")


def verify(pairs: DataFrame, bodies: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets share at least percent of their union; bodies: (node, body)."""
    right = pairs.join(bodies.select(F.col("node").alias("b"), F.col("body").alias("y")), "b")
    both = right.join(bodies.select(F.col("node").alias("a"), F.col("body").alias("x")), "a").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last: tuple = (None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                a, b, x, y = (c.to_pylist() for c in part.columns)
                fresh, texts = {}, []
                if a[0] == last[0]:
                    fresh[a[0]] = last[1]
                for node, body in [*zip(a, x), *zip(b, y)]:
                    if node not in fresh:
                        fresh[node] = None
                        texts.append((node, unpack.decompress(body)))
                offsets = np.zeros(len(texts) + 1, np.int64)
                np.cumsum([len(t) for _, t in texts], out=offsets[1:])
                if texts:
                    data = np.frombuffer(b"".join(t for _, t in texts), np.uint8)
                    for i, j in K.slices(offsets):
                        sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                        for (node, _), s in zip(texts[i:j], sets):
                            fresh[node] = s
                last = a[-1], fresh[a[-1]]
                ok = []
                for p, q in zip(a, b):
                    s, t = fresh[p], fresh[q]
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    ok.append(100 * common >= percent * (len(s) + len(t) - common))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok)), part.column(1).filter(pa.array(ok))], ["a", "b"])

    return both.mapInArrow(run, "a binary, b binary")


def _links(ws: Workspace, sig: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Roots (node, root) of classes linked with another class, or None if no class shares a bucket."""
    rows = sig.where("bands IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands")).select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("leader")).where("size > 1").drop("size")
    members = ws.save(rows.join(shared, "bucket"), "members")
    if members.isEmpty():
        return None
    nodes = members.select("node").distinct()
    known = sig.join(nodes, "node").groupBy("node", F.col("n_shingles").alias("n"))
    known = ws.save(known.agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min_by("body", F.struct(F.length("body"), "body")).alias("body")), "bodies", "none")
    of_node = known.select("node", "n", "sketch")
    of_leader = of_node.select(F.col("node").alias("leader"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    # too different in size: the union is too large whatever is shared
    near = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (different(F.col("sketch"), F.col("other")) <= DIFFERENT)
    star = members.where("node <> leader").select("node", "leader").distinct().join(of_node, "node").join(of_leader, "leader").where(near)
    star = ws.save(star.select(F.col("leader").alias("a"), F.col("node").alias("b")), "star")
    links = ws.save(verify(star, known.select("node", "body"), width, percent), "links")
    roots = ws.save(components(ws, links, "stars"), "roots")
    # the root and the packed size of every class that shares a bucket
    nodes = known.select("node", F.length("body").cast("bigint").alias("bytes")).join(roots, "node", "left")
    of = members.join(nodes, "node").select("bucket", "node", "bytes", F.coalesce("root", "node").alias("root"))
    mixed = of.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("bytes").alias("bytes"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    mixed = mixed.select("bucket", F.greatest(F.ceil(F.col("size") / CHUNK), F.ceil(F.col("bytes") / CHUNK_BYTES)).cast("int").alias("chunks"))
    rows = of.drop("bytes").join(mixed, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"i": F.least("chunk", "with"), "j": F.greatest("chunk", "with")}).join(known, "node")
    rows = rows.select("bucket", "i", "j", "node", "root", "chunk", "n", "bands", "sketch", "body").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    more = ws.save(rows.mapInArrow(_bucket_links(width, percent), "a binary, b binary"), "more")
    if more.isEmpty():
        return roots
    return ws.save(components(ws, links.unionByName(more), "stars-all"), "roots-all")


def _bucket_links(width: int, percent: int):
    """Links between components inside each bucket of a sorted stream of rows."""

    def group(t: pa.Table, unpack) -> list[tuple[bytes, bytes]]:
        bucket, node, chunk = t.column("bucket")[0].as_py(), t.column("node").to_pylist(), t.column("chunk").to_numpy()
        n = t.column("n").to_numpy()
        keys = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        sketch = t.column("sketch").combine_chunks().flatten().to_numpy().view(U).reshape(len(node), -1)
        code: dict[bytes, int] = {}
        root = np.array([code.setdefault(x, len(code)) for x in t.column("root").to_pylist()])
        if len(code) < 2:
            return []
        band = int((keys[0] == bucket).argmax())  # the bucket's own; an earlier shared one has done the pair
        cross = t.column("i")[0].as_py() != t.column("j")[0].as_py()
        parent = list(range(len(code)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        sets: dict[int, np.ndarray] = {}

        def read(need: list[int]) -> None:
            texts = [unpack.decompress(x) for x in t.column("body").take(pa.array(need)).to_pylist()]
            offsets = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(x) for x in texts], out=offsets[1:])
            data = np.frombuffer(b"".join(texts), np.uint8)
            texts.clear()
            for i, j in K.slices(offsets):
                sets.update(zip(need[i:j], shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)))

        out = []

        def confirm(found: list[tuple]) -> None:
            """Links among the pairs found, the nearest first; pairs of one component by then are no matter."""
            gap, first, second = map(np.concatenate, zip(*found))
            if need := sorted({*np.unique(first).tolist(), *np.unique(second).tolist()} - sets.keys()):
                read(need)
            for at in np.argsort(gap, kind="stable"):
                k, m = int(first[at]), int(second[at])
                p, q = find(root[k]), find(root[m])
                if p != q:
                    s, u = sets[k], sets[m]
                    common = len(np.intersect1d(s, u, assume_unique=True))
                    if 100 * common >= percent * (len(s) + len(u) - common):
                        parent[q] = p
                        out.append((node[k], node[m]))

        found: list[tuple] = []
        held, now = 0, root
        for k in range(len(node) - 1):
            ok = (now[k + 1 :] != now[k]) & (100 * np.minimum(n[k + 1 :], n[k]) >= percent * np.maximum(n[k + 1 :], n[k]))
            if cross:
                ok &= chunk[k + 1 :] != chunk[k]
            at = k + 1 + np.flatnonzero(ok)
            if not len(at):
                continue
            at = at[~(keys[at, :band] == keys[k, :band]).any(axis=1)]
            x = sketch[at] ^ sketch[k]
            x |= x >> U(1)
            x |= x >> U(2)
            gap = np.bitwise_count(x & U(0x1111111111111111)).sum(axis=1)
            near = np.flatnonzero(gap <= DIFFERENT)
            if len(near):
                found.append((gap[near].astype(np.uint8), np.full(len(near), k, np.int32), at[near].astype(np.int32)))
                held += len(near)
            if held >= PAIRS:
                confirm(found)
                found, held, now = [], 0, np.array([find(x) for x in range(len(code))])[root]
        if found:
            confirm(found)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> list[tuple[bytes, bytes]]:
            out = group(pa.Table.from_batches(held), unpack) if held else []
            held.clear()
            return out

        for b in batches:
            key = np.stack([b.column(k).to_numpy() for k in range(3)], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            found = []
            for i, j in zip(cuts[:-1], cuts[1:]):
                if last is not None and tuple(key[i]) != last:
                    found += flush()
                last = tuple(key[i])
                held.append(b.slice(i, j - i))
            if found:
                yield _edges(found)
        if found := flush():
            yield _edges(found)

    return run


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], ["a", "b"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: key, n_shingles, component_id, kept.

    Words are runs without white space, with A-Z in lower case; a shingle is
    `width` of them.  Documents at `percent` or more of the Jaccard measure are
    linked; component_id is the least key of what links reach.  Null and blank
    texts have no shingle and stand alone.  Rows with a repeated key are each
    returned; keys that are null never are a component's id unless all are.
    Texts of any length are read whole, an empty table gives no row, and other
    columns are not read.
    """
    ws = Workspace(docs.sparkSession, "near")
    sig = ws.save(signatures(docs, key, text, width), "signatures", "none")
    roots = _links(ws, sig, width, percent)
    classes = sig.where("n_shingles > 0").groupBy("node").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    if roots is not None:
        classes = ws.save(classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "classes")
        tops = classes.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
        classes = join_hot(classes, tops, "root", "m", classes.count()).select("node", "component_id", "n")
    else:
        classes = classes.select("node", F.col("least").alias("component_id"), "n")
    classes = ws.save(classes, "ids")
    # documents without a shingle have one digest, and would all meet in one task of the join
    rows = sig.where("n_shingles > 0").select("key", "node", "n_shingles")
    full = join_hot(rows, classes, "node", "n", sig.count()).drop("node")
    alone = sig.where("n_shingles = 0").select("key", "n_shingles", F.col("key").alias("component_id"))
    out = full.unionByName(alone)
    return out.select(F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=4)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the least key, with all its columns.

    Rows are told apart by their place in their file, or in a written copy of
    docs where they come from no file, so repeated and null keys lose no text:
    a null key comes after all others, equal keys are in the order of place.
    Null and blank texts stay, an empty table stays empty.
    """
    ws = Workspace(docs.sparkSession, "one")
    try:
        numbered = docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("__place"))
    except AnalysisException:
        numbered = ws.save(docs.withColumn("__place", F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("__place").alias("place"))
    near = near_duplicates(numbered.select(order.alias("order"), F.col(text).alias("text")), "order", "text", width, percent)
    # written, its size is known: a small list goes to the documents
    gone = ws.save(near.where("NOT kept").select(F.col("order.place").alias("__gone")), "gone")
    return numbered.join(gone, F.col("__place") == F.col("__gone"), "left_anti").drop("__place")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), the one with the least doc_id; all columns, null and empty texts kept."""
    return keep_one(docs)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS g FROM w),
n AS (SELECT doc_id, len(g) AS n FROM s),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON r.d = e.a WHERE r.root < e.b)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.root AS component_id, n.doc_id = c.root AS kept FROM n JOIN (SELECT d, min(root) AS root FROM r GROUP BY d) c ON n.doc_id = c.d
"""

QUERIES = {"op7_near_duplicates": op7_near}
ORACLES = {"op7_near_duplicates": SQL}
