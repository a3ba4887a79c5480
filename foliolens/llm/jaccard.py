"""Exact Jaccard join of documents on word shingles by universe partition and pigeonhole.

A document's shingles are dealt to segments by hash; two similar documents differ in so few shingles that some segment differs by
none, or by one.  Segments' contents, and their one-deletion variants, are hashed and matched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.components import components
from foliolens.llm.kernels import chunks, distinct, gram_hashes, lower, mix, pack, unpack, word_hashes, words
from foliolens.llm.store import stage, targets

WORDS = 5
#: Similarity of at least 80 / 100.
PERCENT = 80
#: Shingles or signatures that one task holds before it sends them.
HELD = 1_000_000
#: Longs in the bitmap of a document for the parity filter.
BITMAP = 16
#: Deletion variants are kept for the first of this many segments of three.
ELIGIBLE = 3
INDEXED, PROBING = 1, 2
#: Documents of a group that are compared with each other in one task.
BLOCK = 2000
#: Rounds in which each document is compared with its nearest one in another component, before all other pairs are.
NEAREST_ROUNDS = 3


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct hashes of the 5-word shingles of each text; shorter texts are one shingle."""
    data = lower(data)
    starts, ends, first = words(offsets, data)
    tokens = word_hashes(data, starts, ends)
    grams, out = gram_hashes(tokens, WORDS), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            out.append(distinct(grams[a : b - WORDS + 1]))
        else:
            out.append(mix(gram_hashes(tokens[a:b], b - a) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def _bands(longest: int) -> np.ndarray:
    """First sizes of the size bands; each band ends before the next."""
    edges = [1]
    while edges[-1] <= longest:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // PERCENT)))
    return np.array(edges)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, owner, role) of all signatures of the sets; similar sets share one that the smaller has indexed and the larger probes.

    In the band of the smaller set's size, at most H shingles differ.  A segment whose content must agree exactly is worth one unit,
    one that may differ by a shingle is worth two; units of H + 1 are enough.  The smaller set indexes all contents,
    and deletion variants of the eligible segments.  The larger spends units where they cost least: contents of filled segments first,
    then variants of the smallest eligible segments, and contents that many sets share (empty ones) only if nothing else is left.
    """
    sizes = np.array([len(s) for s in sets])
    edges = _bands(int(sizes.max(initial=1)))
    band = np.searchsorted(edges, sizes, "right") - 1
    out = []
    for down in range(len(edges)):
        lower_band = band - down
        ok = (sizes > 0) & (lower_band >= 0)
        ok[ok] &= (edges[np.maximum(lower_band, 0) + 1][ok] - 1) * 100 >= sizes[ok] * PERCENT
        if not ok.any():
            break
        which = np.flatnonzero(ok)
        out += _in_band([sets[i] for i in which], which, lower_band[which], edges, down == 0)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    return tuple(np.concatenate(p) for p in zip(*out))


def _in_band(sets: list[np.ndarray], owners: np.ndarray, band: np.ndarray, edges: np.ndarray, own: bool) -> list[tuple]:
    most = (edges[band + 1] - 1) * (100 - PERCENT) // PERCENT  # shingles that may differ
    keep = most > 0  # none may: such sets are found as equal ones
    if not keep.any():
        return []
    sets, owners, band, most = [s for s, k in zip(sets, keep) if k], owners[keep], band[keep], most[keep]
    small = most <= 4
    segments = np.where(small, (most + 2) // 2, most + 1)
    eligible = np.where(small, segments, -(-segments // ELIGIBLE))
    base = np.append(0, np.cumsum(segments))
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    s = np.concatenate(sets)
    spread, value = mix(s + np.uint64(11)), mix(s + np.uint64(12))
    cell = base[row] + (spread % segments[row].astype(np.uint64)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cell, value = cell[order], value[order]
    count = np.bincount(cell, minlength=base[-1])
    running = np.append(np.uint64(0), np.cumsum(value, dtype=np.uint64))
    upto = np.cumsum(count)
    content = running[upto] - running[upto - count]
    place = np.repeat(np.arange(len(sets)), segments)  # row of each cell
    number = np.arange(base[-1]) - base[place]
    label = mix(np.uint64(1 << 40) * band[place].astype(np.uint64) + number.astype(np.uint64))
    # Units without contents that many share: one for a filled segment, one more for variants of an eligible one of two or more.
    filled = count > 0
    extra = (number < eligible[place]) & (count >= 2)
    short = most + 1 - np.bincount(place, filled, len(sets)).astype(np.int64)
    cheap = np.lexsort((number, np.where(extra, count, 1 << 40), place))
    nth = np.empty(base[-1], np.int64)
    nth[cheap] = np.arange(base[-1]) - base[place[cheap]]
    spent = extra & (nth < short[place])
    lacking = short > np.bincount(place, extra, len(sets))
    probes = filled | lacking[place]
    kind = np.where(probes, PROBING, 0) + (INDEXED if own else 0)
    use = kind > 0
    out = [(mix(content[use] + label[use]), owners[place[use]], kind[use].astype(np.uint8))]
    # Variants without one shingle.
    vary = number < eligible[place]
    probes = spent | (vary & lacking[place])
    kind = np.where(probes, PROBING, 0) + np.where(vary & own, INDEXED, 0)
    kind = kind[cell]
    use = kind > 0
    cell, value = cell[use], value[use]
    out.append((mix(content[cell] - value + label[cell]), owners[place[cell]], kind[use].astype(np.uint8)))
    return out


class Sender:
    """Gathers (key, values) of one task and gives packed runs per target, sorted by key."""

    def __init__(self, pieces: int, narrow: bool):
        self.pieces, self.narrow, self.parts, self.size, self.flushed = pieces, narrow, [], 0, 0

    def add(self, key: np.ndarray, *values: np.ndarray) -> None:
        if len(key):
            self.parts.append((key, *values))
            self.size += len(key)

    def flush(self):
        """(target, blob) rows; the name of the flush is `part`."""
        columns = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else [np.zeros(0, np.uint64)]
        self.parts, self.size = [], 0
        key = columns[0]
        target = ((key >> np.uint64(32)) % np.uint64(self.pieces)).astype(np.int64)
        if self.narrow:
            key = key & np.uint64(0xFFFFFFFF)
            order = np.argsort(target.astype(np.uint64) << np.uint64(32) | key)
            key = key.astype(np.uint32)
        else:
            order = np.lexsort((key, target))
        key, target = key[order], target[order]
        rest = [c[order] for c in columns[1:]]
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(target) > 0)), len(target)) if len(target) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(target[a]), pack(key[a:b], *(c[a:b] for c in rest))

    def part(self) -> str:
        self.flushed += 1
        return f"{TaskContext.get().partitionId()}-{self.flushed}"


def _table(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


SCAN = "target int, part string, doc_id long, n long, digest binary, blob binary"
_SCAN = pa.schema([("target", pa.int32()), ("part", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("blob", pa.binary())])


def _scan(pieces: int):
    """Sizes and digests of all sets; halves of all shingles to their targets, once per set and task; the documents behind each part."""

    def run(batches):
        sender, seen, held = Sender(pieces, True), set(), []

        def send():
            part = sender.part()
            rows = [{"target": t, "part": part, "blob": b} for t, b in sender.flush()]
            rows.append({"part": part, "blob": pack(np.array([d for d, _ in held], np.int64), np.array([n for _, n in held], np.int64))})
            held.clear()
            return _table(_SCAN, rows)

        for rows, offsets, data in chunks(batches):
            ids, out = rows.column("doc_id").to_pylist(), []
            for doc, s in zip(ids, shingle_sets(offsets, data)):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                out.append({"doc_id": doc, "n": len(s), "digest": digest})
                if digest and digest not in seen and doc is not None:
                    seen.add(digest)
                    sender.add(s, np.full(len(s), len(held), np.uint32))
                    held.append((doc, len(s)))
            yield _table(_SCAN, out)
            if sender.size >= HELD:
                yield send()
        if held:
            yield send()

    return run


def _share(table: pa.Table) -> pa.Table:
    """For every part, how many of each document's shingles in this target some other document has too."""
    parts = [unpack(b, np.uint32, np.uint32) for b in table.column("blob").to_pylist()]
    key = np.concatenate([p[0] for p in parts])
    order = np.argsort(key, kind="stable")
    equal = np.diff(key[order]) == 0
    shared = np.zeros(len(key), bool)
    shared[order] = np.append(equal, False) | np.append(False, equal)
    at, blobs = 0, []
    for keys, owner in parts:
        blobs.append(pack(np.bincount(owner[shared[at : at + len(keys)]], minlength=1).astype(np.int64)))
        at += len(keys)
    return pa.table({"part": table.column("part"), "blob": pa.array(blobs, pa.binary())})


def _survive(table: pa.Table) -> pa.Table:
    """Documents of one part that share enough of their shingles to have a similar one at all."""
    ids = sizes = None
    counts = []
    for head, blob in zip(table.column("head").to_pylist(), table.column("blob").to_pylist()):
        if head:
            ids, sizes = unpack(blob, np.int64, np.int64)
        else:
            counts.append(unpack(blob, np.int64)[0])
    total = np.zeros(len(ids), np.int64)
    for c in counts:
        total[: min(len(c), len(total))] += c[: len(total)]
    return pa.table({"doc_id": ids[100 * total >= PERCENT * sizes]})


SETS = "target int, doc_id long, n long, bits array<long>, blob binary"
_SETS = pa.schema([("target", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("bits", pa.list_(pa.int64())), ("blob", pa.binary())])


def parity(s: np.ndarray) -> list[int]:
    """A bitmap where each shingle flips a bit: two sets differ in at least as many shingles as their bitmaps in bits."""
    flips = np.bincount((mix(s + np.uint64(13)) % np.uint64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64).tolist()


def _sign(pieces: int):
    def run(batches):
        sender = Sender(pieces, False)
        for rows, offsets, data in chunks(batches):
            ids, sets = rows.column("doc_id").to_numpy(), shingle_sets(offsets, data)
            yield _table(_SETS, [{"doc_id": int(d), "n": len(s), "bits": parity(s), "blob": s.tobytes()} for d, s in zip(ids, sets)])
            key, owner, role = signatures(sets)
            sender.add(key, ids[owner], role)
            if sender.size >= HELD:
                yield _table(_SETS, [{"target": t, "blob": b} for t, b in sender.flush()])
        yield _table(_SETS, [{"target": t, "blob": b} for t, b in sender.flush()])

    return run


MATCHED = "gid long, doc long, pivot long, role int, more boolean"


def _match(table: pa.Table) -> pa.Table:
    """Groups of documents with one signature, each list of members once: members linked to a pivot, and whether other pairs remain."""
    parts = [unpack(b, np.uint64, np.int64, np.uint8) for b in table.column("blob").to_pylist()]
    key, doc, role = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((doc, key))
    key, doc, role = key[order], doc[order], role[order]
    fresh = np.append(True, (np.diff(key) != 0) | (np.diff(doc) != 0)) if len(key) else np.zeros(0, bool)
    at = np.flatnonzero(fresh)
    role = np.bitwise_or.reduceat(role, at) if len(at) else role
    key, doc = key[at], doc[at]
    first = np.flatnonzero(np.append(True, np.diff(key) != 0)) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    group = np.repeat(np.arange(len(first)), size)
    if len(first):
        either = np.bitwise_or.reduceat(role, first)
        code = mix(doc.astype(np.uint64) * np.uint64(4) + role)
        gid = np.add.reduceat(code, first)
        useful = (size > 1) & (either == INDEXED + PROBING)
        once = np.zeros(len(first), bool)
        chosen = np.flatnonzero(useful)
        once[chosen[np.unique(gid[chosen], return_index=True)[1]]] = True
        probing = np.bincount(group, role >= PROBING, len(first))
        # With few probing members each of them is a pivot, and no other pairs are left.
        few = (probing <= 3) & (size > 2)
    out = []
    if len(first):
        for nth in range(3):
            rank = np.cumsum(role >= PROBING) - np.repeat((np.cumsum(role >= PROBING) - (role >= PROBING))[first], size)
            pick = np.flatnonzero((role >= PROBING) & (rank == nth + 1))
            pivot = np.full(len(first), -1)
            pivot[group[pick]] = pick
            use = once[group] & few[group] & (pivot[group] >= 0) & (pivot[group] != np.arange(len(key)))
            out.append((gid[group[use]], doc[use], doc[pivot[group[use]]], role[use], np.zeros(use.sum(), bool)))
        plain = once & ~few
        use = plain[group]
        out.append((gid[group[use]], doc[use], doc[first[group[use]]], role[use], (size > 2)[group[use]]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 5
    kinds = [np.int64, np.int64, np.int64, np.int32, bool]
    return pa.table({
        n: (c.view(np.int64) if c.dtype == np.uint64 else c).astype(k)
        for n, c, k in zip(("gid", "doc", "pivot", "role", "more"), columns, kinds)
    })


def _verify(batches):
    for batch in batches:
        a, b = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
        keep = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            keep.append(100 * same >= PERCENT * (len(both) - same))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar: sizes and bitmaps are compared first, then whole sets."""
    light = sets.select("doc_id", "n", "bits")
    side = lambda x: light.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    near = (least * 100 >= most * PERCENT) & (apart * PERCENT <= least * (100 - PERCENT))
    some = pairs.join(side("a"), "a").join(side("b"), "b").filter(near).select("a", "b").distinct()
    whole = lambda x: sets.select(F.col("doc_id").alias(x), F.col("blob").alias(f"set_{x}"))
    return some.join(whole("a"), "a").join(whole("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(_verify, "a long, b long")


def _near(every: bool):
    """Pairs of one group that are in different components and may be similar by size and bitmap.

    Without `every`, only the nearest such partner of each document: as one link joins two components, others are looked at only if it fails.
    """

    def run(table: pa.Table) -> pa.Table:
        doc, role, place, n = (table.column(c).to_numpy() for c in ("doc", "role", "component", "n"))
        # Unsigned: of a negative number, bitwise_count would count the bits of its absolute value.
        bits = np.array(table.column("bits").to_pylist(), np.int64).reshape(len(doc), BITMAP).view(np.uint64)
        a, b = [], []
        for i in range(len(doc)):
            apart = np.bitwise_count(bits ^ bits[i]).sum(axis=1)
            least, most = np.minimum(n, n[i]), np.maximum(n, n[i])
            ok = (place != place[i]) & (least * 100 >= most * PERCENT) & (apart * PERCENT <= least * (100 - PERCENT))
            ok &= ((role[i] >= PROBING) & (role % 2 == INDEXED)) | ((role[i] % 2 == INDEXED) & (role >= PROBING))
            found = np.flatnonzero(ok)
            if len(found):
                found = found if every else found[[apart[found].argmin()]]
                a += [int(doc[i])] * len(found)
                b += doc[found].tolist()
        return pa.table({"a": pa.array(np.minimum(a, b).astype(np.int64)), "b": pa.array(np.maximum(a, b).astype(np.int64))})

    return run


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the component of their document so far."""
    return rows.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _open(placed: DataFrame) -> DataFrame:
    """Groups that fall into several components, and how many blocks their documents make."""
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    spread = placed.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"), blocks)
    return spread.filter("low <> high").select("gid", "blocks")


def remaining(loose: DataFrame, found: DataFrame, every: bool) -> DataFrame:
    """Pairs still to compare in groups that fall into several components; large groups are compared in pairs of blocks."""
    placed = _placed(loose, found)
    rows = placed.join(_open(placed), "gid")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "gid", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "doc", "role", "component", "n", "bits"
    )
    return rows.groupBy("gid", "x", "y").applyInArrow(_near(every), "a long, b long").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of at least 0.8 of their sets of 5-word shingles.

    1. One scan hashes shingles; equal sets are grouped by digest and represented by the smallest doc_id.  Each shingle goes to a
       target once per set, which tells how many of a document's shingles others have too: with under 80 % there is no similar document.
    2. What is left gets signatures of segments (see `signatures`).  In each group with one signature, members are compared with a
       pivot; components of these links are found; then the nearest members of different components are compared, and at last all
       pairs of the group that may match and are not connected yet.  Pairs are verified on whole sets (of 64-bit shingle hashes).

    Words are maximal runs of [^\\x20\\x09-\\x0D], with A-Z lower-cased; with fewer than five words the sequence is one shingle.
    Returns a row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable, itself included).  Null and empty texts, and those
    without words, have no shingles and are linked with nothing.  Rows of one doc_id are one node.  A null doc_id has
    itself (null) as component, unless it equals another text.  An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = targets(docs)
    scanned = stage(texts.mapInArrow(_scan(pieces), SCAN), "shingles")
    documents = scanned.filter("n is not null").select("doc_id", "n", "digest")
    classes = documents.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    sent = scanned.filter("target is not null").select("target", "part", "blob").repartition(pieces, "target")
    shared = sent.groupBy("target").applyInArrow(_share, "part string, blob binary")
    heads = scanned.filter("target is null and n is null").select("part", F.lit(True).alias("head"), "blob")
    likely = (
        heads.unionByName(shared.select("part", F.lit(False).alias("head"), "blob")).groupBy("part").applyInArrow(_survive, "doc_id long")
    )
    digests = documents.join(likely.distinct(), "doc_id").select("digest").distinct()
    left = stage(classes.join(digests, "digest").select(F.col("rep").alias("doc_id")).filter("doc_id is not null").distinct(), "survivors")
    signed = stage(texts.join(left, "doc_id").mapInArrow(_sign(pieces), SETS), "signatures")
    sets = signed.filter("n is not null").select("doc_id", "n", "bits", "blob")
    runs = signed.filter("target is not null").select("target", "blob").repartition(pieces, "target")
    groups = stage(runs.groupBy("target").applyInArrow(_match, MATCHED), "groups")
    stars = groups.filter("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    found = stage(components(verified(stars, sets)), "components")
    # Groups that fall into several components: other pairs that signatures allow, the nearest first, then all that are left.
    bits = sets.select(F.col("doc_id").alias("doc"), "n", "bits")
    several = _placed(groups.filter("more").select("gid", "doc", "role").distinct(), found)
    several = several.join(_open(several).select("gid"), "gid").select("gid", "doc", "role")
    loose = stage(several.join(bits, "doc"), "loose")
    nearest = NEAREST_ROUNDS
    while not _open(_placed(loose, found)).isEmpty():
        more = stage(verified(remaining(loose, found, nearest == 0), sets), "more-links")
        grown = not more.isEmpty()
        if grown:
            found = stage(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)), "components")
        if nearest == 0:
            break
        # A round without new links would only repeat itself.
        nearest = nearest - 1 if grown else 0
    class_of = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    return documents.join(class_of, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents of the smallest doc_id of their class, unchanged; those without shingles and rows without doc_id all stay."""
    stays = jaccard_components(docs).filter("doc_id = component_id").select("doc_id").distinct()
    known = docs.join(stays, "doc_id", "left_semi").select(*docs.columns)
    return known.unionByName(docs.filter("doc_id is null"))
