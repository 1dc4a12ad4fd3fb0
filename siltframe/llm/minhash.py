"""Near-duplicate documents by min-max hashing.

Every document becomes its set of distinct ``width``-word shingles. Under each of ``permutations`` permutations of
the 32-bit numbers (multiplication by an odd number) both the smallest and the largest image are kept, so a signature
of 2 x permutations values costs one evaluation per value pair. ``rows`` values of distinct permutations make a band:
half of the bands are cut from the minima, half from the maxima. With 196 permutations in bands of 7 a pair at
similarity 0.8 shares no band with a chance of 2e-6.

A shared band only proposes a pair: every link is confirmed on the full shingle sets. Within a bucket no pairs are
spelled out. A document is first compared with the smallest id of the buckets it shares most of; where a bucket then
still spans several components, its largest component streams past an index of the others, and these past each other, so
no link between different texts that share a band is lost. Equal sets are found by fingerprint and never compared.

Null and empty texts have no shingles and are linked with nothing. Rows that repeat a doc_id are taken for the same
document. A null doc_id is linked with nothing and kept. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import prepare, sieve, stored
from .words import mix, shingles, stream, words

WIDTH, PERMUTATIONS, ROWS = 2, 196, 7
#: Members compared with one copy of their leader's text.
COMPANY = 64
#: Members of smaller components that are indexed together, and members of a larger one that pass them in one task.
PROBES, PART = 256, 1024
_BLOCK = 512
_U = np.uint64


def signature(numbers: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest image of a set under every permutation."""
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    high = np.zeros(len(factors), np.uint32)
    image = np.empty((min(_BLOCK, len(numbers)), len(factors)), np.uint32)
    short = (numbers >> _U(32)).astype(np.uint32)
    for k in range(0, len(short), _BLOCK):
        block = short[k : k + _BLOCK, None]
        out = np.multiply(block, factors, out=image[: len(block)])
        np.minimum(low, out.min(0), out=low)
        np.maximum(high, out.max(0), out=high)
    return low, high


def _signer(width: int, permutations: int, rows: int):
    factors = (stream(7, permutations) >> _U(32)).astype(np.uint32) | np.uint32(1)
    bands = permutations // rows

    def keys(numbers: np.ndarray) -> np.ndarray:
        values = np.stack(signature(numbers, factors))[:, : bands * rows].astype(_U).reshape(2 * bands, rows)
        key = mix(np.arange(1, 2 * bands + 1, dtype=_U))
        for r in range(rows):
            key = mix(key * _U(0x9E3779B97F4A7C15) + values[:, r])
        return key

    def sign(batches):
        for batch in batches:
            w = words(batch.column("text"))
            sets = [shingles(w.of(i), width) for i in range(batch.num_rows)]
            sizes = np.array([len(s) for s in sets], np.int64)
            marks = np.array([[mix(s).sum(dtype=_U), mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)] for s in sets], _U)
            flat = [keys(s).view(np.int64) for s in sets if len(s)]
            places = np.concatenate(([0], np.cumsum(np.where(sizes > 0, 2 * bands, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(marks[:, 0].view(np.int64) if len(sets) else []).cast(pa.int64()),
                    pa.array(np.ascontiguousarray(marks[:, 1]).view(np.int64) if len(sets) else []).cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(flat) if flat else [], pa.int64())),
                ],
                ["doc_id", "n_shingles", "mark1", "mark2", "keys"],
            )

    return sign


def _confirmer(width: int, percent: int):
    def confirm(batches):
        own = None
        for batch in batches:
            kinds = batch.column("member").to_numpy(zero_copy_only=False)
            heads, ids = batch.column("leader").to_numpy(), batch.column("doc_id").to_numpy()
            w, good = words(batch.column("text")), np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                own_set = shingles(w.of(i), width)
                if not kinds[i]:
                    own = own_set
                    continue
                both = np.sort(np.concatenate((own, own_set)))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good[i] = common > 0 and 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([pa.array(ids[good]), pa.array(heads[good])], ["a", "b"])

    return confirm


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (doc_id, leader) that are similar enough.

    A leader's text goes once to every COMPANY or so of its members, which are then compared one after the other:
    a leader of very many documents is spread over as many groups.
    """
    busy = pairs.groupBy("leader").agg(F.ceil(F.count("*") / COMPANY).alias("groups"))
    dealt = pairs.join(busy, "leader").select("leader", "doc_id", F.expr("pmod(xxhash64(doc_id), groups)").alias("part"))
    heads = dealt.select("leader", "part").distinct().withColumn("doc_id", F.col("leader"))
    roles = dealt.select("leader", "part", "doc_id", F.lit(True).alias("member")).union(heads.withColumn("member", F.lit(False)))
    rows = texts.join(roles.hint("merge"), "doc_id")  # by id at every size: how many roles there are is not known ahead
    return (
        rows.select("leader", "part", "member", "doc_id", "text").repartition("leader", "part").sortWithinPartitions("leader", "part", "member")
        .mapInArrow(_confirmer(width, percent), "a long, b long")
    )


def _crosser(width: int, percent: int):
    """Links between documents of different components; rows come by group, probes before members.

    The probes of a group are indexed by shingle and its members pass them one after the other. A link makes two
    components of the group one, so a group of n components gives n - 1 links at most.
    """

    def cross(batches):
        group, probes, index, root = None, [], None, {}

        def of(c):
            while c in root:
                c = root[c]
            return c

        for batch in batches:
            w, out = words(batch.column("text")), []
            columns = (batch.column(c).to_pylist() for c in ("g1", "g2", "g3", "member", "doc_id", "c"))
            for i, (g1, g2, g3, member, doc, c) in enumerate(zip(*columns)):
                own = shingles(w.of(i), width)
                if (g1, g2, g3) != group:
                    group, probes, index, root = (g1, g2, g3), [], None, {}
                if not member:
                    probes.append((doc, c, own))
                    continue
                if index is None:
                    flat = np.concatenate([x for *_, x in probes]) if probes else np.zeros(0, _U)
                    sizes = np.array([len(x) for *_, x in probes], np.int64)
                    owner = np.repeat(np.arange(len(probes)), sizes)
                    order = np.argsort(flat, kind="stable")
                    index, owner = flat[order], owner[order]
                lo, hi = np.searchsorted(index, own), np.searchsorted(index, own, "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                common = np.bincount(owner[at], minlength=len(probes))
                for k in np.flatnonzero((common > 0) & (100 * common >= percent * (sizes + len(own) - common))):
                    x, y = of(probes[k][1]), of(c)
                    if x != y:
                        root[x] = y
                        out.append((probes[k][0], doc))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return cross


def _compared(roles: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links inside the groups of ``roles`` (g1, g2, g3, member, doc_id, c) between probes and members."""
    order = ["g1", "g2", "g3", "member"]
    rows = texts.join(roles.hint("merge"), "doc_id").select(*order, "doc_id", "c", "text")
    return rows.repartition(*order[:3]).sortWithinPartitions(*order).mapInArrow(_crosser(width, percent), "a long, b long")


def _to_largest(rest: DataFrame, place: DataFrame) -> DataFrame:
    """Roles that compare components c with the largest one d of a bucket: d streams past blocks of members of c.

    A large component is spread over parts.
    """
    size = place.groupBy("c").agg(F.count("*").alias("n"))
    pairs = rest.select("c", "d").distinct().join(size, "c")
    deal = pairs.groupBy("d").agg(F.ceil(F.sum("n") / PROBES).alias("blocks"))
    deal = deal.join(size.select(F.col("c").alias("d"), F.ceil(F.col("n") / PART).alias("parts")), "d")
    deal = stored(deal, "deal", narrow=True)
    some = lambda n: f"pmod(xxhash64(doc_id), {n}) AS "
    every = lambda n: f"explode(sequence(0L, {n} - 1)) AS "
    probes = pairs.select("c", "d").join(place, "c").join(deal, "d").selectExpr("d AS g1", some("blocks") + "g2", every("parts") + "g3", "false AS member", "doc_id", "c")
    streams = place.withColumnRenamed("c", "d").join(deal, "d").selectExpr("d AS g1", every("blocks") + "g2", some("parts") + "g3", "true AS member", "doc_id", "d AS c")
    return probes.union(streams)


def _in_bucket(rest: DataFrame, place: DataFrame) -> DataFrame:
    """Roles that compare what is outside of a bucket's largest component, where it spans several components.

    A bucket of many documents is cut into blocks, and every two blocks meet in a group of their own.
    """
    rows = rest.select("key", "doc_id").join(place, "doc_id")
    wide = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.ceil(F.count("*") / PROBES).alias("blocks")).where("low < high")
    rows = rows.join(wide.select("key", "blocks"), "key").selectExpr("key", "doc_id", "c", "pmod(xxhash64(doc_id), blocks) AS own", "explode(sequence(0L, blocks - 1)) AS other")
    both = "explode(if(own = other, array(false, true), array(own > other))) AS member"
    return rows.selectExpr("key AS g1", "least(own, other) AS g2", "greatest(own, other) AS g3", both, "doc_id", "c")


def _merged(place: DataFrame, links: DataFrame) -> DataFrame:
    """``place`` (doc_id, c) with the components that ``links`` (a, b) connect made one."""
    of = lambda end: place.select(F.col("doc_id").alias(end), F.col("c").alias(f"c_{end}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    joined = components(edges).withColumnsRenamed({"node": "c", "component": "root"})
    return stored(place.join(joined, "c", "left").select("doc_id", F.coalesce("root", "c").alias("c")), "place", narrow=True)


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = 80, permutations: int = PERMUTATIONS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text): doc_id, n_shingles, component_id, kept."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(
        docs.mapInArrow(_signer(width, permutations, rows), "doc_id long, n_shingles long, mark1 long, mark2 long, keys array<long>"),
        "signed",
    )
    known = signed.where("n_shingles > 0 and doc_id is not null")

    # Equal sets: the smallest id of a class stands for it from here on.
    mark = ["mark1", "mark2", "n_shingles"]
    classes = known.groupBy(*mark).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = stored(known.select("doc_id", *mark).join(classes, mark).where("doc_id > first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")), "copies", narrow=True)

    bands = known.select("doc_id", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader < last")
    alone = copies.select(F.col("a").alias("doc_id")).distinct()
    shared = stored(shared.select("key", "leader"), "shared", narrow=True)
    bands = sieve(shared.select("key"), bands, "key")
    members = stored(bands.join(shared, "key").join(alone, "doc_id", "left_anti"), "members", narrow=True)

    # First the smallest id of the buckets that a document shares most of: one pair for each document at most.
    pairs = members.where("doc_id > leader").groupBy("doc_id", "leader").agg(F.count("*").alias("bands"))
    best = pairs.groupBy("doc_id").agg(F.max_by("leader", F.struct("bands", -F.col("leader"))).alias("leader"))
    place = stored(members.select("doc_id", F.col("doc_id").alias("c")).distinct(), "place", narrow=True)
    texts = stored(sieve(place.select("doc_id"), docs, "doc_id"), "texts")
    place = _merged(place, stored(_confirmed(best, texts, width, percent), "links", narrow=True))

    # Then buckets that still span several components: the largest one against the others, and these among each other.
    spans = members.select("key", "doc_id").join(place, "doc_id")
    size = place.groupBy("c").agg(F.count("*").alias("n"))
    largest = spans.join(size, "c").groupBy("key").agg(F.max_by("c", F.struct("n", -F.col("c"))).alias("d"), F.min("c").alias("low"), F.max("c").alias("high"))
    rest = stored(spans.join(largest.where("low < high").select("key", "d"), "key").where("c <> d"), "rest", narrow=True)
    place = _merged(place, stored(_compared(_to_largest(rest, place), texts, width, percent), "links", narrow=True))
    place = _merged(place, stored(_compared(_in_bucket(rest, place), texts, width, percent), "links", narrow=True))

    placed = signed.select("doc_id", "n_shingles").join(copies.withColumnsRenamed({"a": "doc_id", "b": "first"}).groupBy("doc_id").agg(F.min("first").alias("first")), "doc_id", "left")
    placed = placed.withColumn("node", F.coalesce("first", "doc_id")).join(place.select(F.col("doc_id").alias("node"), "c"), "node", "left")
    return placed.select(
        "doc_id", "n_shingles", F.coalesce("c", "node").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("c", "node"), F.lit(True)).alias("kept")
    )
