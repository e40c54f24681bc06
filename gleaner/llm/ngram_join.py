"""N-gram Jaccard join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Prefix filtering with token combinations. Shingles are ordered by class, rare first, then by hash. If two sets of sizes n
and m are similar, each shares at least o = ceil(0.8 n) of its shingles, so their first n - o + 1 shingles share one. A
set whose first n - o + 1 shingles are all rare is indexed by those, one by one. A set with r rare shingles, fewer than
that, has its prefix extended: it is indexed by its rare shingles and by k-combinations of frequent ones. Not all
combinations are needed: similar sets differ by at most one shingle for each four that they share, so if they share no
rare shingle, k shingles that both hold stand side by side in the order of both (four sets of three divided by four
differences hold thirteen shingles at most); `reach` bounds how far into the frequent part the first such run can end.
So a set has less than n combinations, at any size. Sets of up to PAIRS_UPTO shingles use k = 2, larger ones k = LONG_K,
and those from LONG_FROM on both, so that similar sets always have a k in common.

The classes come from counters over all different texts: each task counts shingles into a table of counters, Spark sums the
tables, and a shingle's class is the logarithm of its bucket's count; it is rare if the bucket holds at most
2 ** RARE_CLASS sets. A bucket holds at least what its shingles hold, so a rare key has at most that many sets, and its
pairs are bounded. The table grows with the texts, so that a bucket holds LOAD sets or fewer on the average: in a crowded
table all shingles would be frequent, and each set would be indexed by nearly n combinations in place of n / 5 keys. It has
2 ** MOST_BITS buckets at most, in half a byte each, so it may be broadcast; beyond that the bound on rare keys doubles
with the input. A crowded bucket only makes shingles frequent; no class is ever wrong for the result. A shingle that is
alone in its bucket is no key, since no other set has it.

Candidates of rare keys are checked exactly: first by how many keys they share, then by parity bits (the distance of two
parity strings bounds the symmetric difference from below), then by intersecting the full sets. Keys of combinations may
be shared by very many sets. There each set meets the key's pivot (for every second key the set with the least share of
rare shingles, which is what edited copies have in common). Links inside one component change nothing, so afterwards only
sets outside the component of most of the key's sets are still to be joined: in blocks, first by parity alone, to find the
sets that have a possible partner at all, then those by their full sets. A block gives a spanning forest of its links,
never all pairs. Exact copies (equal sets) are one set throughout, known by a 64-bit fingerprint of all shingles and
their number, and equal texts are one text, known by a hash of 64 bits. Sets are larger than their texts once these are
compressed, so they are not stored: a text is shingled to be counted, again to be indexed, and again if one of its
candidates is to be checked. Keys travel in sorted runs of a task, packed. The sets to be checked are stored with 48 bits
of each hash, so that two of 10^5 shingles are taken for one with a chance of some 10^-5 when a pair is checked.

Defined results: words split at blank and U+0009 to U+000D, A-Z lower-cased; fewer than five words form one shingle; null,
empty and blank texts have no shingles and are linked with nothing; repeated rows are copies; a null id is larger than any
other; a text of any length is one set. Columns other than doc_id and text don't enter; keep_one keeps them, whatever
their names. An empty table gives an empty result. The documents are read several times and must be the same each time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, pack, pack_sorted, stored, unpack, unpack_sorted

WIDTH = 5
LEAST_BITS, MOST_BITS, LOAD = 20, 27, 12
SHINGLE_OCTETS = 6  # of a text, for each of its shingles, about
CHUNKS = 64
RARE_CLASS = 5  # rare: at most 32 sets in the bucket
PAIRS_UPTO, LONG_FROM, LONG_K = 40, 32, 4  # LONG_FROM <= 0.8 * PAIRS_UPTO
PARITY_WORDS = 16
MARK_BITS = 26
PACK_KEYS, SLOT_KEYS = 1 << 20, 1 << 18  # keys that a task packs at once, and about those of a slot
STORED_BYTES = 6
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle sets of texts; remembers word hashes up to a bound."""

    def __init__(self, most_words: int = 150_000) -> None:
        self.hashes: dict[bytes, int] = {}
        self.most = most_words

    def of(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingle hashes."""
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.hashes) > self.most:
            self.hashes.clear()
        known = self.hashes
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        if len(words) < WIDTH:
            h = np.concatenate((h, np.full(WIDTH - len(words), 0x5BD1E995, dtype=np.uint64) + np.arange(WIDTH - len(words), dtype=np.uint64)))
        x = h[: len(h) - WIDTH + 1].copy()
        for k in range(1, WIDTH):
            x = x * _STEP + h[k : len(h) - WIDTH + 1 + k]
        return np.unique(_mix(x))


def fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(_mix(_mix(s ^ _STEP).sum(dtype=np.uint64).reshape(1) + np.uint64(len(s)))[0].astype(np.int64))


def parity(s: np.ndarray) -> np.ndarray:
    """PARITY_WORDS longs; bit b is the parity of the number of shingles whose top bits are b."""
    bits = np.bincount((s >> np.uint64(54)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def to_bytes(s: np.ndarray) -> bytes:
    """The upper STORED_BYTES bytes of each hash, byte by byte of equal weight: the first ones rise slowly and compress well."""
    return np.ascontiguousarray(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :STORED_BYTES].T).tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // STORED_BYTES, 8), dtype=np.uint8)
    out[:, :STORED_BYTES] = np.frombuffer(raw, dtype=np.uint8).reshape(STORED_BYTES, -1).T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _bucket(s: np.ndarray, bits: int) -> np.ndarray:
    return (s >> np.uint64(16) & np.uint64((1 << bits) - 1)).astype(np.int64)


def table_bits(octets: int) -> tuple[int, int]:
    """(bits of a bucket's number, by how much the rare class rises) for so many octets of text."""
    wanted = int(np.ceil(np.log2(max(octets / SHINGLE_OCTETS / LOAD, 1))))
    return min(max(wanted, LEAST_BITS), MOST_BITS), max(wanted - MOST_BITS, 0)


def marks(values: DataFrame):
    """A broadcast table of fixed size, of bits, that knows the given longs (in a column v), and takes a few others for them."""
    width = (1 << MARK_BITS) // CHUNKS

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        marked = np.zeros(width, dtype=bool)
        marked[pdf["bucket"].to_numpy() % width] = True
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "bits": [np.packbits(marked).tobytes()]})

    marked = values.select(F.pmod("v", F.lit(1 << MARK_BITS)).alias("bucket")).distinct().withColumn("chunk", F.floor(F.col("bucket") / width).cast("int"))
    table = np.zeros((CHUNKS, width // 8), dtype=np.uint8)
    for row in marked.groupBy("chunk").applyInPandas(packed, "chunk int, bits binary").collect():  # CHUNKS rows
        table[row["chunk"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return values.sparkSession.sparkContext.broadcast(table.reshape(-1))


def _marked(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % (1 << MARK_BITS)
    return (table[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


def _own() -> F.Column:
    """What a text is known by."""
    return F.xxhash64("text")


class Texts:
    """The different texts of (doc_id, text). `rows` has (doc_id, own, octets) of every document, `each` (own, first, octets) of every
    text, where first is its smallest doc_id; documents marked as first stand for their text."""

    def __init__(self, docs: DataFrame) -> None:
        doc_id = F.col("doc_id").cast("long").alias("doc_id")
        self.rows = stored(docs.select(doc_id, _own().alias("own"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("octets")), "join-rows")
        self.each = self.rows.groupBy("own").agg(F.min("doc_id").alias("first"), F.max("octets").cast("long").alias("octets"))
        self.docs = docs.select(F.xxhash64(_own(), doc_id).alias("mark"), _own().alias("own"), "text").where("text IS NOT NULL")
        self.first = marks(self.each.select(F.xxhash64("own", "first").alias("v")))

    def octets(self) -> int:
        return self.each.agg(F.sum("octets")).first()[0] or 0

    def map(self, run, schema: str, among=None) -> DataFrame:
        """run gets iterators of (own, shingles) for each text that has any; those marked in the broadcast table `among`, if given."""
        first = self.first

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
            shingler, seen = Shingler(), set()
            for batch in batches:
                batch = batch.filter(pa.array(_marked(first.value, batch.column("mark").to_numpy())))
                if among:
                    batch = batch.filter(pa.array(_marked(among.value, batch.column("own").to_numpy())))
                for own, text in zip(batch.column("own").to_pylist(), batch.column("text"), strict=True):
                    if own not in seen:
                        seen.add(own)
                        s = shingler.of(text.as_py())
                        if len(s):
                            yield own, s

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from run(each(batches))
            give_back()

        return self.docs.mapInArrow(whole, schema)


DESCRIBED = {"own": pa.int64(), "n": pa.int32(), "sig": pa.int64(), "bits": pa.list_(pa.int64()), "chunk": pa.int32(), "part": pa.int32(), "counts": pa.binary()}
TABLES = 64
BATCH_ROWS = 250


def describe(texts: Texts, bits: int) -> DataFrame:
    """A row for each text that has words (own, n, sig; bits with the first of equal sets in a task), and CHUNKS rows of counters a task."""

    def made(**columns: list) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * size), type=t) for c, t in DESCRIBED.items()], names=list(DESCRIBED))

    def run(sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        counts, seen, rows, fresh = np.zeros(1 << bits, dtype=np.uint16), set(), [], []
        for own, s in sets:
            f = fingerprint(s)
            if f not in seen:
                seen.add(f)
                fresh.append(_bucket(s, bits))
                rows.append((own, len(s), f, parity(s).tolist()))
            else:
                rows.append((own, len(s), f, None))
            if len(rows) == BATCH_ROWS:
                _count(counts, fresh)
                yield made(**dict(zip(("own", "n", "sig", "bits"), zip(*rows, strict=True), strict=True)))
                rows, fresh = [], []
        if rows:
            _count(counts, fresh)
            yield made(**dict(zip(("own", "n", "sig", "bits"), zip(*rows, strict=True), strict=True)))
        parts, part = counts.reshape(CHUNKS, -1), TaskContext.get().partitionId() // TABLES
        for k in range(CHUNKS):
            if parts[k].any():
                yield made(chunk=[k], part=[part], counts=[_pack(parts[k])])

    return stored(texts.map(run, "own long, n int, sig long, bits array<long>, chunk int, part int, counts binary"), "join-described")


def _count(counts: np.ndarray, buckets: list[np.ndarray]) -> None:
    if buckets:
        at, n = np.unique(np.concatenate(buckets), return_counts=True)
        counts[at] = np.minimum(counts[at] + n, 60000)


def _pack(counts: np.ndarray) -> bytes:
    """Most counters are 0, and most of the others 1: bits tell where they are, then follows what they are above 1."""
    at = counts > 0
    where = zstandard.compress(np.packbits(at).tobytes(), 1)
    return len(where).to_bytes(4, "little") + where + pack(np.minimum(counts[at], 60000).astype(np.int64) - 1)


def _total(tables: pd.Series, size: int) -> np.ndarray:
    total = np.zeros(size, dtype=np.int64)
    for raw in tables:
        cut = 4 + int.from_bytes(raw[:4], "little")
        at = np.flatnonzero(np.unpackbits(np.frombuffer(zstandard.decompress(raw[4:cut]), dtype=np.uint8)))
        total[at] += unpack(raw[cut:]) + 1
    return total


def shingle_classes(described: DataFrame, bits: int) -> np.ndarray:
    """The class of each bucket: ceil(log2(sets in it)), 15 at most, in half a byte: 2 ** (bits - 1) bytes.

    Tables are packed, summed TABLES at a time, and the sums again, so no group holds the tables of all tasks."""
    size = (1 << bits) // CHUNKS

    def sum_some(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "counts": [_pack(_total(pdf["counts"], size))]})

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        classes = np.minimum(np.ceil(np.log2(np.maximum(_total(pdf["counts"], size), 1))), 15).astype(np.uint8)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "classes": [zlib.compress((classes[::2] | classes[1::2] << 4).tobytes(), 1)]})

    some = described.where("chunk IS NOT NULL").select("chunk", "part", "counts").groupBy("chunk", "part").applyInPandas(sum_some, "chunk int, counts binary")
    classes = np.zeros((CHUNKS, size // 2), dtype=np.uint8)
    for row in some.groupBy("chunk").applyInPandas(mark, "chunk int, classes binary").collect():  # CHUNKS rows
        classes[row["chunk"]] = np.frombuffer(zlib.decompress(row["classes"]), dtype=np.uint8)
    return classes.reshape(-1)


def classes_of(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = _bucket(s, len(table).bit_length())
    return table[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15


def _prefix(n: int) -> int:
    return n - -(-80 * n // 100) + 1


def reach(n: int, rare: int, k: int) -> int:
    """How many frequent shingles of a set of n, `rare` of them rare, must be indexed by k in a row.

    Let a similar set share none of the rare ones. Of n, x >= rare are not shared; the n - x shared ones allow at most
    (n - x) // 4 differences on both sides together, so at most (n - x) // 4 - rare among the frequent ones. Before the first k shared
    ones in a row end, each difference closes at most k - 1 shared ones."""
    x = np.arange(rare, n // 5 + 1)
    return int((x - rare + (k - 1) * ((n - x) // 4 - rare)).max()) + k


def index_keys(s: np.ndarray, classes: np.ndarray, rare_class: int = RARE_CLASS) -> tuple[np.ndarray, np.ndarray, int]:
    """(rare keys, keys of combinations, number of rare shingles) of a set with the classes of its shingles."""
    n, order = len(s), np.lexsort((s, classes))
    s, rare = s[order], int((classes <= rare_class).sum())
    shared = classes[order[: min(rare, _prefix(n))]] > 0  # the only set in its bucket meets no other there
    if rare >= _prefix(n):
        return s[: _prefix(n)][shared], s[:0], rare
    keys = []
    for k in [2] * (n <= PAIRS_UPTO) + [LONG_K] * (n >= LONG_FROM):
        part = s[rare : rare + reach(n, rare, k)]
        key = np.full(max(len(part) - k + 1, 0), k, dtype=np.uint64)
        for j in range(k):
            key = key * _STEP + part[j : j + len(key)]
        keys.append(_mix(key))
    return s[:rare][shared], np.concatenate(keys), rare


def _all_rare(n: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Whether the prefix of a set is rare shingles alone."""
    return rare > n - -(-80 * n // 100)


INDEXED = {"slot": pa.int32(), "frequent": pa.bool_(), "keys": pa.binary(), "sigs": pa.binary(), "sizes": pa.binary(), "rares": pa.binary()}


def _runs(keys: np.ndarray, sigs: np.ndarray, sizes: np.ndarray, rares: np.ndarray, frequent: bool, slots: int) -> Iterator[pa.RecordBatch]:
    """The keys of a task, a row for each slot. A rare key belongs to a slot by its range, so that sorted ones lie near each other; rows of
    frequent keys are spread by set, since a key may have very many."""
    by = _mix(keys ^ sigs.astype(np.uint64)) if frequent else keys
    slot = ((by >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)
    keys = keys.astype(np.int64)
    order = np.lexsort((keys, slot))
    begins = np.flatnonzero(np.diff(slot[order], prepend=-1))
    rows = []
    for at in np.split(order, begins[1:]):
        rows.append((int(slot[at[0]]), frequent, pack_sorted(keys[at]), pack(sigs[at]), pack(sizes[at]), pack(rares[at])))
    for begin in range(0, len(rows), BATCH_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows[begin : begin + BATCH_ROWS], strict=True), INDEXED.values(), strict=True)], names=list(INDEXED))


def index_rows(texts: Texts, classes: np.ndarray, rare_class: int, slots: int) -> DataFrame:
    """The keys of each set, with sig, n and the number of rare shingles (with rare keys: whether the prefix is rare shingles alone), once a
    task, packed by slot."""
    shared = texts.rows.sparkSession.sparkContext.broadcast(classes)

    def run(sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[list[tuple]] = [[], []]
        waiting = [0, 0]

        def flush(kind: int) -> Iterator[pa.RecordBatch]:
            if held[kind]:
                keys, *rest = zip(*held[kind], strict=True)
                often = np.array([len(k) for k in keys])
                held[kind], waiting[kind] = [], 0
                yield from _runs(np.concatenate(keys), *[np.repeat(np.array(c, dtype=np.int64), often) for c in rest], bool(kind), slots)

        for _, s in sets:
            f = fingerprint(s)
            if f in seen:
                continue
            seen.add(f)
            rare_keys, often, rare = index_keys(s, classes_of(s, shared.value), rare_class)
            whole = int(_all_rare(np.int64(len(s)), np.int64(rare)))
            for kind, (keys, told) in enumerate(((rare_keys & ~np.uint64(0xFFFF), whole), (often, rare))):  # 48 bits of a shingle will do to meet
                if len(keys):
                    held[kind].append((keys, f, len(s), told))
                    waiting[kind] += len(keys)
                    if waiting[kind] >= PACK_KEYS:
                        yield from flush(kind)
        for kind in range(2):
            yield from flush(kind)

    return texts.map(run, "slot int, frequent boolean, keys binary, sigs binary, sizes binary, rares binary")


MET = "key long, a long, na int, b long, nb int, whole boolean, shared long"


def met(rows: pa.Table) -> pa.Table:
    """What the keys of a slot tell. Of rare ones the pairs (a, na, b, nb, whole, shared) of sets of a similar size, with the number of keys
    that they share here; of frequent ones (key, a, na, nb): the key, its set, n and the number of rare shingles."""
    found = []
    for frequent in (False, True):
        part = rows.filter(pc.equal(rows.column("frequent"), frequent))
        columns = ("keys", unpack_sorted), ("sigs", unpack), ("sizes", unpack), ("rares", unpack)
        key, sig, n, rare = (np.concatenate([np.zeros(0, dtype=np.int64), *(of(x.as_py()) for x in part.column(c))]) for c, of in columns)
        order = np.lexsort((sig, key))
        order = order[(np.diff(key[order], prepend=0) != 0) | (np.diff(sig[order], prepend=0) != 0) | (np.arange(len(order)) == 0)]
        key, sig, n, rare = key[order], sig[order], n[order], rare[order]
        if frequent:
            none = np.zeros(len(key), dtype=np.int64)
            found.append((key, sig, n, none, rare, none > 0, none))
            continue
        pairs, d = [], 1
        while len(at := np.flatnonzero(key[d:] == key[:-d])):
            similar = at[100 * np.minimum(n[at], n[at + d]) >= 80 * np.maximum(n[at], n[at + d])]
            pairs.append(np.stack((similar, similar + d)))
            d += 1
        x, y = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=np.int64)
        order = np.lexsort((sig[y], sig[x]))
        x, y = x[order], y[order]
        begins = np.flatnonzero((np.diff(sig[x], prepend=0) != 0) | (np.diff(sig[y], prepend=0) != 0) | (np.arange(len(x)) == 0))
        shared = np.diff(np.append(begins, len(x)))
        x, y = x[begins], y[begins]
        found.append((None, sig[x], n[x], sig[y], n[y], (rare[x] & rare[y]) > 0, shared))
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64())
    names = ("key", "a", "na", "b", "nb", "whole", "shared")
    size = [len(f[1]) for f in found]
    return pa.table({c: pa.chunked_array([pa.nulls(size[i], t) if f[k] is None else pa.array(f[k], t) for i, f in enumerate(found)], t) for k, (c, t) in enumerate(zip(names, types, strict=True))})


def rare_pairs(groups: DataFrame) -> DataFrame:
    """All (a, na, b, nb) of the rare keys that can be similar; a key has at most as many sets as a rare bucket.

    If both prefixes are rare shingles alone, the keys that two sets share are all that their prefixes share. Of the two,
    the one whose prefix ends earlier shares no other shingle of its prefix, so the shared total is at most that number
    and the larger rest; pairs that can't reach the total they need are dropped here.
    """
    counted = groups.where("key IS NULL").groupBy("a", "na", "b", "nb", "whole").agg(F.sum("shared").alias("shared"))
    rest = F.ceil(F.greatest("na", "nb") * 80 / 100) - 1
    return counted.where(~F.col("whole") | (180 * (F.col("shared") + rest) >= 80 * (F.col("na") + F.col("nb")))).select("a", "na", "b", "nb")


def pivot_pairs(often: DataFrame) -> DataFrame:
    """Each set of a key of combinations with the key's pivot; pivots differ by key. Pairs that could be similar only by
    sharing rare shingles are left to the rare keys."""
    by_rare = F.when(F.pmod("key", F.lit(2)) == 0, F.col("rare") / F.col("n")).otherwise(0.0)
    order = F.struct(by_rare.alias("q"), F.xxhash64(F.pmod("key", F.lit(8)), "sig").alias("h"), F.col("sig").alias("a"), F.col("n").alias("na"), F.col("rare").alias("ra"))
    pivots = often.groupBy("key").agg(F.min(order).alias("p"), F.count(F.lit(1)).alias("k")).where("k > 1").select("key", "p.a", "p.na", "p.ra")
    within = F.least(F.col("n") - F.col("rare"), F.col("na") - F.col("ra"))
    pairs = often.join(pivots, "key").where((F.col("a") != F.col("sig")) & (180 * within >= 80 * (F.col("n") + F.col("na"))))
    return pairs.select(
        F.least("a", "sig").alias("a"),
        F.when(F.col("a") < F.col("sig"), F.col("na")).otherwise(F.col("n")).alias("na"),
        F.greatest("a", "sig").alias("b"),
        F.when(F.col("a") < F.col("sig"), F.col("n")).otherwise(F.col("na")).alias("nb"),
    ).distinct()


def near_parity(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs whose parity strings are near enough; those of similar sets always are."""
    a = bits.select(F.col("sig").alias("a"), F.col("bits").alias("pa"))
    b = bits.select(F.col("sig").alias("b"), F.col("bits").alias("pb"))
    far = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.join(a, "a").join(b, "b").where(9 * far <= F.col("na") + F.col("nb")).select("a", "na", "b", "nb")


def needed_sets(texts: Texts, known: DataFrame, sigs: DataFrame) -> DataFrame:
    """(sig, shingles) of the given sets, and of the few others whose texts share their marks; known has a text (own) of each set."""
    wanted = marks(sigs.join(known, "sig").select(F.col("own").alias("v")))

    def run(sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for _, s in sets:
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s)], pa.int64()), pa.array([to_bytes(s)], pa.binary())], names=["sig", "shingles"])

    found = texts.map(run, "sig long, shingles binary", wanted)
    return stored(found.groupBy("sig").agg(F.first("shingles").alias("shingles")), "join-sets")


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= 80 * (len(x) + len(y) - shared)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) whose full sets are similar."""
    a = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_similar(*(from_bytes(v.as_py()) for v in pair)) for pair in zip(batch.column("sa"), batch.column("sb"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, type=pa.bool_()))
            give_back()

    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(sig, label): the smallest sig reachable, for the sigs of the stored (a, b) links. Labels jump along labels, so long
    chains take a logarithmic number of rounds."""
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "join-edges")
    labels = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "sig"), "join-labels")
    while True:
        near = edges.join(labels.select(F.col("sig").alias("b"), "label"), "b").groupBy(F.col("a").alias("sig")).agg(F.min("label").alias("near"))
        hop = labels.select(F.col("sig").alias("label"), F.col("label").alias("far"))
        moved = labels.join(near, "sig").join(hop, "label", "left")
        new = stored(moved.select("sig", F.least("near", "far", "label").alias("label"), (F.least("near", "far", "label") < F.col("label")).alias("moved")), "join-labels")
        labels = new.select("sig", "label")
        if not new.where("moved").limit(1).count():
            return labels


def rest_blocks(often: DataFrame, what: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slot, part, block, key, sig, n, rare, label, + the columns of `what`) of the sets outside a key's main component and of all
    sets of the key; often has labels. Both sides are cut: a key has about BLOCK_ROWS rows or BLOCK_SHINGLES shingles of
    either in a (slot, part, block). Keys of one block share slots, so that there are not more groups than work."""
    sizes = often.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("k", "s", "label")).alias("m"), F.count(F.lit(1)).alias("labels"), F.sum("k").alias("k"), F.sum("s").alias("s"))
    cut = lambda k, s: F.greatest(F.ceil(k / BLOCK_ROWS), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    mixed = sizes.where("labels > 1").select("key", "k", "s", F.col("m.label").alias("main"), cut(F.col("k"), F.col("s")).alias("blocks"), cut(F.col("k") - F.col("m.k"), F.col("s") - F.col("m.s")).alias("parts"))
    mixed = stored(mixed, "join-mixed")
    slots = mixed.agg(F.greatest(F.ceil(F.sum("k") / BLOCK_ROWS), F.ceil(F.sum("s") / BLOCK_SHINGLES))).first()[0] or 1
    slot = F.when((F.col("blocks") == 1) & (F.col("parts") == 1), F.pmod(F.xxhash64("key"), F.lit(int(slots)))).otherwise(F.col("key"))
    placed = often.join(mixed.drop("k", "s"), "key").join(what, "sig").withColumn("slot", slot)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [F.col(c).alias(c) for c in ("slot", "part", "block", "key", "sig", "n", "rare", "label", *(c for c in what.columns if c != "sig"))]
    every = placed.withColumn("block", F.pmod("sig", F.col("blocks")).cast("int")).withColumn("part", each("parts")).select(*columns)
    minor = placed.where("label <> main").withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int")).withColumn("block", each("blocks")).select(*columns)
    return minor, every


class _Side:
    """One side of a group of rest_blocks, in arrays, sorted by key."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by("key").combine_chunks()
        self.key, self.sig, self.label = (rows.column(c).to_numpy() for c in ("key", "sig", "label"))
        self.n, rare = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "rare"))
        self.often = self.n - rare
        if "shingles" in rows.column_names:
            self.sets = [from_bytes(x) for x in rows.column("shingles").to_pylist()]
            self.bits = np.array([parity(s) for s in self.sets]).reshape(-1, PARITY_WORDS)
        else:
            self.bits = rows.column("bits").combine_chunks().flatten().to_numpy().reshape(-1, PARITY_WORDS)


def _partners(z: _Side, x: _Side) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of z, the rows of x of its key, of other components, that may be similar without sharing rare shingles."""
    begins, ends = np.searchsorted(x.key, z.key, "left"), np.searchsorted(x.key, z.key, "right")
    for i, (begin, end, m, often, own) in enumerate(zip(begins, ends, z.n, z.often, z.label, strict=True)):
        at = begin + np.flatnonzero((x.label[begin:end] != own) & (180 * np.minimum(x.often[begin:end], often) >= 80 * (x.n[begin:end] + m)))
        if len(at):
            far = np.bitwise_count((x.bits[at] ^ z.bits[i][None, :]).view(np.uint64)).sum(axis=1, dtype=np.int64)
            at = at[9 * far <= x.n[at] + m]
            if len(at):
                yield i, at


def _met(minor: DataFrame, every: DataFrame, run, schema: str) -> DataFrame:
    by = ("slot", "part", "block")
    return minor.groupBy(*by).cogroup(every.groupBy(*by)).applyInArrow(lambda z, x: run(_Side(z), _Side(x)), schema).distinct()


def possible_rest(often: DataFrame, bits: DataFrame) -> DataFrame:
    """The (key, sig) of labelled rows that have a partner of another component in their key as far as parity tells."""

    def run(z: _Side, x: _Side) -> pa.Table:
        found: set[tuple[int, int]] = set()
        for i, at in _partners(z, x):
            found.add((z.key[i], z.sig[i]))
            found.update(zip(x.key[at], x.sig[at], strict=True))
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate(("key", "sig"))})

    return _met(*rest_blocks(often, bits), run, "key long, sig long")


def rest_links(often: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of similar sets of different components, block by block; of each block a spanning forest of them."""

    def run(z: _Side, x: _Side) -> pa.Table:
        links: list[tuple[int, int]] = []
        head: dict[int, int] = {}

        def find(label: int) -> int:
            while head.get(label, label) != label:
                label = head[label]
            return label

        for i, at in _partners(z, x):
            for j in at:
                a, b = find(z.label[i]), find(x.label[j])
                if a != b and _similar(z.sets[i], x.sets[j]):
                    head[max(a, b)] = min(a, b)
                    links.append((min(z.sig[i], x.sig[j]), max(z.sig[i], x.sig[j])))
        return pa.table({c: pa.array([f[k] for f in links], pa.int64()) for k, c in enumerate("ab")})

    return _met(*rest_blocks(often, sets), run, "a long, b long")


def join_documents(docs: DataFrame, rare_class: int = RARE_CLASS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of (doc_id, text)."""
    texts = Texts(docs)
    octets = texts.octets()
    table, rise = table_bits(octets)
    described = describe(texts, table)
    slim = described.where("sig IS NOT NULL").select("own", "n", "sig", "bits")
    known = stored(slim.where("bits IS NOT NULL").groupBy("sig").agg(F.first("bits").alias("bits"), F.min("own").alias("own")), "join-bits")
    bits = known.select("sig", "bits")
    slots = max(8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-octets // (5 * SHINGLE_OCTETS * SLOT_KEYS)))
    rows = index_rows(texts, shingle_classes(described, table), rare_class + rise, slots)
    groups = stored(rows.groupBy("slot").applyInArrow(met, MET), "join-groups")
    often = groups.where("key IS NOT NULL").select("key", F.col("a").alias("sig"), F.col("na").alias("n"), F.col("nb").alias("rare"))
    near = stored(near_parity(rare_pairs(groups).unionByName(pivot_pairs(often)).distinct(), bits), "join-near")
    sets = needed_sets(texts, known, near.select(F.col("a").alias("sig")).unionByName(near.select(F.col("b").alias("sig"))).distinct())
    links = stored(verify(near, sets), "join-links")
    labelled = often.join(components(links), "sig", "left").select("key", "sig", "n", "rare", F.coalesce("label", "sig").alias("label"))
    labelled = stored(labelled, "join-often")
    possible = stored(possible_rest(labelled, bits), "join-possible")
    sets = needed_sets(texts, known, possible.select("sig").distinct())
    links = stored(links.unionByName(rest_links(labelled.join(possible, ["key", "sig"], "left_semi"), sets)), "join-links")
    labels = components(links)
    own = slim.groupBy("own").agg(F.first("n").alias("n"), F.first("sig").alias("sig")).join(texts.each.select("own", "first"), "own")
    own = stored(own.join(labels, "sig", "left").select("own", "n", "first", F.coalesce("label", "sig").alias("label")), "join-sigs")
    named = own.join(own.groupBy("label").agg(F.min("first").alias("component_id")), "label").select("own", "n", "component_id")
    n, component_id = F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return texts.rows.join(named, "own", "left").select("doc_id", n, component_id)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with the columns they came with: that with the smallest doc_id (null last, where there is such a
    column), of these the one with the smallest hash of its text, so any split of the input keeps the same; equal rows are one as good as another."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = stored(docs.select(F.monotonically_increasing_id().alias("_uid"), F.xxhash64("text").alias("_hash"), row.alias("_row")), "join-docs")
    found = join_documents(kept.select(F.col("_uid").alias("doc_id"), F.col("_row.text").alias("text"))).select(F.col("doc_id").alias("_uid"), "component_id")
    doc_id = F.col("_row.doc_id") if "doc_id" in docs.columns else F.lit(0)
    places = kept.select("_uid", F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), "_hash", "_uid").alias("_place"))
    ids = stored(found.join(places, "_uid").groupBy("component_id").agg(F.min("_place").alias("_place")).select("_place._uid"), "join-kept")
    gone = marks(places.join(ids, "_uid", "left_anti").select(F.xxhash64("_uid").alias("v")))

    @F.pandas_udf("boolean")
    def doubtful(uid: pd.Series) -> pd.Series:
        return pd.Series(_marked(gone.value, uid.to_numpy()))

    # what isn't marked as gone stays, without a shuffle; what is, or is taken for it, is looked up
    told = kept.withColumn("_doubtful", doubtful(F.xxhash64("_uid")))
    return told.where("NOT _doubtful").select("_row.*").unionByName(told.where("_doubtful").join(ids, "_uid", "left_semi").select("_row.*"))
