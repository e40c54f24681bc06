"""Language-model scoring by prediction by partial matching (PPM), pretrained on the corpus.

The model is a byte trie of contexts of up to ORDER bytes over lower-cased text (A-Z), with an end symbol for each text.
In a context, a symbol has probability (count - 1/2) / total (method D); the rest is the escape to the context that is one
byte shorter, where the symbols that the longer context has seen are excluded; below the empty context the symbols not
yet excluded share what is left evenly. A text's score is the log10 probability of its bytes and its end.

With fixed counts, the code length of a position depends on its ORDER bytes and its symbol alone, so a text's score is a
sum over its (ORDER + 1)-grams. Each task cuts its documents, as they come, into batches of about BATCH_BYTES, and packs a
batch's documents and its distinct words and grams with their training counts into a few compressed rows: one for the documents, one
for each part of the words and for each part of the grams. Texts aren't shuffled to be counted, and equal documents may
lie in any batch. Grams are dealt into parts by the last SUFFIX bytes of their contexts. A part has all grams of its
suffixes, hence whole counts of the contexts of SUFFIX bytes and more; it gives every batch's list back with a
log10 probability for each entry. Shorter contexts come from a table of at most 257 ** SUFFIX entries, the only part of
the model that is broadcast; one suffix has at most 256 ** (ORDER - SUFFIX) * 257 distinct grams, however long the corpus.
The number of parts grows with the text, so that a part has about PART_BYTES of text behind it.

Defined results: null texts are empty and consist of the end alone; words split at blank and U+0009 to U+000D; the same
row twice is scored twice and trains twice; a text longer than a batch is a batch by itself; without training documents
every gram costs log10(1/257). Columns other than doc_id and text don't enter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from .common import fold, give_back, pack, pack_sorted, stored, unpack, unpack_sorted

ORDER = 5
END = 256
BATCH_BYTES = 20_000_000
CHUNK_BYTES = 1_000_000
FOLDS, HELD_OUT = 10, 0
SMOOTH = 0.1
SUFFIX = 3
PARTS, PART_BYTES = 64, 50_000_000
SLICES = 16  # of the table of short contexts
DOCS, WORDS, GRAMS, SHORT = 0, 1, 2, 3  # kinds of packed rows


def _prepare(text: str | None) -> bytes:
    return text.encode("utf-8", "replace").lower() if text else b""


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (ORDER + 1)-grams of the texts, flat, and where each text begins. A gram is context << 9 | symbol."""
    pad = b"\0" * ORDER
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    if not len(texts):
        return np.zeros(0, dtype=np.int64), begins
    raw = np.frombuffer(b"".join([pad + t + b"\0" for t in texts]), dtype=np.uint8).astype(np.int64)
    n = len(raw) - ORDER
    gram = raw[:n].copy()
    for k in range(1, ORDER):
        gram <<= 8
        gram |= raw[k : k + n]
    gram <<= 9
    symbol = raw[ORDER:].copy()
    first = begins + ORDER * np.arange(len(texts))
    symbol[first + sizes - 1] = END
    gram |= symbol
    keep = np.ones(n, dtype=bool)
    keep[(first[1:, None] - ORDER + np.arange(ORDER)[None, :]).reshape(-1)] = False
    return gram[keep], begins


class Levels:
    """Counts of the contexts of each length; entries sorted by context << 9 | symbol. `base` has the shorter contexts."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, lengths: range, base: Levels | None = None) -> None:
        self.entries: list[tuple[np.ndarray, np.ndarray]] = list(base.entries) if base else []
        self.contexts = list(base.contexts) if base else []
        self.excluded: list[np.ndarray] = list(base.excluded) if base else []  # symbols of a context take this much from the next shorter one
        seen = count > 0
        context, symbol, count = gram[seen] >> 9, gram[seen] & 511, count[seen]
        for k in lengths:
            keys, counts = add_up(((context & ((1 << (8 * k)) - 1)) << 9) | symbol, count)
            self.entries.append((keys, counts))
            ctx, at = np.unique(keys >> 9, return_index=True)
            ends = np.append(at[1:], len(keys)).astype(np.int64)
            sums = np.concatenate(([0], np.cumsum(counts)))
            self.contexts.append((ctx, sums[ends] - sums[at], ends - at))
            if k:
                short = (((keys >> 9) & ((1 << (8 * (k - 1))) - 1)) << 9) | (keys & 511)
                taken = np.concatenate(([0], np.cumsum(lookup(*self.entries[k - 1], short))))
                self.excluded.append(taken[ends] - taken[at])

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of each gram."""
        out = np.zeros(len(gram))
        open_ = np.ones(len(gram), dtype=bool)
        context, symbol = gram >> 9, gram & 511
        gone_total, gone_distinct = np.zeros(len(gram)), np.zeros(len(gram))
        for k in range(len(self.entries) - 1, -1, -1):
            ctx, total, distinct = self.contexts[k]
            want = context & ((1 << (8 * k)) - 1)
            at = np.minimum(np.searchsorted(ctx, want), max(len(ctx) - 1, 0))
            here = (ctx[at] == want) if len(ctx) else np.zeros(len(gram), dtype=bool)
            n = np.where(here, total[at], 0) - gone_total if len(ctx) else np.zeros(len(gram))
            q = np.where(here, distinct[at], 0) - gone_distinct if len(ctx) else np.zeros(len(gram))
            live = open_ & here & (n > 0)
            count = lookup(*self.entries[k], (want << 9) | symbol)
            hit = live & (count > 0)
            out[hit] += np.log10((count[hit] - 0.5) / n[hit])
            open_ &= ~hit
            miss = live & ~hit & (distinct[at] < 257 if len(ctx) else False)
            out[miss] += np.log10(0.5 * q[miss] / n[miss])
            if k:
                gone_total = np.where(here, self.excluded[k - 1][at], 0) if len(ctx) else np.zeros(len(gram))
                gone_distinct = np.where(here, distinct[at], 0) if len(ctx) else np.zeros(len(gram))
            else:
                left = 257 - (np.where(here, distinct[at], 0) if len(ctx) else np.zeros(len(gram)))
                out[open_] -= np.log10(left[open_])
        return out


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], np.concatenate(([0], np.cumsum(counts[order])))
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[begins], sums[np.append(begins[1:], len(keys))] - sums[begins] if len(keys) else sums[:0]


def lookup(keys: np.ndarray, values: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Values of sorted keys; 0 for others."""
    if not len(keys):
        return np.zeros(len(want), dtype=values.dtype)
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return np.where(keys[at] == want, values[at], 0)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield begin, k
            begin, size = k, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def turn(gram: np.ndarray) -> np.ndarray:
    """Grams with the last SUFFIX bytes of the context in front, so that those of a part lie close together."""
    low, older = 8 * SUFFIX, 8 * (ORDER - SUFFIX)
    context = gram >> 9
    return ((context & ((1 << low) - 1)) << (older + 9)) | ((context >> low) << 9) | (gram & 511)


def turn_back(turned: np.ndarray) -> np.ndarray:
    low, older = 8 * SUFFIX, 8 * (ORDER - SUFFIX)
    return (((turned >> 9) & ((1 << older) - 1)) << (low + 9)) | ((turned >> (older + 9)) << 9) | (turned & 511)


def pack_values(x: np.ndarray) -> tuple[bytes, bytes]:
    """Few different doubles: the doubles, and which one each is."""
    values, code = np.unique(x, return_inverse=True)
    return pack(values.view(np.int64)), pack(code)


PACKED = {"batch": pa.int64(), "kind": pa.int32(), "part": pa.int32(), "keys": pa.binary(), "values": pa.binary(), "codes": pa.binary(), "total": pa.int64(), "distinct": pa.int64()}
PACKED_DDL = "batch long, kind int, part int, keys binary, values binary, codes binary, total long, distinct long"


def packed(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in PACKED]
    return pa.table({name: pa.array(c, type=t) for (name, t), c in zip(PACKED.items(), columns, strict=True)})


def _slices(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part with the places of its members, in their order."""
    order = np.argsort(part, kind="stable")
    named, at = np.unique(part[order], return_index=True)
    for p, begin, end in zip(named, at, [*at[1:], len(order)], strict=False):
        yield int(p), order[begin:end]


def pack_batch(rows: pa.Table, batch: int, parts: int) -> Iterator[tuple]:
    """Rows of PACKED of a batch: its documents, its distinct words and grams with their counts in its training documents,
    and the counts of its short contexts."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    yield batch, DOCS, 0, sink.getvalue().to_pybytes(), None, None, 0, 0
    words: Counter = Counter()
    others: set = set()
    keys, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for trained in (True, False):
        texts = [_prepare(t.as_py()) for t in rows.filter(pa.compute.equal(rows.column("trains"), trained)).column("text")]
        for text in texts:
            (words if trained else others).update(text.split())
        for begin, end in _chunks(texts):
            known, n = np.unique(turn(grams(texts[begin:end])[0]), return_counts=True)
            keys.append(known)
            counts.append(n if trained else np.zeros_like(n))
        del texts
    listed = list(words) + [w for w in others if w not in words]
    if listed:
        n = np.array([words[w] for w in listed], dtype=np.int64)
        for part, at in _slices(np.array([xxhash.xxh3_64_intdigest(w) % parts for w in listed])):
            yield batch, WORDS, part, zstandard.ZstdCompressor(level=1).compress(b"\n".join([listed[i] for i in at])), pack(n[at]), None, 0, 0
    known, n = add_up(np.concatenate(keys), np.concatenate(counts))
    del keys, counts, words, others, listed
    suffix = known >> (8 * (ORDER - SUFFIX) + 9)
    for part, at in _slices((suffix * 0x9E3779B1 >> 24) % parts):
        yield batch, GRAMS, part, pack_sorted(known[at]), pack(n[at]), None, 0, 0
    context = (1 << (8 * (SUFFIX - 1))) - 1
    short, n = add_up(((suffix & context) << 9 | known & 511)[n > 0], n[n > 0])
    for part, at in _slices((short >> 9) % SLICES):
        yield batch, SHORT, part, pack_sorted(short[at]), pack(n[at]), None, 0, 0


def pack_documents(docs: DataFrame, batch_bytes: int, parts: int) -> DataFrame:
    """Stored rows of PACKED, from (doc_id, text, trains); each task makes batches of what it reads."""

    def run(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 24

        def made() -> Iterator[pa.RecordBatch]:
            for row in pack_batch(pa.Table.from_batches(held), number, parts):
                yield from packed([row]).to_batches()
            give_back()

        for batch in arriving:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy()
            begin = 0
            for k in range(batch.num_rows):
                if size and size + sizes[k] > batch_bytes:
                    held.append(batch.slice(begin, k - begin))
                    yield from made()
                    held, size, number, begin = [], 0, number + 1, k
                size += int(sizes[k]) + 1
            held.append(batch.slice(begin))
        if size:
            yield from made()

    return stored(docs.mapInArrow(run, PACKED_DDL), "ppm-packed")


def _sum_words(rows: pa.Table) -> pa.Table:
    """Each batch's list of a part of the words with the counts over all batches; the first row has the part's totals."""
    lists = [pa.array(zstandard.ZstdDecompressor().decompress(k).split(b"\n"), pa.binary()) for k in rows.column("keys").to_pylist()]
    counts = pa.array(np.concatenate([unpack(v) for v in rows.column("values").to_pylist()]))
    summed = pa.table({"w": pa.concat_arrays(lists), "n": counts}).group_by("w").aggregate([("n", "sum")])
    known, n = summed.column("w").combine_chunks(), summed.column("n_sum").to_numpy()
    out = []
    for k, (batch, part, keys) in enumerate(zip(*[rows.column(c).to_pylist() for c in ("batch", "part", "keys")], strict=True)):
        found = n[pa.compute.index_in(lists[k], value_set=known).to_numpy()]
        out.append((batch, WORDS, part, keys, pack(found), None, int(n.sum()) if k == 0 else 0, int((n > 0).sum()) if k == 0 else 0))
    return packed(out)


def _sum_short(rows: pa.Table) -> pa.Table:
    keys, counts = ([f(x) for x in rows.column(c).to_pylist()] for c, f in (("keys", unpack_sorted), ("values", unpack)))
    known, n = add_up(np.concatenate(keys), np.concatenate(counts))
    return packed([(0, SHORT, rows.column("part")[0].as_py(), pack_sorted(known), pack(n), None, 0, 0)])


def short_contexts(asked: DataFrame, batches: int) -> Levels:
    """The contexts of fewer than SUFFIX bytes. Batches are summed some at a time, then the sums."""
    some = asked.where(F.col("kind") == SHORT).groupBy("part", F.pmod("batch", F.lit(int(batches**0.5) + 1))).applyInArrow(_sum_short, PACKED_DDL)
    rows = some.groupBy("part").applyInArrow(_sum_short, PACKED_DDL).collect()  # SLICES rows, 257 ** SUFFIX entries at most
    none = [np.zeros(0, dtype=np.int64)]
    known, n = add_up(np.concatenate(none + [unpack_sorted(r["keys"]) for r in rows]), np.concatenate(none + [unpack(r["values"]) for r in rows]))
    return Levels(known, n, range(SUFFIX))


def code_lengths(asked: DataFrame, batches: int, parts: int) -> DataFrame:
    """The GRAMS rows of `asked`, with the log10 probability of each entry in values and codes."""
    base = asked.sparkSession.sparkContext.broadcast(short_contexts(asked, batches))

    def run(rows: pa.Table) -> pa.Table:
        lists = [unpack_sorted(k) for k in rows.column("keys").to_pylist()]
        known, n = add_up(np.concatenate(lists), np.concatenate([unpack(v) for v in rows.column("values").to_pylist()]))
        gram = turn_back(known)
        logp = Levels(gram, n, range(SUFFIX, ORDER + 1), base.value).log10(gram)
        out = []
        for listed, (batch, part, keys) in zip(lists, zip(*[rows.column(c).to_pylist() for c in ("batch", "part", "keys")], strict=True), strict=True):
            out.append((batch, GRAMS, part, keys, *pack_values(logp[np.searchsorted(known, listed)]), 0, 0))
        return packed(out)

    return _dealt(asked.where(F.col("kind") == GRAMS), parts, "part").applyInArrow(run, PACKED_DDL)


def _dealt(rows: DataFrame, tasks: int, by: str) -> GroupedData:
    """Packed rows are few bytes but much work: the number of tasks is stated, or adaptive execution would put all into one."""
    return rows.repartition(tasks, by).groupBy(by)


SCORED = pa.schema([("doc_id", pa.int64()), ("trains", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_sum", pa.float64()), ("score", pa.float64())])


def score_batch(rows: pa.Table, end_count: int) -> pa.Table:
    """Scores of a batch's documents, from all its packed rows; base_sum is the sum of log10(c + SMOOTH) over the tokens."""
    count: dict[bytes, int] = {}
    turned, logp, docs = [], [], None
    for kind, keys, values, codes in zip(*[rows.column(c).to_pylist() for c in ("kind", "keys", "values", "codes")], strict=True):
        if kind == DOCS:
            docs = pa.ipc.open_stream(keys).read_all()
        elif kind == WORDS:
            count.update(zip(zstandard.ZstdDecompressor().decompress(keys).split(b"\n"), unpack(values).tolist(), strict=True))
        else:
            turned.append(unpack_sorted(keys))
            logp.append(unpack(values).view(np.float64)[unpack(codes)])
    places, logp = pd.Index(np.concatenate(turned)), np.concatenate(logp)
    texts = [_prepare(t.as_py()) for t in docs.column("text")]
    n_tokens, n_known, base, score = [], [], [], []
    for text in texts:
        c = np.array([count[w] for w in text.split()] + [end_count], dtype=np.float64)
        n_tokens.append(len(c))
        n_known.append(int((c > 0).sum()))
        base.append(float(np.log10(c + SMOOTH).sum()))
    for begin, end in _chunks(texts):
        found, begins = grams(texts[begin:end])
        score.append(np.add.reduceat(logp[places.get_indexer(turn(found))], begins))
    columns = [docs.column("doc_id"), docs.column("trains"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.concatenate(score))]
    del texts, count, places, turned, logp, docs
    give_back()
    return pa.Table.from_arrays(columns, schema=SCORED)


def score_documents(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of (doc_id, text)."""
    trains = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    totals = docs.agg(F.sum(F.octet_length("text")), F.count(F.when(trains, 1))).first()
    size, end_count = totals[0] or 0, totals[1]
    parts, batches = max(PARTS, size // PART_BYTES), size // batch_bytes
    asked = pack_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", trains.alias("trains")), batch_bytes, parts)
    words = stored(_dealt(asked.where(F.col("kind") == WORDS), parts, "part").applyInArrow(_sum_words, PACKED_DDL), "ppm-words")
    trained = words.agg(F.sum("total"), F.sum("distinct")).first()
    train_tokens = (trained[0] or 0) + end_count
    distinct = (trained[1] or 0) + (1 if end_count else 0)
    answers = asked.where(F.col("kind") == DOCS).unionByName(words).unionByName(code_lengths(asked, batches, parts))
    scored = _dealt(answers, max(PARTS, batches), "batch").applyInArrow(lambda rows: score_batch(rows, end_count), "doc_id long, trains boolean, n_tokens long, n_known long, base_sum double, score double")
    scale = float(np.log10(train_tokens + SMOOTH * (distinct + 1)))
    return scored.select(
        "doc_id",
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        "score",
    )
