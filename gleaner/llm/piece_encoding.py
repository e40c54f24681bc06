"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A task takes the distinct space-led units of its texts, concatenates them, sorts the suffixes by as many characters
as the longest piece has, narrows the range of every vocabulary piece by binary search, and turns all occurrences
into edges (start, piece). Edges are sorted by end position and relaxed from left to right over all units at once: an
edge extends a prefix if its piece may follow the piece that ends the prefix. For BPE that is exact rather than a
sum of scores: two pieces may stand side by side if no merge across their border would have come before the merges
inside them (`_Model.may_follow`), and every prefix has one such last piece. Runs of blanks are the exception (all their
pieces have one score, so merging depends on the place alone): such units are merged pair by pair.

Defined results: null and empty texts have no tokens and decode to ''. Characters outside the vocabulary become byte
pieces. Blanks become U+2581, so a text holding that character decodes with blanks in its place. A text of any length is
encoded whole. Repeated rows are encoded alike; an empty table gives an empty result; other columns stay.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BAR = "▁"
UNITS = re.compile(f"{BAR}+[^{BAR}]+|{BAR}+")
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of new units that are indexed at once, entries of the unit memo, slots of the pair memo.
INDEX_CHARS = 1_500_000
MEMO_UNITS = 200_000
MEMO_PAIRS = 1 << 21
NEVER = np.int64(1 << 40)


@dataclass
class Vocabulary:
    """What the driver reads from the model file; bounded by the file's size, so it may be sent to every task."""

    pieces: list[str]
    ranks: list[int]  # position in merge order; -1 for pieces that merging never makes
    byte_ids: list[int]


def load_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = len(sp)
    usable = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
    place = {score: r for r, score in enumerate(sorted({sp.get_score(i) for i in range(n) if usable[i]}, reverse=True))}
    ranks = [place[sp.get_score(i)] if usable[i] else -1 for i in range(n)]
    byte_ids = [-1] * 256
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
    return Vocabulary([sp.id_to_piece(i) if usable[i] else "" for i in range(n)], ranks, byte_ids)


@dataclass
class _Model:
    """Tables of one task, derived from the vocabulary."""

    vocab: Vocabulary
    left: np.ndarray = field(init=False)
    right: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        v = self.vocab
        n = len(v.pieces)
        self.ids = {p: i for i, p in enumerate(v.pieces) if v.ranks[i] >= 0}
        self.rank = np.array(v.ranks, dtype=np.int64)
        self.left, self.right = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        self.born = np.zeros(n, dtype=np.int64)  # when merging has made the piece; characters are there from the start
        self.made = np.zeros(n, dtype=bool)
        for p, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
            if len(p) == 1:
                self.made[i] = True
            elif (two := self._last_merge(p)) is not None:
                self.left[i], self.right[i] = two
                self.born[i] = max(self.rank[i], self.born[two[0]], self.born[two[1]])
                self.made[i] = True
        pairs = []
        for p, i in self.ids.items():
            pairs += [(a * n + b, i) for k in range(1, len(p)) if (a := self.ids.get(p[:k])) is not None and (b := self.ids.get(p[k:])) is not None]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], dtype=np.int64)
        self.pair_made = np.array([i for _, i in pairs] or [0], dtype=np.int64)
        self.n = n
        usable = [(p, i) for p, i in self.ids.items() if self.made[i] and BAR + BAR not in p]
        self.piece_ids = np.array([i for _, i in usable], dtype=np.int64)
        self.piece_len = np.array([len(p) for p, _ in usable], dtype=np.int64)
        self.longest = int(self.piece_len.max(initial=1))
        self.piece_chars = np.zeros((len(usable), self.longest), dtype=np.uint32)
        for row, (p, _) in enumerate(usable):
            self.piece_chars[row, : len(p)] = np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32)
        self.length_of = np.array([len(p) for p in v.pieces], dtype=np.int64)
        self.memo_key = np.full(MEMO_PAIRS, -1, dtype=np.int64)
        self.memo_ok = np.zeros(MEMO_PAIRS, dtype=bool)

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two pieces whose merge completes `piece`; None if merging its characters ends in something else."""
        parts = [self.ids.get(c, -1) for c in piece]
        if min(parts) < 0:
            return None
        texts = list(piece)
        while len(parts) > 1:
            best = min(((self.rank[j], k, j) for k in range(len(parts) - 1) if (j := self.ids.get(texts[k] + texts[k + 1])) is not None), default=None)
            if best is None:
                return None
            _, k, j = best
            if len(parts) == 2:
                return parts[0], parts[1]
            parts[k : k + 2], texts[k : k + 2] = [j], [texts[k] + texts[k + 1]]
        return None

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b may stand right of piece a, by pairs."""
        key = a * self.n + b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 21)).astype(np.int64)
        miss, out = self.memo_key[slot] != key, self.memo_ok[slot]
        if miss.any():
            new, at = np.unique(key[miss], return_inverse=True)
            fresh = self._no_merge_across(new // self.n, new % self.n)
            self.memo_key[slot[miss]], self.memo_ok[slot[miss]] = key[miss], fresh[at]
            out[miss] = fresh[at]
        return out

    def _no_merge_across(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), dtype=bool)
        x, x_ends = a.copy(), np.full(len(a), NEVER)
        rows = np.arange(len(a))
        while len(rows):  # x runs down the right edge of a, y down the left edge of b
            y, y_ends, sub = b[rows].copy(), np.full(len(rows), NEVER), np.arange(len(rows))
            while len(sub):
                key = x[sub] * self.n + y[sub]
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                hit = self.pair_keys[at] == key
                when = np.maximum(self.rank[self.pair_made[at]], np.maximum(self.born[x[sub]], self.born[y[sub]]))
                ok[rows[sub[hit & (when < x_ends[sub]) & (when <= y_ends[sub])]]] = False
                deeper = (self.left[y[sub]] >= 0) & ok[rows[sub]]
                sub = sub[deeper]
                y_ends[sub] = self.born[y[sub]]
                y[sub] = self.left[y[sub]]
            deeper = (self.right[x] >= 0) & ok[rows]
            rows, x = rows[deeper], x[deeper]
            x_ends = self.born[x]
            x = self.right[x]
        return ok

    def merge(self, unit: str) -> list[int]:
        """Merge pair by pair, best score first, leftmost among equals; for the units that edges can't settle."""
        texts: list[str | None] = list(unit)
        nxt, prv = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(k: int) -> None:
            if k >= 0 and nxt[k] < len(unit) and (j := self.ids.get(texts[k] + texts[nxt[k]])) is not None:
                heapq.heappush(heap, (int(self.rank[j]), k, len(texts[k]) + len(texts[nxt[k]])))

        for k in range(len(unit) - 1):
            offer(k)
        while heap:
            _, k, size = heapq.heappop(heap)
            if texts[k] is None or nxt[k] >= len(unit) or len(texts[k]) + len(texts[nxt[k]]) != size:
                continue
            gone = nxt[k]
            texts[k], texts[gone] = texts[k] + texts[gone], None
            nxt[k] = nxt[gone]
            if nxt[k] < len(unit):
                prv[nxt[k]] = k
            offer(prv[k])
            offer(k)
        out: list[int] = []
        for t in texts:
            if t is not None:
                i = self.ids.get(t)
                out += [i] if i is not None else [self.vocab.byte_ids[b] for b in t.encode("utf-8", "replace")]
        return out

    # -- matching ------------------------------------------------------------------------------------------------
    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the units and the number of ids of each."""
        text = "\x00".join(units) + "\x00"
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        inside = np.ones(len(raw), dtype=bool)
        inside[begins + lengths] = False
        alphabet, chars = np.unique(raw, return_inverse=True)
        chars = np.where(inside, chars + 1, 0)
        suffixes = self._suffix_array(chars, len(alphabet) + 1)
        start, piece = self._occurrences(chars, alphabet, suffixes)
        known = np.zeros(len(raw), dtype=bool)
        one = self.length_of[piece] == 1
        known[start[one]] = True
        lost = np.flatnonzero(inside & ~known)
        start, piece = np.concatenate((start, lost)), np.concatenate((piece, -3 - raw[lost].astype(np.int64)))
        width = np.where(piece >= 0, self.length_of[piece], 1)
        unit_of = np.repeat(np.arange(len(units)), lengths + 1)
        end = start + width
        local = end - begins[unit_of[start]]
        order = np.argsort(local, kind="stable")
        start, piece, end, local = start[order], piece[order], end[order], local[order]
        last = np.full(len(raw) + 1, -1, dtype=np.int64)
        last[begins] = -2  # nothing stands before a unit
        came = np.zeros(len(raw) + 1, dtype=np.int64)
        # `last[p]` is the piece that ends just before p; the begin of the next unit is one past the separator
        bounds = np.searchsorted(local, np.arange(1, int(lengths.max(initial=0)) + 2))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            s, p, e = start[lo:hi], piece[lo:hi], end[lo:hi]
            before = last[s]
            good = (before == -2) | (p < 0) | (before <= -3)
            ask = np.flatnonzero(~good & (before >= 0))
            good[ask] = self.may_follow(before[ask], p[ask])
            last[e[good]], came[e[good]] = p[good], s[good]
        return self._walk_back(units, begins, lengths, last, came)

    def _walk_back(self, units, begins, lengths, last, came) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each unit, from the last pieces and where they came from."""
        live = np.flatnonzero(lengths > 0)
        at = (begins + lengths)[live]
        found_unit, found_piece = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        while len(live):
            found_unit.append(live)
            found_piece.append(last[at])
            go = last[at] != -1  # -1: no edge came here
            at = came[at]
            go &= at > begins[live]
            live, at = live[go], at[go]
        unit, piece = np.concatenate(found_unit[::-1]), np.concatenate(found_piece[::-1])
        order = np.argsort(unit, kind="stable")
        unit, piece = unit[order], piece[order]
        odd = {u for u, x in enumerate(units) if BAR + BAR in x} | set(unit[piece == -1].tolist())
        if not odd and not (piece < 0).any():
            return piece.astype(np.int32), np.bincount(unit, minlength=len(units))
        out: list[list[int]] = [[] for _ in units]
        for u in odd:
            out[u] = self.merge(units[u])
        for u, p in zip(unit.tolist(), piece.tolist(), strict=True):
            if u not in odd:  # characters outside the vocabulary become bytes
                out[u] += [p] if p >= 0 else [self.vocab.byte_ids[b] for b in chr(-3 - p).encode("utf-8", "replace")]
        return np.array([i for x in out for i in x], dtype=np.int32), np.array([len(x) for x in out], dtype=np.int64)

    def _suffix_array(self, chars: np.ndarray, size: int) -> np.ndarray:
        """Positions sorted by the next `longest` characters, as many of them in one sort key as fit 62 bits."""
        bits = max(1, int(size).bit_length())
        per = max(1, min(self.longest, 62 // bits))
        padded = np.concatenate((chars, np.zeros(self.longest + per, dtype=chars.dtype))).astype(np.int64)
        keys = []
        for at in range(0, self.longest, per):
            key = np.zeros(len(chars), dtype=np.int64)
            for k in range(at, at + per):
                key = (key << bits) | padded[k : k + len(chars)]
            keys.append(key)
        order = np.argsort(keys[0])
        if len(keys) > 1:  # only positions that share their first key need the others
            first = keys[0][order]
            same = first[1:] == first[:-1]
            tied = np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False])))
            group = np.cumsum(np.concatenate(([0], ~same)))[tied]
            at = order[tied]
            order[tied] = at[np.lexsort([k[at] for k in keys[:0:-1]] + [group])]
        return order

    def _occurrences(self, chars: np.ndarray, alphabet: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and pieces of all matches: ranges of the suffix array, narrowed character by character."""
        spot = np.minimum(np.searchsorted(alphabet, self.piece_chars), len(alphabet) - 1)
        code = np.where(alphabet[spot] == self.piece_chars, spot + 1, -1)
        padded = np.concatenate((chars, np.zeros(self.longest + 1, dtype=chars.dtype)))
        rows = np.arange(len(self.piece_ids))
        lo, hi = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), len(suffixes), dtype=np.int64)
        for d in range(self.longest):
            rows = rows[(self.piece_len[rows] > d) & (hi[rows] > lo[rows])]
            want = code[rows, d]
            first = self._bisect(padded, suffixes, lo[rows], hi[rows], want, d)
            lo[rows], hi[rows] = first, self._bisect(padded, suffixes, first, hi[rows], want + 1, d)
            absent = want < 0
            hi[rows[absent]] = lo[rows[absent]]
        count = np.maximum(hi - lo, 0)
        total = int(count.sum())
        into = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        return suffixes[np.repeat(lo, count) + into], np.repeat(self.piece_ids, count)

    @staticmethod
    def _bisect(chars, suffixes, lo, hi, want, d) -> np.ndarray:
        """First place in [lo, hi) whose suffix has a character of at least `want` at offset d."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) // 2
            less = chars[suffixes[np.minimum(mid, len(suffixes) - 1)] + d] < want
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)


def _split(text: str) -> list[str]:
    """The units of a text, without the U+2581 that leads each of them."""
    if BAR not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [u[1:] for u in UNITS.findall(BAR + text.replace(" ", BAR))]


class Encoder:
    """Encodes texts of one task; remembers the units it has met, up to MEMO_UNITS."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.model = _Model(vocab)
        self.bytes_of = [p.replace(BAR, " ").encode() for p in vocab.pieces]
        for b, i in enumerate(vocab.byte_ids):
            if i >= 0:
                self.bytes_of[i] = bytes([b])
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        at, flats, sizes = 0, [self.flat], [self.sizes]
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and (size < INDEX_CHARS or stop == at):
                size += len(new[stop]) + 2
                stop += 1
            flat, count = self.model.encode_units([BAR + u for u in new[at:stop]])
            flats.append(flat)
            sizes.append(count)
            at = stop
        self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
        self.flat, self.sizes = np.concatenate(flats), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and len(texts) + 1 offsets into them."""
        split = [_split(t) if t else [] for t in texts]
        if len(self.memo) > MEMO_UNITS:
            self._forget()
        memo = self.memo
        new = list(dict.fromkeys(u for us in split for u in us if u not in memo))
        if new:
            self._learn(new)
        unit = np.fromiter(map(memo.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        sizes = self.sizes[unit]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.starts[unit] - (ends - sizes), sizes) + np.arange(total)] if total else np.zeros(0, dtype=np.int32)
        upto = np.concatenate(([0], np.cumsum([len(us) for us in split]))).astype(np.int64)
        return flat, np.concatenate(([0], ends))[upto]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        flat, offsets = self.encode_flat(texts)
        return np.split(flat, offsets[1:-1]) if texts else []

    def decode(self, ids) -> str:
        out = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return out[1:] if out[:1] == " " else out


class _Shared:
    """A vocabulary broadcast once for a call; its size is bounded by the model file's."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.id, self.held = uuid.uuid4().hex, spark.sparkContext.broadcast(load_vocabulary(path))

    @property
    def value(self) -> Vocabulary:
        return self.held.value


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocab) -> Encoder:
    """The Python worker's encoder of a broadcast vocabulary; one is kept, for the worker's next tasks."""
    if vocab.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocab.id] = Encoder(vocab.value)
    return _ENCODERS[vocab.id]


def encode_documents(docs: DataFrame, text: str = "text", ids: str = "token_ids", decoded: str | None = None, path: str = MODEL_PATH) -> DataFrame:
    """docs with `ids` (array<int>) and, if named, `decoded`: whether the tokens decode to the text. Both names replace."""
    vocab = _Shared(docs.sparkSession, path)
    names = [c for c in docs.columns if c not in (ids, decoded)]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.BooleanType())] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocab)
        for batch in batches:
            for part in _bounded(batch, text):
                texts = part.column(text).to_pylist()
                flat, offsets = encoder.encode_flat(texts)
                columns = [part.column(c) for c in names] + [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, type=pa.int32()))]
                if decoded:
                    ids_of = np.split(flat, offsets[1:-1]) if len(texts) else []
                    columns.append(pa.array([encoder.decode(x.tolist()) == (t or "") for x, t in zip(ids_of, texts, strict=True)], type=pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, ids, *([decoded] if decoded else [])])

    return docs.mapInArrow(run, schema)


def _bounded(batch: pa.RecordBatch, text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of text, a row at least."""
    sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    begin, size = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if size and size + n > most:
            yield batch.slice(begin, k - begin)
            begin, size = k, 0
        size += n
    if begin < len(sizes):
        yield batch.slice(begin)


def decode_ids(df: DataFrame, ids: str = "token_ids", text: str = "decoded_text", path: str = MODEL_PATH) -> DataFrame:
    """df with `text` decoded from `ids`; null ids give null."""
    vocab = _Shared(df.sparkSession, path)
    names = [c for c in df.columns if c != text]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocab)
        for batch in batches:
            out = [None if x is None else encoder.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out, type=pa.string())], names=[*names, text])

    return df.mapInArrow(run, schema)
