"""SentencePiece encoding and decoding with a streaming Viterbi search.

A text becomes code points, spaces U+2581, with one of them in front. The search runs over
boundaries between code points: a boundary's entry is the last piece of the best
segmentation up to it.

* Unigram models: the best segmentation has the greatest sum of piece scores.
* BPE models: a segmentation is the one that merging makes if and only if each of its
  pieces, and each pair of neighbours, comes out of merging unchanged. The surviving
  entries are those that pass this test, at most one per boundary; whether a pair passes
  is worked out once, by merging its few characters, and remembered.

Only entries within the longest piece's length of the current boundary can be continued,
so a window of that length is all that is kept. Whenever the back pointers of all
surviving entries lead to one boundary, the ids up to it are final and are put out. A
U+2581 behind another character is such a boundary for every model in which no piece
spans one: texts fall apart there, and pieces of text that come again in a slice are
searched once. Short ones are searched all together, a boundary at a time, with numpy;
longer ones, such as texts without spaces, one by one with the moving window.

A character without a piece becomes one id per UTF-8 byte if the model has byte pieces,
else the unknown id. Models must leave texts as they are (identity normalisation).

Edge cases: a null text gives null ids, an empty one none; very long texts are held once,
as code points; U+2581 in a text decodes as a space, as it does everywhere with these
models; repeated rows get equal results; further columns are carried along by ``encoded``;
an empty table gives an empty table.
"""

from __future__ import annotations

import struct
import sys
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnmill.llm import kernels

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
SHORT = 32  # code points; longer pieces of text are searched with the moving window
SLICE = 2 << 20
PAIRS = 1 << 20  # slots for pairs whose test is remembered
_U = np.uint64
_MERGED, _UNIGRAM = 2, 1
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6


def _fields(data: bytes):
    """(number, value) of a serialised message's fields."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            value = number()
        else:
            size = {1: 8, 2: None, 5: 4}[key & 7]
            size = number() if size is None else size
            value, at = data[at: at + size], at + size
        yield key >> 3, value


class Model:
    """A SentencePiece model read from its file's bytes."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        self.kind, self.prefix = _UNIGRAM, True
        for field, value in _fields(data):
            if field == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, _NORMAL))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, _UNIGRAM)
            elif field == 3:
                rules = dict(_fields(value))
                if rules.get(2) or rules.get(4, 1):
                    raise ValueError("only models with identity normalisation are supported")
                self.prefix = bool(rules.get(3, 1))
        if self.kind not in (_MERGED, _UNIGRAM) or _USER in self.kinds:
            raise ValueError("only BPE and unigram models without user-defined pieces are supported")
        self.size = len(self.pieces)
        self.unknown = self.kinds.index(_UNKNOWN)
        self.byte = [-1] * 256
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == _BYTE:
                self.byte[int(piece[3:5], 16)] = i
        self.known = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL}
        self.longest = max(map(len, self.known), default=1)
        self.cut = not any(SPACE in p.lstrip(SPACE) for p in self.known)
        self.worst = min((self.scores[i] for i in self.known.values()), default=0.0) - 10
        self.unchanged: dict = {}
        self._tables()

    def _tables(self) -> None:
        ids = np.array(list(self.known.values()), np.int64)
        texts = list(self.known)
        data, at = code_points(texts)
        sums = _sums(data)
        hashes = _spans(sums, at[:-1], at[1:])
        self.lengths = np.unique(np.diff(at))
        # Two tables by different bits of the hash; what both have taken goes to a third.
        self.slots = []
        while len(hashes):
            shift = _U(44 - 20 * (len(self.slots) % 3))
            slot = (hashes >> shift & _U((1 << 20) - 1)).astype(np.int64)
            table = np.zeros(1 << 20, _U)
            owner = np.full(1 << 20, -1, np.int64)
            table[slot], owner[slot] = hashes, ids
            self.slots.append((shift, table, owner))
            left = table[slot] != hashes
            hashes, ids = hashes[left], ids[left]
        self.score = np.array([*self.scores, self.worst])
        self.pair_keys = np.full(PAIRS, -1, np.int64)
        self.pair_fits = np.zeros(PAIRS, bool)
        surface = [b"" if k not in (_NORMAL, _BYTE) else bytes([int(p[3:5], 16)]) if k == _BYTE
                   else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds)]
        surface[self.unknown] = " ⁇ ".encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_at = np.cumsum([0, *map(len, surface)])

    def merged(self, text: str) -> list[int]:
        """Ids by merging the best pair of neighbours until none is known."""
        parts = list(text)
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]

        def pair(i):
            j = after[i]
            got = self.known.get(parts[i] + parts[j]) if j >= 0 else None
            return None if got is None else (-self.scores[got], i, parts[i] + parts[j])

        queue = [p for p in map(pair, range(len(parts))) if p]
        heapify(queue)
        while queue:
            _, i, both = heappop(queue)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                found = pair(k) if k >= 0 else None
                if found:
                    heappush(queue, found)
        return [self.known.get(p, -1) for p in parts if p is not None]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves a piece, or a pair of pieces, as it is; ``left`` is -1 for
        none. Ids from ``size`` on stand for characters without a piece."""
        if right >= self.size:
            return True
        if left >= self.size:
            left = -1
        key = left * self.size + right
        if key not in self.unchanged:
            if len(self.unchanged) > 1 << 21:
                self.unchanged.clear()
            text = self.pieces[right] if left < 0 else self.pieces[left] + self.pieces[right]
            self.unchanged[key] = self.merged(text) == ([right] if left < 0 else [left, right])
        return self.unchanged[key]

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``fits`` of many pairs; a table holds those seen before."""
        left = np.where(left >= self.size, -1, left)
        key = left * self.size + right
        slot = (kernels.mix(key.view(_U)) >> _U(44)).astype(np.int64) & (PAIRS - 1)
        out = self.pair_fits[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            fresh, where, number = np.unique(key[new], return_index=True, return_inverse=True)
            got = np.array([self.fits(int(a), int(b)) for a, b in zip(left[new[where]], right[new[where]])], bool)
            out[new] = got[number]
            self.pair_keys[slot[new]], self.pair_fits[slot[new]] = key[new], got[number]
        return out

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces by hash, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int64)
        for shift, table, owner in self.slots:
            slot = (hashes >> shift & _U((1 << 20) - 1)).astype(np.int64)
            same = (table[slot] == hashes) & (out < 0)
            out[same] = owner[slot[same]]
        return out

    def streamed(self, points: np.ndarray) -> list[int]:
        """Ids of one piece of text by the moving window."""
        text = points.tobytes().decode("utf-32-le")
        out: list[int] = []
        entries = {0: (0.0, -1, -1)}  # boundary: score, boundary before, piece
        final = 0

        def ids_between(low, high):
            back = []
            while high > low:
                _, before, piece = entries[high]
                back.append(piece)
                high = before
            return back[::-1]

        for end in range(1, len(text) + 1):
            best = None
            for size in range(1, min(self.longest, end - final) + 1):
                start = end - size
                entry = entries.get(start)
                if entry is None:
                    continue
                piece = self.known.get(text[start:end])
                if piece is None:
                    if size > 1:
                        continue
                    piece = self.size + ord(text[start])
                score = 0.0
                if self.kind == _MERGED:
                    if not self.fits(entry[2], piece):
                        continue
                else:
                    score = entry[0] + (self.scores[piece] if piece < self.size else self.worst)
                if best is None or score > best[0]:
                    best = (score, start, piece)
            if best is not None:
                entries[end] = best
            if end % (4 * self.longest) == 0:
                alive = {b for b in entries if b > end - self.longest}
                while len(alive) > 1:
                    last = max(alive)
                    alive.remove(last)
                    alive.add(max(entries[last][1], final))
                meet = alive.pop()
                if meet > final:
                    out += ids_between(final, meet)
                    entries = {b: e for b, e in entries.items() if b >= meet}
                    final = meet
        return out + ids_between(final, len(text))

    def searched(self, points: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces of text at once, and their number for each.

        ``points`` has a row per piece of text, longest first, padded.
        """
        rows, width = points.shape
        up, down = kernels.powers(width + 1)
        sums = np.zeros((width + 1, rows), _U)
        np.cumsum((_spread(points) * up[:width]).T, axis=0, out=sums[1:])
        piece = np.full((width + 1, rows), -1, np.int64)
        back = np.zeros((width + 1, rows), np.int64)
        score = np.zeros((width + 1, rows))
        reached = np.zeros((width + 1, rows), bool)
        reached[0] = True
        for end in range(1, width + 1):
            live = int(np.searchsorted(-size, -end, "right"))
            if not live:
                break
            single = np.zeros(live, bool)
            for length in self.lengths[self.lengths <= end]:
                start = end - length
                h = kernels.mix((sums[end, :live] - sums[start, :live]) * down[start] + _U(length))
                at = np.flatnonzero(reached[start, :live])
                ids = self.lookup(h[at])
                at, ids = at[ids >= 0], ids[ids >= 0]
                if length == 1:
                    single[at] = True
                self._offer(at, ids, start, end, piece, back, score, reached)
            other = np.flatnonzero(~single & reached[end - 1, :live])
            if len(other):
                self._offer(other, self.size + points[other, end - 1].astype(np.int64),
                            end - 1, end, piece, back, score, reached)
        taken, at = [], size.astype(np.int64).copy()
        every = np.arange(rows)
        while at.any():
            taken.append(np.where(at > 0, piece[at, every], -1))
            at = np.where(at > 0, back[at, every], 0)
        if not taken:
            return np.zeros(0, np.int64), np.zeros(rows, np.int64)
        grid = np.stack(taken[::-1], 1)
        return grid[grid >= 0], (grid >= 0).sum(1)

    def _offer(self, at, ids, start, end, piece, back, score, reached):
        """Take pieces as entries of a boundary where they pass."""
        if self.kind == _MERGED:
            left = piece[start, at]
            good = np.ones(len(at), bool)
            test = ids < self.size
            if test.any():
                good[test] = self.fit(left[test], ids[test])
            value = np.zeros(len(at))
        else:
            value = score[start, at] + self.score[np.minimum(ids, self.size)]
            good = ~reached[end, at] | (value > score[end, at])
        at, ids, value = at[good], ids[good], value[good]
        piece[end, at], back[end, at], score[end, at], reached[end, at] = ids, start, value, True

    def expand(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as byte ids, or the unknown id."""
        odd = ids >= self.size
        if not odd.any():
            return ids, counts
        if self.byte[0] < 0:
            # Neighbouring unknown characters are one unknown id.
            owner = np.repeat(np.arange(len(counts)), counts)
            again = np.zeros(len(ids), bool)
            again[1:] = odd[1:] & odd[:-1] & (owner[1:] == owner[:-1])
            return (np.where(odd, self.unknown, ids)[~again],
                    np.bincount(owner[~again], minlength=len(counts)))
        point = np.where(odd, ids - self.size, 0)
        width = np.where(odd, 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF), 1)
        owner = np.repeat(np.arange(len(counts)), counts)
        out = np.repeat(ids, width)
        data = np.frombuffer(point[odd].astype("<u4").tobytes().decode("utf-32-le", "replace").encode(
            "utf-8", "replace"), np.uint8)
        out[np.repeat(odd, width)] = np.array(self.byte)[data]
        return out, np.bincount(owner, weights=width, minlength=len(counts)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and their number for each text."""
        front = SPACE if self.prefix else ""
        points, at = code_points([front + x.replace(" ", SPACE) if x else "" for x in texts])
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        begin = np.zeros(len(points), bool)
        begin[at[:-1][np.diff(at) > 0]] = True
        if self.cut:
            space = points == ord(SPACE)
            begin[1:] |= space[1:] & ~space[:-1]
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(points))
        _, first, number = np.unique(_spans(_sums(points), starts, ends), return_index=True, return_inverse=True)
        low, size = starts[first], (ends - starts)[first]
        order = np.argsort(-size, kind="stable")
        parts: list = [None] * 2
        long = int(np.searchsorted(-size[order], -SHORT, "left"))
        found = [self.streamed(points[low[i]: low[i] + size[i]]) for i in order[:long]]
        ids = [np.array(f, np.int64) for f in found]
        counts = [np.array([len(f) for f in found], np.int64)]
        left = order[long:]
        for limit, floor in ((SHORT, 12), (12, 0)):
            own = left[(size[left] <= limit) & (size[left] > floor)]
            if len(own):
                grid = np.arange(int(size[own[0]]))[None, :] + low[own][:, None]
                inside = np.arange(grid.shape[1])[None, :] < size[own][:, None]
                some, n = self.searched(np.where(inside, points[np.minimum(grid, len(points) - 1)], 0), size[own])
                ids.append(some)
                counts.append(n)
        del parts
        flat, n = self.expand(np.concatenate(ids) if ids else np.zeros(0, np.int64), np.concatenate(counts))
        offset = np.cumsum(n) - n
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        use = place[number]
        sizes = n[use]
        take = np.repeat(offset[use] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        row = np.searchsorted(at, starts, "right") - 1
        total = np.bincount(row, weights=sizes, minlength=len(texts)).astype(np.int64)
        return flat[take], total

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids; the space in front goes, bytes that are no character become
        U+FFFD."""
        size = np.diff(self.surface_at)[ids]
        take = np.repeat(self.surface_at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        data = self.surface[take].tobytes()
        ends = np.append(0, np.cumsum(size))[np.cumsum(counts)] if len(counts) else []
        out, low = [], 0
        for high in ends:
            text = data[low:high].decode("utf-8", "replace")
            out.append(text[1:] if self.prefix and text.startswith(" ") else text)
            low = high
        return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.cumsum([0, *map(len, texts)])


def _spread(points: np.ndarray) -> np.ndarray:
    return kernels.mix(points.astype(_U) + _U(1))


def _sums(points: np.ndarray) -> np.ndarray:
    up, _ = kernels.powers(len(points) + 1)
    out = np.zeros(len(points) + 1, _U)
    np.cumsum(_spread(points) * up[: len(points)], out=out[1:])
    return out


def _spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = kernels.powers(len(sums))
    return kernels.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


_models = kernels.Cache()


def model_of(data: bytes) -> Model:
    """The model of a worker; a model is built once per worker process."""
    key = hash(data)
    if key not in _models:
        _models.clear()
        _models[key] = Model(data)
    return _models[key]


def read_model(path: str = MODEL) -> bytes:
    """The model file, read by the driver and sent along with the job: some 500 KB."""
    with open(path, "rb") as file:
        return file.read()


def _column(part, name):
    return part.column(part.schema.get_field_index(name))


def encoded(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """Every row with ``n_tokens`` and ``ids``, the text's pieces."""
    data = docs.sparkSession.sparkContext.broadcast(read_model() if model is None else model)
    names = [c for c in docs.columns if c not in ("n_tokens", "ids")]

    def run(batches):
        own = model_of(data.value)
        for batch in batches:
            for part in kernels.slices(batch, limit=SLICE):
                texts = _column(part, "text").to_pylist()
                ids, counts = own.encode(texts)
                none = np.array([t is None for t in texts])
                at = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32), mask=np.append(none, False))
                yield pa.RecordBatch.from_arrays(
                    [*[_column(part, n) for n in names], pa.array(counts, mask=none),
                     pa.ListArray.from_arrays(at, pa.array(ids.astype(np.int32)))],
                    [*names, "n_tokens", "ids"])

    schema = T.StructType([docs.schema[n] for n in names])
    schema = schema.add("n_tokens", T.LongType()).add("ids", T.ArrayType(T.IntegerType()))
    return kernels.small_batches(docs).select(*names).mapInArrow(run, schema)


def decoded(rows: DataFrame, model: bytes | None = None) -> DataFrame:
    """Every row with ``decoded``, the text of its ``ids``; null where they are null."""
    data = rows.sparkSession.sparkContext.broadcast(read_model() if model is None else model)
    names = [c for c in rows.columns if c != "decoded"]

    def run(batches):
        own = model_of(data.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = _column(part, "ids")
                none = lists.is_null().to_numpy(zero_copy_only=False)
                counts = np.where(none, 0, np.diff(lists.offsets.to_numpy()))
                texts = own.decode(lists.flatten().to_numpy().astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays(
                    [*[_column(part, n) for n in names],
                     pa.array([None if n else t for n, t in zip(none, texts)], pa.string())],
                    [*names, "decoded"])

    schema = T.StructType([rows.schema[n] for n in names]).add("decoded", T.StringType())
    return kernels.small_batches(rows).select(*names).mapInArrow(run, schema)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kernels.documents(spark, sf_dir).select("doc_id", "text")
    plain = F.replace(F.col("text"), F.lit(SPACE), F.lit(" "))
    return decoded(encoded(docs)).select(
        "doc_id", "n_tokens", "ids", (F.col("decoded") == plain).alias("exact"))
