"""Sampled piece segmentations by forward filtering and backward sampling.

The lattice of a text has an edge for every piece of the vocabulary that matches at a
place. The forward pass adds up, for each place, the weight of all segmentations that
reach it; the backward pass draws one segmentation from the end, each with probability
proportional to the product of its piece weights. Draws depend on the seed, the row's
key and the place in the row alone, so reruns and other partitionings agree.

Pre-tokens (spaces and what follows them up to the next space or line end) are lattices
of their own, as no piece crosses them; ``vocabulary`` refuses a model where one does.
They are whole, whatever their length. The forward pass runs once per distinct pre-token
of a slice of texts. It rescales as it goes, so long ones do not underflow. A pre-token
of more than ``_LONG`` characters goes in segments: the forward pass keeps the weights
before each, and the backward pass builds each segment's lattice again from them, so
memory does not grow with a lattice.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import need, slices

PRETOKEN = re.compile(r" *[^ \n]+| +|\n")
_CROSSING = re.compile(r"[^ ] |\n.|.\n", re.DOTALL)
_LONG, _SEGMENT = 512, 20_000
MARK = "▁"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """Pieces of a SentencePiece model.

    A BPE model ranks its pieces instead of giving probabilities; a piece weighs
    (rank + 2) ** -sharpness, and a byte that stands in for a missing character as much
    as the last piece.
    """

    text: list[bytes]  # by id, spaces as spaces
    byte_ids: np.ndarray
    slots: np.ndarray  # open addressing by hash of the characters: piece id, or -1 for a mere prefix
    keys: np.ndarray
    weights: np.ndarray
    longest: int


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _rolled(points) -> int:
    h = 0
    for c in points:
        h = (h * int(_MIX) + c + 1) & (2**64 - 1)
    return h


def vocabulary(model_file: str, sharpness: float = 0.5) -> Vocabulary:
    """Read a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    text, byte_ids, entries, longest = [b""] * size, np.full(256, -1, np.int32), {}, 1
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            text[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if _CROSSING.search(piece.replace(MARK, " ")):
                raise ValueError(f"piece {i} crosses the end of a word or a line")
            text[i] = piece.replace(MARK, " ").encode()
            points = [ord(c) for c in piece.replace(MARK, " ")]
            entries[tuple(points)] = i
            longest = max(longest, len(points))
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so not every text can be encoded")
    every = dict(entries)
    for points in entries:
        for k in range(1, len(points)):
            every.setdefault(points[:k], -1)
    width = 1 << (4 * len(every) - 1).bit_length()
    keys, slots = np.zeros(width, np.uint64), np.full(width, -2, np.int32)
    for points, i in every.items():
        h = _rolled(points)
        at = int(_scramble(np.array([h], np.uint64))[0]) % width
        while slots[at] != -2:
            if keys[at] == h:
                raise ValueError("two pieces share a hash")
            at = (at + 1) % width
        keys[at], slots[at] = h, i
    rank = np.maximum(0.0, -np.array([model.get_score(i) for i in range(size)]))
    weights = (rank + 2.0) ** -sharpness
    weights[byte_ids] = weights.min()
    return Vocabulary(text, byte_ids, slots, keys, weights, longest)


def _look_up(v: Vocabulary, h: np.ndarray) -> np.ndarray:
    """Piece ids, -1 for a prefix of pieces, -2 for neither."""
    mask = np.uint64(len(v.slots) - 1)
    at = (_scramble(h) & mask).astype(np.int64)
    out = np.full(len(h), -2, np.int32)
    left = np.arange(len(h))
    while len(left):
        slot = v.slots[at]
        hit = v.keys[at] == h[left]
        out[left[hit & (slot != -2)]] = slot[hit & (slot != -2)]
        more = ~hit & (slot != -2)
        left, at = left[more], (at[more] + 1) & int(mask)
    return out


_FINE = 1 << 32


@dataclass
class Lattices:
    """Edges of the lattices of distinct pre-tokens, sorted by the node they end in."""

    flat: np.ndarray  # characters
    first: np.ndarray  # by pre-token: its first character
    sizes: np.ndarray
    edges: np.ndarray  # by node: its first incoming edge; a pre-token has one node more than characters
    limit: np.ndarray  # by edge: cumulative probability within its node, in units of 1 / _FINE, less one
    length: np.ndarray
    piece: np.ndarray  # -1: the bytes of one character
    tail: np.ndarray  # weights, in one scale, of the last nodes but the very last


def lattices(v: Vocabulary, chunks: list[str], given: np.ndarray | None = None) -> Lattices:
    """Forward filtering of each pre-token.

    ``given`` are the known weights of the first nodes of the one chunk there is then.
    """
    flat = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    first = np.cumsum(sizes) - sizes
    token = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    depth = (np.arange(len(flat)) - first[token]).astype(np.int32)  # characters before this one
    room = (sizes[token] - depth).astype(np.int32)
    wide = flat.astype(np.uint64) + np.uint64(1)
    at, h, k = np.arange(len(flat), dtype=np.int32), np.zeros(len(flat), np.uint64), 0
    starts, lengths, pieces = [], [], []
    while len(at):
        h = h * _MIX + wide[at + k]
        k += 1
        got = _look_up(v, h)
        real = got >= 0
        starts.append(at[real]), pieces.append(got[real]), lengths.append(np.full(int(real.sum()), k, np.int8))
        if k == 1:  # characters that are no piece go by their bytes
            bare = at[~real]
            starts.append(bare), pieces.append(np.full(len(bare), -1, np.int32))
            lengths.append(np.ones(len(bare), np.int8))
        on = (got > -2) & (room[at] > k)
        at, h = at[on], h[on]
    start, length, piece = np.concatenate(starts), np.concatenate(lengths), np.concatenate(pieces)
    if given is not None:
        new = start + length >= len(given)
        start, length, piece = start[new], length[new], piece[new]
    narrow = np.uint8 if sizes.max() <= 256 else np.uint16 if sizes.max() <= 65536 else np.uint32
    order = np.argsort(depth[start].astype(narrow), kind="stable")
    start, length, piece = start[order], length[order], piece[order]
    chars = flat[start]
    n_bytes = 1 + (chars >= 0x80).astype(np.int8) + (chars >= 0x800) + (chars >= 0x10000)
    weight = np.where(piece >= 0, v.weights[piece], v.weights[v.byte_ids[0]] ** n_bytes)
    # Edges that start at one depth end in different nodes, so each depth is one step.
    begin = start + token[start]
    end = begin + length
    forward = np.zeros(len(flat) + len(sizes))
    node0 = first + np.arange(len(sizes))
    forward[node0] = 1.0
    if given is not None:
        forward[: len(given)] = given
    flow = np.empty(len(start))
    cuts = np.searchsorted(depth[start], np.arange(int(sizes.max()) + 1))
    # Every ``step`` characters the weights ahead are scaled by a power of two; ``scales``
    # has the sum of exponents by pre-token and stretch.
    step = int(min(200, 200 / max(1.0, -4 * math.log10(v.weights.min()))))
    stretches = (sizes + step - 1) // step
    scale0 = np.cumsum(stretches) - stretches
    scales = np.zeros(int(stretches.sum()), np.int64)
    for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if d and d % step == 0:
            on = np.flatnonzero(sizes > d)
            by = -np.frexp(forward[node0[on] + d])[1]
            scales[scale0[on] + d // step] = scales[scale0[on] + d // step - 1] + by
            ahead = node0[on][:, None] + np.minimum(d + np.arange(v.longest), sizes[on][:, None] + 1)
            inside = d + np.arange(v.longest) <= sizes[on][:, None]
            forward[ahead[inside]] *= np.repeat(np.ldexp(1.0, by), inside.sum(axis=1))
        flow[a:b] = forward[begin[a:b]] * weight[a:b]
        forward[end[a:b]] += flow[a:b]
    if len(scales) > len(sizes):  # flows that go from one stretch to another
        where, room = depth[start], sizes[token[start]]
        ahead = np.flatnonzero(np.minimum(where + length, room - 1) // step > where // step)
        base = scale0[token[start[ahead]]]
        to = base + np.minimum(where[ahead] + length[ahead], room[ahead] - 1) // step
        flow[ahead] = np.ldexp(flow[ahead], scales[to] - scales[base + where[ahead] // step])
    last = np.arange(max(0, len(flat) - v.longest), len(flat))
    tail = np.zeros(0)
    if len(sizes) == 1:
        exponents = scales[last // step]
        tail = np.ldexp(forward[last], exponents[-1] - exponents)
    # Within a node the longest pieces come first, as they are the likeliest.
    by_end = np.argsort(end * (v.longest + 1) - length, kind="stable")
    end, length, piece = end[by_end], length[by_end], piece[by_end]
    share = np.floor(flow[by_end] / forward[end] * _FINE).astype(np.int64)
    upto = np.cumsum(share)
    edges = np.searchsorted(end, np.arange(len(forward) + 1))
    limit = upto - np.append(0, upto)[edges[end]]
    limit[edges[1:][edges[1:] > edges[:-1]] - 1] = _FINE  # the last edge takes what rounding left
    limit = np.maximum(limit - 1, 0).astype(np.uint32)
    return Lattices(flat, first, sizes, edges[:-1], limit, length, piece, tail)


def draw_long(v: Vocabulary, chunk: str, stream: np.uint64) -> list[int]:
    """Ids of one long pre-token, drawn as ``_encode`` draws, segment by segment from the end."""
    befores: list[np.ndarray | None] = [None]
    starts = list(range(0, len(chunk), max(_SEGMENT, v.longest)))

    def segment(j: int) -> tuple[Lattices, int]:
        known = 0 if j == 0 else len(befores[j])
        upto = starts[j + 1] if j + 1 < len(starts) else len(chunk)
        return lattices(v, [chunk[starts[j] - known : upto]], befores[j]), known

    for j in range(len(starts) - 1):
        befores.append(segment(j)[0].tail)
    out: list[int] = []
    node, step = len(chunk), 0
    for j in reversed(range(len(starts))):
        lat, known = segment(j)
        origin = starts[j] - known
        draws = (_scramble(stream + np.arange(step, step + node - origin, dtype=np.uint64)) >> np.uint64(32)).tolist()
        edges, limit, length, piece = lat.edges.tolist(), lat.limit.tolist(), lat.length.tolist(), lat.piece.tolist()
        begun = step
        while node > starts[j]:
            draw, edge = draws[step - begun], edges[node - origin]
            while draw > limit[edge]:
                edge += 1
            node -= length[edge]
            step += 1
            if piece[edge] >= 0:
                out.append(piece[edge])
            else:
                out.extend(v.byte_ids[list(chunk[node].encode())].tolist()[::-1])
    return out[::-1]


class _Column:
    """An array that grows at its end."""

    def __init__(self):
        self.data, self.n = None, 0

    def add(self, more: np.ndarray) -> np.ndarray:
        n = self.n + len(more)
        if self.data is None or n > len(self.data):
            wider = np.empty(2 * n, more.dtype)
            if self.n:
                wider[: self.n] = self.data[: self.n]
            self.data = wider
        self.data[self.n : n] = more
        self.n = n
        return self.data[:n]


class Sampler:
    """Encodes slices of texts; keeps the lattices of pre-tokens until they have ``most`` characters."""

    def __init__(self, v: Vocabulary, most: int = 1_500_000):
        self.v, self.most = v, most
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.columns = [_Column() for _ in range(7)]
        self.lat: Lattices | None = None

    def _known(self, distinct: list[str]) -> np.ndarray:
        """Numbers of pre-tokens, whose lattices are then there."""
        new = [c for c in distinct if c not in self.codes]
        if new and self.lat is not None and len(self.lat.flat) + sum(map(len, new)) > self.most:
            self._forget()
            new = distinct
        if new:
            made = lattices(self.v, new)
            shifts = (0, self.columns[0].n, 0, self.columns[4].n, 0, 0, 0)
            parts = (made.flat, made.first, made.sizes, made.edges, made.limit, made.length, made.piece)
            self.lat = Lattices(*(c.add(x + k if k else x) for c, x, k in zip(self.columns, parts, shifts)), made.tail)
            self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new))))
        return np.fromiter(map(self.codes.__getitem__, distinct), np.int64, len(distinct))

    def encode(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        return _encode(self, texts, seeds)


def _encode(sampler: Sampler, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = sampler.v
    found = [PRETOKEN.findall(t) for t in texts]
    per_row = np.fromiter(map(len, found), np.int64, len(found))
    if not per_row.sum():
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    every = np.empty(int(per_row.sum()), dtype=object)
    every[:] = [c for f in found for c in f]
    long = np.fromiter(map(len, every), np.int64, len(every)) > _LONG
    short = np.flatnonzero(~long)
    codes = np.zeros(len(every), np.int64)
    nth, distinct = pd.factorize(every[short])
    codes[short] = sampler._known(distinct.tolist() or ["\n"])[nth]
    lat = sampler.lat
    row = np.repeat(np.arange(len(texts)), per_row)
    nth = np.arange(len(codes)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    stream = _scramble(seeds[row] + nth.astype(np.uint64) * _MIX)
    origin = (lat.first[codes] + codes).astype(np.int64)  # node 0 of the pre-token
    node, steps = origin + lat.sizes[codes], []
    live, step = short, 0
    while len(live):
        draw = (_scramble(stream[live] + np.uint64(step)) >> np.uint64(32)).astype(np.uint32)
        edge = lat.edges[node[live]]
        late = np.flatnonzero(draw > lat.limit[edge])
        while len(late):
            edge[late] += 1
            late = late[draw[late] > lat.limit[edge[late]]]
        node[live] -= lat.length[edge]
        steps.append((live, edge))
        live = live[node[live] > origin[live]]
        step += 1
    # Lay the pieces out from the back to the front; missing characters take one id per byte.
    total = np.zeros(len(codes), np.int64)
    begins = []
    node = origin + lat.sizes[codes]
    for live, edge in steps:
        node[live] -= lat.length[edge]
        bare = np.flatnonzero(lat.piece[edge] < 0)
        chars = lat.flat[node[live[bare]] - codes[live[bare]]]
        raw = [chr(c).encode() for c in chars.tolist()]
        count = np.ones(len(live), np.int64)
        count[bare] = [len(r) for r in raw]
        total[live] += count
        begins.append((bare, raw, count))
    drawn = {k: draw_long(v, every[k], stream[k]) for k in np.flatnonzero(long).tolist()}
    for k, ids in drawn.items():
        total[k] = len(ids)
    end = np.cumsum(total)
    out = np.zeros(int(end[-1]), np.int32)
    for k, ids in drawn.items():
        out[end[k] - len(ids) : end[k]] = ids
    for (live, edge), (bare, raw, count) in zip(steps, begins):
        end[live] -= count
        out[end[live]] = lat.piece[edge]
        for at, r in zip(end[live[bare]].tolist(), raw):
            out[at : at + len(r)] = v.byte_ids[list(r)]
    return out, np.bincount(row, total, len(texts)).astype(np.int64)


def seed_of(key, seed: int) -> int:
    """64 bits from the seed and a row's key."""
    return int.from_bytes(hashlib.blake2b(repr((seed, key)).encode(), digest_size=8).digest(), "little")


def decode_ids(text: list[bytes], ids) -> str:
    """The text that ids stand for."""
    return b"".join(map(text.__getitem__, ids)).decode()


def encode(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    sharpness: float = 0.5,
    slice_chars: int = 1_000_000,
) -> DataFrame:
    """Per row of ``docs``: the identifier, ``piece_ids``, ``n_pieces``, ``lossless``.

    ``lossless`` says that decoding the ids gave back the text. NULL texts have NULL
    ids, no pieces, and count as lossless; empty ones have none. Rows repeated under
    one identifier with one text get the same ids; rows without identifier draw by
    None as their key. An empty table gives an empty result; other columns are not
    read. ``slice_chars`` bounds memory, not the result.
    """
    need(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary(model_file, sharpness)))

    def run(batches):
        v = Vocabulary(**shared.value)
        sampler = Sampler(v)
        for batch in batches:
            texts, keys = batch["text"].to_pylist(), batch["id"].to_pylist()
            for a, b in slices((len(t or "") for t in texts), slice_chars):
                part = [t or "" for t in texts[a:b]]
                seeds = np.array([seed_of(k, seed) for k in keys[a:b]], np.uint64)
                ids, counts = sampler.encode(part, seeds)
                ends = np.cumsum(counts)
                same, listed = [], ids.tolist()
                for t, e, n in zip(part, ends, counts):
                    same.append(decode_ids(v.text, listed[e - n : e]) == t)
                offsets = pa.array(np.append(0, ends).astype(np.int32), mask=np.append([t is None for t in texts[a:b]], False))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(a, b - a), pa.ListArray.from_arrays(offsets, pa.array(ids)),
                     pa.array(counts.astype(np.int32)), pa.array(same)], ["id", "piece_ids", "n_pieces", "lossless"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = f"id {kind}, piece_ids array<int>, n_pieces int, lossless boolean"
    return rows.mapInArrow(run, made).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "piece_ids") -> DataFrame:
    """Per row the identifier and ``text``; NULL ids give a NULL text."""
    need(encoded, id_col, ids_col)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(model_file).text)

    @F.pandas_udf("string")
    def back(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else decode_ids(shared.value, x))

    return encoded.select(id_col, back(ids_col).alias("text"))
