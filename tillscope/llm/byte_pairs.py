"""Byte-level BPE by replaying the merges over the distinct words of a corpus.

Texts are split into words by the tokenizer's pattern. The distinct words of a slice of
texts lie one after the other as tokens, one per byte, linked to their neighbours. An
inverted index holds, by the rank of the token that two neighbours make, the places
where such a pair starts. The lowest rank is taken from the index, its places are merged
together, and only the pairs at a merged place and the one before it are looked up anew.
Words are independent of each other, so the slices bound memory and never change a result.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import need, slices

# Fixed value: the pattern that goes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
#: A text may be cut before white space that follows anything else: no word spans that place.
_CUT = re.compile(r"\S[ \n]")


@dataclass
class Ranks:
    """A rank file, and what the replay needs of it."""

    blob: np.ndarray  # all tokens' bytes
    starts: np.ndarray  # by id; one more than tokens
    of_byte: np.ndarray
    pairs: np.ndarray  # sorted: left id * 2**32 + right id
    joined: np.ndarray  # by pair: the id of both together
    early: np.ndarray  # by id: with some neighbour it makes a token of lower rank
    kinds: np.ndarray  # by code point: letter, number, white space or other


def _kinds() -> np.ndarray:
    import regex

    out = np.zeros(0x110000, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    at = np.array(points)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        out[at[[m.start() for m in regex.finditer(pattern, text)]]] = kind
    return out


def ranks(path: str) -> Ranks:
    """Read a rank file: a line has a token in base64 and its rank, which is its id."""
    with open(path, "rb") as lines:
        entries = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if missing := [b for b in range(256) if bytes([b]) not in entries]:
        raise ValueError(f"no token for {len(missing)} of the bytes, so not every text can be encoded")
    tokens = [b""] * (max(entries.values()) + 1)
    pairs, joined, early = [], [], np.zeros(len(tokens), bool)
    for token, rank in entries.items():
        tokens[rank] = token
        for k in range(1, len(token)):
            left, right = entries.get(token[:k]), entries.get(token[k:])
            if left is not None and right is not None:
                pairs.append(left << 32 | right)
                joined.append(rank)
                if left > rank:
                    early[left] = True
                if right > rank:
                    early[right] = True
    order = np.argsort(np.array(pairs, np.int64))
    return Ranks(
        np.frombuffer(b"".join(tokens), np.uint8),
        np.append(0, np.cumsum([len(t) for t in tokens])),
        np.array([entries[bytes([b])] for b in range(256)], np.int64),
        np.array(pairs, np.int64)[order],
        np.array(joined, np.int64)[order],
        early,
        _kinds(),
    )


def word_starts(kinds: np.ndarray, points: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where words of ``PATTERN`` start. ``fresh`` marks the characters that begin a text."""
    kind = kinds[points]
    change = fresh.copy()
    change[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(change)
    ends = np.append(runs[1:], len(points))
    follows = np.append(~fresh[runs[1:]], False)  # the next run is of the same text
    # The last of several white spaces goes to what follows them, if it is a plain space, or stands alone.
    gaps = np.flatnonzero((kind[runs] == _SPACE) & follows)
    last = ends[gaps] - 1
    change[last] = True
    change[ends[gaps][points[last] == 32]] = False
    # An apostrophe that starts a word takes certain letters with it.
    marks = np.flatnonzero((points[runs] == 39) & (ends - runs == 1) & change[runs] & follows)
    marks = marks[kind[ends[marks]] == _LETTER]
    first, stop = ends[marks], ends[marks + 1] if len(marks) else ends[:0]
    one = points[first]
    two = np.where(first + 1 < stop, points[np.minimum(first + 1, len(points) - 1)], 0)
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = ((two == ord("e")) & np.isin(one, [ord(c) for c in "rv"])) | ((two == ord("l")) & (one == ord("l")))
    taken = single + 2 * (double & ~single)
    change[first[taken > 0]] = False
    on = (taken > 0) & (first + taken < stop)
    change[(first + taken)[on]] = True
    return np.flatnonzero(change)


def _merged(v: Ranks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Id of both tokens together, or -1."""
    wanted = left << 32 | right
    at = np.minimum(np.searchsorted(v.pairs, wanted), len(v.pairs) - 1)
    return np.where(v.pairs[at] == wanted, v.joined[at], -1)


class _Index:
    """Places by the rank they are due at; the lowest rank comes first."""

    def __init__(self):
        self.places: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def add(self, due: np.ndarray, at: np.ndarray) -> None:
        """Places ``at`` in ascending order; those due at -1 are left out."""
        if len(at) > 1:
            order = np.argsort(due, kind="stable")
            due, at = due[order], at[order]
        heads = [0, *(np.flatnonzero(due[1:] != due[:-1]) + 1).tolist(), len(due)] if len(due) else []
        for a, b in zip(heads[:-1], heads[1:]):
            rank = int(due[a])
            if rank >= 0:
                if rank not in self.places:
                    self.places[rank] = []
                    heapq.heappush(self.heap, rank)
                self.places[rank].append(at[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.heap)
        found = self.places.pop(rank)
        return rank, found[0] if len(found) == 1 else np.sort(np.concatenate(found))


def replay(v: Ranks, letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one word after the other, and how many each has.

    Within a word the lowest rank goes first, of equal ones the leftmost. Places of one
    rank are merged together but for ranks that can bring about a lower one: of those a
    word has one merged at a time.
    """
    n = len(letters)
    token = np.append(v.of_byte[letters], len(v.early))  # the place n stands for no neighbour
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    ends = np.cumsum(sizes)
    after[ends[sizes > 0] - 1] = n
    before[(ends - sizes)[sizes > 0]] = n
    due = np.append(_merged(v, token[:n], token[after[:n]]), -1)
    index = _Index()
    index.add(due[:n], np.arange(n))
    while index.heap:
        rank, at = index.pop()
        at = at[due[at] == rank]
        if not len(at):
            continue
        if len(at) > 1:
            tied = after[at[:-1]] == at[1:]
            if tied.any():  # pairs that share a token: every other one of a chain, from the left
                heads = np.flatnonzero(np.append(True, ~tied))
                nth = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
                at = at[nth % 2 == 0]
            if v.early[rank]:
                first = np.append(True, word[at[1:]] != word[at[:-1]])
                if not first.all():
                    index.add(np.full(int((~first).sum()), rank), at[~first])
                    at = at[first]
        gone = after[at]
        then = after[gone]
        token[at] = rank
        after[at] = then
        before[then] = at
        due[gone] = -1
        token[gone] = -1
        prior = before[at]
        touched = np.sort(np.concatenate([at, prior[prior < n]]))
        touched = touched[np.append(touched[1:] != touched[:-1], True)]
        fresh = _merged(v, token[touched], token[after[touched]])
        due[touched] = fresh
        index.add(fresh, touched)
    alive = token[:n] >= 0
    return token[:n][alive], np.bincount(word[alive], minlength=len(sizes))


class Encoder:
    """Encodes slices of texts; keeps the ids of words until there are ``most`` of them."""

    def __init__(self, v: Ranks, most: int = 300_000):
        self.v, self.most = v, most
        blob = v.blob.tobytes()
        self.whole = pa.array([blob[a:b] or None for a, b in zip(v.starts[:-1], v.starts[1:])], pa.binary())
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.flat, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _known(self, distinct: pa.BinaryArray) -> np.ndarray:
        """Numbers of the words, whose ids are then there."""
        listed = distinct.to_pylist()
        new = [w for w in listed if w not in self.codes]
        if len(self.codes) + len(new) > self.most:
            self._forget()
            new = listed
        if new:
            words = pa.array(new, pa.binary())
            single = pc.index_in(words, value_set=self.whole)
            rest = [w for w, known in zip(new, single.is_valid().to_pylist()) if not known]
            ids, sizes = replay(
                self.v, np.frombuffer(b"".join(rest), np.uint8), np.fromiter(map(len, rest), np.int64, len(rest))
            )
            # Words that are tokens as they stand come first.
            ones = single.drop_null().to_numpy().astype(np.int64)
            order = [w for w, known in zip(new, single.is_valid().to_pylist()) if known] + rest
            self.codes.update(zip(order, range(len(self.codes), len(self.codes) + len(order))))
            self.flat = np.concatenate([self.flat, ones, ids])
            self.counts = np.concatenate([self.counts, np.ones(len(ones), np.int64), sizes])
        return np.fromiter(map(self.codes.__getitem__, listed), np.int64, len(listed))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        if not lengths.sum():
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        text = "".join(texts)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        fresh = np.zeros(len(points), bool)
        begin = np.cumsum(lengths) - lengths
        fresh[begin[lengths > 0]] = True
        starts = word_starts(self.v.kinds, points, fresh)
        data = text.encode()
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.append(0, np.cumsum(width, dtype=np.int64))[np.append(starts, len(points))].astype(np.int32)
        words = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        codes = self._known(words.dictionary)[words.indices.to_numpy()]
        size = self.counts[codes]
        first = (np.cumsum(self.counts) - self.counts)[codes]
        upto = np.cumsum(size)
        ids = self.flat[np.repeat(first - (upto - size), size) + np.arange(upto[-1])]
        edges = np.append(0, upto)[np.searchsorted(starts, np.append(begin, len(points)))]
        return ids.astype(np.int32), np.diff(edges)


def _pieces(text: str, most: int) -> Iterator[str]:
    """``text`` in parts that are encoded alone; a part is longer where there is no place to cut."""
    start = 0
    while len(text) - start > most and (place := _CUT.search(text, start + most)):
        yield text[start : place.start() + 1]
        start = place.start() + 1
    yield text[start:]


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = 2_000_000
) -> DataFrame:
    """Per row of ``docs``: the identifier and ``token_ids`` by the ranks of the file at ``path``.

    The file is read where the query is built and sent to the executors. NULL texts have
    NULL ids, empty ones none; repeated rows and rows without identifier are rows like any
    other. An empty table gives an empty result; other columns are not read.
    ``slice_chars`` bounds memory, not the result: longer texts are cut between words.
    """
    need(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vars(ranks(path)))

    def run(batches):
        encoder = Encoder(Ranks(**shared.value))
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in slices((len(t or "") for t in texts), slice_chars):
                parts, rows = [], []
                for k, t in enumerate(texts[a:b]):
                    for part in _pieces(t or "", slice_chars):
                        parts.append(part)
                        rows.append(k)
                ids, counts = [], np.zeros(b - a, np.int64)
                for c, d in slices(map(len, parts), slice_chars):
                    found, sizes = encoder.encode(parts[c:d])
                    ids.append(found)
                    np.add.at(counts, rows[c:d], sizes)
                offsets = pa.array(
                    np.append(0, np.cumsum(counts)).astype(np.int32),
                    mask=np.append([t is None for t in texts[a:b]], False),
                )
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), lists], ["id", "token_ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, token_ids array<int>").withColumnRenamed("id", id_col)


def decode(
    encoded: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded", slice_ids: int = 500_000
) -> DataFrame:
    """``encoded`` with the bytes of its ids in place of the ids, as ``out_col``.

    A cast to string gives the text. NULL ids give NULL; an id that the file lacks ends
    the job with an error. ``slice_ids`` bounds memory, not the result.
    """
    need(encoded, ids_col)
    others = [c for c in encoded.columns if c != ids_col]
    v = ranks(path)
    shared = encoded.sparkSession.sparkContext.broadcast((v.blob, v.starts))

    def run(batches):
        blob, starts = shared.value
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(counts.tolist(), slice_ids):
                part = batch.slice(a, b - a)
                lists = part.column(part.num_columns - 1)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(starts) - 1):
                    raise ValueError("an id is none of the rank file's")
                size = starts[ids + 1] - starts[ids]
                upto = np.cumsum(size)
                data = blob[np.repeat(starts[ids] - (upto - size), size) + np.arange(size.sum())].tobytes()
                ends = np.append(0, upto)[np.append(0, np.cumsum(counts[a:b], dtype=np.int64))].tolist()
                made = [
                    None if missing else data[c:d]
                    for c, d, missing in zip(ends[:-1], ends[1:], lists.is_null().to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made, pa.binary())], [*others, out_col])

    rows = encoded.select(*others, ids_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]] + [f"`{out_col}` binary"])
    return rows.mapInArrow(run, schema)
