"""Sampled segmentation into the pieces of a SentencePiece vocabulary, and lossless decoding.

The pieces that fit a text form a lattice over its code points. Forward filtering sums the weights of all
ways to reach each place; backward sampling then walks from the end, at each place drawing one of the
incoming pieces by its share. Draws are hashes of the row key, the place in the text and the step, so the
same row gets the same pieces in any run and any partitioning.

No piece of such a vocabulary crosses from a non-space to a space or a line end, so the lattice falls apart
there; equal parts of a batch share one lattice, and all lattices of a batch are worked on at once in arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Code points that are worked on at once, and the longest run without a space that keeps one lattice; longer
#: ones are cut there. Both bound a task's memory, whatever the texts' lengths.
BATCH_CHARS = 100_000
RUN_CHARS = 4096
#: Rows of an Arrow batch that are taken to Python objects at once.
SLICE_ROWS = 256
SEED = 7

_RUNS = re.compile(rf"\n| {{0,{RUN_CHARS}}}[^ \n]{{1,{RUN_CHARS}}}| {{1,{RUN_CHARS}}}")



class Pieces:
    """A vocabulary: piece texts (a space for the mark of a word's begin), their weights, the byte pieces.

    ``scores`` of byte-pair vocabularies only order the pieces; the weight of a piece of rank r is then
    1 / (r + 2), as frequencies by rank commonly fall. A code point without a piece is spelled by its bytes.
    Workers get what encoding needs: no piece texts, no list from which the trie was built.
    """

    def __getstate__(self) -> dict[str, object]:
        return {k: v for k, v in self.__dict__.items() if k not in ("texts", "plain")}

    def __init__(self, path: str = MODEL) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        skip = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        self.texts: list[bytes] = [b""] * n
        plain = []
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
                self.texts[i] = bytes([int(names[i][3:5], 16)])
            elif not skip[i]:
                text = names[i].replace("▁", " ")
                self.texts[i] = text.encode()
                if not re.search(r"[^ ] |.\n|\n.", text, re.S):
                    plain.append((i, text, model.get_score(i)))
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte pieces, so not every text could be spelled")
        order = sorted(plain, key=lambda x: (-x[2], x[0]))
        self.plain = [(i, text, -float(np.log(rank + 2))) for rank, (i, text, _) in enumerate(order)]
        self.byte_weight = -float(np.log(len(order) + 2))
        self.trie = self._double_array()

    def _double_array(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The pieces as a double-array trie: the code of each code point (0: in no piece), where a node's
        steps begin, which node a step belongs to, and each node's piece (-1: none) and weight. A node is
        the number of the step that leads to it."""
        steps: list[dict[int, int]] = [{}]
        ends: list[tuple[int, float]] = [(-1, 0.0)]
        code: dict[str, int] = {}
        for i, text, weight in self.plain:
            node = 0
            for char in text:
                c = code.setdefault(char, len(code) + 1)
                if c not in steps[node]:
                    steps[node][c] = len(steps)
                    steps.append({})
                    ends.append((-1, 0.0))
                node = steps[node][c]
            ends[node] = (i, weight)
        room = 4 * len(steps) + 2 * len(code) + 2
        base, owner = np.zeros(room, dtype=np.int32), np.full(room, -1, dtype=np.int32)
        piece, cost = np.full(room, -1, dtype=np.int32), np.zeros(room)
        taken = bytearray(room)
        slot_of, free, low = {0: 0}, 1, 0
        taken[0] = 1
        for node in sorted(range(len(steps)), key=lambda n: -len(steps[n])):
            if not steps[node]:
                continue
            if len(steps[node]) > 1:  # side by side, the search goes on where the last one ended
                tries, at = 0, low
                while any(taken[at + c] for c in steps[node]):
                    at, tries = at + 1, tries + 1
                low = at if tries > 8 else max(low, 1)
            else:  # single steps fill the gaps
                (only,) = steps[node]
                free = max(free, only + 1)
                while taken[free]:
                    free += 1
                at = free - only
            for c, to in steps[node].items():
                taken[at + c] = 1
                slot_of[to] = at + c
            steps[node][0] = at
        for node, slot in slot_of.items():
            piece[slot], cost[slot] = ends[node]
            if steps[node]:
                base[slot] = at = steps[node].pop(0)
                for c in steps[node]:
                    owner[at + c] = slot
        codes = np.zeros(1 << 21, dtype=np.int32)
        codes[[ord(c) for c in code]] = list(code.values())
        return codes, base, owner, piece, cost

    def edges(self, chars: np.ndarray, run_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end, piece and weight of each piece in each run. ``run_end``: where the run of a code
        point ends. A negative piece -1 - c spells the code point c by its bytes."""
        codes, base, owner, piece, weight = self.trie
        code = codes[chars]
        begin = np.flatnonzero(code).astype(np.int32)
        node = np.zeros(len(begin), dtype=np.int32)
        alone = np.ones(len(chars), dtype=bool)
        out = []
        length = 0
        while len(begin):
            step = base[node] + code[begin + length]
            fits = owner[step] == node
            begin, node = begin[fits], step[fits]
            length += 1
            ends = piece[node] >= 0
            done = begin[ends]
            if length == 1:
                alone[done] = False
            out.append((done, done + np.int32(length), piece[node[ends]], weight[node[ends]]))
            more = (begin + length < run_end[begin]) & (base[node] > 0)
            begin, node = begin[more], node[more]
            more = code[begin + length] > 0
            begin, node = begin[more], node[more]
        spelled = np.flatnonzero(alone).astype(np.int32)
        cost = self.byte_weight * utf8_length(chars[spelled])
        out.append((spelled, spelled + np.int32(1), -1 - chars[spelled], cost))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def utf8_length(chars: np.ndarray) -> np.ndarray:
    return 1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF)


def utf8_byte(chars: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """The byte at a place of each code point's UTF-8 form."""
    payload = chars >> (6 * (size - 1 - at))
    if at:
        return 0x80 | (payload & 0x3F)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size]
    return np.where(size == 1, chars, lead | payload)


def _draw(key: np.ndarray, place: np.ndarray, step: int) -> np.ndarray:
    """32 random bits by mixing those of key, place and step."""
    with np.errstate(over="ignore"):
        x = key + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((step * 0xD1B54A32D192ED03) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.int64)


def row_key(key: object, seed: int = SEED) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest("" if key is None else str(key), seed))


def _forward(begin: np.ndarray, end: np.ndarray, weight: np.ndarray, place: np.ndarray, nodes: int) -> np.ndarray:
    """Log of the summed weights of all ways from a run's begin to each node. Edges are sorted by end;
    ``place`` is the place in its run of each edge's end."""
    order = np.argsort(place.astype(np.uint16), kind="stable")
    begin, end, weight, place = begin[order], end[order], weight[order], place[order]
    total = np.zeros(nodes)
    cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
        at = end[lo:hi]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        value = total[begin[lo:hi]] + weight[lo:hi]
        top = np.maximum.reduceat(value, first)
        sums = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(first, append=len(at)))), first)
        total[at[first]] = top + np.log(sums)
    return total


def sample(pieces: Pieces, runs: list[str], keys: np.ndarray, places: np.ndarray, sharpness: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all runs, one after the other, and how many each run has. ``keys`` and ``places`` seed the
    draws of a run. Weights are raised to the power ``sharpness``: 0 draws any segmentation alike, a large
    value always the best."""
    distinct = list(dict.fromkeys(runs))
    index = dict(zip(distinct, range(len(distinct)), strict=True))
    which = np.fromiter(map(index.__getitem__, runs), dtype=np.int64, count=len(runs))
    chars = np.frombuffer("".join(distinct).encode("utf-32-le", "surrogatepass"), dtype="<i4")
    lengths = np.fromiter(map(len, distinct), dtype=np.int32, count=len(distinct))
    starts = np.cumsum(lengths, dtype=np.int32) - lengths
    begin, end, piece, weight = pieces.edges(chars, np.repeat(starts + lengths, lengths))
    by_end = np.argsort(end, kind="stable")
    begin, end, piece, weight = begin[by_end], end[by_end], piece[by_end], weight[by_end] * sharpness
    # each run has a node more than code points: node = code point + number of the run
    numbers = np.arange(len(distinct), dtype=np.int32)
    roots = starts + numbers
    run_of = np.repeat(numbers, lengths)[begin]
    begin, end = begin + run_of, end + run_of
    total = _forward(begin, end, weight, end - roots[run_of], len(chars) + len(distinct))
    # shares as whole 32-bit numbers, so that rounding does not depend on what else is in the batch
    share = (np.exp(total[begin] + weight - total[end]) * (1 << 32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
    sums = np.cumsum(share)
    sizes = np.diff(first, append=len(end))
    upper = sums - np.repeat((sums - share)[first], sizes)
    upper[first + sizes - 1] = 1 << 32
    edge_of = np.zeros(len(total), dtype=np.int64)
    edge_of[end[first]] = first
    # backward sampling of all runs at once, equal runs side by side
    owner = np.argsort(which, kind="stable")
    at, stop = (roots + lengths)[which[owner]], roots[which[owner]]
    key, place = keys[owner], places[owner]
    drawn, owners, step = [], [], 0
    while len(owner):
        edge, draw = edge_of[at], _draw(key, place, step)
        open_ = np.flatnonzero(upper[edge] <= draw)
        while len(open_):
            edge[open_] += 1
            open_ = open_[upper[edge[open_]] <= draw[open_]]
        drawn.append(piece[edge])
        owners.append(owner)
        at = begin[edge]
        more = at > stop
        owner, at, stop, key, place = owner[more], at[more], stop[more], key[more], place[more]
        step += 1
    counts = np.zeros(len(runs), dtype=np.int64)
    for owner in owners:
        counts[owner] += 1
    ends = np.cumsum(counts)
    ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
    for back, (owner, found) in enumerate(zip(owners, drawn, strict=True)):
        ids[ends[owner] - 1 - back] = found
    spelled = ids < 0
    if spelled.any():
        size = np.where(spelled, utf8_length(-1 - ids), 1)
        out, at = np.repeat(ids, size), np.cumsum(size) - size
        c, n, s = -1 - ids[spelled], size[spelled], at[spelled]
        for b in range(4):
            has = n > b
            out[s[has] + b] = pieces.byte_ids[utf8_byte(c[has], n[has], b)]
        counts = np.add.reduceat(size, ends - counts)
        ids = out
    return ids, counts


def encode_texts(pieces: Pieces, texts: list[str | None], keys: list[object], seed: int = SEED, sharpness: float = 1.0) -> list[np.ndarray]:
    """Piece ids of each text. Null and empty texts have none; any other gets a space in front."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    runs: list[str] = []
    blocks: list[tuple[int, int, int]] = []  # text, place of its first run here, runs
    size = 0

    def flush() -> None:
        nonlocal runs, blocks, size
        if runs:
            counts = [n for _, _, n in blocks]
            key = np.repeat(np.array([row_key(keys[i], seed) for i, _, _ in blocks], dtype=np.uint64), counts)
            place = np.concatenate([np.arange(at, at + n) for _, at, n in blocks])
            ids, lengths = sample(pieces, runs, key, place, sharpness)
            ends = np.cumsum(np.add.reduceat(lengths, np.cumsum(counts) - counts))
            for (i, _, _), piece in zip(blocks, np.split(ids, ends[:-1]), strict=True):
                parts[i].append(piece)
        runs, blocks, size = [], [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        place = 0
        found: list[str] = []
        for match in _RUNS.finditer(" " + text) if len(text) > BATCH_CHARS else ():
            found.append(match[0])
            size += len(match[0])
            if size >= BATCH_CHARS:
                blocks.append((i, place, len(found)))
                runs += found
                place += len(found)
                found = []
                flush()
        if len(text) <= BATCH_CHARS:
            found = _RUNS.findall(" " + text)
            size += len(text) + 1
        if found:
            blocks.append((i, place, len(found)))
            runs += found
        if size >= BATCH_CHARS:
            flush()
    flush()
    return [np.concatenate(p) if len(p) > 1 else p[0] if p else np.zeros(0, dtype=np.int32) for p in parts]


def decode_ids(pieces: Pieces, ids: list[int] | np.ndarray | None) -> str:
    """The text of which these are the pieces. Null is empty."""
    return _spelled(pieces.texts, ids)


def _spelled(texts: list[bytes], ids: list[int] | np.ndarray | None) -> str:
    if ids is None or not len(ids):
        return ""
    return b"".join(map(texts.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def _slices(rows: int) -> Iterator[tuple[int, int]]:
    """Begin and length of the slices of a batch."""
    return ((at, min(SLICE_ROWS, rows - at)) for at in range(0, rows, SLICE_ROWS))


def encoder(spark_docs: DataFrame, text: str = "text", key: str = "doc_id", model: str = MODEL, seed: int = SEED, sharpness: float = 1.0) -> Column:
    """A column of piece ids. The vocabulary, a file of about a megabyte, is read on the driver."""
    shared = spark_docs.sparkSession.sparkContext.broadcast(Pieces(model))

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in batches:
            for part in _slices(len(texts)):
                found = encode_texts(shared.value, texts.slice(*part).to_pylist(), keys.slice(*part).to_pylist(), seed, sharpness)
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                values = np.concatenate([np.zeros(0, dtype=np.int32), *found], dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return ids(F.col(text), F.col(key).cast("string"))


def decoder(spark_docs: DataFrame, column: str, model: str = MODEL) -> Column:
    """A column of texts from a column of piece ids."""
    shared = spark_docs.sparkSession.sparkContext.broadcast(Pieces(model).texts)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            offsets = batch.offsets.to_numpy()
            values = batch.values.to_numpy()
            for at, n in _slices(len(batch)):
                ends = offsets[at : at + n + 1]
                yield pa.array([_spelled(shared.value, values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())

    return texts(F.col(column))


def encoded(docs: DataFrame, text: str = "text", key: str = "doc_id", **options: object) -> DataFrame:
    """``doc_id, text, ids`` for each row of ``docs``; null texts have no ids."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", "text", encoder(rows, **options).alias("ids"))


def decoded(rows: DataFrame, ids: str = "ids", **options: object) -> DataFrame:
    """Adds the text that the ids spell, as ``decoded``."""
    return rows.withColumn("decoded", decoder(rows, ids, **options))
