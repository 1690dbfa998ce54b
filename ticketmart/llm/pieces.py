"""Sampled segmentations over the lattice of SentencePiece pieces, and lossless decoding.

Blanks become the piece alphabet's word mark. Since no piece goes on across the start
of a word mark, the lattice of a text is a chain of lattices of its segments (a run of
marks and what follows it). Segments that occur often in a batch share one lattice.

- Forward filtering adds up, for each place of a segment, the weights of all ways to
  get there; a piece weighs exp(score / temperature).
- Backward sampling goes from the end of each occurrence to its start and draws the
  last piece in proportion to weight. The draws are a hash of seed, row key and place,
  so that a row's segmentation depends on nothing but the row.

Characters without a piece are written as byte pieces, and so is a word mark that is
already part of a text; thus decoding gives back each text exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from ticketmart.llm.common import annotate, mixed, texts_of, without

MARK = "▁"
# Stands for a word mark of the text itself; no UTF-8 text has this code point.
_TEXT_MARK = "\ud800"
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
TEMPERATURE = 1500.0
_BATCH = 2 << 20
# Of a piece's hash, the leading 17 bits find it in its table, those of a prefix its mark.
_SHIFT = np.uint64(47)


@dataclass(frozen=True)
class Pieces:
    """Pieces by id; byte pieces stand at `first_byte` and after."""

    names: list[str]
    scores: list[float]
    normal: list[bool]
    first_byte: int


def read_pieces(path: str) -> Pieces:
    """Pieces of a SentencePiece model with byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    names = [model.id_to_piece(i) for i in ids]
    normal = [not s and MARK not in name.lstrip(MARK) for s, name in zip(special, names, strict=True)]
    return Pieces(names, [model.get_score(i) for i in ids], normal, names.index("<0x00>"))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class _Numbers(dict):
    """Numbers for segments in the order of their appearance."""

    def __missing__(self, segment: str) -> int:
        self[segment] = number = len(self)
        return number


class Lattice:
    """Samples segmentations of batches of texts."""

    def __init__(self, pieces: Pieces, temperature: float = TEMPERATURE) -> None:
        self.first_byte = pieces.first_byte
        by_size: dict[int, list[tuple[int, int]]] = {}
        # By size: whether a longer piece may begin with a hash that has these leading bits.
        self.goes_on: dict[int, np.ndarray] = {}
        for i, name in enumerate(pieces.names):
            if pieces.normal[i]:
                code = np.uint64(0)
                with np.errstate(over="ignore"):
                    for at, point in enumerate(_codes(name)):
                        if at:
                            self.goes_on.setdefault(at, np.zeros(1 << 17, bool))[code >> _SHIFT] = True
                        code = (code + point + np.uint64(1)) * _BASE
                by_size.setdefault(len(name), []).append((int(code), i))
        self.tables = {}
        for size, found in sorted(by_size.items()):
            found.sort()
            keys = np.array([c for c, _ in found], np.uint64)
            # Keys with equal leading bits lie side by side from `firsts` on.
            firsts = np.searchsorted(keys >> _SHIFT, np.arange((1 << 17) + 1, dtype=np.uint64)).astype(np.int32)
            self.tables[size] = keys, np.array([i for _, i in found], np.int32), firsts
        self.weights = np.maximum(np.array(pieces.scores) / temperature, -1e4)
        self.byte_weight = 2 * min(w for w, ok in zip(self.weights, pieces.normal, strict=True) if ok and w > -1e4)

    def edges(self, codes: np.ndarray, below: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces by size: first and last place of each, and its id.

        `below` has, for each place, the next one of its segment, or -1. A character
        without a piece gets an edge with id -1 minus its code point.
        """
        found = []
        at = last = np.arange(len(codes))
        code = (codes + np.uint64(1)) * _BASE
        for size in range(1, max(self.tables) + 1):
            bucket = (code >> _SHIFT).astype(np.int64)
            if size in self.tables:
                keys, values, firsts = self.tables[size]
                low, high = firsts[bucket], firsts[bucket + 1]
                piece = np.full(len(at), -1, np.int32)
                some = np.flatnonzero(low < high)
                place, high = low[some], high[some]
                while len(some):
                    equal = keys[place] == code[some]
                    piece[some[equal]] = values[place[equal]]
                    on = ~equal & (place + 1 < high)
                    some, place, high = some[on], place[on] + 1, high[on]
                if size == 1:
                    found.append((at, last, np.where(piece < 0, -1 - codes.astype(np.int32), piece)))
                else:
                    hit = np.flatnonzero(piece >= 0)
                    found.append((at[hit], last[hit], piece[hit]))
            if size in self.goes_on:
                # Places at which a longer piece may begin.
                on = np.flatnonzero(self.goes_on[size][bucket])
                after = below[last[on]]
                inside = after >= 0
                on, last = on[inside], after[inside]
                at, code = at[on], (code[on] + codes[last] + np.uint64(1)) * _BASE
        return found

    def filtered(self, segments: list[str], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """The lattices of segments, the longest first, filtered forward.

        Nodes lie by depth, so that those of one depth follow each other; node i of a
        depth is that of segment i. Returns the first node of each depth, the first edge
        of each node, and of each edge the node it comes from, its piece, and its
        cumulative chance among the edges of its node.
        """
        n = len(segments)
        # Segments with a character at each depth; the place of one is `width` before the next.
        wide = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), side="left")
        first_place = np.cumsum(wide) - wide
        depth = np.repeat(np.arange(sizes[0]), wide[:-1])
        places = np.arange(len(depth))
        rank = places - first_place[depth]
        codes = _codes("".join(segments))[(np.cumsum(sizes) - sizes)[rank] + depth]
        below = np.where(rank < wide[depth + 1], places + wide[depth], -1)
        # A piece goes from the node before its first place to the node of its last one.
        before = np.where(depth > 0, n + places - wide[depth - 1], rank).astype(np.int32)
        found = self.edges(codes, below)

        times = np.zeros(len(places), np.int64)
        for _, last, _ in found:
            times[last] += 1
        stops = np.cumsum(times)
        first_edge = stops - times
        tail, piece = np.empty(stops[-1], np.int32), np.empty(stops[-1], np.int32)
        # Of a node's edges that with the longest piece comes first.
        free = first_edge.copy()
        while found:
            at, last, ids = found.pop()
            edge = free[last]
            tail[edge], piece[edge] = before[at], ids
            free[last] += 1

        total = np.zeros(n + len(places))
        chance = np.where(piece < 0, self.byte_weight, self.weights[np.maximum(piece, 0)])
        bounds = np.append(first_edge, stops[-1])
        for a, b in zip(first_place.tolist(), first_place[1:].tolist(), strict=False):
            low, high = bounds[a], bounds[b]
            groups = first_edge[a:b] - low
            ways = total[tail[low:high]] + chance[low:high]
            best = np.maximum.reduceat(ways, groups)
            share = np.exp(ways - np.repeat(best, times[a:b]))
            sums = np.add.reduceat(share, groups)
            total[n + a : n + b] = best + np.log(sums)
            chance[low:high] = share / np.repeat(sums, times[a:b])

        # Cumulative chances are added up node by node, so that they do not depend on what
        # else is in the batch; the last is certain.
        at, ends = first_edge + 1, stops
        while len(at):
            on = at < ends
            at, ends = at[on], ends[on]
            chance[at] += chance[at - 1]
            at = at + 1
        chance[stops - 1] = 2.0
        first_node = np.append(0, n + first_place)
        return first_node, np.append(np.zeros(n, np.int64), first_edge), tail, piece, chance

    def sampled(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Ids of one sampled segmentation of each text, drawn by its key."""
        numbers = _Numbers()
        number = numbers.__getitem__
        found, counts = [], []
        for text in texts:
            parts = _SEGMENT.findall(text.replace(MARK, _TEXT_MARK).replace(" ", MARK))
            found += map(number, parts)
            counts.append(len(parts))
        if not found:
            return [np.zeros(0, np.int32)] * len(texts)
        segments = list(numbers)
        sizes = np.array([len(s) for s in segments])
        longest = np.argsort(-sizes, kind="stable")
        segments = [segments[i] for i in longest.tolist()]
        rank = np.empty(len(longest), np.int64)
        rank[longest] = np.arange(len(longest))
        first_node, first_edge, tail, piece, upto = self.filtered(segments, sizes[longest])
        depth_of = np.repeat(np.arange(len(first_node) - 1), np.diff(first_node))

        occurs = np.array(found)
        counts = np.array(counts)
        widths = sizes[occurs]
        text_of = np.repeat(np.arange(len(texts)), counts)
        place = np.cumsum(widths) - widths  # where each occurrence begins, counted from its text
        begins = np.append(0, np.cumsum(widths))[np.cumsum(counts) - counts]
        place = place - begins[text_of]
        seed = np.asarray(keys, np.uint64)[text_of]
        alive = np.arange(len(occurs))
        node = first_node[widths] + rank[occurs]
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        while len(alive):
            spot = (place + depth_of[node]).astype(np.uint64)
            draw = (mixed(seed + mixed(spot + np.uint64(1))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            edge = first_edge[node]
            on = np.flatnonzero(draw >= upto[edge])
            while len(on):
                edge[on] += 1
                on = on[draw[on] >= upto[edge[on]]]
            drawn.append((alive, edge))
            node = tail[edge]
            # The first nodes are those of depth 0, where a segment begins.
            more = np.flatnonzero(node >= len(segments))
            alive, node, place, seed = alive[more], node[more], place[more], seed[more]

        steps = np.zeros(len(occurs), np.int64)
        for owners, _ in drawn:
            steps[owners] += 1
        stop = np.cumsum(steps)
        chosen = np.empty(stop[-1], np.int32)
        for i, (owners, edge) in enumerate(drawn):
            chosen[stop[owners] - 1 - i] = edge
        ids = piece[chosen]
        per_text = np.bincount(text_of, steps, len(texts)).astype(np.int64)
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            ids, per_text = self._with_bytes(ids, bare, per_text)
        return np.split(ids, np.cumsum(per_text)[:-1])

    def _with_bytes(self, ids, bare, per_text) -> tuple[np.ndarray, np.ndarray]:
        """Write characters that have no piece as byte pieces."""
        written = [(MARK if c == ord(_TEXT_MARK) else chr(c)).encode() for c in (-1 - ids[bare]).tolist()]
        widths = np.array([len(w) for w in written])
        text_of = np.searchsorted(np.cumsum(per_text), bare, side="right")
        repeats = np.ones(len(ids), np.int64)
        repeats[bare] = widths
        out = np.repeat(ids, repeats)
        out[np.repeat(ids < 0, repeats)] = np.frombuffer(b"".join(written), np.uint8).astype(np.int32) + self.first_byte
        return out, per_text + np.bincount(text_of, widths - 1, len(per_text)).astype(np.int64)


def spelled(pieces: Pieces) -> list[bytes]:
    """The bytes that each piece stands for."""
    return [
        bytes([i - pieces.first_byte]) if 0 <= i - pieces.first_byte < 256 else name.replace(MARK, " ").encode()
        for i, name in enumerate(pieces.names)
    ]


def encoded(
    docs: DataFrame, pieces: Pieces, keys: list[str], seed: int = 0, temperature: float = TEMPERATURE, text: str = "text"
) -> DataFrame:
    """Add `pieces`, the ids of a segmentation sampled for each row.

    Rows with equal keys and texts get equal segmentations, whatever the partitioning.
    A null text counts as empty and has no pieces. Texts are read whole; a column named
    `pieces` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    seeded = without(docs, ["_row_key"]).withColumn("_row_key", F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]))

    def start():
        lattice = Lattice(shared.value, temperature)

        def compute(batch: pa.RecordBatch) -> list:
            key = batch.column("_row_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            with np.errstate(over="ignore"):
                found = lattice.sampled(texts_of(batch, text), key)
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32)))]

        return compute

    return annotate(seeded, start, [StructField("pieces", ArrayType(IntegerType()), False)], text, _BATCH).drop("_row_key")


def joined(spelling: pa.Array, ids: pa.ListArray) -> pa.Array:
    """The texts that lists of ids stand for; the bytes of all pieces lie end to end already."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    bounds = np.append(0, np.cumsum(sizes))
    written = spelling.take(ids.flatten())
    if not len(written):
        return pa.array([""] * len(ids), pa.string())
    ends = np.frombuffer(written.buffers()[1], np.int32)[written.offset : written.offset + len(written) + 1]
    texts = pa.StringArray.from_buffers(len(ids), pa.py_buffer(ends[bounds].tobytes()), written.buffers()[2] or pa.py_buffer(b""))
    texts.validate(full=True)
    return texts


def decoded(frame: DataFrame, pieces: Pieces, into: str = "decoded", text: str = "text") -> DataFrame:
    """Add the text that `pieces` stand for; null pieces give an empty text."""
    shared = frame.sparkSession.sparkContext.broadcast(pieces)

    def start():
        spelling = pa.array(spelled(shared.value), pa.binary())

        def compute(batch: pa.RecordBatch) -> list:
            return [joined(spelling, batch.column("pieces"))]

        return compute

    return annotate(frame, start, [StructField(into, StringType(), False)], text, _BATCH)
