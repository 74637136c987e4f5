"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and their scores come from a public model file; nothing is trained. Spaces become a marker, one marker is put before the
text, and no piece holds a marker behind another sign, so the best segmentation of a text is that of its marked
words, one after the other. Characters without a piece fall back to byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from lanecast.llm.words import CACHE_WORDS, lists, map_batches, pieces, text_bytes

MARKER = "▁".encode()
#: A character without a piece scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
_UNITS = re.compile(rb" *[^ ]+| +")


@dataclass(frozen=True)
class DoubleArray:
    """A trie in two arrays: the child of node n by byte b is base[n] + b + 1 if check there says n; value is a piece or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @staticmethod
    def build(words: dict[bytes, int]) -> DoubleArray:
        """From key to value. Nodes are placed breadth first, each at the first base where all its children fit."""
        tree: list[dict] = [{}]
        ends = {0: -1}
        for word, number in sorted(words.items()):
            node = 0
            for byte in word:
                if byte not in tree[node]:
                    tree[node][byte] = len(tree)
                    ends[len(tree)] = -1
                    tree.append({})
                node = tree[node][byte]
            ends[node] = number
        # a lone child takes the next free place; larger families go where all fit, searched from the last such place on
        base, check, value, taken = [0], [-1], [-1], bytearray(b"\1")
        queue, lone, family = [(0, 0)], 1, 1
        for at, node in queue:
            value[at] = ends[node]
            offsets = [byte + 1 for byte in tree[node]]
            if not offsets:
                continue
            if len(offsets) == 1:
                lone = max(lone, offsets[0])
                while lone < len(taken) and taken[lone]:
                    lone += 1
                start = lone - offsets[0]
            else:
                start = family
                while any(start + o < len(taken) and taken[start + o] for o in offsets):
                    start += 1
                family = start
            room = start + max(offsets) + 1 - len(taken)
            if room > 0:
                taken += bytes(room)
                base += [0] * room
                check += [-1] * room
                value += [-1] * room
            base[at] = start
            for byte, child in tree[node].items():
                spot = start + byte + 1
                taken[spot], check[spot] = 1, at
                queue.append((spot, child))
        return DoubleArray(*(np.array(x + [fill] * 257, np.int64) for x, fill in ((base, 0), (check, -1), (value, -1))))

    def step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The child of each node by a byte, -1 where there is none."""
        child = self.base[nodes] + bytes_ + 1
        return np.where(self.check[child] == nodes, child, -1)


class UnigramModel:
    """Pieces with log scores, their trie, and the two directions."""

    def __init__(self, pieces: list[tuple[bytes, float]], byte_pieces: dict[int, int], dropped: frozenset = frozenset()):
        self.scores = [score for _, score in pieces]
        words = {p: n for n, (p, _) in enumerate(pieces) if p and n not in dropped and n not in byte_pieces.values()}
        if any(MARKER in p.lstrip(MARKER) for p in words if p.replace(MARKER, b"")):
            raise ValueError("a piece holds the whitespace marker behind another sign")
        self.trie = DoubleArray.build(words)
        self.byte_pieces = byte_pieces
        self.unknown = min((self.scores[n] for n in words.values()), default=0.0) - UNKNOWN_PENALTY
        self.texts = [p.replace(MARKER, b" ") for p, _ in pieces]
        for byte, number in byte_pieces.items():
            self.texts[number] = bytes([byte])
        for number in dropped:
            self.texts[number] = b""
        #: Signs that are in no piece, so that a text may be cut at them.
        self.breaks = b"\n" if not any(b"\n" in p for p in words) else None
        self.units: dict[bytes, bytes] = {}
        self.score_array = np.array(self.scores, np.float64)

    def viterbi(self, texts: list[bytes]) -> list[bytes]:
        """The best-scoring pieces of each marked text, as little-endian 32-bit numbers.

        All texts advance together, one start after the other; of equal scores the one with the earliest start of its last
        piece stands. Texts of very different length are better given apart.
        """
        count, size = len(texts), max(map(len, texts))
        chars = np.zeros((size + 4, count), np.int64)
        length = np.array([len(t) for t in texts])
        flat = np.frombuffer(b"".join(texts), np.uint8)
        where = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
        chars[where, np.repeat(np.arange(count), length)] = flat
        width = 1 + (chars >= 0xC0) + (chars >= 0xE0) + (chars >= 0xF0)
        best = np.full((size + 5, count), -np.inf)
        begin, piece = np.zeros((size + 5, count), np.int32), np.full((size + 5, count), -1, np.int32)
        best[0] = 0.0
        for start in range(size):
            who = np.flatnonzero(np.isfinite(best[start]) & (start < length))
            score, whole = best[start], np.zeros(count, bool)
            nodes, at, all_ = np.zeros(len(who), np.int64), start, who
            while len(who) and at < size:
                nodes = self.trie.step(nodes, chars[at, who])
                on = (nodes >= 0) & (at < length[who])
                who, nodes, at = who[on], nodes[on], at + 1
                number = self.trie.value[nodes]
                ends = number >= 0
                them, number = who[ends], number[ends]
                total = score[them] + self.score_array[number]
                better = total > best[at, them]
                best[at, them[better]], begin[at, them[better]], piece[at, them[better]] = total[better], start, number[better]
                whole[them[width[start, them] == at - start]] = True
            lone = all_[~whole[all_]]
            end = np.minimum(start + width[start, lone], length[lone])
            better = score[lone] + self.unknown > best[end, lone]
            lone, end = lone[better], end[better]
            best[end, lone], begin[end, lone], piece[end, lone] = score[lone] + self.unknown, start, -1
        out = []
        begins, found = begin.T.tolist(), piece.T.tolist()
        for row, text in enumerate(texts):
            path, end, starts, numbers = [], len(text), begins[row], found[row]
            while end:
                start = starts[end]
                if numbers[end] >= 0:
                    path.append(numbers[end])
                else:
                    path += [self.byte_pieces[b] for b in reversed(text[start:end])]
                end = start
            out.append(pack(f"<{len(path)}I", *reversed(path)))
        return out

    def learn(self, units: list[bytes]) -> None:
        """Put the segmentations of new units into the cache, texts of like length together."""
        parts = {u: u.split(self.breaks) if self.breaks else [u] for u in units}
        heads = {p[0] for p in parts.values()}
        tails = {t for p in parts.values() for t in p[1:] if t}
        marked = {MARKER + h.replace(b" ", MARKER): h for h in heads}
        todo = sorted([*marked, *(tails - marked.keys())], key=len)
        done, first = {b"": b""}, 0
        while first < len(todo):
            # a longer text than a few words goes alone
            last = min(len(todo), first + max(1, 200_000 // (len(todo[first]) + 8)))
            while last - first > 1 and len(todo[last - 1]) > 2 * len(todo[first]) + 8:
                last = (first + last) // 2
            done.update(zip(todo[first:last], self.viterbi(todo[first:last])))
            first = last
        if self.breaks:
            line = pack("<I", self.byte_pieces[self.breaks[0]])
        for unit, (head, *rest) in parts.items():
            codes = [done[MARKER + head.replace(b" ", MARKER)]] + [done[r] for r in rest]
            self.units[unit] = line.join(codes) if rest else codes[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Piece numbers of UTF-8 texts as little-endian unsigned 32-bit integers; nothing for an empty text."""
        split = [[u[1:] for u in _UNITS.findall(b" " + text)] if text else [] for text in texts]
        if len(self.units) > CACHE_WORDS:
            self.units.clear()
        self.learn(list(set().union(*split) - self.units.keys()))
        return [b"".join(map(self.units.__getitem__, units)) for units in split]

    def decode(self, numbers: np.ndarray) -> bytes:
        """The text of piece numbers: markers become spaces, byte pieces bytes, and the first marker goes."""
        text = b"".join(map(self.texts.__getitem__, numbers.tolist()))
        return text[1:] if text[:1] == b" " else text


@lru_cache(maxsize=2)
def load_model(path: str) -> UnigramModel:
    """The model of a SentencePiece file. Control and unknown pieces never come from text."""
    from sentencepiece import SentencePieceProcessor

    file = SentencePieceProcessor(model_file=path)
    count = range(file.get_piece_size())
    bytes_ = {int(file.id_to_piece(n)[3:5], 16): n for n in count if file.is_byte(n)}
    dropped = frozenset(n for n in count if file.is_control(n) or file.is_unknown(n) or file.is_unused(n))
    return UnigramModel([(file.id_to_piece(n).encode(), file.get_score(n)) for n in count], bytes_, dropped)


def _shipped(df: DataFrame, path: str) -> str:
    """Send the model file along with the job; the name under which tasks find it."""
    name = path.rsplit("/", 1)[-1]
    context = df.sparkSession.sparkContext
    if not any(name == known.rsplit("/", 1)[-1] for known in context.listFiles):
        context.addFile(path)
    return name


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array<int>), n_pieces, n_byte_pieces (long), round_trip (boolean) of every row.

    ``path`` names the model file. A null text is as empty and has no pieces; ``round_trip`` says that decoding the ids gives the
    text again. Ids may be null or repeated; other columns are not read.
    """
    name = _shipped(documents, path)

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        model, texts = load_model(SparkFiles.get(name)), text_bytes(batch)
        is_byte = np.zeros(len(model.texts), bool)
        is_byte[list(model.byte_pieces.values())] = True
        for begin, end in pieces(texts):
            codes = [np.frombuffer(code, "<u4") for code in model.encode_all(texts[begin:end])]
            yield {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id"))[begin:end],
                "ids": lists(np.concatenate(codes).astype(np.int32), [len(c) for c in codes]),
                "n_pieces": [len(c) for c in codes],
                "n_byte_pieces": [int(is_byte[c].sum()) for c in codes],
                "round_trip": [model.decode(c) == text for c, text in zip(codes, texts[begin:end])],
            }

    schema = "doc_id long, ids array<int>, n_pieces long, n_byte_pieces long, round_trip boolean"
    return map_batches(documents.select("doc_id", "text"), transform, schema)


def decoded(encodings: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of ``encodings`` (doc_id, ids); null ids give an empty text, impossible bytes the replacement sign."""
    name = _shipped(encodings, path)

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        model = load_model(SparkFiles.get(name))
        ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
        texts = [model.decode(np.array(i or [], np.int64)).decode("utf-8", "replace") for i in ids]
        yield {"doc_id": batch.column(batch.schema.get_field_index("doc_id")), "text": texts}

    return map_batches(encodings.select("doc_id", "ids"), transform, "doc_id long, text string")
