"""SentencePiece encoding and decoding, by the rule of the model's kind.

An Aho-Corasick automaton over the pieces drives a one-pass search. For every position it gives the pieces that end there,
longest first (the state's own piece, then those along its output links), and each is held against the best that ends at its
start. For a unigram model each relaxes the best score of a segmentation that ends at the position; of equal scores the
longest last piece wins.

A BPE model's ids come of its merges: of the neighbours that make a piece together those of the best score join first, the
leftmost of equal ones, until none is left. The best sum of scores gives other ids there. But the merged segmentation of
every prefix ends in one piece, and a piece may follow another where merging the two texts together gives just these two: so
at each position the longest piece that may follow the last one at its start is the one, and the search needs no scores. Which
pieces may follow each other is merged once and kept (PAIRS at most, then the table starts anew).

By both rules a character that no piece covers becomes its UTF-8 bytes' pieces. Text is taken as it is, with one space put
before it (the model's dummy prefix), spaces stand for U+2581, and a literal U+2581 is encoded as bytes, so decoding gives
every text back. Since no piece holds a space after another character, each run of spaces with what follows it is encoded
once per batch of documents and kept by the worker (KEPT at most, then it starts anew).
"""

from __future__ import annotations

import zlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import arrow_batch, lean, runs, utf8

KEPT = 250_000
PAIRS = 500_000
CHUNK = 4 << 20
SPACE = "▁"

BPE = 2  # model_type of the trainer

_codecs: dict[tuple[str, bool], "PieceCodec"] = {}


class PieceCodec:
    def __init__(self, path: str, viterbi: bool = True):
        """viterbi: search the best sum of scores whatever the model's kind."""
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            self.merges = not viterbi and sentencepiece_model_pb2.ModelProto.FromString(f.read()).trainer_spec.model_type == BPE
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes = np.zeros(256, np.int64)
        self.plain: list[bytes] = []
        least = 0.0
        self.inner_space = False
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.plain.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.plain.append(b"")
            else:
                score = model.get_score(i)
                least = min(least, score)
                self.inner_space |= SPACE in piece.lstrip(SPACE)
                self.automaton.add_word(piece, (len(piece), i, score))
                self.pieces[piece] = (-score, i)
                self.plain.append(piece.replace(SPACE, " ").encode())
        self.automaton.make_automaton()
        self.unknown = least - 10.0
        self.size = np.array([len(x) for x in self.plain], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.plain), np.uint8)
        self.kept: dict[bytes, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]

    def search(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text whose prefix is already there."""
        marked = text.replace(SPACE, "￿").replace(" ", SPACE)
        n = len(marked)
        best = [0.0] + [None] * n
        back: list = [None] * (n + 1)
        at = 0
        unknown = self.unknown
        for end, (size, piece, score) in self.automaton.iter(marked):
            end += 1
            while at < end - 1:  # positions without a piece of their own
                at += 1
                if best[at] is None or best[at - 1] + unknown > best[at]:
                    best[at], back[at] = best[at - 1] + unknown, (1, -1)
            total = best[end - size] + score
            if best[end] is None or total > best[end]:
                best[end], back[end] = total, (size, piece)
        while at < n:
            at += 1
            if best[at] is None or best[at - 1] + unknown > best[at]:
                best[at], back[at] = best[at - 1] + unknown, (1, -1)
        out: list[int] = []
        at = n
        while at:
            size, piece = back[at]
            if piece < 0:
                out += [int(self.bytes[b]) for b in reversed(text[at - 1].encode("utf-8", "surrogatepass"))]
            else:
                out.append(piece)
            at -= size
        return out[::-1]

    def merged(self, marked: str) -> list[int]:
        """Ends of the symbols that merging leaves of a text with U+2581 for spaces."""
        n, pieces = len(marked), self.pieces
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the symbol that starts at a place; end 0: none does
        heap = [(pieces[marked[i : i + 2]][0], i, i + 1, i + 2) for i in range(n - 1) if marked[i : i + 2] in pieces]
        heapify(heap)
        while heap:
            _, a, b, c = heappop(heap)
            if end[a] != b or end[b] != c:  # one of the two has merged since
                continue
            end[a], end[b], before[c] = c, 0, a
            if c < n and marked[a : end[c]] in pieces:
                heappush(heap, (pieces[marked[a : end[c]]][0], a, c, end[c]))
            if a and marked[before[a] : c] in pieces:
                heappush(heap, (pieces[marked[before[a] : c]][0], before[a], a, c))
        return [e for e in end if e]

    def _follows(self, last: int, piece: int) -> bool:
        """Whether merging leaves a last symbol (a piece, a character as a negative number, or 0 at the start) and a piece as they are."""
        before, after = "" if not last else self.text[last] if last > 0 else chr(-last), self.text[piece]
        return self.merged(before + after) == ([len(before)] if before else []) + [len(before) + len(after)]

    def chain(self, text: str) -> list[int]:
        """Ids by merges of a text whose prefix is already there: at each position the longest piece that may follow."""
        marked = text.replace(SPACE, "\uffff").replace(" ", SPACE)
        last, start = [0, *(-ord(c) for c in marked)], list(range(-1, len(marked)))
        pairs, follows, most = self.pairs, self._follows, len(self.text)
        done = 0
        for end, (size, piece, _) in self.automaton.iter(marked):
            if end < done:  # the position has its piece
                continue
            before = last[end + 1 - size]
            key = before * most + piece
            fits = pairs.get(key)
            if fits is None:
                if len(pairs) > PAIRS:
                    pairs.clear()
                fits = pairs[key] = follows(before, piece)
            if fits:
                done = end + 1
                last[done], start[done] = piece, done - size
        out: list[int] = []
        at = len(marked)
        while at:
            if last[at] > 0:
                out.append(last[at])
            else:
                out += [int(self.bytes[b]) for b in reversed(text[at - 1].encode("utf-8", "surrogatepass"))]
            at = start[at]
        return out[::-1]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """For ranges of rows: (first row, one past the last, all their ids, offsets of each row's ids)."""
        for a, b in runs(offsets, CHUNK):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            full = np.flatnonzero(np.diff(own) > 0)
            part = np.insert(part, own[full], 32)
            own = own + np.concatenate(([0], np.cumsum(np.diff(own) > 0)))
            if not len(part):
                yield a, b, np.zeros(0, np.int64), np.zeros(b - a + 1, np.int64)
                continue
            mark = np.zeros(len(part), bool)
            if not self.inner_space:
                mark[1:] = (part[1:] == 32) & (part[:-1] != 32)
            mark[own[full]] = True
            cuts = np.append(np.flatnonzero(mark), len(part)).astype(np.int64)
            coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(part)]).dictionary_encode()
            values = self._values(coded.dictionary.to_pylist())
            flat = np.frombuffer(b"".join(values), "<u4")
            size = np.fromiter(map(len, values), np.int64, len(values)) // 4
            start = np.cumsum(size) - size
            which = coded.indices.to_numpy(zero_copy_only=False)
            rows = np.searchsorted(cuts, own)
            for c, d in runs(own, CHUNK >> 1):
                w = which[rows[c] : rows[d]]
                n = size[w]
                ends = np.cumsum(n)
                ids = flat[np.repeat(start[w] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
                yield a + c, a + d, ids.astype(np.int64), np.concatenate(([0], ends))[rows[c : d + 1] - rows[c]]

    def _values(self, distinct: list[bytes]) -> list[bytes]:
        if len(self.kept) > KEPT:
            self.kept = {}
        find = self.chain if self.merges else self.search
        for x in distinct:
            if x not in self.kept:
                self.kept[x] = np.array(find(x.decode("utf-8")), "<u4").tobytes()
        return [self.kept[x] for x in distinct]

    def encode_text(self, text: str) -> list[int]:
        return (self.chain if self.merges else self.search)(" " + text) if text else []

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of a row's ids; the space that encoding put first is taken off."""
        size = self.size[ids]
        ends = np.cumsum(size)
        text = self.flat[np.repeat(self.start[ids] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        return text[1:] if text[:1] == b" " else text


def codec(path: str, viterbi: bool) -> PieceCodec:
    """The worker's codec for a model file."""
    if (path, viterbi) not in _codecs:
        _codecs[path, viterbi] = PieceCodec(path, viterbi)
    return _codecs[path, viterbi]


def forget() -> None:
    """Drop the runs that the worker's codecs have kept."""
    for x in _codecs.values():
        x.kept = {}


def _run(path: str, viterbi: bool):
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])

    def run(batches):
        own = codec(path, viterbi)
        for batch in batches:
            docs = batch.column(0)
            for a, b, ids, at in own.encode(*utf8(batch.column(1))):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                texts = [own.decode_bytes(ids[at[i] : at[i + 1]]).decode() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([docs.slice(a, b - a).cast(pa.int64()), lists, pa.array(texts)], schema=out)

    return run


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", viterbi: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, text decoded from them) of each row's whole text; a null or empty text has no ids.

    The ids are those of the best sum of scores, or with viterbi=False the model's own."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(lean(_run(path, viterbi), forget), "doc_id long, ids array<int>, text string")


def _digest(path: str):
    out = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])

    def run(batches):
        own = codec(path, False)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for a, b, ids, at in own.encode(data, offsets):
                parts = [ids[at[i] : at[i + 1]] for i in range(b - a)]
                same = [own.decode_bytes(x) == data[offsets[a + i] : offsets[a + i + 1]].tobytes() for i, x in enumerate(parts)]
                yield arrow_batch(out, doc_id=docs[a:b], n_pieces=[len(x) for x in parts], ids_crc32=[zlib.crc32(x.astype("<u4").tobytes()) for x in parts], round_trip=same)

    return run


def piece_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, ids_crc32 of the little-endian unsigned 32-bit ids, round_trip: whether decoding gives the text back).

    The ids are the model's own, as the library gives them."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(lean(_digest(path), forget), "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")
