"""Encoding whole texts with the tokenizers library, one call for every new piece of text rather than for every text.

A pre-tokenizer that never puts a character before white space and that white space into one token treats every run of
white space with the characters after it on its own; the same holds between a letter or digit and punctuation other than
an apostrophe. So a text's ids are those of its runs in order; each task keeps the ids of runs that it has met lately (two
generations of KEPT runs of SHORT bytes at most). Both public vocabularies in use are of that kind; the tests hold the
result against whole-text calls of the library.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from annolith.llm.common import runs, utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CHUNK = 1 << 20
SPACE = np.array([i == 32 or 9 <= i <= 13 for i in range(256)])
WORD = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
POINT = np.array([chr(i) in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" for i in range(256)])
INK = np.array([not (i == 32 or 9 <= i <= 13 or 28 <= i <= 31) for i in range(256)])
#: Last bytes of white space beyond ASCII, and first bytes of those of three bytes.
WIDE_LAST = np.array([i in (0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F) or 0x80 <= i <= 0x8A for i in range(256)])
WIDE_LEAD = np.array([i in (0xE1, 0xE2, 0xE3) for i in range(256)])
#: Runs of a generation, and bytes of a run that is kept.
KEPT, SHORT = 125_000, 64
JOINED = 64

_encoders: dict[str, "SegmentEncoder"] = {}


def _boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending places of all rows' starts and, within rows, of ASCII white space after a character that is none in any
    alphabet, and of ASCII punctuation but apostrophes after an ASCII letter or digit."""
    mark = np.zeros(len(data), bool)
    space = SPACE[data[1:]]
    mark[1:] = (space & INK[data[:-1]]) | (POINT[data[1:]] & WORD[data[:-1]])
    wide = np.flatnonzero(space & (data[:-1] >= 128)) + 1
    if len(wide):  # white space beyond ASCII: two bytes after C2, three after E1, E2 or E3
        last, mid, lead = data[wide - 1], data[np.maximum(wide - 2, 0)], data[np.maximum(wide - 3, 0)]
        mark[wide[WIDE_LAST[last] & ((mid == 0xC2) | WIDE_LEAD[lead])]] = False
    mark[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(mark)


class SegmentEncoder:
    """Ids of texts as unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.kept, self.older = {}, {}
        vocab = self.library.get_vocab()
        #: Whether tokens end words (else they start them, with the letter that stands for a space), and which ids do.
        self.ends = any(x.endswith("</w>") for x in vocab)
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        self.edge[[i for x, i in vocab.items() if (x.endswith("</w>") if self.ends else x.startswith("\u0120"))]] = True

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """For ranges of rows: (first row, one past the last, all their ids, where each row's ids end up: offsets)."""
        for a, b in runs(offsets, CHUNK):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            if not len(part):
                yield a, b, np.zeros(0, np.uint32), np.zeros(b - a + 1, np.int64)
                continue
            cuts = np.append(_boundaries(part, own), len(part))
            coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(part))]).dictionary_encode()
            values = self._values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())  # to_pylist goes by a scalar object each
            flat = np.frombuffer(b"".join(values), "<u4")
            size = np.fromiter(map(len, values), np.int64, len(values)) // 4
            start = np.cumsum(size) - size
            which = coded.indices.to_numpy(zero_copy_only=False)
            rows = np.searchsorted(cuts, own)
            for c, d in runs(own, CHUNK >> 1):
                w = which[rows[c] : rows[d]]
                n = size[w]
                ends = np.cumsum(n)
                total = int(ends[-1]) if len(ends) else 0
                ids = flat[np.repeat(start[w] - ends + n, n) + np.arange(total)]
                yield a + c, a + d, ids, np.concatenate(([0], ends))[rows[c : d + 1] - rows[c]]

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        out = []
        for a, b, ids, at in self.encode(*utf8(pa.array(texts, pa.large_string()))):
            out += [ids[at[i] : at[i + 1]].tolist() for i in range(b - a)]
        return out

    def _values(self, distinct: list[bytes]) -> list[bytes]:
        found = list(map(self.kept.get, distinct))
        for i in [i for i, v in enumerate(found) if v is None]:
            found[i] = self.older.get(distinct[i])
            if found[i] is not None:
                self.kept[distinct[i]] = found[i]
        miss = [i for i, v in enumerate(found) if v is None]
        new = [distinct[i] for i in miss]
        for i, x, v in zip(miss, new, self._learn(new), strict=True):
            found[i] = v
            if len(x) <= SHORT:
                self.kept[x] = v
        if len(self.kept) > KEPT:
            self.kept, self.older = {}, self.kept
        return found

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Ids of each run. Lists run alongside, as pairs in great numbers keep Python's collector of cycles at work."""
        texts = [x.decode("utf-8") for x in new]
        learnt = [b""] * len(new)
        is_plain = [t[0] == " " and t[1:].isalpha() for t in texts]
        plain, other = ([i for i, p in enumerate(is_plain) if p == kind] for kind in (True, False))
        for a in range(0, len(plain), JOINED):
            part = plain[a : a + JOINED]
            ids = np.array(self.library.encode_batch_fast(["".join([texts[i] for i in part])], add_special_tokens=False)[0].ids, "<u4")
            edge = np.flatnonzero(self.edge[ids]) + self.ends
            if len(edge) != len(part):
                other += part
                continue
            cuts = (np.append(0, edge) if self.ends else np.append(edge, len(ids))) * 4
            raw, cuts = ids.tobytes(), cuts.tolist()
            for i, c, d in zip(part, cuts, cuts[1:], strict=False):
                learnt[i] = raw[c:d]
        for a in range(0, len(other), 4096):
            part = other[a : a + 4096]
            for i, e in zip(part, self.library.encode_batch_fast([texts[i] for i in part], add_special_tokens=False), strict=True):
                learnt[i] = np.array(e.ids, "<u4").tobytes()
        return learnt


def encoder(path: str) -> SegmentEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = SegmentEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop the runs that the worker's encoders have kept."""
    for x in _encoders.values():
        x.kept, x.older = {}, {}
