"""Chroma fingerprints of recordings, and alignment of recordings that share audio.

Frames of FRAME samples, HOP apart, give energies of the twelve pitch classes, each frame scaled to unit length. Sixteen
filters compare sums of rectangles of the frame-by-class image, read off its integral image; each result is quantised to two
bits (Gray code), which makes one 32-bit integer for each window of frames. Frames overlap by seven eighths, so that excerpts
that start between frames still have few wrong bits and many equal integers. Recordings with equal prints form a class.

Search: the integers of windows LAG apart are a key of 64 bits; of a run of equal keys the first counts. Windows of a key that more
than HOT share are dealt into tiles of about HOT by HOT, and all of them meet. Keys of queries meet those of classes in a join; its rows, counted by pair
and offset, are the offset histograms. At each offset with a hit the bits are compared exactly: pairs align where at most
MAX_ERROR of them are wrong over MIN_OVERLAP windows or more, and the offset with most equal integers is reported.

Without the index (exact=True) every query's class is compared with every class at every offset: bits as +1 and -1, correlated
over frequencies of their 32 channels, give a pair's agreeing bits over all offsets at once. That work grows with classes times
queries and is what the tests hold the index against.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import arrow_batch, cut, groups, lean

RATE, FRAME, HOP = 4000, 1024, 128
WINDOW = 32
#: Least windows of an alignment (as many seconds as 16 frames without overlap), and the share of its bits that may be wrong:
#: excerpts that start anywhere have 2.7% on average and 6.2% at most, under noise of 0.4; unrelated tunes 20% or more.
MIN_OVERLAP, MAX_ERROR = 64, 0.15
#: Windows between a key's two integers, and windows that share a key from which on they are dealt into tiles.
LAG, HOT = 8, 4096
#: Frames that are transformed at once.
FRAMES_AT_ONCE = 1 << 13
#: Bytes of prints in a block, and numbers of a correlation that are held at once.
CLASS_BLOCK, QUERY_BLOCK, CELLS = 1 << 18, 1 << 18, 1 << 22
MOST_TASKS = 4096
#: Transforms up to this size go back by a matrix product, which is faster there.
SHORT = 512
NOTE = 512


def _filters() -> list[tuple[int, int, int, int]]:
    """(shape, first class, classes, frames): four shapes by four places and sizes, by a rule."""
    return [(shape, (3 * i + 2 * shape) % (12 - h + 1), h, w) for shape in range(4) for i, (h, w) in enumerate(((4, 32), (6, 16), (8, 24), (12, 32)))]


def chroma(samples: np.ndarray) -> np.ndarray:
    """(recordings, frames, 12) of recordings of equal length, (recordings, samples)."""
    n = (samples.shape[1] - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((len(samples), 0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME, axis=1)[:, ::HOP][:, :n]
    shape = np.hanning(FRAME).astype(np.float32)
    hertz = np.arange(FRAME // 2 + 1) * RATE / FRAME
    use = (hertz >= 60) & (hertz <= 1900)
    classes = np.round(12 * np.log2(hertz[use] / 440.0)).astype(int) % 12
    to = np.zeros((use.sum(), 12), np.float32)
    to[np.arange(len(classes)), classes] = 1
    step = max(1, FRAMES_AT_ONCE // len(samples))
    sums = np.concatenate([(np.abs(np.fft.rfft(frames[:, a : a + step] * shape, axis=2)) ** 2)[:, :, use] @ to for a in range(0, n, step)], axis=1)
    size = np.linalg.norm(sums, axis=2, keepdims=True)
    return np.where(size > 1e-6, sums / np.maximum(size, 1e-6), 0.0)


def prints(samples: np.ndarray) -> np.ndarray:
    """(recordings, windows) packed 32-bit integers; recordings shorter than a window of frames have none."""
    image = chroma(samples)
    r, n, _ = image.shape
    windows = max(0, n - WINDOW + 1)
    total = np.zeros((r, n + 1, 13))
    total[:, 1:, 1:] = image.cumsum(axis=1).cumsum(axis=2)

    def box(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        a, b = slice(t0, t0 + windows), slice(t1, t1 + windows)
        return total[:, b, c1] - total[:, a, c1] - total[:, b, c0] + total[:, a, c0]

    out = np.zeros((r, windows), np.uint32)
    for shape, c, h, w in _filters():
        whole = box(0, w, c, c + h)
        if shape == 0:
            part = box(0, w // 2, c, c + h)
        elif shape == 1:
            part = box(0, w, c, c + h // 2)
        elif shape == 2:
            part = box(0, w // 2, c, c + h // 2) + box(w // 2, w, c + h // 2, c + h)
        else:
            part = box(w // 4, w - w // 4, c, c + h)
        ratio = np.log1p(part) - np.log1p(np.maximum(whole - part, 0))
        level = np.digitize(ratio, (-0.25, 0.0, 0.25)).astype(np.uint32)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))
    return out


def sonify(vectors: np.ndarray) -> np.ndarray:
    """A tune for each vector: every component is a note of NOTE samples, its pitch the component in steps of a sixth of 1/8."""
    t = np.arange(NOTE) / RATE
    scale = 440.0 * 2 ** ((np.arange(37) - 27) / 12)
    notes = np.stack([np.sin(2 * np.pi * f * t) + 0.5 * np.sin(4 * np.pi * f * t) for f in scale]).astype(np.float32)
    pitch = np.clip(np.round(np.nan_to_num(vectors) * 48), -18, 18).astype(int) + 18
    return notes[pitch].reshape(len(vectors), -1)


def _vector_prints(batches):
    out = pa.schema([("id", pa.int64()), ("print", pa.binary())])
    for batch in batches:
        ids, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        found: list[bytes] = [b""] * len(ids)
        sizes: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            sizes.setdefault(len(v or []), []).append(i)
        for size, rows in sizes.items():
            for a in range(0, len(rows) if size else 0, 16):
                part = rows[a : a + 16]
                got = prints(sonify(np.array([[x or 0.0 for x in vectors[i]] for i in part], np.float32)))
                for i, p in zip(part, got, strict=True):
                    found[i] = p.astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], schema=out)


def _pcm_prints(batches):
    out = pa.schema([("id", pa.int64()), ("print", pa.binary())])
    for batch in batches:
        pcm = [np.frombuffer(x or b"", "<i2", len(x or b"") // 2).astype(np.float32) / 32768 for x in batch.column(1).to_pylist()]
        found = [prints(x[None, :])[0].astype("<u4").tobytes() for x in pcm]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found, pa.binary())], schema=out)


def recording_prints(recordings: DataFrame, id_col: str, pcm_col: str) -> DataFrame:
    """(id, print) of recordings: 16-bit little-endian mono samples at RATE; print: little-endian 32-bit integers, empty for null or short audio."""
    return recordings.select(F.col(id_col).cast("long"), pcm_col).mapInArrow(lean(_pcm_prints), "id long, print binary")


def vector_prints(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, print) of the tunes of vectors; a null or empty vector has an empty print."""
    return vectors.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<float>")).mapInArrow(lean(_vector_prints), "id long, print binary")


def bit_errors(x: np.ndarray, y: np.ndarray, offset: int) -> tuple[int, int]:
    """Bits that differ and bits compared when x[i] meets y[i + offset]."""
    a, b = max(0, -offset), min(len(x), len(y) - offset)
    return (int(np.bitwise_count(x[a:b] ^ y[a + offset : b + offset]).sum()), 32 * (b - a)) if b > a else (0, 0)


def _fast_size(n: int) -> int:
    """The least 2^a or 3 * 2^a that is n or more."""
    two = 1 << max(0, n - 1).bit_length()
    return two * 3 // 4 if n <= two * 3 // 4 and two >= 4 else two


def _spectra(p: list[np.ndarray], size: int) -> np.ndarray:
    """(frequencies, prints, 32) of the bits as +1 and -1, zero after a print's end."""
    signs = np.zeros((len(p), size, 32), np.float32)
    for i, x in enumerate(p):
        signs[i, : len(x)] = np.unpackbits(np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(len(x), 4), axis=1).astype(np.float32) * 2 - 1
    return np.fft.rfft(signs, axis=1).transpose(1, 0, 2)


def _count(x: np.ndarray, y: np.ndarray, own: np.ndarray, other: np.ndarray, offset: np.ndarray, n: np.ndarray, m: np.ndarray):
    """Equal integers, bits that differ and bits compared of (own row of x, other row of y, offset), n and m their lengths."""
    hits, errors, bits = (np.zeros(len(own), np.int64) for _ in range(3))
    order = np.lexsort((m, n, offset))
    key = np.stack([offset[order], n[order], m[order]])
    edges = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if len(order) else np.zeros(0, np.int64)
    for i, j in zip(edges, np.append(edges[1:], len(order)), strict=False):
        o, size, most = (int(v) for v in key[:, i])
        a, b = max(0, -o), min(size, most - o)
        for part in np.array_split(order[i:j], -(-(j - i) * (b - a) // CELLS)):
            differ = x[own[part], a:b] ^ y[other[part], a + o : b + o]
            hits[part], errors[part], bits[part] = (differ == 0).sum(axis=1), np.bitwise_count(differ).sum(axis=1, dtype=np.int64), 32 * (b - a)
    return hits, errors, bits


def _inverse(lags: np.ndarray, size: int) -> np.ndarray:
    """(lags, 2 * frequencies) of cosines and sines: what a cross spectrum's real and imaginary parts add to a lag."""
    f = np.arange(size // 2 + 1)
    weight = np.where((f == 0) | (2 * f == size), 1.0, 2.0) / size
    angle = 2 * np.pi / size * np.outer(lags, f)
    return np.stack([weight * np.cos(angle), -weight * np.sin(angle)], axis=2).reshape(len(lags), -1).astype(np.float32)


def _parts(theirs: np.ndarray) -> np.ndarray:
    """(frequencies, 2, 64, prints): what real and imaginary parts of a query's spectrum are multiplied with for those of the cross spectrum."""
    re, im = theirs.real.transpose(0, 2, 1), theirs.imag.transpose(0, 2, 1)
    return np.stack([np.concatenate([re, im], axis=1), np.concatenate([im, -re], axis=1)], axis=1)


def _sums(ours: np.ndarray, theirs: np.ndarray, lags: np.ndarray, size: int, back: np.ndarray | None) -> np.ndarray:
    """(lags, pairs): bits that agree less bits that differ. Short prints (theirs: _parts) go back from frequencies by one product, long ones by a transform."""
    if back is not None:
        cross = np.matmul(np.concatenate([ours.real, ours.imag], axis=2)[:, None], theirs)
        return back @ cross.reshape(2 * len(ours), -1)
    cross = np.matmul(ours.conj(), theirs.transpose(0, 2, 1)).reshape(len(ours), -1)
    return np.ascontiguousarray(np.fft.irfft(np.ascontiguousarray(cross.T), size, axis=1)[:, lags % size].T)


def alignments(queries: list[np.ndarray], prints: list[np.ndarray]):
    """Yields (query numbers, print numbers, offsets, hits, bit errors, bits): for each pair that aligns its best offset."""
    by = [{}, {}]
    for side, group in zip((queries, prints), by, strict=True):
        for i, p in enumerate(side):
            if len(p) >= MIN_OVERLAP:
                group.setdefault(_fast_size(len(p)), []).append(i)
    for rows, cols in ((a, b) for a in by[0].values() for b in by[1].values()):
        longest, widest = max(len(queries[i]) for i in rows), max(len(prints[i]) for i in cols)
        size = _fast_size(longest + widest - MIN_OVERLAP)
        lag = np.arange(MIN_OVERLAP - longest, widest - MIN_OVERLAP + 1)
        back = _inverse(lag, size) if size <= SHORT else None
        noise = 0.5 + 1e-4 * size
        wide = max(1, CELLS // (32 * size))
        for c in (cols[i : i + wide] for i in range(0, len(cols), wide)):
            theirs = _spectra([prints[i] for i in c], size)
            theirs = theirs if back is None else _parts(theirs)
            m = np.array([len(prints[i]) for i in c])
            y = np.stack([np.pad(prints[i], (0, widest - len(prints[i]))) for i in c])
            high = max(1, CELLS // (size * len(c)))
            for r in (rows[i : i + high] for i in range(0, len(rows), high)):
                n = np.array([len(queries[i]) for i in r])
                x = np.stack([np.pad(queries[i], (0, longest - len(queries[i]))) for i in r])
                sums = _sums(_spectra([queries[i] for i in r], size), theirs, lag, size, back)
                (ns, which_n), (ms, which_m) = (np.unique(v, return_inverse=True) for v in (n, m))
                over = np.minimum(ns[:, None, None], ms[:, None] - lag) - np.maximum(0, -lag)
                least = np.where(over >= MIN_OVERLAP, 32 * (1 - 2 * MAX_ERROR) * over - noise, np.inf).astype(np.float32).reshape(-1, len(lag)).T
                if least.shape[1] > 1:
                    least = least[:, (which_n[:, None] * len(ms) + which_m).reshape(-1)]
                at, pair = np.divmod(np.flatnonzero((sums >= least).ravel()), sums.shape[1])
                own, other, offset = pair // len(c), pair % len(c), lag[at]
                hits, errors, bits = _count(x, y, own, other, offset, n[own], m[other])
                good = np.flatnonzero(errors <= MAX_ERROR * bits)
                good = good[np.lexsort((offset[good], np.abs(offset[good]), errors[good] / bits[good], -hits[good], pair[good]))]
                good = good[np.append(True, pair[good][1:] != pair[good][:-1])] if len(good) else good
                yield np.array(r)[own[good]], np.array(c)[other[good]], offset[good], hits[good], errors[good], bits[good]


def _blocks(batches):
    out = pa.schema([("query_class", pa.int64()), ("match_class", pa.int64()), ("offset", pa.int32()), ("hits", pa.int64()), ("bit_errors", pa.int64()), ("bits", pa.int64())])
    for _, t in groups(batches, ["class_block", "query_block"]):
        is_query, ids = (t.column(c).to_numpy() for c in ("is_query", "class_id"))
        p = [np.frombuffer(x, "<u4") for x in t.column("print").to_pylist()]
        asked, known = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        for q, c, offset, hits, errors, bits in alignments([p[i] for i in asked], [p[i] for i in known]):
            query, match = ids[asked[q]], ids[known[c]]
            other = query != match
            yield arrow_batch(out, query_class=query[other], match_class=match[other], offset=offset[other], hits=hits[other], bit_errors=errors[other], bits=bits[other])


def print_keys(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, windows): each window's integer with that LAG further on, at the first of a run of equal keys."""
    n = len(p) - LAG
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = p[:n].astype(np.uint64) << np.uint64(32) | p[LAG:].astype(np.uint64)
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[at], at


def _keys(batches):
    out = pa.schema([("class_id", pa.int64()), ("asked", pa.int32()), ("key", pa.int64()), ("at", pa.int32())])
    for batch in batches:
        found = [print_keys(np.frombuffer(x, "<u4")) for x in batch.column("print").to_pylist()]
        size = np.array([len(k) for k, _ in found], np.int64)
        if size.sum():
            key, at = (np.concatenate([f[i] for f in found]) for i in range(2))
            each = lambda c: np.repeat(batch.column(c).to_numpy(), size)
            yield arrow_batch(out, class_id=each("class_id"), asked=each("asked"), key=key.view(np.int64), at=at)


def _verified(batches):
    """The best of each pair's offsets, if it aligns there."""
    out = pa.schema([("query_class", pa.int64()), ("match_class", pa.int64()), ("offset", pa.int32()), ("hits", pa.int64()), ("bit_errors", pa.int64()), ("bits", pa.int64())])
    for batch in batches:
        found = []
        for q, c, offsets, x, y in zip(*(batch.column(k).to_pylist() for k in ("query_class", "match_class", "offsets", "query_print", "print")), strict=True):
            x, y, best = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), None
            for o in offsets:
                a, b = max(0, -o), min(len(x), len(y) - o)
                if b - a >= MIN_OVERLAP:
                    differ = x[a:b] ^ y[a + o : b + o]
                    hits, errors, bits = int((differ == 0).sum()), int(np.bitwise_count(differ).sum()), 32 * (b - a)
                    if errors <= MAX_ERROR * bits:
                        now = (-hits, errors / bits, abs(o), o, errors, bits)
                        best = now if best is None or now < best else best
            if best:
                found.append((q, c, best[3], -best[0], best[4], best[5]))
        if found:
            yield arrow_batch(out, **dict(zip(out.names, zip(*found, strict=True), strict=True)))


def _met(classes: DataFrame, hot: int) -> DataFrame:
    """Alignments of query classes with other classes that share a key: (query_class, match_class, offset, hits, bit_errors, bits)."""
    keys = cut(classes.mapInArrow(lean(_keys), "class_id long, asked int, key long, at int"), "keys")
    columns = lambda df: (df.where("asked = 1").select("key", F.col("class_id").alias("query_class"), F.col("at").alias("here")), df.select("key", F.col("class_id").alias("match_class"), F.col("at").alias("there")))
    offset = lambda df: df.where("query_class <> match_class").select("query_class", "match_class", (F.col("there") - F.col("here")).alias("offset"))
    common = keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("asked").alias("n_asked")).where(F.col("n") > hot)
    common = cut(common.select("key", *(F.ceil(F.col(n) / max(hot, 1)).cast("int").alias(to) for n, to in (("n_asked", "rows"), ("n", "cols")))), "hot")
    if common.isEmpty():
        ours, theirs = columns(keys)
        met = offset(ours.join(theirs, "key"))
    else:
        ours, theirs = columns(keys.join(common.select("key"), "key", "left_anti"))
        met = offset(ours.join(theirs, "key"))
        ours, theirs = columns(keys.join(common.where("rows > 0"), "key", "left_semi"))
        tile = lambda own, n: F.expr(f"pmod(xxhash64({own}), {n})").cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        ours = ours.join(common, "key").select("key", "query_class", "here", tile("query_class, here", "rows").alias("row"), every("cols").alias("col"))
        theirs = theirs.join(common, "key").select("key", "match_class", "there", every("rows").alias("row"), tile("match_class, there", "cols").alias("col"))
        met = met.unionByName(offset(ours.join(theirs, ["key", "row", "col"])))
    pairs = met.groupBy("query_class", "match_class").agg(F.collect_set("offset").alias("offsets"))
    pairs = pairs.join(classes.select(F.col("class_id").alias("query_class"), F.col("print").alias("query_print")), "query_class")
    pairs = pairs.join(classes.select(F.col("class_id").alias("match_class"), "print"), "match_class")
    return pairs.select("query_class", "match_class", "offsets", "query_print", "print").mapInArrow(lean(_verified), "query_class long, match_class long, offset int, hits long, bit_errors long, bits long")


def align(rows: DataFrame, is_query, exact: bool = False, hot: int = HOT) -> DataFrame:
    """(query_id, class_id, match_class, offset, hits, bit_errors, bits) for prints (id, print).

    For every query row: its class and each other class that aligns with it, and a row with null match where none does. A
    class's number is its smallest id. Empty prints, and rows without id, align with nothing; repeated rows count once. exact: by whole
    comparison in place of the index."""
    queries, found = _aligned(rows, is_query, exact, hot)
    return queries.join(found, F.col("class_id") == F.col("query_class"), "left").select("query_id", "class_id", "match_class", "offset", "hits", "bit_errors", "bits")


def identify(rows: DataFrame, is_query, exact: bool = False, hot: int = HOT) -> DataFrame:
    """(query_id, class_id, n_matches, match_class, offset, hits, bit_errors, bits): one row for each query row of prints (id, print).

    n_matches: how many other classes align with the query's; the rest is of that with the least share of wrong bits, then the
    longest, then the smallest number, and null where none aligns. Else as align, of which this is the summary."""
    queries, found = _aligned(rows, is_query, exact, hot)
    best = F.min(F.struct((F.col("bit_errors") / F.col("bits")).alias("share"), (-F.col("bits")).alias("short"), "match_class", "offset", "hits", "bit_errors", "bits")).alias("best")
    best = found.groupBy("query_class").agg(F.count("*").alias("n_matches"), best)
    out = queries.join(best, F.col("class_id") == F.col("query_class"), "left")
    return out.select("query_id", "class_id", F.coalesce("n_matches", F.lit(0)).alias("n_matches"), *(F.col(f"best.{c}").alias(c) for c in ("match_class", "offset", "hits", "bit_errors", "bits")))


def _aligned(rows: DataFrame, is_query, exact: bool, hot: int) -> tuple[DataFrame, DataFrame]:
    """(query rows with their class, alignments of query classes with other classes)."""
    own = cut(rows.where("id is not null").distinct(), "prints")
    classes = cut(own.where(F.octet_length("print") > 0).groupBy("print").agg(F.min("id").alias("class_id"), F.max(F.when(is_query, 1).otherwise(0)).alias("asked")), "classes")
    queries = own.where(is_query).join(classes.select("print", "class_id"), "print", "left").select(F.col("id").alias("query_id"), F.coalesce("class_id", "id").alias("class_id"))
    if not exact:
        return queries, _met(classes, hot)
    bytes_, asked = classes.agg(F.sum(F.octet_length("print")), F.sum(F.octet_length("print") * F.col("asked"))).first()
    n_classes, n_queries = (max(1, -(-(x or 0) // block)) for x, block in ((bytes_, CLASS_BLOCK), (asked, QUERY_BLOCK)))
    block = lambda n: F.expr(f"pmod(xxhash64(print), {n})")
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    left = classes.select("class_id", "print", F.lit(False).alias("is_query"), block(n_classes).alias("class_block"), every(n_queries).alias("query_block"))
    right = classes.where("asked = 1").select("class_id", "print", F.lit(True).alias("is_query"), every(n_classes).alias("class_block"), block(n_queries).alias("query_block"))
    dealt = left.unionByName(right).repartition(min(n_classes * n_queries, MOST_TASKS), "class_block", "query_block").sortWithinPartitions("class_block", "query_block")
    found = dealt.mapInArrow(lean(_blocks), "query_class long, match_class long, offset int, hits long, bit_errors long, bits long")
    return queries, found
