"""Near-duplicate lines by a segment-partition edit join.

Two lines within edit distance t: if one is cut into t + 1 segments, one segment stands unchanged in
the other, near its own place. Every line is indexed by its segments under its length; it probes the
index of every length from its own down to t less with the substrings that may match there, at places
that leave enough errors for the rest. Lines that meet are verified by a bit-parallel automaton on
the band of 2 t + 1 diagonals. Distances are in characters (code points), and lines of every length
take part. Segments of short lines would be a character or two, which too many lines have: two lines of
SHORT characters or less meet if some characters, up to t of each, can be left out so that the same remains.
Many lines may share a passage and be far apart. An edit changes the numbers of characters of two classes at
most, an insertion or deletion of one, so lines that meet go on only if few parities of these numbers differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from invoicelake.llm.byte_words import mixed, prefix_hashes, spans_of, text_slices
from invoicelake.llm.graph import components
from invoicelake.llm.shared import BLANKS, named_apart, stored

ERRORS = 2
SHORT = 8  # characters of the lines that meet by what is left of them after deletions
CUT = 512  # characters from which it pays to take off common ends
LONG = 4096  # characters in which a pair must differ to be followed along its diagonals
PADDED = 1 << 20  # characters of the pairs that go through the automaton at a time
CLASSES = 25  # classes of characters, by the last byte, whose parities stand in a key
LOW = CLASSES + 1  # low bits of a key: one for a line that asks for shorter ones, then the parities
_CLASS = np.uint64(2) << (np.arange(256, dtype=np.uint64) % np.uint64(CLASSES))


def segment(length: np.ndarray, i: int, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of segment `i` of lines of these lengths; later segments take the rest."""
    size, rest = length // (errors + 1), length % (errors + 1)
    longer = errors + 1 - rest  # the first segment that is one longer
    return i * size + np.maximum(0, i - longer), size + (i >= longer)


def character_starts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each character, and the end; first character of each row, and the end)."""
    first = (data & 0xC0) != 0x80
    first[starts[starts < len(data)]] = True
    at = np.append(np.flatnonzero(first), len(data))
    return at, np.searchsorted(at, starts)


def parities(data: np.ndarray, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row a bit for each class of characters: whether their number is odd."""
    last = data if len(chars) > len(data) else data[chars[1:] - 1]
    out = np.bitwise_xor.reduceat(np.append(_CLASS[last], np.uint64(0)), starts[:-1])
    out[starts[1:] == starts[:-1]] = 0
    return out


def _keys(errors: int, probe: bool):
    """The keys under which a line is indexed or, with `probe`, looks for others.

    The upper 64 - LOW bits are a hash of what must be the same.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column("line").to_numpy()
            for row, data, starts in text_slices(batch.column("text")):
                chars, starts = character_starts(data, starts)
                sums = prefix_hashes(data)
                begin, length = starts[:-1], np.diff(starts)
                line = lines[row : row + len(length)]
                odd = parities(data, chars, starts)
                out = [_remains(sums, chars, begin, length, odd, line, errors)]
                part = length > (SHORT if probe else SHORT - errors)  # a longer line asks for shorter ones
                begin, length, odd, line = begin[part], length[part], odd[part], line[part]
                for i in range(errors + 1):
                    if not probe:
                        at, size = segment(length, i, errors)
                        out.append(_rows(sums, chars, begin + at, size, length, i, odd, line))
                        continue
                    for less in range(errors + 1):
                        # Places that leave errors enough before and behind the segment.
                        low, high = max(-i, less - (errors - i)), min(i, less + errors - i)
                        aim, size = segment(length - less, i, errors)
                        for shift in range(low, high + 1):
                            place = aim + shift
                            fits = (place >= 0) & (place + size <= length) & (length > less)
                            out.append(_rows(sums, chars, (begin + place)[fits], size[fits],
                                             (length - less)[fits], i, (odd | (less > 0))[fits], line[fits]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out)],
                    names=["key", "line"])

    return run


def _key(same, odd):
    return (same >> np.uint64(LOW) << np.uint64(LOW) | odd).view(np.int64)


def _remains(sums, chars, begin, length, odd, line, errors):
    """Keys of the short lines: what remains of each after up to `errors` deletions."""
    keys, rows = [np.zeros(0, np.int64)], [line[:0]]
    for size in range(1, SHORT + 1):
        some = np.flatnonzero(length == size)
        if not len(some):
            continue
        each = [spans_of(sums, chars[begin[some] + p], chars[begin[some] + p + 1]) for p in range(size)]
        remains = []
        for left in range(max(0, size - errors), size + 1):
            for places in combinations(range(size), left):
                key = np.full(len(some), left + 1, np.uint64)
                for p in places:
                    key = mixed(key * np.uint64(3) ^ each[p])
                remains.append(key)
        remains = np.sort(np.stack(remains), axis=0)
        new = np.ones(remains.shape, bool)
        new[1:] = remains[1:] != remains[:-1]
        keys.append(_key(remains, odd[some])[new])
        rows.append(np.broadcast_to(line[some], remains.shape)[new])
    return np.concatenate(keys), np.concatenate(rows)


def _rows(sums, chars, begin, size, length, i, odd, line):
    salt = mixed(length.astype(np.uint64) * np.uint64(64) + np.uint64(i))
    return _key(mixed(spans_of(sums, chars[begin], chars[begin + size]) ^ salt), odd), line


def _characters(text: bytes) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text, np.uint8)
    points = text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(points, np.int32)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many characters two texts have in common at their beginning."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        upto = min(at + step, n)
        differ = x[at:upto] != y[at:upto]
        if differ.any():
            return at + int(differ.argmax())
        at, step = upto, min(4 * step, PADDED)
    return n


def within(pairs: list[tuple[bytes, bytes]], errors: int) -> np.ndarray:
    """Whether each pair of UTF-8 texts is within `errors` edits of characters.

    What a pair of over CUT characters has in common at both ends is taken off, which does not change
    its distance. What is left goes through the automaton, many pairs at a time, up to PADDED characters with the padding;
    pairs of which more than LONG characters are left are followed along their diagonals, alone.
    """
    out = np.zeros(len(pairs), dtype=bool)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]))
    for at in range(0, len(order), 512):
        cores = []
        for k in order[at : at + 512]:
            x, y = _characters(pairs[k][0]), _characters(pairs[k][1])
            if abs(len(x) - len(y)) > errors:
                continue
            if len(y) > CUT:
                same = _common(x, y)
                x, y = x[same:], y[same:]
                same = _common(x[::-1], y[::-1])
                x, y = x[: len(x) - same], y[: len(y) - same]
            if len(x) == 0 or len(y) == 0:
                out[k] = max(len(x), len(y)) <= errors
            elif len(y) > LONG:
                out[k] = _along_diagonals(x, y, errors)
            else:
                cores.append((k, x, y))
        cores.sort(key=lambda core: len(core[2]))
        begin = 0
        for end in range(1, len(cores) + 1):
            if end == len(cores) or (end + 1 - begin) * len(cores[end][2]) > PADDED:
                out[[k for k, _, _ in cores[begin:end]]] = _automaton([c[1:] for c in cores[begin:end]], errors)
                begin = end
    return out


def _along_diagonals(x: np.ndarray, y: np.ndarray, errors: int) -> bool:
    """Whether two long texts are within `errors` edits: on each diagonal of the band, how far one can
    get with so many edits, equal stretches being compared as a whole."""
    goal = len(y) - len(x)
    reach = {0: _common(x, y)}
    for e in range(errors + 1):
        if reach.get(goal) == len(x):
            return True
        further = {}
        for d in range(-e - 1, e + 2):  # y is d characters ahead
            tries = [reach[d] + 1] if d in reach else []
            tries += [reach[d - 1]] if d - 1 in reach else []
            tries += [reach[d + 1] + 1] if d + 1 in reach else []
            i = min(max(tries, default=-1), len(x), len(y) - d)
            if i >= 0 and i + d >= 0:
                further[d] = i + _common(x[i:], y[i + d :])
        reach = further
    return False


def _automaton(read: list[tuple[np.ndarray, np.ndarray]], errors: int) -> np.ndarray:
    """The same for texts as characters, padded to the longest.

    Bit d of a state says that the text read so far matches the other one up to d - errors more
    characters; there is a state for each number of errors, and all pairs take a step together.
    """
    steps = max(len(y) for _, y in read)
    a = np.zeros((len(read), steps + 3 * errors + 1), dtype=np.int32) - 1
    b = np.zeros((len(read), steps), dtype=np.int32) - 2
    for r, (x, y) in enumerate(read):
        x = x[: steps + 2 * errors]
        a[r, errors : errors + len(x)] = x
        b[r, : len(y)] = y
    gap = np.array([len(x) - len(y) for x, y in read])
    ends = np.array([len(y) for _, y in read])
    mask = (1 << (2 * errors + 1)) - 1
    states = [np.full(len(read), ((1 << (e + 1)) - 1) << errors, np.int64) for e in range(errors + 1)]
    good = (ends == 0) & (np.abs(gap) <= errors)
    for j in range(steps):
        match = np.zeros(len(read), dtype=np.int64)
        for d in range(2 * errors + 1):
            match |= (a[:, j + d] == b[:, j]).astype(np.int64) << d
        new = [states[0] & match]
        for e in range(1, errors + 1):
            less = states[e - 1]
            new.append(((states[e] & match) | less | (less >> 1) | (new[-1] << 1)) & mask)
        states = new
        done = ends == j + 1
        if done.any():
            hit = (states[errors] >> np.clip(gap + errors, 0, 2 * errors)) & 1
            good |= done & (np.abs(gap) <= errors) & (hit == 1)
    return good


def _verified(errors: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("ta").cast(pa.binary()), batch.column("tb").cast(pa.binary()))
            good = within([(x.as_py(), y.as_py()) for x, y in texts], errors)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def line_links(docs: DataFrame, errors: int = ERRORS) -> DataFrame:
    """(a, b): hashes of different lines within `errors` edits of each other."""
    return stored(_links(docs, errors))


def _links(docs: DataFrame, errors: int) -> DataFrame:
    # Each line once, known by its hash. The texts are shuffled by it this one time and not stored: keys
    # and pairs all read the same exchange.
    lines = _lines(docs).select("line", "text").dropDuplicates(["line"])
    side = lambda name: lines.select(
        F.col("line").alias(name), F.col("text").alias(f"t{name}"))
    return (
        _met(lines, errors).distinct().join(side("a"), "a").join(side("b"), "b")
        .select("a", "b", "ta", "tb").mapInArrow(_verified(errors), "a bigint, b bigint"))


def _met(lines: DataFrame, errors: int) -> DataFrame:
    """(a, b): pairs of lines with a common key, some repeated."""
    keys = lambda probe, name: lines.mapInArrow(
        _keys(errors, probe), "key bigint, line bigint").withColumnsRenamed(
        {"key": f"key_{name}", "line": name})
    met = keys(False, "x").join(
        keys(True, "y"), F.shiftright("key_x", LOW) == F.shiftright("key_y", LOW)
    ).filter(f"bit_count((key_x ^ key_y) & {2 * ((1 << CLASSES) - 1)}) <= {2 * errors} - (key_y & 1)").filter(
        # Lines of one length, and short lines, have the same keys on both sides: each pair of
        # them is taken one way round.
        "x < y OR key_y & 1 = 1")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _lines(docs: DataFrame, *keep: str) -> DataFrame:
    """`keep`, at, text and line (its hash) of the lines with a word."""
    return docs.select(*keep, F.posexplode(F.split("text", "\n")).alias("at", "text")).filter(
        F.col("text").rlike(f"[^{BLANKS}]")).withColumn("line", F.xxhash64("text"))


def line_dedup(docs: DataFrame, errors: int = ERRORS, key: str = "doc_id") -> DataFrame:
    """(key, n_lines, n_linked, n_links, n_removed, lines): one row per different row of `docs`.

    Lines are classed by edit distance up to `errors` characters, whatever their length, over any
    number of steps. Of `n_lines` with a word, `n_linked` have a different near copy,
    `n_links` counts these near copies, and `n_removed` are not the first of their class (first by
    key, null last, then text hash and place). `lines` has (at, line, class, kept) of each line.
    Null and empty texts have no lines; repeated rows count once. An empty table gives an empty
    table; columns other than `key` and `text` are not read.
    """
    named_apart(docs, key, "text")
    slim = docs.select(F.col(key).alias("id"), "text", F.xxhash64("text").alias("th"))
    links = line_links(slim, errors)
    roots = components(links)
    degrees = links.select(F.explode(F.array("a", "b")).alias("line")).groupBy("line").agg(
        F.count("*").alias("links"))
    places = stored(_lines(slim, "id", "th").select("id", "th", "at", "line").distinct())
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "at")
    near = degrees.join(roots.withColumnRenamed("node", "line"), "line")
    # One value per line and class: a line that a third of all texts share is summed in parts. A line
    # that stands once and has no near copy stays, and is a class of its own; only the others go on.
    shared = stored(
        places.groupBy("line").agg(F.min(order).alias("line_first"), F.max(order).alias("line_last"))
        .join(near, "line", "left").filter("links IS NOT NULL OR line_first <> line_last")
        .select("line", F.coalesce("root", "line").alias("root"), "links", "line_first"))
    firsts = shared.groupBy("root").agg(F.min("line_first").alias("first"))
    per_line = shared.join(firsts, "root").select("line", "root", "links", "first")
    judged = places.join(per_line, "line", "left").select(
        "id", "th", "at", "line", F.coalesce("root", "line").alias("root"), F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce(order == F.col("first"), F.lit(True)).alias("kept"))
    per_doc = judged.groupBy("id", "th").agg(
        F.count("*").alias("n_lines"), F.count_if(F.col("links") > 0).alias("n_linked"),
        F.sum("links").alias("n_links"), F.count_if(~F.col("kept")).alias("n_removed"),
        F.sort_array(F.collect_list(F.struct("at", "line", F.col("root").alias("class"), "kept")))
        .alias("lines"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return slim.select("id", "th").distinct().alias("d").join(
        per_doc.withColumnsRenamed({"id": "_id", "th": "_th"}),
        F.expr("th = _th AND id <=> _id"), "left",
    ).select(F.col("id").alias(key), zero("n_lines"), zero("n_linked"), zero("n_links"),
             zero("n_removed"), "lines")
