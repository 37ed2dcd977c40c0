"""Fill-in-middle: texts cut into prefix, middle and suffix, put in another order, and restored.

Displacement scatter. A batch's texts lie one after another in one byte array. A scan marks where
tokens start; the cuts are the starts of the drawn tokens, found through counts per block. Each cut
adds a jump to a difference array; its running sum gives every byte its shift to the output, and one
numpy scatter writes all outputs of a batch. ``restore`` finds the sentinels in an output, which give
the same jumps, and gathers the bytes back. Running sums are taken in strides of ``STRIDE`` bytes with
the sum carried on, so beside the bytes of a batch (which Spark bounds) memory holds one stride.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Marks of the three parts; a text that has one stays as it is.
SENTINELS = ("<P>", "<S>", "<M>")
#: Out of a hundred: texts that are rearranged, and of these the ones with the suffix first.
RATE = 90
SPM = 20
#: Bytes whose shifts are computed at a time, and bytes per count in the scan for cuts.
STRIDE = 1 << 20
BLOCK = 1 << 12
PLAIN, PSM, SPM_FORM = "plain", "psm", "spm"
#: Order of prefix (0), middle (1) and suffix (2) in each form, and the sentinel before each part.
ORDER = {PSM: (0, 2, 1), SPM_FORM: (2, 0, 1)}
MARK = [word.encode() for word in (SENTINELS[0], SENTINELS[2], SENTINELS[1])]
WIDTH = 3

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
#: Bytes that begin a code point.
_FIRST = (np.arange(256) & 0xC0) != 0x80


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text after another, and their len + 1 ends; no nulls."""
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


class Marks:
    """Counts and places of set flags, through one number per block."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags
        starts = np.arange(0, len(flags), BLOCK)
        counts = np.add.reduceat(flags, starts, dtype=np.int64) if len(flags) else starts
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def rank(self, at: int) -> int:
        """Flags before a place."""
        block = at // BLOCK
        return int(self.before[block]) + int(np.count_nonzero(self.flags[block * BLOCK : at]))

    def select(self, k: int) -> int:
        """Place of the flag with k flags before it; the end, where there is none."""
        if k >= self.before[-1]:
            return len(self.flags)
        block = int(np.searchsorted(self.before, k, side="right")) - 1
        inside = np.flatnonzero(self.flags[block * BLOCK : (block + 1) * BLOCK])
        return block * BLOCK + int(inside[k - self.before[block]])


def token_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags: a run of letters, or any other code point, begins here."""
    letter = _LETTER[data]
    starts = _FIRST[data]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    firsts = ends[:-1]
    starts[firsts[firsts < len(data)]] = True
    return starts


def _shifts(places: np.ndarray, jumps: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, shift of each byte) stride by stride: running sums of jumps at ascending places."""
    carried = 0
    for start in range(0, size, STRIDE):
        stop = min(start + STRIDE, size)
        a, b = np.searchsorted(places, (start, stop))
        difference = np.zeros(stop - start, np.int64)
        np.add.at(difference, places[a:b] - start, jumps[a:b])
        shift = np.cumsum(difference)
        shift += carried
        carried = int(shift[-1])
        yield start, shift


def _jumps(parts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Difference array, as places and jumps, of parts (start in the text, start in the output).

    Parts are ascending in the text; of parts that start together all but the last are empty, and the
    jumps at one place add up to the last one's shift.
    """
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, to = np.array(parts, np.int64).T
    return place, np.diff(to - place, prepend=0)


def _layout(form: str, base: int, lengths: Sequence[int]) -> tuple[list[int], list[tuple[int, int]], int]:
    """Output starts of the parts 0 to 2, (place, part) of the sentinels, and the output's end."""
    to, marks = [0, 0, 0], []
    for part in ORDER[form]:
        marks.append((base, part))
        to[part] = base + WIDTH
        base = to[part] + lengths[part]
    return to, marks, base


def arrange(texts: pa.Array, draws: Sequence[np.ndarray], form: Sequence[str]):
    """(n tokens, prefix chars, middle chars, outputs) of texts; ``draws``: two integers per text."""
    data, ends = text_bytes(texts)
    tokens, chars = Marks(token_starts(data, ends)), Marks(_FIRST[data])
    n, prefix, middle = [], [], []
    parts, marks, out_ends, base = [], [], [0], 0
    for i, kind in enumerate(form):
        start, stop = int(ends[i]), int(ends[i + 1])
        first = tokens.rank(start)
        count = tokens.rank(stop) - first
        n.append(count)
        if kind == PLAIN:
            prefix.append(None)
            middle.append(None)
            parts.append((start, base))
            base += stop - start
        else:
            cuts = sorted(int(d[i]) % (count + 1) for d in draws)
            one, two = (min(tokens.select(first + c), stop) for c in cuts)
            known = chars.rank(one)
            prefix.append(known - chars.rank(start))
            middle.append(chars.rank(two) - known)
            to, found, base = _layout(kind, base, (one - start, two - one, stop - two))
            marks += found
            parts += zip((start, one, two), to)
        out_ends.append(base)
    out = np.empty(base, np.uint8)
    places, jumps = _jumps(parts)
    for start, shift in _shifts(places, jumps, len(data)):
        shift += np.arange(start, start + len(shift))
        out[shift] = data[start : start + len(shift)]
    for place, part in marks:
        out[place : place + WIDTH] = np.frombuffer(MARK[part], np.uint8)
    return n, prefix, middle, _strings(out, out_ends)


def _strings(data: np.ndarray, ends: Sequence[int]) -> pa.Array:
    kind, wide = (pa.string(), np.int32) if len(data) < 1 << 31 else (pa.large_string(), np.int64)
    return pa.Array.from_buffers(
        kind, len(ends) - 1, [None, pa.py_buffer(np.asarray(ends, wide)), pa.py_buffer(data)]
    ).cast(pa.string())


def gather(outputs: pa.Array, form: Sequence[str]) -> pa.Array:
    """The texts of outputs: sentinels give the parts, and every byte is fetched from its place."""
    data, ends = text_bytes(outputs)
    open_, close = np.uint8(ord("<")), np.uint8(ord(">"))
    found = np.flatnonzero((data[:-2] == open_) & (data[2:] == close)) if len(data) > 2 else np.zeros(0, int)
    found = found[np.isin(data[found + 1], [mark[1] for mark in MARK])]
    parts, out_ends, base = [], [0], 0
    for i, kind in enumerate(form):
        start, stop = int(ends[i]), int(ends[i + 1])
        if kind == PLAIN:
            parts.append((base, start))
            base += stop - start
        else:
            a = int(np.searchsorted(found, start))
            places = [int(p) for p in found[a : a + WIDTH]]
            after = [*places[1:], stop]
            at = {part: (p + WIDTH, e) for part, p, e in zip(ORDER[kind], places, after)}
            for part in range(3):
                parts.append((base, at[part][0]))
                base += at[part][1] - at[part][0]
        out_ends.append(base)
    out = np.empty(base, np.uint8)
    places, jumps = _jumps(parts)
    for start, shift in _shifts(places, jumps, base):
        shift += np.arange(start, start + len(shift))
        out[start : start + len(shift)] = data[shift]
    return _strings(out, out_ends)


def _draw(digest: Column, nth: int) -> Column:
    """The nth group of eight hex digits as an integer."""
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", carry: Sequence[str] | None = None
) -> DataFrame:
    """``given`` (a struct of the ``carry`` columns; all, if None), ``n`` tokens, ``form``,
    ``prefix_chars``, ``middle_chars`` and ``output``; a row for each row of ``docs``.

    Cuts and forms are drawn from the hash of ``key`` alone, so reruns, ties and repeated rows get the
    same; a null key is drawn as an empty one. A null text is an empty text, which is plain. The given
    columns stay inside their struct, whatever their names. An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else list(carry)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    id_text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), id_text).cast("binary"), 256)
    given = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    drawn = docs.select(given.alias("given"), whole.alias("text"), digest.alias("digest"))
    marked = F.lit(False)
    for word in SENTINELS:
        marked = marked | F.contains("text", F.lit(word))
    form = (
        F.when((F.col("text") == "") | marked | (_draw(F.col("digest"), 3) % 100 >= RATE), PLAIN)
        .when(_draw(F.col("digest"), 4) % 100 < SPM, SPM_FORM)
        .otherwise(PSM)
    )
    ready = drawn.select(
        "given", "text", _draw(F.col("digest"), 1).alias("one"), _draw(F.col("digest"), 2).alias("two"),
        form.alias("form"),
    )
    schema = (
        StructType([ready.schema["given"]]).add("n", "long").add("form", "string")
        .add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            draws = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]
            n, prefix, middle, output = arrange(batch.column(1), draws, batch.column(4).to_pylist())
            longs = [pa.array(values, pa.int64()) for values in (n, prefix, middle)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), longs[0], batch.column(4), *longs[1:], output],
                schema.names,
            )

    return ready.mapInArrow(cut, schema)


def restore(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the column ``restored``, from ``form`` and ``output`` alone.

    Takes the columns of ``fill_in_middle``; null, empty and plain outputs come back as they are, null
    as empty. An empty table gives an empty result.
    """
    others = [c for c in arranged.columns if c not in ("form", "output")]
    ready = arranged.select(
        *[F.col(f"`{c}`") for c in others],
        F.coalesce("form", F.lit(PLAIN)).alias("form"),
        F.coalesce("output", F.lit("")).alias("output"),
    )

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                *_, form, output = batch.columns
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, gather(output, form.to_pylist())], [*batch.schema.names, "restored"]
                )

    return ready.mapInArrow(back, StructType(list(ready.schema)).add("restored", "string"))
