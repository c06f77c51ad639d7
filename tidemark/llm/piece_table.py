"""Fill-in-middle transformation of documents by a piece table.

A document is a list of descriptors (buffer, start, stop), spans of bytes of two buffers that do not
change, the text and the sentinels. Cutting splits a descriptor, an arrangement puts descriptors in
another order with sentinels before them, and its inverse puts them back; no text is moved for that.
Digests and output texts are fed descriptor by descriptor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.tables import map_arrow, picked, slices

#: The sentinels, and shares in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TRANSFORMED, SUFFIX_FIRST = 90, 20
TEXT, MARKS = 0, 1
#: The parts of a text (0 prefix, 1 middle, 2 suffix) in the order a form writes them, and the sentinel before each.
ARRANGEMENTS = {"psm": ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), "spm": ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}
#: Texts longer than this many bytes are searched for the ends of code points in blocks.
BLOCK = 1 << 20


class Span(NamedTuple):
    """A descriptor: bytes ``start`` to ``stop`` of a buffer."""

    buffer: int
    start: int
    stop: int


@dataclass(frozen=True)
class PieceTable:
    """``spans`` over ``buffers``, which are never written to."""

    buffers: tuple[memoryview, memoryview]
    spans: tuple[Span, ...]

    @classmethod
    def of(cls, text: bytes | memoryview) -> PieceTable:
        view = memoryview(text)
        return cls((view, memoryview(SENTINELS)), (Span(TEXT, 0, len(view)),))

    def cut(self, index: int, *places: int) -> PieceTable:
        """Span ``index`` split at ``places``, ascending bytes of its buffer; an empty part stays a span."""
        buffer, start, stop = self.spans[index]
        edges = [start, *places, stop]
        parts = [Span(buffer, a, b) for a, b in zip(edges, edges[1:])]
        return PieceTable(self.buffers, (*self.spans[:index], *parts, *self.spans[index + 1 :]))

    def arranged(self, form: str) -> PieceTable:
        """Prefix, middle and suffix in the order of ``form``, each after its sentinel."""
        spans = []
        for part, mark in ARRANGEMENTS[form]:
            at = SENTINELS.index(mark)
            spans += [Span(MARKS, at, at + len(mark)), self.spans[part]]
        return PieceTable(self.buffers, tuple(spans))

    def restored(self, form: str) -> PieceTable:
        """The inverse of ``arranged``: sentinels go, the parts return to their places."""
        places = [part for part, _ in ARRANGEMENTS[form]]
        parts = self.spans[1::2]
        return PieceTable(self.buffers, tuple(parts[places.index(n)] for n in range(len(places))))

    def read(self) -> Iterator[memoryview]:
        for buffer, start, stop in self.spans:
            yield self.buffers[buffer][start:stop]

    def text(self) -> bytes:
        return b"".join(self.read())

    def sha256(self) -> str:
        found = hashlib.sha256()
        for part in self.read():
            found.update(part)
        return found.hexdigest()


def parsed(output: bytes | memoryview, form: str) -> PieceTable:
    """The piece table of a written text of ``form``: its sentinels, found from left to right, and the parts between them.

    Each sentinel is the first of its kind after the one before it, since no part holds one. Raises
    ValueError if the output does not begin with the form's first sentinel or lacks another.
    """
    marks = [mark for _, mark in ARRANGEMENTS[form]]
    data = bytes(output)
    at = [0]
    if not data.startswith(marks[0]):
        raise ValueError(f"not a text of form {form}")
    for mark in marks[1:]:
        at.append(data.index(mark, at[-1] + len(marks[0])))
    places = [edge for start, mark in zip(at, marks) for edge in (start, start + len(mark))]
    return PieceTable.of(data).cut(0, *places[1:])


def draws(doc_id: int | None) -> Sequence[int]:
    """Four numbers below 2**32 that the id alone decides; a null id counts as the text ""."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def code_points(text: memoryview) -> int:
    """How many code points UTF-8 bytes hold."""
    data = np.frombuffer(text, np.uint8)
    return sum(int(np.count_nonzero(data[i : i + BLOCK] & 0xC0 != 0x80)) for i in range(0, len(data), BLOCK))


def byte_places(text: memoryview, places: Sequence[int]) -> list[int]:
    """At which byte each of ``places``, counted in code points, lies; the number of all of them is the end."""
    data = np.frombuffer(text, np.uint8)
    found, seen = [len(data)] * len(places), 0
    for i in range(0, len(data), BLOCK):
        starts = np.flatnonzero(data[i : i + BLOCK] & 0xC0 != 0x80)
        for n, place in enumerate(places):
            if seen <= place < seen + len(starts):
                found[n] = i + int(starts[place - seen])
        seen += len(starts)
    return found


class Transformed(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    table: PieceTable


def transform(doc_id: int | None, text: memoryview) -> Transformed:
    """The piece table of a document's output. The id decides on cuts and form; a text that is empty or holds a sentinel stays plain."""
    n = code_points(text)
    first, second, whether, which = draws(doc_id)
    table, data = PieceTable.of(text), bytes(text)
    if not n or whether % 100 >= TRANSFORMED or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Transformed(n, "plain", None, None, table)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    form = "spm" if which % 100 < SUFFIX_FIRST else "psm"
    return Transformed(n, form, low, high - low, table.cut(0, *byte_places(text, (low, high))).arranged(form))


def _texts(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each text, without copies. Null: empty."""
    large = column.cast(pa.large_binary())
    for value in large:
        buffer = value.as_buffer()
        yield memoryview(b"") if buffer is None else memoryview(buffer)


_SPAN = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
_WRITTEN = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
    + [("spans", pa.list_(_SPAN)), ("output", pa.string()), ("output_sha256", pa.string())]
)
WRITTEN = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "spans array<struct<buffer: int, start: long, stop: long>>, output string, output_sha256 string"
)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch.column("text"))):
            *facts, table = transform(doc_id, text)
            rows.append((doc_id, *facts, [s._asdict() for s in table.spans], table.text(), table.sha256()))
        columns = [pa.array(c, pa.binary()).cast(f.type) if f.name == "output" else pa.array(c, f.type) for c, f in zip(zip(*rows), _WRITTEN)]
        yield pa.RecordBatch.from_arrays(columns, schema=_WRITTEN)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored) its text with the middle put last.

    Columns: doc_id, n (code points), form, prefix_chars, middle_chars (null if plain), spans (the
    descriptors: bytes of buffer 0, the text, or 1, the sentinels), output, output_sha256. About 9
    documents in 10 are cut at two places and written as ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>``
    middle) or, one in 5 of them, ``spm`` (``<S>`` suffix ``<P>`` prefix ``<M>`` middle); the others, and
    texts that are empty or hold a sentinel, are ``plain`` and stay as they are. A null text counts as
    empty. Cuts and form follow from the id and the length alone, so repeated rows come out alike; a null
    id counts as the text "". An empty table gives an empty one. Rows are worked on one by one where
    they are read; nothing is shuffled.
    """
    return map_arrow(picked(docs, doc_id="long", text="string"), _write, WRITTEN)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "output"):
        tables = [
            PieceTable.of(output) if form == "plain" else parsed(output, form).restored(form)
            for form, output in zip(batch.column("form").to_pylist(), _texts(batch.column("output")))
        ]
        texts = pa.array([table.text() for table in tables], pa.binary()).cast(pa.string())
        digests = pa.array([table.sha256() for table in tables], pa.string())
        kept = [name for name in batch.schema.names if name != "output"]
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), texts, digests], [*kept, "restored", "restored_sha256"])


def restore(written: DataFrame) -> DataFrame:
    """The texts rebuilt from ``output`` and ``form`` alone, as ``restored`` and ``restored_sha256``; output goes, other columns stay.

    A null output counts as empty. An output that its form does not fit stops the job with ValueError.
    Columns named restored or restored_sha256 are replaced.
    """
    kept = [c for c in written.columns if c.lower() not in ("restored", "restored_sha256")]
    source = written.select(*kept)
    fields = [f for f in source.schema.fields if f.name != "output"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", restored string, restored_sha256 string"
    return map_arrow(source, _read_back, schema)
