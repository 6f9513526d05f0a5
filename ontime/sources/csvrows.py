"""CSV bytes -> record batches of text columns, with the row semantics of ``csv.DictReader`` over a
universal-newline text stream, in bounded memory.

A stream is read in chunks and parsed in blocks of whole records:

* ``\\r\\n`` and ``\\r`` become ``\\n`` (inside quoted fields too), invalid UTF-8 becomes U+FFFD;
* a requested column missing from the header is '' on every row; of duplicate header names the
  last one wins; a short row gives NULL for the missing trailing fields, extra fields are ignored;
  blank lines are skipped;
* a field beyond the csv module's limit ends the stream, whatever surrounds it; a quote that is
  never closed takes the rest of the stream into its field.  Both are named in ``error``.

A block is *regular* if every quote opens a field right after a delimiter or closes one right before
a delimiter (doubled quotes inside count as a close and an open).  Regular blocks are cut at a line
end outside quotes and parsed by pyarrow.  From the first block that is not regular, or that holds a
line longer than the field limit, the csv module reads the rest of the stream.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv

CHUNK_BYTES, BLOCK_BYTES, BATCH_ROWS = 64 << 10, 4 << 20, 50_000
_QUOTE, _COMMA, _LINE, _BOM = ord('"'), ord(","), ord("\n"), b"\xef\xbb\xbf"


class CsvRows:
    """The rows of one stream.  ``read(n)`` returns bytes, b'' at the end; exceptions of ``faults``
    end the stream, keeping every complete row before.  ``rows`` and ``error`` grow as batches are taken."""

    def __init__(self, read: Callable[[int], bytes], columns: Sequence[str], faults: tuple[type[BaseException], ...] = (),
                 block_bytes: int | None = None):
        self.read, self.columns, self.faults = read, list(columns), faults
        self.block_bytes = block_bytes or BLOCK_BYTES
        self.rows, self.error = 0, None
        self._cut = False

    def batches(self) -> Iterator[pa.RecordBatch]:
        for batch in self._parsed():
            self.rows += batch.num_rows
            yield batch

    def _chunks(self) -> Iterator[bytes]:
        """Chunks with line ends as ``\\n``; a fault ends them and is remembered."""
        held = b""
        while True:
            try:
                chunk = self.read(CHUNK_BYTES)
            except self.faults as e:
                self.error, self._cut = f"{type(e).__name__}: {e}", True
                return
            if not chunk:
                break
            chunk = held + chunk
            held = b"\r" if chunk.endswith(b"\r") else b""     # its \n may follow
            chunk = chunk[:len(chunk) - len(held)]
            yield chunk.replace(b"\r\n", b"\n").replace(b"\r", b"\n") if b"\r" in chunk else chunk
        if held:
            yield b"\n"

    def _parsed(self) -> Iterator[pa.RecordBatch]:
        chunks, pending = self._chunks(), b""
        place: dict[str, int] | None = None
        width = 0
        while True:
            parts, size, ended = [pending], len(pending), True
            for chunk in chunks:
                parts.append(chunk)
                size += len(chunk)
                if size >= self.block_bytes:
                    ended = False
                    break
            block = b"".join(parts)
            end = regular_end(block, ended and not self._cut)
            irregular = end is None or (place is None and block[:1] in (b"", b"\n"))
            # a record as long as a block, or a quote open at the end, are left to the csv module
            if irregular or (not end if not ended else end < len(block) and not self._cut):
                yield from self._by_csv(block, chunks, place)
                return
            whole, pending = block[:end], block[end:]
            if place is None and whole:
                line = regular_end(whole, True, first=True) or len(whole)
                header = next(csv.reader(io.StringIO(whole[:line].decode("utf-8", "replace"), newline="\n")), [])
                place, width, whole = {name: i for i, name in enumerate(header)}, len(header), whole[line:]
            if whole.startswith(_BOM):      # pyarrow would drop it
                yield from self._by_csv(whole + pending, chunks, place)
                return
            yield from _by_arrow(whole, width, place or {}, self.columns)
            if ended:
                return

    def _by_csv(self, block: bytes, chunks: Iterator[bytes], place: dict[str, int] | None) -> Iterator[pa.RecordBatch]:
        record: list[str] = []          # the lines of the record being read

        def lines() -> Iterator[str]:
            held = [block]
            while True:
                chunk = next(chunks, None)
                if chunk is not None:
                    held.append(chunk)
                    if b"\n" not in chunk:
                        continue
                data = b"".join(held)
                end = len(data) if chunk is None and not self._cut else data.rfind(b"\n") + 1
                for line in io.StringIO(data[:end].decode("utf-8", "replace"), newline="\n"):
                    record.append(line)
                    yield line
                if chunk is None:
                    return
                held = [data[end:]]

        rows: list[list[str]] = []
        last: list[str] = []
        reader = csv.reader(lines())
        try:
            for row in reader:
                if place is None:
                    place = {name: i for i, name in enumerate(row)}
                elif row:
                    rows.append(row)
                last, record[:] = record[:], []
                if len(rows) > BATCH_ROWS:
                    yield _from_rows(rows[:-1], place, self.columns)
                    rows = rows[-1:]
            if unclosed(last):
                if self._cut:                   # the fault came inside this record
                    rows = rows[:-1]
                else:
                    self.error = self.error or "unclosed quote: a field runs to the end of its member"
        except csv.Error as e:
            self.error = f"{type(e).__name__}: {e}"
        if rows:
            yield _from_rows(rows, place or {}, self.columns)


def unclosed(record: list[str]) -> bool:
    """Whether the lines of a record end within a quoted field."""
    try:
        list(csv.reader(record, strict=True))
    except csv.Error as e:
        return "unexpected end" in str(e)
    return False


def regular_end(block: bytes, at_end: bool, first: bool = False) -> int | None:
    """Where the last whole record of a regular block ends (``first``: the first one), or None if
    the block is not regular.  ``at_end``: nothing follows the block, so its end closes a record."""
    data = np.frombuffer(block, np.uint8)
    lines = np.flatnonzero(data == _LINE)
    if len(block) > csv.field_size_limit() and max(np.diff(lines, prepend=-1, append=len(block)), default=0) > csv.field_size_limit():
        return None
    quotes = np.flatnonzero(data == _QUOTE)
    if len(quotes):
        opens, closes = quotes[::2], quotes[1::2]
        before = np.where(opens > 0, data[np.maximum(opens - 1, 0)], _LINE)
        doubled = np.zeros(len(opens), bool)
        doubled[1:] = closes[:len(opens) - 1] == opens[1:] - 1
        if not ((before == _COMMA) | (before == _LINE) | doubled).all():
            return None
        after = np.where(closes + 1 < len(data), data[np.minimum(closes + 1, len(data) - 1)], _LINE)
        again = np.zeros(len(closes), bool)
        follow = opens[1:len(closes) + 1]
        again[:len(follow)] = follow == closes[:len(follow)] + 1
        if not ((after == _COMMA) | (after == _LINE) | again).all():
            return None
        starts, ends = opens[~doubled], closes[~again]
        ends = np.append(ends, [len(block)] * (len(starts) - len(ends)))
        if (ends - starts > csv.field_size_limit()).any():
            return None
        lines = lines[np.searchsorted(quotes, lines) % 2 == 0]
    if first:
        return int(lines[0]) + 1 if len(lines) else 0
    if at_end and len(quotes) % 2 == 0:
        return len(block)
    return int(lines[-1]) + 1 if len(lines) else 0


def _valid(block: bytes) -> bytes:
    """The block with invalid UTF-8 replaced (pyarrow fails on it in rows of another width)."""
    try:
        block.decode()
        return block
    except UnicodeDecodeError:
        return block.decode("utf-8", "replace").encode()


def _from_rows(rows: list[list[str]], place: dict[str, int], columns: Sequence[str]) -> pa.RecordBatch:
    """Rows as lists of fields: pad / cut like DictReader."""
    out = []
    for c in columns:
        i = place.get(c)
        out.append([""] * len(rows) if i is None else [r[i] if i < len(r) else None for r in rows])
    return pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in out], names=list(columns))


def _by_arrow(block: bytes, width: int, place: dict[str, int], columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Whole regular records; rows of another width go through the csv module."""
    if not block.strip(b"\n"):
        return
    block = _valid(block)
    odd: list[str] = []

    def on_invalid(row) -> str:
        odd.append(row.text if isinstance(row.text, str) else row.text.decode("utf-8", "replace"))
        return "skip"

    names = [f"f{i}" for i in range(width)]
    used = sorted({place[c] for c in columns if c in place}) or [0]
    table = pacsv.read_csv(
        io.BytesIO(block),
        read_options=pacsv.ReadOptions(column_names=names, block_size=len(block) + 1, use_threads=False),
        parse_options=pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=on_invalid),
        convert_options=pacsv.ConvertOptions(
            column_types={n: pa.binary() for n in names}, include_columns=[names[i] for i in used],
            strings_can_be_null=False, quoted_strings_can_be_null=False))
    if table.num_rows:
        absent = pa.array([""] * table.num_rows, pa.string())
        yield pa.RecordBatch.from_arrays([table.column(names[place[c]]).combine_chunks().cast(pa.string()) if c in place else absent for c in columns],
                                         names=list(columns))
    if odd:
        yield _from_rows([r for r in csv.reader(io.StringIO("\n".join(odd), newline="\n")) if r], place, columns)
