"""CSV streams against ``csv.DictReader`` over a universal-newline text stream."""

import csv
import io

import numpy as np
import pytest

from ontime.sources import csvrows

COLUMNS = ["A", "B", "C", "missing"]


def stdlib_rows(data):
    out, error = [], None
    try:
        for r in csv.DictReader(io.TextIOWrapper(io.BytesIO(data), "utf-8", "replace")):
            out.append(tuple(r.get(c, "") for c in COLUMNS))
    except csv.Error as e:
        error = str(e)
    return out, error


def ours(data, **options):
    rows = csvrows.CsvRows(io.BytesIO(data).read, COLUMNS, **options)
    out = [tuple(r.values()) for b in rows.batches() for r in b.to_pylist()]
    assert rows.rows == len(out)
    return out, rows.error


def check(data, **options):
    want, want_error = stdlib_rows(data)
    got, error = ours(data, **options)
    assert sorted(got, key=str) == sorted(want, key=str), data[:300]
    if want_error:
        assert want_error in error
    return error


PIECES = [b"a", b"bc", b"1", b" ", b'"', b'""', b'"x"', b'"x,y"', b'"x\ny"', b'"p""q"', b",", b",", b",", b"\n", b"\n", b"\r\n", b"\r", b"\xff", b"\xe2\x82",
          "ü€".encode(), b"\xef\xbb\xbf", b'"', b'5"', b'","', b'"\r\nz"']


@pytest.mark.parametrize("block", [1, 16, 64, 1 << 20])
@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_fuzz_at_several_block_sizes(block, chunk, monkeypatch):
    monkeypatch.setattr(csvrows, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(block + chunk)
    for _ in range(1500):
        n = int(rng.integers(0, 40))
        header = [b"A,B,C\n", b"", b'"A",B\r\n', b"C,A,A\n", b'"A\n",B\n'][int(rng.integers(5))]
        check(header + b"".join(PIECES[i] for i in rng.integers(0, len(PIECES), n)), block_bytes=block)


@pytest.mark.parametrize("block", [16, 200, 1 << 20])
def test_fuzz_regular_rows(block, monkeypatch):
    """Well-formed rows with quoted line ends stay with pyarrow and lose nothing at block borders."""
    monkeypatch.setattr(csvrows, "CHUNK_BYTES", 50)
    rng = np.random.default_rng(block)
    values = ["", "x", "1.5", "a,b", 'say "hi"', "two\nlines", "\r\n", "ü", " pad "]
    for _ in range(300):
        out = io.StringIO()
        writer = csv.writer(out, quoting=int(rng.integers(2)))
        writer.writerow("ABC")
        for _ in range(int(rng.integers(0, 30))):
            writer.writerow([values[i] for i in rng.integers(0, len(values), int(rng.integers(1, 5)))])
        assert check(out.getvalue().encode(), block_bytes=block) is None


def test_one_field_rule_with_and_without_quotes():
    long = "x" * 200_000
    lines = "\n" * 200_000
    for field in (long, f'"{long}"', f'"{lines}"', '"' + 'a""' * 70_000 + '"'):
        for before in ("", '"q",5"r,s\n'):
            error = check(f"A,B,C\n1,2,3\n{before}4,{field},6\n7,8,9\n".encode())
            assert "field larger" in error
    assert check(f"A,B,C\n1,{'x' * 131_000},3\n".encode()) is None


def test_a_quote_never_closed_is_named_at_any_block_size():
    data = b"A,B,C\n" + b'1,5"x,3\n' * 100 + b'1,"open\n2,3,4\n'
    for block in (16, 4 << 20):
        assert "unclosed" in check(data, block_bytes=block)
        assert "unclosed" in check(b'A,B,C\n1,2,3\n4,"5\n6,7,8\n', block_bytes=block)


@pytest.mark.parametrize("tail", ["1,2", '1,"two\nlin', '1,5"x', ""])
def test_a_fault_keeps_the_whole_records_before_it(tail):
    class Fault(Exception):
        pass

    whole = "A,B,C\n" + "".join(f'{i},"x\n{i}",z\n' for i in range(5000))
    for block in (100, 1 << 20):
        source = io.BytesIO((whole + tail).encode())

        def read(n, source=source):
            chunk = source.read(n)
            if not chunk:
                raise Fault("cut")
            return chunk

        rows = csvrows.CsvRows(read, COLUMNS, (Fault,), block)
        got = [tuple(r.values()) for b in rows.batches() for r in b.to_pylist()]
        assert got == stdlib_rows(whole.encode())[0] and "cut" in rows.error


def test_memory_stays_bounded(monkeypatch):
    """Blocks do not grow with the stream."""
    sizes = []
    by_arrow = csvrows._by_arrow
    monkeypatch.setattr(csvrows, "_by_arrow", lambda block, *a: sizes.append(len(block)) or by_arrow(block, *a))
    line = b'"2020-01-01","AA",1\n'
    left = [20_000_000 // len(line)]

    def read(n):
        take = min(left[0], n // len(line))
        left[0] -= take
        return line * take

    rows = csvrows.CsvRows(lambda n, first=[b"A,B,C\n"]: first.pop() if first else read(n), COLUMNS)
    assert sum(b.num_rows for b in rows.batches()) == 1_000_000 == rows.rows
    assert max(sizes) < csvrows.BLOCK_BYTES + csvrows.CHUNK_BYTES * 2
