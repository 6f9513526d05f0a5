import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ontime.llm import shingles, text as tx

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n.\x0b\xa0", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_are_those_of_bytes_split(texts):
    data, off = tx.flat(pa.array(texts, pa.string()))
    starts, ends, of = tx.words(data, off)
    got = [[data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(of[:-1], of[1:])]
    assert got == [(t or "").encode().split() for t in texts]


def test_hashes_depend_on_the_bytes_alone():
    data, off = tx.flat(pa.array(["ab cd ab", "cd ab"]))
    starts, ends, _ = tx.words(data, off)
    h = tx.span_hash(tx.prefix_sums(data), starts, ends)
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[0] != h[1]
    runs = tx.run_hash(h, 2)
    # ab cd, cd ab, ab cd (over both texts), cd ab
    assert runs[0] == runs[2] and runs[1] == runs[3] and runs[0] != runs[1]


def test_slices_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, None, "y" * 99, "", "z"])], names=["text"])
    parts = list(tx.slices(iter([batch]), "text", 20))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    assert len(parts) > 1


def test_prefix_length_shortens_until_the_recall_is_reached():
    assert shingles.prefix_length(0.8, 20, 8, 0.9999) == 4
    assert shingles.prefix_length(0.8, 20, 8, 0.5) > 4
    assert shingles.prefix_length(0.8, 1, 8, 0.9999) == 1


def test_sums_by_handles_empty_stretches():
    assert tx.sums_by(np.array([1.0, 2.0, 3.0]), np.array([0, 0, 2, 2, 3])).tolist() == [0, 3, 0, 3]
