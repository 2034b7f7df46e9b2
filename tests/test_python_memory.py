"""Tasks turn a bounded number of rows into Python objects at a time, with the same result."""

import numpy as np
import pyarrow as pa

from cofferline.operators import itemsets, match


def test_bitmaps_are_intersected_a_few_at_a_time():
    rng = np.random.default_rng(3)
    rows = 1_300
    bits = rng.integers(0, 256, (2, rows, 4096), np.uint8)
    bits[1, 7] = ~bits[0, 7]  # nobody in common
    batch = pa.RecordBatch.from_pydict({
        "items": pa.array([[f"i{at:05d}", "z"] for at in range(rows)]), "bucket": pa.array([0] * rows, pa.int64()),
        "_left": pa.array([row.tobytes() for row in bits[0]]), "_right": pa.array([row.tobytes() for row in bits[1]])})
    out = list(itemsets._common_owners(iter([batch])))
    assert max(len(part) for part in out) < rows / 2
    table = pa.Table.from_batches(out)
    both = bits[0] & bits[1]
    kept = [at for at in range(rows) if at != 7]
    assert table["items"].to_pylist() == [[f"i{at:05d}", "z"] for at in kept]
    assert table["bits"].to_pylist() == [both[at].tobytes() for at in kept]
    assert table["n"].to_pylist() == [int(np.bitwise_count(both[at]).sum()) for at in kept]


def test_baskets_are_walked_in_slices():
    n = 2_500
    sides = {"_path": [["a", "b"]], "antecedent": [["a", "b"]], "consequent": [["c"]]}
    rules = pa.table(sides | {"confidence": [0.5], "lift": [2.0], "support": [0.1]})
    items = [["a", "b"] if at % 3 == 0 else ["a", "b", "c"] if at % 3 == 1 else ["a", "d"] for at in range(n)]
    baskets = pa.table({"owner": [f"o{at}" for at in range(n)], "items": items, "place": pa.array([0] * n, pa.int32())})
    slices = [(first, len(met)) for first, met in match._walked(rules, baskets)]
    assert [first for first, _ in slices] == [0, 1000, 2000]
    out = match._matches(rules, baskets)
    assert out["owner"].to_pylist() == [f"o{at}" for at in range(0, n, 3)]
    assert set(map(tuple, out["new_items"].to_pylist())) == {("c",)}
    scores = match._best_scores(rules, baskets)
    assert scores["owner"].to_pylist() == out["owner"].to_pylist() and set(scores["score"].to_pylist()) == {1.0}
