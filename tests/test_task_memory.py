"""What a task holds at once stays small, whatever the batch."""

import tracemalloc

import numpy as np

from tidemark.operators import gazetteer, textindex


def peak_mb(run):
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_distances_to_a_full_list_are_taken_in_small_blocks():
    random = np.random.default_rng(2)
    points, asked = random.random((textindex.LIST_ROWS, 4)), random.random((300, 4))
    groups = [("a", np.arange(len(points)), points)]
    found = []
    assert peak_mb(lambda: found.extend(textindex._nearest(groups, np.arange(300), asked, 2))) < 80
    far = np.round(1.0 - asked @ points.T, textindex.DIGITS)
    far[np.arange(300), np.arange(300)] = np.inf
    want = np.argsort(far, axis=1, kind="stable")[:, :2]
    assert np.concatenate([b.column("k").to_numpy() for b in found]).reshape(300, 2).tolist() == want.tolist()


def test_a_piece_of_texts_takes_little_memory():
    held = gazetteer.Gazetteer([{"term": f"t{i}", "kind": "k", "form": f"word{i}", "at": 0, "alone": True} for i in range(50)])
    texts = [" ".join(f"word{(i * 7 + j) % 50}" for j in range(100)) for i in range(gazetteer.PIECE // 700)]
    assert peak_mb(lambda: held.hits(texts)) < 60
