"""Clustering on bit planes and the fill-in-middle piece table against plain Python."""

import hashlib

import numpy as np
import pytest

from tidemark.llm.bit_kmeans import Centroids, cluster, dots, norms, numbers, planes, same_width, with_inertia
from tidemark.llm.piece_table import PieceTable, byte_places, code_points, fill_in_middle, parsed, restore


def test_planes_hold_the_numbers():
    rng = np.random.default_rng(1)
    for most in (0, 1, 2, 255, 1 << 20, (1 << 27) - 1):
        values = rng.integers(-most - 1, most + 1, (7, 64))
        values[0], values[1] = most, -most - 1
        assert (numbers(planes(values)) == values).all()
    assert planes(np.zeros((0, 64), np.int64)).shape == (0, 1)
    narrow, wide = planes(np.full((1, 64), -1)), planes(np.full((1, 64), 300))
    assert numbers(same_width([narrow[0], wide[0]])).tolist() == [[-1] * 64, [300] * 64]


def test_popcounts_are_dot_products():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-700, 700, (20, 64)), rng.integers(-(1 << 27), 1 << 27, (9, 64))
    assert (dots(planes(a), planes(b)) == a @ b.T).all() and (norms(planes(b)) == (b * b).sum(axis=1)).all()
    at, far = Centroids.of(b.tolist()).nearest(planes(a))
    whole = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    assert at.tolist() == whole.argmin(axis=1).tolist() and far.tolist() == whole.min(axis=1).tolist()


def by_hand(rows, number, rounds):
    """(vec_id, cluster, distance, sum by cluster, whole sum, digest) by the rules, in plain Python."""
    kept = [(v, [int(np.floor(256 * np.float64(np.float32(x)))) for x in e]) for v, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    centroids = [list(e) for _, e in order[:number]]

    def nearest(e):
        return min((sum((x - y) ** 2 for x, y in zip(e, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, e in kept:
            groups.setdefault(nearest(e)[1], []).append(e)
        for n, own in groups.items():
            centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    placed = [(v, *nearest(e)[::-1]) for v, e in kept]
    inertia = {n: sum(d for _, c, d in placed if c == n) for n in range(number)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(v, c, d, inertia[c], sum(inertia.values()), digest[c]) for v, c, d in placed]


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(n, rng.normal(n % 3, 0.4, 64).astype(np.float32).tolist()) for n in range(60)]
    rows += [(5, rows[5][1]), (7, rows[7][1]), (None, rows[1][1]), (61, [1e4] * 64), (62, [0.0] * 64), (63, [-0.001] * 64)]
    odd = [(70, None), (71, []), (72, [1.0] * 63), (73, [1.0] * 63 + [None]), (74, [float("inf")] * 64), (75, [float("nan")] * 64), (76, [1e30] * 64)]
    table = spark.createDataFrame([(v, e, 1, 2) for v, e in rows + odd], "VEC_ID long, embedding array<float>, planes int, cluster int")
    got = with_inertia(cluster(table.repartition(5), 8, 3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(by_hand(rows, 8, 3), key=str)


def test_clusters_of_few_or_no_vectors(spark):
    rows = [(n, [float(n)] * 64) for n in range(3)] + [(3, [0.0] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, with_inertia(cluster(table)).collect())) == sorted(by_hand(rows, 40, 5))
    empty = with_inertia(cluster(table.limit(0)))
    assert empty.collect() == [] and empty.columns == with_inertia(cluster(table)).columns


def test_code_points_of_long_texts():
    text = "aé日😀" * 700_000 + "x"
    data = memoryview(text.encode())
    assert code_points(data) == len(text) and code_points(memoryview(b"")) == 0
    places = [0, 1, 2, 1_048_577, len(text) - 1, len(text)]
    assert byte_places(data, places) == [len(text[:p].encode()) for p in places]


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_an_arrangement_and_its_inverse(form):
    for text in ("abc", "<", "<S", "a<P", "S>", "é😀<<>"):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                table = PieceTable.of(text.encode()).cut(0, *byte_places(memoryview(text.encode()), (a, b)))
                p, m, s = text[:a], text[a:b], text[b:]
                written = table.arranged(form)
                assert written.text().decode() == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
                assert written.restored(form).text().decode() == text == parsed(written.text(), form).restored(form).text().decode()
    with pytest.raises(ValueError):
        parsed(b"plain", form)


def filled(doc_id, text):
    text, digest = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark):
    odd = [None, "", "a", "é", "😀 日本", "has <M> inside", "<P", "> <S", "\0 \n", "x" * 40, "same", "same"]
    rows = [(n, odd[n % len(odd)]) for n in range(96)] + [(None, "no id"), (3, odd[3]), (500, "aé日😀 " * 600_000), (-1, "minus")]
    table = spark.createDataFrame([(d, t, "o", "f", 1) for d, t in rows], "doc_id long, text string, output string, form string, n int")
    written = fill_in_middle(table.repartition(3))
    got = written.drop("spans", "output_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted((filled(*row) for row in rows), key=str)
    assert len({r["form"] for r in got}) == 3
    for r in written.where("doc_id between 0 and 95").collect():
        buffers = ((odd[r["doc_id"] % len(odd)] or "").encode(), b"<P><S><M>")
        assert b"".join(buffers[s["buffer"]][s["start"] : s["stop"]] for s in r["spans"]) == r["output"].encode()
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
    back = restore(written.withColumnRenamed("n", "Restored")).collect()
    assert sorted(((r["doc_id"], r["restored"]) for r in back), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert all(r["restored_sha256"] == hashlib.sha256(r["restored"].encode()).hexdigest() for r in back)
    assert fill_in_middle(table.limit(0)).collect() == [] and restore(written.limit(0)).collect() == []


def test_columns_whose_names_differ_in_case(spark):
    table = spark.createDataFrame([(1, "wrong", "right", 2)], "doc_id long, Text string, text string, DOC_ID long")
    assert fill_in_middle(table).select("doc_id", "n").collect() == [(1, 5)]
