"""Words, encoders, packing, token files and decontamination against plain Python."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, encode
from tidemark.llm.bitplane import ShardReader, ShardWriter, from_planes, read_shards, to_planes, write_shards
from tidemark.llm.decontaminate import clean, contamination
from tidemark.llm.encode import Encoder
from tidemark.llm.packing import fullest, pack, plan
from tidemark.llm.words import byte_set, grams, words
from tidemark.workspace import new_folder, setting

BYTES, WORDS = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    None, "", " ", "a  b", "  x", "x \n y", "\n\n a", "tab\t b", "it's <|endoftext|> ok", "x\0y z", "é ́ x", "ΣΑΣ Σ s", "foo\n bar",
    "1 2 33", "don't  's", "a\x1c b", "µm ªb ºc", "a,. b.", "\nx", "x\n", "İx ŸA ßẞ", "a\n\nb", "a b", "a!!b", "foo' s", "x_y _z_",
    "日本 語。x", "É'S I'LL 'll", "word " * 3000, "x" * 5000, "same text", "same text",
]


def library(path):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("part", [1 << 14, 5])
@pytest.mark.parametrize("path, lead", [(BYTES, True), (WORDS, False)])
def test_encoder_is_the_library(path, lead, part, monkeypatch):
    monkeypatch.setattr(encode, "PART", part)
    ids, ends = Encoder(path, lead).encode(pa.array(ODD, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library(path)(text) for text in ODD]
    assert Encoder(path, lead).encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_words_and_grams():
    texts = ["", "The the", "a b c d e", " \t", "xéy B A", "a b c d e f"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    found = words(np.frombuffer(data, np.uint8), offsets, byte_set((0x20, 0x20), (0x09, 0x0D)))
    assert found.counts.tolist() == [0, 2, 5, 0, 3, 6]
    names = [w.lower() for t in texts for w in t.split()]
    assert len(set(zip(found.hash.tolist(), names))) == len(set(names)) == len(set(found.hash.tolist()))
    runs, begin = grams(found, 4)
    assert begin.tolist() == [0, 2, 3, 7, 10, 11, 12]  # texts of two and three words are one run each
    assert len(set(runs.tolist())) == 5 and runs[1] == runs[4] and runs[2] == runs[5]


def test_fullest_is_best():
    rng = np.random.default_rng(5)
    for _ in range(60):
        counts = {int(n): int(rng.integers(1, 4)) for n in rng.integers(1, 40, 5)}
        room = int(rng.integers(1, 90))
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        chosen = fullest(counts, room)
        assert sum(n * t for n, t in chosen.items()) == max(s for s in sums if s <= room)
        assert all(t <= counts[n] for n, t in chosen.items())


def least_bins(counts, capacity):
    """No plan has fewer sequences: for each k, pieces longer than capacity - k take one each, and of the
    others those of at least k share the sequences by length (the best of all these bounds)."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in range(1, capacity // 2 + 1):
        whole = sum(c for n, c in counts.items() if n > capacity - k)
        half = sum(c for n, c in counts.items() if capacity / 2 < n <= capacity - k)
        room = half * capacity - sum(n * c for n, c in counts.items() if capacity / 2 < n <= capacity - k)
        small = sum(n * c for n, c in counts.items() if k <= n <= capacity / 2)
        best = max(best, whole + half + max(0, -(-(small - room) // capacity)))
    return best


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(6)
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, 100, 60), rng.integers(1, 2000, 60))}
    made = plan(counts, 100)
    assert len(made) <= 100 and all(sum(n * t for n, t in chosen.items()) <= 100 for _, chosen in made)
    placed = {n: sum(bins * chosen.get(n, 0) for bins, chosen in made) for n in counts}
    assert placed == counts
    assert sum(bins for bins, _ in made) <= 1.02 * least_bins(counts, 100)


def test_packing(spark, docs):
    packed = pack(docs(*ODD), BYTES, capacity=64)
    ids = [library(BYTES)(text) + [0] for text in ODD]
    rows = packed.placed.collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(ids[doc]) and len(own) == -(-len(ids[doc]) // 64)
        assert all(r["length"] == 64 for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[doc][r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    assert set(by_doc) == set(range(len(ODD)))
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        assert sum(r["length"] for r in own) <= 64
    assert len(by_sequence) <= -(-sum(map(len, ids)) // 64) + 2
    for r in packed.sequences().collect():
        expected = [i for s in sorted(by_sequence[r["sequence_id"]], key=lambda s: s["offset"]) for i in ids[s["doc_id"]][s["start"] : s["start"] + s["length"]]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected


def test_packing_of_nothing(docs):
    assert pack(docs("a").limit(0), BYTES).placed.collect() == []


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind, tmp_path):
    rng = np.random.default_rng(7)
    for n in (1, 7, 64, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (from_planes(to_planes(ids, kind), n, kind) == ids).all()
    writer = ShardWriter(f"{tmp_path}/a.bits", kind, block=16)
    sizes = [0, 5, 40, 1, 0, 16]
    ids = rng.integers(0, 50_000, sum(sizes)).astype("<u4")
    writer.add(list(range(3)), sizes[:3], ids[:45])
    writer.add(list(range(3, 6)), sizes[3:], ids[45:])
    writer.close()
    found = list(ShardReader(f"{tmp_path}/a.bits").documents())
    assert [len(x) for _, _, x in found] == sizes and (np.concatenate([x for _, _, x in found]) == ids).all()
    assert [start for _, start, _ in found] == (np.cumsum(sizes) - sizes).tolist()
    whole = (tmp_path / "a.bits").read_bytes()
    (tmp_path / "b.bits").write_bytes(whole[:-3])
    with pytest.raises(ValueError):
        ShardReader(f"{tmp_path}/b.bits")


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files(spark, docs, kind):
    table = docs(*ODD).withColumn("doc_id", F.when(F.col("doc_id") != 3, 100 - F.col("doc_id")))
    shards = write_shards(table, new_folder(spark, "bits"), WORDS, False, 2, kind, block=256)
    rows = sorted(read_shards(shards).collect(), key=lambda r: r["start"])
    order = [3, *sorted((n for n in range(len(ODD)) if n != 3), reverse=True)]
    expected = [library(WORDS)(ODD[n]) + [2] for n in order]
    assert [r["doc_id"] for r in rows] == [None, *(100 - n for n in order[1:])]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in rows] == expected
    assert [r["start"] for r in rows] == np.cumsum([0, *map(len, expected)])[:-1].tolist()
    assert read_shards(write_shards(table.limit(0), new_folder(spark, "bits"), WORDS, False, 2)).collect() == []


def test_the_list_of_shards_is_one_file(spark):
    table = spark.createDataFrame([(n, "a text " * 50) for n in range(400)], "doc_id long, text string")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        shards = write_shards(table, new_folder(spark, "bits"), WORDS, False, 2)
    listed = shards.orderBy("shard").collect()
    assert len(listed) > 1 and len(shards.inputFiles()) == 1
    assert sum(r["n_docs"] for r in listed) == 400 and [r["doc_id"] for r in read_shards(shards).orderBy("start").collect()] == [*range(400)]


def brute_force(texts, items, size):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    cut = lambda text: pattern.findall((text or "").translate(low))
    for text in texts:
        own, hit, found = cut(text), set(), set()
        for item, item_text in items:
            w = cut(item_text)
            k = min(size, len(w))
            for i in range(len(w) - k + 1) if k else ():
                for j in range(len(own) - k + 1):
                    if own[j : j + k] == w[i : i + k]:
                        hit.update(range(j, j + k))
                        found.add(str(item))
        yield len(own), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(own)


@pytest.mark.parametrize("block", [3, 1 << 18])
def test_contamination(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    monkeypatch.setattr(decontaminate, "MOST_BLOCKS", 1000)
    line = [f"w{n}" for n in range(40)]
    items = [(1, " ".join(line[:20])), (20, "Only THREE words"), (3, "lone"), (4, ""), (5, None), (6, " ".join(["ab"] * 15)), (7, " ".join(line[5:25])), (None, "lone x")]
    texts = [
        " ".join(line), " ".join(line[:12]), " ".join(line[2:15]), "so only three, words here", "a lone w", None, "", "...", " ".join(["ab"] * 14),
        "ab " * 200, " ".join(line[:13]) + " other" * 300, " ".join(line[:13] + ["x"] + line[13:30]), "Lone", "Lone",
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs(*texts), benchmark, size=13)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found.collect()}
    expected = dict(enumerate(brute_force(texts, [i for i in items if i[0] is not None], 13)))
    assert got == expected
    assert sum(x[3] for x in expected.values()) > 4
    for r in found.collect():
        assert sum(s["end"] - s["first"] for s in r["spans"]) == r["n_hit"]
    kept = {r["doc_id"] for r in clean(docs(*texts), found).collect()}
    assert kept == {n for n, x in expected.items() if not x[3]}


def test_contamination_of_nothing(spark, docs):
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(docs("a").limit(0), benchmark).collect() == []
    (row,) = contamination(docs("a b"), benchmark.limit(0)).collect()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)


@pytest.mark.parametrize("fast_bytes, most_blocks", [(0, 8), (64 << 20, 0)])
def test_contamination_by_a_benchmark_of_any_size(spark, docs, monkeypatch, fast_bytes, most_blocks):
    monkeypatch.setattr(decontaminate, "FAST_BYTES", fast_bytes, raising=False)
    monkeypatch.setattr(decontaminate, "MOST_BLOCKS", most_blocks)
    monkeypatch.setattr(decontaminate, "ROWS_PER_SALT", 3, raising=False)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0, raising=False)
    line = [f"w{n}" for n in range(40)]
    items = [(n, " ".join(line[:20])) for n in range(30)] + [(31, "Only THREE words"), (33, ""), (34, None), (35, " ".join(["ab"] * 15)), (36, " ".join(line[5:25])), (31, "lone"), (None, "lone x")]
    texts = [
        " ".join(line), " ".join(line[:12]), "so only three, words here", "a lone w", None, "", " ".join(["ab"] * 14), "ab " * 200,
        " ".join(line[:13]) + " other" * 300, " ".join(line[:13] + ["x"] + line[13:30]), "Lone", "Lone", *[" ".join(line[3:30])] * 12,
    ]
    found = contamination(docs(*texts), spark.createDataFrame(items, "item_id long, text string"), size=13)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found.collect()}
    assert got == dict(enumerate(brute_force(texts, [i for i in items if i[0] is not None], 13)))
    assert all(sum(s["end"] - s["first"] for s in r["spans"]) == r["n_hit"] for r in found.collect())
    assert contamination(docs("a").limit(0), spark.createDataFrame(items, "item_id long, text string")).collect() == []
