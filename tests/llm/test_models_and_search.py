"""Chat formatting, top-k search, the classifier and language models."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, langid, quality
from tidemark.llm.tables import fold, stored
from tidemark.llm.topk import best, search_group, top_k
from tidemark.workspace import setting


def tree_paths(nodes, branches):
    """Root-to-leaf paths of each tree, best first."""
    found = {}
    for tree in {n[0] for n in nodes}:
        own = {n[1]: n for n in nodes if n[0] == tree}
        parents = {n[2] for n in own.values()}
        made = []
        for leaf in set(own) - parents:
            path, at = [], leaf
            while at in own and at not in path:
                path.append(at)
                at = own[at][2]
            if at not in path:
                made.append((-sum(own[n][3] or 0 for n in path), leaf, path[::-1]))
        found[tree] = [path for _, _, path in sorted(made)][:branches]
    return found


@pytest.mark.parametrize("branches", [1, 2, None])
def test_reply_trees(spark, branches):
    rng = random.Random(9)
    nodes = [(t, n, rng.randrange(n) if n else None, rng.choice([0.0, 1.0, 2.0, None]), rng.choice(["user", "assistant"]), f"m{n}") for t in range(6) for n in range(1 + 5 * t)]
    nodes += [(50, n, n - 1 if n else None, 1.0, "user", str(n)) for n in range(70)]  # a chain
    nodes += [(51, 1, 2, 1.0, "user", "x"), (51, 2, 1, 1.0, "user", "y"), (51, 3, 99, 1.0, "user", "z")]  # a circle, and a lost parent
    table = spark.createDataFrame(nodes, "tree long, node long, parent long, score double, role string, text string")
    got = defaultdict(dict)
    for r in chat.paths(table, branches).collect():
        got[r["tree"]].setdefault(r["branch"], {})[r["position"]] = r["node"]
    found = {t: [[p for _, p in sorted(b.items())] for _, b in sorted(own.items())] for t, own in got.items()}
    expected = {t: p for t, p in tree_paths(nodes, branches).items() if p}
    assert found == expected


TEXTS = ["</s>[INST] ok [/INST]", "", None, "\\", "\\\\<s>", "<s", "a\n[INST] b\\n", "[/INST]", " [/INST]</s>", "é 😀 </s>", "x" * 3000]


def test_formatting_is_reversible(spark):
    roles = ["user", "assistant", "system", "to\nol", None, "[INST] ", "assistant"]
    rows = [(c, t, roles[(c + t) % 7], TEXTS[(3 * c + t) % len(TEXTS)]) for c in range(20) for t in range(1 + c % 5)]
    rows += [(None, 0, "user", "lost"), (3, 0, "user", "same turn"), (3, 0, "user", "same turn"), (4, None, "user", "no turn")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    expected = {c: [(r[2] or "", r[3] or "") for r in sorted((x for x in rows if x[0] == c), key=key)] for c in {r[0] for r in rows}}
    written = chat.formatted(chat.paths(chat.chain(table))).collect()
    found = {r["tree"]: chat.read_turns(r["text"]) for r in written}
    assert {c: t for c, t in expected.items() if c is not None} == {c: t for c, t in found.items() if c is not None}
    for r in written:
        learnt = [chat.unescape(r["text"][s["start"] : s["end"]]) for s in r["loss"]]
        assert learnt == [text for role, text in found[r["tree"]] if role == chat.ASSISTANT]
        assert r["n_turns"] == len(found[r["tree"]])
    assert chat.formatted(chat.paths(chat.chain(table.limit(0)))).collect() == []


def test_turns_without_a_conversation_are_one(spark):
    rows = [(None, 1, "assistant", "b"), (None, 0, "user", "a"), (None, None, "system", "s"), (0, 0, "user", "z"), (7, 0, "user", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    written = chat.formatted(chat.paths(chat.chain(table))).collect()
    found = {r["tree"]: chat.read_turns(r["text"]) for r in written}
    assert len(written) == 3 and found == {None: [("system", "s"), ("user", "a"), ("assistant", "b")], 0: [("user", "z")], 7: [("user", "")]}
    named = spark.createDataFrame([(None, 1, None, 1.0), (None, 2, 1, 1.0), ("", 1, None, 0.0)], "tree string, node long, parent long, score double")
    assert sorted((str(r["tree"]), r["node"], r["position"]) for r in chat.paths(named).collect()) == [("", 1, 0), ("None", 1, 0), ("None", 2, 1)]


def test_a_hot_conversation_is_spread(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(chat, "stored", lambda df, name: dealt.append((name, stored(df, name))) or dealt[-1][1])
    rows = [(5, n, ["user", "assistant"][n % 2], f"t{n} " + "<s>" * (n % 3)) for n in range(400)] + [(c, 0, "user", "x") for c in (None, 1, 9)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        trees = chat.chain(table)
    (parts,) = [df.where("tree = 5").groupBy("_part").count().collect() for name, df in dealt if name == "ranges"]
    assert len(parts) > 1 and max(r["count"] for r in parts) < 300
    got = [r["text"] for r in trees.where("tree = 5").orderBy("node").collect()]
    assert got == [r[3] for r in rows[:400]]
    made = chat.pieces(chat.paths(trees))
    own = made.where("tree = 5").orderBy("position").collect()
    assert [r["start"] for r in own] == np.cumsum([0, *(len(r["piece"]) for r in own)])[:-1].tolist()
    assert [r["nth"] for r in own] == [r["position"] for r in own] == list(range(400))
    assert made.where("tree is null").count() == 1


def brute_top(vectors, k):
    scores = {}
    sound = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in {i: v for i, v in reversed(sound)}.items():
        if q % 100 == 0:
            own = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q and len(w) == len(v)]
            scores[q] = [(i, -s) for s, i in sorted(own)[:k]]
    return scores


def test_top_k(spark):
    rng = random.Random(10)
    vectors = [(n, [float(np.float32(rng.gauss(0, 0.1))) for _ in range(8)]) for n in range(700)]
    vectors += [(n, list(vectors[n % 5][1])) for n in range(700, 730)]  # ties
    vectors += [(800, None), (801, []), (900, [0.1] * 7 + [None]), (901, [0.1] * 7 + [float("nan")]), (902, [float("inf")] + [0.1] * 7), (None, [0.1] * 8), (1000, [0.1, 0.2]), (1001, [0.3, -0.2])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(5)
    found = defaultdict(list)
    for r in top_k(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert dict(found) == {q: s for q, s in brute_top(vectors, 10).items() if s}
    assert top_k(table.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_blocks_are_pruned():
    rng = np.random.default_rng(11)
    rows = np.concatenate([rng.integers(-50, 50, (256, 8)) + 400 * (n % 4) for n in range(32)]).astype(np.int64)
    ids = np.arange(len(rows))
    queries = rng.integers(1, 50, (5, 8)).astype(np.int64)
    found, scored = search_group(queries, np.arange(5), np.full(5, np.iinfo(np.int64).min), ids, rows, 10)
    assert scored < 5 * 16
    for q, (got_ids, got) in enumerate(found):
        scores = rows @ queries[q]
        others = ids != q
        assert [x.tolist() for x in best(ids[others], scores[others], 10)] == [got_ids.tolist(), got.tolist()]


def labelled(n):
    rng = random.Random(12)
    good = ["the", "river", "was", "quiet", "and", "we", "walked", "home", "under", "old", "trees"]
    rows = []
    for i in range(n):
        w = [rng.choice(good) + rng.choice(["", "", "s"]) for _ in range(rng.randrange(5, 60))]
        bad = rng.random() < 0.3
        rows.append((i, " ".join(x.upper() + "!!" if bad else x for x in w), int(not bad)))
    return rows


def test_quality(spark):
    rows = labelled(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(-1, None), (-2, ""), (None, "the river"), (3, rows[3][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5, None), (6, 7), (None, 1)], "doc_id long, quality int")
    fitted = quality.fit(docs, labels)
    scored = quality.score(docs, fitted).withColumn("fold", fold(F.col("doc_id"))).collect()
    truth = {i: q for i, _, q in rows}
    assert len(scored) == 604 and all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if r["fold"] == 2 and r["doc_id"] in truth]
    assert sum((r["score"] >= 0.7) == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    again = quality.score(docs, quality.fit(docs, labels)).collect()
    assert sorted(map(str, ((r["doc_id"], r["score"]) for r in again))) == sorted(map(str, ((r["doc_id"], r["score"]) for r in scored)))


def plain_streams(text):
    """The words of a text and their shapes, as byte strings, in plain Python."""
    data = (text or "").encode()
    cut = lambda b: [w for w in re.split(rb"[\x00- ]+", b) if w]
    shape = lambda c: c if c <= 32 else b"0"[0] if 48 <= c <= 57 else b"a"[0] if 97 <= c <= 122 or 128 <= c < 248 else 255 if 65 <= c <= 90 else c
    shaped = [shape(c) for c in data]
    kept = bytes(c for i, c in enumerate(shaped) if not i or c != shaped[i - 1] or data[i] <= 32)
    return [[w.lower() for w in cut(data)], cut(kept)]


def test_quality_vectors_pooling_and_logits(spark):
    """The whole way from texts to scores, word by word."""
    texts = ["the River runs, the river RUNS", None, "", "a b  a\nb 12 345 X1", "日本 é ok!!", "one", "the river " * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    places, signs = quality.index_vectors()
    size = quality.DIMENSIONS
    rows = []  # of each text, by stream, the rows of its words
    for text in texts:
        own = []
        for plain, found in zip(plain_streams(text), quality.streams(pa.array([text], pa.string()))):
            numbers = quality.rows_of(found).tolist()
            assert len(numbers) == len(plain)
            own.append((plain, numbers))
        rows.append(own)
    names = {}
    for own in rows:  # equal words have equal rows
        for stream, (plain, numbers) in enumerate(own):
            for word, number in zip(plain, numbers):
                assert names.setdefault((stream, word), number) == number
    index = np.zeros((quality.ROWS, size))
    for row in set(names.values()):
        for place, sign in zip(places[row], signs[row]):
            index[row, place] += sign
    context = np.zeros((2, quality.ROWS, size))
    for own in rows:
        for stream, (_, numbers) in enumerate(own):
            for i, row in enumerate(numbers):
                for j in range(max(0, i - quality.WINDOW), min(len(numbers), i + quality.WINDOW + 1)):
                    if i != j:
                        context[stream, row] += index[numbers[j]]
    context /= np.maximum(np.linalg.norm(context, axis=2, keepdims=True), 1e-9)
    vectors = quality.word_vectors(docs)
    assert np.allclose(vectors.reshape(2, quality.ROWS, size), context, atol=1e-6)
    pooled = np.zeros((len(texts), 4 * size))
    for n, own in enumerate(rows):
        for stream, (_, numbers) in enumerate(own):
            for row in numbers:
                pooled[n, 2 * size * stream : 2 * size * (stream + 1)] += np.concatenate([context[stream, row], index[row]]) / len(numbers)
    assert np.allclose(quality.features(pa.array(texts, pa.string()), vectors), pooled, atol=1e-5)

    rng = np.random.default_rng(4)
    net = quality.Network(rng.normal(size=4 * size), rng.uniform(0.5, 2, 4 * size), rng.normal(size=(4 * size, 3)), rng.normal(size=3), rng.normal(size=3), 0.25, 1.7)
    fitted = quality.Quality(spark.sparkContext.broadcast(vectors), net)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, fitted).collect()}
    for n, x in enumerate(pooled):
        hidden = [max(0.0, sum((x[i] - net.mean[i]) / net.scale[i] * net.w1[i, j] for i in range(4 * size)) + net.b1[j]) for j in range(3)]
        logit = sum(h * w for h, w in zip(hidden, net.w2)) + net.b2
        assert abs(got[n] - 1 / (1 + math.exp(-logit / net.temperature))) < 1e-4
    fitted.release()


def test_quality_learns_nothing_from_held_out_labels(spark):
    rows = labelled(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(fold(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (sorted(map(tuple, quality.score(docs, quality.fit(docs, x)).collect())) for x in (labels, turned))
    assert first == second


def test_quality_without_labels(spark, docs):
    table = docs("a b", None)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.score(table, quality.fit(table, labels)).collect()] == [0.5, 0.5]
    assert quality.score(table.limit(0), quality.fit(table.limit(0), labels)).collect() == []


def kneser_ney_brute(texts):
    """Interpolated Kneser-Ney from the definition; log probability of the last character of a 4-gram."""
    counts = Counter(g for t in texts for g in ("\0\0\0" + t)[:0] or [("\0\0\0" + t)[i : i + 4] for i in range(len(t))])
    tables = {4: counts}
    for n in (3, 2, 1):
        tables[n] = Counter(g[-n:] for g in {h for h in tables[n + 1]})
    discount = {}
    for n, table in tables.items():
        ones, twos = (sum(c == k for c in table.values()) for k in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(g):
        n = len(g)
        own = {h: c for h, c in tables[n].items() if h[:-1] == g[:-1]}
        lower = p(g[1:]) if n > 1 else 1 / (len(tables[1]) + 1)
        if not own:
            return lower
        total = sum(own.values())
        return max(own.get(g, 0) - discount[n], 0) / total + discount[n] * len(own) / total * lower

    return lambda g: math.log(p(g))


def test_kneser_ney():
    texts = ["abracadabra", "abra cadaver", "a bracelet", "zebra"]
    codes, _ = langid.characters(texts)
    keys = langid.grams(codes)
    keys, counts = np.unique(keys[keys != 0], return_counts=True)
    model = langid.kneser_ney(keys, counts)
    log_p = kneser_ney_brute(texts)
    asked = ["abra", "brac", "xyza", "cada", "dabz", "\0\0\0a", "\0\0\0q", "zzzz", "ra c"]
    packed = np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(g)) for g in asked], np.uint64)
    assert model.log_p(packed) == pytest.approx([log_p(g) for g in asked])


def test_characters():
    codes, begin = langid.characters(["Ab  c1,d", None, "...", "É\0f"])
    assert [bytes(codes[a:b]).decode("utf-16-le") if b > a else "" for a, b in zip(begin, [*(begin[1:] - 3), len(codes)])] == ["ab c d", "", "", "é f"]


def test_only_letters_of_other_planes_are_letters(spark):
    codes, begin = langid.characters(["\U0001f600", "a\U0001f600\U0001f601b", "\U00020000\U0001d7ce\U00010400"])
    ends = [*(begin[1:] - 3), len(codes)]
    first, second, third = (codes[a:b] for a, b in zip(begin, ends))
    assert (first.size, bytes(second).decode("utf-16-le")) == (0, "a b")
    assert third.tolist() == [0x4E00 + 0x20000 % 0x5000, 32, 0x4E00 + 0x10428 % 0x5000]
    table = spark.createDataFrame([(n, "the and \U0001f600", "en") for n in range(90)] + [(100, "\U0001f600 \U0001f680", "xx")], "doc_id long, text string, lang string")
    found = {r["doc_id"]: tuple(r)[1:] for r in langid.identify(table, langid.fit(table)).collect()}
    assert found[100] == ("und", 0.0, False) and found[1][0] == "en"


def test_languages(spark):
    rng = random.Random(13)
    stock = {"en": "the and with that this from have they were which there their".split(), "de": "und der die nicht eine sich auch werden über schön ich".split(), "fr": "les des une dans pour avec être cette était où vous".split()}
    rows = [(n, " ".join(rng.choice(stock[lang]) for _ in range(rng.randrange(3, 40))), lang) for n, lang in enumerate(rng.choices(list(stock), k=900))]
    extra = [(2000, None, "en"), (2001, "12 !? 34", "de"), (2002, "", None), (2003, "ABC", None), (None, "the and they", "en"), (1, rows[1][1], rows[1][2])]
    table = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").withColumn("score", F.lit(9))
    fitted = langid.fit(table)
    assert fitted.names == ["de", "en", "fr"]
    found = langid.identify(table, fitted).collect()
    assert len(found) == 906
    by_id = {r["doc_id"]: r for r in found}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["accepted"]) == ("und", 0, False) for i in (2000, 2001, 2002))
    assert by_id[2003]["lang_pred"] in fitted.names
    held = [(by_id[n]["lang_pred"], lang) for n, _, lang in rows if __import__("zlib").crc32(str(n).encode()) % 4 == 2]
    assert sum(a == b for a, b in held) / len(held) > 0.99
    assert all(0 <= r["score"] <= 1 for r in found)
    nothing = langid.identify(table, langid.fit(table.limit(0))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert langid.identify(table.limit(0), fitted).collect() == []


@pytest.mark.parametrize("most", ["MOST_GRAMS", "MOST_LANGUAGES"])
def test_languages_beyond_the_broadcast_lose_no_counts(spark, monkeypatch, most):
    rng = random.Random(14)
    stock = {"en": "the and with that this from have they".split(), "de": "und der die nicht eine sich über schön".split(), "zh": "你好世界 中文 语言 模型 天气".split()}
    rows = [(n, " ".join(rng.choice(stock[lang]) for _ in range(rng.randrange(1, 20))), lang) for n, lang in enumerate(rng.choices(list(stock), [8, 5, 1], k=500))]
    rows += [(900, None, "en"), (901, "12", None), (902, "qqq xyz", None), (None, "the und", "xx"), (1, rows[1][1], rows[1][2])]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = langid.fit(table)
    monkeypatch.setattr(langid, most, 2)
    monkeypatch.setattr(langid, "BROADCAST_BYTES", 0, raising=False)
    monkeypatch.setattr(langid, "ROWS_PER_SALT", 20, raising=False)
    large = langid.fit(table)
    assert large.names == small.names == ["de", "en", "xx", "zh"] and large.temperature == pytest.approx(small.temperature)
    key = lambda r: str(r["doc_id"])
    expected, found = (sorted(langid.identify(table, x).collect(), key=key) for x in (small, large))
    assert len(found) == len(rows)
    for a, b in zip(expected, found):
        assert (a["doc_id"], a["lang_pred"], a["accepted"]) == (b["doc_id"], b["lang_pred"], b["accepted"])
        assert a["score"] == pytest.approx(b["score"], abs=1e-9)


def test_languages_calibrate_on_all_known_texts(spark, monkeypatch):
    """Far more than 2000 texts: each of them is counted, and each decides on the threshold."""
    rng = random.Random(15)
    stock = {"en": "the and with that this from have they".split(), "de": "und der die nicht eine sich über schön".split()}
    known = [n for n in range(8000) if __import__("zlib").crc32(str(n).encode()) % 4 != 2]
    rows = [(n, " ".join(rng.choice(stock[lang]) for _ in range(6)), lang) for n, lang in zip(known, rng.choices(list(stock), k=len(known)))]
    seen = []
    monkeypatch.setattr(langid, "_threshold", lambda decisions, plain=langid._threshold: seen.append(decisions.count()) or plain(decisions))
    fitted = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert seen == [len(known)]
    grams = sum((langid.characters([text])[0] != 0).sum() for _, text, lang in rows if lang == "en")
    model = fitted.models[fitted.names.index("en")]
    keys, counts = np.unique(np.concatenate([k[k != 0] for k in (langid.grams(langid.characters([t])[0]) for _, t, x in rows if x == "en")]), return_counts=True)
    assert counts.sum() == grams and all((a == b).all() for a, b in zip(model.seen[3], langid.kneser_ney(keys, counts).seen[3]))


def test_language_threshold_by_ranges(spark):
    rng = random.Random(16)
    rows = [(rng.choice([1.0, round(rng.random(), 3), rng.random()]), rng.random() < 0.995) for _ in range(3000)]
    expected, right, n = 1.0, 0, 0
    for best in sorted({b for b, _ in rows}, reverse=True):
        right, n = right + sum(r for b, r in rows if b == best), n + sum(b == best for b, _ in rows)
        expected = best if right / n >= langid.ACCEPTED_RIGHT else expected
    assert langid._threshold(spark.createDataFrame(rows, "best double, right boolean").repartition(7)) == expected
    assert langid._threshold(spark.createDataFrame([(0.7, False)], "best double, right boolean")) == 1.0
