"""The queries of this subpackage: each applies one operator to its whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bit_kmeans, chat, langid, quality, sketch
from tidemark.llm.bitplane import read_shards, write_shards
from tidemark.llm.decontaminate import contamination
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.ngram_join import jaccard_join
from tidemark.llm.packing import pack
from tidemark.llm.piece_table import fill_in_middle, restore
from tidemark.llm.pii import replace_entities
from tidemark.llm.tables import HELD_OUT, fold, map_arrow, read
from tidemark.llm.topk import top_k
from tidemark.workspace import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD_END_ID = 2
#: The query's own key; a real corpus needs a secret one.
SURROGATE_KEY = "op7"


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack(read(spark, sf_dir, "documents"), BYTE_BPE).placed
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join(read(spark, sf_dir, "documents"), ngram=4, threshold=Fraction(85, 100))
    return joined.component_ids().withColumnRenamed("n", "n_shingles")


#: A conversation whose texts are control strings, put beside those of the table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a reader of the formatted conversations finds, as digests; their turns come in order, one after the other."""
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    key, n, seen, learnt_chars, learnt, chars = None, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
    for batch in batches:
        rows = []
        for *own, piece, is_loss, start in zip(*(batch.column(c).to_pylist() for c in (*chat.KEY, "piece", "is_loss", "start"))):
            if own != key:
                if key is not None:
                    rows.append((key[0], n, seen.hexdigest(), learnt_chars, learnt.hexdigest(), chars))
                key, n, seen, learnt_chars, learnt, chars = own, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            if start != chars:
                raise ValueError(f"a turn of conversation {own[0]} begins at {start}, not at {chars}")
            for role, words in chat.read_turns(piece):
                n += 1
                seen.update(f"{role}\n{words}\n".encode())
            if is_loss:
                words = chat.unescape(piece[len("<s>") : -len("</s>")])
                learnt_chars += len(words)
                learnt.update(words.encode())
            chars += len(piece)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names)
    if key is not None:
        last = (key[0], n, seen.hexdigest(), learnt_chars, learnt.hexdigest(), chars)
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, types)], names)


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = [(-1, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    turns = turns.union(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    written = chat.pieces(chat.paths(chat.chain(turns))).select(*chat.KEY, "position", "piece", "is_loss", "start")
    written = written.repartition(*chat.KEY).sortWithinPartitions(*chat.KEY, "position")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(written, _read_back, schema)


def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


def _surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(read(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY).documents


def _top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


KEEP_SCORE = 0.7


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= KEEP_SCORE).cast("int")
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", predicted.alias("predicted"))


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score", "accepted")


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    shards = write_shards(read(spark, sf_dir, "documents"), folder, WORD_BPE, lead=False, end_id=WORD_END_ID)
    return read_shards(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_kmeans.with_inertia(bit_kmeans.cluster(read(spark, sf_dir, "embeddings")))


def _fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = restore(fill_in_middle(read(spark, sf_dir, "documents")).drop("spans"))
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.fingerprints(read(spark, sf_dir, "documents"))
    own, edited, other = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        sketch.fingerprint(own).alias("fingerprint"),
        sketch.fingerprint(edited).alias("edited_fingerprint"),
        sketch.likeness(own, edited).alias("near_edited"),
        sketch.likeness(own, other).alias("near_next"),
        sketch.containment(own, edited).alias("held_by_edited"),
        sketch.containment(own, other).alias("held_by_next"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": _packing,
    "op2_decontamination": _decontamination,
    "op3_ngram_jaccard_join": _near_duplicates,
    "op4_chat_formatting": _chat,
    "op5_quality_classifier": _quality,
    "op6_line_dedup": _line_dedup,
    "op7_pii_surrogates": _surrogates,
    "op8_exact_top_k": _top_k,
    "op9_language_id": _languages,
    "op10_token_files": _token_files,
    "op11_centroid_clusters": _clusters,
    "op12_fill_in_middle": _fill_in_middle,
    "op13_document_fingerprints": _fingerprints,
}

LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

KEPT_VECTOR = "list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), 'bool_and')"


def _assigned_sql(centroids: str) -> str:
    return f"""SELECT r, vec_id, e, min((d, c)) AS best FROM (
        SELECT v.r, v.vec_id, v.e, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - k.e[i]) * (v.e[i] - k.e[i]))) AS d, k.c
        FROM v, {centroids} AS k) GROUP BY r, vec_id, e"""


def _moved_sql(assigned: str, centroids: str) -> str:
    return f"""SELECT k.c, coalesce(m.e, k.e) AS e FROM {centroids} AS k LEFT JOIN (
        SELECT c, list(x ORDER BY i) AS e FROM (
            SELECT c, i, floor(sum(x) / count(*)) AS x
            FROM (SELECT struct_extract_at(best, 2) AS c, unnest(range(1, 65)) AS i, unnest(e) AS x FROM {assigned}) GROUP BY c, i
        ) GROUP BY c) AS m ON k.c = m.c"""


def _clusters_sql() -> str:
    steps = []
    for n in range(bit_kmeans.ROUNDS):
        steps += [f"a{n} AS MATERIALIZED ({_assigned_sql(f'k{n}')})", f"k{n + 1} AS MATERIALIZED ({_moved_sql(f'a{n}', f'k{n}')})"]
    last = f"k{bit_kmeans.ROUNDS}"
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64 AND {KEPT_VECTOR}
), k0 AS MATERIALIZED (
    SELECT c, e FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), e) - 1 AS c, e FROM v) WHERE c < 40
), {", ".join(steps)}, last AS MATERIALIZED ({_assigned_sql(last)}
), placed AS (
    SELECT vec_id, struct_extract_at(best, 2) AS c, struct_extract_at(best, 1) AS d FROM last
)
SELECT vec_id, CAST(placed.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY placed.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(k.e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM placed JOIN {last} AS k ON placed.c = k.c
"""


def _sketch_sql(text: str) -> str:
    """The sketch of a text as a list of hexadecimal numbers."""
    spaces = " || ".join(f"chr({ord(c)})" for c in "\t\n\x0b\f\r")
    even = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || {spaces}, 'abcdefghijklmnopqrstuvwxyz     ')"
    return f"""(SELECT CASE WHEN len(low) > 0 THEN low ELSE list_slice(list_sort(hashes), 1, 1) END FROM (
        SELECT hashes, list_sort(list_distinct(list_filter(hashes, lambda h: h < '200000000000000'))) AS low FROM (
            SELECT list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END),
                lambda i: substr(md5(array_to_string(list_slice(w, i, i + 4), ' ')), 1, 15)) AS hashes
            FROM (SELECT list_filter(string_split({even}, ' '), lambda x: x <> '') AS w))))"""


def _likeness_sql(a: str, b: str) -> str:
    return f"""CASE WHEN len({a}) + len({b}) = 0 THEN 1.0
        ELSE len(list_intersect({a}, {b})) / CAST(len({a}) + len({b}) - len(list_intersect({a}, {b})) AS DOUBLE) END"""


def _containment_sql(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b})) / CAST(len({a}) AS DOUBLE) END"


ORACLES: dict[str, str] = {
    "op13_document_fingerprints": f"""
WITH d AS MATERIALIZED (
    SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS ahead
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), e AS MATERIALIZED (
    SELECT doc_id, n, t, ahead, substr(t, 1, n - n // 4) || substr(ahead, 1, n // 4) AS edited FROM d
), s AS MATERIALIZED (
    SELECT doc_id, n, sha256(edited) AS edited_sha256, {_sketch_sql("t")} AS a, {_sketch_sql("edited")} AS b, {_sketch_sql("ahead")} AS c FROM e
)
SELECT doc_id, n AS n_chars, edited_sha256, array_to_string(a, ',') AS fingerprint, array_to_string(b, ',') AS edited_fingerprint,
    CAST({_likeness_sql("a", "b")} AS DOUBLE) AS near_edited, CAST({_likeness_sql("a", "c")} AS DOUBLE) AS near_next,
    CAST({_containment_sql("a", "b")} AS DOUBLE) AS held_by_edited, CAST({_containment_sql("a", "c")} AS DOUBLE) AS held_by_next
FROM s
""",
    "op11_centroid_clusters": _clusters_sql(),
    "op12_fill_in_middle": """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), cut AS (
    SELECT doc_id, t, length(t) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) % (length(t) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (length(t) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), parts AS (
    SELECT doc_id, t, n, form, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m,
        substr(t, greatest(a, b) + 1) AS s
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
""",
    "op2_decontamination": f"""
WITH dw AS (
    SELECT row_number() OVER () AS r, doc_id,
        coalesce(regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
    FROM documents
), bw AS (
    SELECT item_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), bwin AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS k, list_slice(w, i, i + 12) AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0)
), dwin AS (
    SELECT r, k, i, list_slice(w, i, i + k - 1) AS win
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM bwin))
), occ AS (
    SELECT r, i, k, item_id FROM dwin JOIN bwin USING (k, win)
), hits AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM occ) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
""",
    "op6_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, line_no, line, list_filter(string_split_regex(line, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
    FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
        FROM documents
    )
), firsts AS (
    SELECT words, len(words) AS n, row_number() OVER (ORDER BY min((doc_id, line_no))) AS nth, min((doc_id, line_no)) AS at
    FROM lines WHERE len(words) > 0 GROUP BY words
), rests AS (
    SELECT nth, p, words[1 : p - 1] || words[p + 1 :] AS rest
    FROM (SELECT nth, words, unnest(range(1, n + 1)) AS p FROM firsts WHERE n >= 8)
    UNION ALL SELECT nth, 0, words FROM firsts WHERE n >= 8
), near AS (
    SELECT DISTINCT x.nth FROM rests AS x JOIN rests AS y
    ON x.rest = y.rest AND y.nth < x.nth AND (x.p = y.p OR x.p = 0 OR y.p = 0)
), decided AS (
    SELECT l.doc_id, l.line_no, l.line,
        f.nth IS NULL OR (near.nth IS NULL AND f.at = (l.doc_id, l.line_no)) AS stays
    FROM lines AS l LEFT JOIN firsts AS f ON l.words = f.words LEFT JOIN near ON f.nth = near.nth
)
SELECT doc_id, CASE WHEN count(*) FILTER (stays) = count(*) THEN any_value(text)
        ELSE coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '') END AS text,
    count(line) AS n_lines, count(line) - count(line) FILTER (stays) AS n_dropped
FROM documents LEFT JOIN decided USING (doc_id) GROUP BY doc_id
""",
    "op8_exact_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), 'bool_and')
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
}
