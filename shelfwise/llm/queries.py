"""The registered queries of the operators, and their SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    contamination,
    fill_middle,
    html_text,
    jaccard_join,
    packing,
    periodic_runs,
    piece_encoding,
    private_data,
    quality_classifier,
    suffix_dedup,
    token_records,
    topk_search,
    toxicity,
)
from shelfwise.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as token records and reads them back."""
    path = f"{scratch_dir(spark)}/tokens"
    token_records.write_records(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, missing=True
    )
    read = token_records.read_records(spark, path).select("part", "offset", F.crc32("ids").alias("ids_crc32"))
    return read.join(token_records.read_index(spark, path), ["part", "offset"]).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "part", "offset", "length"
    )


def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_passages(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.find_private(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[n.alias(name) for name, n in private_data.counts(F.col("base")).items()],
        F.sha2(private_data.digest_text(F.col("base")), 256).alias("base_sha256"),
        private_data.digest_text(F.col("spans")).alias("spans"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = html_text.extract_text(pages.select("page_id", "url", "html"), html_text.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 20 against all rows."""
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, texts = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    cut = texts.select("id", removed.alias("cut"), F.size("spans").cast("long").alias("runs"), F.sha2("kept", 256).alias("kept_sha256"))
    joined = documents.withColumnRenamed("sha256", "own").join(cut, "id", "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "own")).alias("kept_sha256"),
    )


def _fold(n: int) -> Column:
    """The remainder by which labelled rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"), _fold(5) != 0)
    return quality_classifier.add_scores(docs, model).select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), _fold(4) != 2)
    return toxicity.add_scores(docs, model).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_encoding.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return piece_encoding.decode(encoded.drop("text"), model).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def _planted(doc_id: Column, text: Column) -> Column:
    """The text; for one document in ten, by its id, its words go on periodically from one of them."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(words, i)), " ")).otherwise(text)

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    bound = F.transform(F.array(words), periodic)  # a variable, so that the words are split once
    return F.when((h % 10 == 0) & text.isNotNull(), F.get(bound, F.lit(0))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.collapse(docs.withColumn("text", _planted(F.col("doc_id"), F.col("text"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return found.withColumn("best", periodic_runs.most_periods(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fill_middle.restore(fill_middle.rearrange(docs).drop("text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_token_records,
        op2_contamination,
        op3_private_data,
        op4_html_text,
        op5_packing,
        op6_jaccard_join,
        op7_topk_search,
        op8_suffix_dedup,
        op9_quality,
        op10_toxicity,
        op11_sentencepiece,
        op12_periodic_runs,
        op13_fill_middle,
    )
}

_OP2_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE_SQL = {
    "op2_contamination": rf"""
WITH items AS (
    SELECT item_id, {_OP2_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_OP2_WORDS} AS w FROM documents
), starts AS (
    SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs
), hits AS (
    SELECT s.r, s.i, v.n, v.item_id
    FROM (SELECT DISTINCT n FROM windows) AS sizes
    JOIN (SELECT r, i, w, len(w) AS total FROM starts) AS s ON s.i + sizes.n - 1 <= s.total
    JOIN windows AS v ON v.n = sizes.n AND v.words = array_to_string(list_slice(s.w, s.i, s.i + sizes.n - 1), ' ')
), words AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), found AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(found.n_items, 0) AS n_items,
       sha256(coalesce(found.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM docs AS d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
""",
    "op6_jaccard_join": r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
    ) AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach AS (
    SELECT doc_id, doc_id AS other FROM docs
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) USING (doc_id)
""",
    "op7_topk_search": """
WITH usable AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
    FROM usable
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts AS q JOIN parts AS c ON c.i = q.i AND c.vec_id <> q.vec_id
    WHERE q.vec_id % 20 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
""",
    "op13_fill_middle": """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
    FROM documents
), numbers AS (
    SELECT doc_id, t, n, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS b,
           CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS e
    FROM hashed
), parts AS (
    SELECT doc_id, t, n, least(a, b) AS i, greatest(a, b) - least(a, b) AS k,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
                WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form,
           substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m, substr(t, greatest(a, b) + 1) AS s
    FROM numbers
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN k END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
}
